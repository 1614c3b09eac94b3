"""MinHash near-duplicate detection with circulant permutations and exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitmark.llm.common import batch, contract, texts_of, unused
from pitmark.operators.components import components
from pitmark.operators.scratch import materialise

_SIGNED = pa.schema([("id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("bands", pa.list_(pa.int64()))])
_SETS = pa.schema([("cls", pa.int64()), ("hashes", pa.list_(pa.int64()))])
_CLASS = ["d1", "d2", "n"]
#: Word hashes remembered by a Python worker.
_MEMORY = 400_000
#: Shingles whose coordinates are computed together, so that they stay in cache.
_BLOCK = 1 << 15
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_words = _WordHashes()


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``size`` words.

    A-Z are lower-cased and words are runs of anything but ASCII white space,
    which is what ``bytes.lower`` and ``bytes.split`` do. Fewer words make one
    shingle of all of them; no words make none.
    """
    if len(_words) > _MEMORY:
        _words.clear()
    words = text.encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - size + 1) if len(h) else 0
    width = min(size, len(h))
    total = np.full(n, width, np.uint64)
    for j in range(width):
        total = _mix64(total * _ODD[j % len(_ODD)] + h[j : j + n])
    return np.unique(total)


def signatures(sets: list[np.ndarray], coordinates: int, seed: int) -> np.ndarray:
    """Circulant MinHash: (set, coordinate) -> uint32.

    The first permutation scatters the shingles over 2**32 places; coordinate k
    is the least value of the second permutation after a circular shift by k.
    Both permutations are invertible mixers of 32-bit integers. Sets may not be empty.
    """
    out = np.empty((len(sets), coordinates), np.uint32)
    sizes = np.array([len(s) for s in sets])
    first = 0
    while first < len(sets):
        last = first + 1
        while last < len(sets) and sizes[first : last + 1].sum() <= _BLOCK:
            last += 1
        with np.errstate(over="ignore"):
            x = (_mix64(np.concatenate(sets[first:last]) + np.uint64(seed)) >> np.uint64(32)).astype(np.uint32)
            starts = np.concatenate([[0], np.cumsum(sizes[first : last - 1])])
            y, z = np.empty_like(x), np.empty_like(x)
            for k in range(coordinates):
                np.subtract(x, np.uint32(k), out=y)
                for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
                    np.right_shift(y, np.uint32(shift), out=z)
                    np.bitwise_xor(y, z, out=y)
                    np.multiply(y, np.uint32(factor), out=y)
                np.right_shift(y, np.uint32(16), out=z)
                np.bitwise_xor(y, z, out=y)
                out[first:last, k] = np.minimum.reduceat(y, starts)
        first = last
    return out


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    """(set, half) -> 128 bits that stand for the set; zeros for an empty one."""
    out = np.zeros((len(sets), 2), np.int64)
    for i, s in enumerate(sets):
        if len(s):
            out[i] = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
    return out


def _signed(docs: DataFrame, size: int, rows: int, bands: int, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t, size) for t in texts_of(b.column(2))]
            full = [i for i, s in enumerate(sets) if len(s)]
            digests = _digests(sets)
            keys: list = [None] * len(sets)
            if full:
                sig = signatures([sets[i] for i in full], rows * bands, seed).reshape(len(full), bands, rows).astype(np.uint64)
                with np.errstate(over="ignore"):
                    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), sig.shape[:2])
                    for j in range(rows):
                        key = _mix64(key * _ODD[j % len(_ODD)] + sig[:, :, j])
                for i, k in zip(full, key.view(np.int64), strict=True):
                    keys[i] = k
            yield batch(_SIGNED, id=b.column(0), text_hash=b.column(1), n=[len(s) for s in sets], d1=digests[:, 0], d2=digests[:, 1], bands=keys)

    return docs.select("id", "text_hash", "text").mapInArrow(run, "id long, text_hash long, n long, d1 long, d2 long, bands array<long>")


def _sets_of(wanted: DataFrame, owners: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(cls, hashes) of the classes ``wanted``, each from one text: ``owners`` has the id and the text's hash of each class.

    The texts are dealt by id and hash once, in the same way at every size, so
    very many texts of one id are dealt out too; the other texts go unread.
    """
    owned = materialise(wanted.select("cls").distinct().join(owners, "cls"), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t, size) for t in texts_of(b.column(0))]
            # two texts of an id may have one hash: the set itself says whose it is
            mine = [k for k, (d, x, y) in enumerate(zip(_digests(sets).tolist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)) if d == [x, y]]
            yield batch(_SETS, cls=b.column(1).take(pa.array(mine, pa.int64())), hashes=[sets[k].view(np.int64) for k in mine])

    made = docs.join(owned.hint("shuffle_hash"), ["id", "text_hash"]).select("text", "cls", "d1", "d2").mapInArrow(run, "cls long, hashes array<long>")
    return materialise(made.dropDuplicates(["cls"]), "sets")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose full sets overlap enough.

    The set of b travels with the pair to where the set of a is, so a leader's
    set is not copied about; both joins have an exchange on either side and may
    be split where a leads very many.
    """
    left = sets.select(F.col("cls").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("cls").alias("b"), F.col("hashes").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    return pairs.join(right, "b").join(left, "a").where(100 * both >= percent * (F.size("ha") + F.size("hb") - both)).select("a", "b")


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """(left, right) -> size of the intersection, as products of slices of the incidence matrix."""
    sizes = np.array([len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    shared = count[column] > 1
    number = np.cumsum(count > 1) - 1
    row, column = row[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
        lo, hi = np.searchsorted(column, (first, first + 2048))
        part = np.zeros((len(sets), 2048), np.float32)
        part[row[lo:hi], column[lo:hi] - first] = 1
        out += part[left] @ part[right].T
    out[left[:, None] == right] = sizes[left[np.isin(left, right)]]
    return out.astype(np.int64)


def _within_groups(groups: DataFrame, root: DataFrame, sets: DataFrame, percent: int, block: int = 128) -> DataFrame:
    """Links between members (a, cls) of a leader's group that no link joins so far.

    A group of one component needs no more comparison. In the others, members
    of the largest component meet those of the smaller ones only, and these
    meet all. Both sides are cut by hash into parts of about ``block``; two
    parts meet in one task's group, and a forest of their links comes out: no
    pairs are written.
    """
    state = groups.join(root, "cls", "left").select("a", "cls", F.coalesce("root", "cls").alias("comp"))
    state = materialise(state, "state")
    sizes = state.groupBy("a", "comp").agg(F.count("*").alias("m"))
    open_ = sizes.groupBy("a").agg(F.sum("m").alias("all"), F.max("m").alias("most"), F.max_by("comp", F.struct("m", "comp")).alias("main"), F.count("*").alias("comps")).where("comps > 1")
    open_ = materialise(open_.select("a", "main", F.ceil((F.col("all") - F.col("most")) / block).alias("few"), F.ceil(F.col("most") / block).alias("many")), "open")
    members = state.join(open_, "a")
    deal = lambda parts: F.pmod(F.xxhash64("cls", F.lit(3)), F.col(parts))
    main = F.col("comp") == F.col("main")
    members = materialise(members.select("a", "cls", "comp", "few", "many", main.alias("in_main"), F.when(main, F.col("few") + deal("many")).otherwise(deal("few")).alias("part")), "members")
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("few") + F.when(F.col("in_main"), 0).otherwise(F.col("many")) - 1))
    dealt = members.select("a", "cls", "comp", "part", others.alias("other")).join(sets, "cls")
    dealt = dealt.select("a", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "cls", "comp", "part", "hashes")

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids, comp, part = (table[c].to_numpy() for c in ("cls", "comp", "part"))
        hashes = table["hashes"].combine_chunks()
        cuts = hashes.offsets.to_numpy()
        flat = hashes.values.to_numpy()
        sets = [flat[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        left, right = (np.flatnonzero(part == k.as_py()) for k in key[1:])
        both, n = overlaps(sets, left, right), np.diff(cuts)
        near = (100 * both >= percent * (n[left][:, None] + n[right] - both)) & (comp[left][:, None] != comp[right])
        i, j = np.nonzero(near)
        at = contract(left[i], right[j], len(ids))
        tied = np.flatnonzero(at != np.arange(len(ids)))
        return pa.table({"a": pa.array(ids[tied], pa.int64()), "b": pa.array(ids[at[tied]], pa.int64())})

    return dealt.groupBy("a", "p", "q").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, size: int = 5, percent: int = 80, rows: int = 5, bands: int = 30, seed: int = 7) -> DataFrame:
    """Classes of documents linked by a Jaccard similarity of at least ``percent`` hundredths.

    Per row of ``docs``: doc_id, n_shingles, class_id (smallest id with the
    same set of shingles), component_id (smallest id reachable over links),
    kept. Equal sets fall into a class before anything is compared; only class
    representatives are banded. At a similarity of just 0.8 a pair meets in no
    band with a chance of (1 - 0.8**rows)**bands: 7 in a million by default.
    Every candidate is then confirmed on the full sets.

    A bucket is not expanded into pairs. Its leader, the member that shares
    most buckets with others, is compared with the rest and links are
    contracted: a bucket of copies is done after one comparison for each member.
    Buckets of one leader then make one group. Where a group still holds several
    components, those are compared in blocks, so that every pair of a bucket
    that could join two components is decided on the full sets.

    Null and blank texts have no shingles and are linked with nothing; so are
    rows with a null id, whose class and component are null. Repeated ids give a
    row each; if their texts differ, the id belongs to what any of them reaches.
    An empty table gives no rows. Other columns are ignored.
    """
    docs = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")).withColumn("text_hash", F.xxhash64("text"))
    signed = materialise(_signed(docs, size, rows, bands, seed), "signed")
    some = signed.where("n > 0 and id is not null")
    classes = some.groupBy(*_CLASS).agg(F.min("id").alias("rep"))
    classes = materialise(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    first = some.join(classes, _CLASS).where("id = rep").dropDuplicates(["cls"])
    first = materialise(first.select("cls", "id", "text_hash", "n", "d1", "d2", "bands"), "first")
    banded = materialise(first.select("cls", "n", F.explode("bands").alias("bucket")), "banded")
    shared = materialise(banded.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1"), "shared")
    met = materialise(banded.join(shared, "bucket"), "met")
    common = materialise(met.groupBy("cls").agg(F.sum("m").alias("pop")), "common")
    met = met.join(common, "cls").select("bucket", "cls", "n", "pop")
    sets = _sets_of(met, first.select("cls", "id", "text_hash", "d1", "d2"), docs, size)
    # an id with several sets ties their classes together
    twin = some.groupBy("id").agg(F.min("d1").alias("x1"), F.max("d1").alias("x2"), F.min("d2").alias("y1"), F.max("d2").alias("y2")).where("x1 <> x2 or y1 <> y2").select("id")
    several = materialise(some.join(twin, "id", "left_semi").select("id", *_CLASS).distinct().join(classes.drop("rep"), _CLASS).select("id", F.col("cls").alias("a")), "several")
    links = materialise(several.join(several.groupBy("id").agg(F.min("a").alias("b")), "id").where("a <> b").select("a", "b").distinct(), "links")
    roots = lambda links: materialise(components(links, "a", "b").select(F.col("node").alias("cls"), F.col("component").alias("root")), "roots")
    leads = materialise(met.groupBy("bucket").agg(F.max_by(F.struct("cls", "n"), F.struct("pop", -F.col("cls"))).alias("x")).select("bucket", F.col("x.cls").alias("a"), F.col("x.n").alias("na")), "leads")
    led = materialise(met.join(leads, "bucket").where("cls <> a").select("a", F.col("cls").alias("b"), F.col("n").alias("nb"), "na").distinct(), "led")
    links = materialise(links.unionByName(_linked(led.where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)").select("a", "b"), sets, percent)), "links")
    root = roots(links)
    found = materialise(_within_groups(led.select("a", F.col("b").alias("cls")), root, sets, percent), "found")
    root = roots(links.unionByName(found))
    least = root.join(classes.select("cls", "rep"), "cls").groupBy("root").agg(F.min("rep").alias("least"))
    root = materialise(root.join(least, "root").select("cls", "least"), "least")
    member = materialise(classes.join(root, "cls", "left").select(*_CLASS, "rep", F.coalesce("least", "rep").alias("root")), "member")
    return (
        signed.join(member, _CLASS, "left")
        .select(
            F.col("id").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("rep", "id")).alias("class_id"),
            F.when(F.col("id").isNotNull(), F.coalesce("root", "id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: of its smallest id, and of that id's rows the one with the first text.

    Rows without words and rows with a null id are linked with nothing and all
    stay; so an id's blank rows outlive its other texts. An id that very many
    rows share is reduced in each task before they meet.
    """
    found = near_duplicates(docs, id_col, text_col, **options).where("n_shingles > 0 and doc_id is not null")
    key, stays = unused(docs, "id", "stays")
    decided = found.groupBy("doc_id").agg(F.bool_and("kept").alias("stays"), F.count("*").alias("n")).where("not stays or n > 1")
    decided = materialise(decided.select(F.col("doc_id").alias(key), F.col("stays").alias(stays)), "decided")
    words = F.coalesce(docs[text_col].rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    rows = docs.withColumn(key, F.when(words, docs[id_col].cast("long"))).join(decided, key, "left")
    single = rows.where(F.col(stays).isNull()).select(*docs.columns)
    several = rows.where(F.col(stays)).groupBy(key).agg(F.min_by(F.struct(*docs.columns), text_col).alias("row"))
    return single.unionByName(several.select("row.*"))
