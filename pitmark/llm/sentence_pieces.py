"""Encoding into a fixed piece vocabulary and back, many words at once."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pitmark.llm.common import batch, texts_of
from pitmark.llm.pieces import PieceTable, by_length, codes, piece_table

_SEGMENT = re.compile("▁+[^▁]*")
#: Segments that a Python worker remembers, from task to task.
_MEMORY = 400_000
#: Characters of neighbouring texts that are worked on together; a longer text stands alone.
_AT_ONCE = 2_000_000
#: Segments longer than this are walked one by one: the same result by another loop.
_LONG_PATH, _LONG_MERGE = 1024, 48
#: What the best path pays, beyond the worst piece, for a character that is no piece.
_STRANGE = 10.0
_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
_DECODED = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])


class Ragged:
    """Rows of numbers of any length, one after another."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.ends = flat, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of these rows, and how many each has."""
        starts = self.ends[rows]
        sizes = self.ends[rows + 1] - starts
        ends = np.cumsum(sizes)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)], sizes

    def joined(self, flat: list[np.ndarray], sizes: list[np.ndarray]) -> Ragged:
        return Ragged(np.concatenate([self.flat, *flat]), np.concatenate([np.diff(self.ends), *sizes]))


def _stack(lattice: list[np.ndarray], words: int, length: int) -> np.ndarray:
    """(piece length, word, start) -> piece id or -1."""
    out = np.full((len(lattice) + 1, words, length), -1, np.int32)
    for k, x in enumerate(lattice):
        out[k + 1, :, : x.shape[1]] = x
    return out


def best_paths(table: PieceTable, lattice: np.ndarray) -> np.ndarray:
    """(word, piece) -> start of the pieces of the best path, filled up with the length.

    The path with the largest sum of scores; all words take a step together, and
    a tie goes to the longer last piece. A character that is no piece is a step
    of its own.
    """
    longest, words, length = lattice.shape
    scores = np.append(table.scores, -np.inf)
    floor = table.scores[table.ids].min() - _STRANGE
    best, back = np.full((length + 1, words), -np.inf), np.ones((length + 1, words), np.int32)
    best[0] = 0
    for j in range(1, length + 1):
        for k in range(min(j, longest - 1), 0, -1):
            step = scores[lattice[k, :, j - k]]
            if k == 1:
                step = np.where(np.isneginf(step), floor, step)
            total = best[j - k] + step
            better = total > best[j]
            best[j] = np.where(better, total, best[j])
            back[j] = np.where(better, k, back[j])
    row, at = np.arange(words), np.full(words, length)
    cut = np.zeros((words, length + 1), bool)
    while at.any():
        at = np.maximum(at - back[at, row], 0)
        cut[row, at] = True
    return np.sort(np.where(cut, np.arange(length + 1), length), axis=1)


def merged(table: PieceTable, lattice: np.ndarray) -> np.ndarray:
    """The same after merging: of all neighbours that make a piece the best-scored pair first, ties to the left."""
    longest, words, length = lattice.shape
    scores = np.append(table.scores, -np.inf)
    out = np.full((words, length + 1), length)
    at, starts = np.arange(words), np.broadcast_to(np.arange(length + 1), (words, length + 1)).copy()
    while len(at):
        size = starts[:, 2:] - starts[:, :-2]
        fits = (size > 0) & (size < longest) & (starts[:, 1:-1] < length)
        found = np.where(fits, lattice[np.where(fits, size, 0), at[:, None], np.minimum(starts[:, :-2], length - 1)], -1)
        score = scores[found]
        pick = score.argmax(1) if score.shape[1] else np.zeros(len(at), int)
        done = np.isneginf(score[np.arange(len(at)), pick]) if score.shape[1] else np.ones(len(at), bool)
        out[at[done], : starts.shape[1]] = starts[done]
        at, starts, pick = at[~done], starts[~done], pick[~done]
        if len(at):
            column = np.arange(starts.shape[1] - 1)
            starts = np.where(column < pick[:, None] + 1, starts[:, :-1], starts[:, 1:])
    return out


def walked_path(table: PieceTable, lattice: np.ndarray) -> np.ndarray:
    """``best_paths`` of one long word: only the pieces that its lattice has are looked at."""
    longest, _, length = lattice.shape
    size, start = np.nonzero(lattice[:, 0] >= 0)
    order = np.lexsort((-size, start + size))
    size, start = size[order], start[order]
    score = table.scores[lattice[size, 0, start]].tolist()
    ends, size = (start + size).tolist(), size.tolist()
    floor = float(table.scores[table.ids].min() - _STRANGE)
    best, back, at = [0.0], [0], 0
    for j in range(1, length + 1):
        top, step, single = -np.inf, 1, False
        while at < len(ends) and ends[at] == j:
            total = best[j - size[at]] + score[at]
            single |= size[at] == 1
            if total > top:
                top, step = total, size[at]
            at += 1
        if not single and best[j - 1] + floor > top:
            top, step = best[j - 1] + floor, 1
        best.append(top)
        back.append(step)
    cut, j = [], length
    while j:
        j -= back[j]
        cut.append(j)
    return np.array([[*reversed(cut), length]])


def walked_merges(table: PieceTable, lattice: np.ndarray) -> np.ndarray:
    """``merged`` of one long word: a heap holds the pairs, and only pairs beside a merge are looked at again."""
    longest, _, length = lattice.shape
    after, before, alive = list(range(1, length + 1)), list(range(-1, length)), [True] * length
    heap: list[tuple[float, int, int]] = []

    def offer(i: int) -> None:
        if 0 <= i and after[i] < length and (size := after[after[i]] - i) < longest and (piece := lattice[size, 0, i]) >= 0:
            heapq.heappush(heap, (-table.scores[piece], i, size))

    for i in range(length - 1):
        offer(i)
    while heap:
        _, i, size = heapq.heappop(heap)
        if alive[i] and after[i] < length and after[after[i]] == i + size:
            alive[after[i]] = False
            after[i] = i + size
            before[i + size] = i
            offer(before[i])
            offer(i)
    return np.array([[*(i for i in range(length) if alive[i]), length]])


def _ids(table: PieceTable, words: list[str], lattice: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all words, and how many each word has; bytes stand for a character that is no piece."""
    size = starts[:, 1:] - starts[:, :-1]
    real = size > 0
    row, at = np.nonzero(real)[0], starts[:, :-1][real]
    flat, counts = lattice[size[real], row, at], real.sum(1)
    strange = np.flatnonzero(flat < 0)
    if len(strange):
        said = [[table.bytes[y] for y in words[r][a].encode("utf-8", "replace")] if table.bytes else [table.unknown] for r, a in zip(row[strange].tolist(), at[strange].tolist(), strict=True)]
        times = np.ones(len(flat), np.int64)
        times[strange] = list(map(len, said))
        counts = counts + np.bincount(row[strange], times[strange] - 1, len(words)).astype(np.int64)
        flat = np.repeat(flat, times)
        flat[flat < 0] = np.concatenate(said)
    return flat.astype("<u4"), counts


class PieceEncoder:
    """Ids of texts, each segment worked out once while it is remembered.

    The model puts a mark before the text and for every space. No piece has the
    mark after another character, so a text falls into segments that begin with
    marks and are encoded alone. ``ways``: by the best path over summed scores
    (``best_paths``), by merges (``merged``), or both from one lattice. When
    memory is full, segments met only once since it last was are forgotten.
    """

    def __init__(self, vocabulary: str, *ways):
        self.table, self.ways = piece_table(vocabulary), ways
        self.place: dict[str, int] = {}
        self.met = np.zeros(0, np.int64)
        self.known = [Ragged(np.zeros(0, "<u4"), np.zeros(0, np.int64)) for _ in ways]

    def _learn(self, words: list[str]) -> None:
        new: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in self.ways]
        for length, at in by_length(words).items():
            step = 1 if length > _LONG_PATH else max(1, min(4096, 200_000 // length))
            for x in range(0, len(at), step):
                some = [words[i] for i in at[x : x + step]]
                self.place.update(zip(some, range(len(self.place), len(self.place) + len(some)), strict=True))
                lattice = _stack(self.table.lattice(codes(some, length)), len(some), length)
                for out, way in zip(new, self.ways, strict=True):
                    if way is merged and length > _LONG_MERGE:
                        each = [(lattice[:, i : i + 1], some[i : i + 1]) for i in range(len(some))]
                        out += [_ids(self.table, w, m, walked_merges(self.table, m)) for m, w in each]
                    elif length > _LONG_PATH:
                        out.append(_ids(self.table, some, lattice, walked_path(self.table, lattice)))
                    else:
                        out.append(_ids(self.table, some, lattice, way(self.table, lattice)))
        self.known = [k.joined(*zip(*out, strict=True)) for k, out in zip(self.known, new, strict=True)]
        self.met = np.append(self.met, np.zeros(len(self.place) - len(self.met), np.int64))

    def _forget(self) -> None:
        often = np.flatnonzero(self.met > 1)
        if len(often) > _MEMORY // 2:
            often = np.sort(often[np.argsort(-self.met[often], kind="stable")[: _MEMORY // 2]])
        words = list(self.place)
        self.place = {words[i]: k for k, i in enumerate(often.tolist())}
        self.met = self.met[often] // 2
        self.known = [Ragged(*k.take(often)) for k in self.known]

    def batch(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each way the ids of all texts, and where each text's ids end."""
        if len(self.place) > _MEMORY:
            self._forget()
        flat: list[str] = []
        ends = []
        for t in texts:
            if t:
                flat += _SEGMENT.findall("▁" + t.replace(" ", "▁"))
            ends.append(len(flat))
        unseen = set(flat).difference(self.place)
        if unseen:
            self._learn(sorted(unseen))
        at = np.fromiter(map(self.place.__getitem__, flat), np.int64, len(flat))
        self.met += np.bincount(at, minlength=len(self.met))
        out = []
        for known in self.known:
            ids, sizes = known.take(at)
            out.append((ids, np.concatenate([[0], np.cumsum(sizes)])[ends] if ends else np.zeros(0, np.int64)))
        return out


@lru_cache(maxsize=4)
def _encoder(vocabulary: str, *ways) -> PieceEncoder:
    return PieceEncoder(vocabulary, *ways)


class PieceDecoder:
    """The texts of ids: each piece's bytes with spaces for marks, read as UTF-8; the first space goes."""

    def __init__(self, vocabulary: str):
        table = piece_table(vocabulary)
        said = [x.replace("▁", " ").encode() for x in table.pieces]
        for y, i in table.bytes.items():
            said[i] = bytes([y])
        self.pieces = Ragged(np.frombuffer(b"".join(said), np.uint8), np.array(list(map(len, said))))

    def __call__(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """UTF-8 of each text, given the ids of all and where each text's ids end."""
        raw, sizes = self.pieces.take(ids.astype(np.int64))
        place, raw = np.concatenate([[0], np.cumsum(sizes)])[ends].tolist(), raw.tobytes()
        return [raw[a:b].removeprefix(b" ") for a, b in zip([0, *place], place, strict=False)]


def _together(texts: list[str]) -> Iterator[slice]:
    """Neighbouring texts of about ``_AT_ONCE`` characters."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > _AT_ONCE:
            yield slice(first, i)
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield slice(first, len(texts))


def _cut(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    raw, place = ids.tobytes(), (4 * ends).tolist()
    return [raw[a:b] for a, b in zip([0, *place], place, strict=False)]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: str = "piece_bpe_32k.model", path: bool = True) -> DataFrame:
    """Per row: doc_id and ids (binary, little-endian uint32) of the whole text.

    ``path=True``: the best path over the pieces' scores, by a Viterbi pass over
    all words of a length at once; the library's n-best search over the same
    pieces and scores puts the same path first. ``path=False``: by merges in order of
    score, which is what it gives for a merge model. There is no shuffle.

    Null and empty texts have no ids; a null id stays null; repeated rows get a
    row each; an empty table gives no rows; other columns are ignored. Long
    texts are encoded whole, also where a segment without a space is very long:
    its path takes time in proportion to its length, its merges n log n.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, best_paths if path else merged)
        for b in batches:
            texts = texts_of(b.column(1))
            for x in _together(texts):
                yield batch(_ENCODED, doc_id=b.column(0)[x.start : x.stop], ids=_cut(*encoder.batch(texts[x])[0]))

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", *, vocabulary: str = "piece_bpe_32k.model") -> DataFrame:
    """Per row: doc_id and the text of its ids. Null ids give empty text.

    A text comes back as it was, except that its own U+2581 marks, which the
    vocabulary keeps for spaces, come back as spaces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = PieceDecoder(vocabulary)
        for b in batches:
            raw = [x or b"" for x in b.column(1).to_pylist()]
            said = decoder(np.frombuffer(b"".join(raw), "<u4"), np.cumsum([len(x) // 4 for x in raw], dtype=np.int64))
            yield batch(_DECODED, doc_id=b.column(0), text=[x.decode("utf-8", "replace") for x in said])

    return encoded.select(encoded[id_col].cast("long").alias("id"), encoded[ids_col].alias("ids")).mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: str = "piece_bpe_32k.model") -> DataFrame:
    """Per row: doc_id, ids by best path and by merges, and whether each decodes to the text (its marks read as spaces); rows as in ``encode``."""
    schema = pa.schema([("doc_id", pa.int64()), ("path_ids", pa.binary()), ("merge_ids", pa.binary()), ("path_same", pa.bool_()), ("merge_same", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = PieceDecoder(vocabulary)
        encoder = _encoder(vocabulary, best_paths, merged)
        for b in batches:
            texts = texts_of(b.column(1))
            for x in _together(texts):
                want = [t.replace("▁", " ").encode() for t in texts[x]]
                one, two = encoder.batch(texts[x])
                same = [[s == t for s, t in zip(decoder(*way), want, strict=True)] for way in (one, two)]
                yield batch(schema, doc_id=b.column(0)[x.start : x.stop], path_ids=_cut(*one), merge_ids=_cut(*two), path_same=same[0], merge_same=same[1])

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")).mapInArrow(run, "doc_id long, path_ids binary, merge_ids binary, path_same boolean, merge_same boolean")
