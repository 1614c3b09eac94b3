"""Language identification by unigram pieces, summed over all segmentations."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pitmark.llm.common import annotate, batch, hashed, share_for, texts_of, unused
from pitmark.llm.pieces import PieceTable, by_length, codes, piece_table

#: Up to this many characters the products of probabilities stay within a double; sums over longer words are scaled on the way.
_SHORT = 40
#: Places between two scalings, and characters of long words worked on together.
_RESCALE, _LONG_CHARS = 8, 200_000
#: Probability of a character that is no piece.
_STRANGE = 1e-7
#: Words remembered by a Python worker; fewer if there are more than _AT_ONCE languages.
_MEMORY = 250_000
#: Languages whose sums are held at once.
_AT_ONCE = 8
_FOUND = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def _marked(words: list[str]) -> list[str]:
    return ["▁" + w for w in words]


def _groups(words: list[str], at_once: int) -> Iterator[list[int]]:
    """Places of words that are worked on together: short ones of one length, long ones of lengths close by."""
    places = by_length(words)
    for length in sorted(places):
        if length <= _SHORT:
            yield from (places[length][x : x + at_once] for x in range(0, len(places[length]), at_once))
    some: list[int] = []
    for length in sorted(x for x in places if x > _SHORT):
        for i in places[length]:
            if some and (length > 1.25 * len(words[some[0]]) or (len(some) + 1) * length > _LONG_CHARS):
                yield some
                some = []
            some.append(i)
    if some:
        yield some


def _lattice(table: PieceTable, words: list[str]) -> list[np.ndarray]:
    """The lattice of a group; shorter words are filled up with a character that no piece has."""
    width = max(map(len, words))
    return table.lattice(codes([w.ljust(width, "\0") for w in words], width))


def _probabilities(model: np.ndarray, lattice: list[np.ndarray]) -> list[np.ndarray]:
    """(word, start, language) for each length; a lone character that is no piece has a floor."""
    out = [model[x] for x in lattice]
    out[0] = np.where(lattice[0][:, :, None] < 0, _STRANGE, out[0])
    return out


def _forward(steps: list[np.ndarray]) -> np.ndarray:
    """(word, place, language) -> probability of all segmentations up to the place."""
    words, length, languages = steps[0].shape
    a = np.zeros((length + 1, words, languages))
    a[0] = 1
    for j in range(1, length + 1):
        for k in range(min(j, len(steps))):
            a[j] += a[j - k - 1] * steps[k][:, j - k - 1]
    return a


def _backward(steps: list[np.ndarray]) -> np.ndarray:
    words, length, languages = steps[0].shape
    b = np.zeros((length + 1, words, languages))
    b[length] = 1
    for i in range(length - 1, -1, -1):
        for k in range(min(length - i, len(steps))):
            b[i] += b[i + k + 1] * steps[k][:, i]
    return b


def _step(model: np.ndarray, lattice: list[np.ndarray], k: int, start: int) -> np.ndarray:
    """(word, language) of the pieces of k + 1 characters from a place on."""
    found = lattice[k][:, start]
    return np.where(found[:, None] < 0, _STRANGE, model[found]) if k == 0 else model[found]


def _scaled_forward(model: np.ndarray, lattice: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``_forward`` for words of any length: (values, logarithms); what it means is value * exp(logarithm)."""
    words, length = lattice[0].shape
    a, log = np.zeros((2, length + 1, words, model.shape[1]))
    a[0] = 1
    for j in range(1, length + 1):
        for k in range(min(j, len(lattice))):
            a[j] += a[j - k - 1] * _step(model, lattice, k, j - k - 1)
        log[j] = log[j - 1]
        if j % _RESCALE == 0:
            lo, m = max(0, j - len(lattice) + 1), a[j].copy()
            a[lo : j + 1] /= m
            log[lo : j + 1] += np.log(m)
    return a, log


def _scaled_backward(model: np.ndarray, lattice: list[np.ndarray], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same from each word's own end backwards."""
    words, length = lattice[0].shape
    b, log = np.zeros((2, length + 1, words, model.shape[1]))
    b[length, lengths == length] = 1
    for i in range(length - 1, -1, -1):
        for k in range(min(length - i, len(lattice))):
            b[i] += b[i + k + 1] * _step(model, lattice, k, i)
        log[i] = log[i + 1]
        b[i, lengths == i] = 1
        if i % _RESCALE == 0:
            hi, m = min(length, i + len(lattice) - 1), np.where(b[i] > 0, b[i], 1)
            b[i : hi + 1] /= m
            log[i : hi + 1] += np.log(m)
    return b, log


def log_sums(model: np.ndarray, table: PieceTable, words: list[str]) -> np.ndarray:
    """(word, language) -> log of the sum over all segmentations, for one group of ``_groups``."""
    lattice, lengths = _lattice(table, words), np.array(list(map(len, words)))
    if lengths.max() <= _SHORT:
        return np.log(_forward(_probabilities(model, lattice))[-1])
    a, log = _scaled_forward(model, lattice)
    row = np.arange(len(words))
    return np.log(a[lengths, row]) + log[lengths, row]


def _expected(model: np.ndarray, lattice: list[np.ndarray], lengths: np.ndarray) -> Iterator[np.ndarray]:
    """For each piece length (start, word, language) -> share of the word's segmentations that use the piece there."""
    if lengths.max() <= _SHORT:
        steps = _probabilities(model, lattice)
        a, b = _forward(steps), _backward(steps)
        for k, found in enumerate(lattice):
            m = found.shape[1]
            yield a[:m] * steps[k].transpose(1, 0, 2) * b[k + 1 : k + 1 + m] / a[-1]
        return
    (a, log_a), (b, log_b) = _scaled_forward(model, lattice), _scaled_backward(model, lattice, lengths)
    row = np.arange(len(lengths))
    total = np.log(a[lengths, row]) + log_a[lengths, row]
    for k, found in enumerate(lattice):
        m = found.shape[1]
        step = np.stack([_step(model, lattice, k, i) for i in range(m)])
        real = b[k + 1 : k + 1 + m] > 0
        yield np.where(real, a[:m] * step * b[k + 1 : k + 1 + m] * np.exp(np.where(real, log_a[:m] + log_b[k + 1 : k + 1 + m] - total, 0)), 0)


def fit_pieces(counts: list[Counter], table: PieceTable, rounds: int = 3, smooth: float = 0.1) -> np.ndarray:
    """Piece probabilities (piece + an empty last row, language) by expectation maximisation.

    A round takes the expected number of times each piece is used, over all
    segmentations of the counted words, and divides by their sum; ``smooth``
    is added to every piece. Languages don't touch each other and are fitted a few at a time.
    """
    if len(counts) > _AT_ONCE:
        return np.concatenate([fit_pieces(counts[x : x + _AT_ONCE], table, rounds, smooth) for x in range(0, len(counts), _AT_ONCE)], axis=1)
    n = len(counts)
    words = sorted(set().union(*counts))
    weight, marked = np.array([[c.get(w, 0) for c in counts] for w in words], float), _marked(words)
    groups = [(_lattice(table, [marked[i] for i in some]), np.array([len(marked[i]) for i in some]), weight[some]) for some in _groups(marked, 4096)]
    model = np.full((table.size + 1, n), 1 / table.size)
    model[-1] = 0
    for _ in range(rounds):
        used = np.full((table.size + 1, n), smooth)
        for lattice, lengths, w in groups:
            for found, share in zip(lattice, _expected(model, lattice, lengths), strict=True):
                flat, expected = np.where(found < 0, table.size, found).T.ravel(), share * w
                for x in range(n):
                    used[:, x] += np.bincount(flat, expected[:, :, x].ravel(), table.size + 1)
        used[-1] = 0
        model = used / used.sum(0)
    return model


class _Scorer:
    """log P(word | language), computed once for each word while it is remembered."""

    def __init__(self, model: np.ndarray, vocabulary: str):
        self.model, self.table = model, piece_table(vocabulary)
        self.place: dict[str, int] = {}
        self.logs = np.zeros((0, model.shape[1]))

    def _learn(self, words: list[str]) -> None:
        new, marked = np.zeros((len(words), self.model.shape[1])), _marked(words)
        for some in _groups(marked, 2048):
            for k in range(0, new.shape[1], _AT_ONCE):
                new[some, k : k + _AT_ONCE] = log_sums(self.model[:, k : k + _AT_ONCE], self.table, [marked[i] for i in some])
        new[[i for i, w in enumerate(words) if not any(map(str.isalpha, w))]] = 0
        self.place.update(zip(words, range(len(self.logs), len(self.logs) + len(words)), strict=True))
        self.logs = np.concatenate([self.logs, new])

    def totals(self, texts: list[str]) -> np.ndarray:
        """(text, language) -> log probability; a row of zeros if no word has a letter."""
        most = _MEMORY * _AT_ONCE // max(_AT_ONCE, self.model.shape[1])
        if most < _MEMORY and len(texts) > 1 and sum(map(str.count, texts, [" "] * len(texts))) > most:
            half = len(texts) // 2
            return np.concatenate([self.totals(texts[:half]), self.totals(texts[half:])])
        if len(self.place) > most:
            self.place.clear()
            self.logs = self.logs[:0]
        flat: list[str] = []
        ends = []
        for t in texts:
            flat += t.split()
            ends.append(len(flat))
        got = list(map(self.place.get, flat))
        if None in got:
            gaps = [i for i, x in enumerate(got) if x is None]
            self._learn(sorted({flat[i] for i in gaps}))
            for i in gaps:
                got[i] = self.place[flat[i]]
        at = np.array(got, np.int64)
        return np.stack([self.logs[at[a:b]].sum(0) for a, b in zip([0, *ends], ends, strict=False)]) if texts else self.logs[:0]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *, where=None, per_language: int = 500, languages: int = 64, vocabulary: str = "piece_bpe_32k.model", rounds: int = 3) -> tuple[list[str], np.ndarray]:
    """The languages learned, in order, and their piece probabilities.

    Bounded sample: of each language the ``per_language`` documents with the
    smallest hash of their id (repeated ids count once each); if there are more
    than ``languages`` languages, fewer of each, so that the sample is no larger
    than theirs would be, but one at least. Every language is learned. Their
    word counts alone reach the driver. Rows with a null id, language or text
    teach nothing.
    """
    docs = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    docs = docs.where("id is not null and lang is not null and text is not null")
    if where is not None:
        docs = docs.where(where)
    sizes = dict(docs.groupBy("lang").agg(F.count("*").alias("n")).collect())
    names = sorted(sizes)
    if not names:
        return [], np.zeros((0, 0))
    each = max(1, min(per_language, per_language * languages // len(names)))
    # ids that can't be among the smallest stay behind, or one language's would all meet in a task
    bounds = docs.sparkSession.createDataFrame([(x, share_for(each, n)) for x, n in sizes.items()], "lang string, bound long")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(hashed("id"), "id"))
    chosen = docs.select("lang", "id").join(F.broadcast(bounds), "lang").where(hashed("id") < F.col("bound")).select("lang", "id").withColumn("rank", rank).where(F.col("rank") <= each).select("lang", "id").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), texts_of(b.column(1)), strict=True):
                seen.setdefault(lang, Counter()).update(w for w in text.split() if any(map(str.isalpha, w)))
        rows = [(lang, w, n) for lang, c in seen.items() for w, n in c.items()]
        for x in range(0, len(rows), 50_000):
            a, b, c = zip(*rows[x : x + 50_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c)], names=["lang", "word", "n"])

    # at most per_language * languages ids of two small columns, or one of each language: a size with a bound
    sample = docs.join(F.broadcast(chosen), ["lang", "id"]).select("lang", "text")
    counts = {x: Counter() for x in names}
    for lang, word, n in sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n")).collect():
        counts[lang][word] = n
    names = [x for x in names if counts[x]]
    return names, fit_pieces([counts[x] for x in names], piece_table(vocabulary), rounds) if names else np.zeros((0, 0))


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text", *, held_out=None, vocabulary: str = "piece_bpe_32k.model") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score.

    A text's probability in a language is the product over its words of the sum
    over all their segmentations; score is the share of the best language.
    Ties go to the language first in order. Null text, text without a letter,
    and any text where nothing was learned get ``und`` with score 0. Whole texts
    are read and words of any length are summed whole; a null id stays null; repeated rows get a row each; an empty table
    gives no rows; other columns are ignored.
    """
    predict = predictor(docs, model, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = predict()
        for b in batches:
            langs, score = made(texts_of(b.column(2)))
            yield batch(_FOUND, doc_id=b.column(0), held_out=b.column(1), lang_pred=langs, score=score)

    held = F.lit(False) if held_out is None else held_out
    return docs.select(docs[id_col].cast("long").alias("id"), held.alias("held"), docs[text_col].alias("text")).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def predictor(docs: DataFrame, model: tuple[list[str], np.ndarray], vocabulary: str = "piece_bpe_32k.model"):
    """A factory of functions from texts to (languages, scores), for tasks."""
    names, weights = model
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def factory():
        scorer = _Scorer(shared.value, vocabulary) if names else None

        def predict(texts: list[str]) -> tuple[list[str], np.ndarray]:
            if not scorer or not texts:
                return ["und"] * len(texts), np.zeros(len(texts))
            total = scorer.totals(texts)
            known = total.any(1)
            score = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
            return [names[i] if k else "und" for i, k in zip(total.argmax(1), known, strict=True)], np.where(known, score, 0.0)

        return predict

    return factory


def keep_identified(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", *, least: float = 0.5, vocabulary: str = "piece_bpe_32k.model") -> DataFrame:
    """The rows of ``docs`` whose language is found with a score of at least ``least``; columns stay as they are."""
    language, score = unused(docs, "language", "score")
    found = annotate(docs, text_col, predictor(docs, model, vocabulary), [T.StructField(language, T.StringType()), T.StructField(score, T.DoubleType())])
    return found.where((F.col(language) != "und") & (F.col(score) >= least)).select(*docs.columns)
