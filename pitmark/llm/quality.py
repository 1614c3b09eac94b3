"""Quality classifier by positive-unlabelled learning with non-negative risk."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitmark.llm.common import annotate, batch, hashed, share_for, smallest, texts_of, unused

#: Buckets of word shapes, and counts about the whole text.
SHAPES, STATS = 256, 10
_MEMORY = 250_000
_FEATURES = pa.schema([("positive", pa.bool_()), ("x", pa.list_(pa.float32()))])
_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])
_RUNS = re.compile(r"(.)\1+", re.S)
_CLASSES = str.maketrans({**dict.fromkeys("abcdefghijklmnopqrstuvwxyz", "a"), **dict.fromkeys("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A"), **dict.fromkeys("0123456789", "0")})


def _shape(word: str) -> str:
    """Letters, digits and case as classes, runs squeezed: ``Ab12***`` is ``Aa0*``."""
    s = word.translate(_CLASSES)
    if not s.isascii():
        s = "".join("a" if c.islower() else "A" if c.isupper() else c if c.isascii() else "é" if c.isalpha() else "°" for c in s)
    return _RUNS.sub(r"\1", s)


class Features:
    """Texts as rows of numbers; what a word contributes is worked out once while it is remembered."""

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.known = np.zeros((0, 3), np.int32)  # shape bucket, length, marks

    def _learn(self, words: list[str]) -> None:
        new = np.array([[xxhash.xxh3_64_intdigest(_shape(w)) % SHAPES, len(w), sum(not c.isalnum() for c in w)] for w in words], np.int32)
        self.place.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.known = np.concatenate([self.known, new])

    def __call__(self, texts: list[str]) -> np.ndarray:
        if len(self.place) > _MEMORY:
            self.place.clear()
            self.known = self.known[:0]
        flat: list[str] = []
        ends, lines, fresh = [], [], []
        for t in texts:
            flat += t.split()
            ends.append(len(flat))
            rows = t.splitlines()
            lines.append(len(rows))
            fresh.append(len(set(rows)))
        got = list(map(self.place.get, flat))
        if None in got:
            gaps = [i for i, x in enumerate(got) if x is None]
            self._learn(sorted({flat[i] for i in gaps}))
            for i in gaps:
                got[i] = self.place[flat[i]]
        at, n = np.array(got, np.int64), len(texts)
        stops = np.array(ends, np.int64)
        sizes = np.diff(stops, prepend=0)
        doc = np.repeat(np.arange(n), sizes)
        shape, length, marks = self.known[at].T if len(at) else np.zeros((3, 0), np.int32)
        total = np.maximum(sizes, 1)[:, None]
        by_shape = np.sqrt(np.bincount(doc * SHAPES + shape, minlength=n * SHAPES).reshape(n, SHAPES) / total)
        key = np.sort(doc << 32 | at)
        first = np.diff(key, prepend=-1) != 0
        different = np.bincount((key[first] >> 32).astype(np.int64), minlength=n)
        counts = np.diff(np.append(np.flatnonzero(first), len(key)))
        most = np.zeros(n)
        np.maximum.at(most, (key[first] >> 32).astype(np.int64), counts)
        again = np.zeros(len(at))
        if len(at) > 1:
            again[1:] = (at[1:] == at[:-1]) & (doc[1:] == doc[:-1])
        per = lambda w: np.bincount(doc, w, n) / total[:, 0]
        lines_, fresh_ = np.maximum(lines, 1), np.array(fresh)
        stats = np.stack([np.log1p(sizes), different / total[:, 0], np.log1p(different) - np.log1p(sizes), most / total[:, 0], per(again), per(length.astype(float)), per(marks.astype(float)), per((marks * 2 >= length).astype(float)), fresh_ / lines_, np.log(total[:, 0] / lines_)], 1)
        return np.concatenate([by_shape, stats], 1).astype(np.float32)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float, *, rounds: int = 1500, size: int = 1024, rate: float = 0.01, decay: float = 1e-4, seed: int = 3) -> Model:
    """Minimise the non-negative unbiased risk of a linear model with logistic loss.

    Risk: prior * E+[loss(g)] + max(0, Eu[loss(-g)] - prior * E+[loss(-g)]).
    Where a batch's second part falls below zero, the step goes up that part
    instead, so that the model can't earn by overfitting the positives.
    """
    rng = np.random.default_rng(seed)
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -6, 6) for x in (positive, unlabelled))
    w, b = np.zeros(p.shape[1]), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for k in range(1, rounds + 1):
        x, y = p[rng.integers(0, len(p), size)], u[rng.integers(0, len(u), size)]
        zx, zy = x @ w + b, y @ w + b
        negative = np.logaddexp(0, zy).mean() - prior * np.logaddexp(0, zx).mean()
        gx, gy = -prior * sigmoid(zx) / size, sigmoid(zy) / size
        if negative >= 0:
            gx = gx - prior * sigmoid(-zx) / size
        else:
            gx, gy = -gx, -gy
        g = np.append(x.T @ gx + y.T @ gy + decay * w, gx.sum() + gy.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Model(mean, scale, w, b, prior)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", *, where=None, positives: int = 4000, unlabelled: int = 6000) -> Model:
    """Train on trusted positives and unlabelled text.

    Bounded sample: the ``positives`` ids labelled 1 and the ``unlabelled`` ids
    of any documents with the smallest hashes, each id once; an id with
    contradicting labels counts as labelled 0. The class prior is the share of
    1 among all labelled rows, as labels are drawn from the same text, kept
    within 0.02 and 0.98. Labels of 0 serve for the prior alone. Null ids,
    labels and texts are left out. Without positives or text every score is
    the prior (0.5 if nothing is labelled).
    """
    labels = labels.select(labels[id_col].cast("long").alias("id"), labels[label_col].alias("y")).where("id is not null and y in (0, 1)")
    docs = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")).where("id is not null and text is not null")
    if where is not None:
        labels, docs = labels.where(where), docs.where(where)
    marked = labels.groupBy("id").agg(F.min("y").alias("y"))
    share, plus_rows, rows = *marked.agg(F.avg("y"), F.sum("y")).first(), docs.count()
    prior = 0.5 if share is None else min(0.98, max(0.02, share))
    plus = smallest(marked.where("y = 1").select("id"), "id", positives, plus_rows or 0, 11)
    any_ = smallest(docs.where(hashed("id", 11) < share_for(unlabelled, rows)).select("id").distinct(), "id", unlabelled, 0, 11)
    # two bounded lists of ids
    chosen = plus.withColumn("positive", F.lit(True)).unionByName(any_.withColumn("positive", F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for b in batches:
            yield batch(_FEATURES, positive=b.column(0), x=list(features(texts_of(b.column(1)))))

    rows = docs.join(F.broadcast(chosen), "id").select("positive", "text").mapInArrow(run, "positive boolean, x array<float>").toArrow()
    x = np.asarray(rows["x"].combine_chunks().flatten() if rows.num_rows else [], np.float32).reshape(-1, SHAPES + STATS)
    flag = np.array(rows["positive"].to_pylist(), bool)
    order = np.lexsort([*x[:, -STATS:].T, flag])  # the rows arrive in any order
    x, flag = x[order], flag[order]
    if not flag.any() or flag.all():
        width = SHAPES + STATS
        return Model(np.zeros(width), np.ones(width), np.zeros(width), float(np.log(prior / (1 - prior))), prior)
    return fit_risk(x[flag], x[~flag], prior)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", *, held_out=None, threshold: float = 0.3) -> DataFrame:
    """Per row: doc_id, held_out, score of the whole text, predicted (score >= threshold).

    Null text is scored as empty text; a null id stays null; repeated rows get
    a row each; an empty table gives no rows; other columns are ignored.
    """
    scorer = scores(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = scorer()
        for b in batches:
            yield batch(_SCORED, doc_id=b.column(0), held_out=b.column(1), score=made(texts_of(b.column(2)))[0])

    held = F.lit(False) if held_out is None else held_out
    found = docs.select(docs[id_col].cast("long").alias("id"), held.alias("held"), docs[text_col].alias("text")).mapInArrow(run, "doc_id long, held_out boolean, score double")
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def scores(docs: DataFrame, model: Model):
    """A factory of functions from texts to (scores,), for tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def factory():
        features = Features()
        return lambda texts: (np.concatenate([np.zeros(0), *[shared.value.score(features(texts[x : x + 256])) for x in range(0, len(texts), 256)]]),)

    return factory


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", *, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more; columns stay as they are."""
    (score,) = unused(docs, "score")
    found = annotate(docs, text_col, scores(docs, model), [T.StructField(score, T.DoubleType())])
    return found.where(F.col(score) >= threshold).select(*docs.columns)
