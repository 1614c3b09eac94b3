"""The registered queries themselves on the smallest tables: contract columns, folds, SQL twins, and plain loops."""

import re
import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pitmark.llm import quality
from pitmark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def rows_of(spark, name, sf=SF):
    return QUERIES[name](spark, sf).collect()


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twins(spark, name):
    duck = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        duck.execute(f"create view {p.stem} as select * from '{p}'")
    result = duck.execute(ORACLES[name])
    columns = sorted(d[0] for d in result.description)
    place = [[d[0] for d in result.description].index(c) for c in columns]
    want = sorted(tuple(r[i] for i in place) for r in result.fetchall())
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == columns
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == want


def test_op1_scores_and_fold(spark):
    sf = "/root/testdata/sf0.01"
    got = rows_of(spark, "op1_quality", sf)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.3) for r in got)
    held = [(r.score, labels[r.doc_id], r.predicted) for r in got if r.held_out and labels.get(r.doc_id) is not None]
    good, bad = [s for s, y, _ in held if y], [s for s, y, _ in held if not y]
    assert sum(p == y for _, y, p in held) >= 0.95 * len(held)
    assert np.mean([[a > b for b in bad] for a in good]) >= 0.98


def test_op1_risk_against_a_plain_loop():
    """Whole-sample descent by the same rule, upwards where the second part is negative, decides as the model does."""
    rng = np.random.default_rng(0)
    p, u = rng.normal(1, 1, (400, 3)), np.concatenate([rng.normal(1, 1, (300, 3)), rng.normal(-1, 1, (300, 3))])
    prior = 0.5
    model = quality.fit_risk(p, u, prior)
    s = lambda z: 1 / (1 + np.exp(-z))

    def parts(w, b):
        zp, zu = p @ w + b, u @ w + b
        return prior * np.logaddexp(0, -zp).mean(), np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()

    w, b, trail = np.zeros(3), 0.0, []
    for _ in range(3000):
        zp, zu = p @ w + b, u @ w + b
        if parts(w, b)[1] >= 0:
            gp, gu = -prior * s(-zp) / len(p) - prior * s(zp) / len(p), s(zu) / len(u)
        else:
            gp, gu = prior * s(zp) / len(p), -s(zu) / len(u)
        w, b = w - 0.1 * (p.T @ gp + u.T @ gu), b - 0.1 * (gp.sum() + gu.sum())
        trail.append(sum(max(0.0, x) for x in parts(w, b)))
    mine, mine_b = model.weights / model.scale, model.bias - (model.mean / model.scale) @ model.weights
    assert np.mean((u @ mine + mine_b > 0) == (u @ w + b > 0)) >= 0.97
    assert abs(sum(max(0.0, x) for x in parts(mine, mine_b)) - np.mean(trail[-500:])) < 0.08


def test_op1_risk_never_pays_for_negative_parts():
    """Where all unlabelled text is positive the second part falls below zero; the model must not drive it on and on."""
    rng = np.random.default_rng(1)
    p = rng.normal(0, 1, (50, 20))
    model = quality.fit_risk(p, p[:40] + 1e-3, 0.9, rounds=3000)
    z = ((p - model.mean) / model.scale).clip(-6, 6) @ model.weights + model.bias
    part = np.logaddexp(0, z[:40]).mean() - 0.9 * np.logaddexp(0, z).mean()
    assert part > -0.2


def test_op1_features_against_a_plain_loop():
    texts = ["Ab12*** ab ab\nab ab\n", "", "one", "É x É x %% %%\n%% %%"]
    got = quality.Features()(texts)
    for t, row in zip(texts, got, strict=True):
        words, lines = t.split(), t.splitlines()
        n, different = len(words), len(set(words))
        shapes = np.zeros(quality.SHAPES)
        for w in words:
            shapes[quality.xxhash.xxh3_64_intdigest(quality._shape(w)) % quality.SHAPES] += 1
        assert np.allclose(row[: quality.SHAPES], np.sqrt(shapes / max(n, 1)))
        marks = [sum(not c.isalnum() for c in w) for w in words]
        want = [
            np.log1p(n), different / max(n, 1), np.log1p(different) - np.log1p(n), max((words.count(w) for w in words), default=0) / max(n, 1), sum(a == b for a, b in zip(words, words[1:], strict=False)) / max(n, 1),
            sum(map(len, words)) / max(n, 1), sum(marks) / max(n, 1), sum(2 * m >= len(w) for m, w in zip(marks, words, strict=True)) / max(n, 1), len(set(lines)) / max(len(lines), 1), np.log(max(n, 1) / max(len(lines), 1)),
        ]
        assert np.allclose(row[quality.SHAPES :], want, atol=1e-6)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_op2_recall_on_the_given_vectors(spark, sf):
    got = defaultdict(list)
    for r in rows_of(spark, "op2_nearest", sf):
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    v = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect() if r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding) and any(r.embedding)}
    ids = np.array(sorted(v))
    x = np.stack([v[i] for i in ids])
    norms = np.sqrt((x * x).sum(1))
    hits = total = 0
    asked = [i for i in ids if i % 50 == 0]
    assert sorted(got) == asked
    for q in asked:
        s = x @ v[q] / (norms * np.sqrt(v[q] @ v[q]))
        s[ids == q] = -np.inf
        best = sorted(zip(-s, ids, strict=True))[:5]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == [1, 2, 3, 4, 5] and all(abs(c - s[np.searchsorted(ids, i)]) < 1e-12 for _, i, c in mine)
        assert [c for _, _, c in mine] == sorted((c for _, _, c in mine), reverse=True)
        hits += len({i for _, i, _ in mine} & {i for _, i in best})
        total += 5
    assert hits >= 0.95 * total


def test_op4_languages_and_fold(spark, texts):
    got = rows_of(spark, "op4_language_id")
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in got) == sorted(texts)
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in got)
    assert all((r.lang_pred == "und") == (not any(map(str.isalpha, texts[r.doc_id]))) for r in got)
    held = [r for r in got if r.held_out and r.lang_pred != "und" and lang[r.doc_id] is not None]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_op6_ids_are_the_librarys(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in rows_of(spark, "op6_sentence_pieces")}
    assert sorted(got) == sorted(texts) and all(r.path_same and r.merge_same for r in got.values())
    for i, t in texts.items():
        ids = np.array(library.encode(t), "<u4")
        assert (got[i].merge_pieces, got[i].merge_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_op8_pieces(spark, texts, whole):
    by_doc, windows = defaultdict(list), defaultdict(list)
    for r in rows_of(spark, "op8_packing"):
        by_doc[r.doc_id].append(r)
        windows[r.sequence_id].append((r.offset, r.length))
    assert sorted(by_doc) == sorted(texts)
    for i, t in texts.items():
        ids = np.array([*whole.encode(t, add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0 and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(n for w in windows.values() for _, n in w) >= 0.9 * 1024 * len(windows)


def test_op9_counts(spark, texts, whole):
    pattern = re.compile("[0-9]{4,}|[%&$#*|]+")
    count = lambda t: len(whole.encode(t, add_special_tokens=False).ids)
    for r in rows_of(spark, "op9_token_counts"):
        t = texts[r.doc_id]
        after = pattern.sub("", t)
        assert (r.n_tokens, r.n_edits, r.n_tokens_after, r.n_chars_after) == (count(t), len(pattern.findall(t)), count(after), len(after))


def test_op3_keeps_every_page(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r for r in rows_of(spark, "op3_html_text")}
    assert sorted(got) == sorted(p.page_id for p in pages)
    assert all(r.n_lines == (r.text.count("\n") + 1 if r.text else 0) for r in got.values())
