"""op11: runs against a plain loop over periods, planted texts, odd rows."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from pitmark.llm.periodic_runs import collapse, find_runs, periodic_runs
from pitmark.llm.queries import QUERIES, planted_period

SF = "/root/testdata/sf0.001"


def plain(words, length=6, times=4):
    """Each period alone: stretches of words that equal the word one period before; the smallest period of a stretch counts."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(length, times * q):
                found.setdefault((start, i - start + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def search(texts, *a):
    ids = np.array([x for w in texts for x in w], np.int64)
    return find_runs(ids, np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64), *a)


def test_random_texts_equal_the_plain_loop():
    rng, seen = random.Random(7), 0
    for _ in range(700):
        texts = []
        for _ in range(rng.randint(1, 5)):
            n, letters = rng.choice([0, 1, 5, 7, 20, 60, 120]), rng.choice([1, 2, 3, 10])
            w = [rng.randint(0, letters) for _ in range(n)]
            if n and rng.random() < 0.7:
                s = rng.randrange(n)
                p = rng.randint(1, max(1, (n - s) // 4))
                w[s:] = [w[s + k % p] for k in range(n - s)]
                if rng.random() < 0.4:
                    w[rng.randrange(n)] = 99
            texts.append(w)
        for bounds in ((6, 4), (1, 4), (9, 5)):
            want = [plain(w, *bounds) for w in texts]
            assert search(texts, *bounds) == want
            seen += sum(map(len, want))
    assert seen > 1000


@pytest.mark.parametrize(("words", "want"), [
    ("a a a a a", []), ("a a a a a a", [(0, 6, 1)]), ("a b a b a b a", []), ("x a b a b a b a b", [(1, 8, 2)]),
    ("a b a b a b a b a c", [(0, 9, 2)]), ("a a b a a b a a b a a b", [(0, 12, 3)]), ("a a a a a a b b b b b b", [(0, 6, 1), (6, 6, 1)]),
])
def test_literal_runs(words, want):
    ids = [ord(w) for w in words.split()]
    assert search([ids]) == [want]
    assert search([ids, ids, []]) == [want, want, []]


def test_hot_words_and_many_short_runs_take_linear_time():
    assert search([[0] * 100_000]) == [[(0, 100_000, 1)]]
    many = [x for k in range(5_000) for x in (0, 1) * 4 + (k + 2,)]
    assert len(search([many])[0]) == 5_000


def test_fewer_than_four_periods_are_refused():
    with pytest.raises(ValueError):
        search([[1]], 6, 3)


def test_odd_rows(spark):
    rows = [(1, None, 9), (None, "", 9), (2, " \t\n ", 9), (3, "a a a a a a b", 9), (3, "a a a a a a b", 9), (4, "é x " * 6, 9), (5, "w" * 100_000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(docs).collect()), key=str)
    want = [(1, 0, [], ""), (None, 0, [], ""), (2, 0, [], ""), (3, 7, [(0, 6, 1)], "a b"), (3, 7, [(0, 6, 1)], "a b"), (4, 6, [(0, 6, 1)], "é x"), (5, 1, [], "w" * 100_000)]
    assert got == sorted(want, key=str)
    assert periodic_runs(docs.where("false")).collect() == []


def test_the_registered_query_equals_the_plain_loop(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op11_periodic_runs"](spark, SF).collect()
    assert len(got) == len(texts)
    planted = 0
    for r in got:
        words = texts[r.doc_id].encode().split()
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            assert planted_period(r.doc_id, n) is not None
        if n > 1500:
            continue
        runs = plain(words)
        planted += bool(runs)
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        assert (r.n_runs, r.n_words) == (len(runs), n)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()
        assert collapse(words, runs) == b" ".join(w for i, w in enumerate(words) if i not in gone)
    assert planted >= 5
