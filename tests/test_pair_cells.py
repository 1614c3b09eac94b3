"""E7: pairs are compared in cells of two tiles, as brute force compares them; a text goes to a cell once, not once for each pair."""

import random

from pitmark.operators import events as E


def _variants(n: int) -> list[list[str]]:
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    base = [word() for _ in range(100)]
    return [sorted({*base[k % 8 :], *[word() for _ in range(k % 13)], f"own{k:03d}"}) for k in range(n)]


def test_cells_find_what_brute_force_finds(spark, monkeypatch):
    monkeypatch.setattr(E, "_TILE", 4)
    sets = _variants(40)
    rows = spark.createDataFrame([(i, 1, len(t), " ".join(t)) for i, t in enumerate(sets)], "row long, b long, n int, words string")
    pairs = [(i, j) for i in range(40) for j in range(i + 1, 40)]
    got = E._alike(spark.createDataFrame(pairs, "row long, other long"), rows.select("row", "b", "n"), rows.select("row", "words"), 0.9, 0.82)
    both = lambda i, j: len({*sets[i]} & {*sets[j]})
    want = [(i, j) for i, j in pairs if both(i, j) >= 0.9 * min(len(sets[i]), len(sets[j])) and both(i, j) >= 0.82 * len({*sets[i]} | {*sets[j]})]
    assert 50 < len(want) < len(pairs) - 50
    assert sorted((r.row, r.other) for r in got.collect()) == want
