"""E7: pairs of token sets that may be alike, against all pairs, and with a token that very many sets share."""

import itertools
import random

import pytest

from pitmark.operators.events import prefix_candidates


def candidates(spark, sets, jaccard=0.82, **options):
    rows = [(b, f"{i:05d}", sorted(t), len(t)) for i, (b, t) in enumerate(sets)]
    df = spark.createDataFrame(rows, "block string, set string, tokens array<string>, n int")
    return [(r.set, r.other) for r in prefix_candidates(df, ["block"], jaccard, **options).collect()]


def alike(sets, jaccard=0.82):
    found = set()
    for (i, (b, x)), (j, (c, y)) in itertools.combinations(enumerate(sets), 2):
        if b == c and len(x & y) >= jaccard * len(x | y):
            found.add((f"{i:05d}", f"{j:05d}"))
    return found


@pytest.mark.parametrize("options", [{}, {"group": 2}, {"group": 2, "depth": 2}, {"group": 1, "depth": 6}])
@pytest.mark.parametrize("jaccard", [0.82, 0.6])
def test_no_alike_pair_is_missing(spark, options, jaccard):
    rng = random.Random(3)
    sets = []
    for _ in range(40):
        base = {f"w{rng.randrange(60)}" for _ in range(rng.randint(3, 25))}
        for _ in range(rng.randint(1, 4)):
            copy = set(base)
            for _ in range(rng.randint(0, 3)):
                copy.discard(rng.choice(sorted(copy)))
                copy.add(f"w{rng.randrange(60)}")
            sets.append((rng.choice("ab"), copy | {"the"}))
    got = candidates(spark, sets, jaccard, **options)
    assert len(got) == len(set(got)) and alike(sets, jaccard) <= set(got)


def test_a_hot_token_ties_no_crowd(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    # all share a token that is in every prefix, as their other tokens are commoner or as common
    sets = [("a", {"!hot", *rng.sample(words, 11)}) for _ in range(3_000)]
    for k in range(0, 600, 2):
        x = sorted(sets[k][1] - {"!hot"})
        sets[k + 1] = ("a", {"!hot", *x[:-1], words[rng.randrange(400)]})
    want = alike(sets)
    got = candidates(spark, sets)
    assert want <= set(got) and len(want) > 200 and len(got) <= 10 * len(want)
