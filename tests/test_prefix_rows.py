"""E7: sets that share nearly all their tokens are not written once for each combination of these."""

import random

from pitmark.operators import events


def test_a_crowd_of_variants_stays_small_on_disk(spark, monkeypatch):
    written = {}

    def counted(df, name, whole=events.materialise):
        out = whole(df, name)
        written[name] = written.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(events, "materialise", counted)
    rng = random.Random(5)
    base = [f"w{k:03d}" for k in range(60)]
    sets = [sorted({*rng.sample(base, 57), f"x{i}"}) for i in range(80)]
    df = spark.createDataFrame([("a", f"{i:03d}", t, len(t)) for i, t in enumerate(sets)], "block string, set string, tokens array<string>, n int")
    got = {(r.set, r.other) for r in events.prefix_candidates(df, ["block"], 0.82).collect()}
    want = {(f"{i:03d}", f"{j:03d}") for i in range(80) for j in range(i + 1, 80) if len({*sets[i]} & {*sets[j]}) >= 0.82 * len({*sets[i]} | {*sets[j]})}
    assert len(want) > 2_000 and want <= got
    # each set has 11 places for one token; further places of the crowd's keys would be 45 a set for two tokens, 120 for three
    assert written.get("prefixes", 0) <= 80 * 60
