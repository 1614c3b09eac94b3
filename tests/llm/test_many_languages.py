"""More languages than a sample of full size has room for."""

import random

import numpy as np

from pitmark.llm import language_id


def test_every_language_is_learned(spark):
    rng = random.Random(4)
    rows = []
    for x in range(70):
        words = ["".join(rng.choice("abcdefghijklmnoprstuvz") for _ in range(6)) for _ in range(12)]
        rows += [(len(rows) + i, " ".join(rng.choices(words, k=25)), f"l{x:02}") for i in range(4 if x < 64 else 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df)
    assert len(model[0]) == 70 and model[1].shape[1] == 70
    want = {r[0]: r[2] for r in rows}
    got = language_id.identify(df, model).collect()
    assert len(got) == len(rows) and all(r.lang_pred == want[r.doc_id] for r in got)
    few = language_id.fit(df, per_language=4, languages=8)
    assert few[0] == model[0]


def test_languages_in_groups_are_as_if_fitted_and_scored_at_once(monkeypatch):
    from collections import Counter

    table = language_id.piece_table("piece_bpe_32k.model")
    rng = random.Random(5)
    counts = [Counter("".join(rng.choice("abcdeno") for _ in range(5)) for _ in range(20)) for _ in range(19)]
    texts = [" ".join(rng.choices([*c], k=9)) for c in counts] + ["", "12"]
    apart = language_id.fit_pieces(counts, table)
    monkeypatch.setattr(language_id, "_MEMORY", 40)
    few = language_id._Scorer(apart, "piece_bpe_32k.model").totals(texts)
    monkeypatch.setattr(language_id, "_AT_ONCE", 100)
    monkeypatch.setattr(language_id, "_MEMORY", 250_000)
    assert np.allclose(apart, language_id.fit_pieces(counts, table))
    assert np.allclose(few, language_id._Scorer(apart, "piece_bpe_32k.model").totals(texts))
