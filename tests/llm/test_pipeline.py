"""The pipeline stage by stage against brute force."""

import re

import corpus_pipeline
from pitmark.llm import quality, secrets
from pitmark.operators.scratch import materialise

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    lang, good, one, clean, pack = (f for _, f in corpus_pipeline.STAGES)
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}

    kept = materialise(lang(spark, docs, SF), "lang")
    assert kept.columns == columns and ids(kept) == {r.doc_id for r in docs.collect() if re.search(r"[^\W\d_]", r.text or "")}

    fine = materialise(good(spark, kept, SF), "good")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    lost = ids(kept) - ids(fine)
    known = [i for i in ids(kept) if i in labels]
    assert fine.columns == columns and sum((i not in lost) == bool(labels[i]) for i in known) >= 0.9 * len(known)
    assert sum(i in lost for i in known if labels[i]) <= 0.03 * len(known)

    unique = materialise(one(spark, fine, SF), "one")
    texts = {r.doc_id: r.text for r in fine.collect()}
    sets = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        sets[i] = frozenset(zip(*[w[j:] for j in range(5)])) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    label = {i: i for i in sets}
    for _ in range(5):
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    assert unique.columns == columns and ids(unique) == {i for i in sets if label[i] == i}

    safe = materialise(clean(spark, unique, SF), "safe")
    assert safe.columns == columns and ids(safe) == ids(unique)
    left = {r.doc_id: r.spans for r in secrets.secret_spans(unique).collect()}
    for r in safe.collect():
        live = [s for s in left[r.doc_id] if s.standing != "example"]
        assert (r.text == texts[r.doc_id]) == (not live) and r.n_chars == len(r.text)

    pieces = pack(spark, safe, SF)
    assert ids(pieces) == ids(safe)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert corpus_pipeline.run(spark, SF).count() == pieces.count()


def test_stages_keep_odd_rows(spark):
    """Nulls, empties, repeats and an empty table: what each stage is defined to keep."""
    secret = 'token = "a1B2c3D4e5F6g7H8i9J0" is in some words here'
    rows = [(1, None, None, None, None), (None, "some words here", "en", "s", 15), (2, "", "en", "s", 0), (2, "some words here", "en", "s", 15), (3, "some words here", None, "t", 15), (3, "some words here", None, "t", 15), (4, secret, "en", None, len(secret)), (5, "12 %", "en", "s", 4)]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score int")
    lang, good, one, clean, pack = (f for _, f in corpus_pipeline.STAGES)
    both = lambda df: sorted(((-1 if r.doc_id is None else r.doc_id), r.text) for r in df.collect() if r.text is not None)
    nulls = lambda df: df.where("text is null").count()
    some = [(-1 if r[0] is None else r[0], r[1]) for r in rows]

    kept = lang(spark, docs, SF)
    assert both(kept) == sorted((i, t) for i, t in some if t and re.search("[a-z]", t)) and nulls(kept) == 0 and kept.columns == docs.columns
    unlabelled = good(spark, docs.where("doc_id > 900"), SF)
    assert unlabelled.count() == 0
    judged = good(spark, docs, SF)
    assert set(both(judged)) <= set(some) and judged.columns == docs.columns
    # ids 2 and 3 have the same words: one row of 2; the blank row of 2 has none and stays
    unique = one(spark, docs, SF)
    assert both(unique) == [(-1, "some words here"), (2, ""), (2, "some words here"), (4, secret), (5, "12 %")] and nulls(unique) == 1
    safe = clean(spark, docs, SF)
    assert both(safe) == sorted((i, t.replace('token = "a1B2c3D4e5F6g7H8i9J0', "[SECRET]") if t else t) for i, t in some if t is not None) and nulls(safe) == 1
    assert all(r.n_chars == len(r.text) for r in safe.collect() if r.text is not None)
    pieces = pack(spark, docs, SF).collect()
    assert len(pieces) == len(rows) and sorted(r.length for r in pieces)[:2] == [1, 1]
    for stage in (lang, good, one, clean, pack):
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_classifier_is_the_operator():
    assert quality.Model and corpus_pipeline.ORACLE_SQL is None
