"""Stages of the pipeline on small tables."""

from __future__ import annotations

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string"


def test_language_id_keeps_short_clean_texts(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source")
    words = ["Von.", "Osra\u00f1.", "Erinst resh.", "That it.", "o", "\u4f60\u597d", "Edstou reinan ed for."]
    short = [(10_000_000 + i, w, None, "s") for i, w in enumerate(words)]
    none = [(20_000_000 + i, w, None, "s") for i, w in enumerate([None, "", " \n", "12 34 !"])]
    docs = given.unionByName(spark.createDataFrame([*short, *none], SCHEMA))
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").select("doc_id").collect()}
    letters = {r.doc_id for r in given.collect() if any(ch.isalpha() for ch in r.text or "")}
    assert kept == letters | {r[0] for r in short}


def test_stages_judge_every_row_by_itself(spark):
    words = [" ".join(f"{chr(97 + i)}{chr(97 + j)}" for j in range(26)) for i in range(8)]
    near = words[0] + " " + words[4] + " " + words[5] + " " + words[6]
    rows = [(1, near, "en", "s"), (1, near, "en", "s"), (2, words[1], "en", "s"), (2, near + " end", "en", "s"),
            (None, words[2], "en", "s"), (None, words[2], "en", "s"), (3, words[3], "en", "s"), (None, words[3], "en", "t"),
            (4, words[7], "en", "s"), (4, "12 34 !", "en", "s"), (5, None, "en", "s"), (5, None, "en", "s")]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = corpus_pipeline.near_dedup_stage(spark, docs, "")
    assert kept.columns == docs.columns
    want = [rows[i] for i in (0, 2, 4, 6, 8, 9, 10, 11)]
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, want))
    lettered = corpus_pipeline.language_id(spark, docs, "")
    assert lettered.columns == docs.columns
    assert sorted(map(str, map(tuple, lettered.collect()))) == sorted(str(r) for r in rows if r[1] not in (None, "12 34 !"))


def test_all_stages_keep_any_column(spark, tmp_path):
    """Names that the operators use themselves, dotted and quoted names, maps and arrays, nulls everywhere, an empty table."""
    schema = SCHEMA + ", n_chars long, found_n long, found_items string, n_items int, item_ids string, `a.b` int, `c``d` int, " \
        "m map<string,int>, l array<int>, row int, given string, copies int, size long, mark string, nth int, place int"
    words = [" ".join(f"{chr(97 + i)}{chr(97 + j)}{k}x" for j in range(26)) for i in range(8) for k in range(3)]
    rows = [(i, w, "en" if i % 2 else "de", [None, "s", "t"][i % 3], None, 7, "x", 8, "y", i, -i, {"k": i}, [i], 1, "g", 2, 3, "m", 4, 5)
            for i, w in enumerate(words)]
    rows += [(None,) * 20, (None, words[0], *[None] * 18), (5, "", "en", "s", *[None] * 16), (3, "12 !", *[None] * 18)]
    item = " ".join(words[4].split()[2:24])
    for name, held in (("full", rows), ("empty", [])):
        spark.createDataFrame(held, schema).write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame([(1, item), (2, None)] if held else [], "item_id long, text string").write.parquet(
            str(tmp_path / name / "benchmark.parquet"))
        docs = spark.read.parquet(str(tmp_path / name / "documents.parquet"))
        kept, given = docs, {str(tuple(r)) for r in docs.collect()}
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, str(tmp_path / name))
            assert kept.columns == docs.columns and [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
            assert {str(tuple(r)) for r in kept.collect()} <= given
        out = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert len(out) == kept.count() and bool(out) == bool(held)
    clean = corpus_pipeline.decontamination(spark, spark.createDataFrame(rows, schema), str(tmp_path / "full"))
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in rows} - {4}
    words_of = corpus_pipeline.language_id(spark, spark.createDataFrame(rows, schema), "")
    assert words_of.count() == len(words) + 1


def test_stages_of_the_pipeline_on_the_given_table(spark):
    """Each stage against a plain reading of its rule, on the output of the one before."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = corpus_pipeline.near_dedup_stage(spark, corpus_pipeline.language_id(spark, docs, ""), "").collect()
    sets = []
    for r in kept:
        w = r.text.lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))})
    for i, a in enumerate(sets):
        assert not any(len(a & b) >= 0.8 * len(a | b) for b in sets[:i] if a & b)
    ids = {r.doc_id for r in kept}
    mixed = corpus_pipeline.mixing_stage(spark, docs, "").groupBy("doc_id").count().collect()
    assert len(ids) == len(kept) and max(r["count"] for r in mixed) <= 2
