"""The corpus pipeline, stage by stage and as a whole."""

import random

from llm_fixtures import SF_SMALL  # noqa: F401
import corpus_pipeline


def test_stages_keep_the_columns_and_take_effect(spark, scratch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, n = docs.columns, docs.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    sizes = [n]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_SMALL).write.parquet(f"{scratch}/{name}")
        out = spark.read.parquet(f"{scratch}/{name}")
        if name != "best_fit_packing":
            assert out.columns == columns
            sizes.append(out.count())
            if name == "line_dedup":
                assert out.where("n_chars != length(text)").isEmpty()
        else:
            assert {r[0] for r in out.select("doc_id").collect()} == {r[0] for r in docs.select("doc_id").collect()}
            assert out.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").isEmpty()
        docs = out
    assert sizes[1] < sizes[0] and sizes[2] == sizes[1] and sizes[3] < sizes[2] and sizes[4] < sizes[3]


def test_run_on_odd_rows(spark, scratch):
    rng = random.Random(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    same = prose(40)
    item = prose(20)
    rows = [(i, prose(60), "en", "s", 0) for i in range(12)] + [
        (20, same, "en", None, None), (21, same, "en", "s", 1), (21, same, "en", "s", 1), (None, prose(50), None, None, None), (22, None, "en", "s", 0),
        (23, "", "en", "s", 0), (24, f"{prose(30)} {item} {prose(20)}", "en", "s", 9), (25, prose(6000), "en", "s", 9)]
    for d, table in ((f"{scratch}/in", rows), (f"{scratch}/none", [])):
        spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    ids = {r.doc_id for r in corpus_pipeline.run(spark, f"{scratch}/in").collect()}
    assert ids == {*range(12), 20, None, 25}
    assert corpus_pipeline.run(spark, f"{scratch}/none").count() == 0
