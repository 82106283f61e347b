import corpus_pipeline
from tapwise.sources.folders import written_once


def test_stages_keep_columns_and_clean_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, []
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "ngram_join", "decontaminate", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written_once(stage(spark, docs, folder), name)
        assert after.columns == columns
        before_ids, after_ids = ({r.doc_id for r in d.select("doc_id").collect()} for d in (docs, after))
        assert after_ids <= before_ids and len(after_ids) > 0.85 * len(before_ids)
        kept.append(after_ids)
        docs = after
    pieces = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == kept[-1]


def test_odd_rows_go_through_every_stage(spark, tmp_path):
    rows = [(None, None, None, None, None, "x"), (1, "", "en", None, 0, None), (1, "", "en", None, 0, None),
            (2, "the only words that are here", "en", "s", 28, "y"), (3, "12 !!", None, None, 5, "z"),
            (4, "z" * 4000 + "\n" + "the end of it", "en", "s", 4013, "y")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_lines string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written_once(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == schema.replace(" long", "").replace(" string", "").split(", ")
    assert sorted(r.doc_id for r in docs.collect()) == [2, 4]
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "none" / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
