import corpus_pipeline
from fleetgauge.llm.common import pinned


def test_stages(spark):
    path = "/root/testdata/sf0.001"
    docs = first = spark.read.parquet(f"{path}/documents.parquet")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = pinned(stage(spark, docs, path))
        assert docs.columns == first.columns
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "simhash", "mixing", "byte_bpe"]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    assert len(out) == sizes[4] and all(r.restored and r.n_tokens == len(r.ids) for r in out)
    assert {r.doc_id for r in out} <= {r.doc_id for r in first.select("doc_id").collect()}


def test_odd_rows_pass_all_stages(spark):
    path = "/root/testdata/sf0.001"
    columns = "doc_id long, text string, lang string, source string, n_chars long, score int"
    rows = [(None, None, None, None, None, 1), (1, "", "en", "a", 0, 2), (1, "", "en", "a", 0, 2), (2, "Short one.", None, None, 10, 3)]
    for given in (rows, []):
        docs = spark.createDataFrame(given, columns)
        for _, stage in corpus_pipeline.STAGES:
            docs = pinned(stage(spark, docs, path))
        assert docs.count() <= 12


def test_texts_without_ids_pass_all_stages_apart(spark):
    path = "/root/testdata/sf0.001"
    good = [r.text for r in spark.read.parquet(f"{path}/documents.parquet").join(
        spark.read.parquet(f"{path}/labels.parquet").where("quality = 1 and toxic = 0"), "doc_id").orderBy("doc_id").limit(3).collect()]
    rows = [(None, t, "en", "a", len(t)) for t in [*good, good[0]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = pinned(stage(spark, docs, path))
    assert sorted(r.text for r in docs.collect()) == sorted(good)
