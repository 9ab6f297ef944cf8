import pytest

import corpus_pipeline

from factline.llm import decontaminate, jaccard_join, quality, substring_dedup


def test_stages_take_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs.select("doc_id").toPandas().doc_id
    kept = []
    for name, step in corpus_pipeline.STAGES[:-1]:
        bad = None
        if name == "quality_rules":
            bad = {r.doc_id for r in quality.judge(docs).filter("not kept").collect()}
        elif name == "near_duplicates":
            bad = {r.doc_id for r in jaccard_join.jaccard_components(docs).collect() if r.doc_id != r.component_id}
        elif name == "benchmark_passages":
            bad = {r.doc_id for r in decontaminate.find_contamination(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect() if r["items"]}
        had = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = corpus_pipeline.stage(step(spark, docs, sf), name)
        assert tuple(docs.columns) == corpus_pipeline.COLUMNS
        have = {r.doc_id for r in docs.select("doc_id").collect()}
        assert have <= had and (bad is None or have == had - bad)
        kept.append(len(have))
    assert 0 < kept[-1] < len(before)
    assert docs.filter("n_chars <> length(text)").count() == 0
    packed = corpus_pipeline.packed_sequences(spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == kept[-1]


@pytest.mark.parametrize("files", [False, True])
def test_rows_that_share_a_doc_id_or_have_none(spark, tmp_path, files):
    words = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    shared, item = words("s", 20), words("item", 12)
    spark.createDataFrame([("a", item)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def kept(step, rows):
        docs = spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
        if files:
            docs.write.parquet(f"{tmp_path}/{step.__name__}")
            docs = spark.read.parquet(f"{tmp_path}/{step.__name__}")
        out = step(spark, docs, str(tmp_path)).collect()
        assert all(r.n_chars == len(r.text) for r in out)
        return sorted(((r.doc_id, r.text.strip()) for r in out), key=str)

    good, junk, other, third = words("g", 30), "one two", words("o", 30), words("t", 30)
    judged = kept(corpus_pipeline.quality_rules, [(1, good), (1, junk), (None, junk), (None, other), (2, third)])
    assert judged == sorted([(1, good), (None, other), (2, third)], key=str)
    single = kept(corpus_pipeline.near_duplicates, [(None, good), (1, good), (1, good), (1, other), (None, third), (None, third), (2, good), (3, other)])
    assert single == sorted([(1, good), (1, other), (None, third)], key=str)
    a, b, c, d = (words(x, 15) for x in "abcd")
    cut = kept(corpus_pipeline.repeated_passages, [(5, f"{a} {shared}"), (7, f"{b} {shared}"), (7, f"{c} {shared}"), (7, shared), (None, f"{d} {shared}")])
    assert cut == sorted([(5, f"{a} {shared}"), (7, b), (7, c), (None, d)], key=str)
    clean = kept(corpus_pipeline.benchmark_passages, [(1, f"{a} {item}"), (1, good), (None, item), (None, other)])
    assert clean == sorted([(1, good), (None, other)], key=str)


def test_repeated_passages_sends_a_row_a_group_and_bucket(spark, monkeypatch):
    """Not one for each chunk of each task too, which grows much faster than the input."""
    hits = substring_dedup._hits

    def once(key, rows):
        groups = rows.column("grp").to_pylist()
        assert len(groups) == len(set(groups))
        return hits(key, rows)

    monkeypatch.setattr(substring_dedup, "_hits", once)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = corpus_pipeline.repeated_passages(spark, docs, "/root/testdata/sf0.01")
    assert 0 < out.count() <= docs.count() and out.filter("n_chars <> length(text)").count() == 0
