"""Registered queries against their SQL, and the pipeline stage by stage."""

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op3_mixing", "op5_license_scan", "op6_url_filter", "op10_jaccard_join"])
def test_query_equals_sql(spark, name):
    from ringlens.llm.oracle import ORACLE
    from ringlens.llm.queries import QUERIES
    from tools.oracle_check import compare, duck

    info = compare(spark, duck(SF), name, QUERIES[name], ORACLE[name], SF)
    assert info["ok"], info


def test_pipeline(spark):
    import corpus_pipeline
    from tests.llm.test_operators import _brute_base, _brute_components
    from ringlens.plans.runtime import materialize

    raw = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(None, None, None, None, None), (90001, "", "en", "src0", 0), (90002, "123", None, None, 3)]
    docs = materialize(raw.union(spark.createDataFrame(odd, raw.schema)).union(raw.limit(1)).selectExpr("*", "1 AS language"), "odd")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, SF), "stage")
        kept.append((name, before, docs))
    (_, start, clean), (_, _, unique), (_, _, private), (_, _, mixed), (_, _, coded) = kept
    assert [n for n, _, _ in kept] == ["language_id", "jaccard_join", "pii", "mixing", "sentencepiece"]
    assert clean.columns == unique.columns == private.columns == mixed.columns == start.columns
    ids = {r.doc_id for r in clean.select("doc_id").collect()}
    assert {None, 90001, 90002}.isdisjoint(ids) and len(ids) >= 0.97 * raw.count()
    rows = [(r.doc_id, r.text) for r in clean.dropDuplicates(["doc_id"]).collect()]
    first = {c if n else d for d, n, c in _brute_components(rows, 5, 80)}
    assert sorted(r.doc_id for r in unique.collect()) == sorted(first)
    found = {r.doc_id: r for r in private.collect()}
    for r in unique.collect():
        assert (found[r.doc_id].text != r.text) == bool(_brute_base(r.text)) or found[r.doc_id].text != r.text
        assert found[r.doc_id].n_chars == len(found[r.doc_id].text) and not _brute_base(found[r.doc_id].text)
    assert coded.count() == mixed.count() > 0 and "token_ids" in coded.columns
    empty = [stage(spark, spark.read.parquet(f"{SF}/documents.parquet").limit(0), SF).count() for _, stage in corpus_pipeline.STAGES]
    assert empty == [0] * 5


def test_stages_with_python_send_small_batches(spark):
    import corpus_pipeline

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, docs = spark.conf.get(name), spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    try:
        for stage in (corpus_pipeline.languages, corpus_pipeline.near_duplicates, corpus_pipeline.privacy, corpus_pipeline.encoding):
            spark.conf.set(name, str(64 << 20))
            stage(spark, docs, SF)
            assert int(spark.conf.get(name)) <= 1 << 20
    finally:
        spark.conf.set(name, before)
