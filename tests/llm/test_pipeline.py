import corpus_pipeline as P
from starflow.llm.common import staged

SF = "/root/testdata/sf0.001"


def test_stages_in_a_row(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "simhash_dedup", "secret_scan", "mix_sources", "pack_sequences"]
    counts = []
    for name, stage in P.STAGES:
        before, docs = docs, staged(stage(spark, docs, SF), name)
        counts.append(docs.count())
        if name != "pack_sequences":
            assert docs.columns == before.columns and docs.schema == before.schema
    q, dedup, secret, mix, pieces = counts
    assert 150 < q < 200 and dedup < q and secret == dedup and mix != dedup
    assert docs.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()
    assert before.filter("text rlike '[0-9a-f]{16}'").count() == 0
    assert P.run(spark, SF).count() == pieces


def test_stages_on_odd_rows(spark, odd, none):
    import pytest  # noqa: F401

    for rows in (odd, none):
        docs = rows
        for name, stage in P.STAGES:
            docs = staged(stage(spark, docs, SF), name)
            assert name == "pack_sequences" or docs.columns == rows.columns
        assert docs.count() == 0 if rows is none else docs.count() > 0
