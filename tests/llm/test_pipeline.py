"""Every stage takes effect on what the one before it kept."""

import corpus_pipeline
import __spark_entry__
from tests.llm.test_decontamination import brute as leaks
from tests.llm.conftest import ROWS
from tests.llm.test_near_duplicates import brute as groups

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        before = [(r.doc_id, r.text) for r in docs.collect()]
        kept = {r.doc_id for r in after.collect()}
        if name == "packing":
            assert kept == {i for i, _ in before}
            break
        assert after.columns == docs.columns and kept <= {i for i, _ in before}
        if name == "near_duplicates":
            assert kept == {i for i, _, c in groups(before, 80) if i == c}
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert kept == {i for i, _ in before} - {x[0] for x in leaks(before, items)}
        else:
            assert 0 < len(kept) < len(before)
        docs = after
    assert corpus_pipeline.run(spark, SF).count() == after.count()


def test_odd_and_empty(spark, tmp_path):
    """Nulls, blank, repeated and clashing rows go through all stages, and an empty table gives nothing."""
    good = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(i, t, None, None, None) for i, t in ROWS]
    docs = good.unionByName(spark.createDataFrame(rows, good.schema)).unionByName(good.limit(5))
    docs = docs.selectExpr("*", "'theirs' as node", "1 as score", "'x' as print", "2 as _id", "3 as first")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, docs.where("false"), SF).count() == 0
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        assert 0 < after.count()
        if name != "packing":
            assert after.columns == docs.columns
            assert after.subtract(docs).count() == 0
        docs = after


def test_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)
