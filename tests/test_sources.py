"""Readers, sinks and the incremental audit."""

import json

from lamina.operators import trees
from lamina.sources import documents
from lamina.streaming import incremental_audit


def test_json_rows(spark, tmp_path):
    (tmp_path / "sa_6_table.json").write_text(json.dumps({"rows": [{"a": "1", "b": "x"}, {"a": "2"}], "blocks": [{"type": "text", "text": "t"}]}))
    (tmp_path / "sa_609_table.json").write_text(json.dumps({"title": "no rows"}))
    docs = documents.json_documents(spark, str(tmp_path))
    assert documents.files_of(docs, "sa_6").count() == 1
    rows = documents.document_rows(docs, "struct<a: string, b: string>").orderBy("line_no").collect()
    assert [(r.line_no, r.row.a, r.row.b) for r in rows] == [(0, "1", "x"), (1, "2", None)]
    assert {(r.type, r.text) for r in documents.citable_blocks(docs).collect()} >= {("text", "t")}


def test_html_cells(spark):
    page = "<table class='x'><tr><th>A</th><th>B</th></tr><tr id=1><td>1<sup>a</sup></td><td>2 &lt; 3</td></tr></table>"
    got = documents.html_cells(spark.createDataFrame([(1, page)], "id int, html string"), "id", "html").orderBy("row_no", "cell_no").collect()
    assert [(r.row_no, r.cell_no, r.text) for r in got] == [(0, 0, "A"), (0, 1, "B"), (1, 0, "1a"), (1, 1, "2 < 3")]


def test_preorder(spark):
    blocks = spark.createDataFrame([("a", None, 0), ("c", "a", 1), ("b", "a", 0), ("d", "b", 0)], "id string, parent_id string, position int")
    assert [r.id for r in trees.preorder(blocks).orderBy("path").collect()] == ["a", "b", "d", "c"]


def test_seal(spark, tmp_path):
    df = spark.range(5)
    a = documents.write_sealed(df, str(tmp_path / "a"), "first").first()
    b = documents.write_sealed(df.repartition(3), str(tmp_path / "b"), "again").first()
    assert a.n_rows == b.n_rows == 5 and a.digest == b.digest


def test_incremental_audit(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "mark"))
    for part in ([1, 2, 3], [3, 4]):
        spark.createDataFrame([(x,) for x in part], "k long").write.mode("append").parquet(source)
        incremental_audit.start(spark, source, "k long", ["k"], target, checkpoint).awaitTermination()
    assert [(r.k, r.n) for r in incremental_audit.repeated_keys(spark, target, ["k"]).collect()] == [(3, 2)]
