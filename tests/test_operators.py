"""Curves, keys, lookups, audits and layout on small tables."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lamina.operators import audit, curves, keys, layout, resolve


@pytest.mark.parametrize(
    "t, conservative, expected",
    [(25, False, 138), (200, False, 138), (212, False, 136.56), (263, False, 130.44), (263, True, 126), (250, True, 132), (900, False, 126)],
)
def test_interpolation(spark, t, conservative, expected):
    points = spark.createDataFrame([(1, 200.0, 138.0), (1, 250.0, 132.0), (1, 275.0, None), (1, 300.0, 126.0)], "id int, t double, v double")
    bands = curves.packed_bands(points, "id", "t", "v")
    probes = spark.createDataFrame([(1, float(t))], "id int, t_probe double")
    got = curves.lookup(probes, bands, "id", conservative=conservative).first()
    assert got.n_pts == 3 and got.value == pytest.approx(expected, abs=1e-6)


def test_curve_without_points(spark):
    points = spark.createDataFrame([(1, 200.0, None)], "id int, t double, v double")
    got = curves.lookup(spark.createDataFrame([(1, 5.0)], "id int, t_probe double"), curves.packed_bands(points, "id", "t", "v"), "id").first()
    assert got.n_pts == 0 and got.value is None


def test_exploded_probes_are_not_broadcast(spark):
    points = spark.range(100).select("id", F.lit(1.0).alias("t"), F.lit(2.0).alias("v"))
    probes = spark.range(100).withColumn("t_probe", F.explode(F.sequence(F.lit(1), F.lit(8)))).withColumn("t_probe", F.col("t_probe").cast("double"))
    plan = curves.lookup(probes, curves.packed_bands(points, "id", "t", "v"), "id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_status_precedence(spark):
    df = spark.createDataFrame([(60.0,), (90.0,), (95.0,), (5.0,), (30.0,)], "t double")
    got = [r.s for r in df.select(curves.limit_status(F.col("t"), F.lit(2), F.lit(38.0), F.lit(82.0), F.lit(10.0), F.lit(93.3)).alias("s")).collect()]
    assert got == ["IN_RANGE", "OUT_ABOVE_TABULATED", "OUT_ABOVE_RECOMMENDED", "OUT_BELOW_MINIMUM", "HELD_BELOW_FIRST"]


def test_factor(spark):
    df = spark.createDataFrame([(0.8, 1.0, True), (0.9, 0.85, True), (1.0, 0.5, False), (0.6, None, True)], "b double, e double, a boolean")
    assert [r.f for r in df.select(curves.applicable_factor(F.col("b"), F.col("e"), F.col("a")).alias("f")).collect()] == [1.0, 0.9, 1.0, 0.6]


def test_disambiguate(spark):
    rows = spark.createDataFrame([(1, "A", "G4"), (2, "A", "W6"), (3, "B", None), (4, "C", None), (5, "C", None)], "line int, id string, note string")
    got = {r.line: (r.unique_id, r.resolved_by) for r in keys.disambiguate(rows, "id", [("Notes", "note")], "line").collect()}
    assert got == {1: ("A Notes G4", 1), 2: ("A Notes W6", 1), 3: ("B", 0), 4: ("C", 2), 5: ("C #5", 2)}


def test_blocks_and_folds(spark):
    rows = spark.createDataFrame([(1, "x", "a"), (2, "x", "b"), (3, "y", "c"), (4, "x", "d")], "n int, k string, t string").withColumn("g", F.lit(1))
    assert [(r.k, r.runs) for r in keys.broken_blocks(rows, ["g"], "k", ["n"]).collect()] == [("x", 2)]
    folded = keys.fold(rows, ["g"], F.col("n").isin(1, 3), "t", ["n"]).orderBy("fold").collect()
    assert [(r.parts, r.t) for r in folded] == [(2, "a b"), (2, "c d")]


def test_selection():
    levels = ["a", "b", "c"]
    assert keys.select_level({"a": "1", "b": "2", "c": "3"}, levels, "b", "9") == {"a": "1", "b": "9", "c": None}
    with pytest.raises(ValueError):
        keys.select_level({}, levels, "b", "1")


def test_resolution_never_guesses(spark):
    rows = spark.createDataFrame([(1, "K1", "S1"), (2, "K2", "S1"), (3, "K3", "S9")], "id int, uns string, spec string")
    by_uns = spark.createDataFrame([("K1", "A"), ("K1", "A"), ("K2", "A"), ("K2", "B")], "uns string, grp string")
    by_spec = spark.createDataFrame([("S1", "C"), ("S1", "D")], "spec string, grp string")
    got = {r.id: (r.grp, r.state) for r in resolve.resolve(rows, "id", [("UNS", by_uns, ["uns"]), ("SPEC", by_spec, ["spec"])], "grp").collect()}
    assert got == {1: ("A", "UNS"), 2: (None, "AMBIGUOUS"), 3: (None, "UNMAPPED")}


def test_patch_refuses_the_unexpected(spark):
    rows = spark.createDataFrame([(1, "old"), (2, "other"), (3, None)], "id int, v string")
    patch = lambda *r: spark.createDataFrame(list(r), "id int, expected string, replacement string")
    fixed = lambda *r: {x.id: x.v for x in resolve.literal_patch(rows, patch(*r), ["id"], "v").collect()}
    assert fixed((1, "old", "new"), (3, None, "was null")) == {1: "new", 2: "other", 3: "was null"}
    assert fixed((1, "old", None)) == {1: None, 2: "other", 3: None}
    assert fixed() == {1: "old", 2: "other", 3: None}
    for wrong, said in (((2, "old", "new"), "unexpected value"), ((2, "old", None), "unexpected value"), ((9, "old", "new"), "no row"), ((None, "old", "new"), "no row")):
        with pytest.raises(Exception, match=said):
            fixed(wrong)
    with pytest.raises(Exception, match="patched twice"):
        fixed((1, "old", "new"), (1, "old", "new"))


def test_upper_median_and_digests(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (1, 1), (1, 2), (1, 3), (2, 4), (2, 5), (3, None)], "k int, v int")
    assert {r.k: r.m for r in audit.upper_median_of(rows, ["k"], "v", "m").collect()} == {1: 2, 2: 5, 3: None}
    digest = lambda *r: spark.createDataFrame(list(r), "a string, b string").agg(audit.content_digest(["a", "b"]).alias("d")).first().d
    assert digest(("x", None)) != digest((None, "x")) and digest(("x", "y"), ("z", "y")) == digest(("z", "y"), ("x", "y"))
    assert len({digest(("x", "y"), ("x", "y")), digest(("z", "y"), ("z", "y")), digest(("x", "y")), digest(("", "y"))}) == 4


def test_notes_and_facing_pages(spark):
    rows = spark.createDataFrame([(1, ["2", "1", "9"]), (2, ["9"]), (3, [])], "k int, cited array<string>")
    notes = spark.createDataFrame([("1", "one"), ("2", "two")], "note string, text string")
    assert {r.k: (r.note_texts, r.notes_missing) for r in resolve.attach_notes(rows, "k", F.col("cited"), notes).collect()} == {1: ("one · two", ["9"]), 2: (None, ["9"]), 3: (None, None)}
    left = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 3, 30)], "line string, n int, x int")
    right = spark.createDataFrame([("a", 1, 11), ("a", 5, 21), ("c", 6, 41)], "line string, n int, y int")
    got = {(r.line, r.nth, r.x, r.y, r.half) for r in resolve.page_halves(left, right, ["line"], "n").collect()}
    assert got == {("a", 1, 10, 11, None), ("a", 2, 20, 21, None), ("b", 1, 30, None, "RIGHT"), ("c", 1, None, 41, "LEFT")}


def test_audits(spark):
    rows = spark.createDataFrame([(1, 1), (1, 3), (2, 1), (2, 2)], "k int, line int")
    assert [r.k for r in audit.contiguity(rows, ["k"], "line").collect()] == [1]
    ranges = spark.createDataFrame([(1, 1, 3), (1, 6, 9), (1, 9, 12)], "k int, a int, b int")
    assert [(r.kind, r.width) for r in audit.page_gaps(ranges, ["k"], "a", "b").orderBy("a").collect()] == [("GAP", 2), ("OVERLAP", 1)]
    assert audit.key_uniqueness(rows, ["k"], "t").first().n_extra == 2
    vec = spark.createDataFrame([(1, 1.0), (2, 2.0)], "i int, v double")
    off = spark.createDataFrame([(1, 1.0 + 1e-12), (3, 2.0)], "i int, v double")
    assert sorted(r.i for r in audit.mismatches(vec, off, ["i"], "v", 1e-9).collect()) == [2, 3]
    named = {"gaps": audit.contiguity(rows, ["k"], "line"), "none": rows.where("false")}
    assert {r.name: r.violations for r in audit.checks(named).collect()} == {"gaps": 1, "none": 0}


def test_pieces_beside_their_text_take_no_exchange(spark, tmp_path):
    rows = [(0, "a b c"), (1, "a b c"), (3, "a  "), (6, "one"), (9, ""), (12, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    from lamina.plans.registry import QUERIES

    got = QUERIES["lossless_concat"](spark, str(tmp_path))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id: r.lossless for r in got.collect()} == {0: False, 1: True, 3: True, 6: True, 9: True, 12: None}
    pieces = spark.createDataFrame([(0, 1, "b"), (0, 0, "a"), (1, 0, "b")], "k int, n int, p string")
    sources = spark.createDataFrame([(0, "a b"), (1, "a b"), (2, ""), (3, "x")], "k int, t string")
    assert {r.k: r.lossless for r in audit.lossless(pieces, "k", "n", "p", sources, "t").collect()} == {0: True, 1: False, 2: True, 3: False}


def test_reconstruction_is_lossless(spark):
    lines = pd.DataFrame(
        [("Grade", 0, 0, 30, 10), ("Value", 50, 0, 80, 10), ("A", 0, 20, 10, 30), ("1.5", 50, 20, 60, 30), ("a note across", 0, 40, 90, 50)],
        columns=["text", "x0", "y0", "x1", "y1"],
    ).assign(page=1, line_no=range(5), spec="s", table_no=1)
    lines[["x0", "y0", "x1", "y1"]] = lines[["x0", "y0", "x1", "y1"]].astype(float)
    got = layout.reconstruct_tables(spark.createDataFrame(lines), ["spec", "table_no"]).orderBy("row_no").collect()
    assert [r.cells for r in got][:2] == [["Grade", "Value"], ["A", "1.5"]]
    assert (got[2].confidence, got[2].reason, got[2].cells) == ("EXACT", "CONTINUATION", ["a note across", ""])  # where labels begin
    assert "".join("".join(r.cells) for r in got) == "".join(lines["text"])


def test_twins(spark):
    rows = spark.createDataFrame([(1, 0.0, True, 1), (1, 0.1, False, 2), (1, 50.0, True, 3), (1, 50.0, True, 4), (1, 50.2, True, 5), (1, 90.0, False, 6), (1, 90.0, False, 7)], "page int, x double, empty boolean, at int")
    rows = rows.withColumn("box", F.struct(F.col("x").alias("x0"), F.lit(0.0).alias("y0"), (F.col("x") + 10.0).alias("x1"), F.lit(10.0).alias("y1")))
    assert sorted(r.at for r in layout.without_twins(rows, ["page"], "box", "empty", "at").collect()) == [2, 3, 6, 7]


def test_a_hundred_thousand_boxes_of_one_group(spark):
    """Copies of one box and a field of others: all pairs would be 10 ** 10."""
    n = F.col("id")
    x = F.when(n % 3 == 0, F.lit(0.0)).otherwise((n % 1000) * 100.0)
    y = F.when(n % 3 == 0, F.lit(0.0)).otherwise(F.floor(n / 1000) * 100.0)
    boxes = spark.range(100_000).select(F.lit(1).alias("page"), n.alias("at"), F.struct(x.alias("x0"), y.alias("y0"), (x + 20).alias("x1"), (y + 20).alias("y1")).alias("box"), (n % 2 == 0).alias("empty"))
    kept = layout.without_twins(boxes, ["page"], "box", "empty", "at")
    # copies: the odd ones are full, so no empty one stays; others have a place of their own, but id 0's is taken
    assert kept.where("at % 3 = 0 AND empty").count() == 0 and kept.count() == boxes.where("NOT (at % 3 = 0 AND empty)").count()
