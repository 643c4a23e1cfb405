"""Tables from positioned lines: rows, bands, counts, continuations; and joins of what overlaps."""

import random

import pytest
from pyspark.sql import functions as F

from lamina.operators import layout, regions, resolve

LINES = "t int, text string, x0 double, y0 double, x1 double, y1 double, page int, line_no int"


def lines(spark, *rows, page=lambda k: 1):
    """Each row: lines of (x0, x1, text)."""
    out = [(1, text, float(x0), 10.0 * k, float(x1), 10.0 * k + 6, page(k), 100 * k + i) for k, row in enumerate(rows) for i, (x0, x1, text) in enumerate(row)]
    return spark.createDataFrame(out, LINES)


def rebuilt(spark, *rows, **more):
    return layout.reconstruct_tables(lines(spark, *rows, **more), ["t"]).orderBy("row_no").collect()


def bands(spark, *rows):
    found = layout.columns_of(layout.printed_rows(lines(spark, *[[(a, b, "x") for a, b in row] for row in rows]), ["t"]), ["t"]).collect()
    return [tuple(b) for r in found for b in r.bands]


def test_rows_by_their_middle(spark):
    """Rows two points apart stay apart, a raised mark stays in its row."""
    place = lambda *ys: [len(r.runs) for r in layout.printed_rows(spark.createDataFrame([(1, "x", 0.0, float(a), 9.0, float(b), 1, k) for k, (a, b) in enumerate(ys)], LINES), ["t"]).orderBy("row_no").collect()]
    assert place((562.3, 569.3), (571.3, 577.5)) == [1, 1]
    assert place((100.0, 106.0), (99.0, 105.5)) == [2]
    assert place((0, 10), (1, 11), (20, 30), (41, 51)) == [2, 1, 1]


def test_bands(spark):
    assert bands(spark, [(0, 300)], [(0, 40), (100, 140), (200, 240)]) == [(0, 40), (100, 140), (200, 240)]
    # one row crosses the gap that another proves: cut in its middle
    assert bands(spark, [(0, 60), (100, 160), (300, 360)], [(50, 110), (300, 360)]) == [(0, 80), (80, 160), (300, 360)]
    # pieces of one cell are nearer to each other than columns are
    assert bands(spark, [(0, 40), (41, 60), (200, 240)]) == [(0, 60), (200, 240)]
    # nine lines across ten columns in two rows, and a row that proves all gaps
    many = [[(100 * c + (60 if r else 0), 100 * c + 90 + (60 if r else 0)) for c in range(9)] for r in range(2)]
    assert len(bands(spark, *many, [(100 * c, 100 * c + 20) for c in range(10)])) == 10
    assert bands(spark, [(0, 10)], [(0, 30)]) == []


def test_geometry(spark):
    got = rebuilt(
        spark, [(10, 40, "Grade"), (60, 80, "A"), (100, 130, "B")], [(10, 40, "Carbon"), (60, 80, "0.25A"), (100, 130, "0.30")],
        [(10, 130, "Manganese 0.27–0.93 0.29–1.06")], [(12, 50, "for all sizes")], [(14, 50, "and grades")], [(10, 35, "x"), (20, 41, "y")], [(300, 350, "far 1 2")],
    )
    assert [r.cells for r in got] == [
        ["Grade", "A", "B"], ["Carbon", "0.25A", "0.30"], ["Manganese", "0.27–0.93", "0.29–1.06"], ["for all sizes", "", ""], ["and grades", "", ""], ["x y"], ["far 1 2"],
    ]
    assert [r.confidence for r in got] == ["EXACT", "EXACT", "BY_COUNT", "EXACT", "EXACT", "AMBIGUOUS", "AMBIGUOUS"]
    assert [r.reason for r in got] == ["", "", "", "CONTINUATION", "CONTINUATION", "SHARED_BAND", "OUT_OF_REACH"]
    assert [r.kind for r in got] == ["header", "data", "data", "header", "header", "header", "data"]
    assert ([r.line_no for r in got], {r.origin for r in got}) == ([0, 100, 200, 300, 400, 500, 600], {"BANDS"})


def test_counts(spark):
    single = lambda *texts: rebuilt(spark, *[[(10, 200, t)] for t in texts])
    got = single("Grade A 0.25 0.30", "Grade B 0.28 0.35", "Grade C . . . 48 000 [330]", "of plates", "odd 1")
    assert [r.confidence for r in got] == ["BY_COUNT"] * 3 + ["EXACT", "AMBIGUOUS"] and {r.origin for r in got} == {"COUNT"}
    assert [r.cells for r in got][2:] == [["Grade C", ". . .", "48 000 [330]"], ["of plates", "", ""], ["odd 1"]]
    doubt = single("a 1 2", "b 1 2", "c 1", "d 1 2 3")
    assert {r.origin for r in doubt} == {"COUNT_IN_DOUBT"} and [r.confidence for r in doubt] == ["BY_COUNT", "BY_COUNT", "AMBIGUOUS", "BY_COUNT"]
    assert [r.confidence for r in single("one", "two words")] == ["EXACT", "EXACT"]
    assert [r.reason for r in single("a row of many words", "another row of words")] == ["NO_COLUMNS"] * 2
    # one band separates nothing, so rows of several lines stay whole
    assert [r.reason for r in rebuilt(spark, [(10, 40, "a"), (41, 60, "b")], [(10, 60, "c 1")])] == ["NO_BANDS", ""]


def test_over_pages_and_lossless(spark):
    rows = [[(0, 30, f"r{k}"), (50, 80, f"{k}.5")] for k in range(6)] + [[(0, 90, "a note across")]]
    got = rebuilt(spark, *rows, page=lambda k: k // 3)
    assert [r.cells for r in got][:6] == [[f"r{k}", f"{k}.5"] for k in range(6)] and [r.page for r in got] == [0, 0, 0, 1, 1, 1, 2]
    assert "".join("".join(r.cells) for r in got) == "".join(t for row in rows for _, _, t in row)
    assert layout.reconstruct_tables(spark.createDataFrame([], LINES), ["t"]).count() == 0


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_lines_are_placed_once(spark):
    """Bands, counts and rows read the same printed rows, and what belongs to a table comes by one exchange, not by joins."""
    got = layout.reconstruct_tables(lines(spark, [(0, 30, "a"), (50, 80, "1")], [(0, 30, "b 2")]), ["t"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "Join" not in plan and exchanges(got) <= 8
    # a table without a key is a table too
    nameless = layout.reconstruct_tables(lines(spark, [(10, 200, "a 1 2")], [(10, 200, "b 3 4")]).withColumn("t", F.lit(None).cast("int")), ["t"]).collect()
    assert sorted(r.cells for r in nameless) == [["a", "1", "2"], ["b", "3", "4"]] and {r.origin for r in nameless} == {"COUNT"}


def test_overlaps_equal_all_pairs(spark):
    r = random.Random(5)
    boxes = [(k, r.choice([1, 2]), *(float(r.randint(-200, 400)) for _ in range(2))) for k in range(120)]
    boxes = [(k, g, x, y, x + r.choice([0, 1, 30, 200]), y + r.choice([0, 5, 90])) for k, g, x, y in boxes]
    df = spark.createDataFrame(boxes, "k int, g int, x0 double, y0 double, x1 double, y1 double")
    side = lambda n: df.select("g", F.col("k").alias(n), F.struct("x0", "y0", "x1", "y1").alias(f"{n}_box"), F.col("x0").alias(f"{n}0"), F.col("x1").alias(f"{n}1"))
    got = regions.touching(side("a"), side("b"), ["g"], "a_box", "b_box").select("a", "b").collect()
    meet = lambda p, q: p[1] == q[1] and min(p[4], q[4]) >= max(p[2], q[2]) and min(p[5], q[5]) >= max(p[3], q[3])
    assert sorted(map(tuple, got)) == sorted((p[0], q[0]) for p in boxes for q in boxes if meet(p, q))
    for least in (0.0, 7.0):
        lengths = regions.overlapping(side("a"), side("b"), ["g"], ("a0", "a1"), ("b0", "b1"), least).select("a", "b").collect()
        share = lambda p, q: min(p[4], q[4]) - max(p[2], q[2])
        assert sorted(map(tuple, lengths)) == sorted((p[0], q[0]) for p in boxes for q in boxes if p[1] == q[1] and (share(p, q) > least if least else share(p, q) >= 0))
    inside = lambda p, q: p[1] == q[1] and q[2] <= (p[2] + p[4]) / 2 <= q[4] and q[3] <= (p[3] + p[5]) / 2 <= q[5]
    some = side("b").where("b % 4 = 0")
    assert sorted(x.a for x in regions.outside(side("a"), some, ["g"], "a_box", "b_box").collect()) == [p[0] for p in boxes if not any(inside(p, q) for q in boxes if q[0] % 4 == 0)]


def test_regions_of_any_size_have_few_cells(spark, monkeypatch):
    """Regions from a point to a thousand pages wide against a plain loop; the widest are cut in cells as wide as they are."""
    sizes, cells = [], regions._cells
    monkeypatch.setattr(regions, "_cells", lambda a, b, cell: (sizes.append(cell), cells(a, b, cell))[1])
    r = random.Random(7)
    box = lambda k, sides: (k, *(p := [float(r.randint(-300, 900)) for _ in range(2)]), *(v + r.choice(sides) for v in p))
    boxes, some = [box(k, [0.0, 12.0]) for k in range(300)], [box(k, [0.0, 64.0, 65.0, 130.0]) for k in range(40)] + [(99, 880.0, -1e6, 1e6, 1e6)]
    df = lambda rows: spark.createDataFrame(rows, "k int, x0 double, y0 double, x1 double, y1 double").select(F.lit(1).alias("g"), "k", F.struct("x0", "y0", "x1", "y1").alias("box"))
    got = regions.outside(df(boxes), df(some), ["g"], "box", "box")
    inside = lambda p, q: q[1] <= (p[1] + p[3]) / 2 <= q[3] and q[2] <= (p[2] + p[4]) / 2 <= q[4]
    assert min(sizes) == 64 and max(sizes) >= 1e6
    assert sorted(x.k for x in got.collect()) == [p[0] for p in boxes if not any(inside(p, q) for q in some)]


def test_regions_go_on_over_the_page(spark):
    box = lambda *v: dict(zip(("x0", "y0", "x1", "y1"), map(float, v), strict=True))
    schema = "d int, page int, region struct<x0: double, y0: double, x1: double, y1: double>, goes_on boolean"
    found = spark.createDataFrame([(1, 1, box(0, 500, 200, 800), True), (1, 3, box(0, 0, 50, 50), False)], schema)
    ends = spark.createDataFrame([(1, 2, 120.0), (1, 4, 99.0)], "d int, page int, ends double")
    got = {(r.page, tuple(r.region)) for r in regions.carried_over(found, ["d"], "page", "region", "goes_on", 40.0, ends).collect()}
    assert got == {(1, (0, 500, 200, 800)), (3, (0, 0, 50, 50)), (2, (0, 40, 200, 120))}


def test_banners_over_columns(spark):
    """One banner over two columns that wraps, one over all, labels of single columns, a broken number."""
    columns = spark.createDataFrame([(1, k, 50.0 * k, 50.0 * k + 50) for k in range(4)], "t int, column_no int, b0 double, b1 double")
    runs = [(0, 5, 195, "Temperature"), (1, 5, 95, "Category D"), (1, 110, 190, "Normal"), (2, 20, 80, "Service"), (3, 5, 45, "1,00-"), (4, 10, 40, "0"), (3, 60, 90, "mm"), (3, 110, 140, "in."), (4, 160, 190, "ft")]
    df = spark.createDataFrame([(1, n, float(a), float(b), t) for n, a, b, t in runs], "t int, line int, x0 double, x1 double, text string")
    got = {r.column_no: (r.label, r.banners) for r in regions.header_columns(df, columns, ["t"]).collect()}
    assert got == {0: ("1,000", ["Temperature", "Category D Service"]), 1: ("mm", ["Temperature", "Category D Service"]), 2: ("in.", ["Temperature", "Normal"]), 3: ("ft", ["Temperature", "Normal"])}


def test_places_of_a_head_are_found_once(spark):
    """Two banners below one: the nearer by centre continues it, the other is its own; runs meet columns once, not once a step."""
    columns = spark.createDataFrame([(1, k, 50.0 * k, 50.0 * k + 50) for k in range(4)], "t int, column_no int, b0 double, b1 double")
    runs = [(0, 5, 95, "Upper"), (0, 110, 190, "Other"), (1, 15, 95, "near"), (1, 40, 120, "far"), (2, 40, 120, "goes on")]
    got = regions.header_columns(spark.createDataFrame([(1, n, float(a), float(b), t) for n, a, b, t in runs], "t int, line int, x0 double, x1 double, text string"), columns, ["t"])
    assert {r.column_no: (r.label, r.banners) for r in got.collect()} == {
        0: (None, ["Upper near", "far goes on"]), 1: (None, ["Upper near", "far goes on"]), 2: (None, ["Other", "far goes on"]), 3: (None, ["Other"]),
    }
    assert exchanges(got) <= 8


def test_required(spark):
    wanted = spark.createDataFrame([(1,), (2,)], "k int")
    found = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(Exception, match="no value for 2"):
        resolve.required(wanted, found, ["k"], "v", "value").collect()
    assert resolve.by_prefix(spark.createDataFrame([], "p string"), spark.createDataFrame([("a", 1)], "n string, o int"), "p", "n", "o").count() == 0
