"""Joins beyond equality and the meaning of tables."""

import pytest
from pyspark.sql import functions as F

from lamina.functions import text
from lamina.operators import match, tables


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


def test_more_text(spark):
    assert one(spark, "Éç a", text.plain_key) == "ECA"
    assert one(spark, " … ", text.is_ellipsis) and not one(spark, "1.5", text.is_ellipsis)
    for printed in ("Carbon, max. [Note (1)]", "Carbon, maxC", "Carbon maximum", "Carbon (heat), maxAB"):
        assert tuple(one(spark, printed, text.label_and_qualifier)) == ("Carbon", "max"), printed
    assert tuple(one(spark, "Carbon", text.label_and_qualifier)) == ("Carbon", None)
    assert [one(spark, x, text.note_mark) for x in ("(1) See", "A see", "see")] == ["(1)", "A", None]
    assert one(spark, "Grade A Grade B", lambda c: text.split_heading(c, 4)) == ["Grade", "A", "Grade", "B"]
    assert one(spark, r"$\frac{a}{b} \leq 2$", text.from_latex) == "a/b ≤ 2"
    assert tuple(one(spark, "1 ∕ 2", text.clean_value)) == ("1/2", "SLASH") and tuple(one(spark, "… 12", text.clean_value)) == ("12", "ELLIPSIS")
    assert tuple(one(spark, "N02200 222", text.merged_name)) == ("N02200", 222.0)
    assert one(spark, "(1) first (2) see (1) above (3) third", text.numbered_notes) == ["first", "see (1) above", "third"]
    assert text.unique_names(["A b", "a-b", ""]) == ["a_b", "a_b_2", "column"]


def test_only_candidate(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    other = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    assert {r.k: r.v for r in match.only_candidate(rows, other, ["k"], "v").collect()} == {1: "a", 2: None, 3: None}


def test_positions_are_a_contract(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "i int, x string")
    good, bad = (spark.createDataFrame(r, "i int, y string") for r in ([(1, "a"), (2, "b")], [(1, "a"), (2, "z")]))
    assert match.checked_positions(left, good, ["i"], F.col("x"), F.col("y")).count() == 2
    for other in (bad, good.limit(1)):
        with pytest.raises(Exception, match="correspond"):
            match.checked_positions(left, other, ["i"], F.col("x"), F.col("y")).collect()


def test_geometry(spark):
    runs = spark.createDataFrame([(1, 1, 5.0, 15.0), (1, 2, 48.0, 60.0), (1, 3, 34.0, 36.0)], "t int, run_no int, x0 double, x1 double")
    bands = spark.createDataFrame([(1, 0, 0.0, 30.0), (1, 1, 50.0, 80.0)], "t int, band int, b0 double, b1 double")
    assert {r.run_no: r.band for r in match.in_bands(runs, bands, ["t"]).collect()} == {1: 0, 2: 1, 3: 0}
    t = spark.createDataFrame([(1, 1, 100.0, 200.0), (2, 1, 10.0, 20.0)], "table_id int, page int, top double, bottom_t double")
    c = spark.createDataFrame([(1, 40.0, "far"), (1, 99.0, "near"), (1, 150.0, "below")], "page int, bottom double, caption string")
    assert {r.table_id: r.caption for r in match.caption_above(t, c).collect()} == {1: "near", 2: None}
    b = spark.createDataFrame([(1, 210.0, "note"), (1, 210.0, "note"), (1, 50.0, "text")], "page int, block_top double, text string")
    found = match.footnotes(t.withColumnRenamed("bottom_t", "bottom"), b).where("table_id = 1").collect()
    assert [r.text for r in found] == ["note"]
    x = spark.createDataFrame([(1, 10.0), (1, 20.0), (1, 100.0)], "k int, x double")
    assert [r.band for r in tables.bands_by_gap(x, ["k"], "x").orderBy("x").collect()] == [0, 0, 1]


def test_prefixes_pages_sections(spark):
    names = spark.createDataFrame([("sa_6_table",), ("sa_609",), ("zz",)], "name string")
    entries = spark.createDataFrame([("sa",), ("sa_6",), ("sa_60",)], "entry string")
    assert {r.name: r.entry for r in match.longest_prefix(names, entries, "name", "entry").collect()} == {"sa_6_table": "sa_6", "sa_609": "sa", "zz": None}
    wanted = spark.createDataFrame([(1, 5, "alpha"), (2, 5, "beta"), (3, 5, "gone")], "id int, page int, text string")
    pages = spark.createDataFrame([(4, "alpha"), (6, "alpha beta"), (17, "beta")], "page int, page_text string")
    assert {r.id: r.found_page for r in match.near_page(wanted, pages, "id").collect()} == {1: 4, 2: 6, 3: None}
    s = spark.createDataFrame([("1",), ("1.2",), ("1.2.3.4",), ("7.1",)], "number string")
    assert {r.number: (r.parent, r.depth) for r in match.section_parents(s).collect()} == {"1": (None, 1), "1.2": ("1", 2), "1.2.3.4": ("1.2", 4), "7.1": (None, 2)}
    df = spark.createDataFrame([("alpha betas", "x alpha betas y"), ("alpha betas gamma", "betas alpha gamma"), ("alpha betas", "nothing")], "w string, p string")
    assert [r.c for r in df.select(match.words_found(F.col("w"), F.col("p")).alias("c")).collect()] == ["FOUND", "REFORMATTED", "MISSING"]


def test_dimensions(spark):
    base = spark.createDataFrame([("12", "20", 12.75, 323.8, 0.25, 6.35)], "nps string, schedule string, od_in double, od_mm double, t_in double, t_mm double")
    asked = spark.createDataFrame([("B36.10M", "12", "20", "SI"), ("B36.10M", "12", "20", "US"), ("B36.19M", "12", "20", "SI")], "standard string, nps string, schedule string, units string")
    got = [(r.od, r.t) for r in match.dimension_lookup(asked, {"B36.10M": base}).orderBy("standard", "units").collect()]
    assert got == [(323.8, 6.35), (12.75, 0.25), (None, None)]


def test_tables(spark):
    rows = spark.createDataFrame([(1, ["Grade", "Carbon"]), (2, ["", "max"]), (3, ["A", "0.25"]), (4, ["B", "0.30"])], "n int, cells array<string>").withColumn("t", F.lit(1))
    split = tables.split_header(rows, ["t"], "n", "cells")
    assert [r.is_data for r in split.orderBy("n").collect()] == [False, False, True, True]
    named = tables.column_names(split.where("not is_data"), ["t"], "n", "cells")
    assert {r.column_no: r.name for r in named.collect()} == {0: "Grade", 1: "Carbon max"}
    cells = spark.createDataFrame([(1, "A", "Carbon, max", "0.25"), (1, "A", "Manganese", "0.3"), (1, "A", "Secret", "1"), (1, "B", "Carbon", "0.3"), (1, "B", "Carbon", "0.35")], "t int, g string, label string, value string")
    got = {r.g: (r.C, r.Mn, r.others) for r in tables.composition(cells, ["t"], "g", "label", "value", ["C", "Mn"]).collect()}
    assert got == {"A": ("0.25", "0.3", "Secret 1"), "B": ("0.3 / 0.35", None, None)}
    assert tables.fully_named(cells, ["t"], "label", F.when(F.col("label") != "Secret", F.col("label"))).first().unresolved == ["Secret"]


def test_notes_and_twins(spark):
    lines = spark.createDataFrame([(1, "text"), (2, "NOTES"), (3, "(1) one"), (4, "more"), (5, "(2) two"), (6, "Table 9"), (7, "(3) no")], "n int, t string").withColumn("d", F.lit(1))
    got = tables.note_regions(lines, ["d"], ["n"], F.col("t") == "NOTES", F.col("t").startswith("Table"), "t").collect()
    assert sorted((r.note, r.text) for r in got) == [("(1)", "(1) one more"), ("(2)", "(2) two")]
    pairs = spark.createDataFrame([("a b", "a b"), ("a b", "ab"), ("A b", "ab"), ("a-b", "ab"), ("x 1.5", "y 1.5"), ("p", "q")], "a string, b string")
    assert [r.c for r in pairs.select(tables.twin_class(F.col("a"), F.col("b")).alias("c")).collect()] == ["IDENTICAL", "SPACES", "CASE", "MARKS", "NUMBERS", "DIFFERENT"]
    names = spark.createDataFrame([("table_1",), ("table_table_1",), ("table_2",)], "n string")
    assert [tuple(r) for r in tables.twin_names(names, "n").collect()] == [("table_1", "table_table_1")]
    members = spark.createDataFrame([("g", "1", "x"), ("g", "1", "y"), ("g", "2", "y"), ("g", "2", "x"), ("g", "3", "x")], "g string, n string, m string")
    assert [r.notes for r in tables.repeated_notes(members, "g", "n", "m").collect()] == [["1", "2"]]
    words = spark.createDataFrame([(1, "mate-rial"), (2, "cold-formed")], "k int, w string")
    vocabulary = spark.createDataFrame([("material",)], "word string")
    assert {r.k: r.joined for r in tables.dehyphenated(words, vocabulary, "k", "w").collect()} == {1: "material", 2: "cold-formed"}
    assert tables.markdown(spark.createDataFrame([("a", 2)], "name string, violations int"))[-1] == "Total: 2"
