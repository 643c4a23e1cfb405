"""Broken words, words from characters, bounds, contents: small cases by hand and against brute force."""

import random
import re
import time
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from lamina.operators import contents, glyphs, hyphens


def test_a_word_is_tried_from_its_first_letter():
    """The same breaks as from every letter, in time that grows with the text: one word of 40,000 letters."""
    plain = lambda x: re.compile(x.replace("(?U)", "").replace("-‐]", "‐-]"))
    r = random.Random(3)
    every = plain(hyphens.BROKEN.replace(r"(?<!\w)", ""))
    for _ in range(3000):
        t = "".join(r.choice("ab-‐ \n.é") for _ in range(r.randint(0, 24)))
        assert [m.span() + m.groups() for m in every.finditer(t)] == [m.span() + m.groups() for m in plain(hyphens.BROKEN).finditer(t)]
    began = time.perf_counter()
    assert not plain(hyphens.BROKEN).search("a" * 40_000 + ".")
    assert time.perf_counter() - began < 1


@pytest.mark.parametrize(
    "given, expected",
    [
        ("selec- tively", "selectively"), ("a tongue-and- groove joint", "a tongue-and-groove joint"), ("low- and high-cycle", "low- and high-cycle"), ("high-\ncycle", "high-cycle"),
        ("well- known", "well-known"), ("un- seen", "unseen"), ("non- de- structive", "nondestructive"), ("Selec‐ Tively", "SelecTively"), ("no breaks", "no breaks"), (None, None), ("a - b", "a - b"),
    ],
)
def test_broken_words(spark, given, expected):
    """What the corpus writes elsewhere decides; unseen words are joined; suspended compounds stay."""
    known = spark.createDataFrame([("selectively groove tongue",), ("high-cycle well-known wellknown",)], "t string")
    texts = spark.createDataFrame([(1, given, "other"), (2, "plain", "x")], "k int, t string, _text2 string")
    found = hyphens.rejoined(texts, "k", "t", hyphens.vocabulary_of(known, "t"))
    assert {r.k: r.t for r in found.collect()} == {1: expected, 2: "plain"}
    assert {r.k: r.t for r in hyphens.rejoined(found, "k", "t", hyphens.vocabulary_of(known, "t")).collect()} == {1: expected, 2: "plain"}


def test_the_corpus_is_its_own_vocabulary(spark):
    texts = spark.createDataFrame([(1, "a multi- step process"), (2, "the multi-step one"), (3, None)], "k int, t string")
    assert {r.k: r.t for r in hyphens.rejoined(texts, "k", "t").collect()} == {1: "a multi-step process", 2: "the multi-step one", 3: None}


def test_words_and_columns(spark):
    chars = [(1, 0.0, 5.0, 10.0, "A"), (1, 5.0, 9.0, 10.0, "b"), (1, 12.0, 16.0, 10.0, "c"), (1, 17.0, 20.0, 4.0, "2"), (1, 60.0, 64.0, 10.0, "x"), (1, 30.0, 34.0, 10.0, " "), (2, 0.0, 3.0, 8.0, "z")]
    df = spark.createDataFrame(chars, "line int, x0 double, x1 double, size double, char string")
    words = glyphs.words_of_chars(df, ["line"])
    assert sorted((r.line, r.word_no, r.text, r.x0, r.x1) for r in words.collect()) == [(1, 0, "Ab", 0, 9), (1, 1, "c2", 12, 20), (1, 2, "x", 60, 64), (2, 0, "z", 0, 3)]
    columns = spark.createDataFrame([(1, 0, 3.0), (1, 1, 15.0), (1, 2, 50.0), (2, 0, 9.0)], "line int, column_no int, b0 double")
    assert sorted((r.line, r.text, r.column_no) for r in glyphs.cut_at_columns(words, columns, ["line"]).collect()) == [(1, "Ab", 0), (1, "c2", 1), (1, "x", 2), (2, "z", 0)]


def test_bounds(spark):
    places = [(1, x) for x in (10.0, 11.0, 12.9, 13.5, 40.0, 40.0, 42.0, 90.0)] + [(1, None), (2, 5.0)]
    df = spark.createDataFrame(places, "t int, x double")
    grid = glyphs.merged_bounds(df, ["t"], "x", 3.0, 2)
    assert {r.t: [round(b, 3) for b in r.bounds] for r in grid.collect()} == {1: [11.3, 40.667], 2: []}
    grid = spark.createDataFrame([(1, [10.0, 50.0]), (2, [0.0, 9.0]), (3, [1.0])], "t int, bounds array<double>")
    more = spark.createDataFrame([(1, 5.0), (1, 4.0), (1, 6.5), (1, 54.0), (1, 60.0), (2, 4.0), (2, 12.0)], "t int, x double")
    assert {r.t: r.bounds for r in glyphs.widened_grid(grid, more, ["t"], "x").collect()} == {1: [4.0, 10.0, 50.0], 2: [0.0, 9.0], 3: [1.0]}


def longest(values):
    return max((len(c) for n in range(len(values) + 1) for c in combinations(values, n) if all(a < b for a, b in zip(c, c[1:], strict=False))), default=0)


def test_contents(spark):
    r = random.Random(2)
    declared, found, expected = [], [], {}
    for d in range(30):
        names = [r.choice("abcdefgh") for _ in range(r.randint(0, 8))]
        others = r.sample(names, r.randint(0, len(names))) + r.sample("abcxyz", 2)
        r.shuffle(others)
        declared += [(d, i, n) for i, n in enumerate(names)]
        found += [(d, i, n) for i, n in enumerate(others)]
        places = {}
        for i, n in enumerate(others):
            places.setdefault(n, []).append(i)
        pairs = []
        for n in names:
            if places.get(n):
                pairs.append(places[n].pop(0))
        expected[d] = (longest(pairs), len(pairs), len(names) - len(pairs), len(others) - len(pairs))
    left, right = (spark.createDataFrame(x, "d int, at int, name string") for x in (declared, found))
    states = {}
    for x in contents.compared_lists(left, right, ["d"], "name", "at").collect():
        states.setdefault(x.d, []).append(x)
    for d, (same, common, missing, extra) in expected.items():
        n = lambda s, d=d: sum(x.state == s for x in states.get(d, []))
        assert (n("SAME"), n("SAME") + n("MOVED"), n("MISSING"), n("EXTRA")) == (same, common, missing, extra)
        kept = sorted((x.declared_at, x.found_at) for x in states.get(d, []) if x.state == "SAME")
        assert all(a[1] < b[1] for a, b in zip(kept, kept[1:], strict=False))


def test_words_of_lines_take_no_exchange(spark):
    """Characters that stand in their line's array stay there; places in any order, nulls and signs of several bytes."""
    lines = spark.createDataFrame([(0, "ab  é漢 c"), (1, None), (2, ""), (3, "   ")], "line int, t string")
    got = lines.select("line", glyphs.words_of_line(F.shuffle(glyphs.in_fixed_pitch(F.col("t"), 5.0, 10.0))).alias("w"))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    found = {r.line: [tuple(w) for w in r.w] for r in got.collect()}
    assert found == {0: [("ab", 0.0, 10.0), ("é漢", 20.0, 30.0), ("c", 35.0, 40.0)], 1: [], 2: [], 3: []}
