"""Scalar functions against literal vectors (fixed values: what the printed pages have)."""

import pytest
from pyspark.sql import functions as F

from lamina.functions import numeric, text


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "given, expected",
    [("SA–516", "SA-516"), ("SA−516", "SA-516"), ("… Seamless pipe", "Seamless pipe"), ("   ", ""), (None, "")],
)
def test_text(spark, given, expected):
    assert one(spark, given, text.text) == expected


def test_clean_with_compatibility_forms(spark):
    assert one(spark, "ﬁne … print", lambda c: text.clean(c, compatibility=True)) == "fine print"
    assert one(spark, "   ", text.clean) is None


def test_search_key(spark):
    df = spark.createDataFrame([("SA–516", "70", None)], "a string, b string, c string")
    assert df.select(text.search_key(F.col("a"), F.col("b"), F.col("c")).alias("k")).first().k == "SA-516 70"


@pytest.mark.parametrize(
    "a, b, same",
    [
        ("18Cr–10Ni–Cb", "18Cr - 10Ni - Cb", True), ("C–1∕2Mo", "C-1/2Mo", True), ("1Cr–1⁄4Mo", "1Cr-1/4Mo", True),
        ("18Cr–18Ni–2Si", "8Ni", False), ("9Ni", "18Cr–19Ni", False),
    ],
)
def test_composition_key(spark, a, b, same):
    assert (one(spark, a, text.composition_key) == one(spark, b, text.composition_key)) is same
    assert one(spark, "16Cr–12Ni–2Mo", text.composition_key) == "16CR-12NI-2MO"


@pytest.mark.parametrize("given, expected", [("SA–217", "217"), ("A217", "217"), ("SA-1010", "1010"), (None, "")])
def test_spec_number(spark, given, expected):
    assert one(spark, given, text.spec_number) == expected


def test_phrases_and_notes(spark):
    assert one(spark, "Gray iron Gray iron", text.undouble) == "Gray iron"
    assert one(spark, "Carbon steels", text.undouble) == "Carbon steels"
    assert one(spark, "Steels [Note (2)]", text.note_reference) == "(2)"
    assert one(spark, "Carbon steels", text.note_reference) == ""


def test_html(spark):
    assert one(spark, "<p>10<sup>2</sup><br/>a &amp; b</p>", text.strip_tags) == "102 a & b"
    assert one(spark, "a\x01b", text.legal_xml) == "a�b"


def test_tokens_and_values(spark):
    """What printed pages show as one value, and what is none."""
    assert one(spark, "Tensile 48 000 [330] 1 1/2 20", text.tokens) == ["Tensile", "48 000 [330]", "1 1/2", "20"]
    assert one(spark, "Tensile strength, min, psi [MPa] 48 000 [330]", text.tokens)[-1] == "48 000 [330]"
    assert one(spark, "a 1 1⁄2 b", text.tokens) == ["a", "1 1⁄2", "b"]
    assert one(spark, "Ti 8 × C to 1.0 . . . 0.25 [6.4]", text.tokens) == ["Ti", "8 × C to 1.0", ". . .", "0.25 [6.4]"]
    for v in ("0.035", "0.27–0.93", "0.25A", "48 000 [330]", "1.00", ". . .", "...", "0.25 [6.4]", "12HB", "0.27–0.93A", "−5"):
        assert one(spark, v, text.is_value), v
    for v in ("Manganese", "Carbon,", "max", "Grade", "NP", "1 1⁄2"):
        assert not one(spark, v, text.is_value), v
    count = lambda c: text.trailing_values(text.tokens(c))
    assert [one(spark, t, count) for t in ("Manganese 0.27–0.93 0.29–1.06 0.29–1.06", "Grade A Grade B Grade C", "Grade B 1.5 2 3")] == [3, 0, 3]
    split = lambda c: text.split_by_count(c, 4)
    assert one(spark, "Manganese 0.27–0.93 0.29–1.06 0.29–1.06", split) == ["Manganese", "0.27–0.93", "0.29–1.06", "0.29–1.06"]
    assert one(spark, "Grade A Grade B Grade C", split) is None and one(spark, "Manganese 0.27–0.93", split) is None


@pytest.mark.parametrize(
    "given, expected",
    [
        ("Manganese, max.", "Mn"), ("Carbon equivalent", None), ("Nickel plus cobalt", None), ("Lead time", None), ("Cr", "Cr"), ("cr", None), ("Grade", None),
        ("Sulphur, maxC", "S"), ("PHOSPHOROUS", "P"), ("Aluminium [Note (1)]", "Al"), ("Cerium", "OTHER"), ("Rare earth, min", "OTHER"), ("Unobtainium", None), (" ", None), (None, None),
    ],
)
def test_elements(spark, given, expected):
    assert one(spark, given, text.element) == expected


@pytest.mark.parametrize(
    "given, expected, gauge",
    [
        ("Yield strength, min.", "yield", None), ("Ultimate tensile", "tensile", None), ("Impact of cold work", None, None), ("Brinell hardness", "hardness", None), ("Rockwell B, max", "hardness", None),
        ("Vickers", "hardness", None), ("Elongation in 2 in. [50 mm], min, %", "elongation", "2 in. [50 mm]"), ("Elongation, %", "elongation", None), ("Reduction in area", "reduction_of_area", None), ("Remarks", None, None),
    ],
)
def test_properties(spark, given, expected, gauge):
    assert (one(spark, given, text.property_of), one(spark, given, text.gauge_base)) == (expected, gauge)


@pytest.mark.parametrize(
    "given, expected",
    [
        ("0.27&#8211;0.93", "0.27–0.93"), ("a &mdash; b &alpha;", "a — b α"), ("&amp;lt; &lt;i&gt;", "&lt; <i>"), ("x &#x2265; 1", "x ≥ 1"), ("AT&T &nothing; &", "AT&T &nothing; &"), ("&#128512;&#0;&#xD800;&#150;", "😀\ufffd\ufffd–"),
        ("10 <sup> 2</sup> m", "102 m"), (None, None), ("plain", "plain"),
    ],
)
def test_entities(spark, given, expected):
    assert one(spark, given, text.strip_tags) == expected


def test_words_of_several_parts(spark):
    assert one(spark, "Limit 0.25 100 2 000 [14] 12.5 [0.5]A", text.tokens) == ["Limit", "0.25", "100", "2 000 [14]", "12.5 [0.5]A"]


@pytest.mark.parametrize(
    "f, given, expected",
    [
        (numeric.temperature, "1,000", 1000.0), (numeric.temperature, "−200", -200.0), (numeric.temperature, "–125", -125.0),
        (numeric.temperature, "abc", None), (numeric.number, "13.8", 13.8), (numeric.number, None, None),
        (numeric.number, "–125", None), (numeric.number, "−125", -125.0), (numeric.number, "1_000", None),
        (numeric.loose_number, "1 016", 1016.0), (numeric.fraction, "2 1/2", 2.5), (numeric.fraction, "1½", 1.5),
    ],
)
def test_coercions(spark, f, given, expected):
    assert one(spark, given, f) == expected


@pytest.mark.parametrize(
    "given, expected",
    [
        ("0.405 (10.29)", (0.405, 10.29)), ("...", (None, None)), ("", (None, None)), ("0.049 (1.24) [Note (1)]", (0.049, 1.24)),
        ("40.0 (1 016)", (40.0, 1016.0)), ("1,000.89 (1 489.92)", (1000.89, 1489.92)),
    ],
)
def test_dual_units(spark, given, expected):
    assert tuple(one(spark, given, numeric.split_dual)) == expected


@pytest.mark.parametrize("given, inches, dn", [("1½ (40)", 1.5, 40.0), ("1/8 (6)", 0.125, 6.0), ("12 (300)", 12.0, 300.0), ("2 1/2 (65)", 2.5, 65.0), ("40 (1 000)", 40.0, 1000.0)])
def test_sizes(spark, given, inches, dn):
    got = one(spark, given, numeric.split_size)
    assert (got.inches, got.dn) == (inches, dn)


@pytest.mark.parametrize("i, s, expected", [("STD", "40", "40 (STD)"), ("...", "10", "10"), ("XXS", "...", "XXS")])
def test_designator(spark, i, s, expected):
    df = spark.createDataFrame([(i, s)], "i string, s string")
    assert df.select(numeric.designator(F.col("i"), F.col("s")).alias("d")).first().d == expected


@pytest.mark.parametrize("op, e, expected", [("multiply", 3, 1000.0), ("divide", 6, 1e-6), ("none", 0, 1.0), (None, None, 1.0)])
def test_scale(spark, op, e, expected):
    df = spark.createDataFrame([(op, e)], "o string, e int")
    assert df.select(numeric.scale_factor(F.col("o"), F.col("e")).alias("f")).first().f == pytest.approx(expected, rel=1e-12)
