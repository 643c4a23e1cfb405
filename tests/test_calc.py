"""Formulas, engines, their guards and verdicts."""

import pytest
from pyspark.sql import functions as F

from lamina.calc.engines import PNEUMATIC_TEST, WELDED_PATCH
from lamina.calc.formula import Formula, column_name
from lamina.calc.model import Check, Citation, Engine, Gate, Row, provenance, severity


def evaluate(spark, engine, **inputs):
    return engine.evaluate(spark.createDataFrame([tuple(inputs.values())], [column_name(k) for k in inputs]))


def test_pneumatic_energy(spark):
    got = evaluate(spark, PNEUMATIC_TEST, V=100.0, Pat=5.0, Pa=0.101, k=1.4, R_scaled=20.0).first().asDict()
    assert got[column_name("E")] == pytest.approx(840055853.1289042, rel=1e-9)
    assert got[column_name("TNT")] == pytest.approx(196.87640104077514, rel=1e-9)
    assert got[column_name("R")] == pytest.approx(146.5900686172443, rel=1e-9)


@pytest.mark.parametrize("p, f_cp, w, s", [(5, 77.8280260625, 1.0254021879117259, 62.08001141391601), (20, 311.31210425, 4.1016087516469035, 248.32004565566405)])
def test_patch(spark, p, f_cp, w, s):
    df = evaluate(spark, WELDED_PATCH, Dm=317.45, t=6.35, T=8.0, P=p * 0.0980665, E=0.55, Sa=138.0, Rf=167.4, gap=0.0, service="allowed")
    got = df.first().asDict()
    assert got[column_name("F_CP")] == pytest.approx(f_cp, rel=1e-9)
    assert got[column_name("w_min")] == pytest.approx(w, rel=1e-9)
    assert got[column_name("S_w")] == pytest.approx(s, rel=1e-9)
    assert got[column_name("L_min")] == pytest.approx(63.495, rel=1e-6)
    assert got[column_name("elongation")] == pytest.approx(2.389486260454002, rel=1e-9)
    assert got["verdict"] == ("PASS" if p == 5 else "REVIEW")


def test_verdict_order(spark):
    common = dict(Dm=317.45, t=6.35, T=8.0, P=0.5, E=0.55, Rf=167.4, gap=0.0)
    blocked = evaluate(spark, WELDED_PATCH, **common, Sa=138.0, service="excluded")
    assert blocked.first().verdict == "BLOCKED: excluded"
    assert blocked.select(severity(F.col("verdict")).alias("s")).first().s == "RED"
    df = evaluate(spark, WELDED_PATCH, **common, Sa=1.0, service="allowed").withColumn(column_name("Sa"), F.lit(None).cast("double"))
    assert WELDED_PATCH.evaluate(df.select(*[c for c in df.columns if c in {column_name(k) for k in [*common, "Sa", "service"]}])).first().verdict == "MISSING Sa"


def test_names_that_differ_in_case_stay_apart(spark):
    assert column_name("t") != column_name("T") and column_name("T").lower() != column_name("t").lower()


@pytest.mark.parametrize("source", ["{a}+", "FOO({a})", "({a}", "{a} {b}", "1 $ 2"])
def test_bad_formulas_stop(source):
    with pytest.raises(ValueError):
        Formula(source)


def test_division_and_missing_values(spark):
    df = spark.createDataFrame([(1.0, 0.0, None)], "a double, b double, c double")
    bound = {k: F.col(k) for k in "abc"}
    get = lambda s: df.select(Formula(s).column(bound).alias("y")).first().y
    assert get("{a}/{b}") is None and get("IFERROR({a}/{b},7)") == 7.0
    assert get("MAX({a},{c})") is None and get("MAX({a},{b})") == 1.0
    assert get("-2^2") == 4.0 and get("2+3*4") == 14.0 and get('IF(AND({a}>0,NOT({b}>0)),"y","n")') == "y"


C = Citation("s", 1)


@pytest.mark.parametrize(
    "engine, says",
    [
        (Engine("e", (Row("a"), Row("a"))), "twice"),
        (Engine("e", (Row("x", "{y}", citation=C),)), "declared"),
        (Engine("e", (Row("x", "{y}", citation=C), Row("y", "{x}", citation=C))), "itself"),
        (Engine("e", (Row("a"), Row("x", "{a}"))), "without a citation"),
        (Engine("e", (Row("a", options=("p", "q"), citation=C, example="z"),)), "isn't one of"),
        (Engine("e", (Row("a"),), checks=(Check("b"),)), "judged"),
        (Engine("e", (Row("a"),), gates=(Gate("g", ("ok",)),)), "judged"),
    ],
)
def test_guards(engine, says):
    with pytest.raises(ValueError, match=says):
        engine.validate()


def test_provenance(spark):
    engine = Engine("e", (Row("a"), Row("x", "{a}*2", citation=Citation("s", 1, "c1")), Row("y", "{x}+1", citation=Citation("s", 2, "c2"))))
    blocks = spark.createDataFrame([("s", 1, "text", "twice"), ("s", 2, "heading", "Title")], "source string, block int, type string, text string")
    assert {r.name: r.found for r in provenance(engine, blocks).collect()} == {"x": True, "y": False}


def test_leak_box(spark):
    from lamina.calc.engines import LEAK_BOX
    from lamina.calc.model import fill, inconsistent_verdicts

    base = dict(od=60.3, t=5.54, P=2.0, CA=1.0, S=118.0, E=1.0, W=1.0, Y=0.4, d1=60.0, d2=120.0, beta=90.0, t_h=4.0, T_h=12.0, L4=10.0, Tp=9.0, thin=6.0)
    says = dict(crack="no", qualified="no", knuckle="no", thrust="yes")
    good = evaluate(spark, LEAK_BOX, **base, **says)
    row = good.first().asDict()
    assert row[column_name("t_req")] == pytest.approx(2.0 * 60.3 / (2 * (118 + 0.8)))
    assert row[column_name("A1")] == pytest.approx(240.0) and row[column_name("A2")] == pytest.approx(180 * 7.0)
    assert row["verdict"] == "PASS" and inconsistent_verdicts(LEAK_BOX, good).count() == 0
    assert evaluate(spark, LEAK_BOX, **base, **says | {"crack": "yes"}).first().verdict == "BLOCKED: unqualified crack"
    assert evaluate(spark, LEAK_BOX, **base, **says | {"knuckle": "yes"}).first().verdict.startswith("BLOCKED: weld")
    assert evaluate(spark, LEAK_BOX, **base | {"thin": 20.0}, **says).first().verdict == "PASS"
    assert evaluate(spark, LEAK_BOX, **base | {"T_h": 4.0}, **says).first().verdict == "REVIEW"
    assert inconsistent_verdicts(LEAK_BOX, good.withColumn("verdict", F.lit("REVIEW"))).count() == 1
    assert good.select(fill("wall {t} mm", LEAK_BOX).alias("x")).first().x == "wall 5.54 mm"
    with pytest.raises(ValueError):
        fill("{zz}", LEAK_BOX)


@pytest.mark.parametrize("ts, leg, verdict", [(8.0, 9.0, "PASS"), (14.0, 12.2, "PASS"), (5.0, 6.0, "REVIEW")])
def test_sleeve(spark, ts, leg, verdict):
    from lamina.calc.engines import SLEEVE

    sleeve = lambda **changed: evaluate(spark, SLEEVE, **({"Ts": ts, "Tp": 8.0, "G": 1.0, "Ls": 160.0, "defect": 40.0, "P_op": 10.0, "P_inst": 6.0} | changed)).first().asDict()
    got = sleeve()
    assert got[column_name("leg")] == pytest.approx(leg) and got[column_name("Ls_min")] == 140.0 and got["verdict"] == verdict
    # fixed values: the pressure while welding lies between 0.5 and 0.8 of that in operation, the gap is 2.5 mm at most
    assert [sleeve(P_inst=p)["verdict"] for p in (4.9, 5.0, 8.0, 8.1)] == ["REVIEW", verdict, verdict, "REVIEW"] and sleeve(G=2.6)["verdict"] == "REVIEW"


def test_units(spark):
    """Conversions; and dimensions that don't fit stop an engine before it is compiled."""
    from lamina.calc.formula import Formula
    from lamina.calc.model import Citation, Engine, Row
    from lamina.calc.units import UNITS, convert, dimension

    row = spark.createDataFrame([(212.0,)], "x double").select(convert(F.col("x"), "F", "C").alias("c"), convert(F.col("x"), "in", "mm").alias("mm"), convert(F.col("x"), "kip/in", "N/mm").alias("f")).first()
    assert (round(row.c, 9), round(row.mm, 9), round(row.f, 3)) == (100.0, 5384.8, 37126.889)
    for of, to in (("mm", "MPa"), ("mm", "cubit")):
        with pytest.raises(ValueError):
            convert(F.col("x"), of, to)
    units = {n: UNITS[u][2] for n, u in {"P": "MPa", "D": "mm", "t": "in", "W": "N/mm", "E": "J", "m": "kg"}.items()}
    of = lambda f: dimension(Formula(f).tree, units, f)
    assert of("{P}*{D}/2+{W}") == {"F": 1, "L": -1} and of("({D}*{t})^0.5+3") == {"L": 1} and of("SQRT({D}*{t})") == {"L": 1} and of("MAX(100,{D}+2*50)") == {"L": 1}
    assert of("{E}/{m}") == {"F": 1, "L": 1, "M": -1} and of("1/{D}") == {"L": -1} and of("{D}/{t}") == {} and of("IF({D}>{t},{P},2)") == {"F": 1, "L": -2} and of("{any}*{D}") is None
    for wrong in ("{P}+{D}", "MIN({D},{P})", "{W}>={P}", "IF({D}>1,{D},{P})"):
        with pytest.raises(ValueError, match="different dimensions"):
            of(wrong)
    cite = Citation("repair-article", 1, "clause")
    Engine("good", rows=(Row("a", unit="mm"), Row("b", "{a}*{a}", "mm2", cite))).validate()
    with pytest.raises(ValueError, match="different dimensions"):
        Engine("bad", rows=(Row("a", unit="mm"), Row("b", "{a}*{a}", "mm", cite))).validate()


def test_verdicts_against_what_stands_beside_them(spark):
    from lamina.calc.engines import WELDED_PATCH
    from lamina.calc.formula import column_name
    from lamina.calc.model import inconsistent_verdicts

    of = {r.name: column_name(r.name) for r in WELDED_PATCH.rows}
    cases = [
        ("PASS", "allowed", 1.0, True, True, True), ("PASS", "allowed", 1.0, True, False, False), ("REVIEW", "allowed", 1.0, False, True, True), ("REVIEW", "allowed", 1.0, True, True, False),
        ("REVIEW", "allowed", None, False, True, False), ("MISSING Sa", "allowed", None, None, True, True), ("MISSING Sa", "allowed", 1.0, True, True, False), ("BLOCKED: excluded", "excluded", None, None, None, True),
        ("BLOCKED: other", "excluded", 1.0, True, True, False), ("PASS", "excluded", 1.0, True, True, False), ("MISSING Sa", "excluded", None, True, True, False), (None, "allowed", 1.0, True, True, False),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], f"i int, verdict string, {of['service']} string, {of['Sa']} double, {of['weld_ok']} boolean, {of['strain_ok']} boolean, good boolean")
    assert sorted(r.i for r in inconsistent_verdicts(WELDED_PATCH, df).collect()) == [i for i, c in enumerate(cases) if not c[-1]]
