"""Engines that are declared as data."""

from __future__ import annotations

from lamina.calc.model import Check, Citation, Engine, Gate, Row

# The formulas, limits and clauses of the code's articles, as it prints them.
_A = lambda block, clause: Citation("repair-article", block, clause)

#: Full-encirclement and patch repair by a fillet-welded plate: forces, weld size and strain of the plate.
WELDED_PATCH = Engine(
    "welded_patch",
    rows=(
        Row("Dm", unit="mm"), Row("t", unit="mm"), Row("T", unit="mm"), Row("P", unit="MPa"), Row("E"), Row("Sa", unit="MPa"),
        Row("Rf", unit="mm"), Row("gap", unit="mm"), Row("service", options=("allowed", "excluded"), example="allowed", citation=_A(1, "scope")),
        Row("F_CP", "{P}*{Dm}/2", "N/mm", _A(2, "circumferential force")),
        Row("F_LP", "{P}*{Dm}/4", "N/mm", _A(3, "longitudinal force")),
        Row("F_max", "MAX({F_CP},{F_LP})", "N/mm", _A(4, "governing force")),
        Row("L_min", "2*({Dm}/2*{t})^0.5", "mm", _A(5, "distance between welds")),
        Row("w_min", "{F_max}/({E}*{Sa})", "mm", _A(6, "least throat")),
        Row("e", "({T}+{t})/2+{gap}", "mm", _A(7, "eccentricity")),
        Row("S_w", "{F_max}/{T}+6*{F_max}*{e}/({T}*{T})", "MPa", _A(8, "weld stress")),
        Row("elongation", "50*{T}/{Rf}", "%", _A(9, "fibre elongation")),
        Row("weld_ok", "{S_w}<=1.5*{Sa}", "", _A(10, "allowable weld stress")),
        Row("strain_ok", "{elongation}<=5", "", _A(11, "cold forming limit")),
    ),
    gates=(Gate("service", ("allowed",)),),
    checks=(Check("weld_ok"), Check("strain_ok")),
    materials=("Sa",),
)

#: Stored energy of a pneumatic test, its equivalent in explosive and the safe distance.
PNEUMATIC_TEST = Engine(
    "pneumatic_test",
    rows=(
        Row("V", unit="m3"), Row("Pat", unit="MPa"), Row("Pa", unit="MPa"), Row("k"), Row("R_scaled"),
        Row("E", "1/({k}-1)*{Pat}*1000000*{V}*(1-({Pa}/{Pat})^(({k}-1)/{k}))", "J", _A(20, "stored energy")),
        Row("E_TNT", "4266920", "J/kg", _A(21, "energy of explosive")),
        Row("TNT", "{E}/{E_TNT}", "kg", _A(21, "equivalent")),
        Row("R", "{R_scaled}*(2*{TNT})^(1/3)", "m", _A(22, "distance")),
    ),
)

#: Leak box with a tee: wall of the tee, reinforcement of the opening, and the conditions of use.
LEAK_BOX = Engine(
    "leak_box",
    rows=(
        Row("od", unit="mm"), Row("t", unit="mm"), Row("P", unit="MPa"), Row("CA", unit="mm"), Row("S", unit="MPa"), Row("E"), Row("W"), Row("Y"),
        Row("d1", unit="mm"), Row("d2", unit="mm"), Row("beta", unit="deg"), Row("t_h", unit="mm"), Row("T_h", unit="mm"), Row("L4", unit="mm"),
        Row("Tp", unit="mm"), Row("thin", unit="mm"),
        Row("crack", options=("yes", "no"), example="no", citation=_A(30, "cracks")),
        Row("qualified", options=("yes", "no"), example="no", citation=_A(31, "ways to qualify a crack")),
        Row("knuckle", options=("yes", "no"), example="no", citation=_A(32, "weld to a formed head")),
        Row("thrust", options=("yes", "no"), example="yes", citation=_A(33, "axial thrust")),
        Row("t_req", "{P}*{od}/(2*({S}*{E}*{W}+{P}*{Y}))", "mm", _A(34, "required wall")),
        Row("wall_ok", "{t}>={t_req}+{CA}", "", _A(35, "wall of the tee")),
        Row("A1", "{t_h}*{d1}*(2-SIN(RADIANS({beta})))", "mm2", _A(36, "required area")),
        Row("A2", "(2*{d2}-{d1})*({T_h}-{t_h}-{CA})", "mm2", _A(37, "area in the closure")),
        Row("A3", "2*{L4}*({t}-{t_req}-{CA})/SIN(RADIANS({beta}))", "mm2", _A(38, "area in the tee")),
        Row("area_ok", "{A2}+{A3}>={A1}", "", _A(39, "reinforcement")),
        Row("crack_gate", 'IF(OR({crack}<>"yes",{qualified}="yes"),"allowed","unqualified crack")', "", _A(40, "cracks")),
        Row("knuckle_gate", 'IF({knuckle}="yes","weld to an unqualified knuckle","allowed")', "", _A(41, "formed heads")),
        Row("thrust_ok", '{thrust}="yes"', "", _A(42, "axial thrust")),
        Row("wall_notice", 'IF({Tp}<={thin},"notice: thin wall","allowed")', "", _A(43, "welding on a thin wall")),
    ),
    gates=(Gate("crack_gate", ("allowed",)), Gate("knuckle_gate", ("allowed",)), Gate("wall_notice", ("allowed",), "notice")),
    checks=(Check("wall_ok"), Check("area_ok"), Check("thrust_ok")),
    materials=("S",),
)

#: Sleeve around a pipe: least thickness and length, and the fillet's leg on either side of 1.4 Tp.
SLEEVE = Engine(
    "sleeve",
    rows=(
        Row("Ts", unit="mm"), Row("Tp", unit="mm"), Row("G", unit="mm"), Row("Ls", unit="mm"), Row("defect", unit="mm"),
        Row("P_op", unit="MPa"), Row("P_inst", unit="MPa"),
        Row("Ts_min", "2/3*{Tp}", "mm", _A(50, "thickness of a sleeve that holds no pressure")),
        Row("Ls_min", "MAX(100,{defect}+2*50)", "mm", _A(51, "length of a sleeve")),
        Row("leg", "IF({Ts}<=1.4*{Tp},{Ts}+{G},1.4*{Tp}+{G})", "mm", _A(52, "fillet weld")),
        Row("thickness_ok", "{Ts}>={Ts_min}", "", _A(50, "thickness")),
        Row("length_ok", "{Ls}>={Ls_min}", "", _A(51, "length")),
        Row("gap_ok", "{G}<=2.5", "", _A(53, "radial gap at fit-up")),
        Row("band_ok", "AND({P_inst}>=0.5*{P_op},{P_inst}<=0.8*{P_op})", "", _A(54, "pressure while welding")),
    ),
    checks=(Check("thickness_ok"), Check("length_ok"), Check("gap_ok"), Check("band_ok")),
)
