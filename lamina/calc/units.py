"""Units of measure: conversions that an audit uses, and dimensions, by which a formula is checked before it is compiled."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column

if TYPE_CHECKING:
    from lamina.calc.model import Engine

Dimension = dict[str, float]
#: Unit -> factor and offset to the first unit of its dimension (value * factor + offset), and the dimension
#: in powers of length, force, mass and temperature.
UNITS: dict[str, tuple[float, float, Dimension]] = {
    "mm": (1.0, 0.0, {"L": 1}), "m": (1000.0, 0.0, {"L": 1}), "in": (25.4, 0.0, {"L": 1}), "ft": (304.8, 0.0, {"L": 1}),
    "mm2": (1.0, 0.0, {"L": 2}), "in2": (645.16, 0.0, {"L": 2}), "m3": (1e9, 0.0, {"L": 3}),
    "N": (1.0, 0.0, {"F": 1}), "kip": (4448.2216152605, 0.0, {"F": 1}),
    "MPa": (1.0, 0.0, {"F": 1, "L": -2}), "psi": (0.006894757293168, 0.0, {"F": 1, "L": -2}), "ksi": (6.894757293168, 0.0, {"F": 1, "L": -2}),
    "kg/cm2": (0.0980665, 0.0, {"F": 1, "L": -2}), "N/mm": (1.0, 0.0, {"F": 1, "L": -1}), "kip/in": (175.126835246476, 0.0, {"F": 1, "L": -1}),
    "J": (1000.0, 0.0, {"F": 1, "L": 1}), "J/kg": (1000.0, 0.0, {"F": 1, "L": 1, "M": -1}), "kg": (1.0, 0.0, {"M": 1}), "lb": (0.45359237, 0.0, {"M": 1}),
    "C": (1.0, 0.0, {"T": 1}), "F": (5 / 9, -160 / 9, {"T": 1}), "%": (1.0, 0.0, {}), "deg": (1.0, 0.0, {}),
}


def convert(value: Column, of: str, to: str) -> Column:
    """A value in another unit of its dimension; units of different dimensions stop the query where it is built."""
    for unit in (of, to):
        if unit not in UNITS:
            raise ValueError(f"unknown unit {unit!r}")
    (a, b, x), (c, d, y) = UNITS[of], UNITS[to]
    if x != y:
        raise ValueError(f"{of} and {to} measure different things")
    return (value * a + (b - d)) / c


def _same(a: Dimension | None, b: Dimension | None, where: str) -> Dimension | None:
    """The dimension that two operands share. None: a number or a value whose unit isn't said, which fits anything."""
    if a is None or b is None:
        return b if a is None else a
    if a != b:
        raise ValueError(f"different dimensions in {where!r}: {a or 'none'} and {b or 'none'}")
    return a


def _number(node: tuple) -> float | None:
    """The value of a constant part of a formula."""
    kind, *rest = node
    if kind == "number":
        return rest[0]
    parts = [_number(x) for x in rest if isinstance(x, tuple)]
    if kind not in ("neg", "+", "-", "*", "/") or None in parts:
        return None
    a, b = parts[0], parts[-1]
    return {"neg": lambda: -a, "+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: a / b}[kind]()


def _powers(x: Dimension, y: Dimension, sign: float) -> Dimension:
    found = {k: x.get(k, 0) + sign * y.get(k, 0) for k in {**x, **y}}
    return {k: round(v, 9) for k, v in found.items() if abs(v) > 1e-9}


def dimension(node: tuple, units: dict[str, Dimension | None], where: str) -> Dimension | None:
    """The dimension of a parsed formula. Sums, comparisons, choices, MIN and MAX need operands of one dimension."""
    kind, *rest = node
    if kind in ("number", "text", "bool"):
        return None
    if kind == "name":
        return units.get(rest[0])
    args = [dimension(x, units, where) for x in rest if isinstance(x, tuple)]
    if kind == "neg":
        return args[0]
    if kind in ("+", "-"):
        return _same(*args, where)
    if kind in ("*", "/"):
        if None in args:  # what isn't said may be anything, but a plain number changes nothing
            plain = [_number(x) for x in rest]
            if plain[1] is not None or (plain[0] is not None and kind == "*"):
                return args[0] if plain[1] is not None else args[1]
            return _powers({}, args[1], -1) if plain[0] is not None and args[1] is not None else None
        return _powers(args[0], args[1], 1 if kind == "*" else -1)
    if kind == "^":
        power = _number(rest[1])
        return None if args[0] is None or power is None else {k: round(v * power, 9) for k, v in args[0].items()}
    if kind == "call":
        name = rest[0]
        if name in ("MIN", "MAX", "IFERROR", "IF"):
            found = None
            for x in args[1:] if name == "IF" else args:
                found = _same(found, x, where)
            return found
        if name == "ABS":
            return args[0]
        if name == "SQRT":
            return None if args[0] is None else {k: v / 2 for k, v in args[0].items()}
        return {} if name in ("SIN", "RADIANS", "PI") else None
    if kind != "&":  # a comparison
        _same(*args, where)
    return None


def check_units(engine: Engine) -> None:
    """Stop an engine whose formulas add or compare different dimensions, or give another one than their row's unit says."""
    from lamina.calc.formula import Formula

    units = {r.name: UNITS[r.unit][2] if r.unit in UNITS else None for r in engine.rows}
    for r in engine.rows:
        if r.formula:
            _same(dimension(Formula(r.formula).tree, units, r.formula), units[r.name], f"{r.name} = {r.formula}")
