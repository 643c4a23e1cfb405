"""Spreadsheet-style formulas, parsed once on the driver and compiled to Column expressions.

Names stand in braces. A name that nothing declares stops the compilation. Columns of results are prefixed and
escaped, as names may differ in case alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = re.compile(r'\s*(?:(\d+\.?\d*(?:[eE][-+]?\d+)?)|"([^"]*)"|\{([^{}]+)\}|([A-Z][A-Z0-9]*)|(<>|<=|>=|[-+*/^()=<>&,;]))')


def column_name(name: str) -> str:
    """One to one: capitals and other characters are spelled out."""
    return "f_" + "".join(c if c.islower() or c.isdigit() else f"_{ord(c):x}_" for c in name)


def _all_or_null(f: Callable[..., Column]) -> Callable[..., Column]:
    """A missing operand makes the result missing, as in a sheet."""

    def call(*args: Column) -> Column:
        missing = args[0].isNull()
        for a in args[1:]:
            missing = missing | a.isNull()
        return F.when(~missing, f(*args))

    return call


FUNCTIONS: dict[str, Callable[..., Column]] = {
    "IF": lambda c, a, b: F.when(c, a).otherwise(b),
    "AND": lambda *x: _fold(x, lambda a, b: a & b),
    "OR": lambda *x: _fold(x, lambda a, b: a | b),
    "NOT": lambda x: ~x,
    "MIN": _all_or_null(lambda *x: F.least(*x) if len(x) > 1 else x[0]),
    "MAX": _all_or_null(lambda *x: F.greatest(*x) if len(x) > 1 else x[0]),
    "ABS": F.abs,
    "SQRT": F.sqrt,
    "SIN": F.sin,
    "RADIANS": F.radians,
    "LEFT": lambda s, n: F.left(s, n.cast("int")),
    "IFERROR": lambda a, b: F.coalesce(a, b),
    "NA": lambda: F.lit(None),
    "PI": lambda: F.lit(3.141592653589793),
}


def _fold(items: Iterable[Column], f: Callable[[Column, Column], Column]) -> Column:
    first, *rest = items
    for x in rest:
        first = f(first, x)
    return first


class Formula:
    """Recursive descent over comparison, ``&``, sums, products, powers and signs."""

    def __init__(self, source: str):
        self.source, self.tokens, at = source, [], 0
        text = source.removeprefix("=").rstrip()
        while at < len(text):
            m = TOKEN.match(text, at)
            if not m:
                raise ValueError(f"can't read {text[at:]!r} in {source!r}")
            kind = next(i for i in range(1, 6) if m[i] is not None)
            self.tokens.append((kind, m[kind]))
            at = m.end()
        self.at = 0
        self.tree = self._compare()
        if self.at < len(self.tokens):
            raise ValueError(f"unexpected {self.tokens[self.at][1]!r} in {source!r}")
        self.names = {v for k, v in self.tokens if k == 3}

    def _peek(self, *marks: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == 5 and self.tokens[self.at][1] in marks:
            return self.tokens[self.at][1]
        return None

    def _chain(self, below: Callable, *marks: str):
        left = below()
        while mark := self._peek(*marks):
            self.at += 1
            left = (mark, left, below())
        return left

    def _compare(self):
        return self._chain(self._join, "=", "<>", "<", ">", "<=", ">=")

    def _join(self):
        return self._chain(self._sum, "&")

    def _sum(self):
        return self._chain(self._product, "+", "-")

    def _product(self):
        return self._chain(self._power, "*", "/")

    def _power(self):
        return self._chain(self._sign, "^")

    def _sign(self):
        if mark := self._peek("-", "+"):
            self.at += 1
            inner = self._sign()
            return ("neg", inner) if mark == "-" else inner
        return self._atom()

    def _atom(self):
        if self.at >= len(self.tokens):
            raise ValueError(f"{self.source!r} ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == 1:
            return ("number", float(value))
        if kind == 2:
            return ("text", value)
        if kind == 3:
            return ("name", value)
        if kind == 4:
            if value in ("TRUE", "FALSE"):
                return ("bool", value == "TRUE")
            if value not in FUNCTIONS or not self._peek("("):
                raise ValueError(f"unknown function {value!r} in {self.source!r}")
            self.at += 1
            args = []
            while not self._peek(")"):
                args.append(self._compare())
                if self._peek(",", ";"):
                    self.at += 1
                elif not self._peek(")"):
                    raise ValueError(f"missing ) in {self.source!r}")
            self.at += 1
            return ("call", value, *args)
        if value == "(":
            inner = self._compare()
            if not self._peek(")"):
                raise ValueError(f"missing ) in {self.source!r}")
            self.at += 1
            return inner
        raise ValueError(f"unexpected {value!r} in {self.source!r}")

    def column(self, bound: dict[str, Column]) -> Column:
        """The formula over columns for its names."""
        if unknown := sorted(self.names - bound.keys()):
            raise ValueError(f"undeclared names in {self.source!r}: {', '.join(unknown)}")
        return self._build(self.tree, bound)

    def _build(self, node: tuple, bound: dict[str, Column]) -> Column:
        kind, *rest = node
        if kind in ("number", "text", "bool"):
            return F.lit(rest[0])
        if kind == "name":
            return bound[rest[0]]
        args = [self._build(x, bound) for x in rest if isinstance(x, tuple)]
        if kind == "call":
            return FUNCTIONS[rest[0]](*args)
        if kind == "neg":
            return -args[0]
        a, b = args
        return {
            "+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: F.try_divide(a, b), "^": lambda: F.pow(a, b),
            "&": lambda: F.concat(a.cast("string"), b.cast("string")), "=": lambda: a == b, "<>": lambda: a != b,
            "<": lambda: a < b, ">": lambda: a > b, "<=": lambda: a <= b, ">=": lambda: a >= b,
        }[kind]()
