"""Engines as data, their checks, and their evaluation over a table of inputs."""

from __future__ import annotations

import re
from functools import reduce
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.calc.units import check_units
from lamina.calc.formula import Formula, column_name


@dataclass(frozen=True)
class Citation:
    source: str
    block: int
    clause: str = ""


@dataclass(frozen=True)
class Row:
    """An input (no formula), possibly with closed options, or a computed value with its provenance."""

    name: str
    formula: str | None = None
    unit: str = ""
    citation: Citation | None = None
    options: tuple[str, ...] = ()
    example: str | float | None = None


@dataclass(frozen=True)
class Gate:
    """A categorical condition: anything but a favourable text, or one that begins with a warning, blocks."""

    name: str
    favourable: tuple[str, ...]
    warning: str | None = None


@dataclass(frozen=True)
class Check:
    """A computed boolean that has to hold."""

    name: str


@dataclass(frozen=True)
class Engine:
    name: str
    rows: tuple[Row, ...]
    gates: tuple[Gate, ...] = ()
    checks: tuple[Check, ...] = ()
    materials: tuple[str, ...] = ()
    dimensions: tuple[tuple[str, ...], ...] = field(default=())

    def declared(self) -> dict[str, Row]:
        out: dict[str, Row] = {}
        for r in self.rows:
            if r.name in out:
                raise ValueError(f"{r.name!r} is declared twice")
            out[r.name] = r
        return out

    def validate(self) -> list[Row]:
        """Computed rows in an order in which each comes after what it reads. Anything undeclared, circular, uncited,
        outside its closed options or of mixed dimensions stops it."""
        rows = self.declared()
        for r in self.rows:
            if r.formula is not None and r.citation is None:
                raise ValueError(f"{r.name!r} is computed without a citation")
            if r.options and r.citation is None:
                raise ValueError(f"the options of {r.name!r} have no citation")
            if r.options and r.example is not None and r.example not in r.options:
                raise ValueError(f"the example of {r.name!r} isn't one of its options")
        for name in [g.name for g in self.gates] + [c.name for c in self.checks] + list(self.materials):
            if name not in rows:
                raise ValueError(f"{name!r} is judged but not declared")
        for chain in self.dimensions:
            for name in chain:
                if name not in rows:
                    raise ValueError(f"{name!r} is selected but not declared")
        order: list[Row] = []
        state: dict[str, int] = {}

        def visit(name: str) -> None:
            if name not in rows:
                raise ValueError(f"{name!r} isn't declared")
            if state.get(name) == 1:
                raise ValueError(f"{name!r} depends on itself")
            if name not in state:
                state[name] = 1
                if rows[name].formula is not None:
                    for below in sorted(Formula(rows[name].formula).names):
                        visit(below)
                    order.append(rows[name])
                state[name] = 2

        for r in self.rows:
            visit(r.name)
        check_units(self)
        return order

    def evaluate(self, inputs: DataFrame) -> DataFrame:
        """``inputs`` with a column for each computed row and ``verdict``; all of it stays one projection."""
        order = self.validate()
        bound: dict[str, Column] = {r.name: F.col(column_name(r.name)) for r in self.rows if r.formula is None}
        missing = [n for n, c in ((r.name, column_name(r.name)) for r in self.rows if r.formula is None) if c not in inputs.columns]
        if missing:
            raise ValueError(f"inputs without a column: {', '.join(missing)}")
        for r in order:
            inputs = inputs.withColumn(column_name(r.name), Formula(r.formula).column(bound))
            bound[r.name] = F.col(column_name(r.name))
        return inputs.withColumn("verdict", self.verdict(bound))

    def verdict(self, bound: dict[str, Column]) -> Column:
        """The first blocking gate speaks; then a missing material value; then whether all checks hold."""
        out = F.lit("PASS") if not self.checks else None
        if out is None:
            held = F.lit(True)
            for c in self.checks:
                held = held & F.coalesce(bound[c.name], F.lit(False))
            out = F.when(held, "PASS").otherwise("REVIEW")
        for name in reversed(self.materials):
            out = F.when(bound[name].isNull(), F.lit(f"MISSING {name}")).otherwise(out)
        for g in reversed(self.gates):
            said = F.coalesce(bound[g.name], F.lit(""))
            fine = said.isin(*g.favourable)
            if g.warning:
                fine = fine | said.startswith(g.warning)
            out = F.when(~fine, F.concat(F.lit("BLOCKED: "), said)).otherwise(out)
        return out


def severity(verdict: Column) -> Column:
    """Green, amber or, by complement, red."""
    return F.when(verdict == "PASS", "GREEN").when(verdict.startswith("REVIEW"), "AMBER").otherwise("RED")


def provenance(engine: Engine, blocks: DataFrame) -> DataFrame:
    """A row for each computed value: its clause, and the text of the block that it cites, if there is one that
    isn't a heading (``found``)."""
    spark = blocks.sparkSession
    cited = [(r.name, r.citation.clause, r.citation.source, r.citation.block) for r in engine.validate()]
    table = spark.createDataFrame(cited, "name string, clause string, source string, block int")
    usable = blocks.where("type <> 'heading'").select("source", "block", F.col("text").alias("cited_text"))
    return table.join(usable, ["source", "block"], "left").withColumn("found", F.col("cited_text").isNotNull())


def inconsistent_verdicts(engine: Engine, evaluated: DataFrame) -> DataFrame:
    """Rows whose stored verdict contradicts what stands beside it. Each verdict is held against what it claims: PASS that
    nothing speaks against, REVIEW that a check fails, MISSING that this value isn't there, BLOCKED that a gate says so; and
    a verdict never passes over what comes before it. Nothing is composed anew."""
    at = lambda name: F.col(column_name(name))
    none = F.lit(False)
    shut = [~(F.coalesce(at(g.name), F.lit("")).isin(*g.favourable) | (F.coalesce(at(g.name), F.lit("")).startswith(g.warning) if g.warning else none)) for g in engine.gates]
    blocked, lost = (reduce(lambda a, b: a | b, x, none) for x in (shut, [at(m).isNull() for m in engine.materials]))
    failed = reduce(lambda a, b: a | b, [~F.coalesce(at(c.name), none) for c in engine.checks], none)
    verdict = F.coalesce("verdict", F.lit(""))
    names_gate = reduce(lambda a, b: a | b, [s & (verdict == F.concat(F.lit("BLOCKED: "), F.coalesce(at(g.name), F.lit("")))) for g, s in zip(engine.gates, shut, strict=True)], none)
    names_value = reduce(lambda a, b: a | b, [at(m).isNull() & (verdict == f"MISSING {m}") for m in engine.materials], none)
    sound = (
        F.when(verdict.startswith("BLOCKED"), names_gate).when(verdict.startswith("MISSING"), names_value & ~blocked)
        .when(verdict == "REVIEW", failed & ~blocked & ~lost).when(verdict == "PASS", ~failed & ~blocked & ~lost).otherwise(none)
    )
    return evaluated.where(~sound)


def fill(template: str, engine: Engine) -> Column:
    """A text in which ``{name}`` stands for the row's value; an undeclared name stops it."""
    rows, parts, at = engine.declared(), [], 0
    for m in re.finditer(r"\{([^{}]+)\}", template):
        if m[1] not in rows:
            raise ValueError(f"{m[1]!r} isn't declared")
        parts += [F.lit(template[at : m.start()]), F.coalesce(F.col(column_name(m[1])).cast("string"), F.lit("?"))]
        at = m.end()
    return F.concat(*parts, F.lit(template[at:]))
