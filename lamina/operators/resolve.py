"""Lookups that never guess: a tier resolves a row only if it leaves exactly one candidate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def resolve(rows: DataFrame, key: str, tiers: list[tuple[str, DataFrame, list[str]]], result: str) -> DataFrame:
    """``result`` from the first tier (name, candidates with the join columns and ``result``, join columns) that
    has a single distinct candidate for the row; ``state`` names the tier, or AMBIGUOUS or UNMAPPED.

    Candidates are reduced to one row for each key before the join, so no tier multiplies rows.
    """
    for i, (_, candidates, on) in enumerate(tiers):
        one = candidates.where(F.col(result).isNotNull()).groupBy(*on).agg(F.min(result).alias(f"_r{i}"), (F.min(result) == F.max(result)).alias(f"_one{i}"))
        rows = rows.join(one, on, "left")
    n = range(len(tiers))
    single = [F.when(F.col(f"_one{i}"), F.col(f"_r{i}")) for i in n]
    names = [F.when(F.col(f"_one{i}"), F.lit(tiers[i][0])) for i in n]
    seen = F.coalesce(*[F.col(f"_r{i}") for i in n]).isNotNull()
    return (
        rows.withColumn(result, F.coalesce(*single))
        .withColumn("state", F.coalesce(*names, F.when(seen, F.lit("AMBIGUOUS")), F.lit("UNMAPPED")))
        .drop(*[f"_r{i}" for i in n], *[f"_one{i}" for i in n])
    )


def first_rule(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    """Ordered classifier: the first condition that holds decides."""
    return F.coalesce(*[F.when(c, F.lit(name)) for c, name in rules], F.lit(otherwise))


def nearest_above(rows: DataFrame, keys: list[str], order: list[str], marked: Column, value: str) -> DataFrame:
    """The value of the last marked row before each row."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("above", F.last(F.when(marked, F.col(value)), ignorenulls=True).over(w))


def attach_notes(rows: DataFrame, key: str, cited: Column, notes: DataFrame) -> DataFrame:
    """``note_texts``: texts of the notes that each row cites, joined in the order of their numbers; ``notes_missing``: the
    cited notes that have no text."""
    long = rows.select(key, F.explode(cited).alias("note")).join(notes.select("note", "text"), "note", "left")
    found = F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("note", "text"))))
    texts = F.nullif(F.array_join(F.transform(found, lambda x: x["text"]), " · "), F.lit(""))
    lost = F.array_sort(F.collect_set(F.when(F.col("text").isNull(), F.col("note"))))
    return rows.join(long.groupBy(key).agg(texts.alias("note_texts"), lost.alias("notes_missing")), key, "left")


def literal_patch(rows: DataFrame, patch: DataFrame, on: list[str], column: str) -> DataFrame:
    """Replace ``column`` by ``replacement`` (null too) where the patch has the row's key.

    A repair never rewrites what it wasn't written for, and none goes astray. The query stops if what stands there isn't
    ``expected``, if the patch has a key twice, and if the table hasn't a key of the patch.
    """
    once = patch.groupBy(*on).agg(F.count("*").alias("_times"), F.first("expected").alias("expected"), F.first("replacement").alias("replacement"))
    both = rows.withColumn("_there", F.lit(True)).join(once, on, "full")
    stop = lambda what, *c: F.raise_error(F.concat_ws(" ", F.lit(what), *[F.coalesce(x.cast("string"), F.lit("null")) for x in c])).cast(dict(rows.dtypes)[column])
    key = [F.col(c) for c in on]
    new = (
        F.when(F.col("_times").isNull(), F.col(column)).when(F.col("_there").isNull(), stop("no row for the patch of", *key)).when(F.col("_times") > 1, stop("patched twice:", *key))
        .when(~F.col(column).eqNullSafe(F.col("expected")), stop("unexpected value:", F.col(column))).otherwise(F.col("replacement"))
    )
    return both.withColumn(column, new).select(*rows.columns)


def first_match(rows: DataFrame, keys: list[str], order: list[str], condition: Column, *columns: str) -> DataFrame:
    """The first row of each group for which a condition holds: what is looked for by its content, not its place.
    Groups without one are left out; ``required`` turns that into an error."""
    return rows.where(condition).groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_m")).select(*keys, "_m.*")


def required(wanted: DataFrame, found: DataFrame, on: list[str], value: str, what: str) -> DataFrame:
    """``wanted`` with ``value`` of ``found``; a row without one stops the query."""
    both = wanted.join(found.select(*on, value), on, "left")
    missing = F.raise_error(F.concat_ws(" ", F.lit(f"no {what} for"), *[F.col(c).cast("string") for c in on])).cast(dict(found.dtypes)[value])
    return both.withColumn(value, F.when(F.col(value).isNull(), missing).otherwise(F.col(value)))


def by_prefix(wanted: DataFrame, rows: DataFrame, prefix: str, name: str, order: str) -> DataFrame:
    """``name`` of the first row whose name begins with each prefix. Prefixes have few lengths, so rows are cut to
    these and joined by equality."""
    lengths = [r[0] for r in wanted.select(F.length(prefix)).distinct().collect()]
    if not lengths:
        return wanted.withColumn(name, F.lit(None).cast("string"))
    cut = rows.select(F.explode(F.array_distinct(F.array(*[F.substring(name, 1, n) for n in lengths]))).alias(prefix), name, order)
    first = cut.groupBy(prefix).agg(F.min_by(name, order).alias(name))
    return wanted.join(first, prefix, "left")


def unbacked(citations: DataFrame, members: DataFrame, on: list[str]) -> DataFrame:
    """Citations that no member of a table backs."""
    return citations.join(members.select(*on).distinct(), on, "left_anti")


def page_halves(left: DataFrame, right: DataFrame, line: list[str], order: str) -> DataFrame:
    """Rows of a table that is printed over two facing pages, by line. Lines with equal labels belong together in their
    ``order``, first with first (``nth``); a half without its other one keeps nulls, and ``half`` says which one is missing."""
    nth = lambda df: df.withColumn("nth", F.row_number().over(Window.partitionBy(*line).orderBy(order))).drop(order)
    both = nth(left).withColumn("_left", F.lit(True)).join(nth(right).withColumn("_right", F.lit(True)), [*line, "nth"], "full")
    half = F.when(F.col("_right").isNull(), F.lit("RIGHT")).when(F.col("_left").isNull(), F.lit("LEFT"))
    return both.withColumn("half", half).drop("_left", "_right")


def mapping_state(row_state: Column, candidates: Column) -> Column:
    """CLOSED if nothing more can be found for a row, OPEN if its candidates only have to be told apart."""
    return F.when(row_state == "AMBIGUOUS", "OPEN").when((row_state == "UNMAPPED") & (candidates > 0), "OPEN").otherwise("CLOSED")
