"""Joins that aren't plain equality: bands, prefixes, pages, positions. Each is cut down by an equality first, so
none compares all rows with all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def only_candidate(rows: DataFrame, other: DataFrame, on: list[str], value: str) -> DataFrame:
    """``value`` of the row of ``other`` with the same key, if there is exactly one such row."""
    single = other.groupBy(*on).agg(F.count("*").alias("_n"), F.first(value).alias(value)).where("_n = 1").drop("_n")
    return rows.join(single, on, "left")


def checked_positions(left: DataFrame, right: DataFrame, on: list[str], name: Column, other: Column) -> DataFrame:
    """Rows linked by position; the query stops if a row is missing on one side or the names disagree."""
    both = left.join(right, on, "full")
    agreed = F.coalesce(name.eqNullSafe(other), F.lit(False))
    return both.where(F.when(agreed, True).otherwise(F.raise_error(F.concat_ws(" ", F.lit("rows don't correspond:"), *[F.col(c).cast("string") for c in on])).cast("boolean")))


def in_bands(runs: DataFrame, bands: DataFrame, keys: list[str], slack: float = 3.0) -> DataFrame:
    """``band`` of each run (run_no, x0, x1): that in which its middle lies, else the nearest; bands (band, b0, b1)
    are those of the run's table."""
    middle = (F.col("x0") + F.col("x1")) / 2
    far = F.greatest(F.col("b0") - middle, middle - F.col("b1"), F.lit(0.0))
    order = F.struct((far > slack).alias("out"), far.alias("far"), "band")
    best = runs.join(bands, keys).groupBy(*keys, "run_no").agg(F.min(order).alias("_best"))
    return runs.join(best, [*keys, "run_no"]).withColumn("band", F.col("_best.band")).drop("_best")


def caption_above(tables: DataFrame, captions: DataFrame, page: str = "page", slack: float = 2.0) -> DataFrame:
    """The lowest caption on the page that ends above the table's top."""
    pairs = tables.join(captions, page).where(F.col("bottom") <= F.col("top") + slack)
    best = pairs.groupBy("table_id").agg(F.max_by("caption", F.struct("bottom", "caption")).alias("caption"))
    return tables.join(best, "table_id", "left")


def footnotes(tables: DataFrame, blocks: DataFrame, page: str = "page") -> DataFrame:
    """table_id and text of the blocks that stand below a table on its page, each text once."""
    return tables.join(blocks, page).where(F.col("block_top") >= F.col("bottom")).select("table_id", "text").distinct()


def longest_prefix(names: DataFrame, entries: DataFrame, name: str, entry: str, marks: str = "_.-") -> DataFrame:
    """The longest entry that begins a name and ends at one of ``marks`` or at its end.

    Names are exploded into their own prefixes, so the join is one of equality.
    """
    ends = F.filter(F.sequence(F.lit(1), F.length(name)), lambda i: (i == F.length(name)) | F.lit(marks).contains(F.substr(F.col(name), i + 1, F.lit(1))))
    prefixes = names.select(name, F.explode(F.transform(ends, lambda i: F.substr(F.col(name), F.lit(1), i))).alias(entry))
    found = prefixes.join(entries.select(entry).distinct(), entry).groupBy(name).agg(F.max_by(entry, F.length(entry)).alias(entry))
    return names.join(found, name, "left")


def near_page(wanted: DataFrame, pages: DataFrame, key: str, back: int = 2, ahead: int = 12) -> DataFrame:
    """The page nearest to the expected one (key, page, text) whose text has it, from ``back`` before to
    ``ahead`` after; pages are (page, page_text)."""
    spread = wanted.withColumn("_at", F.explode(F.sequence(F.col("page") - back, F.col("page") + ahead)))
    hits = spread.join(pages.select(F.col("page").alias("_at"), "page_text"), "_at").where(F.contains("page_text", "text"))
    best = hits.groupBy(key).agg(F.min_by("_at", F.struct(F.abs(F.col("_at") - F.col("page")), "_at")).alias("found_page"))
    return wanted.join(best, key, "left")


def words_found(wanted: Column, page_text: Column, least: int = 5) -> Column:
    """How a text that isn't on its page as it stands is there: by the share of its long words."""
    long_ = F.filter(F.split(F.lower(wanted), r"\W+"), lambda w: F.length(w) >= least)
    share = F.try_divide(F.size(F.filter(long_, lambda w: F.contains(F.lower(page_text), w))), F.size(long_))
    return F.when(F.contains(page_text, wanted), "FOUND").when(share >= 0.95, "REFORMATTED").when(share >= 0.6, "PARTIAL").otherwise("MISSING")


def dimension_lookup(asked: DataFrame, bases: DataFrame | dict[str, DataFrame]) -> DataFrame:
    """Dimensions by standard, size and schedule, in the unit that is asked for. ``bases``: one table with a ``standard``,
    or a table for each of a few standards."""
    if isinstance(bases, dict):
        parts = [base.withColumn("standard", F.lit(standard)) for standard, base in bases.items()]
        bases = reduce(DataFrame.unionByName, parts)
    found = asked.join(bases, ["standard", "nps", "schedule"], "left")
    pick = lambda x: F.when(F.col("units") == "SI", F.col(f"{x}_mm")).otherwise(F.col(f"{x}_in"))
    return found.select(*asked.columns, pick("od").alias("od"), pick("t").alias("t"))


def zipped(left: DataFrame, right: DataFrame, key: list[str], position: str, numbers: str) -> DataFrame:
    """Rows paired by position with ``agree``: whether their numbers are the same; names may differ."""
    other = right.withColumnRenamed(numbers, "_numbers")
    return left.join(other, [*key, position], "full").withColumn("agree", F.col(numbers).eqNullSafe(F.col("_numbers"))).drop("_numbers")


def section_parents(sections: DataFrame, number: str = "number") -> DataFrame:
    """``parent``: the longest dotted prefix of a section's number that is itself a section, with ``depth``."""
    parts = F.split(number, r"\.")
    above = sections.select(number, F.explode(F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.when(i > 0, F.array_join(F.slice(parts, 1, i), ".")))).alias("parent"))
    known = above.where("parent is not null").join(sections.select(F.col(number).alias("parent")).distinct(), "parent")
    best = known.groupBy(number).agg(F.max_by("parent", F.length("parent")).alias("parent"))
    return sections.join(best, number, "left").withColumn("depth", F.size(parts))


def subset_pairs(rows: DataFrame, key: str, members: str, group: str) -> DataFrame:
    """Pairs within a group in which the members of the first are strictly among those of the second."""
    a = rows.select(group, F.col(key).alias("small"), F.col(members).alias("_a"))
    b = rows.select(group, F.col(key).alias("large"), F.col(members).alias("_b"))
    inside = (F.size(F.array_except("_a", "_b")) == 0) & (F.size(F.array_except("_b", "_a")) > 0)
    return a.join(b, group).where((F.col("small") != F.col("large")) & inside).select(group, "small", "large")


def previous_is(rows: DataFrame, keys: list[str], order: list[str], column: str, value: str) -> Column:
    return F.coalesce(F.lag(column).over(Window.partitionBy(*keys).orderBy(*order)) == value, F.lit(False))
