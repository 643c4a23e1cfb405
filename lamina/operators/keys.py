"""Row identity and ordered idioms. Row order is data here, so every function takes the column that holds it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions.text import blank_to_null


def material_id(*parts: str) -> Column:
    return F.concat_ws(" | ", *[blank_to_null(F.col(p).cast("string")) for p in parts])


def disambiguate(df: DataFrame, key: str, tiers: list[tuple[str, str]], line: str) -> DataFrame:
    """Append ``label value`` tier by tier to keys that are still shared and have a value, and at last the line.

    ``resolved_by``: the tier after which a key was unique (0: from the start).
    """
    out = df.withColumn("unique_id", F.col(key)).withColumn("resolved_by", F.lit(None).cast("int"))
    alone = lambda: F.count("*").over(Window.partitionBy("unique_id")) == 1
    for i, (label, column) in enumerate(tiers, 1):
        out = out.withColumn("alone", alone())
        out = out.withColumn("resolved_by", F.coalesce("resolved_by", F.when(F.col("alone"), i - 1)))
        value = blank_to_null(F.col(column).cast("string"))
        out = out.withColumn("unique_id", F.when(~F.col("alone") & value.isNotNull(), F.concat("unique_id", F.lit(f" {label} "), value)).otherwise(F.col("unique_id")))
    out = out.withColumn("alone", alone())
    out = out.withColumn("resolved_by", F.coalesce("resolved_by", F.when(F.col("alone"), len(tiers)), F.lit(len(tiers) + 1)))
    return make_unique(out, "unique_id", line).drop("alone")


def make_unique(df: DataFrame, key: str, line: str) -> DataFrame:
    """The first row keeps its name; later ones get `` #line``."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(line))
    return df.withColumn("_n", n).withColumn(key, F.when(F.col("_n") > 1, F.concat(key, F.lit(" #"), F.col(line).cast("string"))).otherwise(F.col(key))).drop("_n")


def with_ordinal(df: DataFrame, keys: list[str], line: list[str]) -> DataFrame:
    """Position among rows of the same key, which links two editions."""
    return df.withColumn("ordinal", F.row_number().over(Window.partitionBy(*keys).orderBy(*line)))


def link_editions(left: DataFrame, right: DataFrame, keys: list[str], line: list[str]) -> DataFrame:
    """Each row of ``left`` with the row of ``right`` of the same key and ordinal, if there is one."""
    return with_ordinal(left, keys, line).join(with_ordinal(right, keys, line).drop(*line), [*keys, "ordinal"], "left")


def islands(df: DataFrame, keys: list[str], value: Column, order: list[str]) -> DataFrame:
    """``island``: number of the run of equal values that a row belongs to, from 1."""
    w = Window.partitionBy(*keys).orderBy(*order)
    changed = F.coalesce((~value.eqNullSafe(F.lag(value).over(w))).cast("int"), F.lit(1))
    first = F.row_number().over(w) == 1
    marked = df.withColumn("_new", F.when(first, 1).otherwise(changed))
    return marked.withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def broken_blocks(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """Values whose rows don't stand together: more runs than one."""
    runs = islands(df, keys, F.col(value), order).groupBy(*keys, value).agg(F.countDistinct("island").alias("runs"))
    return runs.where("runs > 1")


def carry_forward(df: DataFrame, keys: list[str], column: str, order: list[str]) -> Column:
    """The last value printed above, for rows that leave it empty."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(F.col(column), ignorenulls=True).over(w)


def fold(df: DataFrame, keys: list[str], starts: Column, text: str, order: list[str], mark: str = " ") -> DataFrame:
    """Join continuation rows to the row that they continue; ``starts`` marks rows that begin a new one."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    numbered = df.withColumn("fold", F.sum(starts.cast("int")).over(w))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("_t")))), lambda x: x["_t"]), mark)
    return numbered.groupBy(*keys, "fold").agg(F.count("*").alias("parts"), joined.alias(text))


def cascade(df: DataFrame, levels: list[str], chosen: list) -> DataFrame:
    """What can be chosen at the next level, given the choices above it."""
    for column, value in zip(levels, chosen, strict=False):
        df = df.where(F.col(column).eqNullSafe(F.lit(value)))
    return df.select(levels[len(chosen)]).distinct()


def select_level(selection: dict[str, str | None], levels: list[str], level: str, value: str | None) -> dict[str, str | None]:
    """A choice at one level clears those below it and needs those above it."""
    at = levels.index(level)
    if any(selection.get(x) is None for x in levels[:at]):
        raise ValueError(f"{level} needs a choice at every level above it")
    return {x: value if x == level else selection.get(x) if i < at else None for i, x in enumerate(levels)}
