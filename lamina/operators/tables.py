"""Meaning of reconstructed tables: what is header and what data, composition and strength, notes, twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions.text import element, gauge_base, is_value, label_and_qualifier, note_mark, property_of, tokens, unspaced


def is_requirement(cell: Column) -> Column:
    """At least half of a cell's words are values."""
    words = tokens(cell)
    return (F.size(words) > 0) & (F.size(F.filter(words, is_value)) * 2 >= F.size(words))


def mostly_values(cells: Column) -> Column:
    filled = F.filter(cells, lambda c: F.coalesce(F.trim(c), F.lit("")) != "")
    return (F.size(filled) > 0) & (F.size(F.filter(filled, is_requirement)) * 2 >= F.size(filled))


def split_header(rows: DataFrame, keys: list[str], order: str, cells: str) -> DataFrame:
    """``is_data``: from the first row on whose cells are mostly values; what stands before is the header."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("is_data", F.max(mostly_values(F.slice(F.col(cells), 2, F.greatest(F.size(cells) - 1, F.lit(0)))).cast("int")).over(w) == 1)


def column_names(header: DataFrame, keys: list[str], order: str, cells: str) -> DataFrame:
    """Header rows stacked into one name for each column."""
    long = header.select(*keys, order, F.posexplode(cells).alias("column_no", "part")).where("trim(part) <> ''")
    name = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "part"))), lambda x: x["part"]), " ")
    return long.groupBy(*keys, "column_no").agg(name.alias("name"))


def drop_empty(rows: DataFrame, identification: list[str], values: list[str]) -> DataFrame:
    """Rows without any identification and value go; how many went is for the caller to check."""
    return rows.where(F.coalesce(*[F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in identification + values]).isNotNull())


def first_named(df: DataFrame, aliases: list[str]) -> Column:
    """A field under whichever of its spellings the table has."""
    present = [F.col(a) for a in aliases if a in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def composition(cells: DataFrame, keys: list[str], grade: str, label: str, value: str, symbols: list[str]) -> DataFrame:
    """One row for each grade and a column for each element; several values of one element are joined, and labels
    that name no known element are kept in ``others``. Orientation doesn't matter: cells are (grade, label, value)."""
    named = cells.where(F.trim(value) != "").withColumn("_symbol", element(F.col(label)))
    known = named.withColumn("_symbol", F.when(F.col("_symbol").isin(*symbols), F.col("_symbol")))
    joined = F.array_join(F.array_sort(F.collect_list(F.col(value))), " / ")
    wide = known.where("_symbol is not null").groupBy(*keys, grade).pivot("_symbol", symbols).agg(joined)
    others = known.where("_symbol is null").groupBy(*keys, grade).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", label, value))), "; ").alias("others"))
    blank = [F.nullif(F.col(s), F.lit("")).alias(s) for s in symbols]
    return wide.select(*keys, grade, *blank).join(others, [*keys, grade], "full")


def fully_named(headers: DataFrame, keys: list[str], label: str, resolved: Column) -> DataFrame:
    """Tables all of whose headers resolve; others stay as printed."""
    return headers.groupBy(*keys).agg(F.bool_and(resolved.isNotNull()).alias("closed"), F.array_sort(F.collect_set(F.when(resolved.isNull(), F.col(label)))).alias("unresolved"))


def strength(cells: DataFrame, keys: list[str], grade: str, label: str, value: str, properties: list[str]) -> DataFrame:
    """Tensile requirements: a column for each of ``properties``, values as printed. A property is one that
    ``property_of`` knows, or with its qualifier (``tensile_max``; without one it counts as a minimum). ``gauge``: the
    lengths over which elongations were measured."""
    kind, of = property_of(F.col(label)), label_and_qualifier(F.col(label))["qualifier"]
    names = F.array(kind, F.concat_ws("_", kind, F.coalesce(of, F.lit("min"))))
    named = cells.where(kind.isNotNull()).withColumn("_gauge", F.when(kind == "elongation", gauge_base(F.col(label))))
    gauges = named.groupBy(*keys, grade).agg(F.nullif(F.array_join(F.array_sort(F.collect_set("_gauge")), " / "), F.lit("")).alias("gauge"))
    values = named.withColumn("_property", F.explode(names)).groupBy(*keys, grade).pivot("_property", properties).agg(F.array_join(F.array_sort(F.collect_list(value)), " / "))
    return values.join(gauges, [*keys, grade])


def note_regions(lines: DataFrame, keys: list[str], order: list[str], opens: Column, closes: Column, text: str) -> DataFrame:
    """Notes within regions: a region opens at its anchor and closes at the next label; a mark begins a note."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    state = F.last(F.when(opens, F.lit(True)).when(closes, F.lit(False)), ignorenulls=True).over(w)
    inside = lines.withColumn("_in", F.coalesce(state, F.lit(False)) & ~opens).where("_in")
    mark = note_mark(F.col(text))
    numbered = inside.withColumn("_note", F.sum(mark.isNotNull().cast("int")).over(w)).withColumn("_mark", F.last(mark, ignorenulls=True).over(w))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("_t")))), lambda x: x["_t"]), " ")
    return numbered.groupBy(*keys, "_note").agg(F.first("_mark").alias("note"), joined.alias("text")).drop("_note")


def repeated_notes(members: DataFrame, group: str, note: str, member: str) -> DataFrame:
    """Different notes of a group with the same members."""
    sets = members.groupBy(group, note).agg(F.array_sort(F.collect_set(member)).alias("members"))
    return sets.groupBy(group, "members").agg(F.array_sort(F.collect_list(note)).alias("notes")).where(F.size("notes") > 1)


def twin_class(a: Column, b: Column) -> Column:
    """The strictest of five ways in which two texts are the same, else DIFFERENT."""
    low = lambda c: F.lower(unspaced(c))
    bare = lambda c: F.regexp_replace(low(c), r"[^a-z0-9.]", "")
    digits = lambda c: F.regexp_replace(c, r"[^0-9.]", "")
    return (
        F.when(a == b, "IDENTICAL").when(unspaced(a) == unspaced(b), "SPACES").when(low(a) == low(b), "CASE").when(bare(a) == bare(b), "MARKS")
        .when((digits(a) == digits(b)) & (digits(a) != ""), "NUMBERS").otherwise("DIFFERENT")
    )


def twin_names(names: DataFrame, name: str) -> DataFrame:
    """``table_x`` with ``table_table_x``."""
    doubled = names.where(F.col(name).startswith("table_table_")).select(F.col(name).alias("twin"), F.expr(f"substring({name}, 7)").alias(name))
    return names.join(doubled, name).select(name, "twin")


def bands_by_gap(rows: DataFrame, keys: list[str], x: str, gap: float = 40.0) -> DataFrame:
    """``band``: a new one wherever the step to the next position is wider than ``gap``."""
    w = Window.partitionBy(*keys).orderBy(x)
    new = F.coalesce((F.col(x) - F.lag(x).over(w) > gap).cast("int"), F.lit(0))
    return rows.withColumn("_new", new).withColumn("band", F.sum("_new").over(w.rangeBetween(Window.unboundedPreceding, 0))).drop("_new")


def markdown(checks: DataFrame) -> list[str]:
    """The report of a few checks as lines of text."""
    rows = checks.orderBy("name").collect()  # one row for each check
    return ["| check | violations |", "|---|---|", *(f"| {r.name} | {r.violations} |" for r in rows), f"Total: {sum(r.violations for r in rows)}"]


def states(df: DataFrame, state: str) -> DataFrame:
    """Rows in each state, most first."""
    return df.groupBy(state).agg(F.count("*").alias("n")).orderBy(F.desc("n"), state)


def dehyphenated(words: DataFrame, vocabulary: DataFrame, key: str, word: str) -> DataFrame:
    """``joined``: a broken word without its hyphen where that is a word of the vocabulary, else as it stands."""
    bare = words.withColumn("_bare", F.replace(F.col(word), F.lit("-"), F.lit("")))
    known = vocabulary.select(F.lower("word").alias("_known")).distinct()
    found = bare.join(known, F.lower("_bare") == F.col("_known"), "left")
    return found.withColumn("joined", F.when(F.col("_known").isNotNull(), F.col("_bare")).otherwise(F.col(word))).drop("_bare", "_known")
