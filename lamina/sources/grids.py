"""HTML tables as grids: spans of rows and columns expanded, headings carried down, columns read one by one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions.text import strip_tags

_CELL = "struct<row: int, col: int, rows: int, cols: int, head: boolean, raw: string>"
#: What HTML allows a span to be, at most.
WIDEST, DEEPEST = 1_000, 65_534


def _span(attributes: Column, name: str, most: int) -> Column:
    n = F.regexp_extract(attributes, rf"(?i)\b{name}\s*=\s*[\"']?\s*(\d{{1,6}})", 1).try_cast("int")
    return F.least(F.greatest(F.coalesce(n, F.lit(1)), F.lit(1)), F.lit(most))


def _placed(table: Column) -> Column:
    """Cells of one table with the place where each begins. Row by row, a cell takes the first place that no cell before
    it and none that reaches down from above has."""
    rows = F.regexp_extract_all(table, F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=</tr|<tr\b|\z)"), F.lit(1))
    state = f"struct<at: int, down: array<struct<col: int, upto: int>>, out: array<{_CELL}>>"

    def row(acc: Column, html: Column) -> Column:
        cells = F.regexp_extract_all(html, F.lit(r"(?is)<(?:td|th)\b(?:.*?)(?=<td\b|<th\b|\z)"), F.lit(0))
        taken = F.transform(F.filter(acc["down"], lambda d: d["upto"] >= acc["at"]), lambda d: d["col"])

        def cell(own: Column, raw: Column) -> Column:
            tag = F.regexp_extract(raw, r"(?is)^<(t[dh]\b[^>]*)>", 1)
            free = F.array_min(F.array_except(F.sequence(own["next"], own["next"] + F.size(taken)), taken))
            rows_, cols = _span(tag, "rowspan", DEEPEST), _span(tag, "colspan", WIDEST)
            body = F.regexp_replace(raw, r"(?is)^<t[dh]\b[^>]*>|</t[dh]\s*>.*$", "")
            placed = F.struct(acc["at"].alias("row"), free.alias("col"), rows_.alias("rows"), cols.alias("cols"), F.lower(tag).startswith("th").alias("head"), body.alias("raw"))
            return F.struct((free + cols).alias("next"), F.concat(own["cells"], F.array(placed)).alias("cells"))

        own = F.aggregate(cells, F.struct(F.lit(0).alias("next"), F.array().cast(f"array<{_CELL}>").alias("cells")), cell, lambda s: s["cells"])
        deep = F.flatten(F.transform(F.filter(own, lambda c: c["rows"] > 1), lambda c: F.transform(F.sequence(c["col"], c["col"] + c["cols"] - 1), lambda k: F.struct(k.alias("col"), (c["row"] + c["rows"] - 1).alias("upto")))))
        still = F.filter(acc["down"], lambda d: d["upto"] > acc["at"])
        return F.struct((acc["at"] + 1).alias("at"), F.concat(still, deep).alias("down"), F.concat(acc["out"], own).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<col: int, upto: int>>").alias("down"), F.array().cast(f"array<{_CELL}>").alias("out")).cast(state)
    return F.aggregate(rows, start, row, lambda s: F.struct(s["at"].alias("n_rows"), s["out"].alias("cells")))


def grid_cells(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, table_no, row_no, col_no, text, head (a header cell), spans (how many columns its cell covers) and ``origin``
    (whether the cell begins here) of every place of every table.

    A cell that spans stands in every place that it covers, as far as the table has rows. Pages without tables give
    nothing; a null page neither; tables within tables are part of their cell's text.
    """
    tables = pages.select(key, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(r"(?is)<table\b[^>]*>(.*?)</table>"), F.lit(1))).alias("table_no", "_table"))
    placed = tables.select(key, "table_no", _placed(F.col("_table")).alias("_t")).select(key, "table_no", "_t.n_rows", F.explode("_t.cells").alias("c"))
    down = placed.withColumn("row_no", F.explode(F.sequence("c.row", F.least(F.col("c.row") + F.col("c.rows"), F.col("n_rows")) - 1)))
    every = down.withColumn("col_no", F.explode(F.sequence("c.col", F.col("c.col") + F.col("c.cols") - 1)))
    origin = (F.col("row_no") == F.col("c.row")) & (F.col("col_no") == F.col("c.col"))
    return every.select(key, "table_no", "row_no", "col_no", F.coalesce(strip_tags(F.col("c.raw")), F.lit("")).alias("text"), F.col("c.head").alias("head"), F.col("c.cols").alias("spans"), origin.alias("origin"))


def heading_paths(rows: DataFrame, keys: list[str], order: list[str], level: str, title: str) -> DataFrame:
    """``path`` of every row: the titles of the headings that it stands below, outermost first.

    ``level``: 0 for the outermost headings, null for rows that are none. A heading ends those of its level and deeper ones
    before it; a row belongs to what is open above it, over the ends of pages too, as ``order`` runs through all of a
    group. Levels are few: there is one running value for each of up to ``LEVELS``.
    """
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    numbered = rows.withColumn("_n", nth)
    marks = {f"_h{k}": F.max(F.when(F.col(level) == k, F.struct("_n", F.col(title).alias("t")))).over(w) for k in range(LEVELS)}
    opened = numbered.withColumns(marks)
    path, newest = [], F.lit(0)
    for k in range(LEVELS):
        mark = F.col(f"_h{k}")
        outer = F.col(level).isNull() | (F.col(level) > k)
        path.append(F.when((mark["_n"] > newest) & outer, mark["t"]))
        newest = F.greatest(newest, F.coalesce(mark["_n"], F.lit(0)))
    return opened.withColumn("path", F.array_compact(F.array(*path))).drop("_n", *marks)


#: Levels of headings that a path may have.
LEVELS = 6


def members_by_column(grid: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys and ``members``: texts of a table that is read column by column, each cell once, gaps left out."""
    filled = grid.where(F.col("origin") & (F.col(text) != ""))
    ordered = F.array_sort(F.collect_list(F.struct("col_no", "row_no", F.col(text).alias("t"))))
    return filled.groupBy(*keys).agg(F.transform(ordered, lambda x: x["t"]).alias("members"))
