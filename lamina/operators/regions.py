"""Joins of intervals and boxes that overlap. Both sides are cut into cells of fixed width and meet by equality of cells; the
exact test follows. A pair is formed in the first cell that both have and nowhere else, so nothing is repeated and
nothing has to be made distinct. What stands in no cell together is never compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.session import kept

#: Points, about the size of a printed cell: larger cells compare more, smaller ones repeat wide boxes more often.
CELL = 64.0


def _cells(a: Column, b: Column, cell: float) -> Column:
    return F.sequence(F.floor(a / cell), F.floor(F.greatest(a, b) / cell))


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], of: tuple[str, str], with_: tuple[str, str], least: float = 0.0, cell: float = CELL) -> DataFrame:
    """Pairs of intervals of the same ``keys`` that share more than ``least`` (or touch, if it is 0). Columns of both sides
    have names of their own, the keys aside. Intervals with a null end meet nothing."""
    (a0, a1), (b0, b1) = of, with_
    cut = left.withColumn("_cell", F.explode(_cells(F.col(a0), F.col(a1), cell)))
    other = right.withColumn("_cell", F.explode(_cells(F.col(b0), F.col(b1), cell)))
    shared = F.least(a1, b1) - F.greatest(a0, b0)
    first = F.col("_cell") == F.greatest(F.floor(F.col(a0) / cell), F.floor(F.col(b0) / cell))
    return cut.join(other, [*keys, "_cell"]).where(first & ((shared > least) if least else (shared >= 0))).drop("_cell")


def touching(left: DataFrame, right: DataFrame, keys: list[str], of: str, with_: str, cell: float = CELL) -> DataFrame:
    """Pairs of boxes (structs of x0, y0, x1, y1) of the same ``keys`` that share a point. Names as in ``overlapping``."""
    a, b = F.col(of), F.col(with_)

    def cut(df: DataFrame, box: Column) -> DataFrame:
        return df.withColumn("_x", F.explode(_cells(box["x0"], box["x1"], cell))).withColumn("_y", F.explode(_cells(box["y0"], box["y1"], cell)))

    first = (F.col("_x") == F.floor(F.greatest(a["x0"], b["x0"]) / cell)) & (F.col("_y") == F.floor(F.greatest(a["y0"], b["y0"]) / cell))
    meet = (F.least(a["x1"], b["x1"]) >= F.greatest(a["x0"], b["x0"])) & (F.least(a["y1"], b["y1"]) >= F.greatest(a["y0"], b["y0"]))
    return cut(left, a).join(cut(right, b), [*keys, "_x", "_y"]).where(first & meet).drop("_x", "_y")


def outside(boxes: DataFrame, regions: DataFrame, keys: list[str], box: str, region: str, cell: float = CELL) -> DataFrame:
    """Boxes whose middle lies in no region of the same ``keys``. A middle stands in one cell, so only regions are repeated: each
    in the grid whose cells are at least as wide and high as it is (``cell``, or four times that of the grid before), so it has
    four cells at most. Boxes pass the grids that have any region one after the other."""
    r, b = F.col("_region"), F.col(box)
    side = F.greatest(r["x1"] - r["x0"], r["y1"] - r["y0"], F.lit(cell))
    sized = regions.select(*keys, F.col(region).alias("_region")).withColumn("_grid", F.ceil(F.log(4.0, side / cell) - 1e-9))
    left = boxes.withColumns({"_mx": (b["x0"] + b["x1"]) / 2, "_my": (b["y0"] + b["y1"]) / 2})
    for grid in sorted(x[0] for x in sized.select("_grid").distinct().collect() if x[0] is not None):
        size = cell * 4.0**grid
        cut = sized.where(F.col("_grid") == grid).select(*keys, "_region").distinct().withColumn("_x", F.explode(_cells(r["x0"], r["x1"], size))).withColumn("_y", F.explode(_cells(r["y0"], r["y1"], size)))
        placed = left.withColumns({"_x": F.floor(F.col("_mx") / size), "_y": F.floor(F.col("_my") / size)})
        condition = F.col("_mx").between(r["x0"], r["x1"]) & F.col("_my").between(r["y0"], r["y1"])
        for k in [*keys, "_x", "_y"]:
            condition = (F.col(f"b.{k}") == F.col(f"r.{k}")) & condition
        left = placed.alias("b").join(cut.alias("r"), condition, "left_anti").drop("_x", "_y")
    return left.drop("_mx", "_my")


def carried_over(regions: DataFrame, keys: list[str], page: str, region: str, continues: str, top: float, last: DataFrame) -> DataFrame:
    """Regions, and for each that ``continues`` the strip from ``top`` down to where its run ends on the page after.

    ``last``: keys, page and ``ends``, the height at which a continued region of the page before ends (a page that isn't
    listed isn't covered)."""
    r = F.col(region)
    next_page = regions.where(continues).select(*keys, (F.col(page) + 1).alias(page), r["x0"].alias("_x0"), r["x1"].alias("_x1")).join(last, [*keys, page])
    strip = F.struct(F.col("_x0").alias("x0"), F.lit(top).alias("y0"), F.col("_x1").alias("x1"), F.col("ends").alias("y1"))
    return regions.select(*keys, page, region).unionByName(next_page.select(*keys, page, strip.alias(region)))


def header_columns(runs: DataFrame, columns: DataFrame, keys: list[str], cell: float = CELL, same_center: float = 45.0) -> DataFrame:
    """keys, column_no, ``label`` and ``banners`` of every column of a table, from where the runs of its head stand.

    ``runs``: keys, line (from the top), x0, x1, text; ``columns``: keys, column_no, b0, b1. A run belongs to all columns
    that it overlaps by more than a point: to one as its label, to several as a banner over them. The line below a banner
    continues it if it is a banner too and has the same centre within ``same_center``: then it covers what either covers,
    and both texts are one. Labels are joined from the top; a label that ends in a dash is joined without it.
    """
    meet = overlapping(runs.select(*keys, "line", "x0", "x1", "text"), columns.select(*keys, "column_no", "b0", "b1"), keys, ("x0", "x1"), ("b0", "b1"), 1.0, cell)
    run = [*keys, "line", "x0", "x1", "text"]
    # three steps read where runs stand: it is written to the shared folder once
    wide = kept(meet.groupBy(*run).agg(F.array_sort(F.collect_set("column_no")).alias("over")), "heads")
    piece = F.struct(F.struct("line", "x0").alias("_name"), ((F.col("x0") + F.col("x1")) / 2).alias("_center"), "text", "over")
    heads = wide.where(F.size("over") > 1).groupBy(*keys).agg(F.collect_list(piece).alias("_all"))
    folded = heads.select(*keys, F.explode(_chains(_with_upper(F.col("_all"), same_center))).alias("c"))
    banners = folded.select(*keys, F.explode(F.array_distinct("c.over")).alias("column_no"), F.struct(F.col("c.order").alias("_order"), F.col("c.text").alias("text")).alias("_over"))
    single = wide.where(F.size("over") == 1).select(*keys, F.get("over", F.lit(0)).alias("column_no"), F.struct("line", "x0", "text").alias("_part"))
    texts = lambda c: F.transform(F.array_sort(F.collect_list(c)), lambda x: x["text"])
    said = single.unionByName(banners, allowMissingColumns=True).groupBy(*keys, "column_no").agg(texts("_part").alias("_parts"), texts("_over").alias("_banners"))
    label = F.aggregate("_parts", F.lit(""), lambda a, t: F.when(a == "", t).when(a.endswith("-"), F.concat(F.rtrim(a, F.lit("-")), t)).otherwise(F.concat_ws(" ", a, t)))
    some = lambda c, x: F.when(F.size(c) > 0, x)
    named = said.select(*keys, "column_no", some("_parts", label).alias("label"), some("_banners", F.col("_banners")).alias("banners"))
    return columns.select(*keys, "column_no").join(named, [*keys, "column_no"], "left")


def _with_upper(pieces: Column, same_center: float) -> Column:
    """Banners of one table's head in order, each with the nearest by centre of the line above it, if one is near."""

    def above(p: Column) -> Column:
        far = lambda u: F.abs(u["_center"] - p["_center"])
        near = F.filter(pieces, lambda u: (u["_name"]["line"] == p["_name"]["line"] - 1) & (far(u) <= same_center))
        return F.array_min(F.transform(near, lambda u: F.struct(far(u).alias("far"), u["_name"].alias("name"))))["name"]

    return F.array_sort(F.transform(pieces, lambda p: F.struct(p["_name"].alias("_name"), above(p).alias("_above"), p["text"].alias("text"), p["over"].alias("over"))))


def _chains(pieces: Column) -> Column:
    """Banners of one table's head, a handful, by line: each joins the chain whose last piece stands above it."""
    empty = F.array().cast("array<struct<last: struct<line: int, x0: double>, order: struct<line: int, x0: double>, text: string, over: array<int>>>")

    def step(found: Column, p: Column) -> Column:
        own = F.array(F.struct(p["_name"].alias("last"), p["_name"].alias("order"), p["text"].alias("text"), p["over"].alias("over")))
        grown = F.transform(found, lambda c: F.when(c["last"] == p["_above"], F.struct(p["_name"].alias("last"), c["order"].alias("order"), F.concat_ws(" ", c["text"], p["text"]).alias("text"), F.concat(c["over"], p["over"]).alias("over"))).otherwise(c))
        return F.when(F.coalesce(F.exists(found, lambda c: c["last"] == p["_above"]), F.lit(False)), grown).otherwise(F.concat(found, own))

    return F.aggregate(pieces, empty, step)
