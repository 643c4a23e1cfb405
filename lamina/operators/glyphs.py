"""Words from single characters with places, and bounds of columns from many places that are nearly the same."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


CHARS = "array<struct<x0: double, x1: double, char: string, size: double>>"


def in_fixed_pitch(line: Column, pitch: float, size: float) -> Column:
    """The characters of a line (``CHARS``, from the left) as a printer of one pitch places them; blanks take their place too."""
    return F.arrow_udf(lambda lines: _pitched(lines, pitch, size), CHARS)(line)


def _pitched(lines: pa.Array, pitch: float, size: float) -> pa.Array:
    lines = pc.fill_null(lines.cast(pa.string()), "")
    ends = np.frombuffer(lines.buffers()[1] or bytes(4), np.int32)[lines.offset : lines.offset + len(lines) + 1]
    data = np.frombuffer(lines.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    char = pa.StringArray.from_buffers(len(begins), pa.py_buffer(np.append(begins, len(data)).astype(np.int32)), pa.py_buffer(data.tobytes()))
    of_line = np.searchsorted(begins, ends - ends[0])
    x0 = (np.arange(len(begins)) - np.repeat(of_line[:-1], np.diff(of_line))) * pitch
    chars = pa.StructArray.from_arrays([pa.array(x0, pa.float64()), pa.array(x0 + pitch, pa.float64()), char, pa.array(np.full(len(x0), size))], ["x0", "x1", "char", "size"])
    return pa.ListArray.from_arrays(of_line.astype(np.int32), chars)


def words_of_line(chars: Column, gap: float = 0.25) -> Column:
    """The words (text, x0, x1; from left to right) that the characters of one printed line make (``CHARS``, in any order).

    Characters follow from left to right; a gap wider than ``gap`` times the larger of the two sizes beside it begins a
    word, as blanks aren't printed. Blank and null characters only separate.
    """
    return F.arrow_udf(lambda lines: _words(lines, gap), "array<struct<text: string, x0: double, x1: double>>")(chars)


def _words(lines: pa.Array, gap: float) -> pa.Array:
    """All lines of a batch side by side, character by character in their order."""
    flat, n = lines.flatten(), pc.fill_null(pc.list_value_length(lines), 0).to_numpy(zero_copy_only=False)
    line, char = np.repeat(np.arange(len(lines)), n), flat.field("char").cast(pa.string())
    kept = np.flatnonzero(pc.fill_null(pc.not_equal(pc.ascii_trim(char, " "), ""), False).to_numpy(zero_copy_only=False))
    line = line[kept]
    values = lambda name: flat.field(name).cast(pa.float64()).take(pa.array(kept)).to_numpy(zero_copy_only=False)
    nulls = lambda name: flat.field(name).is_null().to_numpy(zero_copy_only=False)[kept]
    x0, x1, size, no_x0, no_x1 = values("x0"), values("x1"), np.where(nulls("size"), -np.inf, values("size")), nulls("x0"), nulls("x1")
    if not ((np.diff(line) > 0) | (np.diff(x0) > 0)).all():  # else they stand in their order
        names, code = np.unique(np.array([c.encode() for c in char.take(pa.array(kept)).to_pylist()], object), return_inverse=True)
        rank = lambda x, none: (np.where(np.isnan(x), 0, x), np.where(none, 0, np.where(np.isnan(x), 2, 1)))
        order = np.lexsort((size, code, *rank(x1, no_x1), *rank(x0, no_x0), line))
        kept, line, x0, x1, size, no_x0, no_x1 = (a[order] for a in (kept, line, x0, x1, size, no_x0, no_x1))
    first = np.diff(line, prepend=-1) > 0
    found, at = np.unique(np.where(no_x1, -np.inf, x1), return_inverse=True)
    reach = found[np.maximum.accumulate(at + line * len(found)) - line * len(found)] if len(found) else x1
    goes_on = np.zeros(len(line), bool)
    goes_on[1:] = x0[1:] - reach[:-1] <= gap * np.maximum(size[1:], size[:-1])
    begins = np.flatnonzero(first | ~goes_on)
    char = char.take(pa.array(kept))
    ends = np.append(np.frombuffer(char.buffers()[1], np.int32)[: len(kept)][begins], np.frombuffer(char.buffers()[1], np.int32)[len(kept)]) if len(kept) else np.zeros(1, np.int32)
    text = pa.StringArray.from_buffers(len(begins), pa.py_buffer(ends.astype(np.int32)), char.buffers()[2] or pa.py_buffer(b""))
    each = lambda f, x, none: pa.array(f.reduceat(x, begins), mask=np.logical_and.reduceat(none, begins)) if len(begins) else pa.array([], pa.float64())
    words = pa.StructArray.from_arrays([text, each(np.fmin, x0, no_x0), each(np.maximum, np.where(no_x1, -np.inf, x1), no_x1)], ["text", "x0", "x1"])
    return pa.ListArray.from_arrays(np.append(0, np.cumsum(np.bincount(line[begins], minlength=len(lines)))).astype(np.int32), words)


def words_of_chars(chars: DataFrame, keys: list[str], gap: float = 0.25) -> DataFrame:
    """keys (down to the printed line), word_no, text, x0 and x1 of the words that characters (x0, x1, size, char) make,
    by ``words_of_line``: the characters of a line are gathered in one exchange."""
    printed = chars.where(F.trim("char") != "")
    lines = printed.groupBy(*keys).agg(F.collect_list(F.struct("x0", "x1", "char", "size")).alias("_chars"))
    words = lines.select(*keys, F.posexplode(words_of_line(F.col("_chars"), gap)).alias("_no", "_word"))
    return words.select(*keys, F.col("_no").cast("long").alias("word_no"), "_word.text", "_word.x0", "_word.x1")


def cut_at_columns(words: DataFrame, columns: DataFrame, keys: list[str]) -> DataFrame:
    """``column_no`` of each word: the last column (column_no, b0; keys) that begins at or before the word's middle, else the first.

    Both sides are put in one order and the last column is carried on, so no word meets every column."""
    middle = (F.col("x0") + F.col("x1")) / 2
    marks = columns.select(*keys, F.col("b0").alias("_at"), F.lit(0).alias("_kind"), "column_no")
    placed = words.withColumns({"_at": middle, "_kind": F.lit(1), "column_no": F.lit(None).cast(dict(columns.dtypes)["column_no"])})
    w = Window.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last("column_no", ignorenulls=True).over(w)
    first = F.min("column_no").over(Window.partitionBy(*keys))
    both = placed.unionByName(marks, allowMissingColumns=True).withColumn("column_no", F.coalesce(last, first))
    return both.where("_kind = 1").drop("_at", "_kind")


def merged_bounds(places: DataFrame, keys: list[str], x: str, tolerance: float = 3.0, hits: int = 1) -> DataFrame:
    """keys and ``bounds``: places that lie within ``tolerance`` of the first of their run are one bound, the mean of all that
    stand there; bounds with fewer than ``hits`` places are left out. Equal places are counted first, so what is folded
    are the different places of one table."""
    counted = places.where(F.col(x).isNotNull()).groupBy(*keys, F.col(x).cast("double").alias("x")).agg(F.count("*").alias("n"))
    runs = F.aggregate(
        F.array_sort(F.collect_list(F.struct("x", "n"))), F.array().cast("array<struct<first: double, sum: double, n: bigint>>"),
        lambda found, p: F.when(
            F.get(found, F.size(found) - 1)["first"] >= p["x"] - tolerance,
            F.concat(F.slice(found, F.lit(1), F.greatest(F.size(found) - 1, F.lit(0))), F.array(F.struct(F.get(found, F.size(found) - 1)["first"].alias("first"), (F.get(found, F.size(found) - 1)["sum"] + p["x"] * p["n"]).alias("sum"), (F.get(found, F.size(found) - 1)["n"] + p["n"]).alias("n")))),
        ).otherwise(F.concat(found, F.array(F.struct(p["x"].alias("first"), (p["x"] * p["n"]).alias("sum"), p["n"].alias("n"))))),
    )
    return counted.groupBy(*keys).agg(F.transform(F.filter(runs, lambda r: r["n"] >= hits), lambda r: r["sum"] / r["n"]).alias("bounds"))


def widened_grid(grid: DataFrame, places: DataFrame, keys: list[str], x: str, tolerance: float = 3.0, hits: int = 3) -> DataFrame:
    """``bounds`` with one more at either side where at least ``hits`` places lie beyond it by more than ``tolerance``: a table
    whose rule was missed is wider than its rules say. The new bound is the outermost of these places."""
    b = F.col("bounds")
    low, high = F.get(b, F.lit(0)), F.element_at(b, -1)
    met = places.join(grid, keys)
    left, right = F.col(x) < low - tolerance, F.col(x) > high + tolerance
    beyond = met.groupBy(*keys).agg(F.count_if(left).alias("_l"), F.min(F.when(left, F.col(x))).alias("_x0"), F.count_if(right).alias("_r"), F.max(F.when(right, F.col(x))).alias("_x1"))
    none = F.array().cast("array<double>")
    more = F.concat(F.when(F.col("_l") >= hits, F.array("_x0")).otherwise(none), b, F.when(F.col("_r") >= hits, F.array("_x1")).otherwise(none))
    return grid.join(beyond, keys, "left").withColumn("bounds", F.when(F.col("_l").isNull(), b).otherwise(more)).drop("_l", "_r", "_x0", "_x1")
