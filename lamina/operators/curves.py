"""Property curves: packed bands, brackets, interpolation and the states of a lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed_bands(points: DataFrame, key: str, t: str, v: str) -> DataFrame:
    """One row for each curve: its points in ascending ``t`` without gaps, with their number and ends."""
    band = F.array_sort(F.collect_list(F.when(F.col(v).isNotNull(), F.struct(F.col(t).alias("t"), F.col(v).alias("v")))))
    out = points.groupBy(key).agg(band.alias("band"))
    return out.select(
        key, "band", F.size("band").alias("n_pts"),
        F.get("band", F.lit(0))["t"].alias("t_first"), F.try_element_at("band", F.lit(-1))["t"].alias("t_last"),
    )


def bracket(band: Column, at: Column) -> Column:
    """Struct of the last point at or below ``at`` (the first point, below all) and the next one."""
    low = F.coalesce(F.try_element_at(F.filter(band, lambda p: p["t"] <= at), F.lit(-1)), F.get(band, F.lit(0)))
    # bound in a list of one, as the lower point would be sought again for every point that the upper one is sought among
    both = F.transform(F.array(low), lambda lo: F.struct(lo.alias("lo"), F.get(F.filter(band, lambda p: p["t"] > lo["t"]), F.lit(0)).alias("hi")))
    return F.get(both, F.lit(0))


def interpolate(b: Column, at: Column, conservative: Column) -> Column:
    """Held below the first and above the last point; in between linear, or the upper point's value where
    ``conservative``. On or below the lower point its value holds in either mode."""
    lo, hi = b["lo"], b["hi"]
    linear = lo["v"] + (hi["v"] - lo["v"]) * (at - lo["t"]) / (hi["t"] - lo["t"])
    return (
        F.when(lo.isNull(), F.lit(None).cast("double")).when(at <= lo["t"], lo["v"]).when(hi.isNull(), lo["v"])
        .when(conservative, hi["v"]).otherwise(linear)
    )


def lookup(probes: DataFrame, bands: DataFrame, key: str, at: str = "t_probe", conservative: Column | bool = False) -> DataFrame:
    """Join probes to their curve and read it; bands stay one row a curve, so nothing is exploded.

    Both sides are exchanged: probes are often exploded from a few rows, and estimates of their size don't see that, so
    they would be broadcast from the driver however many they are."""
    mode = F.lit(conservative) if isinstance(conservative, bool) else conservative
    read = probes.hint("merge").join(bands, key).withColumn("bracket", bracket(F.col("band"), F.col(at)))
    return read.select(
        *probes.columns, "n_pts", "t_first", "t_last",
        F.col("bracket.lo.t").alias("t1"), F.col("bracket.hi.t").alias("t2"),
        interpolate(F.col("bracket"), F.col(at), mode).alias("value"),
    )


def range_status(at: Column, n: Column, first: Column, last: Column, point: Column | None = None) -> Column:
    """State of a lookup that is blocked outside its points."""
    ladder = F.when(point, "POINT").when(n == 0, "NO_TABLE") if point is not None else F.when(n == 0, "NO_TABLE")
    return ladder.when(at < first, "BELOW_RANGE").when(at > last, "ABOVE_RANGE").otherwise("IN_RANGE")


def limit_status(at: Column, n: Column, first: Column, last: Column, least: Column, most: Column) -> Column:
    """State under printed limits; the order of the cases is their precedence."""
    return (
        F.when(n == 0, "NO_TABLE").when(at < least, "OUT_BELOW_MINIMUM").when(at > most, "OUT_ABOVE_RECOMMENDED")
        .when(at > last, "OUT_ABOVE_TABULATED").when(at < first, "HELD_BELOW_FIRST").otherwise("IN_RANGE")
    )


def stress_status(at: Column, most: Column) -> Column:
    return F.when(at > most, "ABOVE_MAX_TEMPERATURE").otherwise("IN_RANGE")


def unless_out(status: Column, value: Column) -> Column:
    """A value only where the state allows one."""
    return F.when(~(status.startswith("OUT") | status.isin("NO_TABLE", "BELOW_RANGE", "ABOVE_RANGE")), value)


def applicable_factor(basic: Column, examined: Column, admits: Column) -> Column:
    """The increase by examination, capped at 1, where the row admits one."""
    return F.when(admits & examined.isNotNull(), F.least(F.lit(1.0), F.greatest(basic, examined))).otherwise(basic)


def admits_increase(notes: Column) -> Column:
    """From the notes that a row cites: (4) yes, (5) no, both already included, neither silent."""
    yes, no = F.array_contains(notes, "(4)"), F.array_contains(notes, "(5)")
    return F.when(yes & no, "INCLUDED").when(yes, "YES").when(no, "NO").otherwise("SILENT")
