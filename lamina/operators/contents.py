"""A list of contents against what a document has: entries that are missing, extra, or stand elsewhere."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def longest_rising(values: list[int]) -> set[int]:
    """Indexes of a longest strictly rising subsequence; of equals the one whose last values are the smallest."""
    tails, ends, before = [], [], []
    for i, v in enumerate(values):
        at = bisect_left(tails, v)
        before.append(ends[at - 1] if at else -1)
        tails[at : at + 1], ends[at : at + 1] = [v], [i]
    chosen, at = set(), ends[-1] if ends else -1
    while at >= 0:
        chosen.add(at)
        at = before[at]
    return chosen


def compared_lists(declared: DataFrame, found: DataFrame, keys: list[str], entry: str, order: str) -> DataFrame:
    """keys, entry, both places (null: not there) and ``state`` of every entry of two ordered lists: SAME, MOVED, MISSING
    (declared alone) or EXTRA (found alone).

    Entries that occur in both are put in the declared order; as many as possible keep their order and are SAME, all
    others have MOVED. An entry that occurs several times is matched first with first. The lists meet in joins;
    the ranks that one document's entries have are then looked at together, as its order is what is compared.
    """
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy(*keys, entry).orderBy(order))
    left = declared.select(*keys, entry, F.col(order).alias("declared_at"), nth.alias("_nth"))
    right = found.select(*keys, entry, F.col(order).alias("found_at"), nth.alias("_nth"))
    both = left.join(right, [*keys, entry, "_nth"], "full")
    common = both.where("declared_at IS NOT NULL AND found_at IS NOT NULL").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("declared_at", "found_at"))).alias("_pairs"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = []
            for pairs in b.column(b.num_columns - 1).to_pylist():
                rising = longest_rising([p["found_at"] for p in pairs])
                kept.append([pairs[i]["declared_at"] for i in sorted(rising)])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(kept, pa.list_(pa.int64()))], names=[*b.schema.names[:-1], "_kept"])

    at = F.transform("_pairs", lambda p: F.struct(p["declared_at"].cast("long").alias("declared_at"), p["found_at"].cast("long").alias("found_at")))
    schema = ", ".join(f"`{k}` {t}" for k, t in declared.select(*keys).dtypes)
    kept = common.select(*keys, at.alias("_pairs")).mapInArrow(run, f"{schema}, _kept array<long>").select(*keys, F.explode("_kept").alias("declared_at"), F.lit(True).alias("_same"))
    state = F.when(F.col("found_at").isNull(), "MISSING").when(F.col("declared_at").isNull(), "EXTRA").when(F.col("_same"), "SAME").otherwise("MOVED")
    return both.join(kept, [*keys, "declared_at"], "left").select(*keys, entry, "declared_at", "found_at", state.alias("state"))
