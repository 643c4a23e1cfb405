"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import discard, materialize, sweep

#: Rows of two numbers that may be sent to all executors at once, some 64 MB; beyond it, a shuffle join.
BROADCAST_ROWS = 1_000_000


def spread_join(rows: DataFrame, table: DataFrame, on: str, n: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has one row for each key, ``n`` at most, and is read from files.

    A key may hold most of ``rows``. A small table is sent to all executors, so no row moves; a large one is
    joined over plain exchanges on both sides, where an adaptive plan cuts a hot key's rows into several tasks
    (it can't if one side is aggregated by the key in the same stage).
    """
    return rows.join(F.broadcast(table) if n <= BROADCAST_ROWS else table, on, how)


def _large_star(edges: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Every larger neighbour of a node linked to the least of the node and its neighbours; and what to discard."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = materialize(least, "least") if 2 * n > BROADCAST_ROWS else least
    return spread_join(both.where("v > u"), least, "u", 2 * n).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), least


def _small_star(edges: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Every smaller neighbour of a node, and the node itself, linked to the least of them; and what to discard."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    least = materialize(least, "least") if n > BROADCAST_ROWS else least
    moved = spread_join(edges, least, "u", n).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct(), least


def connected_components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) for every node of ``edges`` (a, b).

    Only nodes that have a link to another node are listed. Every round is written to the shared folder;
    neighbours are never gathered: a hub's links are counted by the tasks that have them, and joined by
    ``spread_join``.
    """
    spark = edges.sparkSession
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    current, before = materialize(links, "links"), None
    while True:
        seen = current.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("h")).first()
        if seen == before:
            found = current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
            found._lamina_path = current._lamina_path
            return found
        before, old = seen, current
        large, first = _large_star(old, seen.n)
        large = materialize(large, "stars") if seen.n > BROADCAST_ROWS else large
        small, second = _small_star(large, seen.n)
        current = materialize(small, "links")
        discard(first, large, second, old)
        sweep(spark)
