"""Trees as tables of nodes and parents. Every node points to its parent; a round replaces each pointer by the pointer
of the node that it points to and adds up what lies between, so a tree of depth d takes log2(d) rounds, each one
exchange of the nodes that haven't arrived. Only nodes that are pointed to take part, mostly few; leaves hang on them
afterwards, by one exchange. Rounds are written to the shared folder, the one before is deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.session import kept, scratch


class _Rounds:
    """Tables of which only the last one is needed."""

    def __init__(self, spark, tag: str):
        self.spark, self.tag, self.last = spark, tag, None

    def put(self, df: DataFrame) -> DataFrame:
        path = scratch(self.spark, self.tag)
        df.write.parquet(path)
        if self.last:
            self.drop()
        self.last = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.last)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def climb(pointers: DataFrame, add: dict[str, str] | None = None) -> DataFrame:
    """node, up, hops and the columns of ``add`` from the node to the end of its way.

    ``pointers``: node, up (null: the way ends here) and, for each column of ``add``, what one hop counts for: ``sum`` or
    ``concat`` (arrays, the upper ones first). Nodes are unique; a node that is pointed to without being one
    ends the way too. ``up`` is the last node of the way, itself for a node that has no pointer. A way that runs
    into a circle has no end: its nodes are left out.
    """
    base = _split(pointers.select("node", "up", *(add or {})), "node", "up")
    inner, leaves = base.where("_inner").drop("_inner"), base.where("NOT _inner")
    found, lost = _climb(inner, add or {})
    return found.unionByName(_hung(leaves, "node", "up", found, lost, add or {}).select(found.columns))


def _split(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """``nodes`` and ``_inner``, whether any node points to them."""
    pointed = nodes.where(F.col(parent).isNotNull()).select(F.col(parent).alias(node)).distinct().withColumn("_inner", F.lit(True))
    return kept(nodes.join(pointed, node, "left").withColumn("_inner", F.coalesce("_inner", F.lit(False))), "nodes")


def _hung(leaves: DataFrame, node: str, parent: str, found: DataFrame, lost: DataFrame | None, add: dict[str, str]) -> DataFrame:
    """``leaves`` with up, hops and the columns of ``add``, from what was found for the nodes that they hang on."""
    above = found.select(F.col("node").alias("_node"), F.col("up").alias("_up"), F.col("hops").alias("_hops"), *[F.col(c).alias(f"_{c}") for c in add])
    if lost is not None:
        leaves = leaves.join(lost.select(F.col("node").alias(parent)), parent, "left_anti")
    hung = leaves.join(above, F.col(parent) == F.col("_node"), "left")
    joined = {c: _joined(c, how, dict(leaves.dtypes)[c]) for c, how in add.items()}
    hops = F.when(F.col(parent).isNull(), F.lit(0)).otherwise(F.coalesce("_hops", F.lit(0)) + 1).cast("long")
    return hung.select(*[c for c in leaves.columns if c not in (*add, "up")], F.coalesce("_up", parent, node).alias("up"), hops.alias("hops"), *[x.alias(c) for c, x in joined.items()])


def _joined(c: str, how: str, kind: str) -> Column:
    return F.col(c) + F.coalesce(f"_{c}", F.lit(0)) if how == "sum" else F.concat(F.coalesce(f"_{c}", F.array().cast(kind)), F.col(c))


def _climb(pointers: DataFrame, add: dict[str, str]) -> tuple[DataFrame, DataFrame | None]:
    """``climb`` in rounds of all nodes, and the nodes without an end, if there are any."""
    rounds, more = _Rounds(pointers.sparkSession, "climb"), list(add)
    now = pointers.select("node", F.coalesce("up", "node").alias("up"), F.col("up").isNull().alias("ended"), F.col("up").isNotNull().cast("long").alias("hops"), *more)
    now, lost = rounds.put(now), None
    left, limit = None, 2
    while True:
        n = now.where("NOT ended").count()
        if not n:
            break
        left = left or now.count()
        if 1 << (limit - 2) > 2 * left:  # longer than any way without a circle
            now, lost = now.where("ended"), now.where("NOT ended").select("node")
            break
        then = now.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("ended").alias("_ended"), F.col("hops").alias("_hops"), *[F.col(c).alias(f"_{c}") for c in more])
        going = now.where("NOT ended").join(then, "up", "left")
        stepped = going.select(
            "node", F.coalesce("_up", "up").alias("up"), F.coalesce("_ended", F.lit(True)).alias("ended"), (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops"),
            *[_joined(c, how, dict(now.dtypes)[c]).alias(c) for c, how in add.items()],
        )
        now = rounds.put(now.where("ended").unionByName(stepped))
        limit += 1
    return now.drop("ended"), lost


def reachable(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """node and depth of everything below ``roots`` (node) over ``edges`` (parent, child), least depth first.

    Cycles and several ways to a node are harmless. Nodes with one parent hang, by ``climb``, on the next root or node
    with several parents above them; only these few are then walked, round by round, along their shortest ways.
    """
    roots = roots.select("node").distinct()
    own = edges.select("parent", "child").distinct().join(roots.withColumnRenamed("node", "child"), "child", "left_anti")
    parents = own.groupBy(F.col("child").alias("node")).agg(F.count("*").alias("n"), F.min("parent").alias("up"))
    tops = edges.select(F.col("parent").alias("node")).union(roots).distinct().join(parents.select("node"), "node", "left_anti")
    pointers = parents.select("node", F.when(F.col("n") == 1, F.col("up")).alias("up")).unionByName(tops.select("node", F.lit(None).cast(dict(parents.dtypes)["up"]).alias("up")))
    hung = climb(pointers)
    heads = hung.select(F.col("node").alias("parent"), F.col("up").alias("above"), F.col("hops"))
    links = own.join(parents.where("n > 1").select(F.col("node").alias("child")), "child").join(heads, "parent").select(F.col("child").alias("node"), "above", (F.col("hops") + 1).alias("far"))
    spark, found = edges.sparkSession, roots.withColumn("depth", F.lit(0).cast("long"))
    links = _Rounds(spark, "links").put(links)
    if not links.isEmpty():
        rounds = _Rounds(spark, "reach")
        found, settled = rounds.put(found), False
        while not settled:
            way = links.join(found.withColumnRenamed("node", "above"), "above").groupBy("node").agg(F.min(F.col("depth") + F.col("far")).alias("depth"))
            later = _Rounds(spark, "reach")
            then = later.put(found.unionByName(way).groupBy("node").agg(F.min("depth").alias("depth")))
            settled = then.join(found, ["node", "depth"], "left_anti").isEmpty()
            rounds.drop()
            rounds, found = later, then
    return hung.join(found.select(F.col("node").alias("up"), "depth"), "up").select("node", (F.col("hops") + F.col("depth")).cast("int").alias("depth"))


def tree_faults(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """node and fault of nodes that no tree has: several parents, or no way from a root (orphan)."""
    several = edges.groupBy(F.col("child").alias("node")).agg(F.countDistinct("parent").alias("n")).where("n > 1")
    nodes = edges.select(F.col("child").alias("node")).union(edges.select("parent")).distinct()
    orphans = nodes.join(reachable(edges, roots).select("node"), "node", "left_anti")
    return several.select("node", F.lit("SEVERAL_PARENTS").alias("fault")).union(orphans.select("node", F.lit("ORPHAN")))


def subtree_totals(nodes: DataFrame, values: list[str], node: str = "id", parent: str = "parent_id") -> DataFrame:
    """``nodes`` (with a unique ``node``) and, as ``total_*``, each of ``values`` summed over the node and all below it.

    Round k hands what a node has gathered to the node 2**k above it, so a chain of 100,000 takes 17 rounds. Nulls count
    as nothing; a parent that isn't there has no total; nodes in a circle or below one have no totals (null).
    """
    return _totals(_split(nodes, node, parent), values, node, parent).drop("_inner")


def _totals(base: DataFrame, values: list[str], node: str, parent: str) -> DataFrame:
    """``subtree_totals`` of what ``_split`` gives. A leaf's total is its own value; rounds have only what stands above leaves."""
    names = [f"total_{c}" for c in values]
    inner, leaves = base.where("_inner"), base.where("NOT _inner")
    own = [F.coalesce(F.col(c), F.lit(0)) for c in values]
    sound, lost = _climb(inner.select(F.col(node).alias("node"), F.col(parent).alias("up")), {})
    known = F.col(node).isNotNull()
    start = inner.select(F.col(node).alias("node"), F.col(parent).alias("up"), *[x.alias(n) for x, n in zip(own, names, strict=True)])
    if lost is not None:
        start = start.join(sound.select("node"), "node", "left_semi")
        leaves = leaves.join(lost.select(F.col("node").alias(parent), F.lit(True).alias("_lost")), parent, "left")
        known = known & F.col("_lost").isNull()
    ended = leaves.select(*base.columns, *[F.when(known, x).alias(n) for x, n in zip(own, names, strict=True)])
    hung = ended.where(F.col(node).isNotNull() & F.col(parent).isNotNull()).groupBy(F.col(parent).alias("node")).agg(*[F.sum(n).alias(f"_{n}") for n in names])
    rounds = _Rounds(base.sparkSession, "totals")
    now = rounds.put(start.join(hung, "node", "left").select("node", "up", *[(F.col(n) + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in names]))
    while not now.where("up IS NOT NULL").isEmpty():
        given = now.where("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(*[F.sum(n).alias(f"_{n}") for n in names])
        next_up = now.select(F.col("node").alias("up"), F.col("up").alias("_up"))
        grown = now.join(given, "node", "left").select("node", "up", *[(F.col(n) + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in names])
        moved = grown.where("up IS NOT NULL").join(next_up, "up", "left").select("node", F.col("_up").alias("up"), *names)
        now = rounds.put(moved.unionByName(grown.where("up IS NULL")))
    return ended.unionByName(inner.join(now.drop("up").withColumnRenamed("node", node), node, "left"))


def reading_order(nodes: DataFrame, node: str = "id", parent: str = "parent_id", position: str = "position") -> DataFrame:
    """``nodes`` with ``top`` (the root of their tree), ``depth`` and ``place``: from 0 in each tree, a node before its
    children and these by ``position``. A place is the sum, over the way to the root, of one for the node and the sizes of
    the siblings before it, so no paths are built and a tree may be of any depth."""
    sized = _totals(_split(nodes.withColumn("_one", F.lit(1).cast("long")), node, parent), ["_one"], node, parent).where(F.col(node).isNotNull())
    before = F.sum("total__one").over(Window.partitionBy(parent).orderBy(position, node).rowsBetween(Window.unboundedPreceding, -1))
    below = sized.where(F.col(parent).isNotNull()).withColumn("place", F.coalesce(before, F.lit(0)) + 1)
    placed = below.unionByName(sized.where(F.col(parent).isNull()).withColumn("place", F.lit(0).cast("long")))
    inner = placed.where("_inner")
    found, lost = _climb(inner.select(F.col(node).alias("node"), F.col(parent).alias("up"), "place"), {"place": "sum"})
    kept_ = [node, *[c for c in nodes.columns if c != node]]
    out = [*kept_, F.col("up").alias("top"), F.col("hops").cast("int").alias("depth"), "place"]
    leaves = _hung(placed.where("NOT _inner"), node, parent, found, lost, {"place": "sum"}).select(out)
    return leaves.unionByName(sized.where("_inner").select(kept_).join(found.withColumnRenamed("node", node), node).select(out))


def preorder(nodes: DataFrame, node: str = "id", parent: str = "parent_id", position: str = "position") -> DataFrame:
    """``nodes`` with depth and ``path``, the positions on the way from the root, by which arrays sort in reading order.
    Paths are as long as the tree is deep; ``reading_order`` does without them."""
    found = climb(nodes.select(F.col(node).alias("node"), F.col(parent).alias("up"), F.array(position).alias("path")), {"path": "concat"})
    return nodes.join(found.select(F.col("node").alias(node), F.col("hops").cast("int").alias("depth"), "path"), node)


def first_below(nodes: DataFrame, condition: Column, node: str = "id", parent: str = "parent_id", position: str = "position", *columns: str) -> DataFrame:
    """For each tree (``top``) the ``columns`` of the first node in reading order for which a condition holds, however deep
    it stands. Trees without one are left out; ``resolve.required`` turns that into an error."""
    placed = reading_order(nodes, node, parent, position)
    return placed.where(condition).groupBy("top").agg(F.min_by(F.struct(node, *columns), "place").alias("_m")).select("top", "_m.*")
