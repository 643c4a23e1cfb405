"""Trees by doubling pointers: depth, circles, several ways, totals, reading order."""

import random

from pyspark.sql import functions as F

from lamina.operators import trees

EDGES = "parent string, child string"


def test_reachable(spark):
    edges = spark.createDataFrame([("r", "a"), ("a", "b"), ("x", "y")], EDGES)
    got = {r.node: r.depth for r in trees.reachable(edges, spark.createDataFrame([("r",)], "node string")).collect()}
    assert got == {"r": 0, "a": 1, "b": 2}


def test_circles_and_several_ways(spark):
    chain = spark.range(40).selectExpr("cast(id as string) parent", "cast(id + 1 as string) child")
    more = [("40", "0"), ("0", "7"), ("x", "y"), ("p", "q"), ("q", "p"), ("q", "s")]
    edges = chain.union(spark.createDataFrame(more, EDGES))
    roots = spark.createDataFrame([("0",), ("0",)], "node string")
    got = {r.node: r.depth for r in trees.reachable(edges, roots).collect()}
    assert got == {str(k): min(k, k - 6 if k >= 7 else k) for k in range(41)}
    faults = {("7", "SEVERAL_PARENTS"), ("x", "ORPHAN"), ("y", "ORPHAN"), ("p", "SEVERAL_PARENTS"), ("p", "ORPHAN"), ("q", "ORPHAN"), ("s", "ORPHAN")}
    assert {tuple(r) for r in trees.tree_faults(edges, roots).collect()} == faults - {("p", "SEVERAL_PARENTS")}


def test_any_graph(spark):
    """Least depths against a breadth-first search."""
    for seed in range(4):
        r = random.Random(seed)
        pairs = [(r.randrange(30), r.randrange(30)) for _ in range(36)]
        below = {0: 0, 1: 0}
        queue = [0, 1]
        for n in queue:
            for a, b in pairs:
                if a == n and b not in below:
                    below[b] = below[n] + 1
                    queue.append(b)
        edges = spark.createDataFrame(pairs, "parent int, child int")
        got = trees.reachable(edges, spark.createDataFrame([(0,), (1,)], "node int")).collect()
        assert {x.node: x.depth for x in got} == below and len(got) == len(below)


def test_depth_of_a_hundred_thousand(spark, monkeypatch):
    rounds = []
    put = trees._Rounds.put
    monkeypatch.setattr(trees._Rounds, "put", lambda self, df: (rounds.append(self.tag), put(self, df))[1])
    n = 100_000
    chain = spark.range(n).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_id"), F.lit(0).alias("position"))
    deepest = trees.reachable(chain.where("id > 0").select(F.col("parent_id").alias("parent"), F.col("id").alias("child")), spark.createDataFrame([(0,)], "node long"))
    assert deepest.agg(F.max("depth"), F.count("*")).first()[:] == (n - 1, n)
    assert rounds.count("climb") < 20
    got = trees.reading_order(chain.where("id < 3000"))
    assert got.where("id <> place OR depth <> id OR top <> 0").count() == 0 and got.count() == 3000


def test_scratch_is_removed(spark, tmp_path, monkeypatch):
    names = iter(range(1000))
    monkeypatch.setattr(trees, "scratch", lambda spark, tag: f"file://{tmp_path}/{tag}-{next(names)}")
    chain = spark.range(300).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_id"), F.lit(1).cast("long").alias("n"))
    assert trees.subtree_totals(chain, ["n"]).where("total_n <> 300 - id").count() == 0
    assert len(list(tmp_path.iterdir())) == 2 < next(names)


def test_leaves_take_no_part_in_rounds(spark, monkeypatch):
    """Rounds have only nodes that others hang on; leaves below a circle or below nothing are what they were."""
    written = []
    put = trees._Rounds.put
    monkeypatch.setattr(trees._Rounds, "put", lambda self, df: (written.append((out := put(self, df)).count()), out)[1])
    rows = [(0, None)] + [(k, 0) for k in range(1, 4)] + [(k, k % 3 + 1) for k in range(4, 400)] + [(500, 501), (501, 500), (502, 501), (503, 999)]
    nodes = spark.createDataFrame([(*r, r[0]) for r in rows], "id int, parent_id int, position int")
    got = {r.id: (r.top, r.depth, r.place) for r in trees.reading_order(nodes).collect()}
    assert len(got) == 401 and got[503] == (999, 1, 1) and got[1] == (0, 1, 1) and got[399] == (0, 2, 1 + 132) and not {500, 501, 502} & set(got)
    totals = {r.id: r.total_position for r in trees.subtree_totals(nodes, ["position"]).collect()}
    assert totals[0] == sum(range(400)) and totals[503] == 503 and [totals[k] for k in (500, 501, 502)] == [None] * 3
    assert max(written) <= 6


def test_totals_order_and_search(spark):
    rows = [("a", None, 0, 1, "x"), ("b", "a", 1, 2, "see 3"), ("c", "a", 0, 4, "x"), ("d", "c", 1, None, "see 7"), ("e", "c", 0, 16, "x"), ("f", None, 0, 32, "x"), ("p", "q", 0, 1, "see 1"), ("q", "p", 0, 1, "x"), ("z", "gone", 0, 8, "see 9")]
    nodes = spark.createDataFrame(rows, "id string, parent_id string, position int, n int, text string")
    totals = {r.id: r.total_n for r in trees.subtree_totals(nodes, ["n"]).collect()}
    assert totals == {"a": 23, "b": 2, "c": 20, "d": 0, "e": 16, "f": 32, "p": None, "q": None, "z": 8}
    order = trees.reading_order(nodes)
    assert [r.id for r in order.where("top = 'a'").orderBy("place").collect()] == ["a", "c", "e", "d", "b"]
    assert {(r.id, r.place, r.depth) for r in order.collect()} >= {("a", 0, 0), ("d", 3, 2), ("b", 4, 1), ("f", 0, 0)}
    found = trees.first_below(nodes, F.col("text").rlike(r"see \d"), "id", "parent_id", "position", "text").collect()
    assert {(r.top, r.id, r.text) for r in found} == {("a", "d", "see 7"), ("gone", "z", "see 9")}
    assert [r.id for r in trees.preorder(nodes.where("id <= 'f'")).orderBy("path").collect()][:3] == ["a", "f", "c"]
    empty = spark.createDataFrame([], "id string, parent_id string, position long")
    assert trees.preorder(empty).count() == 0 and trees.reading_order(empty).count() == 0
