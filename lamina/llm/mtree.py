"""Exact top-k inner products by best-first search in M-trees.

Vectors are dealt to the nearest of some pivots, and each pivot's cell becomes an M-tree, or several of bounded
size: pages of entries with a routing vector, a covering radius and the distance to the parent's routing vector.
Inner products are turned into distances by one more coordinate, ``sqrt(M**2 - |x|**2)`` for vectors and 0 for
queries, with M the largest norm; then ``score = (|q|**2 + M**2 - distance**2) / 2``. A search takes the page with
the best bound first. Entries that the stored parent distances rule out by the triangle inequality cost no
distance computation, and a search ends when no page can hold a score as high as the k-th best.

The cells are searched the same way: a query first goes to the tree of its nearest pivot, and then only to the
cells whose radius leaves room for a score as high as the k-th best from there, which bounds their search too.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.common import discard, lean, materialize

PAGE = 128
#: Vectors in a tree (in memory of one task), about; pivots for vectors of one dimension, at most.
SHARD, PIVOTS = 16_384, 4_096
#: Queries of a tree that one task answers, about: a tree that more ask for is sent to several tasks. Where there are fewer
#: trees than cores, tasks have fewer queries, but so many at least.
LOAD, LIGHT = 32_768, 64


def points_of(ints: np.ndarray, square: float) -> np.ndarray:
    """Vectors with the coordinate that turns inner products into distances."""
    x = ints.astype(float)
    return np.hstack([x, np.sqrt(np.maximum(0, square - (x**2).sum(1)))[:, None]])


class Reach:
    """Bounds of the scores of one query."""

    def __init__(self, query: np.ndarray, square: float):
        self.q = np.append(query.astype(float), 0.0)
        self.total = float(self.q @ self.q) + square
        self.slack = 1e-9 * (self.total + 1)  # rounding of the bounds; scores themselves are exact

    def distance(self, vectors: np.ndarray) -> np.ndarray:
        return np.sqrt(((vectors - self.q) ** 2).sum(1))

    def bound(self, distance: np.ndarray) -> np.ndarray:
        """The highest score at that distance or farther."""
        return (self.total - np.maximum(0.0, distance - self.slack) ** 2) / 2 + self.slack


class MTree:
    """Pages: {leaf, at (entries), vector, radius, parent distance}; entries point to pages or to rows."""

    def __init__(self, keys: np.ndarray, vec_ids: np.ndarray, ints: np.ndarray, square: float | None = None, seed: int = 5):
        self.keys, self.vec_ids, self.ints = keys, vec_ids, ints
        self.square = float((ints.astype(float) ** 2).sum(1).max()) if square is None else square
        points = points_of(ints, self.square)
        self.pages: list[dict] = []
        self.center = points.mean(0)
        self.root = self._page(points, np.arange(len(points)), self.center, np.random.default_rng(seed))

    def _page(self, points: np.ndarray, rows: np.ndarray, parent: np.ndarray, rng) -> int:
        own = points[rows]
        if len(rows) <= PAGE:
            page = {"leaf": True, "at": rows, "vector": own, "radius": np.zeros(len(rows))}
        else:
            fan = int(min(PAGE, max(2, np.ceil(len(rows) / PAGE))))
            routing = own[rng.choice(len(rows), fan, replace=False)]
            near = np.concatenate([((o[:, None] - routing) ** 2).sum(2).argmin(1) for o in np.array_split(own, -(-len(own) // 256))])
            if len(np.unique(near)) == 1:  # copies: any split does
                near = np.arange(len(rows)) % fan
            groups = [rows[near == g] for g in range(fan)]
            kept = [g for g in range(fan) if len(groups[g])]
            radius = [np.sqrt(((points[groups[g]] - routing[g]) ** 2).sum(1).max()) for g in kept]
            children = [self._page(points, groups[g], routing[g], rng) for g in kept]
            page = {"leaf": False, "at": np.array(children), "vector": routing[kept], "radius": np.array(radius)}
        page["parent"] = np.sqrt(((page["vector"] - parent) ** 2).sum(1))
        if page["leaf"]:
            del page["vector"]  # rows are scored from their integers
        self.pages.append(page)
        return len(self.pages) - 1

    def search(self, query: np.ndarray, k: int, own: int, least: float = -np.inf) -> list[tuple[int, int, int]]:
        """The k best (score, vec_id, key) with a score of ``least`` or more, ties to smaller vec_id and key, without
        the row ``own``."""
        reach = Reach(query, self.square)
        best: list[tuple[int, int, int]] = []
        heap = [(-np.inf, self.root, float(reach.distance(self.center[None])[0]))]
        while heap:
            high, at, d = heapq.heappop(heap)
            if -high < least:
                break
            page = self.pages[at]
            maybe = np.flatnonzero(reach.bound(np.abs(d - page["parent"]) - page["radius"]) >= least)
            if page["leaf"]:
                rows = page["at"][maybe]
                score = self.ints[rows] @ query
                take = np.flatnonzero(score >= least)
                best += [(-int(s), int(v), int(r)) for s, v, r in zip(score[take], self.vec_ids[rows[take]], self.keys[rows[take]], strict=True) if r != own]
                best = sorted(best)[:k]
                if len(best) == k:
                    least = max(least, -best[-1][0])
            elif len(maybe):
                distance = reach.distance(page["vector"][maybe])
                highest = reach.bound(distance - page["radius"][maybe])
                for i in np.flatnonzero(highest >= least):
                    heapq.heappush(heap, (-float(highest[i]), int(page["at"][maybe[i]]), float(distance[i])))
        return [(-s, v, r) for s, v, r in best]


class Cells:
    """Pivots of one dimension, and what is known of their cells once all vectors are dealt: the radius (distance of
    the farthest vector; -1: none) and the trees."""

    def __init__(self, square: float, pivots: np.ndarray):
        self.square, self.pivots = square, points_of(pivots, square)
        self.radius, self.trees = np.full(len(pivots), -1.0), np.zeros(len(pivots), dtype=int)

    def nearest(self, ints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot of each vector and its distance."""
        points = points_of(ints, self.square)
        near = np.concatenate([((o**2).sum(1)[:, None] + (self.pivots**2).sum(1) - 2 * o @ self.pivots.T).argmin(1) for o in np.array_split(points, -(-len(points) // 1024))])
        return near, np.sqrt(((points - self.pivots[near]) ** 2).sum(1))

    def home(self, query: np.ndarray, key: int) -> tuple[int, int]:
        """The pivot and tree that a query is sent to first."""
        distance = np.where(self.radius >= 0, Reach(query, self.square).distance(self.pivots), np.inf)
        pivot = int(distance.argmin())
        return pivot, key % int(self.trees[pivot])

    def others(self, query: np.ndarray, key: int, least: float) -> list[tuple[int, int]]:
        """The pivots and trees that may hold a score of ``least`` or more, without the first one."""
        reach = Reach(query, self.square)
        may = np.flatnonzero((self.radius >= 0) & (reach.bound(reach.distance(self.pivots) - self.radius) >= least))
        every = [(int(p), t) for p in may for t in range(int(self.trees[p]))]
        home = self.home(query, key)
        return [x for x in every if x != home]


def _vectors(rows: DataFrame) -> DataFrame:
    """key (of the row), vec_id, dim, the integer components and their squared norm, of vectors that take part."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], []]
            for vec_id, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = np.floor(256 * np.array([np.nan if c is None else c for c in v or ()], dtype=float))
                if vec_id is None or not len(x) or not np.isfinite(x).all():
                    continue
                if np.abs(x).max() ** 2 * len(x) >= 2.0**62:
                    raise ValueError(f"vector {vec_id}: inner products of such components don't fit into 64 bits")
                for column, value in zip(out, (vec_id, len(x), x.astype("<i8").tobytes(), float((x**2).sum())), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.binary(), pa.float64()), strict=True)], names=["vec_id", "dim", "ints", "norm"])

    found = lean(rows).select("vec_id", "embedding").mapInArrow(run, "vec_id long, dim int, ints binary, norm double")
    return materialize(found.withColumn("key", F.monotonically_increasing_id()), "vectors")


def _ints(cells: Iterable[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(cells), dtype="<i8").reshape(-1, dim)


def _by_dim(b: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """dim, rows and vectors of a batch (with columns dim and ints) for each dimension in it."""
    dims = b.column(b.schema.get_field_index("dim")).to_numpy()
    for dim in np.unique(dims).tolist():
        part = b.take(pa.array(np.flatnonzero(dims == dim)))
        yield dim, part, _ints(part.column(part.schema.get_field_index("ints")).to_pylist(), dim)


def _cells(vectors: DataFrame) -> tuple[dict[int, Cells], DataFrame]:
    """The cells of each dimension, and the vectors with their pivot and tree."""
    spark, cells = vectors.sparkSession, {}
    for dim, n, square in vectors.groupBy("dim").agg(F.count("*"), F.max("norm")).collect():  # a row for each dimension
        most = min(PIVOTS, -(-n // SHARD))
        share = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < max(1, min(1 << 30, int((1 << 30) * 2 * most / n) + 1))
        chosen = vectors.where((F.col("dim") == dim) & share).select(F.xxhash64("key").alias("h"), "ints").orderBy("h").limit(most).collect()
        if not chosen:
            chosen = vectors.where(F.col("dim") == dim).select("ints").limit(1).collect()
        cells[dim] = Cells(float(square), np.unique(_ints([bytes(r.ints) for r in chosen], dim), axis=0))
    shared = spark.sparkContext.broadcast(cells)  # at most PIVOTS vectors of each dimension

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, part, ints in _by_dim(b):
                pivot, distance = shared.value[dim].nearest(ints)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pivot, pa.int32()), pa.array(distance)], names=["key", "vec_id", "dim", "ints", "pivot", "distance"])

    dealt = materialize(vectors.select("key", "vec_id", "dim", "ints").mapInArrow(deal, "key long, vec_id long, dim int, ints binary, pivot int, distance double"), "dealt")
    sizes = dealt.groupBy("dim", "pivot").agg(F.count("*").alias("n"), F.max("distance").alias("radius"))
    sizes = sizes.withColumn("trees", F.ceil(F.col("n") / SHARD).cast("long")).collect()
    shared.destroy()
    for r in sizes:
        cells[r.dim].radius[r.pivot], cells[r.dim].trees[r.pivot] = r.radius, r.trees
    trees = spark.createDataFrame([(r.dim, r.pivot, r.trees) for r in sizes], "dim int, pivot int, trees long")
    return cells, dealt.join(F.broadcast(trees), ["dim", "pivot"]).withColumn("tree", F.pmod(F.xxhash64("key"), "trees").cast("int"))


ASKED = "key long, query_id long, dim int, ints binary, least double, pivot int, tree int"


#: What names a tree.
TREE = ["dim", "pivot", "tree"]


def search(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Answers of queries that come after the tree that they ask (pages, key, query_id, ints, least, dim): a tree is read
    once, and its queries pass by a batch at a time."""
    tree = None
    for b in batches:
        rows = []
        for pages, key, query_id, ints, least, dim in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if pages is not None:
                tree = pickle.loads(pages)
            else:
                rows += [(key, query_id, vec_id, row, score) for score, vec_id, row in tree.search(_ints([ints], dim)[0], k, key, least)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["key", "query_id", "vec_id", "row", "score"])


def top_products(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` rows with the highest inner product of floor(256 * x) for
    each row whose vec_id is divisible by ``every``; ties go to smaller vec_ids.

    Vectors that are null, empty, or hold null or non-finite components take no part, nor do null vec_ids;
    vectors of different dimension aren't compared. Each repeated row is a row of its own: as a query it only
    leaves out itself. Components so large that scores might not fit into 64 bits stop the query. An empty table
    gives no rows; other columns are ignored.
    """
    vectors = _vectors(embeddings)
    spark = embeddings.sparkSession
    cells, dealt = _cells(vectors)
    known = spark.sparkContext.broadcast(cells)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        dim, pdf = int(pdf["dim"].iloc[0]), pdf.sort_values("key")
        tree = MTree(pdf["key"].to_numpy(), pdf["vec_id"].to_numpy(), _ints(pdf["ints"], dim), known.value[dim].square)
        return pd.DataFrame({"dim": [dim], "pivot": [pdf["pivot"].iloc[0]], "tree": [pdf["tree"].iloc[0]], "pages": [pickle.dumps(tree)]})

    built = dealt.groupBy("dim", "pivot", "tree").applyInPandas(build, "dim int, pivot int, tree int, pages binary")
    trees = materialize(built, "trees")
    asked = vectors.where(F.col("vec_id") % every == 0).select("key", F.col("vec_id").alias("query_id"), "dim", "ints")

    def sent(first: bool):
        """Each query to the tree of its nearest pivot, or to all others that may hold a better score."""

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for dim, part, ints in _by_dim(b):
                    own, rows = known.value[dim], []
                    for key, query_id, cell, low, query in zip(*(part.column(i).to_pylist() for i in (0, 1, 3, 4)), ints, strict=True):
                        least = -np.inf if low is None else low
                        places = [own.home(query, key)] if first else own.others(query, key, least)
                        rows += [(key, query_id, dim, cell, least, *place) for place in places]
                    for at in range(0, len(rows), 4096):
                        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.float64(), pa.int32(), pa.int32())
                        names = ["key", "query_id", "dim", "ints", "least", "pivot", "tree"]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 4096], strict=True), kinds, strict=True)], names=names)

        return run

    def found(queries: DataFrame, first: bool) -> DataFrame:
        asks = materialize(queries.mapInArrow(sent(first), ASKED), "asked")
        counts = asks.groupBy(*TREE).agg(F.count("*").alias("n"))
        places = counts.agg(F.sum(F.ceil(F.col("n") / LOAD))).first()[0] or 1
        spread = -(-spark.sparkContext.defaultParallelism // places)
        shares = counts.select(*TREE, F.greatest(F.ceil(F.col("n") / LOAD), F.least(F.ceil(F.col("n") / LIGHT), F.ceil(F.col("n") / LOAD) * spread)).cast("long").alias("shares"))
        own = trees.join(shares, TREE).select(*TREE, F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"), "pages")
        dealt = asks.join(shares, TREE).withColumn("share", F.pmod(F.xxhash64("key"), "shares")).drop("shares")
        rows = own.unionByName(dealt, allowMissingColumns=True).repartition(min(2 * spread * places, 100_000), *TREE, "share").sortWithinPartitions(*TREE, "share", F.col("pages").isNull())
        answers = rows.select("pages", "key", "query_id", "ints", "least", "dim").mapInArrow(lambda batches: search(batches, k), "key long, query_id long, vec_id long, row long, score long")
        answers = materialize(answers, "answers")
        discard(asks)
        return answers

    near = found(asked.withColumn("least", F.lit(None).cast("double")), True)
    bounds = near.groupBy("key").agg(F.when(F.count("*") == k, F.min("score")).cast("double").alias("least"))
    far = found(asked.join(bounds, "key", "left"), False)
    order = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id", "row")
    ranked = near.union(far).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    discard(trees, vectors)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""
