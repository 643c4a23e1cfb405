"""Near-duplicate documents: MinHash banding with sequential Bayesian verification.

1. Every document becomes its set of five-word shingles, the set's fingerprint and a MinHash signature.
   Equal sets are one node from here on.
2. Signatures are cut into bands; nodes that agree on a band are candidates. A group of them is never
   expanded into all pairs: each node is first compared with the head of one of its groups, then with its
   best matches, and verified links become components. What is left, groups that still hold several
   components, is compared exhaustively: its nodes are dealt into blocks, and every block meets the others in
   a task of its own.
3. A candidate pair's signatures are compared batch by batch. After each batch the pair is dropped if the
   posterior probability that its similarity reaches the threshold is below ``MISS``.
4. Survivors are verified exactly on full sets, and the verified links give the components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import binary_texts, discard, lean, materialize, release, sweep
from lamina.llm.components import connected_components, spread_join
from lamina.llm.shingles import shingle_set

BANDS, ROWS = 24, 5
HASHES = 128
BATCH = 32
#: Probability, under a uniform prior, up to which a pair may still reach the threshold when it is dropped.
MISS = 1e-6
#: Nodes in a block of a group that is compared all against all; blocks bound the memory of a task.
BLOCK = 512
#: Shingles in a slice of a set: larger sets are compared slice by slice.
SLICE_BITS = 17
#: Nodes that a hub's set meets in one row when pairs are verified.
STAR = 64
#: Nodes (id, fingerprint) that may be sent to all executors at once, some 64 MB; beyond it, a shuffle join.
BROADCAST_IDS = 1_000_000

_rng = np.random.default_rng(20240229)
_XOR = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_ODD = _rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_BAND = _rng.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), 256):
        y = (x[at : at + 256, None] ^ _XOR) * _ODD
        y ^= y >> np.uint32(16)
        np.minimum(out, (y * np.uint32(0x85EBCA6B)).min(0), out=out)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key for each node and band."""
    s = signatures[:, : BANDS * ROWS].astype(np.uint64).reshape(-1, BANDS, ROWS)
    h = ((s + np.uint64(1)) * _BAND).sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(32))).astype(np.int64)


def least_matches(threshold: float, miss: float) -> list[tuple[int, int]]:
    """(hashes compared, matches below which a pair is dropped): the posterior after m matches in n, from a
    uniform prior, reaches the threshold with probability P(Binomial(n + 1, threshold) <= m)."""
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def survivors(left: np.ndarray, right: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Positions of the pairs of signatures that no batch drops; ``left`` and ``right`` row by row."""
    alive, matches, done = np.arange(len(left)), np.zeros(len(left), dtype=np.int64), 0
    for n, least in bounds:
        matches = matches + (left[alive, done:n] == right[alive, done:n]).sum(1)
        kept = matches >= least
        alive, matches, done = alive[kept], matches[kept], n
    return alive


def _sketch(docs: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            for at in range(0, b.num_rows, 512):
                sizes, prints, signs = [], [], []
                for data in binary_texts(b.column(1).slice(at, 512)):
                    s = shingle_set(data)
                    sizes.append(len(s))
                    prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    signs.append(signature(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, 512).cast(pa.int64()), b.column(2).slice(at, 512), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(signs, pa.binary())],
                    names=["doc_id", "text_hash", "n", "print", "sign"],
                )

    return docs.select("doc_id", "text", _text_hash().alias("text_hash")).mapInArrow(run, "doc_id long, text_hash long, n long, print binary, sign binary")


def _text_hash() -> Column:
    return F.xxhash64("text")


def _order(doc_id: str = "doc_id") -> Column:
    """By which the first row of a group is found: ids first, null last, then the text."""
    return F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("doc_id"), F.col("text_hash").alias("text_hash"))


def _bands(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                signs = np.frombuffer(b"".join(b.column(1).to_pylist()), dtype=np.uint32).reshape(-1, HASHES)
                node = np.repeat(b.column(0).to_numpy(), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(band_keys(signs).ravel()), pa.array(node)], names=["key", "node"])

    return nodes.select("node", "sign").mapInArrow(run, "key long, node long")


def _sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """Full sets of the ``n`` nodes of ``wanted`` (node, bits, doc_id, text_hash, print), in ``2**bits`` slices by
    hash value, written to files. A node's text is found by its hash, and its doc_id where it has one; of rows that
    repeat it each task takes one."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_hash().alias("text_hash"))
    asked = wanted.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    same = (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    texts = texts.join(F.broadcast(asked) if n <= BROADCAST_IDS else asked, same).select("node", "bits", "print", "text")

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        done: set[tuple[int, int]] = set()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                rows: list[list] = [[], [], [], []]
                for node, bits, print_, data in zip(*(part.column(i).to_pylist() for i in range(3)), binary_texts(part.column(3)), strict=True):
                    if (node, bits) in done:
                        continue
                    done = done if len(done) < 1_000_000 else set()
                    s = shingle_set(data)
                    if hashlib.blake2b(s.tobytes(), digest_size=16).digest() != print_:
                        continue  # another text with the same hash
                    done.add((node, bits))
                    edges = np.searchsorted(s >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)) if bits else [0, len(s)]
                    for k in range(1 << bits):
                        for column, value in zip(rows, (node, bits, k, s[edges[k] : edges[k + 1]].tobytes()), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["node", "bits", "slice", "shingles"])

    return materialize(texts.mapInArrow(sets, "node long, bits int, slice int, shingles binary").dropDuplicates(["node", "bits", "slice"]), "sets")


def _exact(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b; nodes, a being the one that may be in very many) whose full sets reach the
    threshold. The set of a is sent once for each ``STAR`` others, not to every pair."""
    size = nodes.select("node", "n")
    sized = pairs.join(size.withColumnsRenamed({"node": "a", "n": "na"}), "a").join(size.withColumnsRenamed({"node": "b", "n": "nb"}), "b")
    # sets of sizes too far apart can't reach the threshold
    sized = sized.where(F.col("na") * 100 >= F.col("nb") * percent).where(F.col("nb") * 100 >= F.col("na") * percent)
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest("na", "nb").cast("double"))).cast("int") - SLICE_BITS)
    sized = materialize(sized.withColumn("bits", bits), "pairs")
    wanted = sized.select(F.col("a").alias("node"), "bits").union(sized.select(F.col("b").alias("node"), "bits")).distinct()
    wanted = materialize(wanted.join(nodes.select("node", "doc_id", "text_hash", "print"), "node"), "wanted")
    found = _sets(docs, wanted, wanted.count())
    # a star is a hub with some STAR others, fewer if their sets are large: a hub may have too many for one task
    stars = F.ceil(F.greatest(F.count("*") / STAR, F.sum("nb") / (1 << SLICE_BITS + 3))).cast("long")
    hubs = materialize(sized.groupBy("a", "bits").agg(stars.alias("stars")), "hubs")
    n, own = sized.count(), ["a", "na", "bits", "slice", "star"]
    dealt = sized.join(F.broadcast(hubs) if n <= BROADCAST_IDS else hubs, ["a", "bits"]).withColumn("star", F.pmod(F.xxhash64("b"), "stars"))
    sliced = materialize(dealt.withColumn("slice", F.explode(F.expr("sequence(0, shiftleft(1, bits) - 1)"))).select(*own, "b", "nb"), "sliced")
    centers = sliced.select(*own).distinct()
    small = sliced.count() <= BROADCAST_IDS // 4  # what is broadcast: slices, not pairs

    def with_sets(rows: DataFrame, node: str) -> DataFrame:
        keyed = rows.withColumn("node", F.col(node))
        return found.join(F.broadcast(keyed) if small else keyed, ["node", "bits", "slice"])

    no = F.lit(None).cast("long")
    hub_rows = with_sets(centers, "a").select(*own, no.alias("b"), no.alias("nb"), "shingles")
    rows = hub_rows.union(with_sets(sliced, "b").select(*own, "b", "nb", "shingles"))
    met = rows.groupBy(*own).agg(F.collect_list(F.struct("b", "nb", "shingles")).alias("of"))

    def common(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, na, cell = batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), batch.column(2).slice(i, 1).flatten()
                others = list(zip(cell.field(0).to_pylist(), cell.field(1).to_pylist(), (np.frombuffer(x, dtype=np.uint64) for x in cell.field(2).to_pylist()), strict=True))
                hub = next(x for b, _, x in others if b is None)
                both = [(a, b, na, nb, len(np.intersect1d(hub, x, assume_unique=True))) for b, nb, x in others if b is not None]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*both, strict=True)], names=["a", "b", "na", "nb", "both"])

    counted = met.select("a", "na", "of").mapInArrow(common, "a long, b long, na long, nb long, both long")
    total = counted.groupBy("a", "b", "na", "nb").agg(F.sum("both").alias("both"))
    verified = materialize(total.where(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent).select("a", "b"), "verified")
    discard(sized, wanted, found, hubs, sliced)
    return verified


def _compared(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` that the sequential comparison of signatures doesn't drop."""
    bounds = least_matches(percent / 100, MISS)
    signs = nodes.select("node", "sign")
    joined = pairs.join(signs.withColumnsRenamed({"node": "a", "sign": "sa"}), "a").join(signs.withColumnsRenamed({"node": "b", "sign": "sb"}), "b")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), dtype=np.uint32).reshape(-1, HASHES) for k in (2, 3))
                kept = pa.array(survivors(x, y, bounds))
                yield pa.RecordBatch.from_arrays([b.column(0).take(kept), b.column(1).take(kept)], names=["a", "b"])

    return joined.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _mixed(groups: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """key, node, n, component, head (the least component), block and blocks of the nodes of groups that hold
    several components. Blocks have about BLOCK nodes or 2**SLICE_BITS shingles, whatever the group's size."""
    own = groups.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    own = materialize(own.join(nodes.select("node", "n"), "node"), "own")
    mixed = own.groupBy("key").agg(F.count("*").alias("size"), F.sum("n").alias("total"), F.min("component").alias("head"), F.max("component").alias("last")).where("head <> last")
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("total") / (1 << SLICE_BITS))).cast("long")
    mixed = materialize(mixed.select("key", "head", blocks.alias("blocks")), "keys")
    rows = spread_join(own, mixed, "key", mixed.count())
    rows = materialize(rows.withColumn("block", F.pmod(F.xxhash64("node"), "blocks")), "mixed")
    discard(own, mixed)
    return rows


def _met(rows: DataFrame, *columns: str) -> DataFrame:
    """Each block of a group's nodes (x) with each block of those outside its head's component (y). The blocks y
    are sent to every block x, so a large group is spread over as many keys as it has blocks."""
    packed = F.collect_list(F.struct(*columns))  # of a bounded block
    every = rows.groupBy("key", "block").agg(packed.alias("x")).select("key", "block", "x")
    others = rows.where("component <> head").groupBy("key", "block", "blocks").agg(packed.alias("y"))
    others = others.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "y")
    return every.join(others, ["key", "block"]).select("x", "y", "key")


def _side(batch: pa.RecordBatch, column: int, row: int) -> tuple:
    cell = batch.column(column).slice(row, 1).flatten()
    sign = np.frombuffer(b"".join(cell.field(3).to_pylist()), dtype=np.uint32).reshape(-1, HASHES)
    return cell.field(0).to_numpy(), cell.field(1).to_numpy(), cell.field(2).to_numpy(), sign, cell


def _best(rows: DataFrame, nodes: DataFrame, percent: int, ranks: slice, least_n: int = 0) -> DataFrame:
    """Surviving pairs of nodes that share a group but not a component, one of them with ``least_n`` shingles:
    for each node outside the head's component those of a block with these ``ranks``, most matches first."""
    bounds = least_matches(percent / 100, MISS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                (xn, xc, xk, xs, _), (yn, yc, yk, ys, _) = (_side(b, k, i) for k in (0, 1))
                pairs: set[tuple[int, int]] = set()
                for node, component, n, sign in zip(yn, yc, yk, ys, strict=True):
                    other = np.flatnonzero((xc != component) & (np.maximum(xk, n) >= least_n))
                    left = xs[other]
                    kept = survivors(left, np.broadcast_to(sign, left.shape), bounds)
                    kept = kept[np.argsort(-(left[kept] == sign).sum(1), kind="stable")[ranks]]
                    pairs.update((min(int(m), int(node)), max(int(m), int(node))) for m in xn[other[kept]])
                if pairs:
                    a, c = zip(*sorted(pairs), strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64())], names=["a", "b"])

    signed = rows.join(nodes.select("node", "sign"), "node")
    return _met(signed, "node", "component", "n", "sign").mapInArrow(run, "a long, b long").distinct()


def _in_question(xk: np.ndarray, xc: np.ndarray, xs: np.ndarray, xb: np.ndarray, n: int, component: int, sign: np.ndarray, bands: np.ndarray, key: int, bounds: list, percent: int) -> np.ndarray:
    """Positions of the nodes of other components that a node has to be verified with in this group: sizes fit,
    signatures aren't dropped, and the group is the first band that the two share. Most matches first."""
    other = np.flatnonzero((xc != component) & (np.minimum(xk, n) * 100 >= np.maximum(xk, n) * percent))
    other = other[survivors(xs[other], np.broadcast_to(sign, (len(other), HASHES)), bounds)]
    same = xb[other] == bands
    other, same = (a[bands[same.argmax(1)] == key] for a in (other, same)) if len(other) else (other, same)
    return other[np.argsort(-(xs[other] == sign).sum(1), kind="stable")]


def _rest(docs: DataFrame, nodes: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components that share a group: all pairs that no batch of signatures drops are
    verified on full sets, inside their blocks, until nothing new can be joined. Every pair is looked at in
    the first band that it shares; a pair of nodes that a link of the same block has joined meanwhile is
    skipped. So rows come out for links alone, at most one for each node of a block."""
    bounds = least_matches(percent / 100, MISS)
    small = rows.where(F.col("n") <= 1 << SLICE_BITS)

    def sides(b: pa.RecordBatch, i: int) -> Iterator[tuple]:
        """For each node of y: its position and those of x that are in question."""
        key = b.column(2)[i].as_py()
        (_, xc, xk, xs, _), (_, yc, yk, ys, _) = (_side(b, k, i) for k in (0, 1))
        xb, yb = band_keys(xs), band_keys(ys)
        for at in range(len(yk)):
            yield at, _in_question(xk, xc, xs, xb, int(yk[at]), int(yc[at]), ys[at], yb[at], key, bounds, percent)

    def asked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                xn, yn = _side(b, 0, i)[0], _side(b, 1, i)[0]
                found: set[int] = set()
                for at, other in sides(b, i):
                    if len(other):
                        found.add(int(yn[at]))
                        found.update(xn[other].tolist())
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([b.column(2)[i].as_py()] * len(found), pa.int64()), pa.array(sorted(found), pa.int64())], names=["key", "node"])

    signed = small.join(nodes.select("node", "sign"), "node")
    needed = materialize(_met(signed, "node", "component", "n", "sign").mapInArrow(asked, "key long, node long").distinct(), "needed")
    small = small.join(needed, ["key", "node"], "left_semi")
    wanted = needed.select("node").distinct().join(nodes.select("node", "doc_id", "text_hash", "print"), "node").withColumn("bits", F.lit(0))
    wanted = materialize(wanted, "wanted")
    sets = _sets(docs, wanted, wanted.count())
    full = sets.select("node", "shingles").join(nodes.select("node", "sign"), "node")
    with_sets = small.join(full, "node")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                (xn, xc, xk, _, x), (yn, yc, yk, _, y) = (_side(b, k, i) for k in (0, 1))
                xsets, ysets = ([np.frombuffer(v, dtype=np.uint64) for v in c.field(4).to_pylist()] for c in (x, y))
                links = []
                for at, other in sides(b, i):
                    for j in other:
                        if xc[j] == yc[at]:
                            continue
                        both = len(np.intersect1d(xsets[j], ysets[at], assume_unique=True))
                        if both * 100 >= (int(xk[j]) + int(yk[at]) - both) * percent:
                            links.append(sorted((int(xn[j]), int(yn[at]))))
                            old, new = yc[at], xc[j]
                            xc, yc = np.where(xc == old, new, xc), np.where(yc == old, new, yc)
                if links:
                    a, c = zip(*links, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64())], names=["a", "b"])

    links = materialize(_met(with_sets, "node", "component", "n", "sign", "shingles").mapInArrow(run, "a long, b long").distinct(), "links")
    discard(needed, wanted, sets)
    return links


def _large(docs: DataFrame, nodes: DataFrame, members: DataFrame, labels: DataFrame, tried: list[DataFrame], percent: int) -> DataFrame:
    """Components after the links of sets that are too large for a block. Nodes are compared with their best
    matches in other components first; once these give no link any more, with those of the next ranks, until no
    node has any left. A link between two components ends all other questions between them."""
    low, high, own = 0, 2, []
    while True:
        rows = _mixed(members, nodes, labels)
        found = _best(rows, nodes, percent, slice(low, high), (1 << SLICE_BITS) + 1)
        asked = materialize(found, "large")
        more = asked.head(1)
        own.append(asked)
        pairs = asked
        for t in tried:
            pairs = pairs.join(t, ["a", "b"], "left_anti")
        links = _exact(docs, nodes, pairs, percent) if more else None
        discard(rows)
        if not more:
            discard(*own)
            return labels
        tried = [*tried, asked]
        if links.head(1):
            labels, low, high = _joined(labels, links), 0, 2
        else:
            low, high = high, 3 * high
        discard(links)


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: each node's link to its component's head stands for the links so far."""
    sweep(labels.sparkSession)
    joined = connected_components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links.select("a", "b")))
    discard(labels)
    return joined


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of at least ``percent`` / 100 of shingle sets.

    A row for each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id (the smallest doc_id that
    can be reached over links, its own included) and kept (doc_id = component_id). Null and blank texts have
    no shingles and link with nothing; repeated rows are copies of each other; rows with one doc_id but
    different texts are linked by their own texts; a null doc_id only has a component if it is linked with others,
    and is kept only without one. An empty table gives no rows. Other columns are ignored.
    """
    return _grouped(docs, percent).select("doc_id", "n_shingles", "component_id", "kept")


def keep_first(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns.

    It is the one with the smallest doc_id; among rows with that doc_id (or only null ones) and different texts,
    one text stays, and of rows that repeat it one. Documents without words are copies of nothing: their rows all
    stay, whatever else the table holds. Which rows of a group stay never depends on rows of other groups.
    """
    rows = _grouped(docs, percent).where("n_shingles > 0")
    named = rows.groupBy("doc_id", "text_hash").agg(F.bool_or("first").alias("first"), F.count("*").alias("n")).where("not first or n > 1")
    named = materialize(named.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash", "first": "_first"}).drop("n"), "named")
    same = docs["doc_id"].cast("long").eqNullSafe(named["_id"]) & (F.xxhash64(docs["text"]) == named["_hash"])
    others = docs.join(named, same, "left_anti")
    repeated = docs.join(named.where("_first"), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return others.unionByName(repeated)


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept, and whether it is the row that stands for its group
    (``first``; of rows that repeat it, all)."""
    sketch = materialize(_sketch(lean(docs)), "sketch")
    grouped = sketch.where("n > 0").groupBy("print").agg(F.min(_order()).alias("first"), F.first("n").alias("n"), F.first("sign").alias("sign"))
    nodes = grouped.select("print", "n", "sign", "first.doc_id", "first.text_hash").withColumn("node", F.monotonically_increasing_id())
    nodes = materialize(nodes, "nodes")

    bands = materialize(_bands(nodes), "bands")
    heads = bands.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct(F.xxhash64("node", "key"), "node")).alias("head")).where("size > 1")
    heads = materialize(heads.select("key", F.col("head.node").alias("head")), "heads")
    groups = materialize(spread_join(bands, heads, "key", heads.count()), "groups")
    shared = groups.where("node <> head").groupBy("node", "head").count()
    first = shared.groupBy("node").agg(F.max(F.struct("count", "head")).alias("best"))
    first = first.select(F.col("best.head").alias("a"), F.col("node").alias("b")).distinct()
    compared = materialize(_compared(first, nodes, percent), "compared")
    tried = compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = _exact(docs, nodes, compared, percent)
    labels = connected_components(links)
    members = groups.select("key", "node")
    rows = _mixed(members, nodes, labels)
    pairs = materialize(_best(rows, nodes, percent, slice(0, 2)).join(tried, ["a", "b"], "left_anti"), "best")
    discard(bands, heads, links, rows)
    links = _exact(docs, nodes, pairs, percent)
    labels = _joined(labels, links)
    discard(links)
    rows = _mixed(members, nodes, labels)
    more = _rest(docs, nodes, rows, percent)
    if more.head(1):
        labels = _joined(labels, more)
    discard(rows, more)
    if nodes.where(F.col("n") > (1 << SLICE_BITS)).head(1):
        labels = _large(docs, nodes, members, labels, [tried, pairs], percent)

    component = nodes.join(labels, "node", "left").select("print", "doc_id", "text_hash", F.coalesce("component", "node").alias("component"))
    component = materialize(component, "members")
    smallest = materialize(component.groupBy("component").agg(F.min(_order()).alias("least")), "least")
    n = nodes.count()
    of_print = materialize(spread_join(component.select("print", "component"), smallest, "component", n).select("print", "least"), "prints")
    rows = sketch.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("print")).alias("print"))
    found = rows.join(of_print, "print", "left").select(
        "doc_id", "text_hash", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("least.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))).alias("first"),
    )
    result = materialize(found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "groups")
    discard(sketch, nodes, groups, compared, pairs, labels, component, smallest, of_print)
    return result
