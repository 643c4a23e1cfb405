"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are partitioned by size, and a document is seen as overlapping windows of the size that a partition needs, so
a passage that holds an item lies in one window whose size is bounded: containment in a long document becomes a
Jaccard similarity with a lower bound that doesn't depend on the document's length. An item is a candidate if any value
of its signature agrees with a window's (bands of one row, which keep recall highest). There are two kinds of signatures:

- of items that fill them, one least value in each of ``BINS`` bins, over windows of twice the partition's size that
  overlap by half;
- of smaller items, the least values under ``HASHES`` independent hashes, over tighter windows: partitions are a root of
  two apart, and windows begin at every quarter of their length.

An item's kind follows from the probability, at most ``MISS``, that its signature overlooks it. Sets of at most ``SMALL``
distinct shingles, and sets far smaller than the number of their positions (long items that repeat themselves), are their
own signature: nothing in common with a document is overlooked. Every candidate is verified by exact containment of its
shingles in the whole document.

Items with the same shingles are one set. The sets' signatures are sent to the executors in blocks whose size is
counted, one pass for each block, and one block at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import binary_texts, discard, lean, materialize, release, scratch
from lamina.llm.shingles import shingle_hashes, shingle_set, word_hashes

BINS = 64
SMALL = 8
#: Independent hashes of a small item's signature, and positions whose hashes are in memory at a time.
HASHES, SEGMENT = 40, 1 << 13
#: Probability up to which signatures may miss an item that stands in one window.
MISS = 1e-6
#: Shingles of test items that one pass holds in memory, at most (8 bytes each, and their signatures); a single
#: item that is larger has a pass of its own.
BLOCK_SHINGLES = 2_000_000
#: Entries of the filters that values of signatures pass: a small one first, that stays in a core's cache.
_FIRST, _FILTER = 1 << 16, 1 << 20


class ItemIndex:
    """Items (id, sorted shingles, positions) with the signatures of each size partition."""

    def __init__(self, items: list[tuple[int, np.ndarray, int]]):
        self.ids, self.sets, self.positions = [i for i, _, _ in items], [s for _, s, _ in items], [p for _, _, p in items]
        self.partition()

    def partition(self, percent: int = 80) -> ItemIndex:
        """Divide the items for a search at ``percent``."""
        partitions: dict[int, list[int]] = {}
        for at, (s, positions) in enumerate(zip(self.sets, self.positions, strict=True)):
            if len(s):
                partitions.setdefault(kind_of(len(s), positions, percent), []).append(at)
        self.partitions, self.steps = [], sorted(step for kind, step in partitions if kind == "hashes")
        for c, members in sorted(partitions.items()):
            signs = [self.sets[m] if c[0] == "all" else bin_minima(self.sets[m]) if c[0] == "bins" else _wide(hashed(self.sets[m]).min(axis=0)) for m in members]
            keys, owner = np.concatenate(signs), np.repeat(members, [len(s) for s in signs])
            order = np.argsort(keys, kind="stable")
            known = np.zeros(_FILTER, dtype=bool)
            known[(keys >> np.uint64(40)).astype(np.int64) & (_FILTER - 1)] = True
            first = np.zeros(_FIRST, dtype=bool)
            first[(keys >> np.uint64(32)).astype(np.uint16)] = True
            self.partitions.append((c, keys[order], owner[order], first, known))
        return self

    def candidates(self, h: np.ndarray) -> set[int]:
        """Items with a signature value in common with a window of the positions ``h``."""
        found: set[int] = set()
        tight = tight_minima(h, self.steps) if self.steps else {}
        for (kind, size), keys, owner, first, known in self.partitions:
            if kind == "hashes":  # few of very many are known, and only these get 64 bits
                values = _wide(np.concatenate([x[first.take(x.astype(np.uint16))] for x in tight[size]]))
            else:
                values = h if kind == "all" else window_minima(h, size)
            values = values[known[(values >> np.uint64(40)).astype(np.int64) & (_FILTER - 1)]]
            if len(values):
                low, high = np.searchsorted(keys, values, "left"), np.searchsorted(keys, values, "right")
                for a, b in set(zip(low[high > low].tolist(), high[high > low].tolist(), strict=True)):
                    found.update(owner[a:b].tolist())
        return found

    def leaks(self, h: np.ndarray, percent: int) -> list[tuple[int, int, int]]:
        """(item, its shingles, those in the document) of the items that the document contains."""
        candidates = self.candidates(h) if len(h) else ()
        if not candidates:
            return []
        own, out = np.unique(h), []
        for at in sorted(candidates):
            s = self.sets[at]
            where = np.minimum(np.searchsorted(own, s), len(own) - 1)
            shared = int((own[where] == s).sum())
            if shared * 100 >= percent * len(s):
                out.append((self.ids[at], len(s), shared))
        return out


def miss(shingles: int, window: int, percent: int) -> float:
    """At most how probable it is that no bin agrees, of an item of so many distinct shingles and a window of so
    many positions that holds ``percent`` of them: the similarity is the chance of each bin that the item fills."""
    shared = shingles * percent / 100
    filled = BINS * (1 - (1 - 1 / BINS) ** shingles)
    return max(0.0, 1 - shared / (window + shingles - shared)) ** filled


def step_for(positions: int) -> int:
    """The step, of a ladder of roots of two, of the smallest windows of four steps in one of which so many positions lie,
    wherever they begin."""
    k = 0
    while 3 * round(2 ** (k / 2)) + 1 < positions:
        k += 1
    return round(2 ** (k / 2))


def kind_of(shingles: int, positions: int, percent: int) -> tuple[str, int]:
    """How an item is looked for: by all its shingles, by bins over windows (and half their size), or by hashes over
    tight windows (and their step)."""
    half, step = 1 << (positions - 1).bit_length(), step_for(positions + positions // 8)  # words may have been put in
    if shingles <= SMALL:
        return "all", 0
    if miss(shingles, 2 * half, percent) <= MISS:
        return "bins", half
    shared = shingles * percent / 100
    similar = shared / (4 * step + shingles - shared)
    return ("hashes", step) if (1 - similar) ** HASHES <= MISS else ("all", 0)


_RANDOM = np.random.default_rng(17).integers(0, 1 << 32, (2, HASHES), dtype=np.uint32)


def hashed(h: np.ndarray) -> np.ndarray:
    """Shingles under each of the independent hashes: (position, hash), 32 bits each."""
    x = (h >> np.uint64(32)).astype(np.uint32)[:, None] ^ _RANDOM[0]
    x *= _RANDOM[1] | np.uint32(1)
    return x


def _wide(x: np.ndarray) -> np.ndarray:
    """Hashes in the upper half of 64 bits, as signatures of all kinds are looked up alike."""
    return x.ravel().astype(np.uint64) << np.uint64(32)


def _least(x: np.ndarray, step: int) -> np.ndarray:
    """The least of each ``step`` rows, those of the last ones that are left over too."""
    whole = len(x) // step
    parts = [x[: whole * step].reshape(whole, step, x.shape[1]).min(axis=1)] if whole else []
    return np.concatenate([*parts, x[whole * step :].min(axis=0, keepdims=True)]) if len(x) > whole * step else parts[0]


def tight_minima(h: np.ndarray, steps: list[int]) -> dict[int, list[np.ndarray]]:
    """For each step the least values, 32 bits each, of the windows of four steps that begin at every step, segment by
    segment. Segments of a text overlap by the longest window, so memory is bounded whatever the text's length."""
    found: dict[int, list[np.ndarray]] = {step: [] for step in steps}
    longest = 4 * steps[-1]
    for at in range(0, max(1, len(h)), SEGMENT):
        x = hashed(h[at : at + SEGMENT + longest])
        least: dict[int, np.ndarray] = {}
        for step in steps:
            least[step] = own = _least(least[step // 2], 2) if step % 2 == 0 and step // 2 in least else _least(x, step)
            two = own.copy()
            np.minimum(two[:-1], own[1:], out=two[:-1])
            four = two.copy()
            np.minimum(four[:-2], two[2:], out=four[:-2])
            found[step].append(four)
        if at + SEGMENT + longest >= len(h):
            break
    return found


def bin_minima(s: np.ndarray) -> np.ndarray:
    """The least value in each bin that has any."""
    out = np.full(BINS, np.iinfo(np.uint64).max)
    np.minimum.at(out, (s & np.uint64(BINS - 1)).astype(np.int64), s)
    return out[out < np.iinfo(np.uint64).max]


def window_minima(h: np.ndarray, half: int) -> np.ndarray:
    """The least values in the bins of windows of ``2 * half`` positions that begin at every ``half``."""
    blocks = -(-len(h) // half)
    out = np.full((blocks, BINS), np.iinfo(np.uint64).max)
    at = (np.arange(len(h)) // half) * BINS + (h & np.uint64(BINS - 1)).astype(np.int64)
    np.minimum.at(out.ravel(), at, h)
    if blocks > 1:
        out = np.minimum(out[:-1], out[1:])
    out = out.ravel()
    return out[out < np.iinfo(np.uint64).max]


def item_sets(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """item_id and set_id of every item, and set_id, shingles, n and positions of the different sets; rows without
    id or words take no part."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            hashed = [shingle_hashes(word_hashes(t)) for t in binary_texts(b.column(1))]
            own = [np.unique(h) for h in hashed]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array([s.tobytes() for s in own], pa.binary()), pa.array([len(s) for s in own], pa.int64()), pa.array([len(h) for h in hashed], pa.int64())],
                names=["item_id", "shingles", "n", "positions"],
            )

    rows = benchmark.select("item_id", "text").where("item_id is not null")
    hashed = rows.mapInArrow(run, "item_id long, shingles binary, n long, positions long").where("n > 0")
    items = materialize(hashed.withColumn("print", F.sha2("shingles", 256)), "items")
    sets = items.groupBy("print", "positions").agg(F.first("shingles").alias("shingles"), F.first("n").alias("n"))
    sets = materialize(sets.withColumn("set_id", F.monotonically_increasing_id()), "item-sets")
    named = items.select("item_id", "print", "positions").join(sets.select("print", "positions", "set_id"), ["print", "positions"])
    members = materialize(named.select("item_id", "set_id"), "members")
    discard(items)
    return members, sets


def set_blocks(sets: DataFrame, block: int = BLOCK_SHINGLES) -> list[tuple[int, int, int]]:
    """(first bucket, the one after the last, buckets) of blocks that hold at most ``block`` shingles, or one bucket.
    Sizes of buckets are counted, some eight for each block."""
    total = sets.agg(F.sum("n")).first()[0] or 0
    n = max(1, -(-8 * total // block))
    out: list[tuple[int, int, int]] = []
    held = 0
    for bucket, size in sorted(tuple(r) for r in sets.groupBy(_bucket(n).alias("bucket")).agg(F.sum("n").alias("size")).collect()):
        if out and held + size <= block:
            out[-1], held = (out[-1][0], bucket + 1, n), held + size
        else:
            out.append((bucket, bucket + 1, n))
            held = size
    return out


def _bucket(n: int) -> Column:
    return F.pmod(F.xxhash64("set_id"), F.lit(n))


def item_blocks(sets: DataFrame, block: int = BLOCK_SHINGLES) -> Iterator[ItemIndex]:
    """Indexes over the sets, one block after the other; the driver holds one at a time."""
    for low, high, n in set_blocks(sets, block):
        chosen = sets.where((_bucket(n) >= low) & (_bucket(n) < high))
        got = sorted((r.set_id, bytes(r.shingles), r.positions) for r in chosen.collect())
        yield ItemIndex([(i, np.frombuffer(s, dtype=np.uint64), p) for i, s, p in got])


def _texts_leaks(index: ItemIndex, percent: int) -> Callable[[bytes], list[tuple[int, int, int]]]:
    return lambda data: index.leaks(shingle_hashes(word_hashes(data)), percent)


LEAK = "doc_id long, set_id long, n_item long, n_shared long"


def find_leaks(docs: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, item_id, n_item and n_shared for each document that contains at least ``percent`` / 100 of the
    distinct five-word shingles of a test item.

    Null and blank texts contain nothing; items of fewer than five words are one shingle, which only a
    document of the same words has. Repeated rows each give their rows; rows with a null doc_id keep it;
    an empty table on either side gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    passes, docs = [], lean(docs)
    members, sets = item_sets(benchmark)
    for index in item_blocks(sets):
        shared = spark.sparkContext.broadcast(index.partition(percent))

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            release()
            leaks = _texts_leaks(shared.value, percent)
            for b in batches:
                keys = b.column(0).to_pylist()
                for at in range(0, len(keys), 512):
                    found = [(k, *x) for k, t in zip(keys[at : at + 512], binary_texts(b.column(1).slice(at, 512)), strict=True) for x in leaks(t)]
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["doc_id", "set_id", "n_item", "n_shared"])

        found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, LEAK)
        passes.append(path := scratch(spark, "leaks"))
        found.write.parquet(path)
        shared.destroy()
    discard(sets)
    found = spark.read.schema(LEAK).parquet(*passes) if passes else spark.createDataFrame([], LEAK)
    return found.join(members, "set_id").select("doc_id", "item_id", "n_item", "n_shared")


def without_leaks(docs: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that contain no test item, with all their columns.

    Null and blank texts contain nothing and stay, rows with a null doc_id are judged like all others, and of
    repeated rows all stay or none. An empty table on either side leaves ``docs`` as it is. Where the items need
    several blocks, what a block leaves is written out before the next one, so executors hold one index.
    """
    spark, docs, before, source = docs.sparkSession, lean(docs), None, None
    _, sets = item_sets(benchmark)
    for index in item_blocks(sets):
        if before is not None:
            docs, old = materialize(docs, "clean"), source
            before.destroy()
            discard(old)
            source = docs
        before = shared = spark.sparkContext.broadcast(index.partition(percent))  # the last one is read later

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            release()
            leaks = _texts_leaks(shared.value, percent)
            for b in batches:
                texts = b.column(b.schema.get_field_index("text"))
                yield b.filter(pa.array([not leaks(t) for at in range(0, b.num_rows, 512) for t in binary_texts(texts.slice(at, 512))], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


ORACLE_SQL = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM benchmark
), doc_shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc_words WHERE len(w) > 0)
), item_shingles AS (
    SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), sizes AS (
    SELECT item_id, count(*) AS n_item FROM item_shingles GROUP BY item_id
), shared AS (
    SELECT d.doc_id, i.item_id, count(*) AS n_shared
    FROM item_shingles i JOIN doc_shingles d ON d.s = i.s GROUP BY d.doc_id, i.item_id
)
SELECT doc_id, item_id, n_item, n_shared FROM shared JOIN sizes USING (item_id) WHERE n_shared * 100 >= 80 * n_item
"""
