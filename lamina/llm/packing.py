"""Best-fit decreasing packing of token sequences into fixed windows.

Every document's ids (with an end id) are first cut into full windows; what is left, shorter than a window,
is packed best-fit decreasing. The order among pieces of one length doesn't matter to best fit, so the whole
corpus is planned exactly from its histogram of lengths: ``plan`` keeps the open windows in a segment tree
indexed by remaining capacity, finds the tightest one that still takes the length, and places runs of equal
pieces at once. The plan has a few rows for each length, however many documents there are; it is sent to
the executors, which turn each piece's rank within its length into a window and an offset.

Windows that best fit leaves with more than ``spare`` ids of padding are given up again: their pieces are
laid end to end and cut at the window size. So nearly nothing is padded even where one length dominates.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.common import binary_texts, lean, materialize
from lamina.llm.tokens import encoder


#: Poured pieces that may be sent to all executors (some 80 bytes each).
BROADCAST_PIECES = 200_000


class CapacityTree:
    """Segment tree over remaining capacities: how many groups of open windows have each."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, n: int) -> None:
        at = self.size + capacity
        while at:
            self.count[at] += n
            at //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` that an open window has."""
        at = self.size + least
        if self.count[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def plan(counts: dict[int, int], capacity: int, spare: int) -> list[dict]:
    """Intervals of ranks of each length, with the place of their pieces.

    An interval of windows has ``bin`` (its first window), ``per`` (pieces of this length in each window) and
    ``offset``; piece of rank r goes to window ``bin + (r - first) // per``. One with ``bin`` -1 is poured:
    its pieces lie end to end from position ``offset`` of a stream that is cut at ``capacity``, whose first
    window is ``pour``.
    """
    tree = CapacityTree(capacity)
    open_: dict[int, list[tuple[int, int]]] = {}  # remaining capacity -> [(first window, windows)]
    placed: list[dict] = []
    windows = 0

    def put(left: int, first: int, n: int) -> None:
        if n:
            open_.setdefault(left, []).append((first, n))
            tree.add(left, 1)

    def place(length: int, rank: int, n: int, first: int, room: int) -> tuple[int, int]:
        """Fill the windows from ``first``, each with ``room``; the pieces and windows used."""
        per = room // length
        for used, each in ((n // per, per), (int(n % per > 0), n % per)):
            if used:
                placed.append({"length": length, "first": rank, "n": used * each, "bin": first, "per": each, "offset": capacity - room})
                put(room - each * length, first, used)
                rank, first = rank + used * each, first + used
        return n, -(-n // per)

    for length in range(capacity, 0, -1):
        n, rank = counts.get(length, 0), 0
        while n:
            room = tree.tightest(length)
            if room is None:
                used, bins = place(length, rank, n, windows, capacity)
                windows += bins
            else:
                first, bins = open_[room].pop()
                tree.add(room, -1)
                used = min(n, bins * (room // length))
                _, taken = place(length, rank, used, first, room)
                put(room, first + taken, bins - taken)
            n, rank = n - used, rank + used

    def padded(left: int) -> bool:
        return left > spare and (capacity - left) & (capacity - left - 1) != 0

    given_up = sorted((first, first + n) for left, groups in open_.items() if padded(left) for first, n in groups)
    starts = [a for a, _ in given_up]
    out, position = [], 0
    for p in placed:
        at, end = p["bin"], p["bin"] + p["n"] // p["per"]
        while at < end:  # the interval's windows, cut where given-up windows begin and end
            k = bisect_right(starts, at) - 1
            inside = k >= 0 and at < given_up[k][1]
            stop = min(end, given_up[k][1] if inside else (starts[k + 1] if k + 1 < len(starts) else end))
            part = p | {"first": p["first"] + (at - p["bin"]) * p["per"], "n": (stop - at) * p["per"], "bin": -1 if inside else at, "pour": windows}
            if inside:
                part["offset"], position = position, position + part["n"] * p["length"]
            out.append(part)
            at = stop
    return sorted(out, key=lambda x: (x["length"], x["first"]))


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, cache: int) -> DataFrame:
    """Pieces of documents: full windows and the rest, each with its rank among the pieces of its length in
    its task, and for the rests (which may be cut again) the ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, coder, end = TaskContext.get().partitionId(), encoder(tokenizer, limit=cache), end_id.to_bytes(4, "little")
        seen = [0] * (capacity + 1)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for at in range(0, len(keys), 512):
                rows: list[list] = [[] for _ in range(8)]
                texts = binary_texts(batch.column(1).slice(at, 512))
                for doc_id, coded in zip(keys[at : at + 512], coder.encode_documents(texts), strict=True):
                    ids = coded + end
                    total = len(ids) // 4
                    for start in range(0, total, capacity):
                        raw = ids[4 * start : 4 * (start + capacity)]
                        n = len(raw) // 4
                        for column, value in zip(rows, (doc_id, start, n, zlib.crc32(raw), total, part, seen[n], raw if n < capacity else None), strict=True):
                            column.append(value)
                        seen[n] += 1
                types = [pa.int64()] * 7 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=PIECE.replace(" long", "").replace(" binary", "").split(", "))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECE)


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, nth long, ids binary"
RESULT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 1024, spare: int = 16, cache: int = 1_500_000) -> DataFrame:
    """Pack all rows of ``docs`` (doc_id, text) into sequences of at most ``capacity`` ids.

    A row for each piece: doc_id, start (its document's ids before it), length, ids_crc32, doc_tokens,
    sequence_id and offset in the sequence, gapless from 0. Null text counts as empty: its only id is the end
    id. Repeated rows are packed once each; a null doc_id stays null; other columns are ignored. An empty
    table gives no rows. ``cache``: words whose ids a worker keeps.
    """
    spark = docs.sparkSession
    pieces = materialize(cut_documents(lean(docs), tokenizer, end_id, capacity, cache), "pieces")
    slim = pieces.drop("ids")
    by_part = slim.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counts = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    intervals = plan(counts, capacity, spare)
    names = ("length", "first", "n", "bin", "per", "offset", "pour")
    table = spark.sparkContext.broadcast({k: np.array([x[k] for x in intervals], dtype=np.int64) for k in names})
    ranked = slim.join(offsets.select("length", "part", "before"), ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth"))

    def locate(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The interval of each piece: the last one that begins at or before it."""
        t = table.value
        top = int(max(t["first"].max(), rank.max())) + 1
        return np.searchsorted(t["length"] * top + t["first"], length * top + rank, side="right") - 1

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            t = table.value
            length, rank = (b.column(b.schema.get_field_index(k)).to_numpy() for k in ("length", "rank"))
            at = locate(length, rank)
            r, poured = rank - t["first"][at], t["bin"][at] < 0
            per = t["per"][at]
            sequence = np.where(poured, -1, t["bin"][at] + r // per)
            offset = np.where(poured, t["offset"][at] + r * length, t["offset"][at] + (r % per) * length)
            own = {k: b.column(b.schema.get_field_index(k)) for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth")}
            own |= {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            names = (RESULT + ", part, nth").replace(" long", "").split(", ")
            yield pa.RecordBatch.from_arrays([own[k] for k in names], names=names)

    placed = materialize(ranked.mapInArrow(place, RESULT + ", part long, nth long"), "placed")
    whole = placed.where("sequence_id >= 0").drop("part", "nth")
    pour = max((x["pour"] for x in intervals), default=0)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of the stream, cut at the window size; a piece is shorter, so in two at most."""
        for b in batches:
            rows: list[list] = [[] for _ in range(7)]
            for r in b.to_pylist():
                done, position = 0, r["offset"]
                while done < r["length"]:
                    n = min(r["length"] - done, capacity - position % capacity)
                    raw = r["ids"][4 * done : 4 * (done + n)]
                    for column, value in zip(rows, (r["doc_id"], r["start"] + done, n, zlib.crc32(raw), r["doc_tokens"], pour + position // capacity, position % capacity), strict=True):
                        column.append(value)
                    done, position = done + n, position + n
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=RESULT.replace(" long", "").split(", "))

    loose = placed.where("sequence_id < 0").select("doc_id", "start", "length", "doc_tokens", "offset", "part", "nth")
    ids = pieces.where("ids is not null").select("part", "nth", "length", "ids")
    if sum(x["n"] for x in intervals if x["bin"] < 0) <= BROADCAST_PIECES:
        loose = F.broadcast(loose)  # else both sides are shuffled
    recut = loose.join(ids, ["part", "nth", "length"]).select("doc_id", "start", "length", "doc_tokens", "offset", "ids")
    return whole.unionByName(recut.mapInArrow(cut, RESULT))
