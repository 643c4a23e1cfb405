"""Periodic runs of words: stretches that repeat with some period at least ``times`` times and can't be extended.

A run with period p and ``times`` repetitions covers ``times - 1`` neighbouring points of the grid 0, p, 2p, ... whose
words equal those one period on. So for every p only the words at the grid's points are compared, some n/p of them:
n log n over all periods. Periods are probed in blocks [a, 2a), as one matrix of grid points by periods. What
survives is tested at further places between its grid points and then extended to both sides by comparing
chunks of the text with the text one period on. Grid points whose step lies inside a run already found, with a period
that divides p, are passed over: they could only give the same run again.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import binary_texts, lean, release

#: Grid points of a probed matrix, about, and words of the first and largest chunk of an extension.
CELLS, FIRST, LARGEST = 1 << 20, 64, 1 << 16
#: Places, in eighths of the stretch between a survivor's first and last grid point, that are tested before it is extended.
BETWEEN = (1, 2, 3, 5, 6, 7)


def _same_right(w: np.ndarray, at: int, p: int) -> int:
    """The first place from ``at`` whose word differs from the one p on."""
    end, size = len(w) - p, FIRST
    while at < end:
        stop = min(at + size, end)
        differs = w[at:stop] != w[at + p : stop + p]
        first = int(differs.argmax())
        if differs[first]:
            return at + first
        at, size = stop, min(2 * size, LARGEST)
    return end


def _same_left(w: np.ndarray, at: int, p: int) -> int:
    """The first place of the stretch up to ``at`` whose words all equal those p on."""
    size = FIRST
    while at > 0:
        start = max(0, at - size)
        differs = (w[start:at] != w[start + p : at + p])[::-1]
        first = int(differs.argmax())
        if differs[first]:
            return at - first
        at, size = start, min(2 * size, LARGEST)
    return 0


class Found:
    """Runs found so far, by period: within one, neither starts nor ends repeat, so both ascend together."""

    def __init__(self):
        self.by_period: dict[int, list[tuple[int, int]]] = {}
        self.spans: set[tuple[int, int]] = set()

    def add(self, start: int, end: int, period: int) -> None:
        self.by_period.setdefault(period, []).append((start, end))
        self.spans.add((start, end))

    def covers(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Which steps from ``at`` to ``at + period`` lie in a run whose period divides the step."""
        inside = np.zeros(len(at), bool)
        for q, runs in self.by_period.items():
            own = np.flatnonzero((period % q == 0) & (period > q) & ~inside)
            if len(own):
                starts, ends = np.array(runs).T
                k = np.searchsorted(starts, at[own], "right") - 1
                inside[own] = (k >= 0) & (at[own] + period[own] < ends[np.maximum(k, 0)])
        return inside


def _survivors(w: np.ndarray, a: int, b: int, hits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods, a <= period < b, of ``hits`` neighbouring grid points whose words recur one period on;
    by period, then by place."""
    n = len(w)
    periods = np.arange(a, b)
    rows = n // a + 1
    places = np.arange(rows)[:, None] * periods[None, :]
    words = np.where(places < n, w[np.minimum(places, n - 1)], -1 - np.arange(rows, dtype=w.dtype)[:, None])  # no word equals what stands beyond the end
    same = words[:-1] == words[1:]
    good = same[: len(same) - hits + 1].copy()
    for k in range(1, hits):
        good &= same[k : len(same) - hits + 1 + k]
    p, j = np.nonzero(good.T)
    return j * periods[p], periods[p]


def periodic_runs(w: np.ndarray, times: int = 4, shortest: int = 6) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of an integer sequence with at least ``times`` repetitions and
    ``shortest`` members, by start, then period. ``times`` >= 3, as two stretches of a period that share less say
    nothing of a shorter one."""
    n = len(w)
    if times < 3:
        raise ValueError("runs need at least three repetitions")
    found, out = Found(), []
    longest = n // times
    a, hits = 1, times - 1
    while a <= longest:
        b = min(2 * a, longest + 1, a + max(1, CELLS // (n // a + 1)))
        at, period = _survivors(w, a, b, hits)
        for eighth in BETWEEN:
            if len(at):
                place = at + (hits - 1) * period * eighth // 8
                keep = w[place] == w[place + period]
                at, period = at[keep], period[keep]
        if len(at):
            keep = ~found.covers(at, period)
            at, period = at[keep].tolist(), period[keep].tolist()
            done, of = -1, -1  # stretches of one period don't share places
            for i, p in zip(at, period, strict=True):
                if p == of and i < done:
                    continue
                stop, start = _same_right(w, i, p), _same_left(w, i, p)
                of, done = p, stop
                length = stop + p - start
                if length >= max(shortest, times * p) and (start, start + length) not in found.spans:
                    found.add(start, start + length, p)
                    out.append((start, length, p))
        a = b
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stand outside what the runs repeat: a run keeps its first period."""
    change = np.zeros(n + 1, "int64")
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of every tenth document or so, made periodic from a place on, as the query's contract has it."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def find_runs(docs: DataFrame, times: int = 4, shortest: int = 6, change: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, runs (array of start, length and period, by start, then period) and collapsed (the words that no run
    repeats, joined by one space) of every row of ``docs``.

    Words are what stands between spaces and 0x09-0x0D. ``change`` maps a document's id and words before runs are
    looked for. Null and empty texts have no runs and collapse to an empty string. Repeated rows each give a row; a
    null doc_id stays null; other columns are ignored, whatever their names. A text is searched whole, however long.
    One pass without a shuffle; an empty table gives none.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            ids = batch.column(0).cast(pa.int64()).to_pylist()
            for at in range(0, batch.num_rows, 64):
                runs, collapsed = [], []
                for doc_id, text in zip(ids[at : at + 64], binary_texts(batch.column(1).slice(at, 64)), strict=True):
                    words = text.split()
                    if change is not None:
                        words = change(doc_id, words)
                    number: dict[bytes, int] = {}
                    coded = np.fromiter((number.setdefault(x, len(number)) for x in words), "int64", len(words))
                    found = periodic_runs(coded, times, shortest)
                    keep = kept_words(len(words), found)
                    runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                    collapsed.append(b" ".join(words if keep.all() else [words[i] for i in np.flatnonzero(keep).tolist()]))
                yield pa.RecordBatch.from_arrays([pa.array(ids[at : at + 64], pa.int64()), pa.array(runs, kind), pa.array(collapsed, pa.binary())], names=["doc_id", "runs", "collapsed"])

    found = lean(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def _best(runs: Column) -> Column:
    """The run with the greatest length / period; ties: smallest start, then period. Null without runs."""
    more = lambda x, y: (y["length"] * x["period"] > x["length"] * y["period"])  # noqa: E731  exact; runs come by start, then period
    return F.aggregate(runs, F.get(runs, 0), lambda x, y: F.when(more(x, y), y).otherwise(x))


def run_digests(found: DataFrame) -> DataFrame:
    """n_runs, the greatest run and sha256 digests of all runs and of the collapsed text, from the operator's result."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.withColumn("best", _best(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.expr("(1000 * best.length) div best.period")).cast("long").alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
