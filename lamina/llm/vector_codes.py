"""Vector codes: vectors cut into parts, each replaced by its nearest entry of a codebook of its position.

The nearest entry is found by partial distances. The coordinates of a part are processed in descending variance of
the codebook, as those tell entries apart the soonest. The entry that is nearest in the first coordinate gets its
distance completed and bounds the search; then all entries accumulate integer distances coordinate by coordinate,
and masks drop those whose sum strictly exceeds the best complete distance known for their vector. What is left
at the end is complete, ties included. All arithmetic is in integers, so codebooks don't depend on the order of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import lean, materialize

#: Pairs of a vector and an entry that are worked on at once, about.
PAIRS = 1 << 18
#: Labels that hold more than one row in so many are at most so many: their sums are sent to every task.
HOT = 10_000


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``parts`` the index of the nearest row of ``entries`` (squared Euclidean distance, ties to the
    lower index) and that distance. Both are int64."""
    n, k, width = len(parts), len(entries), entries.shape[1]
    index, distance = np.zeros(n, "int64"), np.zeros(n, "int64")
    if width == 0:
        return index, distance
    order = np.argsort(-entries.astype(float).var(axis=0), kind="stable")
    x, c = np.ascontiguousarray(parts[:, order].T), np.ascontiguousarray(entries[:, order].T)
    step = max(1, PAIRS // k)
    for at in range(0, n, step):
        own = x[:, at : at + step]
        total = (own[0][:, None] - c[0][None, :]) ** 2
        seed = total.argmin(axis=1)
        best = ((own - c[:, seed]) ** 2).sum(axis=0)
        row, entry = np.nonzero(total <= best[:, None])
        total = total[row, entry]
        for d in range(1, width):
            total = total + (own[d][row] - c[d][entry]) ** 2
            if d == width - 1:
                np.minimum.at(best, row, total)
            keep = total <= best[row]
            row, entry, total = row[keep], entry[keep], total[keep]
        first = np.flatnonzero(np.diff(row, prepend=-1))  # rows ascend, and entries within them
        index[at : at + step], distance[at : at + step] = entry[first], total[first]
    return index, distance


def _blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places of a batch's vectors of one length, and their integers; for each length."""
    vectors = batch.column(column)
    ends = vectors.offsets.to_numpy()
    flat, sizes = vectors.values.to_numpy(zero_copy_only=False), np.diff(ends)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, flat[ends[at][:, None] + np.arange(size)[None, :]].astype("int64")


def _checked(x: np.ndarray) -> None:
    """Distances have to fit into 64 bits: no component may be beyond the bound that its vector's length leaves."""
    if x.size and 4 * x.shape[1] * int(np.abs(x).max()) ** 2 >= 1 << 62:
        raise ValueError("components are too large for distances of 64 bits")


def _cut(x: np.ndarray, parts: int) -> np.ndarray:
    """(part, vector, position): equal consecutive parts; zeros follow where the length isn't a multiple of ``parts``."""
    width = -(-x.shape[1] // parts)
    return np.pad(x, ((0, 0), (0, width * parts - x.shape[1]))).reshape(len(x), parts, width).transpose(1, 0, 2)


def fit_codebooks(kept: DataFrame, parts: int, entries: int, rounds: int) -> dict[int, np.ndarray]:
    """Codebooks (part, entry, position) for each length of vectors. ``kept``: vec_id, ints.

    They start as the parts of the ``entries`` smallest ids; each round is one pass that sends a sum for each entry and
    position from every task. What reaches the driver is as large as the codebooks."""
    books: dict[int, np.ndarray] = {}
    for (length,) in kept.select(F.size("ints")).distinct().collect():
        first = kept.where(F.size("ints") == length).orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()
        books[length] = _cut(np.array([r.ints for r in first], "int64").reshape(len(first), length), parts)
    for _ in range(rounds):
        now = books

        def sums(batches: Iterable[pa.RecordBatch], now: dict = now) -> Iterator[pa.RecordBatch]:
            total, count = {n: np.zeros_like(b) for n, b in now.items()}, {n: np.zeros(b.shape[:2], "int64") for n, b in now.items()}
            for batch in batches:
                for _, x in _blocks(batch, 1):
                    _checked(x)
                    for p, own in enumerate(_cut(x, parts)):
                        index, _ = nearest(own, now[x.shape[1]][p])
                        np.add.at(total[x.shape[1]][p], index, own)
                        count[x.shape[1]][p] += np.bincount(index, minlength=count[x.shape[1]].shape[1])
            for n, t in total.items():
                p, e = np.nonzero(count[n])
                if len(p):
                    yield pa.RecordBatch.from_pydict({"length": np.full(len(p), n), "part": p, "entry": e, "rows": count[n][p, e], "total": pa.array(list(t[p, e]), pa.list_(pa.int64()))})

        sent = kept.mapInArrow(sums, "length long, part long, entry long, rows long, total array<long>")
        books = {n: b.copy() for n, b in now.items()}
        key = ["length", "part", "entry"]
        if any(b.shape[2] for b in now.values()):
            added = sent.select(*key, "rows", F.posexplode("total").alias("position", "x")).groupBy(*key, "position").agg(F.sum("x").alias("x"), F.sum("rows").alias("rows"))
            for r in added.collect():  # at most one row for each number of the codebooks
                books[r.length][r.part, r.entry, r.position] = r.x // r.rows
    return books


def codebook_digest(book: np.ndarray) -> str:
    """sha256 of all integers by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def encode_vectors(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, column: str = "embedding", scale: int = 256) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """The codes of ``vectors`` (vec_id, ``column``, label), and the codebooks by length of vector.

    Components become floor(``scale`` * x). Returned for each vector: vec_id, label, length, code (array of entries, in
    order of parts) and error, the squared distance to what the code stands for. Vectors that are null or hold null
    or non-finite components are left out. Vectors of different lengths are coded apart, each length with codebooks of
    its own; a length that isn't a multiple of ``parts`` counts as followed by zeros, and empty vectors have entry 0
    everywhere. With fewer vectors than ``entries`` the codebook is smaller. Repeated rows are vectors of their own,
    those of one id in the order of their integers, null ids last. Other columns are ignored, whatever their
    names; an empty table gives no rows. Components too large for distances of 64 bits stop the query.
    """
    if entries > 256:
        raise ValueError("a code is one byte for each part")
    v = F.col(column)
    sound = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = lean(vectors).where(sound).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("ints"), "label")
    books = fit_codebooks(kept.select("vec_id", "ints"), parts, entries, rounds)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors, lengths = np.zeros((batch.num_rows, parts), "int16"), np.zeros(batch.num_rows, "int64"), np.zeros(batch.num_rows, "int64")
            for at, x in _blocks(batch, 1):
                _checked(x)
                lengths[at] = x.shape[1]
                for p, own in enumerate(_cut(x, parts)):
                    codes[at, p], distance = nearest(own, books[x.shape[1]][p])
                    errors[at] += distance
            ends = pa.array(np.arange(0, codes.size + 1, parts, dtype="int32"))
            columns = [batch.column(0), batch.column(2), pa.array(lengths), pa.ListArray.from_arrays(ends, pa.array(codes.ravel())), pa.array(errors)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "length", "code", "error"])

    label = dict(vectors.dtypes)["label"]
    return kept.mapInArrow(run, f"vec_id long, label {label}, length long, code array<short>, error long"), books


def code_digests(vectors: DataFrame) -> DataFrame:
    """vec_id, code (two hex digits for each part), error, label_error (the errors of all vectors with an equal label,
    nulls together) and codebooks_sha256.

    Sums of labels are joined back without gathering a label anywhere: the sums of labels with more than one row in
    ``HOT`` (``HOT`` of them at most) go to every task, those of the others meet their few rows in an exchange.
    """
    coded, books = encode_vectors(vectors)
    coded = materialize(coded, "codes")
    totals = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("rows")), "code-labels")
    n, rows = totals.agg(F.count("*"), F.sum("rows")).first()
    hot = F.lit(n <= HOT) | (F.col("rows") * HOT > (rows or 0))
    named = totals.select(F.col("label").alias("of"), "label_error", hot.alias("hot"))
    found = coded.join(F.broadcast(named.where("hot")), F.col("label").eqNullSafe(F.col("of")), "left").drop("of", "hot")
    if n > HOT:
        rest = named.where("not hot").select("of", F.col("label_error").alias("rest_error"))
        found = found.where("label_error is not null").unionByName(
            found.where("label_error is null").drop("label_error").join(rest, F.col("label").eqNullSafe(F.col("of"))).drop("of").withColumnRenamed("rest_error", "label_error")
        )
    digests = F.create_map(*[F.lit(x) for length, book in sorted(books.items()) for x in (length, codebook_digest(book))]) if books else F.create_map(F.lit(0), F.lit(""))
    digits = F.transform("code", lambda c: F.lower(F.lpad(F.hex(c.cast("long")), 2, "0")))
    return found.select("vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", digests[F.col("length").cast("int")].alias("codebooks_sha256"))


#: The same in DuckDB's SQL: every part against every entry of its codebook.
ORACLE_SQL = """
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT vec_id, part, v[part * w + 1 : part * w + w] AS x FROM (SELECT vec_id, v, len(v) // 16 AS w, unnest(range(16)) AS part FROM kept)
), book0 AS MATERIALIZED (
    SELECT part, n - 1 AS entry, x FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS n FROM kept) USING (vec_id) WHERE n <= 64
), near0 AS MATERIALIZED (
    SELECT vec_id, part, x, arg_min(entry, (d, entry)) AS entry FROM (
        SELECT p.vec_id, p.part, p.x, b.entry, list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - b.x[i]) * (p.x[i] - b.x[i]))) AS d FROM parts p JOIN book0 b USING (part))
    GROUP BY ALL
), mean0 AS (
    SELECT part, entry, list(m ORDER BY i) AS x FROM (SELECT part, entry, i, CAST(floor(sum(c) / count(*)) AS BIGINT) AS m FROM (SELECT part, entry, unnest(x) AS c, unnest(range(len(x))) AS i FROM near0) GROUP BY ALL) GROUP BY ALL
), book1 AS MATERIALIZED (
    SELECT part, entry, coalesce(m.x, b.x) AS x FROM book0 b LEFT JOIN mean0 m USING (part, entry)
), near1 AS MATERIALIZED (
    SELECT vec_id, part, x, arg_min(entry, (d, entry)) AS entry FROM (
        SELECT p.vec_id, p.part, p.x, b.entry, list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - b.x[i]) * (p.x[i] - b.x[i]))) AS d FROM parts p JOIN book1 b USING (part))
    GROUP BY ALL
), mean1 AS (
    SELECT part, entry, list(m ORDER BY i) AS x FROM (SELECT part, entry, i, CAST(floor(sum(c) / count(*)) AS BIGINT) AS m FROM (SELECT part, entry, unnest(x) AS c, unnest(range(len(x))) AS i FROM near1) GROUP BY ALL) GROUP BY ALL
), book2 AS MATERIALIZED (
    SELECT part, entry, coalesce(m.x, b.x) AS x FROM book1 b LEFT JOIN mean1 m USING (part, entry)
), coded AS (
    SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
        SELECT p.vec_id, p.part, b.entry, list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - b.x[i]) * (p.x[i] - b.x[i]))) AS d FROM parts p JOIN book2 b USING (part))
    GROUP BY ALL
), codes AS (
    SELECT vec_id, string_agg(format('{:02x}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM coded GROUP BY vec_id
), digest AS (
    SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, i)) AS codebooks_sha256 FROM (SELECT part, entry, unnest(x) AS c, unnest(range(len(x))) AS i FROM book2)
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM codes JOIN kept USING (vec_id) CROSS JOIN digest
"""
