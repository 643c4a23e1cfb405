"""A gated recurrent language model in numpy, and the log probability of whole documents under it.

The unit and its output are in ``recurrent``: gates read the word and the state, the class of the next word and the
word within its class are softmaxes of the state. It is trained by truncated backpropagation through time inside the
partitions, once on every training document, and the weights are averaged after each of ``ROUNDS`` rounds. A document's state
is carried from its first word to its last, however long it is; documents are computed side by side.

Classes come from the corpus: all training documents are clustered in pieces, frequent words belong to the cluster
where they are most over-represented and to a frequency band of it; other words belong to a cluster by their first
and last letters. The ``SYMBOLS`` most frequent words have vectors, by which the state chooses among them within
their class. All other words have classes of their own, which the state chooses, and a fixed share of their class:
their part of its training tokens, or, for words too rare for the shared vocabulary, one more than they were seen,
where one more such word stands for all that are unknown. So the model is a distribution over the training words and
the unknown.

Counts, clusters, letters and weights all come from all training documents; a bounded sample only gives k-means
the centers that it starts from. The sizes of the model have bounds (``SYMBOLS``, ``SHARED``, ``LETTERS``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import binary_texts, crc_mod, discard, lean, materialize, release, windows
from lamina.llm.recurrent import Network

CLUSTERS, BANDS = 6, 6
#: Words with a symbol and a frequency band of their own, and words whose counts every executor holds.
SYMBOLS, SHARED = 4_096, 300_000
#: Longer words are never shared, so what is broadcast has a bound of SHARED * (WORD_BYTES + 8) bytes.
WORD_BYTES = 64
#: Words in a piece of a text, and the pieces, about, from which k-means takes the centers that it starts from.
PIECE, SEEDS = 1_000, 2_000
#: Frequent words that clusters are made of, first and last letters that have clusters of their own, at most.
FEW, LETTERS = 512, 100_000
#: Rounds of training, each over its share of all documents, how much slower each goes than the one before, and
#: words that a task trains on or tallies at a time.
ROUNDS, SLOWER, CHUNK = 3, 0.5, 1 << 21
#: Words of a shard, about. A shard trains alone between two averages, so it has to be large enough to learn from.
SHARD = 8_000_000
#: Parts of a shard that are learned side by side, at most. More cost less; a shard has to grow with them, so that it takes
#: as many steps.
STREAMS = 512
#: A word's vector counts as if so many tokens had said that it has none: what few tokens say is mostly chance.
PRIOR = 50
#: Words of documents that are scored side by side, about: many, so that long documents have company.
BUFFER = 1 << 21
#: Bytes of texts that are cut into words at a time, about, texts at most, and rows of counts that a task adds up.
AT_ONCE, TEXTS, COUNTS = 8 << 20, 50_000, 1 << 20
#: Marks of words without an own symbol whose counts all executors hold, and of all other words.
_SHARED, _RARE = 1 << 48, 1 << 49
_END = 0xFFFF


def _words(data: bytes) -> list[bytes]:
    return data.lower().split()


def split_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """``_words`` of many texts, one after the other, and how many each has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.binary()).view(pa.string())))
    words, offsets = lists.values, lists.offsets.to_numpy()
    full = pc.binary_length(words).to_numpy() > 0  # white space at the ends of a text leaves empty ones
    return words.filter(pa.array(full)).view(pa.binary()), np.diff(np.concatenate([[0], np.cumsum(full)])[offsets])


def _listed(words: pa.Array) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()


def _edges(word: bytes) -> int:
    """The first three and the last three bytes."""
    return int.from_bytes(word[:3].ljust(3, b"\0"), "big") << 24 | int.from_bytes(word[-3:].ljust(3, b"\0"), "big")


def edges_of(words: list[bytes]) -> np.ndarray:
    """``_edges`` of many words at once."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    data, first = np.frombuffer(b"".join(words) + b"\0\0", np.uint8), np.cumsum(sizes) - sizes
    out, last = np.zeros(len(words), dtype=np.int64), first + np.maximum(0, sizes - 3)
    for begins in (first, last):
        for k in range(3):
            out <<= 8
            out |= np.where(sizes > k, data[begins + k], 0)
    return out


def _ranked(shared: list[tuple[bytes, int]]) -> list[tuple[bytes, int]]:
    return sorted(shared, key=lambda x: (-x[1], x[0]))


def word_codes(shared: list[tuple[bytes, int]]) -> dict[bytes, int]:
    """word -> its symbol, or its letters and a mark."""
    return {w: i if i < SYMBOLS else _SHARED | _edges(w) for i, (w, _) in enumerate(_ranked(shared))}


class Numbers(dict):
    """word -> number: ``known`` ones have theirs, others get the next from ``first`` on, until ``settle`` puts in what
    ``of`` says of all new words together. ``trim`` forgets them once there are more than ``limit``."""

    def __init__(self, known: dict[bytes, int], first: int, of: Callable[[list[bytes]], np.ndarray], limit: int = 300_000):
        release()
        super().__init__(known)
        self.known, self.first, self.of, self.limit = known, first, of, limit
        self.new: list[bytes] = []
        self.values = np.zeros(0, dtype=np.int64)

    def __missing__(self, word: bytes) -> int:
        self[word] = value = self.first + len(self.values) + len(self.new)
        self.new.append(word)
        return value

    def of_all(self, words: pa.Array | list[bytes]) -> np.ndarray:
        """The numbers of many words: each different one is looked up once."""
        coded = (words if isinstance(words, pa.Array) else pa.array(words, pa.binary())).dictionary_encode()
        different = _listed(coded.dictionary)
        new = [w for w in different if w not in self]
        first = self.first + len(self.values) + len(self.new)
        self.update(zip(new, range(first, first + len(new)), strict=True))
        self.new += new
        return np.fromiter(map(self.__getitem__, different), dtype=np.int64, count=len(different))[coded.indices.to_numpy()]

    def settle(self, numbers: np.ndarray) -> np.ndarray:
        if self.new:
            self.values, self.new = np.concatenate([self.values, self.of(self.new)]), []
        other = numbers >= self.first
        out = numbers.copy()
        out[other] = self.values[numbers[other] - self.first]
        return out

    def trim(self) -> None:
        if len(self.values) + len(self.new) > self.limit:
            self.clear()
            self.update(self.known)
            self.values, self.new = self.values[:0], []


def word_numbers(known: dict[bytes, int]) -> Numbers:
    """Codes for all words: unshared ones have their letters and a mark."""
    return Numbers(known, 1 << 52, lambda words: edges_of(words) | _RARE)


def _split(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols, SYMBOLS for shared and SYMBOLS + 1 for rare words, and the letters of these."""
    other = codes >= _SHARED
    symbols = np.where(other, SYMBOLS + (codes >= _RARE), codes).astype(np.uint16)
    return symbols, codes[other] & (_SHARED - 1)


def _vectors(symbols: list[np.ndarray]) -> np.ndarray:
    """Pieces as unit vectors of the roots of their frequent words' counts."""
    own = np.concatenate(symbols) if symbols else np.zeros(0, np.uint16)
    few = np.flatnonzero(own < FEW)
    begins = np.repeat(np.arange(0, len(symbols) * FEW, FEW), [len(x) for x in symbols])
    x = np.sqrt(np.bincount(begins.take(few) + own.take(few), minlength=len(symbols) * FEW).reshape(-1, FEW).astype(np.float32))
    return x / np.maximum(1e-9, np.linalg.norm(x, axis=1))[:, None]


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return (x @ centers.T).argmax(1) if len(centers) else np.zeros(len(x), dtype=int)


def _sums(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The sum of the vectors nearest to each center."""
    return (_nearest(x, centers) == np.arange(len(centers))[:, None]).astype(np.float32) @ x


def _moved(centers: np.ndarray, sums: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(sums, axis=1)[:, None]
    return np.where(norm > 0, sums / np.maximum(1e-9, norm), centers)


def first_centers(x: np.ndarray, seed: int = 3, starts: int = 4) -> np.ndarray:
    """k-means++ and its rounds on a few pieces; the best of several starts."""
    rng, best, found = np.random.default_rng(seed), -1.0, np.zeros((0, FEW))
    for _ in range(starts if len(x) else 0):
        centers = []
        for _ in range(CLUSTERS):
            far = np.min([((x - c) ** 2).sum(1) for c in centers], axis=0).astype(float) + 1e-9 if centers else np.ones(len(x))
            centers.append(x[rng.choice(len(x), p=far / far.sum())])
        centers = np.array(centers)
        for _ in range(15):
            centers = _moved(centers, _sums(x, centers))
        if (near := float((x @ centers.T).max(1).sum())) > best:
            best, found = near, centers
    return found


def _tally(symbols: list[np.ndarray], edges: list[np.ndarray], centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How often clusters have first letters, last letters and words with a symbol: keys, clusters, counts."""
    label = np.repeat(_nearest(_vectors(symbols), centers), [len(x) for x in symbols])
    own, ends = np.concatenate(symbols).astype(np.int64), np.concatenate(edges)
    other = own >= SYMBOLS
    found, n = np.unique(np.concatenate([ends >> 24, 1 << 24 | ends & 0xFFFFFF]) * 8 + np.tile(label[other], 2), return_counts=True)
    words = np.bincount(own[~other] * 8 + label[~other])
    there = np.flatnonzero(words)
    return np.concatenate([found >> 3, 2 << 24 | there >> 3]), np.concatenate([found & 7, there & 7]), np.concatenate([n, words[there]])


class Clusters:
    """What words and letters say of a word's cluster, from ``rows`` of a key and its count in each cluster."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray, shared: list[tuple[bytes, int]]):
        words = [_edges(w) for w, _ in _ranked(shared)[:SYMBOLS]]
        seen = np.full((CLUSTERS, len(words)), 0.1)
        own = keys >= 2 << 24
        seen[:, keys[own] - (2 << 24)] += rows[own].T
        self.top_cluster = (seen / seen.sum(1, keepdims=True)).argmax(0)
        letters = {int(k): r + 0.1 for k, r in zip(keys[~own], rows[~own], strict=True)}
        for e, r in zip(words, seen.T - 0.1, strict=True):
            for key in (e >> 24, 1 << 24 | e & 0xFFFFFF):
                letters[key] = letters.get(key, 0.1) + r
        self.keys = np.array(sorted(letters), dtype=np.int64)
        counts = np.array([letters[int(k)] for k in self.keys]).reshape(-1, CLUSTERS)
        total = counts.sum(0) + 0.1
        often = counts.sum(1) >= 3
        #: The last row stands for letters that aren't known.
        self.keys, self.logs = self.keys[often], np.log(np.vstack([counts[often], np.full(CLUSTERS, 0.1)]) / total)

    def of(self, edges: np.ndarray) -> np.ndarray:
        """The clusters of words by their letters."""

        def places(k: np.ndarray) -> np.ndarray:
            if not len(self.keys):
                return np.zeros(len(k), dtype=int)
            i = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
            return np.where(keys[i] == k, i, len(keys))

        keys = self.keys.astype(np.int32)  # half as wide, so that they stay in a core's cache
        a, b = places((edges >> 24).astype(np.int32)), places((1 << 24 | edges & 0xFFFFFF).astype(np.int32))
        best, out = np.full(len(edges), -np.inf), np.zeros(len(edges), dtype=np.int64)
        for g in range(CLUSTERS):
            column = np.ascontiguousarray(self.logs[:, g])
            sums = column[a] + column[b]
            out[sums > best] = g
            np.maximum(best, sums, out=best)
        return out


def clusters_of_pieces(pieces: list[bytes], shared: list[tuple[bytes, int]]) -> Clusters:
    """Clusters of pieces at hand."""
    codes = word_numbers(word_codes(shared))
    parts = [_split(codes.settle(np.array([codes[w] for w in _words(p)], dtype=np.int64))) for p in pieces]
    if not parts:
        return Clusters(np.zeros(0, np.int64), np.zeros((0, CLUSTERS)), shared)
    symbols, edges = ([x[i] for x in parts] for i in (0, 1))
    keys, cluster, n = _tally(symbols, edges, first_centers(_vectors(symbols)))
    own, at = np.unique(keys, return_inverse=True)
    rows = np.zeros((len(own), CLUSTERS))
    np.add.at(rows, (at, cluster), n)
    return Clusters(own, rows, shared)


class Vocabulary:
    """Classes and shares of words. Ids: shared words, then one id for each cluster's rare words, then the end."""

    def __init__(self, shared: list[tuple[bytes, int]], pieces: list[bytes] | Clusters, ends: int):
        self.clusters = pieces if isinstance(pieces, Clusters) else clusters_of_pieces(pieces, shared)
        shared = _ranked(shared)
        self.words = {w: i for i, (w, _) in enumerate(shared)}
        self.counts = np.array([c for _, c in shared], dtype=float)
        self.top = min(SYMBOLS, len(shared))
        self.ends = ends
        n, top = len(shared), self.top
        cluster = np.concatenate([self.clusters.top_cluster, self.clusters.of(np.array([_edges(w) for w, _ in shared[top:]], dtype=np.int64))]).astype(int)
        band = np.full(n, BANDS)
        for g in range(CLUSTERS):
            own = np.flatnonzero(cluster[:top] == g)
            mass = np.cumsum(self.counts[own])
            band[own] = np.minimum(BANDS - 1, (mass - self.counts[own]) / max(1.0, mass[-1] if len(mass) else 1) * BANDS).astype(int)
        self.rare, self.end = n, n + CLUSTERS
        self.classes = CLUSTERS * (BANDS + 2) + 1
        self.class_of = np.concatenate([cluster * (BANDS + 2) + band, np.arange(CLUSTERS) * (BANDS + 2) + BANDS + 1, [self.classes - 1]])
        mass = np.bincount(self.class_of[:n], self.counts, self.classes)
        #: log10 of a word's share of its class; rare words' shares are added when their counts are known.
        self.share = np.concatenate([np.log10(self.counts / mass[self.class_of[:n]]) if n else [], np.zeros(CLUSTERS + 1)])
        #: Symbols that the network reads: the most frequent words, else the class.
        self.symbol = np.concatenate([np.arange(top), top + self.class_of[top:]])
        self.symbols = top + self.classes
        #: Words with a vector stand class by class: the place of each, and where each class begins and ends.
        self.place = np.full(len(self.class_of), -1)
        self.place[np.argsort(self.class_of[:top], kind="stable")] = np.arange(top)
        self.low, self.high = (np.searchsorted(np.sort(self.class_of[:top]), np.arange(self.classes), side) for side in ("left", "right"))

    def network(self) -> Network:
        own = np.zeros(self.top)
        own[self.place[: self.top]] = self.share[: self.top] * np.log(10)
        return Network(self.symbols, self.low, self.high, own)

    def cluster_of(self, word: bytes) -> int:
        """The cluster of a word without one of its own, by its first and last letters."""
        return int(self.clusters.of(np.array([_edges(word)]))[0])

    def word_ids(self) -> Numbers:
        """Ids of all words: unshared ones have that of their cluster's rare words."""
        return Numbers(self.words, self.end + 1, lambda words: self.rare + self.clusters.of(edges_of(words)))

    def reads(self, symbols: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the network reads, the classes and the places of coded words, ``_END`` among them."""
        # every mark below SYMBOLS has its word's class and place, all others the end's until theirs are known
        mark = np.minimum(symbols, np.uint16(SYMBOLS))
        gives, place = np.full(SYMBOLS + 1, self.classes - 1), np.full(SYMBOLS + 1, -1)
        gives[: self.top], place[: self.top] = self.class_of[: self.top], self.place[: self.top]
        read, gives, place = np.append(np.arange(SYMBOLS), self.top + self.classes - 1).take(mark), gives.take(mark), place.take(mark)
        other = np.flatnonzero((symbols >= SYMBOLS) & (symbols != _END))
        own = self.clusters.of(edges) * (BANDS + 2) + BANDS + (symbols[other] == SYMBOLS + 1)
        gives[other], read[other] = own, self.top + own
        return read, gives, place


def _count_words(docs: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> Iterator[pa.RecordBatch]:
            """Counts of the texts that are held, added to those before, which go out once they are many."""
            counts.append(pa.Table.from_arrays(split_words(texts)[0].value_counts().flatten(), names=["word", "n"]))
            texts.clear()
            if sum(map(len, counts)) > COUNTS:
                counts[:] = [added()]
                if len(counts[0]) > COUNTS // 2:
                    yield from counts.pop().to_batches()

        def added() -> pa.Table:
            return pa.concat_tables(counts).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])

        texts: list[bytes] = []
        counts: list[pa.Table] = []
        size = 0
        for b in batches:
            for at in range(0, b.num_rows, 256):
                for data in binary_texts(b.column(0).slice(at, 256)):
                    for part in windows(data, 1 << 20):
                        texts.append(part)
                        size += len(part)
                        if size > AT_ONCE or len(texts) > TEXTS:
                            yield from flush()
                            size = 0
        if texts:
            yield from flush()
        if counts:
            yield from added().to_batches()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _coded(docs: DataFrame, shared: list[tuple[bytes, int]], words: int) -> DataFrame:
    """The words of ``docs`` in pieces, as ``_split`` has them; ``first`` where a document begins. A document's pieces
    stand together in one of the shards, which are as many as the ``words`` ask for, however the files of ``docs`` lie;
    documents are dealt by their row numbers, so copies and repeated ids spread as all others do, and stand in the order
    of ``mix``."""
    known = docs.sparkSession.sparkContext.broadcast(word_codes(shared))
    shards = max(1, round(words / SHARD))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = word_numbers(known.value)
        held: list[tuple[int, int, int]] = []  # row, mix and place of a megabyte of text at most
        texts: list[bytes] = []

        def flush() -> pa.RecordBatch:
            words, sizes = split_words(texts)
            symbols, edges = _split(codes.settle(codes.of_all(words)))
            codes.trim()
            row, mix, part = np.array(held, dtype=np.int64).T
            held.clear()
            texts.clear()
            pieces = np.maximum(1, -(-sizes // PIECE))
            of = np.repeat(np.arange(len(sizes)), pieces)
            within = (np.arange(len(of)) - (np.cumsum(pieces) - pieces)[of]) * PIECE
            cuts = np.append((np.cumsum(sizes) - sizes)[of] + within, len(symbols))
            other = np.concatenate([[0], np.cumsum(symbols >= SYMBOLS)])
            columns = [*map(pa.array, (row[of], mix[of], part[of] << 32 | within)), _cut(symbols, cuts), _cut(edges, other[cuts])]
            return pa.RecordBatch.from_arrays(columns, names=["row", "mix", "piece", "symbols", "edges"])

        size = 0
        for b in batches:
            for at in range(0, b.num_rows, 256):
                for row, mix, data in zip(*(b.column(i).slice(at, 256).to_pylist() for i in (0, 1)), binary_texts(b.column(2).slice(at, 256)), strict=True):
                    for k, part in enumerate(windows(data, 1 << 20)):
                        held.append((row, mix, k))
                        texts.append(part)
                        size += len(part)
                        if size > AT_ONCE or len(texts) > TEXTS:
                            yield flush()
                            size = 0
        if held:
            yield flush()

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.xxhash64("doc_id", "text").alias("mix"), "text")
    pieces = numbered.mapInArrow(run, "row long, mix long, piece long, symbols binary, edges binary").repartition(shards, F.xxhash64("row")).sortWithinPartitions("mix", "row", "piece")
    coded = materialize(pieces.select((F.col("piece") == 0).alias("first"), "symbols", "edges", F.spark_partition_id().alias("shard")), "coded")
    known.destroy()
    return coded


def _cut(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of ``values`` from each of ``cuts`` to the next."""
    offsets = (cuts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _arrays(column: pa.Array, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in _listed(column)]


def _total(parts: DataFrame, n: int) -> np.ndarray | None:
    """The sum of the arrays of ``parts``, one for each of about ``n`` partitions; added up by tasks in steps, so
    that no task and no driver reads very many."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for x in _arrays(b.column(0), np.float64):
                total = x if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    while True:
        n = max(8, -(-n // 64))
        parts = parts.repartition(n).mapInArrow(run, "sums binary")
        if n == 8:
            break
    got = [np.frombuffer(r.sums, np.float64) for r in parts.collect()]
    return sum(got) if got else None


def _centers(coded: DataFrame, rounds: int = 6) -> np.ndarray:
    """k-means over all pieces, until the centers stay where they are."""
    files = len(coded.inputFiles())
    share = min(1.0, SEEDS / max(1, coded.count()))
    # chosen by content, so the choice doesn't depend on files, and copies count once
    chosen = F.pmod(F.xxhash64("symbols"), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1.0)
    seeds = sorted(bytes(r.symbols) for r in coded.select("symbols").where(chosen).distinct().collect())
    centers = first_centers(_vectors([np.frombuffer(x, np.uint16) for x in seeds]))
    for _ in range(rounds if len(centers) else 0):

        def run(batches: Iterable[pa.RecordBatch], centers=centers) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(centers.shape)
            for b in batches:
                sums += _sums(_vectors(_arrays(b.column(0), np.uint16)), centers)
            yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

        before, centers = centers, _moved(centers, _total(coded.select("symbols").mapInArrow(run, "sums binary"), files).reshape(-1, FEW))
        if np.abs(centers - before).max() < 1e-2:
            break
    return centers


def find_clusters(coded: DataFrame, shared: list[tuple[bytes, int]]) -> Clusters:
    """Clusters of all pieces; letters from the most frequent down, at most ``LETTERS``."""
    centers = _centers(coded)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _tally(symbols, edges, centers)], names=["key", "cluster", "n"])
            symbols.clear()
            edges.clear()
            return out

        symbols, edges, size = [], [], 0
        for b in batches:
            symbols += _arrays(b.column(0), np.uint16)
            edges += _arrays(b.column(1), np.int64)
            size += sum(map(len, symbols[len(symbols) - b.num_rows :]))
            if size > CHUNK // 4:
                yield flush()
                size = 0
        if symbols:
            yield flush()

    tallied = coded.select("symbols", "edges").mapInArrow(run, "key long, cluster long, n long")
    sums = [F.sum(F.when(F.col("cluster") == g, F.col("n")).otherwise(0)).alias(f"c{g}") for g in range(CLUSTERS)]
    keys = materialize(tallied.groupBy("key").agg(F.sum("n").alias("n"), *sums), "letters")
    letters = F.col("key") < (2 << 24)
    least = _least(keys.where(letters), LETTERS)
    got = np.array(keys.where(~letters | (_bucket("n") >= least)).drop("n").collect(), dtype=np.int64).reshape(-1, CLUSTERS + 1)
    return Clusters(got[:, 0], got[:, 1:].astype(float), shared)


def _bucket(n: str):
    """Counts in steps: exact below 10,000, then by about two per cent. Grows with the count, and takes few values."""
    step = F.floor(F.log(F.col(n).cast("double")) * 50)
    return F.when(F.col(n) < 10_000, F.col(n)).otherwise(10_000 + step).cast("long")


def shared_words(counts: DataFrame, most: int = SHARED) -> tuple[list[tuple[bytes, int]], int]:
    """Words and counts from the most frequent down, at most ``most``, and the least ``_bucket`` that they have.
    Found from the histogram of buckets, a few thousand rows, without sorting the vocabulary."""
    short = counts.where(F.length("word") <= WORD_BYTES)
    least = _least(short, most)
    return [(bytes(r.word), r.n) for r in short.where(_bucket("n") >= least).collect()], least


def _least(counts: DataFrame, most: int) -> int:
    """The least ``_bucket`` of the most frequent rows, at most ``most``."""
    histogram = counts.groupBy(_bucket("n").alias("bucket")).count().orderBy(F.desc("bucket")).collect()
    held, least = 0, (histogram[0].bucket + 1) if histogram else 1
    for bucket, number in histogram:
        held += number
        if held > most:
            break
        least = bucket
    return least


class _Learner:
    """One shard in one round: its own weights, which start from the common ones."""

    def __init__(self, shard: int, v: Vocabulary, weights: dict, pace: float):
        self.shard, self.v, self.pace, self.nth = shard, v, pace, 0
        self.net = v.network()
        self.net.p = {k: x.copy() for k, x in weights.items()}
        self.moments, self.read, self.given = self.net.moments(), np.zeros(v.symbols), np.zeros(v.top)
        self.symbols, self.edges, self.size = [], [], 0
        self.end = np.array([_END], np.uint16)

    def add(self, first: bool, symbols: np.ndarray, edges: np.ndarray) -> None:
        if self.size > CHUNK:  # a text that goes on does so from the state of a text's start
            self.learn()
            self.symbols = [] if first else [self.end]
        self.symbols += [self.end, symbols] if first else [symbols]
        self.edges.append(edges)
        self.size += len(symbols)

    def learn(self) -> None:
        if not self.symbols:
            return
        marks = np.concatenate([*self.symbols, self.end])
        s, y, place = self.v.reads(marks, np.concatenate(self.edges))
        s, y, place, starts = s[:-1], y[1:], place[1:], marks[:-1] == _END
        self.symbols, self.edges, self.size = [], [], 0
        if len(s):
            self.net.learn(s, y, place, starts, self.moments, self.pace, streams=min(STREAMS, max(1, len(s) // 2048)))
            self.read += np.bincount(s, minlength=self.v.symbols)
            self.given += np.bincount(place[place >= 0], minlength=self.v.top)

    def sums(self) -> pa.RecordBatch:
        """Weights times the tokens that they count for, and these tokens."""
        self.learn()
        scale = {"p": self.read[:, None], "e": self.given[:, None]}
        parts = [*(x * scale.get(k, self.read.sum()) for k, x in self.net.p.items()), self.read, self.given]
        return pa.RecordBatch.from_arrays([pa.array([np.concatenate([x.ravel() for x in parts]).astype(np.float64).tobytes()], pa.binary())], names=["sums"])


def fit(coded: DataFrame, vocabulary: Vocabulary, class_tokens: np.ndarray, rate: float = 0.015) -> Network:
    """Train on all pieces. A shard's documents are dealt to the rounds in turn. In every round each shard goes on from
    the same weights; then those of a symbol are averaged by how often the shards read it, those of a word's vector by
    how often it followed, the others by the shards' words."""
    context = coded.sparkSession.sparkContext
    network, files = vocabulary.network(), len(coded.inputFiles())
    network.p["b"] = np.log((class_tokens + 1) / (class_tokens + 1).sum()).astype(np.float32)
    own, names = context.broadcast(vocabulary), list(network.p)
    shapes = {k: v.shape for k, v in network.p.items()}
    for r in range(ROUNDS):
        weights = context.broadcast(network.p)

        def run(batches: Iterable[pa.RecordBatch], weights=weights, turn=r, pace=rate * SLOWER**r) -> Iterator[pa.RecordBatch]:
            release()
            learner = None
            for b in batches:
                for first, x, e, shard in zip(b.column(0).to_pylist(), _arrays(b.column(1), np.uint16), _arrays(b.column(2), np.int64), b.column(3).to_pylist(), strict=True):
                    if learner is None or learner.shard != shard:  # small files of several shards may come to one task
                        if learner is not None:
                            yield learner.sums()
                        learner = _Learner(shard, own.value, weights.value, pace)
                    learner.nth += first
                    if learner.nth % ROUNDS == turn:
                        learner.add(first, x, e)
            if learner is not None:
                yield learner.sums()

        total = _total(coded.mapInArrow(run, "sums binary"), files)
        weights.destroy()
        if total is None:
            break
        at = len(total) - vocabulary.symbols - vocabulary.top
        read, given = total[at : at + vocabulary.symbols], total[at + vocabulary.symbols :]
        at = 0
        for k in names:
            size = int(np.prod(shapes[k]))
            by = {"p": read[:, None], "e": given[:, None]}.get(k, np.array(read.sum()))
            found = np.where(by > 0, total[at : at + size].reshape(shapes[k]) / np.maximum(1, by), network.p[k])
            if k == "e":
                found = found * by / (by + PRIOR)
            network.p[k] = found.astype(np.float32)
            at += size
    own.destroy()
    return network


def score_documents(docs: DataFrame, modulus: int = 7, remainder: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row of ``docs``.

    The model learns from the rows that aren't held out (crc32 of doc_id as text, modulo ``modulus``, isn't
    ``remainder``); rows with a null doc_id aren't held out. Null text counts as empty: one token, the end.
    Repeated rows count and are scored once each; other columns are ignored. Without training tokens every
    score is the base score, 0. Texts are read whole, a megabyte at a time, with the state carried along; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    held = F.coalesce(crc_mod("doc_id", modulus) == remainder, F.lit(False))
    rows = lean(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", held.alias("held_out"))
    training = rows.where(~F.col("held_out"))
    counts = materialize(_count_words(training), "words")
    ends = training.count()
    distinct, words = (x or 0 for x in counts.agg(F.count("*"), F.sum("n")).first())
    n_train, n_distinct = words + ends, distinct + (ends > 0)
    shared, least = shared_words(counts)
    coded = _coded(training, shared, words)
    vocabulary = Vocabulary(shared, find_clusters(coded, shared), ends)
    classes = spark.sparkContext.broadcast(vocabulary)

    unshared = counts.where((F.length("word") > WORD_BYTES) | (_bucket("n") < least))

    def classed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = classes.value
        for b in batches:
            edges = edges_of(_listed(b.column(0)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(v.clusters.of(edges), pa.int32())], names=["word", "n", "cluster"])

    unshared = materialize(unshared.mapInArrow(classed, "word binary, n long, cluster int"), "rare")
    mass = {r.cluster: r.m for r in unshared.groupBy("cluster").agg(F.sum(F.col("n") + 1).alias("m")).collect()}
    classes.destroy()
    tokens = np.bincount(vocabulary.class_of[: vocabulary.rare], vocabulary.counts, vocabulary.classes)
    tokens[vocabulary.class_of[vocabulary.rare : vocabulary.end]] = [mass.get(g, 0) for g in range(CLUSTERS)]
    tokens[-1] = ends
    network = fit(coded, vocabulary, tokens)
    discard(coded)
    model = spark.sparkContext.broadcast((vocabulary, network))
    # log10 of the tokens of each cluster's rare words, one more for each word and one for the unknown
    rare = np.log10([mass.get(g, 0) + 1 for g in range(CLUSTERS)])
    floor = float(np.log10(n_train + n_distinct + 1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, net = model.value
        logs = np.concatenate([np.log10(v.counts + 1), np.zeros(CLUSTERS), [np.log10(v.ends + 1)]])
        fixed = v.share.copy()
        fixed[: v.top] = 0  # these come from the state
        fixed[v.rare : v.end] = -rare
        scorer = Scorer(v, net, logs, fixed)
        for b in batches:
            for at in range(0, b.num_rows, 128):
                part = b.slice(at, 128)
                for key, data in zip(zip(*(part.column(i).to_pylist() for i in range(3)), strict=True), binary_texts(part.column(3)), strict=True):
                    yield from scorer.add(key, data)
        yield from scorer.flush()

    scored = rows.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "held_out", "text")
    partial = materialize(scored.mapInArrow(run, PARTIAL), "partial")
    found = partial.select("row", F.explode(F.arrays_zip("rare_words", "rare_counts")).alias("x")).select("row", F.col("x.rare_words").alias("word"), F.col("x.rare_counts").alias("k"))
    logs = found.join(unshared.select("word", "n"), "word").groupBy("row").agg(F.sum("k").alias("known"), F.sum(F.col("k") * F.log10(F.col("n") + F.lit(1.0))).alias("logs"))
    whole = partial.drop("rare_words", "rare_counts").join(logs, "row", "left")
    more = F.coalesce("logs", F.lit(0.0))
    base = F.col("base") + more - F.col("n_tokens") * F.lit(floor)
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"), base.alias("base_score"),
        (F.col("score") + more if n_train else base).alias("score"),
    )


PARTIAL = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, rare_words array<binary>, rare_counts array<long>"


class _Document:
    """What is known of a document so far, and the ids that aren't scored yet: first the one that is read last."""

    def __init__(self, key: tuple, end: int):
        self.key, self.ids, self.n, self.known, self.base, self.score, self.rare = key, [np.array([end], np.int32)], 0, 0, 0.0, 0.0, Counter()
        self.finished = False


class Scorer:
    """Everything about documents but the counts of their rare words; ``BUFFER`` words side by side."""

    def __init__(self, v: Vocabulary, net: Network, logs: np.ndarray, fixed: np.ndarray):
        self.v, self.net, self.logs, self.fixed, self.ids = v, net, logs, fixed, v.word_ids()
        self.held: list[_Document] = []
        self.texts: list[bytes] = []
        self.owners: list[_Document] = []  # whose texts these are
        self.size, self.bytes, self.carried = 0, 0, None

    def add(self, key: tuple, data: bytes) -> Iterator[pa.RecordBatch]:
        self.held.append(_Document(key, self.v.end))
        for part in windows(data, 1 << 20):
            if part:
                self.texts.append(part)
                self.owners.append(self.held[-1])
                self.bytes += len(part)
                if self.bytes > 4 * BUFFER:
                    self._number()
                if self.size > 2 * BUFFER:  # a very long text: what it has so far
                    yield from self._score(unfinished=True)
        self.held[-1].finished = True
        self.size += 1
        if self.size > BUFFER:
            yield from self.flush()

    def _number(self) -> None:
        """Give the words of the texts that are held to their documents, as numbers."""
        words, sizes = split_words(self.texts)
        numbers = self.ids.of_all(words).astype(np.int32)
        at, ends = np.flatnonzero(numbers >= self.v.rare), np.cumsum(sizes)
        rare, cuts, begin, cut = _listed(words.take(pa.array(at))), np.searchsorted(at, ends).tolist(), 0, 0
        for document, end, next_cut in zip(self.owners, ends.tolist(), cuts, strict=True):
            document.ids.append(numbers[begin:end])
            if cut < next_cut:
                document.rare.update(rare[cut:next_cut])
            begin, cut = end, next_cut
        self.size += begin
        self.bytes = 0
        self.texts.clear()
        self.owners.clear()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield from self._score(unfinished=False)

    def _score(self, unfinished: bool) -> Iterator[pa.RecordBatch]:
        v, held = self.v, self.held
        self._number()
        end = np.array([v.end], np.int32)
        for d in held:
            if d.finished:
                d.ids.append(end)
        sizes = np.array([sum(map(len, d.ids)) for d in held])
        ids = self.ids.settle(np.concatenate([x for d in held for x in d.ids]))
        self.ids.trim()
        ends = np.cumsum(sizes)
        starts = ends - sizes
        reads, classes, places = v.symbol.take(ids), v.class_of.take(ids), v.place.take(ids)
        sequences = [(reads[a : b - 1], classes[a + 1 : b], places[a + 1 : b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        sums, state = self.net.score(sequences, self.carried)
        gives, begins, last = np.delete(ids, starts), starts - np.arange(len(held)), ids[ends - 1].astype(np.int32)
        known = (gives < v.rare) | ((gives == v.end) & (v.ends > 0))
        per_document = [np.add.reduceat(x, begins).tolist() for x in (np.ones(len(gives), np.int64), known.astype(np.int64), self.logs[gives], self.fixed[gives])]
        for i, (d, s, n, k, base, fixed) in enumerate(zip(held, (sums / np.log(10)).tolist(), *per_document, strict=True)):
            d.n, d.known, d.base, d.score, d.ids = d.n + n, d.known + k, d.base + base, d.score + s + fixed, [last[i : i + 1]]
        self.held, self.size, self.carried = (held[-1:], 0, state) if unfinished else ([], 0, None)
        done = held[:-1] if unfinished else held
        for at in range(0, len(done), 256):
            yield _partial(done[at : at + 256])


def _partial(docs: list[_Document]) -> pa.RecordBatch:
    offsets = np.cumsum([0, *(len(d.rare) for d in docs)]).astype(np.int32)
    names, amounts = [w for d in docs for w in d.rare], [k for d in docs for k in d.rare.values()]
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
    rows = zip(*((*d.key, d.n, d.known, d.base, d.score) for d in docs), strict=True)
    return pa.RecordBatch.from_arrays(
        [*(pa.array(c, t) for c, t in zip(rows, kinds, strict=True)),
         pa.ListArray.from_arrays(pa.array(offsets), pa.array(names, pa.binary())), pa.ListArray.from_arrays(pa.array(offsets), pa.array(amounts, pa.int64()))],
        names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare_words", "rare_counts"],
    )
