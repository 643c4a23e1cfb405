"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its words in lower case, without punctuation around them, and the words' first four and
five letters. From a bounded labelled sample the terms that differ most between the classes are kept; the
machine learns a weight for each and a vector, whose inner products are the weights of pairs of terms that
occur together: what an additive model misses.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import binary_texts, lean, materialize, release, windows
from lamina.llm.labelled import SAMPLE, held_out, labelled_sample

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
THRESHOLD = 0.3


def terms_of_word(word: bytes) -> tuple[int, ...]:
    """31-bit hashes of a word and its stems."""
    bare = word.strip(PUNCTUATION)
    if not bare:
        return ()
    letters = bare.decode("utf-8", "replace")
    stems = [b"4" + letters[:4].encode(), b"5" + letters[:5].encode()] if len(letters) >= 5 else []
    return tuple(xxhash.xxh3_64_intdigest(t) >> 33 for t in (b"w" + bare, *stems))


class Words(dict):
    """word -> what ``of`` says, kept for at most ``limit`` words."""

    def __init__(self, of, limit: int = 150_000):
        release()
        self.of, self.limit = of, limit

    def __missing__(self, word: bytes):
        if len(self) > self.limit:
            self.clear()
        self[word] = value = self.of(word)
        return value


def terms(data: bytes, words: Words) -> set[int]:
    found: set[int] = set()
    for part in windows(data, 1 << 20):
        found.update(*map(words.__getitem__, set(part.lower().split())))
    return found


class FactorizationMachine:
    """score = sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j) over the terms that are present,
    each x_i = (terms present) ** -0.75."""

    def __init__(self, keys: np.ndarray, factors: int = 8, seed: int = 7):
        self.keys = np.sort(keys)
        self.bias, self.w = 0.0, np.zeros(len(keys))
        self.v = np.random.default_rng(seed).normal(0, 0.05, (len(keys), factors))
        self.words = None

    def __getstate__(self):
        return self.__dict__ | {"words": None}

    def index_of_word(self, word: bytes) -> tuple[int, ...]:
        found = []
        for key in terms_of_word(word):
            at = int(np.searchsorted(self.keys, key))
            if at < len(self.keys) and self.keys[at] == key:
                found.append(at)
        return tuple(found)

    def present(self, data: bytes) -> list[int]:
        if self.words is None:
            self.words = Words(self.index_of_word)
        return sorted(terms(data, self.words))

    def logit(self, rows: list) -> np.ndarray:
        """Of texts given by the terms present in each: sums over these terms, no matrix of all terms."""
        sizes, at, starts = _laid_out(rows)
        if not len(at):
            return np.full(len(rows), self.bias)
        some, out = sizes > 0, np.full(len(rows), self.bias)
        x = sizes[some] ** -0.75
        w, v, squares = (np.add.reduceat(a[at], starts[some]) for a in (self.w, self.v, (self.v**2).sum(1)))
        out[some] += x * w + 0.5 * x * x * ((v**2).sum(1) - squares)
        return out

    def score(self, rows: list) -> np.ndarray:
        """Scores of texts given by the terms present in each."""
        return 1 / (1 + np.exp(-np.clip(self.logit(rows), -40, 40)))

    def fit(self, rows: list, y: np.ndarray, epochs: int = 30, batch: int = 512, rate: float = 0.05, decay: float = 1e-5, seed: int = 11) -> None:
        """Adam on the logistic loss."""
        mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        self.bias = float(np.log(mean / (1 - mean)))
        if not len(self.keys):
            return
        rng, step, n = np.random.default_rng(seed), 0, len(self.keys)
        bias = np.array([self.bias])
        params = [bias, self.w, self.v]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for first in range(0, len(y), batch):
                pick = order[first : first + batch]
                sizes, at, starts = _laid_out([rows[i] for i in pick])
                some = sizes > 0
                x = np.zeros(len(pick))
                x[some] = sizes[some] ** -0.75
                v, sums = self.v[at], np.zeros((len(pick), self.v.shape[1]))
                z = np.full(len(pick), bias[0])
                if len(at):
                    sums[some] = np.add.reduceat(v, starts[some])
                    z[some] += x[some] * np.add.reduceat(self.w[at], starts[some])
                    z[some] += 0.5 * x[some] ** 2 * ((sums[some] ** 2).sum(1) - np.add.reduceat((v**2).sum(1), starts[some]))
                g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[pick]) / len(pick)
                owner = np.repeat(np.arange(len(pick)), sizes)
                own = (g * x * x)[owner][:, None] * (sums[owner] - v)
                dv = np.stack([np.bincount(at, own[:, f], n) for f in range(own.shape[1])], axis=1)
                grads = [np.array([g.sum()]), np.bincount(at, (g * x)[owner], n) + decay * self.w, dv + decay * self.v]
                step += 1
                for p, d, (m, s) in zip(params, grads, moments, strict=True):
                    m += 0.1 * (d - m)
                    s += 0.001 * (d * d - s)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
        self.bias = float(bias[0])


def _laid_out(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of rows of terms, all their terms one after the other, and where each row begins."""
    sizes = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
    at = np.concatenate([np.asarray(r, dtype=np.int64) for r in rows]) if len(rows) else np.zeros(0, np.int64)
    return sizes, at, np.concatenate(([0], np.cumsum(sizes)))[:-1].astype(np.int64)


def term_scores(sampled: DataFrame, n1: int, n0: int) -> DataFrame:
    """term and z: how far its share of documents differs between the classes, as a two-proportion z score.

    Tasks count their own documents first, so the exchange has a row for each task and term.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[list[np.ndarray]] = [[], []]
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen[y].append(np.frombuffer(t, dtype="<i4"))
        for y, arrays in enumerate(seen):
            if arrays:
                term, n = np.unique(np.concatenate(arrays), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(n * y, pa.int64()), pa.array(n * (1 - y), pa.int64())], names=["term", "c1", "c0"])

    counted = sampled.mapInArrow(count, "term int, c1 long, c0 long").groupBy("term").agg(F.sum("c1").alias("c1"), F.sum("c0").alias("c0"))
    p = (F.col("c1") + F.col("c0") + 1) / F.lit(n1 + n0 + 2)
    z = F.abs(F.col("c1") / F.lit(n1) - F.col("c0") / F.lit(n0)) / F.sqrt(p * (F.lit(1.0) - p) * F.lit(1 / n1 + 1 / n0))
    return counted.where("c1 + c0 >= 3").select("term", z.alias("z"))


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most_terms: int = 4096, least_z: float = 3.0) -> FactorizationMachine:
    """Fit on a bounded sample of labelled documents (``labelled_sample`` says what counts as which label); the
    driver gets the chosen terms that each has. Without documents of both labels there are no terms, and every
    score is the share of toxic ones in the sample, or a half."""

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(terms_of_word)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                found = [np.array(sorted(terms(t, words)), dtype="<i4").tobytes() for t in binary_texts(b.column(0).slice(at, 256))]
                yield pa.RecordBatch.from_arrays([b.column(1).slice(at, 256), pa.array(found, pa.binary())], names=["y", "terms"])

    sampled = materialize(labelled_sample(docs, labels, "toxic", sample).mapInArrow(hashed, "y int, terms binary"), "terms")
    n = {r.y: r.n for r in sampled.groupBy("y").agg(F.count("*").alias("n")).collect()}
    keys = np.zeros(0, dtype=np.int64)
    if len(n) == 2:
        chosen = term_scores(sampled, n[1], n[0]).where(F.col("z") >= least_z).orderBy(F.desc("z"), "term").limit(most_terms)
        keys = np.array([r.term for r in chosen.collect()], dtype=np.int64)
    model = FactorizationMachine(keys)
    known = model.keys

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.flatnonzero(np.isin(known, np.frombuffer(t, dtype="<i4"))).astype("<i4").tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], names=["y", "at"])

    got = sorted((r.y, bytes(r.at)) for r in sampled.mapInArrow(kept, "y int, at binary").collect())  # in no task's order
    model.fit([np.frombuffer(at, dtype="<i4") for _, at in got], np.array([y for y, _ in got], dtype=float))
    return model


def score_toxicity(docs: DataFrame, model: FactorizationMachine, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``, from its whole text alone.

    Null and empty texts have no terms: their score is the model's for no evidence. Repeated rows each give
    a row; a null doc_id stays null (held_out is then false); other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most most_terms * (factors + 2) numbers

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            rows = [model.present(t) for at in range(0, b.num_rows, 256) for t in binary_texts(b.column(2).slice(at, 256))]
            score = model.score(rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), b.column(1), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    flagged = lean(docs).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    return flagged.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_harmless(docs: DataFrame, model: FactorizationMachine, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score stays below the threshold, with all their columns; all rows if the model
    found no terms to be fitted on.

    Null and empty texts have the score of no evidence, rows with a null doc_id are judged like all others, of
    repeated rows all stay or none, and an empty table stays empty.
    """
    if not len(model.keys):
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index("text"))
            rows = [shared.value.present(t) for at in range(0, b.num_rows, 256) for t in binary_texts(texts.slice(at, 256))]
            yield b.filter(pa.array(shared.value.score(rows) < threshold, pa.bool_()))

    return lean(docs).mapInArrow(run, docs.schema)
