"""Quality by regularised quadratic discriminant analysis over statistics of a document.

Each class has a mean and a covariance of transformed statistics, shrunk towards the pooled covariance and
towards a multiple of the identity. A score is the posterior of class 1: the difference of the two log
densities, whose Mahalanobis terms come from Cholesky factors that are computed once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import binary_texts, lean, release, windows
from lamina.llm.labelled import SAMPLE, held_out, labelled_sample

THRESHOLD = 0.7
_BYTES = np.arange(256)
#: Byte classes of which a document's shares are taken.
CLASSES = {
    "upper": (_BYTES >= 65) & (_BYTES <= 90),
    "digit": (_BYTES >= 48) & (_BYTES <= 57),
    "blank": np.isin(_BYTES, [32, 9, 11, 12, 13]),
    "line": _BYTES == 10,
    "stop": np.isin(_BYTES, list(b".,;:?")),
    "shout": _BYTES == ord("!"),
    "bar": np.isin(_BYTES, list(b"|\\/~_=")),
    "sign": np.isin(_BYTES, list(b"#$%&*@^+<>")),
    "wide": _BYTES >= 128,
}
_MEMBER = np.array([m for m in CLASSES.values()], dtype=float)


def statistics(data: bytes, window: int = 1 << 20) -> np.ndarray:
    """Transformed statistics of one text; of an empty text, zeros and the values that shares of nothing have.

    Words of very long texts are counted a window at a time, with distinct words as hashes; the last word and the
    unfinished line of a window go on in the next, so the size of windows changes nothing.
    """
    counts, words, distinct, letters, squares, repeats = np.zeros(256), 0, set(), 0, 0, 0
    lines, distinct_lines, line, last = 1, set(), b"", None
    for part in windows(data, window):
        counts += np.bincount(np.frombuffer(part, dtype=np.uint8), minlength=256)
        w = part.split()
        sizes = np.fromiter(map(len, w), dtype=np.int64, count=len(w))
        words += len(w)
        letters += int(sizes.sum())
        squares += int((sizes**2).sum())
        h = np.fromiter(map(hash, w), dtype=np.int64, count=len(w))
        repeats += int((h[1:] == h[:-1]).sum()) + (len(h) > 0 and int(h[0]) == last)
        last = int(h[-1]) if len(h) else last
        distinct.update(h.tolist())
        first, *more = part.split(b"\n")
        lines += len(more)
        if more:
            distinct_lines.add(hash(line + first))
            distinct_lines.update(map(hash, more[:-1]))
            line = more[-1]
        else:
            line += first
    distinct_lines.add(hash(line))
    n, m = max(1.0, float(counts.sum())), max(1, words)
    share = _MEMBER @ counts / n
    mean = letters / m
    return np.concatenate(
        (
            np.log(share + 1e-4),
            [
                np.log1p(words),
                np.log(mean + 1),
                np.log1p(max(0.0, squares / m - mean * mean)),
                np.log(len(distinct) + 1) - np.log(m + 1),
                np.log(repeats / m + 1e-3),
                np.log(len(distinct_lines) + 1) - np.log(lines + 1),
                np.log1p(n / max(1, lines)),
            ],
        )
    )


class QuadraticDiscriminant:
    """Two Gaussian classes; ``pooling`` and ``ridge`` are the shares of the pooled covariance and of the
    identity in each class's covariance."""

    def __init__(self, pooling: float = 0.3, ridge: float = 0.005, reach: float = 6.0):
        self.pooling, self.ridge, self.reach = pooling, ridge, reach
        self.classes: list[tuple[np.ndarray, np.ndarray, float]] = []

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.center) / self.spread, -self.reach, self.reach)

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        self.prior = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        if not len(y) or y.min() == y.max():
            return
        self.center, self.spread = x.mean(0), np.maximum(x.std(0), 1e-6)
        z = self.scaled(x)
        centered = z - np.stack([z[y == k].mean(0) for k in (0, 1)])[y]
        pooled = centered.T @ centered / len(y)
        self.classes = []
        for k in (0, 1):
            own = centered[y == k]
            cov = (1 - self.pooling) * (own.T @ own) / len(own) + self.pooling * pooled
            cov = (1 - self.ridge) * cov + self.ridge * np.trace(cov) / len(cov) * np.eye(len(cov))
            root = np.linalg.cholesky(cov)
            constant = float(np.log(self.prior if k else 1 - self.prior) - np.log(np.diag(root)).sum())
            self.classes.append((z[y == k].mean(0), np.linalg.inv(root), constant))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1."""
        if not self.classes:
            return np.full(len(x), self.prior)
        z = self.scaled(x)
        low, high = (c - 0.5 * (((z - mean) @ inverse.T) ** 2).sum(1) for mean, inverse, c in self.classes)
        return 1 / (1 + np.exp(np.clip(low - high, -40, 40)))


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QuadraticDiscriminant:
    """Fit on a bounded sample of labelled documents (``labelled_sample`` says what counts as which label); the
    driver gets their statistics, not texts. Without documents of both labels every score is the prior."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            found = [statistics(t).tobytes() for t in binary_texts(b.column(0))]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(found, pa.binary())], names=["y", "x"])

    got = labelled_sample(docs, labels, "quality", sample).mapInArrow(measure, "y int, x binary").collect()
    got.sort()  # the fit doesn't depend on the order in which tasks end
    model = QuadraticDiscriminant()
    width = len(statistics(b""))
    model.fit(np.array([np.frombuffer(r.x) for r in got]).reshape(-1, width), np.array([r.y for r in got], dtype=int))
    return model


def score_quality(docs: DataFrame, model: QuadraticDiscriminant, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``, from its whole text alone.

    Null text counts as empty, and empty texts have statistics too. Repeated rows each give a row; a null
    doc_id stays null (held_out is then false); other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two means and factors of a fixed size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            x = [statistics(t) for at in range(0, b.num_rows, 256) for t in binary_texts(b.column(2).slice(at, 256))]
            score = shared.value.score(np.array(x)) if x else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), b.column(1), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    flagged = lean(docs).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    return flagged.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: QuadraticDiscriminant, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns; all rows if the model had
    no labels of both classes to be fitted on.

    Null text counts as empty, rows with a null doc_id are judged like all others, of repeated rows all stay or
    none, and an empty table stays empty.
    """
    if not model.classes:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            texts = b.column(b.schema.get_field_index("text"))
            x = [statistics(t) for at in range(0, b.num_rows, 256) for t in binary_texts(texts.slice(at, 256))]
            yield b.filter(pa.array(shared.value.score(np.array(x)) >= threshold)) if x else b

    return lean(docs).mapInArrow(run, docs.schema)
