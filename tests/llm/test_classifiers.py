"""Held-out accuracy, the machines' arithmetic, and odd input."""

import zlib

import numpy as np
import pytest

from lamina.llm.labelled import labelled_sample
from lamina.llm.quality import QuadraticDiscriminant, fit_quality, keep_good, score_quality, statistics
from lamina.llm.toxicity import FactorizationMachine, fit_toxicity, keep_harmless, score_toxicity

SF = "/root/testdata/sf0.1"


def tables(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def auc(y, s):
    order = np.argsort(s, kind="stable")
    ranks = np.empty(len(s))
    ranks[order] = np.arange(1, len(s) + 1)
    n = y.sum()
    return (ranks[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.mark.parametrize("label, fit, score, least, wrong", [("toxic", fit_toxicity, score_toxicity, 0.97, 0.03), ("quality", fit_quality, score_quality, 0.99, 0.02)])
def test_held_out_accuracy(spark, label, fit, score, least, wrong):
    docs, labels = tables(spark)
    got = score(docs, fit(docs, labels)).toPandas().merge(labels.toPandas(), on="doc_id")
    held = got[got["held_out"]]
    assert (held["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    assert auc(held[label].to_numpy(), held["score"].to_numpy()) >= least
    assert (held["predicted"] != held[label]).mean() <= wrong
    assert got["score"].between(0, 1).all()


def test_labels_of_held_out_rows_have_no_effect(spark):
    docs, labels = tables(spark, "/root/testdata/sf0.001")
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - quality, quality) quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - toxic, toxic) toxic")
    for fit, score in ((fit_toxicity, score_toxicity), (fit_quality, score_quality)):
        a, b = (sorted(score(docs, fit(docs, x)).collect()) for x in (labels, flipped))
        assert a == b


def test_machine_learns_a_pair():
    """Harm only where two terms meet: out of reach for additive weights."""
    rng = np.random.default_rng(0)
    present = rng.random((3000, 6)) < 0.5
    y = (present[:, 0] & present[:, 1]).astype(float)
    y = np.where(present[:, 2] & ~present[:, 0], 0.0, y)
    model = FactorizationMachine(np.arange(6))
    rows = [np.flatnonzero(p) for p in present]
    model.fit(rows, y, epochs=60)
    assert auc(y, model.score(rows)) > 0.99
    rows = [*rows[:5], np.zeros(0, int), rows[6]]
    x = np.array([np.isin(np.arange(6), r) * max(1, len(r)) ** -0.75 for r in rows])
    pairs = [sum(model.v[i] @ model.v[j] * r[i] * r[j] for i in range(6) for j in range(i)) for r in x]
    assert model.logit(rows) == pytest.approx(model.bias + x @ model.w + pairs)


def test_discriminant_is_the_posterior():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (400, 3)), rng.normal(1, 2, (800, 3))])
    y = np.repeat([0, 1], [400, 800])
    model = QuadraticDiscriminant()
    model.fit(x, y)
    z = model.scaled(x[:7])
    log = []
    for k, (mean, inverse, _) in enumerate(model.classes):
        cov = np.linalg.inv(inverse.T @ inverse)
        d = z - mean
        log.append(np.log([1 - model.prior, model.prior][k]) - 0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) + np.linalg.slogdet(cov)[1]))
    assert model.score(x[:7]) == pytest.approx(1 / (1 + np.exp(log[0] - log[1])))


def test_odd_and_empty(spark, odd, nothing):
    docs, labels = tables(spark, "/root/testdata/sf0.001")
    for fit, score, keep in ((fit_toxicity, score_toxicity, keep_harmless), (fit_quality, score_quality, keep_good)):
        model = fit(docs, labels)
        got = score(odd, model).collect()
        assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
        assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
        assert score(nothing, model).count() == 0
        kept = keep(odd, model)
        assert kept.columns == odd.columns and kept.count() == sum(r.predicted == (keep is keep_good) for r in got)
        untrained = fit(docs, labels.where("false"))
        assert all(0 <= r.score <= 1 for r in score(odd, untrained).collect())


def test_statistics_of_windows_agree():
    text = ("Some words, and lines lines.\nwords\n\n" * 300 + "a last line " * 40).encode()
    assert np.isfinite(statistics(text)).all() and np.isfinite(statistics(b"")).all()
    for window in (7, 100, 1000):
        assert statistics(text, window) == pytest.approx(statistics(text))


def test_sample_has_each_document_once(spark):
    docs = spark.createDataFrame([(0, f"text {i % 7}") for i in range(3000)] + [(i, f"doc {i}") for i in range(1, 200)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3 if i % 11 else None) for i in range(200)] + [(1, 0), (None, 1)], "doc_id long, toxic int")
    got = labelled_sample(docs.repartition(5), labels, "toxic", 1000).collect()
    free = [i for i in range(200) if i % 11 and zlib.crc32(str(i).encode()) % 4 != 2]
    assert sorted(r.text for r in got) == sorted(f"doc {i}" for i in free)
    assert {r.text: r.y for r in got} == {f"doc {i}": int(i % 3 > 0) for i in free}
    assert labelled_sample(docs, spark.createDataFrame([(0, 1)], "doc_id long, toxic int"), "toxic", 5).count() == 1


def test_nothing_is_rejected_without_labels(spark, odd):
    docs, labels = tables(spark, "/root/testdata/sf0.001")
    for fit, keep in ((fit_toxicity, keep_harmless), (fit_quality, keep_good)):
        assert keep(odd, fit(docs, labels.where("false"))).count() == odd.count()
