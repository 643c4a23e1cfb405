"""Groups against all pairs, at several sizes of group."""

import random

import numpy as np
import pytest

from lamina.llm import neardup
from lamina.llm.components import connected_components
from tests.llm.conftest import BASE, NEAR, ROWS, words


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset()


def brute(rows, percent):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both * 100 >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    smallest = {}
    for k, (i, _) in enumerate(rows):
        ids = [x for x in (smallest.get(root(k)), i) if x is not None]
        smallest[root(k)] = min(ids) if ids else None
    return sorted((-1 if i is None else i, len(sets[k]), -1 if smallest[root(k)] is None else smallest[root(k)]) for k, (i, _) in enumerate(rows))


def result(df, percent):
    rows = neardup.near_duplicates(df, percent).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(tuple(-1 if x is None else x for x in r[:3]) for r in rows)


@pytest.mark.parametrize("percent", [80, 85])
def test_families_of_edits(spark, percent):
    r = random.Random(percent)
    rows = [(i, words(10_000 + i, r.choice([3, 8, 40, 200]), 3000)) for i in range(150)]
    for family in range(6):
        base = words(family, r.choice([30, 120, 150]), 3000).split()
        for k in range(60):
            own = list(base)
            for _ in range(r.randint(0, 9)):
                own[r.randrange(len(own))] = f"e{r.randrange(10**6)}"
            rows.append((1000 + 100 * family + k, " ".join(own)))
    passage = words(77, 60, 3000)
    rows += [(5000 + i, words(20_000 + i, 90, 3000) + " " + passage) for i in range(60)]
    rows += [(6000 + i, passage.upper()) for i in range(40)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(df, percent) == brute(rows, percent)


def test_blocks_and_slices(spark, monkeypatch):
    """Small blocks and slices take the paths of very large groups and sets."""
    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "SLICE_BITS", 6)
    r = random.Random(4)
    base = words(1, 120, 3000).split()
    rows = []
    for k in range(90):
        own = list(base)[: r.choice([60, 120])]
        for _ in range(r.randint(0, 6)):
            own[r.randrange(len(own))] = f"e{r.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    assert result(spark.createDataFrame(rows, "doc_id long, text string"), 80) == brute(rows, 80)


def test_odd_and_empty(spark, odd, nothing):
    assert result(odd, 80) == brute(ROWS, 80)
    assert neardup.near_duplicates(nothing).count() == 0
    kept = neardup.keep_first(odd)
    assert kept.columns == odd.columns
    left = sorted((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in kept.collect())
    assert [i for i, _ in left] == [-1, 1, 2, 3, 4, 5, 8, 9, 10, 11, 11]
    assert neardup.keep_first(nothing).count() == 0


def test_kept_rows_never_depend_on_other_groups(spark):
    rows = [(1, ""), (1, ""), (2, None), (2, None), (3, "a b c d e f"), (None, " "), (None, " ")]
    kept = lambda r: sorted((x.doc_id or 0, x.text or "") for x in neardup.keep_first(spark.createDataFrame(r, "doc_id long, text string")).collect())
    assert kept(rows) == kept([*rows, rows[4]]) == kept([*rows, (4, "A b  c d e f")]) == sorted((i or 0, t or "") for i, t in rows)


def test_rows_without_id_or_with_one_id(spark):
    """Near copies are linked whatever their ids are, and one row of them stays."""
    near = [BASE, NEAR, BASE.replace(BASE.split()[50], "other", 1)]
    frame = lambda ids: spark.createDataFrame(list(zip(ids, near, strict=True)), "doc_id long, text string").repartition(2)
    assert [r.doc_id for r in neardup.keep_first(frame([None, 7, None])).collect()] == [7]
    assert result(frame([None, 7, None]), 80) == [(-1, 196, 7), (-1, 196, 7), (7, 196, 7)]
    assert neardup.keep_first(frame([None, None, None])).count() == 1
    assert neardup.keep_first(frame([3, 3, 3])).count() == 1
    # two near copies without an id that only a third text joins
    far = " ".join(w if k % 17 else f"x{k}" for k, w in enumerate(BASE.split()))
    assert neardup.near_duplicates(spark.createDataFrame([(None, BASE), (None, BASE), (9, far)], "doc_id long, text string")).where("component_id is null").count() == 2


def test_scratch_is_removed(spark, odd):
    import pathlib

    base = pathlib.Path(spark.sparkContext.getConf().get("spark.checkpoint.dir").removeprefix("file://")) / "lamina"
    before = set(base.iterdir()) if base.exists() else set()
    neardup.near_duplicates(odd).collect()
    assert [p.name.split("-")[0] for p in set(base.iterdir()) - before] == ["groups"]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    for share in (0.5, 0.85, 0.95):
        found = []
        for _ in range(60):
            both = rng.integers(0, 1 << 63, int(400 * share), dtype=np.uint64)
            rest = rng.integers(0, 1 << 63, (2, (400 - len(both)) // 2), dtype=np.uint64)
            found.append((neardup.signature(np.concatenate([both, rest[0]])) == neardup.signature(np.concatenate([both, rest[1]]))).mean())
        assert np.mean(found) == pytest.approx(share, abs=0.02)


def test_posterior_bounds():
    """The bound is the least number of matches whose posterior still reaches the chosen probability."""
    for n, m in neardup.least_matches(0.85, 1e-6):
        t = np.linspace(0, 1, 200_001)

        def above(k, n=n, t=t):
            density = np.exp(k * np.log(np.maximum(t, 1e-300)) + (n - k) * np.log(np.maximum(1 - t, 1e-300)))
            return density[t >= 0.85].sum() / density.sum()

        assert above(m) >= 0.9e-6 and above(m - 1) < 1.1e-6


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (103, 100)] + [(200, 200 + i) for i in range(1, 30)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 104)} | {i: 200 for i in range(200, 230)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
