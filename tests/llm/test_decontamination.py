"""Containment search against brute force."""

import random

import numpy as np

from lamina.llm import decontaminate
from lamina.llm.decontaminate import ItemIndex, find_leaks, item_blocks, item_sets, kind_of, set_blocks, step_for, without_leaks
from tests.llm.conftest import LONG, words


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(docs, items, percent=80):
    out = []
    for d, t in docs:
        own = shingles(t)
        for i, s in items:
            test = shingles(s)
            if test and len(test & own) * 100 >= percent * len(test):
                out.append((d, i, len(test), len(test & own)))
    return sorted(out)


def material():
    r = random.Random(5)
    items = [(i, words(100 + i, r.choice([5, 6, 9, 14, 30, 59, 120, 700]), 5000)) for i in range(60)]
    items += [(60, None), (61, "two words"), (62, "  "), (63, items[0][1])]
    docs = [(1, None), (2, ""), (3, "two words"), (4, "Two  WORDS"), (5, LONG)]
    for k in range(120):
        item = r.choice(items[:60])[1].split()
        if r.random() < 0.5 and len(item) > 12:
            for _ in range(r.randint(1, 3)):
                item[r.randrange(len(item))] = "edited"
        body = words(1000 + k, r.choice([0, 20, 300, 4000]), 5000).split()
        at = r.randint(0, len(body))
        docs.append((10 + k, " ".join(body[:at] + [x.upper() for x in item] + body[at:])))
    return docs, items


def test_against_brute_force(spark):
    docs, items = material()
    expected = brute(docs, items)
    assert len(expected) > 60
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, find_leaks(frame, bench).collect())) == expected
    kept = {r.doc_id for r in without_leaks(frame, bench).collect()}
    assert kept == {d for d, _ in docs} - {x[0] for x in expected}


def test_blocks_of_items(spark, monkeypatch):
    docs, items = material()
    monkeypatch.setattr("lamina.llm.decontaminate.item_blocks", lambda s: item_blocks(s, 500))
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    _, sets = item_sets(bench)
    blocks = list(item_blocks(sets, 500))
    assert len(blocks) > 3 and len({i for b in blocks for i in b.ids}) == sets.count()
    assert sorted(map(tuple, find_leaks(frame, bench).collect())) == brute(docs, items)
    kept = sorted(r.doc_id for r in without_leaks(frame, bench).collect())
    assert kept == sorted({d for d, _ in docs} - {x[0] for x in brute(docs, items)})


def test_what_the_driver_collects_is_bounded(spark):
    """Repeated items are one set; blocks hold what was counted, or a single bucket."""
    rows = [(i, words(1, 20, 1000)) for i in range(3000)] + [(5000 + i, words(10 + i, 40, 1000)) for i in range(50)]
    _, sets = item_sets(spark.createDataFrame(rows, "item_id long, text string"))
    assert sets.count() == 51
    for low, high, n in set_blocks(sets, 200):
        held = [r.n for r in sets.selectExpr("n", f"pmod(xxhash64(set_id), {n}) b").where(f"b >= {low} and b < {high}").collect()]
        assert sum(held) <= 200 or high == low + 1
    found = find_leaks(spark.createDataFrame([(1, words(1, 20, 1000))], "doc_id long, text string"), spark.createDataFrame(rows, "item_id long, text string"))
    assert found.count() == 3000


def test_odd_and_empty(spark, odd, nothing):
    bench = spark.createDataFrame([(1, "same row twice same row twice same row"), (None, "a text without an id")], "item_id long, text string")
    assert sorted(r.doc_id for r in find_leaks(odd, bench).collect()) == [10, 10]
    assert without_leaks(odd, bench).columns == odd.columns
    assert find_leaks(nothing, bench).count() == 0
    assert find_leaks(odd, bench.where("false")).count() == 0
    assert without_leaks(odd, bench.where("false")).count() == odd.count()


def test_items_that_repeat_themselves(spark):
    """Few distinct shingles at many places, alone and beside others, copied whole into long documents."""
    items = []
    for distinct, times in ((1, 60), (5, 12), (5, 40), (5, 200), (16, 62), (17, 60), (30, 60), (60, 20)):
        for k in range(6):
            phrase = words(7000 + 100 * distinct + 10 * k + times, distinct, 100_000)
            items.append((len(items), " ".join([phrase] * times)))
    docs = [(i, f"{words(8000 + i, 5000, 100_000)} {t} {words(9000 + i, 5000, 100_000)}") for i, t in items]
    expected = brute(docs, items)
    assert len(expected) >= len(items)
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, find_leaks(frame, bench).collect())) == expected


def test_most_items_go_through_signatures(spark):
    """Of the benchmark's sets with more than ``SMALL`` shingles nearly all, and nine of ten of all."""
    _, sets = item_sets(spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet"))
    kinds = [(r.n, kind_of(r.n, r.positions, 80)[0]) for r in sets.collect()]
    assert sum(k != "all" for _, k in kinds) > 0.9 * len(kinds)
    assert all(k != "all" for n, k in kinds if n > decontaminate.SMALL + 1)


def test_windows_hold_what_they_should():
    """Wherever a passage begins, one window of four steps has all of it."""
    for positions in range(1, 200):
        step = step_for(positions)
        assert all(any(w <= at and at + positions <= w + 4 * step for w in range(0, at + 1, step)) for at in range(4 * step))


def test_signatures_overlook_nothing():
    """Thousands of short items with a fifth of their shingles lost, at the worst places of long texts that cross segments."""
    rng = np.random.default_rng(1)
    for n in (17, 20, 31, 46, 55, 80, 300):
        sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for _ in range(300)]
        index = ItemIndex([(k, np.unique(s), n) for k, s in enumerate(sets)])
        assert {kind for (kind, _), *_ in index.partitions} <= {"hashes", "bins"}
        text = rng.integers(0, 1 << 63, 40_000, dtype=np.uint64)
        places = rng.choice(len(text) // 400 - 1, 60, replace=False) * 400 + rng.integers(0, 90, 60)
        places[:2] = decontaminate.SEGMENT - n // 2, len(text) - n
        chosen = rng.choice(300, 60, replace=False)
        for k, at in zip(chosen, places, strict=True):
            keep = rng.permutation(n) < -(-n * 8 // 10)
            text[at : at + n] = np.where(keep, sets[k], text[at : at + n])
        assert set(chosen.tolist()) <= index.candidates(text)


def test_few_values_are_widened(monkeypatch):
    """Values of windows that no item has stay at 32 bits, but for a few that share a place in the small filter."""
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 63, 20, dtype=np.uint64)) for _ in range(60)]
    index, text, seen, wide = ItemIndex([(k, s, 20) for k, s in enumerate(sets)]), rng.integers(0, 1 << 63, 20_000, dtype=np.uint64), [], decontaminate._wide
    text[777:797] = sets[5]
    monkeypatch.setattr(decontaminate, "_wide", lambda x: (seen.append(x.size), wide(x))[1])
    assert 5 in index.candidates(text)
    assert 0 < sum(seen) < sum(np.size(x) for parts in decontaminate.tight_minima(text, index.steps).values() for x in parts) / 5
