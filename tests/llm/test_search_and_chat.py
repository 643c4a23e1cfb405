"""Top-k search and preference formatting against brute force and SQL."""

import duckdb
import numpy as np
import pytest

from lamina.llm.chat import CLOSING, OPENING, format_preferences, pairs_by_last_answer, pairs_of
from lamina.llm import mtree
from lamina.llm.mtree import MTree, top_products
from lamina.llm.queries import ORACLE_SQL, QUERIES


def brute(ints, ids, q, k, own):
    scores = [(-int(x @ q), int(i), r) for r, (i, x) in enumerate(zip(ids, ints, strict=True)) if r != own]
    return [(-s, i, r) for s, i, r in sorted(scores)[:k]]


def test_tree_is_exact_and_prunes(monkeypatch):
    monkeypatch.setattr("lamina.llm.mtree.PAGE", 8)
    rng = np.random.default_rng(2)
    centers = rng.integers(-100, 100, (20, 6))
    ints = centers[rng.integers(0, 20, 900)] + rng.integers(-3, 4, (900, 6))
    ints[100:140] = ints[100]  # ties
    ids = rng.permutation(900)
    tree = MTree(np.arange(900), ids, ints)
    for row in range(0, 900, 60):
        assert tree.search(ints[row], 5, row) == brute(ints, ids, ints[row], 5, row)
    same = MTree(np.arange(50), np.arange(50), np.ones((50, 4), dtype=np.int64))
    assert [v for _, v, _ in same.search(np.ones(4, dtype=np.int64), 3, 0)] == [1, 2, 3]


def test_cells(spark, monkeypatch):
    """Many cells, clustered vectors, a third of them copies: exact, and most cells are never asked."""
    monkeypatch.setattr("lamina.llm.mtree.SHARD", 50)
    asked, others = [], mtree.Cells.others
    rng = np.random.default_rng(6)
    centers = rng.normal(0, 3, (12, 6))
    vectors = [(i, [float(x) for x in (centers[i % 12] + rng.normal(0, 0.05, 6) if i % 3 else centers[0])]) for i in range(1500)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").selectExpr("*", "vec_id key", "vec_id pivot", "vec_id tree", "1 dim").repartition(3)
    got = sorted(tuple(r) for r in top_products(df, 4, 25).collect())
    full = np.floor(256 * np.array([v for _, v in vectors])).astype(np.int64)
    expected = []
    for q in range(0, 1500, 25):
        scores = sorted((-int(s), i) for i, s in enumerate(full @ full[q]) if i != q)[:4]
        expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    assert got == sorted(expected)
    cells = mtree.Cells(float((full.astype(float) ** 2).sum(1).max()), full[[1, 2, 4, 5, 7, 8, 10, 11, 0]])
    near, distance = cells.nearest(full)
    cells.radius, cells.trees = np.array([distance[near == k].max(initial=-1.0) for k in range(9)]), np.ones(9, dtype=int)
    best = np.sort(full @ full[1])[-5]
    asked = others(cells, full[1], 0, float(best))
    assert len(asked) < 4


def test_components_beyond_64_bits_stop(spark):
    df = spark.createDataFrame([(0, [1e20, 0.0]), (1, [1e20, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        top_products(df).collect()


def test_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr("lamina.llm.mtree.SHARD", 20)
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 8)]) for i in range(0, 100)]
    rows += [(200, None), (250, [0.1] * 7 + [float("nan")]), (300, [0.1, None] + [0.2] * 6), (350, [float("inf")] * 8), (400, []), (450, [0.5, 0.5]), (None, [0.1] * 8), (50, rows[50][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in top_products(df).collect()]
    full = [(i, np.floor(256 * np.array(v, dtype=np.float32).astype(float)).astype(int)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    expected = []
    for at, (i, q) in enumerate(full):
        if i % 50 == 0:
            scores = sorted((-int(q @ x), j) for k, (j, x) in enumerate(full) if k != at and len(x) == len(q))[:5]
            expected += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores, 1)]
    assert sorted(got) == sorted(expected)
    assert top_products(df.where("false")).count() == 0


def compare(spark, name, sf):
    db = duckdb.connect()
    for t in ("embeddings", "conversations", "documents", "benchmark"):
        db.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got = QUERIES[name](spark, sf).toPandas()
    expected = db.sql(ORACLE_SQL[name]).df()[list(got.columns)]
    keys = list(got.columns)
    assert got.sort_values(keys).reset_index(drop=True).equals(expected.sort_values(keys).reset_index(drop=True))


def test_queries_against_sql(spark):
    for name in ORACLE_SQL:
        compare(spark, name, "/root/testdata/sf0.001")


def turn(role, text):
    return f"{OPENING}{role}\n{text}{CLOSING}"


def test_preferences(spark):
    rows = [
        (0, 0, "system", "be brief"), (0, 1, "user", "hi"), (0, 2, "assistant", "good"), (1, 0, "system", "be brief"), (1, 1, "user", "hi"), (1, 2, "assistant", "bad"),
        (1, 3, "user", "why"), (1, 4, "assistant", None), (2, 0, "user", "only chosen"), (4, 0, "user", "x"), (5, 0, "user", "x"), (7, 1, None, "b"), (7, 1, None, "b"), (7, None, "user", "a"),
        (None, 0, "user", "lost"), (1 << 60, 0, "user", "big"), ((1 << 60) + 1, 0, "user", "bigger"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'theirs' as side", "'x' as pair_id", "1 as turns", "'y' as chosen")
    pairs = spark.createDataFrame([("p", 0, 1), ("q", 2, None), ("r", 4, 5), ("s", None, 7), ("t", 1 << 60, (1 << 60) + 1), ("u", 99, 98), (None, 0, 1)], "pair_id string, chosen long, rejected long")
    got = {r.pair_id: r for r in format_preferences(pairs_of(turns, pairs)).collect()}
    assert sorted(got) == ["p", "q", "r", "s", "t", "u"]
    a = got["p"]
    assert a.prompt == turn("system", "be brief") + turn("user", "hi") and a.prompt_turns == 2
    assert a.chosen == turn("assistant", "good") and a.rejected == turn("assistant", "bad") + turn("user", "why") + turn("assistant", "")
    spans = [tuple(map(int, s.split(":"))) for s in a.rejected_mask.split(",")]
    assert [a.rejected[x:y] for x, y in spans] == ["bad<|im_end|>", "<|im_end|>"]
    assert [a.chosen[x:y] for x, y in [tuple(map(int, a.chosen_mask.split(":")))]] == ["good<|im_end|>"]
    assert (got["q"].prompt, got["q"].chosen, got["q"].rejected) == ("", turn("user", "only chosen"), None)
    assert (got["r"].prompt, got["r"].chosen, got["r"].rejected, got["r"].chosen_mask) == (turn("user", "x"), "", "", "")
    assert got["s"].rejected == turn("user", "a") + turn("", "b") * 2 and got["s"].chosen is None
    assert (got["t"].chosen, got["t"].rejected) == (turn("user", "big"), turn("user", "bigger"))
    assert (got["u"].prompt, got["u"].prompt_turns, got["u"].chosen, got["u"].rejected, got["u"].chosen_turns) == ("", 0, None, None, 0)
    assert format_preferences(pairs_of(turns, pairs.where("false"))).count() == 0


def test_pairs_by_last_answer(spark):
    rows = [(0, k, r, t) for k, (r, t) in enumerate([("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d"), ("user", "e")])]
    rows += [(1, 0, "user", "a"), (1, 1, "assistant", "only"), (2, 0, "user", "a"), (3, 0, "assistant", "first of all")]
    turns = spark.createDataFrame([*rows, (None, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    got = {r.pair_id: r for r in format_preferences(pairs_by_last_answer(turns)).collect()}
    assert sorted(got) == [0, 1, 2, 3]
    assert (got[0].prompt_turns, got[0].chosen, got[0].rejected) == (3, turn("assistant", "d") + turn("user", "e"), turn("assistant", "b"))
    assert (got[1].prompt, got[1].chosen, got[1].rejected, got[1].rejected_mask) == (turn("user", "a"), turn("assistant", "only"), "", "")
    assert [(got[k].prompt, got[k].rejected, got[k].chosen_turns) for k in (2, 3)] == [("", None, 1)] * 2
    real = format_preferences(pairs_by_last_answer(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))).toPandas()
    assert (real["prompt_turns"] > 0).mean() > 0.9
    assert pairs_by_last_answer(turns.where("false")).count() == 0


def test_a_tree_is_read_once_by_a_task(spark, monkeypatch):
    """Many batches of queries after a tree: one load; and a tree that many ask for goes to several tasks."""
    import pickle

    import numpy as np
    import pyarrow as pa

    loads, real = [], pickle.loads
    monkeypatch.setattr(mtree.pickle, "loads", lambda x: (loads.append(1), real(x))[1])
    rng = np.random.default_rng(0)
    ints = rng.integers(-50, 50, (90, 4))
    square = float((ints**2).sum(1).max())
    tree = MTree(np.arange(90), np.arange(90), ints, square)
    names = ["pages", "key", "query_id", "ints", "least", "dim"]
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.float64(), pa.int32())
    batch = lambda *rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
    asks = [(None, i, i, ints[i].astype("<i8").tobytes(), -np.inf, 4) for i in range(0, 90, 3)]
    got = list(mtree.search(iter([batch((pickle.dumps(tree), None, None, None, None, 4), *asks[:9]), batch(*asks[9:20]), batch(*asks[20:])]), 5))
    assert len(loads) == 1 and sum(b.num_rows for b in got) == 30 * 5
    rows = spark.createDataFrame([(int(i), [float(x) / 256 for x in v]) for i, v in enumerate(ints)], "vec_id long, embedding array<double>")
    whole = sorted(map(tuple, top_products(rows, every=2).collect()))
    monkeypatch.setattr(mtree, "LOAD", 4)
    monkeypatch.setattr(mtree, "SHARD", 40)
    assert sorted(map(tuple, top_products(rows, every=2).collect())) == whole
