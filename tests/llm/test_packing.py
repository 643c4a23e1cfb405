"""The plan against best-fit decreasing piece by piece, and whole results against the documents."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from lamina.llm.packing import CapacityTree, pack_documents, plan
from lamina.llm.queries import BYTE_BPE, tokenizer_path
from lamina.llm.tokens import load_tokenizer
from tests.llm.conftest import ROWS


def best_fit(counts, capacity):
    left = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [k for k, room in enumerate(left) if room >= length]
            if fits:
                left[min(fits, key=lambda k: left[k])] -= length
            else:
                left.append(capacity - length)
    return sorted(left)


def test_tree():
    tree = CapacityTree(10)
    assert tree.tightest(0) is None
    for c in (3, 7, 10):
        tree.add(c, 1)
    assert [tree.tightest(k) for k in (0, 3, 4, 8, 10)] == [3, 3, 7, 10, 10]
    tree.add(7, -1)
    assert tree.tightest(4) == 10


@pytest.mark.parametrize("capacity", [8, 64, 1024])
@pytest.mark.parametrize("spare", [2, 10_000])
def test_plan(capacity, spare):
    r = random.Random(capacity)
    for _ in range(40):
        counts = {r.randint(1, capacity): r.randint(1, 30) for _ in range(r.randint(0, 40))}
        fill, stream, seen = defaultdict(list), [], defaultdict(list)
        for x in plan(counts, capacity, spare):
            for k in range(x["n"]):
                seen[x["length"]].append(x["first"] + k)
                if x["bin"] >= 0:
                    fill[x["bin"] + k // x["per"]].append((x["offset"] + k % x["per"] * x["length"], x["length"]))
                else:
                    stream.append((x["offset"] + k * x["length"], x["length"]))
        assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(n)) for k, n in counts.items()}
        for pieces in [*fill.values(), stream]:
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
        if spare > capacity:
            assert not stream and sorted(capacity - sum(n for _, n in b) for b in fill.values()) == best_fit(counts, capacity)
        else:
            assert all(capacity - sum(n for _, n in b) <= spare or sum(n for _, n in b).bit_count() == 1 for b in fill.values())


def test_whole_result(odd):
    got = pack_documents(odd, tokenizer_path(BYTE_BPE)).toPandas()
    library = load_tokenizer(tokenizer_path(BYTE_BPE))
    expected = sorted((zlib.crc32(np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()), -1 if i is None else i) for i, t in ROWS)
    assert got["length"].sum() == sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ROWS)
    fills = []
    for _, x in got.sort_values("offset").groupby("sequence_id"):
        assert x["offset"].tolist() == (x["length"].cumsum() - x["length"]).tolist()
        fills.append(x["length"].sum())
    assert max(fills) <= 1024
    assert sum(1024 - f for f in fills) < 1024 + 17 * len(fills)
    single = got[(got["start"] == 0) & (got["length"] == got["doc_tokens"])]
    assert set(zip(single["ids_crc32"], single["doc_id"].fillna(-1).astype(int), strict=True)) <= set(expected)
    # every piece has its own document's ids, the cut and the poured ones too
    coded = [np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for _, t in ROWS]
    owners = defaultdict(list)  # repeated ids may have texts of equal lengths
    for (i, _), ids in zip(ROWS, coded, strict=True):
        for k, n in {(k, n) for k, n in zip(got["start"], got["length"], strict=True) if k + n <= len(ids)}:
            owners[-1 if i is None else i, len(ids), k, n].append(zlib.crc32(ids[k : k + n].tobytes()))
    pieces = defaultdict(list)
    for d, total, k, n, crc in zip(got["doc_id"].fillna(-1).astype(int), got["doc_tokens"], got["start"], got["length"], got["ids_crc32"], strict=True):
        pieces[d, total, k, n].append(crc)
    for key, crcs in pieces.items():
        assert sorted(crcs) == sorted(owners[key])
    assert (got["length"] < got["doc_tokens"]).sum() > 300
    assert len(got[got["start"] == 0]) == len(ROWS)


def test_dominant_length_leaves_little_padding(spark):
    docs = spark.createDataFrame([(i, "word " * 700) for i in range(60)], "doc_id long, text string")
    got = pack_documents(docs, tokenizer_path(BYTE_BPE)).toPandas()
    fills = got.groupby("sequence_id")["length"].sum()
    assert (1024 - fills).sum() < 1024 + 16 * len(fills)


def test_empty(nothing):
    assert pack_documents(nothing, tokenizer_path(BYTE_BPE)).count() == 0
