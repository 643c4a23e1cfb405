"""Periodic runs, vector codes and prefix BPE against brute force and the library, on odd rows and on whole tables."""

import hashlib
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lamina.llm import queries, vector_codes
from lamina.llm.prefix_bpe import PrefixCoder, PrefixEncoder, coding_digests, encode_and_decode
from lamina.llm.queries import BYTE_BPE, WORD_BPE, tokenizer_path
from lamina.llm.runs import find_runs, periodic_runs, planted, run_digests
from lamina.llm.tokens import load_tokenizer
from lamina.llm.vector_codes import code_digests, encode_vectors, nearest
from tests.llm.conftest import ROWS

SF = "/root/testdata/sf0.001"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# periodic runs


def all_runs(w):
    """Every period, every maximal stretch, and its smallest period by trying all smaller ones."""
    n, out = len(w), []
    for p in range(1, n // 4 + 1):
        same = [w[i] == w[i + p] for i in range(n - p)] + [False]
        start = None
        for i, x in enumerate(same):
            if x and start is None:
                start = i
            elif not x and start is not None:
                s, e, start = start, i + p, None
                part = w[s:e]
                if len(part) >= max(6, 4 * p) and not any(part[q:] == part[:-q] for q in range(1, p)):
                    out.append((s, e - s, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 7), st.integers(0, 5)), max_size=6))
def test_runs_equal_brute_force(parts):
    w = [x for unit, times, cut in parts for x in (unit * times)[: len(unit) * times - cut]]
    assert periodic_runs(np.array(w, "int64")) == all_runs(w)


def test_runs_with_chunks_and_skipped_points():
    w = np.zeros(300_000, "int64")
    w[100_000:] = np.tile(np.arange(1, 8), 30_000)[:200_000]
    assert periodic_runs(w) == [(0, 100_000, 1), (100_000, 200_000, 7)]
    nested = ([1] * 6 + [2] * 7) * 5  # runs inside the repeated part of a longer one
    assert periodic_runs(np.array(nested)) == all_runs(nested)
    with pytest.raises(ValueError):
        periodic_runs(w, times=2)


def runs_by_hand(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n, old = h // 10, len(words), list(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [old[i] if i < a else old[a + (i - a) % p] for i in range(n)]
    runs = all_runs(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    collapsed = b" ".join(x for i, x in enumerate(words) if i not in gone)
    return doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha(lines), hashlib.sha256(collapsed).hexdigest()


def test_runs_of_odd_rows(spark, odd, nothing):
    extra = [(20, "la " * 50), (21, "a b " * 20 + "c " + "x y z " * 6), (22, " ".join("pqrst" * 3)), (22, "no runs here at all"), (23, "\x1c \x1c \x1c \x1c \x1c \x1c \xa0 \xa0 \xa0 \xa0 \xa0 \xa0")]
    extra += [(i, "the quick brown fox " * 3 + f"jumps over dog {i} " * (i % 7)) for i in range(100, 160)]
    rows = [r for r in ROWS if len(r[1] or "") < 100_000] + extra
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("runs", "collapsed", "best", "start")})
    got = [tuple(r) for r in run_digests(find_runs(df, change=planted)).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()]
    order = lambda r: [(x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r]
    assert sorted(got, key=order) == sorted((runs_by_hand(*r) for r in rows), key=order)
    assert sum(r[1] for r in got) > 30
    assert find_runs(odd).count() == len(ROWS)
    assert run_digests(find_runs(nothing)).count() == 0
    whole = {r.doc_id: r for r in find_runs(odd).collect()}
    assert whole[8].collapsed.split(" ") == [x.decode() for x in dict(ROWS)[8].encode().split()] and whole[2].collapsed == "" and whole[1].runs == []


def test_op11_over_the_table(spark):
    got = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, SF).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()}
    docs = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        if len(text or "") < 12_000:
            assert got[doc_id] == runs_by_hand(doc_id, text)


# vector codes


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 6), st.integers(1, 64), st.integers(0, 40), st.integers(0, 10**6))
def test_nearest_equals_brute_force(width, k, n, seed):
    r = np.random.default_rng(seed)
    parts, entries = r.integers(-3, 4, (n, width)), r.integers(-3, 4, (k, width))  # small numbers: many ties
    index, distance = nearest(parts, entries)
    every = ((parts[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    assert index.tolist() == every.argmin(axis=1).tolist() and distance.tolist() == every.min(axis=1).tolist()


def codes_by_hand(rows, parts=16, k=64, rounds=2):
    """Plain lists; one length of vectors."""
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-len(kept[0][1]) // parts)
    cut = [[(v + [0] * (width * parts - len(v)))[p * width : p * width + width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:k]] for p in range(parts)]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y, strict=True))
    find = lambda x, book: min(range(len(book)), key=lambda e: (far(x, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            of = [find(c[p], books[p]) for c in cut]
            books[p] = [[sum(c[p][d] for c, o in zip(cut, of, strict=True) if o == e) // of.count(e) for d in range(width)] if e in of else books[p][e] for e in range(len(books[p]))]
    digest = sha(",".join(str(x) for b in books for e in b for x in e))
    out = []
    for (i, _, lab), c in zip(kept, cut, strict=True):
        code = [find(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for e in code), sum(far(c[p], books[p][e]) for p, e in enumerate(code)), lab, digest))
    sums = Counter()
    for _, _, err, lab, _ in out:
        sums[lab] += err
    return [(i, c, err, sums[lab], d) for i, c, err, lab, d in out]


SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n, length, seed, ids=lambda k: k):
    r = random.Random(seed)
    return [(ids(k), [float(np.float32(r.gauss(0, 1))) for _ in range(length)], r.choice([None, 0, 1, 2])) for k in range(n)]


def plain(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


@pytest.mark.parametrize("hot", [10_000, 1])
def test_codes_of_odd_vectors(spark, monkeypatch, hot):
    monkeypatch.setattr(vector_codes, "HOT", hot)  # with 1, sums of labels also come by an exchange
    rows = vectors(150, 32, 1, lambda k: k // 2) + [(3, None, 1), (4, [None] * 32, 1), (5, [math.nan] + [0.0] * 31, 2), (6, [math.inf] * 32, 2), (None, [0.5] * 32, None)] + [(9, [0.25] * 32, 0)] * 3
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("code", "error", "length", "ints", "part", "rows")}).repartition(5)
    assert plain(code_digests(df)) == sorted(codes_by_hand(rows), key=repr)


@pytest.mark.parametrize("n, length", [(1, 16), (40, 16), (90, 20), (70, 5)])
def test_small_books_and_uneven_lengths(spark, n, length):
    rows = vectors(n, length, n)
    assert plain(code_digests(spark.createDataFrame(rows, SCHEMA))) == sorted(codes_by_hand(rows), key=repr)


def test_lengths_apart_empty_and_too_large(spark):
    short, long = vectors(70, 16, 5), vectors(66, 32, 6, lambda k: 1000 + k)
    got = {r.vec_id: r for r in encode_vectors(spark.createDataFrame(short + long + [(-1, [], 0)], SCHEMA))[0].collect()}
    for rows in (short, long):
        for i, code, err, _, _ in codes_by_hand(rows):
            assert bytes(got[i].code).hex() == code and got[i].error == err
    assert got[-1].code == [0] * 16 and got[-1].error == 0
    assert code_digests(spark.createDataFrame([], SCHEMA)).count() == 0
    assert code_digests(spark.createDataFrame([(1, None, 1)], SCHEMA)).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        code_digests(spark.createDataFrame([(1, [1e12] * 16, 0)], SCHEMA)).count()


def test_op12_equals_sql(spark):
    db = duckdb.connect()
    db.sql(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    expected = db.sql(f"select vec_id, code, error, label_error, codebooks_sha256 from ({vector_codes.ORACLE_SQL})").fetchall()
    assert plain(queries.op12_vector_codes(spark, SF)) == sorted(expected, key=repr) and len(expected) == 500


# prefix BPE

PARTS = list("abeinost'sSTÉé 12  \n\n\t!?.,-</w>ΣςİﬁⅣ中日😀\x1c\x85 　́\x0b\x0c\x00") + ["<|endoftext|>", "<|startoftext|>", "</w>", "'ll", "the", "ing", "aaaa"] + [" "] * 12


def test_prefixes_equal_the_library():
    own, library = PrefixEncoder(tokenizer_path(WORD_BPE), limit=200), load_tokenizer(tokenizer_path(WORD_BPE))
    own.coder.limit = 500
    r = random.Random(7)
    for _ in range(6000):
        t = "".join(r.choice(PARTS) for _ in range(r.randint(0, 16)))
        ids = np.frombuffer(own.encode(t.encode()), "<u4").tolist()
        assert ids == library.encode(t, add_special_tokens=False).ids, repr(t)
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False), repr(t)
    for t in ("banana" * 5000, "".join(r.choice("aehinorst") for _ in range(40_000))):
        assert np.frombuffer(own.encode(t.encode()), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_every_vocabulary_string():
    """Alone, a token's own string has the encoding that the library gives it."""
    own, library = PrefixCoder(tokenizer_path(WORD_BPE)), load_tokenizer(tokenizer_path(WORD_BPE))
    words = [t[:-4] for t in library.get_vocab(with_added_tokens=False) if t.endswith("</w>") and t[:-4].isascii() and t[:-4].isalpha() and t[:-4].islower()]
    assert len(words) > 20_000
    for w, e in zip(words, library.encode_batch_fast(words, add_special_tokens=False), strict=True):
        assert own.ids(w) == e.ids


def test_each_prefix_has_one_last_token():
    """Of all vocabulary strings that end a prefix, exactly one fits the encoding of what stands before it."""
    coder = PrefixCoder(tokenizer_path(WORD_BPE))
    by_text = {s: i for i, s in coder.shown.items()}
    r = random.Random(3)
    for _ in range(300):
        word = "".join(r.choice("aeinorst") for _ in range(12))
        last = []
        for end in range(1, len(word) + 1):
            fits = [t for k in range(end) if (t := by_text.get(word[k:end])) is not None and (k == 0 or coder.compatible(last[k - 1], t))]
            assert len(fits) == 1
            last.append(fits[0])


def test_refuses_other_tokenizers(tmp_path):
    with pytest.raises(ValueError, match="decoder"):
        PrefixEncoder(tokenizer_path(BYTE_BPE), words=False)


def coding_by_hand(library, doc_id, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def test_coding_of_odd_rows(odd, nothing):
    library = load_tokenizer(tokenizer_path(WORD_BPE))
    coded = encode_and_decode(odd, tokenizer_path(WORD_BPE))
    got = [tuple(r) for r in coding_digests(coded).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert sorted(got, key=repr) == sorted((coding_by_hand(library, *r) for r in ROWS), key=repr)
    assert coding_digests(encode_and_decode(nothing, tokenizer_path(WORD_BPE))).count() == 0


def test_op13_over_the_table(spark):
    library = load_tokenizer(tokenizer_path(WORD_BPE))
    got = [tuple(r) for r in queries.op13_prefix_bpe(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert sorted(got) == sorted(coding_by_hand(library, *r) for r in duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())
