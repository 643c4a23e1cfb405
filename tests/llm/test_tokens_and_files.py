"""Encoding against the library, the file format's round trip and random access."""

import io
import random
import zlib

import numpy as np
import pytest

from lamina.llm.common import windows
from lamina.llm.dac import DacFile, DacWriter, token_digest
from lamina.llm.queries import BYTE_BPE, WORD_BPE, tokenizer_path
from lamina.llm.token_count import Counter, count_tokens
from lamina.llm.tokens import Encoder, load_tokenizer
from tests.llm.conftest import ROWS

PARTS = list("ab'sSTÉé 12  \n\n\t!?.ΣςİﬁⅣ中日😀\x1c\x85 　́\x0b\x0c") + ["<|endoftext|>", "'ll", "'re", " ", "foo", "Bar,", " "] + [" "] * 12 + ["\n"] * 3


def texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 16))) for _ in range(n)]


@pytest.mark.parametrize("name, bare", [(WORD_BPE, True), (BYTE_BPE, False)])
def test_encoder_equals_library(name, bare):
    own, library = Encoder(tokenizer_path(name), bare, limit=300), load_tokenizer(tokenizer_path(name))
    for t in texts(4000, 3):
        assert np.frombuffer(own.encode(t.encode()), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)
    long = " ".join(texts(3000, 4))
    assert np.frombuffer(own.encode_documents([long.encode()], window=1000)[0], "<u4").tolist() == library.encode(long, add_special_tokens=False).ids


def test_counter_equals_library():
    own, library = Counter(tokenizer_path(BYTE_BPE), limit=100), load_tokenizer(tokenizer_path(BYTE_BPE))
    assert len(own.whole) > 40_000
    for t in texts(4000, 5):
        assert own.count(t.encode()) == len(library.encode(t, add_special_tokens=False).ids), repr(t)


def test_windows_join_to_the_text():
    for t in texts(500, 6):
        data = (t * 5).encode()
        parts = list(windows(data, 7))
        assert b"".join(parts) == data
        assert not any(p.decode()[-1:].isspace() for p in parts[:-1])


def test_windows_change_no_tokens():
    """White space of all kinds beside the places where texts are cut."""
    library = load_tokenizer(tokenizer_path(BYTE_BPE))
    coder, counter = Encoder(tokenizer_path(BYTE_BPE)), Counter(tokenizer_path(BYTE_BPE))
    r = random.Random(8)
    for _ in range(1500):
        t = "".join(r.choice(["a", "bc", "é", " ", "  ", "\n", "\u00a0", "\u2003", "\u3000", "\x85", "\x1d", "\t", "."]) for _ in range(40))
        expected = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(coder.encode_documents([t.encode()], window=8)[0], "<u4").tolist() == expected, repr(t)
        assert sum(map(counter.count, windows(t.encode(), 8))) == len(expected), repr(t)


class Bytes(io.BytesIO):
    def read_at(self, n, at):
        return self.getbuffer()[at : at + n].tobytes()

    def size(self):
        return len(self.getbuffer())


@pytest.mark.parametrize("most", [200, 60_000, 1 << 32])
def test_format(most, monkeypatch):
    monkeypatch.setattr("lamina.llm.dac.SEGMENT", 1000)
    rng = np.random.default_rng(1)
    docs = [(i, rng.integers(0, most, n, dtype=np.uint64).astype("<u4")) for i, n in zip([-5, 0, 7, 7, 9, None, None], [0, 1, 700, 2500, 0, 3, 999], strict=True)]
    out = Bytes()
    writer = DacWriter(out)
    for i, ids in docs:
        writer.add(i, ids.tobytes())
    writer.close()
    file, all_ids = DacFile(out), np.concatenate([ids for _, ids in docs])
    assert [file.get(i) for i in range(0, len(all_ids), 7)] == all_ids[::7].tolist()
    assert np.concatenate([file.decode_segment(k) for k in range(len(file.levels))]).tolist() == all_ids.tolist()
    starts = np.cumsum([0] + [len(ids) for _, ids in docs])
    assert list(file.digests()) == [(i, int(starts[k]), len(ids), zlib.crc32(ids.tobytes())) for k, (i, ids) in enumerate(docs)]
    with pytest.raises(IndexError):
        file.get(len(all_ids))


def test_empty_file():
    out = Bytes()
    DacWriter(out).close()
    assert list(DacFile(out).digests()) == [] and DacFile(out).tokens == 0


def test_digest_of_odd_rows(odd):
    rows = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_digest(odd, tokenizer_path(WORD_BPE), 2).collect()]
    got = sorted(rows, key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((i for i, _ in ROWS if i is not None)) + [None]  # without an id: last
    library = load_tokenizer(tokenizer_path(WORD_BPE))
    coded = {i: [library.encode(t or "", add_special_tokens=False).ids + [2] for j, t in ROWS if j == i] for i, _ in ROWS}
    assert len(got) == sum(map(len, coded.values()))
    at = 0
    for doc_id, start, n, crc in got:
        assert start == at
        ids = next(x for x in coded[doc_id] if len(x) == n and zlib.crc32(np.array(x, "<u4").tobytes()) == crc)
        coded[doc_id].remove(ids)
        at += n


def test_empty_tables(nothing):
    assert token_digest(nothing, tokenizer_path(WORD_BPE), 2).count() == 0
    assert count_tokens(nothing, tokenizer_path(BYTE_BPE)).count() == 0


def test_counts_of_odd_rows(odd):
    library = load_tokenizer(tokenizer_path(BYTE_BPE))
    key = lambda x: tuple(-1 if v is None else v for v in x)
    expected = sorted(((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS), key=key)
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in count_tokens(odd, tokenizer_path(BYTE_BPE)).collect()), key=key)
    assert got == expected
    assert all(r.over_limit == (r.n_tokens > 1024) for r in count_tokens(odd, tokenizer_path(BYTE_BPE)).collect())
