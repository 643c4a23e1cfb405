"""BPE encoding by dynamic programming over prefixes, and decoding.

Every prefix of a pre-token has exactly one last token: the encoding of a prefix that ends in a given token is the
encoding of the rest before it and that token, and two tokens may stand side by side only if the merges would
never have crossed the place between them. So a pre-token is read once from left to right. An automaton of the
vocabulary lists, longest first, the tokens that are suffixes of the prefix read so far; the first of them that is
compatible with the last token of the shorter prefix is stored, and back-pointers from the end give the ids.
No merge is ever carried out.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import binary_texts, kept, lean, release
from lamina.llm.tokens import Encoder, load_tokenizer

#: Fixed value: how word-level BPE of this family cuts a text in lower case, for ASCII alone.
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9\s]+")
#: Parts that are cut by that pattern; all others by the tokenizer's own normaliser and pre-tokenizer.
PRINTABLE = re.compile(rb"[!-~]*")
NEVER = 1 << 40


class PrefixCoder:
    """Ids of single pre-tokens, given in the alphabet of the tokenizer's vocabulary.

    ``limit`` bounds how many pairs of tokens are remembered as compatible or not.
    """

    def __init__(self, path: str, limit: int = 2_000_000):
        import ahocorasick

        with open(path, encoding="utf-8") as source:
            model = json.load(source)["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd:
            raise ValueError(f"prefixes have a unique last token only under plain BPE, not with {odd or model['type']}")
        self.end = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        vocabulary: dict[str, int] = model["vocab"]
        #: The time at which a pair merges, and for each token when it arises and from what. Base symbols always were.
        self.time: dict[tuple[int, int], int] = {}
        self.born: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for k, (a, b) in enumerate(merges):
            x, y, made = vocabulary[a], vocabulary[b], vocabulary[a + b]
            if made in self.born:
                raise ValueError("a token that arises from two merges may have two encodings")
            self.time[x, y], self.born[made], self.halves[made] = k, k, (x, y)
        #: A base symbol that closes a word is one character here, from beyond those of the byte alphabet.
        self.shown: dict[int, str] = {}
        for text, i in vocabulary.items():
            if i not in self.born:
                closes = bool(self.end) and text.endswith(self.end) and len(text) == 1 + len(self.end)
                if not closes and len(text) != 1:
                    continue
                self.shown[i] = self.closing(text[0]) if closes else text
        automaton = ahocorasick.Automaton()
        for i, text in self.shown.items():
            automaton.add_word(text, (i, 1))
        self.limit, self.pairs = limit, {}
        for made in sorted(self.born, key=self.born.__getitem__):
            x, y = self.halves[made]
            if x in self.shown and y in self.shown and self._beside(x, y, self.born[made]):  # else merges never get there
                self.shown[made] = self.shown[x] + self.shown[y]
                automaton.add_word(self.shown[made], (made, len(self.shown[made])))
        automaton.make_automaton()
        self.automaton = automaton

    @staticmethod
    def closing(char: str) -> str:
        return chr(0x10000 + ord(char))

    def _beside(self, a: int, b: int, until: int = NEVER) -> bool:
        """Whether tokens a and b stay apart until a time, when the symbols of both are merged in order.

        From that time back: whichever of the two arose last is undone, and its part at the boundary takes its
        place. A pair that meets at the boundary would have merged at its time, if that lies before the time at
        which either side was used up. At equal times (the same pair repeated) the left one of two merges is first.
        """
        times, born, halves = self.time, self.born, self.halves
        left, right = until, until  # when the symbol at the boundary is used up inside its own side
        while True:
            t = times.get((a, b), NEVER)
            if t < left and t <= right and t < until:
                return False
            x, y = born.get(a, -1), born.get(b, -1)
            if x < 0 and y < 0:
                return True
            if x > y:
                left, a = x, halves[a][1]
            else:
                right, b = y, halves[b][0]

    def compatible(self, a: int, b: int) -> bool:
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) >= self.limit:
                self.pairs.clear()
            found = self.pairs[a, b] = self._beside(a, b)
        return found

    def ids(self, piece: str) -> list[int]:
        """The ids of one pre-token, each of whose characters has to be in the byte alphabet."""
        if not piece:
            return []
        word = piece[:-1] + self.closing(piece[-1]) if self.end else piece
        last: list[int] = [-1] * len(word)
        size: list[int] = [0] * len(word)
        for at, (token, length) in self.automaton.iter(word):
            if last[at] >= 0:
                continue
            before = at - length
            if before < 0 or self.compatible(last[before], token):
                last[at], size[at] = token, length
        out, at = [], len(word) - 1
        while at >= 0:
            out.append(last[at])
            at -= size[at]
        return out[::-1]


class PrefixEncoder(Encoder):
    """``Encoder`` whose ids come from ``PrefixCoder``: of the library it uses the normaliser, the pre-tokenizer and
    the list of special tokens, never the merges. ``decode`` is the library's for tokenizers without a decoder."""

    def __init__(self, path: str, words: bool = True, limit: int = 500_000):
        super().__init__(path, words, limit)
        self.coder = PrefixCoder(path)
        if self.tokenizer.decoder is not None:
            raise ValueError("only tokenizers without a decoder, whose tokens are joined by a space, are decoded here")
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = {s.encode(): np.array([i], "<u4").tobytes() for s, i in added.items()}
        self.marks = re.compile(b"(" + b"|".join(sorted(map(re.escape, self.added), key=len, reverse=True)) + b")" if added else rb"((?!))")
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.strings = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            if len(self.pieces) >= self.limit:
                self.pieces.clear()
            found = self.pieces[piece] = np.array(self.coder.ids(piece), "<u4").tobytes()
        return found

    def _segment(self, data: bytes) -> bytes:
        """A text without special tokens."""
        if self.words and PRINTABLE.fullmatch(data):
            return b"".join(map(self._piece, ASCII_PIECES.findall(data.decode().lower())))
        text = data.decode("utf-8", "replace")
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        return b"".join(self._piece(p) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text))

    def _library(self, texts: list[bytes]) -> list[bytes]:
        return [
            self._segment(t) if b"<" not in t and not self.marks.search(t) else b"".join(self.added.get(x) or self._segment(x) for x in self.marks.split(t) if x)
            for t in texts
        ]

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.strings.__getitem__, ids))


def _coder(path: str, words: bool) -> PrefixEncoder:
    own = kept("prefix encoders")
    if (path, words) not in own:
        release("prefix encoders")
        own[path, words] = PrefixEncoder(path, words)
    return own[path, words]


#: Ids after which a task hands on what it has.
AT_ONCE = 1 << 19


def encode_and_decode(docs: DataFrame, tokenizer: str, words: bool = True) -> DataFrame:
    """doc_id, ids (array of int) and decoded (string) of every row of ``docs``.

    ``words``: the tokenizer drops white space and case. Null and empty texts have no ids and decode to an empty
    string. Repeated rows each give a row; a null doc_id stays null; other columns are ignored, whatever their
    names. Special strings in a text are special tokens, as the library has it. Very long texts are encoded a
    megabyte at a time, cut where no token can reach across. One pass without a shuffle; an empty table gives none.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer, words)

        def handed(doc_ids: list, coded: list[bytes]) -> pa.RecordBatch:
            ids = [np.frombuffer(c, "<u4") for c in coded]
            ends = np.cumsum([0] + [len(x) for x in ids], dtype="int32")
            flat = pa.array(np.concatenate(ids).astype("int32"), pa.int32())
            decoded = pa.array([coder.decode(x.tolist()) for x in ids], pa.string())
            return pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), flat), decoded], names=["doc_id", "ids", "decoded"])

        for batch in batches:
            doc_ids, coded, size, seen = batch.column(0).cast(pa.int64()).to_pylist(), [], 0, 0
            for at in range(0, batch.num_rows, 64):
                found = coder.encode_documents(binary_texts(batch.column(1).slice(at, 64)))
                coded += found
                size += sum(map(len, found)) // 4
                if size > AT_ONCE:
                    yield handed(doc_ids[seen : seen + len(coded)], coded)
                    seen, coded, size = seen + len(coded), [], 0
            if coded:
                yield handed(doc_ids[seen:], coded)

    return lean(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def coding_digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by a space) and decoded_sha256, from the operator's result."""
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
