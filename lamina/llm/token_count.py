"""Token counts by a whole-token shortcut.

Before any document is read, ``proven_whole`` finds the vocabulary strings that the tokenizer encodes,
standing alone as a pre-token, as exactly one token. A text is then cut into pre-tokens by the
tokenizer's own pattern; each proven pre-token counts as one token directly, and only the rest is merged
by the library.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lamina.llm.common import binary_texts, kept, lean, release, windows
from lamina.llm.tokens import load_tokenizer, odd_space

#: Fixed value: the pre-token pattern of byte-level BPE tokenizers of this family.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters on whose class every version of Unicode agrees; other texts go to the library whole.
PLAIN = regex.compile(r"[\x09-\x0d\x20-\x7e¡-ɏΑ-ΡΣ-ωА-я‐-‧€ぁ-ゖァ-ヺ一-龥]*+")


def proven_whole(tokenizer) -> set[str]:
    """Vocabulary strings that are one pre-token and encode alone as one token."""
    pattern = regex.compile(PRE_TOKEN)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    ids = list(tokenizer.get_vocab(with_added_tokens=False).values())
    strings = [s for s in tokenizer.decode_batch([[i] for i in ids], skip_special_tokens=False) if s and "�" not in s and s not in special]
    coded = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
    return {s for s, e in zip(strings, coded, strict=True) if len(e.ids) == 1 and pattern.fullmatch(s) and pattern.match(s).end() == len(s)}


class Counter:
    """Tokens of texts; ``limit`` bounds how many merged pre-tokens are kept."""

    def __init__(self, path: str, limit: int = 600_000):
        self.tokenizer, self.limit = load_tokenizer(path), limit
        self.pattern = regex.compile(PRE_TOKEN)
        self.whole = proven_whole(self.tokenizer)
        self.merged: dict[str, int] = {}
        marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, marks)) or r"(?!)")

    def count(self, data: bytes) -> int:
        text = data.decode("utf-8", "replace")
        if odd_space(data) or self.special.search(text) or not PLAIN.fullmatch(text):
            return len(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)
        whole, merged = self.whole, self.merged
        parts = self.pattern.findall(text)
        rest = [p for p in parts if p not in whole]
        missing = [p for p in set(rest) if p not in merged]
        if missing:
            if len(merged) + len(missing) > self.limit:
                merged.clear()
                missing = list(set(rest))
            coded = self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)
            merged.update((p, len(e.ids)) for p, e in zip(missing, coded, strict=True))
        return len(parts) - len(rest) + sum(map(merged.__getitem__, rest))


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, window: int = 1 << 20) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of every row of ``docs``.

    Null text counts as empty (0 bytes, 0 tokens, not over). Repeated rows each give a row; a null doc_id
    stays null; other columns are ignored. Special strings inside a text count as the library takes them by
    default. Very long texts are counted a window at a time. One pass without a shuffle.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release("counters")
        own = kept("counters")
        counter = own.get(tokenizer) or own.setdefault(tokenizer, Counter(tokenizer))
        for batch in batches:
            sizes, counts = [], []
            for at in range(0, batch.num_rows, 256):
                for data in binary_texts(batch.column(1).slice(at, 256)):
                    sizes.append(len(data))
                    counts.append(sum(map(counter.count, windows(data, window))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return lean(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
