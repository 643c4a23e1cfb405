"""Token ids as the tokenizers library gives them, with a bounded cache of words.

A text is cut where white space follows something else. No pre-token of either tokenizer spans such a
place and neither normaliser composes across it, so the ids of a text are those of its parts joined. Each
distinct part is encoded by the library once while it stays in the cache; texts with the Unicode spaces
that the library also treats as white space go to the library whole.
"""

from __future__ import annotations

import os
import re

from lamina.llm.common import ODD_SPACE, kept, release, windows

PART = re.compile(rb"\s*\S+|\s+")
#: Latin letters and then punctuation: the pre-tokenizers always cut between the two.
CLOSED = re.compile(rb"(.*(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))([.,;:!?]+)", re.DOTALL)
ENDS = frozenset((b".", b",", b";", b":", b"!", b"?"))
#: With these a text isn't lower-cased ahead of the library: special tokens and combining marks.
CASED = (b"<|", b"\xcc", b"\xcd")
#: With these a text's white space isn't single spaces and line ends alone.
UNEVEN = (b"  ", b" \n", b"\n\n", b"\t", b"\r", b"\x0b", b"\x0c")
#: First bytes of ``ODD_SPACE``: a search for single bytes is much faster than for the pattern.
ODD_FIRST = (b"\x1c", b"\x1d", b"\x1e", b"\x1f", b"\xc2", b"\xe1\x9a", b"\xe2", b"\xe3\x80")


def odd_space(data: bytes) -> bool:
    return any(x in data for x in ODD_FIRST) and ODD_SPACE.search(data) is not None


def load_tokenizer(path: str):
    """A tokenizer that uses one thread: Spark runs one task for each core already."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _places(found: list) -> list[int]:
    """Where a list has None; most entries are passed without a step in Python."""
    out, at = [], -1
    try:
        while True:
            at = found.index(None, at + 1)
            out.append(at)
    except ValueError:
        return out


class Encoder:
    """``encode(bytes) -> bytes``: token ids as little-endian unsigned 32-bit integers.

    ``words``: the tokenizer drops white space and case (then parts are bare words in lower case); else each
    part keeps the white space before it. The cache holds ``limit`` parts at most and starts anew when it is full.
    """

    def __init__(self, path: str, words: bool = False, limit: int = 1_500_000):
        self.tokenizer, self.words, self.limit = load_tokenizer(path), words, limit
        self.cache: dict[bytes, bytes] = {}
        self.spaced: dict[bytes, bytes] = {}
        #: The library encodes what stands between special tokens independently: one call for many parts.
        special = next((t for t in self.tokenizer.get_added_tokens_decoder().items() if t[1].special), None)
        self.mark_id, self.mark = (special[0], special[1].content) if special else (None, None)

    def _library(self, texts: list[bytes]) -> list[bytes]:
        import numpy as np

        strings = [t.decode("utf-8", "replace") for t in texts]
        if self.mark is None or len(texts) == 1 or any(self.mark in t for t in strings):
            found = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
            return [np.array(e.ids, dtype="<u4").tobytes() for e in found]
        out: list[bytes] = []
        for i in range(0, len(strings), 512):
            joined = self.mark.join(strings[i : i + 512])
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
            raw, at = ids.tobytes(), 0
            for end in (np.flatnonzero(ids == self.mark_id) * 4).tolist():
                out.append(raw[at:end])
                at = end + 4
            out.append(raw[at:])
        return out

    def _parts(self, data: bytes) -> tuple[bytes, dict[bytes, bytes], list[bytes]]:
        """What stands first, and the parts after it with the cache that they belong to.

        In ``spaced`` a part stands for a space and the part, or for itself if it begins with a line end.
        That needs texts whose only white space is single spaces and line ends, none of them before a line end.
        """
        if self.words:
            return b"", self.cache, (data if any(x in data for x in CASED) else data.lower()).split()
        if any(x in data for x in UNEVEN):
            return b"", self.cache, PART.findall(data)
        head, *parts = data.replace(b"\n", b" \n").split(b" ")
        return head, self.spaced, parts

    def _learn(self, cache: dict[bytes, bytes], missing: set[bytes]) -> None:
        closed = {p: m.groups() for p in missing if p[-1:] in ENDS and (m := CLOSED.fullmatch(p))}
        order = list({a for a, _ in closed.values() if a not in cache} | (missing - closed.keys()))
        texts = [q if q[:1] == b"\n" else b" " + q for q in order] if cache is self.spaced else order
        cache.update(zip(order, self._library(texts), strict=True))
        ends = [e for e in {b for _, b in closed.values()} if e not in self.cache]
        self.cache.update(zip(ends, self._library(ends), strict=True))
        cache.update((p, cache[a] + self.cache[b]) for p, (a, b) in closed.items())

    def encode(self, data: bytes) -> bytes:
        return self.encode_many([data])[0]

    def encode_many(self, texts: list[bytes]) -> list[bytes]:
        """The ids of several texts; parts that the cache lacks go to the library together."""
        cut = [None if odd_space(t) else self._parts(t) for t in texts]
        found: list[list[bytes | None] | None] = [c and list(map(c[1].get, c[2])) for c in cut]
        gaps = [_places(f) if f else () for f in found]
        for cache in (self.cache, self.spaced):
            missing = {c[2][i] for c, gap in zip(cut, gaps, strict=True) if gap and c[1] is cache for i in gap}
            if missing:
                if len(cache) + len(missing) > self.limit:
                    cache.clear()
                self._learn(cache, missing)
        for c, ids, gap in zip(cut, found, gaps, strict=True):
            for i in gap:
                ids[i] = c[1][c[2][i]]
        heads = list({c[0] for c in cut if c and c[0] and c[0] not in self.cache})
        self.cache.update(zip(heads, self._library(heads), strict=True))
        return [
            self._library([t])[0] if c is None else (self.cache[c[0]] if c[0] else b"") + b"".join(f)
            for t, c, f in zip(texts, cut, found, strict=True)
        ]

    def encode_documents(self, texts: list[bytes], window: int = 1 << 20) -> list[bytes]:
        """As ``encode_many``, a bounded amount of text at a time."""
        out: list[bytes] = []
        group: list[bytes] = []
        size = 0
        for t in texts:
            if len(t) > window:
                out += self.encode_many(group)
                out.append(b"".join(self.encode_many([w])[0] for w in windows(t, window)))
                group, size = [], 0
                continue
            group.append(t)
            size += len(t)
            if size > window:
                out += self.encode_many(group)
                group, size = [], 0
        return out + self.encode_many(group)


def encoder(path: str, words: bool = False, limit: int = 1_500_000) -> Encoder:
    """One encoder for each worker process, so that its cache serves all the tasks it runs. A part in the cache
    takes some 150 bytes."""
    own = kept("encoders")
    if (path, words, limit) not in own:
        release("encoders")
        own[path, words, limit] = Encoder(path, words, limit)
    return own[path, words, limit]
