"""Token-ID output in directly addressable codes.

A file holds the token ids of consecutive documents. Ids are cut into segments of ``SEGMENT`` ids; in a
segment each id is split into chunks, low bits first, one level for each chunk. Level k has the k-th chunks
of those ids that need them, a bitmap that says which ids continue on level k + 1, and a rank directory:
the ones before every block of ``BLOCK`` bits. So token i of a file is read from one place on each level
(``DacFile.get``), without decoding what stands before it.

File layout, little-endian: ``b"LDAC"``, segments, footer (JSON), footer length (uint32), ``b"LDAC"``. The
footer has the segments' levels as ``[offset of chunks, of bitmap, of ranks, entries, bytes of a chunk]``
and the offset of the document index: ids of documents (int64) and where each starts (uint64, one more
than documents). The last ``unnamed`` documents of a file have no id.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import binary_texts, lean, scratch
from lamina.llm.tokens import encoder

MAGIC = b"LDAC"
SEGMENT = 1 << 20
BLOCK = 512
#: Bytes of text in a file, about, unless there are fewer files then than cores.
FILE_BYTES = 128 << 20
#: Bits of the chunks, from the lowest level up; together they hold any unsigned 32-bit id.
WIDTHS = (8, 8, 16)


def encode_segment(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels of (chunks, packed continuation bitmap, rank directory)."""
    levels, rest = [], ids.astype(np.uint32)
    for width in WIDTHS:
        chunk = (rest & np.uint32((1 << width) - 1)).astype(np.uint8 if width == 8 else np.uint16)
        rest = rest >> np.uint32(width) if width < 32 else np.zeros_like(rest)
        more = rest > 0
        ones = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.uint32) if len(more) else np.zeros(0, np.uint32)
        ranks = np.concatenate(([0], np.cumsum(ones)))[:-1].astype("<u4") if len(ones) else ones.astype("<u4")
        levels.append((chunk.astype(chunk.dtype.newbyteorder("<")), np.packbits(more, bitorder="little"), ranks))
        rest = rest[more]
        if not len(rest):
            break
    return levels


class DacWriter:
    """Writes to a binary stream; memory is one segment and the document index."""

    def __init__(self, out):
        self.out, self.at, self.segments = out, 0, []
        self.pending: list[bytes] = []
        self.held = self.total = 0
        self.doc_ids, self.starts, self.unnamed = array("q"), array("Q", [0]), 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> int:
        at = self.at
        self.out.write(data)
        self.at += len(data)
        return at

    def _flush(self, least: int) -> None:
        if self.held < least or not self.held:
            return
        ids = np.frombuffer(b"".join(self.pending), dtype="<u4")
        done = 0
        while len(ids) - done >= least and done < len(ids):
            part = ids[done : done + SEGMENT]
            self.segments.append(
                [[self._put(c.tobytes()), self._put(b.tobytes()), self._put(r.tobytes()), len(c), c.itemsize] for c, b, r in encode_segment(part)]
            )
            done += len(part)
        self.pending, self.held = [ids[done:].tobytes()], len(ids) - done

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """The next document; those without an id come last."""
        self.unnamed += doc_id is None
        self.pending.append(ids)
        self.held += len(ids) // 4
        self.total += len(ids) // 4
        self.doc_ids.append(-1 if doc_id is None else doc_id)
        self.starts.append(self.total)
        self._flush(SEGMENT)

    def close(self) -> None:
        self._flush(1)
        index = self._put(np.array(self.doc_ids, dtype="<i8").tobytes() + np.array(self.starts, dtype="<u8").tobytes())
        footer = json.dumps({"segment": SEGMENT, "tokens": self.total, "documents": len(self.doc_ids), "unnamed": self.unnamed, "index": index, "levels": self.segments}).encode()
        self._put(footer + len(footer).to_bytes(4, "little") + MAGIC)


class DacFile:
    """Random access to a file; ``source`` has ``read_at(size, offset)`` and ``size()`` as pyarrow's files."""

    def __init__(self, source):
        self.source, size = source, source.size()
        tail = source.read_at(8, size - 8)
        if tail[4:] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        n = int.from_bytes(tail[:4], "little")
        self.footer = json.loads(source.read_at(n, size - 8 - n))
        self.segment, self.tokens, self.levels = (self.footer[k] for k in ("segment", "tokens", "levels"))

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        n, at = self.footer["documents"], self.footer["index"]
        ids = np.frombuffer(self.source.read_at(8 * n, at), dtype="<i8")
        return ids, np.frombuffer(self.source.read_at(8 * (n + 1), at + 8 * n), dtype="<u8")

    def get(self, i: int) -> int:
        """Token i of the file: a chunk, a bit and a rank from each level that the token needs."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        levels, at, value, shift = self.levels[i // self.segment], i % self.segment, 0, 0
        for k, (chunks, bits, ranks, _, width) in enumerate(levels):
            value |= int.from_bytes(self.source.read_at(width, chunks + at * width), "little") << shift
            shift += WIDTHS[k]
            if not self.source.read_at(1, bits + at // 8)[0] >> at % 8 & 1:
                break
            block = at // BLOCK
            first = int.from_bytes(self.source.read_at(4, ranks + 4 * block), "little")
            start = block * BLOCK // 8
            low = int.from_bytes(self.source.read_at(at // 8 - start + 1, bits + start), "little")
            at = first + (low & ((1 << at % BLOCK) - 1)).bit_count()
        return value

    def decode_segment(self, k: int) -> np.ndarray:
        """All ids of a segment, for sequential reads."""
        out, where, shift = None, None, 0
        for level, (chunks, bits, _, n, width) in enumerate(self.levels[k]):
            part = np.frombuffer(self.source.read_at(n * width, chunks), dtype=f"<u{width}").astype(np.uint32)
            if out is None:
                out, where = part, np.arange(n)
            else:
                out[where] |= part << np.uint32(shift)
            shift += WIDTHS[level]
            more = np.unpackbits(np.frombuffer(self.source.read_at(-(-n // 8), bits), dtype=np.uint8), bitorder="little", count=n)
            where = where[more.astype(bool)]
        return out

    def digests(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(document, its start in the file, its tokens, crc32 of its ids) in file order; None: without an id."""
        doc_ids, starts = self.documents()
        named = len(doc_ids) - self.footer["unnamed"]
        d, crc = 0, 0
        for k in range(max(1, len(self.levels))):
            ids = self.decode_segment(k) if self.levels else np.zeros(0, np.uint32)
            low, high = k * self.segment, k * self.segment + len(ids)
            raw = memoryview(ids.astype("<u4").tobytes())
            while d < len(doc_ids):
                a, b = int(starts[d]), int(starts[d + 1])
                crc = zlib.crc32(raw[4 * (max(a, low) - low) : 4 * (min(b, high) - low)], crc)
                if b > high:
                    break
                yield int(doc_ids[d]) if d < named else None, a, b - a, crc
                d, crc = d + 1, 0


def filesystem(uri: str):
    """pyarrow's file system and path for a Hadoop-style address."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "file://" + "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_dac(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = None, words: bool = False, files: int | None = None) -> list[dict]:
    """Encode ``docs`` (doc_id, text) and write files of directly addressable codes in ascending doc_id.

    Returns the manifest: one entry for each file, in order, with ``base``, the ids in the files before it.
    Null text counts as empty; rows with the same doc_id are separate documents in the order in which the
    table has them; rows with a null doc_id come after all others, without an id. An empty table gives no files.
    The number of files follows the bytes of text (``FILE_BYTES``). Each file is written under a name of its own
    attempt and then renamed, so lost or repeated tasks leave the same files.
    """
    spark = docs.sparkSession
    if files is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        files = max(-(-size // FILE_BYTES), spark.sparkContext.defaultParallelism)
    order = [F.col("doc_id").asc_nulls_last(), F.col("row")]
    dealt = (
        lean(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "text")
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context, coder, end = TaskContext.get(), encoder(tokenizer, words), b"" if end_id is None else end_id.to_bytes(4, "little")
        system, root = filesystem(folder)
        part = context.partitionId()
        own, name = f"{root}/_attempt-{context.taskAttemptId()}", f"{root}/part-{part:06d}.dac"
        system.create_dir(root, recursive=True)
        with system.open_output_stream(own) as out:
            writer = DacWriter(out)
            for batch in batches:
                ids = batch.column(0).to_pylist()
                for at in range(0, len(ids), 256):
                    texts = binary_texts(batch.column(1).slice(at, 256))
                    for doc_id, coded in zip(ids[at : at + 256], coder.encode_documents(texts), strict=True):
                        writer.add(doc_id, coded + end)
            writer.close()
        if not writer.doc_ids:
            system.delete_file(own)
            return
        if system.get_file_info(name).is_file:  # an earlier attempt's, with the same content
            system.delete_file(name)
        system.move(own, name)
        yield pa.RecordBatch.from_pydict({"part": [part], "path": [name], "tokens": [writer.total], "documents": [len(writer.doc_ids)]})

    rows = dealt.mapInArrow(write, "part long, path string, tokens long, documents long").collect()  # a row for each file
    manifest, base = [], 0
    for r in sorted(rows):
        manifest.append({"path": r.path, "base": base, "tokens": r.tokens, "documents": r.documents})
        base += r.tokens
    return manifest


def read_digests(spark, folder: str, manifest: list[dict]) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not manifest:
        return spark.createDataFrame([], schema)

    def read(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, _ = filesystem(folder)
        for frame in frames:
            for path, base in zip(frame["path"], frame["base"], strict=True):
                with system.open_input_file(path) as source:
                    rows = [(d, base + a, n, c) for d, a, n, c in DacFile(source).digests()]
                columns = zip(("doc_id", "start", "n_tokens", "ids_crc32"), zip(*rows, strict=True), strict=True)
                yield pd.DataFrame({name: pd.array(values, dtype="Int64") for name, values in columns})

    listed = spark.createDataFrame([(m["path"], m["base"]) for m in manifest], "path string, base long")
    return listed.repartition(min(len(manifest), 10_000)).mapInPandas(read, schema)


def token_digest(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write all documents to files and report each (doc_id, start, n_tokens, ids_crc32) from the files read back.

    Null and empty texts are the end's id alone; repeated rows and rows with one doc_id are documents of their own, in the
    table's order; those with a null doc_id come last and keep it. Texts are encoded whole, a megabyte at a time. Other
    columns are ignored, whatever their names; an empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "dac")
    return read_digests(spark, folder, write_dac(docs, folder, tokenizer, end_id, words=True))
