"""What the operators of this subpackage share: tables, scratch space, document batches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.session import scratch  # noqa: F401  (operators take it from here)

#: Bytes that separate words: space and 0x09-0x0D. ``bytes.split()`` cuts at exactly these.
BLANKS = b" \t\n\x0b\x0c\r"
#: UTF-8 forms of the white space beyond space and 0x09-0x0D, and the separators 0x1C-0x1F.
ODD_SPACE = re.compile(
    rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps restart from the files, not from
    the lineage, when executors are lost. ``discard`` deletes the files."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._lamina_path = path
    return back


def discard(*tables: DataFrame | None) -> None:
    """Delete the files of materialized tables that no later plan reads."""
    for t in tables:
        if path := getattr(t, "_lamina_path", None):
            remove(t.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that no later plan reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Rows and bytes of an Arrow batch, where the session doesn't say otherwise.
BATCH_ROWS, BATCH_BYTES = "1024", str(8 << 20)


def lean(df: DataFrame) -> DataFrame:
    """``df``, in a session with small Arrow batches: texts may be long, and a batch exists in the JVM, in its
    off-heap memory and in the worker at once. Plans run after the operator has returned, so this stays an option
    of the session; one that the caller has set is left alone."""
    spark = df.sparkSession
    for name, own in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        if not spark._jsparkSession.sessionState().conf().settings().containsKey(name):
            spark.conf.set(name, own)
    return df


def sweep(spark: SparkSession) -> None:
    """Let the driver notice which shuffles no plan needs any more, so that executors delete their files now and
    not when the driver happens to collect its garbage. For operators of many rounds."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the column as text, modulo ``modulus``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


_KEPT: dict[str, dict] = {}


def kept(name: str) -> dict:
    """What a worker process keeps between the tasks of one operator; ``release`` of another one clears it."""
    return _KEPT.setdefault(name, {})


def release(keep: str = "") -> None:
    """Give memory that earlier tasks of this worker process used back to the machine: executors share theirs
    between the JVM and workers that live long."""
    import ctypes
    import gc

    for name, own in _KEPT.items():
        if name != keep:
            own.clear()
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        return


def binary_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _cut(data: bytes, at: int) -> bool:
    """Whether white space begins at a place, after something that isn't white space of any kind."""
    return data[at] in BLANKS and data[at - 1] not in BLANKS and not any(m.end() == 3 for m in ODD_SPACE.finditer(data[max(0, at - 3) : at].rjust(3, b"x")))


def windows(data: bytes, size: int) -> Iterator[bytes]:
    """Cut a text before white space that follows something else, at about ``size`` bytes, so that no word is
    divided, no run of white space either (that of Unicode included), and very long texts never need memory in
    proportion."""
    n, at = len(data), 0
    while n - at > size:
        cut = at + size
        while cut < n and not _cut(data, cut):
            cut += 1
        yield data[at:cut]
        at = cut
    if at < n or not n:
        yield data[at:]
