"""Sessions with the settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def session(master: str = "local[*]", partitions: int = 8) -> SparkSession:
    """ANSI SQL, UTC, adaptive plans. On a cluster, size ``partitions`` to some 128 MB of shuffle each."""
    return (
        SparkSession.builder.master(master)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder name in the folder that driver and executors share, ``spark.checkpoint.dir``. On a single
    machine a local folder stands in where that is unset."""
    import tempfile
    import uuid

    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or getattr(context, "_lamina_scratch", None)
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = context._lamina_scratch = "file://" + tempfile.mkdtemp(prefix="lamina-")
    return f"{base.rstrip('/')}/lamina/{tag}-{uuid.uuid4().hex}"


def kept(df: DataFrame, tag: str) -> DataFrame:
    """The rows of ``df``, written to the shared folder once for all steps that read them."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Let the Python workers import this package wherever they run: send it as a zip, once a session, unless
    the environment already has it on their path."""
    import os
    import shutil
    import tempfile
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    context = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_lamina_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="lamina-code-")
    context.addPyFile(shutil.make_archive(f"{folder}/lamina", "zip", root, "lamina"))
    context._lamina_shipped = True
