"""Source documents as tables. Row order is kept: every reader gives each row its printed position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions.text import strip_tags
from lamina.operators.audit import content_digest


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row for each file: its path and its content as a VARIANT; files are read whole."""
    files = spark.read.text(path, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    return files.select("path", F.try_parse_json("value").alias("doc"))


def document_rows(documents: DataFrame, schema: str, field: str = "rows") -> DataFrame:
    """path, line_no (from 0) and the printed row; a document without the field gives none."""
    rows = F.coalesce(F.try_variant_get("doc", f"$.{field}", f"array<{schema}>"), F.array().cast(f"array<{schema}>"))
    return documents.select("path", F.posexplode(rows).alias("line_no", "row"))


def files_of(documents: DataFrame, prefix: str) -> DataFrame:
    """Files of one specification: the name is the prefix and an underscore or a dot, so SA-6 isn't SA-609."""
    name = F.element_at(F.split("path", "/"), -1)
    return documents.where(name.startswith(prefix + "_") | name.startswith(prefix + "."))


def html_rows(html: Column) -> Column:
    """Rows of the tables in a page as arrays of raw cells; attributes may stand on any tag."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    return F.transform(rows, lambda r: F.regexp_extract_all(r, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1)))


def html_cells(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, row_no, cell_no and text of every table cell."""
    rows = pages.select(key, F.posexplode(html_rows(F.col(html))).alias("row_no", "cells"))
    cells = rows.select(key, "row_no", F.posexplode("cells").alias("cell_no", "raw"))
    return cells.select(key, "row_no", "cell_no", strip_tags(F.col("raw")).alias("text"))


def raw_items(pages: DataFrame, key: str, html: str, tag: str) -> DataFrame:
    """key, position and raw content of every element ``tag`` that holds no element of the same tag."""
    found = F.regexp_extract_all(F.col(html), F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))
    return pages.select(key, F.posexplode(found).alias("item_no", "raw"))


def html_items(pages: DataFrame, key: str, html: str, tag: str) -> DataFrame:
    """key, position and text of every element ``tag`` that holds no element of the same tag."""
    items = raw_items(pages, key, html, tag)
    return items.select(key, "item_no", F.coalesce(strip_tags(F.col("raw")), F.lit("")).alias("text"))


def coverage(manifest: DataFrame, files: DataFrame, key: str, field: str) -> DataFrame:
    """``field`` of the file that each entry of a manifest names; ``?`` where the file doesn't say, and no row
    for a file that isn't there."""
    return manifest.join(files.select(key, F.coalesce(field, F.lit("?")).alias(field)), key)


def manifest_of(tables: DataFrame, keys: list[str]) -> DataFrame:
    """The index of a written corpus: rows of each table, and an order-free digest of their content."""
    rest = [c for c in tables.columns if c not in keys]
    return tables.groupBy(*keys).agg(F.count("*").alias("n_rows"), content_digest(rest).alias("digest"))


def without_own(rows: Column, own: list[str]) -> Column:
    """A map without the keys that a repair adds itself, so that a repaired document equals its source."""
    return F.map_filter(rows, lambda k, v: ~k.isin(*own))


def filled_cells(rows: Column) -> Column:
    """All cells of an array of rows that aren't null, row by row."""
    return F.filter(F.flatten(rows), lambda c: c.isNotNull())


def copies(files: DataFrame, name: str, content: str, mark: str = "table_") -> DataFrame:
    """Files whose name doubles its first mark, with the one it doubles, and whether both hold the same."""
    doubled = files.where(F.col(name).startswith(mark * 2)).select(F.expr(f"substring({name}, {len(mark) + 1})").alias("_n"), F.col(name).alias("twin"), F.sha2(F.col(content), 256).alias("_h"))
    pairs = files.join(doubled, F.col(name) == F.col("_n"))
    return pairs.select(name, "twin", (F.sha2(F.col(content), 256) == F.col("_h")).alias("identical"))


def citable_blocks(documents: DataFrame) -> DataFrame:
    """path, block, type and text of three shapes of documents: flat blocks, sections of paragraphs, table rows."""
    shapes = [
        ("blocks", "struct<type: string, text: string>", lambda x: F.struct(x["type"].alias("type"), x["text"].alias("text"))),
        ("paragraphs", "struct<kind: string, text: string>", lambda x: F.struct(F.coalesce(x["kind"], F.lit("paragraph")).alias("type"), x["text"].alias("text"))),
        ("rows", "map<string, string>", lambda x: F.struct(F.lit("row").alias("type"), F.to_json(x).alias("text"))),
    ]
    out = None
    for field, schema, shape in shapes:
        items = F.transform(F.try_variant_get("doc", f"$.{field}", f"array<{schema}>"), shape)
        part = documents.select("path", F.posexplode(items).alias("block", "item")).select("path", "block", "item.type", "item.text")
        out = part if out is None else out.unionByName(part)
    return out


def write_sealed(df: DataFrame, path: str, reason: str) -> DataFrame:
    """Write a table and return its seal: rows, an order-free digest of their content, and why it was written."""
    df.write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.parquet(path)
    return back.agg(F.lit(path).alias("path"), F.count("*").alias("n_rows"), content_digest(back.columns).alias("digest"), F.lit(reason).alias("reason"))
