"""Words that a line's end has broken, put together again by what the whole corpus writes elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.session import kept

HYPHENS = "-‐"
#: A word is tried from its first letter only: if its end doesn't match, no later start does.
BROKEN = rf"(?U)(?<!\w)(\w[\w{HYPHENS}]*)[{HYPHENS}]\s+(\w+)"
WORD = rf"[A-Za-z](?:[A-Za-z{HYPHENS}]*[A-Za-z])"
#: After these a hyphen belongs to a compound that goes on later (``low- and high-cycle``).
SUSPENDED = ("and", "or", "to", "nor", "but", "through")


def vocabulary_of(texts: DataFrame, text: str) -> DataFrame:
    """word (small letters, one kind of hyphen) and ``compound``, whether it has a hyphen, of all words of a corpus."""
    words = texts.select(F.explode(F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)))).alias("word"))
    return words.select(F.lower(F.translate("word", HYPHENS, "--")).alias("word")).distinct().withColumn("compound", F.contains("word", F.lit("-")))


def _written(a: Column, b: Column, joined: Column, compound: Column) -> Column:
    """How a broken pair is written. ``joined`` and ``compound``: whether the corpus has it without and with its hyphen."""
    with_hyphen = F.concat(F.translate(a, HYPHENS, "--"), F.lit("-"), b)
    goes_on = a.rlike(f"[{HYPHENS}]") & ~joined  # a compound that broke at its next hyphen
    return F.when(F.lower(b).isin(*SUSPENDED), F.lit(None)).when(goes_on | compound, with_hyphen).otherwise(F.concat(a, b))


def rejoined(texts: DataFrame, key: str, text: str, vocabulary: DataFrame | None = None) -> DataFrame:
    """``texts`` with the words of ``text`` that hyphens break at white space put together.

    A pair that the corpus has as a compound gets its hyphen, all others are joined, as a line's end is the common
    reason for a break; a pair that no one has written is joined too. Suspended compounds stay. Pairs are decided
    once for each different pair, by joins with the ``vocabulary`` (by default that of ``texts`` itself), and rounds go on
    over the texts that still change, so the result is a fixpoint. ``key`` is unique; null texts stay null.
    """
    texts = kept(texts, "texts")  # read three times
    words = vocabulary if vocabulary is not None else vocabulary_of(texts, text)
    words = kept(words, "words")
    plain, compounds = words.where("NOT compound").select(F.col("word").alias("_joined")), words.where("compound").select(F.col("word").alias("_compound"))

    def once(rows: DataFrame) -> DataFrame:
        found = rows.select(key, F.posexplode(F.regexp_extract_all("_text", F.lit(BROKEN), F.lit(0))).alias("n", "whole"))
        pairs = found.select(key, "n", "whole", *[F.regexp_extract("whole", BROKEN, k).alias(c) for k, c in ((1, "a"), (2, "b"))])
        known = pairs.select("a", "b").distinct().withColumns({"_joined": F.lower(F.concat("a", "b")), "_compound": F.lower(F.concat(F.translate("a", HYPHENS, "--"), F.lit("-"), "b"))})
        known = known.join(plain.withColumn("_j", F.lit(True)), "_joined", "left").join(compounds.withColumn("_c", F.lit(True)), "_compound", "left")
        decided = known.select("a", "b", _written(F.col("a"), F.col("b"), F.col("_j").isNotNull(), F.col("_c").isNotNull()).alias("written"))
        fixed = pairs.join(decided, ["a", "b"]).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("n", F.coalesce("written", "whole").alias("t")))).alias("_fixed"))
        between = F.split("_text", BROKEN)
        text_ = F.array_join(F.zip_with(between, F.col("_fixed"), lambda x, y: F.concat(x, F.coalesce(y["t"], F.lit("")))), "")
        return rows.join(fixed, key).select(key, text_.alias("_new"), "_text").where("_new <> _text").select(key, F.col("_new").alias("_text"))

    done, open_ = None, texts.select(key, F.col(text).alias("_text")).where(F.col(text).rlike(BROKEN))
    while True:
        changed = kept(once(open_), "rejoined")
        if changed.isEmpty():
            break
        done = changed if done is None else done.join(changed.select(key), key, "left_anti").unionByName(changed)
        open_ = changed.where(F.col("_text").rlike(BROKEN))
    if done is None:
        return texts
    return texts.join(done, key, "left").withColumn(text, F.coalesce("_text", text)).drop("_text")
