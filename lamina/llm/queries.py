"""The queries of this subpackage and, where SQL can express them, the same in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lamina.llm import chat, decontaminate, mtree, vector_codes
from lamina.llm.common import table

#: Where the public tokenizers' files are; a parameter, as they are never part of the repository.
WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lamina.llm.dac import token_digest

    return token_digest(table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE), end_id=2)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lamina.llm.decontaminate import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lamina.llm.mtree import top_products

    return top_products(table(spark, sf_dir, "embeddings"))


def op5_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lamina.llm.chat import format_preferences, pairs_by_last_answer

    return format_preferences(pairs_by_last_answer(table(spark, sf_dir, "conversations")))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lamina.llm.token_count import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lamina.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lamina.llm.toxicity import fit_toxicity, score_toxicity

    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lamina.llm.quality import fit_quality, score_quality

    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def op9_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lamina.llm.gru_lm import score_documents

    return score_documents(table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lamina.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lamina.llm.runs import find_runs, planted, run_digests

    return run_digests(find_runs(table(spark, sf_dir, "documents"), times=4, shortest=6, change=planted))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_digests(table(spark, sf_dir, "embeddings"))


def op13_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lamina.llm.prefix_bpe import coding_digests, encode_and_decode

    return coding_digests(encode_and_decode(table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE)))


QUERIES = {
    "op1_token_output": op1_token_output,
    "op2_decontamination": op2_decontamination,
    "op3_exact_topk": op3_exact_topk,
    "op5_preference_formatting": op5_preference_formatting,
    "op4_token_counts": op4_token_counts,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_quality": op8_quality,
    "op9_recurrent_lm": op9_recurrent_lm,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_vector_codes": op12_vector_codes,
    "op13_prefix_bpe": op13_prefix_bpe,
}

NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc_words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
), links AS (
    SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
), smallest AS (
    SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM smallest LEFT JOIN sizes USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {
    "op10_near_duplicates": NEAR_DUPLICATES_SQL,
    "op2_decontamination": decontaminate.ORACLE_SQL,
    "op3_exact_topk": mtree.ORACLE_SQL,
    "op5_preference_formatting": chat.ORACLE_SQL,
    "op12_vector_codes": vector_codes.ORACLE_SQL,
}
