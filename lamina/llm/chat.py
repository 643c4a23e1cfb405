"""Preference formatting of conversations, with DataFrame functions alone.

For each pair of a chosen and a rejected conversation the longest common prefix of turns is found and
rendered once, as the prompt; what follows in each becomes a completion with a mask: the spans of characters
in which an assistant's words stand, on which a model is to be trained.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPENING, CLOSING = "<|im_start|>", "<|im_end|>\n"


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and turns (role and text, in order) of every conversation of ``turns`` (conv_id, turn, role, text).

    Turns stand in the order of turn, role and text, so repeated turns and turns with one number have a fixed
    place; a null turn stands first, null role or text counts as empty. Null conv_ids take no part. One exchange
    by conv_id: a conversation becomes one record.
    """
    rows = turns.where("conv_id is not null").select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    placed = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return rows.groupBy("conv_id").agg(placed.alias("turns"))


def pairs_of(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """pair_id and the turns of both sides of ``pairs`` (pair_id, chosen, rejected: conv_ids); a side that is null
    or unknown is null."""
    convs = conversations(turns)
    sides = [convs.select(F.col("conv_id").alias(f"_{s}"), F.col("turns").alias(f"{s}_turns")) for s in ("chosen", "rejected")]
    both = pairs.join(sides[0], F.col("chosen") == F.col("_chosen"), "left").join(sides[1], F.col("rejected") == F.col("_rejected"), "left")
    return both.select("pair_id", F.col("chosen_turns").alias("chosen"), F.col("rejected_turns").alias("rejected"))


def pairs_by_last_answer(turns: DataFrame) -> DataFrame:
    """Every conversation as the chosen side of a pair that has its conv_id. The rejected side is the same up to
    the last turn of an assistant, which gives the first answer of the conversation once more instead; it ends
    before that turn if there is no other answer. Without an assistant there is no rejected side."""
    answers = F.transform(F.col("turns"), lambda t: t["role"] == "assistant")
    rows = conversations(turns).select(F.col("conv_id").alias("pair_id"), "turns", F.array_position(answers, True).alias("first"), F.array_position(F.reverse(answers), True).alias("back"))
    last = F.when(F.col("back") > 0, F.size("turns") + 1 - F.col("back"))
    before = F.slice("turns", F.lit(1), (last - 1).cast("int"))
    again = F.slice("turns", F.col("first").cast("int"), F.when(F.col("first") < last, 1).otherwise(0))
    return rows.select("pair_id", F.col("turns").alias("chosen"), F.when(last > 1, F.concat(before, F.when(F.col("first") > 0, again))).alias("rejected"))


def _head(t: Column) -> Column:
    return F.concat(F.lit(OPENING), t["role"], F.lit("\n"))


def _shown(t: Column) -> Column:
    return F.concat(_head(t), t["text"], F.lit(CLOSING))


def _mask(turns: Column) -> Column:
    """Spans of an assistant's turns: each with its closing mark, without the line end after it."""

    def step(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(_head(t))
        span = F.concat_ws(":", start.cast("string"), (start + F.length(t["text"]) + len(CLOSING) - 1).cast("string"))
        return F.struct(
            (state["at"] + F.length(_shown(t))).alias("at"),
            F.when(t["role"] == "assistant", F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.aggregate(turns, start, step, lambda s: F.array_join(s["spans"], ","))


def format_preferences(pairs: DataFrame) -> DataFrame:
    """A row for each row of ``pairs`` (pair_id, chosen, rejected: arrays of turns with role and text).

    prompt: the common prefix; chosen and rejected: the rest of each (null where the pair lacks the side);
    chosen_mask and rejected_mask: spans ``start:end`` of the completion to train on, joined by commas;
    prompt_turns, chosen_turns and rejected_turns: turns in each. A pair with a single side, or none, has no prompt; one
    whose sides are equal has empty completions. Roles and texts that are null count as empty. Rows with a null
    pair_id take no part; other columns are ignored; an empty table gives no rows.

    No exchange: all work is on the record of a pair, linear in its turns.
    """
    whole = lambda c: F.transform(c, lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
    rows = pairs.where("pair_id is not null").select("pair_id", whole(F.col("chosen")).alias("c"), whole(F.col("rejected")).alias("r"))
    # a turn that only one side has differs, as null never equals anything
    alike = F.zip_with("c", "r", lambda a, b: F.coalesce(a == b, F.lit(False)))
    differs = F.array_position(alike, False)
    common = F.when(F.col("c").isNull() | F.col("r").isNull(), 0).when(differs > 0, differs - 1).otherwise(F.size(alike)).cast("int")
    rows = rows.withColumn("n", common)
    rest = lambda side: F.slice(F.col(side), F.col("n") + 1, F.size(side))
    out = [F.coalesce(F.array_join(F.transform(F.slice(F.coalesce("c", "r"), F.lit(1), F.col("n")), _shown), ""), F.lit("")).alias("prompt"), F.coalesce("n", F.lit(0)).cast("long").alias("prompt_turns")]
    for side, name in (("c", "chosen"), ("r", "rejected")):
        own = F.when(F.col(side).isNotNull(), rest(side))
        turns = F.coalesce(F.size(own), F.lit(0))
        out += [F.array_join(F.transform(own, _shown), "").alias(name), _mask(own).alias(f"{name}_mask"), F.greatest(turns, F.lit(0)).cast("long").alias(f"{name}_turns")]
    return rows.select("pair_id", *out)


def _side_sql(side: str, name: str) -> str:
    return f"""
    CASE WHEN count(*) FILTER (WHERE {side}) > 0 THEN coalesce(string_agg(shown, '' ORDER BY pos) FILTER (WHERE {side} AND NOT common), '') END AS {name},
    CASE WHEN count(*) FILTER (WHERE {side}) > 0 THEN coalesce(string_agg(CAST(start AS VARCHAR) || ':' || CAST(start + length(text) + {len(CLOSING) - 1} AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE {side} AND NOT common AND role = 'assistant'), '') END AS {name}_mask,
    count(*) FILTER (WHERE {side} AND NOT common) AS {name}_turns"""


ORACLE_SQL = f"""
WITH placed AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), ends AS (
    SELECT conv_id, min(pos) AS first, max(pos) AS last FROM placed WHERE role = 'assistant' GROUP BY conv_id
), sides AS (
    SELECT conv_id, 0 AS side, pos, role, text FROM placed
    UNION ALL SELECT conv_id, 1, pos, role, text FROM placed JOIN ends USING (conv_id) WHERE pos < last
    UNION ALL SELECT conv_id, 1, last, role, text FROM placed JOIN ends USING (conv_id) WHERE pos = first AND first < last
), matched AS (
    SELECT *, count(*) OVER w = 2 AND min(role) OVER w = max(role) OVER w AND min(text) OVER w = max(text) OVER w AS alike
    FROM sides WINDOW w AS (PARTITION BY conv_id, pos)
), split AS (
    SELECT *, max(side) OVER c = 1 AND coalesce(pos < min(CASE WHEN NOT alike THEN pos END) OVER c, true) AS common,
           '{OPENING}' || role || chr(10) || text || '{CLOSING[:-1]}' || chr(10) AS shown
    FROM matched WINDOW c AS (PARTITION BY conv_id)
), measured AS (
    SELECT *, CAST(coalesce(sum(length(shown)) OVER (PARTITION BY conv_id, side, common ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
              + {len(OPENING)} + length(role) + 1 AS start
    FROM split
)
SELECT conv_id AS pair_id, coalesce(string_agg(shown, '' ORDER BY pos) FILTER (WHERE common AND side = 0), '') AS prompt,
    count(*) FILTER (WHERE common AND side = 0) AS prompt_turns,{_side_sql("side = 0", "chosen")},{_side_sql("side = 1", "rejected")}
FROM measured GROUP BY conv_id
"""
