"""Preference formatting: the longest common turn prefix once as prompt, then two masked completions.

DataFrame functions only. Turns are put in order of (turn, role, text), so that repeated turn numbers have one order;
a turn with no number comes first. Null roles and texts are rendered as empty strings. A turn counts as shared when role and
text are equal. A missing side has no turns: the prompt is then empty and its completion an empty string. A row without a
pair key is a pair of its own, so that they never meet in one group. Very long texts are kept whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import table


def render(turns: Column) -> Column:
    """Turns as text: <|role|>, newline, text, newline each."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("<|"), t.role, F.lit("|>\n"), t.text, F.lit("\n"))), "")


def segments(turns: Column) -> Column:
    """Each completion turn as (text, learn): only the assistant's turns are learnt."""
    return F.transform(turns, lambda t: F.struct(F.concat(F.lit("<|"), t.role, F.lit("|>\n"), t.text, F.lit("\n")).alias("text"), (t.role == "assistant").alias("learn")))


def prefix_length(a: Column, b: Column) -> Column:
    """How many leading turns two turn arrays share."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce((x.role == y.role) & (x.text == y.text), F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first == 0, F.size(same)).otherwise(first.cast("int") - 1)


def preference_format(turns: DataFrame) -> DataFrame:
    """turns: pair_id, side ('chosen' or 'rejected'), turn, role, text. One row per pair.

    A pair's turns meet by one shuffle on pair_id; a conversation's length bounds a group, however many pairs start alike.
    """
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    alone = F.when(F.col("pair_id").isNull(), F.monotonically_increasing_id())
    sides = turns.groupBy("pair_id", alone.alias("_alone")).agg(
        F.sort_array(F.collect_list(F.when(F.col("side") == "chosen", turn))).alias("a"),
        F.sort_array(F.collect_list(F.when(F.col("side") == "rejected", turn))).alias("b"),
    )
    cutoff = sides.withColumn("n", prefix_length(F.col("a"), F.col("b")))
    rest = lambda c: F.slice(F.col(c), F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0)))
    parts = cutoff.select("pair_id", F.col("n").cast("long").alias("prompt_turns"), F.slice("a", F.lit(1), F.col("n")).alias("p"), rest("a").alias("a"), rest("b").alias("b"))
    return parts.select(
        "pair_id", "prompt_turns", render(F.col("p")).alias("prompt"),
        F.size("a").cast("long").alias("chosen_turns"), render(F.col("a")).alias("chosen"),
        F.size("b").cast("long").alias("rejected_turns"), render(F.col("b")).alias("rejected"),
        segments(F.col("a")).alias("chosen_segments"), segments(F.col("b")).alias("rejected_segments"),
    )


def mask_text(segs: str) -> Column:
    """A completion's mask as text: 1 for a turn that is learnt, else 0."""
    return F.array_join(F.transform(F.col(segs), lambda s: F.when(s.learn, "1").otherwise("0")), "")


def paired(conversations: DataFrame) -> DataFrame:
    """The turns of conversations 2k and 2k + 1 as the sides of pair k; shifts of bits, as a quotient of doubles would mix up large ids."""
    side = F.when(F.col("conv_id").bitwiseAND(1) == 0, "chosen").otherwise("rejected")
    return conversations.select(F.shiftright("conv_id", 1).alias("pair_id"), side.alias("side"), "turn", "role", "text")


def op10_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table names no preferences: conversation 2k is taken as chosen, 2k + 1 as rejected, of pair k (for any long k)."""
    c = table(spark, sf_dir, "conversations")
    return preference_format(paired(c)).withColumns({"chosen_mask": mask_text("chosen_segments"), "rejected_mask": mask_text("rejected_segments")}).drop("chosen_segments", "rejected_segments")


OP10_SQL = """
WITH t AS (
  SELECT conv_id // 2 AS pair_id, conv_id % 2 AS side, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k
  FROM conversations),
j AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.k, b.k) AS k, a.role AS role_a, a.text AS text_a, b.role AS role_b, b.text AS text_b,
         coalesce(a.role = b.role AND a.text = b.text, false) AS same
  FROM (SELECT * FROM t WHERE side = 0) a FULL JOIN (SELECT * FROM t WHERE side = 1) b ON a.pair_id = b.pair_id AND a.k = b.k),
n AS (SELECT *, coalesce(min(CASE WHEN NOT same THEN k END) OVER (PARTITION BY pair_id), 1000000000) AS stop FROM j)
SELECT pair_id,
  count(*) FILTER (WHERE k < stop) AS prompt_turns,
  coalesce(string_agg('<|' || role_a || '|>' || chr(10) || text_a || chr(10), '' ORDER BY k) FILTER (WHERE k < stop), '') AS prompt,
  count(role_a) FILTER (WHERE k >= stop) AS chosen_turns,
  coalesce(string_agg('<|' || role_a || '|>' || chr(10) || text_a || chr(10), '' ORDER BY k) FILTER (WHERE k >= stop AND role_a IS NOT NULL), '') AS chosen,
  count(role_b) FILTER (WHERE k >= stop) AS rejected_turns,
  coalesce(string_agg('<|' || role_b || '|>' || chr(10) || text_b || chr(10), '' ORDER BY k) FILTER (WHERE k >= stop AND role_b IS NOT NULL), '') AS rejected,
  coalesce(string_agg(CASE WHEN role_a = 'assistant' THEN '1' ELSE '0' END, '' ORDER BY k) FILTER (WHERE k >= stop AND role_a IS NOT NULL), '') AS chosen_mask,
  coalesce(string_agg(CASE WHEN role_b = 'assistant' THEN '1' ELSE '0' END, '' ORDER BY k) FILTER (WHERE k >= stop AND role_b IS NOT NULL), '') AS rejected_mask
FROM n GROUP BY pair_id
"""
