"""One row per page, near-duplicate headlines, and the order of feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.text import title_key

_HAS = lambda c: F.coalesce(F.col(c) != "", F.lit(False))


def quality():
    """Verified dates before estimated ones, fresh rows before stale ones, then image and excerpt (the category never decides)."""
    num = lambda c: c.cast("int")
    return num(~F.col("date_estimated")) * 8 + num(~F.col("stale")) * 4 + num(_HAS("image")) + num(_HAS("excerpt"))


def merge_by_id(articles: DataFrame) -> DataFrame:
    """One row per id: the best, the first of equals by seq; collected_iso, category and first_seq are carried over from its group.

    collected is the least first sight (collected_iso, else published_iso) of a group of several rows; an estimated winner of several rows has
    the least published_iso; the category is that of the last row that was best so far and had one, else the first one seen.
    One shuffle on id: the two windows share partitioning and order.
    """
    by_seq = Window.partitionBy("id").orderBy("seq")
    before = by_seq.rowsBetween(Window.unboundedPreceding, -1)
    seen = articles.withColumn("q", quality())
    seen = seen.withColumn("_chain", F.coalesce(F.col("q") > F.max("q").over(before), F.lit(True)))
    first_sight = F.coalesce(F.nullif("collected_iso", F.lit("")), F.col("published_iso"))
    own = F.when(_HAS("category"), F.col("category"))
    rest = [c for c in articles.columns if c not in ("id", "category", "collected_iso", "published_iso")]
    best = F.max_by(F.struct(*rest, "published_iso", "collected_iso", "q"), F.struct("q", -F.col("seq"))).alias("w")
    grouped = seen.groupBy("id").agg(
        best, F.count("*").alias("n"), F.min(first_sight).alias("sight"), F.min("published_iso").alias("least_published"), F.min("seq").alias("first_seq"),
        F.max_by(own, F.when(F.col("_chain") & own.isNotNull(), F.col("seq"))).alias("chained"), F.min_by(own, F.when(own.isNotNull(), F.col("seq"))).alias("first_own"),
    )
    many = F.col("n") > 1
    return grouped.select(
        "id", *(F.col(f"w.{c}").alias(c) for c in rest),
        F.when(many & F.col("w.date_estimated"), F.col("least_published")).otherwise(F.col("w.published_iso")).alias("published_iso"),
        F.when(many, F.col("sight")).otherwise(F.col("w.collected_iso")).alias("collected_iso"),
        F.coalesce("chained", "first_own").alias("category"), "first_seq",
    )


def drop_near(rows: DataFrame, keys: list[str], at_micros: str, order: list, seconds: int) -> DataFrame:
    """Walks each key's rows in order and drops those within seconds of the last row kept (an exact distance is kept).

    A row at a gap of at least that much from the row before it is always kept, so the walk begins anew there: each stretch between such gaps
    is folded on its own, which keeps the arrays short even for a key that very many rows share.
    """
    walk = Window.partitionBy(*keys).orderBy(*order)
    width = seconds * 1_000_000
    gap = F.abs(F.col(at_micros) - F.lag(at_micros).over(walk))
    cut = rows.withColumn("_rank", F.row_number().over(walk)).withColumn("_new", F.coalesce(gap >= width, F.lit(True)).cast("int"))
    cut = cut.withColumn("_part", F.sum("_new").over(walk.rowsBetween(Window.unboundedPreceding, 0)))
    packed = F.sort_array(F.collect_list(F.struct("_rank", F.struct(*rows.columns).alias("row"))))
    grouped = cut.groupBy(*keys, "_part").agg(packed.alias("xs"))
    kept = F.aggregate(
        F.slice("xs", 2, 1 << 30), F.slice("xs", 1, 1),
        lambda acc, x: F.when(F.abs(F.element_at(acc, -1)["row"][at_micros] - x["row"][at_micros]) >= width, F.array_append(acc, x)).otherwise(acc),
    )
    return grouped.select(F.explode(kept).alias("k")).select("k.row.*")


def drop_near_titles(merged: DataFrame, seconds: int = 3600) -> DataFrame:
    """Near-duplicate headlines of one source: newest first by ISO text, then by arrival."""
    keyed = merged.withColumn("_title", title_key(F.col("title"))).withColumn("_at", F.unix_micros("published"))
    kept = drop_near(keyed, ["source_id", "_title"], "_at", [F.desc("published_iso"), F.asc("first_seq")], seconds)
    return kept.drop("_title", "_at")


def top(rows: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first n rows per key, numbered from 1 in column rank; Spark prunes each task's rows to n per key before the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= n)


def first_wins(rows: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """The first row of each key by seq."""
    return rows.groupBy(key).agg(F.min_by(F.struct(*[c for c in rows.columns if c != key]), seq).alias("w")).select(key, "w.*")
