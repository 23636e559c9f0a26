"""The article view over the test tables, and what the queries take as the clock."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import dates

CATEGORY_OF_EVENT = {"click": "sports", "view": "business", "purchase": "politics"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_ts(spark: SparkSession, sf_dir: str):
    """The newest event as a literal: one row comes to the driver."""
    return F.lit(read(spark, sf_dir, "events").agg(F.max("ts").cast("timestamp")).first()[0])


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with the event of the same number as publication, labels as staleness."""
    d, e = read(spark, sf_dir, "documents"), read(spark, sf_dir, "events").withColumnRenamed("event_id", "doc_id").select("doc_id", "ts", "event_type", "value")
    stale = read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    category = F.when(F.lit(False), F.lit(None).cast("string"))
    for kind, name in CATEGORY_OF_EVENT.items():
        category = category.when(F.col("event_type") == kind, F.lit(name))
    rows = d.join(e, "doc_id").join(stale, "doc_id", "left")
    at = F.col("ts").cast("timestamp")
    return rows.select(
        F.col("doc_id").alias("seq"), F.substring(F.sha1(F.col("text").cast("binary")), 1, 16).alias("id"), F.col("source").alias("source_id"), "lang",
        F.substring("text", 1, 80).alias("title"), at.alias("published"), dates.iso(at).alias("published_iso"), F.lit(None).cast("string").alias("collected_iso"),
        F.when(F.col("doc_id") % 3 == 0, "img").alias("image"), F.when(F.col("n_chars") > 400, "exc").alias("excerpt"), category.otherwise(None).alias("category"),
        (F.col("value") < 20).alias("date_estimated"), (F.coalesce("toxic", F.lit(0)) == 1).alias("stale"),
    )


#: The same view for DuckDB, and the ISO text of a timestamp.
def iso_sql(ts: str) -> str:
    return f"CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%SZ') ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%fZ') END"


ARTICLES_SQL = f"""a AS (
  SELECT d.doc_id AS seq, substr(sha1(d.text), 1, 16) AS id, d.source AS source_id, d.lang, substr(d.text, 1, 80) AS title, e.ts AS published,
    {iso_sql("e.ts")} AS published_iso, CASE WHEN d.doc_id % 3 = 0 THEN 'img' END AS image, CASE WHEN d.n_chars > 400 THEN 'exc' END AS excerpt,
    CASE e.event_type WHEN 'click' THEN 'sports' WHEN 'view' THEN 'business' WHEN 'purchase' THEN 'politics' END AS category,
    e.value < 20 AS date_estimated, coalesce(l.toxic, 0) = 1 AS stale
  FROM documents d JOIN events e ON d.doc_id = e.event_id LEFT JOIN (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY doc_id) l ON l.doc_id = d.doc_id),
clock AS (SELECT max(ts) AS now FROM events)"""

#: Id-dedupe in SQL over a relation x with the article columns.
MERGE_SQL = """q AS (SELECT *, (NOT date_estimated)::INT * 8 + (NOT stale)::INT * 4 + (coalesce(image, '') <> '')::INT + (coalesce(excerpt, '') <> '')::INT AS q FROM x),
c AS (SELECT *, coalesce(q > max(q) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS chain,
  row_number() OVER (PARTITION BY id ORDER BY q DESC, seq) AS rk FROM q),
g AS (SELECT id, count(*) AS n, min(published_iso) AS least, min(seq) AS first_seq, max_by(category, seq) FILTER (chain AND category IS NOT NULL) AS chained,
  min_by(category, seq) FILTER (category IS NOT NULL) AS first_own FROM c GROUP BY id),
m AS (SELECT c.seq, c.id, c.source_id, c.lang, c.title, c.published, CASE WHEN c.date_estimated AND n > 1 THEN least ELSE published_iso END AS published_iso,
  CASE WHEN n > 1 THEN least END AS collected_iso, c.image, c.excerpt, coalesce(chained, first_own) AS category, c.date_estimated, c.stale, first_seq
  FROM c JOIN g USING (id) WHERE rk = 1)"""
