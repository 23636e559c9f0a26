"""From raw documents to sampled pieces: toxicity, near-duplicates, benchmark passages, personal data, pieces.

Each stage takes (spark, docs, sf_dir) and returns what the next one reads; all but the last return the columns of documents. Rows whose
doc_id is null are judged like any other, but by near-duplicates, which keeps them as it names groups by id. Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import decontam, dedup, pieces, pii, toxicity
from feedloom.llm.common import fresh, table


#: Documents are near-duplicates from this similarity of their five-word shingles on, in hundredths.
NEAR = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; the model is fitted on the labelled documents of sf_dir."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    name = fresh("toxic", docs.columns)
    return toxicity.score(docs, model, out=name).filter(F.col(name) < toxicity.THRESHOLD).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one of the smallest id, once."""
    kept = dedup.near_duplicates(docs, threshold=NEAR).filter("kept").select("doc_id")
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.filter("doc_id IS NULL")).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def hide_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in angle brackets; n_chars follows the text."""
    return pii.hide(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document, seeded by its id."""
    return pieces.encode_sampled(docs)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_copies), ("decontamination", drop_leaks), ("personal_data", hide_pii), ("pieces", to_pieces)]

#: No SQL expresses a kernel machine or seeded sampling; the stages are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
