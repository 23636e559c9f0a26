"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import train_split


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, per_class: int) -> DataFrame:
    """doc_id, text and label of at most per_class labelled documents of each class.

    Only rows that may be learnt from are taken, in the order of a hash of their id; an id labelled twice counts with its larger label.
    At most 2 * per_class ids reach the broadcast, whatever the size of the tables.
    """
    known = labels.filter(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & train_split(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(F.col(target).cast("int")).alias("label"))
    order = F.xxhash64("doc_id")
    parts = [known.filter(F.col("label") == c).orderBy(order, "doc_id").limit(per_class) for c in (0, 1)]
    ids = parts[0].union(parts[1])
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "text", "label")
