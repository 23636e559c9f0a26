"""The incremental form: micro-batches of articles merged into a snapshot table."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.dedupe import merge_by_id
from feedloom.operators.select import retained

#: The columns of the merged state; history is what id-dedupe folds, so that a batch merge equals the merge of all rows.
STATE = ["seq", "id", "source_id", "lang", "title", "published", "published_iso", "collected_iso", "image", "excerpt", "category", "date_estimated", "stale"]


#: Parts of the state, by a hash of the id; a micro-batch rewrites only those that it touches.
BUCKETS = 64


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _current(spark: SparkSession, root: str) -> dict[int, str]:
    """The folder of each bucket, from the last pointer written; one row per bucket."""
    fs, path = _fs(spark, f"{root}/current")
    if not fs.exists(path):
        return {}
    names = sorted(s.getPath().getName() for s in fs.listStatus(path))
    return {r.bucket: r.folder for r in spark.read.schema("bucket int, folder string").json(f"{root}/current/{names[-1]}").collect()} if names else {}


def _read(spark: SparkSession, root: str, folders) -> DataFrame | None:
    paths = sorted(set(folders))
    return spark.read.parquet(*(f"{root}/{p}" for p in paths)) if paths else None


def upsert(batch: DataFrame, epoch: int, root: str, run_ts=None, days: int | None = None) -> None:
    """Fold a micro-batch into the state under root. An epoch that is written twice gives the same state (rows are keyed by seq).

    The state keeps every row that may still decide a merge, in BUCKETS parts by id; only the parts that the batch touches are read and written, and
    folders that the pointer no longer names go with the epoch after. With run_ts and days, rows beyond retention go when their part is written
    (a cutoff by processing time on event time, as late rows may still correct older ones).
    """
    spark = batch.sparkSession
    rows = batch.select(*STATE).withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).cast("int"))
    touched = sorted(r[0] for r in rows.select("bucket").distinct().collect())
    if not touched:
        return
    folders = _current(spark, root)
    old = _read(spark, root, [folders[k] for k in touched if k in folders])
    if old is not None:
        rows = old.select(*STATE, "bucket").unionByName(rows)
    # A seq has one id, so that its rows meet in one part.
    rows = rows.repartition(len(touched), "bucket").dropDuplicates(["bucket", "seq"])
    if run_ts is not None and days is not None:
        rows = retained(rows, run_ts, days)
    name = f"state-{epoch:010d}-{uuid.uuid4().hex[:8]}"
    # A part's rows stand in a folder of its own; the column is kept in the files.
    rows.withColumn("part", F.col("bucket")).write.partitionBy("part").parquet(f"{root}/{name}")
    fs, _ = _fs(spark, root)
    there = {k for k in touched if fs.exists(_fs(spark, f"{root}/{name}/part={k}")[1])}
    now = {k: p for k, p in folders.items() if k not in touched} | {k: f"{name}/part={k}" for k in there}
    pointer = f"{root}/current/{epoch:010d}-{uuid.uuid4().hex[:8]}"
    spark.createDataFrame(sorted(now.items()), "bucket int, folder string").coalesce(1).write.json(pointer)
    # What the pointer before this one named may still be read; older folders go.
    kept = {p.split("/")[0] for p in [*now.values(), *folders.values()]}
    for status in fs.listStatus(_fs(spark, root)[1]):
        if status.getPath().getName().startswith("state-") and status.getPath().getName() not in kept:
            fs.delete(status.getPath(), True)


def snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The merged rows of the state; the state must not be empty."""
    return merge_by_id(_read(spark, root, _current(spark, root).values()).select(*STATE))


def run(stream: DataFrame, root: str, checkpoint: str, run_ts=None, days: int | None = None):
    """Start the merge of a stream of articles; stop by the returned query."""
    return stream.writeStream.foreachBatch(lambda b, e: upsert(b, e, root, run_ts, days)).option("checkpointLocation", checkpoint).start()


def publish(documents: dict[str, str], target: str) -> None:
    """Stage all documents (name to text) beside target, then swap the folders; the old one comes back if the swap fails. One writer at a time."""
    staging, backup = f"{target}.staging", f"{target}.backup"
    for path in (staging, backup):
        if os.path.isdir(path):
            for name in os.listdir(path):
                os.unlink(f"{path}/{name}")
            os.rmdir(path)
    os.makedirs(staging)
    for name, text in documents.items():
        with open(f"{staging}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    if os.path.isdir(target):
        os.rename(target, backup)
    try:
        os.rename(staging, target)
    except OSError:
        if os.path.isdir(backup):
            os.rename(backup, target)
        raise
