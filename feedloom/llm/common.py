"""What the operators of this subpackage share: table access, Arrow row loops, lineage cuts."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of text that one numpy block holds at most (a single longer text makes a block of its own).
BLOCK_ROWS = 256
BLOCK_BYTES = 1 << 20
#: The same for Arrow batches of tables between stages.
_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2048, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test layout, by Spark's reader (any store that Spark knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir. On a single machine (tests) one is made where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if not known:
        if not context.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="feedloom-"))
        known = context.getCheckpointDir()
    return known


def run_dir(spark: SparkSession) -> str:
    """This application's folder for tables between stages."""
    return f"{shared_dir(spark).rstrip('/')}/feedloom-{spark.sparkContext.applicationId}"


@contextlib.contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of bounded rows and bytes for what is run within: a worker holds a batch at a time."""
    before = {k: spark.conf.get(k, None) for k in _BATCH}
    for k, most in _BATCH.items():
        if not before[k] or not before[k].rstrip("b").isdigit() or int(before[k].rstrip("b")) > most:
            spark.conf.set(k, str(most))
    try:
        yield
    finally:
        for k, v in before.items():
            if v is not None:
                spark.conf.set(k, v)


def cut(df: DataFrame, used: list[str] | None = None) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends, lost executors cost one stage.

    used takes the path, for remove() as soon as nothing lazy reads it any more. What is left goes with clean().
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    if used is not None:
        used.append(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that cut() has written."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    paths.clear()


def clean(spark: SparkSession) -> None:
    """Delete all tables of this application; only when no DataFrame of this subpackage is read any more."""
    remove(spark, [run_dir(spark)])


def train_split(doc_id):
    """The labels that may be learnt from: crc32 of the id as text, modulo 5, is not 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def held_out(doc_id):
    """A null id has no remainder; it counts as not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def blocks(batch: pa.RecordBatch, column: str | int, rows: int = BLOCK_ROWS, size: int = BLOCK_BYTES):
    """Slices of an Arrow batch with a bounded number of rows and bytes in a text column (by name or place); never an empty slice."""
    n = batch.num_rows
    if not n:
        return
    text = batch.column(column if isinstance(column, int) else batch.schema.get_field_index(column))
    lengths = np.asarray(pc.fill_null(pc.binary_length(text), 0), dtype=np.int64)
    ends = np.cumsum(lengths)
    start = 0
    while start < n:
        before = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, before + size, side="right"))
        stop = min(max(stop, start + 1), start + rows, n)
        yield batch.slice(start, stop - start)
        start = stop


def with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with columns put in place of those of the same name, or after the others."""
    names, arrays = list(batch.schema.names), list(batch.columns)
    for name, array in columns.items():
        if name in names:
            arrays[names.index(name)] = array
        else:
            names.append(name)
            arrays.append(array)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def fresh(name: str, taken: list[str]) -> str:
    """A column name like the given one that no column has (names are compared without case)."""
    known = {c.lower() for c in taken}
    while name in known:
        name = f"_{name}"
    return name


def schema_with(df: DataFrame, columns: dict[str, str]) -> str:
    """DDL of df with columns set as with_columns() sets them."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields} | columns
    return ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a good mixing of 64 bits, the same on every machine."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _RNG.integers(1, 1 << 63, 1024, dtype=np.uint64) | np.uint64(1)
_FAR = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of some texts (bytes), and how many words each text has.

    Words are runs of bytes other than space and 9 to 13. A hash depends on the word alone.
    """
    raw = np.frombuffer(b" ".join(data) + b" ", dtype=np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    before = np.empty(len(raw), dtype=bool)
    before[0] = True
    before[1:] = space[:-1]
    starts = np.flatnonzero(before & ~space)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(data), np.int64)
    spans = np.diff(np.append(starts, len(raw)))
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, spans)
    codes = _BYTE[raw[starts[0]:]]
    codes[space[starts[0]:]] = 0
    weight = _PLACE[np.minimum(place, 1023)]
    if spans.max() > 1023:
        far = np.flatnonzero(place >= 1023)
        weight[far] = splitmix(place[far].astype(np.uint64) * _FAR) | np.uint64(1)
    codes *= weight
    hashes = splitmix(np.add.reduceat(codes, starts - starts[0]))
    ends = np.cumsum([len(x) + 1 for x in data])
    counts = np.diff(np.concatenate([[0], np.searchsorted(starts, ends, side="left")]))
    return hashes, counts
