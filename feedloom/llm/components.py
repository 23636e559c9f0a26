"""Connected components of an edge table by union-find: a forest per task, then large-star and small-star rounds."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import cut, remove


class UnionFind:
    """Sets of integers; the root of a set is its smallest member."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (up := self.parent.get(root, root)) != root:
            root = up
        while (up := self.parent.get(x, x)) != root:
            self.parent[x] = root
            x = up
        return root

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True

    def edges(self):
        """(member, root) of all members that are not roots."""
        return [(x, self.find(x)) for x in self.parent if self.find(x) != x]


#: A task's forest is emitted and begun anew when it has so many members.
FOREST = 200_000


def _forest(batches):
    sets = UnionFind()

    def flush():
        found = sets.edges()
        sets.parent = {}
        return pa.RecordBatch.from_arrays([pa.array([e[i] for e in found], pa.int64()) for i in (0, 1)], names=["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sets.union(a, b)
        if len(sets.parent) >= FOREST:
            yield flush()
    yield flush()


def components(edges: DataFrame, used: list[str] | None = None) -> DataFrame:
    """edges: two long columns without nulls. Returns (id, component): the smallest id that each id of an edge reaches.

    Each task first contracts its edges to a forest, so that what is shuffled is at most a row per node and task. Star rounds
    then join the forests; a hub's rows are combined before the shuffle (minimum) and its join is one that AQE can split.
    A round's table goes when the next one is written; used takes the path of the last.
    """
    a, b = edges.columns
    now = cut(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).mapInArrow(_forest, "u long, v long"), last := [])
    before = None
    while True:
        # Large star: every node hands its larger neighbours to the smallest of its neighbourhood.
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # Small star: every node hands itself and its smaller neighbours to the smallest of those.
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        floor = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(floor, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        now = cut(small, path := [])
        remove(edges.sparkSession, last)
        last = path
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == before:
            if used is not None:
                used += last
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        before = sign
