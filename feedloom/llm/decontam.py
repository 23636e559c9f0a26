"""Benchmark decontamination: passages of benchmark items in documents, up to an edit distance over words.

Words are runs of letters, digits and bytes above 127, with A-Z in lower case; all else parts words. The CGK random walk embeds
a window of words: step t emits the word at a pointer and moves the pointer by bit t of that word's hash, so that windows at a small edit
distance emit equal words at most steps. Sampling some of the steps gives a key that close windows share with good probability.

A walk reads its window from the front, and its first STEPS steps are the same for all windows that begin at one word. One walk per
starting word thus serves the windows of all item sizes at once. Each repetition has its own bits and samples TAKEN of
the STEPS steps. On the items' side, the keys of every starting word of an item are indexed (by the number of words before it) if they
end in the item and read several words, so that an item is met at any of its words that is followed by a short stretch without edits.
Short items have few such stretches and get more repetitions: at the full limit of int(0.2 * words) edits, at random or evenly spread,
recall is over 0.99 for each length by simulation (tests/llm/test_decontam.py). A key that is met names an item and where it would
begin; the document's words there are aligned to the item exactly, with free ends, and the pair is kept when distance <= 0.2 * item words.

Items shorter than STEPS words get walks of fewer steps (a class per power of two), which read inside of the item only.
Items without words match nothing. Null and empty texts match nothing; null ids are matched and returned as they are. Repeated rows
give a result row once per id. The index is built from all items; it is sent to the tasks while it has at most INDEX_KEYS keys, and in
batches of items, one pass over the documents each, beyond that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import blocks, table, word_hashes

STEPS, TAKEN = 8, 4
#: Repetitions for items of at least LONG words, and for shorter ones.
WALKS, SHORT_WALKS, LONG = 6, 16, 14
EDITS = 0.2
#: Keys that one pass over the documents holds in a task's memory (about 40 bytes each).
INDEX_KEYS = 2_000_000

_U = np.uint64
_CLEAN = np.full(256, 32, np.uint8)
for _c in [*range(48, 58), *range(97, 123), *range(128, 256)]:
    _CLEAN[_c] = _c
_CLEAN[65:91] = np.arange(97, 123)
_CLEAN = _CLEAN.tobytes()


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """32-bit word hashes, never 0, and the number of words of each text."""
    h, n = word_hashes([t.translate(_CLEAN) for t in texts])
    return np.maximum(h >> _U(32), _U(1)).astype(np.uint32), n


def _draws(walk: int, steps: int) -> np.ndarray:
    """The sampled steps of a walk: one at random in each of TAKEN equal parts, so that they seldom fall on one word."""
    random = np.random.Generator(np.random.PCG64([walk, steps, 77]))
    parts = np.array_split(np.arange(steps), min(TAKEN, steps))
    return np.array([random.choice(part[len(part) // 2:]) for part in parts])


def walk_keys(words: np.ndarray, walk: int, steps: int, reach: np.ndarray | None = None, read: np.ndarray | None = None) -> np.ndarray:
    """The key of the walk that begins at each word. words must be followed by steps words of padding (0).

    reach, if given, takes the place of the last word that each key has read; read takes how many words it has read."""
    n = len(words) - steps
    bits = ((words * np.uint32(2 * walk + 0x9E3779B1)) ^ np.uint32(0x85EBCA6B * (walk + 1) & 0xFFFFFFFF))
    bits ^= bits >> np.uint32(15)
    bits *= np.uint32(0x2C1B3C6D)
    bits ^= bits >> np.uint32(12)
    taken = set(_draws(walk, steps).tolist())
    keys = np.empty(n, np.uint32)
    for at in range(0, n, 16384):  # blocks that stay in the cache
        m = min(16384, n - at)
        w, b = words[at:at + m + steps], bits[at:at + m + steps]
        p, key = np.arange(m, dtype=np.intp), np.zeros(m, np.uint32)
        last, before = max(taken), np.full(m, -1)
        for t in range(last + 1):
            if t in taken:
                key = key * np.uint32(0x01000193) ^ w.take(p)
                key *= np.uint32(0x9E3779B1)
                key ^= key >> np.uint32(16)
                if read is not None:
                    read[at:at + m] += p != before
                    before = p.copy()
            if t < last:
                p += (b.take(p) >> np.uint32(t)) & np.uint32(1)
        keys[at:at + m] = key
        if reach is not None:
            reach[at:at + m] = p + at
    return keys


def repetitions(n: int) -> int:
    """The number of walks that an item of n words is indexed by."""
    return WALKS if n >= LONG else SHORT_WALKS


class Index:
    """Keys of the walks over some items, for one number of steps: a bit table to pass over most words, then sorted keys."""

    def __init__(self, items: list[np.ndarray], steps: int):
        self.steps, self.tables = steps, []
        for walk in range(max(repetitions(len(w)) for w in items if len(w))):
            keys, item, offset = [], [], []
            for i, w in enumerate(items):
                if len(w) and walk < repetitions(len(w)):
                    reach, read = np.empty(len(w), np.int64), np.zeros(len(w), np.int64)
                    k = walk_keys(np.concatenate([w, np.zeros(steps, np.uint32)]), walk, steps, reach, read)
                    # Of the keys that end in the item, those of several words; the others would meet common words everywhere.
                    least = min(3 if steps == STEPS else 2, read[reach < len(w)].max(initial=0))
                    inside = np.flatnonzero((reach < len(w)) & (read >= least))
                    keys.append(k[inside])
                    item.append(np.full(len(inside), i))
                    offset.append(inside)
            k = np.concatenate(keys)
            order = np.argsort(k, kind="stable")
            bits = np.zeros(1 << 20, bool)
            bits[k & np.uint32(0xFFFFF)] = True
            self.tables.append((bits, k[order], np.concatenate(item)[order], np.concatenate(offset)[order]))

    def candidates(self, words: np.ndarray):
        """(start, item) arrays: where an item would begin, by the keys that are met in the padded words."""
        starts, items = [], []
        for walk, (bits, keys, item, offset) in enumerate(self.tables):
            k = walk_keys(words, walk, self.steps)
            at = np.flatnonzero(bits[k & np.uint32(0xFFFFF)])
            lo, hi = np.searchsorted(keys, k[at], "left"), np.searchsorted(keys, k[at], "right")
            n = hi - lo
            rows = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64), n) + np.arange(n.sum())
            starts.append(np.repeat(at, n) - offset[rows])
            items.append(item[rows])
        return np.concatenate(starts), np.concatenate(items)


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """The least edit distance of an item to any part of a text, with the part's start and end (the first such end)."""
    m = len(text)
    row, begin = np.zeros(m + 1, np.int64), np.arange(m + 1)
    ramp = np.arange(m + 1)
    for i, w in enumerate(item, 1):
        up = row + 1
        diag = np.empty(m + 1, np.int64)
        diag[0] = i
        diag[1:] = row[:-1] + (text != w)
        from_diag = diag <= up
        best = np.where(from_diag, diag, up)
        best[0] = i
        origin = begin.copy()
        origin[1:] = np.where(from_diag[1:], begin[:-1], begin[1:])
        origin[0] = 0
        # Insertions: the least value to the left plus the way from there.
        low = best - ramp
        least = np.minimum.accumulate(low)
        fresh = np.ones(m + 1, bool)
        fresh[1:] = low[1:] <= least[:-1]
        source = np.maximum.accumulate(np.where(fresh, ramp, 0))
        row, begin = least + ramp, origin[source]
    end = int(row.argmin())
    return int(row[end]), int(begin[end]), end


class Matcher:
    """Finds items in blocks of documents; made once per task from the items' words."""

    def __init__(self, items: list[np.ndarray]):
        self.items = items
        steps = {min(STEPS, 1 << (len(w).bit_length() - 1)) for w in items if len(w)}
        self.indexes = [Index([w if self._steps(w) == s else w[:0] for w in items], s) for s in sorted(steps)]

    @staticmethod
    def _steps(w):
        return min(STEPS, 1 << (len(w).bit_length() - 1)) if len(w) else 0

    def find(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """(document, item, distance, first word, number of words) of the best place of each item in each document."""
        words, counts = words_of(texts)
        if not len(words) or not self.indexes:
            return []
        # Padding between documents, so that no walk reads on into the next text.
        pad = max(i.steps for i in self.indexes)
        ends = np.cumsum(counts)
        spread = np.zeros(len(words) + pad * len(counts), np.uint32)
        spread[np.arange(len(words)) + np.repeat(np.arange(len(counts)) * pad, counts)] = words
        firsts = ends - counts + np.arange(len(counts)) * pad
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        seen = set()
        for index in self.indexes:
            starts, items = index.candidates(np.concatenate([spread, np.zeros(index.steps, np.uint32)]))
            for s, i in zip(starts.tolist(), items.tolist(), strict=True):
                item = self.items[i]
                limit = int(EDITS * len(item))
                d = int(np.searchsorted(firsts, max(s + limit, 0), "right")) - 1
                while d > 0 and not counts[d]:
                    d -= 1
                # Places that differ by edits before the key are one place: the aligned part has room for all of them.
                if (d, i, s // (limit + 1)) in seen:
                    continue
                seen.add((d, i, s // (limit + 1)))
                lo, hi = max(s - 2 * limit - 1, firsts[d]), min(s + len(item) + 2 * limit + 1, firsts[d] + counts[d])
                # The words that an alignment within the limit leaves in place must be there at all.
                if hi <= lo or np.isin(item, spread[lo:hi]).sum() < len(item) - limit:
                    continue
                distance, a, b = align(item, spread[lo:hi])
                if distance <= limit:
                    row = (distance, int(lo + a - firsts[d]), b - a)
                    if row < best.get((d, i), (1 << 60,)):
                        best[d, i] = row
        return [(d, i, *row) for (d, i), row in sorted(best.items())]


def item_batches(items: DataFrame, item_col: str, text_col: str):
    """Lists of (id, text) rows whose index has at most INDEX_KEYS keys (or one row)."""
    batch, keys = [], 0
    for row in items.select(item_col, text_col).toLocalIterator():
        n = max(1, (len(row[1] or "") + 1) // 2)  # words have a letter and a blank at least
        more = max(WALKS * n, SHORT_WALKS * min(n, LONG - 1))
        if batch and keys + more > INDEX_KEYS:
            yield batch
            batch, keys = [], 0
        batch.append(row)
        keys += more
    if batch:
        yield batch


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """A row per document and item found in it: id_col, item_col, distance, first_word, n_words, item_words.

    Documents are passed over without a shuffle. Items are read batch by batch on the driver (a benchmark is a list of questions,
    and a batch is bounded by INDEX_KEYS); a benchmark beyond a batch costs a pass per batch.
    """
    spark = docs.sparkSession
    kinds = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    schema = f"`{id_col}` {kinds[0]}, `{item_col}` {kinds[1]}, distance int, first_word long, n_words int, item_words int"
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    id_type, item_type = (pa.int64() if k == "bigint" else pa.int32() if k == "int" else pa.string() for k in kinds)
    if item_type == pa.string():
        items = items.withColumn(item_col, F.col(item_col).cast("string"))

    def passes(batch: list) -> DataFrame:
        ids = [r[0] for r in batch]
        words = [words_of([(r[1] or "").encode()])[0] for r in batch]

        def run(batches):
            matcher = Matcher(words)
            for whole in batches:
                for part in blocks(whole, "text"):
                    rows = matcher.find(part.column(1).cast(pa.binary()).to_pylist())
                    take = part.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
                    yield pa.RecordBatch.from_arrays([take, pa.array([ids[r[1]] for r in rows], item_type), pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.int64()), pa.array([r[4] for r in rows], pa.int32()), pa.array([len(words[r[1]]) for r in rows], pa.int32())], names=[id_col, item_col, "distance", "first_word", "n_words", "item_words"])

        return source.mapInArrow(run, schema)

    found = None
    for batch in item_batches(items, item_col, text_col):
        found = passes(batch) if found is None else found.union(passes(batch))
    if found is None:
        return spark.createDataFrame([], schema)
    # Repeated rows and ids: one result per pair, its best place.
    best = F.min(F.struct("distance", "first_word", "n_words", "item_words")).alias("best")
    return found.groupBy(id_col, item_col).agg(best).select(id_col, item_col, "best.*")


def drop_leaks(docs: DataFrame, items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that hold no item: a pass per batch of items, without a shuffle; null ids are judged like any other."""
    for batch in item_batches(items, item_col, text_col):
        words = [words_of([(r[1] or "").encode()])[0] for r in batch]

        def run(batches, words=words):
            matcher = Matcher(words)
            for whole in batches:
                for part in blocks(whole, text_col):
                    texts = part.column(part.schema.get_field_index(text_col)).cast(pa.binary()).to_pylist()
                    leaky = {r[0] for r in matcher.find([t or b"" for t in texts])}
                    yield part.filter(pa.array([i not in leaky for i in range(part.num_rows)]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
