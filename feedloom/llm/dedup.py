"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full shingle sets, union-find.

Words are runs of characters other than space and 9 to 13, with A-Z in lower case. A document's set holds its distinct
five-word shingles (the whole sequence as one, with fewer words), as 64-bit hashes. Two documents are linked when
100 * |intersection| >= threshold * |union|; 85 unless given.

1. A pass over the texts makes a row per document: set size, two digests of the set and the keys of 24 bands of 4 signature
   values. At similarity 0.85 all bands miss a pair with probability 2e-8, at 0.8 with 3e-6.
2. Documents of equal sets are one class (a partial aggregate, so that any number of copies costs a row per task).
3. Buckets of two classes or more are kept; buckets of equal members are one.
4. Each class is verified against the smallest class it shares most buckets with, its centre; components follow. A centre's set is sent
   once to each part of its members (at most PART of a bucket), not with every member.
5. In buckets that still hold two components or more, the members outside of the bucket's largest component are compared with all of its
   members. Members are dealt to blocks of bounded size, each such pair of blocks is a task's work, and only links that join two components
   within a task leave it. So a few outliers in a large family cost a pass over the family, not its square.

Null ids stand alone: component_id null and kept true. Null, empty and blank texts have no shingles and no links.
Repeated ids are one node and give a row each,
also where their texts differ: such an id joins the components of all its texts. Texts of any length are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import blocks, cut, remove, splitmix, table, word_hashes
from feedloom.llm.components import UnionFind, components

WORDS = 5
THRESHOLD = 85
BANDS, ROWS = 24, 4
SIGNATURE = BANDS * ROWS
#: Shingles of one block in the full comparison of a bucket.
BLOCK_SHINGLES = 1 << 18
#: Elements whose permutations are held at a time (about 150 bytes each).
CHUNK = 1 << 18
#: Classes of a bucket that are verified against one copy of their centre's set, and parts that a bucket's rows are dealt to.
PART, SALTS = 1024, 8
#: Ids that are sent to every task at most (about 30 bytes each).
BROADCAST_IDS = 4_000_000

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
#: Multiples of the step, wrapped to 64 bits.
_STEPS = np.arange(1, 1025, dtype=np.uint64) * _STEP
_BAND_SALT = splitmix(_STEPS[:BANDS])


def shingle_hashes(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of some documents and the number of their document, sorted by document and hash."""
    owner = np.repeat(np.arange(len(counts)), counts)
    n = len(words) - WORDS + 1
    parts, owners = [], []
    if n > 0:
        whole = owner[:n] == owner[WORDS - 1:]
        h = np.zeros(n, np.uint64)
        for k in range(WORDS):
            h = h * _U(0x100000001B3) + words[k:n + k]
        parts.append(splitmix(h[whole] + _STEP))
        owners.append(owner[:n][whole])
    ends = np.cumsum(counts)
    for d in np.flatnonzero((counts > 0) & (counts < WORDS)):
        h = _U(counts[d])
        for w in words[ends[d] - counts[d]:ends[d]]:
            h = _U((int(h) * 0x100000001B3 + int(w)) & (2**64 - 1))
        parts.append(splitmix(np.array([h], np.uint64)))
        owners.append(np.array([d]))
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h, d = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[new], d[new]


def superminhash(hashes: np.ndarray, owner: np.ndarray, n: int, m: int = SIGNATURE) -> np.ndarray:
    """SuperMinHash signatures (n by m) of n sets; sets without elements have infinite values.

    In step j each element draws a number in [j, j + 1) for the j-th place of its own random permutation, made by swaps. A set
    is finished at step j when its largest value is below j, as no later draw can lower any value.
    """
    if len(hashes) > CHUNK:  # a very long text: signatures of parts, of which the least values are those of the whole
        return np.minimum.reduce([superminhash(hashes[i:i + CHUNK], owner[i:i + CHUNK], n, m) for i in range(0, len(hashes), CHUNK)])
    sig = np.full(n * m, np.inf)
    places = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.int32), (len(hashes), 1))
    base, state, rows = owner * m, hashes, np.arange(len(hashes))
    for j in range(m):
        if not len(rows):
            break
        x = splitmix(state + _STEPS[j])
        draw = (x >> _U(11)).astype(np.float64) * 2.0**-53 + j
        k = j + (splitmix(x + _STEP) % _U(m - j)).astype(np.int64)
        at_k = places[rows, k]
        places[rows, k] = places[rows, j]
        places[rows, j] = at_k
        np.minimum.at(sig, base + at_k, draw)
        open_ = sig.reshape(n, m).max(axis=1) >= j + 1
        if not open_.all():
            keep = open_[owner]
            owner, base, state, rows = owner[keep], base[keep], state[keep], rows[keep]
    return sig.reshape(n, m)


def set_digests(h: np.ndarray, d: np.ndarray, n: int) -> list[np.ndarray]:
    """Two 64-bit digests of each of n sets: sums of mixed elements, so that no order matters."""
    sums = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
    np.add.at(sums[0], d, splitmix(h ^ _U(0xA5A5A5A5A5A5A5A5)))
    np.add.at(sums[1], d, splitmix(h + _U(0x0123456789ABCDEF)))
    return sums


def _features(batches):
    for whole in batches:
        for batch in blocks(whole, "text"):
            texts = [(t or b"").lower() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            h, d = shingle_hashes(*word_hashes(texts))
            n = len(texts)
            sizes = np.bincount(d, minlength=n)
            sig = superminhash(h, d, n)
            bits = splitmix(sig.view(np.uint64) + np.arange(SIGNATURE, dtype=np.uint64) * _STEP)
            key = np.broadcast_to(_BAND_SALT, (n, BANDS)).copy()
            for r in range(ROWS):
                key = splitmix(key * _U(0x100000001B3) + bits[:, r::ROWS])
            sums = set_digests(h, d, n)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(key.reshape(-1).view(np.int64)), BANDS).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *(pa.array(s.view(np.int64)) for s in sums), lists], names=["id", "n", "k1", "k2", "bands"])


def _sets(batches):
    """(id, k1, k2, set) of documents: the set's digests and its sorted shingle hashes as little-endian bytes."""
    for whole in batches:
        for batch in blocks(whole, "text"):
            texts = [(t or b"").lower() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            h, d = shingle_hashes(*word_hashes(texts))
            ends = np.cumsum(np.bincount(d, minlength=len(texts)))
            rows = [x.tobytes() for x in np.split(h, ends[:-1])]
            sums = set_digests(h, d, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(s.view(np.int64)) for s in sums), pa.array(rows, pa.binary())], names=["id", "k1", "k2", "set"])


def linked(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    """Whether two sets of distinct sorted hashes reach the threshold, exactly."""
    if 100 * min(len(a), len(b)) < threshold * max(len(a), len(b)) or not len(a):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    inter = int((both[1:] == both[:-1]).sum())
    return 100 * inter >= threshold * (len(a) + len(b) - inter)


def _views(column: pa.Array) -> list[np.ndarray]:
    """The sets of a binary column, without copying them."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].tolist()
    data = column.buffers()[2]
    return [np.frombuffer(data, np.uint64, (b - a) // 8, a) if b > a else np.empty(0, np.uint64) for a, b in zip(offsets, offsets[1:], strict=False)]


def _verify(batches, threshold: int):
    """Rows (b, part, member, id, set), sorted: a centre's row, then its members. Linked (a, b) out."""
    centre, held = None, None
    for batch in batches:
        found = []
        ids, sets = batch.column(3).to_pylist(), _views(batch.column(4))
        for b, member, i, s in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), ids, sets, strict=True):
            if not member:
                centre, held = b, s.copy()
            elif centre == b and linked(s, held, threshold):
                found.append((i, b))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])


def block_links(ids: np.ndarray, comp: np.ndarray, side: np.ndarray, sets: list[np.ndarray], threshold: int = THRESHOLD) -> list[tuple[int, int]]:
    """Links that join the components of one pair of blocks: all pairs are decided, those within a component are skipped.

    side is 0 or 1 for the two blocks, all 0 when a block meets itself. Shared elements are counted by posting lists, a member at a time.
    """
    n = len(ids)
    sizes = np.array([len(s) for s in sets])
    if n == 2:
        return [(int(ids[0]), int(ids[1]))] if comp[0] != comp[1] and linked(sets[0], sets[1], threshold) else []
    owner = np.repeat(np.arange(n), sizes)
    values, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(inverse, kind="stable")
    posting, starts = owner[order], np.concatenate([[0], np.cumsum(np.bincount(inverse, minlength=len(values)))])
    ends = np.cumsum(sizes)
    roots, found, two = UnionFind(), [], bool(side.any())
    # The smaller side is gone through.
    mine_is = int(2 * side.sum() <= n)
    for i in np.flatnonzero(side == mine_is) if two else range(n):
        mine = inverse[ends[i] - sizes[i]:ends[i]]
        lengths = starts[mine + 1] - starts[mine]
        at = np.repeat(starts[mine] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        shared = np.bincount(posting[at], minlength=n)
        good = 100 * shared >= threshold * (sizes[i] + sizes - shared)
        good &= (side != mine_is) if two else np.arange(n) > i
        good &= comp != comp[i]
        for j in np.flatnonzero(good):
            if roots.union(int(comp[i]), int(comp[j])):
                found.append((int(ids[i]), int(ids[j])))
    return found


def _compare(batches, threshold: int):
    """Rows sorted by (bucket, pair of blocks); a group is compared when its last row has come."""
    key, rows = None, []

    def done():
        ids, comp, side = (np.array([r[i] for r in rows], np.int64) for i in range(3))
        if key and key[1] != key[2] and side.min() == side.max():
            return []  # one of the two blocks has no members
        return block_links(ids, comp, side, [r[3] for r in rows], threshold) if len(rows) > 1 else []

    def out(links):
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"])

    for batch in batches:
        links = []
        column = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: B023, E731
        sets = _views(column("set"))
        for k, s in zip(zip(*(column(c).to_pylist() for c in ("bucket", "p", "q", "id", "component", "side")), strict=True), sets, strict=True):
            if k[:3] != key:
                links += done()
                key, rows = k[:3], []
            rows.append((k[3], k[4], k[5], s))
        rows = [(*r[:3], r[3].copy()) for r in rows]  # the batch goes, the open group stays
        yield out(links)
    yield out(done())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """A row per document: id_col, n_shingles, component_id (smallest id reachable) and kept; threshold is in hundredths of similarity."""
    spark, used = docs.sparkSession, []
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    feats = cut(source.mapInArrow(_features, "id long, n long, k1 long, k2 long, bands array<long>"))
    some = feats.filter("n > 0 AND id IS NOT NULL")
    # Ids may stand for several texts: classes then have numbers of their own, and ids are put in their place at the end.
    repeated = not some.groupBy("id").count().filter("count > 1").isEmpty()
    classes = some.groupBy("k1", "k2", "n").agg(F.min("id").alias("rep"), F.min_by("bands", "id").alias("bands"))
    classes = cut(classes.withColumn("id", F.monotonically_increasing_id() if repeated else F.col("rep")))

    rows = classes.select("id", "n", F.explode("bands").alias("bucket"))
    full = rows.groupBy("bucket").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("id")).alias("s"), F.min("id").alias("least")).filter("c > 1")
    full = full.groupBy("c", "s", "least").agg(F.min("bucket").alias("bucket"), F.count("*").alias("weight"))
    # A bucket that very many classes share is dealt to SALTS tasks.
    salt, salts = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    members = cut(rows.withColumn("salt", salt).join(full.withColumn("salt", salts), ["bucket", "salt"]).select("bucket", "salt", "c", "least", "weight", "id", "n"), used)

    wanted = cut(members.select("id").distinct().join(classes.select("id", "rep"), "id").select("rep").distinct() if repeated else members.select(F.col("id").alias("rep")).distinct(), used)
    # Ids are sent to the tasks up to a checked number; beyond it the texts are shuffled to them.
    near = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    sets = source.filter("id IS NOT NULL").join(near, F.col("id") == F.col("rep"), "left_semi").mapInArrow(_sets, "id long, k1 long, k2 long, set binary")
    if repeated:
        own = classes.select("k1", "k2", F.col("rep"), F.col("id").alias("class"))
        sets = sets.join(own, ["k1", "k2"]).filter("id = rep").select(F.col("class").alias("id"), "set").dropDuplicates(["id"])
    sets = cut(sets.select("id", "set"), used)

    stars = members.filter("id <> least").groupBy("id", "least").agg(F.sum("weight").alias("w"), F.max("c").alias("c"))
    stars = stars.groupBy("id").agg(F.max_by(F.struct("least", "c"), F.struct("w", -F.col("least"))).alias("s"))
    parts = F.ceil(F.col("s.c") / PART)
    stars = stars.select("id", F.col("s.least").alias("b"), (parts * (1 << 31) + F.pmod(F.xxhash64("id"), parts)).alias("part"))
    centres = stars.select("b", "part").distinct().select("b", "part", F.lit(0).alias("member"), F.col("b").alias("id"))
    stars = centres.unionByName(stars.select("b", "part", F.lit(1).alias("member"), "id")).join(sets, "id").select("b", "part", "member", "id", "set")
    stars = stars.repartition("b", "part").sortWithinPartitions("b", "part", "member")
    star_links = cut(stars.mapInArrow(lambda batches: _verify(batches, threshold), "a long, b long"), used)
    first = components(star_links, used)

    labelled = cut(members.select("bucket", "salt", "id", "n").join(first, "id", "left").withColumn("component", F.coalesce("component", "id")), used)
    shares = labelled.groupBy("bucket", "component").agg(F.sum("n").alias("n"))
    mixed = shares.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("major"), F.max("n").alias("most"), F.sum("n").alias("total"), F.count("*").alias("k")).filter("k > 1")
    blocks_of = lambda n: F.ceil(n / BLOCK_SHINGLES).cast("int")
    mixed = mixed.select("bucket", "major", blocks_of(F.col("most")).alias("majors"), blocks_of(F.col("total") - F.col("most")).alias("minors"))
    deal = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    minor = F.col("component") != F.col("major")
    active = labelled.join(mixed.withColumn("salt", salts), ["bucket", "salt"]).withColumn("block", F.when(minor, F.col("majors") + deal(F.col("minors"))).otherwise(deal(F.col("majors"))))
    # Blocks of the largest component come first and meet those of the others; these meet all blocks. Pair (p, q) has p <= q.
    meets = active.withColumn("other", F.explode(F.sequence(F.when(minor, 0).otherwise(F.col("majors")), F.col("majors") + F.col("minors") - 1)))
    meets = meets.select("bucket", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "id", "component", F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("side"))
    work = meets.join(sets, "id")
    work = work.repartition("bucket", "p", "q").sortWithinPartitions("bucket", "p", "q", "id")
    more = work.mapInArrow(lambda batches: _compare(batches, threshold), "a long, b long")

    links = star_links.union(more)
    # Copies are linked to their class's smallest id.
    copies = some.select("k1", "k2", "n", "id").join(classes.select("k1", "k2", "n", "rep"), ["k1", "k2", "n"]).filter("id <> rep").select("id", "rep")
    if repeated:
        named = classes.select("id", "rep")
        links = links.join(named.select(F.col("id").alias("a"), F.col("rep").alias("u")), "a").join(named.select(F.col("id").alias("b"), F.col("rep").alias("v")), "b").select("u", "v")
        final = components(links.filter("u <> v").union(copies))
    else:
        whole = components(links)
        tops = copies.join(whole.withColumnRenamed("id", "rep"), "rep", "left").select("id", F.coalesce("component", "rep").alias("component"))
        final = whole.union(tops)
    remove(spark, used)
    out = feats.select("id", "n").join(final, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), threshold=THRESHOLD)


#: Exact, by comparing the shingles of all pairs: for small tables only.
OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
b AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT doc_id AS id, doc_id AS root FROM n UNION SELECT b.y, r.root FROM r JOIN b ON b.x = r.id),
m AS (SELECT id, min(root) AS root FROM r GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.root, d.doc_id) AS component_id, coalesce(m.root, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.id = d.doc_id
"""
