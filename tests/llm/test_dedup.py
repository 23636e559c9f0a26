import random
from itertools import combinations

import numpy as np

from feedloom.llm import dedup
from feedloom.llm.common import word_hashes
from feedloom.llm.components import UnionFind, components


def brute(rows):
    """(n_shingles, component) per id, by comparing all pairs."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    roots = UnionFind()
    for a, b in combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 85 * len(x | y):
            roots.union(a, b)
    return {i: (len(s), roots.find(i)) for i, s in sets.items()}


def run(spark, rows):
    out = dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in out}, out


def varied(seed, n=120, words=146):
    """A family of texts that drift apart by edits, some exact copies, and short and blank texts."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(4000)}" for _ in range(words)]
    rows = []
    for i in range(n):
        text = list(base) if rng.random() < 0.3 else rng.choice(rows)[1].split() if rows else list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    rows += [(n + 1, "a b c"), (n + 2, "A  b\tc"), (n + 3, "a b d"), (n + 4, None), (n + 5, ""), (n + 6, " \n"), (n + 7, "one two three four five"), (n + 8, rows[0][1].upper())]
    return rows


def test_against_all_pairs(spark):
    for seed in (1, 2):
        rows = varied(seed)
        found, out = run(spark, rows)
        assert found == brute(rows)
        assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_large_bucket_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK_SHINGLES", 2000)
    rows = varied(3, n=150)
    assert run(spark, rows)[0] == brute(rows)


def test_nulls_repeats_and_empty(spark):
    assert run(spark, [])[1] == []
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (3, None)]
    out = dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in out) == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]
    other = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "q r s t u v"), (5, "q r s t u v")]
    out = dedup.near_duplicates(spark.createDataFrame(other, "doc_id long, text string")).collect()
    assert {r.component_id for r in out} == {1}


def test_ids_with_several_texts(spark):
    near = lambda w: " ".join([f"{w}{k}" for k in range(60)])
    rows = [(1, near("a")), (2, near("a") + " tail"), (2, near("b")), (3, near("b") + " end"), (4, near("c")), (5, near("c")), (5, near("d")), (6, near("e"))]
    out = dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in out) == [(1, 1), (2, 1), (2, 1), (3, 1), (4, 4), (5, 4), (5, 4), (6, 6)]


def test_long_words_of_swapped_parts_differ():
    x, y = b"x" * 1024, b"y" * 1024
    hashes, counts = word_hashes([x + y, y + x, x + y + b" z", b"q" * 5000])
    assert counts.tolist() == [1, 1, 2, 1] and hashes[0] == hashes[2] and len(set(hashes.tolist())) == 4


def test_few_outliers_of_a_large_family(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK_SHINGLES", 3000)
    monkeypatch.setattr(dedup, "PART", 16)
    rng = random.Random(6)
    base = [f"w{k}" for k in range(120)]
    rows = [(i, " ".join(base[:100] + [f"x{i}"] + base[101:])) for i in range(80)]
    for i in range(80, 92):
        text = list(base)
        for k in rng.sample(range(120), 5):
            text[k] = f"y{i}"
        rows.append((i, " ".join(text)))
    assert run(spark, rows)[0] == brute(rows)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate([a[:300], rng.integers(0, 2**63, 100).astype(np.uint64)])
    h, d = np.concatenate([a, b]), np.repeat([0, 1], 400)
    sig = dedup.superminhash(h, d, 2, 256)
    assert abs((sig[0] == sig[1]).mean() - 0.6) < 0.1
    from unittest import mock

    with mock.patch.object(dedup, "CHUNK", 100):
        assert (dedup.superminhash(h, d, 2, 256) == sig).all()
    one = dedup.superminhash(h[:3], d[:3], 1, 16)
    assert np.isfinite(one).all() and len(np.unique(np.floor(one))) > 1


def test_block_links_match_pairs():
    rng = random.Random(9)
    base = [rng.randrange(10**9) for _ in range(60)]
    sets = []
    for _ in range(30):
        s = set(base) if rng.random() < 0.5 or not sets else set(rng.choice(sets).tolist())
        for _ in range(rng.randrange(6)):
            s.discard(rng.choice(sorted(s)))
            s.add(rng.randrange(10**9))
        sets.append(np.array(sorted(s), np.uint64))
    ids = np.arange(30)
    for side in (np.zeros(30, int), (ids % 2)):
        got, want = UnionFind(), UnionFind()
        for a, b in dedup.block_links(ids, ids, side, sets):
            got.union(a, b)
        for a, b in combinations(range(30), 2):
            if (not side.any() or side[a] != side[b]) and dedup.linked(sets[a], sets[b]):
                want.union(a, b)
        assert [got.find(i) for i in range(30)] == [want.find(i) for i in range(30)]


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5)]
    roots = UnionFind()
    for a, b in edges:
        roots.union(a, b)
    out = components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()
    assert {r.id: r.component for r in out} == {x: roots.find(x) for e in edges for x in e if any(roots.find(x) == roots.find(y) and x != y for f in edges for y in f)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_pipeline_links_from_eighty_hundredths(spark):
    import corpus_pipeline

    words = [f"w{k}" for k in range(104)]
    # 100 shingles each: 10 of them differ at 90 / 110 = 0.818, 12 at 88 / 112 = 0.786.
    rows = [(1, " ".join(words)), (2, " ".join(words[10:] + [f"x{k}" for k in range(10)])), (11, " ".join(f"{w}y" for w in words)), (12, " ".join([f"{w}y" for w in words[12:]] + [f"z{k}" for k in range(12)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.drop_copies(spark, docs, "").collect()} == {1, 11, 12}
    assert {r.doc_id for r in dedup.near_duplicates(docs).filter("kept").collect()} == {1, 2, 11, 12}
