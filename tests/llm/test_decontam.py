import random

import numpy as np

from feedloom.llm import decontam


def distance(a, b):
    """Least edit distance of a to any part of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def words(rng, n):
    return [f"w{min(int(rng.paretovariate(0.7)), 3000)}" for _ in range(n)]


def edited(rng, w, k):
    w = list(w)
    for _ in range(k):
        p = rng.randrange(len(w))
        op = rng.randrange(3)
        if op == 0:
            w[p] = f"e{rng.randrange(999)}"
        elif op == 1:
            w.insert(p, f"e{rng.randrange(999)}")
        elif len(w) > 1:
            del w[p]
    return w


def test_align_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(200):
        a, b = [rng.randrange(1, 5) for _ in range(rng.randrange(1, 9))], [rng.randrange(1, 5) for _ in range(rng.randrange(1, 14))]
        d, lo, hi = decontam.align(np.array(a), np.array(b))
        assert d == distance(a, b)
        assert d == _plain(a, b[lo:hi])


def _plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_recall_and_precision_against_brute_force():
    rng = random.Random(4)
    items = [words(rng, rng.randrange(15, 60)) for _ in range(60)]
    found = wanted = 0
    matcher = decontam.Matcher([decontam.words_of([" ".join(i).encode()])[0] for i in items])
    for k in range(180):
        item = rng.randrange(60)
        doc = words(rng, 50) + edited(rng, items[item], rng.randrange(0, 1 + len(items[item]) // 10)) + words(rng, 50)
        got = {(r[1], r[2]) for r in matcher.find([" ".join(doc).encode()])}
        want = {(i, d) for i, w in enumerate(items) if (d := distance(w, doc)) <= int(0.2 * len(w))}
        assert {g[0] for g in got} <= {w[0] for w in want}
        found, wanted = found + len({g[0] for g in got}), wanted + len(want)
    assert found >= 0.99 * wanted
    assert matcher.find([" ".join(words(rng, 3000)).encode()]) == []


def test_query_cases(spark):
    items = spark.createDataFrame([(1, "Alpha, beta gamma delta EPSILON zeta eta theta iota kappa lambda mu nu xi."), (2, None), (3, ""), (4, "one two"), (5, "solo")], "item_id long, text string")
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    rows = [(1, f"x y {passage} z"), (2, "no such words"), (3, None), (4, ""), (5, "say One, TWO three"), (None, passage), (1, f"x y {passage} z"), (6, "is solo here"), (7, passage.replace("eta", "beta", 1) + " tail " * 5000), (8, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {(r.doc_id, r.item_id, r.distance, r.first_word) for r in decontam.find_leaks(docs, items).collect()}
    assert {(1, 1, 0, 2), (None, 1, 0, 0), (5, 4, 0, 1), (6, 5, 0, 1)} <= out and {(a, b) for a, b, *_ in out} == {(1, 1), (None, 1), (5, 4), (6, 5), (7, 1)}
    kept = [r.doc_id for r in decontam.drop_leaks(docs, items).collect()]
    assert sorted(kept) == [2, 3, 4, 8]
    assert decontam.find_leaks(docs.limit(0), items).collect() == [] and decontam.find_leaks(docs, items.limit(0)).collect() == []
    assert decontam.drop_leaks(docs, items.limit(0)).count() == len(rows)


def test_items_in_batches(spark, monkeypatch):
    monkeypatch.setattr(decontam, "INDEX_KEYS", 40)
    items = spark.createDataFrame([(k, f"q{k} a{k} b{k} c{k} d{k} e{k} f{k} g{k} h{k} i{k} j{k} k{k} l{k}") for k in range(6)], "item_id long, text string")
    docs = items.selectExpr("item_id + 10 AS doc_id", "concat('z ', text) AS text")
    assert {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, items).collect()} == {(k + 10, k) for k in range(6)}
    assert decontam.drop_leaks(docs, items).count() == 0


def _at_the_limit(rng, w, kind):
    k = int(0.2 * len(w))
    if kind == "mixed":
        return edited(rng, w, k)
    places = rng.sample(range(len(w)), k) if kind == "random" else [(j + 1) * len(w) // (k + 1) for j in range(k)]
    return [f"s{rng.randrange(10**6)}" if p in places else x for p, x in enumerate(w)]


def test_recall_at_the_full_limit():
    rng = random.Random(5)
    fresh = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    for n in (3, 5, 7, 10, 12, 15, 16, 20, 25, 40):
        items = [fresh(n) for _ in range(200)]
        matcher = decontam.Matcher([decontam.words_of([" ".join(i).encode()])[0] for i in items])
        for kind in ("mixed", "random", "even"):
            docs = [" ".join(fresh(20) + _at_the_limit(rng, i, kind) + fresh(20)).encode() for i in items]
            found = {(d, i) for d, i, *_ in matcher.find(docs)}
            assert sum((k, k) in found for k in range(200)) >= 198, (n, kind)
