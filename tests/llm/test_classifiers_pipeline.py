import zlib

import numpy as np
import pytest

import corpus_pipeline
from feedloom.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


def held_out(rows, labels):
    got = {r.doc_id: r for r in rows}
    return [(got[i], y) for i, y in labels.items() if zlib.crc32(str(i).encode()) % 5 == 0]


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_quality_held_out(spark, labels):
    rows = quality.op1_quality_classifier(spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    pairs = held_out(rows, labels)
    assert np.mean([r.predicted == y[0] for r, y in pairs]) > 0.93


def test_quality_scores_are_the_densities():
    """Log densities by plain inverses and determinants of the shrunk covariances, without Cholesky factors."""
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    x = rng.normal(size=(400, 4)) @ rng.normal(size=(4, 4)) + y[:, None] * [1.0, 0.5, 0, 0]
    model = quality.Model(x, y)
    z = (x - x.mean(0)) / x.std(0)
    covs = [np.cov(z[y == c].T, bias=True) for c in (0, 1)]
    pooled = sum(c * (y == k).mean() for k, c in enumerate(covs))
    logs = []
    for k, c in enumerate(covs):
        c = (1 - quality.TO_POOLED) * c + quality.TO_POOLED * pooled
        c = (1 - quality.TO_IDENTITY) * c + quality.TO_IDENTITY * np.trace(c) / 4 * np.eye(4)
        d = z - z[y == k].mean(0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d) - 0.5 * np.linalg.slogdet(c)[1])
    assert np.allclose(model.difference(x), logs[1] - logs[0])
    assert (np.diff(model.score(x)[np.argsort(logs[1] - logs[0])]) >= 0).all()


def test_toxicity_held_out(spark, labels):
    rows = toxicity.op2_toxicity(spark, SF).collect()
    pairs = held_out(rows, labels)
    assert np.mean([r.predicted == y[1] for r, y in pairs]) > 0.93


def test_statistics_of_odd_texts():
    x = quality.statistics([b"", b" ", b"A", b"a" * 100000, b"| | |\n\n\n", "é!".encode(), b"WORD!! WORD!!"])
    assert x.shape == (7, len(quality.FEATURES)) and np.isfinite(x).all()
    alone = np.concatenate([quality.statistics([t]) for t in (b"One two.\nOne two.", b"", b"UP DOWN!!")])
    assert np.allclose(alone, quality.statistics([b"One two.\nOne two.", b"", b"UP DOWN!!"]))


def test_gaps_and_inserted_letters():
    rng = np.random.default_rng(0)
    plain = ["".join(rng.choice(list("aeinorst"), rng.integers(2, 9))) for _ in range(3000)]
    texts, y = [], []
    for k in range(400):
        w = list(rng.choice(plain, 40))
        if k % 2:
            w[7] = "dumbkopf" if k % 4 == 1 else "buzzwit"
        texts.append(" ".join(w))
        y.append(k % 2)
    model = toxicity.train(texts, np.array(y))
    score = lambda t: float(model.probability(toxicity.Scorer(model).margins([t]))[0])
    for bad in ("you dumbkopf", "you d.u.m.b.k.o.p.f now", "a dumbbkopf", "a d u m b k o p f b", "dumb-kopf", "DUMBKOPF!!", "buzzzwit", "b u z z w i t", "dumbxkopf", "dumb*opf"):
        assert score(bad) > 0.5, bad
    for good in ("a stone in a nest", "", "e" * 5000, "no rest"):
        assert score(good) < 0.5, good


def test_kernel_is_the_enumerated_one():
    from itertools import combinations

    def phi(signs):
        out = {}
        for c in combinations(range(len(signs)), 3):
            if c[2] - c[0] < toxicity.SPAN:
                key = "".join(signs[i] for i in c)
                out[key] = out.get(key, 0.0) + toxicity.DECAY ** (c[2] - c[0] + 1)
        norm = sum(v * v for v in out.values()) ** 0.5
        return {k: v / norm for k, v in out.items()}

    words = ["dumbkopf", "dumbxkopf", "dumkopf", "aaaaa", "ab", "abcabcabc", "nest", "kopfdumb"]
    dense = toxicity.features(words)
    found = toxicity.kernel(words, dense)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            x, y = phi("{" + a + "{"), phi("{" + b + "{")
            assert abs(found[i, j] - sum(v * y.get(k, 0.0) for k, v in x.items())) < 1e-4, (a, b)
    assert (toxicity.bound(words, toxicity.envelope(dense, toxicity.alike(dense, 3))) >= found.max(axis=1) - 1e-4).all()
    long = "kopf" * 9 + "dumbkopf" + "nest" * 9  # the best window counts
    whole = phi("{dumbkopf{")
    best = max(sum(v * whole.get(k, 0.0) for k, v in phi(w).items()) for w in toxicity.windows(long))
    assert abs(toxicity.kernel([long], dense)[0, 0] - best) < 1e-4


def test_gapped_inserted_and_left_out_letters_of_held_out_documents():
    """Insults of held-out toxic documents, edited, in held-out clean ones. A clean document gets two of them.

    Only of groups that clean words don't come near: others (of invented stems, here) differ from clean words by as little as an edit does."""
    import random

    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.1"
    text = dict(zip(*pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pydict().values(), strict=True))
    known = {k: v for k, v in zip(*pq.read_table(f"{sf}/labels.parquet", columns=["doc_id", "toxic"]).to_pydict().values(), strict=True) if k in text and text[k]}
    held = lambda k: zlib.crc32(str(k).encode()) % 5 == 0
    learn = sorted(k for k in known if not held(k))
    model = toxicity.train([text[k] for k in learn], np.array([known[k] for k in learn]))
    flagged = lambda texts: (np.array(toxicity.Scorer(model).margins(texts)) >= 0).mean()
    clean, toxic = [text[k] for k in known if held(k) and not known[k]], [text[k] for k in known if held(k) and known[k]]
    assert flagged(clean) <= 0.01 and flagged(toxic) >= 0.9  # six of the 97 toxic ones hold no insult
    words = sorted({w for t in toxic for w in toxicity.words_of(t) if w.isalpha() and model.margins([toxicity.fold_word(w)])[0] >= 0})
    apart = lambda w: model.cuts[model.group[toxicity.kernel([toxicity.fold_word(w)], toxicity.features(model.landmarks[:len(model.group)]))[0].argmax()]] < -0.65
    words = [w for w in words if apart(w)]
    assert len(words) >= 8
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def put_in(w):
        i = rng.randrange(1, len(w))
        return w[:i] + rng.choice([c for c in letters if c not in w[i - 1:i + 1]]) + w[i:]

    def left_out(w):
        i = rng.randrange(1, len(w) - 1)
        return w[:i] + w[i + 1:]

    hosts = [t for t in clean if toxicity.Scorer(model).margins([t])[0] < 0][:200]
    for edit, least in ((put_in, 0.95), (left_out, 0.9), (lambda w: ".".join(w), 0.99), (lambda w: " ".join(w), 0.99), (lambda w: "*".join(w), 0.99)):
        made = [f"{edit(rng.choice(words))} {t} {edit(rng.choice(words))}" for t in hosts]
        assert flagged(made) >= least, (edit, flagged(made))


def test_classifiers_take_nulls_and_clashes(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 6), (None, "some words", None), (2, "", 6)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for module in (quality, toxicity):
        model = module.fit(docs.select("doc_id", "text"), labels)
        out = module.score(docs, model)
        assert dict(out.dtypes) == {"doc_id": "bigint", "text": "string", "score": "double"} and all(0 <= r.score <= 1 for r in out.collect())
        assert module.score(docs.limit(0), module.fit(docs.select("doc_id", "text"), labels.limit(0))).collect() == []


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert 0.5 * before < docs.count() <= before, name
        before = docs.count()
    whole = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, tuple(r.pieces)) for r in whole.collect()) == sorted((r.doc_id, tuple(r.pieces)) for r in docs.collect())


def test_pipeline_decisions(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    clean = "In the long run a quiet river meets the sea and nobody there is counting the days that it takes."
    rows = [(10**6, clean), (10**6 + 1, clean), (10**6 + 2, f"Before. {item} After."), (10**6 + 3, "Write to me at a@b.example please, it is a quiet place."), (None, f"x {item}"), (None, "Call +1 (555) 555-0100 or so"), (10**6 + 4, None), (10**6 + 5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    got = sorted(((r.doc_id % 10**6, r.text, r.n_chars) for r in docs.collect() if r.doc_id), key=str)
    assert got == sorted([(0, clean, len(clean)), (3, "Write to me at <EMAIL> please, it is a quiet place.", 51), (5, "", 0)] + [(4, None, None)], key=str)
    assert [r.text for r in docs.collect() if r.doc_id is None] == ["Call <PHONE> or so"]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0
