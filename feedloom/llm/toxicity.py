"""Toxicity: a support vector machine on a gap-weighted subsequence kernel with Nyström landmarks.

The string kernel of two words is the sum over all sequences of three signs that both contain, gaps allowed, of DECAY to the span in either
word (spans of at most SPAN signs), over the norms of both words, so that it is 1 for equal ones. A word's signs are its letters between two border signs.
DECAY is near 1, so that a letter put in or left out moves a word little, and the machine's kernel is a radial one on top,
exp(-SHARPNESS * (1 - K)), which is small for words that only share a few sequences. A word's letters are folded (case, digits that stand for letters; an
accent is a sign after its letter); punctuation inside of a word is passed over and runs of single letters are read as one word, so that spelled-out
insults are words too. Words longer than WINDOW signs are read in overlapping windows, and the best window counts, in learning as in scoring.
An insult of several words is met by its single words only.

Learning, on a bounded sample of labelled rows (equal texts count once): labels are those of whole documents. A sentence of a toxic document is
labelled toxic if a word of it has a mark: it, or a stem of it, is over 50 times as frequent among toxic documents as among clean ones. The marked words of those sentences are
the positive examples, the other words of clean documents the negative ones, each weighed by the root of its number of sentences or texts. No edited word is made up for learning: the tolerance is the kernel's.
LANDMARKS words (positive ones, by pivoted Cholesky steps where there are too many, and the clean words nearest to them) span the Nyström features
kappa(x, L) kappa(L, L)^-1/2, on which a squared-hinge SVM is fitted. Clean words whose string kernel with all positive landmarks is below CLOSE differ
little from one another to this machine: one row of no kernel at all stands for them. Like positive landmarks are a group, and a word belongs to the group of the landmark nearest to it. A group's
cut between clean and toxic words is read from clean documents that were held out in turn (FOLDS parts): it flags a share of FALSE of them, unless
that misses too many toxic ones. A margin counts from its group's cut on.

A sentence's score is that of its highest word, a document's that of its highest sentence, by a logistic that is one half at the cut. For most
words sums of table entries, one per subsequence and group of like landmarks, bound the kernel with every positive landmark; words whose bound is below NEAR have the bias, less the highest cut, as margin.

Null texts count as empty; empty texts score 0. Without labelled rows of both classes, every score is the share of toxic rows (0 without any label).
Repeated rows get equal scores; all sentences of a text are read, of any length.
"""

from __future__ import annotations

import pickle
import re
import unicodedata
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import blocks, held_out, schema_with, table, with_columns
from feedloom.llm.labels import labelled_sample

#: Labelled rows per class that the fit may use.
SAMPLE = 2000
LANDMARKS = 256
DECAY, SPAN, WINDOW = 0.9, 8, 16
SHARPNESS, COST = 4.0, 1000.0
#: String kernels with positive landmarks from which on a clean word is an example of its own, and a word is scored by the machine.
CLOSE, NEAR = 0.3, 0.5
STEM = 5
#: Parts of the clean documents that are held out in turn, the share of them that the cut may flag, and its distance to the highest of the others.
FOLDS, FALSE, GAP = 3, 0.0002, 0.15
THRESHOLD = 0.5
#: Words whose scores a task keeps.
CACHE = 150_000

_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
#: Signs that are taken off at both ends whatever stands there.
_EDGES = ".,;:!?\"'()[]{}*|/-"
_FRONT = re.compile(r"[^\w@$]+")
#: Accents are signs of their own, after their letter: acute, grave, circumflex, others.
_ACCENTS = {c: "\x7f" for c in range(0x300, 0x370)} | {0x301: "|", 0x300: "}", 0x302: "~"} | dict.fromkeys(map(ord, "{|}~\x7f"))
_LETTER, _OTHER = re.compile(r"[^\W\d_]"), re.compile(r"[^a-z|}~\x7f]+")
_SINGLE = re.compile(r"(?<!\S)(?:[^\W_][ \t.\-_*]+){2,}[^\W_](?!\S)")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def fold_word(word: str) -> str:
    """The signs of a word: letters a-z, accents, and digits and punctuation inside of it for the letters they stand for."""
    word = word.lower()
    if (plain := word.strip(_EDGES)).isascii() and plain.isalpha():
        return plain
    if front := _FRONT.match(word):
        word = word[front.end():]
    end = len(word)
    while end and not (word[end - 1].isalnum() or word[end - 1] == "_"):
        end -= 1
    word = word[:end]
    if not word.isascii():
        word = unicodedata.normalize("NFKD", word.replace("ß", "ss"))
    word = word.translate(_ACCENTS)
    if _LETTER.search(word):
        word = word.translate(_LEET)
    return _OTHER.sub("", word)


def words_of(text: str) -> set[str]:
    """The distinct words of a text, and its runs of single letters as words."""
    words = set(text.lower().split())
    if any(len(w) < 2 for w in words):
        words.update(re.sub(r"[\W_]+", "", m) for m in _SINGLE.findall(text.lower()))
    return words


def _combos(n: int) -> np.ndarray:
    return np.array([c for c in combinations(range(n), 3) if c[2] - c[0] < SPAN]).reshape(-1, 3)


SIGNS = 31
_PLACES = {n: _combos(n) for n in range(3, WINDOW + 1)}
_DECAYS = {n: (DECAY ** (c[:, 2] - c[:, 0] + 1.0)).astype(np.float32) for n, c in _PLACES.items()}


def windows(letters: str) -> list[str]:
    """A word's signs in windows of at most WINDOW; none for words of under two letters."""
    if len(letters) < 2:
        return []
    signs = "{" + letters + "{"
    if len(signs) <= WINDOW:
        return [signs]
    return [signs[i:i + WINDOW] for i in range(0, len(signs) - WINDOW // 2, WINDOW // 2)]


def subsequences(parts: list[str]) -> np.ndarray:
    """(windows, places) numbers of the subsequences of windows of equal length."""
    codes = np.frombuffer("".join(parts).encode(), np.uint8).reshape(-1, len(parts[0])).astype(np.uint16) - 97
    a, b, c = _PLACES[codes.shape[1]].T
    return (codes[:, a] * SIGNS + codes[:, b]) * SIGNS + codes[:, c]


def norms(numbers: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Norms of windows: a subsequence that occurs at several places weighs the sum of them."""
    order = np.argsort(numbers, axis=1, kind="stable")
    ordered = np.take_along_axis(numbers, order, 1)
    new = np.ones(ordered.shape, bool)
    new[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    starts = np.flatnonzero(new)
    totals = np.add.reduceat(weight[order].ravel(), starts)
    return np.sqrt(np.bincount(starts // ordered.shape[1], totals * totals)).astype(np.float32)


def by_length(words: list[str]):
    """(rows, numbers, weights) of all windows of words, a group per length and 2048 windows; rows ascend, words without a window are left out."""
    groups: dict[int, tuple[list[int], list[str]]] = {}
    for i, w in enumerate(words):
        for part in windows(w):
            at = groups.setdefault(len(part), ([], []))
            at[0].append(i)
            at[1].append(part)
    for n, (rows, parts) in groups.items():
        for k in range(0, len(parts), 2048):
            yield np.array(rows[k:k + 2048]), subsequences(parts[k:k + 2048]), _DECAYS[n]


def features(words: list[str]) -> np.ndarray:
    """The explicit features of words of one window each (a column per word): the string kernel is their product."""
    out = np.zeros((SIGNS**3, len(words)), np.float32)
    for rows, numbers, weight in by_length(words):
        for r, i, norm in zip(rows, numbers, norms(numbers, weight), strict=True):
            np.add.at(out[:, r], i, weight / norm)
    return out


def _best(out: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Raises rows of out to values; a word's windows are neighbours."""
    first = np.flatnonzero(np.diff(rows, prepend=-1))
    if len(first) < len(rows):
        values = np.maximum.reduceat(values, first)
    out[rows[first]] = np.maximum(out[rows[first]], values)


def _sums(numbers: np.ndarray, weight: np.ndarray, right: np.ndarray) -> np.ndarray:
    total = np.zeros((len(numbers), right.shape[1]), np.float32)
    for p, w in enumerate(weight):
        total += w * right[numbers[:, p]]
    return total


def kernel(words: list[str], right: np.ndarray, where: np.ndarray | None = None) -> np.ndarray:
    """The string kernel of words (the best of their windows) with those of features(): a row per word. where: right is packed()."""
    out = np.zeros((len(words), right.shape[1]), np.float32)
    for rows, numbers, weight in by_length(words):
        _best(out, rows, _sums(numbers if where is None else where[numbers], weight, right) / norms(numbers, weight)[:, None])
    return out


def packed(dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of features() that are not empty, after an empty one, and where each subsequence has its row."""
    rows = np.flatnonzero(dense.any(axis=1))
    where = np.zeros(len(dense), np.int32)
    where[rows] = np.arange(1, len(rows) + 1)
    return np.concatenate([np.zeros((1, dense.shape[1]), dense.dtype), dense[rows]]), where


def bound(words: list[str], most: np.ndarray) -> np.ndarray:
    """What the string kernel of words with the landmarks behind envelope() cannot exceed. A norm is at least that of a window without repeats."""
    out = np.zeros(len(words), np.float32)
    for rows, numbers, weight in by_length(words):
        _best(out, rows, _sums(numbers, weight, most).max(axis=1) / np.sqrt((weight * weight).sum()))
    return out


def alike(dense: np.ndarray, most: int = 16) -> np.ndarray:
    """A group number for each word of features(): the nearest of at most so many leaders, each far from those before it."""
    near = dense.T @ dense
    leaders = [0]
    while len(leaders) < min(most, len(near)):
        leaders.append(int(near[:, leaders].max(axis=1).argmin()))
    return np.unique(near[:, leaders].argmax(axis=1), return_inverse=True)[1]


def envelope(dense: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The largest features of the words of features() in each group."""
    return np.ascontiguousarray(np.column_stack([dense[:, group == g].max(axis=1) for g in range(group.max() + 1)]))


class Model:
    """Landmarks (the positive ones first) with their weights, a bias, and a cut per group of like positive landmarks. Tables are made where it is used."""

    def __init__(self, landmarks: list[str], group: np.ndarray, weights: np.ndarray, bias: float, cuts: np.ndarray):
        self.landmarks, self.group, self.weights, self.bias, self.cuts = landmarks, group, weights.astype(np.float32), bias, cuts
        self.low = min(bias - float(cuts.max()), -GAP)
        self.tables = None

    def __getstate__(self):
        return self.__dict__ | {"tables": None}

    def margins(self, folded: list[str]) -> np.ndarray:
        """Margins of folded words beyond the cut of the positive landmark nearest to them; words of under 2 letters have the least margin."""
        n = len(self.group)
        if self.tables is None:
            dense = features(self.landmarks)
            self.tables = *packed(dense), envelope(dense[:, :n], self.group)
        dense, where, most = self.tables
        out = np.array([self.low if len(f) > 1 else -10.0 for f in folded])
        near = np.flatnonzero(bound(folded, most) >= NEAR)
        for k in range(0, len(near), 2048):
            at = near[k:k + 2048]
            like = kernel([folded[i] for i in at], dense, where)
            out[at] = (np.exp(SHARPNESS * (like - 1)) * self.weights).sum(axis=1) + self.bias - self.cuts[self.group[like[:, :n].argmax(axis=1)]]
        return out

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return np.where(margins <= -10, 0.0, 1 / (1 + np.exp(-np.clip(4.0 * margins, -40, 40))))


class Constant:
    """Where labels of one class only are known."""

    def __init__(self, share: float):
        self.share = share

    def margins(self, folded):
        return np.zeros(len(folded))

    def probability(self, margins):
        return np.full(len(margins), self.share)


class Scorer:
    """Margins of texts: the highest word, with a bounded store of the words met."""

    def __init__(self, model):
        self.model, self.known = model, {}

    def margins(self, texts: list[str]) -> np.ndarray:
        sets = [words_of(t) for t in texts]
        if len(self.known) > CACHE:
            self.known = {}
        new = [w for w in set().union(*sets) if w not in self.known]
        folded = [fold_word(w) for w in new]
        distinct = list(dict.fromkeys(folded))
        margin = dict(zip(distinct, self.model.margins(distinct).tolist(), strict=True))
        self.known.update(zip(new, map(margin.__getitem__, folded), strict=True))
        get = self.known.__getitem__
        return np.array([max(map(get, s), default=-10.0) for s in sets])


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM of weighted rows, by Newton steps over the rows within the margin."""
    x = np.column_stack([x, np.ones(len(x))])
    s, weight = np.where(y > 0, 1.0, -1.0), weight * COST
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for step in range(60):
        active = s * (x @ w) < 1
        xa, wa = x[active], weight[active]
        new = np.linalg.solve(ridge + (xa * wa[:, None]).T @ xa, (xa * wa[:, None]).T @ s[active])
        if np.abs(new - w).max() < 1e-6 * np.abs(w).max():
            break
        w = 0.5 * w + 0.5 * new if step > 10 else new
    return w[:-1], float(w[-1])


def _stems(word: str) -> set[str]:
    return {word[i:i + STEM] for i in range(max(1, len(word) - STEM + 1))}


def _telling(toxic, clean, n_toxic: int, n_clean: int):
    """Whether the share among toxic texts is over 50 times that among clean ones."""
    return toxic / n_toxic > 50 * (clean + 0.5) / n_clean


def _examples(texts: list[str], y: np.ndarray):
    """(positive words with counts, distinct words, word numbers of each text): see the module's text."""
    numbers: dict[str, int] = {}
    folded: dict[str, int] = {}
    docs = []
    for text in texts:
        found = set()
        for w in words_of(text):
            if (k := folded.get(w)) is None:
                f = fold_word(w)
                k = folded[w] = numbers.setdefault(f, len(numbers)) if len(f) > 1 else -1
            found.add(k)
        found.discard(-1)
        docs.append(np.array(sorted(found), np.int32))
    words = list(numbers)
    n_toxic, n_clean = int(y.sum()), int(len(y) - y.sum())
    stems: dict[str, int] = {}
    of_word = [[stems.setdefault(x, len(stems)) for x in _stems(w)] if len(w) >= 4 else [] for w in words]
    size = np.array([len(x) for x in of_word])
    flat, first = np.array([k for x in of_word for k in x], np.int32), np.cumsum(size) - size

    def texts_with(wanted: int) -> np.ndarray:
        """How many texts of a label have each stem."""
        counts = np.zeros(len(stems), np.int64)
        for d, label in zip(docs, y, strict=True):
            if label == wanted and size[d].sum():
                n = size[d]
                counts[np.unique(flat[np.repeat(first[d] - np.cumsum(n) + n, n) + np.arange(n.sum())])] += 1
        return counts

    toxic, clean = texts_with(1), texts_with(0)
    is_mark = (toxic >= max(3, 0.01 * n_toxic)) & _telling(toxic, clean, n_toxic, n_clean)
    marks = {x for x, k in stems.items() if is_mark[k]}
    counts = [np.zeros(len(words), np.int64) for _ in range(2)]
    for d, label in zip(docs, y, strict=True):
        counts[label][d] += 1
    own = (counts[1] >= 3) & _telling(counts[1], counts[0], n_toxic, n_clean)
    marked = {k for k, x in enumerate(of_word) if x and (own[k] or not counts[0][k] and any(is_mark[i] for i in x))}
    # Sentences of toxic documents with a marked word, each once, as near copies of a document share theirs.
    seen: set[str] = set()
    found: Counter = Counter()
    for text, d, label in zip(texts, docs, y, strict=True):
        if label and not marked.isdisjoint(d.tolist()):
            for s in _SENTENCE.split(text):
                got = {k for w in words_of(s) if (k := folded.get(w, -1)) in marked}
                if got and s not in seen:
                    seen.add(s)
                    found.update(got)
    # A marked word of one sentence only is chance more often than not.
    positive = {words[k]: n for k, n in found.items() if n > 1}
    in_clean = counts[0] > 0
    in_clean[[k for k in found if words[k] in positive]] = False
    return positive, marks, words, in_clean, docs


def _core(word: str, marks: set[str]) -> str:
    """The part of a long word that stands for it as a landmark: the window's letters that hold most marks."""
    parts = [p.strip("{") for p in windows(word)]
    return max(parts, key=lambda p: len(_stems(p) & marks))


def _pivots(words: list[str], weight: np.ndarray, most: int) -> list[int]:
    """At most so many words that span the others best: Cholesky steps, each by the largest weighted rest."""
    rest, rows, chosen = np.ones(len(words)), np.zeros((len(words), 0)), []
    while len(chosen) < most and (rest > 1e-6).any():
        i = int(np.argmax(rest * weight))
        column = kernel(words, features([words[i]]))[:, 0] - rows @ rows[i]
        rows = np.column_stack([rows, column / np.sqrt(max(column[i], 1e-9))])
        rest = np.maximum(rest - rows[:, -1] ** 2, 0)
        rest[i] = 0
        chosen.append(i)
    return chosen


def train(texts: list[str], y: np.ndarray):
    """The model of labelled documents; see the module's text. A text with both labels is toxic."""
    if not len(y) or not 0 < y.sum() < len(y):
        return Constant(float(y.mean()) if len(y) else 0.0)
    label: dict[str, int] = {}
    for t, k in zip(texts, y.tolist(), strict=True):
        label[t] = max(k, label.get(t, 0))
    texts, share = list(label), float(y.mean())
    y = np.array(list(label.values()))
    positive, marks, words, in_clean, docs = _examples(texts, y)
    if not positive or y.all():
        return Constant(share)
    pos = sorted(positive, key=lambda w: (-positive[w], w))
    weight = np.sqrt([positive[w] for w in pos])
    cores = [_core(w, marks) for w in pos]
    chosen = list(dict.fromkeys(cores[i] for i in (_pivots(cores, weight, LANDMARKS * 2 // 3) if len(pos) > LANDMARKS * 2 // 3 else range(len(pos)))))
    dense = features(chosen)
    group = alike(dense)
    # Clean words near a positive landmark, and how many texts have each.
    of = np.flatnonzero(in_clean)
    of = of[bound([words[k] for k in of], envelope(dense, group)) >= CLOSE]
    like = [kernel([words[k] for k in of[i:i + 2048]], dense) for i in range(0, len(of), 2048)]
    highest, nearest = (np.concatenate([f(x, axis=1) for x in like]) if like else np.empty(0, t) for f, t in ((np.max, float), (np.argmax, int)))
    of, nearest, highest = (x[highest >= CLOSE] for x in (of, nearest, highest))
    texts_of = np.bincount(np.concatenate([d for d, k in zip(docs, y, strict=True) if not k]), minlength=len(words))
    order = np.lexsort((of, -highest))
    landmarks = list(dict.fromkeys(chosen + [_core(words[of[i]], marks) for i in order[:LANDMARKS]]))[:LANDMARKS]
    dense = features(landmarks)
    radial = lambda x: np.exp(SHARPNESS * (kernel(x, dense).astype(float) - 1))
    values, vectors = np.linalg.eigh(radial(landmarks))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    xp, xn = radial(pos) @ root, radial([words[k] for k in of]) @ root
    wp, wn = weight / weight.sum(), np.sqrt(texts_of[of])
    wn = 0.01 * wn / max(wn.mean(), 1e-9) if len(wn) else wn
    # Any number of far clean words are one row: of no kernel with any landmark.
    far = np.zeros((1, len(landmarks)))

    def fit_on(rows):
        return _svm(np.concatenate([xp, far, xn[rows]]), np.concatenate([np.ones(len(xp)), np.zeros(1 + len(rows))]), np.concatenate([wp, [1.0], wn[rows]]))

    # Margins of the documents' words by group: of clean ones by the machine that has not seen the words that only their part has.
    n_groups = int(group.max()) + 1
    tops = np.full((len(y), n_groups), -np.inf)
    place = np.full(len(words), -1)
    place[of] = np.arange(len(of))
    part = np.cumsum(1 - y) % FOLDS
    for f in range(FOLDS):
        others = np.zeros(len(words), bool)
        for d, k, p in zip(docs, y, part, strict=True):
            if not k and p != f:
                others[d] = True
        w, bias = fit_on(np.flatnonzero(others[of]))
        margins = xn @ w + bias
        for i in np.flatnonzero((y == 0) & (part == f)):
            at = place[docs[i]]
            np.maximum.at(tops[i], group[nearest[at[at >= 0]]], margins[at[at >= 0]])
    w, bias = fit_on(np.arange(len(of)))
    margins, home = xp @ w + bias, group[kernel(pos, dense[:, :len(chosen)]).argmax(axis=1)]
    number = {w: k for k, w in enumerate(words)}
    place[:] = -1
    place[[number[w] for w in pos]] = np.arange(len(pos))
    for i in np.flatnonzero(y == 1):
        at = place[docs[i]]
        np.maximum.at(tops[i], home[at[at >= 0]], margins[at[at >= 0]])
    cuts = np.array([_cut(tops[:, g], y, bias) for g in range(n_groups)])
    return Model(landmarks, group, root @ w, bias, cuts)


def _cut(margins: np.ndarray, y: np.ndarray, bias: float) -> float:
    """The cut of least cost, the lowest of equals: missed toxic documents, and clean ones flagged beyond a share of FALSE at tenfold.

    margins are those of the words of one group, -inf in documents without such words. The cut is above the bias, which far words have."""
    clean, toxic = np.sort(margins[y == 0]), np.sort(margins[(y == 1) & np.isfinite(margins)])
    cuts = np.unique(np.concatenate([clean[np.isfinite(clean)], [bias + GAP]]))
    cuts = cuts[cuts >= bias + GAP]
    missed = np.searchsorted(toxic, cuts, side="right") / max(1, (y == 1).sum())
    false = 1 - np.searchsorted(clean, cuts, side="right") / len(clean)
    least = float(cuts[np.lexsort((cuts, np.round(missed + 10 * np.maximum(false - FALSE, 0), 9)))[0]])
    above = toxic[toxic > least]
    return least + min(GAP, (float(above[0]) - least) / 2 if len(above) else GAP)


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", sample: int = SAMPLE):
    """The model of a bounded labelled sample of at most 2 * sample texts. It is trained by one task; only the landmarks and their weights come to the driver."""
    def run(batches):
        rows = pa.Table.from_batches(list(batches), pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("label", pa.int32())])).sort_by([("doc_id", "ascending"), ("text", "ascending")])
        model = train([t or "" for t in rows.column("text").to_pylist()], np.array(rows.column("label").to_pylist(), int))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    rows = labelled_sample(docs, labels, target, sample).select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("label").cast("int"))
    found = rows.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(found[0]) if found else Constant(0.0)


def score(docs: DataFrame, model, text_col: str = "text", out: str = "score") -> DataFrame:
    """docs with a score column (in place of one of that name)."""
    def run(batches):
        scorer = Scorer(model)
        for whole in batches:
            for part in blocks(whole, text_col):
                margins = scorer.margins([t or "" for t in part.column(part.schema.get_field_index(text_col)).to_pylist()])
                yield with_columns(part, {out: pa.array(model.probability(margins))})

    return docs.mapInArrow(run, schema_with(docs, {out: "double"}))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
