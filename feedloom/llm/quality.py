"""Quality: regularised quadratic discriminant analysis over transformed document statistics.

Each text gives FEATURES statistics (counts of characters, words and lines), made near normal by logarithms and square roots. Class means and
covariances are fitted on a bounded sample of labelled rows (SAMPLE per class); a class covariance is shrunk towards the pooled one and
towards a multiple of the identity. The score of a text is the logistic of the difference of the two Mahalanobis log densities,
from Cholesky factors that are made once, with a slope and an intercept fitted on the same sample.

Null texts count as empty; empty texts have a score like any other. Labels, language, source and id are no features. If a
class has no labelled row, every score is the share of the other class (0.5 without any label). Repeated rows get equal scores; texts of any
length are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import blocks, held_out, schema_with, table, with_columns, word_hashes
from feedloom.llm.labels import labelled_sample

#: Labelled rows per class that the fit may use.
SAMPLE = 8000
#: Shares of the pooled covariance and of the identity in a class covariance.
TO_POOLED, TO_IDENTITY = 0.1, 0.01
THRESHOLD = 0.3

FEATURES = ("words", "chars_per_word", "upper", "digits", "symbols", "pipes", "stops", "distinct", "top_word", "lines", "line_words", "repeated_lines", "symbol_ends", "capital_words", "upper_words")

_KIND = np.zeros(256, np.int64)  # 0 other, 1 upper, 2 digit, 3 symbol, 4 pipe, 5 stop
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:|'\"-()"]] = 3
_KIND[ord("|")] = 4
_KIND[[ord(c) for c in ".!?"]] = 5


def statistics(texts: list[bytes]) -> np.ndarray:
    """The transformed statistics of some texts: a row each."""
    n = len(texts)
    hashes, words = word_hashes(texts)
    sizes = np.array([len(t) for t in texts])
    raw = np.frombuffer(b"".join(texts), np.uint8)
    owner = np.repeat(np.arange(n), sizes)
    kinds = np.bincount(owner * 6 + _KIND[raw], minlength=6 * n).reshape(n, 6)
    # Words: which begin with a capital, which are all capitals, which end in a symbol.
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.ones(len(raw) + 1, bool)
    edge[1:-1] = space[1:] | space[:-1]
    edge[np.cumsum(sizes)] = True
    edge[0] = True
    bounds = np.flatnonzero(edge)
    starts, ends = bounds[:-1], bounds[1:]
    solid = ~space[starts] if len(starts) else np.empty(0, bool)
    starts, ends = starts[solid], ends[solid]
    word_owner = owner[starts] if len(starts) else np.empty(0, np.int64)
    per = lambda mask: np.bincount(word_owner[mask], minlength=n)
    kind = _KIND[raw]
    uppers = np.concatenate([[0], np.cumsum(kind == 1)])
    lowers = np.concatenate([[0], np.cumsum((raw >= 97) & (raw <= 122))])
    up, low = uppers[ends] - uppers[starts], lowers[ends] - lowers[starts]
    capital, shout = per(kind[starts] == 1) if len(starts) else np.zeros(n), per((up > 1) & (low == 0))
    symbol_end = per((kind[ends - 1] == 3) | (raw[ends - 1] == 33)) if len(starts) else np.zeros(n)
    count = np.bincount(word_owner, minlength=n)
    # Distinct words and the most frequent word of each text.
    key_owner = np.repeat(np.arange(n), words)
    order = np.lexsort((hashes, key_owner))
    h, o = hashes[order], key_owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    runs = np.diff(np.append(np.flatnonzero(new), len(h)))
    distinct, top = np.bincount(o[new], minlength=n), np.zeros(n)
    np.maximum.at(top, o[new], runs)
    lines = np.array([t.count(b"\n") + 1 for t in texts])
    same = np.array([k - len(set(t.split(b"\n"))) if k > 1 else 0 for t, k in zip(texts, lines, strict=True)])
    c, w = np.maximum(sizes, 1), np.maximum(count, 1)
    share = lambda a, b: np.sqrt(a / b)
    return np.column_stack([
        np.log1p(count), np.log1p(sizes / w), share(kinds[:, 1], c), share(kinds[:, 2], c), share(kinds[:, 3], c), share(kinds[:, 4], w), share(kinds[:, 5], w),
        distinct / w, share(top, w), np.log1p(lines), np.log1p(count / lines), share(same, lines), share(symbol_end, w), share(capital, w), share(shout, w),
    ]).astype(float)


class Model:
    """Two normal densities with shrunk covariances, as means and inverse Cholesky factors, and a calibration."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.share = float(y.mean()) if len(y) else 0.5
        self.parts = None
        if len(np.unique(y)) < 2:
            return
        self.centre, self.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        z = (x - self.centre) / self.scale
        covs = [np.cov(z[y == c].T, bias=True) if (y == c).sum() > 1 else np.eye(x.shape[1]) for c in (0, 1)]
        pooled = sum(cov * (y == c).mean() for c, cov in enumerate(covs))
        self.parts = []
        for c, cov in enumerate(covs):
            cov = (1 - TO_POOLED) * cov + TO_POOLED * pooled
            cov = (1 - TO_IDENTITY) * cov + TO_IDENTITY * max(np.trace(cov) / len(cov), 1e-3) * np.eye(len(cov))
            low = np.linalg.cholesky(cov)
            self.parts.append((z[y == c].mean(0), np.linalg.inv(low), float(np.log(np.diag(low)).sum())))
        self.slope, self.shift = _logistic(self._squash(self.difference(x)), y)

    @staticmethod
    def _squash(d):
        return np.arcsinh(d)

    def difference(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        logs = [-0.5 * (((z - mean) @ inv.T) ** 2).sum(1) - det for mean, inv, det in self.parts]
        return logs[1] - logs[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.parts is None:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-np.clip(self.slope * self._squash(self.difference(x)) + self.shift, -40, 40)))


def _logistic(d: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope (kept positive) and intercept by Newton's method, with a little weight on slope 1."""
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * d + b, -40, 40)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - y) * d).sum() + (a - 1), (p - y).sum() + b * 1e-3])
        hess = np.array([[(w * d * d).sum() + 1, (w * d).sum()], [(w * d).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(hess, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 1e-3), b


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", sample: int = SAMPLE) -> Model:
    """The model of a bounded labelled sample; statistics are computed by the tasks, and at most 2 * sample rows come to the driver."""
    def run(batches):
        for whole in batches:
            for part in blocks(whole, "text"):
                x = statistics([t or b"" for t in part.column(0).cast(pa.binary()).to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1]).cast(pa.list_(pa.float64())), part.column(1)], names=["x", "y"])

    rows = labelled_sample(docs, labels, target, sample).select("text", F.col("label").alias("y")).mapInArrow(run, "x array<double>, y int").toArrow()
    x = np.array(rows.column("x").combine_chunks().flatten() if rows.num_rows else [], float).reshape(-1, len(FEATURES))
    y = np.array(rows.column("y").to_pylist(), int)
    order = np.lexsort((*x.T, y))  # sums are then the same whatever the order of the rows
    return Model(x[order], y[order])


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """docs with a score column (in place of one of that name)."""
    def run(batches):
        for whole in batches:
            for part in blocks(whole, text_col):
                x = statistics([t or b"" for t in part.column(part.schema.get_field_index(text_col)).cast(pa.binary()).to_pylist()])
                yield with_columns(part, {out: pa.array(model.score(x))})

    return docs.mapInArrow(run, schema_with(docs, {out: "double"}))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
