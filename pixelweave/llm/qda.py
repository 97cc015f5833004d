"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

``features`` reads every text once and turns it into NAMES (numpy over whole Arrow batches): logarithms of counts,
square roots of shares. ``fit`` sums moments of the labelled training rows by class and fold in Spark; the driver gets
one row a class, fold and cell of the moments. Each class covariance is shrunk towards the pooled one and that towards
its diagonal; how far is chosen from GRID by the likelihood of each fold under the moments of the others, which needs
moments only. The Cholesky factors of the shrunk covariances are kept. ``score`` is the logistic of the difference of
the two log densities (Mahalanobis distances by forward substitution with the factors, log determinants) and the log
ratio of the priors.

Null texts are empty and have a score like any other; texts of any length are read whole. Labels that are null or
neither 0 nor 1 are left out; equal label rows count once. Without two rows of each class every score is the share of
class 1 among the labels, 0.5 without any. Repeated documents are scored one by one; extra columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batch, id_text, map_batches, slices, table, written
from .hashing import LOWER, U, WHITE, mix, span_hashes, words
from .quality_rules import STOP_WORDS

THRESHOLD = 0.7
#: Weights of the pooled covariance, and of the diagonal, in each class covariance, of which the likeliest are taken.
GRID = [(p, r) for p in (0.02, 0.05, 0.1, 0.2, 0.4, 0.8) for r in (0.005, 0.01, 0.05, 0.1, 0.3)]
FOLDS = 3

NAMES = [
    "log_bytes", "log_words", "mean_word", "spread_word", "upper", "digit", "symbol", "bar", "exclaim", "point", "comma", "break", "other",
    "stop", "distinct_words", "distinct_lines", "distinct_trigrams", "entropy", "long_words", "top_word",
]

_KIND = np.zeros(256, np.uint8)  # byte classes counted for the shares
for _k, _chars in enumerate([b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>", b"|", b"!", b".", b",", b"\n", b"\"'()-/:;=?@[\\]^_`{}~+"], 1):
    _KIND[list(_chars)] = _k


def _stop_hashes() -> np.ndarray:
    text = [w.encode() for w in sorted({w for ws in STOP_WORDS.values() for w in ws})]
    ends = np.cumsum([len(w) for w in text])
    return np.sort(span_hashes(np.frombuffer(b"".join(text), np.uint8), ends - [len(w) for w in text], ends))


STOP_HASHES = _stop_hashes()


def distinct_share(keys: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of keys edges[k] to edges[k + 1]: the share of distinct ones, and that of the most frequent one."""
    share, top = np.ones(len(edges) - 1), np.zeros(len(edges) - 1)
    for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
        if b > a:
            s = np.sort(keys[a:b])
            at = np.flatnonzero(np.r_[True, s[1:] != s[:-1], True])
            share[k], top[k] = (len(at) - 1) / (b - a), np.diff(at).max() / (b - a)
    return share, top


def statistics(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A row of NAMES for each document of a concatenation."""
    n = np.diff(offs)
    docs = len(n)
    doc = np.repeat(np.arange(docs), n)
    kinds = np.bincount(doc * 10 + _KIND[data], minlength=10 * docs).reshape(docs, 10)[:, 1:]
    size = np.maximum(n, 1)
    starts, ends, at = words(data, offs)
    count = np.diff(at)
    length = (ends - starts).astype(float)
    sums = lambda x: np.diff(np.r_[0, np.cumsum(x)][at])
    some = np.maximum(count, 1)
    mean = sums(length) / some
    spread = np.sqrt(np.maximum(sums(length * length) / some - mean * mean, 0))
    one = span_hashes(LOWER[data], starts, ends)
    found = np.minimum(np.searchsorted(STOP_HASHES, one), len(STOP_HASHES) - 1)
    stop = sums((STOP_HASHES[found] == one).astype(float)) / some
    share_words, top = distinct_share(one, at)
    grams = mix(one[:-2] * U(3) + one[1:-1] * U(5) + one[2:] * U(7)) if len(one) > 2 else np.zeros(0, U)
    first = np.minimum(at[:-1], len(grams))
    last = np.minimum(np.maximum(at[1:] - 2, at[:-1]), len(grams))
    share_grams = np.ones(docs)
    for k, (a, b) in enumerate(zip(first.tolist(), last.tolist(), strict=True)):
        if b > a:
            share_grams[k] = len(np.unique(grams[a:b])) / (b - a)
    line_at = np.unique(np.r_[offs, np.flatnonzero(data == 10) + 1])
    line_at = line_at[line_at <= len(data)]
    line = span_hashes(data, line_at[:-1], line_at[1:])
    share_lines, _ = distinct_share(line, np.searchsorted(line_at[:-1], offs))
    joint = np.bincount(doc * 64 + (data >> 2), minlength=64 * docs).reshape(docs, 64) / size[:, None]
    entropy = -np.where(joint > 0, joint * np.log2(np.where(joint > 0, joint, 1)), 0).sum(axis=1)
    long_words = sums((length > 15).astype(float)) / some
    shares = np.sqrt(kinds / size[:, None])
    return np.column_stack([np.log1p(n), np.log1p(count), np.log1p(mean), np.log1p(spread), shares, np.sqrt(stop), np.sqrt(share_words), np.sqrt(share_lines), np.sqrt(share_grams), entropy, np.sqrt(long_words), np.sqrt(top)])


FEATURES = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the array x of NAMES of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in slices(batch):
                yield arrow_batch(FEATURES, doc_id=rows.column(0), x=pa.array(list(statistics(data, offs)), pa.list_(pa.float64())))

    return map_batches(id_text(docs), run, "doc_id long, x array<double>")


def substitute(factor: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Rows y with factor @ y = z for a lower triangular factor and each row z."""
    y = np.empty_like(z)
    for k in range(len(factor)):
        y[:, k] = (z[:, k] - y[:, :k] @ factor[k, :k]) / factor[k, k]
    return y


@dataclass
class Discriminant:
    """Means, lower Cholesky factors and constants of class 0 and 1; none: every score is ``share``."""

    mean: list[np.ndarray] | None
    factor: list[np.ndarray] | None
    constant: list[float] | None
    share: float
    weights: tuple[float, float] | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.mean is None:
            return np.full(len(x), self.share)
        log = [c - 0.5 * (substitute(f, x - m) ** 2).sum(axis=1) for m, f, c in zip(self.mean, self.factor, self.constant, strict=True)]
        return 1 / (1 + np.exp(-np.clip(log[1] - log[0], -30, 30)))


def moments_of(sums: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Number, mean and covariance from (n, sums, sums of products)."""
    d = len(NAMES)
    mean = sums[1 : 1 + d] / sums[0]
    return sums[0], mean, sums[1 + d :].reshape(d, d) / sums[0] - np.outer(mean, mean)


def shrunk(cov: np.ndarray, both: np.ndarray, pooled: float, diagonal: float) -> np.ndarray:
    """Lower Cholesky factor of the regularised covariance."""
    s = (1 - pooled) * cov + pooled * both
    return np.linalg.cholesky((1 - diagonal) * s + diagonal * np.diag(np.maximum(np.diag(both), 1e-12)) + 1e-9 * np.eye(len(s)))


def solved(sums: np.ndarray, pooled: float, diagonal: float) -> tuple[list[np.ndarray], list[np.ndarray], list[float]]:
    """Means, factors and constants from the moments of class 0 and 1."""
    (n0, m0, c0), (n1, m1, c1) = map(moments_of, sums)
    both = (n0 * c0 + n1 * c1) / (n0 + n1)
    factors = [shrunk(c, both, pooled, diagonal) for c in (c0, c1)]
    return [m0, m1], factors, [float(np.log(n / (n0 + n1)) - np.log(np.diag(f)).sum()) for n, f in zip((n0, n1), factors, strict=True)]


def chosen(sums: np.ndarray) -> tuple[float, float]:
    """Of GRID the weights under which each fold's rows are likeliest, given the other folds. sums: class, fold, moments."""
    folds = [k for k in range(FOLDS) if (sums[:, k, 0] > 0).all() and (sums.sum(axis=1)[:, 0] - sums[:, k, 0] >= 2).all()]
    if not folds:
        return 0.1, 0.05

    def likelihood(weights: tuple[float, float]) -> float:
        total = 0.0
        for k in folds:
            means, factors, _ = solved(sums.sum(axis=1) - sums[:, k], *weights)
            for own, m, f in zip(sums[:, k], means, factors, strict=True):
                n, mean, cov = moments_of(own)
                # the mean squared distance is the trace of the products of differences under the inverse
                about = cov + np.outer(mean - m, mean - m)
                distance = np.trace(substitute(f, substitute(f, about).T))
                total -= n * (0.5 * distance + np.log(np.diag(f)).sum())
        return total

    return max(GRID, key=likelihood)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(feats: DataFrame, labels: DataFrame, weights: tuple[float, float] | None = None) -> Discriminant:
    """From rows of labels (doc_id, quality) that aren't held out; weights are chosen where none are given."""
    own = labels.where("quality in (0, 1)").select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("q")).where(~held_out(F.col("doc_id"))).distinct()
    rows = feats.join(own, "doc_id").select("q", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold"), "x")
    d = len(NAMES)
    cells = 1 + d + d * d

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, FOLDS, cells))
        for batch in batches:
            q, fold = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            x = batch.column(2).flatten().to_numpy().reshape(-1, d)
            for c in (0, 1):
                for k in range(FOLDS):
                    some = x[(q == c) & (fold == k)]
                    total[c, k] += np.r_[len(some), some.sum(axis=0), (some.T @ some).ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], names=["cell", "v"])

    sums = np.zeros(2 * FOLDS * cells)
    for r in map_batches(rows, moments, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect():  # as many rows as cells
        sums[r["cell"]] = r["v"]
    sums = sums.reshape(2, FOLDS, cells)
    n = sums[:, :, 0].sum(axis=1)
    share = float(n[1] / n.sum()) if n.sum() else 0.5
    if n.min() < 2:
        return Discriminant(None, None, None, share)
    weights = weights or chosen(sums)
    return Discriminant(*solved(sums.sum(axis=1), *weights), share, weights)


SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    feats = written(features(docs), "features")
    model = fit(feats, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(NAMES))
            yield arrow_batch(SCORES, doc_id=batch.column(0), score=np.round(model.score(x), 6))

    scored = map_batches(feats, run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op3_quality_qda(spark, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
