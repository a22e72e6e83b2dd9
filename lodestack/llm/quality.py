"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Sums of the statistics and of their products, per class, are all that training needs: they are added up in
Spark and only d + d*d numbers a class reach the driver. Class covariances are shrunk towards the pooled one and
that towards a multiple of the identity; the score is the difference of log densities from Mahalanobis
distances under the cached Cholesky factors, turned into a probability by a logistic fit on binned differences.

Defined results: a null text is empty and has all statistics zero; null labels are not learned from; with no
labels, or none of one class, every score is the share of label 1 (0.5 without labels); equal texts get equal scores;
very long texts are measured whole; existing columns of the names given for the outputs are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows to fit on at most, taken by hash of the key; all where there are fewer.
TRAIN_ROWS = 200_000
SHRINK_TO_POOLED = 0.1
SHRINK_TO_IDENTITY = 0.02
BIN = 0.25
MOST = 40.0
ACCEPT = 0.3

_CLASS = np.zeros(256, np.int64)  # 0 other, 1 lower, 2 upper, 3 digit, 4 blank, 5 stop mark, 6 shout, 7 symbol, 8 beyond ASCII
for _codes, _kind in ((range(97, 123), 1), (range(65, 91), 2), (range(48, 58), 3), (b" \t\r\x0b\x0c\n", 4), (b".,;:'-\"()", 5), (b"!?", 6), (b"#$%&*+/<=>@[\\]^_`{|}~", 7), (range(128, 256), 8)):
    _CLASS[list(_codes)] = _kind

STATISTICS = ("length", "words", "word_length", "distinct", "echo", "lines", "line_repeats", "line_length", "lower", "upper", "digits", "blanks", "stops", "shouts", "symbols", "beyond", "spread")


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of one whole text: logarithms of counts and log-odds of shares."""
    if not text:
        return [0.0] * len(STATISTICS)
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    bytes_ = np.bincount(data, minlength=256)
    kinds = np.bincount(_CLASS, weights=bytes_, minlength=9)
    words, lines, n = text.split(), text.split("\n"), len(data)
    k = max(1, len(words))
    lodds = lambda a, b: math.log((a + 0.5) / (b - a + 0.5))
    distinct = len(set(words))
    echo = sum(map(str.__eq__, words, words[1:]))
    share = bytes_[bytes_ > 0] / n
    return [
        math.log1p(n),
        math.log1p(len(words)),
        math.log((n - kinds[4] + 1) / k),
        math.log((distinct + 1) / k) + 0.4 * math.log(k),
        lodds(echo, k),
        math.log1p(len(lines)),
        lodds(len(lines) - len(set(lines)), len(lines)),
        math.log(n / len(lines)),
        *(lodds(kinds[i], n) for i in range(1, 9)),
        float(-(share * np.log(share)).sum()),
    ]


def with_statistics(df: DataFrame, text: str = "text", out: str = "stats") -> DataFrame:
    @F.pandas_udf("array<double>")
    def measure(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts], dtype=object)

    return df.withColumn(out, measure(F.col(text)))


def bounded(df: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows by hash of the key, or all rows where there are fewer."""
    n = df.count()
    return df if n <= bound else df.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 20)) < int((1 << 20) * bound / n))


class Discriminant:
    """Two Gaussian classes with cached Cholesky factors, and a logistic map of the log-density difference."""

    def __init__(self, moments: dict[int, np.ndarray], d: int):
        n = {c: float(m[0]) for c, m in moments.items()}
        self.rate = n.get(1, 0.0) / sum(n.values()) if n else 0.5
        self.ready = min(n.get(0, 0), n.get(1, 0)) >= 2
        self.slope, self.shift = 1.0, 0.0
        if not self.ready:
            return
        means = {c: moments[c][1 : 1 + d] / n[c] for c in (0, 1)}
        covs = {c: moments[c][1 + d :].reshape(d, d) / n[c] - np.outer(means[c], means[c]) for c in (0, 1)}
        pooled = sum(n[c] * covs[c] for c in (0, 1)) / sum(n.values())
        self.scale = np.sqrt(np.maximum(np.diag(pooled), 1e-9))
        self.parts = []
        for c in (0, 1):
            few = d / (d + n[c])  # a class of few rows leans more on the pooled covariance
            a = min(1.0, SHRINK_TO_POOLED + few)
            s = ((1 - a) * covs[c] + a * pooled) / np.outer(self.scale, self.scale)
            s = (1 - SHRINK_TO_IDENTITY) * s + SHRINK_TO_IDENTITY * np.trace(s) / d * np.eye(d)
            factor = np.linalg.cholesky(s)
            self.parts.append((means[c], np.linalg.inv(factor), np.log(np.diag(factor)).sum()))

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density under label 1 less that under label 0."""
        logs = [-0.5 * ((((x - m) / self.scale) @ inverse.T) ** 2).sum(axis=1) - logdet for m, inverse, logdet in self.parts]
        return np.clip(logs[1] - logs[0], -MOST, MOST)

    def calibrate(self, bins: list[tuple[float, float, float]]) -> None:
        """Logistic regression of the label on the difference, from (difference, ones, rows) of each bin."""
        z, ones, rows = np.array(bins, float).T
        w = np.array([0.5, math.log(self.rate / (1 - self.rate))])
        x = np.stack([z, np.ones_like(z)], axis=1)
        for _ in range(50):
            p = 1 / (1 + np.exp(-(x @ w)))
            gradient = x.T @ (rows * p - ones) + 1e-3 * w
            hessian = (x * (rows * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
            w = w - np.clip(np.linalg.solve(hessian, gradient), -1, 1)
        self.slope, self.shift = float(max(w[0], 1e-3)), float(w[1])

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not self.ready:
            return np.full(len(x), self.rate)
        return 1 / (1 + np.exp(-(self.slope * self.difference(x) + self.shift)))


def fit(training: DataFrame, label: str, stats: str = "stats") -> Discriminant:
    """Fits on rows with an array of statistics and a label of 0 or 1."""
    d = len(STATISTICS)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {c: np.zeros(1 + d + d * d) for c in (0, 1)}
        for pdf in batches:
            x, y = np.array(pdf[stats].tolist(), float).reshape(-1, d), pdf[label].to_numpy()
            for c in (0, 1):
                own = x[y == c]
                sums[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        for c, v in sums.items():
            if v[0]:
                yield pd.DataFrame({"label": c, "i": np.arange(len(v)), "v": v})

    rows = training.select(F.col(label).cast("int").alias(label), stats).where(F.col(label).isin(0, 1))
    moments: dict[int, np.ndarray] = {}
    for r in rows.mapInPandas(add, "label int, i int, v double").groupBy("label", "i").agg(F.sum("v").alias("v")).collect():
        moments.setdefault(r["label"], np.zeros(1 + d + d * d))[r["i"]] = r["v"]
    model = Discriminant(moments, d)
    if model.ready:

        @F.pandas_udf("double")
        def binned(x: pd.Series) -> pd.Series:
            return pd.Series(np.round(model.difference(np.array(x.tolist(), float).reshape(-1, d)) / BIN) * BIN)

        bins = rows.withColumn("z", binned(stats)).groupBy("z").agg(F.sum(label).alias("ones"), F.count("*").alias("n")).collect()
        model.calibrate([(b["z"], b["ones"], b["n"]) for b in bins])
    return model


def scored(df: DataFrame, model: Discriminant, stats: str = "stats", out: str = "score") -> DataFrame:
    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.probability(np.array(x.tolist(), float).reshape(-1, len(STATISTICS))))

    return df.withColumn(out, score(F.col(stats)))
