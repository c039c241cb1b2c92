"""A learned detector ("data quality ml"): isolation forest.

Rows that few random splits set apart are unusual. The forest is grown on a bounded sample
(``trees * sample`` rows at most, each tree on ``sample`` of them, chosen by a hash of the row, so a
rerun grows the same forest), which is all that reaches the driver. Scoring is a Spark expression,
nested conditions per tree, evaluated in the JVM over all rows: no shuffle, no Python.

A row's score is ``2 ** (-mean path length / c)``, with ``c`` the mean path length of an unsuccessful
search among ``sample`` rows: near 1 for rows that are set apart at once, about 0.5 for ordinary ones. Rows whose
score reaches that of the ``contamination`` most unusual of the sample, and ``LEAST``, are anomalies.

Defined results: a null or NaN goes to the lower side of every split, so that nulls where values are
usual count as unusual; an infinite value is a value; an empty or constant frame has no
anomalies; columns that are not named take no part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TREES = 100
SAMPLE = 64
CONTAMINATION = 0.005
LEAST = 0.6


def mean_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of ``n`` rows."""
    if n < 2:
        return 0.0
    return 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


@dataclass(frozen=True)
class Split:
    feature: int
    below: float  # rows under this value, and nulls, go left
    left: "Split | float"  # a leaf is its path length
    right: "Split | float"


def grow(x: np.ndarray, depth: int, limit: int, rng: np.random.Generator) -> Split | float:
    """A tree over the rows of ``x`` (nulls as NaN)."""
    if len(x) <= 1 or depth >= limit:
        return depth + mean_path(len(x))
    options = []
    for f in range(x.shape[1]):
        known = x[np.isfinite(x[:, f]), f]
        if len(known) and (known.min() < known.max() or len(known) < len(x)):
            options.append((f, float(known.min()), float(known.max())))
    if not options:
        return depth + mean_path(len(x))
    f, low, high = options[rng.integers(len(options))]
    cut = low if low == high else float(rng.uniform(np.nextafter(low, high), high))
    with np.errstate(invalid="ignore"):
        left = ~(x[:, f] >= cut)
    if left.all() or not left.any():
        return depth + mean_path(len(x))
    return Split(f, cut, grow(x[left], depth + 1, limit, rng), grow(x[~left], depth + 1, limit, rng))


class IsolationForest:
    def __init__(self, features: Sequence[str], trees: Sequence[Split | float], sample: int, threshold: float):
        self.features, self.trees, self.sample, self.threshold = list(features), list(trees), sample, threshold

    @classmethod
    def fit(cls, df: DataFrame, features: Sequence[str], trees: int = TREES, sample: int = SAMPLE, contamination: float = CONTAMINATION, seed: int = 42, id_columns: Sequence[str] = ()) -> IsolationForest:
        """``id_columns`` set rows with equal features apart when the sample is chosen."""
        values = [F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)]
        order = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in [*id_columns, *features]])
        # each task keeps that many rows, and so does the driver
        rows = df.select(*values, order.alias("_o")).orderBy("_o").limit(trees * sample).drop("_o").toArrow()
        x = np.column_stack([c.to_numpy().astype(float) if c.null_count == 0 else np.array([np.nan if v is None else v for v in c.to_pylist()], float) for c in rows.columns]) if rows.num_rows else np.zeros((0, len(values)))
        rng = np.random.default_rng(seed)
        x = x[rng.permutation(len(x))]
        size = min(sample, len(x))
        limit = max(1, math.ceil(math.log2(max(size, 2))))
        grown = []
        for t in range(trees if size > 1 else 0):
            some = x[t * size : (t + 1) * size] if (t + 1) * size <= len(x) else x[rng.choice(len(x), size, replace=False)]
            grown.append(grow(some, 0, limit, rng))
        forest = cls(features, grown, size, 1.0)
        if grown:
            scores = np.sort([forest.score_row(r) for r in x])
            forest.threshold = max(LEAST, float(scores[min(len(scores) - 1, int((1 - contamination) * len(scores)))]))
        return forest

    def score_row(self, row: np.ndarray) -> float:
        """The score of one sampled row (the fit's threshold)."""
        total = 0.0
        for node in self.trees:
            while isinstance(node, Split):
                node = node.right if row[node.feature] >= node.below else node.left
            total += node
        return 2.0 ** (-total / len(self.trees) / mean_path(self.sample))

    def _length(self, node: Split | float) -> str:
        if not isinstance(node, Split):
            return f"{node!r}D"
        return f"CASE WHEN _f{node.feature} >= {node.below!r}D THEN {self._length(node.right)} ELSE {self._length(node.left)} END"

    def score(self, df: DataFrame, score_column: str = "score", flag_column: str = "is_anomaly") -> DataFrame:
        """``df`` with the score of every row and whether it is an anomaly."""
        if not self.trees:
            return df.withColumns({score_column: F.lit(0.0), flag_column: F.lit(False)})
        # NaN counts as null here, and a comparison with null takes the lower side
        values = {f"_f{i}": F.nullif(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for i, c in enumerate(self.features)}
        # within a lambda, as trees together are more code than a generated method may have
        lengths = [F.expr(self._length(t)) for t in self.trees]
        total = F.element_at(F.transform(F.array(F.lit(0)), lambda _: sum(lengths[1:], lengths[0])), 1)
        scored = F.pow(F.lit(2.0), -total / F.lit(len(self.trees) * mean_path(self.sample)))
        out = df.withColumns(values).withColumn(score_column, scored).drop(*values)
        return out.withColumn(flag_column, F.col(score_column) >= F.lit(self.threshold))


def learned_outliers(df: DataFrame, features: Sequence[str], contamination: float = CONTAMINATION, seed: int = 42, id_columns: Sequence[str] = ()) -> DataFrame:
    """All rows of ``df`` with ``score`` and ``is_anomaly``, by a forest grown on a sample of them."""
    return IsolationForest.fit(df, features, contamination=contamination, seed=seed, id_columns=id_columns).score(df)
