"""Linear regressions from sums of products: one aggregation serves every penalty, fold and score.

The means of all products of two features and of features and label, per fold, are all that ridge and lasso need: training sums
are those of the other folds together, and the error on a fold follows from its own sums. The features must be few, as d x d sums
per fold reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Gram:
    """Rows, and means of x x', x y, x, y and y y."""

    n: int
    xx: np.ndarray
    xy: np.ndarray
    x: np.ndarray
    y: float
    yy: float

    @classmethod
    def of(cls, n: int, m: np.ndarray) -> Gram:
        d = round((len(m) - 1) ** 0.5) - 1  # d * d + d + d + 2 entries
        return cls(n, m[: d * d].reshape(d, d), m[d * d : -d - 2], m[-d - 2 : -2], float(m[-2]), float(m[-1]))

    def __add__(self, other: Gram) -> Gram:
        n = self.n + other.n
        both = ((self.n * a + other.n * b) / n for a, b in zip(self._means(), other._means(), strict=True))
        return Gram(n, *both)

    def _means(self) -> tuple:
        return self.xx, self.xy, self.x, self.y, self.yy

    def spread(self) -> np.ndarray:
        return self.xx - np.outer(self.x, self.x)

    def joint(self) -> np.ndarray:
        return self.xy - self.x * self.y

    def fit(self, alpha: float, lasso: bool = False, scaled: bool = False) -> tuple[np.ndarray, float]:
        """Coefficients and intercept for ``alpha`` times the squares of the coefficients beside the summed squared error, or
        with ``lasso`` times their absolute values beside half its mean; ``scaled`` penalises standardised features."""
        spread, joint = self.spread(), self.joint()
        size = np.sqrt(np.diag(spread)) if scaled else np.ones(len(joint))
        size = np.where(size > 0, size, 1.0)
        spread, joint = spread / np.outer(size, size), joint / size
        w = _descend(spread, joint, alpha) if lasso else np.linalg.solve(spread + alpha / self.n * np.eye(len(joint)), joint)
        w = w / size
        return w, float(self.y - w @ self.x)

    def r2(self, w: np.ndarray, intercept: float) -> float:
        """Share of the label's variance that a linear model explains on these rows."""
        off = self.y - intercept - w @ self.x  # mean error
        total = self.yy - self.y**2
        return float(1.0 - (total - 2 * w @ self.joint() + w @ self.spread() @ w + off**2) / total)


def _descend(spread: np.ndarray, joint: np.ndarray, alpha: float, rounds: int = 10_000) -> np.ndarray:
    """Coordinate descent for the lasso on means of products."""
    w = np.zeros(len(joint))
    for _ in range(rounds):
        most = 0.0
        for j in range(len(w)):
            if spread[j, j] > 0:
                rest = joint[j] - spread[j] @ w + spread[j, j] * w[j]
                new = np.sign(rest) * max(abs(rest) - alpha, 0.0) / spread[j, j]
                most, w[j] = max(most, abs(new - w[j])), new
        if most <= 1e-14 * (1.0 + np.abs(w).max()):
            break
    return w


def _products(features: str, label: str):
    x, y = vector_to_array(features), F.col(label).cast("double")
    outer = F.flatten(F.transform(x, lambda a: F.transform(x, lambda b: a * b)))
    return array_to_vector(F.concat(outer, F.transform(x, lambda a: a * y), x, F.array(y, y * y)))


def gram(df: DataFrame, label: str, features: str = "features") -> Gram:
    row = df.agg(Summarizer.mean(_products(features, label)).alias("m"), F.count(F.lit(1)).alias("n")).first()
    return Gram.of(row["n"], row["m"].toArray())


def fold_grams(df: DataFrame, label: str, fold: str, features: str = "features") -> dict[int, Gram]:
    """The sums of every fold, in one scan."""
    rows = df.groupBy(fold).agg(Summarizer.mean(_products(features, label)).alias("m"), F.count(F.lit(1)).alias("n"))
    return {r[fold]: Gram.of(r["n"], r["m"].toArray()) for r in rows.collect()}


def search(
    df: DataFrame, label: str, fold: str, draws: Mapping[str, Sequence[float]], features: str = "features"
) -> tuple[dict[str, tuple[np.ndarray, float]], DataFrame]:
    """All penalties of ``ridge`` and ``lasso`` judged by R² in cross-validation, features standardised in every fit.

    The best model of each kind fitted on all rows, and rows (model, params, mean, std, best); the first best wins.
    """
    folds = fold_grams(df, label, fold, features)
    whole = None
    for g in folds.values():
        whole = g if whole is None else whole + g
    train = {}
    for i in folds:
        rest = [g for j, g in folds.items() if j != i]
        train[i] = sum(rest[1:], rest[0])
    best, rows = {}, []
    for kind, values in draws.items():
        lasso = kind == "lasso"
        scores = np.array([[folds[i].r2(*train[i].fit(a, lasso, True)) for i in sorted(folds)] for a in values])
        mean, std = scores.mean(axis=1), scores.std(axis=1)
        top = int(mean.argmax())
        best[kind] = whole.fit(values[top], lasso, True)
        name = "regParam" if lasso else "alpha"
        rows += [(kind, f"{name}={a}", float(m), float(s), int(j == top)) for j, (a, m, s) in enumerate(zip(values, mean, std, strict=True))]
    return best, df.sparkSession.createDataFrame(rows, "model string, params string, mean double, std double, best int")
