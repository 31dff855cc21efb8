"""Support vector machine with an RBF kernel: Nyström landmarks, hinge loss, calibrated probabilities.

The kernel is taken on a bounded number of landmarks, distinct training vectors drawn by hash; with no more distinct
vectors than that it is exact. The hinge loss is rounded off within ``h`` of its corner and minimised by Newton steps, each
from one scan that adds up losses, slopes and curvatures; ``h`` falls to ``CORNERS[-1]``, where no row's loss is off by more
than half of it. The fits that leave out one fold each, whose decisions calibrate the probabilities, share the scans
of the fit of all rows. Tasks send out one row per fit, of the size of the landmarks' square.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

LANDMARKS = 256
CORNERS = (2.0, 0.3, 0.05, 0.01)
#: Rows of a task that are lifted at a time.
SLICE = 4096
MAX_SCANS = 500
TOLERANCE = 1e-6


@dataclass(frozen=True)
class Lift:
    """Vectors to features whose inner products are the kernel's, as far as the landmarks carry it."""

    landmarks: np.ndarray
    gamma: float
    turn: np.ndarray

    @classmethod
    def fit(cls, rows: DataFrame, size: int = LANDMARKS, gamma: float | str = "scale", seed: int = 42) -> Lift:
        """``rows`` has vectors in ``v``; ``scale`` takes 1 / (d * variance of all entries)."""
        order = F.xxhash64("v", F.lit(seed))
        chosen = rows.select("v").distinct().orderBy(order, "v").limit(size).collect()
        points = np.array([r["v"] for r in chosen], dtype=float)
        if gamma == "scale":
            v = array_to_vector("v")
            n, mean, var = rows.agg(F.count(F.lit(1)), Summarizer.mean(v), Summarizer.variance(v)).first()
            mean, var = mean.toArray(), var.toArray() * (n - 1) / n
            gamma = 1.0 / max(len(mean) * (var.mean() + mean.var()), 1e-300)
        values, vectors = np.linalg.eigh(rbf(points, points, gamma))
        kept = values > values.max() * 1e-12
        return cls(points, float(gamma), vectors[:, kept] / np.sqrt(values[kept]))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """The features, and a one for the offset."""
        z = rbf(x, self.landmarks, self.gamma) @ self.turn
        return np.hstack([z, np.ones((len(x), 1))])


def rbf(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    middle = y.mean(axis=0)
    x, y = x - middle, y - middle
    d2 = (x**2).sum(axis=1)[:, None] + (y**2).sum(axis=1) - 2 * x @ y.T
    return np.exp(-gamma * np.maximum(d2, 0))


def _slices(batches, *columns) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            v = part.column("v")
            x = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)
            yield x, *[part.column(c).to_numpy(zero_copy_only=False) for c in columns]


@dataclass
class Fit:
    """One minimisation: a penalty, the fold it leaves out (None: none), and how far it has come."""

    C: float
    without: int | None
    w: np.ndarray
    corner: int = 0
    value: float | None = None
    step: float = 1.0
    slope: float = 0.0
    move: np.ndarray = field(default=None)
    done: bool = False

    @property
    def asked(self) -> np.ndarray:
        return self.w if self.move is None else self.w + self.step * self.move

    def take(self, loss: float, grad: np.ndarray, hess: np.ndarray) -> None:
        """Judge the asked place: shorten the step if it is no gain, else go there and set the next step or corner."""
        at = self.asked
        weights = np.r_[np.ones(len(at) - 1), 0.0]
        value = 0.5 * weights @ at**2 + self.C * loss
        if self.value is not None and value > self.value + 1e-4 * self.step * self.slope and self.step > 1e-6:
            least = -self.slope * self.step / (2 * (value - self.value - self.slope * self.step))
            self.step *= min(max(least, 0.1), 0.7)
            return
        self.w, self.value, self.step = at, value, 1.0
        slope = weights * at + self.C * grad
        # No penalty holds the offset where no row lies in the rounded corner; the losses do.
        curve = np.diag(np.r_[weights[:-1], 1e-6 + 1e-3 * self.C * loss]) + self.C * hess
        self.move = -np.linalg.solve(curve, slope)
        self.slope = float(slope @ self.move)
        if -self.slope <= TOLERANCE * (1 + abs(value)):
            self.corner, self.move, self.value = self.corner + 1, None, None
            self.done = self.corner == len(CORNERS)


def _scan(rows: DataFrame, lift: Lift, fits: list[Fit]) -> dict[int, np.ndarray]:
    """Loss, slope and upper half of the curvature of each fit at its asked place, in one pass."""
    asked = np.array([f.asked for f in fits])
    corners, without = [CORNERS[f.corner] for f in fits], [f.without for f in fits]

    def run(batches):
        import pyarrow as pa

        m = asked.shape[1]
        loss, grad, hess = np.zeros(len(asked)), np.zeros_like(asked), np.zeros((len(asked), m, m))
        for x, y, fold in _slices(batches, "y", "fold"):
            z, sign = lift(x), np.where(y == 1, 1.0, -1.0)
            short = 1 - (z @ asked.T) * sign[:, None]
            for i, (h, left_out) in enumerate(zip(corners, without)):
                t = short[:, i] if left_out is None else np.where(fold == left_out, 0.0, short[:, i])
                t = np.maximum(t, 0)
                loss[i] += np.where(t < h, t * t / (2 * h), t - h / 2).sum()
                grad[i] -= (np.minimum(t / h, 1) * sign) @ z
                bent = z[(t > 0) & (t < h)]
                hess[i] += bent.T @ bent / h
        half = np.triu_indices(m)
        sums = [np.r_[loss[i], grad[i], hess[i][half]] for i in range(len(asked))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(asked), dtype=np.int32)), pa.array(sums, pa.list_(pa.float64()))], names=["i", "s"]
        )

    sums = rows.mapInArrow(run, "i int, s array<double>").groupBy("i").agg(Summarizer.sum(array_to_vector("s")).alias("s"))
    return {r["i"]: r["s"].toArray() for r in sums.collect()}


def minimise(rows: DataFrame, lift: Lift, problems: list[tuple[float, int | None]]) -> list[np.ndarray]:
    """Weights (the last one the offset) of several fits, given as (penalty, fold left out), in shared scans.

    ``rows`` has vectors ``v``, classes ``y`` of 0 and 1 and a number ``fold``.
    """
    m = lift.turn.shape[1] + 1
    fits = [Fit(C, without, np.zeros(m)) for C, without in problems]
    half = np.triu_indices(m)
    for _ in range(MAX_SCANS):
        live = [f for f in fits if not f.done]
        if not live:
            return [f.w for f in fits]
        for i, s in _scan(rows, lift, live).items():
            hess = np.zeros((m, m))
            hess[half] = s[1 + m :]
            live[i].take(s[0], s[1 : 1 + m], hess + np.triu(hess, 1).T)
    raise RuntimeError(f"a fit has not settled in {MAX_SCANS} scans")


class KernelMachine(Estimator):
    """The machine as an estimator over a ``features`` vector; rows without label or features take no part.

    With ``folds`` its model has a probability: a sigmoid fitted, with the usual softened targets, on the decisions
    about each row of the fit without the row's fold. Folds go by the vector's hash, so copies stay together.
    """

    C = Param(Params._dummy(), "C", "inverse strength of the penalty")
    gamma = Param(Params._dummy(), "gamma", "kernel width, or scale")

    def __init__(
        self, label: str, C: float = 1.0, gamma: float | str = "scale", size: int = LANDMARKS, folds: int = 5, seed: int = 42
    ):
        super().__init__()
        self.label, self.size, self.folds, self.seed = label, size, folds, seed
        self._set(C=float(C), gamma=gamma)

    def _fit(self, dataset: DataFrame) -> Model:
        known = dataset.where(F.col("features").isNotNull() & F.col(self.label).isNotNull())
        rows = known.select(vector_to_array("features").alias("v"), F.col(self.label).cast("int").alias("y"))
        fold = F.pmod(F.xxhash64("v", F.lit(self.seed + 1)), F.lit(max(self.folds, 1))).cast("int")
        rows = rows.withColumn("fold", fold).persist()
        try:
            lift = Lift.fit(rows, self.size, self.getOrDefault(self.gamma), self.seed)
            C = self.getOrDefault(self.C)
            found = minimise(rows, lift, [(C, None)] + [(C, i) for i in range(self.folds)])
            sigmoid = self._calibrate(rows, lift, found[1:]) if self.folds else None
        finally:
            rows.unpersist()
        return KernelModel(lift, found[0], sigmoid)

    def _calibrate(self, rows: DataFrame, lift: Lift, weights: list[np.ndarray]) -> tuple[float, float]:
        judged = with_decision(rows, lift, weights, "fold").persist()
        try:
            n1, n0 = judged.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()
            target = F.when(F.col("y") == 1, (n1 + 1.0) / (n1 + 2.0)).otherwise(1.0 / (n0 + 2.0))
            sides = F.explode(F.array(F.struct(F.lit(1.0).alias("t"), target.alias("p")), F.struct(F.lit(0.0).alias("t"), (1 - target).alias("p"))))
            soft = judged.select(array_to_vector(F.array("decision")).alias("f"), sides.alias("s")).select("f", "s.t", "s.p")
            model = LogisticRegression(featuresCol="f", labelCol="t", weightCol="p", tol=1e-9, maxIter=200).fit(soft)
        finally:
            judged.unpersist()
        return float(model.coefficients[0]), float(model.intercept)


def with_decision(rows: DataFrame, lift: Lift, weights: list[np.ndarray], which: str | None = None) -> DataFrame:
    """Add ``decision`` for vectors ``v``, by the first weights or by those that the column ``which`` numbers."""
    schema = rows.withColumn("decision", F.lit(0.0)).schema

    def run(batches):
        import pyarrow as pa

        w = np.array(weights).T
        for batch in batches:
            if batch.num_rows:
                out = []
                for x, *pick in _slices([batch], *([which] if which else [])):
                    f = lift(x) @ w
                    out.append(f[np.arange(len(f)), pick[0]] if which else f[:, 0])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(np.concatenate(out))], names=[*batch.schema.names, "decision"]
                )

    return rows.mapInArrow(run, schema)


class KernelModel(Model):
    """Adds ``decision``, ``prediction`` (decision above zero) and, if calibrated, ``probability``."""

    def __init__(self, lift: Lift, weights: np.ndarray, sigmoid: tuple[float, float] | None):
        super().__init__()
        self.lift, self.weights, self.sigmoid = lift, weights, sigmoid

    def _decisions(self):
        lift, w = self.lift, self.weights

        @F.pandas_udf("double")
        def decide(v: pd.Series) -> pd.Series:
            out = np.full(len(v), np.nan)
            known = np.flatnonzero(v.notna().to_numpy())
            for a in range(0, len(known), SLICE):
                at = known[a : a + SLICE]
                out[at] = lift(np.stack(v.iloc[at].to_numpy())) @ w
            return pd.Series(out).where(v.notna().to_numpy())

        return decide

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset.withColumn("decision", self._decisions()(vector_to_array("features")))
        out = out.withColumn("prediction", (F.col("decision") > 0).cast("double"))
        if self.sigmoid is None:
            return out
        a, b = self.sigmoid
        p = 1 / (1 + F.exp(-(a * F.col("decision") + b)))
        return out.withColumn("probability", array_to_vector(F.array(1 - p, p)))
