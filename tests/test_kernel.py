"""The kernel machine against an exact solution of its dual by pairs, and its probabilities."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ledgerlark.operators import kernel, models


def dual(x, y, C, gamma):
    """Decisions of the exact machine: the most violating pair is moved until none violates."""
    s = np.where(y == 1, 1.0, -1.0)
    k = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(2))
    a, g = np.zeros(len(x)), -np.ones(len(x))
    for _ in range(200_000):
        up = np.where(((s > 0) & (a < C)) | ((s < 0) & (a > 0)), -s * g, -np.inf)
        low = np.where(((s > 0) & (a > 0)) | ((s < 0) & (a < C)), -s * g, np.inf)
        i, j = up.argmax(), low.argmin()
        if up[i] - low[j] < 1e-6:
            break
        t = (up[i] - low[j]) / max(k[i, i] + k[j, j] - 2 * k[i, j], 1e-12)
        t = min(t, C - a[i] if s[i] > 0 else a[i], a[j] if s[j] > 0 else C - a[j])
        a[i] += s[i] * t
        a[j] -= s[j] * t
        g += s * (k[:, i] - k[:, j]) * t
    return k @ (a * s) + (up[i] + low[j]) / 2


@pytest.fixture(scope="module")
def rings():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(220, 2))
    y = ((x**2).sum(1) + draw.normal(scale=0.5, size=220) > 1.3).astype(int)
    return np.vstack([x, np.tile(x[:1], (20, 1))]), np.r_[y, np.repeat(y[:1], 20)]


def table(spark, x, y):
    df = spark.createDataFrame([(i, [float(a) for a in v], int(c)) for i, (v, c) in enumerate(zip(x, y))], "id int, v array<double>, y int")
    return df.withColumn("features", array_to_vector("v"))


def test_decisions_equal_the_exact_machine(spark, rings):
    x, y = rings
    df = table(spark, x, y)
    for C in (0.5, 10.0):
        model = kernel.KernelMachine("y", C, 0.7, folds=0).fit(df.repartition(3))
        got = np.array([r["decision"] for r in model.transform(df).orderBy("id").collect()])
        want = dual(x, y, C, 0.7)
        assert ((got > 0) == (want > 0)).mean() >= 0.99 and np.abs(got - want).mean() < 0.03


def test_few_landmarks_come_near(spark, rings):
    x, y = rings
    df = table(spark, x, y)
    model = kernel.KernelMachine("y", 1.0, size=40, folds=0).fit(df)
    assert model.lift.landmarks.shape == (40, 2) and model.lift.gamma == pytest.approx(1 / (2 * x.var()), rel=1e-6)
    got = np.array([r["decision"] for r in model.transform(df).orderBy("id").collect()])
    assert ((got > 0) == (dual(x, y, 1.0, model.lift.gamma) > 0)).mean() > 0.97


def test_probabilities_are_calibrated(spark, rings):
    x, y = rings
    df = table(spark, x, y)
    rows = df.unionByName(df.limit(1).withColumn("y", F.lit(None).cast("int")))
    model = kernel.KernelMachine("y", 1.0).fit(rows)
    scored = models.with_probability(model.transform(df)).toPandas()
    bins = np.digitize(scored.p1, [0.25, 0.5, 0.75])
    rates = [scored.y[bins == b].mean() for b in range(4) if (bins == b).any()]
    assert rates == sorted(rates) and abs(scored.p1.mean() - y.mean()) < 0.08
    assert (np.argsort(np.argsort(scored.p1)) == np.argsort(np.argsort(scored.decision))).mean() > 0.9
