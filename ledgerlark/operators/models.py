"""Supervised models on Spark ML, with the parameters of their usual single-machine counterparts.

Inputs have a ``features`` vector and a numeric label column. Known differences: trees use binned
thresholds, have no minimum split size and stop at depth 30 (``trees.py`` has exact ones). The RBF machine is in
``kernel.py``; the random Fourier features here are a cheaper stand-in for searches over kernel widths.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from math import pi

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from ledgerlark import presets
from ledgerlark.functions.scalars import literal_matrix
from ledgerlark.operators.gram import gram

WEIGHT = "_weight"
#: Spark's trees end at this depth.
MAX_DEPTH = 30
#: Candidate splits per feature, a parameter of every tree model.
BINS = 256


def _depth(wanted: int | None) -> int:
    if wanted is not None and wanted > MAX_DEPTH:
        raise ValueError(f"trees end at depth {MAX_DEPTH}, {wanted} was asked for")
    return MAX_DEPTH if wanted is None else wanted


def with_balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Weight ``n / (2 n_c)`` for a row of class c."""
    n1 = F.count_if(F.col(label) == 1)
    sizes = df.agg(F.struct(F.count(F.lit(1)).alias("n"), n1.alias("n1")).alias("s")).scalar()
    s = F.col("_s")
    own = F.when(F.col(label) == 1, s["n1"]).otherwise(s["n"] - s["n1"])
    weight = F.try_divide(s["n"].cast("double"), 2 * own)
    return df.withColumn("_s", sizes).withColumn(WEIGHT, weight).drop("_s")


def logistic(label: str, rows: float, C: float = 1.0, balanced: bool = False) -> LogisticRegression:
    """L2-penalised logistic regression; ``rows`` is the total weight (the row count as a rule)."""
    model = LogisticRegression(
        labelCol=label, regParam=1.0 / (C * rows), standardization=False, maxIter=1000, tol=1e-8
    )
    return model.setWeightCol(WEIGHT) if balanced else model


def decision_tree(
    label: str,
    max_depth: int | None = None,
    min_leaf: int = 1,
    balanced: bool = False,
    seed: int = 42,
    bins: int = BINS,
) -> DecisionTreeClassifier:
    model = DecisionTreeClassifier(
        labelCol=label, maxDepth=_depth(max_depth), minInstancesPerNode=min_leaf, seed=seed, maxBins=bins
    )
    return model.setWeightCol(WEIGHT) if balanced else model


def random_forest(
    label: str,
    trees: int = 100,
    max_depth: int | None = None,
    min_leaf: int = 1,
    balanced: bool = False,
    seed: int = 42,
    bins: int = BINS,
) -> RandomForestClassifier:
    model = RandomForestClassifier(
        labelCol=label,
        numTrees=trees,
        maxDepth=_depth(max_depth),
        minInstancesPerNode=min_leaf,
        featureSubsetStrategy="sqrt",
        seed=seed,
        maxBins=bins,
    )
    return model.setWeightCol(WEIGHT) if balanced else model


def gradient_boosting(
    label: str,
    rounds: int = 100,
    rate: float = 0.1,
    max_depth: int = 3,
    min_leaf: int = 1,
    subsample: float = 1.0,
    features: str = "all",
    seed: int = 42,
    bins: int = BINS,
) -> GBTClassifier:
    return GBTClassifier(
        labelCol=label,
        maxIter=rounds,
        stepSize=rate,
        maxDepth=_depth(max_depth),
        maxBins=bins,
        minInstancesPerNode=min_leaf,
        subsamplingRate=subsample,
        featureSubsetStrategy=features,
        seed=seed,
    )


class ExactRidge(Estimator):
    """Ridge regression solved from one aggregation of all products of two features (``gram.py``).

    The features must be few: the d x d sums of a d-dimensional vector reach the driver.
    """

    alpha = Param(Params._dummy(), "alpha", "weight of the penalty")
    lasso = False

    def __init__(self, label: str, alpha: float, prediction: str = "prediction"):
        super().__init__()
        self.label, self.prediction = label, prediction
        self._set(alpha=float(alpha))

    def setPredictionCol(self, name: str) -> ExactRidge:
        self.prediction = name
        return self

    def _fit(self, dataset: DataFrame) -> Model:
        w, intercept = gram(dataset, self.label).fit(self.getOrDefault(self.alpha), self.lasso)
        return LinearModel(w, intercept, self.prediction)


class ExactLasso(ExactRidge):
    """Lasso regression by coordinate descent on the same sums."""

    lasso = True


class LinearModel(Model):
    """Coefficients and intercept of a linear model."""

    def __init__(self, coefficients: np.ndarray, intercept: float, prediction: str):
        super().__init__()
        self.coefficients, self.intercept, self.prediction = Vectors.dense(coefficients), intercept, prediction

    def _transform(self, dataset: DataFrame) -> DataFrame:
        w = F.array(*[F.lit(float(c)) for c in self.coefficients.toArray()])
        products = F.zip_with(vector_to_array("features"), w, lambda a, b: a * b)
        value = F.aggregate(products, F.lit(float(self.intercept)), lambda s, v: s + v)
        return dataset.withColumn(self.prediction, value)


def ridge(label: str, alpha: float) -> ExactRidge:
    return ExactRidge(label, alpha)


class BalancedLogistic(Estimator):
    """L2-penalised logistic regression whose penalty and class weights follow the rows it is fitted on."""

    C = Param(Params._dummy(), "C", "inverse strength of the penalty")

    def __init__(self, label: str, C: float = 1.0, balanced: bool = True):
        super().__init__()
        self.label, self.balanced = label, balanced
        self._set(C=float(C))

    def _fit(self, dataset: DataFrame) -> Model:
        rows = dataset
        if self.balanced and WEIGHT not in dataset.columns:
            rows = with_balanced_weights(dataset, self.label)
        return logistic(self.label, dataset.count(), self.getOrDefault(self.C), self.balanced).fit(rows)


class WeightStage(Estimator):
    """Class weights as a pipeline stage of its own, for searches in which they are the same for all draws."""

    def __init__(self, label: str):
        super().__init__()
        self.label = label

    def _fit(self, dataset: DataFrame) -> Model:
        n, n1 = dataset.agg(F.count(F.lit(1)), F.count_if(F.col(self.label) == 1)).first()
        return WeightStageModel(self.label, n / (2 * n1) if n1 else None, n / (2 * (n - n1)) if n - n1 else None)


class WeightStageModel(Model):
    def __init__(self, label: str, one: float | None, other: float | None):
        super().__init__()
        self.label, self.one, self.other = label, one, other

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weight = F.when(F.col(self.label) == 1, F.lit(self.one)).otherwise(F.lit(self.other))
        return dataset.withColumn(WEIGHT, weight.cast("double"))


class BalancedTrees(Estimator):
    """Any estimator with a weight column, fitted with class weights of the rows it is fitted on."""

    def __init__(self, label: str, inner: Estimator):
        super().__init__()
        self.label, self.inner = label, inner

    def _fit(self, dataset: DataFrame) -> Model:
        return self.inner.fit(with_balanced_weights(dataset, self.label))


def lasso(label: str, alpha: float) -> ExactLasso:
    return ExactLasso(label, alpha)


def least_squares(label: str) -> LinearRegression:
    return LinearRegression(labelCol=label, regParam=0.0, solver="normal")


@dataclass(frozen=True)
class FourierFeatures:
    """Random cosine features whose inner products approximate an RBF kernel (Rahimi, Recht 2007)."""

    weights: list[list[float]]
    shifts: list[float]

    @classmethod
    def fit(cls, df: DataFrame, features: str, size: int, gamma: float | str = "scale", seed: int = 42):
        """``scale`` takes 1 / (d * variance of all entries)."""
        x = F.explode(vector_to_array(features))
        d = len(df.select(features).first()[0])
        if gamma == "scale":
            variance = df.select(x.alias("x")).agg(F.var_pop("x")).first()[0]
            gamma = 1.0 / (d * variance)
        draw = np.random.default_rng(seed)
        weights = draw.normal(scale=np.sqrt(2.0 * gamma), size=(size, d))
        return cls(weights.tolist(), draw.uniform(0, 2 * pi, size).tolist())

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Replace the vector column by its cosine features."""
        rows = [[*w, b] for w, b in zip(self.weights, self.shifts)]
        scale = float(np.sqrt(2.0 / len(rows)))
        extended = F.concat(vector_to_array(features), F.array(F.lit(1.0)))
        angles = F.transform(
            literal_matrix(rows),
            lambda r: F.aggregate(
                F.zip_with(r, F.col("_x"), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v
            ),
        )
        out = df.withColumn("_x", extended).withColumn("_z", angles)
        cosines = F.transform("_z", lambda a: F.cos(a) * scale)
        return out.withColumn(features, array_to_vector(cosines)).drop("_x", "_z")


class FourierStage(Estimator):
    """``FourierFeatures`` as a pipeline stage; the kernel width ``scale`` follows the rows of each fit."""

    gamma = Param(Params._dummy(), "gamma", "kernel width, or scale")

    def __init__(self, size: int, gamma: float | str = "scale", seed: int = 42):
        super().__init__()
        self.size, self.seed = size, seed
        self._set(gamma=gamma)

    def _fit(self, dataset: DataFrame) -> Model:
        return FourierStageModel(FourierFeatures.fit(dataset, "features", self.size, self.getOrDefault(self.gamma), self.seed))


class FourierStageModel(Model):
    def __init__(self, lift: FourierFeatures):
        super().__init__()
        self.lift = lift

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.lift.transform(dataset)


@dataclass
class Constant:
    """Stands in for a model when the training rows hold one class only: decides 0."""

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.lit(0.0))


def fit_guarded(estimator: Estimator, train: DataFrame, label: str) -> Model | Constant:
    """Fit, unless only one class is present."""
    if train.select(label).distinct().limit(2).count() < 2:
        return Constant()
    return estimator.fit(train)


def decide(scored: DataFrame, regression: bool = False, target: str = "pred") -> DataFrame:
    """The 0/1 decision; the output of a regression is cut at 0.5."""
    p = F.col("prediction")
    return scored.withColumn(target, (p >= 0.5).cast("int") if regression else p.cast("int"))


def with_probability(scored: DataFrame, target: str = "p1") -> DataFrame:
    """The probability of class 1."""
    return scored.withColumn(target, vector_to_array("probability")[1])


def score(model: Model, rows: DataFrame, yes: str = presets.VERDICT_YES, no: str = presets.VERDICT_NO) -> DataFrame:
    """Decision, confidence (percent) and a verdict text for new rows."""
    out = with_probability(decide(model.transform(rows)))
    confidence = 100.0 * F.when(F.col("pred") == 1, F.col("p1")).otherwise(1 - F.col("p1"))
    name = F.when(F.col("pred") == 1, F.lit(yes)).otherwise(F.lit(no))
    text = F.concat(name, F.format_string(presets.VERDICT_CONFIDENCE, confidence))
    return out.withColumn("confidence", confidence).withColumn("verdict", text)


def importances(model: Model, names: Sequence[str], rows: DataFrame) -> DataFrame:
    """Rows (feature, importance), the largest first."""
    values = model.featureImportances.toArray()
    pairs = [(n, float(v)) for n, v in zip(names, values)]
    table = rows.sparkSession.createDataFrame(pairs, "feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "feature")


def coefficients(model: Model, names: Sequence[str], rows: DataFrame) -> DataFrame:
    """Rows (feature, coefficient, magnitude), the largest magnitude first."""
    pairs = [(n, float(v), abs(float(v))) for n, v in zip(names, model.coefficients.toArray())]
    table = rows.sparkSession.createDataFrame(
        pairs, "feature string, coefficient double, magnitude double"
    )
    return table.orderBy(F.col("magnitude").desc(), "feature")


def aligned_importances(
    first: DataFrame, second: DataFrame, names: tuple[str, str], top: int | None = None
) -> DataFrame:
    """Two importance tables side by side, in order of the first one."""
    a = first.withColumnRenamed("importance", names[0])
    b = second.withColumnRenamed("importance", names[1])
    out = a.join(b, "feature").orderBy(F.col(names[0]).desc(), "feature")
    return out if top is None else out.limit(top)


@dataclass(frozen=True)
class TreeText:
    depth: int
    leaves: int
    rules: str = field(repr=False)


def tree_text(model: Model, names: Sequence[str]) -> TreeText:
    """Depth, number of leaves and the rules of one tree with the feature names filled in."""
    rules = model.toDebugString
    for i in reversed(range(len(names))):
        rules = rules.replace(f"feature {i} ", f"{names[i]} ")
    return TreeText(model.depth, (model.numNodes + 1) // 2, rules)

