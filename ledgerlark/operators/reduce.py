"""Principal components."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F


def pca_scores(
    df: DataFrame, features: str, k: int, output: str = "scores"
) -> tuple[DataFrame, list[float]]:
    """Centred scores as an array column, and the explained share of variance per component.

    Each component points to where its largest loading is positive (the first one on ties).
    Only the d x k loadings reach the driver.
    """
    centre = StandardScaler(inputCol=features, outputCol="_centred", withMean=True, withStd=False)
    centred = centre.fit(df).transform(df)
    model = PCA(k=k, inputCol="_centred", outputCol="_pc").fit(centred)
    loadings = model.pc.toArray()
    signs = [_sign(loadings[:, j]) for j in range(k)]
    scored = model.transform(centred).withColumn("_raw", vector_to_array("_pc"))
    out = F.array(*[F.col("_raw")[j] * F.lit(s) for j, s in enumerate(signs)])
    return (
        scored.withColumn(output, out).drop("_centred", "_pc", "_raw"),
        [float(v) for v in model.explainedVariance.toArray()],
    )


def _sign(loading: np.ndarray) -> float:
    biggest = int(np.argmax(np.round(np.abs(loading), 12)))
    return 1.0 if loading[biggest] >= 0 else -1.0
