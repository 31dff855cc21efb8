"""Most frequent values by plain counting, never by a per-group buffer of all values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, mode, frequency); the smallest value wins ties.

    The columns must share a type, or all be numeric, in which case the modes are doubles.
    """
    types = {t for c, t in df.dtypes if c in set(columns)}
    common = types.pop() if len(types) == 1 else "double"
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast(common).alias("v")) for c in columns]
    )
    counts = (
        df.select(F.inline(cells))
        .where(F.col("v").isNotNull())
        .groupBy("column", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    first = F.struct(-F.col("n"), F.col("v"))
    return counts.groupBy("column").agg(
        F.min_by("v", first).alias("mode"), F.max("n").alias("frequency")
    )
