"""The data behind each figure; drawing is left to the caller."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate
from math import factorial
from operator import mul

from numpy.polynomial.hermite_e import herme2poly
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.operators.quantiles import exact_quantiles
from ledgerlark.operators.ranking import shuffle_key
from ledgerlark.operators.skew import checked_broadcast

KDE_POINTS = 200
#: Cells per bandwidth, bandwidths a kernel reaches, and terms of its series.
KDE_CELLS, KDE_REACH, KDE_TERMS = 8, 8, 8


def daily_series(df: DataFrame, day: str, label: str, amount: str) -> DataFrame:
    """Total and count per day and label."""
    return df.groupBy(day, label).agg(F.sum(amount).alias("_total"), F.count(F.lit(1)).alias("n"))


def top_groups(df: DataFrame, key: str, label: str, n: int) -> DataFrame:
    """Counts per label for the ``n`` keys with the most rows; rows without a key are left out."""
    counts = (
        df.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(key, label)
        .agg(F.count(F.lit(1)).alias("conteo"))
    )
    top = (
        counts.groupBy(key)
        .agg(F.sum("conteo").alias("_total"))
        .orderBy(F.col("_total").desc(), key)
        .limit(n)
    )
    return counts.join(F.broadcast(top.select(key)), key, "left_semi")


def scatter_series(
    df: DataFrame, row_id: str, columns: Sequence[str], hue: str, n: int, seed: int
) -> DataFrame:
    """Complete rows of a few columns; if there are more than ``n``, an exact seeded sample."""
    complete = df.select(row_id, *columns, hue).dropna(subset=[*columns, hue])
    return (
        complete.withColumn("_h", shuffle_key(row_id, seed)).orderBy("_h", row_id).limit(n).drop("_h")
    )


def histogram(df: DataFrame, column: str, bins: int, by: str) -> DataFrame:
    """Equal-width bins per class, each class with its own edges; the last bin is closed."""
    known = df.where(F.col(column).isNotNull())
    edges = known.groupBy(by).agg(
        F.min(column).alias("_lo"), ((F.max(column) - F.min(column)) / bins).alias("_w")
    )
    rows = known.join(checked_broadcast(edges, df, [by]), by)
    slot = F.coalesce(F.floor(F.try_divide(F.col(column) - F.col("_lo"), F.col("_w"))), F.lit(0))
    binned = rows.withColumn("bin", F.least(slot, F.lit(bins - 1)).cast("int"))
    out = binned.groupBy(by, "bin", "_lo", "_w").agg(F.count(F.lit(1)).alias("n"))
    left = F.round(F.col("_lo") + F.col("_w") * F.col("bin"), 6)
    return out.select(by, "bin", "n", left.alias("left_edge"))


def auto_histogram(df: DataFrame, column: str) -> DataFrame:
    """One histogram with as many bins as the finer of Sturges' and Freedman and Diaconis' rules."""
    known = df.select(F.col(column).cast("double").alias("x")).where(F.col("x").isNotNull())
    q = exact_quantiles(known, ["x"], [0.25, 0.75])
    iqr = q.agg(
        F.max(F.when(F.col("prob") == 0.75, F.col("value")))
        - F.max(F.when(F.col("prob") == 0.25, F.col("value")))
    ).scalar()
    base = known.agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")
    ).withColumn("iqr", iqr)
    span = F.col("hi") - F.col("lo")
    sturges = F.log2("n") + 1
    diaconis = F.try_divide(span, F.try_divide(2 * F.col("iqr"), F.cbrt("n")))
    bins = F.greatest(F.lit(1.0), F.ceil(F.greatest(sturges, diaconis)).cast("double"))
    edges = base.select(F.struct("lo", (span / bins).alias("w"), bins.alias("bins"))).scalar()
    e = F.col("_e")
    slot = F.coalesce(F.floor(F.try_divide(F.col("x") - e["lo"], e["w"])), F.lit(0))
    placed = known.withColumn("_e", edges)
    binned = placed.groupBy("_e", F.least(slot, e["bins"] - 1).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return binned.select("bin", "n", (e["lo"] + e["w"] * F.col("bin")).alias("left_edge"))


def _hermite(k: int, u: Column) -> Column:
    """The Hermite polynomial: exp(-(u - d)² / 2) is exp(-u² / 2) times the sum of He_k(u) d^k / k!."""
    out = F.lit(0.0)
    for c in reversed(herme2poly([0.0] * k + [1.0])):
        out = out * u + F.lit(float(c))
    return out


def density_curve(df: DataFrame, column: str, points: int = KDE_POINTS) -> DataFrame:
    """Gaussian kernel density on an even grid with Scott's bandwidth, by a fast Gauss transform.

    Values are added up in cells ``1 / KDE_CELLS`` of a bandwidth wide: their number and the sums of the first powers of
    their distance to the middle. A grid point takes the cells within ``KDE_REACH`` bandwidths, each by the series of
    the kernel around its middle. Left out are less than 1.2e-12 of a kernel's height per value by the cut series and 1.3e-14
    by the reach. Values no grid point reaches are left aside, so at most ``2 * KDE_REACH * KDE_CELLS`` cells per grid
    point are shuffled, whatever the number of rows. NULL values take no part; without any spread the density is NULL.
    """
    known = df.select(F.col(column).cast("double").alias("x")).where(F.col("x").isNotNull())
    spread = known.agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("lo"), F.max("x").alias("hi")
    )
    width = F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    spread = spread.select(
        F.struct(
            "n",
            F.nullif(width, F.lit(0.0)).alias("h"),
            (F.col("lo") - 3 * width).alias("a"),
            ((F.col("hi") - F.col("lo") + 6 * width) / (points - 1)).alias("step"),
        )
    ).scalar()
    s = F.col("_s")
    # Places are in bandwidths from the first grid point; the grid's step is above zero where there is a bandwidth.
    step = s["step"] / s["h"]
    placed = known.withColumn("_s", spread).select("_s", ((F.col("x") - s["a"]) / s["h"]).alias("z"))
    from_grid = F.abs(F.col("z") - F.round(F.col("z") / step) * step)
    cell = F.floor(F.col("z") * KDE_CELLS)
    placed = placed.where(from_grid <= KDE_REACH).select("_s", "z", cell.alias("cell"))
    d = F.col("z") - (F.col("cell") + 0.5) / KDE_CELLS
    powers = accumulate([d] * (KDE_TERMS - 1), mul)
    sums = [F.sum(p).alias(f"m{k}") for k, p in enumerate(powers, 1)]
    cells = placed.groupBy("_s", "cell").agg(F.count(F.lit(1)).cast("double").alias("m0"), *sums)
    cells = cells.withColumn("mid", (F.col("cell") + 0.5) / KDE_CELLS)
    first = F.greatest(F.lit(0), F.ceil((F.col("mid") - KDE_REACH) / step)).cast("int")
    last = F.least(F.lit(points - 1), F.floor((F.col("mid") + KDE_REACH) / step)).cast("int")
    met = cells.withColumn("ends", F.struct(first.alias("first"), last.alias("last"))).where("ends.first <= ends.last")
    met = met.withColumn("i", F.explode(F.sequence("ends.first", "ends.last")))
    met = met.withColumn("u", F.col("i") * step - F.col("mid"))
    series = F.lit(0.0)
    for k in range(KDE_TERMS):
        series = series + F.col(f"m{k}") * _hermite(k, F.col("u")) / float(factorial(k))
    found = met.groupBy("i").agg(F.sum(F.exp(-0.5 * F.col("u") * F.col("u")) * series).alias("_sum"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("i")).withColumn("_s", spread)
    grid = grid.where(s["n"] > 0)
    norm = s["n"] * s["h"] * F.sqrt(2 * F.pi())
    density = F.greatest(F.coalesce("_sum", F.lit(0.0)), F.lit(0.0)) / norm
    at = s["a"] + s["step"] * F.col("i")
    return grid.join(found, "i", "left").select("i", at.alias("x"), density.alias("density"))


def box_stats(df: DataFrame, column: str, by: str, width: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (the extreme values within the fences) and number of fliers per class."""
    q = exact_quantiles(df, [column], [0.25, 0.5, 0.75], [by])
    wide = q.groupBy(by).agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
            for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
        ]
    )
    rows = df.where(F.col(column).isNotNull()).join(checked_broadcast(wide, df, [by]), by)
    reach = width * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - reach, F.col("q3") + reach
    x = F.col(column)
    return (
        rows.groupBy(by, "q1", "median", "q3")
        .agg(
            F.min(F.when(x >= low, x)).alias("low_whisker"),
            F.max(F.when(x <= high, x)).alias("high_whisker"),
            F.count_if((x < low) | (x > high)).alias("fliers"),
            F.count(F.lit(1)).alias("n"),
        )
        .withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})
    )


def fliers(df: DataFrame, column: str, by: str, width: float = 1.5) -> DataFrame:
    """The rows outside the fences of their class."""
    q = exact_quantiles(df, [column], [0.25, 0.75], [by])
    wide = q.groupBy(by).agg(F.min("value").alias("_q1"), F.max("value").alias("_q3"))
    rows = df.join(checked_broadcast(wide, df, [by]), by)
    reach = width * (F.col("_q3") - F.col("_q1"))
    x = F.col(column)
    return rows.where((x < F.col("_q1") - reach) | (x > F.col("_q3") + reach)).drop("_q1", "_q3")


def regression_line(df: DataFrame, x: str, actual: str, predictions: Sequence[str]) -> DataFrame:
    """Rows in order of ``x`` with the actual value and each prediction."""
    return df.select(x, actual, *predictions).orderBy(x, actual)
