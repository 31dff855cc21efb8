"""Descriptive statistics. Each operator reads the table once or twice, whatever the column count."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlark.operators.modes import modes
from ledgerlark.operators.quantiles import exact_quantiles, quantile_row, unpivot
from ledgerlark.operators.rules import numeric_columns


MAX_CELLS = 10_000


def frequency_table(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts and shares (in percent) of the values of a column; missing values are left out.

    With ``by`` the shares are taken within each group, and rows without a group are left out.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("n"))
    if by:
        counts = counts.join(counts.groupBy(*by).agg(F.sum("n").alias("_total")), list(by))
    else:
        counts = counts.withColumn("_total", counts.agg(F.sum("n")).scalar())
    pct = F.round(100.0 * F.col("n") / F.col("_total"), 6)
    return counts.select(*by, column, "n", pct.alias("pct"))


def distinct_counts(df: DataFrame, column: str, ignore: object = None) -> DataFrame:
    """Distinct values with counts; ``ignore`` (such as a noise mark) is left out."""
    kept = df if ignore is None else df.where(F.col(column) != F.lit(ignore))
    return kept.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def central_tendency(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, mean, median, mode)."""
    mids = quantile_row(df, columns, [0.5])
    means = df.agg(*[F.avg(c).alias(c) for c in columns])
    long = means.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("mean")) for c in columns]))
    )
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return long.withColumn("median", F.try_element_at(mids, F.col("column"))[0]).join(
        modes(typed, columns).drop("frequency"), "column"
    )


def dispersion(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, std, variance, range) with n - 1 in the denominator."""
    return unpivot(df, columns).groupBy("column").agg(
        F.stddev_samp("value").alias("std"),
        F.var_samp("value").alias("variance"),
        (F.max("value") - F.min("value")).alias("range"),
    )


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, std, min, quartiles and max per column, with exact quartiles."""
    by = list(by)
    basic = unpivot(df, columns, by).groupBy(*by, "column").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75], by)
    wide = q.groupBy(*by, "column").agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
            for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
        ]
    )
    return basic.join(wide, by + ["column"])


def describe_by_class(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Five statistics per class and column, rounded half-even to three digits."""
    out = describe(df, columns, [label])
    names = {"mean": "mean", "std": "std", "min": "min", "median": "q50", "max": "max"}
    return out.select(label, "column", *[F.bround(c, 3).alias(n) for n, c in names.items()])


def table_info(df: DataFrame) -> DataFrame:
    """Rows (column, type, non_null, n_rows)."""
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(t).alias("type"),
            F.col(c).alias("non_null"),
            F.col("_n").alias("n_rows"),
        )
        for c, t in df.dtypes
    ]
    return counts.select(F.inline(F.array(*rows)))


def null_profile(df: DataFrame) -> DataFrame:
    """Columns with missing values, their count and share in percent (two digits)."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns]
    long = counts.select("_n", F.inline(F.array(*rows)))
    pct = F.bround(100.0 * F.col("nulls") / F.col("_n"), 2)
    return (
        long.where(F.col("nulls") > 0)
        .select("column", "nulls", pct.alias("pct"))
        .orderBy(F.col("pct").desc(), "column")
    )


def null_cells(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One 0/1 mark per cell: 1 where the value is missing."""
    others = [c for c in df.columns if c not in keys]
    return df.select(*keys, *[F.col(c).isNull().cast("int").alias(c) for c in others])


def corrected_skewness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, skew): the bias-corrected sample skewness; fewer than three values give NULL."""
    out = unpivot(df, columns).groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.skewness("value").alias("g1")
    )
    n = F.col("n").cast("double")
    skew = F.when(F.col("n") > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    return out.select("column", skew.alias("skew"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (a, b, corr) for a < b in column order; each pair uses its own complete rows."""
    pairs = list(combinations(columns, 2))
    one = df.agg(*[_corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]
    return one.select(F.inline(F.array(*cells)))


def _corr(a: str, b: str) -> Column:
    return F.corr(F.col(a).cast("double"), F.col(b).cast("double"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The full matrix in long form, the diagonal included, from one aggregation."""
    pairs = list(combinations_with_replacement(columns, 2))
    one = df.agg(*[_corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"r{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
        for x, y in dict.fromkeys([(a, b), (b, a)])
    ]
    return one.select(F.inline(F.array(*cells)))


def correlation_with_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Rows (column, corr), strongest first."""
    one = df.agg(*[_corr(c, target).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("corr")) for c in columns]
    return one.select(F.inline(F.array(*rows))).orderBy(F.abs("corr").desc(), "column")


def high_correlation_pairs(df: DataFrame, columns: Sequence[str], at_least: float = 0.9) -> DataFrame:
    return correlations(df, columns).where(F.abs("corr") >= at_least)


def group_rate(df: DataFrame, key: str, label: str) -> DataFrame:
    """Share of label 1 per group, highest first."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.avg(label).alias("rate"), F.count(label).alias("n"))
        .orderBy(F.col("rate").desc(), key)
    )


def class_means(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Rows (label, column, mean, normalised): means min-max scaled across the classes."""
    wide = df.where(F.col(label).isNotNull()).groupBy(label).agg(*[F.avg(c).alias(c) for c in columns])
    long = unpivot(wide, columns, [label]).withColumnRenamed("value", "mean")
    over = W.partitionBy("column")
    low, high = F.min("mean").over(over), F.max("mean").over(over)
    return long.withColumn("normalised", (F.col("mean") - low) / (high - low + 1e-9))


def criteria_share(
    df: DataFrame, label: str, criteria: Sequence[tuple[str, float]]
) -> DataFrame:
    """Share (percent) of label-1 rows below each bound, among those whose value is known."""
    ones = df.where(F.col(label) == 1)
    one = ones.agg(*[F.avg((F.col(c) < t).cast("int")).alias(c) for c, t in criteria])
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(float(t)).alias("bound"),
            (100.0 * F.col(c)).alias("pct"),
        )
        for c, t in criteria
    ]
    return one.select(F.inline(F.array(*rows)))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """One row: class sizes, negative to positive ratio, smaller class and usable fold count."""
    one = df.agg(
        F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")
    )
    smaller = (
        F.when(F.col("n0") == 0, F.col("n1"))
        .when(F.col("n1") == 0, F.col("n0"))
        .otherwise(F.least("n0", "n1"))
    )
    folds = F.when(smaller >= 2, F.least(F.lit(5), smaller)).otherwise(F.lit(3))
    return one.select(
        "n0",
        "n1",
        F.try_divide(F.col("n0").cast("double"), F.col("n1")).alias("ratio"),
        smaller.alias("min_class"),
        folds.cast("int").alias("folds"),
    )


def contingency(df: DataFrame, row: str, column: str) -> DataFrame:
    """Long contingency table (row, column, n) with a zero for each absent cell, and row percent."""
    counts = df.groupBy(row, column).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.select(row).distinct()
    found = counts.select(column).distinct().agg(F.collect_list(column).alias("c"))
    few = F.when(F.size("c") <= MAX_CELLS, F.col("c"))
    few = F.coalesce(few, F.raise_error(F.lit("too many columns for a table")).cast(f"array<{dict(df.dtypes)[column]}>"))
    full = rows.select(row, F.explode(found.select(few).scalar()).alias(column))
    out = full.join(counts, [row, column], "left").fillna(0, ["n"])
    total = F.sum("n").over(W.partitionBy(row))
    pct = F.when(total > 0, 100.0 * F.col("n") / total).otherwise(F.lit(0.0))
    return out.withColumn("pct", pct)


def matrix_long(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A wide table as heat-map cells (row, column, value)."""
    names = list(columns or numeric_columns(df.drop(key)))
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in names]
    )
    return df.select(F.col(key).alias("row"), F.inline(cells))
