"""Reproducible splits and folds with exact sizes. The order is md5 of seed and row id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.operators.ranking import with_shuffled_rank


def assign_parts(
    df: DataFrame,
    id_col: str,
    parts: Sequence[tuple[str, float]],
    seed: int = 42,
    label: str | None = None,
    target: str = "split",
) -> DataFrame:
    """Name the part of each row; with ``label`` each class is cut at the same shares.

    A class of ``n`` rows is cut at ``round(n * cumulated share)``.
    """
    by = [label] if label else []
    ranked = with_shuffled_rank(df, id_col, seed, by)
    cut, case = 0.0, None
    for name, share in parts[:-1]:
        cut += share
        here = F.col("_rank") <= _cut(F.col("_size"), cut)
        case = F.when(here, F.lit(name)) if case is None else case.when(here, F.lit(name))
    return ranked.select(*df.columns, case.otherwise(F.lit(parts[-1][0])).alias(target))


def _cut(size: Column, share: float) -> Column:
    return F.floor(size * F.lit(round(share, 10)) + F.lit(0.5))


def split_random(df: DataFrame, id_col: str, test: float = 0.2, seed: int = 42) -> DataFrame:
    return assign_parts(df, id_col, [("train", 1 - test), ("test", test)], seed)


def split_stratified(
    df: DataFrame, id_col: str, label: str, test: float = 0.25, seed: int = 42, min_class: int = 2
) -> DataFrame:
    """Stratified split; if a class has fewer than ``min_class`` rows the split is plain."""
    smallest = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n")).first()[0]
    stratify = label if smallest is not None and smallest >= min_class else None
    return assign_parts(df, id_col, [("train", 1 - test), ("test", test)], seed, stratify)


def split_three_way(
    df: DataFrame, id_col: str, label: str, shares: Sequence[float] = (0.6, 0.2, 0.2), seed: int = 42
) -> DataFrame:
    parts = list(zip(("train", "validation", "test"), shares))
    return assign_parts(df, id_col, parts, seed, label)


def assign_folds(
    df: DataFrame, id_col: str, k: int, seed: int = 42, label: str | None = None, target: str = "fold"
) -> DataFrame:
    """Fold numbers 0..k-1, dealt in turn (per class with ``label``)."""
    ranked = with_shuffled_rank(df, id_col, seed, [label] if label else [])
    return ranked.select(*df.columns, ((F.col("_rank") - 1) % k).cast("int").alias(target))
