"""Exact ranks and running totals over a whole table without a one-task window.

Rows are cut into many ordered buckets; a table with one row per bucket gives each bucket its
start; only the rows of one bucket meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlark.session import cut_lineage

RANGE_BUCKETS = 1024


def shuffle_key(id_col: str, seed: int) -> Column:
    """A reproducible random order of rows: md5 of seed and row id."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def with_shuffled_rank(
    df: DataFrame,
    id_col: str,
    seed: int,
    by: Sequence[str] = (),
    rank: str = "_rank",
    size: str = "_size",
    prefix: int = 4,
) -> DataFrame:
    """Add the 1-based rank of each row in seeded order, per group, and the group's size.

    The first ``prefix`` hex digits cut each group into ``16 ** prefix`` even buckets.
    """
    by = list(by)
    keyed = df.withColumn("_h", shuffle_key(id_col, seed)).withColumn(
        "_bucket", F.substring("_h", 1, prefix)
    )
    earlier = W.partitionBy(*by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        keyed.groupBy(*by, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn(size, F.sum("_n").over(W.partitionBy(*by)))
        .drop("_n")
    )
    within = W.partitionBy(*by, "_bucket").orderBy("_h", id_col)
    return (
        keyed.withColumn("_i", F.row_number().over(within))
        .join(starts, by + ["_bucket"])
        .withColumn(rank, F.col("_start") + F.col("_i"))
        .drop("_h", "_bucket", "_i", "_start")
    )


def range_bucket(value: Column, bounds: Column, buckets: int) -> Column:
    """Number of sorted ``bounds`` that are <= ``value``, by bisection inside an expression."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(buckets.bit_length()))])
    size = F.size(bounds)
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= size) & (F.get(bounds, at + step - 1) <= value), at + step
        ).otherwise(at),
    )


def with_running_totals(
    df: DataFrame,
    order: str,
    totals: Sequence[str],
    descending: bool = False,
    buckets: int = RANGE_BUCKETS,
) -> DataFrame:
    """Add ``cum_<t>``: the total of column ``t`` over this row and all rows before it.

    ``order`` must be unique per row (aggregate by it first). Any cut points give right totals;
    here they are values drawn by hash, of any type that can be ordered. The table is read three times, so it is
    materialised first.
    """
    df = cut_lineage(df)
    drawn = df.select(order).orderBy(F.xxhash64(order), order).limit(buckets - 1)
    cut = drawn.agg(F.sort_array(F.collect_set(order)).alias("b")).scalar()
    placed = range_bucket(F.col(order), F.col("_bounds"), buckets)
    cells = df.withColumn("_bounds", cut).withColumn("_bucket", placed).drop("_bounds")
    way = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    earlier = W.orderBy(way("_bucket")).rowsBetween(W.unboundedPreceding, -1)
    starts = cells.groupBy("_bucket").agg(*[F.sum(t).alias(f"_{t}") for t in totals])
    starts = starts.select(
        "_bucket",
        *[F.coalesce(F.sum(f"_{t}").over(earlier), F.lit(0)).alias(f"_start_{t}") for t in totals],
    )
    within = W.partitionBy("_bucket").orderBy(way(order)).rowsBetween(W.unboundedPreceding, 0)
    out = cells.select("*", *[F.sum(t).over(within).alias(f"_in_{t}") for t in totals])
    out = out.join(starts, "_bucket")
    return out.select(
        *df.columns,
        *[(F.col(f"_start_{t}") + F.col(f"_in_{t}")).alias(f"cum_{t}") for t in totals],
    )
