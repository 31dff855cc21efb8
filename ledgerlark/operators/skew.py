"""Group results attached to rows without gathering a hot group in one task.

A window over a key moves all rows of that key to one task. Here each group is aggregated
first (with map-side partial results), and the small result is joined back. For that join every key with more than
``1 / HOT_SHARE`` of a shuffle partition's mean rows is cut into pieces of ``1 / PIECES`` of that mean, as many as its
exact row count asks for, so the load of a partition comes from many small pieces at any table size. Fewer than
``HOT_SHARE`` keys per partition can be that large, which bounds the list of hot keys that is broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

HOT_SHARE = 4
PIECES = 16


def partitions(df: DataFrame) -> int:
    """Partitions of a shuffle, as the session has them."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def attach_group_aggregates(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: Mapping[str, Column],
    source: DataFrame | None = None,
) -> DataFrame:
    """Add group aggregates to every row; rows whose key is NULL get NULL.

    ``source`` is the table the groups are taken from (``df`` itself by default).
    """
    stats = (
        (df if source is None else source)
        .dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in aggregates.items()])
    )
    return attach_by_key(df, stats, keys, "_rows").drop("_rows")


def attach_by_key(df: DataFrame, table: DataFrame, keys: Sequence[str], rows: str) -> DataFrame:
    """Left join ``df`` with a one-row-per-key ``table`` holding the row count of each key.

    Rows without a key match nothing and are spread as well.
    """
    keys, parts = list(keys), partitions(df)
    mean = table.agg(F.sum(rows) / parts).scalar()
    pieces = F.ceil(PIECES * F.col(rows) / F.col("_mean")).cast("int")
    large = table.select(*keys, rows).withColumn("_mean", mean).where(F.col(rows) * HOT_SHARE > F.col("_mean"))
    hot = F.broadcast(large.select(*keys, pieces.alias("_pieces")))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    spread = F.when(no_key, PIECES * parts).otherwise(F.coalesce("_pieces", F.lit(1)))
    left = df.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*df.columns), spread).cast("int"))
    salts = F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)
    right = table.join(hot, keys, "left").withColumn("_salt", F.explode(salts)).drop("_pieces")
    joined = left.join(right, keys + ["_salt"], "left")
    added = [c for c in table.columns if c not in keys]
    return joined.select(*df.columns, *added)


def checked_broadcast(
    table: DataFrame, source: DataFrame, by: Sequence[str], limit: int = 10_000
) -> DataFrame:
    """Broadcast a table with one row per group of ``source``; the query fails if there are too many.

    The groups are counted by a sketch over the key columns alone, not by running the table twice.
    """
    if not by:
        return F.broadcast(table)
    groups = source.agg(F.approx_count_distinct(F.struct(*by))).scalar()
    message = F.lit(f"a table meant for broadcast has more than {limit} groups of {list(by)}")
    return F.broadcast(table.where(F.when(groups <= limit, True).otherwise(F.raise_error(message))))


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, spread_on: str
) -> DataFrame:
    """The ``k`` first rows of each group in two steps, so that a hot group is split by salt.

    The first step keeps at most ``k`` rows per (group, salt); the second sees ``k`` per partition of a shuffle.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread_on), F.lit(partitions(df))))
    first = W.partitionBy(*keys, "_salt").orderBy(*order)
    last = W.partitionBy(*keys).orderBy(*order)
    return (
        salted.withColumn("_n", F.row_number().over(first))
        .where(F.col("_n") <= k)
        .withColumn("_n", F.row_number().over(last))
        .where(F.col("_n") <= k)
        .drop("_salt", "_n")
    )


def bounded_values(df: DataFrame, column: str, limit: int = 1000) -> list:
    """The sorted distinct values of a column that must be few, such as a class label."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"column {column} holds more than {limit} distinct values")
    return sorted(r[0] for r in rows)
