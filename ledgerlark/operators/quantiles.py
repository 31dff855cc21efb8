"""Exact quantiles and order statistics of large columns, by radix selection.

The built-in exact ``percentile`` holds every distinct value of a group in one task. Here a value is its 64 bits, in an order that is
that of the numbers, and a wanted rank is found 16 bits at a time: one scan counts the values of each group by their first
16 bits, which tells the bits of every wanted rank; the next scan counts by the next 16 bits among values
that begin like a wanted one, and so on. After four scans all bits are known, whatever the size or shape of the column.
At most 65 536 counters per group, column and wanted beginning are shuffled, and no value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlark.operators.skew import checked_broadcast
from ledgerlark.session import cut_lineage

#: Bits that a scan settles; four times as many are all.
DIGIT = 16
_LOWEST = -(1 << 63)


def unpivot(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long form (by..., column, value) of numeric columns, without missing values."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return df.select(*by, F.inline(cells)).where(F.col("value").isNotNull())


def _ordered_bits(value: Column) -> Column:
    """The bits of a double, ordered as unsigned numbers like the doubles; both zeros are one."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0)).cast("long")
    return F.when(bits < 0, F.bitwise_not(bits)).otherwise(bits.bitwiseXOR(F.lit(_LOWEST)))


def _double(ordered: Column) -> Column:
    bits = F.when(ordered < 0, ordered.bitwiseXOR(F.lit(_LOWEST))).otherwise(F.bitwise_not(ordered))
    return F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), bits).cast("double")


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    method: str = "linear",
) -> DataFrame:
    """Rows (by..., column, n, prob, value).

    ``linear`` interpolates between the two nearest ranks; ``index`` takes the value at zero-based
    rank ``floor(n * prob)``. ``by`` must have few groups, such as a class label.
    """
    by, probs = list(by), [float(p) for p in probs]
    keys = by + ["column"]
    rows = unpivot(df, columns, by).select(*keys, _ordered_bits(F.col("value")).alias("_bits"))
    ranks = F.array_distinct(F.array(*[r(p, method).cast("long") for p in probs for r in (_low_rank, _high_rank)]))
    wanted: DataFrame | None = None
    for shift in range(64 - DIGIT, -1, -DIGIT):
        digit = F.shiftrightunsigned("_bits", shift).bitwiseAND(F.lit((1 << DIGIT) - 1)).alias("_digit")
        within, some = keys, rows
        if wanted is not None:
            within = keys + ["_start"]
            starts = checked_broadcast(wanted.select(*within).distinct(), df, by)
            some = rows.withColumn("_start", F.shiftrightunsigned("_bits", shift + DIGIT)).join(starts, within)
        cells = some.groupBy(*within, digit).agg(F.count(F.lit(1)).alias("_rows"))
        upto = W.partitionBy(*within).orderBy("_digit").rowsBetween(W.unboundedPreceding, 0)
        cells = cells.withColumn("_to", F.sum("_rows").over(upto)).withColumn("_from", F.col("_to") - F.col("_rows"))
        if wanted is None:
            cells = cells.withColumn("n", F.sum("_rows").over(W.partitionBy(*keys)))
            found = cells.withColumn("rank", F.explode(ranks)).withColumn("_rest", F.col("rank"))
            start = F.col("_digit").cast("long")
        else:
            found = cells.join(wanted, within)
            start = F.shiftleft("_start", DIGIT).bitwiseOR(F.col("_digit"))
        found = found.where((F.col("_from") <= F.col("_rest")) & (F.col("_rest") < F.col("_to")))
        wanted = cut_lineage(found.select(*keys, "n", "rank", (F.col("_rest") - F.col("_from")).alias("_rest"), start.alias("_start")))
    wanted = wanted.withColumn("_number", _double(F.col("_start")))
    entry = F.struct("rank", "_number")
    values = wanted.groupBy(*keys, "n").agg(F.map_from_entries(F.collect_list(entry)).alias("_value"))
    results = F.array(*[F.struct(F.lit(p).alias("prob"), _interpolate(p, method).alias("value")) for p in probs])
    return values.select(*keys, "n", F.inline(results))


def _position(p: float) -> Column:
    return F.lit(p) * (F.col("n") - 1)


def _low_rank(p: float, method: str) -> Column:
    if method == "index":
        return F.least(F.floor(F.lit(p) * F.col("n")), F.col("n") - 1)
    return F.floor(_position(p))


def _high_rank(p: float, method: str) -> Column:
    return _low_rank(p, method) if method == "index" else F.ceil(_position(p))


def _interpolate(p: float, method: str) -> Column:
    low, high = (F.col("_value")[r(p, method).cast("long")] for r in (_low_rank, _high_rank))
    if method == "index":
        return low
    return low + (high - low) * (_position(p) - F.floor(_position(p)))


def quantile_row(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], method: str = "linear"
) -> Column:
    """A scalar for projections: map from column name to the array of its quantiles.

    Put it into a column once; each further mention would plan the whole subquery again.
    """
    long = exact_quantiles(df, columns, probs, method=method)
    per_column = long.groupBy("column").agg(
        F.sort_array(F.collect_list(F.struct("prob", "value"))).alias("q")
    )
    entry = F.struct("column", F.transform("q", lambda s: s["value"]))
    return per_column.agg(F.map_from_entries(F.collect_list(entry))).scalar()

