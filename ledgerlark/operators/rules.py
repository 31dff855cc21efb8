"""Filters, flags and rule-based labels."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.functions.parse import clean_text, contains_any
from ledgerlark.functions.scalars import flag, flag_at_least
from ledgerlark.operators.quantiles import exact_quantiles
from ledgerlark.operators.skew import attach_by_key


def require(df: DataFrame, columns: Sequence[str]) -> bool:
    """True if all columns exist; optional outputs are skipped otherwise."""
    return set(columns) <= set(df.columns)


def first_present(df: DataFrame, wanted: Sequence[str], fallback: int = 0) -> str:
    """The first wanted column that exists, else the numeric column at ``fallback``."""
    for name in wanted:
        if name in df.columns:
            return name
    return numeric_columns(df)[fallback]


def numeric_columns(df: DataFrame) -> list[str]:
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [c for c, t in df.dtypes if t in numeric or t.startswith("decimal")]


def categorical_columns(df: DataFrame) -> list[str]:
    numeric = set(numeric_columns(df))
    return [c for c in df.columns if c not in numeric]


def keep_outflows(df: DataFrame, amount: str) -> DataFrame:
    return df.where(F.col(amount) < 0)


def exclude_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Exact, case-sensitive NOT IN; rows without a value stay."""
    return df.where(F.coalesce(~F.col(column).isin(list(values)), F.lit(True)))


def with_known_target(df: DataFrame, target: str) -> DataFrame:
    return df.where(F.col(target).isNotNull()).withColumn(target, F.col(target).cast("int"))


def fences(df: DataFrame, columns: Sequence[str], width: float = 1.5) -> DataFrame:
    """Quartiles, IQR and fences per column, over rows where all the columns are known."""
    long = exact_quantiles(df.dropna(subset=list(columns)), columns, [0.25, 0.75])
    q = long.groupBy("column").agg(
        F.max("n").alias("n"),
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"),
    )
    iqr = F.col("q3") - F.col("q1")
    return q.select(
        "column",
        "n",
        "q1",
        "q3",
        iqr.alias("iqr"),
        (F.col("q1") - width * iqr).alias("lower"),
        (F.col("q3") + width * iqr).alias("upper"),
    )


def outlier_counts(df: DataFrame, columns: Sequence[str], width: float = 1.5) -> DataFrame:
    """One row: rows with all columns known, those inside all fences, and the outliers."""
    known = df.dropna(subset=list(columns))
    kept = keep_inliers(known, columns, width).agg(F.count(F.lit(1))).scalar()
    return known.agg(F.count(F.lit(1)).alias("judged")).select(
        "judged", kept.alias("inliers"), (F.col("judged") - kept).alias("outliers")
    )


def keep_inliers(df: DataFrame, columns: Sequence[str], width: float = 1.5) -> DataFrame:
    """Drop rows outside the fences of any column; a row with a missing value cannot be judged."""
    table = fences(df, columns, width)
    bounds = table.agg(
        F.map_from_entries(F.collect_list(F.struct("column", F.array("lower", "upper"))))
    ).scalar()
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    b = F.col("_bounds")
    inside = reduce(lambda x, y: x & y, [F.col(c).between(b[c][0], b[c][1]) for c in columns])
    return df.withColumn("_bounds", bounds).where(~known | inside).drop("_bounds")


@dataclass(frozen=True)
class Rule:
    """``label`` is given where ``condition`` holds and no earlier rule did."""

    condition: Column
    label: object


def rule_label(rules: Sequence[Rule], default: object) -> Column:
    """One CASE expression from ordered rules; an unknown condition counts as not met."""
    first, *rest = rules
    case = F.when(first.condition, F.lit(first.label))
    for rule in rest:
        case = case.when(rule.condition, F.lit(rule.label))
    return case.otherwise(F.lit(default))


def small_spend_flag(
    description: Column, amount: Column, excluded: Sequence[str], threshold: float
) -> Column:
    """1 for an amount up to the threshold, unless the description names an excluded kind of spend."""
    small = F.coalesce(F.abs(amount) <= F.lit(threshold), F.lit(False))
    return rule_label([Rule(contains_any(description, excluded), 0), Rule(small, 1)], 0)


def ordered_keyword_label(
    description: Column,
    amount: Column,
    always: Sequence[str],
    never: Sequence[Sequence[str]],
    threshold: float,
    yes: str = "HORMIGA",
    no: str = "NO_HORMIGA",
) -> Column:
    """Keyword lists in order of priority (``always`` first), then an amount below the threshold."""
    text = clean_text(description, upper=True)
    rules = [Rule(contains_any(text, always), yes)]
    rules += [Rule(contains_any(text, words), no) for words in never]
    rules.append(Rule(amount < F.lit(threshold), yes))
    return rule_label(rules, no)


def stress_label(
    df: DataFrame,
    unit: str,
    year: str,
    cash_flow: str,
    liquidity: str,
    cash_days: str,
    target: str = "tension",
) -> DataFrame:
    """1 if liquidity < 1, or cash days < 30, or cash flow is negative this year and the year before.

    The year before is looked up by (unit, year), so no busy unit gathers in one task.
    """
    before = df.groupBy(unit, (F.col(year) + 1).cast(df.schema[year].dataType).alias(year)).agg(
        F.bool_or(F.col(cash_flow) < 0).alias("_before"), F.count(F.lit(1)).alias("_rows")
    )
    joined = attach_by_key(df, before, [unit, year], "_rows")
    two_years = (F.col(cash_flow) < 0) & F.coalesce(F.col("_before"), F.lit(False))
    met = (
        flag(F.col(liquidity) < 1) + flag(F.col(cash_days) < 30) + flag(two_years)
    ) > 0
    return joined.select(*df.columns, met.cast("int").alias(target))


def threshold_ladder(
    df: DataFrame, score: str, ladder: Sequence[float], min_class: int = 2, target: str = "success"
) -> DataFrame:
    """Label ``score >= t`` with the first threshold whose smaller class has ``min_class`` rows.

    All thresholds are counted in one scan. A class without rows does not count as the smaller one,
    and the last threshold stands if none passes.
    """
    s = F.col(score)
    ups = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(flag_at_least(s, t)).alias(f"up{i}") for i, t in enumerate(ladder)]
    )
    chosen = F.lit(float(ladder[-1]))
    for i, t in reversed(list(enumerate(ladder))):
        up, down = F.col(f"up{i}"), F.col("n") - F.col(f"up{i}")
        smaller = F.when((up == 0) | (down == 0), F.col("n")).otherwise(F.least(up, down))
        chosen = F.when(smaller >= min_class, F.lit(float(t))).otherwise(chosen)
    threshold = ups.select(chosen).scalar()
    return df.withColumn("threshold", threshold).withColumn(
        target, flag(s >= F.col("threshold"))
    )
