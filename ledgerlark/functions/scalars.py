"""Numeric, vector and text expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def flag(condition: Column) -> Column:
    """A 0/1 flag in which a missing operand counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def flag_at_least(c: Column, threshold: float) -> Column:
    return flag(c >= F.lit(threshold))


def votes_per_minute(votes: Column, runtime: Column) -> Column:
    return votes / (runtime + 1)


def age_from_year(year: Column, base_year: int) -> Column:
    return F.lit(base_year) - year


def decode(c: Column, names: Mapping[int, str]) -> Column:
    """Codes to names; an unknown code gives NULL."""
    out = F.lit(None).cast("string")
    for code, name in names.items():
        out = F.when(c == F.lit(code), F.lit(name)).otherwise(out)
    return out


def round_half_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)


def text_bar(c: Column, width: int = 20, block: str = "█") -> Column:
    """A bar of ``int(|c| * width)`` blocks."""
    return F.repeat(F.lit(block), F.floor(F.abs(c) * width).cast("int"))


def signed_label(c: Column, digits: int = 3) -> Column:
    sign = F.when(c > 0, F.lit("+")).otherwise(F.lit("-"))
    text = F.concat(sign, F.format_string(f"%.{digits}f", F.abs(c)))
    return F.when(c.isNotNull(), text)


def squared_distance(a: Column, b: Column) -> Column:
    """Squared euclidean distance of two array columns of the same length."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x
    )


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))


def literal_vector(values: Sequence[float]) -> Column:
    return F.expr(_vector_text(values))


def literal_matrix(rows: Sequence[Sequence[float]]) -> Column:
    return F.expr(f"array({', '.join(_vector_text(r) for r in rows)})")


def _vector_text(values: Sequence[float]) -> str:
    return f"array({', '.join(repr(float(v)) + 'D' for v in values)})"


def as_doubles(c: Column) -> Column:
    """float32 arrays must be widened before any distance is taken."""
    return F.transform(c, lambda x: x.cast("double"))


def leading_columns(vector: Column, dims: int, prefix: str = "x") -> list[Column]:
    """The first ``dims`` entries of an array column as double columns."""
    return [vector.getItem(i).cast("double").alias(f"{prefix}{i}") for i in range(dims)]
