"""Parsing of dirty text columns. A value that does not parse becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

DAY_FIRST = "d/M/yyyy"
MONTH_FIRST = "M/d/yyyy"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def nan_to_null(c: Column) -> Column:
    """Spark aggregates do not skip NaN, so missing numbers are held as NULL only."""
    return F.when(~F.isnan(c), c)


def parse_money(c: Column) -> Column:
    """``"$ 1,234.50"`` to 1234.5: drops dollar signs, spaces and thousands commas. Other text is NULL."""
    bare = F.translate(F.trim(c.cast("string")), "$ ,", "")
    return F.when(bare.rlike(NUMBER), bare.try_cast("double"))


def parse_day_first(c: Column, default_year: int | None = None) -> Column:
    """Day-first dates; ``12/03`` without a year takes ``default_year``, else it is NULL."""
    return _whole_date(_with_year(c, default_year), DAY_FIRST)


def _with_year(c: Column, default_year: int | None) -> Column:
    """Trimmed text, NULL if blank, with the default year where there is none."""
    text = F.trim(c)
    text = F.when(text != "", text)
    if default_year is None:
        return text
    yearless = text.rlike(r"^\d{1,2}/\d{1,2}$")
    return F.when(yearless, F.concat(text, F.lit(f"/{default_year}"))).otherwise(text)


def _whole_date(text: Column, pattern: str) -> Column:
    shaped = F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), text)
    return F.try_to_date(shaped, pattern)


def with_date_ladder(
    df: DataFrame, source: str, target: str, default_year: int | None = None
) -> DataFrame:
    """Parse a date column with the first pattern that fits the WHOLE column.

    Day-first is tried, then month-first, each on the values as they are with ``default_year``
    added; blanks decide nothing. If neither fits every value, each row is read day-first on its
    own and misfits become NULL. One scan decides for the column.
    """
    text = _with_year(F.col(source), default_year)
    misfits = df.agg(
        *[
            F.count_if(text.isNotNull() & _whole_date(text, p).isNull()).alias(n)
            for n, p in (("day", DAY_FIRST), ("month", MONTH_FIRST))
        ]
    )
    month_first = misfits.select((F.col("day") > 0) & (F.col("month") == 0)).scalar()
    parsed = F.when(month_first, _whole_date(text, MONTH_FIRST)).otherwise(_whole_date(text, DAY_FIRST))
    return df.withColumn(target, parsed)


def clean_text(c: Column, upper: bool = False) -> Column:
    """Trim and change case; NULL stays NULL and so matches no keyword."""
    return F.trim(F.upper(c) if upper else F.lower(c))


def strip_punctuation(c: Column) -> Column:
    """Remove all that is neither a word character of any script nor white space."""
    return F.regexp_replace(c, r"(?U)[^\w\s]", "")


def parse_grouped_integer(c: Column) -> Column:
    """``"1,234,567"`` to 1234567."""
    return F.replace(c, F.lit(","), F.lit("")).try_cast("bigint")


def parse_leading_integer(c: Column, missing: str = "N/A") -> Column:
    """``"148 min"`` to 148; the missing marker counts as 0."""
    return F.when(c == missing, F.lit(0)).otherwise(F.split(c, " ").getItem(0).try_cast("int"))


def parse_start_year(c: Column) -> Column:
    """``"2010"`` or the start of ``"2001–2005"``."""
    return F.split(c, "–").getItem(0).try_cast("int")


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """Plain substring test against a word list, as one regular expression of quoted words.

    An empty list matches nothing; an empty word is in every text.
    """
    if not words:
        return F.lit(False)
    quoted = "|".join("\\Q" + w.replace("\\E", "\\E\\\\E\\Q") + "\\E" for w in words)
    return F.coalesce(c.rlike(quoted), F.lit(False))
