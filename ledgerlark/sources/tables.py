"""Delimited text in and out, and header clean-up."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlark.functions.parse import NUMBER, nan_to_null
from ledgerlark.session import scratch_path

BLANK_HEADER = re.compile(r"^(Unnamed.*|_c\d+)$")


#: Cells that stand for a missing value.
MISSING = ("", "NA", "N/A", "NaN", "nan", "-nan", "n/a", "NULL", "null", "None", "<NA>", "#N/A")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    sep: str = ",",
    missing: Sequence[str] = MISSING,
) -> DataFrame:
    """A delimited file with a header; a byte-order mark is dropped.

    Cells among ``missing``, numbers that are NaN and cells that do not fit the type are NULL. Without a
    ``schema`` one extra scan finds the columns whose cells are all whole or all decimal numbers.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", "UTF-8")
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if schema is not None:
        reader = reader.schema(StructType([StructField(f.name, StringType()) for f in schema]))
    raw = reader.csv(path)
    cells = {c: F.col(f"`{c}`") for c in raw.columns}
    text = raw.select(*[F.when(~F.trim(x).isin(*missing), x).alias(c) for c, x in cells.items()])
    if schema is not None:
        kinds = {f.name: f.dataType.simpleString() for f in schema}
    else:
        kinds = _kinds(text)

    def typed(c: str) -> Column:
        kind = kinds[c]
        if kind == "string":
            return cells[c]
        value = F.trim(cells[c]).try_cast(kind)
        return nan_to_null(value) if kind in ("double", "float") else value

    return text.select(*[typed(c).alias(c) for c in text.columns])


def _kinds(text: DataFrame) -> dict[str, str]:
    """bigint, double or string for each column of a table of texts."""
    whole, number = r"^[+-]?\d{1,18}$", NUMBER
    counts = []
    for i, c in enumerate(text.columns):
        cell = F.trim(F.col(f"`{c}`"))
        counts += [F.count(cell).alias(f"n{i}"), F.count_if(cell.rlike(whole)).alias(f"w{i}"), F.count_if(cell.rlike(number)).alias(f"d{i}")]
    row = text.agg(*counts).first()
    out = {}
    for i, c in enumerate(text.columns):
        n = row[f"n{i}"]
        out[c] = "bigint" if n and row[f"w{i}"] == n else "double" if n and row[f"d{i}"] == n else "string"
    return out


def write_csv(df: DataFrame, path: str | None = None, sep: str = ",") -> str:
    """Write with a header and without an index; returns the path (a fresh shared one by default)."""
    target = path or scratch_path(df.sparkSession, "csv")
    df.write.option("header", True).option("sep", sep).csv(target)
    return target


def write_report(df: DataFrame, path: str | None = None) -> str:
    """Persist a metric or importance table as JSON lines."""
    target = path or scratch_path(df.sparkSession, "report")
    df.write.json(target)
    return target


def drop_blank_columns(df: DataFrame) -> DataFrame:
    """Drop columns whose header was blank in the file."""
    return df.drop(*[c for c in df.columns if BLANK_HEADER.match(c)])


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def strip_labels(df: DataFrame, label: str) -> DataFrame:
    """The unlabelled twin of a labelled table."""
    return df.drop(label)


def concat_columns(left: DataFrame, right: DataFrame, row_id: str) -> DataFrame:
    """Put two tables of the same rows side by side; rows are matched by id, not by position."""
    return left.join(right, row_id)


def attach_labels(df: DataFrame, labelled: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Bring labels back from another table by key."""
    return df.join(labelled.select(*keys, F.col(label)), keys)
