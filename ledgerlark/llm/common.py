"""Helpers that the operators share: input columns, Arrow tasks and span texts."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One input table, by whatever path Spark can open."""
    short_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Send whole texts to Python in batches of so many rows, unless the session has its own number."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":  # Spark's default, made for narrow rows
        spark.conf.set(key, str(rows))


def tidied(run: Callable) -> Callable:
    """Give what a task has used back to the system at its end; Python workers outlive their tasks."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU C library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def with_column(df: DataFrame, text_col: str, name: str, kind: str, make: Callable[[], Callable]) -> DataFrame:
    """``df`` with a column ``name`` made from a text column, in place of any column of that name.

    ``make()`` gives a function from a list of texts (NULL as the empty string) to a list of values.
    """
    keep = [c for c in df.columns if c != name]
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = make()
        for whole in batches:
            texts = [t or "" for t in whole.column(at).to_pylist()]
            for lo, hi in slices(texts):
                batch = whole.slice(lo, hi - lo)
                made = pa.array(many(texts[lo:hi]), _ARROW[kind])
                rest = [c for c, n in zip(batch.columns, names, strict=True) if n != name]
                yield pa.RecordBatch.from_arrays([*rest, made], names=[*keep, name])

    names = df.columns
    schema = StructType([f for f in df.schema if f.name != name] + [StructField(name, _parse_datatype(kind))])
    return df.mapInArrow(tidied(run), schema)


def _parse_datatype(kind: str) -> DataType:
    return {"long": LongType(), "string": StringType()}[kind]


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns a text operator needs, whatever other columns the table carries."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )


def slices(texts: list[str], rows: int = 512, chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Cut a list of texts into stretches of at most ``rows`` texts and, but for a longer single text, ``chars``."""
    lo, total = 0, 0
    for i, t in enumerate(texts):
        if i > lo and (i - lo >= rows or total + len(t) > chars):
            yield lo, i
            lo, total = i, 0
        total += len(t)
    if texts:
        yield lo, len(texts)


def per_batch(docs: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """One output row per row of (doc_id, text, ...), some hundred texts at a time.

    ``make()`` is called once per task and gives a function from a list of texts (NULL arrives as the
    empty string) to one tuple of the ``schema`` columns per text. The text itself is not passed on.
    """
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [_ARROW[x.split()[1]] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = make()
        for whole in batches:
            texts = [t or "" for t in whole.column(1).to_pylist()]
            for lo, hi in slices(texts):
                batch, out = whole.slice(lo, hi - lo), many(texts[lo:hi])
                made = [pa.array([r[k] for r in out], type=kinds[k]) for k in range(len(names))]
                keep = [k for k in range(batch.num_columns) if k != 1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k) for k in keep] + made, names=[batch.schema.names[k] for k in keep] + names
                )

    others = [f"`{n}` {t}" for n, t in docs.dtypes if n != "text"]
    return docs.mapInArrow(tidied(run), ", ".join([*others, schema]))


def per_text(docs: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """As ``per_batch`` with a function of one text."""

    def make_many():
        one = make()
        return lambda texts: [one(t) for t in texts]

    return per_batch(docs, make_many, schema)


_ARROW = {
    "long": pa.int64(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(),
    "int": pa.int32(), "array<string>": pa.list_(pa.string()),
}


def span_text(spans: Iterable[tuple[int, str, int]], order: dict[str, int]) -> str:
    """``kind:start:end`` of (start, kind, end) by start, then by the order of the kinds, then by end."""
    ranked = sorted(spans, key=lambda s: (s[0], order[s[1]], s[2]))
    return ",".join(f"{k}:{a}:{b}" for a, k, b in ranked)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
