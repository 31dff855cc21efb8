"""Semi-structured records: JSON text to typed rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerlark.functions.parse import (
    nan_to_null,
    parse_grouped_integer,
    parse_leading_integer,
    parse_start_year,
)

MOVIE_FIELDS = ["Response", "Title", "imdbRating", "imdbVotes", "Runtime", "Year"]


def parse_movies(df: DataFrame, raw: str) -> DataFrame:
    """Typed film records; a reply that was refused, or has any bad field, is dropped.

    The text is read once, by a generator, which filters on the parsed fields cannot repeat.
    """
    others = [c for c in df.columns if c != raw]
    reply = df.select(*others, F.json_tuple(raw, *MOVIE_FIELDS).alias(*MOVIE_FIELDS))
    fields = {
        "title": F.col("Title"),
        "rating": nan_to_null(F.col("imdbRating").try_cast("double")),
        "votes": parse_grouped_integer(F.col("imdbVotes")),
        "runtime": parse_leading_integer(F.col("Runtime")),
        "year": parse_start_year(F.col("Year")),
    }
    accepted = reply.where(F.col("Response") == "True")
    typed = accepted.select(*others, *[c.alias(n) for n, c in fields.items()])
    return typed.where(reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in fields]))
