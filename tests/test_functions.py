"""Parsing, calendar and scalar expressions on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlark import presets
from ledgerlark.functions import calendar, parse, scalars
from ledgerlark.operators import rules
from ledgerlark.sources import records, tables


def values(df, column):
    return [r[column] for r in df.orderBy("i").collect()]


def frame(spark, items, kind="string"):
    return spark.createDataFrame(list(enumerate(items)), f"i int, x {kind}")


def test_money(spark):
    df = frame(spark, ["$ 1,234.50", "-3 000", "", "abc", "nan", None, "$900", "12d", "1f", "Infinity", ".5", "1e3"])
    out = df.withColumn("y", parse.parse_money(F.col("x")))
    assert values(out, "y") == [1234.5, -3000.0, None, None, None, None, 900.0, None, None, None, 0.5, 1000.0]


def test_contains_any_quotes_its_words(spark):
    df = frame(spark, ["a\\Eb", "abc", None, "x.z"])
    hit = lambda words: values(df.withColumn("y", parse.contains_any(F.col("x"), words)), "y")
    assert hit([]) == [False] * 4
    assert hit(["\\E", "."]) == [True, False, False, True]
    assert hit(["bc"]) == [False, True, False, False]


def test_date_ladder_ignores_blanks_and_adds_the_year(spark):
    ladder = lambda texts, year=None: values(parse.with_date_ladder(frame(spark, texts), "x", "y", year), "y")
    us = ["12/25/2020", "3/31/2021", "4/5/2021"]
    want = [dt.date(2020, 12, 25), dt.date(2021, 3, 31), dt.date(2021, 4, 5)]
    assert ladder([*us, "", " ", None]) == [*want, None, None, None]
    assert ladder([*us, "4/5"], 2024) == [*want, dt.date(2024, 4, 5)]
    assert ladder(["25/12", "4/5/2021"], 2024) == [dt.date(2024, 12, 25), dt.date(2021, 5, 4)]
    assert ladder(["", None]) == [None, None]


def test_csv_missing_marks(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b,c,d\n1,NaN,x,1.5\n,2,NA,NaN\n3,N/A,,2\n")
    df = tables.read_csv(spark, str(path))
    assert dict(df.dtypes) == {"a": "bigint", "b": "bigint", "c": "string", "d": "double"}
    rows = sorted(df.collect(), key=str)
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(
        map(str, [(1, None, "x", 1.5), (None, 2, None, None), (3, None, None, 2.0)])
    )
    typed = tables.read_csv(spark, str(path), "a int, b double, c string, d double", missing=["", "NA"])
    assert typed.where("isnan(b) OR isnan(d)").count() == 0 and typed.where("b IS NULL").count() == 2


def test_day_first_dates(spark):
    df = frame(spark, ["3/09/2024", "31/12/2023", "12/12", "31/02/2024", "junk", None])
    out = df.withColumn("y", parse.parse_day_first(F.col("x")))
    assert values(out, "y") == [dt.date(2024, 9, 3), dt.date(2023, 12, 31), None, None, None, None]
    out = df.withColumn("y", parse.parse_day_first(F.col("x"), 2020))
    assert values(out, "y")[2] == dt.date(2020, 12, 12)


@pytest.mark.parametrize(
    "texts, expected",
    [
        (["01/02/2024", "25/12/2024"], [dt.date(2024, 2, 1), dt.date(2024, 12, 25)]),
        (["01/02/2024", "12/25/2024"], [dt.date(2024, 1, 2), dt.date(2024, 12, 25)]),
        (["25/12/2024", "12/25/2024"], [dt.date(2024, 12, 25), None]),
        (["01/02/2024", None], [dt.date(2024, 2, 1), None]),
    ],
)
def test_date_ladder_decides_for_the_column(spark, texts, expected):
    assert values(parse.with_date_ladder(frame(spark, texts), "x", "y"), "y") == expected


def test_text_cleaning_keeps_letters_of_all_scripts(spark):
    df = frame(spark, ["  Peñón S.A.S!  ", None])
    cleaned = parse.strip_punctuation(parse.clean_text(F.col("x"), upper=True))
    assert values(df.withColumn("y", cleaned), "y") == ["PEÑÓN SAS", None]


def test_film_fields(spark):
    df = frame(spark, ["1,234,567", "148 min", "N/A", "2001–2005", "2010"])
    out = df.select(
        "i",
        parse.parse_grouped_integer(F.col("x")).alias("votes"),
        parse.parse_leading_integer(F.col("x")).alias("runtime"),
        parse.parse_start_year(F.col("x")).alias("year"),
    )
    assert values(out, "votes")[0] == 1_234_567
    assert values(out, "runtime")[1:3] == [148, 0]
    assert values(out, "year")[3:] == [2001, 2010]


def test_bad_records_are_dropped(spark):
    good = '{"Response":"True","Title":"a","imdbRating":"8.1","imdbVotes":"1,200","Runtime":"N/A","Year":"1999"}'
    texts = [good, good.replace("True", "False"), good.replace("8.1", "N/A"), good[:30], "", None]
    out = records.parse_movies(frame(spark, texts), "x").collect()
    assert [tuple(r) for r in out] == [(0, "a", 8.1, 1200, 0, 1999)]


def test_calendar(spark):
    df = frame(spark, [dt.date(2024, 1, 6), dt.date(2024, 1, 8), None], "date")
    parts = calendar.calendar_parts(F.col("x"))
    rows = df.select("i", *[c.alias(n) for n, c in parts.items()]).orderBy("i").collect()
    assert rows[0]["dia_semana"] == 5 and rows[0]["es_fin_semana"] == 1 and rows[0]["semana"] == 1
    assert rows[1]["dia_semana"] == 0 and rows[1]["es_fin_semana"] == 0
    assert rows[2]["dia"] is None and rows[2]["es_fin_semana"] == 0


def test_flags_and_formats(spark):
    df = frame(spark, [8.0, 7.99, None, -0.456], "double")
    out = df.select(
        "i",
        scalars.flag_at_least(F.col("x"), 8.0).alias("f"),
        scalars.text_bar(F.col("x") / 10).alias("bar"),
        scalars.signed_label(F.col("x")).alias("s"),
        scalars.round_half_even(F.lit(0.125), 2).alias("r"),
    )
    assert values(out, "f") == [1, 0, 0, 0]
    assert values(out, "bar")[0] == "█" * 16
    assert values(out, "s") == ["+8.000", "+7.990", None, "-0.456"]
    assert values(out, "r")[0] == 0.12


def test_small_spend_rule(spark):
    rows = [("cafe", -9000.0), ("cafe", -25000.0), ("cafe", -25001.0), ("pago metro", -10.0), (None, -5.0), ("x", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, d string, v double")
    label = rules.small_spend_flag(
        F.col("d"), F.col("v"), presets.SMALL_SPEND_EXCLUDED, presets.SMALL_SPEND_THRESHOLD
    )
    assert values(df.withColumn("y", label), "y") == [1, 1, 0, 0, 1, 0]


def test_ordered_rule(spark):
    rows = [(" hym farmacia", 90_000.0), ("Farmacia", 5.0), ("tienda", 14_999.0), ("tienda", 15_000.0), (None, 1.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, d string, v double")
    label = rules.ordered_keyword_label(
        F.col("d"), F.col("v"), presets.ALWAYS_SMALL, list(presets.NEVER_SMALL.values()), 15_000
    )
    got = values(df.withColumn("y", label), "y")
    assert got == ["HORMIGA", "NO_HORMIGA", "HORMIGA", "NO_HORMIGA", "HORMIGA"]


def test_not_in_keeps_missing_and_is_exact(spark):
    df = frame(spark, ["A", "a", " A", None])
    assert values(rules.exclude_values(df, "x", ["A"]), "x") == ["a", " A", None]


def test_stress_needs_two_years_in_a_row(spark):
    rows = [
        ("u", 2016, -1.0, 2.0, 90.0), ("u", 2018, -1.0, 2.0, 90.0), ("u", 2019, -2.0, 2.0, 90.0),
        ("v", 2016, 5.0, 0.5, 90.0), ("v", 2017, None, None, None), ("v", 2018, 1.0, 3.0, 29.0),
    ]
    df = spark.createDataFrame(rows, "u string, y int, cfo double, liq double, days double")
    out = rules.stress_label(df, "u", "y", "cfo", "liq", "days").orderBy("u", "y").collect()
    assert [r["tension"] for r in out] == [0, 0, 1, 1, 0, 1]


def test_threshold_ladder_falls_through(spark):
    df = frame(spark, [7.9, 7.6, 7.6, 7.0, 6.0], "double")
    out = rules.threshold_ladder(df, "x", presets.SUCCESS_LADDER)
    assert {r["threshold"] for r in out.collect()} == {8.0}  # one class alone counts as its own size
    out = rules.threshold_ladder(frame(spark, [8.2, 7.6, 7.6, 7.0], "double"), "x", presets.SUCCESS_LADDER)
    assert {r["threshold"] for r in out.collect()} == {7.0}
    assert values(out, "success") == [1, 1, 1, 1]


def test_csv_keeps_header_spaces_until_normalised(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("﻿FECHA; Valor ;\n3/09/2024;$ 5;\n;;\n", encoding="utf-8")
    raw = tables.read_csv(spark, str(path), sep=";")
    out = tables.normalise_headers(tables.drop_blank_columns(raw))
    assert out.columns == ["fecha", "valor"]
    assert [tuple(r) for r in out.collect()] == [("3/09/2024", "$ 5"), (None, None)]


def test_rules_run_on_a_stream(spark, tmp_path):
    spark.createDataFrame([("cafe", -9.0), ("taxi", -9.0)], "d string, v double").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("d string, v double").parquet(str(tmp_path / "in"))
    label = rules.small_spend_flag(F.col("d"), F.col("v"), ["taxi"], 100.0)
    running = (
        stream.withColumn("y", label).writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    running.awaitTermination(60)
    got = {(r["d"], r["y"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("cafe", 1), ("taxi", 0)}
