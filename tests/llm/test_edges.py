"""NULLs, empty and very long texts, repeated rows, empty tables and clashing columns, for every text operator."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from cases import frame, odd_rows  # noqa: E402

from ledgerlark.llm import licenses, packing, pieces, pii, pitman, quality, secrets, simhash

LABELS = "doc_id long, quality int, toxic int, score string"


def labels(spark):
    return spark.createDataFrame([(5, 1, 0, "s"), (5, 1, 0, "s"), (None, 1, None, None), (6, 0, 1, ""), (7, None, 0, "")], LABELS)


OPERATORS = {
    "licenses": lambda spark, d: licenses.scan(d),
    "quality": lambda spark, d: quality.judge(d, labels(spark)),
    "pitman": lambda spark, d: pitman.score(d, rounds=2, burn_in=1),
    "simhash": lambda spark, d: simhash.grouped(d),
    "pii": lambda spark, d: pii.detect(d),
    "secrets": lambda spark, d: secrets.scan(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(spark, name):
    rows = odd_rows()
    got = OPERATORS[name](spark, frame(spark, rows)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    first, second = (r for r in got if r["doc_id"] == 6)
    for a, b in zip(first, second, strict=True):
        assert a == (pytest.approx(b, rel=1e-12) if isinstance(b, float) else b)
    assert len({c for c in got[0].asDict()}) == len(got[0])


@pytest.mark.parametrize("name", [*OPERATORS, "pieces", "packing"])
def test_empty_table(spark, name):
    empty = frame(spark, [])
    run = OPERATORS | {
        "pieces": lambda spark, d: pieces.sample(d, pieces.model_path()),
        "packing": lambda spark, d: packing.pack(d, packing.vocabulary_path()),
    }
    assert run[name](spark, empty).count() == 0


def test_null_and_empty_results(spark):
    d = frame(spark, odd_rows())
    by = {r["doc_id"]: r for r in licenses.scan(d).collect()}
    assert (by[1]["n_words"], by[1]["first_word"], by[1]["labels"], by[1]["score"]) == (0, None, "", 0.0)
    by = {r["doc_id"]: r for r in quality.judge(d, labels(spark)).collect()}
    for i in (1, 2, 3):
        assert by[i]["base_failed"] and not by[i]["kept"] and by[i]["n_words"] == 0 and by[i]["score"] == 0
    by = {r["doc_id"]: r for r in simhash.grouped(d).collect()}
    assert {by[i]["fingerprint"] for i in (1, 2, 3)} == {"0" * 16} and by[3]["component_id"] == 1
    assert by[11]["component_id"] == 10 and by[7]["component_id"] == 6
    by = {r["doc_id"]: r for r in pii.detect(d).collect()}
    assert by[1]["spans"] == by[2]["spans"] == "" and by[12]["n_ip"] == 1
    by = {r["doc_id"]: r for r in pitman.score(d, rounds=2, burn_in=1).collect()}
    assert by[1]["n_tokens"] == by[2]["n_tokens"] == by[3]["n_tokens"] == 1


def test_without_labels(spark):
    none = spark.createDataFrame([], LABELS)
    got = quality.judge(frame(spark, odd_rows()), none).collect()
    assert {r["score"] for r in got} == {0.0}


def test_whole_rows_come_back(spark):
    rows = odd_rows()
    d = frame(spark, rows)
    kept = quality.keep_good(d, labels(spark))
    assert kept.columns == d.columns
    verdict = quality.judge(d, labels(spark)).where("kept")
    assert sorted(map(str, kept.select("doc_id").collect())) == sorted(map(str, verdict.select("doc_id").collect()))
    one = simhash.keep_one(d)
    assert one.columns == d.columns
    groups = simhash.grouped(d)
    assert one.count() == groups.select(F.coalesce("component_id", F.lit(-1))).distinct().count()
    assert {r[0] for r in one.select("doc_id").collect()} >= {6, 1, 10} and not {7, 11} & {
        r[0] for r in one.select("doc_id").collect()
    }
    masked = pii.redact(d)
    assert masked.columns == d.columns and masked.count() == len(rows)
    assert masked.where("text IS NULL").count() == 2


def test_redact_updates_length(spark):
    d = spark.createDataFrame([(1, "mail a.b@c.de now", 17), (2, None, 0)], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: r for r in pii.redact(d).collect()}
    assert got[1]["text"] == "mail [EMAIL] now" and got[1]["n_chars"] == 16 and got[2]["text"] is None
