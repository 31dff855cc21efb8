"""The driver contract, and a few queries next to their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_flagship(spark):
    out = contract.entry(spark)
    assert out.columns == ["fecha", "es_gasto_hormiga", "total", "n", "share"] and out.count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries()) and len(contract.queries()) > 100


@pytest.mark.parametrize(
    "name",
    ["flagship_daily_small_spend", "label_ordered_rules", "group_broadcast_features", "quantile_bins",
     "parse_records", "null_profile", "split_three_way", "confusion", "consensus_relabel", "tfidf_top_terms"],
)
def test_query_equals_sql(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR)
    rel = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    want = sorted(map(str, (tuple(r[names.index(c)] for c in sorted(names)) for r in rel.fetchall())))
    assert sorted(names) == sorted(got.columns)
    rows = sorted(str(tuple(r[c] for c in sorted(names))) for r in got.collect())
    assert rows == want and rows
