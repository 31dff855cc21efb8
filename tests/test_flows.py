"""Whole analyses on small hand-made tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import features, rules
from ledgerlark.plans import flows


@pytest.fixture(scope="module")
def ledger(spark):
    """A raw ledger: text dates, signs, commas, a blank column."""
    names = ["Cafe Central", "OXXO 12", "Arriendo", "Taxi", "Transferencia", "Tienda"]
    rows = []
    for i in range(90):
        value = -(1000 + 700 * (i % 37)) if i % 9 else 50_000
        if names[i % 6] == "Arriendo":
            value *= 40
        rows.append((i, f"{1 + i % 28}/{1 + i % 12}/2024", f" {names[i % 6]} ", f"$ {value:,}", None))
    return spark.createDataFrame(rows, "id int, FECHA string, ` Descripcion` string, VALOR string, `Unnamed: 4` string")


def test_transaction_report(ledger):
    spent = flows.label_transactions(flows.clean_transactions(ledger))
    table = features.spending_features(spent)
    out = flows.transaction_report(table, "id", sample=20)
    assert set(out) == {
        "amount_histogram", "label_counts", "amount_boxes", "amount_boxes_zoom", "top_descriptions",
        "daily_totals", "frequency_scatter", "correlation",
    }
    assert out["amount_histogram"].agg(F.sum("n")).first()[0] == 80
    assert out["frequency_scatter"].count() == 20 and out["correlation"].count() == 100
    assert "top_descriptions" not in flows.transaction_report(table.drop(flows.LABEL), "id")


def test_hybrid_relabel(ledger):
    cleaned = flows.clean_transactions(ledger)
    spent = rules.keep_outflows(cleaned, "valor").where("id % 9 > 0")
    df = spent.select(
        "id",
        F.date_format("fecha", "d/M/yyyy").alias("FECHA"),
        F.col("descripcion").alias("DESCRIPCION"),
        F.abs("valor").alias("VALOR"),
        (F.abs("valor") < 15_000).cast("int").alias("ETIQUETA"),
    )
    matrix = flows.spending_matrix(df, terms=10)
    assert matrix.where(F.size("v") < 14).count() == 0
    out = flows.hybrid_relabel(matrix, "id", "ETIQUETA", restarts=1)
    found = out["assignments"].toPandas()
    assert found.groupby("algorithm").id.nunique().eq(80).all() and found.algorithm.nunique() == 5
    assert out["comparison"].count() == 6 and out["comparison"].agg(F.sum("best")).first()[0] == 1
    revised = out["revised"].toPandas()
    assert out["changes"].first()["changes"] == (revised.ETIQUETA != revised.revised).sum()


@pytest.fixture(scope="module")
def panel(spark):
    draw = np.random.default_rng(4)
    rows = []
    for i in range(80):
        y = i % 2
        gap = None if i % 13 == 0 else float(draw.normal(2 * y))
        rows.append((f"u{i % 8}|{2016 + i // 8}", f"u{i % 8}", 2016 + i // 8, gap, float(draw.normal(y)), float(draw.normal()), y))
    return spark.createDataFrame(rows, "id string, unidad string, anio int, a double, b double, c double, label int")


def test_panel_report(panel):
    out = flows.panel_report(panel, ["a", "b", "c"], "label", "unidad", "anio")
    assert [r["column"] for r in out["nulls"].collect()] == ["a"]
    assert out["by_unit"].count() == 8 and out["by_year"].count() == 10
    assert out["with_target"].first()["column"] == "a"


def test_panel_models(panel):
    out = flows.panel_models(panel, "id", ["a", "b", "c"], "label", folds=2, trees=5, rounds=3).collect()
    assert {r["model"] for r in out} == {"tree", "forest", "boosting"}
    assert sum(r["best"] for r in out) == 1 and all(0.4 <= r["roc_auc"] <= 1 for r in out)


def test_cluster_audit(panel):
    out = flows.cluster_audit(panel.drop("unidad", "anio"), "id", "label", restarts=2)
    hits = out["hits"].toPandas()
    assert len(hits) == 73
    assert out["mislabelled"].count() <= 73 and out["agreement"].first()["agreement"] >= 50
    assert out["contingency"].agg(F.sum("n")).first()[0] == 73
