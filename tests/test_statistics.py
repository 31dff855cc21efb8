"""Quantiles, ranks, group features, profiling and evaluation against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import charts, evaluate, features, prep, profile, quantiles, ranking, skew, split
from ledgerlark.operators.modes import modes


@pytest.fixture(scope="module")
def numbers(spark):
    draw = np.random.default_rng(1)
    pdf = pd.DataFrame(
        {
            "id": np.arange(6000),
            "a": draw.normal(size=6000),
            "b": draw.integers(0, 7, 6000).astype(float),
            "g": draw.integers(0, 2, 6000),
        }
    )
    pdf.loc[::11, "a"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("a", F.when(~F.isnan("a"), F.col("a")))
    return pdf, df


def test_quantiles(numbers):
    pdf, df = numbers
    probs = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]
    out = quantiles.exact_quantiles(df, ["a", "b"], probs).collect()
    assert len(out) == 12
    for r in out:
        assert r["value"] == pytest.approx(pdf[r["column"]].quantile(r["prob"]), abs=1e-12)
    by = quantiles.exact_quantiles(df, ["a"], [0.25, 0.75], ["g"]).collect()
    assert len(by) == 4
    for r in by:
        assert r["value"] == pytest.approx(pdf[pdf.g == r["g"]].a.quantile(r["prob"]), abs=1e-12)


def test_quantiles_of_any_double(spark):
    """Signs, zeros, the least and the largest numbers, and neighbours that differ in the last bit."""
    x = [0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308, 1.0, np.nextafter(1.0, 2), np.nextafter(1.0, 0)]
    x += [float("inf"), float("-inf"), -1.0, 0.1, 0.30000000000000004, 0.3]
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    probs = [i / 15 + 0.01 for i in range(15)]
    got = {r["prob"]: r["value"] for r in quantiles.exact_quantiles(df, ["x"], probs, method="index").collect()}
    assert [got[p] for p in probs] == sorted(x)
    empty = quantiles.exact_quantiles(df.where("x > 1 AND x < 0"), ["x"], [0.5])
    assert empty.collect() == []


def test_order_statistic_by_index(numbers):
    pdf, df = numbers
    x = np.sort(pdf.a.dropna().to_numpy())
    got = quantiles.exact_quantiles(df, ["a"], [0.9], method="index").first()["value"]
    assert got == x[int(len(x) * 0.9)]


@pytest.mark.parametrize("x", [[1, 1, 1, 1, 2, 3, 9], [5, 1, 4, 2, 3], [7.0] * 4, [1, 1, 2, 2, 2, 2, 2, 8]])
def test_quantile_bins_match_qcut(spark, x):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, x double")
    got = [r["q"] for r in features.add_quantile_bin(df, "x", 5, "q").orderBy("i").collect()]
    if len(set(x)) == 1:
        assert got == [0] * len(x)
    else:
        assert got == pd.qcut(pd.Series(x), 5, labels=False, duplicates="drop").tolist()


def test_running_totals(spark):
    rows = [(float(i), i % 5) for i in range(500)]
    df = spark.createDataFrame(rows, "x double, n long")
    for down in (False, True):
        got = ranking.with_running_totals(df, "x", ["n"], descending=down, buckets=16).toPandas()
        got = got.sort_values("x", ascending=not down)
        assert (got.n.cumsum() == got.cum_n).all() and len(got) == 500


def test_group_features_with_missing_and_hot_keys(spark):
    rows = [(i, "hot" if i % 3 == 0 else None if i % 10 == 1 else f"k{i}", float(i)) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, k string, v double")
    out = features.add_group_profile(df, "k", "v").toPandas()
    pdf = df.toPandas()
    size = pdf.groupby("k")["v"].transform("size")
    merged = out.merge(pdf.assign(size=size)[["id", "size"]], on="id")
    assert len(out) == 900
    known = merged[merged.k.notna()]
    assert (known.freq_por_descripcion == known["size"]).all()
    assert merged[merged.k.isna()].freq_por_descripcion.isna().all()


@pytest.mark.parametrize("n", [4000, 40000])
def test_hot_keys_are_spread(spark, n):
    """One key with half of the rows, ten with most of the others: no partition gets twice the mean, at any size."""
    i = F.col("id")
    key = F.when(i % 2 == 0, F.lit(-1)).when(i % 20 > 1, -2 - i % 10).otherwise(i)
    df = spark.range(n).withColumn("k", key)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = skew.attach_group_aggregates(df, ["k"], {"n": F.count(F.lit(1))})
        loads = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        got = out.groupBy("k").agg(F.count(F.lit(1)).alias("have"), F.min("n").alias("a"), F.max("n").alias("b"))
        assert got.where("have != a OR have != b").count() == 0 and out.count() == n
        assert max(loads) < 2 * n / skew.partitions(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_k_per_group(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 2)
    got = skew.top_k_per_group(df, ["g"], [F.col("id")], 3, "id").orderBy("g", "id").collect()
    assert [r["id"] for r in got] == [0, 2, 4, 1, 3, 5]


def test_broadcast_guard(spark):
    df = spark.range(2000)
    table = df.groupBy("id").count()
    with pytest.raises(Exception, match="more than 10 groups"):
        df.join(skew.checked_broadcast(table, df, ["id"], 10), "id").collect()


def test_modes_and_skew_and_corr(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (3.0,), (3.0,), (2.0,)], "x double")
    assert modes(df, ["x"]).first()["mode"] == 1.0
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert profile.corrected_skewness(df, ["x"]).first()["skew"] == pytest.approx(1.7636, abs=1e-4)
    pairs = [(1.0, 2.0), (2.0, None), (3.0, 5.0), (4.0, 4.0)]
    df = spark.createDataFrame(pairs, "a double, b double")
    assert profile.correlations(df, ["a", "b"]).first()["corr"] == pytest.approx(0.785714, abs=1e-6)


def test_contingency_fills_absent_cells(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, -1)], "y int, c int")
    got = {(r["y"], r["c"]): (r["n"], r["pct"]) for r in profile.contingency(df, "y", "c").collect()}
    assert len(got) == 6 and got[(1, 0)] == (0, 0.0) and got[(1, -1)] == (1, 50.0)


def test_histogram_edges_and_constant_class(spark):
    rows = [("a", float(v)) for v in range(11)] + [("b", 5.0)] * 3
    df = spark.createDataFrame(rows, "g string, x double")
    got = charts.histogram(df, "x", 5, "g").toPandas()
    assert got[got.g == "a"].n.sum() == 11 and got[(got.g == "a") & (got.bin == 4)].n.iloc[0] == 3
    assert got[got.g == "b"][["bin", "n"]].values.tolist() == [[0, 3]]


def test_density_curve_equals_the_plain_sum(spark):
    """Also with far values, where most of the grid meets no cell, and with many copies of one value."""
    draw = np.random.default_rng(3)
    near = draw.normal(size=3000)
    for x in (near, np.r_[near, 1e5, -3e4], np.r_[near, np.full(4000, 0.25)], np.array([1.0, 2.0])):
        df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
        got = charts.density_curve(df, "x").toPandas().sort_values("i")
        h = x.std(ddof=1) * len(x) ** -0.2
        at = np.linspace(x.min() - 3 * h, x.max() + 3 * h, 200)
        want = np.exp(-0.5 * ((at[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
        assert got.i.tolist() == list(range(200)) and np.allclose(got.x, at)
        assert np.abs(got.density - want).max() * h < 1e-10


def test_density_without_spread(spark):
    for rows in ([(3.0,)], [(3.0,), (3.0,)]):
        got = charts.density_curve(spark.createDataFrame(rows, "x double"), "x").toPandas()
        assert len(got) == 200 and got.density.isna().all()
    empty = spark.createDataFrame([(None,)], "x double")
    assert charts.density_curve(empty, "x").count() == 0


def test_density_integrates_to_one(spark):
    df = spark.createDataFrame([(float(v),) for v in np.random.default_rng(2).normal(size=300)], "x double")
    got = charts.density_curve(df, "x").toPandas().sort_values("x")
    assert np.trapezoid(got.density, got.x) == pytest.approx(1.0, abs=0.01) and len(got) == 200


def test_scaling_of_constants_and_nulls(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "x double, c double")
    out = prep.scale_min_max(prep.scale_standard(df, ["x", "c"]), ["x", "c"]).collect()
    assert [r["x_std"] for r in out] == [-1.0, 1.0, None]
    assert {r["c_std"] for r in out} == {0.0} and {r["c_minmax"] for r in out} == {0.0}


def test_imputation(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (4.0, None), (None, "a"), (8.0, "b")], "x double, s string")
    out = prep.impute_mode(prep.impute_median(df, ["x"]), ["s"]).collect()
    assert out[3]["x"] == 3.0 and out[2]["s"] == "a"


def test_encoders(spark):
    df = spark.createDataFrame([(0, "z"), (1, None), (2, "a"), (3, "z"), (4, "m")], "id int, c string")
    hot = prep.one_hot(df, ["c"]).orderBy("id").collect()
    assert hot[0].asDict() == {"id": 0, "c_a": 0, "c_m": 0, "c_z": 1}
    assert sum(hot[1].asDict()[k] for k in ("c_a", "c_m", "c_z")) == 0
    codes = prep.ordinal_encode(df, "c", "k").orderBy("id").collect()
    assert [r["k"] for r in codes] == [2, None, 0, 2, 1]
    bits = prep.binary_encode(df, "c", "id", prep.bits_for(df, "c")).orderBy("id").collect()
    assert [(r["c_0"], r["c_1"], r["c_2"]) for r in bits] == [(0, 0, 1), (0, 1, 0), (0, 1, 1), (0, 0, 1), (1, 0, 0)]


def test_mixed_preprocessor_handles_unknown_levels(spark):
    train = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, "a")], "x double, s string")
    learnt = prep.fit_mixed(train)
    assert learnt.feature_names() == ["x", "s_a", "s_b"]
    new = spark.createDataFrame([(2.0, "zzz"), (None, None)], "x double, s string")
    out = [r["features"].toArray().tolist() for r in learnt.transform(new).collect()]
    assert out == [[0.0, 0.0, 0.0], [0.0, 1.0, 0.0]]


def test_splits_are_exact_disjoint_and_reproducible(numbers):
    _, df = numbers
    one = split.split_stratified(df, "id", "g", 0.25).select("id", "g", "split").toPandas()
    two = split.split_stratified(df.repartition(5), "id", "g", 0.25).select("id", "g", "split").toPandas()
    pd.testing.assert_frame_equal(*[x.sort_values("id").reset_index(drop=True) for x in (one, two)])
    for _, part in one.groupby("g"):
        assert (part.split == "train").sum() == int(np.floor(len(part) * 0.75 + 0.5))
    folds = split.assign_folds(df, "id", 5, label="g").groupBy("g", "fold").count().toPandas()
    for _, part in folds.groupby("g"):
        assert part["count"].max() - part["count"].min() <= 1
    rare = df.withColumn("g", F.when(F.col("id") == 0, 1).otherwise(0))
    assert split.split_stratified(rare, "id", "g", 0.2).where("split = 'test'").count() == 1200


def test_roc_against_brute_force(spark):
    draw = np.random.default_rng(3)
    y, s = draw.integers(0, 2, 400), np.round(draw.random(400), 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    pairs = [(1.0 if p > n else 0.5 if p == n else 0.0) for p in s[y == 1] for n in s[y == 0]]
    assert evaluate.roc_auc(df, "y", "s").first()["roc_auc"] == pytest.approx(np.mean(pairs))
    curve = evaluate.roc_curve(df, "y", "s").toPandas().sort_values(["fpr", "tpr"])
    assert curve.iloc[0][["fpr", "tpr"]].tolist() == [0.0, 0.0]
    assert curve.iloc[-1][["fpr", "tpr"]].tolist() == [1.0, 1.0]
    assert np.trapezoid(curve.tpr, curve.fpr) == pytest.approx(np.mean(pairs))


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    got = evaluate.binary_metrics(df, "y", "p").first()
    assert got["accuracy"] == 1.0 and got["precision"] == got["recall"] == got["f1"] == got["hard_auc"] == 0.0
    assert [tuple(r) for r in evaluate.confusion(df, "y", "p", [0, 1]).orderBy("y").collect()] == [(0, 2, 0), (1, 0, 0)]


def test_best_model_first_wins_ties(spark):
    df = spark.createDataFrame([(0.5,)], "f1 double")
    got = evaluate.compare([("a", df), ("b", df)]).collect()
    assert [(r["model"], r["best"]) for r in got] == [("a", 1), ("b", 0)]
