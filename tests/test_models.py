"""Models, tuning and text weights: optimality conditions and guards."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ledgerlark.operators import gram, models, split, text, tune


@pytest.fixture(scope="module")
def data(spark):
    draw = np.random.default_rng(9)
    x = draw.normal(size=(200, 3))
    x = (x - x.mean(0)) / x.std(0)
    target = x @ [2.0, -1.0, 0.0] + 5 + draw.normal(size=200)
    y = (x[:, 0] + draw.normal(scale=0.7, size=200) > 0.3).astype(int)
    rows = [(i, [float(v) for v in x[i]], float(target[i]), int(y[i])) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, v array<double>, t double, y int")
    return x, target, y, df.withColumn("features", array_to_vector("v")).cache()


def test_ridge_matches_closed_form(data):
    x, t, _, df = data
    model = models.ridge("t", 3.0).fit(df)
    want = np.linalg.solve(x.T @ x + 3.0 * np.eye(3), x.T @ (t - t.mean()))
    assert np.allclose(model.coefficients.toArray(), want, atol=1e-6)


def test_training_ignores_test_rows(data):
    """A scaler, weights and a penalty inside the pipeline come from the rows of the fit alone."""
    from pyspark.ml import Pipeline

    from ledgerlark.operators import prep

    _, _, _, df = data
    rows = df.drop("features").select("id", "y", *[F.col("v")[i].alias(f"x{i}") for i in range(3)])
    steps = Pipeline(stages=[prep.MixedStage(["x0", "x1", "x2"]), models.BalancedLogistic("y", 0.5)])
    changed = rows.withColumn("x0", F.when(F.col("id") >= 150, F.col("x0") * 1000).otherwise(F.col("x0")))
    changed = changed.withColumn("y", F.when(F.col("id") >= 150, 1).otherwise(F.col("y")))
    first, second = (steps.fit(t.where("id < 150")).stages[-1].coefficients.toArray() for t in (rows, changed))
    assert np.array_equal(first, second)
    everything = steps.fit(changed).stages[-1].coefficients.toArray()
    assert not np.allclose(first, everything)


def test_depth_beyond_the_limit_is_refused():
    with pytest.raises(ValueError, match="depth"):
        models.decision_tree("y", 31)


def test_lasso_meets_its_conditions(data):
    x, t, _, df = data
    w = models.lasso("t", 0.3).fit(df).coefficients.toArray()
    slope = x.T @ (t - t.mean() - x @ w) / len(t)
    assert w[2] == 0 and abs(slope[2]) <= 0.3
    assert np.allclose(slope[:2], 0.3 * np.sign(w[:2]), atol=1e-5)


def test_balanced_logistic_is_stationary(data):
    x, _, y, df = data
    weighted = models.with_balanced_weights(df, "y")
    model = models.logistic("y", 200, C=0.5, balanced=True).fit(weighted)
    w, b = model.coefficients.toArray(), model.intercept
    weight = np.where(y == 1, 200 / (2 * y.sum()), 200 / (2 * (200 - y.sum())))
    error = weight * (1 / (1 + np.exp(-(x @ w + b))) - y)
    assert np.allclose(0.5 * x.T @ error + w, 0, atol=1e-3) and abs(error.sum()) < 1e-3


def test_one_class_guard(data):
    df = data[3].withColumn("y", F.lit(0))
    model = models.fit_guarded(models.logistic("y", 200), df, "y")
    assert models.decide(model.transform(df)).agg(F.sum("pred")).first()[0] == 0


def test_tree_text_and_importances(data):
    _, _, _, df = data
    tree = models.decision_tree("y", 3).fit(df)
    info = models.tree_text(tree, ["alpha", "beta", "gamma"])
    assert info.depth <= 3 and info.leaves <= 8 and "alpha" in info.rules and "feature" not in info.rules
    table = models.importances(tree, ["alpha", "beta", "gamma"], df).collect()
    assert table[0]["feature"] == "alpha" and sum(r["importance"] for r in table) == pytest.approx(1.0)


def test_fourier_features_approximate_the_kernel(data):
    x, _, _, df = data
    lift = models.FourierFeatures.fit(df, "features", 4000, gamma=0.5)
    z = np.stack([r["features"].toArray() for r in lift.transform(df).orderBy("id").limit(20).collect()])
    kernel = np.exp(-0.5 * ((x[:20, None] - x[None, :20]) ** 2).sum(2))
    assert np.abs(z @ z.T - kernel).max() < 0.12


def test_search_picks_the_best_and_folds_are_respected(data):
    _, _, _, df = data
    folded = split.assign_folds(df, "id", 4, label="y")
    base = models.logistic("y", 150)
    maps = tune.draws(base, "regParam", [100.0, 0.001, 0.001])
    _, table = tune.search(base, maps, folded, "y", "fold", 4, "accuracy")
    rows = table.collect()
    assert [r["best"] for r in rows] == [0, 1, 0]
    scores = tune.fold_scores({"m": models.logistic("y", 150, C=1 / 0.15)}, folded, "y", "fold", 4, "accuracy")
    summary = tune.score_summary(scores).first()
    assert summary["mean"] == pytest.approx(rows[1]["mean"]) and summary["std"] == pytest.approx(rows[1]["std"])


def test_draws_are_reproducible_and_in_range():
    assert tune.uniform(5, 0.01, 10) == tune.uniform(5, 0.01, 10)
    assert all(0.01 <= v <= 10.01 for v in tune.uniform(50, 0.01, 10))
    assert all(1e-3 <= v <= 1e2 for v in tune.log_uniform(50, 1e-3, 1e2))


def test_scores_carry_the_confidence_of_the_decision(data):
    _, _, _, df = data
    out = models.score(models.logistic("y", 200).fit(df), df).collect()
    assert all(r["confidence"] >= 50 for r in out)
    assert out[0]["verdict"].startswith("Exitosa" if out[0]["pred"] else "No exitosa")


def test_tfidf_weights(spark):
    docs = [(0, "Pan pan café"), (1, "café solo"), (2, "x !"), (3, None)]
    df = spark.createDataFrame(docs, "id int, body string")
    got = {(r["id"], r["term"]): r["weight"] for r in text.tfidf(df, "id", "body", 2).collect()}
    pan, cafe = 2 * (np.log(5 / 2) + 1), np.log(5 / 3) + 1
    assert set(got) == {(0, "pan"), (0, "café"), (1, "café")}
    assert got[0, "pan"] == pytest.approx(pan / np.hypot(pan, cafe)) and got[1, "café"] == pytest.approx(1.0)


def test_linear_search_equals_separate_fits(spark):
    """Every draw and fold against a model fitted on standardised rows of the other folds."""
    draw = np.random.default_rng(8)
    x = draw.normal([3, 50, -1, 7], [1, 9, 0.2, 0], (240, 4))  # the last one is constant
    y = x @ [2.0, 0.3, -1.0, 0.0] + draw.normal(0, 2, 240)
    fold = np.arange(240) % 4
    rows = [(Vectors.dense(a), float(b), int(f)) for a, b, f in zip(x, y, fold)]
    df = spark.createDataFrame(rows, ["features", "y", "fold"])
    draws = {"ridge": [0.5, 40.0], "lasso": [0.05, 0.9, 50.0]}
    best, table = gram.search(df, "y", "fold", draws)
    got = {(r["model"], r["params"]): r for r in table.collect()}
    for kind, values in draws.items():
        means = []
        for a in values:
            scores = []
            for i in range(4):
                t, v = fold != i, fold == i
                mu, sd = x[t].mean(0), x[t].std(0)
                sd = np.where(sd > 1e-12, sd, 1.0)
                z, c = (x[t] - mu) / sd, y[t] - y[t].mean()
                if kind == "ridge":
                    w = np.linalg.solve(z.T @ z + a * np.eye(4), z.T @ c)
                else:
                    w = np.zeros(4)
                    for _ in range(3000):
                        for j in range(4):
                            rest = z[:, j] @ (c - z @ w + z[:, j] * w[j]) / t.sum()
                            w[j] = np.sign(rest) * max(abs(rest) - a, 0)
                error = y[v] - y[t].mean() - (x[v] - mu) / sd @ w
                scores.append(1 - (error**2).sum() / ((y[v] - y[v].mean()) ** 2).sum())
            r = got[kind, f"{'alpha' if kind == 'ridge' else 'regParam'}={a}"]
            assert r["mean"] == pytest.approx(np.mean(scores), abs=1e-9) and r["std"] == pytest.approx(np.std(scores), abs=1e-9)
            means.append(np.mean(scores))
        assert [r["best"] for r in table.where(f"model = '{kind}'").collect()] == [int(j == np.argmax(means)) for j in range(len(values))]
        assert len(best[kind][0]) == 4
