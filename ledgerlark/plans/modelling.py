"""Queries that fit and tune models. What a model learns, its preprocessing included, comes from training rows."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from ledgerlark import presets
from ledgerlark.operators import charts, evaluate, gram, kernel, models, neighbours, prep, rules, split, trees, tune
from ledgerlark.operators.features import movie_features
from ledgerlark.plans import flows
from ledgerlark.plans.registry import query
from ledgerlark.plans.views import (
    PANEL_FEATURES,
    PASSENGERS,
    panel,
    passengers,
    records,
    with_sql,
)
from ledgerlark.session import cut_lineage, scratch_path
from ledgerlark.sources.records import parse_movies
from ledgerlark.sources.tables import write_report

PASSENGER_NUMBERS = ["pclass", "age", "sibsp", "parch", "fare"]
PASSENGER_TEXTS = ["sex", "embarked"]


def panel_parts(spark, sf_dir):
    """The panel with gaps filled by the median, split 75/25 by class; the training rows in five folds."""
    p = rules.with_known_target(panel(spark, sf_dir), "label")
    p = p.withColumn("id", F.concat_ws("|", "unidad", "anio"))
    parts = split.split_stratified(prep.impute_median(p, PANEL_FEATURES), "id", "label")
    return cut_lineage(parts)


def panel_train(spark, sf_dir):
    return cut_lineage(split.assign_folds(part(panel_parts(spark, sf_dir), "train"), "id", 5, label="label"))


def panel_ready(spark, sf_dir):
    """The split panel, scaled by its training rows; training rows carry class weights."""
    parts = panel_parts(spark, sf_dir)
    ready = prep.fit_mixed(part(parts, "train"), PANEL_FEATURES, []).transform(parts)
    train = models.with_balanced_weights(part(ready, "train"), "label")
    return train.unionByName(part(ready, "test"), allowMissingColumns=True)


def passengers_ready(spark, sf_dir):
    parts = cut_lineage(split.split_stratified(passengers(spark, sf_dir), "id", "survived", 0.2))
    learnt = prep.fit_mixed(part(parts, "train"), PASSENGER_NUMBERS, PASSENGER_TEXTS)
    ready = learnt.transform(parts).select("id", "survived", "fare", "age", "features", "split")
    return ready, learnt.feature_names()


def part(df, name):
    return df.where(F.col("split") == name)


def tidy(df, digits=4):
    doubles = [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


def _mixed_sql() -> str:
    sql = PASSENGERS + ", learnt AS (SELECT " + ", ".join(
        f"median({c}) AS {c}_mid" for c in PASSENGER_NUMBERS
    ) + " FROM passengers)"
    for c in PASSENGER_TEXTS:
        sql += f", {c}_mode AS (SELECT {c} AS {c}_fill FROM passengers WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"
    sql += ", filled AS (SELECT id, " + ", ".join(
        f"CAST(coalesce({c}, {c}_mid) AS DOUBLE) AS {c}" for c in PASSENGER_NUMBERS
    )
    sql += ", " + ", ".join(f"coalesce({c}, {c}_fill) AS {c}" for c in PASSENGER_TEXTS)
    sql += " FROM passengers, learnt, " + ", ".join(f"{c}_mode" for c in PASSENGER_TEXTS) + ")"
    parts = [
        f"""SELECT id, '{c}' AS feature, round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 5) AS value FROM filled"""
        for c in PASSENGER_NUMBERS
    ]
    parts += [
        f"""SELECT id, '{c}_' || l AS feature, CAST(CASE WHEN {c} = l THEN 1 ELSE 0 END AS DOUBLE) AS value
        FROM filled, (SELECT DISTINCT {c} AS l FROM passengers WHERE {c} IS NOT NULL)"""
        for c in PASSENGER_TEXTS
    ]
    return with_sql(sql, " UNION ALL ".join(parts))


@query(_mixed_sql())
def mixed_preprocessor(spark, sf_dir):
    """Every entry of the scaled, encoded vector of each passenger, under its feature name."""
    p = passengers(spark, sf_dir)
    learnt = prep.fit_mixed(p, PASSENGER_NUMBERS, PASSENGER_TEXTS)
    cells = F.arrays_zip(
        F.array(*[F.lit(n) for n in learnt.feature_names()]).alias("feature"),
        vector_to_array("features").alias("value"),
    )
    long = learnt.transform(p).select("id", F.inline(cells))
    return long.withColumn("value", F.round("value", 5))


@query()
def logistic_fit(spark, sf_dir):
    """Balanced logistic regression: coefficients by magnitude."""
    ready, names = passengers_ready(spark, sf_dir)
    train = models.with_balanced_weights(part(ready, "train"), "survived")
    model = models.logistic("survived", train.count(), balanced=True).fit(train)
    return tidy(models.coefficients(model, names, ready))


@query()
def logistic_probabilities(spark, sf_dir):
    """Fare against the predicted probability of the test rows."""
    ready, _ = passengers_ready(spark, sf_dir)
    train = models.with_balanced_weights(part(ready, "train"), "survived")
    model = models.logistic("survived", train.count(), balanced=True).fit(train)
    scored = models.with_probability(model.transform(part(ready, "test")))
    return scored.select("id", "fare", "survived", F.round("p1", 4).alias("p1"))


@query()
def tree_fit(spark, sf_dir):
    """One balanced tree of depth 4: its depth, leaves and rules."""
    ready = panel_ready(spark, sf_dir)
    model = models.decision_tree("label", 4, balanced=True).fit(part(ready, "train"))
    text = models.tree_text(model, PANEL_FEATURES)
    rows = [(text.depth, text.leaves, text.rules)]
    return spark.createDataFrame(rows, "depth int, leaves int, rules string")


def _tree_sql(depth: int, min_split: int) -> str:
    """The tree of ``tree_exact``, one group of subqueries per level."""
    cells = " UNION ALL ".join(
        f"SELECT id, {i} AS feature, CAST({c} AS DOUBLE) AS value FROM whole" for i, c in enumerate(PASSENGER_NUMBERS)
    )
    known = " AND ".join(f"{c} IS NOT NULL" for c in PASSENGER_NUMBERS)
    sql = PASSENGERS + f""", whole AS (SELECT * FROM passengers WHERE {known}), long AS ({cells}),
      a0 AS (SELECT id, survived AS y, '' AS node FROM whole)"""
    for i in range(depth):
        sql += f""",
      c{i} AS (SELECT node, feature, value, count(*) AS n, sum(y) AS n1 FROM a{i} JOIN long USING (id) GROUP BY node, feature, value),
      s{i} AS (SELECT node, feature, value, lead(value) OVER o AS nx, sum(n) OVER o AS ln, sum(n1) OVER o AS l1,
                      sum(n) OVER g AS tn, sum(n1) OVER g AS t1
               FROM c{i} WINDOW g AS (PARTITION BY node, feature), o AS (PARTITION BY node, feature ORDER BY value)),
      k{i} AS (SELECT node, feature, value / 2 + nx / 2 AS cut, ln / tn * ((tn - ln) / tn) * (l1 / ln - (t1 - l1) / (tn - ln))
                      * (l1 / ln - (t1 - l1) / (tn - ln)) AS gain
               FROM (SELECT node, feature, value, nx, CAST(ln AS DOUBLE) AS ln, CAST(l1 AS DOUBLE) AS l1, CAST(tn AS DOUBLE) AS tn,
                            CAST(t1 AS DOUBLE) AS t1 FROM s{i}) WHERE nx IS NOT NULL AND tn >= {min_split} AND t1 > 0 AND t1 < tn),
      b{i} AS MATERIALIZED (SELECT node, feature, cut FROM k{i}
               QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 12) DESC, feature, cut) = 1),
      a{i + 1} AS MATERIALIZED (SELECT id, y, node || CASE WHEN value <= cut THEN '0' ELSE '1' END AS node
               FROM a{i} JOIN b{i} USING (node) JOIN long USING (id, feature))"""
    names = "CASE feature " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(PASSENGER_NUMBERS)) + " END"
    levels = " UNION ALL ".join(
        f"""SELECT t.node, CAST({i} AS INTEGER) AS depth, t.rows, t.n1, {names if i < depth else 'NULL::VARCHAR'} AS feature,
        round({'cut' if i < depth else 'NULL::DOUBLE'}, 6) AS threshold
        FROM (SELECT node, count(*) AS rows, CAST(sum(y) AS BIGINT) AS n1 FROM a{i} GROUP BY node) t
        {f'LEFT JOIN b{i} USING (node)' if i < depth else ''}"""
        for i in range(depth + 1)
    )
    return with_sql(sql, levels)


@query(_tree_sql(presets.TREE_DEPTH, presets.TREE_SPLIT))
def tree_exact(spark, sf_dir):
    """Every node of a tree with exact thresholds and a least size of nodes to be split."""
    p = passengers(spark, sf_dir).select("id", F.col("survived").alias("y"), *PASSENGER_NUMBERS).dropna()
    x = F.array(*[F.col(c).cast("double") for c in PASSENGER_NUMBERS]).alias("x")
    rows = p.select(F.lit(0).cast("long").alias("tree"), "id", x, "y", F.lit(1).cast("long").alias("n"))
    nodes = trees.grow(rows, len(PASSENGER_NUMBERS), presets.TREE_DEPTH, presets.TREE_SPLIT).nodes
    name = F.get(F.array(*[F.lit(c) for c in PASSENGER_NUMBERS]), F.col("feature")).alias("feature")
    return nodes.select("node", "depth", "rows", "n1", name, F.round("threshold", 6).alias("threshold"))


@query()
def forest_grid(spark, sf_dir):
    """All forests of the grid over trees, depth and split size on the panel, from one growth per fold."""
    x = F.array(*[F.col(c).cast("double") for c in PANEL_FEATURES]).alias("x")
    train = panel_train(spark, sf_dir).select("id", x, F.col("label").alias("y"), "fold")
    return tidy(
        trees.forest_search(train, len(PANEL_FEATURES), 5, presets.GRID_TREES, presets.GRID_DEPTHS, presets.GRID_SPLITS)
    )


def boosting(label):
    return models.gradient_boosting(
        label, presets.BOOSTING_ROUNDS, presets.BOOSTING_RATE, presets.BOOSTING_DEPTH, presets.BOOSTING_LEAF,
        presets.BOOSTING_SHARE, "sqrt",
    )


@query()
def forest_fit(spark, sf_dir):
    """A balanced forest and boosted trees: aligned importances."""
    ready = panel_ready(spark, sf_dir)
    train = cut_lineage(part(ready, "train"))
    forest = models.random_forest("label", presets.FOREST_TREES, None, 2, balanced=True).fit(train)
    tables = [models.importances(m, PANEL_FEATURES, train) for m in (forest, boosting("label").fit(train))]
    return tidy(models.aligned_importances(*tables, ("forest", "boosting"), top=15))


@query()
def gbt_fit(spark, sf_dir):
    """Boosted trees on samples of rows and columns: test metrics and AUC."""
    ready = cut_lineage(panel_ready(spark, sf_dir))
    model = boosting("label").fit(part(ready, "train"))
    scored = models.with_probability(models.decide(model.transform(part(ready, "test"))))
    metrics = evaluate.binary_metrics(scored, "label", "pred")
    return tidy(metrics.withColumn("roc_auc", evaluate.roc_auc(scored, "label", "p1").scalar()))


@query()
def rbf_fit(spark, sf_dir):
    """RBF machine with hinge loss: test metrics by its decisions, AUC by its calibrated probabilities."""
    ready = cut_lineage(panel_ready(spark, sf_dir))
    model = kernel.KernelMachine("label").fit(part(ready, "train"))
    scored = cut_lineage(models.with_probability(models.decide(model.transform(part(ready, "test")))))
    metrics = evaluate.binary_metrics(scored, "label", "pred")
    return tidy(metrics.withColumn("roc_auc", evaluate.roc_auc(scored, "label", "p1").scalar()))


def compared(train, test, label, row_id, forest_trees):
    """Test metrics of six classifiers fitted on the same rows, stacked, with the best by F1."""
    fits = {
        "logistic": models.BalancedLogistic(label),
        "tree": models.decision_tree(label, balanced=True),
        "forest": models.random_forest(label, forest_trees, None, 2, balanced=True),
        "boosting": boosting(label),
        "rbf": kernel.KernelMachine(label, folds=0),
    }
    judged = {name: models.decide(models.fit_guarded(e, train, label).transform(test)) for name, e in fits.items()}
    near, asked = (df.withColumn("v", vector_to_array("features")) for df in (train, test))
    judged["neighbours"] = neighbours.knn_classify(near, asked, row_id, "v", label)
    return evaluate.compare([(name, evaluate.binary_metrics(df, label, "pred")) for name, df in judged.items()])


@query()
def model_comparison(spark, sf_dir):
    """Six classifiers on one split of the panel: stacked test metrics and the best by F1."""
    ready = cut_lineage(panel_ready(spark, sf_dir))
    return tidy(compared(part(ready, "train"), part(ready, "test"), "label", "id", presets.FOREST_TREES))


@query()
def cv_scores(spark, sf_dir):
    """Fold scores of two models on the training rows; the scaler is learnt in each fit."""
    train = panel_train(spark, sf_dir)
    scaler = prep.MixedStage(PANEL_FEATURES)
    fits = {
        "tree": Pipeline(stages=[scaler, models.BalancedTrees("label", models.decision_tree("label", 4, balanced=True))]),
        "logistic": Pipeline(stages=[scaler, models.BalancedLogistic("label")]),
    }
    return tidy(tune.fold_scores(fits, train, "label", "fold", 5, "f1"))


@query()
def grid_search(spark, sf_dir):
    """All penalties by all kernel widths of the RBF machine; scaler and kernel are learnt in each fit."""
    train = panel_train(spark, sf_dir)
    lift, machine = models.FourierStage(100), models.BalancedLogistic("label", balanced=False)
    maps = ParamGridBuilder().addGrid(machine.C, presets.RBF_C).addGrid(lift.gamma, presets.RBF_GAMMA).build()
    steps = Pipeline(stages=[prep.MixedStage(PANEL_FEATURES), lift, machine])
    _, table = tune.search(steps, maps, train, "label", "fold", 5, "accuracy", 8)
    return tidy(table)


@query()
def random_search(spark, sf_dir):
    """Random penalties for logistic regression, judged by F1; imputer, scaler, encoder and weights are learnt in each fit."""
    parts = split.split_stratified(passengers(spark, sf_dir), "id", "survived", 0.2)
    train = cut_lineage(split.assign_folds(part(parts, "train"), "id", 5, label="survived"))
    machine = models.BalancedLogistic("survived")
    steps = Pipeline(
        stages=[prep.MixedStage(PASSENGER_NUMBERS, PASSENGER_TEXTS), models.WeightStage("survived"), machine]
    )
    maps = tune.draws(machine, "C", tune.log_uniform(presets.LOGISTIC_DRAWS, 1e-3, 1e2))
    _, table = tune.search(steps, maps, train, "survived", "fold", 5, "f1", 8)
    return tidy(table)


#: The drawn penalties, the same for both models.
LINEAR = tune.uniform(presets.LINEAR_DRAWS, 0.01, 10.0)


def _linear_search_sql() -> str:
    """Closed forms of ridge and lasso for one standardised feature, per fold and draw."""
    draws = ", ".join(
        f"('{kind}', {i}, '{name}={a}', {a!r}::DOUBLE)"
        for kind, name in (("ridge", "alpha"), ("lasso", "regParam")) for i, a in enumerate(LINEAR)
    )
    return with_sql(PASSENGERS, f""", base AS (
      SELECT id, age::DOUBLE AS x, fare::DOUBLE AS y, row_number() OVER (ORDER BY md5('42:' || id), id) AS rk, count(*) OVER () AS n
      FROM passengers WHERE age IS NOT NULL AND fare IS NOT NULL),
    train AS (SELECT x, y, (rk - 1) % 5 AS fold FROM base WHERE rk <= floor(n * 0.8 + 0.5)),
    mid AS (
      SELECT f.fold, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, covar_pop(x, y) AS vxy
      FROM (SELECT DISTINCT fold FROM train) f JOIN train t ON t.fold <> f.fold GROUP BY f.fold),
    held AS (
      SELECT fold, sum((x - mx) * (x - mx)) AS sxx, sum((x - mx) * (y - my)) AS sxy, sum((y - my) * (y - my)) AS syy,
             count(*) * var_pop(y) AS sst
      FROM train JOIN mid USING (fold) GROUP BY fold),
    draw(model, i, params, a) AS (VALUES {draws}),
    slope AS (
      SELECT model, i, params, fold,
             CASE model WHEN 'ridge' THEN n * vxy / sqrt(vx) / (n + a)
             ELSE sign(vxy) * greatest(abs(vxy) / sqrt(vx) - a, 0) END / sqrt(vx) AS s
      FROM draw, mid),
    score AS (SELECT model, i, params, 1 - (syy - 2 * s * sxy + s * s * sxx) / sst AS r2 FROM slope JOIN held USING (fold)),
    judged AS (SELECT model, i, params, avg(r2) AS mean, stddev_pop(r2) AS std FROM score GROUP BY model, i, params)
    SELECT model, params, round(mean, 4) AS mean, round(std, 4) AS std,
           CAST(row_number() OVER (PARTITION BY model ORDER BY mean DESC, i) = 1 AS INTEGER) AS best FROM judged""")


@query(_linear_search_sql())
def random_search_ridge(spark, sf_dir):
    """Random penalties for ridge and lasso regression of fare on age, judged by R²; the scaler is learnt in each fit."""
    rows = split.split_random(passengers(spark, sf_dir).select("id", "fare", "age").dropna(), "id")
    train = split.assign_folds(part(rows, "train"), "id", 5).withColumn("features", array_to_vector(F.array(F.col("age").cast("double"))))
    return tidy(gram.search(train, "fare", "fold", {"ridge": LINEAR, "lasso": LINEAR})[1])


@query()
def split_comparison(spark, sf_dir):
    """Metrics of one model on its training, validation and test rows."""
    parts = cut_lineage(split.split_three_way(passengers(spark, sf_dir), "id", "survived"))
    learnt = prep.fit_mixed(part(parts, "train"), PASSENGER_NUMBERS, PASSENGER_TEXTS)
    ready = learnt.transform(parts).select("id", "survived", "features", "split")
    train = models.with_balanced_weights(part(ready, "train"), "survived")
    model = models.logistic("survived", train.count(), balanced=True).fit(train)
    return tidy(tune.compare_by_split(model.transform(ready), "survived", "split"))


@query()
def relabel_comparison(spark, sf_dir):
    """Three models, each fitted on the given label and on the rule-based one."""
    p = panel(spark, sf_dir)
    p = rules.stress_label(p, "unidad", "anio", "cfo", "liquidez", "dias_efectivo")
    p = p.withColumn("id", F.concat_ws("|", "unidad", "anio"))
    parts = cut_lineage(split.split_stratified(prep.impute_median(p, PANEL_FEATURES), "id", "tension", 0.2))
    ready = prep.fit_mixed(part(parts, "train"), PANEL_FEATURES, []).transform(parts)
    rows = part(ready, "train").count()
    makers = {
        "tree": lambda y: models.decision_tree(y, 10, 5),
        "logistic": lambda y: models.logistic(y, rows),
        "linear": models.least_squares,
    }
    labels = {"Original": "label", "Reevaluada": "tension"}
    return tidy(tune.compare_labels(makers, ready, labels, "split", ["linear"]))


@query()
def score_new_records(spark, sf_dir):
    """A saved pipeline scores films with a verdict text; the report is written and read back."""
    movies = movie_features(parse_movies(records(spark, sf_dir), "raw"))
    movies = rules.threshold_ladder(movies, "rating", [8.0, 7.8, 7.5, 7.0, 6.5])
    inputs = ["votes", "runtime", "year", "votes_per_min", "votes_log", "age", "runtime_squared"]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    tree = models.decision_tree("success", 4)
    path = scratch_path(spark, "model")
    prep.save_model(Pipeline(stages=[assembler, tree]).fit(movies), path)
    scored = models.score(prep.load_model(path), movies.drop("success"))
    report = write_report(scored.select("event_id", "title", "verdict"))
    return spark.read.schema("event_id bigint, title string, verdict string").json(report)


def fare_on_age(spark, sf_dir):
    p = passengers(spark, sf_dir).select("id", "fare", "age").dropna()
    scaled = prep.scale_standard(p, ["age"])
    return prep.assemble(scaled, ["age_std"])


FARE = PASSENGERS + """, d AS (SELECT id, fare, age FROM passengers WHERE fare IS NOT NULL AND age IS NOT NULL),
  s AS (SELECT count(*) AS n, avg(fare) AS my, covar_pop(age, fare) / stddev_pop(age) AS c FROM d)"""


@query(
    with_sql(FARE, "SELECT round(n * c / (n + 500.0), 2) AS slope, round(my, 2) AS intercept FROM s")
)
def ridge_1d(spark, sf_dir):
    data = fare_on_age(spark, sf_dir)
    return _line(data, models.ridge("fare", 500.0).fit(data))


@query(
    with_sql(
        FARE,
        "SELECT round(sign(c) * greatest(abs(c) - 100, 0), 2) AS slope, round(my, 2) AS intercept FROM s",
    )
)
def lasso_1d(spark, sf_dir):
    data = cut_lineage(fare_on_age(spark, sf_dir))
    return _line(data, models.lasso("fare", 100.0).fit(data))


@query(
    with_sql(
        FARE,
        """, o AS (SELECT id, fare, age, row_number() OVER (ORDER BY md5(concat('42:', id)), id) AS rk, count(*) OVER () AS n FROM d),
        a AS (SELECT avg(age) AS m, stddev_pop(age) AS sd FROM o WHERE rk <= floor(n * 0.8 + 0.5)),
        z AS (SELECT id, fare, age, (age - m) / sd AS x, rk, n FROM o, a),
        t AS (SELECT count(*) AS n, avg(x) AS mx, avg(fare) AS my, covar_pop(x, fare) AS c, var_pop(x) AS v FROM z WHERE rk <= floor(n * 0.8 + 0.5)),
        w AS (SELECT mx, my, n * c / (n * v + 1) AS wr, sign(c) * greatest(abs(c) - 1, 0) / v AS wl FROM t)
        SELECT age, fare, round(my + wr * (x - mx), 2) AS ridge, round(my + wl * (x - mx), 2) AS lasso
        FROM z, w WHERE rk > floor(n * 0.8 + 0.5)""",
    )
)
def regression_line(spark, sf_dir):
    """Test rows in order of age, with the fare and two predicted lines."""
    rows = cut_lineage(split.split_random(passengers(spark, sf_dir).select("id", "fare", "age").dropna(), "id"))
    data = prep.fit_mixed(part(rows, "train"), ["age"], []).transform(rows)
    train, test = part(data, "train"), part(data, "test")
    for name, estimator in (("ridge", models.ridge("fare", 1.0)), ("lasso", models.lasso("fare", 1.0))):
        model = estimator.setPredictionCol(name).fit(train)
        test = model.transform(test)
    return tidy(charts.regression_line(test, "age", "fare", ["ridge", "lasso"]), 2)


def _line(data, model):
    """Slope and intercept as one row of the data's aggregate."""
    slope, intercept = float(model.coefficients[0]), float(model.intercept)
    return data.agg(F.count(F.lit(1)).alias("n")).select(
        F.round(F.lit(slope), 2).alias("slope"), F.round(F.lit(intercept), 2).alias("intercept")
    )


@query(
    with_sql(
        PASSENGERS,
        """, d AS (SELECT id, survived, fare FROM passengers WHERE fare IS NOT NULL),
        l AS (SELECT regr_slope(survived, fare) AS b, regr_intercept(survived, fare) AS a FROM d)
        SELECT id, round(a + b * fare, 6) AS prediction, CAST(CASE WHEN a + b * fare >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS pred FROM d, l""",
    )
)
def ols_threshold(spark, sf_dir):
    d = passengers(spark, sf_dir).select("id", "survived", "fare").dropna()
    data = cut_lineage(prep.assemble(d, ["fare"]))
    model = models.least_squares("survived").fit(data)
    out = models.decide(model.transform(data), regression=True)
    return out.select("id", F.round("prediction", 6).alias("prediction"), "pred")


@query()
def cluster_audit_flow(spark, sf_dir):
    """The panel's label against clusters of its complete, scaled rows."""
    p = panel(spark, sf_dir).withColumn("id", F.concat_ws("|", "unidad", "anio"))
    out = flows.cluster_audit(p, "id", "label", PANEL_FEATURES)
    density = out["density"].select(F.struct("clusters", "outliers", "outlier_pct")).scalar()
    return tidy(out["agreement"].withColumn("d", density).select("agreement", "verdict", "d.*"))


@query()
def hybrid_relabel_flow(spark, sf_dir):
    """The panel's label revised by five clusterings; models fitted on both labels."""
    p = panel(spark, sf_dir).withColumn("id", F.concat_ws("|", "unidad", "anio"))
    ready = prep.fit_mixed(p, PANEL_FEATURES, []).transform(p)
    vector = vector_to_array("features").alias("v")
    return tidy(flows.hybrid_relabel(ready.select("id", "label", vector), "id", "label")["comparison"])
