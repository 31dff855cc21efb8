"""Queries on the unit by year panel: stress rule, profiling, correlations and preparation."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from ledgerlark.functions.scalars import decode, round_half_even, signed_label, text_bar
from ledgerlark.operators import charts, evaluate, prep, profile, rules, split
from ledgerlark.operators.reduce import pca_scores
from ledgerlark.plans.registry import query
from ledgerlark.plans.views import PANEL, PANEL_FEATURES, panel, with_sql
from ledgerlark.sources import tables

LONG = PANEL + ", long AS (" + " UNION ALL ".join(
    f"SELECT unidad, anio, label, '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM panel"
    for c in PANEL_FEATURES
) + ")"
COLUMNS = ["unidad", "anio", "ingresos_totales", "gastos_personal", *PANEL_FEATURES, "label"]
KEYED = PANEL + ", keyed AS (SELECT *, concat(unidad, '|', anio) AS id FROM panel)"


def keyed(spark, sf_dir):
    return panel(spark, sf_dir).withColumn("id", F.concat_ws("|", "unidad", "anio"))


@query(with_sql(PANEL, "SELECT * FROM panel"))
def panel_table(spark, sf_dir):
    return panel(spark, sf_dir)


@query(
    with_sql(
        PANEL,
        """SELECT a.unidad, a.anio, CAST(CASE WHEN coalesce(a.liquidez < 1, false) OR coalesce(a.dias_efectivo < 30, false)
        OR coalesce(a.cfo < 0 AND b.cfo < 0, false) THEN 1 ELSE 0 END AS INTEGER) AS tension
        FROM panel a LEFT JOIN panel b ON a.unidad = b.unidad AND a.anio = b.anio + 1""",
    )
)
def label_stress_rule(spark, sf_dir):
    out = rules.stress_label(
        panel(spark, sf_dir), "unidad", "anio", "cfo", "liquidez", "dias_efectivo"
    )
    return out.select("unidad", "anio", "tension")


@query(
    with_sql(
        PANEL,
        "SELECT * FROM panel WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in PANEL_FEATURES),
    )
)
def complete_rows(spark, sf_dir):
    """Features and label stay on one row, so dropping incomplete rows keeps them aligned."""
    return panel(spark, sf_dir).dropna(subset=PANEL_FEATURES)


@query(
    with_sql(
        PANEL,
        "SELECT unidad, anio, liquidez, cfo, label FROM panel",
    )
)
def join_by_row_id(spark, sf_dir):
    p = panel(spark, sf_dir).withColumn("rid", F.concat_ws("|", "unidad", "anio"))
    left, right = p.select("rid", "unidad", "anio", "liquidez"), p.select("rid", "cfo", "label")
    return tables.concat_columns(left, right, "rid").drop("rid")


@query(with_sql(PANEL, "SELECT unidad, anio, cfo, label FROM panel"))
def join_labels_by_key(spark, sf_dir):
    p = panel(spark, sf_dir)
    bare = tables.strip_labels(p, "label").select("unidad", "anio", "cfo")
    return tables.attach_labels(bare, p, ["unidad", "anio"], "label")


@query(with_sql(PANEL, "SELECT * EXCLUDE (label) FROM panel"))
def strip_labels(spark, sf_dir):
    return tables.strip_labels(panel(spark, sf_dir), "label")


@query(
    with_sql(
        PANEL,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", '{t}' AS type, count({c}) AS non_null, count(*) AS n_rows FROM panel"""
            for c, t in zip(COLUMNS, ["string", "int"] + ["double"] * 13 + ["int"])
        ),
    )
)
def table_info(spark, sf_dir):
    return profile.table_info(panel(spark, sf_dir))


@query(
    with_sql(
        PANEL,
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls,
            round_even(100.0 * (count(*) - count({c})) / count(*), 2) AS pct FROM panel"""
            for c in COLUMNS
        )
        + ") WHERE nulls > 0",
    )
)
def null_profile(spark, sf_dir):
    return profile.null_profile(panel(spark, sf_dir))


@query(
    with_sql(
        PANEL,
        "SELECT unidad, anio, "
        + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}" for c in PANEL_FEATURES)
        + " FROM panel",
    )
)
def null_cells(spark, sf_dir):
    p = panel(spark, sf_dir).select("unidad", "anio", *PANEL_FEATURES)
    return profile.null_cells(p, ["unidad", "anio"])


@query(
    with_sql(
        LONG,
        """SELECT "column", count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
        min(value) AS min, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50,
        round(quantile_cont(value, 0.75), 6) AS q75, max(value) AS max FROM long GROUP BY "column" """,
    )
)
def describe_all(spark, sf_dir):
    out = profile.describe(panel(spark, sf_dir), PANEL_FEATURES)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


@query(
    with_sql(
        LONG,
        """SELECT label, "column", round_even(avg(value), 3) AS mean, round_even(stddev_samp(value), 3) AS std,
        round_even(min(value), 3) AS min, round_even(median(value), 3) AS median, round_even(max(value), 3) AS max
        FROM long WHERE "column" IN ('liquidez', 'dias_efectivo', 'endeudamiento', 'gp_ratio') GROUP BY ALL""",
    )
)
def describe_by_class(spark, sf_dir):
    few = ["liquidez", "dias_efectivo", "endeudamiento", "gp_ratio"]
    return profile.describe_by_class(panel(spark, sf_dir), few, "label")


@query(
    with_sql(
        LONG, """SELECT "column", round(skewness(value), 6) AS skew FROM long GROUP BY "column" """
    )
)
def skewness_corrected(spark, sf_dir):
    out = profile.corrected_skewness(panel(spark, sf_dir), PANEL_FEATURES)
    return out.withColumn("skew", F.round("skew", 6))


def _pairs_sql(pairs):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM panel" for a, b in pairs
    )


@query(
    with_sql(
        PANEL, _pairs_sql([(a, b) for a in PANEL_FEATURES for b in PANEL_FEATURES])
    )
)
def correlation_matrix(spark, sf_dir):
    out = profile.correlation_matrix(panel(spark, sf_dir), PANEL_FEATURES)
    return out.withColumn("corr", F.round("corr", 6))


@query(
    with_sql(
        PANEL,
        "SELECT *, repeat('█', CAST(floor(abs(corr) * 20) AS INTEGER)) AS bar FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", round(corr({c}, label), 6) AS corr FROM panel"""
            for c in PANEL_FEATURES
        )
        + ")",
    )
)
def corr_with_target(spark, sf_dir):
    out = profile.correlation_with_target(panel(spark, sf_dir), PANEL_FEATURES, "label")
    out = out.withColumn("corr", F.round("corr", 6))
    return out.withColumn("bar", text_bar(F.col("corr")))


@query(
    with_sql(
        PANEL,
        "SELECT * FROM (" + _pairs_sql(combinations(PANEL_FEATURES, 2)) + ") WHERE abs(corr) >= 0.6",
    )
)
def high_corr_pairs(spark, sf_dir):
    out = profile.high_correlation_pairs(panel(spark, sf_dir), PANEL_FEATURES, 0.6)
    return out.withColumn("corr", F.round("corr", 6))


@query(
    with_sql(
        PANEL,
        """, c AS (SELECT count(CASE WHEN label = 0 THEN 1 END) AS n0, count(CASE WHEN label = 1 THEN 1 END) AS n1 FROM panel)
        SELECT n0, n1, round(n0 / n1, 6) AS ratio, least(n0, n1) AS min_class, CAST(least(5, n0, n1) AS INTEGER) AS folds FROM c""",
    )
)
def class_balance(spark, sf_dir):
    out = profile.class_balance(panel(spark, sf_dir), "label")
    return out.withColumn("ratio", F.round("ratio", 6))


@query(
    with_sql(
        PANEL,
        """SELECT CASE WHEN label = 1 THEN 'Riesgo Financiero (1)' ELSE 'Sin Riesgo (0)' END AS clase, count(*) AS n,
        round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM panel GROUP BY label""",
    )
)
def class_share(spark, sf_dir):
    shares = profile.frequency_table(panel(spark, sf_dir), "label")
    names = {0: "Sin Riesgo (0)", 1: "Riesgo Financiero (1)"}
    return shares.select(decode(F.col("label"), names).alias("clase"), "n", "pct")


CRITERIA = [("cfo", 0.0), ("liquidez", 1.0), ("dias_efectivo", 30.0)]


@query(
    with_sql(
        PANEL,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", CAST({t} AS DOUBLE) AS bound,
            round(100.0 * avg(CASE WHEN {c} < {t} THEN 1 WHEN {c} >= {t} THEN 0 END), 6) AS pct FROM panel WHERE label = 1"""
            for c, t in CRITERIA
        ),
    )
)
def criteria_share(spark, sf_dir):
    out = profile.criteria_share(panel(spark, sf_dir), "label", CRITERIA)
    return out.withColumn("pct", F.round("pct", 6))


@query(
    with_sql(
        PANEL,
        "SELECT unidad, round(avg(label), 6) AS rate, count(*) AS n FROM panel GROUP BY unidad",
    )
)
def rate_by_unit(spark, sf_dir):
    out = profile.group_rate(panel(spark, sf_dir), "unidad", "label")
    return out.withColumn("rate", F.round("rate", 6))


@query(
    with_sql(
        PANEL, "SELECT anio, round(avg(label), 6) AS rate, count(*) AS n FROM panel GROUP BY anio"
    )
)
def rate_by_year(spark, sf_dir):
    out = profile.group_rate(panel(spark, sf_dir), "anio", "label")
    return out.withColumn("rate", F.round("rate", 6)).orderBy("anio")


@query(
    with_sql(
        LONG,
        """, m AS (SELECT label, "column", avg(value) AS mean FROM long GROUP BY ALL)
        SELECT label, "column", round(mean, 6) AS mean,
        round((mean - min(mean) OVER (PARTITION BY "column")) / (max(mean) OVER (PARTITION BY "column") - min(mean) OVER (PARTITION BY "column") + 1e-9), 6) AS normalised
        FROM m""",
    )
)
def class_means_normalised(spark, sf_dir):
    out = profile.class_means(panel(spark, sf_dir), PANEL_FEATURES, "label")
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "normalised")})


@query(
    with_sql(
        LONG,
        """SELECT concat(unidad, '|', anio) AS row, "column", value FROM long WHERE "column" IN ('liquidez', 'cfo', 'gp_ratio')""",
    )
)
def heatmap_long(spark, sf_dir):
    return profile.matrix_long(keyed(spark, sf_dir), "id", ["liquidez", "cfo", "gp_ratio"])


@query(
    with_sql(
        PANEL,
        """, k AS (SELECT CAST(gp_ratio AS DOUBLE) AS x FROM panel),
        s AS (SELECT count(*) AS n, min(x) AS lo, max(x) AS hi, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM k),
        b AS (SELECT *, greatest(1, ceil(greatest(log2(n) + 1, (hi - lo) / (2 * iqr / cbrt(n))))) AS bins FROM s)
        SELECT CAST(least(floor((x - lo) / ((hi - lo) / bins)), bins - 1) AS INTEGER) AS bin, count(*) AS n,
        round(any_value(lo) + any_value((hi - lo) / bins) * CAST(least(floor((x - lo) / ((hi - lo) / bins)), bins - 1) AS INTEGER), 6) AS left_edge
        FROM k, b GROUP BY bin""",
    )
)
def histogram_auto(spark, sf_dir):
    out = charts.auto_histogram(panel(spark, sf_dir), "gp_ratio")
    return out.withColumn("left_edge", F.round("left_edge", 6))


@query(
    with_sql(
        PANEL,
        """, k AS (SELECT endeudamiento AS v FROM panel WHERE endeudamiento IS NOT NULL),
        s AS (SELECT count(*) AS n, min(v) AS lo, max(v) AS hi, stddev_samp(v) * pow(count(*), -0.2) AS h FROM k),
        g AS (SELECT CAST(range AS INTEGER) AS i FROM range(200))
        SELECT i, round(lo - 3 * h + (hi - lo + 6 * h) / 199 * i, 4) AS x,
        round(sum(exp(-0.5 * pow((lo - 3 * h + (hi - lo + 6 * h) / 199 * i - v) / h, 2))) / (n * h * sqrt(2 * pi())), 8) AS density
        FROM g, s, k GROUP BY i, lo, hi, h, n""",
    )
)
def histogram_kde(spark, sf_dir):
    out = charts.density_curve(panel(spark, sf_dir), "endeudamiento")
    return out.select("i", F.round("x", 4).alias("x"), F.round("density", 8).alias("density"))


FILL = ["liquidez", "endeudamiento", "cfo"]
FILLED = PANEL + """, med AS (SELECT median(liquidez) AS m1, median(endeudamiento) AS m2, median(cfo) AS m3 FROM panel),
 fuente AS (SELECT *, CASE WHEN anio % 3 = 0 THEN NULL ELSE 'G' || CAST(anio % 4 AS VARCHAR) END AS grupo FROM panel),
 modal AS (SELECT grupo AS m4 FROM fuente WHERE grupo IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, grupo LIMIT 1),
 filled AS (SELECT unidad, anio, label, coalesce(liquidez, m1) AS liquidez, coalesce(endeudamiento, m2) AS endeudamiento,
   coalesce(cfo, m3) AS cfo, coalesce(grupo, m4) AS grupo FROM fuente, med, modal)"""


def filled(spark, sf_dir):
    group = F.when(F.col("anio") % 3 != 0, F.concat(F.lit("G"), (F.col("anio") % 4).cast("string")))
    p = panel(spark, sf_dir).withColumn("grupo", group)
    p = prep.impute_mode(p, ["grupo"])
    return prep.impute_median(p, FILL).select("unidad", "anio", "label", *FILL, "grupo")


@query(
    with_sql(
        FILLED,
        "SELECT unidad, anio, label, round(liquidez, 7) AS liquidez, round(endeudamiento, 6) AS endeudamiento, round(cfo, 4) AS cfo, grupo FROM filled",
    )
)
def impute_median_mode(spark, sf_dir):
    out = filled(spark, sf_dir)
    return out.withColumns(
        {"liquidez": F.round("liquidez", 7), "endeudamiento": F.round("endeudamiento", 6), "cfo": F.round("cfo", 4)}
    )


@query(
    with_sql(
        PANEL,
        """, s AS (SELECT avg(liquidez) AS a, stddev_pop(liquidez) AS d, min(liquidez) AS lo, max(liquidez) AS hi FROM panel)
        SELECT unidad, anio, round((liquidez - a) / d, 6) AS liquidez_std, round((liquidez - lo) / (hi - lo), 6) AS liquidez_minmax,
        round((liquidez - lo) / (hi - lo + 1e-10), 6) AS liquidez_eps FROM panel, s""",
    )
)
def scale_standard_minmax(spark, sf_dir):
    p = panel(spark, sf_dir).select("unidad", "anio", "liquidez")
    p = prep.scale_standard(p, ["liquidez"])
    p = prep.scale_min_max(p, ["liquidez"])
    p = prep.scale_min_max(p, ["liquidez"], "_eps", 1e-10)
    return p.select("unidad", "anio", *[F.round(f"liquidez_{s}", 6).alias(f"liquidez_{s}") for s in ("std", "minmax", "eps")])


def _rank_sql(view, by):
    part = f"PARTITION BY {by} " if by else ""
    return f"""SELECT id, {by + ", " if by else ""}row_number() OVER ({part}ORDER BY md5(concat('42:', id)), id) AS rk,
      count(*) OVER ({part.strip()}) AS n FROM {view}"""


@query(
    with_sql(
        KEYED,
        f""", r AS ({_rank_sql("keyed", "")})
        SELECT id, CASE WHEN rk <= floor(n * 0.8 + 0.5) THEN 'train' ELSE 'test' END AS split FROM r""",
    )
)
def split_random(spark, sf_dir):
    return split.split_random(keyed(spark, sf_dir), "id").select("id", "split")


@query(
    with_sql(
        KEYED,
        f""", r AS ({_rank_sql("keyed", "label")})
        SELECT id, label, CASE WHEN rk <= floor(n * 0.75 + 0.5) THEN 'train' ELSE 'test' END AS split FROM r""",
    )
)
def split_stratified(spark, sf_dir):
    return split.split_stratified(keyed(spark, sf_dir), "id", "label").select("id", "label", "split")


@query(
    with_sql(
        KEYED,
        f""", r AS ({_rank_sql("keyed", "label")})
        SELECT id, label, CAST((rk - 1) % 5 AS INTEGER) AS fold FROM r""",
    )
)
def kfold_assign(spark, sf_dir):
    return split.assign_folds(keyed(spark, sf_dir), "id", 5, label="label").select("id", "label", "fold")


@query(
    with_sql(
        PANEL,
        """, z AS (SELECT (liquidez - avg(liquidez) OVER ()) / stddev_pop(liquidez) OVER () AS a,
             (gp_ratio - avg(gp_ratio) OVER ()) / stddev_pop(gp_ratio) OVER () AS b, unidad, anio
             FROM panel WHERE liquidez IS NOT NULL AND gp_ratio IS NOT NULL),
        c AS (SELECT covar_samp(a, b) AS r FROM z)
        SELECT unidad, anio, round((a + sign(r) * b) / sqrt(2), 6) AS pc1,
        round((a - sign(r) * b) / sqrt(2) , 6) AS pc2 FROM z, c""",
    )
)
def pca_2d(spark, sf_dir):
    """Two standardised columns: the components are their sum and difference."""
    p = panel(spark, sf_dir).dropna(subset=["liquidez", "gp_ratio"])
    p = prep.scale_standard(p.select("unidad", "anio", "liquidez", "gp_ratio"), ["liquidez", "gp_ratio"])
    p = prep.assemble(p, ["liquidez_std", "gp_ratio_std"])
    scores, _ = pca_scores(p, "features", 2)
    s = F.col("scores")
    return scores.select("unidad", "anio", F.round(s[0], 6).alias("pc1"), F.round(s[1], 6).alias("pc2"))


MODELS = PANEL + """, m AS (SELECT CAST(CASE WHEN liquidez < 1 THEN 1 ELSE 0 END AS INTEGER) AS a,
  CAST(CASE WHEN cfo < 0 THEN 1 ELSE 0 END AS INTEGER) AS b, label AS y FROM panel WHERE liquidez IS NOT NULL AND cfo IS NOT NULL),
 metric AS (SELECT model, 100.0 * avg(CASE WHEN p = y THEN 1 ELSE 0 END) / 100 AS accuracy,
   sum(p * y) / sum(p) AS precision, sum(p * y) / sum(y) AS recall FROM
   (SELECT 'liquidity' AS model, a AS p, y FROM m UNION ALL SELECT 'cash' AS model, b AS p, y FROM m) GROUP BY model)"""


@query(
    with_sql(
        MODELS,
        """SELECT 'accuracy' AS metric, round(max(CASE WHEN model = 'liquidity' THEN accuracy END), 6) AS liquidity,
          round(max(CASE WHEN model = 'cash' THEN accuracy END), 6) AS cash FROM metric
        UNION ALL SELECT 'precision', round(max(CASE WHEN model = 'liquidity' THEN precision END), 6),
          round(max(CASE WHEN model = 'cash' THEN precision END), 6) FROM metric
        UNION ALL SELECT 'recall', round(max(CASE WHEN model = 'liquidity' THEN recall END), 6),
          round(max(CASE WHEN model = 'cash' THEN recall END), 6) FROM metric""",
    )
)
def metric_table_reshape(spark, sf_dir):
    """Two one-rule models: stacked, compared, made long and turned round."""
    p = panel(spark, sf_dir).dropna(subset=["liquidez", "cfo"])
    p = p.withColumn("a", (F.col("liquidez") < 1).cast("int")).withColumn(
        "b", (F.col("cfo") < 0).cast("int")
    )
    stacked = evaluate.compare(
        [
            ("liquidity", evaluate.binary_metrics(p, "label", "a")),
            ("cash", evaluate.binary_metrics(p, "label", "b")),
        ]
    )
    names = ["accuracy", "precision", "recall"]
    out = evaluate.transpose(stacked, "model", names, ["liquidity", "cash"])
    return out.select("metric", *[F.round(m, 6).alias(m) for m in ("liquidity", "cash")])


@query(
    with_sql(
        PANEL,
        """SELECT unidad, anio, (CASE WHEN cfo > 0 THEN '+' ELSE '-' END || printf('%.3f', abs(cfo) / 1000000)) AS cfo_text,
        round(ln(1 + dias_efectivo), 6) AS dias_log, round_even(liquidez, 2) AS liquidez_2 FROM panel""",
    )
)
def scalar_texts(spark, sf_dir):
    return panel(spark, sf_dir).select(
        "unidad",
        "anio",
        signed_label(F.col("cfo") / 1_000_000).alias("cfo_text"),
        F.round(F.log1p("dias_efectivo"), 6).alias("dias_log"),
        round_half_even(F.col("liquidez"), 2).alias("liquidez_2"),
    )
