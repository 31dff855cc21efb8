"""Queries on the passenger view and the film records: statistics, encodings, splits, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.functions.scalars import decode
from ledgerlark.operators import charts, evaluate, features, prep, profile, rules, split
from ledgerlark.plans.registry import query
from ledgerlark.plans.views import (
    PASSENGERS,
    RECORDS,
    SCORED,
    passengers,
    records,
    scored,
    with_sql,
)
from ledgerlark.sources.records import parse_movies

NUMERIC = ["age", "fare", "sibsp", "parch"]
LONG = PASSENGERS + ", long AS (" + " UNION ALL ".join(
    f"SELECT id, '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM passengers WHERE {c} IS NOT NULL"
    for c in NUMERIC
) + ")"
FENCES = PASSENGERS + """, pos AS (SELECT age, fare FROM passengers WHERE age IS NOT NULL AND fare IS NOT NULL),
 q AS (SELECT quantile_cont(age, 0.25) AS a1, quantile_cont(age, 0.75) AS a3,
              quantile_cont(fare, 0.25) AS f1, quantile_cont(fare, 0.75) AS f3, count(*) AS n FROM pos),
 b AS (SELECT a1 - 0.4 * (a3 - a1) AS alo, a3 + 0.4 * (a3 - a1) AS ahi, f1 - 0.4 * (f3 - f1) AS flo, f3 + 0.4 * (f3 - f1) AS fhi FROM q)"""


@query(
    with_sql(
        LONG,
        """, c AS (SELECT "column", value, count(*) AS n FROM long GROUP BY ALL),
        m AS (SELECT "column", value AS mode, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rn FROM c)
        SELECT "column", round(avg(value), 6) AS mean, round(median(value), 6) AS median, any_value(mode) AS mode
        FROM long JOIN (SELECT "column", mode FROM m WHERE rn = 1) USING ("column") GROUP BY "column" """,
    )
)
def central_tendency(spark, sf_dir):
    out = profile.central_tendency(passengers(spark, sf_dir), NUMERIC)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "median")})


@query(
    with_sql(
        LONG,
        """SELECT "column", round(stddev_samp(value), 5) AS std, round(var_samp(value), 2) AS variance,
        round(max(value) - min(value), 4) AS range FROM long GROUP BY "column" """,
    )
)
def dispersion(spark, sf_dir):
    out = profile.dispersion(passengers(spark, sf_dir), NUMERIC)
    return out.select(
        "column",
        F.round("std", 5).alias("std"),
        F.round("variance", 2).alias("variance"),
        F.round("range", 4).alias("range"),
    )


@query(
    with_sql(
        FENCES,
        """SELECT 'age' AS "column", n, round(a1, 6) AS q1, round(a3, 6) AS q3, round(a3 - a1, 6) AS iqr,
          round(alo, 6) AS lower, round(ahi, 6) AS upper FROM q, b
        UNION ALL SELECT 'fare', n, round(f1, 6), round(f3, 6), round(f3 - f1, 6), round(flo, 6), round(fhi, 6) FROM q, b""",
    )
)
def iqr_fences(spark, sf_dir):
    out = rules.fences(passengers(spark, sf_dir), ["age", "fare"], 0.4)
    return out.select(
        "column", "n", *[F.round(c, 6).alias(c) for c in ("q1", "q3", "iqr", "lower", "upper")]
    )


@query(
    with_sql(
        FENCES,
        """SELECT count(*) AS judged, count(CASE WHEN age BETWEEN alo AND ahi AND fare BETWEEN flo AND fhi THEN 1 END) AS inliers,
        count(*) - count(CASE WHEN age BETWEEN alo AND ahi AND fare BETWEEN flo AND fhi THEN 1 END) AS outliers FROM pos, b""",
    )
)
def iqr_outlier_counts(spark, sf_dir):
    return rules.outlier_counts(passengers(spark, sf_dir), ["age", "fare"], 0.4)


@query(
    with_sql(
        FENCES,
        """SELECT id, age, fare FROM passengers, b WHERE age IS NULL OR fare IS NULL
        OR (age BETWEEN alo AND ahi AND fare BETWEEN flo AND fhi)""",
    )
)
def filter_iqr_inliers(spark, sf_dir):
    """Fences narrower than usual, as the stand-in columns have no far outliers."""
    kept = rules.keep_inliers(passengers(spark, sf_dir), ["age", "fare"], 0.4)
    return kept.select("id", "age", "fare")


@query(
    with_sql(
        FENCES,
        """SELECT id, survived, fare FROM passengers JOIN (SELECT survived, quantile_cont(fare, 0.25) AS q1,
          quantile_cont(fare, 0.75) AS q3 FROM passengers WHERE fare IS NOT NULL GROUP BY 1) USING (survived)
        WHERE fare < q1 - 0.4 * (q3 - q1) OR fare > q3 + 0.4 * (q3 - q1)""",
    )
)
def box_fliers(spark, sf_dir):
    p = passengers(spark, sf_dir).select("id", "survived", "fare")
    return charts.fliers(p, "fare", "survived", 0.4)


@query(
    with_sql(
        PASSENGERS,
        """SELECT id, CASE WHEN survived = 1 THEN 'Exitosa' ELSE 'No exitosa' END AS verdict,
        round(ln(1 + fare), 6) AS fare_log, coalesce(cabin, 'Unknown') AS cabin,
        round(fare / (sibsp + 1), 5) AS fare_each FROM passengers""",
    )
)
def scalar_derivations(spark, sf_dir):
    return passengers(spark, sf_dir).select(
        "id",
        decode(F.col("survived"), {1: "Exitosa", 0: "No exitosa"}).alias("verdict"),
        F.round(F.log1p("fare"), 6).alias("fare_log"),
        F.coalesce("cabin", F.lit("Unknown")).alias("cabin"),
        F.round(F.col("fare") / (F.col("sibsp") + 1), 5).alias("fare_each"),
    )


MOVIES = RECORDS + """, movies AS (
  SELECT event_id, title, CAST(rating AS DOUBLE) AS rating, votes, CAST(runtime AS INTEGER) AS runtime, CAST(year AS INTEGER) AS year
  FROM typed WHERE response = 'True' AND rating IS NOT NULL)"""


@query(with_sql(MOVIES, "SELECT * FROM movies"))
def parse_records(spark, sf_dir):
    return parse_movies(records(spark, sf_dir), "raw")


@query(
    with_sql(
        MOVIES,
        """SELECT event_id, round(votes / (runtime + 1), 6) AS votes_per_min, round(ln(1 + votes), 6) AS votes_log,
        CAST(2026 - year AS INTEGER) AS age, CAST(runtime * runtime AS INTEGER) AS runtime_squared FROM movies""",
    )
)
def movie_features(spark, sf_dir):
    out = features.movie_features(parse_movies(records(spark, sf_dir), "raw"))
    return out.select(
        "event_id",
        F.round("votes_per_min", 6).alias("votes_per_min"),
        F.round("votes_log", 6).alias("votes_log"),
        "age",
        "runtime_squared",
    )


@query(
    with_sql(
        MOVIES,
        """, t AS (SELECT CASE WHEN least(count(CASE WHEN rating >= 9.9 THEN 1 END), count(CASE WHEN rating < 9.9 THEN 1 END)) >= 1000 THEN 9.9
          WHEN least(count(CASE WHEN rating >= 9.5 THEN 1 END), count(CASE WHEN rating < 9.5 THEN 1 END)) >= 1000 THEN 9.5
          WHEN least(count(CASE WHEN rating >= 9.0 THEN 1 END), count(CASE WHEN rating < 9.0 THEN 1 END)) >= 1000 THEN 9.0
          ELSE 8.0 END AS threshold FROM movies)
        SELECT event_id, CAST(threshold AS DOUBLE) AS threshold, CAST(CASE WHEN rating >= threshold THEN 1 ELSE 0 END AS INTEGER) AS success
        FROM movies, t""",
    )
)
def threshold_ladder(spark, sf_dir):
    movies = parse_movies(records(spark, sf_dir), "raw")
    out = rules.threshold_ladder(movies, "rating", [9.9, 9.5, 9.0, 8.0], min_class=1000)
    return out.select("event_id", "threshold", "success")


SEXES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    with_sql(
        PASSENGERS,
        "SELECT id, "
        + ", ".join(f"CAST(coalesce(sex = '{s}', false) AS INTEGER) AS \"sex_{s}\"" for s in SEXES)
        + ", "
        + ", ".join(f"CAST(coalesce(embarked = '{s}', false) AS INTEGER) AS \"embarked_{s}\"" for s in "CQS")
        + " FROM passengers",
    )
)
def onehot_encode(spark, sf_dir):
    p = passengers(spark, sf_dir).select("id", "sex", "embarked")
    return prep.one_hot(p, ["sex", "embarked"])


@query(
    with_sql(
        PASSENGERS,
        """, d AS (SELECT embarked, CAST(row_number() OVER (ORDER BY embarked) - 1 AS INTEGER) AS embarked_code
          FROM (SELECT DISTINCT embarked FROM passengers WHERE embarked IS NOT NULL))
        SELECT id, embarked, embarked_code FROM passengers LEFT JOIN d USING (embarked)""",
    )
)
def ordinal_encode(spark, sf_dir):
    p = passengers(spark, sf_dir).select("id", "embarked")
    return prep.ordinal_encode(p, "embarked", "embarked_code")


@query(
    with_sql(
        PASSENGERS,
        """, f AS (SELECT id, coalesce(cabin, 'Unknown') AS cabin FROM passengers),
        d AS (SELECT cabin, row_number() OVER (ORDER BY min(id)) AS code FROM f GROUP BY cabin)
        SELECT id, CAST((code >> 4) & 1 AS INTEGER) AS cabin_0, CAST((code >> 3) & 1 AS INTEGER) AS cabin_1,
        CAST((code >> 2) & 1 AS INTEGER) AS cabin_2, CAST((code >> 1) & 1 AS INTEGER) AS cabin_3, CAST(code & 1 AS INTEGER) AS cabin_4
        FROM f JOIN d USING (cabin)""",
    )
)
def binary_encode(spark, sf_dir):
    p = passengers(spark, sf_dir).select("id", "cabin")
    return prep.binary_encode(p, "cabin", "id", prep.bits_for(p, "cabin"))


def _ranked(by: str) -> str:
    part = f"PARTITION BY {by}"
    return f"""r AS (SELECT *, row_number() OVER ({part} ORDER BY md5(concat('42:', id)), id) AS rk, count(*) OVER ({part}) AS n FROM base)"""


@query(
    with_sql(
        PASSENGERS,
        f""", base AS (SELECT id, survived FROM passengers), {_ranked("survived")}
        SELECT id, survived, CASE WHEN rk <= floor(n * 0.6 + 0.5) THEN 'train' WHEN rk <= floor(n * 0.8 + 0.5) THEN 'validation' ELSE 'test' END AS split FROM r""",
    )
)
def split_three_way(spark, sf_dir):
    p = passengers(spark, sf_dir).select("id", "survived")
    return split.split_three_way(p, "id", "survived")


@query(
    with_sql(
        PASSENGERS,
        f""", base AS (SELECT id, survived, CAST(CASE WHEN fare > 250000 THEN 1 ELSE 0 END AS INTEGER) AS revised FROM passengers), {_ranked("revised")}
        SELECT id, survived, revised, CASE WHEN rk <= floor(n * 0.8 + 0.5) THEN 'train' ELSE 'test' END AS split FROM r""",
    )
)
def split_joint(spark, sf_dir):
    """One split for two label columns, stratified on the revised one."""
    revised = F.coalesce((F.col("fare") > 250_000).cast("int"), F.lit(0))
    p = passengers(spark, sf_dir).select("id", "survived", revised.alias("revised"))
    return split.split_stratified(p, "id", "revised", 0.2)


RATES = """, t AS (SELECT count(*) AS n, sum(CASE WHEN y = pred THEN 1 ELSE 0 END) AS hits, sum(y * pred) AS tp,
  sum((1 - y) * pred) AS fp, sum(y * (1 - pred)) AS fn, sum((1 - y) * (1 - pred)) AS tn FROM judged),
 m AS (SELECT hits / n AS accuracy, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, tn / (tn + fp) AS spec FROM t)"""


@query(
    with_sql(
        SCORED + RATES,
        """SELECT round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
        round(2 * precision * recall / (precision + recall), 6) AS f1 FROM m""",
    )
)
def binary_metrics(spark, sf_dir):
    out = evaluate.binary_metrics(scored(spark, sf_dir), "y", "pred")
    return out.select(*[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@query(with_sql(SCORED + RATES, "SELECT round((recall + spec) / 2, 6) AS hard_auc FROM m"))
def hard_auc(spark, sf_dir):
    out = evaluate.binary_metrics(scored(spark, sf_dir), "y", "pred")
    return out.select(F.round("hard_auc", 6).alias("hard_auc"))


@query(
    with_sql(
        SCORED,
        """SELECT y, count(CASE WHEN pred = 0 THEN 1 END) AS pred_0, count(CASE WHEN pred = 1 THEN 1 END) AS pred_1
        FROM judged GROUP BY y""",
    )
)
def confusion(spark, sf_dir):
    return evaluate.confusion(scored(spark, sf_dir), "y", "pred", [0, 1])


@query(
    with_sql(
        SCORED,
        """, c AS (SELECT CAST(v AS VARCHAR) AS class, sum(CASE WHEN y = v AND pred = v THEN 1 ELSE 0 END) / sum(CASE WHEN pred = v THEN 1 ELSE 0 END) AS p,
          sum(CASE WHEN y = v AND pred = v THEN 1 ELSE 0 END) / sum(CASE WHEN y = v THEN 1 ELSE 0 END) AS r,
          CAST(sum(CASE WHEN y = v THEN 1 ELSE 0 END) AS BIGINT) AS support FROM judged, (VALUES (0), (1)) AS t(v) GROUP BY v),
        f AS (SELECT *, 2 * p * r / (p + r) AS f1 FROM c),
        a AS (SELECT avg(CASE WHEN y = pred THEN 1 ELSE 0 END) AS acc, count(*) AS n FROM judged)
        SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, support FROM f
        UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), n FROM a
        UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
        UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
          round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f""",
    )
)
def classification_report(spark, sf_dir):
    out = evaluate.classification_report(scored(spark, sf_dir), "y", "pred", [0, 1])
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


STEPS = SCORED + """, st AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY score)"""


@query(
    with_sql(
        STEPS,
        """, c AS (SELECT *, sum(neg) OVER (ORDER BY score) - neg / 2 AS below FROM st)
        SELECT round(sum(pos * below) / (sum(pos) * sum(neg)), 8) AS roc_auc FROM c""",
    )
)
def roc_auc(spark, sf_dir):
    out = evaluate.roc_auc(scored(spark, sf_dir), "y", "score")
    return out.select(F.round("roc_auc", 8).alias("roc_auc"))


@query(
    with_sql(
        STEPS,
        """, c AS (SELECT score, pos, neg, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, lead(pos) OVER w AS np, lead(neg) OVER w AS nn
          FROM st WINDOW w AS (ORDER BY score DESC)), t AS (SELECT sum(pos) AS p, sum(neg) AS n FROM st)
        SELECT score AS threshold, round(cn / n, 8) AS fpr, round(cp / p, 8) AS tpr FROM c, t
        WHERE np IS NULL OR NOT (np = pos AND nn = neg)
        UNION ALL SELECT NULL, 0.0, 0.0""",
    )
)
def roc_curve(spark, sf_dir):
    out = evaluate.roc_curve(scored(spark, sf_dir), "y", "score")
    return out.withColumns({c: F.round(c, 8) for c in ("fpr", "tpr")})


@query(
    with_sql(
        PASSENGERS,
        """, e AS (SELECT fare AS y, 150000 + 20000 * sibsp + 7 * age AS p FROM passengers WHERE fare IS NOT NULL AND age IS NOT NULL)
        SELECT round(1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), 8) AS r2, round(avg(abs(y - p)), 4) AS mae,
        round(avg((y - p) * (y - p)), 0) AS mse, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse FROM e""",
    )
)
def regression_metrics(spark, sf_dir):
    p = passengers(spark, sf_dir).dropna(subset=["fare", "age"])
    p = p.withColumn("guess", 150_000 + 20_000 * F.col("sibsp") + 7 * F.col("age"))
    out = evaluate.regression_metrics(p, "fare", "guess")
    return out.select(
        F.round("r2", 8).alias("r2"),
        F.round("mae", 4).alias("mae"),
        F.round("mse", 0).alias("mse"),
        F.round("rmse", 4).alias("rmse"),
    )


@query(
    with_sql(
        PASSENGERS,
        """SELECT embarked, sex, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY sex), 6) AS pct
        FROM passengers WHERE embarked IS NOT NULL AND sex IS NOT NULL GROUP BY embarked, sex""",
    )
)
def frequency_by_group(spark, sf_dir):
    return profile.frequency_table(passengers(spark, sf_dir), "embarked", ["sex"])
