"""Evaluation of decisions, scores and predictions by plain aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlark.operators.ranking import with_running_totals
from ledgerlark.session import cut_lineage


def _zero_div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return _zero_div(2 * p * r, p + r)


def _counts(y: str, pred: str, positive: object) -> list[Column]:
    is_y, is_p = F.col(y) == F.lit(positive), F.col(pred) == F.lit(positive)
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(y) == F.col(pred)).alias("hits"),
        F.count_if(is_y & is_p).alias("tp"),
        F.count_if(~is_y & is_p).alias("fp"),
        F.count_if(is_y & ~is_p).alias("fn"),
        F.count_if(~is_y & ~is_p).alias("tn"),
    ]


def binary_metrics(
    df: DataFrame, y: str, pred: str, positive: object = 1, by: Sequence[str] = ()
) -> DataFrame:
    """Accuracy, precision, recall, F1 and the AUC of the hard decisions; 0 where undefined."""
    c = df.groupBy(*by).agg(*_counts(y, pred, positive))
    precision = _zero_div(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _zero_div(F.col("tp"), F.col("tp") + F.col("fn"))
    specificity = _zero_div(F.col("tn"), F.col("tn") + F.col("fp"))
    both = (F.col("tp") + F.col("fn") > 0) & (F.col("tn") + F.col("fp") > 0)
    return c.select(
        *by,
        _zero_div(F.col("hits"), F.col("n")).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _f1(precision, recall).alias("f1"),
        F.when(both, (recall + specificity) / 2).otherwise(F.lit(0.0)).alias("hard_auc"),
    )


def confusion(df: DataFrame, y: str, pred: str, labels: Sequence[object]) -> DataFrame:
    """One row per true label, one column ``pred_<label>`` per decision, zeros filled in."""
    wide = df.groupBy(y).agg(
        *[F.count_if(F.col(pred) == F.lit(p)).alias(f"pred_{p}") for p in labels]
    )
    frame = df.sparkSession.createDataFrame([(v,) for v in labels], df.select(y).schema)
    names = [f"pred_{p}" for p in labels]
    return frame.join(wide, y, "left").fillna(0, names).select(y, *names)


def classification_report(df: DataFrame, y: str, pred: str, labels: Sequence[object]) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(y) == F.col(pred)).alias("hits"),
        *[
            F.struct(
                F.count_if((F.col(y) == F.lit(v)) & (F.col(pred) == F.lit(v))).alias("tp"),
                F.count_if(F.col(pred) == F.lit(v)).alias("guessed"),
                F.count_if(F.col(y) == F.lit(v)).alias("support"),
            ).alias(f"c{i}")
            for i, v in enumerate(labels)
        ],
    )
    cells = []
    for i, v in enumerate(labels):
        c = F.col(f"c{i}")
        p, r = _zero_div(c["tp"], c["guessed"]), _zero_div(c["tp"], c["support"])
        cells.append((str(v), p, r, _f1(p, r), c["support"]))
    n, accuracy = F.col("n"), _zero_div(F.col("hits"), F.col("n"))
    rows = cells + [
        ("accuracy", accuracy, accuracy, accuracy, n),
        ("macro avg", *[_mean(cells, j) for j in (1, 2, 3)], n),
        ("weighted avg", *[_weighted(cells, j, n) for j in (1, 2, 3)], n),
    ]
    names = ("class", "precision", "recall", "f1", "support")
    structs = [
        F.struct(*[(F.lit(x) if isinstance(x, str) else x).alias(m) for x, m in zip(row, names)])
        for row in rows
    ]
    return one.select(F.inline(F.array(*structs)))


def _mean(cells: list, j: int) -> Column:
    total = cells[0][j]
    for c in cells[1:]:
        total = total + c[j]
    return total / len(cells)


def _weighted(cells: list, j: int, n: Column) -> Column:
    total = _zero_div(cells[0][j] * cells[0][4], n)
    for c in cells[1:]:
        total = total + _zero_div(c[j] * c[4], n)
    return total


def _score_steps(df: DataFrame, y: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score; equal scores are one step."""
    return (
        df.where(F.col(score).isNotNull() & F.col(y).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(
            F.sum((F.col(y) == 1).cast("bigint")).alias("pos"),
            F.sum((F.col(y) == 0).cast("bigint")).alias("neg"),
        )
    )


def roc_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Exact area under the ROC curve with average ranks for ties; 0 if a class is missing."""
    steps = with_running_totals(_score_steps(df, y, score), "score", ["neg"])
    below = F.col("cum_neg") - F.col("neg") + F.col("neg") / 2
    out = steps.agg(
        F.sum(F.col("pos") * below).alias("u"), F.sum("pos").alias("p"), F.sum("neg").alias("n")
    )
    return out.select(_zero_div(F.col("u"), F.col("p") * F.col("n")).alias("roc_auc"))


def roc_curve(df: DataFrame, y: str, score: str) -> DataFrame:
    """Points (threshold, fpr, tpr) from high to low score; points inside a straight run are dropped.

    A point is dropped when the next step adds as many positives and as many negatives as its own;
    the next step is found by its position in the running totals, not by one window over all
    scores. The point (0, 0) comes before the first step and has no threshold.
    """
    steps = with_running_totals(_score_steps(df, y, score), "score", ["pos", "neg"], descending=True)
    steps = cut_lineage(steps.withColumn("_end", F.col("cum_pos") + F.col("cum_neg")))
    following = steps.select(
        (F.col("_end") - F.col("pos") - F.col("neg")).alias("_end"),
        F.col("pos").alias("next_pos"),
        F.col("neg").alias("next_neg"),
    )
    total = steps.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    straight = (F.col("next_pos") == F.col("pos")) & (F.col("next_neg") == F.col("neg"))
    kept = steps.join(following, "_end", "left").where(F.col("next_pos").isNull() | ~straight)
    origin = F.struct(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    point = F.struct(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("cum_neg").cast("double"), F.col("_total")["n"]).alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), F.col("_total")["p"]).alias("tpr"),
    )
    last = F.col("next_pos").isNull()
    points = F.when(last, F.array(origin, point)).otherwise(F.array(point))
    return kept.withColumn("_total", total).select(F.inline(points))


def regression_metrics(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """R², MAE, MSE and RMSE."""
    e = F.col(y) - F.col(pred)
    s = df.groupBy(*by).agg(
        F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.var_pop(y).alias("_v")
    )
    return s.select(
        *by,
        (1 - F.try_divide(F.col("mse"), F.col("_v"))).alias("r2"),
        "mae",
        "mse",
        F.sqrt("mse").alias("rmse"),
    )


def compare(tables: Sequence[tuple[str, DataFrame]], rank_by: str = "f1") -> DataFrame:
    """Stack one-row metric tables and mark the best; the first one wins ties."""
    out = None
    for i, (name, table) in enumerate(tables):
        row = table.select(F.lit(name).alias("model"), F.lit(i).alias("_i"), *table.columns)
        out = row if out is None else out.unionByName(row)
    few = W.partitionBy()  # one row per model
    best = F.max_by("_i", F.struct(F.col(rank_by), -F.col("_i"))).over(few)
    return out.withColumn("best", (F.col("_i") == best).cast("int")).drop("_i")


def to_long(df: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """Wide metric table to rows (key, metric, value)."""
    return df.unpivot([key], list(metrics), "metric", "value")


def transpose(df: DataFrame, key: str, metrics: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per metric, one column per model."""
    return to_long(df, key, metrics).groupBy("metric").pivot(key, list(names)).agg(F.first("value"))
