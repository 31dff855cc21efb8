"""Whole analyses from a raw table to result tables. Each value is a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from ledgerlark import presets
from ledgerlark.functions.calendar import calendar_parts
from ledgerlark.functions.parse import (
    clean_text,
    parse_day_first,
    parse_money,
    strip_punctuation,
    with_date_ladder,
)
from ledgerlark.operators import (
    audit,
    charts,
    cluster,
    evaluate,
    features,
    models,
    prep,
    profile,
    rules,
    split,
    text,
    tune,
)
from ledgerlark.operators.dbscan import adaptive_eps, dbscan, summary
from ledgerlark.session import cut_lineage
from ledgerlark.sources.tables import drop_blank_columns, normalise_headers

LABEL = "es_gasto_hormiga"


def clean_transactions(raw: DataFrame, default_year: int | None = None) -> DataFrame:
    """Headers, dates, descriptions and amounts of a raw ledger."""
    df = normalise_headers(drop_blank_columns(raw))
    return df.withColumns(
        {
            "fecha": parse_day_first(F.col("fecha"), default_year),
            "descripcion": clean_text(F.col("descripcion").cast("string")),
            "valor": parse_money(F.col("valor")),
        }
    )


def label_transactions(df: DataFrame, threshold: float = presets.SMALL_SPEND_THRESHOLD) -> DataFrame:
    spent = rules.keep_outflows(df, "valor")
    label = rules.small_spend_flag(
        F.col("descripcion"), F.col("valor"), presets.SMALL_SPEND_EXCLUDED, threshold
    )
    return spent.withColumn(LABEL, label)


def label_ordered(df: DataFrame, description: str = "descripcion", amount: str = "valor") -> DataFrame:
    """Expenses labelled by the ordered keyword lists, then by amount."""
    spent = rules.keep_outflows(rules.exclude_values(df, description, presets.NOT_AN_EXPENSE), amount)
    label = rules.ordered_keyword_label(
        F.col(description), F.abs(amount), presets.ALWAYS_SMALL, list(presets.NEVER_SMALL.values()),
        float(presets.ORDERED_THRESHOLD),
    )
    return spent.withColumn("etiqueta", label)


def transaction_report(df: DataFrame, row_id: str, sample: int = 2000) -> dict[str, DataFrame]:
    """Chart data of a feature table; charts whose columns are missing are left out."""
    out: dict[str, DataFrame] = {}
    if rules.require(df, ["valor_abs"]):
        whole = df.withColumn("_all", F.lit(0))
        out["amount_histogram"] = charts.histogram(whole, "valor_abs", 40, "_all").drop("_all")
    if rules.require(df, [LABEL, "valor_abs"]):
        out["label_counts"] = profile.frequency_table(df, LABEL)
        out["amount_boxes"] = charts.box_stats(df, "valor_abs", LABEL)
        small = df.where(F.col("valor_abs") <= 100_000)
        out["amount_boxes_zoom"] = charts.box_stats(small, "valor_abs", LABEL)
    if rules.require(df, ["descripcion", LABEL]):
        out["top_descriptions"] = charts.top_groups(df, "descripcion", LABEL, 10)
    if rules.require(df, ["fecha_dia", LABEL, "valor_abs"]):
        out["daily_totals"] = charts.daily_series(df, "fecha_dia", LABEL, "valor_abs")
    pair = ["freq_por_descripcion", "gasto_promedio_descripcion"]
    if rules.require(df, [*pair, LABEL]):
        out["frequency_scatter"] = charts.scatter_series(df, row_id, pair, LABEL, sample, 42)
    wanted = ["valor_abs", "dia_semana", "mes", "dia", "es_fin_semana", "freq_gastos_dia"]
    wanted += ["gasto_diario_acumulado", *pair, LABEL]
    present = [c for c in wanted if c in df.columns]
    if len(present) >= 2:
        out["correlation"] = profile.correlation_matrix(df, present)
    return out


def spending_matrix(
    df: DataFrame,
    terms: int = 50,
    stop_words: Sequence[str] | None = None,
    default_year: int | None = None,
) -> DataFrame:
    """Scaled vector ``v`` of a ledger: calendar, amount, frequency and description terms.

    Dates without a year take ``default_year``. A row without a date has the mean of each calendar
    part, which is 0 after scaling. ``stop_words`` are Spark's English list if not given.
    """
    if stop_words is None:
        stop_words = text.english_stop_words()
    dated = with_date_ladder(df, "FECHA", "fecha", default_year)
    dated = dated.withColumns(calendar_parts(F.col("fecha")))
    dated = prep.scale_standard(dated, ["VALOR"]).withColumn("log_valor", F.log1p("VALOR"))
    binned = features.add_quantile_bin(dated, "VALOR", 5, "quintil")
    counted = features.add_frequency(binned, "DESCRIPCION", "frecuencia_desc", df)
    body = strip_punctuation(clean_text(F.col("DESCRIPCION"), upper=True))
    with_terms, _ = text.tfidf_vectors(counted.withColumn("_body", body), "_body", terms, stop_words)
    names = ["VALOR_std", "log_valor", "quintil", "frecuencia_desc"]
    names += ["dia", "mes", "dia_semana", "trimestre", "semana", "es_fin_semana"]
    typed = with_terms.withColumns({c: F.col(c).cast("double") for c in names})
    scaled = prep.scale_standard(typed, names, "_z")
    scaled = scaled.withColumns({f"{n}_z": F.coalesce(f"{n}_z", F.lit(0.0)) for n in names})
    raw = prep.assemble(scaled, [f"{n}_z" for n in names] + ["tfidf"], "_f")
    return raw.withColumn("v", vector_to_array("_f")).select(*df.columns, "v")


def hybrid_relabel(
    df: DataFrame, row_id: str, label: str, vector: str = "v", restarts: int = 10
) -> dict[str, DataFrame]:
    """Five clusterings, the label they agree on, and models fitted on both labels."""
    rows = cut_lineage(df.select(row_id, label, vector))
    found = cut_lineage(cluster.all_clusterings(rows, row_id, vector, 3, restarts))
    revised = cut_lineage(audit.consensus_relabel(rows, found, row_id, label))
    ready = split.split_stratified(revised, row_id, "revised", 0.2)
    ready = cut_lineage(ready.withColumn("features", array_to_vector(vector)))
    n = ready.where(F.col("split") == "train").count()
    makers = {
        "DecisionTree": lambda y: models.decision_tree(y, 10, 5),
        "LogisticRegression": lambda y: models.logistic(y, n),
        "LinearRegression": models.least_squares,
    }
    labels = {"Original": label, "Reevaluada": "revised"}
    return {
        "assignments": found,
        "revised": revised.drop(vector),
        "verdicts": audit.cluster_verdicts(
            found.join(rows.select(row_id, label), row_id), label, ["algorithm", "cluster"]
        ),
        "changes": audit.label_changes(revised, label, "revised"),
        "comparison": tune.compare_labels(makers, ready, labels, "split", ["LinearRegression"]),
    }


def panel_report(df: DataFrame, columns: Sequence[str], label: str, unit: str, year: str):
    """Profile of a labelled panel."""
    return {
        "info": profile.table_info(df),
        "nulls": profile.null_profile(df),
        "balance": profile.class_balance(df, label),
        "by_class": profile.describe_by_class(df, columns, label),
        "class_means": profile.class_means(df, columns, label),
        "skewness": profile.corrected_skewness(df, columns),
        "correlation": profile.correlation_matrix(df, [*columns, label]),
        "with_target": profile.correlation_with_target(df, columns, label),
        "by_unit": profile.group_rate(df, unit, label),
        "by_year": profile.group_rate(df, year, label),
    }


def panel_models(
    df: DataFrame, row_id: str, columns: Sequence[str], label: str, folds: int = 5, trees: int = 300,
    rounds: int = 200,
) -> DataFrame:
    """Tree, forest and boosting: test metrics, AUC, cross-validated F1 and the best by F1."""
    known = prep.impute_median(rules.with_known_target(df, label), columns)
    parts = cut_lineage(split.split_stratified(known, row_id, label))
    train, test = (parts.where(F.col("split") == p) for p in ("train", "test"))
    fits = {
        "tree": models.BalancedTrees(label, models.decision_tree(label, balanced=True)),
        "forest": models.BalancedTrees(label, models.random_forest(label, trees, None, 2, balanced=True)),
        "boosting": models.gradient_boosting(label, rounds, 0.08, 4, 3, 0.8, "sqrt"),
    }
    # The scaler is learnt with the model, from the rows of each fit.
    fits = {name: Pipeline(stages=[prep.MixedStage(columns), m]) for name, m in fits.items()}
    dealt = cut_lineage(split.assign_folds(train, row_id, folds, label=label))
    cv = tune.score_summary(tune.fold_scores(fits, dealt, label, "fold", folds, "f1"))
    tables = []
    for name, estimator in fits.items():
        judged = models.decide(estimator.fit(train).transform(test))
        scored = models.with_probability(judged)
        row = evaluate.binary_metrics(scored, label, "pred")
        auc = evaluate.roc_auc(scored, label, "p1").scalar()
        tables.append((name, row.withColumn("roc_auc", auc)))
    best = evaluate.compare(tables)
    return best.join(cv.select("model", F.col("mean").alias("cv_f1")), "model")


def cluster_audit(
    df: DataFrame, row_id: str, label: str, columns: Sequence[str] | None = None, restarts: int = 10
) -> dict[str, DataFrame]:
    """Do clusters found without the label agree with it? K-means in two, then density clusters."""
    names = list(columns or rules.numeric_columns(df.drop(label, row_id)))
    complete = df.dropna(subset=names).select(row_id, label, *names)
    scaled = prep.scale_standard(complete, names, "_z")
    vector = F.array(*[F.col(f"{n}_z").cast("double") for n in names])
    rows = cut_lineage(scaled.select(row_id, label, vector.alias("v")))
    centres, _ = cluster.kmeans(rows, "v", 2, restarts)
    halves = cluster.assign(rows, "v", centres)
    eps = adaptive_eps(rows, row_id, "v", 5, 0.9, "index").first()["eps"]
    dense = cut_lineage(dbscan(rows, row_id, "v", eps, 5))
    return {
        "agreement": audit.cluster_agreement(halves, label, "cluster"),
        "matching": audit.matching_clusters(halves, label, "cluster"),
        "mislabelled": audit.mislabelled(halves, label, "cluster").drop("v"),
        "hits": audit.hit_flags(halves, label, "cluster").drop("v"),
        "density": summary(dense),
        "contingency": profile.contingency(dense, label, "cluster"),
        "quality": audit.parity_flags(dense, label, "cluster").drop("v"),
    }
