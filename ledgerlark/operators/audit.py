"""Auditing of given labels against clusters found without them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.operators.skew import attach_by_key, checked_broadcast
from ledgerlark.presets import VERDICT_LOWEST, VERDICT_TIERS


def cluster_verdicts(df: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """Size, positives and majority label of each cluster; an even split gives 0."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("positives"))
        .withColumn("verdict", (F.col("positives") * 2 > F.col("n")).cast("int"))
    )


def usable_algorithms(assignments: DataFrame) -> DataFrame:
    """Drop algorithms that found fewer than two clusters, unless all of them did."""
    found = assignments.groupBy("algorithm").agg(F.count_distinct("cluster").alias("_k"))
    best = found.agg(F.max("_k")).scalar()
    keep = found.where((F.col("_k") >= 2) | (best < 2)).select("algorithm")
    return assignments.join(
        checked_broadcast(keep, assignments, ["algorithm"]), "algorithm", "left_semi"
    )


def consensus_relabel(
    labelled: DataFrame, assignments: DataFrame, row_id: str, label: str, target: str = "revised"
) -> DataFrame:
    """Add the label most algorithms vote for; a row's vote is its cluster's majority label.

    A tie between algorithms gives 1, a tie inside a cluster gives 0.
    """
    usable = usable_algorithms(assignments).join(labelled.select(row_id, label), row_id)
    keys = ["algorithm", "cluster"]
    votes = attach_by_key(usable, cluster_verdicts(usable, label, keys), keys, "n")
    mean = votes.groupBy(row_id).agg(F.avg("verdict").alias("_mean"))
    out = labelled.join(mean, row_id, "left")
    return out.withColumn(target, (F.col("_mean") >= 0.5).cast("int")).drop("_mean")


def label_changes(df: DataFrame, label: str, revised: str) -> DataFrame:
    """One row: number and share (percent) of changed labels, and both class counts."""
    changes = F.count_if(F.col(label) != F.col(revised))
    return df.agg(
        changes.alias("changes"),
        F.coalesce(F.try_divide(100.0 * changes, F.count(F.lit(1))), F.lit(0.0)).alias("pct"),
        F.count_if(F.col(label) == 1).alias("ones_before"),
        F.count_if(F.col(revised) == 1).alias("ones_after"),
    )


def matching_clusters(df: DataFrame, label: str, cluster: str) -> DataFrame:
    """Rows (label, matched, share): the cluster holding most of a label and its share in percent.

    Ties favour the cluster with the label's own number, then the lowest.
    """
    counts = df.groupBy(label, cluster).agg(F.count(F.lit(1)).alias("n"))
    own = (F.col(cluster) == F.col(label)).cast("int")
    best = F.max_by(cluster, F.struct(F.col("n"), own, -F.col(cluster)))
    return counts.groupBy(label).agg(
        best.alias("matched"), (100.0 * F.max("n") / F.sum("n")).alias("share")
    )


def verdict(agreement: Column) -> Column:
    """Tier of an agreement percentage."""
    case = None
    for bound, name in VERDICT_TIERS:
        case = F.when(agreement >= bound, name) if case is None else case.when(agreement >= bound, name)
    return case.otherwise(VERDICT_LOWEST)


def cluster_agreement(df: DataFrame, label: str, cluster: str) -> DataFrame:
    """One row: mean over the labels of the share in their own best cluster, and its tier.

    Each label picks its cluster alone, so two labels may pick the same one.
    """
    one = matching_clusters(df, label, cluster).agg(F.avg("share").alias("agreement"))
    return one.withColumn("verdict", verdict(F.col("agreement")))


def _matched_for(df: DataFrame, label: str, cluster: str) -> Column:
    """Scalar map from label to its matching cluster."""
    m = matching_clusters(df, label, cluster)
    return m.agg(F.map_from_entries(F.collect_list(F.struct(label, "matched")))).scalar()


def mislabelled(df: DataFrame, label: str, cluster: str) -> DataFrame:
    """Rows outside the cluster that matches their label."""
    matched = _matched_for(df, label, cluster)
    return df.where(F.col(cluster) != F.try_element_at(matched, F.col(label)))


def hit_flags(df: DataFrame, label: str, cluster: str, target: str = "hit") -> DataFrame:
    """1 where label 1 sits in its matching cluster, or label 0 sits outside it."""
    inside = F.col(cluster) == F.try_element_at(_matched_for(df, label, cluster), F.lit(1))
    return df.withColumn(target, (inside == (F.col(label) == 1)).cast("int"))


def parity_flags(df: DataFrame, label: str, cluster: str, target: str = "quality") -> DataFrame:
    """1 where the cluster number has the parity of the label, else 0; noise counts 0.5."""
    same = (F.col(cluster) % 2 == F.col(label)).cast("double")
    return df.withColumn(target, F.when(F.col(cluster) == -1, F.lit(0.5)).otherwise(same))
