"""Imputation, scaling and encoding. Each step learns its values in the same plan that applies them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.feature import VectorAssembler

from ledgerlark.operators.modes import modes
from ledgerlark.operators.quantiles import quantile_row
from ledgerlark.operators.rules import categorical_columns, numeric_columns
from ledgerlark.operators.ranking import with_running_totals
from ledgerlark.operators.skew import attach_by_key, bounded_values


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill with the exact, interpolated median."""
    mids = F.col("_mids")
    filled = {c: F.coalesce(F.col(c).cast("double"), mids[c][0]) for c in columns}
    return df.withColumn("_mids", quantile_row(df, columns, [0.5])).withColumns(filled).drop("_mids")


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill with the most frequent value, the smallest on ties."""
    filled = {c: F.coalesce(F.col(c), modes(df, [c]).select("mode").scalar()) for c in columns}
    return df.withColumns(filled)


def _learnt(df: DataFrame, columns: Sequence[str], first, second) -> Column:
    one = df.agg(*[F.struct(first(c).alias("a"), second(c).alias("b")).alias(c) for c in columns])
    return one.select(F.struct(*columns)).scalar()


def scale_standard(df: DataFrame, columns: Sequence[str], suffix: str = "_std") -> DataFrame:
    """``(x - mean) / sd`` with n in the denominator of sd; a constant column becomes 0."""
    s = F.col("_s")

    def scaled(c):
        centred = F.col(c) - s[c]["a"]
        return F.when(s[c]["b"] == 0, centred).otherwise(F.try_divide(centred, s[c]["b"]))

    learnt = df.withColumn("_s", _learnt(df, columns, F.avg, F.stddev_pop))
    return learnt.withColumns({c + suffix: scaled(c) for c in columns}).drop("_s")


def scale_min_max(
    df: DataFrame, columns: Sequence[str], suffix: str = "_minmax", epsilon: float = 0.0
) -> DataFrame:
    """``(x - min) / (max - min + epsilon)``; a constant column becomes 0."""
    s = F.col("_s")

    def scaled(c):
        low = F.col(c) - s[c]["a"]
        span = s[c]["b"] - s[c]["a"] + F.lit(epsilon)
        return F.when(span == 0, low).otherwise(F.try_divide(low, span))

    learnt = df.withColumn("_s", _learnt(df, columns, F.min, F.max))
    return learnt.withColumns({c + suffix: scaled(c) for c in columns}).drop("_s")


def one_hot(
    df: DataFrame, columns: Sequence[str], levels: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Replace each column by one 0/1 column per level, ``<column>_<level>``.

    All levels are kept; a missing or unknown value has 0 everywhere. The levels must be few.
    """
    known = levels or {c: bounded_values(df, c) for c in columns}
    marks = [
        F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c in columns
        for v in known[c]
    ]
    return df.select(*[c for c in df.columns if c not in set(columns)], *marks)


def ordinal_encode(df: DataFrame, column: str, target: str) -> DataFrame:
    """Code of the value in sorted order, starting at 0; a missing value has none."""
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    ranked = with_running_totals(values.withColumn("one", F.lit(1)), column, ["one"])
    codes = ranked.select(column, (F.col("cum_one") - 1).cast("int").alias(target), "_rows")
    return attach_by_key(df, codes, [column], "_rows").drop("_rows")


def first_seen_codes(df: DataFrame, column: str, row_id: str) -> DataFrame:
    """Rows (column, code, rows): codes from 1 in order of the first row id of each value."""
    first = df.groupBy(column).agg(F.min(row_id).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    ones = first.withColumn("one", F.lit(1))
    return with_running_totals(ones, "_first", ["one"]).select(
        column, F.col("cum_one").alias("_code"), "_rows"
    )


def binary_encode(
    df: DataFrame, column: str, row_id: str, bits: int, missing: str = "Unknown"
) -> DataFrame:
    """Replace a column by the bits of its first-seen code, most significant bit first."""
    filled = df.withColumn(column, F.coalesce(F.col(column), F.lit(missing)))
    codes = first_seen_codes(filled, column, row_id)
    coded = attach_by_key(filled, codes, [column], "_rows")
    digits = [
        F.getbit(F.col("_code"), F.lit(bits - 1 - i)).cast("int").alias(f"{column}_{i}")
        for i in range(bits)
    ]
    return coded.select(*[c for c in df.columns if c != column], *digits)


def bits_for(df: DataFrame, column: str) -> int:
    """Bits needed for the codes of a column, the missing mark included."""
    n = df.select(F.count_distinct(F.coalesce(F.col(column).cast("string"), F.lit("")))).first()[0]
    return max(1, int(n).bit_length())


@dataclass(frozen=True)
class MixedPreprocessor:
    """Values learnt by ``fit_mixed``: medians, means, deviations, fill-in levels and levels."""

    numeric: tuple[tuple[str, float, float, float], ...]
    categorical: tuple[tuple[str, object, tuple], ...]

    def feature_names(self) -> list[str]:
        names = [n for n, *_ in self.numeric]
        return names + [f"{c}_{v}" for c, _, levels in self.categorical for v in levels]

    def transform(self, df: DataFrame, output: str = "features") -> DataFrame:
        """Numbers: median, then standard scale. Categories: mode, then one-hot, unknowns all 0."""
        parts = []
        for name, mid, mean, sd in self.numeric:
            filled = F.coalesce(F.col(name).cast("double"), F.lit(mid))
            parts.append((filled - F.lit(mean)) / F.lit(sd if sd else 1.0))
        for name, fill, levels in self.categorical:
            value = F.coalesce(F.col(name), F.lit(fill))
            parts += [(value == F.lit(v)).cast("double") for v in levels]
        return df.withColumn(output, array_to_vector(F.array(*parts)))


def fit_mixed(
    df: DataFrame, numeric: Sequence[str] | None = None, categorical: Sequence[str] | None = None
) -> MixedPreprocessor:
    """Learn the preprocessor; only one number or level list per column reaches the driver."""
    numeric = list(numeric if numeric is not None else numeric_columns(df))
    categorical = list(categorical if categorical is not None else categorical_columns(df))
    learnt = []
    if numeric:
        mids = df.select(quantile_row(df, numeric, [0.5]).alias("m")).limit(1).first()["m"]
        filled = [F.coalesce(F.col(c).cast("double"), F.lit(mids[c][0])) for c in numeric]
        row = df.agg(
            *[F.avg(x).alias(f"a{i}") for i, x in enumerate(filled)],
            *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(filled)],
        ).first()
        learnt = [(c, mids[c][0], row[f"a{i}"], row[f"s{i}"]) for i, c in enumerate(numeric)]
    modal = {c: modes(df, [c]).first()["mode"] for c in categorical}
    levels = [(c, modal[c], tuple(bounded_values(df, c))) for c in categorical]
    return MixedPreprocessor(tuple(learnt), tuple(levels))


class MixedStage(Estimator):
    """``fit_mixed`` as a pipeline stage, so that a search learns it anew from the rows of each fit."""

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str] = (), output: str = "features"):
        super().__init__()
        self.numeric, self.categorical, self.output = list(numeric), list(categorical), output

    def _fit(self, dataset: DataFrame) -> Model:
        return MixedStageModel(fit_mixed(dataset, self.numeric, self.categorical), self.output)


class MixedStageModel(Model):
    def __init__(self, learnt: MixedPreprocessor, output: str):
        super().__init__()
        self.learnt, self.output = learnt, output

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.learnt.transform(dataset, self.output)


def feature_columns(df: DataFrame, prefix: str, fixed: Sequence[str]) -> list[str]:
    """Columns with a name prefix plus those of a fixed list, in table order."""
    return [c for c in df.columns if c.startswith(prefix) or c in set(fixed)]


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
