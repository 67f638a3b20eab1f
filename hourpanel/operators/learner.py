"""Boosted-tree forecasts, fitted on the cluster: one fit over the whole panel, or one per day of a rolling origin."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourpanel.functions.scalars import flag, null_if_nan, ratio
from hourpanel.operators import boosting
from hourpanel.operators.boosting import BoostedTrees, BoostParams
from hourpanel.operators.features import usable_features
from hourpanel.operators.metrics import rolling_origins
from hourpanel.session import materialise
from hourpanel.sources.tree import Tree
from hourpanel.spec import AREA_PANEL, FLAG_COLUMNS, NUMERIC_FEATURES, PanelSpec

LEARNER_COLUMN = "lgbm_pred"
LEVEL = "series_level"  # the series as a number: its mean value over earlier days


@dataclass(frozen=True)
class LearnerParams:
    """Fixed values of the forecast model."""

    trees: int = 64
    depth: int = 6
    rate: float = 0.1
    bins: int = 32
    min_leaf: int = 20
    min_rows: int = 10

    @property
    def boost(self) -> BoostParams:
        return BoostParams(self.trees, self.depth, self.rate, self.bins, self.min_leaf)


@dataclass(frozen=True)
class Model:
    """The trees, and the level of every series for rows that come later."""

    trees: BoostedTrees
    levels: DataFrame

    def save(self, path: str) -> None:
        spark = self.levels.sparkSession
        spark.createDataFrame([(self.trees.to_json(),)], "value string").write.mode("overwrite").text(f"{path}/trees")
        self.levels.write.mode("overwrite").parquet(f"{path}/levels")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Model:
        return cls(BoostedTrees.from_json(spark.read.text(f"{path}/trees").first().value), spark.read.parquet(f"{path}/levels"))


def flags_as_numbers(df: DataFrame) -> DataFrame:
    return df.withColumns({name: flag(F.col(name)) for name in FLAG_COLUMNS if name in df.columns})


def with_baseline(features: DataFrame) -> DataFrame:
    return features.withColumn("baseline_pred", F.col("lag_24h"))


def _value(spec: PanelSpec):
    return null_if_nan(F.col(spec.value).cast("double"))


def with_level(data: DataFrame, spec: PanelSpec) -> DataFrame:
    """Add the mean value of the row's series over earlier days: it knows nothing of the row's own day or later.

    Null on the first day of a series. The window sees the days of one series.
    """
    days = data.groupBy(spec.series, spec.date).agg(F.sum(_value(spec)).alias("_sum"), F.count(_value(spec)).alias("_n"))
    earlier = Window.partitionBy(spec.series).orderBy(spec.date).rowsBetween(Window.unboundedPreceding, -1)
    level = ratio(F.sum("_sum").over(earlier), F.sum("_n").over(earlier))
    known = days.select(F.col(spec.series).alias("_s"), F.col(spec.date).alias("_d"), level.alias(LEVEL))
    return data.join(known, F.col(spec.series).eqNullSafe(F.col("_s")) & F.col(spec.date).eqNullSafe(F.col("_d")), "left").drop("_s", "_d")


def _filled(names, spec: PanelSpec):
    known = (null_if_nan(F.col(name).cast("double")).isNotNull() for name in names)
    return reduce(lambda a, b: a & b, known, F.col(spec.series).isNotNull())


def _prepared(features: DataFrame, spec: PanelSpec) -> DataFrame:
    data = with_baseline(flags_as_numbers(features)).withColumn("row", F.monotonically_increasing_id())
    # rebalanced, so that partitions follow the session's advisory size: every tree level is a pass over them
    return materialise(with_level(materialise(data, "learner-rows"), spec).hint("rebalance"), "learner-features")


def _numbers(names: list[str]):
    return [F.col(name).cast("double").alias(name) for name in names]


def _attached(data: DataFrame, found: DataFrame) -> DataFrame:
    columns = [c for c in data.columns if c not in ("row", LEVEL)]
    return data.join(found, "row", "left").select(*columns, LEARNER_COLUMN)


def train_and_predict(
    features: DataFrame, spec: PanelSpec = AREA_PANEL, params: LearnerParams = LearnerParams(),
    model_path: str | None = None,
) -> tuple[DataFrame, Model | None]:
    """Baseline and in-sample learner prediction for every row.

    The model is fitted when at least ``min_rows`` rows have a value and every usable feature; otherwise the learner column
    is null and a model left at ``model_path`` is removed. Every row with all features is predicted. As the fit and
    the prediction use the same rows, the learner column shows in-sample fit, not forecast skill.
    """
    data = _prepared(features, spec)
    observed = data.filter(_value(spec).isNotNull())
    usable = usable_features(observed, spec)
    numeric = [name for name in usable if name != spec.series]
    names = [*numeric, LEVEL]
    complete = data.filter(_filled(numeric, spec))
    labelled = _value(spec).isNotNull()
    rows = complete.select("row", F.coalesce(_value(spec), F.lit(0.0)).alias("label"), F.lit(0).alias("first"), labelled.cast("int").alias("stop"), F.lit(0).alias("test"), *_numbers(names))
    cuts = boosting.cut_points(rows, names, params.bins)
    states, start, counts, trees = boosting.boost(boosting.blocks(rows, names, cuts, 1), 1, len(names), params.boost, params.min_rows)
    if counts[0] < params.min_rows:
        states.unpersist()
        if model_path:
            Tree(data.sparkSession, model_path).drop(model_path)
        return _attached(data, _nothing(data.sparkSession)), None
    found = materialise(boosting.predictions(data.sparkSession, states, counts >= params.min_rows, LEARNER_COLUMN), "learner-predictions")
    states.unpersist()
    means = observed.filter(_filled(numeric, spec)).groupBy(spec.series).agg(F.avg(_value(spec)).alias(LEVEL))
    model = Model(BoostedTrees.of(names, cuts, start, trees), materialise(means, "learner-levels"))
    if model_path:
        model.save(model_path)
    return _attached(data, found), model


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"row long, {LEARNER_COLUMN} double")


def predict(model: Model, df: DataFrame, spec: PanelSpec = AREA_PANEL) -> DataFrame:
    """Predictions for rows that have every feature of the model; the others get null. Row count is kept.

    NaN counts as missing, as in the fit. A series that the model has not seen has no level, which is a bin of its own.
    """
    levels = model.levels.withColumnRenamed(spec.series, "_s")
    joined = df.join(levels, F.col(spec.series) == F.col("_s"), "left").drop("_s")
    known = _filled([n for n in model.trees.features if n != LEVEL], spec)
    return joined.withColumn(LEARNER_COLUMN, F.when(known, model.trees.column(joined))).select(*df.columns, LEARNER_COLUMN)


def rolling_origin_predictions(
    features: DataFrame, spec: PanelSpec = AREA_PANEL, params: LearnerParams = LearnerParams(),
    step_days: int = 1, max_folds: int | None = None,
) -> DataFrame:
    """Test rows of every fold with an out-of-sample learner prediction.

    Each fold fits on all rows before its date, and all folds are fitted together (``boosting``). A feature counts in a
    fold if it has a value before the fold's date; rows without one of the fold's features neither train nor get a prediction.
    The list of dates and one first day per feature are the only things on the driver. ``step_days`` and ``max_folds``
    thin the folds on request; by default every date but the first is one. Bins are cut from the features of all
    rows; labels of a fold's own day or later are used nowhere in it.
    """
    data = _prepared(features, spec)
    spark = data.sparkSession
    origins = [r[0] for r in rolling_origins(data, spec).orderBy(spec.date).collect()]
    chosen = origins[::step_days][:max_folds]
    if not chosen:
        return _attached(data.limit(0), _nothing(spark))
    numeric = [name for name in NUMERIC_FEATURES if name in data.columns]
    names = [*numeric, LEVEL]
    day = F.col(spec.date)
    seen = data.filter(_value(spec).isNotNull()).agg(
        *(F.min(F.when(null_if_nan(F.col(n).cast("double")).isNotNull(), day)).alias(n) for n in numeric)
    ).first()
    # a row without a value of a feature belongs to folds that do not know the feature yet
    limits = [F.when(null_if_nan(F.col(n).cast("double")).isNull(), F.lit(seen[n])) for n in numeric if seen[n] is not None]
    limits.append(F.when(F.col(spec.series).isNull(), day))
    limit = F.least(*limits, F.lit(chosen[-1]))
    dates = F.array(*(F.lit(d) for d in chosen))
    first = F.size(F.filter(dates, lambda d: d <= day))
    stop = F.when(_value(spec).isNotNull(), F.size(F.filter(dates, lambda d: d <= limit))).otherwise(0)
    at = F.array_position(dates, day).cast("int") - 1
    rows = data.filter(day.isNotNull() & (day <= F.lit(chosen[-1]))).select(
        "row", F.coalesce(_value(spec), F.lit(0.0)).alias("label"), first.alias("first"), stop.alias("stop"),
        F.when(day <= limit, at).otherwise(-1).alias("test"), *_numbers(names),
    )
    cuts = boosting.cut_points(rows, names, params.bins)
    states, _, counts, _ = boosting.boost(boosting.blocks(rows, names, cuts, len(chosen)), len(chosen), len(names), params.boost, params.min_rows)
    found = materialise(boosting.predictions(spark, states, counts >= params.min_rows, LEARNER_COLUMN), "fold-predictions")
    states.unpersist()
    return _attached(data.filter(day.isin(chosen)), found)
