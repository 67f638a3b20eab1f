"""Forecast features: the value 24 hours earlier, the weekday, and which features are usable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourpanel.functions.scalars import null_if_nan
from hourpanel.functions.wallclock import day_of_week, localize, wall_clock
from hourpanel.spec import AREA_PANEL, NUMERIC_FEATURES, SEASON_HOURS, PanelSpec


def add_lag(
    panel: DataFrame, spec: PanelSpec = AREA_PANEL, hours: int = SEASON_HOURS,
    out: str = "lag_24h", wall: bool = False,
) -> DataFrame:
    """Value of the same series ``hours`` earlier, by instant.

    Hours can be missing, so this is a shifted self join and not a row offset. A row without an
    instant gets no lag; such rows stay out of the join, as their null key would send them all to
    one task. ``wall=True`` shifts the wall clock instead of the elapsed time. ``panel`` should be a
    landed or materialised table, since it is read twice.
    """
    instant = F.col(spec.ts)
    back = F.make_dt_interval(hours=F.lit(hours))
    if wall:
        moved = localize(wall_clock(F.col(spec.date), F.col(spec.hour)) + back, spec.tz)
    else:
        moved = instant + back
    prior = panel.filter(instant.isNotNull()).select(
        F.col(spec.series),
        moved.alias(spec.ts),
        F.col(spec.value).cast("double").alias(out),
    ).filter(instant.isNotNull())
    # one prior row per (series, instant), so that repeated rows never multiply the panel
    prior = prior.groupBy(spec.series, spec.ts).agg(F.max(out).alias(out))
    timed = panel.filter(instant.isNotNull()).join(prior, [spec.series, spec.ts], "left")
    untimed = panel.filter(instant.isNull()).withColumn(out, F.lit(None).cast("double"))
    return timed.select(*panel.columns, out).unionByName(untimed)


def feature_matrix(mart: DataFrame, spec: PanelSpec = AREA_PANEL) -> DataFrame:
    """Mart plus weekday (Monday = 0) and 24-hour lag; the lag is also the naive forecast."""
    return add_lag(mart.withColumn("day_of_week", day_of_week(F.col(spec.date))), spec)


def feature_summary(features: DataFrame, spec: PanelSpec = AREA_PANEL) -> DataFrame:
    return features.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(spec.series).alias("precincts"),
        F.min(spec.date).alias("min_date"),
        F.max(spec.date).alias("max_date"),
    )


def filled_columns(df: DataFrame, columns: tuple[str, ...] = NUMERIC_FEATURES) -> DataFrame:
    """One row per column with its number of non-null values, from one aggregation."""
    counts = df.agg(*(F.count(name).alias(name) for name in columns))
    return counts.unpivot(
        [], [F.col(name) for name in columns], "feature", "filled"
    )


def usable_features(
    df: DataFrame, spec: PanelSpec = AREA_PANEL, columns: tuple[str, ...] = NUMERIC_FEATURES
) -> list[str]:
    """The series column, then the columns that have any value; NaN counts as missing."""
    filled = df.agg(
        *(F.count(null_if_nan(F.col(name).cast("double"))).alias(name) for name in columns)
    ).first()
    return [spec.series, *(name for name in columns if filled[name] > 0)]


def complete_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=columns)


def train_summary(predictions: DataFrame, learner: str = "lgbm_pred") -> DataFrame:
    return predictions.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("baseline_pred").alias("rows_with_baseline"),
        F.count(learner).alias("rows_with_lgbm"),
        F.lit(SEASON_HOURS).alias("seasonality_hours"),
    )
