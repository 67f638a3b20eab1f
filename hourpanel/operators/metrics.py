"""Scaled forecast errors: in-sample scale, panel MASE, rolling origin.

A series is ordered by (date, hour) and the seasonal difference is by position, not by clock, so
gaps shift it. Positions come from row counts per (series, day) and prefix sums over days, and the
difference is taken inside blocks of positions that repeat the last ``season`` rows of the block
before. No window is larger than a block, a day, or the list of days of one series, however long or
dominant a series is. The panel must be unique on (series, date, hour).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourpanel.functions.scalars import finite, null_if_nan, ratio
from hourpanel.spec import AREA_PANEL, SEASON_HOURS, PanelSpec

BLOCK_ROWS = 4096


def _before_today(spec: PanelSpec) -> Window:
    return Window.partitionBy(spec.series).orderBy(spec.date).rowsBetween(
        Window.unboundedPreceding, -1
    )


def with_position(panel: DataFrame, spec: PanelSpec = AREA_PANEL) -> DataFrame:
    """Add ``position``, the 1-based place of a row in its series."""
    days = panel.groupBy(spec.series, spec.date).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = days.select(
        spec.series, spec.date,
        F.coalesce(F.sum("_rows").over(_before_today(spec)), F.lit(0)).alias("_offset"),
    )
    in_day = Window.partitionBy(spec.series, spec.date).orderBy(spec.hour)
    return (
        panel.withColumn("_rank", F.row_number().over(in_day))
        .join(offsets, [spec.series, spec.date])
        .withColumn("position", F.col("_offset") + F.col("_rank"))
        .drop("_rank", "_offset")
    )


def seasonal_difference(
    panel: DataFrame, spec: PanelSpec = AREA_PANEL, season: int = SEASON_HOURS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows with ``position`` and ``seasonal_diff`` = |y[i] - y[i - season]|.

    The difference is null for the first ``season`` rows and where either value is missing.
    """
    size = max(block_rows, season)
    value = null_if_nan(F.col(spec.value).cast("double"))
    placed = with_position(
        panel.select(spec.series, spec.date, spec.hour, value.alias(spec.value)), spec
    )
    block = F.floor((F.col("position") - 1) / size)
    in_tail = (F.col("position") - 1) % size >= size - season
    halo = F.when(in_tail, F.array(block, block + 1)).otherwise(F.array(block))
    blocked = placed.withColumn("_block", F.explode(halo))
    order = Window.partitionBy(spec.series, "_block").orderBy("position")
    before = F.lag(spec.value, season).over(order)
    return (
        blocked.withColumn("seasonal_diff", F.abs(F.col(spec.value) - before))
        .filter(F.col("_block") == block)
        .drop("_block")
    )


def _day_statistics(panel: DataFrame, spec: PanelSpec, season: int) -> DataFrame:
    """Per (series, day): rows, summed and broken differences, first and last value."""
    diffs = seasonal_difference(panel, spec, season)
    past_first_season = F.col("position") > season
    point = F.struct(F.col("position"), F.col(spec.value).alias("y"))
    return diffs.groupBy(spec.series, spec.date).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(past_first_season, F.col("seasonal_diff"))).alias("total"),
        F.count_if(past_first_season & F.col("seasonal_diff").isNull()).alias("broken"),
        F.min(point)["y"].alias("first_y"),
        F.max(point)["y"].alias("last_y"),
    )


def _scale(n: Column, total: Column, broken: Column, first_y: Column, last_y: Column,
           season: int) -> Column:
    """Mean seasonal difference of a sample of ``n`` rows.

    A sample no longer than the season uses the longest lag it has, which leaves one difference.
    Null when there is none, when a value in it is missing, or when it is zero.
    """
    mean = F.when(
        n > season, F.when(broken == 0, total / (n - season))
    ).when(n >= 2, F.abs(last_y - first_y))
    return F.when(finite(mean) & (mean > 0), mean)


def series_scale(
    train: DataFrame, spec: PanelSpec = AREA_PANEL, season: int = SEASON_HOURS
) -> DataFrame:
    """In-sample scale per series; series without one are left out."""
    days = _day_statistics(train, spec, season)
    first = F.min(F.struct(F.col(spec.date), F.col("first_y")))["first_y"]
    last = F.max(F.struct(F.col(spec.date), F.col("last_y")))["last_y"]
    scaled = days.groupBy(spec.series).agg(
        F.sum("n").alias("train_rows"),
        _scale(
            F.sum("n"), F.sum("total"), F.sum("broken"), first, last, season
        ).alias("scale"),
    )
    return scaled.filter(F.col("scale").isNotNull())


def fold_scale(
    panel: DataFrame, spec: PanelSpec = AREA_PANEL, season: int = SEASON_HOURS
) -> DataFrame:
    """Scale per (series, day) from all earlier days of the series, for every fold in one job.

    Training samples of a rolling origin are prefixes of one ordering, so running totals over days
    replace one pass per fold. ``train_rows`` counts the prefix; ``scale`` is null where undefined.
    """
    days = _day_statistics(panel, spec, season)
    earlier = _before_today(spec)
    n = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    scale = _scale(
        n,
        F.sum("total").over(earlier),
        F.sum("broken").over(earlier),
        F.first("first_y").over(earlier),
        F.last("last_y").over(earlier),
        season,
    )
    return days.select(spec.series, spec.date, n.alias("train_rows"), scale.alias("scale"))


def rolling_origins(panel: DataFrame, spec: PanelSpec = AREA_PANEL) -> DataFrame:
    """Test dates: every distinct date but the first."""
    days = panel.select(spec.date).distinct()
    return days.filter(F.col(spec.date) > panel.agg(F.min(spec.date)).scalar())


def _errors(actual: str, predicted: str) -> tuple[Column, Column]:
    """(summed absolute error, number of pairs) over pairs where both sides are finite."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    usable = finite(y) & finite(p)
    return F.sum(F.when(usable, F.abs(y - p))), F.count_if(usable)


def _pooled(numerator: Column, denominator: Column) -> Column:
    return ratio(F.sum(numerator), F.sum(denominator))


def _components(
    test: DataFrame, scales: DataFrame, predicted: str, spec: PanelSpec
) -> DataFrame:
    """Numerator and denominator per series; the test side is aggregated before the join."""
    error, pairs = _errors(spec.value, predicted)
    summed = test.groupBy(spec.series).agg(error.alias("numerator"), pairs.alias("pairs"))
    return (
        summed.filter("pairs > 0")
        .join(scales.select(spec.series, "scale"), spec.series)
        .withColumn("denominator", F.col("scale") * F.col("pairs"))
    )


def panel_mase(
    test: DataFrame, train: DataFrame, predicted: str, spec: PanelSpec = AREA_PANEL,
    season: int = SEASON_HOURS,
) -> DataFrame:
    """Pooled error over the summed training scales, as one row; null without usable series."""
    parts = _components(test, series_scale(train, spec, season), predicted, spec)
    return parts.agg(_pooled(F.col("numerator"), F.col("denominator")).alias("mase"))


def mase_by_series(
    test: DataFrame, train: DataFrame, predicted: str, spec: PanelSpec = AREA_PANEL,
    season: int = SEASON_HOURS,
) -> DataFrame:
    parts = _components(test, series_scale(train, spec, season), predicted, spec)
    return parts.select(spec.series, (F.col("numerator") / F.col("denominator")).alias("mase"))


def mase(df: DataFrame, actual: str, predicted: str, scale: Column) -> DataFrame:
    """Mean absolute error over finite pairs, divided by a given scale."""
    error, pairs = _errors(actual, predicted)
    return df.agg(F.when(finite(scale), ratio(ratio(error, pairs), scale)).alias("mase"))


def effective_season(rows: Column, season: int = SEASON_HOURS) -> Column:
    """The longest usable lag: 0 for fewer than two rows, else at most rows - 1."""
    return F.when(rows <= 1, F.lit(0)).otherwise(F.least(F.lit(season), rows - 1))


def rolling_origin(
    panel: DataFrame, predictions: dict[str, str], spec: PanelSpec = AREA_PANEL,
    season: int = SEASON_HOURS,
) -> DataFrame:
    """One row per fold: test date, row counts, and one MASE per prediction column.

    ``predictions`` maps output names to prediction columns.
    """
    aggregates = []
    for out, column in predictions.items():
        error, pairs = _errors(spec.value, column)
        aggregates += [error.alias(f"{out}_error"), pairs.alias(f"{out}_pairs")]
    tested = panel.groupBy(spec.series, spec.date).agg(
        F.count(F.lit(1)).alias("rows"), *aggregates
    )
    joined = tested.join(
        fold_scale(panel, spec, season).select(spec.series, spec.date, "scale"),
        [spec.series, spec.date],
    )
    scores = []
    for out in predictions:
        usable = F.col("scale").isNotNull() & (F.col(f"{out}_pairs") > 0)
        scores.append(
            _pooled(
                F.when(usable, F.col(f"{out}_error")),
                F.when(usable, F.col("scale") * F.col(f"{out}_pairs")),
            ).alias(out)
        )
    folds = joined.groupBy(spec.date).agg(F.sum("rows").alias("test_rows"), *scores)
    # One row per date remains here, so a window without a key sees only the list of dates.
    earlier = Window.orderBy(spec.date).rowsBetween(Window.unboundedPreceding, -1)
    return (
        folds.withColumn("train_rows", F.sum("test_rows").over(earlier))
        .filter(F.col("train_rows").isNotNull())
        .select(
            F.col(spec.date).alias("test_date"), "train_rows", "test_rows", *predictions
        )
    )


def _pooled_frames(panel: DataFrame, spec: PanelSpec) -> tuple[DataFrame, DataFrame]:
    first = panel.agg(F.min(spec.date)).scalar()
    last = panel.agg(F.max(spec.date)).scalar()
    return panel.filter(F.col(spec.date) > first), panel.filter(F.col(spec.date) < last)


def pooled_by_series(
    panel: DataFrame, predictions: dict[str, str], spec: PanelSpec = AREA_PANEL,
    season: int = SEASON_HOURS,
) -> DataFrame:
    """MASE per series over the test rows of all folds, scaled by all days before the last."""
    test, train = _pooled_frames(panel, spec)
    scales = series_scale(train, spec, season)
    parts = [
        _components(test, scales, column, spec).select(
            spec.series, (F.col("numerator") / F.col("denominator")).alias(out)
        )
        for out, column in predictions.items()
    ]
    return reduce(lambda a, b: a.join(b, spec.series, "full"), parts)


def pooled_mase(
    panel: DataFrame, predictions: dict[str, str], spec: PanelSpec = AREA_PANEL,
    season: int = SEASON_HOURS,
) -> DataFrame:
    """Pooled MASE of every prediction column as one row; nulls with fewer than two dates."""
    test, train = _pooled_frames(panel, spec)
    aggregates = []
    for out, column in predictions.items():
        error, pairs = _errors(spec.value, column)
        aggregates += [error.alias(f"{out}_error"), pairs.alias(f"{out}_pairs")]
    summed = test.groupBy(spec.series).agg(*aggregates).join(
        series_scale(train, spec, season), spec.series
    )
    return summed.agg(
        *(
            _pooled(
                F.when(F.col(f"{out}_pairs") > 0, F.col(f"{out}_error")),
                F.when(F.col(f"{out}_pairs") > 0, F.col("scale") * F.col(f"{out}_pairs")),
            ).alias(out)
            for out in predictions
        )
    )
