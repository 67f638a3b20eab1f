"""The wide export: mart, predictions, scores, profile index and rank."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourpanel.functions.scalars import ratio
from hourpanel.spec import AREA_PANEL, PanelSpec

RANK_BUCKETS = 256
PREDICTION_COLUMNS = ("baseline_pred", "lgbm_pred", "lag_24h")
POOLED_COLUMNS = ("mase_baseline", "mase_lgbm")
SERIES_COLUMNS = ("mase_baseline_precinct", "mase_lgbm_precinct")


def dense_rank(df: DataFrame, value: str, out: str, buckets: int = RANK_BUCKETS) -> DataFrame:
    """Dense rank by descending value without sorting everything in one task.

    Distinct values are cut at approximate quantiles, ranked inside their bucket, and shifted by
    the number of distinct values in higher buckets. Null values get a null rank.
    """
    values = df.select(value).filter(F.col(value).isNotNull()).distinct()
    steps = F.array(*(F.lit(k / buckets) for k in range(1, buckets)))
    cuts = values.agg(F.percentile_approx(value, steps, F.lit(10_000))).scalar()
    bucketed = values.withColumn("_cuts", cuts).select(
        value, F.size(F.filter("_cuts", lambda cut: cut < F.col(value))).alias("_bucket")
    )
    higher = Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size")).select(
        "_bucket", F.coalesce(F.sum("_size").over(higher), F.lit(0)).alias("_above")
    )
    inside = Window.partitionBy("_bucket").orderBy(F.desc(value))
    ranks = bucketed.join(sizes, "_bucket").select(
        value, (F.row_number().over(inside) + F.col("_above")).alias(out)
    )
    return df.join(ranks, value, "left")


def series_hour_means(mart: DataFrame, spec: PanelSpec = AREA_PANEL) -> DataFrame:
    """Per (series, hour): index of the hour mean against the series mean, and the series rank.

    One aggregation over the mart; everything else works on series times 24 rows.
    """
    by_hour = mart.groupBy(spec.series, spec.hour).agg(
        F.sum(F.col(spec.value).cast("double")).alias("_sum"), F.count(spec.value).alias("_n")
    )
    by_series = by_hour.groupBy(spec.series).agg(
        ratio(F.sum("_sum"), F.sum("_n")).alias("_mean")
    )
    ranked = dense_rank(by_series, "_mean", "precinct_rank")
    index = ratio(ratio(F.col("_sum"), F.col("_n")), F.col("_mean"))
    return by_hour.join(ranked, spec.series).select(
        spec.series, spec.hour, index.alias("precinct_hourly_index"), "precinct_rank"
    )


def series_rank(mart: DataFrame, spec: PanelSpec = AREA_PANEL) -> DataFrame:
    """Dense rank of the series by mean value, 1 = largest; a null mean has no rank."""
    means = mart.groupBy(spec.series).agg(F.avg(spec.value).alias("mean_value"))
    return dense_rank(means, "mean_value", "precinct_rank")


def join_predictions(
    mart: DataFrame, predictions: DataFrame | None, spec: PanelSpec = AREA_PANEL
) -> DataFrame:
    """Attach the prediction columns by key; absent predictions give null columns."""
    null = F.lit(None).cast("double")
    if predictions is None:
        return mart.withColumns({name: null for name in PREDICTION_COLUMNS})
    present = [name for name in PREDICTION_COLUMNS if name in predictions.columns]
    return mart.join(predictions.select(*spec.grain, *present), list(spec.grain), "left")


def export_wide(
    mart: DataFrame, predictions: DataFrame | None = None, pooled: DataFrame | None = None,
    by_series: DataFrame | None = None, spec: PanelSpec = AREA_PANEL,
) -> DataFrame:
    """One row per mart row with predictions, errors, scores, index and rank.

    ``pooled`` is one row with the pooled scores; ``by_series`` has the per-series scores.
    """
    null = F.lit(None).cast("double")
    profile = series_hour_means(mart, spec)
    if by_series is not None:
        # Joined to the small profile, so the mart meets one table, on (series, hour).
        scores = by_series.select(
            spec.series,
            *(
                (F.col(a) if a in by_series.columns else null).alias(b)
                for a, b in zip(POOLED_COLUMNS, SERIES_COLUMNS, strict=True)
            ),
        )
        profile = profile.join(scores, spec.series, "left")
    else:
        profile = profile.withColumns({name: null for name in SERIES_COLUMNS})
    wide = join_predictions(mart, predictions, spec).join(
        profile, [spec.series, spec.hour], "left"
    )
    added = {}
    for name in POOLED_COLUMNS:
        known = pooled is not None and name in pooled.columns
        added[name] = pooled.select(name).scalar() if known else null
    for kind in ("baseline", "lgbm"):
        if f"{kind}_pred" in wide.columns:
            added[f"{kind}_error"] = F.col(spec.value) - F.col(f"{kind}_pred")
    return wide.withColumns(added)
