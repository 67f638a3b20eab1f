"""The stages from landed tables to the export, each one a table of the run."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourpanel.operators import (
    calendar, export, features, learner, metrics, panel, quality, spatial, staging,
)
from hourpanel.operators.learner import LearnerParams
from hourpanel.session import materialise
from hourpanel.sources import ingest, readers, schemas, sinks
from hourpanel.sources.ingest import Window
from hourpanel.sources.schemas import Source
from hourpanel.sources.tree import Tree
from hourpanel.spec import AREA_PANEL, SEASON_HOURS


CENSUS_WINDOW = Window(date(2024, 1, 1), date(2024, 12, 31))
TOO_FEW_DATES = "A rolling origin starts from the second date of a panel; this one has fewer."


def ingest_all(
    spark: SparkSession, frames: dict[str, DataFrame], raw_root: str, window: Window | None,
    today: date, skip_addresses: bool = False,
) -> DataFrame:
    """Land every given source below ``raw_root`` in the fixed order; returns the audit rows.

    ``frames`` maps source names to frames read from landed exports. Holidays are taken for whole
    years, terms and events in full, census tables for the census year.
    """

    def root(source: Source) -> str:
        return f"{raw_root}/{source.name}"

    years = ingest.whole_years(window) if window else None
    census = (CENSUS_WINDOW.start, CENSUS_WINDOW.end)
    steps = {
        schemas.COUNTS: lambda df, at: ingest.ingest_counts(df, at, window, today),
        schemas.SENSORS: ingest.ingest_sensors,
        schemas.WEATHER: lambda df, at: ingest.ingest_weather(df, at, window, today),
        schemas.HOLIDAYS: lambda df, at: ingest.ingest_holidays(df, at, years, today),
        schemas.TERMS: ingest.ingest_terms,
        schemas.EVENTS: ingest.ingest_events,
    }
    for source in (schemas.BLOCK_ESTABLISHMENTS, schemas.BLOCK_JOBS, schemas.ADDRESSES):
        if not (skip_addresses and source is schemas.ADDRESSES):
            steps[source] = lambda df, at, source=source: ingest.ingest_census(
                df, source, at, *census
            )
    results = [
        step(frames[source.name], root(source))
        for source, step in steps.items()
        if source.name in frames
    ]
    return ingest.report(spark, results)


def check_landed(spark: SparkSession, raw_root: str) -> DataFrame:
    """The five source checks over the landed counts and sensors."""
    return quality.run_all_checks(
        landed(spark, raw_root, schemas.COUNTS), landed(spark, raw_root, schemas.SENSORS)
    )


@dataclass(frozen=True)
class Staged:
    """Staged views over the landed tables."""

    counts: DataFrame
    sensors: DataFrame
    weather: DataFrame
    holidays: DataFrame
    terms: DataFrame
    events: DataFrame
    blocks: DataFrame


def landed(
    spark: SparkSession, raw_root: str, source: Source, window: Window | None = None
) -> DataFrame:
    """A landed source below ``raw_root``.

    With ``window`` only the day folders inside it are read, for sources partitioned by day.
    """
    root = f"{raw_root}/{source.name}"
    if window is None or source.date_column is None:
        return readers.read_tree(spark, root, source.landed)
    day = T.StructField(sinks.DAY_PARTITION, T.DateType())
    tree = readers.read_tree(
        spark, root, T.StructType([*source.landed, day]), sinks.DAY_PARTITION
    )
    inside = F.col(sinks.DAY_PARTITION).between(F.lit(window.start), F.lit(window.end))
    return tree.filter(inside).drop(sinks.DAY_PARTITION)


def stage_all(raw: dict[str, DataFrame]) -> Staged:
    """Staged views from landed frames keyed by source name."""
    return Staged(
        counts=staging.stage_counts(raw[schemas.COUNTS.name]),
        sensors=staging.stage_sensors(raw[schemas.SENSORS.name]),
        weather=staging.stage_weather(raw[schemas.WEATHER.name]),
        holidays=staging.stage_holidays(raw[schemas.HOLIDAYS.name]),
        terms=staging.stage_terms(raw[schemas.TERMS.name]),
        events=staging.stage_events(raw[schemas.EVENTS.name]),
        blocks=staging.block_centroids(raw[schemas.ADDRESSES.name]),
    )


def stage_landed(spark: SparkSession, raw_root: str, window: Window | None = None) -> Staged:
    names = ("COUNTS", "SENSORS", "WEATHER", "HOLIDAYS", "TERMS", "EVENTS", "ADDRESSES")
    sources = [getattr(schemas, name) for name in names]
    return stage_all({s.name: landed(spark, raw_root, s, window) for s in sources})


def day_calendar(staged: Staged) -> DataFrame:
    """Calendar of the days present in the counts, materialised as a dimension.

    The days are written first: they are read once per interval table and bound, and should not
    cost a pass over the facts each time.
    """
    days = materialise(calendar.distinct_days(staged.counts), "days")
    merged = calendar.calendar_by_day(staged.holidays, staged.terms, staged.events, days)
    return materialise(merged, "calendar")


def block_map(staged: Staged) -> DataFrame:
    """Sensor to block map, materialised as a dimension."""
    return materialise(spatial.nearest_block(staged.sensors, staged.blocks), "block-map")


def build_location_hour(staged: Staged) -> DataFrame:
    return panel.location_hour(
        staged.counts, staged.sensors, staged.weather, day_calendar(staged)
    )


def area_map(staged: Staged) -> DataFrame:
    """Location to area, materialised as a dimension."""
    nearest = spatial.nearest_block(staged.sensors, staged.blocks)
    return materialise(panel.area_dimension(nearest, staged.sensors), "areas")


def build_mart(staged: Staged) -> DataFrame:
    """The area-hour mart, aggregated before the hour and day columns are attached.

    The two dimensions are independent jobs and are written at the same time.
    """
    with ThreadPoolExecutor(2) as pool:
        days = pool.submit(day_calendar, staged)
        areas = pool.submit(area_map, staged)
        day_table, area_table = days.result(), areas.result()
    return panel.precinct_hour_early(staged.counts, area_table, staged.weather, day_table)


@dataclass(frozen=True)
class Scores:
    """Evaluation results as tables."""

    folds: DataFrame
    pooled: DataFrame
    by_series: DataFrame


def evaluate(tested: DataFrame, panel_rows: DataFrame | None = None) -> Scores:
    """Fold, pooled and per-series scores.

    ``tested`` has ``baseline_pred`` and, after a rolling-origin run, the learner column. When it
    holds only test rows, ``panel_rows`` supplies all other days up to the last test date: they count
    as training rows and for the scales, never for the errors, so any choice of folds is scored as in
    the full run.
    """
    frame, dates = tested, None
    if panel_rows is not None:
        dates = tested.select("sensing_date").distinct()
        last = tested.agg(F.max("sensing_date")).scalar()
        others = panel_rows.filter(F.col("sensing_date") <= last).join(dates, "sensing_date", "left_anti")
        frame = others.withColumn("baseline_pred", F.lit(None).cast("double")).unionByName(
            tested, allowMissingColumns=True
        )
    scored = {"mase_baseline": "baseline_pred"}
    if learner.LEARNER_COLUMN in frame.columns:
        scored["mase_lgbm"] = learner.LEARNER_COLUMN
    note = F.when(frame.select(F.count_distinct("sensing_date")).scalar() < 2, TOO_FEW_DATES)
    folds = metrics.rolling_origin(frame, scored)
    if dates is not None:
        folds = folds.join(dates.withColumnRenamed("sensing_date", "test_date"), "test_date", "left_semi")
    return Scores(
        folds=folds,
        pooled=metrics.pooled_mase(frame, scored).withColumns(
            {"seasonality_hours": F.lit(SEASON_HOURS), "note": note}
        ),
        by_series=metrics.pooled_by_series(frame, scored),
    )


POOLED = schemas.columns(
    "mase_baseline double, mase_lgbm double, seasonality_hours int, note string"
)
BY_SERIES = schemas.columns(
    f"{AREA_PANEL.series} string, mase_baseline double, mase_lgbm double"
)


def write_scores(scores: Scores, root: str) -> None:
    """Scores as JSON documents, undefined values as null."""
    sinks.write_json(scores.folds, f"{root}/folds")
    sinks.write_json(scores.pooled, f"{root}/pooled")
    sinks.write_json(scores.by_series, f"{root}/by_series")


def read_scores(spark: SparkSession, root: str) -> tuple[DataFrame | None, DataFrame | None]:
    """Pooled and per-series scores read back; absent documents give None."""
    found = []
    for name, schema in (("pooled", POOLED), ("by_series", BY_SERIES)):
        exists = Tree(spark, f"{root}/{name}").exists()
        found.append(spark.read.schema(schema).json(f"{root}/{name}") if exists else None)
    return found[0], found[1]


def run(
    spark: SparkSession, raw_root: str, out_root: str, params: LearnerParams = LearnerParams()
) -> DataFrame:
    """Build, features, train, evaluate and export; returns the exported table."""
    staged = stage_landed(spark, raw_root)
    sinks.write_table(build_mart(staged), f"{out_root}/mart_precinct_hour")
    mart = readers.read_required(spark, f"{out_root}/mart_precinct_hour")
    sinks.write_table(features.feature_matrix(mart), f"{out_root}/precinct_hour_features")
    matrix = readers.read_required(spark, f"{out_root}/precinct_hour_features")
    predictions, _ = learner.train_and_predict(
        matrix, params=params, model_path=f"{out_root}/models/boosted"
    )
    sinks.write_table(predictions, f"{out_root}/precinct_hour_predictions")
    tested = learner.rolling_origin_predictions(matrix, params=params)
    scores = evaluate(tested, learner.with_baseline(learner.flags_as_numbers(matrix)))
    write_scores(scores, f"{out_root}/metrics")
    wide = export.export_wide(
        mart,
        readers.read_optional(spark, f"{out_root}/precinct_hour_predictions"),
        *read_scores(spark, f"{out_root}/metrics"),
    )
    sinks.write_export(
        wide, f"{out_root}/export/precinct_hour_parquet", f"{out_root}/export/precinct_hour_csv"
    )
    return spark.read.parquet(f"{out_root}/export/precinct_hour_parquet")
