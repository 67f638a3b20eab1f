"""Registered queries: every operator on frames derived from the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourpanel.functions.scalars import finite
from hourpanel.functions.wallclock import (
    day_of_week, dst_kind, expected_grid, wall_clock,
)
from hourpanel.operators import (
    calendar, constraints, export, features, learner, metrics, panel, profiling, quality, spatial,
    staging,
)
from hourpanel.plans import given, stages
from hourpanel.session import materialise, scratch_path
from hourpanel.sources import ingest, readers, schemas, sinks
from hourpanel.sources.schemas import Source
from hourpanel.spec import AREA_PANEL, AUDIT_COLUMN, NUMERIC_FEATURES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore only avoids an import's name."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that summation order does not show in the comparison."""
    return df.select(
        *(
            F.round(F.col(n), digits).alias(n) if t == "double" else F.col(n)
            for n, t in df.dtypes
        )
    )


def presented(df: DataFrame) -> DataFrame:
    """Rounded doubles, and instants as UTC readings; the session zone is pinned to UTC here."""
    stamps = {n: F.col(n).cast("timestamp_ntz") for n, t in df.dtypes if t == "timestamp"}
    return rounded(df.withColumns(stamps) if stamps else df)


def mart_of(spark: SparkSession, sf: str) -> DataFrame:
    return materialise(stages.build_mart(given.staged(spark, sf)), "mart")


def matrix_of(spark: SparkSession, sf: str) -> DataFrame:
    return materialise(features.feature_matrix(mart_of(spark, sf)), "features")


def baseline_of(spark: SparkSession, sf: str) -> DataFrame:
    return learner.with_baseline(learner.flags_as_numbers(matrix_of(spark, sf)))


def staged_counts(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage_counts(given.counts(spark, sf))


def tally_of(spark: SparkSession, sf: str) -> quality.Tally:
    return quality.tally(given.counts(spark, sf))


def pairs_of(spark: SparkSession, sf: str) -> DataFrame:
    pairs = quality.coordinate_pairs(given.counts(spark, sf), given.sensors(spark, sf))
    return materialise(pairs, "pairs")


# ------------------------------------------------------------ scans and ingest


@query
def scan_union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose files differ in columns and number type, two kinds in one folder and one beside it, read as one."""
    orders = given.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    root = scratch_path(spark, "drifting")
    whole = F.floor("o_totalprice").cast("bigint")
    variants = {
        "F": (f"{root}/both", lambda df: df),
        "O": (f"{root}/both", lambda df: df.withColumn("o_totalprice", whole)),
        "P": (root, lambda df: df.drop("o_orderpriority")),
    }
    for status, (folder, change) in variants.items():
        change(orders.filter(F.col("o_orderstatus") == status)).write.mode("append").parquet(folder)
    return readers.read_foreign_tree(spark, root, orders.schema)


@query
def date_window_scan(spark: SparkSession, sf: str) -> DataFrame:
    lines = given.table(spark, sf, "lineitem")
    window = readers.date_window(F.col("l_shipdate"), date(1997, 3, 1), date(1997, 8, 31))
    return lines.filter(window).select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship_day")
    )


@query
def existing_max_date(spark: SparkSession, sf: str) -> DataFrame:
    """Latest readable date of a date column and of a text column with unreadable values."""
    counts = readers.max_date(given.counts(spark, sf), "sensing_date")
    sensors = readers.max_date(given.sensors(spark, sf), "installation_date")
    return counts.withColumn("source", F.lit("counts")).unionByName(
        sensors.withColumn("source", F.lit("sensors"))
    )


@query
def incremental_window(spark: SparkSession, sf: str) -> DataFrame:
    """Line items shipped after the last landed order day, up to a fixed today."""
    landed = readers.max_date(given.table(spark, sf, "orders"), "o_orderdate").first()[0]
    window = ingest.resolve_window(
        None, None, landed=landed, first_day=date(1995, 1, 1), last_day=None,
        today=date(2001, 12, 31),
    )
    lines = given.table(spark, sf, "lineitem")
    return (
        lines.filter(readers.date_window(F.col("l_shipdate"), window.start, window.end))
        .groupBy(F.to_date("l_shipdate").alias("ship_day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def interval_overlap(spark: SparkSession, sf: str) -> DataFrame:
    events = given.major_events(spark, sf)
    return ingest.overlapping(events, date(2024, 1, 10), date(2024, 1, 20)).select(
        "event_id", "start_date", "end_date"
    )


@query
def census_year_select(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of the census years inside a window; the year is text, as in the land-use export."""
    source = Source(
        "orders", T.StructType([]), first_day=date(1995, 1, 1), last_day=date(2001, 1, 1)
    )
    orders = given.table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").cast("string").alias("census_year")
    )
    years = ingest.census_years(date(1998, 5, 1), date(1999, 6, 30), source)
    return ingest.census_rows(orders, years)


@query
def calendar_csv(spark: SparkSession, sf: str) -> DataFrame:
    """All orders as a CSV calendar, low-priority ones as comment lines, read back."""
    orders = given.table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    low = F.col("o_orderpriority") == "5-LOW"
    rows = orders.select(
        F.when(low, F.concat(F.lit("# "), key)).otherwise(key).alias("event_id"),
        F.concat(F.lit("order, "), F.col("o_orderstatus")).alias("event_name"),
        F.col("o_orderpriority").alias("venue"),
        F.to_date("o_orderdate").alias("start_date"),
        F.to_date("o_orderdate").alias("end_date"),
        F.lit(None).cast("string").alias("notes"),
    )
    path = scratch_path(spark, "calendar-csv")
    # The writer quotes a value that starts with its own comment sign, so that is set to another.
    rows.write.option("header", True).option("comment", "~").csv(path)
    return readers.read_calendar_csv(spark, path, schemas.EVENTS.schema).drop("notes")


@query
def flatten_columnar_json(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly weather written as one columnar JSON payload per day (24 hours at most), read back."""
    row = schemas.columns(
        "time string, temperature_2m double, precipitation double, rain double, "
        "wind_speed_10m double, cloud_cover bigint"
    )
    hours = given.weather_hours(spark, sf).withColumn(
        "time", F.date_format("wall", "yyyy-MM-dd'T'HH:mm")
    )
    per_day = hours.groupBy(F.to_date("wall").alias("day")).agg(
        F.array_sort(F.collect_list(F.struct(*row.names))).alias("rows")
    )
    arrays = F.struct(*(F.col(f"rows.{name}").alias(name) for name in row.names))
    path = scratch_path(spark, "columnar-json")
    per_day.select(arrays.alias("hourly")).write.json(path)
    payloads = spark.read.schema(readers.columnar_schema(row)).json(path)
    return rounded(readers.flatten_columnar(payloads, row))


def _json_round_trip(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Written as JSON arrays, and read back with the columns that were written."""
    path = scratch_path(spark, name)
    sinks.write_json_arrays(df, path)
    return readers.read_json_export(spark, path, df.schema)


@query
def json_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = given.hourly_counts(spark, sf)
    back = _json_round_trip(spark, counts, "json-counts")
    return rounded(back.withColumns({"lon": F.col("location.lon"), "lat": F.col("location.lat")}).drop("location"))


@query
def json_sensors(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_json_round_trip(spark, given.sensors(spark, sf).drop(AUDIT_COLUMN), "json-sensors"))


@query
def json_addresses(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_json_round_trip(spark, given.addresses(spark, sf).drop(AUDIT_COLUMN), "json-addresses"))


@query
def json_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Long texts with quotes, braces and line ends as JSON, read back."""
    documents = given.table(spark, sf, "documents")
    back = _json_round_trip(spark, documents.withColumn("text", F.concat(F.lit('{"\\'), "text", F.lit('}"'))), "json-documents")
    return back.select("doc_id", "lang", "n_chars", F.md5("text").alias("text_md5"))


# ----------------------------------------------------------------------- sinks


@query
def day_range_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Land all counts, then replace five days with corrected ones; one has no rows left."""
    counts = given.hourly_counts(spark, sf)
    root = scratch_path(spark, "counts")
    day = F.col("sensing_date")
    sinks.replace_days(counts, root, day, date(2024, 1, 1), date(2024, 1, 31))
    revised = counts.filter(day != F.lit(date(2024, 1, 12))).withColumn(
        "pedestriancount", F.col("pedestriancount") * 10
    )
    for _ in range(2):
        sinks.replace_days(revised, root, day, date(2024, 1, 10), date(2024, 1, 14))
    return (
        readers.read_tree(spark, root, counts.schema)
        .groupBy("sensing_date")
        .agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("pedestriancount").alias("pedestriancount")
        )
    )


@query
def key_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Land all orders by year, then replace two years; one of them has no rows left."""
    orders = given.table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year")
    )
    root = scratch_path(spark, "orders-by-year")
    sinks.replace_keys(orders, root, "year", range(1995, 2002))
    revised = orders.filter("year != 1997").withColumn("o_totalprice", F.lit(1.0))
    sinks.replace_keys(revised, root, "year", [1996, 1997])
    return rounded(
        readers.read_tree(spark, root, orders.schema)
        .groupBy("year")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_totalprice").alias("total")),
        2,
    )


# ------------------------------------------------------------------------ time


def _transition_counts(spark: SparkSession, sf: str) -> DataFrame:
    april = given.hourly_counts(spark, sf, given.APRIL_SHIFT)
    return april.unionByName(given.hourly_counts(spark, sf, given.OCTOBER_SHIFT))


@query
def localize_wall_clock(spark: SparkSession, sf: str) -> DataFrame:
    counts = ingest.with_observed_at(_transition_counts(spark, sf))
    return presented(counts.select("location_id", "sensing_date", "hourday", "observed_at"))


@query
def dst_kind_(spark: SparkSession, sf: str) -> DataFrame:
    counts = _transition_counts(spark, sf)
    kind = dst_kind(wall_clock(F.col("sensing_date"), F.col("hourday")))
    return counts.groupBy("sensing_date", "hourday", kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query
def expected_hours(spark: SparkSession, sf: str) -> DataFrame:
    days = calendar.distinct_days(_transition_counts(spark, sf))
    return expected_grid(days, "sensing_date", "hourday")


@query
def day_of_week_(spark: SparkSession, sf: str) -> DataFrame:
    counts = given.hourly_counts(spark, sf)
    return counts.groupBy(
        "sensing_date", day_of_week(F.col("sensing_date")).alias("day_of_week")
    ).agg(F.sum("pedestriancount").alias("pedestriancount"))


# --------------------------------------------------------------------- staging


@query
def stg_counts(spark: SparkSession, sf: str) -> DataFrame:
    return presented(staged_counts(spark, sf))


@query
def stg_sensors(spark: SparkSession, sf: str) -> DataFrame:
    return presented(staging.stage_sensors(given.sensors(spark, sf)))


@query
def stg_weather(spark: SparkSession, sf: str) -> DataFrame:
    return presented(staging.stage_weather(given.weather(spark, sf)))


@query
def stg_holidays(spark: SparkSession, sf: str) -> DataFrame:
    return presented(staging.stage_holidays(given.holidays(spark, sf)))


@query
def stg_terms(spark: SparkSession, sf: str) -> DataFrame:
    return presented(staging.stage_terms(given.terms(spark, sf)))


@query
def stg_events(spark: SparkSession, sf: str) -> DataFrame:
    return presented(staging.stage_events(given.major_events(spark, sf)))


@query
def complete_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Mart rows that have every numeric feature and a value."""
    matrix = matrix_of(spark, sf)
    kept = features.complete_rows(matrix, [*NUMERIC_FEATURES, "pedestriancount"])
    return rounded(kept.select("precinct", "sensing_date", "hourday", "lag_24h", "temperature_2m"))


# ----------------------------------------------------------------------- joins


@query
def join_left_sensor(spark: SparkSession, sf: str) -> DataFrame:
    sensors = staging.stage_sensors(given.sensors(spark, sf))
    keys = staged_counts(spark, sf).select(
        "location_id", "sensing_date", "hourday", "pedestriancount"
    )
    return rounded(panel.join_sensors(keys, sensors))


@query
def join_left_composite(spark: SparkSession, sf: str) -> DataFrame:
    weather = materialise(staging.stage_weather(given.weather(spark, sf)), "weather")
    keys = staged_counts(spark, sf).select("location_id", "sensing_date", "hourday")
    return rounded(panel.join_weather(keys, weather))


def _days(spark: SparkSession, sf: str) -> DataFrame:
    return materialise(calendar.distinct_days(given.hourly_counts(spark, sf)), "days")


@query
def range_join_terms(spark: SparkSession, sf: str) -> DataFrame:
    terms = staging.stage_terms(given.terms(spark, sf))
    return calendar.explode_intervals(terms, _days(spark, sf), "sensing_date").select(
        "sensing_date", "year", "term", "jurisdiction"
    )


@query
def range_join_events(spark: SparkSession, sf: str) -> DataFrame:
    events = staging.stage_events(given.major_events(spark, sf))
    return calendar.explode_intervals(events, _days(spark, sf), "sensing_date").select(
        "sensing_date", "event_id", "event_name"
    )


def _sensors_and_blocks(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return (
        staging.stage_sensors(given.sensors(spark, sf)),
        staging.block_centroids(given.addresses(spark, sf)),
    )


@query
def nearest_block(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(spatial.nearest_block(*_sensors_and_blocks(spark, sf)))


@query
def nearest_block_window(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(spatial.nearest_block_ranked(*_sensors_and_blocks(spark, sf)))


@query
def location_hour(spark: SparkSession, sf: str) -> DataFrame:
    return presented(stages.build_location_hour(given.staged(spark, sf)))


@query
def lag_24h(spark: SparkSession, sf: str) -> DataFrame:
    """24-hour lag at location grain."""
    counts = materialise(
        given.counts(spark, sf).select(
            "location_id", "sensing_date", "hourday", "observed_at", "pedestriancount"
        ),
        "counts",
    )
    return presented(features.add_lag(counts, quality.LOCATION_PANEL))


@query
def join_predictions(spark: SparkSession, sf: str) -> DataFrame:
    mart = mart_of(spark, sf)
    predictions = learner.with_baseline(features.feature_matrix(mart))
    slim = mart.select("precinct", "sensing_date", "hourday", "pedestriancount")
    return rounded(export.join_predictions(slim, predictions))


@query
def calendar_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Named days of the urgent orders that no high-value order falls on."""
    orders = given.table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    left = orders.filter(F.col("o_orderpriority") == "1-URGENT")
    right = orders.filter(F.col("o_totalprice") > 400_000.0)
    return profiling.calendar_difference(left, right, "day", "o_orderstatus")


# ------------------------------------------------------------------ aggregates


@query
def string_agg_ordered(spark: SparkSession, sf: str) -> DataFrame:
    orders = given.table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("day"), "o_orderpriority"
    )
    return calendar.ordered_names(orders, "day", "o_orderpriority", "priorities")


@query
def holidays_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.holidays_by_day(staging.stage_holidays(given.holidays(spark, sf)))


@query
def terms_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.terms_by_day(
        staging.stage_terms(given.terms(spark, sf)), _days(spark, sf)
    )


@query
def events_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.events_by_day(
        staging.stage_events(given.major_events(spark, sf)), _days(spark, sf)
    )


@query
def block_centroids(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(staging.block_centroids(given.addresses(spark, sf)))


@query
def precinct_hour(spark: SparkSession, sf: str) -> DataFrame:
    """The mart, aggregated before the hour and day columns are attached."""
    return presented(stages.build_mart(given.staged(spark, sf)))


@query
def precinct_hour_wide_join(spark: SparkSession, sf: str) -> DataFrame:
    """The mart from the location-hour table."""
    staged = given.staged(spark, sf)
    wide = stages.build_location_hour(staged)
    return presented(panel.precinct_hour(wide, stages.block_map(staged)))


@query
def feature_summary(spark: SparkSession, sf: str) -> DataFrame:
    return features.feature_summary(matrix_of(spark, sf))


@query
def train_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Summary after a learner run."""
    predictions, _ = learner.train_and_predict(matrix_of(spark, sf))
    return features.train_summary(predictions)


@query
def usable_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.filled_columns(matrix_of(spark, sf))


@query
def profile_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.profile_counts(given.hourly_counts(spark, sf))


@query
def profile_columns(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.profile_columns(given.table(spark, sf, "orders"))


@query
def value_types(spark: SparkSession, sf: str) -> DataFrame:
    """JSON type of every word of the documents."""
    documents = given.table(spark, sf, "documents")
    words = documents.select(F.explode(F.split("text", " ")).alias("word"))
    return profiling.value_types(words, "word")


@query
def top_groups(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.top_groups(given.table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"])


@query
def watched_rows(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.watched_rows(given.hourly_counts(spark, sf))


@query
def column_extremes(spark: SparkSession, sf: str) -> DataFrame:
    lines = given.table(spark, sf, "lineitem")
    return profiling.column_extremes(lines, ["l_shipdate", "l_extendedprice", "l_orderkey"])


# --------------------------------------------------------------------- windows


@query
def series_rank(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(export.series_rank(mart_of(spark, sf)))


@query
def location_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Dense rank of all locations by mean hourly count."""
    counts = given.hourly_counts(spark, sf)
    return rounded(export.series_rank(counts, quality.LOCATION_PANEL))


@query
def hourly_index(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(export.series_hour_means(mart_of(spark, sf)))


@query
def seasonal_diff(spark: SparkSession, sf: str) -> DataFrame:
    diffs = metrics.seasonal_difference(mart_of(spark, sf), block_rows=256)
    return rounded(
        diffs.select("precinct", "sensing_date", "hourday", "position", "seasonal_diff")
    )


@query
def fold_scale(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.fold_scale(mart_of(spark, sf)))


@query
def rolling_origins(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.rolling_origins(given.hourly_counts(spark, sf))


# --------------------------------------------------------------------- quality


@query
def check_churn(spark: SparkSession, sf: str) -> DataFrame:
    return quality.churn_status(tally_of(spark, sf))


@query
def check_zero_outage(spark: SparkSession, sf: str) -> DataFrame:
    return quality.zero_outage_counts(tally_of(spark, sf))


@query
def check_gaps_global(spark: SparkSession, sf: str) -> DataFrame:
    return quality.gaps_global(tally_of(spark, sf))


@query
def check_gaps_own_range(spark: SparkSession, sf: str) -> DataFrame:
    return quality.gaps_own_range(tally_of(spark, sf))


@query
def check_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Duplicates among the raw events seen as hourly rows."""
    events = given.table(spark, sf, "events").select(
        F.col("user_id").alias("location_id"), F.to_date("ts").alias("sensing_date"),
        F.hour("ts").alias("hourday"),
    )
    return quality.duplicate_counts(quality.tally(events))


@query
def check_continuity(spark: SparkSession, sf: str) -> DataFrame:
    """Own-range gaps and rows without an instant over both clock changes."""
    counts = ingest.with_observed_at(_transition_counts(spark, sf))
    return quality.continuity_counts(quality.tally(counts))


@query
def check_relocation(spark: SparkSession, sf: str) -> DataFrame:
    return quality.moved_locations(pairs_of(spark, sf))


@query
def check_all(spark: SparkSession, sf: str) -> DataFrame:
    counts, sensors = given.counts(spark, sf), given.sensors(spark, sf)
    return quality.run_all_checks(counts, sensors).select("name", "passed", "count_affected")


@query
def check_not_null(spark: SparkSession, sf: str) -> DataFrame:
    staged = given.staged(spark, sf)
    lh = materialise(stages.build_location_hour(staged), "location-hour")
    block_map = stages.block_map(staged)
    tables = {
        "stg_pedestrian_counts": staged.counts,
        "stg_sensor_locations": staged.sensors,
        "stg_weather_hourly": staged.weather,
        "stg_public_holidays": staged.holidays,
        "stg_school_terms": staged.terms,
        "stg_major_events": staged.events,
        "stg_clue_block_centroids": staged.blocks,
        "int_location_hour": lh,
        "int_sensor_block_map": block_map,
        "mart_precinct_hour": panel.precinct_hour(lh, block_map),
    }
    return reduce(
        DataFrame.unionByName,
        (
            constraints.null_counts(tables[name], name, columns)
            for name, columns in constraints.NOT_NULL.items()
        ),
    )


@query
def check_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Holiday dates that occur more than once."""
    holidays = staging.stage_holidays(given.holidays(spark, sf))
    return constraints.repeated_values(holidays, "holiday_date")


@query
def check_relationships(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with orders who have no events, with their number of orders."""
    events = given.table(spark, sf, "events").select(F.col("user_id").alias("custkey"))
    orders = given.table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"))
    return constraints.missing_parents(orders, events, "custkey")


@query
def check_hour_range(spark: SparkSession, sf: str) -> DataFrame:
    """Hours moved by three, so that the late ones leave the range."""
    counts = given.hourly_counts(spark, sf)
    moved = counts.withColumn("hourday", F.col("hourday") + 3)
    return constraints.hours_out_of_range(moved)


@query
def row_count_preserved(spark: SparkSession, sf: str) -> DataFrame:
    """No row: the joins keep the number of counts."""
    staged = given.staged(spark, sf)
    wide = stages.build_location_hour(staged)
    return constraints.row_counts_differ(staged.counts, wide)


@query
def check_grain_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated (user, day, hour) keys among the raw events."""
    events = given.table(spark, sf, "events")
    keyed = events.select("user_id", F.to_date("ts").alias("day"), F.hour("ts").alias("hour"))
    return constraints.repeated_keys(keyed, ["user_id", "day", "hour"])


@query
def check_totals_preserved(spark: SparkSession, sf: str) -> DataFrame:
    staged = given.staged(spark, sf)
    block_map = stages.block_map(staged)
    wide = materialise(stages.build_location_hour(staged), "location-hour")
    return constraints.totals(wide, block_map, panel.precinct_hour(wide, block_map))


@query
def check_freshness(spark: SparkSession, sf: str) -> DataFrame:
    now = datetime(2024, 2, 1, 12, 0)
    return presented(constraints.freshness(given.counts(spark, sf), now))


# -------------------------------------------------------------------- forecast


@query
def feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return presented(features.feature_matrix(mart_of(spark, sf)))


@query
def baseline_error(spark: SparkSession, sf: str) -> DataFrame:
    """Mean absolute error of the 24-hour naive forecast per area."""
    frame = features.feature_matrix(mart_of(spark, sf))
    error = F.abs(F.col("pedestriancount") - F.col("lag_24h"))
    return rounded(
        frame.groupBy("precinct").agg(
            F.count("lag_24h").alias("pairs"), F.avg(error).alias("mean_abs_error")
        )
    )


@query
def mase_scale(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.series_scale(mart_of(spark, sf)))


SPLIT = date(2024, 1, 21)


def _split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    frame = baseline_of(spark, sf)
    day = F.col("sensing_date")
    return frame.filter(day >= F.lit(SPLIT)), frame.filter(day < F.lit(SPLIT))


@query
def panel_mase(spark: SparkSession, sf: str) -> DataFrame:
    test, train = _split(spark, sf)
    return rounded(metrics.panel_mase(test, train, "baseline_pred"))


@query
def mase_by_series(spark: SparkSession, sf: str) -> DataFrame:
    test, train = _split(spark, sf)
    return rounded(metrics.mase_by_series(test, train, "baseline_pred"))


BASELINE = {"mase_baseline": "baseline_pred"}


@query
def rolling_origin_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.rolling_origin(baseline_of(spark, sf), BASELINE))


@query
def pooled_mase(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.pooled_mase(baseline_of(spark, sf), BASELINE))


@query
def pooled_mase_by_series(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.pooled_by_series(baseline_of(spark, sf), BASELINE))


@query
def export_wide(spark: SparkSession, sf: str) -> DataFrame:
    """The wide export with the baseline scores; the learner columns are null."""
    mart = mart_of(spark, sf)
    matrix = materialise(features.feature_matrix(mart), "features")
    predictions = learner.with_baseline(matrix).withColumn(
        "lgbm_pred", F.lit(None).cast("double")
    )
    wide = export.export_wide(
        mart, predictions,
        materialise(metrics.pooled_mase(predictions, BASELINE), "pooled"),
        materialise(metrics.pooled_by_series(predictions, BASELINE), "by-series"),
    )
    return presented(wide)


# --------------------------------------------------------------------- learner


def known(column: str):
    """Whether a learner's value is there: values of boosted trees cannot be compared with a statement."""
    return F.col(column).isNotNull()


@query
def gbt_train_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that the fitted model predicts, and that its predictions are numbers."""
    predictions, _ = learner.train_and_predict(matrix_of(spark, sf))
    value = F.col(learner.LEARNER_COLUMN)
    return rounded(
        predictions.select(*AREA_PANEL.grain, "baseline_pred", known("lgbm_pred").alias("lgbm_known"), finite(value).alias("lgbm_finite"))
    )


def _tested(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The test rows of all folds, and the matrix they come from."""
    matrix = matrix_of(spark, sf)
    return materialise(learner.rolling_origin_predictions(matrix), "tested"), matrix


def _scores(tested: DataFrame, matrix: DataFrame) -> stages.Scores:
    return stages.evaluate(tested, learner.with_baseline(learner.flags_as_numbers(matrix)))


@query
def rolling_origin_learner(spark: SparkSession, sf: str) -> DataFrame:
    """Every fold of the rolling origin: what was trained, tested, predicted and scored."""
    tested, matrix = _tested(spark, sf)
    predicted = tested.groupBy(F.col("sensing_date").alias("test_date")).agg(F.count(learner.LEARNER_COLUMN).alias("predicted_rows"))
    folds = _scores(tested, matrix).folds.join(predicted, "test_date")
    scored = F.coalesce(finite(F.col("mase_lgbm")), F.lit(False))
    return rounded(folds.select("test_date", "train_rows", "test_rows", "predicted_rows", "mase_baseline", scored.alias("learner_scored")))


@query
def export_with_learner(spark: SparkSession, sf: str) -> DataFrame:
    """The wide export on a learner run: fitted values, pooled and per-series scores of the rolling origin."""
    tested, matrix = _tested(spark, sf)
    scores = _scores(tested, matrix)
    predictions, _ = learner.train_and_predict(matrix)
    wide = export.export_wide(
        mart_of(spark, sf), predictions, materialise(scores.pooled, "pooled"), materialise(scores.by_series, "by-series")
    )
    flags = ("lgbm_pred", "lgbm_error", "mase_lgbm", "mase_lgbm_precinct")
    return rounded(
        wide.select(
            *AREA_PANEL.grain, "pedestriancount", "baseline_pred", "baseline_error", *(known(n).alias(f"{n}_known") for n in flags)
        )
    )
