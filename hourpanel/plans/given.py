"""The given tables seen as landed panel sources.

Every frame here is derived by Spark from whole tables, so it grows with them. Calendar and order
dates lie in 1995 to 2001 and are moved by whole days onto the year of the event stream.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourpanel.functions.wallclock import localize, wall_clock, wall_from_ntz
from hourpanel.plans.stages import Staged, stage_all
from hourpanel.session import materialise
from hourpanel.sources import schemas
from hourpanel.sources.readers import conform
from hourpanel.sources.schemas import columns
from hourpanel.spec import AUDIT_COLUMN

ORDER_DAYS_TO_EVENTS = 9131  # 1999-01-01 becomes 2024-01-01
HOLIDAY_ORDER = 490_000.0
EVENT_ORDER = 450_000.0
APRIL_SHIFT, OCTOBER_SHIFT = 90, 270  # days from January 2024 to the two clock changes
LANDED_AT = "2024-02-01 00:00:00"
TODAY = date(2024, 2, 1)


def pin_zone(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


# Declared, so that opening a table runs no job.
SCHEMAS = {
    "events": columns(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "embeddings": columns("vec_id bigint, embedding floats, label int"),
    "orders": columns(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": columns(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "documents": columns(
        "doc_id bigint, text string, lang string, source string, n_chars bigint"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_zone(spark)
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn(AUDIT_COLUMN, F.lit(LANDED_AT).cast("timestamp"))


def hourly_counts(spark: SparkSession, sf_dir: str, shift_days: int = 0) -> DataFrame:
    """Raw hourly counts: one location per user, events per hour; no instant yet."""
    events = table(spark, sf_dir, "events")
    ahead = F.col("event_type").isin("click", "view")
    counted = events.groupBy(
        F.col("user_id").alias("location_id"),
        F.date_add(F.to_date("ts"), shift_days).alias("sensing_date"),
        F.hour("ts").alias("hourday"),
    ).agg(
        F.min("event_id").alias("id"),
        F.count_if(ahead).alias("direction_1"),
        F.count_if(~ahead).alias("direction_2"),
        F.count(F.lit(1)).alias("pedestriancount"),
    )
    lon = F.lit(144.9) + F.col("location_id") / F.lit(1000.0)
    lat = F.lit(-37.8) - F.col("pedestriancount") / F.lit(1000.0)
    return counted.select(
        "id", "location_id", "sensing_date", "hourday", "direction_1", "direction_2",
        "pedestriancount",
        F.concat(F.lit("S"), F.col("location_id").cast("string")).alias("sensor_name"),
        F.struct(lon.alias("lon"), lat.alias("lat")).alias("location"),
    )


def counts(spark: SparkSession, sf_dir: str, shift_days: int = 0) -> DataFrame:
    """Landed hourly counts with their instant and audit stamp."""
    raw = hourly_counts(spark, sf_dir, shift_days)
    wall = wall_clock(F.col("sensing_date"), F.col("hourday"))
    return _stamped(raw.withColumn("observed_at", localize(wall)))


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor snapshot: one sensor per vector; some labels give an unreadable install date."""
    vectors = table(spark, sf_dir, "embeddings")
    month = F.lpad((F.col("label") * 2).cast("string"), 2, "0")
    return _stamped(
        vectors.select(
            F.col("vec_id").alias("location_id"),
            F.concat(F.lit("site "), F.col("label").cast("string")).alias("sensor_description"),
            F.concat(F.lit("V"), F.col("vec_id").cast("string")).alias("sensor_name"),
            F.concat(F.lit("2020-"), month, F.lit("-01")).alias("installation_date"),
            F.lit(None).cast("string").alias("note"),
            F.lit("Outdoor").alias("location_type"),
            F.lit("A").alias("status"),
            F.lit("North").alias("direction_1"),
            F.lit("South").alias("direction_2"),
            F.col("embedding")[0].cast("double").alias("latitude"),
            F.col("embedding")[1].cast("double").alias("longitude"),
        )
    )


def weather_hours(spark: SparkSession, sf_dir: str, shift_days: int = 0) -> DataFrame:
    """Weather per wall-clock hour from the error events; hours without one are absent."""
    errors = table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    wall = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    moved = wall + F.make_dt_interval(days=F.lit(shift_days))
    return errors.groupBy(moved.alias("wall")).agg(
        F.avg("value").alias("temperature_2m"),
        F.min("value").alias("precipitation"),
        F.max("value").alias("rain"),
        (F.max("value") - F.min("value")).alias("wind_speed_10m"),
        F.count(F.lit(1)).alias("cloud_cover"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = weather_hours(spark, sf_dir)
    timed = hours.withColumn("time", localize(wall_from_ntz(F.col("wall")))).drop("wall")
    return conform(_stamped(timed), schemas.WEATHER.landed)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    day = F.date_add(F.to_date("o_orderdate"), ORDER_DAYS_TO_EVENTS)
    return orders.withColumn("day", day)


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with a very large order, named by its priority; several names a day are common."""
    big = _orders(spark, sf_dir).filter(F.col("o_totalprice") > HOLIDAY_ORDER)
    return _stamped(big.select(F.col("day").alias("date"), F.col("o_orderpriority").alias("name")))


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarters per order status; one status runs 20 days into the next quarter."""
    orders = _orders(spark, sf_dir)
    late = F.when(F.col("o_orderstatus") == "P", F.lit(20)).otherwise(F.lit(0))
    spans = orders.groupBy(
        F.year("day").alias("year"), F.quarter("day").alias("term"),
        F.col("o_orderstatus").alias("jurisdiction"),
    ).agg(
        F.min("day").alias("start_date"),
        F.max(F.date_add(F.col("day"), late)).alias("end_date"),
    )
    return _stamped(
        spans.select(
            "year", "term", "start_date", "end_date", "jurisdiction",
            F.lit("derived").alias("source_note"),
        )
    )


def major_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Very large orders as events that last longer with a longer priority label."""
    big = _orders(spark, sf_dir).filter(F.col("o_totalprice") > EVENT_ORDER)
    days = F.length("o_orderpriority") - 5
    return _stamped(
        big.select(
            F.col("o_orderkey").cast("string").alias("event_id"),
            F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("event_name"),
            F.lit("order book").alias("venue"),
            F.col("day").alias("start_date"),
            F.date_add(F.col("day"), days).alias("end_date"),
            F.lit(None).cast("string").alias("notes"),
            F.year("day").alias("year"),
        )
    )


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses at the vector coordinates; blocks and areas are grid squares."""
    lat = F.col("embedding")[0].cast("double")
    lon = F.col("embedding")[1].cast("double")

    def square(step: float):
        rows, columns = F.floor(lat * step), F.floor(lon * step)
        return F.concat_ws(":", rows.cast("string"), columns.cast("string"))

    return _stamped(
        table(spark, sf_dir, "embeddings").select(
            F.lit("2024").alias("census_year"),
            square(20.0).alias("block_id"),
            square(5.0).alias("clue_small_area"),
            lat.alias("latitude"),
            lon.alias("longitude"),
        )
    )


def staged(spark: SparkSession, sf_dir: str) -> Staged:
    """Staged views. Counts and weather both come from the events; each is landed once as a table."""
    with ThreadPoolExecutor(2) as pool:
        facts = pool.submit(materialise, counts(spark, sf_dir), "counts")
        hours = pool.submit(materialise, weather(spark, sf_dir), "weather")
        landed_counts, landed_weather = facts.result(), hours.result()
    return stage_all(
        {
            schemas.COUNTS.name: landed_counts,
            schemas.SENSORS.name: sensors(spark, sf_dir),
            schemas.WEATHER.name: landed_weather,
            schemas.HOLIDAYS.name: holidays(spark, sf_dir),
            schemas.TERMS.name: terms(spark, sf_dir),
            schemas.EVENTS.name: major_events(spark, sf_dir),
            schemas.ADDRESSES.name: addresses(spark, sf_dir),
        }
    )
