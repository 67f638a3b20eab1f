"""Calendar facts by day: holidays, school terms, major events.

Intervals meet days by exploding each interval, clipped to the days present, and joining on
equality. That keeps the join hash-based; a ``between`` join would compare every pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_days(counts: DataFrame, date: str = "sensing_date") -> DataFrame:
    """Days present in the facts: a one-column scan, deduplicated before the shuffle."""
    return counts.select(date).filter(F.col(date).isNotNull()).distinct()


def explode_intervals(intervals: DataFrame, days: DataFrame, date: str) -> DataFrame:
    """One row per interval and present day inside it, both ends included.

    Intervals are clipped to the first and last present day first, so an open-ended one costs no
    more rows than there are days.
    """
    first = days.agg(F.min(date)).scalar()
    last = days.agg(F.max(date)).scalar()
    low = F.greatest(F.col("start_date"), first)
    high = F.least(F.col("end_date"), last)
    known = F.col("start_date").isNotNull() & F.col("end_date").isNotNull()
    spans = intervals.withColumn("_low", low).withColumn("_high", high)
    return (
        spans.filter(known & (F.col("_low") <= F.col("_high")))
        .withColumn(date, F.explode(F.sequence("_low", "_high")))
        .drop("_low", "_high")
        .join(days, date, "left_semi")
    )


def ordered_names(df: DataFrame, key: str, name: str, out: str, sep: str = ", ") -> DataFrame:
    """Names of a key joined in name order, repeats kept.

    Equal names are counted before the shuffle, so a key with many copies of few names moves one
    row per name.
    """
    counted = df.filter(F.col(name).isNotNull()).groupBy(key, name).agg(
        F.count(F.lit(1)).cast("int").alias("_n")
    )
    repeated = counted.withColumn(
        "_text", F.array_join(F.array_repeat(F.col(name), F.col("_n")), sep)
    )
    return repeated.groupBy(key).agg(
        F.expr(f"listagg(_text, '{sep}') WITHIN GROUP (ORDER BY {name})").alias(out)
    )


def holidays_by_day(holidays: DataFrame) -> DataFrame:
    """Ordered holiday names per date."""
    names = ordered_names(holidays, "holiday_date", "holiday_name", "holiday_name")
    return names.withColumnRenamed("holiday_date", "sensing_date")


def terms_by_day(terms: DataFrame, days: DataFrame, date: str = "sensing_date") -> DataFrame:
    """Distinct term count per day, and the term itself when there is exactly one."""
    pairs = explode_intervals(terms, days, date).select(date, "term").distinct()
    count = F.count("term")
    return pairs.groupBy(date).agg(
        count.alias("school_term_count"),
        F.when(count == 1, F.min("term")).alias("school_term"),
    )


def events_by_day(events: DataFrame, days: DataFrame, date: str = "sensing_date") -> DataFrame:
    """Distinct event count per day and the distinct event names in order."""
    pairs = explode_intervals(events, days, date).select(date, "event_id", "event_name").distinct()
    return pairs.groupBy(date).agg(
        F.count_distinct("event_id").alias("event_count"),
        F.array_join(F.array_sort(F.collect_set("event_name")), ", ").alias("event_names"),
    )


def calendar_by_day(
    holidays: DataFrame, terms: DataFrame, events: DataFrame, days: DataFrame,
    date: str = "sensing_date",
) -> DataFrame:
    """All calendar facts of the present days in one narrow table, so the facts join it once."""
    parts = [
        holidays_by_day(holidays).withColumnRenamed("sensing_date", date),
        terms_by_day(terms, days, date),
        events_by_day(events, days, date),
    ]
    merged = days
    for part in parts:
        merged = merged.join(part, date, "left")
    return merged
