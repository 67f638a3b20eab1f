"""Profiling of a landed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourpanel.spec import LOCATION_PANEL, WATCHED_LOCATIONS, PanelSpec

TOP_GROUPS = 20
#: What a cast to a number may accept, and a little more: a failed cast to double costs an exception.
NUMBER = (
    r"\A[\x00-\x20\x7F]*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]*)([eE][+-]?[0-9]+)?[dDfF]?"
    r"|0[xX][0-9a-fA-F]*\.?[0-9a-fA-F]*[pP][+-]?[0-9]+[dDfF]?|(?i:nan|inf|infinity))[\x00-\x20\x7F]*\z"
)


def profile_counts(counts: DataFrame, spec: PanelSpec = LOCATION_PANEL) -> DataFrame:
    """One row: rows, distinct series, zero and null values, duplicate keys.

    All of it comes from one aggregation to the grain, so copies are combined before the shuffle.
    """
    value = F.col(spec.value)
    grain = counts.groupBy(*spec.grain).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(value == 0).alias("zeros"),
        F.count_if(value.isNull()).alias("nulls"),
    )
    series = grain.groupBy(spec.series).agg(
        F.sum("n").alias("n"), F.sum("zeros").alias("zeros"), F.sum("nulls").alias("nulls"),
        F.count_if(F.col("n") > 1).alias("groups"),
    )
    return series.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("distinct_series"),
        F.coalesce(F.sum("zeros"), F.lit(0)).alias("zero_rows"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_rows"),
        F.coalesce(F.sum("groups"), F.lit(0)).alias("duplicate_groups"),
    )


def profile_columns(df: DataFrame) -> DataFrame:
    """Per column: type, non-null and null rows, smallest and largest value, in the column's own order, as text."""
    tallies = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(
            F.struct(
                F.count(name).alias("filled"),
                F.min(name).cast("string").alias("low"),
                F.max(name).cast("string").alias("high"),
            ).alias(name)
            for name in df.columns
        ),
    )
    long = tallies.unpivot("_rows", [F.col(n) for n in df.columns], "column_name", "_t")
    kinds = F.create_map(*(F.lit(part) for pair in df.dtypes for part in pair))
    return long.select(
        "column_name",
        F.element_at(kinds, F.col("column_name")).alias("column_type"),
        F.col("_t.filled").alias("filled_rows"),
        (F.col("_rows") - F.col("_t.filled")).alias("null_rows"),
        F.col("_t.low").alias("low"),
        F.col("_t.high").alias("high"),
    )


def value_types(df: DataFrame, column: str) -> DataFrame:
    """How many values of a text column read as each JSON type."""
    text = F.col(column).cast("string")
    kind = (
        F.when(text.isNull(), F.lit("null"))
        .when(text.isin("true", "false"), F.lit("bool"))
        .when(~text.rlike(NUMBER), F.lit("str"))
        .when(text.try_cast("bigint").isNotNull(), F.lit("int"))
        .when(text.try_cast("double").isNotNull(), F.lit("float"))
        .otherwise(F.lit("str"))
    )
    return df.groupBy(kind.alias("value_type")).agg(F.count(F.lit(1)).alias("n"))


def first_examples(df: DataFrame, column: str, n: int = 8) -> DataFrame:
    """The smallest ``n`` values of a column."""
    return df.select(column).orderBy(column).limit(n)


def top_groups(df: DataFrame, keys: list[str], limit: int = TOP_GROUPS) -> DataFrame:
    """The largest groups; ties in key order. A bounded heap per task, no global sort."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), *keys).limit(limit)


def watched_rows(
    df: DataFrame, spec: PanelSpec = LOCATION_PANEL, watched: tuple[int, ...] = WATCHED_LOCATIONS
) -> DataFrame:
    """Row count per watched location."""
    return (
        df.filter(F.col(spec.series).isin(*watched))
        .groupBy(spec.series).agg(F.count(F.lit(1)).alias("n"))
    )


def column_extremes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Smallest and largest value of each column, as one row."""
    return df.agg(
        *(
            agg(name).alias(f"{label}_{name}")
            for name in columns
            for label, agg in (("min", F.min), ("max", F.max))
        )
    )


def calendar_difference(left: DataFrame, right: DataFrame, day: str, name: str) -> DataFrame:
    """Distinct (day, name) of the left calendar on days the right one lacks, in order."""
    missing = left.select(day, name).distinct().join(
        right.select(day).distinct(), day, "left_anti"
    )
    return missing.orderBy(day, name)
