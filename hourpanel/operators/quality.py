"""Source quality checks: churn, zero versus outage, duplicates, continuity, relocation.

All count checks start from a ``Tally``. Its grain table has one row per (location, date, hour) with
the number of rows and of zero, null and unstamped ones. It is the only pass over the facts and
combines copies before the shuffle, so a dominant location or group of copies costs one row per
task. Two small tables sum it by location and by day, and every count comes from those: gaps by
arithmetic, as expected hours minus hours present. The grid of expected hours is built only to list
gaps. Every check gives one record: name, passed, count_affected, sample_rows (JSON strings, first
rows in key order), detail (JSON).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourpanel.functions.scalars import half_even, pick_coordinates
from hourpanel.functions.wallclock import (
    expected_hours, is_ambiguous, is_expected_hour, is_nonexistent, wall_clock,
)
from hourpanel.session import materialise
from hourpanel.spec import LOCATION_PANEL, SAMPLE_ROWS, WATCHED_LOCATIONS, PanelSpec


def quality_grain(counts: DataFrame, spec: PanelSpec = LOCATION_PANEL) -> DataFrame:
    """One row per (location, date, hour), null keys included, with tallies and ``expected``.

    ``expected`` marks a complete key whose hour exists on that day.
    """
    value = F.col(spec.value) if spec.value in counts.columns else F.lit(None)
    stamped = F.col(spec.ts).isNotNull() if spec.ts in counts.columns else F.lit(False)
    day = F.col(spec.date).try_cast("date")
    keyed = counts.select(
        F.col(spec.series), day.alias(spec.date), F.col(spec.hour),
        (value == 0).alias("_zero"), value.isNull().alias("_null"),
        (~stamped & F.col(spec.hour).isNotNull()).alias("_unstamped"),
    )
    tallied = keyed.groupBy(*spec.grain).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("_zero").alias("zeros"),
        F.count_if("_null").alias("nulls"),
        F.count_if("_unstamped").alias("unstamped"),
    )
    complete = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in spec.grain))
    real = is_expected_hour(F.col(spec.date), F.col(spec.hour), spec.tz)
    return tallied.withColumn("expected", F.coalesce(complete & real, F.lit(False)))


def by_location(grain: DataFrame, spec: PanelSpec = LOCATION_PANEL) -> DataFrame:
    """Grain tallies summed per location, null location included, with first and last date."""
    copied = F.col("n") > 1
    return grain.groupBy(spec.series).agg(
        F.count_if("expected").alias("present"),
        F.min(spec.date).alias("first_date"),
        F.max(spec.date).alias("last_date"),
        F.sum("zeros").alias("zeros"),
        F.sum("nulls").alias("nulls"),
        F.sum("unstamped").alias("unstamped"),
        F.sum(F.when(copied, F.col("n")).otherwise(0)).alias("copied_rows"),
        F.count_if(copied).alias("copied_groups"),
    )


def by_day(grain: DataFrame, spec: PanelSpec = LOCATION_PANEL) -> DataFrame:
    """Number of expected keys present per day."""
    return grain.filter("expected").groupBy(spec.date).agg(F.count(F.lit(1)).alias("present"))


@dataclass(frozen=True)
class Tally:
    """The grain table and its sums by location and by day."""

    grain: DataFrame
    locations: DataFrame
    days: DataFrame
    spec: PanelSpec


def tally(counts: DataFrame, spec: PanelSpec = LOCATION_PANEL) -> Tally:
    """Write the three tables the checks read."""
    grain = materialise(quality_grain(counts, spec), "quality-grain")
    return Tally(
        grain,
        materialise(by_location(grain, spec), "quality-locations"),
        materialise(by_day(grain, spec), "quality-days"),
        spec,
    )


def _span(t: Tally) -> DataFrame:
    """One row with the first and last date of the extract; none without dates."""
    ends = t.locations.agg(F.min("first_date").alias("low"), F.max("last_date").alias("high"))
    return ends.filter("low is not null")


def _known_locations(t: Tally) -> DataFrame:
    return t.locations.select(t.spec.series).filter(F.col(t.spec.series).isNotNull())


def short_days(t: Tally) -> Column:
    """Array of (day, missing) for the days that lack a wall hour: a few per year.

    It covers the whole calendar years the dates touch.
    """
    first = F.trunc("low", "year")
    last = F.date_sub(F.add_months(F.trunc("high", "year"), 12), 1)
    days = _span(t).select(F.explode(F.sequence(first, last)).alias("day"))
    missing = (24 - F.size(expected_hours(F.col("day"), t.spec.tz))).alias("missing")
    return (
        days.select("day", missing).filter("missing > 0")
        .agg(F.collect_list(F.struct("day", "missing"))).scalar()
    )


def hours_between(first: Column, last: Column, short: Column) -> Column:
    """Expected wall hours from one date to another, both included."""
    skipped = F.aggregate(
        F.filter(short, lambda d: d["day"].between(first, last)),
        F.lit(0),
        lambda total, d: total + d["missing"],
    )
    return ((F.datediff(last, first) + 1) * 24 - skipped).cast("bigint")


# ---------------------------------------------------------------- sensor churn


def churn_status(t: Tally) -> DataFrame:
    """Per (year, location): hours present, hours of the year, and whether all are covered."""
    spec = t.spec
    year = F.year(spec.date)
    present = (
        t.grain.filter(F.col(spec.date).isNotNull() & F.col(spec.series).isNotNull())
        .groupBy(year.alias("year"), spec.series)
        .agg(F.count_if("expected").alias("present_hours"))
    )
    first = F.make_date("year", F.lit(1), F.lit(1))
    last = F.make_date("year", F.lit(12), F.lit(31))
    length = hours_between(first, last, F.col("_short"))
    return (
        present.withColumn("_short", short_days(t))
        .withColumn("expected_hours", length)
        .withColumn("full_year", F.col("present_hours") == F.col("expected_hours"))
        .drop("_short")
    )


def sensor_churn(t: Tally) -> DataFrame:
    """Locations that do not cover a whole calendar year. Always passes.

    ``detail`` gives counts per year; ``churn_status`` gives the locations themselves.
    """
    spec = t.spec
    status = churn_status(t)
    per_year = status.groupBy("year", "expected_hours").agg(
        F.count_if("full_year").alias("full"), F.count_if(~F.col("full_year")).alias("partial")
    )
    sample = _sample(
        status.filter("not full_year"), ["year", spec.series],
        [spec.series, "year", "present_hours"],
    )
    detail = F.sort_array(F.collect_list(F.struct("year", "expected_hours", "full", "partial")))
    return per_year.agg(
        F.lit("sensor_churn").alias("name"),
        F.lit(True).alias("passed"),
        F.coalesce(F.sum("partial"), F.lit(0)).alias("count_affected"),
        F.to_json(F.struct(detail.alias("years"))).alias("detail"),
    ).select("name", "passed", "count_affected", sample.alias("sample_rows"), "detail")


# ---------------------------------------------------------- zero versus outage


def zero_outage_counts(t: Tally) -> DataFrame:
    """Genuine zeros, null counts and gaps, as one row.

    A gap is an expected hour of any day between the first and last date of the whole extract at
    which a location has no row.
    """
    totals = t.locations.agg(
        F.count(t.spec.series).alias("locations"),
        F.sum("present").alias("present"),
        F.min("first_date").alias("first"),
        F.max("last_date").alias("last"),
        F.coalesce(F.sum("zeros"), F.lit(0)).alias("genuine_zeros"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_counts"),
    )
    expected = F.col("locations") * hours_between(F.col("first"), F.col("last"), F.col("_short"))
    gaps = F.coalesce(expected - F.col("present"), F.lit(0))
    return totals.withColumn("_short", short_days(t)).select(
        "genuine_zeros", "null_counts", gaps.alias("gaps")
    )


def missing_hours(t: Tally, days: DataFrame, near: Column | None = None) -> DataFrame:
    """Expected (location, date, hour) keys without a row, for given (location, date) rows.

    Present hours are gathered per day (at most 24), so the grid that is joined has one row per
    location and day and hours are expanded only where they are missing. ``near`` keeps only grain
    rows that can meet ``days``, when those are few.
    """
    spec = t.spec
    keys = [spec.series, spec.date]
    grain = t.grain if near is None else t.grain.filter(near)
    present = (
        grain.filter("expected").groupBy(*keys)
        .agg(F.collect_set(F.col(spec.hour).cast("int")).alias("_present"))
    )
    none = F.array().cast("array<int>")
    absent = F.array_except(
        expected_hours(F.col(spec.date), spec.tz), F.coalesce("_present", none)
    )
    return days.join(present, keys, "left").select(*keys, F.explode(absent).alias(spec.hour))


def gaps_global(t: Tally) -> DataFrame:
    """All gaps inside the date range of the whole extract."""
    low, high = _span(t).select("low").scalar(), _span(t).select("high").scalar()
    days = _known_locations(t).withColumn(t.spec.date, F.explode(F.sequence(low, high)))
    return missing_hours(t, days)


def _own_days(t: Tally, locations: DataFrame) -> DataFrame:
    return locations.select(
        t.spec.series, F.explode(F.sequence("first_date", "last_date")).alias(t.spec.date)
    )


def gaps_own_range(t: Tally) -> DataFrame:
    """All gaps inside each location's own date range."""
    known = F.col(t.spec.series).isNotNull() & F.col("first_date").isNotNull()
    return missing_hours(t, _own_days(t, t.locations.filter(known)))


def _first_global_gaps(t: Tally) -> DataFrame:
    """Gaps of the earliest days that have any: enough for the sample, without the whole grid."""
    date = t.spec.date
    total = _known_locations(t).agg(F.count(F.lit(1))).scalar()
    days = _span(t).select(F.explode(F.sequence("low", "high")).alias(date))
    wanted = total * F.size(expected_hours(F.col(date), t.spec.tz))
    lacking = (
        days.join(t.days, date, "left")
        .filter(F.coalesce("present", F.lit(0)) < wanted)
        .select(date).orderBy(date).limit(SAMPLE_ROWS)
    )
    chosen = lacking.agg(F.collect_list(date)).scalar()
    grid = _known_locations(t).withColumn(date, F.explode(chosen))
    return missing_hours(t, grid, F.array_contains(chosen, F.col(date)))


def zero_versus_outage(t: Tally) -> DataFrame:
    """A present 0 is a genuine zero, a null is unknown, an absent hour is a gap.

    Passes when there are no nulls; gaps and nulls are affected.
    """
    spec, grain = t.spec, t.grain
    keys = list(spec.grain)

    def labelled(df: DataFrame, name: str, rank: int) -> DataFrame:
        return df.select(*keys, F.lit(name).alias("class"), F.lit(rank).alias("_rank")).orderBy(
            spec.date, spec.hour, spec.series
        ).limit(SAMPLE_ROWS)

    rows = (
        labelled(grain.filter("zeros > 0"), "genuine_zero", 0)
        .unionByName(labelled(grain.filter("nulls > 0"), "null_count", 1))
        .unionByName(labelled(_first_global_gaps(t), "gap", 2))
    )
    sample = _sample(rows, ["_rank", spec.date, spec.hour, spec.series], [*keys, "class"])
    counts = zero_outage_counts(t)
    return counts.select(
        F.lit("zero_versus_outage").alias("name"),
        (F.col("null_counts") == 0).alias("passed"),
        (F.col("gaps") + F.col("null_counts")).alias("count_affected"),
        sample.alias("sample_rows"),
        F.to_json(F.struct("genuine_zeros", "null_counts", "gaps")).alias("detail"),
    )


# ------------------------------------------------------------------ duplicates


def duplicate_counts(t: Tally, watched: tuple[int, ...] = WATCHED_LOCATIONS) -> DataFrame:
    """Rows in duplicate groups, number of groups, and groups of the watched locations."""
    of_watched = F.when(F.col(t.spec.series).isin(*watched), F.col("copied_groups"))
    return t.locations.agg(
        F.coalesce(F.sum("copied_rows"), F.lit(0)).alias("affected_rows"),
        F.coalesce(F.sum("copied_groups"), F.lit(0)).alias("duplicate_groups"),
        F.coalesce(F.sum(of_watched), F.lit(0)).alias("watched_groups"),
    )


def duplicate_records(t: Tally, watched: tuple[int, ...] = WATCHED_LOCATIONS) -> DataFrame:
    """Keys with more than one row; null keys count as equal."""
    keys = list(t.spec.grain)
    sample = _sample(t.grain.filter("n > 1"), keys, [*keys, "n"])
    return duplicate_counts(t, watched).select(
        F.lit("duplicate_records").alias("name"),
        (F.col("duplicate_groups") == 0).alias("passed"),
        F.col("affected_rows").alias("count_affected"),
        sample.alias("sample_rows"),
        F.to_json(F.struct("duplicate_groups", "watched_groups")).alias("detail"),
    )


# ------------------------------------------------------------------ continuity


def location_gaps(t: Tally) -> DataFrame:
    """Number of gaps inside each location's own date range."""
    known = F.col(t.spec.series).isNotNull() & F.col("first_date").isNotNull()
    expected = hours_between(F.col("first_date"), F.col("last_date"), F.col("_short"))
    return t.locations.filter(known).withColumn("_short", short_days(t)).select(
        t.spec.series, "first_date", "last_date", (expected - F.col("present")).alias("gaps")
    )


def continuity_counts(t: Tally) -> DataFrame:
    gaps = location_gaps(t).agg(F.coalesce(F.sum("gaps"), F.lit(0))).scalar()
    return t.locations.agg(
        F.coalesce(F.sum("unstamped"), F.lit(0)).alias("observed_at_nat")
    ).select(gaps.alias("gaps"), "observed_at_nat")


def transition_dates(t: Tally) -> DataFrame:
    """Dates in range whose 02:00 has no single instant, as ordered lists for April and October."""
    spec = t.spec
    days = _span(t).select(F.explode(F.sequence("low", "high")).alias("day"))
    two = wall_clock(F.col("day"), F.lit(2))
    odd = days.filter(
        F.month("day").isin(4, 10) & (is_nonexistent(two, spec.tz) | is_ambiguous(two, spec.tz))
    )

    def listed(month: int) -> Column:
        dates = F.collect_list(F.when(F.month("day") == month, F.col("day").cast("string")))
        return F.array_sort(dates)

    return odd.agg(
        listed(4).alias("april_fallback_dates"), listed(10).alias("october_spring_forward_dates")
    )


def timestamp_continuity(t: Tally) -> DataFrame:
    """Gaps inside each location's own range, and rows with an hour but no instant."""
    keys = list(t.spec.grain)
    # The first gaps in key order belong to the first locations that have any.
    leading = location_gaps(t).filter("gaps > 0").orderBy(t.spec.series).limit(SAMPLE_ROWS)
    chosen = leading.agg(F.collect_list(t.spec.series)).scalar()
    near = F.array_contains(chosen, F.col(t.spec.series))
    gap_sample = _sample(missing_hours(t, _own_days(t, leading), near), keys, keys)
    odd_sample = _sample(t.grain.filter("unstamped > 0"), keys, keys)
    counts = continuity_counts(t)
    transitions = transition_dates(t)
    april = transitions.select("april_fallback_dates").scalar()
    october = transitions.select("october_spring_forward_dates").scalar()
    return counts.select(
        F.lit("timestamp_continuity").alias("name"),
        ((F.col("gaps") == 0) & (F.col("observed_at_nat") == 0)).alias("passed"),
        (F.col("gaps") + F.col("observed_at_nat")).alias("count_affected"),
        F.when(F.col("gaps") > 0, gap_sample).otherwise(odd_sample).alias("sample_rows"),
        F.to_json(
            F.struct(
                "gaps", "observed_at_nat",
                april.alias("april_fallback_dates"),
                october.alias("october_spring_forward_dates"),
            )
        ).alias("detail"),
    )


# ------------------------------------------------------------------ relocation


def coordinate_pairs(
    counts: DataFrame | None, sensors: DataFrame | None, spec: PanelSpec = LOCATION_PANEL
) -> DataFrame:
    """Distinct rounded (location, lon, lat) over counts and sensors; lon and lat may be null."""
    parts = []
    for df in (counts, sensors):
        if df is not None:
            lon, lat = pick_coordinates(df)
            parts.append(
                df.select(spec.series, half_even(lon).alias("lon"), half_even(lat).alias("lat"))
                .distinct()
            )
    return reduce(DataFrame.unionByName, parts).distinct()


def moved_locations(pairs: DataFrame, spec: PanelSpec = LOCATION_PANEL) -> DataFrame:
    """Locations seen at more than one coordinate pair."""
    return (
        pairs.filter(F.col(spec.series).isNotNull())
        .groupBy(spec.series)
        .agg(F.count_if(F.col("lon").isNotNull() & F.col("lat").isNotNull()).alias("n_coordinates"))
        .filter("n_coordinates > 1")
    )


def relocation_counts(pairs: DataFrame, spec: PanelSpec = LOCATION_PANEL) -> DataFrame:
    moved = moved_locations(pairs, spec).agg(F.count(F.lit(1))).scalar()
    return pairs.agg(F.count_distinct(spec.series).alias("locations_checked")).select(
        moved.alias("moved"), "locations_checked"
    )


def sensor_relocation(pairs: DataFrame, spec: PanelSpec = LOCATION_PANEL) -> DataFrame:
    """Locations that moved. The coordinates of any of them are its rows in ``pairs``."""
    sample = _sample(moved_locations(pairs, spec), [spec.series], [spec.series, "n_coordinates"])
    return relocation_counts(pairs, spec).select(
        F.lit("sensor_relocation").alias("name"),
        (F.col("moved") == 0).alias("passed"),
        F.col("moved").alias("count_affected"),
        sample.alias("sample_rows"),
        F.to_json(F.struct("locations_checked")).alias("detail"),
    )


# ------------------------------------------------------------------- together


def _sample(rows: DataFrame, order: list[str], show: list[str]) -> Column:
    """First rows in key order as JSON strings."""
    top = rows.orderBy(*order).limit(SAMPLE_ROWS)
    keyed = F.struct(
        *(F.col(c).alias(f"k{i}") for i, c in enumerate(order)),
        F.to_json(F.struct(*(F.col(c) for c in show)), {"ignoreNullFields": "false"}).alias("row"),
    )
    listed = F.transform(F.array_sort(F.collect_list(keyed)), lambda item: item["row"])
    return top.agg(listed).scalar()


def run_all_checks(
    counts: DataFrame, sensors: DataFrame | None = None, spec: PanelSpec = LOCATION_PANEL
) -> DataFrame:
    """The five checks in fixed order, one record each, over one tally."""
    t = tally(counts, spec)
    pairs = materialise(coordinate_pairs(counts, sensors, spec), "quality-coordinates")
    records = [
        sensor_churn(t),
        zero_versus_outage(t),
        duplicate_records(t),
        timestamp_continuity(t),
        sensor_relocation(pairs, spec),
    ]
    return reduce(DataFrame.unionByName, records)
