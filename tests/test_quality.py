import json
import random
from datetime import date, timedelta

from panel_rows import counts, sensors
from pyspark.sql import functions as F

from hourpanel.operators import constraints, profiling, quality
from hourpanel.sources.ingest import with_observed_at


def grain(spark, rows):
    return quality.tally(with_observed_at(counts(spark, rows)))


def test_duplicates_name_the_watched_sensor(spark):
    row = quality.duplicate_records(
        grain(spark, [(67, "2026-08-01", 9, 22), (67, "2026-08-01", 9, 23)])
    ).first()
    assert (row.passed, row.count_affected) == (False, 2)
    assert json.loads(row.detail) == {"duplicate_groups": 1, "watched_groups": 1}
    assert json.loads(row.sample_rows[0])["location_id"] == 67


def test_null_keys_form_duplicate_groups(spark):
    rows = [(None, None, None, 1)] * 3 + [(1, "2026-08-01", 0, 1)]
    assert quality.duplicate_counts(grain(spark, rows)).first().affected_rows == 3


def test_relocation_finds_the_moved_sensor(spark):
    df = counts(spark, [(14, "2026-08-01", 8, 2, 144.96, -37.81), (14, "2026-08-02", 8, 2, 144.97, -37.82),
                        (15, "2026-08-02", 8, 2, 144.97, -37.82)])
    row = quality.sensor_relocation(quality.coordinate_pairs(df, None)).first()
    assert (row.passed, row.count_affected) == (False, 1)
    assert json.loads(row.sample_rows[0]) == {"location_id": 14, "n_coordinates": 2}


def test_relocation_compares_counts_with_sensors(spark):
    df = counts(spark, [(14, "2026-08-01", 8, 2, 144.96, -37.81)])
    same = quality.coordinate_pairs(df, sensors(spark, [(14, -37.8100000001, 144.96)]))
    moved = quality.coordinate_pairs(df, sensors(spark, [(14, -37.82, 144.96)]))
    assert quality.sensor_relocation(same).first().passed
    assert not quality.sensor_relocation(moved).first().passed


ZEROS_GAPS = [(52, "2026-08-01", 0, 0), (52, "2026-08-01", 2, 10)]


def test_zero_is_not_a_gap(spark):
    row = quality.zero_versus_outage(grain(spark, ZEROS_GAPS)).first()
    assert json.loads(row.detail) == {"genuine_zeros": 1, "null_counts": 0, "gaps": 22}
    assert row.passed and row.count_affected == 22
    assert json.loads(row.sample_rows[0])["class"] == "genuine_zero"
    assert [json.loads(r)["hourday"] for r in row.sample_rows[1:]] == [1, 3, 4, 5]


def test_null_counts_fail(spark):
    row = quality.zero_versus_outage(grain(spark, [(52, "2026-08-01", 0, None)])).first()
    assert not row.passed and row.count_affected == 24


def test_continuity_lists_the_missing_hour(spark):
    row = quality.timestamp_continuity(grain(spark, ZEROS_GAPS)).first()
    assert not row.passed and json.loads(row.detail)["gaps"] == 22
    assert 1 in {json.loads(r)["hourday"] for r in row.sample_rows}


def test_continuity_over_the_clock_changes(spark):
    rows = [(1, "2026-04-05", h, 1) for h in range(24)] + [(2, "2026-10-04", h, 1) for h in range(24) if h != 2]
    row = quality.timestamp_continuity(grain(spark, rows)).first()
    detail = json.loads(row.detail)
    assert detail["gaps"] == 0 and detail["observed_at_nat"] == 1
    assert detail["april_fallback_dates"] == ["2026-04-05"]
    assert detail["october_spring_forward_dates"] == ["2026-10-04"]
    assert json.loads(row.sample_rows[0])["sensing_date"] == "2026-04-05"


def test_churn_marks_a_partial_year(spark):
    df = grain(spark, [(52, "2026-07-05", 11, 552), (52, "2026-07-05", 12, 590)])
    assert quality.sensor_churn(df).first().passed
    status = quality.churn_status(df).first()
    assert (status.year, status.location_id, status.full_year) == (2026, 52, False)
    assert status.expected_hours == 365 * 24 - 1


def test_churn_full_year_ignores_the_skipped_hour(spark):
    first = date(2026, 1, 1)
    days = [str(first + timedelta(days=n)) for n in range(365)]
    rows = [(1, d, h, 1) for d in days for h in range(24)]
    full = grain(spark, rows)
    assert quality.churn_status(full).first().full_year
    # A row at the skipped hour must not stand in for a missing one.
    lacking = grain(spark, [r for r in rows if r[1:3] != ("2026-07-01", 5)])
    assert not quality.churn_status(lacking).first().full_year


def direct_gaps(rows, own):
    keys = {(r[0], r[1], r[2]) for r in rows}
    spans = {}
    for loc, day, _ in keys:
        spans.setdefault(loc, set()).add(day)
    every = {d for days in spans.values() for d in days}
    out = set()
    for loc, days in spans.items():
        low, high = (min(days), max(days)) if own else (min(every), max(every))
        day = date.fromisoformat(low)
        while str(day) <= high:
            for hour in range(24):
                skipped = str(day) == "2026-10-04" and hour == 2
                if not skipped and (loc, str(day), hour) not in keys:
                    out.add((loc, str(day), hour))
            day += timedelta(days=1)
    return out


def test_gaps_match_the_direct_grid(spark):
    rng = random.Random(3)
    rows = [
        (loc, str(date(2026, 10, 1) + timedelta(days=rng.randrange(loc + 1))), rng.randrange(24), 1)
        for loc in range(6) for _ in range(40)
    ]
    df = grain(spark, rows)
    for own, listed in ((False, quality.gaps_global(df)), (True, quality.gaps_own_range(df))):
        found = {(r.location_id, str(r.sensing_date), r.hourday) for r in listed.collect()}
        assert found == direct_gaps(rows, own)
    assert quality.zero_outage_counts(df).first().gaps == len(direct_gaps(rows, False))
    assert quality.continuity_counts(df).first().gaps == len(direct_gaps(rows, True))
    sample = quality.timestamp_continuity(df).first().sample_rows
    first = sorted(direct_gaps(rows, True))[:5]
    assert [tuple(json.loads(r).values()) for r in sample] == first


def test_all_checks_in_order_and_on_nothing(spark):
    df = with_observed_at(counts(spark, ZEROS_GAPS))
    names = ["sensor_churn", "zero_versus_outage", "duplicate_records", "timestamp_continuity", "sensor_relocation"]
    found = quality.run_all_checks(df, sensors(spark, [(52, -37.8, 144.9)])).collect()
    assert [r.name for r in found] == names
    empty = quality.run_all_checks(df.limit(0)).collect()
    assert [(r.name, r.passed, r.count_affected) for r in empty] == [(n, True, 0) for n in names]


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 24), (None, "c", -1), (None, "d", None)],
                               "location_id int, sensing_date string, hourday int")
    assert [(r.location_id, r.n_rows) for r in constraints.repeated_values(df, "location_id").collect()] == [(1, 2)]
    assert constraints.repeated_keys(df, ["location_id"]).count() == 2
    assert {r.hourday for r in constraints.hours_out_of_range(df).collect()} == {24, -1}
    nulls = {r.column_name: r.null_rows for r in constraints.null_counts(df, "t", ["location_id", "hourday"]).collect()}
    assert nulls == {"location_id": 2, "hourday": 1}
    parents = spark.createDataFrame([(2,)], "location_id int")
    assert [r.location_id for r in constraints.missing_parents(df, parents, "location_id").collect()] == [1]
    assert constraints.row_counts_differ(df, df).isEmpty()
    assert constraints.row_counts_differ(df, df.limit(1)).first().staged_rows == 4


def test_freshness_limits(spark):
    from datetime import datetime

    df = spark.createDataFrame([(datetime(2026, 1, 1),)], "t timestamp_ntz").select(
        F.col("t").cast("timestamp").alias("observed_at"))
    for hours, status in ((36, "pass"), (37, "warn"), (72, "warn"), (73, "error")):
        now = datetime(2026, 1, 1) + timedelta(hours=hours)
        assert constraints.freshness(df, now).first().status == status
    assert constraints.freshness(df.limit(0), datetime(2026, 1, 1)).first().status == "error"


def test_words_that_are_no_numbers_are_never_cast(spark):
    numbers = ["1", "-7", " 12\t", "12.", ".5", "+1.e-5", "1d", "0x1.8p1", "nan", "-Infinity", "INF", "9223372036854775808"]
    words = ["word", "nano", "infix", "e5", "1_000", "2024-01-02", "1e", "1.2.3", "-", "\u0663", "\u0130nf", ""]
    df = spark.createDataFrame([(w,) for w in [*numbers, *words, "true", None]], "w string")
    word = F.col("w")
    assert {r.w for r in df.where(word.rlike(profiling.NUMBER)).collect()} == set(numbers)
    assert df.where(~word.rlike(profiling.NUMBER) & (word.try_cast("bigint").isNotNull() | word.try_cast("double").isNotNull())).isEmpty()
    assert {r.value_type: r.n for r in profiling.value_types(df, "w").collect()} == {"int": 3, "float": 9, "str": 12, "bool": 1, "null": 1}
