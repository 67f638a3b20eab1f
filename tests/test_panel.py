import random
from datetime import date

from panel_rows import counts, plan_of, sensors
import pytest
from pyspark.sql import functions as F

from hourpanel.operators import calendar, export, panel, profiling, spatial, staging
from hourpanel.operators.learner import LearnerParams
from hourpanel.plans import stages
from hourpanel.sources import ingest, schemas, sinks
from hourpanel.sources.ingest import Window


def days(spark, *texts):
    return spark.createDataFrame([(date.fromisoformat(t),) for t in texts], "sensing_date date")


def terms(spark, rows):
    df = spark.createDataFrame(
        [(2026, t, date.fromisoformat(a), date.fromisoformat(b), "VIC", "") for t, a, b in rows],
        schemas.TERMS.schema)
    return staging.stage_terms(ingest.stamp(df))


def events(spark, rows):
    df = spark.createDataFrame(
        [(i, n, "v", date.fromisoformat(a), date.fromisoformat(b), None) for i, n, a, b in rows],
        schemas.EVENTS.schema).withColumn("year", F.year("start_date"))
    return staging.stage_events(ingest.stamp(df))


def holidays(spark, rows):
    df = spark.createDataFrame([(date.fromisoformat(d), n) for d, n in rows], schemas.HOLIDAYS.schema)
    return staging.stage_holidays(ingest.stamp(df))


def test_overlapping_terms_have_no_single_term(spark):
    t = terms(spark, [(1, "2026-01-01", "2026-01-10"), (2, "2026-01-10", "2026-03-01"), (1, "2025-12-01", "2026-01-02")])
    out = {str(r.sensing_date): (r.school_term_count, r.school_term) for r in
           calendar.terms_by_day(t, days(spark, "2026-01-01", "2026-01-10", "2026-01-11", "2026-04-01")).collect()}
    assert out == {"2026-01-01": (1, 1), "2026-01-10": (2, None), "2026-01-11": (1, 2)}


def test_events_by_day_lists_distinct_names_in_order(spark):
    e = events(spark, [("a", "Zeta", "2026-01-01", "2026-01-03"), ("b", "Alpha", "2026-01-02", "2026-01-02"), ("c", "Alpha", "2026-01-02", "9999-12-31")])
    out = {str(r.sensing_date): (r.event_count, r.event_names) for r in
           calendar.events_by_day(e, days(spark, "2026-01-01", "2026-01-02", "2026-01-04")).collect()}
    assert out == {"2026-01-01": (1, "Zeta"), "2026-01-02": (3, "Alpha, Zeta"), "2026-01-04": (1, "Alpha")}


def test_holiday_names_keep_repeats_in_name_order(spark):
    h = holidays(spark, [("2026-01-01", "a b"), ("2026-01-01", "a"), ("2026-01-01", "a"), ("2026-01-26", "x")])
    out = {str(r.sensing_date): r.holiday_name for r in calendar.holidays_by_day(h).collect()}
    assert out == {"2026-01-01": "a, a, a b", "2026-01-26": "x"}


def test_interval_join_is_an_equi_join(spark):
    plan = plan_of(calendar.explode_intervals(terms(spark, [(1, "2026-01-01", "2026-01-10")]), days(spark, "2026-01-01"), "sensing_date"))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def brute_nearest(sensor_rows, block_rows):
    out = {}
    for loc, lat, lon in sensor_rows:
        if lat is None or lon is None:
            continue
        out[loc] = min(((lat - a) * (lat - a) + (lon - b) * (lon - b), block, area) for block, area, a, b in block_rows)
    return out


def test_nearest_block_equals_brute_force(spark):
    rng = random.Random(7)
    # A dense cluster, copies of one point, a grid with ties, and far outliers.
    blocks = [(f"c{i}", "A", rng.gauss(0, 0.01), rng.gauss(0, 0.01)) for i in range(300)]
    blocks += [(f"d{i}", "B", 1.0, 1.0) for i in range(20)]
    blocks += [(f"g{i}-{j}", "C", float(i), float(j)) for i in range(-3, 4) for j in range(-3, 4)]
    blocks += [("far", "D", 500.0, -700.0)]
    rows = [(i, rng.gauss(0, 2), rng.gauss(0, 2)) for i in range(300)]
    rows += [(400 + i, rng.randrange(-4, 4) + 0.5, rng.randrange(-4, 4) + 0.5) for i in range(40)]
    rows += [(500, 1e4, 1e4), (501, None, 1.0), (502, 1.0, 1.0)]
    s = spark.createDataFrame(rows, "location_id int, latitude double, longitude double")
    b = spark.createDataFrame(blocks, "block_id string, clue_small_area string, latitude double, longitude double")
    expected = brute_nearest(rows, blocks)
    for size, operators in ((1, [spatial.nearest_block]), (32, [spatial.nearest_block, spatial.nearest_block_ranked]), (1000, [spatial.nearest_block])):
        for operator in operators:
            found = {r.location_id: (r.distance_sq, r.block_id, r.clue_small_area) for r in operator(s, b, size).collect()}
            assert found == expected
    assert spatial.nearest_block(s, b.limit(0)).collect() == []
    pairs = spatial.block_candidates(s, b, 8)
    assert pairs.count() < len(rows) * len(blocks) / 10
    assert "NestedLoop" not in plan_of(pairs) and "CartesianProduct" not in plan_of(pairs)


@pytest.mark.parametrize("clustered", [False, True])
def test_candidates_do_not_grow_with_the_blocks(spark, clustered):
    def points(n, seed):
        spread = F.pow(F.lit(10.0), -4 * F.rand(seed + 2)) if clustered else F.lit(1.0)
        base = F.floor(F.rand(seed + 3) * 5) if clustered else F.lit(0.0)
        return spark.range(n).select(
            F.col("id"), (base + spread * F.randn(seed)).alias("latitude") if clustered else F.rand(seed).alias("latitude"),
            (base * 2 + spread * F.randn(seed + 1)).alias("longitude") if clustered else F.rand(seed + 1).alias("longitude"))

    sensors_ = points(300, 50).withColumnRenamed("id", "location_id")
    per_sensor = []
    for n in (4_000, 256_000):
        blocks = points(n, 7).select(F.col("id").cast("string").alias("block_id"), F.lit("A").alias("clue_small_area"), "latitude", "longitude")
        per_sensor.append(spatial.block_candidates(sensors_, blocks).count() / 300)
    assert per_sensor[1] < 2 * per_sensor[0] and per_sensor[1] < 16 * spatial.CELL_BLOCKS


def staged_sample(spark, weather_rows=None, sensor_rows=None):
    c = ingest.stamp(ingest.with_observed_at(counts(spark, [
        (1, "2026-08-01", 9, 10), (2, "2026-08-01", 9, 5), (3, "2026-08-01", 9, 7), (9, "2026-08-01", 9, 100),
        (1, "2026-08-01", 10, 1), (1, "2026-08-02", 9, 4)])))
    w = spark.createDataFrame(
        weather_rows or [("2026-08-01T09:00", 8.0, 0.1, 0.2, 3.0, 4), ("2026-08-02T09:00", 9.0, 0.0, 0.0, 1.0, 2)],
        "time string, temperature_2m double, precipitation double, rain double, wind_speed_10m double, cloud_cover bigint")
    w = w.withColumn("time", ingest.parse_instant(F.col("time")))
    a = spark.createDataFrame(
        [("2024", "b1", "North", 0.0, 0.0), ("2024", "b1", "North", 0.0, 2.0), ("2024", "b2", "South", 10.0, 10.0),
         ("2023", "b3", "Old", 0.0, 0.9), ("2024", "b4", "Null", None, 1.0)],
        "census_year string, block_id string, clue_small_area string, latitude double, longitude double")
    s = sensors(spark, sensor_rows or [(1, 0.0, 1.0), (2, 0.5, 1.0), (3, 9.0, 9.0), (4, 1.0, 1.0)])
    return stages.Staged(
        counts=staging.stage_counts(c), sensors=staging.stage_sensors(ingest.stamp(s)),
        weather=staging.stage_weather(ingest.stamp(w)),
        holidays=holidays(spark, [("2026-08-01", "Day")]),
        terms=terms(spark, [(3, "2026-07-01", "2026-08-01")]),
        events=events(spark, [("e", "Fair", "2026-08-02", "2026-08-02")]),
        blocks=staging.block_centroids(a))


def test_centroids_use_located_rows_of_the_census_year(spark):
    out = {r.block_id: (r.latitude, r.longitude, r.address_count) for r in staged_sample(spark).blocks.collect()}
    assert out == {"b1": (0.0, 1.0, 2), "b2": (10.0, 10.0, 1)}


def test_mart_values(spark):
    mart = {(r.precinct, str(r.sensing_date), r.hourday): r for r in stages.build_mart(staged_sample(spark)).collect()}
    assert set(mart) == {("North", "2026-08-01", 9), ("South", "2026-08-01", 9), ("North", "2026-08-01", 10), ("North", "2026-08-02", 9)}
    row = mart["North", "2026-08-01", 9]
    assert (row.pedestriancount, row.sensor_count, row.temperature_2m, row.holiday_name) == (15, 2, 8.0, "Day")
    assert (row.is_public_holiday, row.school_term, row.is_event_day, row.event_count) == (True, 3, False, 0)
    assert mart["North", "2026-08-01", 10].temperature_2m is None
    late = mart["North", "2026-08-02", 9]
    assert (late.is_public_holiday, late.is_school_term, late.event_names) == (False, False, "Fair")


def same_marts(spark, staged):
    wide = stages.build_location_hour(staged)
    a = panel.precinct_hour(wide, stages.block_map(staged))
    b = stages.build_mart(staged)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and not a.isEmpty()
    return a


def test_both_marts_agree(spark):
    same_marts(spark, staged_sample(spark))


def test_both_marts_agree_on_repeated_weather_and_sensor_keys(spark):
    twice = [("2026-08-01T09:00", 8.0, 0.1, 0.2, 3.0, 4), ("2026-08-01T09:00", 7.0, 0.3, 0.2, 3.0, 4)]
    staged = staged_sample(spark, twice, [(1, 0.0, 1.0), (1, 0.0, 1.0), (2, 0.5, 1.0), (3, 9.0, 9.0)])
    mart = same_marts(spark, staged)
    row = mart.filter("precinct = 'North' and hourday = 9 and sensing_date = '2026-08-01'").first()
    assert row.pedestriancount == (10 * 2 + 5) * 2


def test_location_hour_keeps_every_count(spark):
    staged = staged_sample(spark)
    wide = stages.build_location_hour(staged)
    assert wide.count() == staged.counts.count() and len(wide.columns) == 29
    assert wide.filter("location_id = 9").first().latitude is None


def test_dense_rank_equals_the_direct_one(spark):
    rng = random.Random(1)
    values = [float(rng.randrange(60)) for _ in range(200)] + [None, None]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    order = {v: i + 1 for i, v in enumerate(sorted({v for v in values if v is not None}, reverse=True))}
    for buckets in (2, 7, 256):
        out = {r.id: r.rank for r in export.dense_rank(df, "v", "rank", buckets).collect()}
        assert out == {i: order.get(v) for i, v in enumerate(values)}


def test_index_and_rank(spark):
    rows = [("A", 0, 10), ("A", 1, 30), ("B", 0, 0), ("B", 1, 0), ("C", 0, None)]
    df = spark.createDataFrame(rows, "precinct string, hourday int, pedestriancount bigint")
    out = {(r.precinct, r.hourday): (r.precinct_hourly_index, r.precinct_rank) for r in export.series_hour_means(df).collect()}
    assert out == {("A", 0): (0.5, 1), ("A", 1): (1.5, 1), ("B", 0): (None, 2), ("B", 1): (None, 2), ("C", 0): (None, None)}


def test_export_without_predictions_or_scores(spark):
    mart = spark.createDataFrame([("A", date(2026, 8, 1), 10, 100)], "precinct string, sensing_date date, hourday int, pedestriancount bigint")
    row = export.export_wide(mart).first()
    assert (row.precinct_hourly_index, row.precinct_rank) == (1.0, 1)
    for name in ("baseline_pred", "lgbm_pred", "lag_24h", "mase_baseline", "mase_lgbm_precinct", "baseline_error", "lgbm_error"):
        assert row[name] is None


def test_profile(spark):
    df = counts(spark, [(67, "2026-08-01", 9, 0), (67, "2026-08-01", 9, None), (68, "2026-08-01", 9, 3)])
    assert profiling.profile_counts(df).first().asDict() == {
        "n_rows": 3, "distinct_series": 2, "zero_rows": 1, "null_rows": 1, "duplicate_groups": 1}
    assert {(r.location_id, r.n) for r in profiling.watched_rows(df).collect()} == {(67, 2), (68, 1)}
    assert [r.n for r in profiling.top_groups(df, ["location_id"], 1).collect()] == [2]
    assert [r.hourday for r in profiling.first_examples(df, "hourday", 2).collect()] == [9, 9]


def test_landed_trees_to_export(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    today, window = date(2026, 9, 1), Window(date(2026, 8, 1), date(2026, 8, 4))
    rows = [(loc, f"2026-08-0{d}", h, loc * 10 + h + d) for loc in (1, 2, 3) for d in range(1, 5) for h in range(24)]
    weather = spark.createDataFrame(
        [(f"2026-08-0{d}T{h:02d}:00", 8.0, 0.1, 0.2, 3.0, 4) for d in range(1, 5) for h in range(24)],
        "time string, temperature_2m double, precipitation double, rain double, wind_speed_10m double, cloud_cover bigint")
    address = spark.createDataFrame(
        [("2024", "b1", "p", "p", "North", "t", "a", "1", "x", 1.0, 0.0, None), ("2024", "b2", "p", "p", "South", "t", "a", "1", "x", 10.0, 10.0, None)],
        schemas.ADDRESSES.schema)
    frames = {
        schemas.COUNTS.name: counts(spark, rows),
        schemas.SENSORS.name: sensors(spark, [(1, 0.0, 1.0), (2, 0.5, 1.0), (3, 9.0, 9.0)]),
        schemas.WEATHER.name: weather,
        schemas.HOLIDAYS.name: spark.createDataFrame([(date(2026, 8, 2), "Day")], schemas.HOLIDAYS.schema),
        schemas.ADDRESSES.name: address,
    }
    audit = stages.ingest_all(spark, frames, raw, window, today)
    assert [(r.source, r.rows_written) for r in audit.collect()] == [
        (schemas.COUNTS.name, 288), (schemas.SENSORS.name, 3), (schemas.WEATHER.name, 96),
        (schemas.HOLIDAYS.name, 1), (schemas.ADDRESSES.name, 2)]
    one_day = stages.landed(spark, raw, schemas.COUNTS, Window(date(2026, 8, 2), date(2026, 8, 2)))
    assert one_day.count() == 72 and "part_day" in plan_of(one_day).split("PartitionFilters", 1)[1]
    checks = {r.name: r.passed for r in stages.check_landed(spark, raw).collect()}
    assert checks == {"sensor_churn": True, "zero_versus_outage": True, "duplicate_records": True,
                      "timestamp_continuity": True, "sensor_relocation": False}
    wide = stages.run(spark, raw, out, LearnerParams(trees=2, depth=2))
    assert wide.count() == 2 * 4 * 24 and len(wide.columns) == 29
    assert wide.filter("lgbm_pred is not null").count() == 2 * 3 * 24
    assert wide.filter("mase_baseline is null or mase_lgbm is null").isEmpty()
    folds = spark.read.json(f"{out}/metrics/folds")
    assert folds.count() == 3
    pooled, by_series = stages.read_scores(spark, f"{out}/metrics")
    assert pooled.first().note is None and pooled.first().seasonality_hours == 24
    assert by_series.count() == 2
    assert wide.filter("is_public_holiday").select("sensing_date").distinct().count() == 1


def test_one_date_leaves_a_note(spark):
    frame = spark.createDataFrame(
        [("A", date(2026, 1, 1), 0, 1, 1.0)], "precinct string, sensing_date date, hourday int, pedestriancount bigint, baseline_pred double")
    scores = stages.evaluate(frame)
    assert scores.pooled.first().note == stages.TOO_FEW_DATES
    assert scores.folds.isEmpty()


def test_thinned_folds_score_as_in_the_full_run(spark):
    rows = [(a, date(2026, 1, d), h, (d * 37 + h * 11 + len(a) * d * h) % 50, float((d * 5 + h) % 50))
            for a in ("A", "BB") for d in range(1, 9) for h in range(24)]
    frame = spark.createDataFrame(rows, "precinct string, sensing_date date, hourday int, pedestriancount bigint, baseline_pred double")
    every = {r.test_date: r for r in stages.evaluate(frame).folds.collect()}
    tested = frame.filter("day(sensing_date) in (2, 5, 8)")
    thinned = stages.evaluate(tested, frame)
    got = {r.test_date: r for r in thinned.folds.collect()}
    assert sorted(d.day for d in got) == [2, 5, 8]
    for day, row in got.items():
        assert (row.train_rows, row.test_rows) == (every[day].train_rows, every[day].test_rows)
        assert abs(row.mase_baseline - every[day].mase_baseline) < 1e-12
    masked = frame.selectExpr("precinct", "sensing_date", "hourday", "pedestriancount", "case when day(sensing_date) in (2, 5, 8) then baseline_pred end baseline_pred")
    assert abs(thinned.pooled.first().mase_baseline - stages.evaluate(masked).pooled.first().mase_baseline) < 1e-12


def test_mart_as_a_catalog_table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS marts LOCATION '{tmp_path}/marts'")
    df = stages.build_mart(staged_sample(spark))
    for _ in range(2):
        assert sinks.save_mart(df, "marts.mart_precinct_hour").count() == 4
    spark.sql("DROP DATABASE marts CASCADE")
