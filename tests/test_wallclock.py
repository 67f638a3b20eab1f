from datetime import date, datetime

from pyspark.sql import functions as F

from hourpanel.functions import wallclock as wc


def days(spark, *texts):
    return spark.createDataFrame([(date.fromisoformat(t),) for t in texts], "day date")


def test_kinds_at_two_o_clock(spark):
    df = days(spark, "2026-04-05", "2026-10-04", "2026-08-01")
    rows = df.select("day", wc.dst_kind(wc.wall_clock(F.col("day"), F.lit(2))).alias("k")).collect()
    assert {str(r.day): r.k for r in rows} == {
        "2026-04-05": "ambiguous", "2026-10-04": "nonexistent", "2026-08-01": "ok",
    }


def test_neighbouring_hours_are_ok(spark):
    df = days(spark, "2026-04-05", "2026-10-04").select("day", F.explode(F.array(F.lit(1), F.lit(3))).alias("h"))
    kinds = df.select(wc.dst_kind(wc.wall_clock(F.col("day"), F.col("h"))).alias("k"))
    assert {r.k for r in kinds.collect()} == {"ok"}


def test_localize_gives_null_without_one_instant(spark):
    df = days(spark, "2026-04-05", "2026-10-04", "2026-08-01")
    at = wc.localize(wc.wall_clock(F.col("day"), F.lit(2)))
    rows = df.select("day", wc.utc_wall(at).alias("u")).collect()
    assert {str(r.day): r.u for r in rows} == {
        "2026-04-05": None, "2026-10-04": None, "2026-08-01": datetime(2026, 7, 31, 16, 0),
    }


def test_expected_hours_of_transition_days(spark):
    df = days(spark, "2026-10-04", "2026-04-05", "2026-08-01")
    hours = {str(r.day): r.h for r in df.select("day", wc.expected_hours(F.col("day")).alias("h")).collect()}
    assert hours["2026-10-04"] == [h for h in range(24) if h != 2]
    assert hours["2026-04-05"] == list(range(24))
    assert hours["2026-08-01"] == list(range(24))


def test_round_trip_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(date(2026, 1, 15), 23), (date(1969, 6, 30), 5)], "day date, hour int")
    at = wc.localize(wc.wall_clock(F.col("day"), F.col("hour")))
    shown = df.select("day", "hour", wc.local_date(at).alias("d"), wc.local_hour(at).alias("h"))
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            for r in shown.collect():
                assert (r.day, r.hour) == (r.d, r.h)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text_with_and_without_offset(spark):
    df = spark.createDataFrame(
        [("2026-08-01T00:00",), ("2026-07-31T14:00:00Z",), ("2026-08-01T00:00+10:00",), ("junk",),
         ("2026-04-05T02:00",)], "t string",
    )
    seen = [r.u for r in df.select(wc.utc_wall(wc.parse_instant(F.col("t"))).alias("u")).collect()]
    assert seen == [datetime(2026, 7, 31, 14)] * 3 + [None, None]


def test_monday_is_zero(spark):
    row = days(spark, "2026-11-30").select(wc.day_of_week(F.col("day")).alias("d")).first()
    assert row.d == 0


def test_hours_outside_the_day_have_no_instant(spark):
    from pyspark.sql import functions as F

    from hourpanel.functions.wallclock import wall_clock

    rows = spark.sql("SELECT date'2026-01-01' AS d, explode(array(-1, 0, 23, 24)) AS h")
    out = rows.select("h", wall_clock(F.col("d"), F.col("h")).isNull().alias("none")).collect()
    assert {r["h"]: r["none"] for r in out} == {-1: True, 0: False, 23: False, 24: True}


def test_partition_folders_are_unescaped(spark, tmp_path):
    from hourpanel.sources.tree import Tree

    spark.createDataFrame([("a:b", 1), ("50%", 2), ("x y", 3)], "k string, n int").write.partitionBy("k").parquet(str(tmp_path / "t"))
    assert set(Tree(spark, str(tmp_path / "t")).parts("k")) == {"a:b", "50%", "x y"}


def test_typed_extremes(spark):
    from hourpanel.operators.profiling import profile_columns

    row = profile_columns(spark.range(1, 61).toDF("n")).first()
    assert (row["low"], row["high"]) == ("1", "60")
