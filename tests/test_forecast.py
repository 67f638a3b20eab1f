import math
import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from panel_rows import plan_of
from pyspark.sql import functions as F

from hourpanel.functions.wallclock import localize, wall_clock
from hourpanel.operators import boosting, features, learner, metrics
from hourpanel.operators.learner import LearnerParams

PANEL = "precinct string, sensing_date date, hourday int, pedestriancount double, baseline_pred double"


def panel(spark, rows):
    return spark.createDataFrame(rows, PANEL)


def test_lag_is_the_same_hour_of_the_day_before(spark):
    rows = [("A", date(2026, 8, 1 + d), h, d * 100 + h) for d in (0, 1) for h in (9, 10)]
    df = spark.createDataFrame(rows, "precinct string, sensing_date date, hourday int, pedestriancount bigint")
    df = df.withColumn("observed_at", localize(wall_clock(F.col("sensing_date"), F.col("hourday"))))
    for wall in (False, True):
        out = features.add_lag(df, wall=wall).filter("sensing_date = '2026-08-02'").orderBy("hourday")
        assert [r.lag_24h for r in out.collect()] == [9.0, 10.0]
    matrix = features.feature_matrix(df)
    assert {r.day_of_week for r in matrix.collect()} == {5, 6}
    assert features.feature_summary(matrix).first().rows == 4


def test_rows_without_an_instant_get_no_lag_and_stay_single(spark):
    rows = [("A", date(2026, 4, 4), 2, 1), ("A", date(2026, 4, 5), 2, 5), ("A", date(2026, 4, 6), 2, 7), ("A", date(2027, 4, 4), 2, 9)]
    df = spark.createDataFrame(rows, "precinct string, sensing_date date, hourday int, pedestriancount bigint")
    df = df.withColumn("observed_at", localize(wall_clock(F.col("sensing_date"), F.col("hourday"))))
    assert df.filter("observed_at is null").count() == 2
    out = features.add_lag(df)
    assert out.count() == 4 and out.filter("lag_24h is not null").isEmpty()


def test_elapsed_and_wall_shift_differ_over_the_clock_change(spark):
    rows = [("A", date(2026, 4, 4), 12, 1), ("A", date(2026, 4, 4), 13, 2), ("A", date(2026, 4, 5), 12, 3)]
    df = spark.createDataFrame(rows, "precinct string, sensing_date date, hourday int, pedestriancount bigint")
    df = df.withColumn("observed_at", localize(wall_clock(F.col("sensing_date"), F.col("hourday"))))
    later = F.col("sensing_date") == F.lit(date(2026, 4, 5))
    assert features.add_lag(df).filter(later).first().lag_24h == 2.0
    assert features.add_lag(df, wall=True).filter(later).first().lag_24h == 1.0


TRAIN = [("A", date(2026, 8, 1), h, float(h), float(max(h - 1, 0))) for h in range(4)]


def test_scale_and_plain_mase(spark):
    assert metrics.series_scale(panel(spark, TRAIN), season=1).first().scale == 1.0
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0), (2.0, 2.0), (3.0, 2.0), (None, 1.0), (1.0, float("inf"))], "y double, p double")
    assert metrics.mase(df, "y", "p", F.lit(1.0)).first().mase == 0.5
    assert metrics.mase(df, "y", "p", F.lit(0.0)).first().mase is None
    assert metrics.mase(df.limit(0), "y", "p", F.lit(1.0)).first().mase is None


def test_panel_mase_uses_the_training_scale(spark):
    test = panel(spark, [("A", date(2026, 8, 2), 0, 2.0, 1.0), ("B", date(2026, 8, 2), 0, 2.0, 1.0)])
    train = panel(spark, TRAIN)
    assert metrics.panel_mase(test, train, "baseline_pred", season=1).first().mase == 1.0
    assert [(r.precinct, r.mase) for r in metrics.mase_by_series(test, train, "baseline_pred", season=1).collect()] == [("A", 1.0)]


def test_effective_season(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (24,), (25,), (90,)], "n int")
    assert [r[0] for r in df.select(metrics.effective_season(F.col("n"))).collect()] == [0, 0, 1, 23, 24, 24]


def direct_scale(values, season=24):
    n = len(values)
    m = 0 if n <= 1 else min(season, n - 1)
    if m == 0:
        return None
    diffs = [None if a is None or b is None else abs(b - a) for a, b in zip(values, values[m:])]
    if not diffs or None in diffs:
        return None
    scale = sum(diffs) / len(diffs)
    return scale or None


def random_panel(seed):
    rng = random.Random(seed)
    rows = []
    for s in range(8):
        per_day = rng.choice([1, 3, 9, 24])
        holes = rng.random() < 0.5
        for d in range(12):
            for h in sorted(rng.sample(range(24), per_day)):
                if rng.random() < 0.2:
                    continue
                y = None if holes and rng.random() < 0.02 else float(rng.randrange(5))
                p = None if rng.random() < 0.3 else float(rng.randrange(5))
                rows.append((f"s{s}", date(2026, 1, 1) + timedelta(days=d), h, y, p))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fold_scales_equal_the_direct_definition_of_every_prefix(spark, seed):
    rows = random_panel(seed)
    found = {(r.precinct, r.sensing_date): (r.train_rows, r.scale) for r in metrics.fold_scale(panel(spark, rows)).collect()}
    assert set(found) == {(r[0], r[1]) for r in rows}
    for (series, day), (n, scale) in found.items():
        prefix = [r[3] for r in sorted((r for r in rows if r[0] == series and r[1] < day), key=lambda r: (r[1], r[2]))]
        expected = direct_scale(prefix)
        assert n == len(prefix)
        assert (scale is None) == (expected is None)
        assert scale is None or math.isclose(scale, expected, rel_tol=1e-9)


def direct_panel_mase(test, train):
    numerator = denominator = 0.0
    for series in {r[0] for r in test}:
        values = [r[3] for r in sorted((r for r in train if r[0] == series), key=lambda r: (r[1], r[2]))]
        scale = direct_scale(values)
        pairs = [(r[3], r[4]) for r in test if r[0] == series and r[3] is not None and r[4] is not None]
        if scale and pairs:
            numerator += sum(abs(y - p) for y, p in pairs)
            denominator += scale * len(pairs)
    return numerator / denominator if denominator else None


@pytest.mark.parametrize("seed", [4, 5])
def test_rolling_and_pooled_scores_equal_the_direct_loops(spark, seed):
    rows = random_panel(seed)
    df = panel(spark, rows)
    days = sorted({r[1] for r in rows})
    folds = {r.test_date: r for r in metrics.rolling_origin(df, {"m": "baseline_pred"}).collect()}
    assert sorted(folds) == days[1:]
    assert sorted(r[0] for r in metrics.rolling_origins(df).collect()) == days[1:]
    for day, row in folds.items():
        train = [r for r in rows if r[1] < day]
        test = [r for r in rows if r[1] == day]
        expected = direct_panel_mase(test, train)
        assert (row.train_rows, row.test_rows) == (len(train), len(test))
        assert row.m == pytest.approx(expected) if expected is not None else row.m is None
    test, train = [r for r in rows if r[1] > days[0]], [r for r in rows if r[1] < days[-1]]
    assert metrics.pooled_mase(df, {"m": "baseline_pred"}).first().m == pytest.approx(direct_panel_mase(test, train))
    by_series = {r.precinct: r.m for r in metrics.pooled_by_series(df, {"m": "baseline_pred"}).collect()}
    for series in {r[0] for r in rows}:
        expected = direct_panel_mase([r for r in test if r[0] == series], train)
        assert by_series.get(series) == (pytest.approx(expected) if expected is not None else None)


def test_one_date_gives_no_folds_and_null_scores(spark):
    df = panel(spark, TRAIN)
    assert metrics.rolling_origin(df, {"m": "baseline_pred"}).isEmpty()
    assert metrics.pooled_mase(df, {"m": "baseline_pred"}).first().m is None


@pytest.mark.parametrize("block_rows", [1, 30, 4096])
def test_difference_does_not_depend_on_the_block_size(spark, block_rows):
    rows = random_panel(6)
    out = metrics.seasonal_difference(panel(spark, rows), block_rows=block_rows).collect()
    assert len(out) == len(rows)
    for series in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == series), key=lambda r: (r[1], r[2]))
        found = sorted((r for r in out if r.precinct == series), key=lambda r: r.position)
        assert [r.position for r in found] == list(range(1, len(ordered) + 1))
        for i, r in enumerate(found):
            now, before = ordered[i][3], ordered[i - 24][3] if i >= 24 else None
            assert r.seasonal_diff == (None if now is None or before is None else abs(now - before))


def matrix(spark, days=6):
    start = datetime(2026, 1, 1)
    rows = []
    for s in ("A", "B"):
        for i in range(days * 24):
            at = start + timedelta(hours=i)
            lag = float((i - 24) % 24) if i >= 24 else None
            rows.append((s, at.date(), at.hour, (i % 24) + (5 if s == "B" else 0), at.weekday(), 20.0, None, lag, i % 2 == 0))
    df = spark.createDataFrame(
        rows, "precinct string, sensing_date date, hourday int, pedestriancount bigint, day_of_week int, "
        "temperature_2m double, rain double, lag_24h double, is_event_day boolean")
    null = F.lit(None).cast("double")
    return df.withColumns({
        "precipitation": null, "wind_speed_10m": null, "cloud_cover": null, "sensor_count": F.lit(1),
        "is_public_holiday": F.lit(None).cast("boolean"), "is_school_term": F.lit(False)})


SMALL = LearnerParams(trees=3, depth=3, min_leaf=5)


def test_learner_skips_empty_columns_and_incomplete_rows(spark, tmp_path):
    df = matrix(spark)
    numbers = learner.flags_as_numbers(df)
    assert features.usable_features(numbers)[:4] == ["precinct", "hourday", "day_of_week", "temperature_2m"]
    assert "rain" not in features.usable_features(numbers)
    path = str(tmp_path / "model")
    out, model = learner.train_and_predict(df, params=SMALL, model_path=path)
    assert model is not None and out.count() == df.count()
    assert out.filter("lag_24h is null and lgbm_pred is not null").isEmpty()
    assert out.filter("lag_24h is not null and lgbm_pred is null").isEmpty()
    summary = features.train_summary(out).first()
    assert (summary.rows, summary.rows_with_baseline, summary.rows_with_lgbm) == (288, 240, 240)
    # Too little data: no model, and the old one goes.
    out, model = learner.train_and_predict(df.limit(5), params=SMALL, model_path=path)
    assert model is None and not (tmp_path / "model").exists()
    assert out.filter("lgbm_pred is not null").isEmpty()


def test_unseen_series_is_predicted_by_a_saved_model(spark, tmp_path):
    df = learner.flags_as_numbers(matrix(spark))
    path = str(tmp_path / "model")
    _, model = learner.train_and_predict(df.filter("precinct = 'A'"), params=SMALL, model_path=path)
    loaded = learner.Model.load(spark, path)
    assert loaded.trees == model.trees
    scored = learner.predict(loaded, df)
    assert scored.count() == df.count() and scored.columns == [*df.columns, "lgbm_pred"]
    assert scored.filter("lag_24h is not null and lgbm_pred is null").isEmpty()
    assert scored.filter("lag_24h is null and lgbm_pred is not null").isEmpty()


def boosted(x, y, params, start):
    """Boosting by its definition, row by row: bins x (rows, features), labels y; the prediction of every row."""
    predicted = np.full(len(y), start)

    def grow(rows, residual, depth):
        value = residual[rows].mean()
        best = (1e-9, None)
        if depth < params.depth:
            for k in range(x.shape[1]):
                for cut in range(params.bins):
                    left, right = rows[x[rows, k] <= cut], rows[x[rows, k] > cut]
                    if min(len(left), len(right)) >= params.min_leaf:
                        gain = residual[left].sum() ** 2 / len(left) + residual[right].sum() ** 2 / len(right) - residual[rows].sum() ** 2 / len(rows)
                        if gain > best[0] + 1e-9:
                            best = (gain, (left, right))
        if best[1] is None:
            predicted[rows] += params.rate * value
        else:
            for side in best[1]:
                grow(side, residual, depth + 1)

    for _ in range(params.trees):
        grow(np.arange(len(y)), y - predicted, 0)
    return predicted


def test_every_sample_is_boosted_as_if_alone(spark):
    rng = np.random.default_rng(3)
    params = boosting.BoostParams(trees=4, depth=3, bins=8, min_leaf=3)
    rows, samples = [], 5
    for i in range(300):
        a, b = rng.random(2).round(3).tolist()
        rows.append((i, float(10 * (a > 0.4) + 3 * b * (a > 0.7) + rng.random()), int(rng.integers(0, samples)), samples, -1, a, b if i % 7 else None))
    # predicted by the first sample that they do not train
    rows = [(r, y, first, stop, first - 1, a, b) for r, y, first, stop, _, a, b in rows]
    df = spark.createDataFrame(rows, "row long, label double, first int, stop int, test int, a double, b double").repartition(3)
    cuts = boosting.cut_points(df, ["a", "b"], params.bins)
    states, start, counts, trees = boosting.boost(boosting.blocks(df, ["a", "b"], cuts, samples), samples, 2, params, 1)
    got = {r.row: r.p for r in boosting.predictions(spark, states, counts > 0, "p").collect()}
    x = boosting.binned(np.array([[r[5], np.nan if r[6] is None else r[6]] for r in rows]), cuts)
    y = np.array([r[1] for r in rows])
    assert counts.tolist() == [sum(r[2] <= s for r in rows) for s in range(samples)]
    for s in range(samples):
        inside = np.array([r[2] <= s for r in rows])
        assert math.isclose(start[s], y[inside].mean(), rel_tol=1e-9)
        model = boosting.BoostedTrees.of(["a", "b"], cuts, start, trees, s)
        values = np.array([[r[5], np.nan if r[6] is None else r[6]] for r in rows])
        assert np.allclose(model.scored(values)[inside], boosted(x[inside], y[inside], params, start[s]), atol=1e-4)
        for r, p in zip(rows, model.scored(values)):
            if r[4] == s:
                assert math.isclose(got[r[0]], p, abs_tol=1e-9)


def test_number_of_jobs_does_not_depend_on_folds(spark):
    tracker = spark.sparkContext.statusTracker()

    def jobs(days):
        spark.sparkContext.setJobGroup(f"folds-{days}", "")
        learner.rolling_origin_predictions(matrix(spark, days=days), params=SMALL).count()
        return len(tracker.getJobIdsForGroup(f"folds-{days}"))

    try:
        assert jobs(8) <= jobs(4) + 2  # a table may take a job more to be read
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_every_fold_is_out_of_sample(spark):
    df = matrix(spark, days=4)
    out = learner.rolling_origin_predictions(df, params=SMALL)
    assert out.count() == 3 * 48
    assert out.filter("lgbm_pred is not null").select("sensing_date").distinct().count() >= 2
    thinned = learner.rolling_origin_predictions(df, params=SMALL, step_days=2, max_folds=1)
    assert thinned.select("sensing_date").distinct().count() == 1
    # values of a day or later do not reach the forecasts of that day
    last = F.col("sensing_date") >= F.lit(date(2026, 1, 4))
    spoiled = df.withColumn("pedestriancount", F.when(last, F.lit(10_000).cast("bigint")).otherwise(F.col("pedestriancount")))
    key = ["precinct", "sensing_date", "hourday"]
    was = {tuple(r[k] for k in key): r.lgbm_pred for r in out.collect()}
    now = {tuple(r[k] for k in key): r.lgbm_pred for r in learner.rolling_origin_predictions(spoiled, params=SMALL).collect()}
    assert set(was) == set(now) and all((a is None) == (now[k] is None) and (a is None or math.isclose(a, now[k], abs_tol=1e-2)) for k, a in was.items())


def test_position_windows_are_cut_inside_a_series(spark):
    text = plan_of(metrics.seasonal_difference(panel(spark, TRAIN)))
    assert "_block" in text and "windowspecdefinition(precinct" in text
