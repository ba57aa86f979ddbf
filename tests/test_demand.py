import datetime

import pytest

from tallymill.operators import demand, forest

MON, NEXT_MON, TUE = datetime.date(2016, 2, 1), datetime.date(2016, 2, 8), datetime.date(2016, 2, 2)


def hires(spark, data):
    return spark.createDataFrame(data, "zone int, day date, hour int, hires int")


def test_weekday_profile_averages_daily_sums(spark):
    df = hires(spark, [(1, MON, 8, 10), (2, MON, 9, 20), (1, NEXT_MON, 8, 50), (1, TUE, 8, 7)])
    assert [tuple(r) for r in demand.weekday_profile(df).collect()] == [(1, 40.0), (2, 7.0)]
    by_zone = [tuple(r) for r in demand.weekday_profile(df, by_zone=True).collect()]
    assert by_zone == [(1, 1, 30.0), (1, 2, 7.0), (2, 1, 20.0)]


def test_hour_profile(spark):
    df = hires(spark, [(1, MON, 8, 10), (2, MON, 8, 20), (1, TUE, 8, 50), (1, TUE, 9, 4)])
    assert [tuple(r) for r in demand.hour_profile(df).collect()] == [(8, 40.0), (9, 4.0)]
    assert [tuple(r) for r in demand.hour_profile(df, by_zone=True).collect()] == [(1, 8, 30.0), (1, 9, 4.0), (2, 8, 20.0)]


def test_rides_per_month_divides_by_days_present(spark):
    df = hires(spark, [(1, MON, 8, 10), (2, MON, 8, 20), (1, TUE, 8, 50)])
    assert [tuple(r) for r in demand.rides_per_month(df).collect()] == [(2, 40.0)]


def test_daily_hires_of_a_month(spark):
    df = hires(spark, [(1, MON, 8, 10), (2, MON, 9, 1), (1, datetime.date(2016, 3, 1), 8, 5)])
    assert [tuple(r) for r in demand.daily_hires(df, month=2).collect()] == [(MON, 11)]
    assert demand.daily_hires(df).count() == 2


def test_forecast_truncates_and_keeps_unseen_rows(spark):
    train = hires(spark, [(1, MON, 8, 2), (1, MON, 8, 3), (1, NEXT_MON, 8, 3)])
    test = spark.createDataFrame([(1, 1, MON, 8), (2, 1, TUE, 8)], "test_id int, zone int, day date, hour int")
    assert [tuple(r) for r in demand.profile_forecast(train, test).collect()] == [(1, 1, MON, 8, 2), (2, 1, TUE, 8, None)]


def test_date_slice(spark):
    df = hires(spark, [(14, MON, 8, 2), (14, MON, 8, 5), (14, MON, 11, 9), (14, TUE, 8, 9), (3, MON, 8, 9)])
    assert [tuple(r) for r in demand.date_slice_profile(df, "2016-02-01", 14, 10).collect()] == [(14, 8, 3)]


def test_zone_bounds_with_overall_box(spark, rows):
    df = spark.createDataFrame([(1, 0.0, 9.0, 5.0, 4.0), (2, 5.0, 9.0, 10.0, 0.0)], "zone int, left double, top double, right double, bottom double")
    got = {r.zone: (r.left, r.right, r.bottom, r.top) for r in demand.zone_bounds(df).collect()}
    assert got == {1: (0.0, 5.0, 4.0, 9.0), 2: (5.0, 10.0, 0.0, 9.0), None: (0.0, 10.0, 0.0, 9.0)}


def test_totals(spark):
    df = hires(spark, [(1, MON, 8, 10), (2, MON, 9, 20), (1, TUE, 8, 30)])
    row = demand.ride_totals(df).first()
    assert (row.total, row.per_day, row.per_hour) == (60, 30.0, 20.0)
    assert row.per_zone_hour == pytest.approx(60 / 2 / 48)


def test_counts_and_points(spark, rows):
    points = spark.createDataFrame([(1, MON, 0.5, 1.5), (1, TUE, 2.5, 3.5), (2, MON, 4.5, 5.5)], "zone int, day date, x double, y double")
    assert [tuple(r) for r in demand.rides_per_zone(points).collect()] == [(1, 2), (2, 1)]
    assert [tuple(r) for r in demand.rides_per_day(points).collect()] == [(MON, 2), (TUE, 1)]
    assert rows(demand.zone_points(points, 2)) == [(4.5, 5.5)]


@pytest.fixture(scope="module")
def labelled(spark):
    start = datetime.date(2016, 1, 4)
    data = [
        (zone, start + datetime.timedelta(days=d), hour, zone * 10 + (30 if 8 <= hour <= 18 else 0) - (15 if d % 7 > 4 else 0))
        for zone in range(1, 6) for d in range(28) for hour in range(24)
    ]
    return hires(spark, data)


def test_forest_beats_the_mean_and_repeats(spark, labelled):
    models = [forest.fit_forest(labelled, trees=9, depth=6, seed=4) for _ in range(2)]
    errors = [forest.forest_rmse(m, labelled).first().rmse for m in models]
    assert errors[0] == errors[1]
    assert errors[0] < labelled.selectExpr("stddev_pop(hires)").first()[0] / 2


def test_forest_takes_unseen_zones(spark, labelled):
    model = forest.fit_forest(labelled, trees=3, depth=4)
    test = spark.createDataFrame([(1, 99, MON, 8)], "test_id int, zone int, day date, hour int")
    row = forest.forest_forecast(model, test).first()
    assert isinstance(row.hires, int) and row.test_id == 1


def test_rectangles_without_a_zone_count_for_the_overall_box(spark):
    df = spark.createDataFrame([(1, 0.0, 9.0, 5.0, 4.0), (None, -3.0, 12.0, 1.0, 2.0)], "zone int, left double, top double, right double, bottom double")
    got = [(r.zone, r.left, r.right, r.bottom, r.top) for r in demand.zone_bounds(df).orderBy(demand.F.asc_nulls_last("zone")).collect()]
    assert got == [(1, 0.0, 5.0, 4.0, 9.0), (None, -3.0, 5.0, 2.0, 12.0)]


def test_predictions_by_joins_are_those_of_the_model(spark, labelled):
    model = forest.fit_forest(labelled, trees=7, depth=5, max_categories=6)
    index = forest.category_index(labelled, max_categories=6)
    maps = {(f, v): p for f, m in model.stages[1].categoryMaps.items() for v, p in m.items()}
    assert {(r.feature, r.value): r.place for r in index.collect()} == maps and {f for f, _ in maps} < {0, 1, 2, 3}
    test = labelled.union(hires(spark, [(99, MON, 8, 1), (2, datetime.date(2016, 7, 3), 23, 1)]))
    rows = forest.indexed_features(test.withColumn("test_id", demand.F.monotonically_increasing_id()), index)
    found = forest.predict_by_joins(forest.forest_nodes(spark, model), rows, trees=7, depth=5).toPandas()
    expected = model.transform(rows.drop("features")).select("zone", "day", "hour", "prediction").toPandas()
    keys = ["zone", "day", "hour"]
    assert len(found) == len(expected) == test.count()
    both = found.merge(expected, on=keys)
    assert (both.prediction_x - both.prediction_y).abs().max() < 1e-9


def test_the_forest_does_not_depend_on_shuffle_partitions(spark, labelled):
    setting, texts = "spark.sql.shuffle.partitions", []
    before = spark.conf.get(setting)
    for n in ("3", "8"):
        spark.conf.set(setting, n)
        try:
            texts.append(forest.fit_forest(labelled, trees=3, depth=4).stages[-1].toDebugString.split("\n", 1)[1])
        finally:
            spark.conf.set(setting, before)
    assert texts[0] == texts[1]


def test_errors_on_training_and_later_rows(spark, labelled):
    early, later = labelled.where("day < '2016-01-25'"), labelled.where("day >= '2016-01-25'")
    model = forest.fit_forest(early, trees=5, depth=6)
    got = {r.rows: (r.n, r.rmse) for r in forest.forest_scores(model, early, later).collect()}
    assert got["train"][0] == early.count() and got["later"][0] == later.count()
    assert got["train"][1] == pytest.approx(forest.forest_rmse(model, early).first().rmse)


def test_profile_error_leaves_out_unseen_rows(spark):
    train = hires(spark, [(1, MON, 8, 2), (1, MON, 8, 4)])
    test = hires(spark, [(1, NEXT_MON, 8, 5), (1, NEXT_MON, 8, 1), (1, TUE, 8, 9)])
    assert tuple(demand.profile_rmse(train, test).first()) == (3, 2, 2.0)
