import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tallymill.operators import columns


def power(spark, values):
    return spark.createDataFrame([(v,) for v in values], "g double")


def test_summary_counts_valid_values(spark, rows):
    assert rows(columns.column_summary(power(spark, [4.0, None, 2.0]), ["g"])) == [("g", 2.0, 4.0, 2)]


def test_summary_of_no_rows(spark, rows):
    assert rows(columns.column_summary(power(spark, []), ["g"])) == [("g", None, None, 0)]


def test_moments_use_the_sample_deviation(spark):
    row = columns.column_moments(power(spark, [4.0, None, 2.0]), ["g"]).first()
    assert (row["mean"], round(row["std"], 4)) == (3.0, 1.4142)


def test_normalize(spark):
    scaled = columns.minmax_normalize(power(spark, [4.0, None, 2.0]), ["g"]).collect()
    assert [r.g_norm for r in scaled] == [1.0, None, 0.0]


def test_normalize_constant_column_gives_null(spark):
    assert [r.g_norm for r in columns.minmax_normalize(power(spark, [5.0, 5.0]), ["g"]).collect()] == [None, None]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-1000, 1000), min_size=2, max_size=20, unique=True))
def test_normalized_values_span_the_unit_interval(spark, values):
    scaled = [r.g_norm for r in columns.minmax_normalize(power(spark, [float(v) for v in values]), ["g"]).collect()]
    assert min(scaled) == 0.0 and max(scaled) == 1.0


def test_one_scan_for_all_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1.0, 2.0)], "a double, b double").write.parquet(path)
    plan = columns.column_summary(spark.read.parquet(path), ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    with pytest.raises(Exception):
        columns.column_summary(spark.read.parquet(path), ["missing"]).collect()
