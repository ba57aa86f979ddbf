"""All queries against DuckDB on the smallest tables, and properties of plans and results."""

import re

import compare
import pytest

import __spark_entry__
from tallymill.plans import catalog, oracle, tables

FOLDER = str(compare.SF_ROOT / "sf0.001")
QUERIES = catalog.queries()
ORACLES = oracle.oracle_sql()
NO_ORACLE = {"forest_forecast", "forest_rmse", "forest_scores", "hire_files_forest"}

pytestmark = pytest.mark.skipif(not compare.SF_ROOT.exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_query_but_the_forest_has_an_oracle():
    assert set(QUERIES) - set(ORACLES) == NO_ORACLE and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_duckdb(spark, con, name):
    assert compare.differences(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(NO_ORACLE))
def test_forest_queries_return_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_forest_from_files_forecasts_what_the_tables_give(spark, rows):
    names = ["test_id", "zone", "day", "hour", "hires"]
    assert rows(QUERIES["hire_files_forest"](spark, FOLDER), *names) == rows(QUERIES["forest_forecast"](spark, FOLDER), *names)


def test_entry_registers_all_queries():
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["topic", "word", "n"]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - NO_ORACLE - {"minhash_signatures", "signature_coefficients", "article_file_signatures"}))
def test_no_python_worker_and_no_product_join(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_filters_and_columns_reach_the_scan(spark):
    plan = catalog.zone_points(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(label,5)" in plan
    plan = catalog.out_degree(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan and "Join" not in plan


def final_plan(df):
    """The executed plan of a query that has run, without the plans it started from."""
    df.collect()
    kept, skip = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        indent = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and indent > skip:
            continue
        skip = indent - 1 if "== Initial Plan ==" in line else None
        if skip is None:
            kept.append(line)
    return "\n".join(kept)


def test_cooccurrence_reads_the_corpus_twice(spark):
    assert final_plan(catalog.cooccurrence(spark, FOLDER)).count("FileScan") == 2


def test_bounds_of_all_columns_are_one_subquery(spark):
    assert final_plan(catalog.minmax_normalize(spark, FOLDER)).count("FileScan") == 2


def test_hot_keys_are_reduced_before_they_meet(spark):
    plan = catalog.out_degree(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(src#\d+L, dst#\d+L", plan)
    plan = catalog.top_words_by_topic(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit .* Partial", plan)


def test_test_and_training_days_prune_the_scan(spark):
    plan = catalog.profile_forecast(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts,2024-01-24T00:00)" in plan and "GreaterThanOrEqual(ts,2024-01-24T00:00)" in plan


def test_topics_add_up_to_the_total(spark):
    total = {r.word: r.n for r in catalog.word_count_total(spark, FOLDER).collect()}
    by_topic: dict = {}
    for r in catalog.word_count_by_topic(spark, FOLDER).collect():
        by_topic[r.word] = by_topic.get(r.word, 0) + r.n
    assert total == by_topic


def test_cooccurrence_is_symmetric(spark):
    cells = {(r.topic, r.word_a, r.word_b): r.n for r in catalog.cooccurrence(spark, FOLDER).collect()}
    assert all(cells[(t, b, a)] == n for (t, a, b), n in cells.items())


def test_similarity_of_the_target_is_one(spark):
    got = {r.user: r.similarity for r in catalog.user_similarity(spark, FOLDER).collect()}
    assert got[catalog.TARGET] == 1.0 and all(0 <= s <= 1 for s in got.values())


def test_small_tables_are_spread_over_the_cores(spark):
    spread = tables.load_spread(spark, FOLDER, "documents", "doc_id")
    assert spread.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
