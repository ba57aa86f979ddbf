import pytest

from tallymill.operators import links


@pytest.fixture
def edges(spark):
    return spark.createDataFrame([(0, 1), (0, 1), (0, 2), (3, 0)], "src int, dst int")


def test_degrees_count_distinct_neighbours(edges):
    assert [tuple(r) for r in links.out_degree(edges).collect()] == [(0, 2), (3, 1)]
    assert [tuple(r) for r in links.in_degree(edges).collect()] == [(0, 1), (1, 1), (2, 1)]


def test_links_keep_duplicates(edges, rows):
    assert rows(links.node_links(edges, 0)) == [("in", 3), ("out", 1), ("out", 1), ("out", 2)]


def test_self_link_goes_both_ways(spark, rows):
    loop = spark.createDataFrame([(5, 5), (5, 6)], "src int, dst int")
    assert rows(links.node_links(loop, 5)) == [("in", 5), ("out", 5), ("out", 6)]


def test_nodes(edges, rows):
    assert rows(links.graph_nodes(edges)) == [(0,), (1,), (2,), (3,)]


def test_degree_sums_agree(spark, edges):
    more = edges.union(spark.range(50).selectExpr("cast(id % 7 as int)", "cast(id % 11 as int)"))
    distinct = more.distinct().count()
    assert sum(r.degree for r in links.out_degree(more).collect()) == distinct
    assert sum(r.degree for r in links.in_degree(more).collect()) == distinct
