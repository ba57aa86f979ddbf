import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tallymill.operators import scores, similarity


def ratings(spark, data):
    return spark.createDataFrame(data, "user int, item int, rating double")


DATA = [(1, 1, 4.0), (1, 2, 3.0), (2, 1, 4.0), (3, 3, 5.0)]


def test_sentiment(spark):
    df = spark.createDataFrame([("t", 0.2, 0.4), ("t", 0.0, 0.2), ("t", None, 1.0)], "topic string, a double, b double")
    row = scores.sentiment_by_topic(df, ["a", "b"]).first()
    assert row["sum"] == pytest.approx(0.4) and row["mean"] == pytest.approx(0.2)


def test_average_rating_leaves_out_unrated_items(spark):
    titles = spark.createDataFrame([(1, "one"), (2, "two"), (9, "nine")], "item int, title string")
    df = ratings(spark, [(1, 1, 4.0), (2, 1, 4.0), (1, 2, 3.0)])
    got = [tuple(r) for r in scores.average_rating(df, titles, "item", "rating", "title").collect()]
    assert got == [(1, "one", 4.0), (2, "two", 3.0)]


def test_user_similarity_lists_everyone(spark):
    got = [(r.user, round(r.similarity, 12)) for r in similarity.user_similarity(ratings(spark, DATA), 1, "user", "item", "rating").collect()]
    assert got == [(1, 1.0), (2, 0.8), (3, 0.0)]


def test_item_similarity(spark):
    got = {r.item: r.similarity for r in similarity.item_similarity(ratings(spark, DATA), 2, "user", "item", "rating").collect()}
    assert got[2] == pytest.approx(1.0) and got[1] == pytest.approx(1 / math.sqrt(2)) and got[3] == 0.0


def test_repeated_ratings_add_up(spark):
    df = ratings(spark, [(1, 1, 1.0), (1, 1, 2.0), (1, 2, 4.0), (2, 1, 3.0), (2, 2, 4.0)])
    got = {r.user: r.similarity for r in similarity.user_similarity(df, 1, "user", "item", "rating").collect()}
    assert got[2] == pytest.approx(1.0)


def test_zero_vector_has_no_cosine(spark):
    got = {r.user: r.similarity for r in similarity.user_similarity(ratings(spark, [(1, 1, 2.0), (2, 1, 0.0)]), 1, "user", "item", "rating").collect()}
    assert got == {1: pytest.approx(1.0), 2: None}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.tuples(st.integers(1, 5), st.integers(1, 5)), st.integers(1, 9), min_size=1))
def test_similarity_against_brute_force(spark, cells):
    df = ratings(spark, [(u, i, float(v)) for (u, i), v in cells.items()])
    users = {u for u, _ in cells}
    target = min(users)

    def vector(user):
        return [cells.get((user, item), 0) for item in range(1, 6)]

    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / (math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b)))

    got = {r.user: r.similarity for r in similarity.user_similarity(df, target, "user", "item", "rating").collect()}
    assert got == {u: pytest.approx(cos(vector(target), vector(u))) for u in users}
