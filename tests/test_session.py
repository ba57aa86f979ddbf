from types import SimpleNamespace

import pytest

from tallymill.session import shared_folder, written_table


def fake(settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: settings.get(name, default)))


def test_shared_folder_is_below_the_checkpoint_folder_and_fresh(spark):
    parent = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(f"{parent}/x-") and first != second


def test_cluster_without_checkpoint_folder_is_refused():
    with pytest.raises(ValueError):
        shared_folder(fake({"spark.master": "yarn"}), "x")
    assert shared_folder(fake({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///c/"}), "x").startswith("hdfs:///c/x-")
    assert "/x-" in shared_folder(fake({"spark.master": "local[2]"}), "x")


def test_written_table_forgets_how_it_was_made(spark, rows):
    made = spark.range(10).selectExpr("id % 3 AS k", "id").repartition(4)
    back = written_table(made, "t")
    assert rows(back) == rows(made) and "Exchange" not in back._jdf.queryExecution().executedPlan().toString()


def test_written_tables_go_when_the_caller_is_done(spark, monkeypatch):
    from pathlib import Path

    from tallymill import session

    monkeypatch.setattr(session, "_folders", [])
    back = session.written_table(spark.range(3), "t")
    (path,) = {Path(f.removeprefix("file:")).parent for f in back.inputFiles()}
    assert path.exists() and session._folders == [str(path)]
    session.remove_written(spark)
    assert not path.exists() and session._folders == []
