"""Shared steps."""

from __future__ import annotations

import os

from assayweave import session


def test_settled_steps_are_kept_and_discarded(spark):
    df = session.settle(spark.range(3), "kept")
    path = df._settled_at.removeprefix("file:")
    assert os.path.isdir(path) and df.count() == 3 and path.startswith(session.shared_dir(spark).removeprefix("file:"))
    session.discard(df)
    assert not os.path.exists(path)
    session.discard(df)


def test_shared_folder_is_the_sessions(spark):
    assert session.shared_dir(spark) == spark.sparkContext.getCheckpointDir()
    empty = session.settle(spark.range(0), "empty")
    assert empty.count() == 0 and empty.columns == ["id"]


def test_workers_find_the_package(spark):
    session.show_package(spark)
    session.show_package(spark)
    root = os.path.dirname(os.path.dirname(os.path.abspath(session.__file__)))
    assert spark.sparkContext.environment["PYTHONPATH"].split(os.pathsep).count(root) == 1
