from __future__ import annotations

import os

from plateflow import session


def test_intermediate_tables_are_dropped(spark, monkeypatch):
    monkeypatch.setattr(session, "_given", [])
    table = session.written(spark.range(3).toDF("n"), "numbers")
    assert table.count() == 3
    (path,) = session._given
    folder = path.removeprefix("file:")
    assert os.path.isdir(folder)
    assert session.drop_intermediate(spark) == 1 and session._given == [] and not os.path.exists(folder)
