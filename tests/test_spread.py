"""Tasks over many images are small, and what is used more than once is computed once."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import FOLDER
from plateflow import fixtures
from plateflow.fixtures import Tables
from plateflow.operators import images as I
from plateflow.operators import imagesets as S
from plateflow.operators.jobs import job_states
from plateflow.plans.status import status_updates
from plateflow.plans.submit import plan_submission
from plateflow.queries.jobs import status
from plateflow.sources.catalog import write_catalog


def test_multiplied_rows_are_spread(spark, monkeypatch):
    whole = Tables(spark, FOLDER).base("lineitem")
    monkeypatch.setattr(fixtures, "ROWS_PER_TASK", 500)
    spread = Tables(spark, FOLDER).base("lineitem")
    assert spread.rdd.getNumPartitions() == -(-whole.count() // 500) > whole.rdd.getNumPartitions()
    assert spread.exceptAll(whole).isEmpty() and whole.exceptAll(spread).isEmpty()


def test_many_images_take_more_tasks(spark, monkeypatch):
    rows = [(i % 3, "P", 1, None if i % 5 == 0 else "A01", 1, i % 7, 1, "X", f"p{i % 50}") for i in range(200)]
    images = spark.createDataFrame(rows, "plate_acquisition_id long, plate_barcode string, timepoint int, well string, site int, z int, channel int, dye string, path string")
    plain = [I.distinct_images(images).collect(), I.order_images(images).collect()]
    monkeypatch.setattr(I, "IMAGES_PER_TASK", 20)
    assert I.image_tasks(images) == 10
    distinct, ordered = I.distinct_images(images), I.order_images(images)
    assert "Exchange hashpartitioning" in (text := distinct._jdf.queryExecution().executedPlan().toString()) and ", 10), " in text
    assert "10)" in ordered._jdf.queryExecution().executedPlan().toString().split("rangepartitioning", 1)[1].splitlines()[0]
    assert set(distinct.collect()) == set(plain[0]) == set(rows) and distinct.count() == len(set(rows))
    assert ordered.collect() == plain[1]


def test_images_of_a_field_go_together(spark, monkeypatch):
    """Many images meet by their field of view: alike rows are compressed together."""
    rows = [(i % 3, "P", 1, None if i % 5 == 0 else "A01", 1, i % 7, c, "X", f"p{i % 50}w{c}") for i in range(60) for c in (1, 2)]
    images = spark.createDataFrame(rows * 2, "plate_acquisition_id long, plate_barcode string, timepoint int, well string, site int, z int, channel int, dye string, path string")
    monkeypatch.setattr(I, "IMAGES_PER_TASK", 20)
    distinct = I.distinct_images(images)
    exchange = distinct._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning(", 1)[1].splitlines()[0]
    assert "well#" in exchange.split(", 12)")[0] and "path#" not in exchange.split(", 12)")[0]
    assert sorted(map(str, distinct.collect())) == sorted({str(row) for row in spark.createDataFrame(rows, images.schema).collect()})


def test_runnable_sub_analyses_are_computed_once(spark):
    t = Tables(spark, FOLDER)
    plan = plan_submission(t.images, t.sub_analyses, t.analyses, t.plate_acquisition, t.channel_map, run_id=F.lit("r"))
    assert plan.jobs.count() > 0
    text = plan.jobs._jdf.queryExecution().executedPlan().toString()
    assert "o_orderkey" not in text and "s_suppkey" in text


def test_job_states_are_computed_once(spark):
    """What the updates are made of is not numbered and parsed again for each of their parts."""
    t, now = Tables(spark, FOLDER), F.expr("TIMESTAMP_NTZ '2024-02-01 00:00:00'")
    updates = status_updates(job_states(status(t)), t.sub_analyses, now)
    for events in (updates.status, updates.lifecycle):
        assert "event_id" not in events._jdf.queryExecution().executedPlan().toString() and events.count() > 0


def test_sets_are_met_by_their_planes(spark):
    images = spark.createDataFrame(
        [(1, "P", 1, "A01", 1, z, 1, "X", f"p{z}") for z in (0, 1, 2, None)] + [(2, "Q", 1, "A01", 1, 0, 1, "X", "q")],
        "plate_acquisition_id long, plate_barcode string, timepoint int, well string, site int, z int, channel int, dye string, path string",
    )
    analyses = spark.createDataFrame(
        [(10, 1, [0, 1, 1, None]), (11, 1, None), (12, 1, []), (13, 2, [0, 9]), (10, 1, [2])],
        "sub_id long, plate_acquisition_id long, z_planes array<int>",
    ).selectExpr("*", "CAST(NULL AS array<int>) site_filter", "CAST(NULL AS array<string>) well_filter", "CAST(NULL AS array<string>) channels")
    acquisitions = spark.createDataFrame([(1, 0), (2, 0)], "id long, channel_map_id int")
    counts = S.count_sets(images, analyses, acquisitions, spark.createDataFrame([(0, 1, "X")], "map_id int, channel int, dye string"))
    assert {r["sub_id"]: r["n_sets"] for r in counts.collect()} == {10: 3, 13: 1}
    joins = [line for line in counts._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]
    assert any("plate_acquisition_id" in line and " z#" in line for line in joins)


def test_tasks_commit_the_catalogue(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    seen, option = [], DataFrameWriter.option
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, key, value: seen.append((key, value)) or option(self, key, value))
    t = Tables(spark, FOLDER)
    write_catalog({"images": t.images}, str(tmp_path))
    assert ("mapreduce.fileoutputcommitter.algorithm.version", "2") in seen
    monkeypatch.undo()
    assert spark.read.parquet(f"{tmp_path}/images").count() == t.images.count()
