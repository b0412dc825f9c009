from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from plateflow.functions.settings import route, with_settings
from plateflow.operators import analyses as A
from plateflow.operators import files as R
from plateflow.operators import jobs as J

DAY = dt.datetime(2024, 1, 1)
SUB = (
    "sub_id bigint, analysis_id bigint, plate_acquisition_id bigint, priority int, depends_on_sub_id array<bigint>,"
    " start timestamp_ntz, finish timestamp_ntz, error timestamp_ntz, meta string"
)


def sub(sub_id, analysis_id=1, deps=None, start=None, finish=None, error=None, meta="{}", priority=None):
    return (sub_id, analysis_id, 1, priority, deps, start, finish, error, meta)


def test_dependencies(spark):
    subs = spark.createDataFrame([
        sub(1, finish=DAY, error=DAY), sub(2), sub(3, deps=[]), sub(4, deps=[1]), sub(5, deps=[1, 2]), sub(6, deps=[99]),
        sub(7, deps=[2, 2]), sub(8, deps=[6], start=DAY),
    ], SUB)
    assert sorted(r["sub_id"] for r in A.ready(A.pending(subs), subs).collect()) == [2, 3, 4, 6]


def test_queue_order_puts_missing_priority_last(spark):
    subs = spark.createDataFrame([sub(1), sub(2, priority=2), sub(3, priority=1), sub(4, priority=2)], SUB)
    assert [r["sub_id"] for r in A.queue_order(subs).collect()] == [3, 2, 4, 1]


def test_routes(spark):
    metas = ['{"run_on_uppmax":true,"type":"cellprofiler"}', '{"run_on_uppmax":true,"type":"x"}', '{"run_on_uppmax":false}',
             '{"run_on_pelle":null}', '{"type":"cellprofiler"}']
    rows = spark.createDataFrame([(i, m) for i, m in enumerate(metas)], "i int, meta string")
    assert [r["b"] for r in rows.select("i", route(F.col("meta")).alias("b")).orderBy("i").collect()] == [
        "remote", "external", "external", "external", "cluster",
    ]


def test_settings_defaults_and_values(spark):
    meta = '{"type":"cellprofiler","run_on_uppmax":true,"priority":1,"job_timeout":60,"use_icf":true,"batch_size":3,"pipeline_file":"p.x","max_errors":"4"}'
    rows = with_settings(spark.createDataFrame([(0, "{}"), (1, meta)], "sub_id bigint, meta string")).orderBy("sub_id").collect()
    assert (rows[0]["job_timeout"], rows[0]["batch_size"], rows[0]["use_icf"], rows[0]["cp_version"], rows[0]["pipeline_file"]) == (
        "10800", 1, False, "v4.2.5-cellpose2.0", None,
    )
    assert (rows[1]["job_timeout"], rows[1]["is_urgent"], rows[1]["cp_version"], rows[1]["pipeline_file"]) == (
        "60", True, "v4.0.7", "/cpp_work/pipelines/p.x",
    )


def test_rollup(spark):
    analyses = spark.createDataFrame(
        [(i, None, None, m) for i, m in [(1, "{}"), (2, "{}"), (3, "{}"), (4, "{}"), (5, '{"run_on_pelle":null}')]],
        "id bigint, finish timestamp_ntz, error timestamp_ntz, meta string",
    )
    subs = spark.createDataFrame([
        sub(1, 1, finish=DAY), sub(2, 1, finish=DAY), sub(3, 2, finish=DAY), sub(4, 2), sub(5, 3, error=DAY), sub(6, 3),
        sub(7, 5, finish=DAY),
    ], SUB)
    for shuffled in (subs, subs.orderBy(F.desc("sub_id")).repartition(3)):
        states = {r["analysis_id"]: r["state"] for r in A.rollup(analyses, shuffled).collect()}
        assert states == {1: "finished", 2: "pending", 3: "failed", 4: "pending"}
    files = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "a")], "sub_id bigint, path string")
    folders = spark.createDataFrame([(1, "f1/"), (2, "f2/"), (3, "f3/")], "sub_id bigint, job_folder string")
    rolled = A.rollup_files(analyses, subs, files, folders)
    assert sorted((r["sub_id"], r["path"], r["analysis_folder"]) for r in rolled.collect()) == [
        (1, "a", "f2/"), (1, "b", "f2/"), (2, "a", "f2/"),
    ]


def log(spark, *events):
    rows = [(1, 7, DAY + dt.timedelta(hours=h), seq, kind) for seq, (h, kind) in enumerate(events)]
    return spark.createDataFrame(rows, "sub_id bigint, analysis_id bigint, ts timestamp_ntz, seq bigint, kind string")


def test_lifecycle(spark):
    events = log(spark, (0, "start"), (1, "error"), (2, "reset"), (3, "start"), (4, "start"), (5, "finish"))
    child = A.lifecycle(events, "sub_id", first_start=False).first()
    parent = A.lifecycle(events, "analysis_id", first_start=True).first()
    hour = lambda h: DAY + dt.timedelta(hours=h)
    assert (child["start"], child["finish"], child["error"]) == (hour(4), hour(5), None)
    assert (parent["id"], parent["start"]) == (7, hour(3))
    cleared = A.lifecycle(log(spark, (0, "start"), (1, "reset")), "sub_id", first_start=False).first()
    assert (cleared["start"], cleared["finish"], cleared["error"]) == (None, None, None)


def test_status_keeps_last_value(spark):
    rows = [(1, 7, DAY, 1, "error", "a"), (1, 7, DAY, 2, "error", "b"), (2, 7, DAY, 3, "error", "c")]
    events = spark.createDataFrame(
        rows, "sub_id bigint, analysis_id bigint, ts timestamp_ntz, seq bigint, status_key string, status_value string"
    )
    assert sorted(tuple(r) for r in A.merge_status(events).collect()) == [
        ("analysis", 7, "error_1", "b"), ("analysis", 7, "error_2", "c"), ("sub", 1, "error", "b"), ("sub", 2, "error", "c"),
    ]


def jobs(spark, *rows):
    return spark.createDataFrame(list(rows), "job_name string, conditions array<struct<type:string,status:string>>")


def name(sub_id, number, total, run="r"):
    return f"cpp-worker-job-{sub_id}-{run}-{number}-{total}-7"


def test_job_states_and_families(spark):
    status = jobs(
        spark,
        (name(1, 0, 2), [("Failed", "True"), ("Complete", "True")]), (name(1, 1, 2), [("Failed", "True")]),
        (name(1, 1, 2), [("Failed", "True")]), (name(2, 0, 2), [("Complete", "False")]), (name(2, 1, 2), [("Complete", "True")]),
        (name(3, 0, 1), None), (name(3, 0, 1, "s"), [("Suspended", "True"), ("Complete", "True")]), ("odd", [("Complete", "True")]),
        (name(4, 0, 1), [("Complete", "True")]), (name(4, 1, 1), [("Complete", "True")]),
    )
    states = J.job_states(status)
    found = {(r["job_name"], r["state"]) for r in states.collect()}
    assert {(name(1, 0, 2), "complete"), (name(1, 1, 2), "failed"), (name(2, 0, 2), "running"), (name(3, 0, 1), "running")} <= found
    families = J.job_families(states)
    done = {r["job_family"]: (r["done"], r["total"], r["n_failed"]) for r in families.collect()}
    assert done == {
        "cpp-worker-job-1-r": (2, 2, 1), "cpp-worker-job-2-r": (1, 2, 0), "cpp-worker-job-3-s": (1, 1, 0), "cpp-worker-job-4-r": (2, 1, 0),
    }
    complete = lambda limit: sorted(r["sub_id"] for r in J.complete_families(families, limit).collect())
    assert complete(None) == [1, 3] and complete(2) == [1, 3, 4]
    rest = J.new_families(J.complete_families(families), families.where("sub_id = 1"))
    assert [r["sub_id"] for r in rest.collect()] == [3]


def test_progress_and_budget(spark):
    families = spark.createDataFrame(
        [("f1", 1, 2, 4), ("f2", 2, 1, 2), ("f3", 3, 1, 2)], "job_family string, sub_id bigint, done bigint, total bigint"
    )
    subs = spark.createDataFrame([sub(1, start=DAY, meta='{"max_errors":1}'), sub(2, error=DAY)], SUB)
    now = F.lit(DAY + dt.timedelta(hours=3)).cast("timestamp_ntz")
    rows = {r["sub_id"]: r for r in J.progress(families, subs, now).collect()}
    assert rows[1]["progress"] == "2 / 4 jobs finished, time remaining: 3.00 hours"
    assert rows[2]["hours_left"] is None and rows[2]["progress"] is None
    assert rows[3]["progress"] == "1 / 2 jobs finished, time remaining: 0.00 hours"
    states = J.job_states(jobs(spark, *[(name(s, n, 9), [("Failed", "True")]) for s, n in [(1, 0), (1, 0), (2, 0), (3, 0)]]))
    budget = {r["sub_id"]: (r["n_failed"], r["over_budget"], r["has_error"]) for r in J.error_budget(states, subs).collect()}
    assert budget == {1: (1, False, False), 2: (1, True, True), 3: (1, True, True)}


def test_later_backend_wins(spark):
    schema = "job_family string, done bigint"
    merged = J.union_families(
        spark.createDataFrame([("a", 1), ("b", 1)], schema), spark.createDataFrame([("b", 2), ("c", 2)], schema)
    )
    assert sorted(tuple(r) for r in merged.collect()) == [("a", 1), ("b", 2), ("c", 2)]


def test_compact_files_and_documents(spark):
    manifest = spark.createDataFrame(
        [(1, "x.PNG"), (1, "a/b/y.tif"), (1, "a/b/z.tif"), (1, "t.parquet"), (1, "t.parquet")], "sub_id bigint, path string"
    )
    assert sorted(r["path"] for r in R.compact_files(manifest).collect()) == ["/", "a/b/", "t.parquet"]
    storage = spark.createDataFrame([(1, "results/P/1/2/")], "sub_id bigint, job_specific string")
    files = R.result_files(manifest, storage)
    document = R.build_results(files).first()
    assert document["result"] == (
        '{"job_folder":"results/P/1/2/","file_list":["results/P/1/2/","results/P/1/2/a/b/","results/P/1/2/t.parquet"]}'
    )
    many = spark.range(1000).select(F.lit(1).alias("sub_id"), F.lit("f/").alias("job_folder"), F.concat(F.lit("f/"), "id").alias("path"))
    parts = R.build_results(many, parts=10).select("part", F.from_json("result", "file_list array<string>").alias("d")).collect()
    assert sorted(r["part"] for r in parts) == list(range(10))
    assert sorted(path for r in parts for path in r["d"]["file_list"]) == sorted(f"f/{n}" for n in range(1000))


def test_result_files_tasks(spark):
    """Paths are told apart by as many tasks as there are shuffle partitions, not by as few as their shuffled bytes suggest."""
    manifest = spark.createDataFrame([(n, path) for n in range(40) for path in ("a.csv", "m/1.tif", "m/2.tif", "a.csv")], "sub_id bigint, path string")
    storage = spark.createDataFrame([(n, f"results/{n}/") for n in range(1, 40)], "sub_id bigint, job_specific string")
    files = R.result_files(manifest, storage)
    assert {(row["sub_id"], row["path"]) for row in files.collect()} == {(n, f"results/{n}/{end}") for n in range(1, 40) for end in ("a.csv", "m/")}
    assert files.count() == 78
    assert f", {spark.conf.get('spark.sql.shuffle.partitions')}), REPARTITION_BY_NUM" in files._jdf.queryExecution().toString()
