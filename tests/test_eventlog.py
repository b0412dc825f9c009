"""Snapshots of growing logs, and documents written entry by entry."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from plateflow.operators import analyses as A
from plateflow.operators.eventlog import LifecycleFold, StatusFold, fold_batch, folded
from plateflow.sources import sinks


def log(spark, rng, kinds, columns):
    rows = [(rng.randrange(1, 5), rng.randrange(1, 3), 1_000_000 + rng.randrange(50), seq, rng.choice(kinds), f"v{seq}") for seq in range(120)]
    rows = [(sub, sub % 2 if columns == "kind" else parent, ts, seq, kind, value) for sub, parent, ts, seq, kind, value in rows]
    df = spark.createDataFrame(rows, f"sub_id bigint, analysis_id bigint, t bigint, seq bigint, {columns} string, status_value string")
    return df.withColumn("ts", F.timestamp_seconds("t")).drop("t")


@pytest.mark.parametrize("seed", [1, 2])
def test_snapshots_equal_the_whole_log(spark, tmp_path, seed):
    rng = random.Random(seed)
    status = log(spark, rng, ["progress", "error"], "status_key")
    times = log(spark, rng, ["start", "start", "finish", "error", "reset"], "kind")
    cuts = [0, *sorted(rng.sample(range(1, 120), 3)), 120]
    folds = {
        "status": (StatusFold(), status, A.merge_status(status)),
        "sub": (LifecycleFold("sub_id", False), times, A.lifecycle(times, "sub_id", first_start=False)),
        "parent": (LifecycleFold("analysis_id", True), times, A.lifecycle(times, "analysis_id", first_start=True)),
    }
    for name, (fold, events, whole) in folds.items():
        folder = str(tmp_path / name)
        for number, (low, high) in enumerate(zip(cuts, cuts[1:])):
            stretch = events.where(f"seq >= {low} AND seq < {high}")
            for _ in range(1 + (number == 2)):  # a batch that runs again
                fold_batch(stretch, number, fold, folder)
        assert sorted(map(str, folded(spark, fold, folder).collect())) == sorted(map(str, whole.collect())), name
        assert len(list((tmp_path / name).iterdir())) == 2


def test_a_snapshot_that_was_not_finished_is_not_used(spark, tmp_path):
    status = log(spark, random.Random(3), ["progress"], "status_key")
    fold, folder = StatusFold(), str(tmp_path / "s")
    fold_batch(status.where("seq < 50"), 0, fold, folder)
    fold_batch(status.where("seq >= 50 AND seq < 60"), 1, fold, folder)
    (tmp_path / "s" / "batch_id=1" / "_SUCCESS").unlink()
    fold_batch(status.where("seq >= 50"), 2, fold, folder)
    assert sorted(map(tuple, folded(spark, fold, folder).collect())) == sorted(map(tuple, A.merge_status(status).collect()))


def test_documents_are_written_entry_by_entry(spark, tmp_path):
    many = spark.range(30_000).select(F.lit(7).alias("sub_id"), F.lit('r/"7"/').alias("job_folder"), F.concat(F.lit("a\\\"é/"), F.lpad("id", 6, "0")).alias("path"))
    few = spark.createDataFrame([(8, "r/8/", "b"), (8, "r/8/", "a"), (9, "r/9/", None)], "sub_id int, job_folder string, path string")
    done = sinks.write_documents(many.unionByName(few), "sub_id", "job_folder", str(tmp_path / "d"))
    assert sorted((r["sub_id"], r["rows"]) for r in done.collect()) == [(7, 30_000), (8, 2), (9, 0)]
    large = json.loads((tmp_path / "d" / "7.json").read_text())
    assert large == {"job_folder": 'r/"7"/', "file_list": [f'a\\"é/{n:06d}' for n in range(30_000)]}
    assert json.loads((tmp_path / "d" / "8.json").read_text()) == {"job_folder": "r/8/", "file_list": ["a", "b"]}
    assert json.loads((tmp_path / "d" / "9.json").read_text()) == {"job_folder": "r/9/", "file_list": []}


def test_collection_closes_the_loop(spark, tmp_path):
    from test_collect import collected

    from plateflow.plans.status import collection_updates

    files = [(1, "a", 0, 1, "T.csv", "x\n1\n"), (2, "a", 0, 1, "T.csv", "x\n1,2\n"), (2, "b", 0, 1, "T.csv", "x\n1\n")]
    out = collected(spark, tmp_path, files, {1: "r/1/", 2: "r/2/"})
    subs = spark.createDataFrame([(1, 11), (2, 12), (3, 13)], "sub_id bigint, analysis_id bigint")
    updates = collection_updates(out, subs, F.expr("TIMESTAMP_NTZ '2024-02-01 00:00:00'"))
    times = {r["id"]: (r["finish"] is not None, r["error"] is not None) for r in A.lifecycle(updates.lifecycle, "sub_id", first_start=False).collect()}
    assert times == {1: (True, False), 2: (False, True)}
    status = {(r["level"], r["id"], r["status_key"]): r["status_value"] for r in A.merge_status(updates.status).collect()}
    text = "T.csv: row longer than its header"
    assert status == {("sub", 2, "error"): text, ("analysis", 12, "error_2"): text}


def test_progress_goes_where_labels_say(spark):
    from plateflow.operators.jobs import job_states
    from plateflow.plans.status import status_updates
    from plateflow.schemas import JOB_STATUS

    done = [("Complete", "True")]
    rows = [(f"cpp-worker-job-1-r-{n}-4-9", {"sub_analysis_id": "5", "analysis_id": "50"}, done) for n in range(2)]
    rows += [("cpp-worker-job-2-r-0-4-9", {"sub_analysis_id": "6"}, done), ("cpp-worker-job-3-r-0-4-9", None, done)]
    rows += [("cpp-worker-job-4-r-0-4-9", {"sub_analysis_id": "x", "analysis_id": "1"}, [("Failed", "True")])]
    states = job_states(spark.createDataFrame(rows, JOB_STATUS))
    subs = spark.createDataFrame([(n, None, None, "{}") for n in range(1, 7)], "sub_id bigint, start timestamp_ntz, error timestamp_ntz, meta string")
    subs = subs.withColumn("start", F.expr("TIMESTAMP_NTZ '2024-01-31 00:00:00'"))
    events = status_updates(states, subs, F.expr("TIMESTAMP_NTZ '2024-02-01 00:00:00'")).status
    got = {(r["sub_id"], r["analysis_id"], r["status_key"], r["status_value"][:20]) for r in events.collect()}
    assert got == {(5, 50, "progress", "2 / 4 jobs finished,"), (4, 9, "error", "error_count is more ")}


def test_commands_name_the_files_that_are_written(spark, tmp_path):
    from conftest import FOLDER

    from plateflow import constants as C
    from plateflow.fixtures import Tables
    from plateflow.operators.jobs import job_commands
    from plateflow.plans.submit import plan_submission

    t = Tables(spark, FOLDER)
    subs = t.sub_analyses.where("sub_id % 3 = 1")
    plan = plan_submission(t.images, subs, t.analyses, t.plate_acquisition, t.channel_map, run_id=F.lit("r"), job_limit=2)
    written = {r["path"] for r in plan.write_image_sets(str(tmp_path)).collect()}
    commands = [r["command"] for r in job_commands(plan.jobs, "registry/x").collect()]
    named = {command.split("--data-file ")[1].split(" ")[0] for command in commands}
    assert len(named) == len(commands) > 3
    assert {path.replace(C.WORK_ROOT, f"{tmp_path}/") for path in named} == written
    assert all((tmp_path / path.removeprefix(C.WORK_ROOT)).exists() for path in named)
