"""Queries over jobs and job families, as tables and as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from plateflow import functions as PF
from plateflow.operators import jobs as J
from plateflow.operators.analyses import lifecycle, merge_status
from plateflow.plans.status import status_updates as updates
from plateflow.queries.base import query
from plateflow.queries.trees import marker_tree
from plateflow.session import shared_folder, written
from plateflow.sources.markers import stream_markers
from plateflow.streaming import jobs as ST

_PARSED = """named AS (SELECT *, CAST(split_part(job_name, '-', 4) AS BIGINT) AS sub_id,
      concat('cpp-worker-job-', split_part(job_name, '-', 4), '-', split_part(job_name, '-', 5)) AS job_family,
      CAST(split_part(job_name, '-', 7) AS BIGINT) AS n_jobs, CAST(split_part(job_name, '-', 8) AS BIGINT) AS analysis_id FROM jobs)"""
_FAMILIES = f"""{_PARSED}, families AS (SELECT job_family, min(sub_id) AS sub_id, min(analysis_id) AS analysis_id,
      count(DISTINCT job_name) AS done, count(DISTINCT CASE WHEN cond_type = 'Failed' THEN job_name END) AS n_failed, min(n_jobs) AS total
    FROM named WHERE cond_type IS NOT NULL GROUP BY 1)"""


def status(t):
    """Job status rows as the cluster reports them."""
    return status_of(t.jobs)


def status_of(jobs):
    condition = F.when(
        F.col("cond_type").isNotNull(),
        F.array(F.struct(F.col("cond_type").alias("type"), F.col("cond_status").alias("status"))),
    )
    return jobs.select("job_name", "ts", condition.alias("conditions"))


def _families(t):
    return J.job_families(J.job_states(status(t)))


@query(
    """SELECT job_name, CASE cond_type WHEN 'Complete' THEN 'complete' WHEN 'Failed' THEN 'failed' ELSE 'running' END AS state FROM jobs""",
    "jobs",
)
def job_condition(t):
    return status(t).select("job_name", J.job_condition(F.col("conditions")).alias("state"))


@query(f"WITH {_PARSED} SELECT job_name, sub_id, job_family, n_jobs, analysis_id FROM named", "jobs")
def parse_job_name(t):
    return t.jobs.select("job_name", PF.parse_job_name(F.col("job_name")).alias("p")).select("job_name", "p.*")


@query(f"WITH {_FAMILIES} SELECT * FROM families", "jobs")
def job_families(t):
    return _families(t)


@query(f"WITH {_FAMILIES} SELECT job_family, sub_id, done, total FROM families WHERE done = total", "jobs")
def complete_families(t):
    return J.complete_families(_families(t)).select("job_family", "sub_id", "done", "total")


@query(
    f"""WITH {_FAMILIES}, later AS (SELECT job_family, done + 1 AS done FROM families WHERE sub_id % 3 = 0
      UNION ALL SELECT concat(job_family, 'b'), done FROM families WHERE sub_id % 4 = 0)
    SELECT coalesce(l.job_family, f.job_family) AS job_family, coalesce(l.done, f.done) AS done
    FROM families f FULL JOIN later l ON f.job_family = l.job_family""",
    "jobs",
)
def union_families(t):
    first = _families(t).select("job_family", "sub_id", "done")
    later = first.where("sub_id % 3 = 0").withColumn("done", F.col("done") + 1).unionByName(
        first.where("sub_id % 4 = 0").withColumn("job_family", F.concat("job_family", F.lit("b")))
    )
    return J.union_families(first.drop("sub_id"), later.drop("sub_id"))


@query(
    f"WITH {_FAMILIES} SELECT job_family, done, total FROM families WHERE done = total AND sub_id % 5 <> 0", "jobs"
)
def new_families(t):
    families = _families(t)
    return J.new_families(J.complete_families(families), families.where("sub_id % 5 = 0")).select(
        "job_family", "done", "total"
    )


@query(
    f"""WITH {_PARSED} SELECT j.job_name, j.sub_id, s.start, s.sub_id IS NULL OR s.error IS NOT NULL AS has_error,
      coalesce(TRY_CAST(s.meta->>'$.max_errors' AS INT), 0) AS max_errors
    FROM named j LEFT JOIN sub_analyses s ON s.sub_id = j.sub_id""",
    "jobs", "sub_analyses",
)
def job_context(t):
    return J.job_context(J.job_states(status(t)).select("job_name", "sub_id"), t.sub_analyses)


_NOW = "TIMESTAMP '2024-02-01 00:00:00'"


@query(
    f"""WITH {_FAMILIES}, timed AS (SELECT f.*, (epoch_us({_NOW}) - epoch_us(CASE WHEN s.sub_id IS NULL THEN {_NOW} ELSE s.start END)) / 1e6
        / done * (total - done) / 3600 AS h FROM families f LEFT JOIN sub_analyses s USING (sub_id))
    SELECT job_family, sub_id, done, total, round(h, 4) AS hours_left,
      CASE WHEN h IS NOT NULL THEN printf('%d / %d jobs finished, time remaining: %.2f hours', done, total, h) END AS progress
    FROM timed""",
    "jobs", "sub_analyses",
)
def progress(t):
    now = F.expr("TIMESTAMP_NTZ '2024-02-01 00:00:00'")
    return J.progress(_families(t), t.sub_analyses, now).withColumn("hours_left", F.round("hours_left", 4))


@query(
    f"""WITH {_PARSED}, failed AS (SELECT sub_id, count(DISTINCT job_name) AS n_failed FROM named WHERE cond_type = 'Failed' GROUP BY 1)
    SELECT f.sub_id, n_failed, coalesce(TRY_CAST(meta->>'$.max_errors' AS INT), 0) AS max_errors,
      n_failed > coalesce(TRY_CAST(meta->>'$.max_errors' AS INT), 0) AS over_budget, s.sub_id IS NULL OR s.error IS NOT NULL AS has_error
    FROM failed f LEFT JOIN sub_analyses s ON s.sub_id = f.sub_id""",
    "jobs", "sub_analyses",
)
def error_budget(t):
    return J.error_budget(J.job_states(status(t)), t.sub_analyses)


@query(
    f"""WITH {_FAMILIES}, timed AS (SELECT f.*, (epoch_us({_NOW}) - epoch_us(CASE WHEN s.sub_id IS NULL THEN {_NOW} ELSE s.start END)) / 1e6
        / done * (total - done) / 3600 AS h FROM families f LEFT JOIN sub_analyses s USING (sub_id)),
    owners AS (SELECT sub_id, max(analysis_id) AS analysis_id FROM families GROUP BY 1),
    texts AS (SELECT sub_id, 'progress' AS status_key,
        arg_max(printf('%d / %d jobs finished, time remaining: %.2f hours', done, total, h), job_family) AS status_value FROM timed WHERE h IS NOT NULL GROUP BY 1
      UNION ALL
      SELECT f.sub_id, 'error', CASE WHEN n > coalesce(TRY_CAST(meta->>'$.max_errors' AS INT), 0) THEN 'error_count is more than max_errors' ELSE concat('error in job ', job) END
      FROM (SELECT sub_id, count(DISTINCT job_name) AS n, max(job_name) AS job FROM named WHERE cond_type = 'Failed' GROUP BY 1) f
      LEFT JOIN sub_analyses s ON s.sub_id = f.sub_id)
    SELECT 'sub' AS level, sub_id AS id, status_key, status_value FROM texts
    UNION ALL
    SELECT 'analysis', analysis_id, concat(status_key, '_', sub_id), status_value FROM texts JOIN owners USING (sub_id)""",
    "jobs", "sub_analyses",
)
def status_updates(t):
    now = F.expr("TIMESTAMP_NTZ '2024-02-01 00:00:00'")
    # Folded twice, for sub-analyses and for analyses.
    return merge_status(written(updates(J.job_states(status(t)), t.sub_analyses, now).status, "status-events"))


@query(
    f"""WITH {_FAMILIES} SELECT f.sub_id AS id, {_NOW} AS error
    FROM (SELECT sub_id, count(DISTINCT job_name) AS n FROM named WHERE cond_type = 'Failed' GROUP BY 1) f
    JOIN sub_analyses s ON s.sub_id = f.sub_id
    WHERE s.error IS NULL AND n > coalesce(TRY_CAST(meta->>'$.max_errors' AS INT), 0)""",
    "jobs", "sub_analyses",
)
def error_updates(t):
    now = F.expr("TIMESTAMP_NTZ '2024-02-01 00:00:00'")
    events = updates(J.job_states(status(t)), t.sub_analyses, now).lifecycle
    return lifecycle(events, "sub_id", first_start=False).select("id", "error")


def _stream(t, files: int = 2):
    """The job status rows as a stream of several micro-batches."""
    source = shared_folder(t.spark, "status")
    rows = status(t)
    rows.repartition(files, "ts").write.parquet(source)
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)


def _run(t, start):
    """Run a streaming query to its end; the folder it wrote."""
    path, checkpoint = shared_folder(t.spark, "stream"), shared_folder(t.spark, "offsets")
    start(_stream(t), path, checkpoint).awaitTermination()
    return path


@query(f"WITH {_PARSED} SELECT DISTINCT job_name, sub_id, analysis_id FROM named WHERE cond_type = 'Failed'", "jobs")
def stream_errors_once(t):
    path = _run(t, ST.stream_errors_once)
    return t.spark.read.parquet(path).select("job_name", "sub_id", "analysis_id")


@query(f"WITH {_FAMILIES} SELECT job_family, done, total FROM families", "jobs")
def stream_progress(t):
    return ST.latest_progress(t.spark, _run(t, ST.stream_progress))


@query(f"WITH {_FAMILIES} SELECT job_family, done, total FROM families WHERE done = total", "jobs")
def stream_complete(t):
    path = _run(t, ST.stream_complete)
    return t.spark.read.parquet(path).select("job_family", "done", "total")


@query(f"WITH {_FAMILIES} SELECT job_family, done, total FROM families WHERE done = total", "jobs")
def stream_marker_files(t):
    """Families that complete as marker files appear, over three batches with a restart before each."""
    names = ("output", "roots", "log", "stream", "offsets")
    top, roots, log, path, checkpoint = (shared_folder(t.spark, f"markers-{name}") for name in names)
    for part in range(3):
        # Some jobs run for as long as the others last.
        later = (F.pmod(F.xxhash64("job_name"), F.lit(3)) == part) & F.col("cond_type").isNotNull()
        added = marker_tree(t.jobs.where(later | (F.col("cond_type").isNull() & F.lit(part == 0))), top)
        added.write.mode("append").parquet(roots)
        ST.stream_complete(stream_markers(t.spark, roots, log), path, checkpoint).awaitTermination()
    return t.spark.read.parquet(path).select("job_family", "done", "total")
