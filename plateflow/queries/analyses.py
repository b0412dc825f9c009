"""Queries over sub-analyses and their parent analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from plateflow import functions as PF
from plateflow.functions.settings import classify_type as kind_of
from plateflow.functions.settings import route, with_settings
from plateflow.operators import analyses as A
from plateflow.operators import files as R
from plateflow.operators.eventlog import LifecycleFold, StatusFold, folded
from plateflow.plans.rollup import plan_rollup
from plateflow.queries.base import ORACLES, query
from plateflow.session import shared_folder
from plateflow.sources import sinks
from plateflow.sources.publish import read_published
from plateflow.streaming.events import stream_fold

_NOT_DONE = "finish IS NULL AND error IS NULL"


@query(
    """SELECT sub_id, analysis_id, plate_acquisition_id, priority FROM sub_analyses WHERE start IS NULL AND error IS NULL""",
    "sub_analyses",
)
def pending_analyses(t):
    return A.pending(t.sub_analyses).select("sub_id", "analysis_id", "plate_acquisition_id", "priority")


@query(
    """SELECT sub_id, priority FROM sub_analyses WHERE start IS NULL AND error IS NULL ORDER BY priority NULLS LAST, sub_id""",
    "sub_analyses",
)
def queue_order(t):
    return A.queue_order(A.pending(t.sub_analyses)).select("sub_id", "priority")


@query(f"SELECT id, plate_acquisition_id FROM analyses WHERE {_NOT_DONE}", "analyses")
def unfinished_analyses(t):
    return A.unfinished(t.analyses).select("id", "plate_acquisition_id")


@query(
    f"SELECT sub_id, analysis_id FROM sub_analyses WHERE {_NOT_DONE} AND meta->>'$.run_on_uppmax' IS NOT NULL",
    "sub_analyses",
)
def unfinished_remote(t):
    return A.unfinished_remote(t.sub_analyses).select("sub_id", "analysis_id")


@query(
    """SELECT sub_id, CASE
      WHEN meta->>'$.run_on_uppmax' = 'true' AND meta->>'$.type' = 'cellprofiler' THEN 'remote'
      WHEN list_contains(json_keys(meta), 'run_on_uppmax') OR list_contains(json_keys(meta), 'run_on_hpcdev')
        OR list_contains(json_keys(meta), 'run_on_pelle') THEN 'external' ELSE 'cluster' END AS backend
    FROM sub_analyses""",
    "sub_analyses",
)
def route_analyses(t):
    return t.sub_analyses.select("sub_id", route(F.col("meta")).alias("backend"))


@query(
    """SELECT sub_id, CASE WHEN meta->>'$.type' IN ('cellprofiler', 'jupyter_notebook') THEN meta->>'$.type' ELSE 'unknown' END AS type
    FROM (SELECT sub_id, CASE WHEN sub_id % 23 = 0 THEN replace(meta, 'cellprofiler', 'other') ELSE meta END AS meta FROM sub_analyses)""",
    "sub_analyses",
)
def classify_type(t):
    odd = F.when(F.col("sub_id") % 23 == 0, F.replace(F.col("meta"), F.lit("cellprofiler"), F.lit("other")))
    return t.sub_analyses.select("sub_id", kind_of(odd.otherwise(F.col("meta"))).alias("type"))


@query(
    """SELECT sub_id, coalesce(CAST(meta->>'$.priority' AS INT), 0) AS meta_priority, coalesce(meta->>'$.job_timeout', '10800') AS job_timeout,
      false AS use_icf, coalesce(meta->>'$.sub_type', 'undefifed') AS sub_type, '/cpp_work/pipelines/' || (meta->>'$.pipeline_file') AS pipeline_file,
      coalesce(TRY_CAST(meta->>'$.max_errors' AS INT), 0) AS max_errors, coalesce(TRY_CAST(meta->>'$.batch_size' AS BIGINT), 1) AS batch_size,
      coalesce(meta->>'$.cp_version', CASE WHEN meta->>'$.run_on_uppmax' = 'true' AND meta->>'$.type' = 'cellprofiler' THEN 'v4.0.7' ELSE 'v4.2.5-cellpose2.0' END) AS cp_version,
      meta->>'$.z' AS z,
      array_to_string(CAST(json_extract(meta, '$.site_filter') AS VARCHAR[]), ',') AS sites,
      array_to_string(CAST(json_extract(meta, '$.channels') AS VARCHAR[]), ',') AS channels
    FROM sub_analyses""",
    "sub_analyses",
)
def settings(t):
    return with_settings(t.sub_analyses).select(
        "sub_id", "meta_priority", "job_timeout", "use_icf", "sub_type", "max_errors", "batch_size", "cp_version", "z", "pipeline_file",
        F.array_join(F.col("site_filter").cast("array<string>"), ",").alias("sites"),
        F.array_join("channels", ",").alias("channels"),
    )


@query(
    """SELECT sub_id, priority FROM sub_analyses s WHERE start IS NULL AND error IS NULL
    AND NOT EXISTS (SELECT 1 FROM sub_analyses d WHERE d.sub_id IN (s.dep1, s.dep2, s.dep3) AND d.finish IS NULL)""",
    "sub_analyses",
)
def ready_analyses(t):
    return A.ready(A.pending(t.sub_analyses), t.sub_analyses).select("sub_id", "priority")


@query(
    """SELECT s.sub_id, s.analysis_id, '/cpp_work/' AS mount_point,
      concat('results/', a.plate_barcode, '/', a.plate_acquisition_id, '/', a.id, '/') AS job_specific,
      concat('/cpp_work/results/', a.plate_barcode, '/', a.plate_acquisition_id, '/', a.id) AS full_path
    FROM sub_analyses s JOIN analyses a ON a.id = s.analysis_id""",
    "sub_analyses", "analyses",
)
def storage_paths(t):
    return A.sub_storage_paths(t.sub_analyses, t.analyses).withColumnRenamed("full", "full_path")


@query(
    """SELECT a.id AS analysis_id, s.sub_id, s.finish IS NOT NULL AS is_finished, s.error IS NOT NULL AS is_failed
    FROM analyses a JOIN sub_analyses s ON s.analysis_id = a.id WHERE a.finish IS NULL AND a.error IS NULL""",
    "analyses", "sub_analyses",
)
def children(t):
    return A.children(A.unfinished(t.analyses), t.sub_analyses).select(
        "analysis_id", "sub_id",
        F.col("finish").isNotNull().alias("is_finished"),
        F.col("error").isNotNull().alias("is_failed"),
    )


_ROLLUP = """cand AS (SELECT id FROM analyses WHERE finish IS NULL AND error IS NULL
    AND NOT list_contains(json_keys(meta), 'run_on_pelle') AND NOT list_contains(json_keys(meta), 'run_on_hpcdev')),
    state AS (SELECT id AS analysis_id, count(s.sub_id) AS n_children,
      CASE WHEN count(s.sub_id) = 0 THEN 'pending' WHEN count(s.error) > 0 THEN 'failed'
           WHEN count(s.finish) = count(s.sub_id) THEN 'finished' ELSE 'pending' END AS state
      FROM cand LEFT JOIN sub_analyses s ON s.analysis_id = id GROUP BY id)"""


@query(f"WITH {_ROLLUP} SELECT analysis_id, state, n_children FROM state", "analyses", "sub_analyses")
def rollup_analyses(t):
    return A.rollup(t.analyses, t.sub_analyses)


_COMPACT = """compact AS (SELECT DISTINCT sub_id, CASE WHEN lower(path) LIKE '%.png' OR lower(path) LIKE '%.jpg'
      OR lower(path) LIKE '%.tiff' OR lower(path) LIKE '%.tif'
      THEN CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') ELSE '' END || '/' ELSE path END AS path
    FROM manifest)"""
# Below the job folder a bare image name stands for that folder itself.
_FILES = """files AS (SELECT DISTINCT m.sub_id, concat('results/', plate_barcode, '/', plate_acquisition_id, '/', a.id, '/') AS job_folder,
      concat('results/', plate_barcode, '/', plate_acquisition_id, '/', a.id, '/',
        CASE WHEN lower(m.path) SIMILAR TO '.*\\.(png|jpg|tiff|tif)' THEN regexp_replace(m.path, '[^/]*$', '') ELSE m.path END) AS path
    FROM manifest m JOIN (SELECT sub_id, analysis_id FROM sub_analyses) s ON s.sub_id = m.sub_id
    JOIN (SELECT id, plate_barcode, plate_acquisition_id FROM analyses) a ON a.id = s.analysis_id)"""


@query(f"WITH {_COMPACT} SELECT sub_id, path FROM compact", "manifest")
def compact_files(t):
    return R.compact_files(t.manifest)


def _result_files(t):
    return R.result_files(t.manifest, A.sub_storage_paths(t.sub_analyses, t.analyses))


@query(
    f"""WITH {_FILES}
    SELECT sub_id, any_value(job_folder) AS job_folder, count(*) AS n_files, string_agg(path, '|' ORDER BY path) AS paths
    FROM files GROUP BY 1""",
    "manifest", "sub_analyses", "analyses",
)
def build_result(t):
    # The document is text whose key order differs between engines: compare what it says.
    documents = R.build_results(_result_files(t)).withColumn(
        "d", F.from_json("result", "job_folder string, file_list array<string>")
    )
    return documents.select(
        "sub_id", "d.job_folder", F.size("d.file_list").cast("bigint").alias("n_files"),
        F.array_join("d.file_list", "|").alias("paths"),
    )


_ROLLED = f"""{_ROLLUP}, {_FILES},
    members AS (SELECT s.analysis_id, s.sub_id FROM sub_analyses s JOIN state USING (analysis_id) WHERE state.state = 'finished'),
    last AS (SELECT analysis_id, arg_max(job_folder, sub_id) AS analysis_folder
      FROM members JOIN (SELECT DISTINCT sub_id, job_folder FROM files) USING (sub_id) GROUP BY 1),
    rolled AS (SELECT analysis_id, analysis_folder, sub_id, path FROM members JOIN files USING (sub_id) JOIN last USING (analysis_id))"""


def _rolled(t):
    storage = A.sub_storage_paths(t.sub_analyses, t.analyses)
    folders = storage.select("sub_id", F.col("job_specific").alias("job_folder"))
    return plan_rollup(t.analyses, t.sub_analyses, R.result_files(t.manifest, storage), folders).files


@query(f"WITH {_ROLLED} SELECT * FROM rolled", "manifest", "analyses", "sub_analyses")
def rollup_files(t):
    return _rolled(t)


@query(
    f"""WITH {_ROLLED} SELECT analysis_id, any_value(analysis_folder) AS job_folder, count(*) AS n_files,
      string_agg(path, '|' ORDER BY sub_id, path) AS paths FROM rolled GROUP BY 1""",
    "manifest", "analyses", "sub_analyses",
)
def analysis_results(t):
    documents = R.analysis_results(_rolled(t)).withColumn(
        "d", F.from_json("result", "job_folder string, file_list array<string>")
    )
    return documents.select(
        "analysis_id", "d.job_folder", F.size("d.file_list").cast("bigint").alias("n_files"),
        F.array_join("d.file_list", "|").alias("paths"),
    )


@query(
    """SELECT 'sub' AS level, sub_id AS id, status_key, arg_max(status_value, (ts, seq)) AS status_value
    FROM status_events GROUP BY ALL
    UNION ALL
    SELECT 'analysis', analysis_id, concat(status_key, '_', sub_id), arg_max(status_value, (ts, seq))
    FROM status_events GROUP BY ALL""",
    "status_events",
)
def merge_status(t):
    return A.merge_status(t.status_events)


@query(
    """WITH rows AS (SELECT 'sub' AS level, sub_id AS id, status_key, arg_max(status_value, (ts, seq)) AS v FROM status_events GROUP BY ALL
      UNION ALL SELECT 'analysis', analysis_id, concat(status_key, '_', sub_id), arg_max(status_value, (ts, seq)) FROM status_events GROUP BY ALL)
    SELECT level, id, count(*) AS n_keys, string_agg(concat(status_key, '=', v), '|' ORDER BY status_key) AS entries FROM rows GROUP BY 1, 2""",
    "status_events",
)
def status_documents(t):
    # Key order of JSON text differs between engines: compare the entries.
    documents = R.status_documents(A.merge_status(t.status_events)).withColumn(
        "m", F.map_entries(F.from_json("status", "map<string,string>"))
    )
    entries = F.transform(F.array_sort("m"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return documents.select(
        "level", "id", F.size("m").cast("bigint").alias("n_keys"), F.array_join(entries, "|").alias("entries")
    )


def _lifecycle_sql(key: str, level: str, start: str) -> str:
    return f"""SELECT '{level}' AS level, id, {start}(ts, seq) FILTER (kind = 'start') AS start,
      arg_max(ts, seq) FILTER (kind = 'finish') AS finish, arg_max(ts, seq) FILTER (kind = 'error') AS error
    FROM (SELECT {key} AS id, ts, seq, kind, max(CASE WHEN kind = 'reset' THEN seq END) OVER (PARTITION BY {key}) AS r
          FROM lifecycle_events) WHERE r IS NULL OR seq >= r GROUP BY id"""


@query(
    _lifecycle_sql("sub_id", "sub", "arg_max") + "\nUNION ALL\n" + _lifecycle_sql("analysis_id", "analysis", "arg_min"),
    "lifecycle_events",
)
def lifecycle(t):
    subs = A.lifecycle(t.lifecycle_events, "sub_id", first_start=False)
    parents = A.lifecycle(t.lifecycle_events, "analysis_id", first_start=True)
    return subs.select(F.lit("sub").alias("level"), "*").unionByName(
        parents.select(F.lit("analysis").alias("level"), "*")
    )


def _growing(t, events, fold):
    """The result of folding the log in three stretches, each after a restart."""
    log, folder, checkpoint = (shared_folder(t.spark, f"events-{name}") for name in ("log", "snapshots", "offsets"))
    last = events.agg(F.max("seq").alias("n")).first()["n"]
    for low, high in ((None, last // 3), (last // 3, 2 * last // 3), (2 * last // 3, last)):
        stretch = events.where((F.col("seq") <= high) & (F.lit(True) if low is None else F.col("seq") > low))
        stretch.write.mode("append").parquet(log)
        stream_fold(t.spark.readStream.schema(events.schema).parquet(log), fold, folder, checkpoint).awaitTermination()
    return folded(t.spark, fold, folder)


@query(ORACLES["merge_status"])
def fold_status_events(t):
    """The status by snapshots of a log that grows."""
    return _growing(t, t.status_events, StatusFold())


@query(ORACLES["lifecycle"])
def fold_lifecycle_events(t):
    """The times by snapshots of a log that grows."""
    subs = _growing(t, t.lifecycle_events, LifecycleFold("sub_id", first_start=False))
    parents = _growing(t, t.lifecycle_events, LifecycleFold("analysis_id", first_start=True))
    return subs.select(F.lit("sub").alias("level"), "*").unionByName(parents.select(F.lit("analysis").alias("level"), "*"))


def _read_documents(manifest, id: str):
    """What the documents of a manifest say."""
    texts = read_published(manifest, whole=True)
    number = F.regexp_extract("path", "/([0-9]+)[.]json$", 1).cast("bigint")
    documents = texts.select(number.alias(id), F.from_json("value", "job_folder string, file_list array<string>").alias("d"))
    return documents.select(
        id, "d.job_folder", F.size("d.file_list").cast("bigint").alias("n_files"), F.array_join("d.file_list", "|").alias("paths")
    )


@query(ORACLES["build_result"])
def write_documents(t):
    """The documents of sub-analyses as files, read back."""
    top = shared_folder(t.spark, "documents")
    return _read_documents(sinks.write_documents(_result_files(t), "sub_id", "job_folder", top), "sub_id")


@query(ORACLES["analysis_results"])
def write_analysis_documents(t):
    """The documents of analyses as files, read back."""
    top = shared_folder(t.spark, "documents")
    return _read_documents(sinks.write_documents(_rolled(t), "analysis_id", "analysis_folder", top, ("sub_id", "path")), "analysis_id")


_RANGES = """SELECT o_orderkey AS sub_id, CASE o_orderkey % 5
      WHEN 0 THEN concat(o_orderkey % 7, '-', o_orderkey % 4, ',', o_orderkey % 11)
      WHEN 1 THEN concat('-', o_orderkey % 9 + 1) WHEN 2 THEN concat(o_orderkey % 6, ', ', o_orderkey % 3, ',', o_orderkey % 6)
      WHEN 3 THEN concat(o_orderkey % 3, '-', o_orderkey % 8, '-', o_orderkey % 2) ELSE concat(o_orderkey % 3, ',x') END AS text
    FROM orders"""


@query(
    f"""WITH texts AS ({_RANGES}), parsed AS (SELECT *, string_split(text, ',') AS parts,
      CASE WHEN text LIKE '%x%' OR text LIKE '-%' THEN NULL ELSE
        list_transform(string_split(text, ','), lambda e: list_transform(string_split(e, '-'), lambda p: CAST(trim(p) AS INT))) END AS ends
      FROM texts)
    SELECT sub_id, text, CASE WHEN text LIKE '-%' THEN text ELSE
      array_to_string(list_sort(list_distinct(flatten(list_transform(ends, lambda e: range(list_min(e), list_max(e) + 1))))), ',') END AS numbers
    FROM parsed""",
)
def parse_ranges(t):
    t.base("orders").createOrReplaceTempView("orders")
    texts = t.spark.sql(_RANGES)
    numbers = F.array_join(PF.parse_ranges(F.col("text")).cast("array<string>"), ",")
    return texts.select("sub_id", "text", numbers.alias("numbers"))


@query(
    """SELECT path, regexp_extract(path, '[^/]*$') AS file_name, regexp_replace(path, '/[^/]*$', '') AS folder,
      'file:' || path AS url FROM images_raw""",
    "images_raw",
)
def path_parts(t):
    path = F.col("path")
    return t.images.select(
        "path", PF.base_name(path).alias("file_name"), PF.dir_name(path).alias("folder"), PF.file_url(path).alias("url")
    )


_RUNS = "SELECT sub_id, analysis_id, sub_id % 9 AS job_number, 9 + sub_id % 5 AS n_jobs, concat('x', sub_id % 100) AS run_id FROM sub_analyses"


def _runs(t):
    return t.sub_analyses.select(
        "sub_id", "analysis_id", (F.col("sub_id") % 9).alias("job_number"), (9 + F.col("sub_id") % 5).alias("n_jobs"),
        F.concat(F.lit("x"), (F.col("sub_id") % 100).cast("string")).alias("run_id"),
    )


_NAME = "concat('cpp-worker-job-', sub_id, '-', run_id, '-', job_number, '-', n_jobs, '-', analysis_id)"
_NAME_PARTS = ("sub_id", "run_id", "job_number", "n_jobs", "analysis_id")


@query(f"SELECT sub_id, {_NAME} AS job_name FROM ({_RUNS})", "sub_analyses")
def job_name(t):
    return _runs(t).select("sub_id", PF.job_name(*[F.col(part) for part in _NAME_PARTS]).alias("job_name"))


@query(
    f"""SELECT sub_id, concat('/cpp_work/input/', sub_id, '/', n, '.csv') AS imageset_file,
      concat('/cpp_work/input/', sub_id, '/', n, '.yaml') AS job_yaml_file, concat('/cpp_work/output/', sub_id, '/', n, '/') AS output_path
    FROM (SELECT sub_id, {_NAME} AS n FROM ({_RUNS}))""",
    "sub_analyses",
)
def job_paths(t):
    name = PF.job_name(*[F.col(part) for part in _NAME_PARTS])
    return _runs(t).select("sub_id", PF.job_paths(F.col("sub_id"), name).alias("p")).select("sub_id", "p.*")


@query(
    """SELECT sub_id, CASE WHEN contains(reply, 'Submitted batch job') THEN split_part(split_part(reply, 'Submitted batch job ', 2), ' ', 1) END AS batch_id
    FROM submissions""",
    "submissions",
)
def parse_batch_id(t):
    return t.submissions.select("sub_id", PF.batch_id(F.col("reply")).alias("batch_id"))
