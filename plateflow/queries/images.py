"""Queries over the image catalogue and its image sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from plateflow import functions as PF
from plateflow.fixtures import DYES
from plateflow.functions.settings import with_settings
from plateflow.operators import analyses as A
from plateflow.operators import images as I
from plateflow.operators import imagesets as S
from plateflow.operators.jobs import job_commands
from plateflow.operators.ranking import with_places
from plateflow.operators.validation import validate as find_problems
from plateflow.plans.submit import plan_submission
from plateflow.queries.base import query

_PENDING = "pend AS (SELECT * FROM sub_analyses WHERE start IS NULL AND error IS NULL)"
_MID = """mid AS (SELECT plate_acquisition_id, zs[(len(zs) + 1) // 2] AS middle_z
  FROM (SELECT plate_acquisition_id, list_sort(list(DISTINCT z)) AS zs FROM images_raw GROUP BY 1))"""
_Z_LIST = """list_sort(list_distinct(flatten(list_transform(string_split(meta->>'$.z', ','),
  lambda e: range(list_min(list_transform(string_split(e, '-'), lambda p: CAST(p AS INT))),
                  list_max(list_transform(string_split(e, '-'), lambda p: CAST(p AS INT))) + 1)))))"""
_FILTERS = f"""filters AS (SELECT s.*, CAST(json_extract(meta, '$.site_filter') AS INT[]) AS sites,
    CAST(json_extract(meta, '$.channels') AS VARCHAR[]) AS chans,
    CASE WHEN meta->>'$.z' IS NOT NULL THEN {_Z_LIST} ELSE [middle_z] END AS zs
  FROM pend s LEFT JOIN mid USING (plate_acquisition_id))"""
_MATCH = """(sites IS NULL OR list_contains(sites, site)) AND (chans IS NULL OR list_contains(chans, dye))
  AND list_contains(zs, z)"""
_SETS = """sets AS (SELECT DISTINCT plate_acquisition_id, plate_barcode, timepoint, well, site, z FROM images_raw)"""


@query(
    "SELECT * FROM (SELECT DISTINCT plate_acquisition_id, plate_barcode, timepoint, well, site, z, channel, dye, path FROM images_raw)",
    "images_raw",
)
def distinct_images(t):
    return I.distinct_images(t.images)


@query(f"WITH {_MID} SELECT plate_acquisition_id, CAST(middle_z AS INT) AS middle_z FROM mid", "images_raw")
def middle_z(t):
    return I.middle_z(t.images)


@query("SELECT plate_acquisition_id, min(z) AS min_z FROM images_raw GROUP BY 1", "images_raw")
def first_z(t):
    return I.first_z(t.images)


@query(
    """SELECT p.id AS plate_acquisition_id, m.map_id, m.channel, m.dye
    FROM plate_acquisition p JOIN channel_map m ON p.channel_map_id = m.map_id""",
    "plate_acquisition", "channel_map",
)
def acquisition_channels(t):
    return I.acquisition_channels(t.plate_acquisition, t.channel_map)


@query(
    f"""WITH {_PENDING}
    SELECT s.sub_id, m.channel, m.dye
    FROM pend s JOIN plate_acquisition p ON p.id = s.plate_acquisition_id
    JOIN channel_map m ON m.map_id = p.channel_map_id
    WHERE json_extract(meta, '$.channels') IS NULL
       OR list_contains(CAST(json_extract(meta, '$.channels') AS VARCHAR[]), m.dye)""",
    "sub_analyses", "plate_acquisition", "channel_map",
)
def filter_channel_map(t):
    wanted = with_settings(A.pending(t.sub_analyses)).select("sub_id", "plate_acquisition_id", "channels")
    channels = I.acquisition_channels(t.plate_acquisition, t.channel_map)
    return I.filter_channel_map(wanted.join(channels, "plate_acquisition_id")).select("sub_id", "channel", "dye")


@query(
    f"""WITH {_PENDING}
    SELECT sub_id, count(*) AS n_images, CAST(sum(timepoint * 10000 + site * 1000 + z * 100 + channel) AS BIGINT) AS key_sum,
      min(path) AS first_path, max(path) AS last_path
    FROM pend JOIN images_raw USING (plate_acquisition_id) GROUP BY 1""",
    "sub_analyses", "images_raw",
)
def images_for_analyses(t):
    pending = A.pending(t.sub_analyses).select("sub_id", "plate_acquisition_id")
    images = with_places(I.images_of(t.images, pending), "path", "place")
    # Each has the images of a whole plate: a fixed number of tasks share them.
    tasks = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    joined = I.images_for_analyses(images, pending.repartition(tasks, "sub_id"))
    ends = joined.groupBy("sub_id").agg(
        F.count(F.lit(1)).alias("n_images"),
        F.sum(F.expr("timepoint * 10000 + site * 1000 + z * 100 + channel")).alias("key_sum"),
        F.min("place").alias("first_place"),
        F.max("place").alias("last_place"),
    )
    for end in ("first", "last"):
        ends = ends.join(images.select(F.col("place").alias(f"{end}_place"), F.col("path").alias(f"{end}_path")), f"{end}_place", "left")
    return ends.select("sub_id", "n_images", "key_sum", "first_path", "last_path")


@query(
    f"""WITH {_PENDING}, {_MID}, {_FILTERS}
    SELECT DISTINCT sub_id, path FROM filters JOIN images_raw USING (plate_acquisition_id) WHERE {_MATCH}""",
    "sub_analyses", "images_raw",
)
def select_images(t):
    analyses = with_settings(A.pending(t.sub_analyses))
    return I.select_images(t.images, analyses).select("sub_id", "path")


@query(
    """SELECT plate_acquisition_id, timepoint, well, site, channel, z, path FROM images_raw
    ORDER BY timepoint, well, site, channel, z, plate_acquisition_id, path""",
    "images_raw",
)
def image_order(t):
    return I.order_images(t.images).select(
        "plate_acquisition_id", "timepoint", "well", "site", "channel", "z", "path"
    )


@query(
    """SELECT plate_acquisition_id, concat('tp', timepoint, '-', well, '-', site, '-', z) AS imgset_id,
      count(*) AS n_images, string_agg(concat(channel, ':', dye, ':', path), '|' ORDER BY channel, dye, path) AS images
    FROM (SELECT DISTINCT * FROM images_raw) GROUP BY plate_acquisition_id, timepoint, well, site, z""",
    "images_raw",
)
def image_sets(t):
    members = F.transform(
        "images", lambda image: F.concat_ws(":", image["channel"].cast("string"), image["dye"], image["path"])
    )
    return S.image_sets(t.images).select(
        "plate_acquisition_id",
        "imgset_id",
        F.size("images").cast("bigint").alias("n_images"),
        F.array_join(members, "|").alias("images"),
    )


@query(
    """SELECT path, concat('tp', timepoint, '-', well, '-', site, '-', z) AS imgset_id FROM images_raw""",
    "images_raw",
)
def image_set_id(t):
    return t.images.select("path", PF.image_set_id(*[F.col(key) for key in S.SET_KEYS]).alias("imgset_id"))


_NUMBERED = f"""{_SETS}, numbered AS (SELECT *,
    row_number() OVER (PARTITION BY plate_acquisition_id ORDER BY timepoint, well, site, z) - 1 AS i,
    count(*) OVER (PARTITION BY plate_acquisition_id) AS n FROM sets)"""


def _batches(t, size: int):
    sets = t.images.select(*S.SET_COLUMNS).dropDuplicates()
    return S.assign_batches(sets, size, ("plate_acquisition_id",), largest=S.most_images(t.images))


@query(
    f"""WITH {_NUMBERED}
    SELECT plate_acquisition_id, timepoint, well, site, z, i // 7 AS job_number,
           CAST(ceil(n / 7.0) AS BIGINT) AS n_jobs, i % 7 AS image_number FROM numbered""",
    "images_raw",
)
def assign_batches(t):
    return _batches(t, 7).drop("plate_barcode")


@query(
    f"""WITH {_NUMBERED}
    SELECT plate_acquisition_id, i // 10 AS job_number, count(*) AS n_sets, min(i % 10) AS first_number, max(i % 10) AS last_number
    FROM numbered GROUP BY 1, 2""",
    "images_raw",
)
def image_number(t):
    return _batches(t, 10).groupBy("plate_acquisition_id", "job_number").agg(
        F.count(F.lit(1)).alias("n_sets"),
        F.min("image_number").alias("first_number"),
        F.max("image_number").alias("last_number"),
    )


@query(
    f"""WITH {_NUMBERED}
    SELECT plate_acquisition_id, timepoint, well, site, z, i // 7 AS job_number FROM numbered WHERE i // 7 < 3""",
    "images_raw",
)
def limit_jobs(t):
    return S.limit_jobs(_batches(t, 7), 3).select("plate_acquisition_id", *S.SET_KEYS, "job_number")


def _wide_sql(dyes: list[str]) -> dict[str, list[str]]:
    base = "regexp_extract({p}, '[^/]*$')"
    return {
        "files": [f"{base.format(p=f'p_{dye}')} AS FileName_{dye}" for dye in dyes],
        "folders": [f"regexp_replace(p_{dye}, '/[^/]*$', '') AS PathName_{dye}" for dye in dyes],
        "urls": [f"'file:' || p_{dye} AS URL_{dye}" for dye in dyes],
    }


_PIVOT = ", ".join(f"max(path) FILTER (m.dye = '{dye}') AS p_{dye}" for dye in DYES)
_PRESENT = " + ".join(f"CASE WHEN p_{dye} IS NULL THEN 0 ELSE 1 END" for dye in DYES)
_ITEMS = _wide_sql(DYES)
_WIDE_FROM = """images_raw i JOIN plate_acquisition p ON p.id = i.plate_acquisition_id
    JOIN channel_map m ON m.map_id = p.channel_map_id AND m.channel = i.channel"""


@query(
    f"""WITH {_MID},
    wide AS (SELECT i.plate_acquisition_id, i.plate_barcode, timepoint, well, site, z, m.map_id, {_PIVOT}
      FROM {_WIDE_FROM} GROUP BY ALL),
    focus AS (SELECT w.*, (SELECT count(*) FROM channel_map c WHERE c.map_id = w.map_id) AS n_dyes
      FROM wide w JOIN mid ON mid.plate_acquisition_id = w.plate_acquisition_id AND mid.middle_z = w.z),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY plate_acquisition_id ORDER BY timepoint, well, site, z) - 1 AS i,
      count(*) OVER (PARTITION BY plate_acquisition_id) AS n FROM focus)
    SELECT i // 7 AS job_number, CAST(ceil(n / 7.0) AS BIGINT) AS n_jobs, {_PRESENT} = n_dyes AS is_complete,
      {', '.join(_ITEMS['files'])}, i % 7 AS Group_Index, 1 AS Group_Number, i % 7 AS ImageNumber,
      plate_barcode AS Metadata_Barcode, site AS Metadata_Site, well AS Metadata_Well,
      plate_acquisition_id AS Metadata_AcqID, z AS Metadata_z,
      {', '.join(_ITEMS['folders'])}, {', '.join(_ITEMS['urls'])}
    FROM numbered""",
    "images_raw", "plate_acquisition", "channel_map",
)
def image_set_table(t):
    return S.image_set_table(t.images, t.plate_acquisition, t.channel_map, batch_size=7)


_ICF = ", ".join(
    [f"CASE WHEN u THEN 'file:' || f || '/ICF_{dye}.npy' END AS URL_ICF_{dye}" for dye in DYES]
    + [f"CASE WHEN u THEN f END AS PathName_ICF_{dye}" for dye in DYES]
    + [f"CASE WHEN u THEN 'ICF_{dye}.npy' END AS FileName_ICF_{dye}" for dye in DYES]
)


@query(
    f"""WITH {_SETS}
    SELECT plate_acquisition_id, timepoint, well, site, z, {_ICF}
    FROM (SELECT *, timepoint <> 2 AS u,
            concat('/cpp_work/results/', plate_barcode, '/', plate_acquisition_id, '/', site) AS f FROM sets)""",
    "images_raw",
)
def icf_columns(t):
    sets = t.images.select(*S.SET_COLUMNS).dropDuplicates()
    storage = PF.storage_paths(
        F.col("plate_barcode"), F.col("plate_acquisition_id").cast("string"), F.col("site").cast("string")
    )
    return S.with_icf_columns(sets, DYES, storage["full"], F.col("timepoint") != 2).drop("plate_barcode")


@query(
    f"""WITH {_PENDING}, {_MID}, {_FILTERS},
    typed AS (SELECT *, meta->>'$.type' AS kind FROM filters WHERE meta->>'$.type' = 'cellprofiler')
    SELECT sub_id, 'Channel map is empty' AS problem FROM typed t
    WHERE NOT EXISTS (SELECT 1 FROM plate_acquisition p JOIN channel_map m ON m.map_id = p.channel_map_id
      WHERE p.id = t.plate_acquisition_id AND (chans IS NULL OR list_contains(chans, m.dye)))
    UNION ALL
    SELECT sub_id, 'No images found for the analysis with the input data ....' FROM typed
    WHERE sub_id NOT IN (SELECT sub_id FROM typed JOIN images_raw USING (plate_acquisition_id) WHERE {_MATCH})
    UNION ALL
    SELECT sub_id, concat('Unknown Analysis type: ', meta->>'$.type') FROM pend
    WHERE meta->>'$.type' NOT IN ('cellprofiler', 'jupyter_notebook')
    UNION ALL
    SELECT sub_id, 'No pipeline file is named' FROM typed WHERE meta->>'$.pipeline_file' IS NULL
    UNION ALL
    SELECT sub_id, 'Setting that cannot be read: batch_size' FROM pend WHERE TRY_CAST(meta->>'$.batch_size' AS BIGINT) IS NULL
    UNION ALL
    SELECT sub_id, 'Setting that cannot be read: max_errors' FROM pend
    WHERE meta->>'$.max_errors' IS NOT NULL AND TRY_CAST(meta->>'$.max_errors' AS INT) IS NULL""",
    "sub_analyses", "images_raw", "plate_acquisition", "channel_map",
)
def validate(t):
    return find_problems(A.pending(t.sub_analyses), t.images, t.plate_acquisition, t.channel_map)


_READY = """ready AS (SELECT * FROM pend s WHERE NOT EXISTS (SELECT 1 FROM sub_analyses d
    WHERE d.sub_id IN (s.dep1, s.dep2, s.dep3) AND d.finish IS NULL))"""
_RUNNABLE = """runnable AS (SELECT * FROM filters WHERE sub_id IN (SELECT sub_id FROM ready)
    AND meta->>'$.type' = 'cellprofiler' AND meta->>'$.pipeline_file' IS NOT NULL AND TRY_CAST(meta->>'$.batch_size' AS BIGINT) IS NOT NULL
    AND (meta->>'$.max_errors' IS NULL OR TRY_CAST(meta->>'$.max_errors' AS INT) IS NOT NULL)
    AND (meta->>'$.run_on_uppmax' = 'true' OR NOT (list_contains(json_keys(meta), 'run_on_uppmax')
      OR list_contains(json_keys(meta), 'run_on_hpcdev') OR list_contains(json_keys(meta), 'run_on_pelle'))))"""


@query(
    f"""WITH {_PENDING}, {_MID}, {_READY}, {_FILTERS}, {_RUNNABLE},
    chosen AS (SELECT DISTINCT r.sub_id, r.analysis_id, TRY_CAST(meta->>'$.batch_size' AS BIGINT) AS size,
        i.timepoint, i.well, i.site, i.z
      FROM runnable r JOIN images_raw i USING (plate_acquisition_id)
      JOIN plate_acquisition p ON p.id = i.plate_acquisition_id
      JOIN channel_map m ON m.map_id = p.channel_map_id AND m.channel = i.channel
      WHERE (sites IS NULL OR list_contains(sites, i.site)) AND (chans IS NULL OR list_contains(chans, m.dye))
        AND list_contains(zs, i.z)),
    counted AS (SELECT sub_id, analysis_id, count(*) AS n, CASE WHEN any_value(size) <= 0 THEN count(*) ELSE any_value(size) END AS size
      FROM chosen GROUP BY 1, 2),
    numbered AS (SELECT sub_id, analysis_id, n, size, unnest(range(CAST(ceil(n * 1.0 / size) AS BIGINT))) AS job_number,
      CAST(ceil(n * 1.0 / size) AS BIGINT) AS n_jobs FROM counted)
    SELECT sub_id, job_number, n_jobs,
      concat('cpp-worker-job-', sub_id, '-run1-', job_number, '-', n_jobs, '-', analysis_id) AS job_name,
      CAST(least(size, n - job_number * size) AS BIGINT) AS n_image_sets FROM numbered""",
    "sub_analyses", "images_raw", "plate_acquisition", "channel_map",
)
def submission_jobs(t):
    plan = plan_submission(
        t.images, t.sub_analyses, t.analyses, t.plate_acquisition, t.channel_map, run_id=F.lit("run1")
    )
    return plan.jobs.select("sub_id", "job_number", "n_jobs", "job_name", "n_image_sets")


@query(
    """SELECT sub_id, job_name,
      concat(' timeout 10800 cellprofiler -r -c -p /cpp_work/pipelines/p', sub_id % 7, '.cppipe --data-file /cpp_work/input/', sub_id, '/',
        job_name, '.csv -o /cpp_work/output/', sub_id, '/', job_name, '/ --plugins-directory /CellProfiler/plugins') AS command,
      concat('registry.example/worker:', CASE WHEN sub_id % 2 = 0 THEN 'v4.0.7' ELSE 'v4.2.5-cellpose2.0' END, '-stable') AS image
    FROM (SELECT job_name, CAST(split_part(job_name, '-', 4) AS BIGINT) AS sub_id FROM jobs)""",
    "jobs",
)
def job_commands_(t):
    jobs = t.jobs.select("job_name", PF.parse_job_name(F.col("job_name"))["sub_id"].alias("sub_id")).withColumns(
        {
            "pipeline_file": F.concat(F.lit("/cpp_work/pipelines/p"), (F.col("sub_id") % 7).cast("string"), F.lit(".cppipe")),
            "job_timeout": F.lit("10800"),
            "cp_version": F.when(F.col("sub_id") % 2 == 0, "v4.0.7").otherwise("v4.2.5-cellpose2.0"),
        }
    )
    return job_commands(jobs, "registry.example/worker")
