"""Queries that write and read files: catalogue, job outputs, merged tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateflow.fixtures import DYES
from plateflow.operators import analyses as A
from plateflow.operators import imagesets as S
from plateflow.operators import jobs as J
from plateflow.operators.apply import map_batches as run_batches
from plateflow.operators.files import result_manifest as manifest_of
from plateflow.plans.collect import collect_results, joined
from plateflow.queries.base import ORACLES, query
from plateflow.queries.images import _NUMBERED
from plateflow.queries.jobs import _FAMILIES, _PARSED, status_of
from plateflow.queries.trees import job_trees, measurement_tree
from plateflow.session import shared_folder, together, written
from plateflow.sources import catalog, job_csv, job_tables, listing, sinks
from plateflow.sources.publish import read_published


@query(
    """SELECT 'images' AS table_name, count(*) AS n_rows, count(DISTINCT path) AS n_keys FROM images_raw
    UNION ALL SELECT 'channel_map', count(*), count(DISTINCT map_id) FROM channel_map
    UNION ALL SELECT 'plate_acquisition', count(*), count(DISTINCT id) FROM plate_acquisition
    UNION ALL SELECT 'image_analyses', count(*), count(DISTINCT id) FROM analyses
    UNION ALL SELECT 'image_sub_analyses', count(*), count(DISTINCT sub_id) FROM sub_analyses""",
    "images_raw", "channel_map", "plate_acquisition", "analyses", "sub_analyses",
)
def read_catalog(t):
    folder = shared_folder(t.spark, "catalog")
    tables = {
        "images": t.images, "channel_map": t.channel_map, "plate_acquisition": t.plate_acquisition,
        "image_analyses": t.analyses, "image_sub_analyses": t.sub_analyses,
    }
    catalog.write_catalog(tables, folder)
    keys = {"images": "path", "channel_map": "map_id", "image_sub_analyses": "sub_id"}
    counts = None
    for name, table in catalog.read_catalog(t.spark, folder).items():
        row = table.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct(keys.get(name, "id")).alias("n_keys"),
        )
        counts = row if counts is None else counts.unionByName(row)
    return counts


_JOB_FILES = f"""{_PARSED}, tree AS (SELECT sub_id, job_name, unnest(list_filter(['cp.log', 'masks/m.tiff', 'Nuclei.csv', 'Experiment.csv',
      CASE cond_type WHEN 'Failed' THEN 'error' WHEN 'Complete' THEN 'finished' END], lambda f: f IS NOT NULL)) AS rel_path FROM named)"""


@query(
    f"WITH {_JOB_FILES} SELECT sub_id, job_name, rel_path, regexp_extract(rel_path, '[^/]*$') AS file_name FROM tree", "jobs"
)
def scan_job_outputs(t):
    parts = []
    for _, roots in job_trees(t):
        found = listing.scan_job_outputs(roots)
        files = found.where("NOT is_dir").select("sub_id", "job_name", "rel_path", F.col("table").alias("file_name"))
        parts.append(written(files, "files"))
    return together(parts)


@query(
    f"""WITH {_PARSED} SELECT sub_id, job_name,
      CASE cond_type WHEN 'Failed' THEN 'error' WHEN 'Complete' THEN 'finished' ELSE 'running' END AS state FROM named""",
    "jobs",
)
def marker_status(t):
    parts = [written(listing.marker_status(listing.scan_job_outputs(roots)), "markers") for _, roots in job_trees(t)]
    return together(parts)


@query(
    f"""WITH {_FAMILIES}, done AS (SELECT job_family FROM families WHERE done = total)
    SELECT sub_id, 'masks/m.tiff' AS path, count(*) AS n_files FROM named JOIN done USING (job_family) WHERE cond_type IS NOT NULL GROUP BY 1
    UNION ALL SELECT DISTINCT sub_id, 'Nuclei.parquet', 1 FROM named JOIN done USING (job_family)""",
    "jobs",
)
def result_manifest(t):
    parts = []
    for own, roots in job_trees(t):
        states = J.job_states(status_of(own))
        complete = J.complete_families(J.job_families(states)).select("job_family")
        jobs = J.finished(states).join(complete, "job_family", "left_semi")
        found = listing.scan_job_outputs(roots.join(jobs.select("sub_id").dropDuplicates(), "sub_id", "left_semi"))
        files, _ = listing.exclude_tables(listing.csv_tables(found))
        manifest = manifest_of(found, jobs, files.select("sub_id", "table").dropDuplicates())
        parts.append(written(manifest.groupBy("sub_id", "path").agg(F.count(F.lit(1)).alias("n_files")), "manifest"))
    return together(parts)


_COLLECTED = f"""WITH {_FAMILIES}, fresh AS (SELECT job_family FROM families WHERE done = total AND sub_id % 5 <> 0)"""


def _collect(t):
    folders = A.sub_storage_paths(t.sub_analyses, t.analyses).select("sub_id", "job_specific")
    parts = []
    for own, roots in job_trees(t):
        families = J.job_families(J.job_states(status_of(own)))
        parts.append(collect_results(t.spark, status_of(own), roots, folders, processed=families.where("sub_id % 5 = 0")))
    return joined(parts)


@query(
    f"""{_COLLECTED} SELECT sub_id, CAST(split_part(job_name, '-', 6) AS INT) AS ImageNumber, n_jobs + 0.5::DOUBLE AS Area
    FROM named JOIN fresh USING (job_family)""",
    "jobs",
)
def collect_tables(t):
    """The typed table of all families, by family."""
    (_, table), = _collect(t).tables
    return table.select("sub_id", "ImageNumber", F.col("Area").cast("double").alias("Area"))


@query(
    f"""{_COLLECTED} SELECT concat('results/', plate_barcode, '/', a.plate_acquisition_id, '/', a.id, '/Nuclei.parquet') AS path,
      CAST(split_part(job_name, '-', 6) AS INT) AS ImageNumber, n_jobs + 0.5::DOUBLE AS Area
    FROM named JOIN fresh USING (job_family) JOIN sub_analyses s USING (sub_id) JOIN analyses a ON a.id = s.analysis_id""",
    "jobs", "sub_analyses", "analyses",
)
def write_result_tables(t):
    """The files that the result documents name, written and read back."""
    top = shared_folder(t.spark, "results")
    done = _collect(t).write_tables(top)
    rows = t.spark.read.schema("ImageNumber int, Area float").option("recursiveFileLookup", True).parquet(top)
    path = F.regexp_extract("_metadata.file_path", "/(results/[^/]*/[^/]*/[^/]*/[^/]*)$", 1)
    back = rows.select(path.alias("path"), "ImageNumber", F.col("Area").cast("double").alias("Area"))
    written = done.select(F.regexp_extract("path", "/(results/[^/]*/[^/]*/[^/]*/[^/]*)$", 1).alias("path"))
    return back.join(written.dropDuplicates(), "path", "left_semi")


@query(
    f"""{_COLLECTED}, owners AS (SELECT DISTINCT sub_id FROM named JOIN fresh USING (job_family))
    SELECT o.sub_id, concat('results/', plate_barcode, '/', a.plate_acquisition_id, '/', a.id, '/') AS job_folder,
      concat('results/', plate_barcode, '/', a.plate_acquisition_id, '/', a.id, '/Nuclei.parquet|results/', plate_barcode, '/', a.plate_acquisition_id, '/', a.id, '/masks/') AS paths
    FROM owners o JOIN sub_analyses s ON s.sub_id = o.sub_id JOIN analyses a ON a.id = s.analysis_id""",
    "jobs", "sub_analyses", "analyses",
)
def collect_documents(t):
    documents = _collect(t).results.withColumn(
        "d", F.from_json("result", "job_folder string, file_list array<string>")
    )
    return documents.select("sub_id", "d.job_folder", F.array_join("d.file_list", "|").alias("paths"))


_MEASURED = """SELECT CAST(ImageNumber AS INT) AS ImageNumber, CAST(ObjectNumber AS INT) AS ObjectNumber,
    round(CAST(CAST(AreaShape_Area AS REAL) AS DOUBLE), 2) AS AreaShape_Area,
    round(CAST(CAST(Intensity_Mean AS REAL) AS DOUBLE), 2) AS Intensity_Mean, Metadata_Well FROM measurements"""


def _rounded(df):
    """Compare 32-bit numbers as rounded doubles."""
    return df.withColumns(
        {name: F.round(F.col(name).cast("double"), 2) for name in ("AreaShape_Area", "Intensity_Mean")}
    )


def _merged(t, table: str = "Nuclei.csv"):
    root = measurement_tree(t, table)
    roots = t.spark.createDataFrame([(1, root)], "sub_id bigint, root string")
    files = listing.csv_tables(listing.scan_job_outputs(roots))
    return root, files


@query(_MEASURED, "measurements")
def merge_csv(t):
    _, files = _merged(t)
    return _rounded(job_tables.merge_table(files, "Nuclei.csv"))


def _infer_sql(name: str) -> str:
    value = f"CAST({name} AS VARCHAR)"
    return f"""SELECT '{name}' AS column_name, count({name}) AS n_values, count(*) - count({name}) AS n_missing,
      CASE WHEN count(*) FILTER (regexp_full_match({value}, '[+-]?[0-9]+')) = count({name}) THEN 'int'
           WHEN count(TRY_CAST({value} AS DOUBLE)) = count({name}) THEN 'float' ELSE 'string' END AS narrow_type FROM measurements"""


@query(
    "\nUNION ALL\n".join(
        _infer_sql(name) for name in ("ImageNumber", "ObjectNumber", "AreaShape_Area", "Intensity_Mean", "Metadata_Well")
    ),
    "measurements",
)
def infer_types(t):
    root, files = _merged(t)
    header = job_csv.first_header(job_csv.csv_headers(files))
    raw = job_csv.read_job_csv(t.spark, [root], "Nuclei.csv", header)
    return job_csv.infer_types(raw).select(
        F.col("column").alias("column_name"), "n_values", "n_missing", "narrow_type"
    )


@query(
    _MEASURED.replace(" FROM measurements", ", ImageNumber * 3000000000 AS Wide FROM measurements"), "measurements"
)
def narrow_types(t):
    wide = t.measurements.drop("job_number").withColumn("Wide", F.col("ImageNumber") * F.lit(3_000_000_000))
    return _rounded(job_csv.narrow_types(wide))


@query(_MEASURED, "measurements")
def write_tables(t):
    _, files = _merged(t, "Cells.csv")
    merged = job_tables.merge_table(files, "Cells.csv")
    path = sinks.write_table(merged, shared_folder(t.spark, "results"), "Cells.csv")
    return _rounded(t.spark.read.parquet(path))


_TABLE_NAMES = """SELECT l_orderkey AS sub_id, CASE l_linenumber WHEN 1 THEN 'Experiment.csv' WHEN 2 THEN 'qcRAW_experiment_7.csv'
      WHEN 3 THEN 'icf_experiment_9.csv' WHEN 4 THEN 'experiment.csv' WHEN 5 THEN 'icf_experiment__experiment.csv'
      ELSE concat('Object', l_linenumber, '.csv') END AS "table" FROM lineitem"""


@query(
    f"""SELECT sub_id, "table" AS table_name FROM ({_TABLE_NAMES})
    WHERE NOT (contains("table", 'qcRAW_experiment_') OR contains("table", 'icf_experiment__experiment.csv') OR contains("table", 'Experiment.csv'))""",
)
def exclude_tables(t):
    t.base("lineitem").createOrReplaceTempView("lineitem")
    names = t.spark.sql(_TABLE_NAMES.replace('"table"', "`table`"))
    kept, _ = listing.exclude_tables(names)
    return kept.select("sub_id", F.col("table").alias("table_name"))


def _worker_cells(dye_cell, own_cell) -> list:
    """The cells of a worker's line in their order, made for a dye or a column of the image set by the two functions."""
    own = ["Group_Index", "Group_Number", "ImageNumber", "Metadata_Barcode", "Metadata_Site", "Metadata_Well", "Metadata_AcqID", "Metadata_z"]
    per_dye = lambda kind: [dye_cell(f"{kind}_{dye}", dye) for dye in DYES]
    return [*per_dye("FileName"), *map(own_cell, own), *per_dye("PathName"), *per_dye("URL")]


_TEXT = ("Metadata_Barcode", "Metadata_Well")
_OWN_DYE = "CASE WHEN Metadata_AcqID % 3 <> 2 OR '{dye}' <> 'PHALLOIDINandWGA' THEN {value} END"
_LINE = ", ".join(_worker_cells(
    lambda name, dye: _OWN_DYE.format(dye=dye, value=f"""coalesce('"' || "{name}" || '"', '')"""),
    lambda name: f"""'"' || {name} || '"'""" if name in _TEXT else f"CAST({name} AS VARCHAR)",
))
_HEAD = ", ".join(_worker_cells(lambda name, dye: _OWN_DYE.format(dye=dye, value=f"'{name}'"), lambda name: f"'{name}'"))


@query(
    f"""SELECT Metadata_AcqID AS sub_id, concat('job-', job_number) AS job_name, unnest(CASE WHEN ImageNumber = 0
      THEN [concat_ws(',', {_HEAD}), concat_ws(',', {_LINE})] ELSE [concat_ws(',', {_LINE})] END) AS line
    FROM ({ORACLES["image_set_table"]})""",
)
def write_worker_csv(t):
    """The files that workers read, line by line."""
    table = S.image_set_table(t.images, t.plate_acquisition, t.channel_map, batch_size=7).withColumns({
        "sub_id": F.col("Metadata_AcqID"),
        "job_name": F.concat(F.lit("job-"), F.col("job_number").cast("string")),
        "header": F.when(F.col("Metadata_AcqID") % 3 == 2, F.array(*map(F.lit, DYES[:4]))).otherwise(F.array(*map(F.lit, DYES))),
        "use_icf": F.lit(False),
    })
    top = shared_folder(t.spark, "worker")
    done = sinks.write_worker_csv(S.with_icf_columns(table, DYES, F.lit("/r"), F.col("use_icf")), DYES, top)
    lines = read_published(done)
    place = "/input/([^/]*)/([^/]*)[.]csv$"
    part = lambda n: F.regexp_extract("path", place, n)
    return lines.select(part(1).cast("bigint").alias("sub_id"), part(2).alias("job_name"), F.col("value").alias("line"))


_JOB_SIZES = f"""WITH {_NUMBERED}, jobs_of AS (SELECT plate_acquisition_id AS sub_id, i // 50 AS job_number, count(*) AS n_sets
    FROM numbered GROUP BY 1, 2)"""


def _batches(t):
    sets = t.images.select(*S.SET_COLUMNS).dropDuplicates()
    return S.assign_batches(sets, 50, ("plate_acquisition_id",), largest=S.most_images(t.images)).withColumnRenamed("plate_acquisition_id", "sub_id")


@query(f"{_JOB_SIZES} SELECT sub_id, job_number, n_sets, n_sets - 1 AS last_number FROM jobs_of", "images_raw")
def write_image_set_csv(t):
    wide = S.pivot_channels(t.images, t.plate_acquisition, t.channel_map, DYES)
    batches = S.assign_batches(wide, 50, ("plate_acquisition_id",), largest=S.most_images(t.images))
    table = S.layout(batches, DYES, ["job_number"]).withColumn("sub_id", F.col("Metadata_AcqID"))
    path = shared_folder(t.spark, "input")
    sinks.write_image_set_csv(table, path)
    columns = [f for f in table.schema if f.name not in ("sub_id", "job_number")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    back = t.spark.read.schema(f"{schema}, sub_id bigint, job_number bigint").option("header", True).csv(path)
    return back.groupBy("sub_id", "job_number").agg(
        F.count(F.lit(1)).alias("n_sets"), F.max("ImageNumber").alias("last_number")
    )


@query(
    f"""{_JOB_SIZES} SELECT sub_id, job_number, CASE WHEN job_number % 5 = 3 THEN NULL ELSE n_sets END AS n_sets,
      CASE WHEN job_number % 5 = 3 THEN 'error' ELSE 'finished' END AS job_state FROM jobs_of""",
    "images_raw",
)
def map_batches(t):
    def count_sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = 0
        for frame in frames:
            if frame["job_number"].iloc[0] % 5 == 3:
                raise ValueError("cannot read image")
            total += len(frame)
        yield pd.DataFrame({"n_sets": [total]})

    rows = run_batches(_batches(t), count_sets, "n_sets bigint", step=1000)
    return rows.groupBy("sub_id", "job_number").agg(
        F.max("n_sets").alias("n_sets"), F.max("job_state").alias("job_state")
    )


@query(
    f"""WITH {_PARSED} SELECT sub_id, job_name AS line FROM named""",
    "jobs",
)
def write_commands(t):
    jobs = t.jobs.select("job_name", F.col("job_name").alias("command")).withColumns(
        {
            "sub_id": F.element_at(F.split("job_name", "-"), 4).cast("bigint"),
            "job_number": F.element_at(F.split("job_name", "-"), 6).cast("bigint"),
        }
    )
    path = shared_folder(t.spark, "commands")
    sinks.write_commands(jobs, path)
    return t.spark.read.schema("value string, sub_id bigint").text(path).select("sub_id", F.col("value").alias("line"))
