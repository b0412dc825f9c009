"""Jobs and job families: state, completeness, progress, error budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateflow import constants as C
from plateflow import functions as PF


def job_condition(conditions: Column) -> Column:
    """State of a job by its conditions: `Complete` before `Failed`, else `running`."""
    def holds(kind: str) -> Column:
        return F.coalesce(
            F.exists(conditions, lambda c: (c["type"] == kind) & (c["status"] == "True")), F.lit(False)
        )

    return F.when(holds("Complete"), "complete").when(holds("Failed"), "failed").otherwise("running")


def job_states(jobs: DataFrame) -> DataFrame:
    """Job status rows with their `state` and what their name says.

    Rows that hold a `state` already, as those of marker files do, keep it; others have `conditions`.
    """
    parsed = jobs.withColumn("_name", PF.parse_job_name(F.col("job_name")))
    if "state" not in jobs.columns:
        parsed = parsed.withColumn("state", job_condition(F.col("conditions")))
    named = ("sub_id", "job_family", "n_jobs", "analysis_id")
    kept = [name for name in jobs.columns if name not in (*named, "state")]
    return parsed.select(*kept, "state", *[f"_name.{name}" for name in named])


def finished(states: DataFrame) -> DataFrame:
    """Jobs that ended; failed ones and those that ran out of time count as well."""
    return states.where(F.col("state").isin("complete", "failed", "finished", "error", "timeout"))


def job_families(states: DataFrame) -> DataFrame:
    """Finished jobs per family, with the family's own total."""
    # Distinct names first: a job may be reported more than once.
    ended = finished(states).where(F.col("job_family").isNotNull())
    per_job = ended.groupBy("job_family", "job_name").agg(
        F.max("n_jobs").alias("n_jobs"),
        F.max("sub_id").alias("sub_id"),
        F.max("analysis_id").alias("analysis_id"),
        F.max(F.col("state").isin("failed", "error").cast("int")).alias("failed"),
    )
    return per_job.groupBy("job_family").agg(
        F.max("sub_id").alias("sub_id"),
        F.max("analysis_id").alias("analysis_id"),
        F.count(F.lit(1)).alias("done"),
        F.sum("failed").alias("n_failed"),
        F.max("n_jobs").alias("total"),
    )


def labelled_families(states: DataFrame) -> DataFrame:
    """(job_family, sub_id, analysis_id) as the labels of a family's first ended job by name say, if they say both."""
    ended = finished(states).where(F.col("job_family").isNotNull())
    first = ended.groupBy("job_family").agg(F.min_by(F.struct("labels"), "job_name").alias("_first"))
    label = lambda name: F.try_element_at(F.col("_first.labels"), F.lit(name)).try_cast("bigint")
    ids = first.select("job_family", label("sub_analysis_id").alias("sub_id"), label("analysis_id").alias("analysis_id"))
    return ids.where("sub_id IS NOT NULL AND analysis_id IS NOT NULL")


def complete_families(families: DataFrame, job_limit: int | None = None) -> DataFrame:
    """Families with exactly as many finished jobs as their total (or as the limit)."""
    complete = F.col("done") == F.col("total")
    if job_limit is not None:
        complete = complete | (F.col("done") == job_limit)
    return families.where(complete)


def new_families(complete: DataFrame, processed: DataFrame) -> DataFrame:
    """Complete families that are not being processed yet."""
    return complete.join(processed.select("job_family"), "job_family", "left_anti")


def union_families(first: DataFrame, later: DataFrame) -> DataFrame:
    """Families of two backends; where both know one, the later one wins."""
    ranked = first.withColumn("_rank", F.lit(0)).unionByName(later.withColumn("_rank", F.lit(1)))
    columns = [name for name in first.columns if name != "job_family"]
    return (
        ranked.groupBy("job_family")
        .agg(F.max_by(F.struct(*columns), "_rank").alias("_row"))
        .select("job_family", "_row.*")
    )


def job_context(states: DataFrame, sub_analyses: DataFrame) -> DataFrame:
    """Jobs with start, error flag and error budget of their sub-analysis.

    A job of an unknown sub-analysis counts as failed there and has no budget.
    """
    budget = F.coalesce(
        F.nullif(PF.json_text(F.col("meta"), "max_errors"), F.lit("")).try_cast("int"),
        F.lit(C.DEFAULT_MAX_ERRORS),
    )
    context = sub_analyses.select(
        "sub_id", "start", F.col("error").isNotNull().alias("has_error"), budget.alias("max_errors")
    )
    return states.join(context, "sub_id", "left").withColumns(
        {
            "has_error": F.coalesce("has_error", F.lit(True)),
            "max_errors": F.coalesce("max_errors", F.lit(C.DEFAULT_MAX_ERRORS)),
        }
    )


def progress(families: DataFrame, sub_analyses: DataFrame, now: Column) -> DataFrame:
    """Progress of each family: done, total, hours left and the text for the status document.

    Without a sub-analysis the clock starts now; with one that has not started the hours are unknown.
    """
    starts = sub_analyses.select("sub_id", "start", F.lit(True).alias("_known"))
    joined = families.join(starts, "sub_id", "left")
    start = F.when(F.col("_known"), F.col("start")).otherwise(now)
    hours = PF.hours_left(start, now, F.col("done"), F.col("total"))
    return joined.withColumn("hours_left", hours).select(
        "job_family", "sub_id", "done", "total", "hours_left",
        PF.progress_text(F.col("done"), F.col("total"), F.col("hours_left")).alias("progress"),
    )


def error_budget(states: DataFrame, sub_analyses: DataFrame) -> DataFrame:
    """Failed jobs of each sub-analysis against what it allows."""
    failures = (
        states.where(F.col("state").isin("failed", "error"))
        .groupBy("sub_id")
        .agg(F.count_distinct("job_name").alias("n_failed"))
    )
    return job_context(failures, sub_analyses).select(
        "sub_id", "n_failed", "max_errors", (F.col("n_failed") > F.col("max_errors")).alias("over_budget"), "has_error"
    )


def job_commands(jobs: DataFrame, image_repository: str, debug: bool = False) -> DataFrame:
    """Command text and container image of each job.

    `jobs` holds `sub_id`, `job_name`, `pipeline_file`, `cp_version` and `job_timeout`. Without a pipeline there is no
    command (NULL), which `validation.validate` reports.
    """
    files = PF.job_paths(F.col("sub_id"), F.col("job_name"))
    tag = "-latest" if debug else "-stable"
    return jobs.withColumn("_files", files).select(
        "sub_id",
        "job_name",
        F.concat(
            F.lit(" timeout "), "job_timeout", F.lit(" cellprofiler -r -c -p "), "pipeline_file",
            F.lit(" --data-file "), "_files.imageset_file", F.lit(" -o "), "_files.output_path",
            F.lit(" --plugins-directory /CellProfiler/plugins"),
        ).alias("command"),
        F.concat(F.lit(f"{image_repository}:"), "cp_version", F.lit(tag)).alias("image"),
    )
