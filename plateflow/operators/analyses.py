"""Sub-analyses and their parent analyses: queue, dependencies, roll-up, life cycle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateflow import constants as C
from plateflow import functions as PF


def pending(sub_analyses: DataFrame) -> DataFrame:
    """Neither started nor failed."""
    return sub_analyses.where(F.col("start").isNull() & F.col("error").isNull())


def unfinished(analyses: DataFrame) -> DataFrame:
    """Neither finished nor failed."""
    return analyses.where(F.col("finish").isNull() & F.col("error").isNull())


def unfinished_remote(sub_analyses: DataFrame) -> DataFrame:
    """Unfinished ones that name the remote backend (a JSON null does not)."""
    return unfinished(sub_analyses).where(PF.json_text(F.col("meta"), C.REMOTE_KEY).isNotNull())


def queue_order(sub_analyses: DataFrame) -> DataFrame:
    """By priority, those without one last."""
    return sub_analyses.orderBy(F.asc_nulls_last("priority"), "sub_id")


def waiting(candidates: DataFrame, sub_analyses: DataFrame) -> DataFrame:
    """Ids of candidates with a dependency that exists and has not finished."""
    needs = candidates.select("sub_id", F.explode("depends_on_sub_id").alias("needed"))
    open_ones = sub_analyses.where(F.col("finish").isNull()).select(F.col("sub_id").alias("needed"))
    return needs.join(open_ones, "needed", "left_semi").select("sub_id").dropDuplicates()


def ready(candidates: DataFrame, sub_analyses: DataFrame) -> DataFrame:
    """Candidates whose dependencies have all finished. Unknown ids count as finished, also if failed."""
    return candidates.join(waiting(candidates, sub_analyses), "sub_id", "left_anti")


def children(analyses: DataFrame, sub_analyses: DataFrame) -> DataFrame:
    """Each analysis with its sub-analyses."""
    parents = analyses.select(F.col("id").alias("analysis_id"))
    return parents.join(sub_analyses, "analysis_id")


def with_storage_paths(analyses: DataFrame, id_column: str = "id") -> DataFrame:
    """Add the result folder of an analysis (`full`, `mount_point`, `job_specific`)."""
    paths = PF.storage_paths(
        F.col("plate_barcode"), F.col("plate_acquisition_id").cast("string"), F.col(id_column).cast("string")
    )
    return analyses.withColumn("storage", paths).select("*", "storage.*").drop("storage")


def sub_storage_paths(sub_analyses: DataFrame, analyses: DataFrame) -> DataFrame:
    """Result folder of each sub-analysis, that of its parent analysis."""
    parents = with_storage_paths(analyses).select(
        F.col("id").alias("analysis_id"), "full", "mount_point", "job_specific"
    )
    return sub_analyses.select("sub_id", "analysis_id").join(parents, "analysis_id", "left")


def rollup_candidates(analyses: DataFrame) -> DataFrame:
    """Unfinished analyses that are not kept for other backends."""
    open_ones = unfinished(analyses)
    for key in C.ROLLUP_SKIP_KEYS:
        open_ones = open_ones.where(~PF.has_key(F.col("meta"), key))
    return open_ones


def rollup_states(sub_analyses: DataFrame) -> DataFrame:
    """State of each analysis by its sub-analyses: one failure fails it, all finished finish it."""
    flags = sub_analyses.groupBy("analysis_id").agg(
        F.bool_or(F.col("error").isNotNull()).alias("any_failed"),
        F.bool_and(F.col("finish").isNotNull()).alias("all_finished"),
        F.count(F.lit(1)).alias("n_children"),
    )
    state = F.when(F.col("any_failed"), "failed").when(F.col("all_finished"), "finished").otherwise("pending")
    return flags.select("analysis_id", state.alias("state"), "n_children")


def rollup(analyses: DataFrame, sub_analyses: DataFrame) -> DataFrame:
    """New state of every candidate; one without sub-analyses stays pending."""
    parents = rollup_candidates(analyses).select(F.col("id").alias("analysis_id"))
    return parents.join(rollup_states(sub_analyses), "analysis_id", "left").select(
        "analysis_id",
        F.coalesce("state", F.lit("pending")).alias("state"),
        F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
    )


def rollup_files(
    analyses: DataFrame, sub_analyses: DataFrame, files: DataFrame, folders: DataFrame
) -> DataFrame:
    """Files of every analysis that has just finished, one row per file.

    `files` (sub_id, path) are the result files of the sub-analyses and `folders` (sub_id, job_folder) their
    folders. Files are kept as often as the children list them, and are not gathered: an analysis may have
    any number. `analysis_folder` is the folder of the child with the highest id.
    """
    done = rollup(analyses, sub_analyses).where(F.col("state") == "finished").select("analysis_id")
    members = sub_analyses.select("analysis_id", "sub_id").join(done, "analysis_id", "left_semi")
    last = (
        members.join(folders, "sub_id")
        .groupBy("analysis_id")
        .agg(F.max_by("job_folder", "sub_id").alias("analysis_folder"))
    )
    # The small tables meet first; the files are joined once.
    owners = members.join(last, "analysis_id")
    return owners.join(files.select("sub_id", "path"), "sub_id").select(
        "analysis_id", "analysis_folder", "sub_id", "path"
    )


def merge_status(events: DataFrame) -> DataFrame:
    """Status documents as rows: the last value per key, for sub-analyses and for their parents.

    A parent holds the keys of its sub-analyses with `_{sub_id}` appended, so any number of them: rows
    instead of one document keep a parent with many children spread out.
    """
    latest = F.max_by("status_value", F.struct("ts", "seq"))
    own = events.groupBy(F.lit("sub").alias("level"), F.col("sub_id").alias("id"), "status_key").agg(
        latest.alias("status_value")
    )
    parent = events.groupBy(
        F.lit("analysis").alias("level"),
        F.col("analysis_id").alias("id"),
        F.concat_ws("_", "status_key", F.col("sub_id").cast("string")).alias("status_key"),
    ).agg(latest.alias("status_value"))
    return own.unionByName(parent)


def lifecycle(events: DataFrame, id_column: str, first_start: bool) -> DataFrame:
    """Fold a log of `start`, `finish`, `error` and `reset` into the current times.

    What precedes the latest reset of an id is gone. With `first_start` the first start stays (an
    analysis), else the last one wins (a sub-analysis); finish and error are the last ones.
    """
    resets = (
        events.where(F.col("kind") == "reset").groupBy(id_column).agg(F.max("seq").alias("_reset"))
    )
    alive = events.join(resets, id_column, "left").where(
        F.col("_reset").isNull() | (F.col("seq") >= F.col("_reset"))
    )

    def pick(kind: str, choose):
        is_kind = F.col("kind") == kind
        return choose(F.when(is_kind, F.col("ts")), F.when(is_kind, F.col("seq")))

    return alive.groupBy(F.col(id_column).alias("id")).agg(
        pick("start", F.min_by if first_start else F.max_by).alias("start"),
        pick("finish", F.max_by).alias("finish"),
        pick("error", F.max_by).alias("error"),
    )
