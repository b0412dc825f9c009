"""What is known of the jobs, as events for the status documents and the life cycle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateflow import constants as C
from plateflow.operators.jobs import error_budget, job_families, labelled_families, progress
from plateflow.plans.collect import Collection
from plateflow.session import written


@dataclass(frozen=True)
class Updates:
    status: DataFrame
    lifecycle: DataFrame


def status_updates(states: DataFrame, sub_analyses: DataFrame, now: Column) -> Updates:
    """Events for `analyses.merge_status` and `analyses.lifecycle` from the job states of one look at the cluster.

    A sub-analysis gets its progress (that of its last family by name) and its error: the name of a failed job (the last
    one by name), or that there are too many. One over its budget that has no error yet also gets the error event.
    Where job status rows have `labels`, progress goes to the ids that these name, and families without them have none.
    """
    # Used many times below: computed once, and no broadcast waits for the same work done again beside it.
    used = ("job_name", "state", "sub_id", "job_family", "n_jobs", "analysis_id", "labels")
    states = written(states.select(*[name for name in used if name in states.columns]), "states")
    families = written(job_families(states), "families")
    owners = families.groupBy("sub_id").agg(F.max("analysis_id").alias("analysis_id"))
    moving = families
    if "labels" in states.columns:
        moving = families.drop("sub_id", "analysis_id").join(labelled_families(states), "job_family")
        named = moving.groupBy("sub_id").agg(F.max("analysis_id").alias("analysis_id"))
        owners = named.unionByName(owners.join(named, "sub_id", "left_anti"))
    done = progress(moving, sub_analyses, now).groupBy("sub_id").agg(F.max_by("progress", "job_family").alias("status_value"))
    failed = states.where(F.col("state").isin("failed", "error")).groupBy("sub_id").agg(F.max("job_name").alias("_job"))
    budget = error_budget(states, sub_analyses)
    text = F.when(F.col("over_budget"), F.lit(C.OVER_BUDGET)).otherwise(F.concat(F.lit(C.JOB_ERROR), "_job"))
    errors = budget.join(failed, "sub_id").select("sub_id", text.alias("status_value"))
    events = done.where("status_value IS NOT NULL").withColumn("status_key", F.lit("progress")).unionByName(
        errors.withColumn("status_key", F.lit("error"))
    )
    stamp = {"ts": now, "seq": F.lit(0).cast("bigint")}
    over = budget.where(F.col("over_budget") & ~F.col("has_error")).select("sub_id", F.lit("error").alias("kind"))
    return Updates(events.join(owners, "sub_id").withColumns(stamp), over.join(owners, "sub_id").withColumns(stamp))


def collection_updates(collection: Collection, sub_analyses: DataFrame, now: Column) -> Updates:
    """Events from what was collected: an error for each sub-analysis with a family that cannot be merged, the end of all others.

    Applied after `status_updates`, they close the loop: `analyses.merge_status` and `analyses.lifecycle` fold both, and the next look at the
    pending and unfinished analyses follows from that. The text is that of the first problem by family.
    """
    owners = sub_analyses.select("sub_id", "analysis_id")
    first = collection.problems.groupBy("sub_id").agg(F.min(F.struct("job_family", "problem")).alias("_first"))
    problems = first.select("sub_id", F.col("_first.problem").alias("status_value"))
    ended = collection.families.select("sub_id").dropDuplicates().join(problems, "sub_id", "left_anti")
    stamp = {"ts": now, "seq": F.lit(1).cast("bigint")}
    status = problems.withColumn("status_key", F.lit("error")).join(owners, "sub_id").withColumns(stamp)
    kinds = problems.select("sub_id", F.lit("error").alias("kind")).unionByName(ended.select("sub_id", F.lit("finish").alias("kind")))
    return Updates(status, kinds.join(owners, "sub_id").withColumns(stamp))
