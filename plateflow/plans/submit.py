"""From pending sub-analyses to the image-set tables and jobs that run them, in one plan."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateflow import constants as C
from plateflow import functions as PF
from plateflow.functions.settings import with_settings
from plateflow.operators.analyses import pending, ready, sub_storage_paths
from plateflow.operators.images import images_of, with_z_planes
from plateflow.operators.imagesets import (
    assign_batches,
    count_sets,
    cut_jobs,
    dye_order,
    layout,
    limit_jobs,
    most_images,
    sub_analysis_sets,
    with_icf_columns,
)
from plateflow.operators.ranking import MAX_WINDOW_ROWS
from plateflow.operators.validation import settings_problems, validate
from plateflow.session import written
from plateflow.sources.sinks import write_worker_csv


@dataclass(frozen=True)
class Submission:
    """What a submission consists of; each part is planned when it is first asked for."""

    images: DataFrame
    sub_analyses: DataFrame
    analyses: DataFrame
    plate_acquisition: DataFrame
    channel_map: DataFrame
    run_id: Column
    backends: tuple[str, ...]
    job_limit: int | None

    @cached_property
    def routed(self) -> DataFrame:
        startable = ready(pending(self.sub_analyses), self.sub_analyses)
        return with_settings(startable).where(F.col("backend").isin(*self.backends))

    @cached_property
    def runnable(self) -> DataFrame:
        """Those without a problem that is known before any image is looked at; others would run with settings not meant."""
        flawed = settings_problems(self.routed, self.plate_acquisition, self.channel_map).select("sub_id")
        sound = self.routed.where(F.col("type") == "cellprofiler").join(flawed, "sub_id", "left_anti")
        runnable = sound.withColumn("run_id", self.run_id)
        storage = sub_storage_paths(self.sub_analyses, self.analyses).select("sub_id", "full")
        # Written: the plates, the planes, the counts and the settings of the jobs all follow from it.
        return written(runnable.join(storage, "sub_id", "left"), "runnable")

    @cached_property
    def own_images(self) -> DataFrame:
        return images_of(self.images, self.runnable)

    @cached_property
    def dyes(self) -> list[str]:
        return dye_order(self.channel_map)

    @cached_property
    def image_sets(self) -> DataFrame:
        """The wide image-set table of every job, with the columns of all maps."""
        return self.wide.drop("use_icf", "full", "header")

    def write_image_sets(self, top: str = C.WORK_ROOT) -> DataFrame:
        """One CSV per job where its command looks for it, with the columns of its own map, dye filter and correction only."""
        return write_worker_csv(self.wide, self.dyes, top)

    @cached_property
    def wide(self) -> DataFrame:
        dyes = self.dyes
        images = self.own_images
        largest = most_images(images)
        wide = sub_analysis_sets(
            images, with_z_planes(self.runnable, images), self.plate_acquisition, self.channel_map, dyes,
            keep=("analysis_id", "run_id", "batch_size", "use_icf", "full"),
            by_plate=largest <= MAX_WINDOW_ROWS, with_header=True,
        )
        batches = limit_jobs(assign_batches(wide, F.col("batch_size"), largest=largest), self.job_limit)
        kept = ["sub_id", "analysis_id", "job_number", "n_jobs", "job_name", "is_complete", "use_icf", "full", "header"]
        table = layout(batches.withColumn("job_name", _job_name()), dyes, kept)
        return with_icf_columns(table, dyes, F.col("full"), F.col("use_icf"))

    @cached_property
    def jobs(self) -> DataFrame:
        """The jobs with their settings: from the number of image sets of each sub-analysis, without the sets themselves."""
        images = self.own_images
        counts = count_sets(
            images, with_z_planes(self.runnable, images), self.plate_acquisition, self.channel_map,
            keep=("analysis_id", "run_id", "batch_size"),
        )
        jobs = cut_jobs(counts, F.col("batch_size"), self.job_limit).withColumn("job_name", _job_name())
        settings = self.runnable.select(
            "sub_id", "backend", "pipeline_file", "cp_version", "job_timeout", "is_urgent", "sub_type"
        )
        return jobs.select("sub_id", "analysis_id", "job_number", "n_jobs", "job_name", "n_image_sets").join(settings, "sub_id")

    @cached_property
    def problems(self) -> DataFrame:
        """Why sub-analyses have no jobs."""
        routed = self.routed.select(*self.sub_analyses.columns)
        return validate(routed, self.images, self.plate_acquisition, self.channel_map)


def _job_name() -> Column:
    return PF.job_name(*[F.col(name) for name in ("sub_id", "run_id", "job_number", "n_jobs", "analysis_id")])


def plan_submission(
    images: DataFrame,
    sub_analyses: DataFrame,
    analyses: DataFrame,
    plate_acquisition: DataFrame,
    channel_map: DataFrame,
    run_id: Column,
    backends: tuple[str, ...] = ("cluster", "remote"),
    job_limit: int | None = None,
) -> Submission:
    """Image sets and jobs of every pending sub-analysis whose dependencies have finished.

    `run_id` tells repeated submissions of a sub-analysis apart; given the same one, the plan gives the
    same names. Sub-analyses with problems have no jobs and are reported.
    """
    return Submission(images, sub_analyses, analyses, plate_acquisition, channel_map, run_id, backends, job_limit)
