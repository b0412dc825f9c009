"""Identifiers: image sets, jobs, job families."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plateflow import constants as C


def image_set_id(timepoint: Column, well: Column, site: Column, z: Column) -> Column:
    return F.concat(F.lit("tp"), F.concat_ws("-", timepoint.cast("string"), well, site.cast("string"), z.cast("string")))


def job_id(sub_id: Column, run_id: Column, number: Column, total: Column, analysis_id: Column) -> Column:
    return F.concat_ws("-", *[part.cast("string") for part in (sub_id, run_id, number, total, analysis_id)])


def job_name(sub_id: Column, run_id: Column, number: Column, total: Column, analysis_id: Column) -> Column:
    return F.concat(F.lit(C.JOB_PREFIX), job_id(sub_id, run_id, number, total, analysis_id))


def _capture(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def family_of(name: Column) -> Column:
    """The part of a job name that all jobs of one submission share; NULL for other names."""
    return _capture(name, C.FAMILY_PATTERN)


def parse_job_name(name: Column) -> Column:
    """Struct of what a job name says; fields it does not say are NULL."""
    return F.struct(
        _capture(name, C.SUB_ID_PATTERN).try_cast("bigint").alias("sub_id"),
        family_of(name).alias("job_family"),
        _capture(name, C.JOB_TOTAL_PATTERN).try_cast("bigint").alias("n_jobs"),
        _capture(name, C.ANALYSIS_ID_PATTERN).try_cast("bigint").alias("analysis_id"),
    )


def batch_id(reply: Column) -> Column:
    """Job number in the reply of a batch system; NULL when it holds none."""
    return _capture(reply, C.BATCH_ID_PATTERN)
