"""File paths as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plateflow import constants as C


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dir_name(path: Column) -> Column:
    """Everything before the last slash; empty for a bare name, `/` for a file in the root."""
    head = F.left(path, F.length(path) - F.length(base_name(path)))
    folder = F.rtrim(head, F.lit("/"))
    return F.when(folder == "", head).otherwise(folder)


def file_url(path: Column) -> Column:
    return F.concat(F.lit("file:"), path)


def icf_file(dye: str) -> str:
    """Name of the illumination-correction file of one dye."""
    return f"ICF_{dye}.npy"


def is_image_file(path: Column) -> Column:
    return F.lower(path).rlike(r"\.(" + "|".join(C.IMAGE_SUFFIXES) + ")$")


def storage_paths(barcode: Column, acquisition: Column, analysis: Column) -> Column:
    """Struct of the result folder: absolute, its mount point, and relative to that."""
    folder = F.concat_ws("/", F.lit("results"), barcode, acquisition, analysis)
    return F.struct(
        F.concat(F.lit(C.WORK_ROOT), folder).alias("full"),
        F.lit(C.WORK_ROOT).alias("mount_point"),
        F.concat(folder, F.lit("/")).alias("job_specific"),
    )


def job_paths(sub_id: Column, name: Column) -> Column:
    """Struct of the files of one job: its image-set table, its document and its output folder."""
    source = F.concat(F.lit(f"{C.WORK_ROOT}input/"), sub_id.cast("string"), F.lit("/"), name)
    return F.struct(
        F.concat(source, F.lit(".csv")).alias("imageset_file"),
        F.concat(source, F.lit(".yaml")).alias("job_yaml_file"),
        F.concat(F.lit(f"{C.WORK_ROOT}output/"), sub_id.cast("string"), F.lit("/"), name, F.lit("/")).alias(
            "output_path"
        ),
    )
