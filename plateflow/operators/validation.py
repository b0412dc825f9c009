"""Problems that keep a sub-analysis from running."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateflow import constants as C
from plateflow.functions.settings import with_settings
from plateflow.operators.images import acquisition_channels, images_of, passes, with_z_planes
from plateflow.operators.imagesets import most_images
from plateflow.operators.ranking import MAX_WINDOW_ROWS

# Most buckets over which the images of one acquisition are spread.
MAX_BUCKETS = 64


def settings_problems(settings: DataFrame, plate_acquisition: DataFrame, channel_map: DataFrame) -> DataFrame:
    """(sub_id, problem) for what no image is needed to see: unknown type, no pipeline, unreadable settings, no channels.

    `settings` are sub-analyses with `functions.settings.with_settings`.
    """
    unknown = settings.where(F.col("type") == "unknown").select(
        "sub_id", F.concat(F.lit(C.UNKNOWN_TYPE), F.coalesce(F.get_json_object("meta", "$.type"), F.lit("None"))).alias("problem")
    )
    runnable = settings.where(F.col("type") == "cellprofiler")
    dyes = acquisition_channels(plate_acquisition, channel_map).groupBy("plate_acquisition_id").agg(
        F.collect_set("dye").alias("map_dyes")
    )
    wanted = runnable.select("sub_id", "plate_acquisition_id", "channels").join(dyes, "plate_acquisition_id", "left")
    empty = wanted.where(
        F.col("map_dyes").isNull()
        | (F.col("channels").isNotNull() & ~F.arrays_overlap("map_dyes", "channels"))
    ).select("sub_id", F.lit(C.EMPTY_CHANNEL_MAP).alias("problem"))
    aimless = runnable.where(F.col("pipeline_file").isNull()).select("sub_id", F.lit(C.NO_PIPELINE).alias("problem"))
    strange = settings.select("sub_id", F.explode("unreadable").alias("setting"))
    strange = strange.select("sub_id", F.concat(F.lit(C.UNREADABLE), "setting").alias("problem"))
    return reduce(DataFrame.unionByName, (unknown, empty, aimless, strange))


def validate(
    sub_analyses: DataFrame, images: DataFrame, plate_acquisition: DataFrame, channel_map: DataFrame
) -> DataFrame:
    """One row per problem: no images, no channels, unknown type, no pipeline, a setting that cannot be read."""
    settings = with_settings(sub_analyses)
    runnable = settings.where(F.col("type") == "cellprofiler")

    # The kinds of images an acquisition has. The semi join looks for one match per sub-analysis and emits
    # no pairs. Where an acquisition is too large for a task, its kinds go to several buckets, and a
    # sub-analysis looks into each of them.
    images = images_of(images, runnable)
    buckets = min(MAX_BUCKETS, 1 + most_images(images) // MAX_WINDOW_ROWS)
    kinds = images.select(
        F.col("plate_acquisition_id").alias("_acquisition"), "site", "well", "dye", F.col("z").alias("_z")
    ).dropDuplicates()
    salted = kinds.withColumn("_bucket", F.pmod(F.hash("well", "site", "dye", "_z"), F.lit(buckets)))
    salt = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
    filters = with_z_planes(runnable, images).withColumn("_salt", salt)
    matches = (
        (F.col("plate_acquisition_id") == F.col("_acquisition"))
        & (F.col("_salt") == F.col("_bucket"))
        & passes(F.col("site_filter"), F.col("site"))
        & passes(F.col("well_filter"), F.col("well"))
        & passes(F.col("channels"), F.col("dye"))
        & F.array_contains("z_planes", F.col("_z"))
    )
    found = filters.join(salted, matches, "left_semi").select("sub_id")
    missing = runnable.join(found, "sub_id", "left_anti").select("sub_id", F.lit(C.NO_IMAGES).alias("problem"))
    return settings_problems(settings, plate_acquisition, channel_map).unionByName(missing)
