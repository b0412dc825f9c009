"""The image catalogue: selection, focus planes, channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateflow.functions import parse_ranges

IMAGE_COLUMNS = [
    "plate_acquisition_id", "plate_barcode", "timepoint", "well", "site", "z", "channel", "dye", "path",
]

# What the images of one field of view have in common: channels tell them apart.
FIELD_COLUMNS = ["plate_acquisition_id", "plate_barcode", "timepoint", "well", "site", "z"]

# Images that a task may hold at once: some 200 MB.
IMAGES_PER_TASK = 1_000_000

# Rows of two numbers that are broadcast at most: some 10 MB.
BROADCAST_ROWS = 500_000


def distinct_images(images: DataFrame) -> DataFrame:
    """The catalogue without repeated rows.

    Where the shuffle partitions would be too large to be compared in memory, rows go to more tasks first. Images of one field of
    view go together: beside one another their rows are alike, and take far less room when they are compressed.
    """
    rows, tasks = images.select(*IMAGE_COLUMNS), image_tasks(images)
    return (rows if tasks is None else rows.repartition(tasks, *FIELD_COLUMNS)).dropDuplicates()


def image_tasks(images: DataFrame) -> int | None:
    """How many tasks hold IMAGES_PER_TASK images each; None where the shuffle partitions do."""
    tasks = -(-images.count() // IMAGES_PER_TASK)
    return tasks if tasks > int(images.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def middle_z(images: DataFrame) -> DataFrame:
    """Lower median of the distinct focus planes of each acquisition."""
    planes = images.where(F.col("z").isNotNull()).select("plate_acquisition_id", "z").dropDuplicates()
    return planes.groupBy("plate_acquisition_id").agg(
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY z)").cast("int").alias("middle_z")
    )


def middle_images(images: DataFrame, plate_acquisition: DataFrame) -> DataFrame:
    """Images of the middle plane of each known acquisition.

    There is one middle plane per acquisition: the count of these says whether it may be broadcast.
    """
    known = plate_acquisition.select(F.col("id").alias("plate_acquisition_id"))
    focus = middle_z(images.join(known, "plate_acquisition_id", "left_semi")).withColumnRenamed("middle_z", "z")
    if plate_acquisition.count() <= BROADCAST_ROWS:
        focus = F.broadcast(focus)
    return images.join(focus, ["plate_acquisition_id", "z"], "left_semi")


def first_z(images: DataFrame) -> DataFrame:
    """Lowest focus plane of each acquisition."""
    return images.groupBy("plate_acquisition_id").agg(F.min("z").alias("min_z"))


def acquisition_channels(plate_acquisition: DataFrame, channel_map: DataFrame) -> DataFrame:
    """The channels of each acquisition, by its channel map."""
    return (
        plate_acquisition.join(channel_map, plate_acquisition["channel_map_id"] == channel_map["map_id"])
        .select(plate_acquisition["id"].alias("plate_acquisition_id"), "map_id", "channel", "dye")
    )


def filter_channel_map(channels: DataFrame, wanted: str = "channels") -> DataFrame:
    """Channels whose dye is listed in `wanted`. No list keeps all of them, an empty list keeps none."""
    return channels.where(F.col(wanted).isNull() | F.array_contains(wanted, F.col("dye")))


def passes(wanted: Column, value: Column) -> Column:
    """Membership test of an image filter, where an absent or empty list lets everything pass."""
    return (F.coalesce(F.size(wanted), F.lit(0)) <= 0) | F.array_contains(wanted, value)


def images_for_analyses(images: DataFrame, analyses: DataFrame) -> DataFrame:
    """Every image of the acquisition of every sub-analysis."""
    return analyses.join(images, "plate_acquisition_id")


def images_of(images: DataFrame, analyses: DataFrame) -> DataFrame:
    """The images of the acquisitions that `analyses` work on.

    Everything costly follows this: a catalogue holds many more plates than are analysed at a time. While
    the acquisitions are few enough to be broadcast, only their partitions of the catalogue are read.
    """
    plates = analyses.select("plate_acquisition_id").dropDuplicates()
    plate = F.col("plate_acquisition_id")
    found = plates.agg(F.count(F.lit(1)).alias("n"), F.min(plate).alias("low"), F.max(plate).alias("high")).first()
    # The range is a filter the planner takes as selective, so that it prunes partitions by the join.
    plates = plates.where(plate.between(found["low"], found["high"]))
    if found["n"] <= BROADCAST_ROWS:
        plates = F.broadcast(plates)
    return images.join(plates, "plate_acquisition_id", "left_semi")


def with_z_planes(analyses: DataFrame, images: DataFrame) -> DataFrame:
    """Add `z_planes`: the planes a sub-analysis asks for, else the middle plane of its acquisition.

    Needs `z` (range text or NULL). The middle plane is NULL for an acquisition without images, and then
    selects nothing.
    """
    return (
        analyses.join(middle_z(images), "plate_acquisition_id", "left")
        .withColumn(
            "z_planes",
            F.when(F.col("z").isNotNull(), parse_ranges(F.col("z"))).when(
                F.col("middle_z").isNotNull(), F.array("middle_z")
            ),
        )
        .drop("middle_z")
    )


def select_images(images: DataFrame, analyses: DataFrame) -> DataFrame:
    """The distinct images each sub-analysis works on.

    `analyses` holds `sub_id`, `plate_acquisition_id` and the filters `site_filter`, `well_filter`,
    `channels` and `z` (see `functions.settings`).
    """
    images = images_of(images, analyses)
    filters = with_z_planes(analyses, images).select(
        "sub_id", "plate_acquisition_id", "site_filter", "well_filter", "channels", "z_planes"
    )
    # Repeats go before the join: several sub-analyses may share a plate.
    joined = images_for_analyses(distinct_images(images), filters)
    return joined.where(
        passes(F.col("site_filter"), F.col("site"))
        & passes(F.col("well_filter"), F.col("well"))
        & passes(F.col("channels"), F.col("dye"))
        & F.array_contains("z_planes", F.col("z"))
    ).select("sub_id", *IMAGE_COLUMNS)


def order_images(images: DataFrame) -> DataFrame:
    """Images in reading order; the further columns settle ties, so that any range can be split.

    Partitions are consecutive ranges, each sorted by a task; they are as many as it takes that none is large.
    """
    order, tasks = ["timepoint", "well", "site", "channel", "z", "plate_acquisition_id", "path"], image_tasks(images)
    if tasks is None:
        return images.orderBy(*order)
    return images.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
