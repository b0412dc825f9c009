"""Numbering rows within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plateflow.session import written

# Largest group that one task may sort: about 1 GB of wide rows.
MAX_WINDOW_ROWS = 1_000_000


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group; counted map-side first, one number reaches the driver."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n")).first()["n"]


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str = "row_index",
    total: str = "group_rows",
    max_window_rows: int = MAX_WINDOW_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """Add the 0-based position of a row in its group and the size of that group.

    `order` must be a total order within the group. Where every group fits one task this is a window per
    group. Where one does not, the rows are range-partitioned over the whole key, so that a group spans as
    many tasks as it needs, and positions come from the row counts of those slices. `largest` is a bound on
    the group size if the caller knows one that is cheaper than counting `df`.
    """
    if largest is None:
        largest = largest_group(df, group)
    if largest <= max_window_rows:
        per_group = Window.partitionBy(*group)
        ordered = per_group.orderBy(*order)
        return df.withColumn(name, (F.row_number().over(ordered) - 1).cast("bigint")).withColumn(
            total, F.count(F.lit(1)).over(per_group)
        )
    return _number_by_slices(df, list(group), list(order), name, total)


def _number_by_slices(df: DataFrame, group: list[str], order: list[str], name: str, total: str) -> DataFrame:
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group, *order]
    # The slice of a row depends on sampled range bounds: fix it once, so that both uses below agree.
    placed = written(
        df.repartitionByRange(slices, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id()),
        "slices",
    )
    # One row per group and slice it touches; a group has at most `slices` of them.
    parts = placed.groupBy(*group, "_slice").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    per_group = Window.partitionBy(*group)
    before = per_group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        *group,
        "_slice",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(per_group).alias(total),
    )
    matched = [F.col(f"p.{key}").eqNullSafe(F.col(f"s.{key}")) for key in [*group, "_slice"]]
    return (
        placed.alias("p")
        .join(starts.alias("s"), _all(matched))
        .select(
            *[F.col(f"p.{column}") for column in df.columns],
            (F.col("p._place") + F.col("s._shift")).alias(name),
            F.col(f"s.{total}"),
        )
    )


def with_places(df: DataFrame, order: str, name: str) -> DataFrame:
    """Add a number that grows with the column `order`; NULL has none.

    Least and greatest numbers are fixed-width values, which aggregates hold in a hash table; of texts they would sort all rows.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.when(F.col(order).isNotNull(), F.monotonically_increasing_id())
    # Written: the number of a row depends on sampled range bounds.
    return written(df.repartitionByRange(slices, order).sortWithinPartitions(order).withColumn(name, place), "places")


def running_total(df: DataFrame, order: Sequence[str], weight: Column, name: str) -> DataFrame:
    """Add the sum of `weight`, a whole number, over a row and all before it.

    `order` must be a total order. Rows are range-partitioned and summed slice by slice, each by a task that passes over them;
    what precedes a slice follows from the totals of the slices, of which there are as many as shuffle partitions.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = df.withColumn(name, weight.cast("bigint")).repartitionByRange(slices, *order).sortWithinPartitions(*order)
    sliced = sliced.withColumn("_slice", F.spark_partition_id())

    def sums(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        before = 0
        for batch in batches:
            place = batch.schema.get_field_index(name)
            total = pc.add(pc.cumulative_sum(batch.column(place)), pa.scalar(before, pa.int64()))
            before = total[-1].as_py() if len(total) else before
            yield batch.set_column(place, batch.schema.field(place), total)

    summed = written(sliced.mapInArrow(sums, sliced.schema), "sums")
    totals = summed.groupBy("_slice").agg(F.max(name).alias("_sum"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("_slice", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_shift"))
    return summed.join(shifts, "_slice").withColumn(name, F.col(name) + F.col("_shift")).select(*df.columns, name)


def _all(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result
