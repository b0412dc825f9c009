"""Event logs folded as they grow.

What a log says of an id is a small state, and states of consecutive stretches of the log can be joined: so a snapshot of
states and the events since are as good as the whole log. A snapshot is written for each batch of events under the batch's number, from the
one before and the new events only; a batch that runs again writes the same one again. Batches follow one another in
the order of the events' sequence numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class StatusFold:
    """The last value of each status key, of sub-analyses and of their parents, as `analyses.merge_status` has it."""

    keys: tuple[str, ...] = ("level", "id", "status_key")

    def states(self, events: DataFrame) -> DataFrame:
        last = F.struct("ts", "seq", "status_value").alias("last")
        own = events.select(F.lit("sub").alias("level"), F.col("sub_id").alias("id"), "status_key", last)
        key = F.concat_ws("_", "status_key", F.col("sub_id").cast("string")).alias("status_key")
        parent = events.select(F.lit("analysis").alias("level"), F.col("analysis_id").alias("id"), key, last)
        return self.joined(own.unionByName(parent))

    def joined(self, states: DataFrame) -> DataFrame:
        return states.groupBy(*self.keys).agg(F.max("last").alias("last"))

    def result(self, states: DataFrame) -> DataFrame:
        return states.select(*self.keys, "last.status_value")


@dataclass(frozen=True)
class LifecycleFold:
    """The current times of sub-analyses or analyses, as `analyses.lifecycle` has them."""

    id_column: str
    first_start: bool

    def states(self, events: DataFrame) -> DataFrame:
        at = lambda kind: F.when(F.col("kind") == kind, F.struct("seq", "ts")).alias(kind)
        reset = F.when(F.col("kind") == "reset", F.col("seq")).alias("reset")
        rows = events.select(F.col(self.id_column).alias("id"), reset, at("start"), at("finish"), at("error"), "seq")
        # Within a stretch the resets are looked up by a join, since an id may have any number of events.
        resets = rows.groupBy("id").agg(F.max("reset").alias("last_reset"))
        alive = rows.join(resets, "id").where(F.col("last_reset").isNull() | (F.col("seq") >= F.col("last_reset")))
        first = F.min if self.first_start else F.max
        return alive.groupBy("id").agg(
            F.max("last_reset").alias("reset"), first("start").alias("start"), F.max("finish").alias("finish"), F.max("error").alias("error")
        )

    def joined(self, states: DataFrame) -> DataFrame:
        """At most one state of an id comes from each of the stretches joined."""
        of_id = states.groupBy("id").agg(F.max("reset").alias("reset"), F.collect_list(F.struct("start", "finish", "error")).alias("all"))

        def pick(kind: str, choose):
            kept = F.filter(F.col("all")[kind], lambda at: at.isNotNull() & (F.col("reset").isNull() | (at["seq"] >= F.col("reset"))))
            return choose(kept).alias(kind)

        first = F.array_min if self.first_start else F.array_max
        return of_id.select("id", "reset", pick("start", first), pick("finish", F.array_max), pick("error", F.array_max))

    def result(self, states: DataFrame) -> DataFrame:
        return states.select("id", *[F.col(f"{kind}.ts").alias(kind) for kind in ("start", "finish", "error")])


Fold = StatusFold | LifecycleFold


def _snapshots(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the snapshots that were written whole."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(path):
        return []
    names = [status.getPath().getName() for status in store.listStatus(path)]
    numbers = [int(name.removeprefix("batch_id=")) for name in names if name.startswith("batch_id=")]
    marker = lambda n: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch_id={n}/_SUCCESS")
    return sorted(n for n in numbers if store.exists(marker(n)))


def fold_batch(events: DataFrame, number: int, fold: Fold, folder: str) -> None:
    """Write snapshot `number` from the one before it and the events of the batch; snapshots before that are deleted."""
    spark = events.sparkSession
    states = fold.states(events)
    before = [n for n in _snapshots(spark, folder) if n < number]
    if before:
        states = fold.joined(spark.read.parquet(f"{folder}/batch_id={before[-1]}").unionByName(states))
    states.write.mode("overwrite").parquet(f"{folder}/batch_id={number}")
    for old in before[:-1]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch_id={old}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def folded(spark: SparkSession, fold: Fold, folder: str) -> DataFrame:
    """What the log says by its last snapshot."""
    return fold.result(spark.read.parquet(f"{folder}/batch_id={_snapshots(spark, folder)[-1]}"))
