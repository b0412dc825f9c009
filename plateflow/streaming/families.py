"""Families of jobs as state that ends with them.

The state of a family is a bit per job number, so it is small whatever the family's size. When the last job has ended, the family is
handed out as complete and its jobs are forgotten; a mark stays for some time, so that late repeats are known for what they
are, and goes by a timer. Nothing is left then of a family that is over.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: How long reports of a family's jobs are ignored after it was complete.
GRACE = timedelta(hours=24)
_OUTPUT = "job_family string, done bigint, total bigint"


def _family_jobs(grace: timedelta) -> StatefulProcessor:
    """A processor that counts the ended jobs of a family, each once.

    Its class is made here, so that it is sent along by value: the process that starts it may not find this package.
    """
    milliseconds = int(grace.total_seconds() * 1000)

    class FamilyJobs(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            # Jobs of the usual name by their number, others by name; done and total follow from them.
            self.jobs = handle.getValueState("jobs", "numbers binary, others array<string>, total bigint")
            self.over = handle.getValueState("over", "since bigint")

        def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
            if self.over.exists():
                return
            numbers, others, total = before = (self.jobs.get() or (b"", [], None))
            bits, names = bytearray(numbers), set(others)
            for row in rows:
                total = row.n_jobs if total is None else max(total, row.n_jobs or 0)
                if row.job_number is None:
                    names.add(row.job_name)
                    continue
                place, bit = divmod(row.job_number, 8)
                if place >= len(bits):
                    bits.extend(bytes(place + 1 - len(bits)))
                bits[place] |= 1 << bit
            after = (bytes(bits), sorted(names), total)
            if after == (bytes(before[0]), list(before[1]), before[2]):
                return
            done = sum(b.bit_count() for b in bits) + len(names)
            if done == total:
                now = timerValues.getCurrentProcessingTimeInMs()
                self.jobs.clear()
                self.over.update((now,))
                self.handle.registerTimer(now + milliseconds)
            else:
                self.jobs.update(after)
            yield Row(job_family=key[0], done=done, total=total)

        def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
            self.over.clear()
            return iter(())

        def close(self) -> None:
            pass

    return FamilyJobs()


def family_progress(ended: DataFrame, grace: timedelta = GRACE) -> DataFrame:
    """(job_family, done, total) of the families that change, from rows of ended jobs with what their names say.

    A job counts once however often it is reported. Number and total tell a usual name from the others of its family.
    """
    number = F.regexp_extract("job_name", r"-(\d{1,9})-\d+-\d+$", 1)
    usual = F.concat_ws("-", "job_family", number, F.col("n_jobs").cast("string"), F.col("analysis_id").cast("string"))
    # A number far beyond the total would make a long row of empty bits.
    short = number.try_cast("bigint") < F.greatest(F.lit(64), 2 * F.col("n_jobs"))
    numbered = ended.withColumn("job_number", F.when((usual == F.col("job_name")) & short, number.try_cast("bigint")))
    return (
        numbered.select("job_family", "job_name", "job_number", "n_jobs")
        .groupBy("job_family")
        .transformWithState(_family_jobs(grace), _OUTPUT, "Update", "ProcessingTime")
    )


@contextmanager
def ending_state(spark: SparkSession):
    """The settings that such state needs, for the queries that are started meanwhile.

    Timers look at the clock, and a batch without data would follow another for as long as one is set: they wait for data.
    """
    settings = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
