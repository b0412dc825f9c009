"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "plateflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for; `conf` keys use `_` for `.`."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per session: the functions that list and read files need it."""
    context = spark.sparkContext
    if any(os.path.basename(str(path)) == "plateflow.zip" for path in context.listFiles):
        return
    folder = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="plateflow-"), "plateflow")
    context.addPyFile(shutil.make_archive(target, "zip", os.path.dirname(folder), os.path.basename(folder)))


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`; a temporary one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="plateflow-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


#: Folders given out in this process and not dropped yet.
_given: list[str] = []


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder, for tables that other stages read back."""
    _given.append(f"{checkpoint_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}")
    return _given[-1]


def drop_intermediate(spark: SparkSession) -> int:
    """Delete what this process has written below the shared folder, once all results are written elsewhere.

    Frames that were planned before can no longer be read. Returns the number of folders.
    """
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    dropped = 0
    while _given:
        path = jvm.org.apache.hadoop.fs.Path(_given.pop())
        dropped += bool(path.getFileSystem(hadoop).delete(path, True))
    return dropped


#: Whether shuffle files go when the query that made them has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder.

    It is computed once, cuts the lineage, and outlives executors, so that several uses see the same rows. Shuffle files that led
    to it are deleted, since nothing is computed again from before it.
    """
    path, conf = shared_folder(df.sparkSession, purpose), df.sparkSession.conf
    places = [f"c{place}" for place in range(len(df.columns))]  # any column name will do
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        df.toDF(*places).write.parquet(path)
    finally:
        conf.set(_CLEANUP, before)
    table = df.sparkSession.read.parquet(path).select(*places).toDF(*df.columns)
    table._written_to = path
    return table


def together(tables: Sequence[DataFrame]) -> DataFrame:
    """The rows of tables with the same columns that `written` has made, read as one: plans do not grow with their number."""
    columns = tables[0].columns
    places = [f"c{place}" for place in range(len(columns))]
    return tables[0].sparkSession.read.parquet(*[table._written_to for table in tables]).select(*places).toDF(*columns)


def drop_written(*tables: DataFrame) -> None:
    """Delete tables that `written` has made, once all that is planned from them is written itself."""
    for table in tables:
        spark, path = table.sparkSession, table._written_to
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        if path in _given:
            _given.remove(path)
