"""The metadata tables as derived from the generic test tables: once as SQL text, once as DataFrames.

The SQL text heads the checking queries. The DataFrames say the same with an exploded array in place of a
cross join and with `number_rows` in place of a window over a group of unknown size.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plateflow.operators.ranking import number_rows

# Tables whose rows are multiplied below.
_LARGE = ("lineitem",)
# Rows of these that a task may have: some 150 MB once they are multiplied and have their texts.
ROWS_PER_TASK = 100_000
DYES = ["HOECHST", "SYTO", "MITO", "CONCAVALIN", "PHALLOIDINandWGA"]

_CHANNELS = """(SELECT 1 AS channel, 'HOECHST' AS dye UNION ALL SELECT 2, 'SYTO' UNION ALL SELECT 3, 'MITO'
  UNION ALL SELECT 4, 'CONCAVALIN' UNION ALL SELECT 5, 'PHALLOIDINandWGA')"""

_FIELDS = [
    "l_suppkey AS plate_acquisition_id",
    "concat('P', lpad(CAST(l_suppkey AS STRING), 6, '0')) AS plate_barcode",
    "CAST(l_orderkey % 3 + 1 AS INT) AS timepoint",
    "concat(substr('ABCDEFGH', CAST(l_partkey % 8 AS INT) + 1, 1),"
    " lpad(CAST(CAST(floor(l_partkey / 8) AS BIGINT) % 12 + 1 AS STRING), 2, '0')) AS well",
    "l_linenumber AS site",
    "CAST(l_quantity AS INT) % 5 AS z",
]

_IMAGE_PATH = """concat('/share/mikro/', plate_barcode, '/tp', CAST(timepoint AS STRING), '/', well, '_s',
  CAST(site AS STRING), '_z', CAST(z AS STRING), '_w', CAST(channel AS STRING), '.tif')"""

SQL: dict[str, str] = {
    "channel_map": f"""
SELECT m.map_id, c.channel, c.dye
FROM (SELECT 0 AS map_id UNION ALL SELECT 1 UNION ALL SELECT 2) m CROSS JOIN {_CHANNELS} c
WHERE NOT (m.map_id = 2 AND c.channel = 5)""",
    "plate_acquisition": """
SELECT s_suppkey AS id, concat('P', lpad(CAST(s_suppkey AS STRING), 6, '0')) AS plate_barcode,
       CAST(s_suppkey % 3 AS INT) AS channel_map_id
FROM supplier""",
    "images_raw": f"""
SELECT i.*, {_IMAGE_PATH} AS path
FROM (SELECT {', '.join(_FIELDS)}, c.channel, c.dye FROM lineitem CROSS JOIN {_CHANNELS} c
      WHERE (l_orderkey + c.channel) % 37 <> 0) i""",
    "sub_analyses": """
SELECT o_orderkey AS sub_id, o_custkey AS analysis_id, CAST(o_custkey % 100 AS BIGINT) AS plate_acquisition_id,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(substr(o_orderpriority, 1, 1) AS INT) END AS priority,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey - 1 END AS dep1,
       CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey - 10 END AS dep2,
       CASE WHEN o_orderkey % 5 = 0 THEN -1 END AS dep3,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS start,
       CASE WHEN o_orderkey % 11 < 2 THEN NULL ELSE o_orderdate + INTERVAL '1' DAY END AS finish,
       CASE WHEN o_orderkey % 97 = 5 THEN o_orderdate END AS error,
       concat('{"type":"', CASE WHEN o_orderkey % 50 = 0 THEN 'jupyter_notebook' WHEN o_orderkey % 53 = 1 THEN 'odd' ELSE 'cellprofiler' END,
              '","batch_size":', CASE WHEN o_orderkey % 61 = 7 THEN '"many"' ELSE CAST(o_orderkey % 9 - 1 AS STRING) END,
              CASE WHEN o_orderkey % 4 = 0 THEN ',"z":"0-1,3"' ELSE '' END,
              CASE WHEN o_orderkey % 37 = 2 THEN ',"site_filter":[77]' WHEN o_orderkey % 35 = 0 THEN ',"site_filter":["1","2"]'
                   WHEN o_orderkey % 5 = 0 THEN ',"site_filter":[1,2,3]' ELSE '' END,
              CASE WHEN o_orderkey % 41 = 3 THEN ',"channels":["NONE"]' WHEN o_orderkey % 6 = 0 THEN ',"channels":["HOECHST","MITO"]' ELSE '' END,
              CASE WHEN o_orderkey % 23 = 1 THEN '' ELSE ',"pipeline_file":"p.cppipe"' END,
              CASE WHEN o_orderkey % 43 = 1 THEN ',"priority":"1","job_timeout":"600","sub_type":"qc","cp_version":"v9"' ELSE '' END,
              CASE WHEN o_orderkey % 7 = 0 THEN ',"run_on_uppmax":true' WHEN o_orderkey % 7 = 1 THEN ',"run_on_uppmax":false'
                   WHEN o_orderkey % 7 = 2 THEN ',"run_on_pelle":null' ELSE '' END,
              CASE WHEN o_orderkey % 8 = 0 THEN ',"max_errors":10' WHEN o_orderkey % 31 = 7 THEN ',"max_errors":"many"'
                   WHEN o_orderkey % 31 = 9 THEN ',"max_errors":"10"' ELSE '' END, '}') AS meta
FROM orders""",
    # Parent analyses: unfinished unless the key says otherwise; some are kept for other backends.
    "analyses": """
SELECT c_custkey AS id, concat('P', lpad(CAST(c_custkey % 100 AS STRING), 6, '0')) AS plate_barcode,
       CAST(c_custkey % 100 AS BIGINT) AS plate_acquisition_id,
       CASE WHEN c_custkey % 10 = 3 THEN TIMESTAMP '2024-01-05 00:00:00' END AS finish,
       CASE WHEN c_custkey % 17 = 5 THEN TIMESTAMP '2024-01-06 00:00:00' END AS error,
       CASE WHEN c_custkey % 19 = 7 THEN '{"run_on_pelle":null}' WHEN c_custkey % 19 = 8 THEN '{"run_on_hpcdev":true}'
            ELSE '{"run_on_uppmax":true}' END AS meta
FROM customer""",
    "jobs": """
SELECT concat('cpp-worker-job-', CAST(user_id AS STRING), '-r', lpad(CAST(user_id AS STRING), 7, '0'), '-',
              CAST(job_number AS STRING), '-', CAST(n + CASE WHEN user_id % 4 = 1 THEN 1 ELSE 0 END AS STRING), '-',
              CAST(user_id % 30 AS STRING)) AS job_name,
       ts,
       CASE WHEN event_type = 'error' THEN 'Failed'
            WHEN event_type = 'signup' AND user_id % 2 = 1 THEN NULL
            ELSE 'Complete' END AS cond_type,
       CASE WHEN event_type = 'signup' AND user_id % 2 = 1 THEN NULL ELSE 'True' END AS cond_status
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS job_number,
             count(*) OVER (PARTITION BY user_id) AS n FROM events) e""",
    "measurements": """
SELECT CAST(l_suppkey % 8 AS INT) AS job_number, l_orderkey AS ImageNumber, l_linenumber AS ObjectNumber,
       l_extendedprice AS AreaShape_Area, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount END AS Intensity_Mean,
       l_returnflag AS Metadata_Well
FROM lineitem""",
    # Files a sub-analysis left behind, relative to its job folder.
    "manifest": """
SELECT l_orderkey AS sub_id,
       CASE l_linenumber % 5 WHEN 0 THEN concat('overlay/', l_returnflag, '/img_', CAST(l_partkey AS STRING), '.PNG')
            WHEN 1 THEN concat('masks/m', CAST(l_suppkey AS STRING), '.tiff')
            WHEN 2 THEN concat('ICF_', l_linestatus, '.npy')
            WHEN 3 THEN concat('thumb_', CAST(l_partkey AS STRING), '.jpg')
            ELSE 'Nuclei.parquet' END AS path
FROM lineitem""",
    # Changes of the status document, in the order of `seq`.
    "status_events": """
SELECT user_id AS sub_id, user_id % 30 AS analysis_id, ts, event_id AS seq,
       CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'progress' ELSE 'status' END AS status_key,
       concat(event_type, ' ', CAST(event_id AS STRING)) AS status_value
FROM events""",
    # Changes of start, finish and error, in the order of `seq`.
    "lifecycle_events": """
SELECT user_id AS sub_id, user_id % 30 AS analysis_id, ts, event_id AS seq,
       CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'purchase' THEN 'finish'
            WHEN event_type = 'signup' AND event_id % 7 = 0 THEN 'reset' ELSE 'start' END AS kind
FROM events""",
    # Replies of a batch system.
    "submissions": """
SELECT o_orderkey AS sub_id,
       CASE WHEN o_orderkey % 6 = 0 THEN concat('batch: error: Batch job submission failed ', CAST(o_orderkey AS STRING))
            ELSE concat('wait... Submitted batch job ', CAST(o_orderkey * 7 AS STRING), ' on cluster') END AS reply
FROM orders""",
}


def with_ctes(*names: str) -> str:
    """The head of a checking query: the named derivations as common table expressions."""
    return "WITH " + ",\n".join(f"{name} AS ({SQL[name]})" for name in names) + "\n"


class Tables:
    """The derived tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def base(self, name: str) -> DataFrame:
        """A test table; one whose rows are multiplied is spread over all cores, and over more tasks where these would hold many rows."""
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name not in _LARGE:
            return table
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-table.count() // ROWS_PER_TASK))
        return table.repartition(tasks) if table.rdd.getNumPartitions() < tasks else table

    def _sql(self, name: str, source: str) -> DataFrame:
        self.base(source).createOrReplaceTempView(source)
        return self.spark.sql(SQL[name])

    @staticmethod
    def _channel_array(dyes: list[str] = DYES):
        return F.array(
            *[F.struct(F.lit(number).alias("channel"), F.lit(dye).alias("dye")) for number, dye in enumerate(dyes, 1)]
        )

    @cached_property
    def channel_map(self) -> DataFrame:
        """The maps that the acquisitions use, each with its channels."""
        maps = self.plate_acquisition.select(F.col("channel_map_id").alias("map_id")).dropDuplicates()
        return maps.select("map_id", F.inline(self._channel_array())).where("NOT (map_id = 2 AND channel = 5)")

    @cached_property
    def plate_acquisition(self) -> DataFrame:
        return self._sql("plate_acquisition", "supplier")

    @cached_property
    def images(self) -> DataFrame:
        fields = self.base("lineitem").selectExpr("l_orderkey", *_FIELDS)
        return (
            fields.select("*", F.inline(self._channel_array()))
            .where("(l_orderkey + channel) % 37 <> 0")
            .drop("l_orderkey")
            .withColumn("path", F.expr(_IMAGE_PATH))
        )

    @cached_property
    def sub_analyses(self) -> DataFrame:
        deps = F.array_compact(F.array("dep1", "dep2", "dep3"))
        return (
            self._sql("sub_analyses", "orders")
            .withColumn("depends_on_sub_id", F.when(F.size(deps) > 0, deps))
            .drop("dep1", "dep2", "dep3")
        )

    @cached_property
    def analyses(self) -> DataFrame:
        return self._sql("analyses", "customer").withColumns(
            {name: F.col(name).cast("timestamp_ntz") for name in ("finish", "error")}
        )

    @cached_property
    def jobs(self) -> DataFrame:
        numbered = number_rows(self.base("events"), ["user_id"], ["event_id"], "job_number", "n")
        running = (F.col("event_type") == "signup") & (F.col("user_id") % 2 == 1)
        total = F.col("n") + F.when(F.col("user_id") % 4 == 1, 1).otherwise(0)
        user = F.col("user_id").cast("string")
        name = F.concat(
            F.lit("cpp-worker-job-"),
            F.concat_ws(
                "-", user, F.concat(F.lit("r"), F.lpad(user, 7, "0")), F.col("job_number").cast("string"),
                total.cast("string"), (F.col("user_id") % 30).cast("string"),
            ),
        )
        condition = F.when(F.col("event_type") == "error", "Failed").otherwise("Complete")
        return numbered.select(
            name.alias("job_name"),
            "ts",
            F.when(~running, condition).alias("cond_type"),
            F.when(~running, F.lit("True")).alias("cond_status"),
        )

    @cached_property
    def measurements(self) -> DataFrame:
        return self._sql("measurements", "lineitem")

    @cached_property
    def manifest(self) -> DataFrame:
        return self._sql("manifest", "lineitem")

    @cached_property
    def status_events(self) -> DataFrame:
        return self._sql("status_events", "events")

    @cached_property
    def lifecycle_events(self) -> DataFrame:
        return self._sql("lifecycle_events", "events")

    @cached_property
    def submissions(self) -> DataFrame:
        return self._sql("submissions", "orders")

