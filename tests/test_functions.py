from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plateflow import functions as PF


def values(spark, column, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [row["v"] for row in rows.select("i", column(F.col("t")).alias("v")).orderBy("i").collect()]


def test_parse_ranges_forms(spark):
    texts = ["2-5,7,15-17,12", "9-8", "1-2-4", "-7", "-7-9", "3", " 3 ,1", "a", "1,,2", "", None, "5,5,4-6"]
    assert values(spark, PF.parse_ranges, texts) == [
        [2, 3, 4, 5, 7, 12, 15, 16, 17], [8, 9], [1, 2, 3, 4], [-7], None, [3], [1, 3], None, None, None, None, [4, 5, 6],
    ]


element = st.one_of(
    st.integers(0, 60).map(lambda n: (str(n), {n})),
    st.tuples(st.integers(0, 60), st.integers(0, 60)).map(
        lambda ends: (f"{ends[0]}-{ends[1]}", set(range(min(ends), max(ends) + 1)))
    ),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(element, min_size=1, max_size=6), min_size=20, max_size=20))
def test_parse_ranges_equals_set(spark, cases):
    texts = [",".join(text for text, _ in case) for case in cases]
    expected = [sorted(set().union(*[numbers for _, numbers in case])) for case in cases]
    assert values(spark, PF.parse_ranges, texts) == expected


def test_paths(spark):
    texts = ["/a/b/c.tif", "c.tif", "/c.tif", "a/", "a//b.tif", ""]
    assert values(spark, PF.base_name, texts) == ["c.tif", "c.tif", "c.tif", "", "b.tif", ""]
    assert values(spark, PF.dir_name, texts) == ["/a/b", "", "/", "a", "a", ""]
    assert values(spark, PF.is_image_file, ["x.PNG", "x.tiff", "x.tif.gz", "tif", "a/.jpg"]) == [
        True, True, False, False, True,
    ]


def test_job_name_round_trip(spark):
    rows = spark.range(50).select(
        F.col("id").alias("sub_id"), (F.col("id") * 3).alias("analysis_id"), F.lit("k9x").alias("run_id"),
        (F.col("id") % 7).alias("job_number"), F.lit(7).alias("n_jobs"),
    )
    parts = [F.col(name) for name in ("sub_id", "run_id", "job_number", "n_jobs", "analysis_id")]
    parsed = rows.select("*", PF.parse_job_name(PF.job_name(*parts)).alias("p"))
    assert parsed.where(
        "p.sub_id = sub_id AND p.analysis_id = analysis_id AND p.n_jobs = 7"
        " AND p.job_family = concat('cpp-worker-job-', sub_id, '-k9x')"
    ).count() == 50


def test_odd_job_names(spark):
    parsed = values(spark, PF.parse_job_name, ["cpp-worker-job-5-abc", "other", "xcpp-worker-job-5-abc-0-1-2", "cpp-worker-job-ab-c-1-2-3"])
    assert tuple(parsed[0]) == (5, "cpp-worker-job-5-abc", None, None)
    assert tuple(parsed[1]) == tuple(parsed[2]) == (None, None, None, None)
    assert tuple(parsed[3]) == (None, None, None, None)


def test_json_keys(spark):
    texts = ['{"a":null}', '{"a":false}', '{"a":true}', '{"b":1}', None]
    assert values(spark, lambda t: PF.has_key(t, "a"), texts) == [True, True, True, False, False]
    assert values(spark, lambda t: PF.json_flag(t, "a"), texts) == [False, False, True, False, False]
    assert values(spark, lambda t: PF.json_text(t, "a"), texts) == [None, "false", "true", None, None]


def test_batch_reply(spark):
    texts = ["note\nSubmitted batch job 123 on x", "error", None]
    assert values(spark, PF.batch_id, texts) == ["123", None, None]
