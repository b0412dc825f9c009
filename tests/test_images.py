from __future__ import annotations

import pytest
from conftest import FOLDER
from pyspark.sql import functions as F

from plateflow.functions.settings import with_settings
from plateflow.operators import images as I
from plateflow.operators import imagesets as S
from plateflow.operators.ranking import number_rows, with_places
from plateflow.operators.validation import validate
from plateflow.queries import QUERIES

DYES = ["D1", "D2", "D3"]


def catalogue(spark, fields, channels=(1, 2, 3)):
    """Images of fields (acquisition, timepoint, well, site, z) in the given channels."""
    rows = [
        (a, f"P{a}", t, w, s, z, c, f"D{c}", f"/img/{a}/{t}{w}{s}{z}_{c}.tif")
        for a, t, w, s, z in fields
        for c in channels
    ]
    return spark.createDataFrame(
        rows, "plate_acquisition_id bigint, plate_barcode string, timepoint int, well string, site int, z int,"
        " channel int, dye string, path string"
    )


def maps(spark, missing=()):
    acquisitions = spark.createDataFrame([(1, "P1", 0), (2, "P2", 1)], "id bigint, plate_barcode string, channel_map_id int")
    rows = [(m, c, f"D{c}") for m in (0, 1) for c in (1, 2, 3) if (m, c) not in missing]
    return acquisitions, spark.createDataFrame(rows, "map_id int, channel int, dye string")


def analyses(spark, *metas, acquisition=1):
    rows = [(i, 10 + i, acquisition, meta) for i, meta in enumerate(metas)]
    return spark.createDataFrame(rows, "sub_id bigint, analysis_id bigint, plate_acquisition_id bigint, meta string")


def test_middle_z_is_lower_median_of_distinct(spark):
    fields = [(1, 1, "A01", 1, z) for z in (0, 0, 0, 4, 6, 9)] + [(2, 1, "A01", 1, z) for z in (7, 5, 6)]
    images = catalogue(spark, fields)
    images = images.unionByName(images.limit(1).withColumn("z", F.lit(None).cast("int")))
    assert {tuple(r) for r in I.middle_z(images).collect()} == {(1, 4), (2, 6)}
    assert {tuple(r) for r in I.first_z(images).collect()} == {(1, 0), (2, 5)}


def test_empty_filter_differs_from_absent_one_for_channels_only(spark):
    images = catalogue(spark, [(1, 1, "A01", 1, 0), (1, 1, "B01", 2, 0)])
    subs = with_settings(analyses(
        spark, '{"type":"cellprofiler"}', '{"site_filter":[],"well_filter":[],"channels":[]}',
        '{"site_filter":[2]}', '{"well_filter":["A01"],"channels":["D1"]}', '{"z":"5"}',
    ))
    counts = {r["sub_id"]: r["count"] for r in I.select_images(images, subs).groupBy("sub_id").count().collect()}
    assert counts == {0: 6, 1: 6, 2: 3, 3: 1}
    acquisitions, channel_map = maps(spark)
    channels = subs.join(I.acquisition_channels(acquisitions, channel_map), "plate_acquisition_id")
    kept = {r["sub_id"]: r["count"] for r in I.filter_channel_map(channels).groupBy("sub_id").count().collect()}
    assert kept == {0: 3, 2: 3, 3: 1, 4: 3}


def test_no_images_selects_nothing(spark):
    images = catalogue(spark, [(1, 1, "A01", 1, 0)])
    subs = with_settings(analyses(spark, "{}", acquisition=2))
    assert I.select_images(images, subs).count() == 0


def test_image_sets_drop_repeats_and_sort_channels(spark):
    images = catalogue(spark, [(1, 1, "A01", 1, 0)])
    row = S.image_sets(images.unionByName(images)).first()
    assert [i["channel"] for i in row["images"]] == [1, 2, 3]
    assert row["imgset_id"] == "tp1-A01-1-0"


def test_missing_channel_is_null_not_shifted(spark):
    full = catalogue(spark, [(1, 1, "A01", 1, 0)])
    part = catalogue(spark, [(1, 1, "A01", 2, 0)], channels=(1, 3))
    table = S.image_set_table(full.unionByName(part), *maps(spark), batch_size=10)
    rows = {r["Metadata_Site"]: r for r in table.collect()}
    assert rows[1]["is_complete"] and not rows[2]["is_complete"]
    assert rows[2]["FileName_D2"] is None and rows[2]["FileName_D3"] == "1A0120_3.tif"
    assert [r["Group_Index"] for r in sorted(rows.values(), key=lambda r: r["Metadata_Site"])] == [0, 1]


def test_header_order(spark):
    table = S.image_set_table(catalogue(spark, [(1, 1, "A01", 1, 0)]), *maps(spark), batch_size=1, with_job=False)
    assert table.drop("is_complete").columns == [
        *[f"FileName_{d}" for d in DYES], "Group_Index", "Group_Number", "ImageNumber", "Metadata_Barcode", "Metadata_Site",
        "Metadata_Well", "Metadata_AcqID", "Metadata_z", *[f"PathName_{d}" for d in DYES], *[f"URL_{d}" for d in DYES],
    ]


def test_unmapped_channel_has_no_column_value(spark):
    images = catalogue(spark, [(2, 1, "A01", 1, 0)])
    row = S.image_set_table(images, *maps(spark, missing={(1, 3)}), batch_size=1).first()
    assert row["is_complete"] and row["FileName_D3"] is None


def test_sub_analysis_sets_apply_dye_filter(spark):
    images = catalogue(spark, [(1, 1, "A01", 1, 0)]).unionByName(catalogue(spark, [(1, 1, "A01", 2, 0)], channels=(3,)))
    subs = I.with_z_planes(with_settings(analyses(spark, '{"channels":["D1","D2"]}', "{}", '{"channels":["X"]}')), images)
    rows = S.sub_analysis_sets(images, subs, *maps(spark), DYES).collect()
    assert sorted((r["sub_id"], r["site"], r["is_complete"]) for r in rows) == [(0, 1, True), (1, 1, True), (1, 2, False)]
    assert all(r["path_D3"] is None for r in rows if r["sub_id"] == 0)


@pytest.mark.parametrize("largest_window", [1_000_000, 5])
@pytest.mark.parametrize("size", [0, -3, 1, 4, 1000])
def test_batches_cover_everything(spark, largest_window, size):
    fields = [(1, t, w, s, z) for t in (1, 2) for w in ("A01", "B02") for s in range(5) for z in (0, 1)] + [(2, 1, "A01", 1, 0)]
    sets = catalogue(spark, fields, channels=(1,)).select(*S.SET_COLUMNS)
    batches = S.assign_batches(sets, size, ("plate_acquisition_id",), max_window_rows=largest_window)
    rows = sorted(batches.collect(), key=lambda r: (r["plate_acquisition_id"], r["timepoint"], r["well"], r["site"], r["z"]))
    for acquisition, n in ((1, 40), (2, 1)):
        mine = [r for r in rows if r["plate_acquisition_id"] == acquisition]
        step = size if size > 0 else n
        assert [(r["job_number"], r["image_number"]) for r in mine] == [(i // step, i % step) for i in range(n)]
        assert {r["n_jobs"] for r in mine} == {-(-n // step)}


def test_hot_group_is_numbered_by_slices(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 2 == 0, F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.hash("id").alias("k"), "id",
    )
    by_window = number_rows(rows, ["g"], ["k", "id"])
    by_slices = number_rows(rows, ["g"], ["k", "id"], max_window_rows=100)
    assert by_slices.columns == by_window.columns
    assert sorted(map(str, by_slices.collect())) == sorted(map(str, by_window.collect()))


def test_limit_jobs(spark):
    sets = catalogue(spark, [(1, 1, "A01", s, 0) for s in range(9)], channels=(1,)).select(*S.SET_COLUMNS)
    batches = S.assign_batches(sets, 2, ("plate_acquisition_id",))
    assert S.limit_jobs(batches, 2).count() == 4
    assert S.limit_jobs(batches, None).count() == 9


def test_icf_only_where_used(spark):
    sets = catalogue(spark, [(1, 1, "A01", s, 0) for s in (1, 2)], channels=(1,)).select(*S.SET_COLUMNS)
    rows = S.with_icf_columns(sets, ["D1"], F.lit("/r"), F.col("site") == 1).orderBy("site").collect()
    assert (rows[0]["URL_ICF_D1"], rows[0]["PathName_ICF_D1"], rows[0]["FileName_ICF_D1"]) == ("file:/r/ICF_D1.npy", "/r", "ICF_D1.npy")
    assert rows[1]["URL_ICF_D1"] is None and rows[1]["FileName_ICF_D1"] is None


def test_validate_reports_every_problem(spark):
    images = catalogue(spark, [(1, 1, "A01", 1, 0)])
    subs = analyses(
        spark, '{"type":"cellprofiler"}', '{"type":"odd"}', '{"type":"cellprofiler","channels":[]}',
        '{"type":"cellprofiler","site_filter":[9]}', '{"type":"cellprofiler","z":"x"}', '{"type":"cellprofiler","channels":["X"]}',
        '{"type":"jupyter_notebook"}', '{}',
    )
    found = sorted((r["sub_id"], r["problem"][:9]) for r in validate(subs, images, *maps(spark)).collect())
    assert found == [
        (0, "No pipeli"), (1, "Unknown A"), (2, "Channel m"), (2, "No pipeli"), (3, "No images"), (3, "No pipeli"), (4, "No images"),
        (4, "No pipeli"), (5, "Channel m"), (5, "No images"), (5, "No pipeli"), (7, "Unknown A"),
    ]


def test_settings_in_other_forms(spark):
    images = catalogue(spark, [(1, 1, "A01", 1, 0)])
    subs = analyses(
        spark, '{"type":"cellprofiler","pipeline_file":"p","site_filter":["1","2"],"batch_size":"4","max_errors":"10"}',
        '{"type":"cellprofiler","pipeline_file":"p","site_filter":"1","well_filter":"A01"}',
        '{"type":"cellprofiler","pipeline_file":"p","site_filter":["x"],"batch_size":"few","channels":[1',
        '{"type":"cellprofiler","pipeline_file":"p","site_filter":["x"],"batch_size":"few","max_errors":{}}',
    )
    rows = {r["sub_id"]: r for r in with_settings(subs).collect()}
    assert (rows[0]["site_filter"], rows[0]["batch_size"], rows[0]["max_errors"]) == ([1, 2], 4, 10)
    assert (rows[1]["site_filter"], rows[1]["well_filter"]) == ([1], ["A01"])
    problems = sorted(r["problem"] for r in validate(subs, images, *maps(spark)).where("sub_id = 3").collect())
    assert [p for p in problems if p.startswith("Setting")] == [f"Setting that cannot be read: {s}" for s in ("batch_size", "max_errors", "site_filter")]


def test_problems_keep_jobs_away(spark):
    from plateflow.plans.submit import plan_submission

    images = catalogue(spark, [(1, 1, "A01", 1, 0), (2, 1, "A01", 1, 0)])
    good = '{"type":"cellprofiler","pipeline_file":"p","batch_size":1}'
    subs = analyses(
        spark, good, good.replace(":1}", ':"many"}'), '{"type":"cellprofiler"}', good.replace("}", ',"channels":["X"]}'),
        good.replace("}", ',"max_errors":"few"}'), good.replace("}", ',"z":"9"}'), '{"type":"jupyter_notebook"}', good.replace("cellprofiler", "odd"),
    ).withColumns({name: F.lit(None).cast("timestamp") for name in ("start", "finish", "error")})
    subs = subs.withColumns({"analysis_id": F.lit(1).cast("bigint"), "depends_on_sub_id": F.lit(None).cast("array<bigint>")})
    parents = spark.createDataFrame([(1, "P1", 1)], "id bigint, plate_barcode string, plate_acquisition_id bigint")
    plan = plan_submission(images, subs, parents, *maps(spark), run_id=F.lit("r"))
    assert {r["sub_id"] for r in plan.jobs.collect()} == {r["sub_id"] for r in plan.image_sets.collect()} == {0}
    assert {r["sub_id"] for r in plan.problems.collect()} == {1, 2, 3, 4, 5, 7}


def test_one_acquisition_has_its_own_columns(spark):
    images = catalogue(spark, [(1, 1, "A01", 1, 0), (2, 1, "A01", 1, 0)])
    acquisitions, channel_map = maps(spark, missing={(1, 3)})
    table = S.image_set_table(images, acquisitions, channel_map, batch_size=1, acquisition_id=2)
    assert table.count() == 1 and "FileName_D2" in table.columns and "FileName_D3" not in table.columns


def test_images_for_analyses_are_not_sorted(spark):
    """The images of all sub-analyses, many times the catalogue, meet hash tables; sorting them would put them on disk."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        QUERIES["images_for_analyses"](spark, FOLDER).explain()
    assert "HashAggregate" in out.getvalue() and "SortAggregate" not in out.getvalue()


def test_places_follow_the_order(spark):
    rows = spark.createDataFrame([(text,) for text in ["b", "a", None, "é", "b", "", "Z"]], "path string")
    placed = {(row["place"], row["path"]) for row in with_places(rows, "path", "place").collect()}
    assert [path for place, path in sorted(row for row in placed if row[0] is not None)] == ["", "Z", "a", "b", "b", "é"]
    assert [place for place, path in placed if path is None] == [None]
