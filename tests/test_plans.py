"""What the plans must show: pruning, pushdown, and no more shuffles than needed."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import FOLDER
from plateflow.fixtures import Tables
from plateflow.functions.settings import with_settings
from plateflow.operators import analyses as A
from plateflow.operators import images as I
from plateflow.operators import imagesets as S
from plateflow.operators import jobs as J
from plateflow.sources.catalog import read_catalog, write_catalog


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    t = Tables(spark, FOLDER)
    folder = str(tmp_path_factory.mktemp("catalog"))
    write_catalog({
        "images": t.images, "channel_map": t.channel_map, "plate_acquisition": t.plate_acquisition,
        "image_analyses": t.analyses, "image_sub_analyses": t.sub_analyses,
    }, folder)
    return read_catalog(spark, folder)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_acquisition_reads_its_partition(catalog):
    table = S.image_set_table(
        catalog["images"], catalog["plate_acquisition"], catalog["channel_map"], batch_size=7, acquisition_id=3
    )
    scans = [line for line in plan(table).splitlines() if "FileScan" in line and "path#" in line]
    assert scans and all(re.search(r"PartitionFilters: \[[^\]]*plate_acquisition_id#\d+L? = 3", line) for line in scans)
    assert {r["Metadata_AcqID"] for r in table.collect()} == {3}


def test_focus_reads_one_column(catalog):
    assert "ReadSchema: struct<z:int>" in plan(I.middle_z(catalog["images"]))


def test_site_filter_is_pushed_down(catalog):
    assert "GreaterThan(site,3)" in plan(catalog["images"].where("site > 3").select("path"))


def test_pending_analyses_prune_plates(catalog):
    pending = with_settings(A.pending(catalog["image_sub_analyses"]).where("analysis_id % 100 IN (5, 77)"))
    images = I.images_of(catalog["images"], pending)
    assert images.count() > 0
    assert "dynamicpruning" in plan(images)
    assert {r[0] for r in images.select("plate_acquisition_id").distinct().collect()} <= {5, 77}


def test_flagship_shuffles_images_once(catalog):
    table = S.image_set_table(catalog["images"], catalog["plate_acquisition"], catalog["channel_map"], batch_size=7)
    text = plan(table)
    main = text[: text.index("BroadcastExchange")] if "BroadcastExchange" in text else text
    assert main.count("Exchange hashpartitioning(plate_acquisition_id") == 1
    assert main.count("+- Sort ") == 1


def test_no_plan_has_a_cross_join_or_python(catalog):
    subs, images = catalog["image_sub_analyses"], catalog["images"]
    pending = A.pending(subs)
    for df in (A.ready(pending, subs), I.select_images(images, with_settings(pending)), S.image_sets(images)):
        assert not re.search("CartesianProduct|NestedLoop|Python|Pandas", plan(df))


def test_expected_counts_at_the_larger_scale(spark):
    t = Tables(spark, "/root/testdata/sf0.01")
    assert (A.pending(t.sub_analyses).count(), A.ready(A.pending(t.sub_analyses), t.sub_analyses).count()) == (1350, 1014)
    conditions = F.when(F.col("cond_type").isNotNull(), F.array(F.struct(F.col("cond_type").alias("type"), F.col("cond_status").alias("status"))))
    families = J.job_families(J.job_states(t.jobs.select("job_name", conditions.alias("conditions"))))
    assert (families.count(), J.complete_families(families).count()) == (150, 75)
    assert families.where("n_failed > 14").count() == 57
    sizes = S.image_sets(t.images).groupBy((F.size("images") == 5).alias("whole")).count().collect()
    assert {r["whole"]: r["count"] for r in sizes} == {True: 50651, False: 7628}
    states = {r["state"]: r["count"] for r in A.rollup_states(t.sub_analyses).groupBy("state").count().collect()}
    assert states == {"failed": 147, "finished": 224, "pending": 1129}
    assert S.image_set_table(t.images, t.plate_acquisition, t.channel_map, batch_size=7).count() == 11517


def test_no_pending_analyses_select_no_images(catalog):
    none = with_settings(catalog["image_sub_analyses"].where("sub_id < 0"))
    assert I.images_of(catalog["images"], none).count() == 0
