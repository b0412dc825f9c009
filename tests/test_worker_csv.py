"""The image-set CSV of a job: where its command looks for it, and cell by cell."""

from __future__ import annotations

import csv
import os

from pyspark.sql import functions as F

from conftest import FOLDER
from plateflow import constants as C
from plateflow import functions as PF
from plateflow.fixtures import Tables
from plateflow.plans.submit import plan_submission
from plateflow.sources.sinks import worker_lines


def test_files_of_jobs(spark, tmp_path):
    t = Tables(spark, FOLDER)
    images = t.images.where("plate_acquisition_id < 30")
    plan = plan_submission(images, t.sub_analyses, t.analyses, t.plate_acquisition, t.channel_map, run_id=F.lit("r"))
    written = {r["path"]: r["rows"] for r in plan.write_image_sets(str(tmp_path)).collect()}
    jobs = plan.jobs.withColumn("file", PF.job_paths(F.col("sub_id"), F.col("job_name"))["imageset_file"]).collect()
    assert written == {r["file"].replace(C.WORK_ROOT, f"{tmp_path}/"): r["n_image_sets"] for r in jobs} and len(jobs) > 1
    sets = {}
    for row in plan.wide.collect():
        sets.setdefault(row["job_name"], []).append(row)
    for path, count in written.items():
        with open(path, newline="") as file:
            head, *lines = list(csv.reader(file))
        rows = sorted(sets[os.path.basename(path)[:-4]], key=lambda row: row["ImageNumber"])
        dyes = [dye for dye in plan.dyes if dye in rows[0]["header"]]
        own = ["Group_Index", "Group_Number", "ImageNumber", "Metadata_Barcode", "Metadata_Site", "Metadata_Well", "Metadata_AcqID", "Metadata_z"]
        assert head == [f"FileName_{d}" for d in dyes] + own + [f"{kind}_{d}" for kind in ("PathName", "URL") for d in dyes]
        assert lines == [["" if row[name] is None else str(row[name]) for name in head] for row in rows] and len(lines) == count
    assert not [name for _, _, names in os.walk(tmp_path) for name in names if not name.endswith(".csv")]


def test_correction_and_quotes(spark):
    row = (1, "j", 0, 1, 0, "P", 2, "A01", 7, 0, 'a"b.tif', None, "/d", None, "file:/d", None, "u", "p", "f", ["D1"], True)
    own = "Group_Index int, Group_Number int, ImageNumber int, Metadata_Barcode string, Metadata_Site int, Metadata_Well string, Metadata_AcqID bigint, Metadata_z int"
    columns = ", ".join(f"{kind}{dye} string" for kind in ("FileName_", "PathName_", "URL_") for dye in ("D1", "D2"))
    table = spark.createDataFrame([row], f"sub_id bigint, job_name string, {own}, {columns}, URL_ICF_D1 string, PathName_ICF_D1 string, FileName_ICF_D1 string, header array<string>, use_icf boolean")
    table = table.withColumns({f"{kind}_ICF_D2": F.lit(None).cast("string") for kind in ("URL", "PathName", "FileName")})
    (line,) = worker_lines(table, ["D1", "D2"]).collect()
    assert line["head"] == "FileName_D1,Group_Index,Group_Number,ImageNumber,Metadata_Barcode,Metadata_Site,Metadata_Well,Metadata_AcqID,Metadata_z,PathName_D1,URL_D1,URL_ICF_D1,PathName_ICF_D1,FileName_ICF_D1"
    assert line["line"] == '"a""b.tif",0,1,0,"P",2,"A01",7,0,"/d","file:/d","u","p","f"'
    (two,) = worker_lines(table.withColumns({"header": F.array(F.lit("D1"), F.lit("D2")), "use_icf": F.lit(False)}), ["D1", "D2"]).collect()
    assert two["line"] == '"a""b.tif",,0,1,0,"P",2,"A01",7,0,"/d",,"file:/d",'
