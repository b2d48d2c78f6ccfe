"""Landing by column name: any order, unknown and missing columns, malformed lines, restarts, repeated batches."""

import json

import pytest

from claimlake.session import scratch_path
from claimlake.sources import files
from claimlake.streaming import landing


@pytest.fixture
def folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def _put(folder, name, *lines):
    (folder / "in" / name).write_text("".join(f"{x}\n" for x in lines))


def _run(spark, folder, **how):
    landing.run_landing(spark, str(folder / "in"), "vehicles", str(folder / "ckpt"), str(folder / "out"), **how)


def _rows(spark, folder):
    return {r.vehicle_id: r for r in landing.landed(spark, str(folder / "out")).collect()}


def test_columns_bind_by_name_and_the_rest_is_rescued(spark, folder):
    columns = files.BRONZE_COLUMNS["vehicles"]
    _put(folder, "a.csv", ",".join(columns), ",".join(f"a{i}" for i in range(len(columns))))
    _put(folder, "b.csv", "﻿Make , VEHICLE_ID,vin,colour,Colour,x.y", 'Ford,b0,V1,"red, dark",again,7', "Kia,b1,,,,")
    _put(folder, "c.csv", "vehicle_id,make", "c0,Opel,surplus", "c1", "c2,Seat")
    _put(folder, "empty.csv")
    _run(spark, folder)
    rows = _rows(spark, folder)
    assert set(rows) == {"a0", "b0", "b1", "c0", "c1", "c2"}
    assert [rows["a0"][c] for c in columns] == [f"a{i}" for i in range(len(columns))] and rows["a0"]._rescued_data is None
    b0 = rows["b0"]
    assert (b0.make, b0.vin, b0.colour, b0.mileage) == ("Ford", "V1", "red, dark", None)
    assert json.loads(b0._rescued_data) == {"colour#4": "again", "x.y": "7"}
    assert rows["b1"]._rescued_data is None and rows["b1"].vin is None
    assert json.loads(rows["c0"]._rescued_data) == {"_malformed_line": "c0,Opel,surplus"} and rows["c0"].make == "Opel"
    assert json.loads(rows["c1"]._rescued_data) == {"_malformed_line": "c1"} and rows["c2"]._rescued_data is None
    assert rows["c2"]._source_file.endswith("c.csv") and rows["c2"]._ingested_at is not None
    log = {r.header: r for r in landing.landing_log(spark, str(folder / "out"), "layouts").collect()}
    assert log["vehicle_id,make"].unknown == [] and "vin" in log["vehicle_id,make"].missing and len(log) == 3
    counted = landing.landing_log(spark, str(folder / "out"), "expectations").first()
    assert (counted.passed, counted.failed) == (3, 3)


def test_files_land_once_across_restarts_and_batches(spark, folder):
    for i in range(5):
        _put(folder, f"{i}.csv", *(["vehicle_id,make"] if i % 2 else ["make,vehicle_id"]), *([f"v{i},m"] if i % 2 else [f"m,v{i}"]))
    _run(spark, folder, max_files_per_trigger=2)
    assert {r.make for r in _rows(spark, folder).values()} == {"m"}
    _put(folder, "late.csv", "vehicle_id,new_column", "v9,1")
    _run(spark, folder)
    _run(spark, folder)
    table = landing.landed(spark, str(folder / "out"))
    assert table.count() == 6 and table.select(landing.BATCH).distinct().count() == 4
    assert sum(r.passed + r.failed for r in landing.landing_log(spark, str(folder / "out"), "expectations").collect()) == 6
    first = [p for p in (folder / "in").iterdir() if p.name in ("0.csv", "1.csv")]
    rows, _ = landing.land_files(spark, [p.as_uri() for p in first], "vehicles")
    again = str(folder / "out") + f"/{landing.BATCH}=0"
    before = spark.read.parquet(again).count()
    rows.withColumn(files.AUDIT_INGESTED_AT, landing.F.current_timestamp()).write.mode("overwrite").parquet(again)
    assert spark.read.parquet(again).count() == before == 2


def test_large_files_keep_their_header_over_splits(spark, folder):
    _put(folder, "big.csv", "make,vehicle_id", *[f"make{i},v{i}" for i in range(3000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows, log = landing.land_files(spark, [(folder / "in" / "big.csv").as_uri()], "vehicles")
        assert rows.rdd.getNumPartitions() > 3
        assert rows.filter("make = replace(vehicle_id, 'v', 'make') AND _rescued_data IS NULL").count() == 3000 == rows.count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_too_many_layouts_and_names(spark, folder, monkeypatch):
    assert landing.header_names("a,,A, b ,\"x,y\"") == ["a", "_c1", "a#2", "b", "x,y"] and landing.header_names("") == []
    _put(folder, "a.csv", "vehicle_id", "1")
    _put(folder, "b.csv", "make", "1")
    monkeypatch.setattr(landing, "MOST_LAYOUTS", 1)
    with pytest.raises(ValueError, match="different headers"):
        landing.layouts(spark, [p.as_uri() for p in (folder / "in").iterdir()])


def test_an_empty_folder_lands_nothing(spark):
    base = scratch_path(spark, "landing-none")
    spark.createDataFrame([], "vehicle_id string").write.option("header", True).csv(f"{base}/in")
    landing.run_landing(spark, f"{base}/in", "vehicles", f"{base}/ckpt", f"{base}/out")


def test_headers_take_no_job_and_files_may_be_compressed(spark, folder):
    """Only the first line of each file is read to find the layouts: no Spark job runs over the lines."""
    import gzip

    _put(folder, "a.csv", "make,vehicle_id", *[f"Kia,a{i}" for i in range(50)])
    _put(folder, "b c.csv", "\ufeffvehicle_id,make", "b0,Opel")
    (folder / "in" / "c.csv.gz").write_bytes(gzip.compress(b"vehicle_id,make\nc0,Seat\n"))
    _put(folder, "empty.csv")
    paths = [f"file:{folder}/in/{name}" for name in ("a.csv", "b c.csv", "c.csv.gz", "empty.csv")]
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        found = landing.layouts(spark, paths)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("headers")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {h: sorted(f.rsplit("/", 1)[1] for f in files) for h, files in found.items()} == {
        "make,vehicle_id": ["a.csv"], "vehicle_id,make": ["b c.csv", "c.csv.gz"]}
    _run(spark, folder)
    rows = _rows(spark, folder)
    assert len(rows) == 52 and rows["b0"].make == "Opel" and rows["c0"].make == "Seat"
