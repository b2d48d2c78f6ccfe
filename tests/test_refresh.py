"""Refresh of date partitions in place: replaced, new and vanished days; few files a partition."""

import os
from datetime import date, timedelta

from pyspark.sql import functions as F

from claimlake.sources import files, incremental


def _rows(path, spark):
    return {(r.day, r.id, r.v) for r in spark.read.parquet(path).collect()}


def test_refresh_partitions_replaces_adds_and_drops(spark, tmp_path):
    path, start = str(tmp_path / "t"), date(2024, 1, 1)
    old = [(start + timedelta(i % 20), i, "old") for i in range(200)] + [(None, 999, "undated")]
    files.write_partitioned(spark.createDataFrame(old, "day date, id long, v string"), path, "day")
    # days 12 to 19 are reloaded: 14 and 19 have gone, 20 and 21 are new; older rows of the source are not taken
    new = [(start + timedelta(i % 22), i, "new") for i in range(220) if i % 22 not in (14, 19)]
    expect = {r for r in old if r[0] is None or r[0] < start + timedelta(12)} | {r for r in new if r[0] >= start + timedelta(12)}
    source = spark.createDataFrame(new, "day date, id long, v string")
    incremental.refresh_partitions(spark, path, source, "day")
    assert _rows(path, spark) == expect
    assert not os.path.exists(f"{path}/day=2024-01-15")
    # The last day is 21 now, so 14 to 21 are reloaded; the same source changes nothing, an empty one empties those days.
    incremental.refresh_partitions(spark, path, source, "day")
    assert _rows(path, spark) == expect
    incremental.refresh_partitions(spark, path, source.limit(0), "day")
    assert _rows(path, spark) == {r for r in expect if r[0] is None or r[0] < start + timedelta(14)}


def test_refresh_may_read_its_own_table(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_partitioned(spark.range(100).select(F.expr("date_add(date'2024-01-01', int(id % 10))").alias("day"), "id",
                                                    F.lit("a").alias("v")), path, "day")
    incremental.refresh_partitions(spark, path, spark.read.parquet(path).withColumn("v", F.lit("b")), "day", days=3)
    assert {(r.v, r["count"]) for r in spark.read.parquet(path).groupBy("v").count().collect()} == {("a", 60), ("b", 40)}


def test_few_files_a_partition(spark, tmp_path):
    df = spark.range(0, 40000, 1, 16).select((F.col("id") % 5).alias("p"), "id")
    files.write_partitioned(df, str(tmp_path / "a"), "p")
    files.materialize(df, files.TableConfig(str(tmp_path)), "silver", "b", partition_by=["p"])
    for table in ("a", "silver/b"):
        for p in range(5):
            assert len([f for f in os.listdir(tmp_path / table / f"p={p}") if f.endswith(".parquet")]) == 1


def test_first_fetch_window_begins_at_the_start(spark):
    empty = spark.createDataFrame([], "rate_date date")
    for target in (None, empty):
        r = incremental.high_water_mark(target, "rate_date", date(2024, 1, 5), start=date(2024, 1, 1)).collect()
        assert [tuple(x) for x in r] == [(date(2024, 1, 1), date(2024, 1, 5), False)]
    years = incremental.year_chunks(incremental.high_water_mark(None, "rate_date", date(2024, 1, 5), start=date(2022, 6, 1)))
    assert years.count() == 3
