"""Triggered CSV stream: exactly-once across restarts, rescue column, warn-only expectation metric."""

from pyspark.sql import functions as F

from claimlake.plans.lake import Lake
from claimlake.session import scratch_path
from claimlake.sources import files
from claimlake.streaming import ingest

from .conftest import SF_SMALL


def test_stream_restart_is_exactly_once_and_reports_rescued_rows(spark):
    lk = Lake(spark, SF_SMALL)
    base = scratch_path(spark, "stream-test")
    src, ckpt, out = f"{base}/landing", f"{base}/_ckpt", f"{base}/bronze"
    b = lk.bronze("incidents")
    b.filter(F.col("incident_date") < "2024-01-15").write.option("header", True).csv(src)
    ingest.run_ingest(spark, src, "incidents", ckpt, out)
    first = spark.read.parquet(out).count()
    # second drop: one file with a surplus field on every line
    line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in files.BRONZE_COLUMNS["incidents"]])
    late = b.filter(F.col("incident_date") >= "2024-01-15")
    header = spark.createDataFrame([(",".join(files.BRONZE_COLUMNS["incidents"]),)], "value string")
    body = late.select(F.concat(line, F.lit(",surplus")).alias("value"))
    header.union(body).coalesce(1).write.mode("append").text(src)   # one file, header line first
    q = ingest.ingest_stream(spark, src, "incidents", ckpt, out)
    q.awaitTermination()
    metrics = [p["observedMetrics"] for p in q.recentProgress if p.get("observedMetrics")]
    landed = spark.read.parquet(out)
    assert landed.count() == b.count() and first < b.count()
    assert landed.filter(F.col(files.RESCUED).isNotNull()).count() == late.count()
    assert sum(m["bronze_incidents_expectations"]["rescued_rows"] for m in metrics) == late.count()
    ingest.run_ingest(spark, src, "incidents", ckpt, out)          # nothing new: no duplicates
    assert spark.read.parquet(out).count() == b.count()
