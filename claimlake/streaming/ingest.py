"""Incremental landing → bronze ingest with Structured Streaming.

``readStream.csv`` with a fixed schema tracks processed files in the
checkpoint, so each landed file is ingested exactly once across restarts;
``trigger(availableNow=True)`` processes what is there and stops, which is
the triggered (not continuous) mode the reference runs in.  The warn-only
expectation ``_rescued_data IS NULL`` is an ``observe`` metric on the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import RESCUED, bronze_schema, ingest_audit_cols


def rescue_malformed(reader, col: str = RESCUED):
    """PERMISSIVE parsing that keeps the raw text of malformed lines in ``col``."""
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", col)


def bronze_stream(spark: SparkSession, src: str, entity: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(bronze_schema(entity, rescued=True)).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = rescue_malformed(reader).csv(src)
    return ingest_audit_cols(df).observe(
        f"bronze_{entity}_expectations",
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(RESCUED).isNotNull()).alias("rescued_rows"),
    )


def ingest_stream(spark: SparkSession, src: str, entity: str, checkpoint: str, out: str,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start an availableNow stream from the landing folder to a bronze parquet table."""
    df = bronze_stream(spark, src, entity, max_files_per_trigger)
    return (df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .option("path", out).outputMode("append").trigger(availableNow=True).start())


def run_ingest(spark: SparkSession, src: str, entity: str, checkpoint: str, out: str) -> None:
    """Run one triggered ingest to completion."""
    q = ingest_stream(spark, src, entity, checkpoint, out)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
