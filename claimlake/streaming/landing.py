"""Landing by column name: files of one entity arrive with their columns in any order, with unknown or missing ones.

A stream over the landing folder hands each new file to one micro-batch exactly once (the checkpoint knows the files).
The batch reads the header line of each of its files and no more of them, groups the files by header, and reads every group with Spark's CSV
parser under that header's own names.  Known columns are then taken by name; what is left over goes to a rescue document
beside the row.  Each batch writes its own folder of the table, so a repeated batch replaces what it wrote before.

Beside the table lies its log: ``layouts`` (the headers met, their files, unknown and missing columns, per batch) and
``expectations`` (rows that pass and fail the warn-only rule ``no_rescued_data``, per batch).

Defined cases: names match without regard to case, blanks around them or a byte-order mark; of two equal names the first
counts, the other is unknown; a file without lines gives no rows; a missing column is null; a line with more or fewer
fields than its header keeps its raw text in the rescue document; a folder without new files changes nothing.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import AUDIT_INGESTED_AT, AUDIT_SOURCE_FILE, RESCUED, landing_columns

BATCH = "landing_batch"
#: Layouts of one batch at most: each is a read of its own.
MOST_LAYOUTS = 200
_LINE = "_malformed_line"


def header_names(header: str) -> list[str]:
    """The column names of a header line, lower-case; empty and repeated ones get a name of their own."""
    names: list[str] = []
    for i, cell in enumerate(next(csv.reader([header.removeprefix("﻿")]), [])):
        name = cell.strip().lower() or f"_c{i}"
        names.append(name if name not in names else f"{name}#{i}")
    return names


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file, by Hadoop's file systems and codecs; None if it has none.  No more of it is read."""
    hadoop, io, conf = spark._jvm.org.apache.hadoop, spark._jvm.java.io, spark._jsc.hadoopConfiguration()
    at = hadoop.fs.Path(path)
    stream = at.getFileSystem(conf).open(at)
    try:
        codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
        line = io.BufferedReader(io.InputStreamReader(stream if codec is None else codec.createInputStream(stream), "UTF-8")).readLine()
    finally:
        stream.close()
    return None if line is None else line.removeprefix("\ufeff")


def layouts(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Files by header; the driver holds one line for each file of the batch."""
    out = defaultdict(list)
    with ThreadPoolExecutor(16) as pool:  # the waits are those of the file system
        for path, header in zip(paths, pool.map(lambda path: first_line(spark, path), paths), strict=True):
            if header is not None:
                out[header].append(path.replace("file:/", "file:///", 1) if re.match("file:/[^/]", path) else path)
    if len(out) > MOST_LAYOUTS:
        raise ValueError(f"{len(out)} different headers in one batch; lower max_files_per_trigger")
    return dict(out)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def read_layout(spark: SparkSession, files: Sequence[str], header: str, columns: Sequence[str]) -> DataFrame:
    """Files of one header: ``columns`` by name, the rescue document, the source file."""
    names = header_names(header)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _LINE]])
    rows = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _LINE).csv(list(files)))
    unknown = [_quoted(n).alias(n) for n in [*names, _LINE] if n not in columns]
    # Leaves nulls out; rows without anything unknown, most of them, need no document made.
    document = F.when(F.coalesce(*[_quoted(n) for n in [*names, _LINE] if n not in columns]).isNotNull(), F.to_json(F.struct(*unknown)))
    return rows.select(*[_quoted(c).alias(c) if c in names else F.lit(None).cast("string").alias(c) for c in columns],
                       document.alias(RESCUED), F.col("_metadata.file_path").alias(AUDIT_SOURCE_FILE))


def land_files(spark: SparkSession, paths: Sequence[str], entity: str) -> tuple[DataFrame | None, list[tuple]]:
    """All rows of ``paths``, and (header, files, unknown, missing) per layout."""
    columns, out, log = landing_columns(entity), None, []
    for header, files in sorted(layouts(spark, paths).items()):
        names = header_names(header)
        log.append((header, sorted(files), [n for n in names if n not in columns], [c for c in columns if c not in names]))
        part = read_layout(spark, files, header, columns)
        out = part if out is None else out.unionByName(part)
    return out, log


def land_by_name(spark: SparkSession, src: str, entity: str, checkpoint: str, out: str,
                 max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Starts a triggered stream from the folder ``src`` to the table folder ``out`` (log: ``<out>-log``)."""
    out = out.rstrip("/")

    def land(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        paths = [r.path for r in batch.collect()]  # at most max_files_per_trigger
        rows, log = land_files(session, paths, entity) if paths else (None, [])
        if rows is None:
            return
        seen = Observation()
        (rows.withColumn(AUDIT_INGESTED_AT, F.current_timestamp())
         .observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(RESCUED).isNotNull()).alias("failed"))
         .write.mode("overwrite").parquet(f"{out}/{BATCH}={number}"))
        passed, failed = seen.get["rows"] - seen.get["failed"], seen.get["failed"]
        for name, held, schema in (
                ("layouts", log, "header string, files array<string>, unknown array<string>, missing array<string>"),
                ("expectations", [(entity, "no_rescued_data", passed, failed)], "entity string, expectation string, passed long, failed long")):
            session.createDataFrame(held, schema).write.mode("overwrite").parquet(f"{out}-log/{name}/{BATCH}={number}")

    # Only paths are selected, so the files' contents are not read here.
    found = (spark.readStream.format("binaryFile").option("maxFilesPerTrigger", max_files_per_trigger)
             .schema("path string, modificationTime timestamp, length long, content binary").load(src).select("path"))
    return (found.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def run_landing(spark: SparkSession, src: str, entity: str, checkpoint: str, out: str, **how) -> None:
    """One triggered landing to its end; raises what the stream raised."""
    q = land_by_name(spark, src, entity, checkpoint, out, **how)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def landed(spark: SparkSession, out: str) -> DataFrame:
    """The table: known columns, rescue document, audit columns and the number of the batch."""
    return spark.read.parquet(out)


def landing_log(spark: SparkSession, out: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{out.rstrip('/')}-log/{name}")
