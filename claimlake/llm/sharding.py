"""Weighted rendezvous sharding, in DataFrame functions only.

Each shard scores a record key by -ln(u) / weight, u in (0, 1) from a hash of key and shard; the smallest score
wins.  Key, shard number and weight decide, so another shard takes rows only into itself.  Slots number the rows
of a shard without a window over a whole shard: rows are ordered inside hash buckets whose number grows with the
table, and a bucket's first slot is the sum of the counts before it.

Defined cases: null key: hashed as the text 'null'; null text: size 8, crc32 0; repeated rows: one slot each;
empty table: no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows per numbering bucket, on average.
BUCKET_ROWS = 20_000
_DIGITS = 13  # hex digits of the hash: exact in a double


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 ...) of ``key`` among shards of these weights; a weight of 0 takes nothing."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    scores = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            h = F.conv(F.substring(F.md5(F.concat(text, F.lit(f":{shard}"))), 1, _DIGITS), 16, 10).cast("double")
            scores.append(F.struct((-F.log((h + 0.5) / float(16 ** _DIGITS)) / float(weight)).alias("score"),
                                   F.lit(shard).alias("shard")))
    return (F.least(*scores) if len(scores) > 1 else scores[0])["shard"]


def shard(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs``."""
    rows = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        rendezvous(F.col("doc_id"), weights).alias("shard"),
        (rendezvous(F.col("doc_id"), grown) if grown else F.lit(None).cast("int")).alias("grown_shard"))
    buckets = docs.count() // (BUCKET_ROWS * len(weights)) + 8
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(buckets)))
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("at", F.row_number().over(inside)).join(first, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"),
                    (F.col("first") + F.col("at") - 1).cast("long").alias("slot"),
                    F.col("grown_shard").cast("int").alias("grown_shard")))
