"""Resampling a corpus towards a target text set by hashed n-gram importance weights.

Features are runs of one to ``width`` words.  Separators collapse to single spaces, then one regular expression is
searched with ``overlapped=True``: every blank before a word is a match whose lookahead spans the runs that start
there, so the n-grams come as spans of the text itself and go straight to CRC-32.  A feature's bucket is its CRC
modulo ``buckets``.  Gains compare the buckets' counts in the target texts with those in the corpus; a row's weight is
the sum of gains over its features, and a fixed draw per doc_id turns weights into a sample without replacement
(the highest of weight + Gumbel noise).

The corpus is scanned once: the sorted buckets of every row are staged as differences, counted from there and weighed
from there.  The order over all rows comes from a range partitioning, not from one sorted group.

Defined cases: null or empty text, text without words: no features, weight 0, never drawn; null doc_id: its draw is
that of the word ``null``, last among ties; repeated rows: each row by itself; equal scores: smaller doc_id first;
no target texts: all target counts 0; empty table: no rows; texts of any length: scanned in pieces of ``PIECE`` bytes
that share ``width - 1`` words; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Bytes of a text scanned at a time.
PIECE = 1 << 20
#: Bytes that belong to words, A-Z as a-z; all others as blanks.
_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                    for b in range(256))


def span_pattern(width: int) -> regex.Pattern:
    """Matches every blank that ``width`` words follow; group k spans the run of the first ``width - k + 1`` of them."""
    word = rb"[^ ]++"
    runs = word
    for _ in range(width - 1):
        runs = rb"(" + runs + rb") " + word
    return regex.compile(rb" (?=(" + runs + rb") )")


def _pieces(words: bytes, width: int) -> Iterator[bytes]:
    """Blank-enclosed pieces of collapsed text that share ``width - 1`` words, so every full run lies in one of them."""
    at = 0
    while at < len(words) - 1:
        end = len(words) - 1
        if end - at > PIECE:
            end = words.find(b" ", at + PIECE)
        stop = end
        for _ in range(width - 1):
            if stop < len(words) - 1:
                stop = words.find(b" ", stop + 1)
        yield words[at:stop + 1]
        at = end


def feature_hashes(text: bytes, patterns: list[regex.Pattern]) -> tuple[int, np.ndarray]:
    """(number of words, CRC-32 of every run of 1 to len(patterns) words) of one UTF-8 text; ``patterns``: widest first."""
    collapsed = b" ".join(text.translate(_WORD_BYTES).split())
    if not collapsed:
        return 0, np.zeros(0, np.uint32)
    words, found = b" " + collapsed + b" ", []
    for width, pattern in zip(range(len(patterns), 0, -1), patterns, strict=True):
        for piece in _pieces(words, width):
            spans = chain.from_iterable(m.groups() for m in pattern.finditer(piece, overlapped=True))
            found.append(np.fromiter(map(crc32, spans), np.uint32))
        # What starts in the last width - 1 words is shorter: the next pattern scans those alone.
        words = b" " + b" ".join(words.rsplit(b" ", width)[1:-1]) + b" "
        if not words.strip():
            break
    return collapsed.count(b" ") + 1, np.concatenate(found)


def _scan(batches: Iterator[pa.RecordBatch], width: int, buckets: int) -> Iterator[pa.RecordBatch]:
    patterns = [span_pattern(w) for w in range(width, 0, -1)]
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        counts, sizes, packed, done, held = [], [], [], 0, 0
        for i, text in enumerate(texts):
            n, hashes = feature_hashes(text.as_py() or b"", patterns)
            own = np.sort((hashes % np.uint32(buckets)).astype(kind))
            counts.append(n)
            sizes.append(len(own))
            packed.append(np.diff(own, prepend=own[:0].dtype.type(0)).tobytes())
            held += len(packed[-1])
            if held > PIECE * 8 or i == len(texts) - 1:
                rest = batch.slice(done, len(counts)).drop_columns(["text"])
                yield pa.RecordBatch.from_arrays(
                    [*rest.columns, pa.array(counts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
                    names=[*rest.schema.names, "n_words", "n_features", "buckets"])
                counts, sizes, packed, done, held = [], [], [], i + 1, 0


def bucket_lists(texts: DataFrame, width: int, buckets: int) -> DataFrame:
    """``texts`` with n_words, n_features and the packed buckets of its features in place of ``text``; staged."""
    fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in texts.schema.fields if f.name != "text")
    return staged(texts.mapInArrow(lambda it: _scan(it, width, buckets),
                                   fields + "n_words long, n_features long, buckets binary"), "features")


def _unpacked(column: pa.Array, buckets: int) -> Iterator[np.ndarray]:
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    for packed in column:
        yield np.cumsum(np.frombuffer(packed.as_py(), kind), dtype=np.int64)


def bucket_counts(lists: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) over all features of ``lists``; each task adds up its rows first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for own in _unpacked(batch.column(0), buckets):
                total += np.bincount(own, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return lists.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> list[int]:
    """Per bucket floor(1000 ln of the smoothed ratio of target to corpus share); ``buckets`` counts of each side come to
    the driver, whatever the size of the texts."""
    s, t = ({r.bucket: r.n for r in side.collect()} for side in (corpus, target))
    all_s, all_t = (float(sum(side.values()) + buckets) for side in (s, t))
    return [floor(1000.0 * log(float(t.get(b, 0) + 1) * all_s / (float(s.get(b, 0) + 1) * all_t))) for b in range(buckets)]


def weighed(lists: DataFrame, gain: list[int]) -> DataFrame:
    """``lists`` with the sum of gains over each row's features in place of its buckets."""
    value = np.array(gain, np.int64)
    fields = [f for f in lists.schema.fields if f.name != "buckets"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = [int(value[own].sum()) for own in _unpacked(batch.column("buckets"), len(value))]
            rest = batch.drop_columns(["buckets"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(weight, pa.int64())],
                                             names=[*rest.schema.names, "weight"])

    return lists.mapInArrow(weigh, "".join(f"{f.name} {f.dataType.simpleString()}, " for f in fields) + "weight long")


def ranked(rows: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """``rows`` with their number from 1 in ``order``: sorted ranges are staged, each with its rows' places, and a
    range starts after the sizes of those before it (one row per range is added up, never the rows themselves)."""
    placed = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("place", F.monotonically_increasing_id())
                    .withColumn("range", F.shiftright("place", 33)).withColumn("place", F.col("place").bitwiseAND((1 << 33) - 1)),
                    "ranges")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("range").count().select("range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    return (placed.join(F.broadcast(starts), "range").withColumn(name, F.col("start") + F.col("place") + 1)
            .drop("range", "place", "start"))


def importance_sample(docs: DataFrame, target: DataFrame, width: int = 3, buckets: int = 10_000, least_words: int = 20,
                      per_cent: int = 5, seed: int = 42) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``.  Of the rows with at least ``least_words``
    words, ``per_cent`` % are drawn by score; rank numbers them from 1 and is null for all others."""
    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    lists = bucket_lists(numbered, width, buckets)
    wanted = bucket_lists(target.select("text"), width, buckets)
    weight = weighed(lists, gains(bucket_counts(lists, buckets), bucket_counts(wanted, buckets), buckets))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    draw = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000.0 * F.log(-F.log((draw + 0.5) / 4294967296.0)))
    scored = staged(weight.withColumn("score", F.col("weight") + noise).withColumn("row", F.monotonically_increasing_id())
                    .withColumn("open", F.col("n_words") >= least_words)
                    .select("doc_id", "n_features", "weight", "score", "open", "row"), "scored")
    order = [F.col("open").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    drawn = scored.agg(F.floor(per_cent * F.count_if("open") / 100).alias("drawn")).first()[0] or 0
    return ranked(scored, order).select(
        "doc_id", "n_features", "weight", "score",
        F.when(F.col("open") & (F.col("rank") <= drawn), F.col("rank")).alias("rank"))
