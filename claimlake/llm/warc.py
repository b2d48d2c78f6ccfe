"""WARC as a Spark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Writing: every task writes one file of gzip members, one WARC/1.1 record each.  The file's name carries a random part,
and the commit lists the files of the tasks that counted in ``_files.json``: files of lost or repeated tasks are
never read.  Every member states its own length in the gzip extra field ``sl`` (WARC 1.1, annex D), so a reader can
pass over it unopened.

Reading: one partition per file.  Equality and null filters on header columns are pushed into the reader
(``spark.sql.python.filterPushdown.enabled``).  It inflates the head of a member first, tests the filters on the
header, and inflates the payload only of records that are kept, and only if option ``payload`` is not ``false``.

``archive`` lays a table out as response and revisit records; see there for the defined cases.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, InputPartition,
                                    IsNotNull, WriterCommitMessage)

from claimlake.session import scratch_path

from .files import file_system, make_folder, read_bytes, write_bytes

SCHEMA = ("record_id string, record_type string, target_uri string, warc_date string, payload_digest string, "
          "payload_bytes long, refers_to string, payload binary")

#: Header field of each column; the payload is the block itself.
FIELDS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
          "warc_date": "WARC-Date", "payload_digest": "WARC-Payload-Digest", "payload_bytes": "X-Payload-Length",
          "refers_to": "WARC-Refers-To"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEAD = struct.Struct("<4BIBB")  # gzip: magic, method, flags, time, extra flags, system
EXTRA = struct.Struct("<H2sHII")  # length of the extra field, "sl", 8, packed and plain length
_CHUNK = 1 << 16


def _clean(value: object) -> str:
    """A header value stays on its line."""
    return "".join(" " if ch in "\r\n" else ch for ch in str(value))


def pack_record(row: dict) -> bytes:
    payload = bytes(row.get("payload") or b"")
    lines = ["WARC/1.1"] + [f"{name}: {_clean(row[c])}" for c, name in FIELDS.items() if row.get(c) is not None]
    if row.get("record_type") == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines += ["Content-Type: text/html", f"Content-Length: {len(payload)}", "", ""]
    plain = "\r\n".join(lines).encode() + payload + b"\r\n\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(plain) + deflate.flush()
    tail = struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)
    whole = HEAD.size + EXTRA.size + len(body) + len(tail)
    return (HEAD.pack(0x1F, 0x8B, 8, 4, 0, 0, 255) + EXTRA.pack(12, b"sl", 8, whole, len(plain) & 0xFFFFFFFF)
            + body + tail)


def _record(stream, want, payload: bool) -> tuple[tuple | None, bool]:
    """The next record of ``stream`` if ``want`` takes its header fields, and whether there was one."""
    head = stream.read(HEAD.size)
    if not head:
        return None, False
    if head[:2] != b"\x1f\x8b" or not head[3] & 4:
        raise ValueError("not a member with a skip length")
    whole = EXTRA.unpack(stream.read(EXTRA.size))[3]
    left = whole - HEAD.size - EXTRA.size
    inflate, plain, end, seen = zlib.decompressobj(-15), bytearray(), -1, 0
    while end < 0:
        piece = inflate.unconsumed_tail
        if not piece:
            piece = stream.read(min(left, _CHUNK))
            left -= len(piece)
        # Without a piece, what the inflater still holds.
        more = inflate.decompress(piece, _CHUNK)
        if not piece and not more or inflate.eof and not more:
            raise ValueError("a record without the end of its header")
        plain += more
        end = plain.find(b"\r\n\r\n", seen)
        seen = max(len(plain) - 3, 0)
    header, block = bytes(plain[:end]), bytes(plain[end + 4:])
    fields = dict(line.split(": ", 1) for line in header.decode().split("\r\n")[1:] if ": " in line)
    values = {c: fields.get(name) for c, name in FIELDS.items()}
    values["payload_bytes"] = int(values["payload_bytes"]) if values["payload_bytes"] else None
    if not want(values):
        stream.seek(left, 1)
        return None, True
    body = None
    if payload:
        size = int(fields["Content-Length"])
        rest = inflate.unconsumed_tail + stream.read(left)
        body = (block + inflate.decompress(rest))[:size]
    else:
        stream.seek(left, 1)
    return (*[values[c] for c in FIELDS], body), True


class WarcPartition(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.equal, self.present = path, payload, [], []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in FIELDS:
                self.equal.append((f.attribute[0], f.value))
            elif isinstance(f, IsNotNull) and len(f.attribute) == 1 and f.attribute[0] in FIELDS:
                self.present.append(f.attribute[0])
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [WarcPartition(f"{self.path}/{name}") for name in json.loads(read_bytes(f"{self.path}/_files.json"))]

    def read(self, partition: WarcPartition) -> Iterator[tuple]:
        equal, present = self.equal, self.present

        def want(values: dict) -> bool:
            return all(values[c] == v for c, v in equal) and all(values[c] is not None for c in present)

        system, path = file_system(partition.path)
        with system.open_input_file(path) as stream:
            more = True
            while more:
                record, more = _record(stream, want, self.payload)
                if record is not None:
                    yield record


class WarcWritten(WriterCommitMessage):
    def __init__(self, name: str):
        self.name = name


class WarcWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator) -> WriterCommitMessage:
        name = f"{uuid.uuid4().hex}.warc.gz"
        system, path = file_system(f"{self.path}/{name}")
        with system.open_output_stream(path, compression=None) as out:
            for row in iterator:
                out.write(pack_record(row.asDict()))
        return WarcWritten(name)

    def commit(self, messages: list[WarcWritten]) -> None:
        write_bytes(f"{self.path}/_files.json", json.dumps([m.name for m in messages if m is not None]).encode())

    def abort(self, messages) -> None:
        pass


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options["path"].rstrip("/"), self.options.get("payload", "true").lower() != "false")

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return WarcWriter(self.options["path"].rstrip("/"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def _digest_text(hexadecimal: F.Column) -> F.Column:
    return F.concat(F.lit("sha1:"), hexadecimal)


def records(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """One WARC record per row of ``pages`` (page_id, url, html).

    Equal payloads of ``least_bytes`` or more: the largest page_id is the response, the rest revisit it.  Null html: an
    empty payload; null page_id: a response, never referred to; repeated page_id with equal payloads: all responses;
    null url: no target; empty table: no records; other columns are not read.
    """
    html = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("payload"),
                        F.sha1(html).alias("digest"), F.octet_length(html).cast("long").alias("payload_bytes"))
    first = (base.filter((F.col("payload_bytes") >= least_bytes) & F.col("page_id").isNotNull())
             .groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
             .filter("n > 1").drop("n"))
    base = base.join(first, "digest", "left")
    revisit = F.col("page_id").isNotNull() & (F.col("first") != F.col("page_id"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    return base.select(
        F.coalesce(urn(F.col("page_id")), F.lit("<urn:page:>")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.col("url").alias("target_uri"),
        F.lit("1970-01-01T00:00:00Z").alias("warc_date"), _digest_text(F.col("digest")).alias("payload_digest"), "payload_bytes",
        F.when(revisit, urn(F.col("first"))).alias("refers_to"),
        F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"))


def archive(pages: DataFrame, least_bytes: int = 1000) -> str:
    """Writes ``records`` of ``pages`` as WARC files; returns their folder."""
    spark = pages.sparkSession
    register(spark)
    path = scratch_path(spark, "warc")
    make_folder(path)
    records(pages, least_bytes).write.format("warc").mode("append").save(path)
    return path


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Per page what the archives hold.  Payloads of responses are read and digested anew, and a mismatch with the
    header raises; revisits are read by header alone."""
    register(spark)
    read = spark.read.format("warc")
    response = read.load(path).filter("record_type = 'response'")
    sound = (F.octet_length("payload") == F.col("payload_bytes")) & (_digest_text(F.sha1("payload")) == F.col("payload_digest"))
    response = response.withColumn("payload_digest", F.when(sound, F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("payload and header differ: "), F.col("record_id"))))).drop("payload")
    revisit = read.option("payload", "false").load(path).filter("record_type = 'revisit'").drop("payload")
    page = lambda c: F.regexp_extract(c, "<urn:page:(-?[0-9]+)>", 1)
    return response.unionByName(revisit).select(
        F.expr("try_cast(regexp_extract(record_id, '<urn:page:(-?[0-9]+)>', 1) as bigint)").alias("page_id"),
        "payload_bytes", F.substring("payload_digest", 6, 40).alias("payload_digest"), "record_type",
        F.when(F.col("refers_to").isNotNull(), page("refers_to")).cast("long").alias("refers_to"), "target_uri")
