"""WARC archives as a PySpark Python data source (format name ``warc``).

Reading: archives (``.warc`` or ``.warc.gz``, one gzip member per record) are
planned as partitions of about ``partitionBytes``. Archives written here are
cut at the record starts that their manifest lists, so one large archive is
read by many tasks; where record starts of other archives lie is not known
without reading them, so these are taken whole. A record's
headers are parsed first; pushed predicates on the header columns decide
before its block is touched. A block is only inflated when the requested
schema has ``payload`` and the predicates hold; else the reader jumps to the
next record (by the member's skip-lengths field, by Content-Length in plain
archives, or by inflating without keeping when a member has no such field).

Writing: one archive (or more, at ``rollBytes``) per task, each member with a
skip-lengths field. Names are unique per attempt and the commit lists the
files in a manifest, with a record start every ``splitBytes``, so leftovers of
failed attempts are never read.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo,
                                    GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan,
                                    LessThanOrEqual, StringContains, StringEndsWith,
                                    StringStartsWith, WriterCommitMessage)
from pyspark.sql.types import StructType

from reelrank.llm.common import join_groups, ship, written
from reelrank.llm.files import delete_files, new_part, open_fs, read_manifest, write_manifest

ship(__name__)

#: Column and the WARC header it comes from.
HEADER_COLUMNS = {
    "warc_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
    "date": "warc-date", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest",
    "content_type": "content-type",
}
SCHEMA = ("warc_type string, record_id string, target_uri string, date string, refers_to string, "
          "payload_digest string, content_type string, payload_length long, "
          "headers map<string,string>, payload binary")
WRITE_SCHEMA = ("warc_type string, record_id string, target_uri string, date string, "
                "refers_to string, payload_digest string, payload_length long, payload binary")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"
_CHUNK = 16 << 10


def _header_value(text: str) -> str:
    """Line breaks would end the header; they are percent-encoded."""
    return text.replace("\r", "%0D").replace("\n", "%0A").strip(" \t")


def record_bytes(row: dict) -> bytes:
    """A WARC/1.1 record; the block is the HTTP response the payload came in."""
    payload = b"" if row["warc_type"] == "revisit" else row["payload"] or b""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {row['payload_length']}\r\n\r\n").encode()
    head = [("WARC-Type", row["warc_type"]), ("WARC-Record-ID", f"<{row['record_id']}>"),
            ("WARC-Date", row["date"]), ("WARC-Target-URI", row["target_uri"]),
            ("WARC-Payload-Digest", row["payload_digest"])]
    if row["warc_type"] == "revisit":
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{row['refers_to']}>")]
    head += [("Content-Type", "application/http; msgtype=response"),
             ("Content-Length", str(len(http) + len(payload)))]
    lines = "".join(f"{k}: {_header_value(v)}\r\n" for k, v in head if v is not None)
    return b"WARC/1.1\r\n" + lines.encode("utf-8") + b"\r\n" + http + payload + _END


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """One gzip member whose extra field ``sl`` holds its own length and the data's."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    total = 10 + 2 + 12 + len(body) + 8
    if max(total, len(data)) > 0xFFFFFFFF:
        return b"\x1f\x8b\x08\x00" + b"\0" * 5 + b"\xff" + body + tail
    extra = b"sl" + struct.pack("<HII", 8, total, len(data))
    return (b"\x1f\x8b\x08\x04" + b"\0" * 5 + b"\xff" + struct.pack("<H", len(extra))
            + extra + body + tail)


class _Member:
    """The bytes of one gzip member, inflated as far as asked for."""

    def __init__(self, src: io.BufferedReader) -> None:
        self.src, self.start = src, src.tell()
        head = src.read(10)
        if len(head) < 10 or head[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {self.start}")
        self.length = None
        if head[3] & 4:
            (n,) = struct.unpack("<H", src.read(2))
            extra = src.read(n)
            while len(extra) >= 4:
                size = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"sl" and size == 8:
                    self.length = struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + size:]
        for flag in (8, 16):  # file name and comment, ended by a zero byte
            while head[3] & flag and src.read(1) not in (b"\0", b""):
                pass
        if head[3] & 2:
            src.read(2)
        self.inflate = zlib.decompressobj(-15)

    def more(self) -> bytes:
        """Some more data; empty at the member's end."""
        while not self.inflate.eof:
            data = self.src.read(_CHUNK)
            if not data:
                raise ValueError(f"the gzip member at byte {self.start} is cut short")
            out = self.inflate.decompress(data)
            if out:
                return out
        return b""

    def leave(self) -> None:
        """Stand behind the member, without inflating what nobody asked for."""
        if self.length is not None:
            self.src.seek(self.start + self.length)
            return
        while self.more():
            pass
        self.src.seek(-len(self.inflate.unused_data) + 8, io.SEEK_CUR)


class _Plain:
    """The bytes of one record of an archive that isn't compressed."""

    def __init__(self, src: io.BufferedReader) -> None:
        self.src, self.start, self.length = src, src.tell(), None

    def more(self) -> bytes:
        return self.src.read(_CHUNK)

    def leave(self) -> None:
        self.src.seek(self.start + self.length)


def _parse(head: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        key, colon, value = line.partition(":")
        if colon:
            out[key.strip().lower()] = value.strip()
    return out


def _until(part, data: bytearray, start: int) -> int:
    """Place of the blank line after ``start``, reading on as needed; -1: none."""
    at = data.find(_END, start)
    while at < 0:
        more = part.more()
        if not more:
            return -1
        seen = max(start, len(data) - 3)
        data += more
        at = data.find(_END, seen)
    return at


def _dechunk(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16) if end >= 0 else 0
        if not size:
            return b"".join(out)
        out.append(body[end + 2:end + 2 + size])
        at = end + 2 + size + 2


def read_records(src: io.BufferedReader, start: int, end_at: int, gz: bool, wanted,
                 columns: set[str]) -> Iterator[dict]:
    """The records that begin in bytes ``start`` to ``end_at`` and for which ``wanted`` holds.

    ``start`` is the first byte of a record; ``wanted`` takes the header columns.
    """
    src.seek(start)
    while src.tell() < end_at:
        part = _Member(src) if gz else _Plain(src)
        data = bytearray()
        end = _until(part, data, 0)
        if end < 0:
            if not bytes(data).strip():
                return
            raise ValueError(f"a record at byte {part.start} has no end of headers")
        headers = _parse(bytes(data[:end]))
        length = int(headers.get("content-length", 0))
        block = end + len(_END)
        if not gz:
            part.length = block + length + len(_END)
        row = {c: headers.get(h) for c, h in HEADER_COLUMNS.items()}
        for c in ("record_id", "refers_to"):
            row[c] = row[c].strip("<>") if row[c] else None
        if not wanted(row):
            part.leave()
            continue
        http = (row["content_type"] or "").startswith("application/http")
        body, own = block, {}
        if http and columns & {"payload", "payload_length"}:
            at = _until(part, data, block)
            if 0 <= at < block + length:
                own, body = _parse(bytes(data[block:at])), at + len(_END)
        row["payload_length"] = block + length - body
        if row["warc_type"] == "revisit" and own.get("content-length", "").isdigit():
            row["payload_length"] = int(own["content-length"])
        row["headers"] = list(headers.items())
        if "payload" in columns:
            while len(data) < block + length:
                more = part.more()
                if not more:
                    raise ValueError(f"the record at byte {part.start} is cut short")
                data += more
            row["payload"] = bytes(data[body:block + length])
            if own.get("transfer-encoding", "").lower() == "chunked":
                row["payload"] = _dechunk(row["payload"])
                row["payload_length"] = len(row["payload"])
        part.leave()
        yield row


class _Ranges(InputPartition):
    """Ranges (path, start, end) of archives; each starts at a record."""

    def __init__(self, ranges: list[tuple[str, int, int]]) -> None:
        super().__init__(None)
        self.ranges = ranges


def plan_ranges(files: list[dict], most: int) -> list[list[tuple[str, int, int]]]:
    """Lists of ranges (path, start, end) of about ``most`` bytes, cut at the files' marks.

    A list is longer only by what lies between two marks (or by a whole file
    without any).
    """
    parts, part, room = [], [], most
    for f in sorted(files, key=lambda f: f["path"]):
        starts = [0, *f.get("marks", [])]
        for start, end in zip(starts, [*starts[1:], f["bytes"]]):
            if part and end - start > room:
                parts.append(part)
                part, room = [], most
            if part and part[-1][0] == f["path"]:
                part[-1] = (f["path"], part[-1][1], end)
            else:
                part.append((f["path"], start, end))
            room -= end - start
    return [*parts, part] if part else parts


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.columns, self.options, self.filters = schema.fieldNames(), options, []
        from pyspark.sql.pandas.types import to_arrow_schema
        self.arrow = to_arrow_schema(schema)

    def pushFilters(self, filters: list) -> Iterator:
        kinds = (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual,
                 StringStartsWith, StringEndsWith, StringContains)
        for f in filters:
            if isinstance(f, kinds) and len(f.attribute) == 1 and f.attribute[0] in HEADER_COLUMNS:
                self.filters.append((type(f).__name__, f.attribute[0], f.value))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        path, most = self.options["path"], int(self.options.get("partitionbytes", 128 << 20))
        listed = read_manifest(path)
        if listed is None:
            system, inner = open_fs(path)
            infos = system.get_file_info(inner)
            infos = [infos] if infos.type == pafs.FileType.File else system.get_file_info(
                pafs.FileSelector(inner, recursive=True))
            listed = [{"path": i.path if "://" not in path else
                       path.split("://")[0] + "://" + i.path, "bytes": i.size}
                      for i in infos if i.path.endswith((".warc", ".warc.gz"))]
        return [_Ranges(p) for p in plan_ranges(listed, most)] or [_Ranges([])]

    def _wanted(self, row: dict) -> bool:
        for kind, column, value in self.filters:
            got = row[column]
            if got is None or not {
                    "EqualTo": lambda: got == value, "In": lambda: got in value,
                    # code points order as UTF-8 does in Spark
                    "GreaterThan": lambda: got > value, "GreaterThanOrEqual": lambda: got >= value,
                    "LessThan": lambda: got < value, "LessThanOrEqual": lambda: got <= value,
                    "StringStartsWith": lambda: got.startswith(value),
                    "StringEndsWith": lambda: got.endswith(value),
                    "StringContains": lambda: value in got}[kind]():
                return False
        return True

    def read(self, partition: _Ranges) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for path, start, end in partition.ranges:
            system, inner = open_fs(path)
            with system.open_input_file(inner) as raw:
                src = io.BufferedReader(raw, 1 << 20)
                for row in read_records(src, start, end, path.endswith(".gz"), self._wanted,
                                        set(self.columns)):
                    rows.append({c: row.get(c) for c in self.columns})
                    held += len(row.get("payload") or b"") + 500
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, self.arrow)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, self.arrow)


class _Written(WriterCommitMessage):
    def __init__(self, files: list[dict]) -> None:
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.roll = int(options.get("rollbytes", 1 << 30))
        self.level = int(options.get("level", 6))
        self.split = int(options.get("splitbytes", 32 << 20))

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        from pyspark import TaskContext

        files, out, size, marks = [], None, 0, []
        system, inner = open_fs(self.path)
        system.create_dir(inner, recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = new_part(self.path, TaskContext.get().partitionId(), ".warc.gz")
                    system, inner = open_fs(name)
                    out = system.open_output_stream(inner, compression=None, buffer_size=1 << 20)
                    size, marks = 0, []
                elif size - (marks[-1] if marks else 0) >= self.split:
                    marks.append(size)
                member = gzip_member(record_bytes(row), self.level)
                out.write(member)
                size += len(member)
                if size >= self.roll:
                    out.close()
                    files.append({"path": name, "bytes": size, "marks": marks})
                    out = None
        if out is not None:
            out.close()
            files.append({"path": name, "bytes": size, "marks": marks})
        return _Written(files)

    def commit(self, messages: list[_Written]) -> None:
        write_manifest(self.path, [f for m in messages if m for f in m.files])

    def abort(self, messages: list[_Written]) -> None:
        delete_files([f["path"] for m in messages if m for f in m.files])


class WarcDataSource(DataSource):
    """Options: path, partitionBytes (read), rollBytes, splitBytes and level (write)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def _register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None,
              **options) -> DataFrame:
    """Records of the archives below ``path``; filters on it are pushed down.

    Without ``payload`` among the columns no block is inflated beyond its
    headers. A folder without archives gives an empty result.
    """
    _register(spark)
    schema = StructType.fromDDL(SCHEMA)
    if columns is not None:
        schema = StructType([schema[c] for c in columns])
    return spark.read.format("warc").options(**options).schema(schema).load(path)


def write_warc(records: DataFrame, path: str, **options) -> None:
    """Write records (columns of WRITE_SCHEMA, more are ignored) to a new folder."""
    _register(records.sparkSession)
    columns = StructType.fromDDL(WRITE_SCHEMA).fieldNames()
    records.select(*columns).write.format("warc").mode("append").options(**options).save(path)


def page_records(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url",
                 body_col: str = "html", least: int = 100,
                 date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """WARC records (WRITE_SCHEMA) of a table of pages, equal payloads as revisits.

    Of rows with equal payloads of at least ``least`` bytes the one with the
    smallest id is the response (several if they repeat that id), the others
    revisit it. A null body is an empty payload; rows with a null id are
    responses that nothing refers to, named by digest and place; a null URI is
    left out of the headers. Equality goes by SHA-256. An empty table gives no
    records; payloads of any length are one record each. Only digests and ids are grouped; the payload
    moves at most once, and a hot payload is never gathered in one place.
    """
    base = pages.select(F.col(id_col).alias("id"), F.col(uri_col).alias("target_uri"),
                        F.coalesce(F.col(body_col), F.lit("")).cast("binary").alias("payload"))
    base = base.withColumn("sha", F.sha2("payload", 256)).withColumn(
        "payload_length", F.octet_length("payload").cast("long"))
    known = base.where(F.col("id").isNotNull() & (F.col("payload_length") >= least))
    groups = known.groupBy("sha").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = written(groups.where("n > 1"), "warc-payloads")
    rows = join_groups(base, groups, ["sha"], "n", "id")
    again = F.coalesce((F.col("id") != F.col("first")), F.lit(False))
    named = F.when(F.col("id").isNotNull(), F.concat(F.lit("urn:page:"), F.col("id").cast("string")))
    # a number that no other record of this table gets: pages without id may repeat a payload
    unnamed = F.concat(F.lit("urn:page-sha256:"), "sha", F.lit(":"),
                       F.monotonically_increasing_id().cast("string"))
    return rows.select(
        F.when(again, "revisit").otherwise("response").alias("warc_type"),
        F.coalesce(named, unnamed).alias("record_id"), "target_uri",
        F.lit(date).alias("date"),
        F.when(again, F.concat(F.lit("urn:page:"), F.col("first").cast("string")))
        .alias("refers_to"),
        F.concat(F.lit("sha256:"), "sha").alias("payload_digest"), "payload_length",
        F.when(~again, F.col("payload")).alias("payload"))
