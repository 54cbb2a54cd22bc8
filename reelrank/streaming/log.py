"""A partitioned, append-only message log in files: source with offsets, replay, writer.

Format ``message_log``. An append writes one segment file per task, which is
the log partition of that number, and one commit file that gives each segment
its first offset. Segments without a commit don't exist for readers, so a
failed or repeated append leaves no trace. A message's position (partition,
offset) never changes: streams restart at their positions, and a range can be
read again as a batch.

Options: ``path``; ``startingOffsets`` is ``earliest`` (default), ``latest``
(streams) or JSON {partition: offset}; ``endingOffsets`` (batch) JSON, exclusive.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader,
                                    DataSourceStreamReader, InputPartition, WriterCommitMessage)
from pyspark.sql.types import StructType

from reelrank.streaming import files

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "message_log"
SCHEMA = "value string, msg_partition int, msg_offset long"


class Segment(InputPartition):
    """Messages ``low`` to ``high`` (exclusive) of a segment file that starts at ``first``."""

    def __init__(self, name: str, partition: int, first: int, low: int, high: int) -> None:
        self.name, self.partition = name, partition
        self.first, self.low, self.high = first, low, high


class Written(WriterCommitMessage):
    def __init__(self, partition: int, name: str, count: int) -> None:
        self.partition, self.name, self.count = partition, name, count


class _Log:
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.starting = options.get("startingoffsets", "earliest")
        self.ending = options.get("endingoffsets")

    def segments(self) -> list[list]:
        """[partition, name, first, count] of every committed segment."""
        return [s for commit in files.entries(f"{self.path}/_commits").values() for s in commit]

    def ends(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for partition, _, first, count in self.segments():
            out[str(partition)] = max(out.get(str(partition), 0), first + count)
        return out

    def start(self) -> dict[str, int]:
        if self.starting == "latest":
            return self.ends()
        return {} if self.starting == "earliest" else json.loads(self.starting)

    def between(self, start: dict, end: dict) -> list[Segment]:
        out = []
        for partition, name, first, count in self.segments():
            low = max(first, start.get(str(partition), 0))
            high = min(first + count, end.get(str(partition), 0))
            if low < high:
                out.append(Segment(name, partition, first, low, high))
        return out

    def read(self, segment: Segment) -> Iterator[pa.RecordBatch]:
        system, inner = files.open_fs(f"{self.path}/{segment.name}")
        with system.open_input_file(inner) as src, pa.ipc.open_file(src) as table:
            at = segment.first
            for i in range(table.num_record_batches):
                batch = table.get_batch(i)
                low = max(0, segment.low - at)
                high = min(batch.num_rows, segment.high - at)
                if low < high:
                    n = high - low
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(low, n), pa.array([segment.partition] * n, pa.int32()),
                         pa.array(range(at + low, at + high), pa.int64())],
                        names=["value", "msg_partition", "msg_offset"])
                at += batch.num_rows


class LogStream(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.log = _Log(options)

    def initialOffset(self) -> dict:
        return self.log.start()

    def latestOffset(self) -> dict:
        return self.log.ends()

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        return self.log.between(start, end)

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition)


class LogReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.log = _Log(options)

    def partitions(self) -> list[Segment]:
        end = json.loads(self.log.ending) if self.log.ending else self.log.ends()
        return self.log.between(self.log.start(), end) or [Segment("", 0, 0, 0, 0)]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition) if partition.name else iter(())


class LogWriter(DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self.log = _Log(options)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        partition = TaskContext.get().partitionId()
        name, count, out = files.new_name(".arrow"), 0, None
        system, inner = files.open_fs(self.log.path)
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                system.create_dir(inner, recursive=True)
                out = system.open_output_stream(f"{inner}/{name}")
                table = pa.ipc.new_file(out, pa.schema([("value", pa.string())]))
            table.write_batch(pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string())], names=["value"]))
            count += batch.num_rows
        if out is not None:
            table.close()
            out.close()
        return Written(partition, name, count)

    def commit(self, messages: list) -> None:
        ends, number = self.log.ends(), len(files.entries(f"{self.log.path}/_commits"))
        found = sorted((m for m in messages if m is not None and m.count), key=lambda m: m.partition)
        files.publish(f"{self.log.path}/_commits", f"{number:020d}.json",
                      [[m.partition, m.name, ends.get(str(m.partition), 0), m.count]
                       for m in found])

    def abort(self, messages: list) -> None:
        files.delete(self.log.path, [m.name for m in messages if m is not None and m.count])


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> LogReader:
        return LogReader({k.lower(): v for k, v in self.options.items()})

    def streamReader(self, schema: StructType) -> LogStream:
        return LogStream({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema: StructType, overwrite: bool) -> LogWriter:
        return LogWriter({k.lower(): v for k, v in self.options.items()})


def append_messages(messages: DataFrame, path: str) -> None:
    """Append the ``value`` lines; each Spark partition is the log partition of its number.

    One append at a time (a log has one writer); repartition by a key first to
    keep a key's messages in order.
    """
    messages.sparkSession.dataSource.register(MessageLog)
    messages.select("value").write.format(FORMAT).mode("append").save(path)


def log_stream(spark: SparkSession, path: str, starting: str | dict = "earliest") -> DataFrame:
    """Messages with their positions; ``starting``: earliest, latest or {partition: offset}."""
    spark.dataSource.register(MessageLog)
    starting = starting if isinstance(starting, str) else json.dumps(starting)
    return spark.readStream.format(FORMAT).option("startingOffsets", starting).load(path)


def read_messages(spark: SparkSession, path: str, starting: dict | None = None,
                  ending: dict | None = None) -> DataFrame:
    """A range of the log once more, as a batch; offsets by partition, ``ending`` exclusive."""
    spark.dataSource.register(MessageLog)
    reader = spark.read.format(FORMAT)
    if starting is not None:
        reader = reader.option("startingOffsets", json.dumps(starting))
    if ending is not None:
        reader = reader.option("endingOffsets", json.dumps(ending))
    return reader.load(path)
