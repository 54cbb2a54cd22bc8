"""A table that streams append to: rows show once their micro-batch is committed, and once only.

Format ``committed_rows``. Tasks write Parquet files under names of their own;
the commit file of a micro-batch lists its files and makes them visible. A
batch that ended between its tasks and its commit left files nobody reads; when
it is run again after a restart it commits its new files. A batch id that has
been committed before is ignored, its files are deleted.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter,
                                    DataSourceStreamArrowWriter, WriterCommitMessage)
from pyspark.sql.types import StructType

from reelrank.streaming import files

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "committed_rows"


class Written(WriterCommitMessage):
    def __init__(self, name: str | None) -> None:
        self.name = name


class _Sink:
    def __init__(self, options: dict) -> None:
        self.path = options["path"]

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        writer, name = None, None
        system, inner = files.open_fs(self.path)
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                name = files.new_name(".parquet")
                system.create_dir(inner, recursive=True)
                writer = pq.ParquetWriter(f"{inner}/{name}", batch.schema, filesystem=system)
            writer.write_batch(batch)
        if writer is not None:
            writer.close()
        return Written(name)

    def publish(self, messages: list, batch_id: int) -> None:
        names = [m.name for m in messages if m is not None and m.name]
        commit = f"{batch_id:020d}.json"
        if commit in files.entries(f"{self.path}/_commits"):
            files.delete(self.path, names)
        else:
            files.publish(f"{self.path}/_commits", commit, names)

    def discard(self, messages: list) -> None:
        files.delete(self.path, [m.name for m in messages if m is not None and m.name])


class StreamSink(_Sink, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self.publish(messages, batchId)

    def abort(self, messages: list, batchId: int) -> None:
        self.discard(messages)


class BatchSink(_Sink, DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        super().__init__(options)
        self.batch_id = int(options["batchid"])

    def commit(self, messages: list) -> None:
        self.publish(messages, self.batch_id)

    def abort(self, messages: list) -> None:
        self.discard(messages)


class CommittedRows(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamSink:
        return StreamSink({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema: StructType, overwrite: bool) -> BatchSink:
        return BatchSink({k.lower(): v for k, v in self.options.items()})


def write_stream(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Start appending ``stream``; the sink's commits follow the query's batch ids."""
    stream.sparkSession.dataSource.register(CommittedRows)
    writer = stream.writeStream.format(FORMAT).option("path", path).option(
        "checkpointLocation", checkpoint).outputMode("append")
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Append a micro-batch from ``foreachBatch``."""
    df.sparkSession.dataSource.register(CommittedRows)
    df.write.format(FORMAT).mode("append").option("batchId", str(batch_id)).save(path)


def read_committed(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The committed rows and their ``batch_id``; none before the first commit."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    commits = files.entries(f"{path}/_commits")
    table = [(name, int(commit[:-5])) for commit, names in commits.items() for name in names]
    if not table:
        return spark.createDataFrame([], schema).withColumn("batch_id", F.lit(None).cast("long"))
    rows = spark.read.schema(schema).parquet(*[f"{path}/{name}" for name, _ in table])
    rows = rows.withColumn("file_", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    # one row per file
    ids = spark.createDataFrame(table, "file_ string, batch_id long")
    return rows.join(F.broadcast(ids), "file_").drop("file_")
