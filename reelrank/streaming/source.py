"""Rating message streams: ``uid|mid|score|timestamp`` text.

Kafka is the production source (by format name; the connector jar is
optional). A folder of text files behind the same parser serves tests and
replays. Malformed messages do not fail the batch: they are split off.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.config import MESSAGE_FIELD_SEP

MESSAGE_COLUMNS = ["uid", "mid", "score", "timestamp"]
# Where a message stands in its stream, for sources that say so (Kafka).
POSITION_COLUMNS = ["msg_partition", "msg_offset"]
# Upper bounds of a micro-batch: a backlog is worked off in several.
MAX_OFFSETS_PER_TRIGGER, MAX_FILES_PER_TRIGGER = 100_000, 100
_TYPES = ["bigint", "bigint", "double", "bigint"]


def parse_messages(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Add uid, mid, score, timestamp and ``_ok`` (exactly 4 numeric fields)."""
    parts = F.split(F.col(value_col).cast("string"), "\\" + MESSAGE_FIELD_SEP, -1)
    cols, ok = [], F.size(parts) == len(MESSAGE_COLUMNS)
    for i, (name, typ) in enumerate(zip(MESSAGE_COLUMNS, _TYPES)):
        val = F.trim(F.try_element_at(parts, F.lit(i + 1))).try_cast(typ)
        ok = ok & val.isNotNull()
        cols.append(val.alias(name))
    return df.select(F.col(value_col).cast("string").alias("value"), *cols,
                     *[c for c in POSITION_COLUMNS if c in df.columns],
                     F.coalesce(ok, F.lit(False)).alias("_ok"))


def good_messages(parsed: DataFrame) -> DataFrame:
    return parsed.filter("_ok").select(
        *MESSAGE_COLUMNS, *[c for c in POSITION_COLUMNS if c in parsed.columns])


def rejected_messages(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("_ok")).select("value")


def kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str,
                 starting_offsets: str = "latest", options: dict | None = None,
                 max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER) -> DataFrame:
    """Messages and their positions from Kafka (needs the spark-sql-kafka package at runtime)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic).option("startingOffsets", starting_offsets)
              .option("maxOffsetsPerTrigger", str(max_offsets_per_trigger)))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("value").cast("string").alias("value"),
                                F.col("partition").alias("msg_partition"),
                                F.col("offset").alias("msg_offset"))


def text_stream(spark: SparkSession, path: str,
                max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Message lines from files landing in ``path`` (one message per line)."""
    reader = spark.readStream.format("text").option("maxFilesPerTrigger",
                                                    str(max_files_per_trigger))
    return reader.load(path)


def to_messages(ratings: DataFrame) -> DataFrame:
    """(uid, mid, score, timestamp) -> ``value`` message lines."""
    return ratings.select(F.concat_ws(MESSAGE_FIELD_SEP, *[F.col(c).cast("string")
                                                          for c in MESSAGE_COLUMNS]).alias("value"))
