"""JDBC tables: parallel reads and batch writes.

Connection settings (url, user, password, driver) come from the job
configuration, never from code. Reads split on a numeric column into
``num_partitions`` range queries instead of one unpartitioned scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _props(cfg: dict) -> dict:
    keys = ("user", "password", "driver", "fetchsize", "batchsize")
    return {k: str(cfg[k]) for k in keys if k in cfg and cfg[k] is not None}


def read_table(spark: SparkSession, cfg: dict, table: str, partition_column: str | None = None,
               lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None) -> DataFrame:
    """Whole-table read; partitioned by ``partition_column`` when given."""
    reader = spark.read.format("jdbc").option("url", cfg["url"]).option("dbtable", table)
    for k, v in _props(cfg).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partitioned JDBC read needs lower, upper and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower)).option("upperBound", str(upper))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()


def write_table(df: DataFrame, cfg: dict, table: str, mode: str = "errorifexists",
                truncate: bool = True, num_partitions: int | None = None) -> None:
    """Create (default: fail if the table exists) or overwrite/append a table.

    ``overwrite`` truncates instead of dropping, so the table keeps its DDL.
    ``num_partitions`` bounds concurrent connections to the database.
    """
    writer = df.write.format("jdbc").option("url", cfg["url"]).option("dbtable", table)
    for k, v in _props(cfg).items():
        writer = writer.option(k, v)
    if mode == "overwrite" and truncate:
        writer = writer.option("truncate", "true")
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    writer.mode(mode).save()
