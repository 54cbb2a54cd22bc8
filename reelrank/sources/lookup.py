"""Bucketed storage of a similarity matrix for lookups by micro-batches.

A matrix version is stored once as two bucketed parquet tables:

* pairs (mid, sim_mid, sim), bucketed and sorted by (mid, sim_mid): the join
  of (candidate, recent) pairs with it moves the pairs only. With both keys
  in the bucket function an item that a third of all events name is spread
  over the buckets by its partners.
* the capped lists of ``rerank.capped_matrix``, bucketed and sorted by src:
  the join of events with it moves the events only, and ``prune`` reads
  nothing but the buckets of a small batch's items.

Bucketing is known to the catalog alone, so the tables are external ones with
a given folder; ``open_matrix`` declares stored folders again in another session.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PAIR_KEYS, LIST_KEYS = ("mid", "sim_mid"), ("src",)
#: Batches of more distinct items read all buckets: they would meet most of them anyway.
MAX_PRUNED_KEYS = 1000


@dataclass(frozen=True)
class Matrix:
    """Catalog names of a stored matrix version."""

    pairs: str
    lists: str | None

    def frames(self, spark: SparkSession) -> tuple[DataFrame, DataFrame | None]:
        return spark.table(self.pairs), spark.table(self.lists) if self.lists else None

    def forget(self, spark: SparkSession) -> None:
        """Drop the names; the folders stay for whoever reads them still."""
        for name in (self.pairs, self.lists):
            if name:
                spark.sql(f"drop table if exists {name}")


def _name() -> str:
    return f"matrix_{uuid.uuid4().hex}"


def _write(df: DataFrame, path: str, keys: tuple[str, ...], buckets: int) -> str:
    name = _name()
    # one task per bucket, hence one file per bucket
    placed = df.repartition(buckets, *keys)
    placed.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format(
        "parquet").saveAsTable(name)
    return name


def store_matrix(pairs: DataFrame, lists: DataFrame | None, path: str, buckets: int) -> Matrix:
    """Store one version under ``path``; ``lists``: its ``capped_matrix``, if any.

    ``buckets`` is fixed by the size of the matrix (128-256 MB a bucket), not
    by the cluster: joins with it run in as many tasks.
    """
    return Matrix(_write(pairs.select(*PAIR_KEYS, "sim"), f"{path}/pairs", PAIR_KEYS, buckets),
                  lists and _write(lists, f"{path}/lists", LIST_KEYS, buckets))


def open_matrix(spark: SparkSession, path: str, buckets: int, pairs_schema: StructType,
                lists_schema: StructType | None = None) -> Matrix:
    """Declare the folders that ``store_matrix`` wrote with as many buckets."""
    def declare(folder: str, schema: StructType, keys: tuple[str, ...]) -> str:
        name, cols = _name(), ", ".join(keys)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"create table {name} ({fields}) using parquet clustered by ({cols}) "
                  f"sorted by ({cols}) into {buckets} buckets location '{path}/{folder}'")
        return name

    return Matrix(declare("pairs", pairs_schema, PAIR_KEYS),
                  lists_schema and declare("lists", lists_schema, LIST_KEYS))


def prune(lists: DataFrame, keys: DataFrame, most: int = MAX_PRUNED_KEYS) -> DataFrame:
    """``lists`` (src, ...) with a literal filter on the few keys of ``keys`` (src).

    Bucket pruning needs literals. More than ``most`` distinct keys leave the
    filter out; the join that follows gives the same rows either way.
    """
    few = [r[0] for r in keys.select("src").where("src is not null").distinct()
           .limit(most + 1).collect()]
    return lists if len(few) > most else lists.where(F.col("src").isin(few))
