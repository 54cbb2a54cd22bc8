"""Readers for the driver's parquet tables and the recommendation bindings.

The test tables are TPC-H-like; the recommendation entities are bound to
them as follows (the same definitions appear in the oracle SQL):

* rating(uid, mid, score, ts, ok, ln): one row per lineitem, the buyer is
  the user, the part is the item, the quantity maps onto 0.5 .. 5.0 stars,
  the order date is the rating time; ``(ok, ln)`` break time ties.
* movie(mid, name, ..., genres, ...): one row per part; ``genres`` is the
  part type followed by the words of the part name, ``|`` separated.
* tag(uid, mid, tag, ts): one row per lineitem, the order priority is the tag.

Only the columns a query needs are selected, so parquet scans are pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.functions.dates import epoch_seconds

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lineitem_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    # Both sides are fact-sized: let the planner choose (sort-merge or AQE
    # broadcast when statistics prove one side small).
    return li.join(orders, li.l_orderkey == orders.o_orderkey)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rating(uid, mid, score, ts, ok, ln) bound to lineitem x orders."""
    return _lineitem_orders(spark, sf_dir).select(
        F.col("o_custkey").alias("uid"),
        F.col("l_partkey").alias("mid"),
        (F.ceil(F.col("l_quantity") / 5).cast("double") / 2.0).alias("score"),
        F.col("o_orderdate").alias("ts"),
        F.col("l_orderkey").alias("ok"),
        F.col("l_linenumber").alias("ln"),
    )


def ratings_with_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings in the reference text layout: uid, mid, score, timestamp (epoch s)."""
    r = ratings(spark, sf_dir)
    return r.select("uid", "mid", "score", epoch_seconds("ts").alias("timestamp"))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """movie(mid, name, genres) bound to part."""
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("mid"),
        F.col("p_name").alias("name"),
        F.concat_ws("|", "p_type", F.regexp_replace("p_name", " ", "|")).alias("genres"),
    )


def movies_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten movie fields, filled from part columns (for the text loader)."""
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("mid"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("descri"),
        F.concat(F.col("p_size").cast("string"), F.lit(" minutes")).alias("timelog"),
        F.col("p_brand").alias("issue"),
        F.lit("").alias("shoot"),
        F.lit("").alias("language"),
        F.concat_ws("|", "p_type", F.regexp_replace("p_name", " ", "|")).alias("genres"),
        F.regexp_replace("p_name", " ", "|").alias("actors"),
        F.col("p_brand").alias("directors"),
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tag(uid, mid, tag, timestamp) bound to lineitem x orders."""
    return _lineitem_orders(spark, sf_dir).select(
        F.col("o_custkey").alias("uid"),
        F.col("l_partkey").alias("mid"),
        F.col("o_orderpriority").alias("tag"),
        epoch_seconds("o_orderdate").alias("timestamp"),
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
