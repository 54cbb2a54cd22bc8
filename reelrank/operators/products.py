"""Exact largest inner products, with item blocks in order of their norms.

For top lists by inner product (ALS scores) the direction alone doesn't bound
a score, but |x| |y| does (Cauchy-Schwarz). Items are ranked by norm and cut
into blocks, small ones first. Every user meets the block of the longest items;
a user whose k-th best score is above |x| times the largest norm of all later
blocks is finished, the others go on to the next block. Blocks are shipped to
the users' tasks one at a time, each of at most ``BLOCK_BYTES``; users' lists
are written after every round, so a lost executor costs a round at most.

Users without any item of a positive bound left stop at once. Nothing is
approximate: ties (scores equal in six places) go to the smaller item id.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.session import materialize_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANK_PLACES = 6
# Items of the first block, and bytes of item vectors in any block.
FIRST_ROWS, BLOCK_BYTES = 1024, 16 << 20
# Bytes of scores that a task holds at a time.
SLAB_BYTES = 32 << 20
_STATE = "id long, x array<double>, norm double, items array<long>, scores array<double>, products long"


def _vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v * v))
    return df.where(F.col(vec_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), x.alias("x"), norm.alias("norm"))


def _round_fn(ids: np.ndarray, vecs: np.ndarray, k: int):
    """Users' lists after a block of items (ids ascending within equal scores)."""
    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack(pdf["x"].to_numpy())
            step = max(1, SLAB_BYTES // (8 * max(1, len(vecs))))
            scores = (row for at in range(0, len(x), step) for row in x[at:at + step] @ vecs.T)
            items, best = [], []
            for row, (old, had) in zip(scores, zip(pdf["items"], pdf["scores"])):
                if len(row) > k:  # those tied with the k-th stay in
                    rounded = np.round(row, RANK_PLACES)
                    at = np.flatnonzero(rounded >= -np.partition(-rounded, k - 1)[k - 1])
                else:
                    at = np.arange(len(row))
                name = np.concatenate([np.asarray(old, np.int64), ids[at]])
                value = np.concatenate([np.asarray(had, float), row[at]])
                order = np.lexsort((name, -np.round(value, RANK_PLACES)))[:k]
                items.append(name[order])
                best.append(value[order])
            yield pdf.assign(items=items, scores=best, products=pdf["products"] + len(ids))
    return run


def largest_products(users: DataFrame, items: DataFrame, k: int, user_id: str = "id",
                     user_vec: str = "features", item_id: str = "id", item_vec: str = "features",
                     first_rows: int = FIRST_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(user, rk, item, score, products): each user's k items of the largest inner products.

    ``products`` is the number of items the user was compared with. Order:
    score rounded to six places desc, item id asc. Rows with a null vector are
    left out; repeated ids count as rows of their own. Empty tables give an
    empty result.
    """
    ranked = _vectors(items, item_id, item_vec)
    order = [F.desc("norm"), F.asc("id")]
    ranked = ranked.repartitionByRange(*order).sortWithinPartitions(*order)
    ranked = materialize_table(ranked.withColumn("place", F.monotonically_increasing_id()), "items")
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = ranked.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("dims")).orderBy("part").collect()
    total, dims = sum(r["n"] for r in sizes), max([r["dims"] for r in sizes] or [1])
    before, at = [], 0  # one row per partition
    for r in sizes:
        before.append((r["part"], at))
        at += r["n"]
    offsets = F.broadcast(users.sparkSession.createDataFrame(before, "part long, start long"))
    ranked = materialize_table(ranked.withColumn("part", part).join(offsets, "part").select(
        "id", "x", "norm", (F.col("start") + within).alias("rank")), "items-ranked")

    state = _vectors(users, user_id, user_vec).select(
        "id", "x", "norm", F.array().cast("array<long>").alias("items"),
        F.array().cast("array<double>").alias("scores"), F.lit(0).cast("long").alias("products"))
    done, low, rows = None, 0, first_rows
    most = max(1, block_bytes // (8 * max(1, dims)))
    while True:
        rows = min(rows, most)
        block = ranked.where((F.col("rank") >= low) & (F.col("rank") < low + rows)).toPandas()
        low, rows = low + rows, 2 * rows
        if len(block):
            block = block.sort_values("id")
            state = materialize_table(state.mapInPandas(_round_fn(
                block["id"].to_numpy(), np.stack(block["x"].to_numpy()), k), _STATE), "users")
        if low >= total:
            rest = state.limit(0)
        else:
            # the largest norm still to come; an unseen item may at best tie with the k-th
            nearest = ranked.where(F.col("rank") == low).first()["norm"]
            kth = F.round(F.element_at("scores", -1), RANK_PLACES)
            go_on = (F.size("scores") < k) | (
                F.col("norm") * nearest >= kth - 2 * 10.0 ** -RANK_PLACES)
            rest, state = state.where(go_on), state.where(~go_on)
        done = state if done is None else done.unionByName(state)
        if low >= total or rest.isEmpty():
            break
        state = rest
    flat = done.select(F.col("id").alias("user"), "products", F.posexplode(
        F.arrays_zip("items", "scores")).alias("pos", "best"))
    return flat.select("user", (F.col("pos") + 1).alias("rk"), F.col("best.items").alias("item"),
                       F.col("best.scores").alias("score"), "products")
