"""Each user's newest ratings as keyed state of a stream.

The K newest ratings of a user live in the state store, so a micro-batch
touches only the users it has messages for, and those that share a state with
them, and never reads the history. State and output of a user are bounded by K.
Users share ``STATE_GROUPS`` states by hash, so that a large micro-batch is folded
in by many users at a time; a group's messages come chunk by chunk.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from reelrank.config import MAX_USER_RATINGS_NUM

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Part of the state: a checkpoint goes on with the number it began with.
STATE_GROUPS = 16_384


def recent_ratings(ratings: DataFrame, k: int = MAX_USER_RATINGS_NUM,
                   tie_breakers: Sequence[str] = (), groups: int = STATE_GROUPS) -> DataFrame:
    """Stream of (uid, version, recent): a user's k newest ratings after each micro-batch.

    ``ratings`` is a stream of (uid, mid, score, timestamp, *tie_breakers) with
    integer tie-breakers. ``recent`` is an array of (mid, score, timestamp),
    newest first: timestamp desc, tie-breakers desc, score desc, mid asc, as in
    ``rerank.user_recent_k``; late messages take the place their time gives
    them. ``version`` counts a user's lists from 1, the last one holds. Rows
    with a null among the columns are left out; a message that is delivered
    twice counts twice.
    """
    ties = list(tie_breakers)
    names = ["timestamp", *ties, "score", "mid"]
    kinds = ["bigint"] * (1 + len(ties)) + ["double", "bigint"]
    rows = ratings.select("uid", *[F.col(c).cast(t).alias(c) for c, t in zip(names, kinds)])
    rows = rows.dropna()
    uid = rows.schema["uid"].dataType.simpleString()
    columns = ["uid", *names]
    state_schema = ", ".join(f"{c} array<{t}>" for c, t in zip(columns, [uid, *kinds]))
    state_schema += f", known array<{uid}>, version array<bigint>"
    newest = [False] * (len(names) - 1) + [True]

    def best(held: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values(names, ascending=newest, kind="stable")
        return held[held.groupby("uid", sort=False).cumcount() < k]

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState
               ) -> Iterator[pd.DataFrame]:
        held, versions, touched = None, {}, {}
        if state.exists:
            *lists, known, version = state.get
            held, versions = pd.DataFrame(dict(zip(columns, lists))), dict(zip(known, version))
        for part in parts:
            touched |= dict.fromkeys(part["uid"].tolist())
            held = best(part[columns] if held is None else
                        pd.concat([held, part[columns]], ignore_index=True))
        versions |= {u: versions.get(u, 0) + 1 for u in touched}
        state.update((*[held[c].tolist() for c in columns], list(versions), list(versions.values())))
        recent = {u: [] for u in touched}
        for u, mid, score, at in zip(*[held[c].tolist() for c in ("uid", "mid", "score", "timestamp")]):
            if u in recent:
                recent[u].append({"mid": mid, "score": score, "timestamp": at})
        yield pd.DataFrame({"uid": list(recent), "version": [versions[u] for u in recent],
                            "recent": list(recent.values())})

    keyed = rows.withColumn("group_", F.pmod(F.xxhash64("uid"), F.lit(groups)))
    return keyed.groupBy("group_").applyInPandasWithState(
        update, f"uid {uid}, version long, "
        "recent array<struct<mid: bigint, score: double, timestamp: bigint>>",
        state_schema, "append", GroupStateTimeout.NoTimeout)


SCHEMA = ("uid long, version long, "
          "recent array<struct<mid: bigint, score: double, timestamp: bigint>>")


def latest_lists(lists: DataFrame) -> DataFrame:
    """(uid, rk, mid, score): the last list of each user, as rows."""
    newest = Window.partitionBy("uid").orderBy(F.desc("version"))
    last = lists.withColumn("n_", F.row_number().over(newest)).where("n_ = 1")
    flat = last.select("uid", F.posexplode("recent").alias("pos", "r"))
    return flat.select("uid", (F.col("pos") + 1).alias("rk"), F.col("r.mid").alias("mid"),
                       F.col("r.score").alias("score"))
