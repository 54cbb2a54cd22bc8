"""The streaming recommender: micro-batches of rating messages -> lists.

Each micro-batch is handled set-wise in ``foreachBatch``: the batch's
events join the static rating history and the similarity matrix through
the same operators as the batch job (``operators.rerank``). Output rows
are written under ``batch_id=<n>`` with overwrite, so a replayed batch
(after a failure) replaces its own rows instead of duplicating them.
The checkpoint folder records progress; both folders belong on shared
storage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.config import MAX_SIM_MOVIES_NUM, MAX_USER_RATINGS_NUM, STREAM_BATCH_INTERVAL
from reelrank.operators import rerank
from reelrank.operators.topk import collect_sorted
from reelrank.session import checkpoint_once, scratch_path
from reelrank.sources import lookup
from reelrank.streaming import commits
from reelrank.streaming.source import good_messages, parse_messages, rejected_messages

EVENT_KEY = ("event_id",)
# Rows of ``recommend_batch`` for messages with positions.
LISTS_SCHEMA = ("event_id struct<partition: int, offset: bigint>, uid long, mid long, "
                "event_ts timestamp, recs array<struct<mid: bigint, score: double>>")


def recommend_batch(batch: DataFrame, history: DataFrame, sim_matrix: DataFrame,
                    num_candidates: int = MAX_SIM_MOVIES_NUM,
                    recent_k: int | None = MAX_USER_RATINGS_NUM,
                    tie_breakers=(), capped: DataFrame | None = None,
                    item_group: DataFrame | None = None,
                    history_buckets: tuple[str, int] | None = None,
                    union_batch: bool = False, history_sliced: bool = False,
                    exclude_seen: bool = True) -> DataFrame:
    """Events (uid, mid, score, timestamp) -> (event_id, uid, mid, event_ts, recs).

    The original job does not store the incoming rating, so by default the
    history is the rating table alone; ``union_batch`` adds the batch's own
    ratings to the history first. ``history_sliced``: ``history`` already
    holds only the batch users' ratings (``rerank.batch_history``).
    ``exclude_seen=False`` keeps rated items among the candidates.

    ``event_id`` is (partition, offset) of the message; sources without
    positions number a batch's messages.
    """
    if "msg_offset" in batch.columns:
        position = F.struct(F.col("msg_partition").alias("partition"),
                            F.col("msg_offset").alias("offset"))
    else:
        position = F.struct(F.lit(0).alias("partition"),
                            F.monotonically_increasing_id().alias("offset"))
    events = batch.withColumn("event_id", position)
    if union_batch:
        ts_type = history.schema["ts"].dataType
        own = events.select("uid", "mid", "score",
                            F.timestamp_seconds("timestamp").cast(ts_type).alias("ts"))
        if history_buckets is not None:
            from reelrank.functions.keys import bucket_of
            own = own.withColumn(history_buckets[0], bucket_of("uid", history_buckets[1]))
        history = history.unionByName(own, allowMissingColumns=True)
    scored = rerank.stream_recommendations(
        events.select("event_id", "uid", "mid"), history, sim_matrix, num_candidates,
        recent_k, tie_breakers=tie_breakers, event_key=EVENT_KEY, capped=capped,
        exclude_seen=exclude_seen, item_group=item_group, history_buckets=history_buckets,
        history_sliced=history_sliced)
    lists = collect_sorted(scored, ["event_id"])
    # Events without any scored candidate still get a row with an empty list.
    out = events.join(lists, "event_id", "left").select(
        "event_id", "uid", "mid", F.timestamp_seconds("timestamp").alias("event_ts"),
        F.coalesce("recs", F.array().cast("array<struct<mid:bigint,score:double>>")).alias("recs"))
    return out


def start(stream: DataFrame, history: DataFrame | Callable[[], DataFrame],
          sim_matrix: DataFrame, output_path: str, checkpoint_path: str,
          rejects_path: str | None = None, trigger: dict | None = None,
          candidate_cap: int | None = 2 * MAX_SIM_MOVIES_NUM,
          item_group: DataFrame | None = None, version: str | None = None,
          reload: Callable[[str | None], tuple[str, DataFrame, DataFrame | None] | None]
          | None = None, committed: bool = False, buckets: int | None = None, **kwargs):
    """Start the query; ``trigger`` defaults to the 2-second micro-batch interval.

    The similarity matrix is static between versions, so its per-item
    top-``candidate_cap`` prefix is computed once per version and
    checkpointed; each micro-batch then joins that bounded prefix (exactly,
    see ``rerank.sim_candidates``). ``candidate_cap=None`` joins full lists.
    ``item_group`` (mid, grp) marks a group-level matrix (e.g. TF-IDF
    profiles). ``reload`` is called before every micro-batch with the
    installed version (``version`` at the start); it returns None if that is
    still the current one, else ``(version, matrix, item_group)``.

    ``history`` as a function is called for every micro-batch, so that each
    sees the ratings stored until then; a DataFrame is a fixed history.

    ``committed`` writes the lists through the commit log of
    ``streaming.commits`` (visible once the micro-batch is committed, once
    only) in place of one folder per batch; read them by ``read_committed``.

    ``buckets`` stores each matrix version and its prefix as bucketed tables
    (``sources.lookup``) in the checkpoint folder: micro-batches then move
    their own rows to the matrix's buckets and the matrix not at all.
    """
    parsed = parse_messages(stream)
    state: dict = {}

    def install(version, matrix, groups) -> None:
        # Only the capped prefix is materialised: it is the one table every
        # micro-batch joins; the item map is a plain read or projection.
        capped = None
        stored = None
        if candidate_cap:
            capped = rerank.capped_matrix(matrix, candidate_cap, groups)
        if buckets:
            spark = matrix.sparkSession
            stored = lookup.store_matrix(matrix, capped, scratch_path(spark, "matrix"), buckets)
            matrix, capped = stored.frames(spark)
        elif candidate_cap:
            capped = checkpoint_once(capped)
        if state.get("stored"):
            state["stored"].forget(matrix.sparkSession)
        state.update(version=version, matrix=matrix, groups=groups, capped=capped, stored=stored)

    install(version, sim_matrix, item_group)

    def handle(batch_df: DataFrame, batch_id: int) -> None:
        if reload is not None:
            newer = reload(state["version"])
            if newer is not None:
                install(*newer)
        batch_df.persist()
        good = good_messages(batch_df)
        # The batch users' ratings are read for recent ratings and twice for
        # the seen filter: slice the history once and keep it for the batch.
        stored = history() if callable(history) else history
        hist = rerank.batch_history(good, stored, kwargs.get("history_buckets"))
        hist.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            capped = state["capped"]
            if buckets and capped is not None:
                capped = lookup.prune(capped, rerank.event_sources(good, state["groups"]))
            recs = recommend_batch(good, hist, state["matrix"], capped=capped,
                                   item_group=state["groups"], history_sliced=True, **kwargs)
            if committed:
                commits.write_batch(recs, output_path, batch_id)
            else:
                recs.write.mode("overwrite").parquet(f"{output_path}/batch_id={batch_id}")
            if rejects_path:
                (rejected_messages(batch_df).write.mode("overwrite")
                 .parquet(f"{rejects_path}/batch_id={batch_id}"))
        finally:
            hist.unpersist()
            batch_df.unpersist()

    writer = (parsed.writeStream.foreachBatch(handle)
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(**(trigger or {"processingTime": STREAM_BATCH_INTERVAL}))
    return writer.start()


def latest_per_user(output: DataFrame) -> DataFrame:
    """Most recent list per user over all batches (a view over the append log)."""
    from pyspark.sql import Window
    w = Window.partitionBy("uid").orderBy(F.desc("batch_id"), F.desc("event_ts"), F.desc("event_id"))
    return output.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")
