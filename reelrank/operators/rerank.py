"""Real-time re-ranking, expressed as set-based joins over a batch of events.

An *event* is one incoming rating (uid, mid). For each event:

1. recent ratings: the user's newest ``recent_k`` ratings (``user_recent_k``);
2. candidates: the ``num_candidates`` items most similar to the event's item
   that the user has not rated (``sim_candidates``);
3. priority of each candidate c over the recent ratings r whose similarity
   sim(c, r) > 0.7:  mean(sim * score) + log10(max(ups, 1)) - log10(max(downs, 1))
   where ups count r.score > 3 and downs the rest (``score_candidates``).

No per-event connections or driver-side maps: the events of a micro-batch
join the ratings table and the long-form similarity matrix.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelrank.config import (MAX_SIM_MOVIES_NUM, MAX_USER_RATINGS_NUM, RERANK_SIM_THRESHOLD,
                             RERANK_UP_SCORE)
from reelrank.functions.keys import bucket_of
from reelrank.operators.topk import top_k_per_group
from reelrank.session import checkpoint_once

# Similarities are compared after rounding to this many places when ranking
# candidates, so last-bit noise cannot reorder equal similarities.
RANK_PLACES = 6


def user_recent_k(ratings: DataFrame, k: int | None = MAX_USER_RATINGS_NUM,
                  tie_breakers: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """(uid, rk, mid, score): each user's ratings, newest first, at most ``k``.

    Order: ts desc, then ``tie_breakers`` desc, then score desc, mid asc.
    ``k=None`` keeps every rating (the literal behaviour of the original,
    which passed a limit but did not apply it). ``keep`` names extra columns
    to carry through.
    """
    order = [F.desc("ts")] + [F.desc(c) for c in tie_breakers] + [F.desc("score"), F.asc("mid")]
    ranked = top_k_per_group(ratings, ["uid"], order, k)
    return ranked.select("uid", "rk", "mid", "score", *keep)


def latest_events(ratings: DataFrame, tie_breakers: Sequence[str] = (),
                  keep: Sequence[str] = ()) -> DataFrame:
    """Each user's newest rating as an event (uid, mid, score, *keep)."""
    return user_recent_k(ratings, 1, tie_breakers, keep).select("uid", "mid", "score", *keep)


def _candidate_order():
    return [F.desc(F.round("sim", RANK_PLACES)), F.asc("sim_mid")]


def _lists(sim_matrix: DataFrame, item_group: DataFrame | None) -> DataFrame:
    """(src, sim_mid, sim): the similar items of each source key.

    Without ``item_group`` the matrix is item-level and src is an item id.
    With it, the matrix holds group pairs (same column names, group ids)
    and ``item_group`` (mid, grp) maps items to groups: every item of a
    similar group is a similar item (the item itself is removed later).
    """
    if item_group is None:
        return sim_matrix.select(F.col("mid").alias("src"), "sim_mid", "sim")
    members = item_group.select(F.col("grp").alias("gb"), F.col("mid").alias("sim_mid"))
    return (sim_matrix.select(F.col("mid").alias("src"), F.col("sim_mid").alias("gb"), "sim")
            .join(members, "gb").select("src", "sim_mid", "sim"))


def _prefix(sim_matrix: DataFrame, item_group: DataFrame | None, cap: int) -> DataFrame:
    """The first ``cap`` rows of each source key's list.

    Items of a group are equally similar and go by id, so only each group's
    ``cap`` smallest ids can be among them: copies beyond are never listed.
    """
    if item_group is not None:
        item_group = top_k_per_group(item_group, ["grp"], [F.asc("mid")], cap).drop("rk")
    lists = _lists(sim_matrix, item_group)
    return top_k_per_group(lists, ["src"], _candidate_order(), cap).drop("rk")


def capped_matrix(sim_matrix: DataFrame, cap: int = 2 * MAX_SIM_MOVIES_NUM,
                  item_group: DataFrame | None = None) -> DataFrame:
    """Each source key's ``cap`` most similar items plus its full list length.

    (src, sim_mid, sim, n_sims, cap). Static per matrix version: compute it
    once (and persist or checkpoint it) rather than per micro-batch. With a
    grouped matrix this is one short list per group, not per item.
    """
    lists = _lists(sim_matrix, item_group)
    top = _prefix(sim_matrix, item_group, cap)
    if item_group is None:
        sizes = lists.groupBy("src").agg(F.count(F.lit(1)).alias("n_sims"))
    else:
        # A list's length is the sum of its partner groups' sizes: no second expansion.
        members = item_group.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
        sizes = (sim_matrix.select(F.col("mid").alias("src"), F.col("sim_mid").alias("grp"))
                 .join(members, "grp").groupBy("src").agg(F.sum("n").alias("n_sims")))
    return top.join(sizes, "src").withColumn("cap", F.lit(cap))


def seen_bitmaps(seen: DataFrame) -> DataFrame:
    """(uid, bucket, bits): rated items as bitmaps of 64 item ids each.

    For users with long histories: a lookup reads one bit of one row, where
    an anti join would meet all of the user's ratings. Repeated ratings set
    their bit once; a hot user's ratings are combined in each map task. A
    bitmap is one long, so that it never takes more than its ratings do,
    however far apart the items' ids are.
    """
    mid = F.col("mid").cast("long")
    return seen.where("uid is not null and mid is not null").groupBy(
        "uid", _bitmap(mid).alias("bucket")).agg(F.bit_or(_bit(mid)).alias("bits"))


def _bitmap(mid: Column) -> Column:
    return F.shiftright(mid, 6)


def _bit(mid: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), mid.bitwiseAND(F.lit(63)).cast("int"))


def is_set(bits: Column, mid: Column) -> Column:
    """Whether an item's bitmap has its bit; false for a null bitmap."""
    return F.coalesce(bits.bitwiseAND(_bit(mid)) != 0, F.lit(False))


def drop_seen(cand: DataFrame, bitmaps: DataFrame, item_col: str = "sim_mid") -> DataFrame:
    """Rows of ``cand`` (uid, item, ...) whose bit isn't set in ``seen_bitmaps``."""
    item = F.col(item_col).cast("long")
    rows = cand.withColumn("bucket", _bitmap(item))
    rows = rows.join(bitmaps, ["uid", "bucket"], "left")
    unseen = ~is_set(F.col("bits"), item)
    return rows.where(unseen).select(*cand.columns)


def _unseen_top(ev: DataFrame, lists: DataFrame, seen: DataFrame | None, num: int,
                event_key: Sequence[str]) -> DataFrame:
    cand = ev.join(lists, "src").filter(F.col("sim_mid") != F.col("event_mid"))
    if seen is not None and "bits" in seen.columns:
        cand = drop_seen(cand, seen)
    elif seen is not None:
        rated = seen.select("uid", F.col("mid").alias("sim_mid"))
        cand = cand.join(rated, ["uid", "sim_mid"], "left_anti")
    return top_k_per_group(cand, list(event_key), _candidate_order(), num)


def _event_sources(events: DataFrame, keys: list[str], item_group: DataFrame | None) -> DataFrame:
    ev = events.select(*keys, F.col("mid").alias("event_mid"))
    if item_group is None:
        return ev.withColumn("src", F.col("event_mid"))
    groups = item_group.select(F.col("mid").alias("event_mid"), F.col("grp").alias("src"))
    return ev.join(groups, "event_mid")


def event_sources(events: DataFrame, item_group: DataFrame | None) -> DataFrame:
    """(src): the matrix keys that the items of ``events`` look up."""
    return _event_sources(events, ["uid"], item_group).select("src")


def sim_candidates(events: DataFrame, sim_matrix: DataFrame, seen: DataFrame | None,
                   num: int = MAX_SIM_MOVIES_NUM, event_key: Sequence[str] = ("uid",),
                   capped: DataFrame | None = None,
                   item_group: DataFrame | None = None) -> DataFrame:
    """Per event: the ``num`` most similar items the user has not rated.

    events: event_key columns + uid, mid. sim_matrix: (mid, sim_mid, sim),
    item-level, or group-level together with ``item_group`` (mid, grp).
    seen: (uid, mid) pairs already rated or their ``seen_bitmaps``, or None to
    keep rated items.
    Returns event_key + (rk, sim_mid, sim). Items missing from the matrix
    give no candidates.

    With ``capped`` (from :func:`capped_matrix`, same ``item_group``) each
    event first joins only the top-``cap`` prefix of its list, so the join
    fan-out per event is bounded. Exactness: if the prefix holds ``num``
    unseen items they are the answer; if the list is no longer than the
    prefix, the prefix is the list; only the remaining events (heavy
    raters) read on. In an item-level matrix that is their full list; in a
    grouped one, where the full lists would be expanded, a prefix longer than
    what the user has rated (:func:`_longer_lists`).
    """
    keys = list(dict.fromkeys([*event_key, "uid"]))
    ev = _event_sources(events, keys, item_group)
    full = _lists(sim_matrix, item_group)
    cols = [*keys, "rk", "sim_mid", "sim"]
    if capped is None:
        return _unseen_top(ev, full, seen, num, event_key).select(*cols)
    prefix = capped.select("src", "sim_mid", "sim")
    lengths = capped.select("src", "n_sims", "cap").dropDuplicates(["src"])
    # Events carry their list length; the per-event count of unseen prefix
    # items is a window on the top-k's own partitioning (no extra shuffle).
    x = ev.join(lengths, "src", "left")
    first = _unseen_top(x, prefix, seen, num, event_key)
    first = first.withColumn("found", F.max("rk").over(Window.partitionBy(*event_key)))
    settled = (F.col("n_sims").isNull() | (F.col("n_sims") <= F.col("cap"))
               | (F.col("found") >= num))
    first_done = first.filter(settled)
    enough = first.filter(F.col("found") >= num).select(*event_key).distinct()
    if item_group is not None:
        first = checkpoint_once(first)
        first_done = first.filter(settled)
        enough = first.filter(F.col("found") >= num).select(*event_key).distinct()
    pending = x.filter(F.col("n_sims") > F.col("cap")).join(enough, list(event_key), "left_anti")
    out = first_done.select(*cols)
    if item_group is None:
        return out.unionByName(_unseen_top(pending, full, seen, num, event_key).select(*cols))
    for second in _longer_lists(pending, sim_matrix, item_group, seen, num, event_key):
        out = out.unionByName(second.select(*cols))
    return out


def _longer_lists(pending: DataFrame, sim_matrix: DataFrame, item_group: DataFrame,
                  seen: DataFrame | None, num: int, event_key: Sequence[str]
                  ) -> Iterator[DataFrame]:
    """Top ``num`` of the pending events, from prefixes as long as each of them needs.

    The first num + (rated items + 1) * c rows of a list hold ``num`` unseen
    ones, c being the most rows an item has. Events are taken together when
    that number lies below the same power of two (at most 62 rounds, none
    without pending events), so that what is joined is bounded by what the
    users have rated.
    """
    per_item = item_group.groupBy("mid").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("c"))
    if seen is None:
        need = pending.withColumn("rated", F.lit(0).cast("long"))
    else:
        users = pending.select("uid").distinct()
        size = F.sum(F.bit_count("bits")) if "bits" in seen.columns else F.count("mid")
        rated = seen.join(users, "uid", "left_semi").groupBy("uid").agg(size.alias("rated"))
        need = pending.join(rated, "uid", "left")
    rows = F.lit(num) + (F.coalesce("rated", F.lit(0)) + 1) * F.coalesce("c", F.lit(1))
    need = checkpoint_once(need.join(F.broadcast(per_item)).withColumn(  # one row
        "bits_", F.ceil(F.log2(rows)).cast("int")).drop("c", "rated"))
    for (bits,) in need.select("bits_").distinct().orderBy("bits_").collect():
        some = need.filter(F.col("bits_") == bits).drop("bits_")
        wanted = some.select(F.col("src").alias("mid")).distinct()
        prefix = _prefix(sim_matrix.join(wanted, "mid", "left_semi"), item_group, 1 << bits)
        yield _unseen_top(some, prefix, seen, num, event_key)


def score_candidates(candidates: DataFrame, recent: DataFrame, sim_matrix: DataFrame,
                     threshold: float = RERANK_SIM_THRESHOLD, up_score: float = RERANK_UP_SCORE,
                     event_key: Sequence[str] = ("uid",),
                     item_group: DataFrame | None = None, unseen: bool = False) -> DataFrame:
    """Priority per (event, candidate): event_key + (mid, score).

    Candidates with no recent rating above the similarity threshold get no
    row (nothing to average). Each event joins at most num x recent_k pairs;
    with a grouped matrix as many as the pairs of their groups, since the
    candidates of a group meet the same recent ratings. ``unseen`` says that
    no candidate is among its user's recent ratings.
    """
    keys = list(dict.fromkeys([*event_key, "uid"]))
    c = candidates.select(*keys, F.col("sim_mid").alias("cand"))
    r = recent.select("uid", F.col("mid").alias("rmid"), F.col("score").alias("rscore"))
    s = sim_matrix.filter(F.col("sim") > threshold)
    up, down = F.col("rscore") > up_score, F.col("rscore") <= up_score
    if item_group is None:
        s = s.select(F.col("mid").alias("cand"), F.col("sim_mid").alias("rmid"), "sim")
        pairs = c.join(r, "uid").filter(F.col("cand") != F.col("rmid"))
        agg = pairs.join(s, ["cand", "rmid"]).groupBy(*keys, "cand").agg(
            F.avg(F.col("sim") * F.col("rscore")).alias("base"),
            F.count_if(up).alias("ups"), F.count_if(down).alias("downs"))
    else:
        s = s.select(F.col("mid").alias("gc"), F.col("sim_mid").alias("gr"), "sim")
        c = c.join(item_group.select(F.col("mid").alias("cand"), F.col("grp").alias("gc")), "cand")
        r = r.join(item_group.select(F.col("mid").alias("rmid"), F.col("grp").alias("gr")), "rmid")
        r = r.groupBy("uid", "gr", "rmid").agg(
            F.sum("rscore").alias("s"), F.count("rscore").alias("n"), F.count(F.lit(1)).alias("rows"),
            F.count_if(up).alias("ups"), F.count_if(down).alias("downs"))
        counts = ["n", "rows", "ups", "downs"]
        by_group = r.groupBy("uid", "gr").agg(F.sum("s").alias("s"),
                                              *[F.sum(x).alias(x) for x in counts])

        def weighted(rows: DataFrame, by: list[str]) -> DataFrame:
            return rows.join(s, ["gc", "gr"]).groupBy(*by).agg(
                F.sum(F.col("sim") * F.col("s")).alias("total"),
                *[F.sum(x).alias(x) for x in counts])

        of_group = weighted(c.select(*keys, "gc").distinct().join(by_group, "uid"), [*keys, "gc"])
        rows = c.join(of_group, [*keys, "gc"])
        if not unseen:  # an item is no evidence for itself
            own = c.select("uid", "cand", "gc").distinct().join(
                r.withColumnRenamed("rmid", "cand"), ["uid", "cand"])
            own = weighted(own, ["uid", "cand", "gc"]).select("uid", "cand", "gc", *[
                F.col(x).alias(f"{x}_") for x in ("total", *counts)])
            rows = rows.join(own, ["uid", "cand", "gc"], "left").select(*keys, "cand", *[
                (F.col(x) - F.coalesce(f"{x}_", F.lit(0))).alias(x) for x in ("total", *counts)])
        agg = rows.groupBy(*keys, "cand").agg(F.sum("total").alias("total"),
                                              *[F.sum(x).alias(x) for x in counts])
        agg = agg.where("rows > 0").withColumn("base", F.try_divide("total", "n"))
    priority = (F.col("base") + F.log10(F.greatest(F.col("ups"), F.lit(1)))
                - F.log10(F.greatest(F.col("downs"), F.lit(1))))
    return agg.select(*keys, F.col("cand").alias("mid"), priority.alias("score"))


def batch_history(events: DataFrame, ratings: DataFrame,
                  history_buckets: tuple[str, int] | None = None) -> DataFrame:
    """The ratings of the users that appear in ``events`` (a semi-join).

    ``history_buckets=(column, n)`` says the rating history is partitioned
    by ``column = bucket_of(uid, n)``: the batch's bucket ids (at most n
    small ints) become a partition filter, so only those partitions of the
    history are read for the batch.
    """
    users = events.select("uid").distinct()
    if history_buckets is not None:
        column, n = history_buckets
        ids = [r[0] for r in users.select(bucket_of("uid", n).alias("b")).distinct().collect()]
        ratings = ratings.filter(F.col(column).isin(ids))
    return ratings.join(users, "uid", "left_semi")


def stream_recommendations(events: DataFrame, ratings: DataFrame, sim_matrix: DataFrame,
                           num_candidates: int = MAX_SIM_MOVIES_NUM,
                           recent_k: int | None = MAX_USER_RATINGS_NUM,
                           exclude_seen: bool = True, tie_breakers: Sequence[str] = (),
                           event_key: Sequence[str] = ("uid",),
                           capped: DataFrame | None = None,
                           item_group: DataFrame | None = None,
                           history_buckets: tuple[str, int] | None = None,
                           history_sliced: bool = False) -> DataFrame:
    """Full re-rank for a batch of events: event_key + (mid, score).

    ``capped`` (see :func:`capped_matrix`) bounds the candidate join; the
    result is the same with or without it. ``item_group`` marks a grouped
    matrix (see :func:`sim_candidates`). ``history_buckets``: see
    :func:`batch_history`. ``history_sliced`` says ``ratings`` is already
    :func:`batch_history` of these events (e.g. persisted per micro-batch).
    """
    # Only users that appear in the batch matter: semi-join first so the
    # window and anti-join touch just their ratings.
    hist = ratings if history_sliced else batch_history(events, ratings, history_buckets)
    recent = user_recent_k(hist, recent_k, tie_breakers)
    seen = hist.select("uid", "mid") if exclude_seen else None
    cands = sim_candidates(events, sim_matrix, seen, num_candidates, event_key, capped,
                           item_group)
    return score_candidates(cands, recent, sim_matrix, event_key=event_key,
                            item_group=item_group, unseen=exclude_seen)
