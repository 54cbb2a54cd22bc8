import datetime as dt
import os
import tempfile

import pytest

from reelrank.operators import als, rerank
from reelrank.streaming import job, source


@pytest.fixture(scope="module")
def small_ratings(spark):
    data = [(u, m, float(1 + (u * m) % 5), dt.datetime(2020, 1, 1 + (u + m) % 28))
            for u in range(1, 21) for m in range(1, 16) if (u + m) % 3]
    return spark.createDataFrame(data, "uid long, mid long, score double, ts timestamp_ntz")


def test_als_recs_and_item_sim(small_ratings):
    model = als.fit_als(small_ratings, rank=4, max_iter=5, seed=1)
    recs = als.user_recommendations(model, 5).collect()
    per_user = {}
    for r in recs:
        per_user.setdefault(r.uid, []).append(r)
    assert all(len(v) <= 5 for v in per_user.values())
    assert all(r.score > 0 for r in recs)
    for v in per_user.values():
        scores = [r.score for r in sorted(v, key=lambda r: r.rk)]
        assert scores == sorted(scores, reverse=True)
    sims = {(r.mid, r.sim_mid): r.sim for r in als.item_similarity(model, 0.6).collect()}
    assert all(a != b and s > 0.6 and sims[(b, a)] == pytest.approx(s) for (a, b), s in sims.items())
    # seeded: a second fit gives the same item factors
    again = als.fit_als(small_ratings, rank=4, max_iter=5, seed=1)
    f1 = sorted((r.id, tuple(r.features)) for r in model.itemFactors.collect())
    f2 = sorted((r.id, tuple(r.features)) for r in again.itemFactors.collect())
    assert f1 == f2


def test_rmse_repeated_pairs_multiply(spark):
    obs = spark.createDataFrame([(1, 1, 4.0), (1, 1, 2.0), (2, 1, 3.0)], "uid long, mid long, score double")
    pred = spark.createDataFrame([(1, 1, 3.0), (1, 1, 3.0), (2, 1, 3.0)],
                                 "uid long, mid long, prediction double")
    r = als.rmse(obs, pred).first()
    assert r.n == 5
    assert r.rmse == pytest.approx(((4 * 1 + 0) / 5) ** 0.5)


def test_grid_and_cold_start(spark, small_ratings):
    train = small_ratings.filter("uid <= 18")
    test = small_ratings   # users 19, 20 are unknown to the model: dropped
    grid = als.als_grid(train, test, ranks=[2, 3], reg_params=[0.1], max_iter=3, seed=3)
    got = grid.collect()
    assert len(got) == 2 and all(g.rmse is not None and g.rmse > 0 for g in got)
    best = als.best_params(grid).first()
    assert best.rmse == min(g.rmse for g in got)
    model = als.fit_als(train, rank=2, max_iter=3, seed=3)
    assert als.model_rmse(model, test).first().n == train.filter("true").count()


def test_streaming_job_matches_batch_and_replay_is_idempotent(spark, small_ratings):
    sims = spark.createDataFrame(
        [(a, b, 0.6 + ((a * 7 + b * 7) % 40) / 100.0) for a in range(1, 16) for b in range(1, 16) if a != b],
        "mid long, sim_mid long, sim double")
    events = spark.createDataFrame([(3, 4, 5.0, 100), (5, 1, 2.0, 101), (3, 1, 4.0, 102)],
                                   "uid long, mid long, score double, timestamp long")
    base = tempfile.mkdtemp(prefix="reelrank-stream-")
    src = os.path.join(base, "in")
    source.to_messages(events).write.text(src)
    with open(os.path.join(src, "junk.txt"), "w") as fh:
        fh.write("bad|message\n")
    out = os.path.join(base, "out")
    for attempt in range(2):   # second run = the same batch replayed from scratch
        q = job.start(source.text_stream(spark, src), small_ratings, sims, out,
                      os.path.join(base, f"ckpt{attempt}"), rejects_path=os.path.join(base, "rej"),
                      trigger={"availableNow": True})
        q.awaitTermination()
    res = spark.read.parquet(out)
    assert res.count() == 3
    ev = events.selectExpr("uid", "mid", "uid * 1000 + timestamp as event_id")
    batch = rerank.stream_recommendations(ev, small_ratings, sims, event_key=("event_id",))
    want = sorted((r.uid, r.mid, round(r.score, 9)) for r in batch.collect())
    from pyspark.sql import functions as F
    flat = res.select("uid", F.explode("recs").alias("r")).select("uid", "r.mid", "r.score")
    got = sorted((r.uid, r.mid, round(r.score, 9)) for r in flat.collect())
    assert got == want
    assert spark.read.parquet(os.path.join(base, "rej")).count() == 1
    latest = job.latest_per_user(res).collect()
    assert sorted(r.uid for r in latest) == [3, 5]


def test_streaming_job_reloads_a_new_matrix_version(spark):
    base = tempfile.mkdtemp(prefix="reelrank-reload-")
    src = os.path.join(base, "in")
    os.makedirs(src)
    for i in range(2):          # the same event twice, one file per micro-batch
        with open(os.path.join(src, f"m{i}.txt"), "w") as fh:
            fh.write("30|4|4.0|100\n")
    history = spark.createDataFrame(
        [(30, 4, 4.0, dt.datetime(2020, 1, 1)), (30, 6, 5.0, dt.datetime(2020, 1, 2))],
        "uid long, mid long, score double, ts timestamp_ntz")

    def sym(pairs):
        return spark.createDataFrame([p for a, b, v in pairs for p in ((a, b, v), (b, a, v))],
                                     "mid long, sim_mid long, sim double")
    v1 = sym([(4, 1, 0.9), (1, 6, 0.8)])
    v2 = sym([(4, 2, 0.9), (2, 6, 0.8)])
    calls = []

    def reload(installed):
        calls.append(installed)
        return None if len(calls) == 1 else ("v2", v2, None)

    out = os.path.join(base, "out")
    q = job.start(source.text_stream(spark, src, max_files_per_trigger=1), history, v1, out,
                  os.path.join(base, "ckpt"), trigger={"availableNow": True}, version="v1",
                  reload=reload)
    q.awaitTermination()
    from pyspark.sql import functions as F
    res = spark.read.parquet(out).select("batch_id", F.explode("recs").alias("r"))
    got = sorted((r.batch_id, r.r.mid) for r in res.collect())
    assert calls == ["v1", "v1"]
    assert got == [(0, 1), (1, 2)]


@pytest.mark.parametrize("extra", [0, 2, 20])
def test_user_recs_exclude_rated_matches_brute_force(spark, small_ratings, extra):
    import numpy as np
    model = als.fit_als(small_ratings, rank=3, max_iter=4, seed=5)
    got = {}
    for r in als.user_recommendations(model, 4, rated=small_ratings.select("uid", "mid"),
                                      extra=extra).collect():
        got.setdefault(r.uid, []).append((r.rk, r.mid))
    users = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    items = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    seen = {(r.uid, r.mid) for r in small_ratings.collect()}
    for u, uf in users.items():
        scores = sorted(((-float(np.float32(uf @ f)), m) for m, f in items.items()
                         if (u, m) not in seen and float(uf @ f) > 0))
        want = [m for _, m in scores[:4]]
        assert [m for _, m in sorted(got.get(u, []))] == want


def test_union_batch_adds_the_event_to_history(spark):
    history = spark.createDataFrame([(30, 6, 5.0, dt.datetime(2020, 1, 2))],
                                    "uid long, mid long, score double, ts timestamp_ntz")
    sims = spark.createDataFrame([(4, 1, 0.9), (1, 4, 0.9), (1, 6, 0.8), (6, 1, 0.8)],
                                 "mid long, sim_mid long, sim double")
    batch = spark.createDataFrame([(30, 4, 2.0, 1600000000)],
                                  "uid long, mid long, score double, timestamp long")
    plain = job.recommend_batch(batch, history, sims).first().recs
    both = job.recommend_batch(batch, history, sims, union_batch=True).first().recs
    # candidate 1 scores from recent item 6 only, or from 6 and the event's item 4
    assert [r.mid for r in plain] == [1] and [r.mid for r in both] == [1]
    assert plain[0].score == pytest.approx(0.8 * 5.0)
    assert both[0].score == pytest.approx((0.8 * 5.0 + 0.9 * 2.0) / 2)


def test_event_ids_carry_the_message_position(spark):
    batch = spark.createDataFrame([(30, 4, 2.0, 1600000000, 3, 77)],
                                  "uid long, mid long, score double, timestamp long, "
                                  "msg_partition int, msg_offset long")
    sims = spark.createDataFrame([(4, 1, 0.9)], "mid long, sim_mid long, sim double")
    history = spark.createDataFrame([], "uid long, mid long, score double, ts timestamp_ntz")
    row = job.recommend_batch(batch, history, sims).first()
    assert (row.event_id.partition, row.event_id.offset) == (3, 77)


def test_checks_of_a_fit_notice_wrong_rows(spark, small_ratings):
    from pyspark.sql import functions as F

    ratings = small_ratings.select("uid", "mid", "score")
    model = als.fit_als(ratings, rank=4, max_iter=5, reg_param=0.05, seed=1)
    recs = als.user_recommendations(model, 5)
    good = als.check_user_recs(model, ratings, recs, reg=0.05).collect()
    assert len(good) == 20 and all(all(r[i] for i in range(3, 8)) for r in good)
    off = als.check_user_recs(model, ratings, recs.withColumn(
        "score", F.when(F.col("rk") == 2, F.col("score") + 9).otherwise(F.col("score"))), reg=0.05)
    assert not any(r.sorted or r.is_factor_product for r in off.collect())
    assert not any(r.solves_ridge for r in als.check_user_recs(model, ratings, recs,
                                                               reg=0.5).collect())
    sims = als.item_similarity(model)
    assert all(all(r[1:]) for r in als.check_item_similarity(model, sims).collect())
    half = sims.filter("mid < sim_mid")
    assert not all(r.mirrored for r in als.check_item_similarity(model, half).collect())


_FIT = """
import json, sys
sys.path.insert(0, {root!r})
from reelrank.operators import als
from reelrank.session import get_session
spark = get_session("local[{cores}]", {cores})
rows = [(u, m, float(1 + (u * m) % 5)) for u in range(1, 31) for m in range(1, 26) if (u + m) % 3]
model = als.fit_als(spark.createDataFrame(rows, "uid long, mid long, score double"),
                    rank=5, max_iter=4, seed=1)
recs = als.user_recommendations(model, 6).orderBy("uid", "rk").collect()
print("LISTS", json.dumps([(r.uid, r.rk, r.mid, round(r.score, 4)) for r in recs]))
"""


def test_the_model_does_not_depend_on_the_number_of_cores():
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    lists = []
    for cores in (2, 5):
        out = subprocess.run([sys.executable, "-c", _FIT.format(root=root, cores=cores)],
                             capture_output=True, text=True, timeout=300)
        assert out.returncode == 0, out.stderr[-2000:]
        lists.append(next(x for x in out.stdout.splitlines() if x.startswith("LISTS")))
    assert lists[0] == lists[1]


def test_blocks_of_a_fit_grow_with_the_ratings(small_ratings, monkeypatch):
    made, make = [], als.make_als

    def seen(*args, num_blocks, **more):
        made.append(num_blocks)
        return make(*args, num_blocks=num_blocks, **more)
    monkeypatch.setattr(als, "make_als", seen)
    n = small_ratings.count()
    als.fit_als(small_ratings, rank=2, max_iter=1)
    monkeypatch.setattr(als, "ALS_BLOCK_RATINGS", 5)
    als.fit_als(small_ratings, rank=2, max_iter=1)
    assert made == [10, -(-n // 5)] and made[1] > 10
