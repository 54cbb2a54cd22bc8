"""Bucketed matrix tables: no exchange on the matrix side, pruned buckets, same rows."""

import re

import pytest
from pyspark.sql import functions as F

from reelrank.operators import rerank
from reelrank.sources import lookup
from reelrank.streaming import job
from tests.conftest import rows
from tests.test_rerank import RATINGS, SIMS, _day

BUCKETS = 4


@pytest.fixture()
def shuffled_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def sims(spark):
    return spark.createDataFrame([(a, b, s) for (a, b), s in SIMS.items()],
                                 "mid long, sim_mid long, sim double")


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.createDataFrame([(u, m, s, _day(d)) for u, m, s, d in RATINGS],
                                 "uid long, mid long, score double, ts timestamp_ntz")


@pytest.fixture(scope="module")
def stored(spark, sims, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("matrix"))
    made = lookup.store_matrix(sims, rerank.capped_matrix(sims, 3), path, BUCKETS)
    yield path, made
    made.forget(spark)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges_below(plan: str, column: str) -> int:
    """Shuffles whose keys are the scan's own ``column`` (by its attribute id)."""
    scan = next(x for x in plan.splitlines() if "FileScan" in x and column in x)
    attribute = re.search(rf"{column}#\d+L?", scan)[0]
    return len(re.findall(rf"Exchange hashpartitioning\([^)]*{re.escape(attribute)}", plan))


def test_pairs_join_without_moving_the_matrix(spark, sims, stored, shuffled_joins):
    pairs, _ = stored[1].frames(spark)
    wanted = spark.range(0, 200).select((F.col("id") % 101).alias("mid"),
                                        (F.col("id") % 7).alias("sim_mid"))
    out = wanted.join(pairs, ["mid", "sim_mid"])
    plan = _plan(out)
    assert plan.count("Exchange hashpartitioning") == 1
    assert _exchanges_below(plan, "sim_mid") == 0
    assert rows(out) == rows(wanted.join(sims, ["mid", "sim_mid"]))
    # the plain table moves
    assert _plan(wanted.join(sims, ["mid", "sim_mid"])).count("Exchange hashpartitioning") == 2


def test_lists_join_without_moving_and_prune(spark, sims, stored, shuffled_joins):
    _, lists = stored[1].frames(spark)
    events = spark.createDataFrame([(1, 100), (2, 3), (3, 3), (4, None)], "uid long, src long")
    few = lookup.prune(lists, events)
    out = events.join(few, "src")
    plan = _plan(out)
    assert plan.count("Exchange hashpartitioning") == 1
    picked = re.search(r"SelectedBucketsCount: (\d+) out of 4", plan)
    assert picked and int(picked[1]) <= 2
    all_lists = rerank.capped_matrix(sims, 3)
    assert rows(out, "uid", "src", "sim_mid") == rows(
        events.join(all_lists, "src"), "uid", "src", "sim_mid")
    # more keys than the limit: no filter, the same rows
    assert rows(events.join(lookup.prune(lists, events, 1), "src")) == rows(out)
    none = events.where("src is null")
    assert none.join(lookup.prune(lists, none), "src").count() == 0


def test_rerank_is_the_same_from_buckets(spark, sims, ratings, stored, shuffled_joins):
    events = rerank.latest_events(ratings)
    want = rerank.stream_recommendations(events, ratings, sims)
    pairs, lists = stored[1].frames(spark)
    got = rerank.stream_recommendations(events, ratings, pairs, capped=lists)
    assert rows(got.select("uid", "mid", F.round("score", 9))) == rows(
        want.select("uid", "mid", F.round("score", 9)))
    assert want.count() > 0


def test_stored_folders_open_again(spark, sims, stored, shuffled_joins):
    path, made = stored
    pairs, lists = made.frames(spark)
    again = lookup.open_matrix(spark, path, BUCKETS, pairs.schema, lists.schema)
    try:
        pairs, lists = again.frames(spark)
        assert rows(pairs) == rows(sims)
        out = sims.select("mid", "sim_mid").join(pairs, ["mid", "sim_mid"])
        assert _plan(out).count("Exchange hashpartitioning") == 1
        assert out.count() == len(SIMS)
    finally:
        again.forget(spark)


def test_stream_installs_versions_as_buckets(spark, sims, ratings, tmp_path):
    src = str(tmp_path / "in")
    lines = [("MOVIE_RATING_PREFIX:7|100|4.0|1578528000",), ("8|100|1.0|1577923200",)]
    spark.createDataFrame(lines, "value string").repartition(2).write.text(src)
    stream = spark.readStream.format("text").schema("value string").option(
        "maxFilesPerTrigger", 1).load(src)
    empty, calls = sims.limit(0), []

    def reload(version):  # the first batch installs the real matrix
        calls.append(version)
        return ("b", sims, None) if version == "a" else None

    results = {}
    for name, buckets in (("plain", None), ("bucketed", BUCKETS)):
        calls.clear()
        out = str(tmp_path / name)
        query = job.start(stream, ratings, empty, out, str(tmp_path / f"{name}-ckpt"),
                          trigger={"availableNow": True}, version="a", reload=reload,
                          buckets=buckets)
        query.awaitTermination()
        results[name] = rows(spark.read.parquet(out).select("uid", "mid", F.to_json("recs")))
        assert calls[:2] == ["a", "b"]
    assert results["plain"] == results["bucketed"]
    assert any("mid" in recs for _, _, recs in results["plain"])
    assert spark.sql("show tables like 'matrix_*'").count() <= 4
