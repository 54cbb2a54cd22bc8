"""Hot keys: one user and one item hold a third of all rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reelrank.operators import genres, rerank, stats
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    data = []
    for i in range(900):
        uid = 1 if i % 3 == 0 else 2 + i % 40          # user 1: a third of all rows
        mid = 7 if i % 3 == 1 else 100 + i % 60         # item 7: a third of all rows
        data.append((uid, mid, float(1 + i % 5), dt.datetime(2020, 1, 1 + i % 28), i))
    return spark.createDataFrame(data, "uid long, mid long, score double, ts timestamp_ntz, seq long")


def test_hot_item_statistics(skewed):
    counts = dict(rows(stats.rate_more_movies(skewed)))
    assert counts[7] == 300 and sum(counts.values()) == 900


def test_hot_user_recent_k_is_bounded_and_exact(skewed):
    out = rerank.user_recent_k(skewed, 20, ["seq"]).filter("uid = 1").orderBy("rk").collect()
    hot = sorted([r for r in skewed.filter("uid = 1").collect()],
                 key=lambda r: (-r.ts.timestamp(), -r.seq))[:20]
    assert [r.mid for r in out] == [r.mid for r in hot]


def test_hot_genre_top_k(spark, skewed):
    avg = stats.average_movies(skewed)
    movies = avg.select("mid", F.lit("Drama|Other").alias("genres"))
    scored = stats.movies_with_score(movies, avg)
    top = genres.genres_top(scored, genres.genre_frame(spark, ["drama"]), k=10).collect()
    want = sorted(((-r.score, r.mid) for r in avg.collect()))[:10]
    assert [r.mid for r in sorted(top, key=lambda r: r.rk)] == [m for _, m in want]


def test_hot_user_rerank_matches_uncapped(spark, skewed):
    sims = spark.createDataFrame(
        [(a, b, 0.6 + ((a + b) % 40) / 100.0) for a in [7] + list(range(100, 160))
         for b in [7] + list(range(100, 160)) if a != b and (a * b) % 3],
        "mid long, sim_mid long, sim double")
    events = rerank.latest_events(skewed, ["seq"])
    full = rerank.stream_recommendations(events, skewed, sims, tie_breakers=["seq"])
    capped = rerank.stream_recommendations(events, skewed, sims, tie_breakers=["seq"],
                                           capped=rerank.capped_matrix(sims, 5))
    a = {(r.uid, r.mid): round(r.score, 9) for r in full.collect()}
    b = {(r.uid, r.mid): round(r.score, 9) for r in capped.collect()}
    assert a == b and len(a) > 0


def test_hot_term_in_portions_gives_the_same_candidates(spark):
    """One term in a third of all profiles, dealt into many portions or joined plainly."""
    from pyspark.sql import functions as F

    from reelrank.operators import tfidf

    ids = spark.range(300).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("p"), "id")
    terms = ids.select("p", F.explode(F.array(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id") % 17)),
        F.concat(F.lit("u"), F.col("id") % 41))).alias("term"))
    prefix = terms.select(F.col("p").alias("pa"), "term")
    postings = terms.select(F.col("p").alias("pb"), "term")
    plain = tfidf._share_a_term(prefix, postings, portion=10**9)
    dealt = tfidf._share_a_term(prefix, postings, portion=7, most=5)
    want = {(bytes(r.pa), bytes(r.pb)) for r in plain.collect()}
    assert want == {(bytes(r.pa), bytes(r.pb)) for r in dealt.collect()}
    assert len(want) >= 100 * 99 // 2 and all(a < b for a, b in want)
