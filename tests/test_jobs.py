import os
import tempfile

from pyspark.sql import functions as F

from reelrank.operators import als
from reelrank.plans import jobs


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def test_load_statistics_content_offline_jobs(spark):
    base = tempfile.mkdtemp(prefix="reelrank-jobs-")
    _write(f"{base}/in/movies.txt", [
        "1^A^d^t^i^s^l^Action|Adventure^x^y", "2^B^d^t^i^s^l^Action^x^y",
        "3^C^d^t^i^s^l^Comedy|Drama^x^y", "4^D^d^t^i^s^l^Action|Adventure^x^y",
        "bad^line"])
    _write(f"{base}/in/ratings.txt", [f"{u},{m},{(u + m) % 5 + 1}.0,{1260759000 + u * 100 + m}"
                                      for u in range(1, 7) for m in range(1, 5)])
    _write(f"{base}/in/tags.txt", ["1,1,fun,1", "2,1,fun,2", "3,3,dark,3"])
    tables = {n: {"format": "parquet", "path": f"{base}/t/{n}"} for n in (
        "movie", "rating", "tag", "rate_more_movies", "rate_more_recently_movies",
        "average_movies", "genres_top_movies", "content_movie_recs", "user_recs", "movie_recs",
        "content_item_groups", "content_group_recs")}
    cfg = {"input": {k: f"{base}/in/{k}.txt" for k in ("movies", "ratings", "tags")},
           "tables": tables, "rejects": f"{base}/rej",
           "index": {"format": "json", "path": f"{base}/index"}}
    jobs.load_job(spark, cfg)
    assert spark.read.parquet(tables["movie"]["path"]).count() == 4
    assert spark.read.text(f"{base}/rej/movie").count() == 1
    docs = {r.mid: r.tags for r in spark.read.json(f"{base}/index").collect()}
    assert docs[1] == "fun" and docs[3] == "dark" and docs[2] is None
    jobs.statistics_job(spark, cfg)
    assert spark.read.parquet(tables["rate_more_movies"]["path"]).count() == 4
    top = {r.genre: r.recs for r in spark.read.parquet(tables["genres_top_movies"]["path"]).collect()}
    assert set(top) == {"Action", "Adventure", "Comedy", "Drama"}
    jobs.content_job(spark, cfg)
    sims = {(r.mid, r.sim_mid) for r in spark.read.parquet(tables["content_movie_recs"]["path"]).collect()}
    assert (1, 4) in sims and (4, 1) in sims
    jobs.content_job(spark, dict(cfg, factorised=True))
    again = {(r.mid, r.sim_mid) for r in spark.read.parquet(tables["content_movie_recs"]["path"]).collect()}
    assert again == sims
    assert spark.read.parquet(tables["content_item_groups"]["path"]).count() == 4
    jobs.offline_job(spark, cfg)
    assert spark.read.parquet(tables["user_recs"]["path"]).count() == 6


def test_trainer_job_reports_the_best_parameters(spark, capsys):
    base = tempfile.mkdtemp(prefix="reelrank-trainer-")
    data = [(u, m, float(1 + (u * m) % 5)) for u in range(1, 21) for m in range(1, 16)]
    spark.createDataFrame(data, "uid long, mid long, score double").write.parquet(f"{base}/rating")
    cfg = {"tables": {"rating": {"path": f"{base}/rating"},
                      "als_best_params": {"path": f"{base}/best"}},
           "ranks": [2, 3], "reg_params": [0.05, 5.0], "max_iter": 3}
    grid = jobs.als_trainer_job(spark, cfg).collect()
    best = spark.read.parquet(f"{base}/best").first()
    assert len(grid) == 4 and best.rmse == min(r.rmse for r in grid) and best.reg_param == 0.05
    assert "reg_param" in capsys.readouterr().out


def test_random_split_is_a_seeded_partition(spark):
    from reelrank.operators import als

    ratings = spark.range(2000).selectExpr("id as uid", "id as mid", "1.0D as score")
    train, test = als.random_split(ratings, seed=3)
    a, b = {r.uid for r in train.collect()}, {r.uid for r in test.collect()}
    assert not a & b and len(a | b) == 2000 and 1500 < len(a) < 1700
    assert a == {r.uid for r in als.random_split(ratings, seed=3)[0].collect()}


def test_factorised_content_job_expands_only_on_request(spark):
    base = tempfile.mkdtemp(prefix="reelrank-content-")
    spark.createDataFrame([(1, "Action|War"), (2, "Action|War"), (3, "Comedy")],
                          "mid long, genres string").write.parquet(f"{base}/movie")
    cfg = {"tables": {n: {"path": f"{base}/{n}"} for n in (
        "movie", "content_item_groups", "content_group_recs", "content_movie_recs")},
        "factorised": True}
    jobs.content_job(spark, cfg)
    assert not os.path.exists(f"{base}/content_movie_recs")
    jobs.content_job(spark, dict(cfg, expand=True, lists="text"))
    texts = {r.mid: r.recs for r in spark.read.parquet(f"{base}/content_movie_recs").collect()}
    assert set(texts) == {1, 2} and texts[1].startswith("List(Recommendation(2,")


def test_streaming_job_sees_new_ratings_and_a_new_matrix(spark):
    """The job itself: ratings appended and a matrix version committed between micro-batches."""
    import datetime as dt

    base = tempfile.mkdtemp(prefix="reelrank-live-")
    os.makedirs(f"{base}/in")
    cfg = {"tables": {"rating": {"path": f"{base}/rating"},
                      "matrix": {"path": f"{base}/matrix", "versioned": True}},
           "stream": {"format": "text", "path": f"{base}/in", "matrix": "matrix",
                      "output": f"{base}/out", "checkpoint": f"{base}/ckpt",
                      "trigger": {"processingTime": "1 second"}, "recent_k": 20,
                      "max_files_per_trigger": 1}}
    rating = "uid long, mid long, score double, timestamp long"

    def rate(*rows):
        spark.createDataFrame(list(rows), rating).write.mode("append").parquet(f"{base}/rating")

    def matrix(pairs):
        both = [p for a, b, v in pairs for p in ((a, b, v), (b, a, v))]
        sims = spark.createDataFrame(both, "mid long, sim_mid long, sim double")
        from reelrank.sources import sinks
        jobs.write(sinks.with_text_recs(sinks.similarity_lists(sims)), cfg, "matrix")

    def event(name, line):
        with open(f"{base}/{name}", "w", encoding="utf-8") as fh:
            fh.write(line + "\n")
        os.rename(f"{base}/{name}", f"{base}/in/{name}")

    rate((30, 4, 4.0, 100), (30, 6, 5.0, 200))
    matrix([(4, 1, 0.9), (4, 2, 0.8), (1, 6, 0.8), (2, 6, 0.8), (2, 7, 0.9)])
    query = jobs.streaming_job(spark, cfg)
    try:
        event("a.txt", "30|4|4.0|300")
        query.processAllAvailable()
        rate((30, 1, 3.0, 400), (30, 7, 1.0, 500))  # 1 is now seen, 7 counts for 2
        event("b.txt", "30|4|4.0|600")
        query.processAllAvailable()
        matrix([(4, 9, 0.9), (9, 6, 0.8)])
        event("c.txt", "30|4|4.0|700")
        query.processAllAvailable()
    finally:
        query.stop()
    out = spark.read.parquet(f"{base}/out").orderBy("batch_id").collect()
    lists = [{r.mid: round(r.score, 6) for r in x.recs} for x in out]
    # candidate 1: (0.9 * 4 + 0.8 * 5) / 2 + log10(2); candidate 2: (0.8 * 4 + 0.8 * 5) / 2 + ...
    assert lists[0] == {1: 4.10103, 2: 3.90103}
    # (0.8 * 4 + 0.8 * 5 + 0.9 * 1) / 3 + log10(2) - log10(1)
    assert lists[1] == {2: 3.00103}
    assert lists[2] == {9: 4.10103}


def test_hash_split_does_not_move_with_the_layout(spark):
    frame = spark.range(4000).select(F.col("id").alias("ok"), (F.col("id") % 3).alias("ln"),
                                     F.lit(1.0).alias("score"))
    train, test = als.hash_split(frame, ["ok", "ln"], 0.8, seed=5)
    a, b = ({r.ok for r in x.collect()} for x in (train, test))
    assert a | b == set(range(4000)) and not a & b
    assert abs(len(a) - 3200) < 120
    moved = als.hash_split(frame.repartition(7), ["ok", "ln"], 0.8, seed=5)[0]
    assert {r.ok for r in moved.collect()} == a
    assert {r.ok for r in als.hash_split(frame, ["ok", "ln"], 0.8, seed=6)[0].collect()} != a
    nulls = spark.createDataFrame([(None, 1, 1.0)] * 3, "ok long, ln long, score double")
    sides = [x.count() for x in als.hash_split(nulls, ["ok", "ln"])]
    assert sorted(sides) == [0, 3]
