"""Job entry points: source -> operators -> sink, one function per job.

    spark-submit -m reelrank.plans.jobs <job> --config cfg.json

Tables are addressed through the config: ``{"tables": {"rating": {...}}}``
where each entry is ``{"format": "parquet", "path": ...}`` or
``{"format": "jdbc", "table": ...}`` (JDBC settings under ``"jdbc"``).
Jobs communicate only through these tables, as in the original system.
"""

from __future__ import annotations

import argparse
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.config import ALS_NUM_BLOCKS, GENRES, load_job_config
from reelrank.functions.keys import bucket_of
from reelrank.operators import als, genres, stats, tfidf
from reelrank.operators.topk import collect_sorted
from reelrank.session import get_session
from reelrank.sources import jdbc, sinks, text
from reelrank.streaming import job as stream_job
from reelrank.streaming import source as stream_source


def current_version(spark: SparkSession, cfg: dict, name: str) -> str | None:
    """The newest committed version of a table written with ``"versioned": true``.

    Reads the commit rows only (one per version), never a table's file list.
    None for tables without versions: they are taken as they are at the start.
    """
    spec = cfg["tables"][name]
    if not spec.get("versioned"):
        return None
    if spec.get("format") == "jdbc":
        commits = jdbc.read_table(spark, cfg["jdbc"], f"{spec['table']}_commits")
        return commits.agg(F.max("version")).first()[0]
    return spark.read.text(f"{spec['path']}/commits").agg(F.max("value")).first()[0]


def read(spark: SparkSession, cfg: dict, name: str) -> DataFrame:
    spec = cfg["tables"][name]
    if spec.get("versioned") and spec.get("format") != "jdbc":
        path = f"{spec['path']}/data/{current_version(spark, cfg, name)}"
        return spark.read.format(spec.get("format", "parquet")).load(path)
    if spec.get("format") == "jdbc":
        return jdbc.read_table(spark, cfg["jdbc"], spec["table"], spec.get("partition_column"),
                               spec.get("lower"), spec.get("upper"), spec.get("num_partitions"))
    return spark.read.format(spec.get("format", "parquet")).load(spec["path"])


def write(df: DataFrame, cfg: dict, name: str, mode: str = "overwrite") -> None:
    """Write a table. ``"versioned": true`` writes every overwrite as a version
    of its own and then commits it, so running readers keep their files."""
    spec = cfg["tables"][name]
    version = f"{time.time_ns() // 1_000_000:015d}-{uuid.uuid4().hex[:8]}"
    commit = df.sparkSession.createDataFrame([(version,)], "version string").coalesce(1)
    if spec.get("uid_buckets"):
        # Laid out by user bucket so per-batch history reads prune partitions.
        df = df.withColumn("uid_bucket", bucket_of("uid", int(spec["uid_buckets"])))
        spec = dict(spec, partition_by=["uid_bucket"])
    if spec.get("format") == "jdbc":
        jdbc.write_table(df, cfg["jdbc"], spec["table"], mode=spec.get("mode", mode))
        if spec.get("versioned"):
            jdbc.write_table(commit, cfg["jdbc"], f"{spec['table']}_commits", mode="append")
        return
    writer = df.write.format(spec.get("format", "parquet")).mode(spec.get("mode", mode))
    if spec.get("partition_by"):
        writer = writer.partitionBy(*spec["partition_by"])
    if spec.get("versioned"):
        writer.save(f"{spec['path']}/data/{version}")
        commit.write.mode("append").text(f"{spec['path']}/commits")
        return
    writer.save(spec["path"])


def _with_ts(ratings: DataFrame) -> DataFrame:
    if "ts" in ratings.columns:
        return ratings
    return ratings.withColumn("ts", F.timestamp_seconds("timestamp"))


def load_job(spark: SparkSession, cfg: dict) -> None:
    """Text files -> movie/rating/tag tables and the movie document index."""
    src = cfg["input"]
    movies, movie_rej = text.read_movies(spark, src["movies"])
    ratings, rating_rej = text.read_ratings(spark, src["ratings"])
    tag_rows, tag_rej = text.read_tags(spark, src["tags"])
    write(movies, cfg, "movie")
    write(ratings, cfg, "rating")
    write(tag_rows, cfg, "tag")
    if "rejects" in cfg:
        for name, rej in (("movie", movie_rej), ("rating", rating_rej), ("tag", tag_rej)):
            rej.write.mode("overwrite").text(f"{cfg['rejects']}/{name}")
    docs = stats.movies_with_tags(read(spark, cfg, "movie"), stats.movie_tags(read(spark, cfg, "tag")))
    index = cfg.get("index", {})
    sinks.write_documents(docs, index.get("resource", index.get("path")),
                          fmt=index.get("format", "parquet"), id_col="mid",
                          options=index.get("options"))


def statistics_job(spark: SparkSession, cfg: dict) -> None:
    ratings = _with_ts(read(spark, cfg, "rating"))
    write(stats.rate_more_movies(ratings), cfg, "rate_more_movies")
    # the order is that of the report, not of the stored table
    write(stats.rate_more_recently(ratings, sort=False), cfg, "rate_more_recently_movies")
    averages = stats.average_movies(ratings)
    write(averages, cfg, "average_movies")
    scored = stats.movies_with_score(read(spark, cfg, "movie"), averages)
    top = genres.genres_top_lists(scored, genres.genre_frame(spark, cfg.get("genres", GENRES)))
    write(sinks.with_text_recs(top, style="genre") if cfg.get("legacy_text") else top,
          cfg, "genres_top_movies")


def write_similarities(sims: DataFrame, cfg: dict, name: str) -> None:
    """Long form, or with ``"lists"`` one sorted list per item (nested, or as text)."""
    form = cfg.get("lists")
    if form:
        sims = sinks.similarity_lists(sims)
        sims = sinks.with_text_recs(sims) if form == "text" else sims
    write(sims, cfg, name)


def offline_job(spark: SparkSession, cfg: dict) -> None:
    ratings = read(spark, cfg, "rating").select("uid", "mid", "score").persist()
    try:
        model = als.fit_als(ratings, seed=cfg.get("seed", 42),
                            num_blocks=cfg.get("als_blocks"))
        rated = ratings.select("uid", "mid") if cfg.get("exclude_rated") else None
        user_recs = collect_sorted(als.user_recommendations(model, rated=rated), ["uid"])
        write(user_recs, cfg, "user_recs")
        write_similarities(als.item_similarity(model), cfg, "movie_recs")
    finally:
        ratings.unpersist()


def als_trainer_job(spark: SparkSession, cfg: dict) -> DataFrame:
    ratings = read(spark, cfg, "rating").select("uid", "mid", "score")
    train, test = als.random_split(ratings, seed=cfg.get("seed", 42))
    settings = {k: cfg[k] for k in ("ranks", "reg_params", "max_iter") if k in cfg}
    grid = als.als_grid(train, test, seed=cfg.get("seed", 42),
                        num_blocks=cfg.get("als_blocks", ALS_NUM_BLOCKS), **settings)
    best = als.best_params(grid)
    best.show(truncate=False)
    if "als_best_params" in cfg["tables"]:
        write(best, cfg, "als_best_params")
    return grid


def content_job(spark: SparkSession, cfg: dict) -> None:
    """TF-IDF similarity. ``factorised`` writes the compact form (item ->
    profile, profile pairs), which the streaming job can use; the item-level
    table, its expansion, is then written only with ``expand``."""
    movies = read(spark, cfg, "movie").select("mid", "genres")
    hashed = cfg.get("hashed", True)
    if cfg.get("factorised"):
        item_group, group_sims = tfidf.tfidf_similarity_groups(movies, hashed=hashed)
        write(item_group, cfg, "content_item_groups")
        write(group_sims, cfg, "content_group_recs")
        if not cfg.get("expand"):
            return
        item_group = read(spark, cfg, "content_item_groups")
        group_sims = read(spark, cfg, "content_group_recs")
        sims = tfidf.expand_to_items(
            item_group.select(F.col("mid").alias("item"), F.col("grp").alias("profile")),
            group_sims.select(F.col("mid").alias("pa"), F.col("sim_mid").alias("pb"), "sim"))
    else:
        sims = tfidf.tfidf_item_similarity(movies, hashed=hashed)
    write_similarities(sims, cfg, "content_movie_recs")


def streaming_job(spark: SparkSession, cfg: dict):
    s = cfg["stream"]
    if s.get("format", "kafka") == "kafka":
        stream = stream_source.kafka_stream(spark, s["bootstrap_servers"], s["topic"],
                                            s.get("starting_offsets", "latest"), s.get("options"),
                                            s.get("max_offsets_per_trigger",
                                                  stream_source.MAX_OFFSETS_PER_TRIGGER))
    else:
        stream = stream_source.text_stream(spark, s["path"], s.get(
            "max_files_per_trigger", stream_source.MAX_FILES_PER_TRIGGER))
    names = [s.get("matrix", "movie_recs"), *([s["item_group"]] if s.get("item_group") else [])]

    def version():
        found = [current_version(spark, cfg, n) for n in names]
        return None if None in found else "/".join(found)

    def load_matrix():
        matrix = read(spark, cfg, names[0])
        if "recs" in matrix.columns:  # stored lists, as text or nested
            matrix = sinks.matrix_from_lists(matrix)
        # A group-level matrix (e.g. content_group_recs) comes with its item map.
        return matrix, read(spark, cfg, names[1]) if len(names) > 1 else None

    def reload(installed):
        now = version()
        return None if now == installed else (now, *load_matrix())

    first = version()
    matrix, item_group = load_matrix()
    options = {k: s[k] for k in ("recent_k", "union_batch", "exclude_seen") if k in s}
    buckets = cfg["tables"]["rating"].get("uid_buckets")
    # the ratings are looked up anew for every micro-batch
    query = stream_job.start(stream, lambda: _with_ts(read(spark, cfg, "rating")), matrix,
                             s["output"], s["checkpoint"], rejects_path=s.get("rejects"),
                             trigger=s.get("trigger"), item_group=item_group, version=first,
                             candidate_cap=s.get("candidate_cap", 40), reload=reload, **options,
                             buckets=s.get("matrix_buckets"),
                             history_buckets=("uid_bucket", int(buckets)) if buckets else None)
    return query


JOBS = {"load": load_job, "statistics": statistics_job, "offline": offline_job,
        "als_trainer": als_trainer_job, "content": content_job, "streaming": streaming_job}


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="reelrank.plans.jobs")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--config", required=True)
    args = parser.parse_args(argv)
    cfg = load_job_config(args.config)
    spark = get_session()
    result = JOBS[args.job](spark, cfg)
    if args.job == "streaming":
        result.awaitTermination()


if __name__ == "__main__":
    main()
