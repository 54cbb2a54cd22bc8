"""Popularity and quality statistics over ratings and tags.

All are single hash aggregations with map-side partial aggregation, so a
movie with a third of all ratings is combined inside each map task before
the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.config import LIST_SEP
from reelrank.functions.dates import year_month


def rate_more_movies(ratings: DataFrame) -> DataFrame:
    """Number of ratings per movie: (mid, count)."""
    return ratings.groupBy("mid").agg(F.count("mid").alias("count"))


def rate_more_recently(ratings: DataFrame, ts_col: str = "ts", sort: bool = True) -> DataFrame:
    """Ratings per (movie, month): (mid, count, yearmonth), newest month first."""
    monthly = (ratings.select("mid", year_month(ts_col).alias("yearmonth"))
               .groupBy("mid", "yearmonth").agg(F.count("mid").alias("count"))
               .select("mid", "count", "yearmonth"))
    if sort:
        monthly = monthly.orderBy(F.desc("yearmonth"), F.desc("count"), F.asc("mid"))
    return monthly


def average_movies(ratings: DataFrame) -> DataFrame:
    """Mean score per movie: (mid, score)."""
    return ratings.groupBy("mid").agg(F.avg("score").alias("score"))


def distinct_movie_tags(tags: DataFrame) -> DataFrame:
    """(mid, tag) once each: the long form, with no row that grows with a movie's tags."""
    return tags.select("mid", "tag").distinct()


def movie_tags(tags: DataFrame, sep: str = LIST_SEP) -> DataFrame:
    """Distinct tags per movie joined by ``sep`` (sorted, so the text is stable).

    Nests :func:`distinct_movie_tags` for the document sink; a movie's text is
    one value by definition.
    """
    return distinct_movie_tags(tags).groupBy("mid").agg(
        F.array_join(F.array_sort(F.collect_list("tag")), sep).alias("tags"))


def movies_with_tags(movies: DataFrame, tags_per_movie: DataFrame) -> DataFrame:
    """Every movie plus its tag text (null when untagged): left outer join."""
    return movies.join(tags_per_movie, on="mid", how="left")


def movies_with_score(movies: DataFrame, averages: DataFrame) -> DataFrame:
    """Movies that have a mean score (inner join: unrated movies drop out)."""
    return movies.join(averages, on="mid", how="inner")


def distinct_entities(ratings: DataFrame) -> DataFrame:
    """(kind, id): the distinct users and items, in one pass over the ratings."""
    tagged = ratings.select(F.explode(F.array(
        F.struct(F.lit("user").alias("kind"), F.col("uid").alias("id")),
        F.struct(F.lit("item").alias("kind"), F.col("mid").alias("id")))).alias("e"))
    return tagged.select("e.kind", "e.id").distinct()
