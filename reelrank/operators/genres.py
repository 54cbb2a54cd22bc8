"""Best movies per genre.

The genre list is a fixed, short list (20 entries by default), so it is the
broadcast side of a nested-loop join whose streamed side is the movie
table: no shuffle of movies for the match. Beyond ``MAX_BROADCAST_GENRES``
entries the match becomes an equi-join instead: every substring of the
movie's genre text with a length that some genre has, against the lower-
cased genres (exact, no product of the two tables). The top-k runs as a
window with a partial group limit before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.config import GENRE_TOP_K, GENRES
from reelrank.operators.topk import collect_sorted, top_k_per_group

# Largest genre list joined by broadcast; longer lists use the equi-join.
MAX_BROADCAST_GENRES = 500


def genre_frame(spark: SparkSession, genres: Sequence[str] = GENRES) -> DataFrame:
    return spark.createDataFrame([(g,) for g in genres], "genre string")


def genre_match(genres_col, genre_col, match: str = "substring"):
    """Case-insensitive match of one genre against a movie's genre text.

    ``substring`` reproduces the original rule ("Music" matches "Musical");
    ``token`` requires a whole ``|``-separated entry. Null genres never match.
    """
    g = F.lower(genres_col)
    x = F.lower(genre_col)
    if match == "substring":
        return F.coalesce(g.contains(x), F.lit(False))
    if match == "token":
        return F.coalesce(F.array_contains(F.split(g, r"\|"), x), F.lit(False))
    raise ValueError(f"unknown match mode {match!r}")


def _match_by_broadcast(movies_scored: DataFrame, genres: DataFrame, match: str) -> DataFrame:
    cond = genre_match(movies_scored["genres"], genres["genre"], match)
    return movies_scored.join(F.broadcast(genres), cond, "inner")


def _match_by_substrings(movies_scored: DataFrame, genres: DataFrame, match: str) -> DataFrame:
    """Equi-join form of :func:`genre_match` for genre lists of any size."""
    g = genres.select("genre", F.lower("genre").alias("key"))
    text = F.lower(F.col("genres"))
    if match == "token":
        keys = movies_scored.withColumn("key", F.explode(F.array_distinct(F.split(text, r"\|"))))
    elif match == "substring":
        # The distinct lengths of the genre names: a handful of small ints.
        lengths = [r[0] for r in g.select(F.length("key")).distinct().collect()]
        def windows(n: int):
            # Every substring of length n (start positions 1 .. len - n + 1).
            starts = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(0)))
            return F.transform(starts, lambda i: F.substring(text, i, n))
        subs = [windows(n) for n in sorted(lengths)]
        keys = movies_scored.withColumn(
            "key", F.explode(F.array_distinct(F.flatten(F.array(*subs)) if subs else F.array())))
    else:
        raise ValueError(f"unknown match mode {match!r}")
    return keys.join(g, "key").drop("key")


def genres_top(movies_scored: DataFrame, genres: DataFrame, k: int = GENRE_TOP_K,
               match: str = "substring", max_broadcast: int = MAX_BROADCAST_GENRES) -> DataFrame:
    """Flat top-k per genre: (genre, rk, mid, score), score desc then mid asc.

    ``movies_scored`` has (mid, genres, score). Genres without a match give
    no rows; null or empty genres are no genres and match nothing. The genre
    list is broadcast only when its size is checked to be at most
    ``max_broadcast`` rows; otherwise the equi-join form is used. Both forms
    give the same pairs: the size only picks the plan.
    """
    genres = genres.filter(F.length("genre") > 0)
    n_genres = genres.limit(max_broadcast + 1).count()
    if n_genres <= max_broadcast:
        pairs = _match_by_broadcast(movies_scored, genres, match)
    else:
        pairs = _match_by_substrings(movies_scored.filter(F.col("genres").isNotNull()),
                                     genres, match)
    pairs = pairs.select("genre", "mid", "score")
    return top_k_per_group(pairs, ["genre"], [F.desc("score"), F.asc("mid")], k)


def genres_top_lists(movies_scored: DataFrame, genres: DataFrame, k: int = GENRE_TOP_K,
                     match: str = "substring") -> DataFrame:
    """Nested form for sinks: (genre, recs array<struct<mid, score>>)."""
    flat = genres_top(movies_scored, genres, k, match)
    return collect_sorted(flat, ["genre"])
