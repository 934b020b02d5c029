"""Movie ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.values import ratio


def ratings_histogram(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("score").agg(F.count("*").alias("n")).orderBy("score")


def movie_scores(ratings: DataFrame, best: int = 5) -> DataFrame:
    """Best-score count, mean and truncated mean per movie, in one pass."""
    score = F.col("score")
    return ratings.groupBy("movie_id").agg(
        F.count_if(score == best).alias("five_star_count"),
        ratio(F.sum(score), F.count(score)).alias("average_score"),
        F.expr("try_divide(sum(score), count(score))").cast("int").alias("int_average"),
    )


def five_star_count(ratings: DataFrame, best: int = 5) -> DataFrame:
    """Movies with at least one best score."""
    chosen = ratings.filter(F.col("score") == best)
    return chosen.groupBy("movie_id").agg(F.count("score").alias("five_star_count"))


def avg_score(ratings: DataFrame, int_avg: bool = False) -> DataFrame:
    """Mean score per movie; ``int_avg`` drops the fraction, as integer columns do."""
    chosen = "int_average" if int_avg else "average_score"
    return movie_scores(ratings).select("movie_id", F.col(chosen).alias("average_score"))


def hyped_movies(ratings: DataFrame, movies: DataFrame, k: int = 10) -> DataFrame:
    """Movies with most best scores, with title and mean score.

    Ratings are reduced to one row per movie before titles are joined.
    """
    scored = movie_scores(ratings).filter(F.col("five_star_count") > 0)
    return (
        scored.join(movies, "movie_id")
        .select("movie_id", "title", "five_star_count", "average_score")
        .orderBy(F.desc("five_star_count"), "movie_id")
        .limit(k)
    )
