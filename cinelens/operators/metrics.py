"""Report metrics over the star schema.

Every aggregate runs on the fact table first and joins a dimension only to
the aggregated rows (one per key), so the dimension join never sees the
fact's volume. Partial (map-side) aggregation makes hot keys cheap: a movie
holding a third of all reviews still contributes one row per map task to
the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kpi_summary(reviews: DataFrame, decimals: int = 2) -> DataFrame:
    """A10: one row -- total_reviews, avg_rating, total_movies, latest_scrape."""
    return reviews.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.round(F.avg("rating"), decimals).alias("avg_rating"),
        F.countDistinct("movie_id").alias("total_movies"),
        F.max("scrape_timestamp").alias("latest_scrape"),
    )


def rating_distribution(reviews: DataFrame, rating_col: str = "rating",
                        sort: bool = True) -> DataFrame:
    """(rating, review_count) over non-null ratings, by rating."""
    out = (reviews.where(F.col(rating_col).isNotNull())
           .groupBy(F.col(rating_col).alias("rating"))
           .agg(F.count(F.lit(1)).alias("review_count")))
    return out.orderBy("rating") if sort else out


def movie_metrics(reviews: DataFrame, movies: DataFrame) -> DataFrame:
    """Per movie -- title, review_count, avg_rating, total_upvotes."""
    per_movie = reviews.groupBy("movie_id").agg(
        F.count(F.lit(1)).alias("review_count"),
        F.avg("rating").alias("avg_rating"),
        F.sum("helpful_upvotes").cast("long").alias("total_upvotes"),
    )
    return per_movie.join(movies.select("movie_id", "title"), "movie_id").select(
        "movie_id", "title", "review_count", "avg_rating", "total_upvotes")


def reviewer_totals(reviews: DataFrame, reviewers: DataFrame) -> DataFrame:
    """Per reviewer -- username, total_reviews."""
    per = reviews.groupBy("reviewer_id").agg(F.count(F.lit(1)).alias("total_reviews"))
    return per.join(reviewers.select("reviewer_id", "username"), "reviewer_id").select(
        "reviewer_id", "username", "total_reviews")


def _ordered(df: DataFrame, by: str, key: str, nulls: str) -> DataFrame:
    primary = F.col(by).desc_nulls_last() if nulls == "last" else F.col(by).desc_nulls_first()
    return df.orderBy(primary, F.col(key).asc())


def top_movies(metrics: DataFrame, by: str, n: int = 10, min_reviews: int | None = None,
               nulls: str = "last") -> DataFrame:
    """F2 + T1-T3: top ``n`` movies by ``by`` (desc), ties by movie_id.

    ``min_reviews`` keeps movies with strictly more reviews. ``orderBy`` +
    ``limit`` plans as ``TakeOrderedAndProject``: each task keeps its own top
    ``n`` and only those reach the final merge.
    """
    if min_reviews is not None:
        metrics = metrics.where(F.col("review_count") > min_reviews)
    return _ordered(metrics, by, "movie_id", nulls).limit(n)


def top_reviewers(totals: DataFrame, n: int = 10) -> DataFrame:
    """T4: top ``n`` reviewers by total_reviews, ties by reviewer_id."""
    return _ordered(totals, "total_reviews", "reviewer_id", "last").limit(n)


def leaders(metrics: DataFrame, totals: DataFrame, min_reviews: int = 5, missing: str = "N/A") -> DataFrame:
    """T5: the first label of each ranking, or ``missing`` where a ranking is empty.

    One aggregate over the movie metrics gives all movie rankings' leaders
    (``min_by`` of the order the rankings use: value descending, nulls last,
    then id), one over the reviewer totals the reviewer.
    """
    def first(label: str, by: str, key: str, cond=None):
        order = F.struct(F.col(by).isNull(), -F.col(by), F.col(key))
        return F.min_by(F.col(label).cast("string"), order if cond is None else F.when(cond, order))

    movies = metrics.agg(first("title", "avg_rating", "movie_id", F.col("review_count") > min_reviews).alias("top_movie_rating"),
                         first("title", "review_count", "movie_id").alias("top_movie_volume"),
                         first("title", "total_upvotes", "movie_id").alias("top_movie_upvotes"))
    reviewer = totals.agg(first("username", "total_reviews", "reviewer_id"))
    row = movies.withColumn("top_reviewer", reviewer.scalar())
    return row.select(*[F.coalesce(F.col(c), F.lit(missing)).alias(c) for c in row.columns])


def peak_rating(distribution: DataFrame) -> DataFrame:
    """Most common rating and its count (lowest rating wins a tie)."""
    return distribution.agg(
        F.max_by("rating", F.struct(F.col("review_count"), -F.col("rating"))).alias("top_rating"),
        F.max("review_count").alias("peak_review_count"),
    )
