"""Report datasets (E5, S6, S7): the data behind the KPI / ranking report.

``report_datasets`` returns a dict of lazy DataFrames; with ``materialize`` the
per-movie metrics and reviewer totals, which feed several of them, are
checkpointed once. ``write_report`` writes every dataset as its own output.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import display
from ..operators import metrics as M
from ..session import checkpointed
from ..sources import derived


def report_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star-schema tables the report reads."""
    return {
        "reviews": derived.review_fact(spark, sf_dir),
        "movies": derived.movies(spark, sf_dir),
        "reviewers": derived.reviewers(spark, sf_dir),
    }


def loaded_inputs(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """S6 over the tables that ``plans.star.load_star`` wrote."""
    return {t: spark.read.parquet(os.path.join(root, t)) for t in ("reviews", "movies", "reviewers")}


def constants(df: DataFrame, **values) -> DataFrame:
    """The same constant columns on every row of a load (e.g. movie id, title, source url)."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def scatter(metrics: DataFrame) -> DataFrame:
    """The all-movie scatter measures (every movie)."""
    return metrics.select("movie_id", "title", "review_count", "avg_rating", "total_upvotes")


def report_datasets(reviews: DataFrame, movies: DataFrame, reviewers: DataFrame,
                    n: int = 10, min_reviews: int = 5, materialize: bool = False) -> dict[str, DataFrame]:
    """E5: named report datasets."""
    metrics = M.movie_metrics(reviews, movies)
    if materialize:
        metrics = checkpointed(metrics)
    totals = M.reviewer_totals(reviews, reviewers)
    if materialize:
        totals = checkpointed(totals)
    dist = M.rating_distribution(reviews)
    kpi = M.kpi_summary(reviews)
    by_rating = M.top_movies(metrics, "avg_rating", n, min_reviews=min_reviews)
    by_volume = M.top_movies(metrics, "review_count", n)
    by_upvotes = M.top_movies(metrics, "total_upvotes", n)
    top_revs = M.top_reviewers(totals, n)
    peak = M.peak_rating(dist)
    return {
        "kpi": kpi,
        "kpi_display": display.kpi_display(kpi),
        "executive_summary": display.executive_summary(kpi),
        "rating_distribution": dist,
        "top_movies_by_rating": by_rating,
        "top_movies_by_volume": by_volume,
        "top_movies_by_upvotes": by_upvotes,
        "top_reviewers": top_revs,
        "movie_scatter": scatter(metrics),
        "leaders": M.leaders(metrics, totals, min_reviews),
        "peak_rating": peak.select(
            F.coalesce(F.col("top_rating").cast("string"), F.lit(display.MISSING)).alias("top_rating"),
            display.thousands("peak_review_count").alias("peak_review_count")),
    }


def write_report(datasets: dict[str, DataFrame], path: str, fmt: str = "json") -> list[str]:
    """One output folder per dataset; returns the written paths."""
    written = []
    for name, df in datasets.items():
        out = os.path.join(path, name)
        df.write.mode("overwrite").format(fmt).save(out)
        written.append(out)
    return written
