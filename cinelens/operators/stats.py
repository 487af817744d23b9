"""Aggregate statistics of labelled reviews (A2-A7), over all rows or per ``group`` (e.g. ``movie_id``).

A null label is not counted as a sentiment (A2, A5 and the record's maps),
but its row counts in totals and rating means.

A7 computes every statistic in one scan with ``GROUPING SETS ((label),
(rating), ())``; the grouped result has one row per label plus one per
rating value, so folding it into the one-row record is a bounded aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .clean import require_columns


def _by(group: str | None) -> list[str]:
    return [group] if group else []


def sentiment_counts(df: DataFrame, label: str = "Sentiment_label", group: str | None = None) -> DataFrame:
    """A2: ``([group,] label, count)`` largest first, ties by label."""
    require_columns(df, [label])
    return (df.where(F.col(label).isNotNull()).groupBy(*_by(group), label).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(*_by(group), F.col("count").desc(), F.col(label)))


def average_rating(df: DataFrame, rating: str = "Rating", decimals: int = 1, group: str | None = None) -> DataFrame:
    """A3: mean rating ignoring nulls, rounded half-to-even."""
    require_columns(df, [rating])
    return df.groupBy(*_by(group)).agg(F.bround(F.avg(rating), decimals).alias("avg_rating"))


def rating_counts(df: DataFrame, rating: str = "Rating", group: str | None = None) -> DataFrame:
    """A4 + T6: ``([group,] rating, count)`` for non-null ratings, ascending."""
    require_columns(df, [rating])
    return (df.where(F.col(rating).isNotNull()).groupBy(*_by(group), rating)
            .agg(F.count(F.lit(1)).alias("count")).orderBy(*_by(group), rating))


def rating_by_sentiment(df: DataFrame, label: str = "Sentiment_label", rating: str = "Rating",
                        group: str | None = None) -> DataFrame:
    """A5: mean rating per label."""
    require_columns(df, [label, rating])
    return df.where(F.col(label).isNotNull()).groupBy(*_by(group), label).agg(F.avg(rating).alias("avg_rating"))


def total_reviews(df: DataFrame, group: str | None = None) -> DataFrame:
    """Row count."""
    return df.groupBy(*_by(group)).agg(F.count(F.lit(1)).alias("total_reviews"))


def grouped_stats(df: DataFrame, label: str = "Sentiment_label", rating: str = "Rating",
                  group: str | None = None) -> DataFrame:
    """A7 (rows): one scan, ``GROUPING SETS ((label), (rating), ())``, each within ``group`` if given.

    ``set`` is ``label``, ``rating`` or ``total``; ``grouping_id`` keeps a
    null rating group apart from the grand total.
    """
    require_columns(df, [label, rating])
    by = _by(group)
    g = df.groupingSets([[*by, label], [*by, rating], by], *by, label, rating).agg(
        F.count(F.lit(1)).alias("count"), F.avg(rating).alias("avg_rating"),
        F.grouping_id().alias("__gid"))
    kind = (F.when(F.col("__gid") == 1, F.lit("label")).when(F.col("__gid") == 2, F.lit("rating"))
            .otherwise(F.lit("total")))
    return g.select(*by, kind.alias("set"), F.col(label).alias("label"), F.col(rating).alias("rating"),
                    "count", "avg_rating")


def stats_record(df: DataFrame, label: str = "Sentiment_label", rating: str = "Rating",
                 group: str | None = None) -> DataFrame:
    """One row (per group) -- sentiment_counts, avg_rating, rating_distribution,
    avg_rating_by_sentiment, total_reviews (maps ordered as the reference's dicts)."""
    g = grouped_stats(df, label, rating, group)
    is_label = (F.col("set") == "label") & F.col("label").isNotNull()
    is_rating = (F.col("set") == "rating") & F.col("rating").isNotNull()
    is_total = F.col("set") == "total"
    counts = F.sort_array(F.collect_list(F.when(is_label, F.struct(
        (-F.col("count")).alias("k"), F.col("label").alias("l"), F.col("count").alias("c")))))
    dist = F.sort_array(F.collect_list(F.when(is_rating, F.struct(
        F.col("rating").alias("r"), F.col("count").alias("c")))))
    by_label = F.collect_list(F.when(is_label, F.struct(F.col("label").alias("l"), F.col("avg_rating").alias("a"))))
    return g.groupBy(*_by(group)).agg(
        F.map_from_entries(F.transform(counts, lambda x: F.struct(x["l"], x["c"]))).alias("sentiment_counts"),
        F.bround(F.max(F.when(is_total, F.col("avg_rating"))), 1).alias("avg_rating"),
        F.map_from_entries(dist).alias("rating_distribution"),
        F.map_from_entries(F.sort_array(by_label)).alias("avg_rating_by_sentiment"),
        F.coalesce(F.max(F.when(is_total, F.col("count"))), F.lit(0)).alias("total_reviews"),
    )
