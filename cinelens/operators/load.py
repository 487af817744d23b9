"""Star-schema load operators (J1, J2, J3a-d, D2, D4).

Insert-or-ignore = first row per key in the batch (by ``ord``), minus keys
the target already holds (anti join on the key column only). Loading the
same batch twice therefore adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .dedup import keep_first

# The star schema's column order.
MOVIES_COLS = ["movie_id", "title", "imdb_url", "created_at"]
REVIEWERS_COLS = ["reviewer_id", "username", "created_at"]
SOURCES_COLS = ["source_id", "source_url"]
REVIEWS_COLS = ["review_id", "movie_id", "reviewer_id", "source_id", "rating", "helpful_upvotes",
                "helpful_downvotes", "summary", "review_text", "review_hash", "scrape_timestamp"]


def insert_or_ignore(batch: DataFrame, target: DataFrame | None, key: str, ord: str | None = None, bucketed: bool = False) -> DataFrame:
    """Rows of ``batch`` to append -- first per key, and key not in ``target`` (which may be ``bucketed`` by the key)."""
    rows = batch.where(F.col(key).isNotNull())
    if ord:
        return keep_first(rows, key, ord, unless=target, by_key=bucketed)
    rows = rows.dropDuplicates([key])
    if target is not None:
        rows = rows.join(target.select(key).distinct(), key, "left_anti")
    return rows


def with_surrogate_id(df: DataFrame, id_col: str, existing: DataFrame | None) -> DataFrame:
    """Unique (not dense) ids above the target's current maximum.

    ``monotonically_increasing_id`` needs no shuffle or single-task window;
    the caller writes the result before anything joins on the id, so a
    recomputed task cannot hand out different ids to two readers.
    """
    base = F.lit(0).cast("long")
    if existing is not None:
        base = F.coalesce(existing.agg(F.max(id_col)).scalar(), F.lit(0)).cast("long")
    return df.withColumn(id_col, base + 1 + F.monotonically_increasing_id())


#: Unclipped numbers of a record, for range checks before a value is cast away.
VALUE_COLS = ["rating_value", "upvotes_value", "downvotes_value"]


def review_records(rows: DataFrame, movie_id: str = "movie_id", author: str = "Author",
                   site: str = S.SITE, values: bool = False) -> DataFrame:
    """Raw review rows -> typed review records keyed by natural keys.

    With ``values`` the records also carry ``VALUE_COLS``. What is parsed or
    hashed is worked out once per row, behind an ``explode`` of one element:
    the optimiser does not copy expressions through it, so the rules and
    filters of a load read plain numbers instead of repeating the parsing.
    """
    parsed = F.struct(
        S.rating_value("Rating").alias("rating_value"), S.vote_value("Helpful_upVotes").alias("upvotes_value"),
        S.vote_value("Helpful_downVotes").alias("downvotes_value"), S.review_hash(movie_id, author, "Review").alias("review_hash"),
        S.iso_timestamp("Scrape_Timestamp").alias("scrape_timestamp"))
    known = rows.select(
        F.col(movie_id).cast("string").alias("movie_id"), F.col(author).alias("username"),
        S.source_url(movie_id, site).alias("source_url"), F.col("Summary").alias("summary"), F.col("Review").alias("review_text"),
        *([F.col("ord")] if "ord" in rows.columns else []), F.explode(F.array(parsed)).alias("__v"))
    return known.select(
        *[F.col(f"__v.{c}") for c in (VALUE_COLS if values else [])],
        "movie_id", "username", "source_url",
        F.col("__v.rating_value").try_cast("short").alias("rating"),
        *[F.coalesce(F.col(f"__v.{v}").try_cast("int"), F.lit(0)).alias(f"helpful_{c}")
          for c, v in (("upvotes", "upvotes_value"), ("downvotes", "downvotes_value"))],
        "summary", "review_text", "__v.review_hash", "__v.scrape_timestamp",
        *(["ord"] if "ord" in rows.columns else []),
    )


def resolve_keys(records: DataFrame, reviewers: DataFrame, sources: DataFrame) -> DataFrame:
    """J1 + J2: username -> reviewer_id, source_url -> source_id (inner joins).

    The dimension sides are reduced to their two key columns; the planner
    broadcasts them when their measured size allows (AQE) and shuffles
    otherwise.
    """
    r = reviewers.select("username", "reviewer_id")
    s = sources.select("source_url", "source_id")
    return records.join(r, "username").join(s, "source_url")
