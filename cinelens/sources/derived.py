"""Review data derived from the driver's tables.

None of the input tables is a review table, so review rows are derived by
formulas (see FIXTURES.md):

* ``review_rows``  -- raw review CSV rows (one per ``documents`` row)
* ``movies``, ``reviewers``, ``review_fact`` -- a star schema built from
  ``part``, ``customer`` and ``lineitem ⋈ orders``.

All of these are lazy projections/joins, so Catalyst prunes columns and pushes
filters into the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# --- fixture formulas ----------------------------------------
FIXTURE_SITE = "https://example.com"
# vote text by doc_id % 7; index 6 is the document length
FIXTURE_VOTES = ["", "None", "1,234", "1.5K", "2M", "abc"]
# ---------------------------------------------------------------------------


def review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw review rows with an ingest order ``ord`` and ``movie_id``/``title``."""
    return review_rows_from(read_table(spark, sf_dir, "documents"))


def review_rows_from(d: DataFrame) -> DataFrame:
    """The review-row formulas over a ``documents``-shaped frame (batch or stream)."""
    doc_id = F.col("doc_id")
    movie_id = F.concat(F.lit("tt"), F.lpad(F.expr("substring(source, 4)"), 7, "0"))
    votes = F.when(doc_id % 7 == 6, F.col("n_chars").cast("string"))
    for i, v in enumerate(FIXTURE_VOTES):
        votes = F.when(doc_id % 7 == i, F.lit(v)).otherwise(votes)
    uid = F.when(doc_id % 20 == 1, doc_id - 1).otherwise(doc_id)
    return d.select(
        doc_id.alias("ord"),
        movie_id.alias("movie_id"),
        F.col("source").alias("title"),
        F.concat(F.lit("user_"), (doc_id * 31 % 97).cast("string")).alias("Author"),
        F.when(doc_id % 11 == 0, F.lit(None).cast("double"))
         .otherwise(((doc_id * 7 + F.col("n_chars")) % 10 + 1).cast("double")).alias("Rating"),
        votes.alias("Helpful_upVotes"),
        F.when(doc_id % 5 == 0, F.lit(None).cast("string"))
         .otherwise((doc_id % 40).cast("string")).alias("Helpful_downVotes"),
        F.when(doc_id % 17 == 3, F.lit(None).cast("string"))
         .otherwise(F.split_part(F.col("text"), F.lit("\n"), F.lit(1))).alias("Summary"),
        F.when(doc_id % 101 == 50, F.lit(None).cast("string")).otherwise(F.col("text")).alias("Review"),
        F.concat(F.lit("2026-01-"), F.lpad((doc_id % 28 + 1).cast("string"), 2, "0"),
                 F.lit("T00:00:00+00:00")).alias("Scrape_Timestamp"),
        F.concat(F.lit(FIXTURE_SITE + "/title/"), movie_id, F.lit("/reviews")).alias("Source_URL"),
        F.concat(F.lit("rv_"), uid.cast("string")).alias("Unique_ID"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """movies(movie_id, title) from ``part``."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("movie_id"), F.col("p_name").alias("title"))


def reviewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """reviewers(reviewer_id, username) from ``customer``."""
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("reviewer_id"), F.col("c_name").alias("username"))


def review_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """reviews(movie_id, reviewer_id, rating, helpful_upvotes, scrape_timestamp).

    ``lineitem ⋈ orders`` on the order key: both sides are large, so this is
    a shuffle (sort-merge) join; a deployment that keeps the two tables
    bucketed by order key gets it without an exchange.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    qty = F.floor("l_quantity").cast("int")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_partkey").alias("movie_id"),
        F.col("o_custkey").alias("reviewer_id"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("int")).otherwise(qty % 10 + 1).alias("rating"),
        qty.alias("helpful_upvotes"),
        F.col("l_shipdate").alias("scrape_timestamp"),
    )
