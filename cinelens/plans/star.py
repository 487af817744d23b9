"""Idempotent load of review rows into the star schema.

Ordered writes: sources, movies, reviewers, then reviews. Each dimension is
written before the reviews resolve their keys against it, so surrogate ids
are read back from storage rather than recomputed. Rows that break a NOT
NULL or range rule go to a quarantine table instead of failing the load.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions import scalars as S
from ..operators import load as L
from ..operators import quality as Q
from ..sources import bucketed as BK

MAX_INT = 2**31 - 1
TABLES = ("sources", "movies", "reviewers", "reviews", "quarantine")
#: Natural key of each table: what makes a row known, and what a bucketed target is bucketed by.
KEYS = {"sources": "source_url", "movies": "movie_id", "reviewers": "username", "reviews": "review_hash",
        "quarantine": "quarantine_hash"}


def rules() -> list:
    """NOT NULL and CHECK constraints of the star schema; ranges are checked on unclipped numbers."""
    return [Q.not_null_rule("username"), Q.not_null_rule("review_text"), Q.not_null_rule("scrape_timestamp"),
            Q.range_rule("rating_value", 1, 10), Q.range_rule("upvotes_value", 0, MAX_INT),
            Q.range_rule("downvotes_value", 0, MAX_INT)]


def read_target(spark: SparkSession, root: str, name: str, buckets: int | None = None) -> DataFrame | None:
    path = os.path.join(root, name)
    try:
        plain = spark.read.parquet(path)
    except AnalysisException:
        return None
    return plain if buckets is None else BK.open_bucketed(spark, path, plain.schema, KEYS[name], buckets)


def plan_new_rows(batch: DataFrame, target: dict, ord: str = "ord", site: str = S.SITE, only=TABLES,
                  bucketed: bool = False) -> dict:
    """The natural-key part of the load: what each table (of ``only``) would receive.

    ``batch`` holds raw review rows with ``movie_id`` and ``title``; ``target``
    maps table names to existing DataFrames (or None), all ``bucketed`` by
    ``KEYS`` or none. No surrogate ids.
    """
    records = L.review_records(batch, site=site, values=True)
    good, bad = Q.quarantine(records, rules())
    good, bad = good.drop(*L.VALUE_COLS), bad.drop(*L.VALUE_COLS)

    def rejected() -> DataFrame:
        # a rejected row is known by its movie, author, text and reasons, so a replay adds none
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("movie_id", "username", "review_text")]
        known = F.concat_ws("\n", *[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts], F.concat_ws(",", "reasons"))
        return bad.withColumn("quarantine_hash", F.sha2(known, 256))

    def movies() -> DataFrame:
        rows = batch.select(F.col("movie_id").cast("string").alias("movie_id"), "title", ord)
        return insert(rows, "movies").select(
            "movie_id", "title", S.movie_url("movie_id", site).alias("imdb_url"))

    def insert(rows: DataFrame, table: str) -> DataFrame:
        return L.insert_or_ignore(rows, target.get(table), KEYS[table], ord, bucketed)

    build = {
        "sources": lambda: insert(batch.select(S.source_url("movie_id", site).alias("source_url"), ord), "sources").drop(ord),
        "movies": movies,
        "reviewers": lambda: insert(good.select("username", ord), "reviewers").drop(ord),
        "reviews": lambda: insert(good, "reviews"),
        "quarantine": lambda: insert(rejected(), "quarantine"),
    }
    return {t: build[t]() for t in only}


def load_star(batch: DataFrame, root: str, ord: str = "ord", site: str = S.SITE,
              report_counts: bool = False, buckets: int | None = None,
              report_violations: bool = False) -> dict | None:
    """Append new rows to ``root/{sources,movies,reviewers,reviews,quarantine}``.

    With ``buckets`` the targets are bucketed and sorted by their natural keys
    (``sources.bucketed``; the number must stay the same for a root): later
    loads then compare keys without shuffling what was loaded before.

    With ``report_counts`` the rows added per table are returned, with
    ``report_violations`` also ``violations``: per rule the quarantined rows
    that broke it. Both are observed while the rows are written; nothing is
    read or counted again.
    """
    spark = batch.sparkSession
    batch = batch.persist()  # read by five writes; a lost part is computed anew
    target = {t: read_target(spark, root, t, buckets) for t in TABLES}
    plan = plan_new_rows(batch, target, ord, site, bucketed=buckets is not None)
    added: dict = {}
    now = F.current_timestamp()

    def append(name: str, df: DataFrame) -> None:
        seen = None
        if report_counts or report_violations:
            broken = {r: F.count_if(F.array_contains("reasons", r)) for r, _ in rules()} if name == "quarantine" else {}
            seen = Observation()
            df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[n.alias(r) for r, n in broken.items()])
        if buckets is not None:
            BK.append_bucketed(df, os.path.join(root, name), KEYS[name], buckets)
        else:
            df.write.mode("append").parquet(os.path.join(root, name))
        if seen is not None:
            got = seen.get
            added[name] = got.get("rows", 0)
            if broken and report_violations:
                added["violations"] = {r: got.get(r, 0) for r in broken}

    src = L.with_surrogate_id(plan["sources"], "source_id", target["sources"]).select(*L.SOURCES_COLS)
    append("sources", src)
    append("movies", plan["movies"].withColumn("created_at", now).select(*L.MOVIES_COLS))
    rev = L.with_surrogate_id(plan["reviewers"], "reviewer_id", target["reviewers"]) \
        .withColumn("created_at", now).select(*L.REVIEWERS_COLS)
    append("reviewers", rev)
    reviewers = read_target(spark, root, "reviewers")
    sources = read_target(spark, root, "sources")
    resolved = L.resolve_keys(plan["reviews"], reviewers, sources)
    reviews = L.with_surrogate_id(resolved, "review_id", target["reviews"]).select(*L.REVIEWS_COLS)
    append("reviews", reviews)
    append("quarantine", plan["quarantine"])
    batch.unpersist()
    return added or None
