"""Registered queries and their DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir)`` builds a lazy DataFrame over the driver's
parquet tables; ``ORACLE[name]`` is an independent SQL formulation of the
same result for DuckDB (tables pre-registered as views). Column names match.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import display, scalars
from .operators import metrics as M
from .plans import report
from .sources import derived

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- oracle CTEs
REVIEWS_CTE = """
reviews AS (
  SELECT l.l_partkey AS movie_id, o.o_custkey AS reviewer_id,
         CASE WHEN l.l_linenumber = 7 THEN NULL
              ELSE CAST(floor(l.l_quantity) AS INTEGER) % 10 + 1 END AS rating,
         CAST(floor(l.l_quantity) AS INTEGER) AS helpful_upvotes,
         l.l_shipdate AS scrape_timestamp
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

METRICS_CTE = REVIEWS_CTE + """,
metrics AS (
  SELECT r.movie_id, p.p_name AS title, count(*) AS review_count,
         avg(r.rating) AS avg_rating, CAST(sum(r.helpful_upvotes) AS BIGINT) AS total_upvotes
  FROM reviews r JOIN part p ON p.p_partkey = r.movie_id
  GROUP BY r.movie_id, p.p_name)"""

TOTALS_CTE = REVIEWS_CTE + """,
totals AS (
  SELECT r.reviewer_id, c.c_name AS username, count(*) AS total_reviews
  FROM reviews r JOIN customer c ON c.c_custkey = r.reviewer_id
  GROUP BY r.reviewer_id, c.c_name)"""

DIST_CTE = REVIEWS_CTE + """,
dist AS (
  SELECT rating, count(*) AS review_count FROM reviews
  WHERE rating IS NOT NULL GROUP BY rating)"""


def _star(spark, sf_dir):
    return (derived.review_fact(spark, sf_dir), derived.movies(spark, sf_dir),
            derived.reviewers(spark, sf_dir))


# ------------------------------------------------------------ report metrics
@register("A12_movie_metrics", f"WITH {METRICS_CTE} SELECT * FROM metrics")
def q_movie_metrics(spark, sf_dir):
    r, m, _ = _star(spark, sf_dir)
    return M.movie_metrics(r, m)


@register("T1_top_movies_by_rating", f"""WITH {METRICS_CTE}
SELECT * FROM metrics WHERE review_count > 5
ORDER BY avg_rating DESC NULLS LAST, movie_id LIMIT 10""")
def q_top_rating(spark, sf_dir):
    r, m, _ = _star(spark, sf_dir)
    return M.top_movies(M.movie_metrics(r, m), "avg_rating", 10, min_reviews=5)


@register("F2_movies_with_more_than_5_reviews", f"""WITH {METRICS_CTE}
SELECT * FROM metrics WHERE review_count > 5""")
def q_min_reviews(spark, sf_dir):
    r, m, _ = _star(spark, sf_dir)
    return M.movie_metrics(r, m).where(F.col("review_count") > 5)


@register("T2_top_movies_by_volume", f"""WITH {METRICS_CTE}
SELECT * FROM metrics ORDER BY review_count DESC NULLS LAST, movie_id LIMIT 10""")
def q_top_volume(spark, sf_dir):
    r, m, _ = _star(spark, sf_dir)
    return M.top_movies(M.movie_metrics(r, m), "review_count", 10)


@register("T3_top_movies_by_upvotes", f"""WITH {METRICS_CTE}
SELECT * FROM metrics ORDER BY total_upvotes DESC NULLS LAST, movie_id LIMIT 10""")
def q_top_upvotes(spark, sf_dir):
    r, m, _ = _star(spark, sf_dir)
    return M.top_movies(M.movie_metrics(r, m), "total_upvotes", 10)


@register("A13_reviewer_totals", f"WITH {TOTALS_CTE} SELECT * FROM totals")
def q_reviewer_totals(spark, sf_dir):
    r, _, u = _star(spark, sf_dir)
    return M.reviewer_totals(r, u)


@register("T4_top_reviewers", f"""WITH {TOTALS_CTE}
SELECT * FROM totals ORDER BY total_reviews DESC, reviewer_id LIMIT 10""")
def q_top_reviewers(spark, sf_dir):
    r, _, u = _star(spark, sf_dir)
    return M.top_reviewers(M.reviewer_totals(r, u), 10)


@register("A10_kpi_summary", f"""WITH {REVIEWS_CTE}
SELECT count(*) AS total_reviews, round(avg(rating), 2) AS avg_rating,
       count(DISTINCT movie_id) AS total_movies, max(scrape_timestamp) AS latest_scrape
FROM reviews""")
def q_kpi(spark, sf_dir):
    return M.kpi_summary(derived.review_fact(spark, sf_dir))


@register("A11_rating_distribution", f"WITH {DIST_CTE} SELECT * FROM dist ORDER BY rating")
def q_dist(spark, sf_dir):
    return M.rating_distribution(derived.review_fact(spark, sf_dir))


@register("A14_peak_rating", f"""WITH {DIST_CTE}
SELECT rating AS top_rating, review_count AS peak_review_count FROM dist
ORDER BY review_count DESC, rating LIMIT 1""")
def q_peak(spark, sf_dir):
    return M.peak_rating(M.rating_distribution(derived.review_fact(spark, sf_dir), sort=False))


@register("T5_ranking_leaders", f"""WITH {METRICS_CTE},
totals AS (
  SELECT r.reviewer_id, c.c_name AS username, count(*) AS total_reviews
  FROM reviews r JOIN customer c ON c.c_custkey = r.reviewer_id
  GROUP BY r.reviewer_id, c.c_name)
SELECT
  coalesce((SELECT title FROM metrics WHERE review_count > 5
            ORDER BY avg_rating DESC NULLS LAST, movie_id LIMIT 1), 'N/A') AS top_movie_rating,
  coalesce((SELECT title FROM metrics ORDER BY review_count DESC, movie_id LIMIT 1), 'N/A') AS top_movie_volume,
  coalesce((SELECT title FROM metrics ORDER BY total_upvotes DESC, movie_id LIMIT 1), 'N/A') AS top_movie_upvotes,
  coalesce((SELECT username FROM totals ORDER BY total_reviews DESC, reviewer_id LIMIT 1), 'N/A') AS top_reviewer""")
def q_leaders(spark, sf_dir):
    return report.report_datasets(*_star(spark, sf_dir))["leaders"]


@register("P16_P20_executive_summary", f"""WITH {REVIEWS_CTE}
SELECT format('{{:,}}', count(*)) || ' reviews of ' || format('{{:,}}', count(DISTINCT movie_id))
       || ' titles are loaded; the latest were collected on '
       || strftime(max(scrape_timestamp), '%B %d, %Y') || '.' AS executive_summary
FROM reviews""")
def q_exec_summary(spark, sf_dir):
    return display.executive_summary(M.kpi_summary(derived.review_fact(spark, sf_dir)))


@register("P17_kpi_display", f"""WITH {REVIEWS_CTE}
SELECT count(*) AS "Total IMDb Reviews", round(avg(rating), 2) AS "Overall Avg Rating",
       count(DISTINCT movie_id) AS "Total Movies Tracked",
       max(scrape_timestamp) AS "Latest Extraction Timestamp"
FROM reviews""")
def q_kpi_display(spark, sf_dir):
    return display.kpi_display(M.kpi_summary(derived.review_fact(spark, sf_dir)))


@register("P18_movie_scatter", f"""WITH {METRICS_CTE}
SELECT movie_id, title, review_count, avg_rating, total_upvotes FROM metrics""")
def q_scatter(spark, sf_dir):
    r, m, _ = _star(spark, sf_dir)
    return report.scatter(M.movie_metrics(r, m))


@register("P3_movie_and_source_urls", """
SELECT p_partkey AS movie_id,
       'https://www.imdb.com/title/' || CAST(p_partkey AS VARCHAR) || '/' AS imdb_url,
       'https://www.imdb.com/title/' || CAST(p_partkey AS VARCHAR) || '/reviews' AS source_url
FROM part""")
def q_urls(spark, sf_dir):
    m = derived.movies(spark, sf_dir)
    return m.select("movie_id", scalars.movie_url("movie_id").alias("imdb_url"),
                    scalars.source_url("movie_id").alias("source_url"))


# --------------------------------------------------- raw review rows (P, D, F)
from .functions import text as TX  # noqa: E402
from .operators import clean as CL  # noqa: E402
from .operators import dedup as DD  # noqa: E402
from .plans.preprocess import preprocess  # noqa: E402

_TOKENS_SQL = ", ".join("'" + t.replace("'", "''") + "'" for t in CL.NULL_TOKENS)

RAW_CTE = """
raw_reviews AS (
  SELECT doc_id AS ord,
         'tt' || lpad(substring(source, 4), 7, '0') AS movie_id,
         source AS title,
         'user_' || CAST(doc_id * 31 % 97 AS VARCHAR) AS Author,
         CASE WHEN doc_id % 11 = 0 THEN NULL
              ELSE CAST((doc_id * 7 + n_chars) % 10 + 1 AS DOUBLE) END AS Rating,
         CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'None' WHEN 2 THEN '1,234'
              WHEN 3 THEN '1.5K' WHEN 4 THEN '2M' WHEN 5 THEN 'abc'
              ELSE CAST(n_chars AS VARCHAR) END AS Helpful_upVotes,
         CASE WHEN doc_id % 5 = 0 THEN NULL ELSE CAST(doc_id % 40 AS VARCHAR) END AS Helpful_downVotes,
         CASE WHEN doc_id % 17 = 3 THEN NULL ELSE split_part(text, chr(10), 1) END AS Summary,
         CASE WHEN doc_id % 101 = 50 THEN NULL ELSE text END AS Review,
         '2026-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00+00:00' AS Scrape_Timestamp,
         'https://example.com/title/tt' || lpad(substring(source, 4), 7, '0') || '/reviews' AS Source_URL,
         'rv_' || CAST(CASE WHEN doc_id % 20 = 1 THEN doc_id - 1 ELSE doc_id END AS VARCHAR) AS Unique_ID
  FROM documents)"""

RAW_COLS = ("ord, movie_id, title, Author, Rating, Helpful_upVotes, Helpful_downVotes, Summary, "
            "Review, Scrape_Timestamp, Source_URL, Unique_ID")

# DuckDB form of functions.scalars.vote_count
_VOTE_BODY = "regexp_replace(upper(regexp_replace({c}, '^\\s+|\\s+$', '', 'g')), ',', '', 'g')"


def _vote_sql(c: str) -> str:
    s = _VOTE_BODY.format(c=c)
    body = (f"CASE WHEN right({s}, 1) IN ('K', 'M') THEN left({s}, length({s}) - 1) ELSE {s} END")
    mult = f"CASE right({s}, 1) WHEN 'K' THEN 1000.0 WHEN 'M' THEN 1000000.0 ELSE 1.0 END"
    return (f"coalesce(CASE WHEN regexp_full_match({body}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
            f"THEN TRY_CAST(trunc(TRY_CAST({body} AS DOUBLE) * {mult}) AS INTEGER) END, 0)")


FIRST_PER_REVIEW = f"""{RAW_CTE},
first_per_review AS (
  SELECT {RAW_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY Review ORDER BY ord) AS rn FROM raw_reviews) t
  WHERE rn = 1)"""

COMPLETE_CTE = FIRST_PER_REVIEW + """,
complete AS (SELECT * FROM first_per_review WHERE Review IS NOT NULL AND Summary IS NOT NULL)"""

PREPROCESSED_CTE = COMPLETE_CTE.replace(
    "SELECT *, row_number() OVER (PARTITION BY Review ORDER BY ord) AS rn FROM raw_reviews) t",
    "SELECT *, row_number() OVER (PARTITION BY Review ORDER BY ord) AS rn FROM raw_reviews "
    "WHERE Review IS NOT NULL) t") + f""",
preprocessed AS (
  SELECT ord, movie_id, title, Author,
         coalesce(Rating, (SELECT round_even(avg(Rating), 0) FROM complete)) AS Rating,
         Helpful_upVotes, Helpful_downVotes, Summary, Review, Scrape_Timestamp, Source_URL, Unique_ID
  FROM complete)"""


#: Session setting: deal the review rows over so many tasks (a caller whose table has few row groups asks for it).
PARTITIONS = "spark.cinelens.partitions"


def _raw(spark, sf_dir):
    rows, tasks = derived.review_rows(spark, sf_dir), spark.conf.get(PARTITIONS, None)
    return rows if tasks is None else rows.repartition(int(tasks))


@register("P1_vote_counts", f"""WITH {RAW_CTE}
SELECT ord, Helpful_upVotes, Helpful_downVotes,
       {_vote_sql('Helpful_upVotes')} AS upvotes, {_vote_sql('Helpful_downVotes')} AS downvotes
FROM raw_reviews""")
def q_votes(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "ord", "Helpful_upVotes", "Helpful_downVotes",
        scalars.vote_count("Helpful_upVotes").alias("upvotes"),
        scalars.vote_count("Helpful_downVotes").alias("downvotes"))


@register("P2_parse_rating", f"""WITH {RAW_CTE}
SELECT ord, CASE WHEN isnan(Rating) THEN NULL ELSE CAST(trunc(Rating) AS INTEGER) END AS rating
FROM raw_reviews""")
def q_rating(spark, sf_dir):
    return _raw(spark, sf_dir).select("ord", scalars.parse_rating("Rating").alias("rating"))


@register("P4_normalise_nulls", f"""WITH {RAW_CTE}
SELECT ord,
       CASE WHEN Helpful_upVotes IN ({_TOKENS_SQL}) THEN NULL ELSE Helpful_upVotes END AS Helpful_upVotes,
       CASE WHEN token IN ({_TOKENS_SQL}) THEN NULL ELSE token END AS token, Rating
FROM (SELECT *, ([{_TOKENS_SQL}, 'kept'])[CAST(ord % {len(CL.NULL_TOKENS) + 1} AS INTEGER) + 1] AS token FROM raw_reviews) t""")
def q_nulls(spark, sf_dir):
    # every token occurs, and one text that is none
    texts = F.array(*[F.lit(t) for t in (*CL.NULL_TOKENS, "kept")])
    token = F.get(texts, (F.col("ord") % (len(CL.NULL_TOKENS) + 1)).cast("int"))
    df = _raw(spark, sf_dir).withColumn("token", token).select("ord", "Helpful_upVotes", "token", "Rating")
    return CL.normalise_nulls(df)


@register("P5_author_from_label", f"""WITH {RAW_CTE}
SELECT ord, coalesce(split_part(label, '''s rating', 1), 'Unknown') AS author
FROM (SELECT ord, Author || '''s rating: ' || CAST(CAST(Rating AS INTEGER) AS VARCHAR) || '/10' AS label
      FROM raw_reviews) t""")
def q_author(spark, sf_dir):
    label = F.concat(F.col("Author"), F.lit("'s rating: "),
                     F.col("Rating").cast("int").cast("string"), F.lit("/10"))
    return _raw(spark, sf_dir).select("ord", scalars.author_from_label(label).alias("author"))


_HREF_SQL = ("CASE WHEN ord % 9 = 0 THEN NULL WHEN ord % 9 = 4 THEN '' "
             "ELSE '/review/' || Unique_ID || '/?ref_=tt_urv_' || CAST(ord AS VARCHAR) END")


@register("P6_unique_id", f"""WITH {RAW_CTE}, linked AS (SELECT *, {_HREF_SQL} AS href FROM raw_reviews)
SELECT ord,
       CASE WHEN href IS NOT NULL AND 'https://www.imdb.com' || split_part(href, '?', 1) <> 'https://www.imdb.com'
            THEN 'https://www.imdb.com' || split_part(href, '?', 1)
            ELSE coalesce(Author, 'None') || '_' || sha256(coalesce(Review, '')) END AS unique_id
FROM linked""")
def q_unique_id(spark, sf_dir):
    o = F.col("ord")
    href = (F.when(o % 9 == 0, F.lit(None).cast("string")).when(o % 9 == 4, F.lit(""))
            .otherwise(F.concat(F.lit("/review/"), F.col("Unique_ID"), F.lit("/?ref_=tt_urv_"),
                                o.cast("string"))))
    return _raw(spark, sf_dir).select(
        "ord", scalars.unique_id(href, F.col("Author"), F.col("Review")).alias("unique_id"))


@register("P7_review_hash", f"""WITH {RAW_CTE}
SELECT ord, md5(coalesce(movie_id, 'None') || coalesce(Author, 'None') || coalesce(Review, 'None')) AS review_hash,
       sha256(coalesce(movie_id, 'None') || coalesce(Author, 'None') || coalesce(Review, 'None')) AS review_sha256
FROM raw_reviews""")
def q_hash(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "ord", scalars.review_hash("movie_id", "Author", "Review").alias("review_hash"),
        scalars.review_hash("movie_id", "Author", "Review", algo="sha256").alias("review_sha256"))


@register("P8_clean_text", f"""WITH {RAW_CTE}
SELECT ord, trim(regexp_replace(regexp_replace(lower(coalesce(Review, '')), '[^a-z\\s]', '', 'g'),
                                '\\s+', ' ', 'g')) AS clean_review
FROM raw_reviews""")
def q_clean_text(spark, sf_dir):
    return _raw(spark, sf_dir).select("ord", TX.clean_text("Review").alias("clean_review"))


@register("P14_P15_cast_text_and_timestamp", f"""WITH {RAW_CTE}
SELECT ord, CAST(Summary AS VARCHAR) AS Summary,
       CAST(CAST(Scrape_Timestamp AS TIMESTAMPTZ) AS TIMESTAMP) AS scrape_timestamp
FROM raw_reviews""")
def q_casts(spark, sf_dir):
    return _raw(spark, sf_dir).select("ord", scalars.as_text("Summary").alias("Summary"),
                                      scalars.iso_timestamp("Scrape_Timestamp").alias("scrape_timestamp"))


@register("D1_keep_first_per_review", f"WITH {FIRST_PER_REVIEW} SELECT * FROM first_per_review")
def q_keep_first(spark, sf_dir):
    return DD.keep_first(_raw(spark, sf_dir), "Review", "ord")


@register("D2_distinct_authors", f"WITH {RAW_CTE} SELECT DISTINCT Author FROM raw_reviews")
def q_authors(spark, sf_dir):
    return DD.distinct_values(_raw(spark, sf_dir), "Author")


@register("D3_first_per_unique_id", f"""WITH {RAW_CTE}
SELECT {RAW_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY Unique_ID ORDER BY ord) AS rn FROM raw_reviews) t
WHERE rn = 1""")
def q_first_uid(spark, sf_dir):
    return DD.keep_first(_raw(spark, sf_dir), "Unique_ID", "ord")


@register("F1_drop_incomplete", f"WITH {COMPLETE_CTE} SELECT * FROM complete")
def q_complete(spark, sf_dir):
    return CL.drop_incomplete(DD.keep_first(_raw(spark, sf_dir), "Review", "ord"))


@register("F4_nonblank_texts", f"""WITH {RAW_CTE}
SELECT ord, Review FROM raw_reviews
WHERE Review IS NOT NULL AND regexp_replace(Review, '^\\s+|\\s+$', '', 'g') <> ''""")
def q_nonblank(spark, sf_dir):
    return CL.nonblank(_raw(spark, sf_dir).select("ord", "Review"), "Review")


@register("A1_fill_rating", f"WITH {PREPROCESSED_CTE} SELECT ord, Rating FROM preprocessed")
def q_fill(spark, sf_dir):
    return preprocess(_raw(spark, sf_dir)).select("ord", "Rating")


@register("E1_preprocess", f"WITH {PREPROCESSED_CTE} SELECT * FROM preprocessed")
def q_preprocess(spark, sf_dir):
    return preprocess(_raw(spark, sf_dir))


# History = reviews scraped before Jan 3; the batch is every row.
_HISTORY = "Scrape_Timestamp < '2026-01-03'"


@register("S3_known_ids", f"""WITH {RAW_CTE}
SELECT DISTINCT Unique_ID FROM raw_reviews WHERE {_HISTORY}""")
def q_known(spark, sf_dir):
    from .sources.csv import known_ids
    return known_ids(_raw(spark, sf_dir).where(_HISTORY))


_F3_SQL = f"""WITH {RAW_CTE}
SELECT {RAW_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY Unique_ID ORDER BY ord) AS rn FROM raw_reviews) t
WHERE rn = 1 AND Unique_ID NOT IN (SELECT Unique_ID FROM raw_reviews WHERE {_HISTORY})"""


@register("F3_skip_seen", _F3_SQL)
def q_skip_seen(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return DD.new_reviews(raw, raw.where(_HISTORY), "Unique_ID", "ord")


#: Buckets of the targets that the bucketed queries write.
BUCKETS = 16


@register("F3_bucketed_skip_seen", _F3_SQL)
def q_skip_seen_bucketed(spark, sf_dir):
    """History written once in buckets by its key; the batch is compared without shuffling it."""
    from .sources import bucketed as BK
    from .streaming import ingest as IG
    raw = _raw(spark, sf_dir)
    path, known = IG.fresh_dir(spark, "known"), raw.where(_HISTORY).select("Unique_ID")
    BK.append_bucketed(known, path, "Unique_ID", BUCKETS)
    return DD.new_reviews(raw, BK.open_bucketed(spark, path, known.schema, "Unique_ID", BUCKETS), "Unique_ID", "ord", by_key=True)


# A late batch of a few rows, old and new, against the history's files.
_LATE = "ord % 41 = 7"


@register("F3_skipping_by_file", f"""WITH {RAW_CTE}
SELECT {RAW_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY Unique_ID ORDER BY ord) AS rn FROM raw_reviews WHERE {_LATE}) t
WHERE rn = 1 AND Unique_ID NOT IN (SELECT Unique_ID FROM raw_reviews WHERE {_HISTORY})""")
def q_skip_by_file(spark, sf_dir):
    """History in files with Bloom filters on the key; the batch asks for its own keys."""
    from .sources import key_filters as KF
    from .streaming import ingest as IG
    raw, path = _raw(spark, sf_dir), IG.fresh_dir(spark, "history")
    KF.append_filtered(raw.where(_HISTORY), path, "Unique_ID")
    return KF.skip_known(raw.where(_LATE), path)


@register("F5_cap_at_target", f"""WITH {RAW_CTE},
fresh AS (
  SELECT {RAW_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY Unique_ID ORDER BY ord) AS rn FROM raw_reviews) t
  WHERE rn = 1 AND Unique_ID NOT IN (SELECT Unique_ID FROM raw_reviews WHERE {_HISTORY}))
SELECT * FROM fresh ORDER BY ord
LIMIT (SELECT greatest(0, 900 - count(DISTINCT Unique_ID)) FROM raw_reviews WHERE {_HISTORY})""")
def q_cap(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return DD.new_reviews(raw, raw.where(_HISTORY), "Unique_ID", "ord", target=900)


# ------------------------------------------------------------------ keywords
from .operators import keywords as KW  # noqa: E402
from .operators import lemma_rules as LM  # noqa: E402
from .session import checkpointed  # noqa: E402
from .sources import lexicons as LX  # noqa: E402

_TOKEN_SQL = TX.TOKEN.replace("'", "''")
_CLITIC_SQL = TX.CLITIC.replace("'", "''")
_STOP_SQL = LX.values_sql(LX.FIXTURE_STOPWORDS, ["token"])
_LEMMA_SQL = LX.values_sql(list(LX.FIXTURE_LEMMAS.items()), ["token", "lemma"])

_LEMMA_JOIN_SQL = _LEMMA_SQL.replace("t(token, lemma)", "l(l_tok, lemma)")


def _kw_chain(src: str) -> str:
    """CTEs docs/toks/ex/kept/lem over ``src(ord, Review)`` (starts with a comma)."""
    return f""",
kw_docs AS (SELECT ord, Review FROM {src}
         WHERE Review IS NOT NULL AND regexp_replace(Review, '^\\s+|\\s+$', '', 'g') <> ''),
kw_toks AS (SELECT ord, list_transform(regexp_extract_all(lower(Review), '{_TOKEN_SQL}'),
                                    lambda t: regexp_replace(t, '{_CLITIC_SQL}', '')) AS ts FROM kw_docs),
kw_ex AS (SELECT ord, unnest(ts) AS token, generate_subscripts(ts, 1) AS pos FROM kw_toks),
kw_kept AS (SELECT * FROM kw_ex WHERE length(token) > 2 AND length(token) < 20
         AND regexp_full_match(token, '\\p{{L}}+')
         AND token NOT IN (SELECT token FROM {_STOP_SQL})),
lem AS (SELECT k.ord, k.pos, coalesce(l.lemma, k.token) AS word
        FROM kw_kept k LEFT JOIN {_LEMMA_JOIN_SQL} ON l.l_tok = k.token),
counted AS (SELECT word, count(*) AS count, min({{'o': ord, 'p': pos}}) AS first FROM lem GROUP BY word)"""


KEYWORD_TOKENS_CTE = RAW_CTE + _kw_chain("raw_reviews")

TOP_KEYWORDS_SQL = f"""WITH {KEYWORD_TOKENS_CTE}
SELECT word, count FROM counted ORDER BY count DESC, first LIMIT 20"""


def _kw_tables(spark):
    return KW.stopwords(spark, LX.FIXTURE_STOPWORDS), KW.lemmas(spark, LX.FIXTURE_LEMMAS)


@register("P9_P10_meaningful_tokens", f"""WITH {KEYWORD_TOKENS_CTE.split(',' + chr(10) + 'kw_ex AS')[0]}
SELECT ord, list_filter(ts, lambda t: length(t) > 2 AND length(t) < 20 AND regexp_full_match(t, '\\p{{L}}+'))
       AS tokens FROM kw_toks""")
def q_tokens(spark, sf_dir):
    docs = CL.nonblank(_raw(spark, sf_dir), "Review")
    return docs.select("ord", TX.meaningful(TX.tokenize("Review")).alias("tokens"))


@register("A8_top_keywords", TOP_KEYWORDS_SQL)
def q_top_keywords(spark, sf_dir):
    stop, lem = _kw_tables(spark)
    return KW.top_keywords(_raw(spark, sf_dir), "Review", "ord", stop, lem, top_n=20).drop("rank")


@register("J5_J6_keyword_frequencies", f"""WITH {KEYWORD_TOKENS_CTE}
SELECT word, count(*) AS count FROM lem GROUP BY word""")
def q_kw_freq(spark, sf_dir):
    stop, lem = _kw_tables(spark)
    toks = KW.keyword_tokens(_raw(spark, sf_dir), "Review", "ord", stop, lem)
    return toks.groupBy(F.col("token").alias("word")).agg(F.count(F.lit(1)).alias("count"))


#: Irregular words of the registered query; a word is in its dictionary if it stands this often in the corpus.
_IRREGULAR = {"thly": ["thle"], "erer": ["erin", "er"], "thnt": ["nothing-known"]}
_KNOWN_FROM = 20


def _endings_sql(forms: str) -> str:
    made = ", ".join(f"CASE WHEN ends_with(f, '{old}') THEN left(f, length(f) - {len(old)}) || '{new}' END" for old, new in LM.NOUN_RULES)
    return f"flatten(list_transform({forms}, lambda f: list_filter([{made}], lambda x: x IS NOT NULL)))"


@register("J6_rule_lemmas", f"""WITH RECURSIVE {KEYWORD_TOKENS_CTE},
irregular AS (SELECT * FROM (VALUES {', '.join(f"('{w}', [{', '.join(repr(x) for x in [w, *v])}])" for w, v in _IRREGULAR.items())}) t(word, names)),
dict AS (SELECT token AS form FROM kw_kept GROUP BY token HAVING count(*) >= {_KNOWN_FROM}),
words AS (SELECT DISTINCT k.token, i.names FROM kw_kept k LEFT JOIN irregular i ON i.word = k.token),
tries AS (
  SELECT token, 0 AS round, coalesce(names, [token] || {_endings_sql('[token]')}) AS forms,
         CASE WHEN names IS NULL THEN {_endings_sql('[token]')} ELSE [] END AS made FROM words
  UNION ALL
  SELECT token, round + 1, {_endings_sql('made')}, {_endings_sql('made')} FROM tries WHERE len(made) > 0),
spelt AS (SELECT token, round, unnest(forms) AS form, generate_subscripts(forms, 1) AS spot FROM tries),
hits AS (SELECT s.*, row_number() OVER (PARTITION BY token ORDER BY round, length(s.form), spot) AS rn FROM spelt s JOIN dict USING (form))
SELECT token, form AS lemma FROM hits WHERE rn = 1""")
def q_rule_lemmas(spark, sf_dir):
    stop, _ = _kw_tables(spark)
    toks = KW.keyword_tokens(_raw(spark, sf_dir), "Review", "ord", stop)
    words = checkpointed(toks.groupBy("token").agg(F.count(F.lit(1)).alias("n")))      # read as words and as dictionary
    return LM.rule_lemmas(words, words.where(F.col("n") >= _KNOWN_FROM), exceptions=_IRREGULAR)


@register("P12_default_stopwords", f"""WITH {RAW_CTE}{_kw_chain('raw_reviews')},
default_stop AS (SELECT * FROM {LX.values_sql(LX.ENGLISH_STOPWORDS, ["token"])})
SELECT k.token, count(*) AS count FROM kw_ex k WHERE k.token IN (SELECT token FROM default_stop) GROUP BY k.token""")
def q_default_stopwords(spark, sf_dir):
    """How often each default stopword stands in the reviews."""
    docs = CL.nonblank(_raw(spark, sf_dir), "Review").select(F.explode(TX.tokenize("Review")).alias("token"))
    return docs.join(KW.stopwords(spark), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("count"))


_SENSE_SQL = LX.values_sql(LX.FIXTURE_SENSES, ["word", "rank", "definition", "pos", "examples"])


@register("J4_enrich_keywords", f"""{TOP_KEYWORDS_SQL.replace('SELECT word, count FROM counted ORDER BY count DESC, first LIMIT 20',
                                                               'SELECT word, count FROM counted ORDER BY count DESC, first LIMIT 20), senses AS (SELECT * FROM ' + _SENSE_SQL + ')').replace('WITH ', 'WITH kw AS (WITH ', 1)},
first_sense AS (SELECT word, arg_min({{'definition': definition, 'pos': pos, 'examples': examples[1:2]}}, rank) AS s
                FROM senses GROUP BY word)
SELECT kw.word AS name, kw.count AS value,
       CAST(to_json(CASE WHEN f.s IS NULL THEN []
            ELSE [{{'definition': f.s.definition, 'pos': f.s.pos, 'examples': f.s.examples}}] END) AS VARCHAR)
       AS categories_json
FROM kw LEFT JOIN first_sense f ON f.word = kw.word""")
def q_enrich(spark, sf_dir):
    stop, lem = _kw_tables(spark)
    kw = KW.top_keywords(_raw(spark, sf_dir), "Review", "ord", stop, lem, top_n=20)
    out = KW.enrich_keywords(kw, KW.senses(spark, LX.FIXTURE_SENSES))
    return out.select("name", "value", F.to_json("categories").alias("categories_json"))


@register("P11_lemmatize_and_remove_stopwords", f"""WITH {RAW_CTE},
cleaned AS (SELECT ord, trim(regexp_replace(regexp_replace(lower(coalesce(Review, '')), '[^a-z\\s]', '', 'g'),
                                            '\\s+', ' ', 'g')) AS c FROM raw_reviews),
words AS (SELECT ord, list_filter(string_split_regex(c, '\\s+'), lambda w: w <> '') AS ws FROM cleaned),
ex AS (SELECT ord, unnest(ws) AS token, generate_subscripts(ws, 1) AS pos FROM words),
kept AS (SELECT e.ord, e.pos, coalesce(l.lemma, e.token) AS token FROM ex e
         LEFT JOIN {_LEMMA_SQL.replace('t(token, lemma)', 'l(l_tok, lemma)')} ON l.l_tok = e.token
         WHERE e.token NOT IN (SELECT token FROM {_STOP_SQL}))
SELECT w.ord, coalesce((SELECT string_agg(k.token, ' ' ORDER BY k.pos) FROM kept k WHERE k.ord = w.ord), '') AS text
FROM words w""")
def q_lemmatize(spark, sf_dir):
    stop, lem = _kw_tables(spark)
    cleaned = _raw(spark, sf_dir).select("ord", TX.clean_text("Review").alias("c"))
    return KW.lemmatize_and_remove_stopwords(cleaned, "ord", "c", stop, lem, "text")


# ----------------------------------------------------------------- sentiment
from .functions import labels as LB  # noqa: E402
from .operators import sentiment as SN  # noqa: E402

_P = SN.PUNCT_CLASS
_LEX_SQL = LX.values_sql(list(LX.FIXTURE_LEXICON.items()), ["token", "valence"])
_BST_SQL = LX.values_sql(list(LX.FIXTURE_BOOSTERS.items()), ["token", "scalar"])
_NEG_SQL = LX.values_sql(LX.FIXTURE_NEGATIONS, ["token"])
_IDIOM_SQL = LX.values_sql(list(LX.FIXTURE_IDIOMS.items()), ["phrase", "valence"])
_C, _N = LX.C_INCR, LX.N_SCALAR


def _upper_sql(x: str) -> str:
    return f"(upper({x}) = {x} AND lower({x}) <> {x})"


def _boost_sql(k: int, v: str) -> str:
    s = (f"CASE WHEN b{k} IS NOT NULL THEN (CASE WHEN {v} < 0 THEN -b{k} ELSE b{k} END) + "
         f"(CASE WHEN {_upper_sql(f'o{k}')} AND capdiff THEN (CASE WHEN {v} > 0 THEN {_C} ELSE -{_C} END) "
         f"ELSE 0 END) ELSE 0 END")
    damp = {1: "", 2: f" * {SN.DAMP_2}", 3: f" * {SN.DAMP_3}"}[k]
    return f"(({s}){damp})"


_NEG1 = "CASE WHEN n1 THEN vb1 * {N} ELSE vb1 END"
_NEG2 = ("CASE WHEN p2 = 'never' AND p1 IN ('so', 'this') THEN vb2 * 1.25 "
         "WHEN p2 = 'without' AND p1 = 'doubt' THEN vb2 WHEN n2 THEN vb2 * {N} ELSE vb2 END")
_NEG3 = ("CASE WHEN (p3 = 'never' AND p2 IN ('so', 'this')) OR p1 IN ('so', 'this') THEN vb3 * 1.25 "
         "WHEN p3 = 'without' AND (p2 = 'doubt' OR p1 = 'doubt') THEN vb3 WHEN n3 THEN vb3 * {N} ELSE vb3 END")

SENTIMENT_CTE = f"""{RAW_CTE},
docs AS (SELECT ord AS id, coalesce(Review, '') AS text FROM raw_reviews),
w AS (SELECT id, text, list_transform(regexp_extract_all(text, '[^\\s]+'),
        lambda x: CASE WHEN length(regexp_replace(x, '^{_P}+|{_P}+$', '', 'g')) <= 2 THEN x
                       ELSE regexp_replace(x, '^{_P}+|{_P}+$', '', 'g') END) AS ws FROM docs),
feat0 AS (SELECT id, ws, len(ws) AS n,
        length(text) - length(replace(text, '!', '')) AS ep,
        length(text) - length(replace(text, '?', '')) AS qm,
        len(list_filter(ws, lambda x: {_upper_sql('x')})) AS ncaps,
        coalesce(list_position(list_transform(ws, lambda x: lower(x)), '{LX.FIXTURE_CONTRAST}') - 1, -1) AS bi
      FROM w),
feat AS (SELECT id, ws, n, bi, ncaps > 0 AND ncaps < n AS capdiff,
        least(ep, 4) * 0.292 + CASE WHEN qm > 1 THEN (CASE WHEN qm <= 3 THEN qm * 0.18 ELSE 0.96 END) ELSE 0 END AS amp
      FROM feat0),
ex AS (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM feat),
ctx AS (SELECT id, i, w, lower(w) AS lw,
        lag(w, 1) OVER win AS o1, lag(w, 2) OVER win AS o2, lag(w, 3) OVER win AS o3,
        lower(lead(w, 1) OVER win) AS nx, lower(lead(w, 2) OVER win) AS nx2
      FROM ex WINDOW win AS (PARTITION BY id ORDER BY i)),
lex AS (SELECT token, valence FROM {_LEX_SQL}),
bst AS (SELECT token, scalar FROM {_BST_SQL}),
ngt AS (SELECT token FROM {_NEG_SQL}),
phr AS (SELECT phrase, max(iv) AS iv, max(ib) AS ib FROM (
        SELECT phrase, valence AS iv, CAST(NULL AS DOUBLE) AS ib FROM {_IDIOM_SQL}
        UNION ALL SELECT token, NULL, scalar FROM bst WHERE contains(token, ' ')) u GROUP BY phrase),
hits AS (SELECT c.id, c.i, c.w, c.lw, c.nx, c.nx2, c.o1, c.o2, c.o3,
        lower(c.o1) AS p1, lower(c.o2) AS p2, lower(c.o3) AS p3, lex.valence AS val,
        EXISTS (SELECT 1 FROM bst WHERE bst.token = c.lw) AS is_booster,
        coalesce(lower(c.o1) IN (SELECT token FROM lex), FALSE) AS l1,
        coalesce(lower(c.o2) IN (SELECT token FROM lex), FALSE) AS l2,
        coalesce(lower(c.o3) IN (SELECT token FROM lex), FALSE) AS l3,
        (SELECT scalar FROM bst WHERE bst.token = lower(c.o1)) AS b1,
        (SELECT scalar FROM bst WHERE bst.token = lower(c.o2)) AS b2,
        (SELECT scalar FROM bst WHERE bst.token = lower(c.o3)) AS b3,
        coalesce(lower(c.o1) IN (SELECT token FROM ngt) OR contains(lower(c.o1), 'n''t'), FALSE) AS n1,
        coalesce(lower(c.o2) IN (SELECT token FROM ngt) OR contains(lower(c.o2), 'n''t'), FALSE) AS n2,
        coalesce(lower(c.o3) IN (SELECT token FROM ngt) OR contains(lower(c.o3), 'n''t'), FALSE) AS n3
      FROM ctx c JOIN lex ON lex.token = c.lw),
s0 AS (SELECT h.*, f.capdiff, f.bi,
        CASE WHEN {_upper_sql('h.w')} AND f.capdiff THEN (CASE WHEN val > 0 THEN val + {_C} ELSE val - {_C} END)
             ELSE val END AS v0
      FROM hits h JOIN feat f ON f.id = h.id),
s1a AS (SELECT *, v0 + {_boost_sql(1, 'v0')} AS vb1 FROM s0),
s1 AS (SELECT *, CASE WHEN i >= 1 AND NOT l1 THEN {_NEG1.format(N=_N)} ELSE v0 END AS v1 FROM s1a),
s2a AS (SELECT *, v1 + {_boost_sql(2, 'v1')} AS vb2 FROM s1),
s2 AS (SELECT *, CASE WHEN i >= 2 AND NOT l2 THEN {_NEG2.format(N=_N)} ELSE v1 END AS v2 FROM s2a),
s3a AS (SELECT *, v2 + {_boost_sql(3, 'v2')} AS vb3 FROM s2),
s3 AS (SELECT *, CASE WHEN i >= 3 AND NOT l3 THEN {_NEG3.format(N=_N)} ELSE v2 END AS v3 FROM s3a),
s3i AS (SELECT *, CASE WHEN i >= 3 AND NOT l3 THEN
          coalesce((SELECT iv FROM phr WHERE phrase = lw || ' ' || nx || ' ' || nx2),
                   (SELECT iv FROM phr WHERE phrase = lw || ' ' || nx),
                   (SELECT iv FROM phr WHERE phrase = p1 || ' ' || lw),
                   (SELECT iv FROM phr WHERE phrase = p2 || ' ' || p1 || ' ' || lw),
                   (SELECT iv FROM phr WHERE phrase = p2 || ' ' || p1),
                   (SELECT iv FROM phr WHERE phrase = p3 || ' ' || p2 || ' ' || p1),
                   (SELECT iv FROM phr WHERE phrase = p3 || ' ' || p2), v3)
          + coalesce((SELECT ib FROM phr WHERE phrase = p3 || ' ' || p2 || ' ' || p1), 0)
          + coalesce((SELECT ib FROM phr WHERE phrase = p3 || ' ' || p2), 0)
          + coalesce((SELECT ib FROM phr WHERE phrase = p2 || ' ' || p1), 0)
        ELSE v3 END AS v3i FROM s3),
s4 AS (SELECT *, CASE WHEN i > 1 AND NOT l1 AND p1 = 'least'
                      THEN (CASE WHEN p2 <> 'at' AND p2 <> 'very' THEN v3i * {_N} ELSE v3i END)
                      WHEN i > 0 AND NOT l1 AND p1 = 'least' THEN v3i * {_N} ELSE v3i END AS v4 FROM s3i),
s5 AS (SELECT *, CASE WHEN is_booster OR (lw = 'kind' AND nx = 'of') THEN 0.0 ELSE v4 END AS v5 FROM s4),
valences AS (SELECT id, i, w AS word,
        CASE WHEN bi >= 0 AND i < bi THEN v5 * 0.5 WHEN bi >= 0 AND i > bi THEN v5 * 1.5 ELSE v5 END AS valence
      FROM s5),
agg AS (SELECT id, sum(valence) AS s, sum(CASE WHEN valence > 0 THEN valence + 1 END) AS ps,
        sum(CASE WHEN valence < 0 THEN valence - 1 END) AS ns,
        count(*) FILTER (WHERE valence > 0) AS np, count(*) FILTER (WHERE valence < 0) AS nn
      FROM valences GROUP BY id),
j AS (SELECT f.id, f.n, f.amp, coalesce(a.s, 0) AS s, coalesce(a.ps, 0) AS ps, coalesce(a.ns, 0) AS ns,
        CAST(f.n - coalesce(a.np, 0) - coalesce(a.nn, 0) AS DOUBLE) AS neu
      FROM feat f LEFT JOIN agg a ON a.id = f.id),
k AS (SELECT *, CASE WHEN s > 0 THEN s + amp WHEN s < 0 THEN s - amp ELSE s END AS s2,
        CASE WHEN ps > abs(ns) THEN ps + amp ELSE ps END AS ps2,
        CASE WHEN ps < abs(ns) THEN ns - amp ELSE ns END AS ns2 FROM j),
scores AS (SELECT id AS ord,
        CASE WHEN n > 0 THEN round_even(greatest(least(s2 / sqrt(s2 * s2 + 15.0), 1.0), -1.0), 4) + 0.0 ELSE 0.0 END AS Compound,
        CASE WHEN n > 0 THEN round_even(abs(ns2 / (ps2 + abs(ns2) + neu)), 3) + 0.0 ELSE 0.0 END AS Negative,
        CASE WHEN n > 0 THEN round_even(abs(neu / (ps2 + abs(ns2) + neu)), 3) + 0.0 ELSE 0.0 END AS Neutral,
        CASE WHEN n > 0 THEN round_even(abs(ps2 / (ps2 + abs(ns2) + neu)), 3) + 0.0 ELSE 0.0 END AS Positive
      FROM k)"""


def _sent_tables(spark):
    return (SN.lexicon_table(spark, LX.FIXTURE_LEXICON), SN.booster_table(spark, LX.FIXTURE_BOOSTERS),
            SN.negation_table(spark, LX.FIXTURE_NEGATIONS))


def _idioms(spark):
    return SN.idiom_table(spark, LX.FIXTURE_IDIOMS)


def _scored(spark, sf_dir):
    lex, bst, ngt = _sent_tables(spark)
    raw = _raw(spark, sf_dir).select("ord", "Review")
    return SN.sentiment_scores(raw, "ord", "Review", lex, bst, ngt, contrast=LX.FIXTURE_CONTRAST,
                               idioms=_idioms(spark))


@register("A9_sentiment_scores", f"WITH {SENTIMENT_CTE} SELECT * FROM scores")
def q_sentiment(spark, sf_dir):
    return _scored(spark, sf_dir).select("ord", "Compound", "Negative", "Neutral", "Positive")


@register("J7_word_valences", f"WITH {SENTIMENT_CTE} SELECT id AS ord, i, word, valence FROM valences")
def q_valences(spark, sf_dir):
    lex, bst, ngt = _sent_tables(spark)
    vals = SN.word_valences(_raw(spark, sf_dir), "ord", "Review", lex, bst, ngt,
                            contrast=LX.FIXTURE_CONTRAST, idioms=_idioms(spark))
    return vals.select(F.col("__id").alias("ord"), "i", "word", "valence")


@register("P13_sentiment_labels", f"""WITH {SENTIMENT_CTE}
SELECT ord, Compound, CASE WHEN isnan(Compound) THEN 'neutral' WHEN Compound > 0.05 THEN 'positive'
                           WHEN Compound < -0.05 THEN 'negative' ELSE 'neutral' END AS Sentiment_label
FROM scores""")
def q_labels(spark, sf_dir):
    return LB.add_sentiment_labels(_scored(spark, sf_dir).select("ord", "Compound"))


# ---------------------------------------------------------- stats and flows
from .operators import stats as ST  # noqa: E402
from .plans import analyze as AN  # noqa: E402

LABELLED_CTE = PREPROCESSED_CTE + SENTIMENT_CTE[len(RAW_CTE):] + """,
labelled AS (
  SELECT p.*, s.Compound, s.Negative, s.Neutral, s.Positive,
         CASE WHEN isnan(s.Compound) THEN 'neutral' WHEN s.Compound > 0.05 THEN 'positive'
              WHEN s.Compound < -0.05 THEN 'negative' ELSE 'neutral' END AS Sentiment_label
  FROM preprocessed p JOIN scores s ON s.ord = p.ord)"""


def _analyzed(spark, sf_dir):
    lex, bst, ngt = _sent_tables(spark)
    stop, lem = _kw_tables(spark)
    return AN.analyze(_raw(spark, sf_dir), lex, "ord", bst, ngt, LX.FIXTURE_CONTRAST, stop, lem,
                      KW.senses(spark, LX.FIXTURE_SENSES), idioms=_idioms(spark))


def _labelled(spark, sf_dir):
    scored, _ = _analyzed(spark, sf_dir)
    return LB.add_sentiment_labels(scored)


@register("E2_analyze", f"WITH {LABELLED_CTE} SELECT * EXCLUDE (Sentiment_label) FROM labelled")
def q_analyze(spark, sf_dir):
    return _analyzed(spark, sf_dir)[0]


@register("A2_sentiment_counts", f"""WITH {LABELLED_CTE}
SELECT Sentiment_label, count(*) AS count FROM labelled GROUP BY Sentiment_label""")
def q_sent_counts(spark, sf_dir):
    return ST.sentiment_counts(_labelled(spark, sf_dir))


@register("A3_average_rating", f"""WITH {LABELLED_CTE}
SELECT round_even(avg(Rating), 1) AS avg_rating FROM labelled""")
def q_avg(spark, sf_dir):
    return ST.average_rating(_labelled(spark, sf_dir))


@register("A4_T6_rating_counts", f"""WITH {LABELLED_CTE}
SELECT Rating, count(*) AS count FROM labelled WHERE Rating IS NOT NULL GROUP BY Rating ORDER BY Rating""")
def q_rating_counts(spark, sf_dir):
    return ST.rating_counts(_labelled(spark, sf_dir))


@register("A5_rating_by_sentiment", f"""WITH {LABELLED_CTE}
SELECT Sentiment_label, avg(Rating) AS avg_rating FROM labelled GROUP BY Sentiment_label""")
def q_rating_by_sent(spark, sf_dir):
    return ST.rating_by_sentiment(_labelled(spark, sf_dir))


@register("A6_total_reviews", f"WITH {LABELLED_CTE} SELECT count(*) AS total_reviews FROM labelled")
def q_total(spark, sf_dir):
    return ST.total_reviews(_labelled(spark, sf_dir))


@register("A7_grouped_stats", f"""WITH {LABELLED_CTE}
SELECT CASE grouping(Sentiment_label, Rating) WHEN 1 THEN 'label' WHEN 2 THEN 'rating' ELSE 'total' END AS set,
       Sentiment_label AS label, Rating AS rating, count(*) AS count, avg(Rating) AS avg_rating
FROM labelled GROUP BY GROUPING SETS ((Sentiment_label), (Rating), ())""")
def q_grouped(spark, sf_dir):
    return ST.grouped_stats(_labelled(spark, sf_dir))


@register("E3_P19_inference_summary", f"""WITH {LABELLED_CTE}{_kw_chain('labelled')},
stats AS (SELECT count(*) AS total_reviews, round_even(avg(Rating), 1) AS avg_rating,
                 count(*) FILTER (WHERE Sentiment_label = 'positive') AS npos,
                 count(*) FILTER (WHERE Sentiment_label = 'negative') AS nneg FROM labelled),
top AS (SELECT word FROM counted ORDER BY count DESC, first LIMIT 1)
SELECT total_reviews, avg_rating,
       '⭐ Avg ' || CAST(avg_rating AS VARCHAR) || '/10. ' ||
       CASE WHEN npos > nneg THEN 'Overall positive audience reception.'
            WHEN nneg > npos THEN 'Overall negative audience reception.' ELSE 'Mixed audience reception.' END ||
       coalesce(' Common theme: ' || (SELECT word FROM top) || '.', '') AS summary
FROM stats""")
def q_infer(spark, sf_dir):
    scored, kws = _analyzed(spark, sf_dir)
    result, _ = AN.infer(scored, kws)
    return result.select("total_reviews", "avg_rating", "summary")


# ------------------------------------------------------ star load and quality
from .operators import load as LD  # noqa: E402
from .operators import lookup as LK  # noqa: E402
from .operators import quality as QC  # noqa: E402
from .plans import star as SR  # noqa: E402

_SITE = scalars.SITE


def _vote_value_sql(c: str) -> str:
    return _vote_sql(c).replace("coalesce(", "", 1).replace(" AS INTEGER) END, 0)", " AS DOUBLE) END")


def _records_sql(src: str) -> str:
    """CTEs records, checked (with reasons) and good over ``src``."""
    return f""",
records AS (
  SELECT ord, movie_id, Author AS username,
         '{_SITE}/title/' || movie_id || '/reviews' AS source_url,
         CASE WHEN isnan(Rating) THEN NULL ELSE TRY_CAST(trunc(Rating) AS SMALLINT) END AS rating,
         {_vote_sql('Helpful_upVotes')} AS helpful_upvotes,
         {_vote_sql('Helpful_downVotes')} AS helpful_downvotes,
         Summary AS summary, Review AS review_text,
         md5(coalesce(movie_id, 'None') || coalesce(Author, 'None') || coalesce(Review, 'None')) AS review_hash,
         CAST(TRY_CAST(Scrape_Timestamp AS TIMESTAMPTZ) AS TIMESTAMP) AS scrape_timestamp,
         Scrape_Timestamp < '2026-01-03' AS in_history,
         concat_ws(',', CASE WHEN Author IS NULL THEN 'username is null' END,
           CASE WHEN Review IS NULL THEN 'review_text is null' END,
           CASE WHEN TRY_CAST(Scrape_Timestamp AS TIMESTAMPTZ) IS NULL THEN 'scrape_timestamp is null' END,
           CASE WHEN Rating < 1 OR Rating > 10 THEN 'rating_value outside [1, 10]' END,
           CASE WHEN {_vote_value_sql('Helpful_upVotes')} NOT BETWEEN 0 AND 2147483647 THEN 'upvotes_value outside [0, 2147483647]' END,
           CASE WHEN {_vote_value_sql('Helpful_downVotes')} NOT BETWEEN 0 AND 2147483647 THEN 'downvotes_value outside [0, 2147483647]' END)
         AS reasons
  FROM {src}),
good AS (SELECT * FROM records WHERE reasons = '')"""


RECORDS_CTE = RAW_CTE + _records_sql("raw_reviews")

# Rows that break every rule of the load, one rule or several at a time.
DIRTY_CTE = RAW_CTE + """,
dirty AS (SELECT * REPLACE (
    CASE WHEN ord % 13 = 5 THEN 70000.0 WHEN ord % 13 = 6 THEN 0.0 ELSE Rating END AS Rating,
    CASE WHEN ord % 11 = 4 THEN '3000M' ELSE Helpful_upVotes END AS Helpful_upVotes,
    CASE WHEN ord % 17 = 6 THEN '-5' ELSE Helpful_downVotes END AS Helpful_downVotes,
    CASE WHEN ord % 19 = 7 THEN NULL ELSE Author END AS Author,
    CASE WHEN ord % 23 = 8 THEN 'no date' ELSE Scrape_Timestamp END AS Scrape_Timestamp) FROM raw_reviews)"""


def _dirty(spark, sf_dir):
    o = F.col("ord")
    return _raw(spark, sf_dir).withColumns({
        "Rating": F.when(o % 13 == 5, 70000.0).when(o % 13 == 6, 0.0).otherwise(F.col("Rating")),
        "Helpful_upVotes": F.when(o % 11 == 4, "3000M").otherwise(F.col("Helpful_upVotes")),
        "Helpful_downVotes": F.when(o % 17 == 6, "-5").otherwise(F.col("Helpful_downVotes")),
        "Author": F.when(o % 19 != 7, F.col("Author")),
        "Scrape_Timestamp": F.when(o % 23 == 8, "no date").otherwise(F.col("Scrape_Timestamp"))})


_REC_COLS = ("ord, movie_id, username, source_url, rating, helpful_upvotes, helpful_downvotes, summary, "
             "review_text, review_hash, scrape_timestamp")


def _first_sql(rel: str, key: str, cols: str) -> str:
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ord) AS rn "
            f"FROM {rel} WHERE {key} IS NOT NULL) t WHERE rn = 1")


def _star_plan(spark, sf_dir, table):
    raw = _raw(spark, sf_dir)
    history = SR.plan_new_rows(raw.where(_HISTORY), {}, only=[table])
    return SR.plan_new_rows(raw, history, only=[table])[table]


_J3D_SQL = f"""WITH {RECORDS_CTE},
hist AS (SELECT review_hash FROM good WHERE in_history),
firsts AS ({_first_sql('good', 'review_hash', _REC_COLS)})
SELECT * FROM firsts WHERE review_hash NOT IN (SELECT review_hash FROM hist)"""


@register("J3d_E4_new_reviews", _J3D_SQL)
def q_new_reviews(spark, sf_dir):
    return _star_plan(spark, sf_dir, "reviews")


@register("J3d_bucketed_new_reviews", _J3D_SQL)
def q_new_reviews_bucketed(spark, sf_dir):
    """The same against a target that an earlier load wrote in buckets by review_hash."""
    root, raw = IG.fresh_dir(spark, "star"), _raw(spark, sf_dir)
    SR.load_star(raw.where(_HISTORY), root, buckets=BUCKETS)
    target = {"reviews": SR.read_target(spark, root, "reviews", BUCKETS)}
    return SR.plan_new_rows(raw, target, only=["reviews"], bucketed=True)["reviews"]


@register("J3c_D2_new_reviewers", f"""WITH {RECORDS_CTE}
SELECT DISTINCT username FROM good
WHERE username NOT IN (SELECT username FROM good WHERE in_history)""")
def q_new_reviewers(spark, sf_dir):
    return _star_plan(spark, sf_dir, "reviewers")


@register("J3b_new_movies", f"""WITH {RAW_CTE},
firsts AS ({_first_sql('raw_reviews', 'movie_id', 'ord, movie_id, title, Scrape_Timestamp')})
SELECT movie_id, title, '{_SITE}/title/' || movie_id || '/' AS imdb_url FROM firsts
WHERE movie_id NOT IN (SELECT movie_id FROM raw_reviews WHERE Scrape_Timestamp < '2026-01-03')""")
def q_new_movies(spark, sf_dir):
    return _star_plan(spark, sf_dir, "movies")


@register("J3a_new_sources", f"""WITH {RAW_CTE},
urls AS (SELECT '{_SITE}/title/' || movie_id || '/reviews' AS source_url, Scrape_Timestamp FROM raw_reviews)
SELECT DISTINCT source_url FROM urls
WHERE source_url NOT IN (SELECT source_url FROM urls WHERE Scrape_Timestamp < '2026-01-03')""")
def q_new_sources(spark, sf_dir):
    return _star_plan(spark, sf_dir, "sources")


@register("Q3_E4_quarantined_rows", f"""WITH {DIRTY_CTE}{_records_sql('dirty')}
SELECT {_REC_COLS}, reasons FROM (SELECT *, row_number() OVER (
  PARTITION BY movie_id, username, review_text, reasons ORDER BY ord) AS rn FROM records WHERE reasons <> '') t WHERE rn = 1""")
def q_quarantine(spark, sf_dir):
    bad = SR.plan_new_rows(_dirty(spark, sf_dir), {}, only=["quarantine"])["quarantine"]
    return bad.withColumn("reasons", F.concat_ws(",", "reasons")).drop("quarantine_hash")


@register("E4_Q3_Q4_load_metrics", f"""WITH {DIRTY_CTE}{_records_sql('dirty')},
bad AS (SELECT reasons FROM (SELECT *, row_number() OVER (
  PARTITION BY movie_id, username, review_text, reasons ORDER BY ord) AS rn FROM records WHERE reasons <> '') t WHERE rn = 1),
rules(rule) AS (VALUES ('username is null'), ('review_text is null'), ('scrape_timestamp is null'), ('rating_value outside [1, 10]'),
  ('upvotes_value outside [0, {SR.MAX_INT}]'), ('downvotes_value outside [0, {SR.MAX_INT}]'))
SELECT 'reviews' AS metric, (SELECT count(DISTINCT review_hash) FROM records WHERE reasons = '') AS n
UNION ALL SELECT 'reviewers', (SELECT count(DISTINCT username) FROM records WHERE reasons = '')
UNION ALL SELECT 'sources', (SELECT count(DISTINCT source_url) FROM records)
UNION ALL SELECT 'movies', (SELECT count(DISTINCT movie_id) FROM records)
UNION ALL SELECT 'quarantine', (SELECT count(*) FROM bad)
UNION ALL SELECT rule, (SELECT count(*) FROM bad WHERE contains(reasons, rule)) FROM rules""")
def q_load_metrics(spark, sf_dir):
    """Rows added and rules broken, as observed by the load itself."""
    got = SR.load_star(_dirty(spark, sf_dir), IG.fresh_dir(spark, "metrics"), report_counts=True, report_violations=True)
    rows = [*got.pop("violations").items(), *got.items()]
    return LK.local_table(spark, rows, "metric string, n long")


@register("J1_J2_resolve_keys", f"""WITH {RECORDS_CTE},
reviewers AS (SELECT DISTINCT username, CAST(substring(username, 6) AS BIGINT) AS reviewer_id FROM good
              WHERE username NOT LIKE '%3'),
sources AS (SELECT DISTINCT source_url, CAST(split_part(source_url, '/', 5)[3:] AS BIGINT) AS source_id FROM good
            WHERE source_url NOT LIKE '%5/reviews')
SELECT g.ord, r.reviewer_id, s.source_id FROM good g
JOIN reviewers r ON r.username = g.username JOIN sources s ON s.source_url = g.source_url""")
def q_resolve(spark, sf_dir):
    good, _ = QC.quarantine(LD.review_records(_raw(spark, sf_dir), values=True), SR.rules())
    # dimensions that lack some keys: the inner joins drop their rows
    reviewers = good.select("username").distinct().withColumn(
        "reviewer_id", F.expr("substring(username, 6)").cast("long")).where("username NOT LIKE '%3'")
    sources = good.select("source_url").distinct().withColumn(
        "source_id", F.expr("substring(split_part(source_url, '/', 5), 3)").cast("long")).where(
        "source_url NOT LIKE '%5/reviews'")
    return LD.resolve_keys(good, reviewers, sources).select("ord", "reviewer_id", "source_id")


@register("Q1_duplicate_titles", """
SELECT p_name AS title, count(*) AS count FROM part GROUP BY p_name HAVING count(*) > 1""")
def q_dup_titles(spark, sf_dir):
    return QC.check_unique(derived.movies(spark, sf_dir), "title")


# A batch that holds the history again, as after a second scrape of the same pages.
AGAIN_CTE = RAW_CTE + """,
again AS (SELECT * FROM raw_reviews UNION ALL
          SELECT * REPLACE (ord + 10000000000 AS ord) FROM raw_reviews WHERE Scrape_Timestamp < '2026-01-03')"""


def _again(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return raw.unionAll(raw.where(_HISTORY).withColumn("ord", F.col("ord") + 10_000_000_000))


@register("Q1_duplicate_review_hashes", f"""WITH {AGAIN_CTE}{_records_sql('again')}
SELECT review_hash, count(*) AS count FROM records GROUP BY review_hash HAVING count(*) > 1""")
def q_dup_hash(spark, sf_dir):
    return QC.check_unique(LD.review_records(_again(spark, sf_dir)), "review_hash")


@register("Q2_orphan_review_keys", f"""WITH {REVIEWS_CTE}
SELECT 'movie_id' AS fk, movie_id AS key FROM reviews
WHERE movie_id NOT IN (SELECT p_partkey FROM part WHERE p_name NOT LIKE '%a')
UNION ALL
SELECT 'reviewer_id' AS fk, reviewer_id AS key FROM reviews
WHERE reviewer_id NOT IN (SELECT c_custkey FROM customer WHERE c_name NOT LIKE '%7')""")
def q_orphans(spark, sf_dir):
    r, m, u = _star(spark, sf_dir)
    # parents that lack some of the keys, so that orphans exist
    m, u = m.where("title NOT LIKE '%a'"), u.where("username NOT LIKE '%7'")
    a = QC.check_fk(r, "movie_id", m).select(F.lit("movie_id").alias("fk"), F.col("movie_id").alias("key"))
    b = QC.check_fk(r, "reviewer_id", u).select(F.lit("reviewer_id").alias("fk"), F.col("reviewer_id").alias("key"))
    return a.unionByName(b)


@register("Q3_null_counts", f"""WITH {RECORDS_CTE}
SELECT * FROM (
  SELECT 'username' AS column, count(*) FILTER (WHERE username IS NULL) AS null_count FROM records UNION ALL
  SELECT 'rating', count(*) FILTER (WHERE rating IS NULL) FROM records UNION ALL
  SELECT 'summary', count(*) FILTER (WHERE summary IS NULL) FROM records UNION ALL
  SELECT 'review_text', count(*) FILTER (WHERE review_text IS NULL) FROM records UNION ALL
  SELECT 'scrape_timestamp', count(*) FILTER (WHERE scrape_timestamp IS NULL) FROM records)""")
def q_nulls_check(spark, sf_dir):
    recs = LD.review_records(_raw(spark, sf_dir))
    return QC.check_not_null(recs, ["username", "rating", "summary", "review_text", "scrape_timestamp"])


@register("Q4_rating_out_of_range", f"""WITH {REVIEWS_CTE}
SELECT * FROM reviews WHERE rating IS NOT NULL AND (rating < 2 OR rating > 9)""")
def q_range(spark, sf_dir):
    return QC.check_range(derived.review_fact(spark, sf_dir), "rating", 2, 9)


# ---------------------------------------------------------------- extraction
from .sources import pages as PG  # noqa: E402
from .sources import suggest as SG  # noqa: E402
from .sources.tables import read_table  # noqa: E402

# Selectors for the driver's pages: one card per page, the whole article its
# text (fields absent on these pages fall back to the reference defaults).
PAGE_SELECTORS = {"card": "body", "link": "h1", "review": "article", "author": "span.author",
                  "rating": "span.rating", "up": "span.up", "down": "span.down"}


@register("S8b_page_fields", f"""
SELECT page_id, url, regexp_extract(html, '{PG.TITLE_RE}', 1) AS title,
       regexp_extract_all(html, '{PG.LINK_RE}', 1) AS links,
       CAST(len(regexp_extract_all(html, '{PG.LINK_RE}', 1)) AS INTEGER) AS n_links
FROM pages""")
def q_page_fields(spark, sf_dir):
    return PG.page_fields(read_table(spark, sf_dir, "pages"))


@register("S8_extract_review_cards")
def q_cards(spark, sf_dir):
    return PG.extract_reviews(read_table(spark, sf_dir, "pages"), PAGE_SELECTORS).drop("Scrape_Timestamp")


_CARD = '<div class="ipc-list-card" data-testid="review-card-parent">'


def _render_cards(raw):
    """Review rows as card HTML: escaped texts, missing fields, unclosed tags, scripts that hold markup."""
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    part = lambda *x: F.coalesce(F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x]), F.lit(""))
    html = F.concat(
        F.lit("<html><script>var s = '" + _CARD + "';</script><p>unclosed <b>" + _CARD),
        part('<span class="x ipc-rating-star--otherUserAlt" aria-label="', F.col("Author"), "'s rating: 8\"></span>"),
        part('<span class="ipc-rating-star--rating">', F.col("Rating").cast("int").cast("string"), "</span>"),
        part('<a class="ipc-title-link-wrapper" href="/review/', F.col("Unique_ID"), '/?ref_=x">', esc(F.col("Summary")), "</a>"),
        part('<div class="ipc-html-content-inner-div">', esc(F.col("Review")), "<script>if (a < b) c('</span>')</script></div>"),
        part('<span class="ipc-voting__label__count--up">', F.col("Helpful_upVotes"), "</span>"),
        part('<span class="ipc-voting__label__count--down">', F.col("Helpful_downVotes"), "</span></div>"))
    return raw.select(F.col("ord").alias("page_id"), F.col("Source_URL").alias("url"), html.alias("html"))


def _strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


_RENDERED_SQL = f"""WITH {RAW_CTE}
SELECT ord AS page_id, Author, coalesce(CAST(CAST(Rating AS INTEGER) AS VARCHAR), 'NaN') AS Rating,
       coalesce({_strip_sql('Helpful_upVotes')}, '0') AS Helpful_upVotes,
       coalesce({_strip_sql('Helpful_downVotes')}, '0') AS Helpful_downVotes,
       coalesce({_strip_sql('Summary')}, '') AS Summary, coalesce({_strip_sql('Review')}, '') AS Review, Source_URL,
       CASE WHEN Summary IS NOT NULL THEN '{scalars.SITE}/review/' || Unique_ID || '/' ELSE Author || '_' END AS Unique_ID
FROM raw_reviews"""


def _rendered(got):
    # without a link the id ends in a hash of the card's text
    uid = F.regexp_replace("Unique_ID", "_[0-9a-f]{64}$", "_")
    return got.select(F.col("ord.page_id").alias("page_id"), "Author", "Rating", "Helpful_upVotes", "Helpful_downVotes",
                      "Summary", "Review", "Source_URL", uid.alias("Unique_ID"))


@register("S8_rendered_review_cards", _RENDERED_SQL)
def q_rendered_cards(spark, sf_dir):
    return _rendered(PG.extract_reviews(_render_cards(_raw(spark, sf_dir))))


@register("S8_lateral_review_cards", _RENDERED_SQL)
def q_lateral_cards(spark, sf_dir):
    return _rendered(PG.review_fields(PG.cards_by_sql(_render_cards(_raw(spark, sf_dir)))))


_SUGGEST_SQL = """CASE WHEN event_type = 'view' THEN props ELSE
  '{"d": [' || (CASE WHEN event_type = 'click' THEN '' ELSE
     '{"id": "nm' || CAST(user_id AS VARCHAR) || '", "l": "' || event_type || '"}, ' END)
  || '{"id": "' || (CASE WHEN k % 3 = 0 THEN 'co' ELSE 'tt' END) || lpad(CAST(k AS VARCHAR), 7, '0')
  || '", "l": "title ' || CAST(k AS VARCHAR) || '"}]}' END"""


@register("S9_resolve_movie_id", f"""
WITH ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
docs AS (SELECT event_id, {_SUGGEST_SQL} AS doc FROM ev),
parsed AS (SELECT event_id, list_filter(from_json(doc, '{{"d": [{{"id": "VARCHAR", "l": "VARCHAR"}}]}}').d,
                                       lambda x: starts_with(x.id, 'tt')) AS hits FROM docs)
SELECT event_id, hits[1].id AS movie_id, hits[1].l AS title FROM parsed""")
def q_suggest(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("int"))
    et, k = F.col("event_type"), F.col("k")
    other = F.when(et == "click", F.lit("")).otherwise(F.concat(
        F.lit('{"id": "nm'), F.col("user_id").cast("string"), F.lit('", "l": "'), et, F.lit('"}, ')))
    doc = F.when(et == "view", F.col("props")).otherwise(F.concat(
        F.lit('{"d": ['), other, F.lit('{"id": "'), F.when(k % 3 == 0, F.lit("co")).otherwise(F.lit("tt")),
        F.lpad(k.cast("string"), 7, "0"), F.lit('", "l": "title '), k.cast("string"), F.lit('"}]}')))
    docs = ev.select("event_id", doc.alias("doc"))
    return docs.select("event_id", SG.resolve_movie_id("doc").alias("movie_id"),
                       SG.resolve_title("doc").alias("title"))


# ----------------------------------------------------------------- streaming
import os as _os  # noqa: E402

from pyspark.sql import types as _T  # noqa: E402

from .streaming import ingest as IG  # noqa: E402
from .streaming import keyed as KS  # noqa: E402

_DOC_SCHEMA = _T.StructType([_T.StructField("doc_id", _T.LongType()), _T.StructField("text", _T.StringType()),
                             _T.StructField("lang", _T.StringType()), _T.StructField("source", _T.StringType()),
                             _T.StructField("n_chars", _T.LongType())])


def _stream_documents(spark, sf_dir, target=None, **kw):
    out = IG.fresh_dir(spark, "reviews")
    return IG.run_ingest(spark, _os.path.join(sf_dir, "documents*.parquet"), out, fmt="parquet",
                         schema=_DOC_SCHEMA, transform=derived.review_rows_from, target=target,
                         checkpoint=out + "-ckpt", **kw)


_D3_SQL = f"""WITH {RAW_CTE}
SELECT {RAW_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY Unique_ID ORDER BY ord) AS rn FROM raw_reviews) t
WHERE rn = 1"""


@register("ST1_ST2_stream_ingest", _D3_SQL)
def q_stream(spark, sf_dir):
    return _stream_documents(spark, sf_dir)


@register("ST2_state_store_keys", f"WITH {RAW_CTE} SELECT DISTINCT Unique_ID FROM raw_reviews")
def q_stream_state(spark, sf_dir):
    # the state store keeps some row of each key, so the keys are compared
    return _stream_documents(spark, sf_dir, dedup_state="all").select("Unique_ID")


@register("ST3_stream_until_target", _D3_SQL + " ORDER BY ord LIMIT 900")
def q_stream_target(spark, sf_dir):
    return _stream_documents(spark, sf_dir, target=900)


def _keyed_documents(spark, sf_dir, **kw):
    out = IG.fresh_dir(spark, "keyed")
    got = KS.run_keyed(spark, _os.path.join(sf_dir, "documents*.parquet"), out, "ord", fmt="parquet", schema=_DOC_SCHEMA,
                       transform=derived.review_rows_from, checkpoint=out + "-ckpt", **kw)
    return got.select(*[c.strip() for c in RAW_COLS.split(",")])


@register("ST2_keyed_state", _D3_SQL)
def q_keyed_state(spark, sf_dir):
    return _keyed_documents(spark, sf_dir)


def _stream_with_hook(spark, sf_dir, make_hook):
    out = IG.fresh_dir(spark, "reviews")
    side = out + "-side"
    IG.run_ingest(spark, _os.path.join(sf_dir, "documents*.parquet"), out, fmt="parquet", schema=_DOC_SCHEMA,
                  transform=derived.review_rows_from, checkpoint=out + "-ckpt", on_batch=make_hook(spark, side))
    return side


@register("ST4_stream_star_load", f"""WITH {RECORDS_CTE},
d3 AS (SELECT ord FROM (SELECT ord, row_number() OVER (PARTITION BY Unique_ID ORDER BY ord) AS rn
                        FROM raw_reviews) t WHERE rn = 1),
g AS (SELECT * FROM good WHERE ord IN (SELECT ord FROM d3))
SELECT movie_id, review_hash, rating, helpful_upvotes, helpful_downvotes, summary, review_text, scrape_timestamp
FROM ({_first_sql('g', 'review_hash', _REC_COLS)}) f""")
def q_stream_star(spark, sf_dir):
    root = _stream_with_hook(spark, sf_dir, lambda s, side: (lambda rows, bid: SR.load_star(rows, side)))
    return spark.read.parquet(_os.path.join(root, "reviews")).select(
        "movie_id", "review_hash", "rating", "helpful_upvotes", "helpful_downvotes", "summary", "review_text",
        "scrape_timestamp")


@register("ST5_stream_scored_batches", f"""WITH {SENTIMENT_CTE},
d3 AS (SELECT ord FROM (SELECT ord, row_number() OVER (PARTITION BY Unique_ID ORDER BY ord) AS rn
                        FROM raw_reviews) t WHERE rn = 1)
SELECT * FROM scores WHERE ord IN (SELECT ord FROM d3)""")
def q_stream_scored(spark, sf_dir):
    def hook(s, side):
        lex, bst, ngt = _sent_tables(s)
        idi = _idioms(s)
        score = (lambda rows: SN.score_sentiment(rows, "ord", "Review", lex, bst, ngt, contrast=LX.FIXTURE_CONTRAST,
                                                 idioms=idi)
                 .select("Unique_ID", "ord", "Compound", "Negative", "Neutral", "Positive"))
        return IG.score_batches(score, side)
    return spark.read.parquet(_stream_with_hook(spark, sf_dir, hook)).drop("Unique_ID", IG.BATCH_COL)


@register("D4_first_per_review_hash", f"""WITH {AGAIN_CTE}{_records_sql('again')}
{_first_sql('records', 'review_hash', _REC_COLS)}""")
def q_first_hash(spark, sf_dir):
    recs = LD.review_records(_again(spark, sf_dir)).where(F.col("review_hash").isNotNull())
    return DD.keep_first(recs, "review_hash", "ord")


# ------------------------------------------------------------ sink round trips
from .sources import csv as CSV  # noqa: E402



def _nt(c: str) -> str:
    return f"CASE WHEN {c} IN ({_TOKENS_SQL}) THEN NULL ELSE {c} END AS {c}"


_CSV_SQL = f"""WITH {RAW_CTE}
SELECT {', '.join(_nt(c) for c in ['Author'])},
       CASE WHEN isnan(Rating) THEN NULL ELSE Rating END AS Rating,
       {', '.join(_nt(c) for c in ['Helpful_upVotes', 'Helpful_downVotes', 'Summary', 'Review',
                                   'Scrape_Timestamp', 'Source_URL', 'Unique_ID'])}
FROM raw_reviews"""


def _written_csv(spark, sf_dir):
    out = IG.fresh_dir(spark, "csv")
    CSV.append_reviews(_raw(spark, sf_dir).select(*CSV.CSV_FIELDS), out, fmt="csv")
    return out


@register("S1_S2_csv_round_trip", _CSV_SQL)
def q_csv(spark, sf_dir):
    return CSV.read_reviews(spark, _written_csv(spark, sf_dir)).drop("ord")


@register("S1_csv_read_in_ranges", _CSV_SQL)
def q_csv_ranges(spark, sf_dir):
    return CSV.read_reviews(spark, _written_csv(spark, sf_dir), in_ranges=True).drop("ord")


@register("F5_cap_per_movie", f"""WITH {RAW_CTE},
hist AS (SELECT movie_id, Unique_ID FROM raw_reviews WHERE Scrape_Timestamp < '2026-01-03'),
firsts AS (SELECT {RAW_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY movie_id, Unique_ID ORDER BY ord) AS rn FROM raw_reviews) t WHERE rn = 1),
fresh AS (SELECT f.* FROM firsts f ANTI JOIN hist h ON h.movie_id = f.movie_id AND h.Unique_ID = f.Unique_ID),
ranked AS (SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY ord) AS rn FROM fresh),
existing AS (SELECT movie_id, count(DISTINCT Unique_ID) AS n FROM hist GROUP BY movie_id)
SELECT {RAW_COLS} FROM ranked LEFT JOIN existing USING (movie_id) WHERE rn <= 40 - coalesce(n, 0)""")
def q_cap_per_movie(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return DD.new_reviews(raw, raw.where(_HISTORY), "Unique_ID", "ord", target=40, group="movie_id")


_MOVIE_TARGET_SQL = f"""WITH {RAW_CTE},
firsts AS (SELECT {RAW_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY movie_id, Unique_ID ORDER BY ord) AS rn FROM raw_reviews) t WHERE rn = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY ord) AS rn FROM firsts)
SELECT {RAW_COLS} FROM ranked WHERE rn <= 40"""


@register("ST3_keyed_totals_per_movie", _MOVIE_TARGET_SQL)
def q_keyed_totals(spark, sf_dir):
    return _keyed_documents(spark, sf_dir, group_col="movie_id", target=40)


@register("ST3_stream_per_movie_target", _MOVIE_TARGET_SQL)
def q_stream_per_movie(spark, sf_dir):
    out = IG.fresh_dir(spark, "reviews")
    got = IG.run_ingest(spark, _os.path.join(sf_dir, "documents*.parquet"), out, fmt="parquet",
                        schema=_DOC_SCHEMA, transform=derived.review_rows_from, target=40,
                        checkpoint=out + "-ckpt", group_col="movie_id")
    return got.select(*[c.strip() for c in RAW_COLS.split(",")])


# ------------------------------------------------------------------- per movie
MOVIE_PREPROCESSED_CTE = f"""{RAW_CTE},
m_first AS (SELECT {RAW_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY movie_id, Review ORDER BY ord) AS rn FROM raw_reviews
  WHERE Review IS NOT NULL) t WHERE rn = 1),
m_complete AS (SELECT * FROM m_first WHERE Summary IS NOT NULL),
m_means AS (SELECT movie_id, round_even(avg(Rating), 0) AS fill FROM m_complete GROUP BY movie_id),
m_preprocessed AS (SELECT c.* REPLACE (coalesce(c.Rating, m.fill) AS Rating)
  FROM m_complete c JOIN m_means m ON m.movie_id = c.movie_id)"""

MOVIE_LABELLED_CTE = MOVIE_PREPROCESSED_CTE + SENTIMENT_CTE[len(RAW_CTE):] + """,
m_labelled AS (
  SELECT p.*, s.Compound, s.Negative, s.Neutral, s.Positive,
         CASE WHEN isnan(s.Compound) THEN 'neutral' WHEN s.Compound > 0.05 THEN 'positive'
              WHEN s.Compound < -0.05 THEN 'negative' ELSE 'neutral' END AS Sentiment_label
  FROM m_preprocessed p JOIN scores s ON s.ord = p.ord)"""

_MOVIE_TOP_SQL = """,
m_counted AS (SELECT r.movie_id, l.word, count(*) AS count, min({'o': l.ord, 'p': l.pos}) AS first
  FROM lem l JOIN m_preprocessed r ON r.ord = l.ord GROUP BY ALL),
m_top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY count DESC, first) AS rank
  FROM m_counted) t WHERE rank <= 20)"""


def _analyzed_by_movie(spark, sf_dir):
    lex, bst, ngt = _sent_tables(spark)
    stop, lem = _kw_tables(spark)
    return AN.analyze(_raw(spark, sf_dir), lex, "ord", bst, ngt, LX.FIXTURE_CONTRAST, stop, lem,
                      KW.senses(spark, LX.FIXTURE_SENSES), idioms=_idioms(spark), group="movie_id", materialize=True)


@register("E1_preprocess_per_movie", f"WITH {MOVIE_PREPROCESSED_CTE} SELECT * FROM m_preprocessed")
def q_preprocess_movies(spark, sf_dir):
    return preprocess(_raw(spark, sf_dir), group="movie_id")


@register("A8_top_keywords_per_movie", f"""WITH {MOVIE_PREPROCESSED_CTE}{_kw_chain('m_preprocessed')}{_MOVIE_TOP_SQL}
SELECT movie_id, word, count, rank FROM m_top""")
def q_keywords_movies(spark, sf_dir):
    stop, lem = _kw_tables(spark)
    return KW.top_keywords(preprocess(_raw(spark, sf_dir), group="movie_id"), "Review", "ord", stop, lem, group="movie_id")


@register("A7_grouped_stats_per_movie", f"""WITH {MOVIE_LABELLED_CTE}
SELECT movie_id, CASE grouping(Sentiment_label, Rating) WHEN 1 THEN 'label' WHEN 2 THEN 'rating' ELSE 'total' END AS set,
       Sentiment_label AS label, Rating AS rating, count(*) AS count, avg(Rating) AS avg_rating
FROM m_labelled GROUP BY GROUPING SETS ((movie_id, Sentiment_label), (movie_id, Rating), (movie_id))""")
def q_stats_movies(spark, sf_dir):
    scored, _ = _analyzed_by_movie(spark, sf_dir)
    return ST.grouped_stats(LB.add_sentiment_labels(scored), group="movie_id")


@register("E2_keywords_per_movie", f"""WITH {MOVIE_PREPROCESSED_CTE}{_kw_chain('m_preprocessed')}{_MOVIE_TOP_SQL},
senses AS (SELECT word, arg_min(definition, rank) AS definition FROM {_SENSE_SQL} GROUP BY word)
SELECT t.movie_id, t.word AS name, t.count AS value, t.rank, s.definition
FROM m_top t LEFT JOIN senses s ON s.word = t.word""")
def q_analyzed_keywords(spark, sf_dir):
    return _analyzed_by_movie(spark, sf_dir)[1].select(
        "movie_id", "name", "value", "rank", F.get("categories", F.lit(0))["definition"].alias("definition"))


@register("E3_P19_inference_per_movie", f"""WITH {MOVIE_LABELLED_CTE}{_kw_chain('m_preprocessed')}{_MOVIE_TOP_SQL},
stats AS (SELECT movie_id, count(*) AS total_reviews, round_even(avg(Rating), 1) AS avg_rating,
  count(*) FILTER (WHERE Sentiment_label = 'positive') AS npos, count(*) FILTER (WHERE Sentiment_label = 'negative') AS nneg
  FROM m_labelled GROUP BY movie_id),
labels AS (SELECT movie_id, string_agg(Sentiment_label || '=' || n || '/' || round(a, 6), ';' ORDER BY Sentiment_label) AS labels
  FROM (SELECT movie_id, Sentiment_label, count(*) AS n, avg(Rating) AS a FROM m_labelled GROUP BY ALL) t GROUP BY movie_id),
ratings AS (SELECT movie_id, string_agg(Rating || '=' || n, ';' ORDER BY Rating) AS ratings
  FROM (SELECT movie_id, Rating, count(*) AS n FROM m_labelled WHERE Rating IS NOT NULL GROUP BY ALL) t GROUP BY movie_id),
words AS (SELECT movie_id, string_agg(word || '=' || count, ';' ORDER BY rank) AS keywords,
  max(CASE WHEN rank = 1 THEN word END) AS top FROM m_top GROUP BY movie_id)
SELECT s.movie_id, total_reviews, avg_rating, labels, ratings, keywords,
       '⭐ Avg ' || coalesce(CAST(avg_rating AS VARCHAR), 'nan') || '/10. ' ||
       CASE WHEN npos > nneg THEN 'Overall positive audience reception.'
            WHEN nneg > npos THEN 'Overall negative audience reception.' ELSE 'Mixed audience reception.' END ||
       coalesce(' Common theme: ' || top || '.', '') AS summary
FROM stats s LEFT JOIN labels USING (movie_id) LEFT JOIN ratings USING (movie_id) LEFT JOIN words USING (movie_id)""")
def q_infer_movies(spark, sf_dir):
    scored, kws = _analyzed_by_movie(spark, sf_dir)
    result, _ = AN.infer(scored, kws, group="movie_id")
    joined = lambda m, f: F.array_join(F.transform(F.array_sort(F.map_entries(m)), f), ";")
    text = lambda v: v.cast("string")
    means = F.col("avg_rating_by_sentiment")
    return result.select(
        "movie_id", "total_reviews", "avg_rating",
        joined("sentiment_counts", lambda e: F.concat(e["key"], F.lit("="), text(e["value"]), F.lit("/"),
                                                      text(F.round(F.element_at(means, e["key"]), 6)))).alias("labels"),
        joined("rating_distribution", lambda e: F.concat(text(e["key"]), F.lit("="), text(e["value"]))).alias("ratings"),
        F.nullif(F.array_join(F.transform("top_keywords", lambda k: F.concat(k["name"], F.lit("="), text(k["value"]))), ";"),
                 F.lit("")).alias("keywords"), "summary")


@register("S4_write_analyzed", f"WITH {MOVIE_LABELLED_CTE} SELECT * FROM m_labelled")
def q_write_analyzed(spark, sf_dir):
    out = IG.fresh_dir(spark, "analyzed")
    scored, kws = _analyzed_by_movie(spark, sf_dir)
    labelled = AN.infer(scored, kws, group="movie_id")[1]
    AN.write_analyzed(labelled, out)
    return spark.read.parquet(out).select(*labelled.columns)


# ---------------------------------------------------------- load, then report
def _loaded(spark, sf_dir):
    """The star tables after two loads of dirty rows, the second holding the first again."""
    root = IG.fresh_dir(spark, "star")
    rows = _dirty(spark, sf_dir)
    SR.load_star(rows.where(_HISTORY), root)
    SR.load_star(rows, root)
    return root


_LOADED_CTE = f"""{DIRTY_CTE}{_records_sql('dirty')},
loaded AS ({_first_sql('good', 'review_hash', _REC_COLS)})"""


@register("S5_loaded_movies", f"""WITH {RAW_CTE}
SELECT movie_id, arg_min(title, ord) AS title, '{_SITE}/title/' || movie_id || '/' AS imdb_url FROM raw_reviews GROUP BY movie_id""")
def q_loaded_movies(spark, sf_dir):
    return spark.read.parquet(_os.path.join(_loaded(spark, sf_dir), "movies")).select("movie_id", "title", "imdb_url")


@register("S5_loaded_reviewers", f"WITH {_LOADED_CTE} SELECT DISTINCT username FROM good")
def q_loaded_reviewers(spark, sf_dir):
    return spark.read.parquet(_os.path.join(_loaded(spark, sf_dir), "reviewers")).select("username")


@register("S5_loaded_sources", f"WITH {_LOADED_CTE} SELECT DISTINCT source_url FROM records")
def q_loaded_sources(spark, sf_dir):
    return spark.read.parquet(_os.path.join(_loaded(spark, sf_dir), "sources")).select("source_url")


@register("S5_loaded_quarantine", f"""WITH {_LOADED_CTE}
SELECT DISTINCT movie_id, username, review_text, reasons FROM records WHERE reasons <> ''""")
def q_loaded_quarantine(spark, sf_dir):
    return spark.read.parquet(_os.path.join(_loaded(spark, sf_dir), "quarantine")).select(
        "movie_id", "username", "review_text", F.concat_ws(",", "reasons").alias("reasons"))


_LOADED_METRICS = f"""{_LOADED_CTE},
metrics AS (SELECT movie_id, max(replace(movie_id, 'tt', '')) AS k, count(*) AS review_count, avg(rating) AS avg_rating,
  CAST(sum(helpful_upvotes) AS BIGINT) AS total_upvotes FROM loaded GROUP BY movie_id),
titled AS (SELECT m.movie_id, t.title, m.review_count, m.avg_rating, m.total_upvotes
  FROM metrics m JOIN (SELECT movie_id, arg_min(title, ord) AS title FROM raw_reviews GROUP BY movie_id) t USING (movie_id))"""


def _report_of_load(spark, sf_dir):
    return report.report_datasets(**report.loaded_inputs(spark, _loaded(spark, sf_dir)), materialize=True)


@register("E5_S6_S7_report_of_load", f"""WITH {_LOADED_METRICS}
SELECT * FROM titled ORDER BY total_upvotes DESC NULLS LAST, movie_id LIMIT 10""")
def q_report_of_load(spark, sf_dir):
    out = IG.fresh_dir(spark, "report")
    report.write_report(_report_of_load(spark, sf_dir), out, fmt="parquet")
    return spark.read.parquet(_os.path.join(out, "top_movies_by_upvotes"))


@register("E5_T5_leaders_of_load", f"""WITH {_LOADED_METRICS},
by_user AS (SELECT username, count(*) AS n FROM loaded GROUP BY username)
SELECT (SELECT title FROM titled WHERE review_count > 5 ORDER BY avg_rating DESC NULLS LAST, movie_id LIMIT 1) AS top_movie_rating,
  (SELECT title FROM titled ORDER BY review_count DESC, movie_id LIMIT 1) AS top_movie_volume,
  (SELECT title FROM titled ORDER BY total_upvotes DESC, movie_id LIMIT 1) AS top_movie_upvotes,
  (SELECT max(n) FROM by_user) AS top_reviewer_reviews""")
def q_leaders_of_load(spark, sf_dir):
    sets = _report_of_load(spark, sf_dir)
    # reviewer ids are handed out by the load, so a tie's winner is compared by its count
    top = sets["top_reviewers"].agg(F.max("total_reviews"))
    return sets["leaders"].select("top_movie_rating", "top_movie_volume", "top_movie_upvotes",
                                  top.scalar().alias("top_reviewer_reviews"))


@register("Q5_P18_required_and_constant_columns", f"""WITH {RAW_CTE}
SELECT ord, Review, 'tt0000042' AS movie_id, 'A title' AS title FROM raw_reviews""")
def q_required(spark, sf_dir):
    rows = CL.require_columns(_raw(spark, sf_dir).select("ord", "Review"), ["ord", "Review"])
    try:
        CL.require_columns(rows, ["Rating"])
    except KeyError:
        return report.constants(rows, movie_id="tt0000042", title="A title")
    raise AssertionError("a missing column must be reported")
