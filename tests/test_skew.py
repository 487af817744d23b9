"""A key holding a third of all rows: results stay exact, and hot keys are combined before the shuffle."""

from pyspark.sql import functions as F

from cinelens.functions import display
from cinelens.operators import keywords as KW
from cinelens.operators import metrics as M
from cinelens.operators.dedup import keep_first, new_reviews

N = 3000


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _skewed(spark):
    # ids 0..N-1; every third row belongs to the hot movie 7 and repeats the hot text
    df = spark.range(N).select(
        F.col("id").alias("ord"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50 + 100).alias("movie_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot text")).otherwise(F.concat(F.lit("text "), F.col("id").cast("string")))
         .alias("Review"),
        (F.col("id") % 10 + 1).cast("int").alias("rating"),
        F.lit(1).alias("helpful_upvotes"))
    return df.repartition(8)


def test_keep_first_with_hot_key(spark):
    df = _skewed(spark)
    out = keep_first(df, "Review", "ord")
    assert out.count() == N - N // 3 + 1
    assert out.where("Review = 'hot text'").first()["ord"] == 0
    assert "partial_min" in _plan(out)


def test_movie_metrics_with_hot_movie(spark):
    df = _skewed(spark)
    movies = spark.range(200).select(F.col("id").alias("movie_id"), F.concat(F.lit("m"), F.col("id")).alias("title"))
    m = {r["movie_id"]: r["review_count"] for r in M.movie_metrics(df, movies).collect()}
    assert m[7] == N // 3 and sum(m.values()) == N
    assert "partial_count" in _plan(M.movie_metrics(df, movies))


def test_hot_token_keywords(spark):
    docs = spark.range(600).select(F.col("id").alias("ord"),
                                   F.when(F.col("id") % 3 == 0, F.lit("alpha " * 50))
                                   .otherwise(F.lit("beta gamma")).alias("Review"))
    out = {r["word"]: r["count"] for r in KW.top_keywords(docs, "Review", top_n=3).collect()}
    assert out == {"alpha": 200 * 50, "beta": 400, "gamma": 400}


def test_per_movie_cap_with_hot_movie(spark):
    df = _skewed(spark).withColumn("Unique_ID", F.col("ord").cast("string"))
    out = new_reviews(df, None, target=25, group="movie_id")
    per = {r["movie_id"]: r["n"] for r in out.groupBy("movie_id").agg(F.count("*").alias("n")).collect()}
    assert len(per) == 51 and all(v == 25 for v in per.values())
    first_hot = sorted(r["ord"] for r in out.where("movie_id = 7").collect())
    assert first_hot == list(range(0, 75, 3))


def test_display_helpers(spark):
    import datetime as dt
    df = spark.createDataFrame([(60000, dt.datetime(2001, 11, 4)), (None, None)], "n long, t timestamp")
    rows = df.select(display.thousands("n"), display.long_date("t")).collect()
    assert tuple(rows[0]) == ("60,000", "November 04, 2001")
    assert tuple(rows[1]) == ("N/A", "N/A")
