"""Statistics, verdicts and reports: whole tables, and one movie among several."""

import os

import pytest
from pyspark.sql import functions as F

from cinelens.functions import display
from cinelens.operators import metrics as M
from cinelens.operators import stats as ST
from cinelens.plans.analyze import analyze, infer, write_analyzed
from cinelens.plans.report import constants, loaded_inputs, report_datasets, report_inputs, write_report
from cinelens.plans.star import load_star

ROWS = [("m1", 10, "positive"), ("m1", 4, "negative"), ("m1", 4, "neutral"), ("m1", None, "negative"), ("m1", 7, None),
        ("m2", 1, "positive"), ("m2", None, None)]


def _rows(spark):
    return spark.createDataFrame(ROWS, "movie_id string, Rating int, Sentiment_label string")


def test_record_of_one_movie_ignores_null_labels(spark):
    df = _rows(spark).where("movie_id = 'm1'")
    r = ST.stats_record(df).select("*", F.map_keys("sentiment_counts").alias("order")).first()
    assert r["total_reviews"] == 5
    assert r["sentiment_counts"] == {"negative": 2, "neutral": 1, "positive": 1}
    assert r["order"] == ["negative", "neutral", "positive"]        # largest count first, then by name
    assert r["rating_distribution"] == {4: 2, 7: 1, 10: 1}
    assert r["avg_rating"] == 6.2                                    # 25 / 4 = 6.25, half to even
    assert r["avg_rating_by_sentiment"] == {"negative": 4.0, "neutral": 4.0, "positive": 10.0}


def test_records_per_movie_equal_records_of_each(spark):
    df = _rows(spark)
    per = {r["movie_id"]: r.asDict() for r in ST.stats_record(df, group="movie_id").collect()}
    for m in ("m1", "m2"):
        alone = ST.stats_record(df.where(F.col("movie_id") == m)).first().asDict()
        assert {k: v for k, v in per[m].items() if k != "movie_id"} == alone
    assert ST.stats_record(df.limit(0)).first()["total_reviews"] == 0


def test_parts_agree_with_the_record(spark):
    df = _rows(spark)
    assert {tuple(r) for r in ST.sentiment_counts(df).collect()} == {("negative", 2), ("positive", 2), ("neutral", 1)}
    assert {tuple(r) for r in ST.rating_by_sentiment(df, group="movie_id").collect()} == {
        ("m1", "positive", 10.0), ("m1", "negative", 4.0), ("m1", "neutral", 4.0), ("m2", "positive", 1.0)}
    assert [tuple(r) for r in ST.total_reviews(df, group="movie_id").orderBy("movie_id").collect()] == [("m1", 5), ("m2", 2)]
    sets = {(r["set"], r["label"], r["rating"]): r["count"] for r in ST.grouped_stats(df).collect()}
    assert sets[("total", None, None)] == 7 and sets[("rating", None, None)] == 2 and sets[("label", None, None)] == 2


def test_required_columns(spark):
    with pytest.raises(KeyError, match="Sentiment_label"):
        ST.stats_record(_rows(spark).drop("Sentiment_label"))


@pytest.mark.parametrize("mean, pos, neg, word, want", [
    (7.0, 2, 0, "ending", "⭐ Avg 7.0/10. Overall positive audience reception. Common theme: ending."),
    (2.4, None, 1, "", "⭐ Avg 2.4/10. Overall negative audience reception."),
    (None, 4, 4, None, "⭐ Avg nan/10. Mixed audience reception."),
])
def test_summary_sentence(spark, mean, pos, neg, word, want):
    df = spark.createDataFrame([(mean, pos, neg, word)], "a double, p long, n long, k string")
    assert df.select(display.summary_sentence(*map(F.col, "apnk"))).first()[0] == want


LEX = [("lovely", 2.0), ("dreary", -2.0)]
REVIEWS = [(0, "m1", "lovely tale", "s", 9.0), (1, "m1", "lovely tale", "s", 3.0), (2, "m1", "dreary tale", "s", None),
           (3, "m2", "lovely tale", "s", 2.0), (4, "m2", "plain camera camera", "s", None), (5, "m2", None, "s", 8.0),
           (6, "m3", "dreary", None, 5.0), (7, "m3", "dreary", "s", 5.0)]


def _analyzed(spark, rows, group):
    df = spark.createDataFrame(rows, "ord long, movie_id string, Review string, Summary string, Rating double")
    scored, kws = analyze(df, spark.createDataFrame(LEX, "token string, valence double"), group=group, materialize=bool(group))
    return infer(scored, kws, group=group)


def test_each_movie_is_analysed_as_if_alone(spark):
    result, labelled = _analyzed(spark, REVIEWS, "movie_id")
    got = {r["movie_id"]: r.asDict(recursive=True) for r in result.collect()}
    # one text under two movies stays in both; m3's only complete copy is not the first one
    assert set(got) == {"m1", "m2"} and labelled.count() == 4
    for m in got:
        alone, rows = _analyzed(spark, [r for r in REVIEWS if r[1] == m], None)
        assert {k: v for k, v in got[m].items() if k != "movie_id"} == alone.first().asDict(recursive=True)
    assert got["m2"]["top_keywords"][0] == {"name": "camera", "value": 2, "categories": []}
    assert got["m1"]["summary"] == "⭐ Avg 9.0/10. Mixed audience reception. Common theme: tale."
    assert {r["ord"]: r["Rating"] for r in labelled.collect()} == {0: 9.0, 2: 9.0, 3: 2.0, 4: 2.0}


def test_write_analyzed_replaces_movies_and_splits_hot_ones(spark, tmp_dir):
    out = os.path.join(tmp_dir, "analyzed")
    df = spark.range(400).select(F.when(F.col("id") < 300, "hot").otherwise(F.concat(F.lit("m"), F.col("id") % 4)).alias("movie_id"),
                                 "id").repartition(16)
    write_analyzed(df, out, rows_per_file=50)
    files = {d: len([f for f in os.listdir(os.path.join(out, d)) if f.endswith(".parquet")])
             for d in os.listdir(out) if d.startswith("movie_id=")}
    assert files.pop("movie_id=hot") > 1 and set(files.values()) == {1}
    write_analyzed(df.where("movie_id = 'm1'").limit(3), out)          # replaces m1 alone
    assert spark.read.parquet(out).count() == 400 - 25 + 3


def test_leaders_use_the_rankings_order(spark):
    metrics = spark.createDataFrame([("b", "B", 9, 5.0, None), ("a", "A", 9, 5.0, 3), ("c", "C", 2, 9.9, 3), ("d", "D", 7, None, 1)],
                                    "movie_id string, title string, review_count long, avg_rating double, total_upvotes long")
    totals = spark.createDataFrame([(2, "two", 4), (1, "one", 4)], "reviewer_id long, username string, total_reviews long")
    assert tuple(M.leaders(metrics, totals).first()) == ("A", "A", "A", "one")
    assert tuple(M.leaders(metrics.limit(0), totals.limit(0)).first()) == ("N/A",) * 4
    assert M.top_movies(metrics, "avg_rating", 1, min_reviews=5).first()["title"] == "A"


def test_report_of_loaded_tables(spark, tmp_dir):
    root = os.path.join(tmp_dir, "star")
    rows = [(k, f"tt{k % 3}", f"T{k % 3}", f"u{k % 4}", float(k % 10 + 1), str(k), "0", "s", f"text {k}",
             "2026-02-03T00:00:00+00:00") for k in range(30)]
    load_star(spark.createDataFrame(rows, "ord long, movie_id string, title string, Author string, Rating double, Helpful_upVotes "
                                          "string, Helpful_downVotes string, Summary string, Review string, Scrape_Timestamp string"), root)
    sets = report_datasets(**loaded_inputs(spark, root), materialize=True)
    paths = write_report(sets, os.path.join(tmp_dir, "report"))
    assert len(paths) == len(sets)
    kpi = spark.read.json(os.path.join(tmp_dir, "report", "kpi")).first()
    assert (kpi["total_reviews"], kpi["total_movies"]) == (30, 3)
    assert spark.read.json(os.path.join(tmp_dir, "report", "movie_scatter")).count() == 3
    assert spark.read.json(os.path.join(tmp_dir, "report", "leaders")).first()["top_movie_upvotes"] == "T2"


def test_report_scans_the_fact_once_per_aggregate(spark):
    sets = report_datasets(**report_inputs(spark, "/root/testdata/sf0.001"))
    plan = sets["leaders"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") <= 2


def test_constant_columns(spark):
    got = constants(spark.range(2), movie_id="tt1", n=3).collect()
    assert [tuple(r) for r in got] == [(0, "tt1", 3), (1, "tt1", 3)]
