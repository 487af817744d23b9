import os

from pyspark.sql import functions as F

from cinelens.operators import quality as Q
from cinelens.plans.star import load_star

COLS = ("ord long, movie_id string, title string, Author string, Rating double, Helpful_upVotes string, "
        "Helpful_downVotes string, Summary string, Review string, Scrape_Timestamp string, Source_URL string, "
        "Unique_ID string")


def _batch(spark):
    rows = [
        (1, "tt0000001", "First", "ann", 8.0, "1.5K", "2", "Nice", "Loved it", "2026-01-01T00:00:00+00:00", "u", "a"),
        (2, "tt0000001", "First", "bob", None, "None", "", "Meh", "It was fine", "2026-01-02T00:00:00+00:00", "u", "b"),
        (3, "tt0000001", "First", "ann", 8.0, "3", "0", "Nice", "Loved it", "2026-01-03T00:00:00+00:00", "u", "c"),
        (4, "tt0000002", "Second", "cy", 11.0, "0", "0", "Odd", "Too high", "2026-01-04T00:00:00+00:00", "u", "d"),
        (5, "tt0000002", "Second", "dee", 5.0, "0", "0", "Empty", None, "2026-01-05T00:00:00+00:00", "u", "e"),
    ]
    return spark.createDataFrame(rows, COLS)


def test_load_twice_adds_nothing_and_quarantines(spark, tmp_dir):
    root = os.path.join(tmp_dir, "star")
    first = load_star(_batch(spark), root, report_counts=True)
    assert first["movies"] == 2 and first["sources"] == 2
    assert first["reviewers"] == 2              # ann, bob (cy and dee only have bad rows)
    assert first["reviews"] == 2                # duplicate hash of row 3 ignored
    assert first["quarantine"] == 2             # rating 11 and a null review text
    second = load_star(_batch(spark), root, report_counts=True)
    assert set(second.values()) == {0}          # all five tables, the quarantine too

    reviews = spark.read.parquet(os.path.join(root, "reviews"))
    movies = spark.read.parquet(os.path.join(root, "movies"))
    reviewers = spark.read.parquet(os.path.join(root, "reviewers"))
    sources = spark.read.parquet(os.path.join(root, "sources"))
    assert Q.check_fk(reviews, "movie_id", movies).count() == 0
    assert Q.check_fk(reviews, "reviewer_id", reviewers).count() == 0
    assert Q.check_fk(reviews, "source_id", sources).count() == 0
    for df, key in ((reviews, "review_id"), (reviews, "review_hash"), (reviewers, "username"),
                    (reviewers, "reviewer_id"), (sources, "source_url")):
        assert Q.check_unique(df, key).count() == 0
    r = reviews.where(F.col("rating") == 8).first()
    assert r["helpful_upvotes"] == 1500 and r["helpful_downvotes"] == 2
    assert movies.where("movie_id = 'tt0000001'").first()["imdb_url"] == "https://www.imdb.com/title/tt0000001/"


def test_values_out_of_range_are_quarantined_not_clipped(spark, tmp_dir):
    ok = ("s", "text", "2026-01-01T00:00:00+00:00", "u", "i")
    rows = [(1, "tt1", "T", "a", 70000.0, "1", "1", *ok), (2, "tt1", "T", "b", 3.0, "3000M", "1", *ok),
            (3, "tt1", "T", "c", 0.5, "1", "-2", *ok), (4, "tt1", "T", "d", None, "junk", None, *ok), (5, "tt1", "T", "e", 10.0, "1", "1", *ok)]
    root = os.path.join(tmp_dir, "star")
    load_star(spark.createDataFrame(rows, COLS), root)
    bad = {r["username"]: r["reasons"] for r in spark.read.parquet(os.path.join(root, "quarantine")).collect()}
    assert bad == {"a": ["rating_value outside [1, 10]"], "b": ["upvotes_value outside [0, 2147483647]"],
                   "c": ["rating_value outside [1, 10]", "downvotes_value outside [0, 2147483647]"]}
    assert spark.read.parquet(os.path.join(root, "reviews")).count() == 2


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, None, 11), (2, "b", 0)], "k int, t string, r int")
    assert Q.check_unique(df, "k").collect()[0]["count"] == 2
    nulls = spark.createDataFrame([(None,), (None,), ("x",)], "k string")
    assert Q.check_unique(nulls, "k").count() == 0     # a unique constraint allows several nulls
    assert {r["column"]: r["null_count"] for r in Q.check_not_null(df, ["k", "t"]).collect()} == {"k": 0, "t": 1}
    assert sorted(r["r"] for r in Q.check_range(df, "r", 1, 10).collect()) == [0, 11]
    ok, bad = Q.quarantine(df, [Q.not_null_rule("t"), Q.range_rule("r", 1, 10)])
    assert ok.count() == 1 and sorted(bad.first()["reasons"]) == ["r outside [1, 10]", "t is null"]


def test_load_expressions_are_not_copied_and_compile(spark):
    from cinelens import catalog as C

    plan = C.QUERIES["J3d_E4_new_reviews"](spark, "/root/testdata/sf0.001")
    text = plan._jdf.queryExecution().executedPlan().toString()
    for line in text.splitlines():
        assert line.count("regexp") <= 60, line[:200]
    conf = {"spark.sql.codegen.fallback": "false", "spark.sql.codegen.factoryMode": "CODEGEN_ONLY"}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for name in ("J3d_E4_new_reviews", "J3c_D2_new_reviewers", "Q3_E4_quarantined_rows"):
            assert C.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_violations_are_observed_by_the_load(spark, tmp_dir):
    from cinelens import catalog as C
    from cinelens.operators import quality as Q
    from cinelens.operators.load import review_records
    from cinelens.plans import star as SR

    rows = C._dirty(spark, "/root/testdata/sf0.001")
    for buckets in (None, 4):
        root = os.path.join(tmp_dir, f"star{buckets}")
        got = SR.load_star(rows, root, report_counts=True, report_violations=True, buckets=buckets)
        bad = spark.read.parquet(os.path.join(root, "quarantine"))
        assert {t: spark.read.parquet(os.path.join(root, t)).count() for t in SR.TABLES} == {t: got[t] for t in SR.TABLES}
        records = review_records(rows, values=True)
        assert {r: n for r, n in got["violations"].items()} == {r: bad.where(f"array_contains(reasons, '{r}')").count() for r, _ in SR.rules()}
        # as the checks of single rules count them (no row of this batch is broken twice in the same way)
        assert got["violations"]["rating_value outside [1, 10]"] == Q.check_range(records, "rating_value", 1, 10).dropDuplicates(
            ["movie_id", "username", "review_text"]).count() > 0
        again = SR.load_star(rows, root, report_counts=True, report_violations=True, buckets=buckets)
        assert set(again["violations"].values()) == {0} and {again[t] for t in SR.TABLES} == {0}
