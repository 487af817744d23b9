import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["movie_id", "title", "review_count", "avg_rating", "total_upvotes"]
    assert 0 < len(rows) <= 10


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 60


def test_fixture_anchors(spark):
    q = E.queries()
    d = "/root/testdata/sf0.01"
    assert q["D1_keep_first_per_review"](spark, d).count() == 920
    assert q["F1_drop_incomplete"](spark, d).count() == 863
    votes = q["P1_vote_counts"](spark, d).agg({"upvotes": "sum"}).first()[0]
    assert votes == 286706773
    kpi = q["A10_kpi_summary"](spark, d).first()
    assert (kpi["total_reviews"], kpi["avg_rating"], kpi["total_movies"]) == (60000, 5.5, 2000)
    top = [r["movie_id"] for r in q["T1_top_movies_by_rating"](spark, d).collect()[:3]]
    assert top == [576, 689, 1881]
