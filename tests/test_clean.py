"""Null handling, keep-first, rating fill, history and target."""

import pytest

from cinelens.operators import clean as CL
from cinelens.operators.dedup import cap_new, keep_first, new_reviews, skip_seen
from cinelens.plans.preprocess import preprocess

SCHEMA = "ord long, movie_id string, Review string, Summary string, Rating double"


def _pre(spark, rows, **kw):
    return {r["ord"]: r for r in preprocess(spark.createDataFrame(rows, SCHEMA), **kw).collect()}


def test_order_of_the_steps(spark):
    """Copies go before incomplete rows, and only what is left counts for the fill."""
    rows = [(4, "m", "long text\nof two lines", "later copy", 1.0), (1, "m", "long text\nof two lines", "title", None),
            (2, "m", "second", "t2", 4.0), (3, "m", "third", "t3", 7.0),
            (5, "m", "its first copy has no title", None, 9.0), (6, "m", "its first copy has no title", "t", 9.0),
            (7, "m", None, "nothing written", 10.0), (8, "m", "", "empty is a text", 10.0)]
    got = _pre(spark, rows)
    assert {k: r["Rating"] for k, r in got.items()} == {1: 7.0, 2: 4.0, 3: 7.0, 8: 10.0}
    assert got[1]["Review"] == "long text\nof two lines"


def test_fill_is_half_to_even_and_per_movie(spark):
    rows = [(1, "a", "x1", "s", 4.0), (2, "a", "x2", "s", 5.0), (3, "a", "x3", "s", None),
            (4, "b", "x1", "s", 9.0), (5, "b", "x5", "s", None), (6, "c", "x6", "s", None)]
    assert {k: r["Rating"] for k, r in _pre(spark, rows, group="movie_id").items()} == {1: 4.0, 2: 5.0, 3: 4.0, 4: 9.0, 5: 9.0, 6: None}
    assert 4 not in _pre(spark, rows)                       # one text under two movies, taken together


def test_columns_that_must_exist(spark):
    with pytest.raises(KeyError, match="Summary"):
        preprocess(spark.createDataFrame([(1, "r", 2.0)], "ord long, Review string, Rating double"))
    with pytest.raises(KeyError, match="movie_id"):
        preprocess(spark.createDataFrame([(1, "r", "s", 2.0)], "ord long, Review string, Summary string, Rating double"), group="movie_id")


def test_keep_first_of_keys_nulls_and_near_keys(spark):
    rows = [(9, "k", "", 1), (2, "k", "", 2), (3, None, "x", 3), (4, None, "x", 4), (5, "-", "x", 5), (6, "1:k", None, 6), (7, "", "k", 7),
            (8, "", "k", 8)]
    df = spark.createDataFrame(rows, "ord long, a string, b string, v int")
    assert sorted(r["v"] for r in keep_first(df, ["a", "b"]).collect()) == [2, 3, 5, 6, 7]
    assert keep_first(df, ["a", "b"]).columns == df.columns


def test_history_counts_null_keys_too(spark):
    batch = spark.createDataFrame([(1, None), (2, "p"), (3, "q")], "ord long, Unique_ID string")
    known = spark.createDataFrame([(None,), ("q",)], "Unique_ID string")
    assert [r["Unique_ID"] for r in skip_seen(batch, known).collect()] == ["p"]
    assert [r["Unique_ID"] for r in new_reviews(batch, known).collect()] == ["p"]


@pytest.mark.parametrize("existing, target, want", [(0, 7, 7), (3, 7, 4), (9, 7, 0), (0, 1000, 200), (5, 5, 0)])
def test_target_keeps_the_first_rows_over_many_partitions(spark, existing, target, want):
    rows = spark.range(200).selectExpr("(id * 37) % 200 AS ord", "id AS v").repartition(9)
    got = sorted(r["ord"] for r in cap_new(rows, existing, target).collect())
    assert got == list(range(want))


def test_resume_counts_known_keys_once(spark):
    batch = spark.createDataFrame([(k, f"n{k // 2}") for k in range(40)], "ord long, Unique_ID string")
    known = spark.createDataFrame([("n3",), ("n3",), ("old",)], "Unique_ID string")
    got = [r["Unique_ID"] for r in new_reviews(batch, known, target=6).orderBy("ord").collect()]
    assert got == ["n0", "n1", "n2", "n4"]


def test_null_tokens_and_blank_texts(spark):
    df = spark.createDataFrame([(t, float(k)) for k, t in enumerate((*CL.NULL_TOKENS, " NA", "nil", "0"))], "s string, d double")
    assert [r["s"] for r in CL.normalise_nulls(df).where("s is not null").orderBy("d").collect()] == [" NA", "nil", "0"]
    nan = spark.createDataFrame([(float("nan"),), (2.5,)], "d double")
    assert [r["d"] for r in CL.normalise_nulls(nan).collect()] == [None, 2.5]
    texts = spark.createDataFrame([("\t\n",), (" ",), (None,), (" . ",)], "t string")
    assert [r["t"] for r in CL.nonblank(texts, "t").collect()] == [" . "]
