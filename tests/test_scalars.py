import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cinelens.functions import scalars as S
from cinelens.functions import text as TX


def _one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("o")).first()["o"]


def _many(spark, expr, values, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r["o"] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_vote_count_numbers_suffixes_and_blanks(spark):
    vals = ["150", "0", "1.5K", "2M", "", "None", None, "1,234", "2.5k", " 12 ", "abc",
            "1.5D", "-3.7", "1e3", "inf", "1_000", "K", "99999999999"]
    assert _many(spark, S.vote_count, vals) == [150, 0, 1500, 2000000, 0, 0, 0, 1234, 2500, 12, 0,
                                               0, -3, 1000, 0, 0, 0, 0]


def _vote_model(val):
    """Python model of the vote rule (with our decisions for inf/underscores/overflow)."""
    if val is None or val in ("None", ""):
        return 0
    s = val.strip().upper().replace(",", "")
    mult = 1
    if s.endswith("K"):
        s, mult = s[:-1], 1000
    elif s.endswith("M"):
        s, mult = s[:-1], 1000000
    if "_" in s or s.lower() in ("inf", "+inf", "-inf", "infinity", "nan") or not s:
        return 0
    try:
        x = float(s) * mult
    except ValueError:
        return 0
    if math.isinf(x) or math.isnan(x) or not (-2**31 <= int(x) < 2**31):
        return 0
    return int(x)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(
    st.none(),
    st.from_regex(r"\A ?[+-]?[0-9]{0,4}(\.[0-9]{0,2})?([eE][0-9])?[kKmM]? ?\Z"),
    st.from_regex(r"\A[0-9]{1,3}(,[0-9]{3}){0,2}[KM]?\Z"),
    st.text(alphabet="0123456789.,KMkm -+eE_abc", max_size=8)), min_size=1, max_size=25))
def test_vote_count_matches_python_model(spark, values):
    assert _many(spark, S.vote_count, values) == [_vote_model(v) for v in values]


def test_parse_rating(spark):
    assert _many(spark, S.parse_rating, ["8", "8.9", "NaN", None, "abc", "-1.5", "10.0"]) == \
        [8, 8, None, None, None, -1, 10]
    assert _many(spark, S.parse_rating, [7.0, float("nan"), None], "v double") == [7, None, None]


def test_author_from_label(spark):
    assert _many(spark, S.author_from_label, ["jane_doe's rating: 8/10", "no marker", "", None]) == \
        ["jane_doe", "no marker", "", "Unknown"]


def test_unique_id_link_and_fallback(spark):
    df = spark.createDataFrame([("/review/rw1/?ref_=x", "ann", "body"), ("", "bob", "body"),
                                (None, "cy", "text")], "href string, author string, text string")
    out = [r[0] for r in df.select(S.unique_id("href", "author", "text")).collect()]
    assert out[0] == "https://www.imdb.com/review/rw1/"
    assert out[1].startswith("bob_") and len(out[1]) == 4 + 64
    assert out[2].startswith("cy_")


def test_review_hash_prints_none_for_missing(spark):
    import hashlib
    df = spark.createDataFrame([("tt1", "ann", None)], "m string, a string, r string")
    got = df.select(S.review_hash("m", "a", "r")).first()[0]
    assert got == hashlib.md5(b"tt1annNone").hexdigest()
    got256 = df.select(S.review_hash("m", "a", "r", algo="sha256")).first()[0]
    assert got256 == hashlib.sha256(b"tt1annNone").hexdigest()


def test_urls(spark):
    df = spark.createDataFrame([("tt0903747",)], "m string")
    r = df.select(S.movie_url("m"), S.source_url("m")).first()
    assert r[0] == "https://www.imdb.com/title/tt0903747/"
    assert r[1] == "https://www.imdb.com/title/tt0903747/reviews"


def test_iso_timestamp(spark):
    import datetime as dt
    got = _many(spark, S.iso_timestamp, ["2026-08-17T12:34:56.123456+00:00", "garbage"])
    assert got[0] == dt.datetime(2026, 8, 17, 12, 34, 56, 123456)
    assert got[1] is None


def test_clean_text_keeps_letters_and_single_spaces(spark):
    vals = ["Caf\u00e9 No.5\t\u2014 A/B<br/>test", "\n\nONE\r\n two\u00a0three", "42 % ?!", None, "x" * 3 + " " * 50 + "Y"]
    got = _many(spark, TX.clean_text, vals)
    assert got[0] == "caf no abbrtest"
    assert got[2:] == ["", "", "xxx y"]
    assert got[1].split() == ["one", "twothree"] or got[1].split() == ["one", "two", "three"]


def test_tokens_of_words_signs_and_clitics(spark):
    toks = _one(spark, TX.tokenize, "We'll see: rock-n-roll isn't dead, right?")
    assert {"we", "see", "dead", "right", "?", ":", ","} <= set(toks)
    assert _one(spark, TX.tokenize, " \t ") == []
    assert _one(spark, lambda c: TX.tokenize(c, "whitespace"), " A,b\n\tC-d  ") == ["a,b", "c-d"]


def test_meaningful_tokens_by_length_and_letters(spark):
    toks = ["abc", "ab", "a1c", "\u00e9t\u00e9", "twenty-one", "y" * 19, "y" * 20, "", "_x_", "Z" * 3]
    df = spark.createDataFrame([(toks,)], "t array<string>")
    assert df.select(TX.meaningful("t")).first()[0] == ["abc", "\u00e9t\u00e9", "y" * 19, "ZZZ"]


def test_numbers_before_they_are_clipped(spark):
    assert _many(spark, S.rating_value, ["70000", "8.9", "NaN", None, "1e2"]) == [70000.0, 8.9, None, None, 100.0]
    assert _many(spark, S.vote_value, ["3000M", "-5", "1.29K", "abc", None, "9,999"]) == [3e9, -5.0, 1290.0, None, None, 9999.0]
