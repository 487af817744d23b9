"""Keyword counts, ties, stopwords, lemmas and senses."""

import random

import pytest
from pyspark.sql import functions as F

from cinelens.functions import text as TX
from cinelens.operators import clean as CL
from cinelens.operators import keywords as KW
from cinelens.operators import sentiment as SN
from cinelens.operators.lookup import local_table, pair_table


def _docs(spark, texts):
    return spark.createDataFrame([(k, f"m{k % 2}", t) for k, t in enumerate(texts)], "ord long, movie_id string, Review string")


TEXTS = ["harbour lantern harbour!", "Lantern; violin (harbour)", "violin violin quay", None, " \n ", "quay quay 1999 ab lantern's"]


def test_counts_and_ties_by_first_place(spark):
    got = [tuple(r)[:2] for r in KW.top_keywords(_docs(spark, TEXTS), "Review").collect()]
    assert got == [("harbour", 3), ("lantern", 3), ("violin", 3), ("quay", 3)]
    # a tie within one row goes by position, also where it crosses the cut
    row = [tuple(r)[:2] for r in KW.top_keywords(_docs(spark, ["delta gamma omega sigma"]), "Review", top_n=2).collect()]
    assert row == [("delta", 1), ("gamma", 1)]


def test_per_movie_keywords_are_those_of_each_movie(spark):
    docs = _docs(spark, TEXTS)
    got = {}
    for r in KW.top_keywords(docs, "Review", top_n=2, group="movie_id").orderBy("movie_id", "rank").collect():
        got.setdefault(r["movie_id"], []).append((r["word"], r["count"]))
    for m in ("m0", "m1"):
        alone = KW.top_keywords(docs.where(f"movie_id = '{m}'"), "Review", top_n=2).collect()
        assert got[m] == [tuple(r)[:2] for r in alone]


def test_nothing_to_count(spark):
    assert KW.top_keywords(_docs(spark, [None, "", "\t", "12 ab !!"]), "Review").collect() == []


def test_lemmas_come_after_stopwords(spark):
    stop, lem = KW.stopwords(spark, ["quay"]), KW.lemmas(spark, [("quays", "quay"), ("violins", "violin")])
    got = {r["word"]: r["count"] for r in KW.top_keywords(
        _docs(spark, ["quay quays violins violin violins"]), "Review", stop=stop, lemma_table=lem).collect()}
    assert got == {"violin": 3, "quay": 1}


def test_text_without_stopwords_in_lemmas(spark):
    df = spark.createDataFrame([(5, "two violins on quays"), (6, " "), (7, "on on"), (8, None)], "id long, t string")
    got = KW.lemmatize_and_remove_stopwords(df, "id", "t", KW.stopwords(spark, ["on", "two"]),
                                            KW.lemmas(spark, {"violins": "violin", "quays": "quay"})).collect()
    assert {r["id"]: r["text"] for r in got} == {5: "violin quay", 6: "", 7: "", 8: ""}


def test_default_stopwords(spark):
    words = {r["token"] for r in KW.stopwords(spark).collect()}
    assert len(words) > 100 and {"himself", "which", "doesn't"} <= words


def test_first_sense_and_at_most_two_examples(spark):
    kw = spark.createDataFrame([("m1", "quay", 4, 2), ("m1", "zzz", 1, 3), ("m2", "quay", 9, 1)],
                               "movie_id string, word string, count long, rank int")
    senses = KW.senses(spark, [("quay", 7, "late sense", "v", ["x"]), ("quay", 3, "wharf", "n", ["e1", "e2", "e3"]), ("other", 1, "o", "n", None)])
    got = {(r["movie_id"], r["name"]): (r["value"], r["rank"], [tuple(c) for c in r["categories"]])
           for r in KW.enrich_keywords(kw, senses).collect()}
    assert got == {("m1", "quay"): (4, 2, [("wharf", "n", ["e1", "e2"])]), ("m1", "zzz"): (1, 3, []),
                   ("m2", "quay"): (9, 1, [("wharf", "n", ["e1", "e2"])])}


@pytest.mark.parametrize("size", [3, 7_500, 60_000])
def test_tables_of_any_size_are_built_alike(spark, size):
    lexicon = SN.lexicon_table(spark, {f"w{k}": k % 5 - 2 for k in range(size)})      # whole numbers for doubles
    assert dict(lexicon.dtypes)["valence"] == "double"
    assert lexicon.count() == size and lexicon.where("token = 'w1'").first()["valence"] == -1.0
    assert KW.lemmas(spark, {f"a{k}": f"b{k}" for k in range(size)}).count() == size


def test_tables_with_nulls_arrays_and_no_rows(spark):
    t = pair_table(spark, [("a", None, ["x"]), (None, 2, None), ("c", 3, [])], "k string, n int, v array<string>")
    assert [tuple(r) for r in t.collect()] == [("a", None, ["x"]), (None, 2, None), ("c", 3, [])]
    assert local_table(spark, [], "k string, n double").dtypes == [("k", "string"), ("n", "double")]


def test_one_pattern_finds_the_meaningful_words(spark):
    rng = random.Random(4)
    parts = ["a", "bc", "def", "Ghij", "n", "n't", "'s", "'ll", "'", "\u2019", "-", "--", "_", "7", " ", "  ", "\n", ".", "\u00e9", "e\u0301", "\u0130",
             "'re", "'m", "'d", "'ve", "x" * 18, "\u4e2d\u6587", "\U0001d51e"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(4000)]
    texts += [None, "", "shouldn't ann's shouldn't've cat'sing don't o'clock's x-ray's", "can't cannn't " + "z" * 19 + " " + "z" * 20 + "'s"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for low, high in ((2, 20), (0, 5), (-1, 4), (3, 3), (3, 5)):
        both = df.select(TX.meaningful(TX.word_tokens("t"), low, high).alias("a"), TX.meaningful_words("t", low, high).alias("b"))
        assert both.where("a is distinct from b").collect() == []


def test_blank_texts_of_any_space(spark):
    spaces = ["", " ", "\x1c\x1d\x1e\x1f", "\u00a0\u3000\u2028\u0085", "\t\r\n\x0b\x0c", None]
    df = spark.createDataFrame([(t,) for s in spaces for t in (s, s and s + "x" + s, s and s + "\u200b\n")], "t string")
    assert [r.t for r in CL.nonblank(df, "t").collect()] == [t for (t,) in df.collect() if t is not None and t.strip()]


def _both_ways(spark, rows, stop, lem):
    df = spark.createDataFrame(rows, "id long, t string")
    ways = [sorted(map(tuple, KW.lemmatize_and_remove_stopwords(df, "id", "t", stop, lem, max_words=n).collect()), key=str) for n in (1000, 0)]
    assert ways[0] == ways[1]
    return dict(ways[0])


def test_one_text_per_row_is_shuffled(spark):
    stop, lem = KW.stopwords(spark, ["on", "two"]), KW.lemmas(spark, [("violins", "violin"), ("quays", None), (None, "z"), ("two", "on")])
    rows = [(5, "two violins on quays"), (6, " "), (7, "on on"), (8, None), (None, "b a"), (None, "c"), (9, "d on b"), (9, "a c\u3000\x1cc violins"), (9, None)]
    got = _both_ways(spark, rows, stop, lem)
    assert got == {5: "violin quays", 6: "", 7: "", 8: "", None: "b c a", 9: "a d c b c violin"}
    df = spark.createDataFrame(rows, "id long, t string")
    plan = KW.lemmatize_and_remove_stopwords(df, "id", "t", stop, lem)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan and plan.count("Exchange") == 1
    assert _both_ways(spark, rows, None, None)[9] == "a d c on b c violins"


def test_lemmas_that_are_no_single_word(spark):
    rows = [(1, "ab cd ef"), (2, "cd")]
    for pairs in ([("cd", "c d")], [("cd", "")], [("cd", "x"), ("cd", "y")], [("cd", None), ("cd", "y")]):
        _both_ways(spark, rows, None, KW.lemmas(spark, pairs))


def test_python_splits_where_the_pattern_does(spark):
    chars = [c for c in map(chr, range(0x11000)) if not 0xd800 <= ord(c) < 0xe000]
    df = spark.createDataFrame([("a" + c + "b",) for c in chars], "t string")
    got = df.where(F.size(F.split("t", r"(?U)[\s\x{1c}-\x{1f}]+")) > 1).count()
    assert got == sum(len(("a" + c + "b").split()) > 1 for c in chars) > 20


def test_both_readers_of_the_counts_share_one_shuffle(spark):
    docs = _docs(spark, TEXTS).withColumn("movie_id", F.expr("if(ord = 2, null, movie_id)"))
    for group in (None, "movie_id"):
        df = KW.top_keywords(docs, "Review", top_n=2, group=group)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        # the counts and the leaders' first rows: two splittings of texts, not three
        assert plan.count("Generate posexplode") == 2, plan
    assert {r["movie_id"] for r in KW.top_keywords(docs, "Review", group="movie_id").collect()} == {"m0", "m1"}
