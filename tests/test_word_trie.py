"""The one-scan vocabulary gives what the joins give, at any size of lexicon."""

import random
import time

import pytest

from cinelens.operators import sentiment as SN
from cinelens.operators.word_trie import Vocabulary, split_words

from .test_sentiment import BOOST, IDIOMS, LEX, NEG

WORDS = [*LEX, *BOOST, *NEG, "the", "bomb", "kiss", "of", "death", "movie", "but", "least", "at", "never", "so", "this", "doubt", "Good!",
         "GREAT", "VERY", "don't", "plain", "word", "yeah", "right", "?", "!!", "(bad)", "kind", "É", "ﬁne"]


def _tables(spark):
    return SN.lexicon_table(spark, LEX), SN.booster_table(spark, BOOST), SN.negation_table(spark, NEG), SN.idiom_table(spark, IDIOMS)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(9)
    rows = [(k, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(40))), k % 3) for k in range(400)]
    rows += [(400, None, 1), (401, "", 1), (402, " \t\n ", 1), (403, "good " * 20000, 1), (404, "good", 1)]
    return spark.createDataFrame(rows, "id long, t string, other int").repartition(3).checkpoint()


def test_trie_equals_joins(spark, texts):
    lex, bst, neg, idi = _tables(spark)
    for fn in (lambda m: SN.sentiment_scores(texts, "id", "t", lex, bst, neg, idioms=idi, method=m),
               lambda m: SN.word_valences(texts, "id", "t", lex, bst, neg, idioms=idi, method=m),
               lambda m: SN.score_sentiment(texts, "id", "t", lex, bst, neg, idioms=idi, method=m).select("id", "other", *SN.SCORE_COLUMNS)):
        a, b = ([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in fn(m).collect()] for m in ("trie", "joins"))
        assert sorted(a) == sorted(b) and len(a) > 400


def test_one_scan_without_join_or_shuffle(spark, texts):
    lex, bst, neg, idi = _tables(spark)
    plan = _plan(SN.score_sentiment(texts, "id", "t", lex, bst, neg, idioms=idi))
    assert "Join" not in plan and "Exchange" not in plan and plan.count("ArrowEvalPython") == 1
    assert "RoundRobinPartitioning(7)" in _plan(SN.score_sentiment(texts, "id", "t", lex, bst, neg, partitions=7))


def test_repeated_ids_and_other_columns_stay(spark):
    lex, bst, neg, _ = _tables(spark)
    df = spark.createDataFrame([(1, "good", "a"), (1, "bad", "b"), (None, None, None)], "id long, t string, n string")
    got = SN.score_sentiment(df, "id", "t", lex, bst, neg).collect()
    assert [(r.id, r.n, r.Compound > 0, r.Compound < 0) for r in got] == [(1, "a", True, False), (1, "b", False, True), (None, None, False, False)]


def test_large_lexicon_is_planned_quickly(spark, texts):
    lex = SN.lexicon_table(spark, {f"w{k}": 1.0 for k in range(200_000)} | {"good": 1.9})
    SN.sentiment_scores(texts, "id", "t", SN.lexicon_table(spark, LEX))
    t = time.time()
    df = SN.sentiment_scores(texts, "id", "t", lex)
    _plan(df)
    assert time.time() - t < 10       # under 2 s on an idle machine
    assert df.where("Compound > 0").count() > 0


def test_beyond_the_bound_the_joins_take_over(spark, texts, monkeypatch):
    lex, bst, neg, idi = _tables(spark)
    assert SN.vocabulary(lex, bst, neg, idi, max_words=10) is None
    assert SN.vocabulary(lex, bst, neg, idi, max_words=len(LEX) + len(BOOST) + len(NEG) + len(IDIOMS)) is not None
    monkeypatch.setattr(SN.vocabulary, "__defaults__", (None, None, None, 10))
    assert "Join" in _plan(SN.sentiment_scores(texts, "id", "t", lex, bst, neg))
    with pytest.raises(ValueError, match="more than"):
        SN.sentiment_scores(texts, "id", "t", lex, bst, neg, method="trie")


def test_phrases_and_words():
    v = Vocabulary([("Good", 1.0), ("good", 2.0), (None, 1.0)], [("kind of", -0.3), ("very", 0.3)], ["Not", None], [("the bomb squad", 3.0), ("the bomb", 1.0)])
    assert v.valence == {"good": 2.0} and v.negation == {"not"}
    assert v.phrases_from(["the", "bomb", "squad"], 0) == {2: (1.0, None), 3: (3.0, None)}
    assert v.phrases_from(["kind", "of"], 0) == {2: (None, -0.3)} and v.phrases_from(["very"], 0) == {}
    assert split_words('"well," he (!) said... :) ok!') == ["well", "he", "(!)", "said", ":)", "ok!"]
