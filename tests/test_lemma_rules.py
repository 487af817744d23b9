"""Lemmas by rules: against a plain statement of the method, and by hand."""

import random

from pyspark.ml.feature import StopWordsRemover

from cinelens.operators import keywords as KW
from cinelens.operators.lemma_rules import NOUN_RULES, rule_lemmas
from cinelens.sources.lexicons import ENGLISH_STOPWORDS

WORDS = ["movie", "box", "church", "wish", "wolf", "man", "city", "bus", "boss", "glass", "as", "s", "quiz", "axis", "women", "woman"]
ODD = {"axes": ["axis", "axe"], "geese": ["goose"], "women": ["woman"]}


def plain(word, known, odd):
    def made(forms):
        return [f[:len(f) - len(a)] + b for f in forms for a, b in NOUN_RULES if f.endswith(a)]

    if word in odd:
        hits = [f for f in [word, *odd[word]] if f in known]
        return min(hits, key=len) if hits else None
    forms = made([word])
    hits = [f for f in [word, *forms] if f in known]
    while not hits and forms:
        forms = made(forms)
        hits = [f for f in forms if f in known]
    return min(hits, key=len) if hits else None


def test_rules_match_the_plain_method(spark):
    rng = random.Random(6)
    tokens = {w + "".join(rng.choice(["s", "es", "ses", "ves", "xes", "men", "ies", "x"]) for _ in range(rng.randrange(4))) for w in WORDS for _ in range(12)}
    tokens |= {*WORDS, *ODD, "wolves", "movies", "cities", "churches", "wishes", "boxes", "bosses", "sssss", "", "xyz"}
    df = spark.createDataFrame([(t,) for t in [*sorted(tokens), "movies", None]], "token string")
    known = spark.createDataFrame([(w,) for w in [*WORDS, "movie"]], "form string")
    got = {r.token: r.lemma for r in rule_lemmas(df, known, exceptions=ODD).collect()}
    assert got == {t: m for t in tokens if (m := plain(t, set(WORDS), ODD)) is not None}
    assert (got["wolves"], got["cities"], got["axes"], got["women"], got["bosses"]) == ("wolf", "city", "axis", "women", "boss")
    assert "geese" not in got and "xyz" not in got
    # the table is one for ``lemmatize``
    kept = {r.token for r in KW.lemmatize(df.where("token in ('movies', 'xyz', 'geese')"), rule_lemmas(df, known, exceptions=ODD)).collect()}
    assert kept == {"movie", "xyz", "geese"}


def test_nothing_to_do(spark):
    none = spark.createDataFrame([], "token string")
    assert rule_lemmas(none, none).collect() == []


def test_default_stopwords(spark):
    assert sorted(r.token for r in KW.stopwords(spark).collect()) == sorted(set(ENGLISH_STOPWORDS))
    assert ENGLISH_STOPWORDS == list(StopWordsRemover.loadDefaultStopWords("english"))


def test_words_and_dictionary_are_worked_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    tokens = spark.createDataFrame([(w,) for w in ["movies", "sssss", "xyz", "movie"]], "token string").coalesce(1).mapInArrow(passed, "token string")
    got = {r.token: r.lemma for r in rule_lemmas(tokens, tokens.where("token = 'movie'")).collect()}
    # once as words and once as dictionary, however many rounds the endings take
    assert got == {"movies": "movie", "movie": "movie"} and seen.value == 8


def test_registered_lemmas_read_the_reviews_once(spark, tmp_dir, monkeypatch):
    from cinelens import catalog
    reads = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    text = " ".join(["harbour"] * 25 + ["harbours", "sssssss"])
    raw = spark.createDataFrame([(k, text) for k in range(3)], "ord long, Review string").coalesce(1).mapInArrow(passed, "ord long, Review string")
    monkeypatch.setattr(catalog, "_raw", lambda *_: raw)
    got = {r.token: r.lemma for r in catalog.QUERIES["J6_rule_lemmas"](spark, tmp_dir).collect()}
    assert got == {"harbour": "harbour", "harbours": "harbour"} and reads.value == 3
