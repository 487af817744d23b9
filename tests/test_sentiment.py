import math
import string

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cinelens.functions.labels import add_sentiment_labels, classify_compound
from cinelens.operators import sentiment as SN

LEX = {"good": 1.9, "bad": -2.5, "great": 3.1, "awful": -2.0, "kind": 0.5, "recommend": 1.5, "fine": 0.8}
BOOST = {"very": 0.293, "really": 0.293, "slightly": -0.293, "extremely": 0.293, "kind of": -0.293}
IDIOMS = {"the bomb": 3.0, "yeah right": -2.0, "kiss of death": -1.5, "good movie": 2.6}
NEG = ["not", "never", "without", "none", "isn't", "no"]


def model(text, lex=LEX, boosters=BOOST, negs=NEG, contrast="but", C=0.733, N=-0.74, idioms=IDIOMS):
    """Independent Python statement of the scoring rules (unrounded)."""
    words = []
    for w in (text or "").split():
        s = w.strip(string.punctuation)
        words.append(w if len(s) <= 2 else s)
    n = len(words)
    if n == 0:
        return (0.0, 0.0, 0.0, 0.0)
    ncaps = sum(1 for w in words if w.isupper())
    capdiff = 0 < ncaps < n
    lw = [w.lower() for w in words]

    def negated(w):
        return w in negs or "n't" in w

    sent = []
    for i, w in enumerate(words):
        lo = lw[i]
        if lo in boosters or (i < n - 1 and lo == "kind" and lw[i + 1] == "of") or lo not in lex:
            sent.append(0.0)
            continue
        v = lex[lo]
        if w.isupper() and capdiff:
            v = v + C if v > 0 else v - C
        for si in range(3):
            if i > si and lw[i - (si + 1)] not in lex:
                pw, pl = words[i - (si + 1)], lw[i - (si + 1)]
                s = 0.0
                if pl in boosters:
                    s = boosters[pl] * (-1 if v < 0 else 1)
                    if pw.isupper() and capdiff:
                        s = s + C if v > 0 else s - C
                if si == 1 and s != 0:
                    s *= 0.95
                if si == 2 and s != 0:
                    s *= 0.9
                v += s
                if si == 0:
                    if negated(lw[i - 1]):
                        v *= N
                elif si == 1:
                    if lw[i - 2] == "never" and lw[i - 1] in ("so", "this"):
                        v *= 1.25
                    elif lw[i - 2] == "without" and lw[i - 1] == "doubt":
                        pass
                    elif negated(lw[i - 2]):
                        v *= N
                else:
                    if (lw[i - 3] == "never" and lw[i - 2] in ("so", "this")) or lw[i - 1] in ("so", "this"):
                        v *= 1.25
                    elif lw[i - 3] == "without" and (lw[i - 2] == "doubt" or lw[i - 1] == "doubt"):
                        pass
                    elif negated(lw[i - 3]):
                        v *= N
                    seqs = [f"{lw[i-1]} {lw[i]}", f"{lw[i-2]} {lw[i-1]} {lw[i]}", f"{lw[i-2]} {lw[i-1]}",
                            f"{lw[i-3]} {lw[i-2]} {lw[i-1]}", f"{lw[i-3]} {lw[i-2]}"]
                    for seq in seqs:
                        if seq in idioms:
                            v = idioms[seq]
                            break
                    if n - 1 > i and f"{lw[i]} {lw[i+1]}" in idioms:
                        v = idioms[f"{lw[i]} {lw[i+1]}"]
                    if n - 1 > i + 1 and f"{lw[i]} {lw[i+1]} {lw[i+2]}" in idioms:
                        v = idioms[f"{lw[i]} {lw[i+1]} {lw[i+2]}"]
                    for ng in (f"{lw[i-3]} {lw[i-2]} {lw[i-1]}", f"{lw[i-3]} {lw[i-2]}", f"{lw[i-2]} {lw[i-1]}"):
                        if ng in boosters:
                            v += boosters[ng]
        if i > 1 and lw[i - 1] not in lex and lw[i - 1] == "least":
            if lw[i - 2] not in ("at", "very"):
                v *= N
        elif i > 0 and lw[i - 1] not in lex and lw[i - 1] == "least":
            v *= N
        sent.append(v)
    if contrast in lw:
        bi = lw.index(contrast)
        sent = [s * 0.5 if k < bi else s * 1.5 if k > bi else s for k, s in enumerate(sent)]
    amp = min(text.count("!"), 4) * 0.292
    qm = text.count("?")
    if qm > 1:
        amp += qm * 0.18 if qm <= 3 else 0.96
    total = sum(sent)
    total = total + amp if total > 0 else total - amp if total < 0 else total
    comp = max(-1.0, min(1.0, total / math.sqrt(total * total + 15)))
    ps = sum(s + 1 for s in sent if s > 0)
    ns = sum(s - 1 for s in sent if s < 0)
    neu = sum(1 for s in sent if s == 0)
    if ps > abs(ns):
        ps += amp
    elif ps < abs(ns):
        ns -= amp
    t = ps + abs(ns) + neu
    return (comp, abs(ns / t), abs(neu / t), abs(ps / t))


def _score(spark, texts, contrast="but"):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, Review string")
    out = SN.score_sentiment(df, "id", "Review", SN.lexicon_table(spark, LEX), SN.booster_table(spark, BOOST),
                             SN.negation_table(spark, NEG), contrast=contrast, idioms=SN.idiom_table(spark, IDIOMS))
    return {r["id"]: (r["Compound"], r["Negative"], r["Neutral"], r["Positive"]) for r in out.collect()}


VOCAB = ["good", "GOOD", "bad", "Bad", "great", "awful", "kind", "of", "very", "VERY", "really", "slightly",
         "not", "never", "so", "this", "without", "doubt", "least", "at", "but", "isn't", "no", "the",
         "movie", "MOVIE", "it", "was", "good!", "bad?", "fine.", "!!!", "??", "recommend", "a",
         "bomb", "yeah", "right", "kiss", "death"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.sampled_from(VOCAB), min_size=0, max_size=14).map(" ".join),
                min_size=1, max_size=12))
def test_relational_scores_match_python_model(spark, texts):
    got = _score(spark, texts)
    for i, t in enumerate(texts):
        want = model(t)
        assert abs(got[i][0] - want[0]) <= 6e-5, (t, got[i], want)
        for g, w in zip(got[i][1:], want[1:]):
            assert abs(g - w) <= 6e-4, (t, got[i], want)


def test_a_negation_flips_within_three_words_only(spark):
    got = _score(spark, ["fine", "not fine", "not x fine", "not x y fine", "not x y z fine", "isn't bad"])
    assert got[0][0] > 0 and got[4][0] > 0
    assert all(got[k][0] < 0 for k in (1, 2, 3)) and got[5][0] > 0
    assert abs(got[3][0] - model("not x y fine")[0]) < 6e-5


def test_rules_of_other_releases(spark):
    df = spark.createDataFrame([(0, "never so fine"), (1, "without doubt fine"), (2, "x without doubt fine")], "id long, t string")

    def scores(rules):
        out = SN.sentiment_scores(df, "id", "t", SN.lexicon_table(spark, LEX), SN.booster_table(spark, BOOST),
                                  SN.negation_table(spark, NEG), rules=rules)
        return {r["id"]: r["Compound"] for r in out.collect()}

    usual, other = scores(SN.Rules()), scores(SN.Rules(never_factor_2=1.5, without_doubt=False))
    assert other[0] > usual[0] > 0
    assert usual[1] > 0 > other[1] and usual[2] > 0 > other[2]


def test_idioms_override_and_phrase_boosters(spark):
    # "good movie" (word + next) overrides; "kind of" before the word adds its scalar
    got = _score(spark, ["the x y good movie", "a b c good", "x kind of good", "x y z good"])
    assert abs(got[0][0] - model("the x y good movie")[0]) < 6e-5
    assert got[0][0] > got[1][0]
    assert got[2][0] < got[3][0]


def test_empty_and_null_text_score_zero(spark):
    got = _score(spark, ["", None, "   "])
    assert all(v == (0.0, 0.0, 0.0, 0.0) for v in got.values())


def test_contrast_and_punctuation(spark):
    got = _score(spark, ["good but bad", "good", "good!!!", "good ??"])
    assert got[0][0] < 0                      # after "but" weighs 1.5, before 0.5
    assert got[2][0] > got[1][0] and got[3][0] > got[1][0]


def test_another_scorer_can_be_plugged_in(spark):
    @F.pandas_udf("struct<neg:double,neu:double,pos:double,compound:double>")
    def by_length(texts: pd.Series) -> pd.DataFrame:
        share = texts.str.len().clip(upper=10) / 10
        return pd.DataFrame({"neg": 0.0, "neu": 1 - share, "pos": share, "compound": share})

    df = spark.createDataFrame([(3, "abcd", "kept"), (4, None, "kept"), (5, "x" * 40, "kept")], "id long, t string, other string")
    out = SN.score_sentiment(df, "id", "t", scorer=by_length, columns=("c", "n", "u", "p")).orderBy("id").collect()
    assert [(r["c"], r["n"], round(r["u"], 6), r["p"], r["other"]) for r in out] == [
        (0.4, 0.0, 0.6, 0.4, "kept"), (0.0, 0.0, 1.0, 0.0, "kept"), (1.0, 0.0, 0.0, 1.0, "kept")]


def test_label_limits_are_strict_and_can_be_moved(spark):
    values = [0.0501, 0.0500, -0.0500, -0.0501, 1.0, -1.0, float("nan"), None]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, Compound double")
    label = {r["k"]: r["Sentiment_label"] for r in add_sentiment_labels(df).collect()}
    assert [label[k][:3] for k in range(8)] == ["pos", "neu", "neu", "neg", "pos", "neg", "neu", "neu"]
    moved = df.select("k", classify_compound("Compound", pos_threshold=0.0499, neg_threshold=-0.9).alias("l")).collect()
    assert [r["l"][:3] for r in sorted(moved)] == ["pos", "pos", "neu", "neu", "pos", "neg", "neu", "neu"]
