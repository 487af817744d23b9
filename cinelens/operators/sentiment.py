"""Lexicon-based sentiment scoring as a relational job (A9 = V1-V9, J7).

Implements the rule-based method of Hutto & Gilbert (ICWSM 2014): lexicon
valence per word, all-caps emphasis, booster words, negation within three
words, "never so/this" and "without doubt", "least", contrastive "but",
``!``/``?`` emphasis, and the normalised compound score with pos/neg/neu
shares. Lexicon, boosters and negations are DataFrames.

Two ways to the same numbers:

* ``trie`` (the usual one): the word tables are read once into a
  ``Vocabulary`` (a dictionary of words and a trie of phrases), broadcast, and
  applied by an Arrow function next to the text column: one scan, no join, no
  shuffle, whatever the number of lexicon words up to ``MAX_WORDS``.
* ``joins`` (beyond that size, where a broadcast has no bound): words are
  exploded with their neighbours and looked up by joins; a per-document
  aggregate (combined map-side) leaves one narrow row per document.

``sentiment_scores`` returns scores by id, ``score_sentiment`` appends them to
all columns of its input.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import lexicons as LX
from . import word_trie
from .lookup import pair_table, word_table

# --- fixed values -------------------------------------------------------------
# Python's string.punctuation, as a regex character class.
PUNCT_CLASS = r"[!-/:-@\[-`{-~]"
EXCLAIM_WEIGHT = 0.292      # per "!" (at most 4 counted)
EXCLAIM_MAX = 4
QUESTION_WEIGHT = 0.18      # per "?" when there are 2 or 3
QUESTION_CAP = 0.96         # when there are more than 3
DAMP_2, DAMP_3 = 0.95, 0.9  # booster damping at distance 2 and 3
NEVER_FACTOR = 1.25         # "never so/this" emphasis
BUT_BEFORE, BUT_AFTER = 0.5, 1.5
NEVER_WORDS = ("so", "this")
# -----------------------------------------------------------------------------

#: Words of all tables together up to which they are broadcast as one vocabulary.
MAX_WORDS = 1_000_000
SCORE_COLUMNS = ("Compound", "Negative", "Neutral", "Positive")


def lexicon_table(spark: SparkSession, mapping) -> DataFrame:
    """``(token, valence)`` from a dict or pairs."""
    return pair_table(spark, mapping, "token string, valence double")


def booster_table(spark: SparkSession, mapping=None) -> DataFrame:
    """``(token, scalar)``; default = the published booster words."""
    return pair_table(spark, mapping if mapping is not None else LX.booster_table_default(),
                      "token string, scalar double")


def negation_table(spark: SparkSession, words=None) -> DataFrame:
    """``(token)``; default = the published negation words."""
    return word_table(spark, words if words is not None else LX.NEGATIONS, "token")


def idiom_table(spark: SparkSession, mapping=None) -> DataFrame:
    """``(phrase, valence)``; default = the published multi-word idioms."""
    return pair_table(spark, mapping if mapping is not None else LX.IDIOMS, "phrase string, valence double")


# phrase slots read by the idiom rule: name -> words joined by spaces
PHRASE_SLOTS = {"10": ("p1", "lw"), "210": ("p2", "p1", "lw"), "21": ("p2", "p1"),
                "321": ("p3", "p2", "p1"), "32": ("p3", "p2"), "01": ("lw", "nx"), "012": ("lw", "nx", "nx2")}


def _isupper(c: Column) -> Column:
    """Python ``str.isupper``: some cased character and none lower-case."""
    return (F.upper(c) == c) & (F.lower(c) != c)


def _count_char(text: Column, ch: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(ch), F.lit("")))


def punctuation_amplifier(text: Column) -> Column:
    """V7: ``!`` and ``?`` emphasis added to a non-zero sum."""
    ep = F.least(_count_char(text, "!"), F.lit(EXCLAIM_MAX)) * EXCLAIM_WEIGHT
    qm = _count_char(text, "?")
    qa = F.when(qm > 1, F.when(qm <= 3, qm * QUESTION_WEIGHT).otherwise(QUESTION_CAP)).otherwise(0.0)
    return ep + qa


# Token = maximal run of non-space; CORE = the token without edge punctuation.
_NS = r"[^\s\x{1c}-\x{1f}]"
_TOKEN = f"(?U){_NS}+"
_CORE = f"(?U)(?<!{_NS})(?={_NS}){PUNCT_CLASS}*({_NS}*?){PUNCT_CLASS}*(?!{_NS})"
# A token with a cased letter and no lower-case letter (Python's str.isupper).
_ALLCAPS = f"(?U)(?<!{_NS})(?={_NS}*[\\p{{Lu}}\\p{{Lt}}])[^\\s\\x{{1c}}-\\x{{1f}}\\p{{Ll}}]+(?!{_NS})"


def _words(text: Column) -> Column:
    """V1 on a whole text: whitespace tokens, edge punctuation stripped unless
    that leaves 2 characters or fewer (two aligned regex passes, no per-word regex)."""
    toks = F.regexp_extract_all(text, F.lit(_TOKEN), 0)
    cores = F.regexp_extract_all(text, F.lit(_CORE), 1)
    return F.zip_with(toks, cores, lambda t, c: F.when(F.length(c) <= 2, t).otherwise(c))


def _doc_features(df: DataFrame, id_col: str, text_col: str, contrast: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(
        F.col(id_col).alias("__id"),
        _words(text).alias("__w"),
        punctuation_amplifier(text).alias("__amp"),
        F.size(F.regexp_extract_all(text, F.lit(_ALLCAPS), 0)).alias("__ncaps"),
    ).withColumn("__lw", F.transform("__w", F.lower)).select(
        "__id", "__w", "__lw", "__amp",
        F.size("__w").alias("__n"),
        (F.array_position("__lw", contrast) - 1).alias("__bi"),
        ((F.col("__ncaps") > 0) & (F.col("__ncaps") < F.size("__w"))).alias("__capdiff"),
    )


def _contexts(feat: DataFrame) -> DataFrame:
    """One row per word with its neighbours, and one for a document without any (``i`` null); arrays are never copied per row."""
    w, lw = F.col("__w"), F.col("__lw")

    def ctx(word, i):
        return F.struct(
            i.alias("i"), word.alias("w"), F.get(lw, i).alias("lw"),
            F.get(w, i - 1).alias("o1"), F.get(w, i - 2).alias("o2"), F.get(w, i - 3).alias("o3"),
            F.get(lw, i - 1).alias("p1"), F.get(lw, i - 2).alias("p2"), F.get(lw, i - 3).alias("p3"),
            F.get(lw, i + 1).alias("nx"), F.get(lw, i + 2).alias("nx2"))

    return feat.select("__id", "__n", "__amp", "__capdiff", "__bi", F.explode_outer(F.transform(w, ctx)).alias("c")).select(
        "__id", "__n", "__amp", "__capdiff", "__bi", "c.*")


def _vocab(lexicon: DataFrame, boosters: DataFrame, negations: DataFrame) -> DataFrame:
    lex = lexicon.select(F.lower("token").alias("token"), F.col("valence").cast("double"),
                         F.lit(None).cast("double").alias("scalar"), F.lit(False).alias("neg"))
    bst = boosters.select(F.lower("token").alias("token"), F.lit(None).cast("double").alias("valence"),
                          F.col("scalar").cast("double"), F.lit(False).alias("neg"))
    ngt = negations.select(F.lower(negations.columns[0]).alias("token"),
                           F.lit(None).cast("double").alias("valence"),
                           F.lit(None).cast("double").alias("scalar"), F.lit(True).alias("neg"))
    return lex.unionByName(bst).unionByName(ngt).groupBy("token").agg(
        F.max("valence").alias("valence"), F.max("scalar").alias("scalar"), F.max("neg").alias("neg"))


@dataclass(frozen=True)
class Rules:
    """Small rules in which releases of the method differ; the defaults follow the published implementation."""

    never_factor_2: float = NEVER_FACTOR     # "never so/this <word>"
    never_factor_3: float = NEVER_FACTOR     # the same one word farther, or "so/this" just before
    without_doubt: bool = True               # "without doubt" does not negate


def _valence_steps(hits: DataFrame, C: float, N: float, rules: Rules = Rules()) -> DataFrame:
    """Per-word valence (V2-V6) for lexicon words, one projection per rule.

    Each step reads the previous step's column by name, so the expression
    tree stays linear in the number of rules.
    """
    col = F.col
    cap = col("__capdiff")
    v = col("valence")
    out = hits.withColumn("__v", F.when(_isupper(col("w")) & cap,
                                        F.when(v > 0, v + C).otherwise(v - C)).otherwise(v))
    for k in (1, 2, 3):
        v = col("__v")
        p, o, boost = col(f"p{k}"), col(f"o{k}"), col(f"b{k}")
        s = F.when(boost.isNotNull(),
                   F.when(v < 0, -boost).otherwise(boost)
                   + F.when(_isupper(o) & cap, F.when(v > 0, F.lit(C)).otherwise(F.lit(-C))).otherwise(0.0)
                   ).otherwise(F.lit(0.0))
        if k == 2:
            s = s * DAMP_2
        if k == 3:
            s = s * DAMP_3
        out = out.withColumn("__vb", v + s)
        vb = col("__vb")
        negated = F.coalesce(col(f"n{k}"), F.lit(False)) | p.contains("n't")
        if k == 1:
            vn = F.when(negated, vb * N).otherwise(vb)
        elif k == 2:
            doubt = F.lit(rules.without_doubt) & (col("p2") == "without") & (col("p1") == "doubt")
            vn = (F.when((col("p2") == "never") & col("p1").isin(*NEVER_WORDS), vb * rules.never_factor_2)
                  .when(doubt, vb).when(negated, vb * N).otherwise(vb))
        else:
            doubt = F.lit(rules.without_doubt) & (col("p3") == "without") & ((col("p2") == "doubt") | (col("p1") == "doubt"))
            vn = (F.when(((col("p3") == "never") & col("p2").isin(*NEVER_WORDS))
                         | col("p1").isin(*NEVER_WORDS), vb * rules.never_factor_3)
                  .when(doubt, vb).when(negated, vb * N).otherwise(vb))
        applies = (col("i") >= k) & ~F.coalesce(col(f"l{k}"), F.lit(False))
        out = out.withColumn("__v", F.when(applies, vn).otherwise(v))
        if k == 3 and "iv_10" in out.columns:
            # idioms: the first matching preceding phrase sets the valence, a following
            # phrase overrides it, multi-word boosters before the word add their scalar
            v = col("__v")
            seq = F.coalesce(*[col(f"iv_{x}") for x in ("10", "210", "21", "321", "32")], v)
            seq = F.coalesce(col("iv_012"), col("iv_01"), seq)
            seq = seq + sum((F.coalesce(col(f"ib_{x}"), F.lit(0.0)) for x in ("321", "32", "21")), F.lit(0.0))
            out = out.withColumn("__v", F.when(applies, seq).otherwise(v))
    v = col("__v")
    least1 = (col("i") > 0) & ~F.coalesce(col("l1"), F.lit(False)) & (col("p1") == "least")
    out = out.withColumn("__v", F.when(least1 & (col("i") > 1),
                                       F.when((col("p2") != "at") & (col("p2") != "very"), v * N).otherwise(v))
                         .when(least1, v * N).otherwise(v))
    v = col("__v")
    # a booster word, or "kind" in "kind of", scores 0 itself
    out = out.withColumn("__v", F.when(col("wb").isNotNull() | ((col("lw") == "kind") & (col("nx") == "of")),
                                       F.lit(0.0)).otherwise(v))
    v, bi = col("__v"), col("__bi")
    # contrast: before the first contrast word x0.5, after it x1.5
    return out.withColumn("__v", F.when((bi >= 0) & (col("i") < bi), v * BUT_BEFORE)
                          .when((bi >= 0) & (col("i") > bi), v * BUT_AFTER).otherwise(v))


def _valences(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame, boosters: DataFrame | None,
              negations: DataFrame | None, contrast: str, c_incr: float, n_scalar: float, idioms: DataFrame | None,
              rules: Rules = Rules()) -> DataFrame:
    """Words with their valences ``__v`` (null where the lexicon has none) and their document's features."""
    spark = df.sparkSession
    boosters = boosters if boosters is not None else booster_table(spark)
    negations = negations if negations is not None else negation_table(spark)
    vocab = _vocab(lexicon, boosters, negations)
    ctx = _contexts(_doc_features(df, id_col, text_col, contrast.lower()))
    hits = ctx.join(vocab.where(F.col("valence").isNotNull())
                    .select(F.col("token").alias("lw"), "valence", F.col("scalar").alias("wb")), "lw", "left")
    for k in (1, 2, 3):
        side = vocab.select(F.col("token").alias(f"p{k}"), F.col("valence").isNotNull().alias(f"l{k}"),
                            F.col("scalar").alias(f"b{k}"), F.col("neg").alias(f"n{k}"))
        hits = hits.join(side, f"p{k}", "left")
    idioms = idioms if idioms is not None else idiom_table(spark)
    phrases = (
        idioms.select(F.lower("phrase").alias("phrase"), F.col("valence").cast("double").alias("iv"),
                      F.lit(None).cast("double").alias("ib"))
        .unionByName(boosters.where(F.col("token").contains(" ")).select(
            F.lower("token").alias("phrase"), F.lit(None).cast("double").alias("iv"),
            F.col("scalar").cast("double").alias("ib")))
        .groupBy("phrase").agg(F.max("iv").alias("iv"), F.max("ib").alias("ib")))
    for slot, parts in PHRASE_SLOTS.items():
        # concat is null when a word is missing, so a phrase exists only where all its words do
        words = [c for x in parts for c in (F.col(x), F.lit(" "))][:-1]
        hits = hits.withColumn(f"ph_{slot}", F.concat(*words))
        side = phrases.select(F.col("phrase").alias(f"ph_{slot}"), F.col("iv").alias(f"iv_{slot}"),
                              F.col("ib").alias(f"ib_{slot}"))
        hits = hits.join(side, f"ph_{slot}", "left")
    steps = _valence_steps(hits, c_incr, n_scalar, rules)
    # phrases around a word that the lexicon does not know give it no valence
    return steps.withColumn("__v", F.when(F.col("valence").isNotNull(), F.col("__v")))


# --- the vocabulary on the way of one scan --------------------------------------------


def vocabulary(lexicon: DataFrame, boosters: DataFrame | None = None, negations: DataFrame | None = None,
               idioms: DataFrame | None = None, max_words: int = MAX_WORDS) -> word_trie.Vocabulary | None:
    """The word tables as one ``Vocabulary``; None if they have more than ``max_words`` rows.

    No table is read further than that bound.
    """
    spark = lexicon.sparkSession
    boosters = boosters if boosters is not None else booster_table(spark)
    negations = negations if negations is not None else negation_table(spark)
    idioms = idioms if idioms is not None else idiom_table(spark)
    lists, room = [], max_words
    for table in (lexicon.select("token", F.col("valence").cast("double")), boosters.select("token", F.col("scalar").cast("double")),
                  negations.select(negations.columns[0]), idioms.select("phrase", F.col("valence").cast("double"))):
        cols = [c.to_pylist() for c in table.limit(room + 1).toArrow().columns]
        room -= len(cols[0])
        if room < 0:
            return None
        lists.append(list(zip(*cols)) if len(cols) > 1 else cols[0])
    return word_trie.Vocabulary(*lists)


def _scorer(df: DataFrame, known: word_trie.Vocabulary, contrast: str, c_incr: float, n_scalar: float, rules: Rules):
    consts = {"caps": c_incr, "negated": n_scalar, "damp": {1: 1.0, 2: DAMP_2, 3: DAMP_3}, "never_words": NEVER_WORDS,
              "but_before": BUT_BEFORE, "but_after": BUT_AFTER}
    return df.sparkSession.sparkContext.broadcast(word_trie.Scorer(known, contrast.lower(), consts, rules))


def _sums(shared, text: Column) -> Column:
    @F.arrow_udf(word_trie.SUMS)
    def sums(texts: pa.Array) -> pa.Array:
        return word_trie.sums_of(shared.value, texts)
    return sums(text)


def _hits(shared, text: Column) -> Column:
    @F.arrow_udf(word_trie.HITS)
    def hits(texts: pa.Array) -> pa.Array:
        return word_trie.hits_of(shared.value, texts)
    return hits(text)


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def _spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Dealt over ``partitions`` tasks where the caller asks for it (a table of few row groups has few tasks)."""
    return df if partitions is None else df.repartition(partitions)


def _known(method: str, lexicon, boosters, negations, idioms) -> word_trie.Vocabulary | None:
    if method not in ("auto", "trie", "joins"):
        raise ValueError(f"unknown method {method!r}")
    if method == "joins":
        return None
    known = vocabulary(lexicon, boosters, negations, idioms)
    if known is None and method == "trie":
        raise ValueError(f"the word tables have more than {MAX_WORDS} rows")
    return known


def word_valences(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame,
                  boosters: DataFrame | None = None, negations: DataFrame | None = None,
                  contrast: str = "but", c_incr: float = LX.C_INCR,
                  n_scalar: float = LX.N_SCALAR, idioms: DataFrame | None = None, rules: Rules = Rules(),
                  method: str = "auto", partitions: int | None = None) -> DataFrame:
    """J7 + V1-V6: ``(id, i, word, valence)`` for lexicon words."""
    known = _known(method, lexicon, boosters, negations, idioms)
    df = _spread(df, partitions)
    if known is not None:
        shared = _scorer(df, known, contrast, c_incr, n_scalar, rules)
        return df.select(F.col(id_col).alias("__id"), F.explode(_hits(shared, _text(text_col))).alias("h")).select("__id", "h.*")
    steps = _valences(df, id_col, text_col, lexicon, boosters, negations, contrast, c_incr, n_scalar, idioms, rules)
    return steps.where("valence is not null").select(F.col("__id"), F.col("i"), F.col("w").alias("word"), F.col("__v").alias("valence"))


def _final_scores(total: Column, n: Column, pos: Column, neg: Column, npos: Column, nneg: Column, amp: Column,
                  alpha: float, columns) -> dict[str, Column]:
    """V7-V9: the four scores from a document's sums (any of them may be null: no lexicon word)."""
    compound, negative, neutral, positive = columns
    zero = F.lit(0.0)
    ssum = F.coalesce(total, zero)
    ssum = F.when(ssum > 0, ssum + amp).when(ssum < 0, ssum - amp).otherwise(ssum)
    comp = ssum / F.sqrt(ssum * ssum + F.lit(alpha))
    comp = F.greatest(F.least(comp, F.lit(1.0)), F.lit(-1.0))
    pos, neg = F.coalesce(pos, zero), F.coalesce(neg, zero)
    neu = (n - npos - nneg).cast("double")
    pos2 = F.when(pos > F.abs(neg), pos + amp).otherwise(pos)
    neg2 = F.when(pos < F.abs(neg), neg - amp).otherwise(neg)
    whole = pos2 + F.abs(neg2) + neu
    has = n > 0
    return {compound: F.when(has, F.bround(comp, 4)).otherwise(zero),
            negative: F.when(has, F.bround(F.abs(neg2 / whole), 3)).otherwise(zero),
            neutral: F.when(has, F.bround(F.abs(neu / whole), 3)).otherwise(zero),
            positive: F.when(has, F.bround(F.abs(pos2 / whole), 3)).otherwise(zero)}


def _append_scores(df: DataFrame, text_col: str, known: word_trie.Vocabulary, contrast: str, alpha: float, columns,
                   rules: Rules) -> DataFrame:
    shared = _scorer(df, known, contrast, LX.C_INCR, LX.N_SCALAR, rules)
    text = _text(text_col)
    summed = df.withColumns({"__s": _sums(shared, text), "__amp": punctuation_amplifier(text)})
    s = {k: F.col(f"__s.{k}") for k in ("sum", "n", "pos", "neg", "npos", "nneg")}
    return summed.withColumns(_final_scores(s["sum"], s["n"], s["pos"], s["neg"], s["npos"], s["nneg"], F.col("__amp"), alpha,
                                            columns)).drop("__s", "__amp")


def sentiment_scores(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame, boosters: DataFrame | None = None,
                     negations: DataFrame | None = None, contrast: str = "but", alpha: float = LX.ALPHA,
                     columns=None, idioms: DataFrame | None = None, rules: Rules = Rules(), method: str = "auto",
                     partitions: int | None = None) -> DataFrame:
    """``(id, Compound, Negative, Neutral, Positive)`` per document: one scan, and no text is shuffled."""
    columns = columns or SCORE_COLUMNS
    known = _known(method, lexicon, boosters, negations, idioms)
    df = _spread(df.select(id_col, text_col), partitions)
    if known is not None:
        return _append_scores(df, text_col, known, contrast, alpha, columns, rules).select(id_col, *columns)
    vals = _valences(df, id_col, text_col, lexicon, boosters, negations, contrast, LX.C_INCR, LX.N_SCALAR, idioms, rules)
    v = F.col("__v")
    per_doc = vals.groupBy("__id", "__n", "__amp").agg(
        F.sum(v).alias("__sum"),
        F.sum(F.when(v > 0, v + 1)).alias("__pos"),
        F.sum(F.when(v < 0, v - 1)).alias("__neg"),
        F.count_if(v > 0).alias("__npos"),
        F.count_if(v < 0).alias("__nneg"),
    )
    scores = _final_scores(*[F.col(f"__{c}") for c in ("sum", "n", "pos", "neg", "npos", "nneg", "amp")], alpha, columns)
    return per_doc.select(F.col("__id").alias(id_col), *[c.alias(k) for k, c in scores.items()])


def score_sentiment(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame | None = None,
                    boosters: DataFrame | None = None, negations: DataFrame | None = None,
                    contrast: str = "but", scorer=None, alpha: float = LX.ALPHA,
                    columns=SCORE_COLUMNS, idioms: DataFrame | None = None, rules: Rules = Rules(), method: str = "auto",
                    partitions: int | None = None) -> DataFrame:
    """Append Compound, Negative, Neutral, Positive to ``df``.

    ``scorer`` (optional) is a ``pandas_udf`` returning
    ``struct<neg,neu,pos,compound>`` and replaces the rules, e.g. to plug in an
    external analyser. ``partitions`` deals the rows over so many tasks first.
    With ``method="joins"`` (or tables beyond ``MAX_WORDS``) ``id_col`` must be
    unique per row, since scores are joined back on it.
    """
    compound, negative, neutral, positive = columns
    df = _spread(df, partitions)
    if scorer is not None:
        s = scorer(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
        return df.withColumn("__s", s).withColumns({
            compound: F.col("__s.compound"), negative: F.col("__s.neg"),
            neutral: F.col("__s.neu"), positive: F.col("__s.pos")}).drop("__s")
    if lexicon is None:
        raise ValueError("a lexicon DataFrame (token, valence) is required")
    known = _known(method, lexicon, boosters, negations, idioms)
    if known is not None:
        return _append_scores(df, text_col, known, contrast, alpha, columns, rules)
    scores = sentiment_scores(df, id_col, text_col, lexicon, boosters, negations, contrast, alpha, columns, idioms, rules, "joins")
    return df.join(scores.withColumnRenamed(id_col, "__id"), F.col(id_col).eqNullSafe(F.col("__id"))).drop("__id")
