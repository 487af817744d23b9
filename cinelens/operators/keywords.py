"""Keyword extraction and enrichment.

Tokens are exploded to rows and aggregated; stopwords and lemmas are join
tables (the planner decides whether to broadcast them). Nothing is
concatenated into one string or collected to the driver.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import meaningful, meaningful_words, tokenize
from .clean import nonblank
from .lookup import pair_table, word_table
from .sentiment import MAX_WORDS


def stopwords(spark: SparkSession, words=None, language: str = "english") -> DataFrame:
    """Stopword table ``(token)``; default = Spark's built-in list."""
    if words is None:
        words = StopWordsRemover.loadDefaultStopWords(language)
    return word_table(spark, words, "token")


def lemmas(spark: SparkSession, mapping) -> DataFrame:
    """Lemma table ``(token, lemma)`` from a dict or pairs."""
    return pair_table(spark, mapping, "token string, lemma string")


def drop_stopwords(tokens: DataFrame, stop: DataFrame | None, col: str = "token") -> DataFrame:
    """Remove rows whose token is a stopword (anti join)."""
    if stop is None:
        return tokens
    return tokens.join(stop.select(F.col(stop.columns[0]).alias(col)), col, "left_anti")


def lemmatize(tokens: DataFrame, lemma_table: DataFrame | None, col: str = "token") -> DataFrame:
    """Replace each token by its lemma when the table has one."""
    if lemma_table is None:
        return tokens
    lt = lemma_table.select(F.col("token").alias("__tok"), F.col("lemma").alias("__lemma"))
    return (tokens.join(lt, tokens[col] == lt["__tok"], "left")
            .withColumn(col, F.coalesce(F.col("__lemma"), F.col(col)))
            .drop("__tok", "__lemma"))


def _replacements(stop: DataFrame | None, lemma_table: DataFrame | None, max_words: int) -> dict | None:
    """Word -> its lemma, or "" for a stopword, from the two tables.

    None where they hold more than ``max_words`` rows, several lemmas of a word
    or lemmas that are no single word. No table is read further than that bound.
    """
    room, found = max_words, []
    for table in (stop.select(stop.columns[0]) if stop is not None else None,
                  lemma_table.select("token", "lemma") if lemma_table is not None else None):
        cols = [c.to_pylist() for c in table.limit(room + 1).toArrow().columns] if table is not None else [[], []]
        room -= len(cols[0])
        if room < 0:
            return None
        found.append(list(zip(*cols)))
    pairs = [(w, m) for w, m in found[1] if w is not None]
    if len({w for w, _ in pairs}) < len(pairs) or any(m is not None and m.split() != [m] for _, m in pairs):
        return None
    return {w: m for w, m in pairs if m is not None} | {w: "" for (w, *_) in found[0] if w is not None}


def _replaced(shared, text: Column) -> Column:
    @F.arrow_udf("string")
    def replaced(texts: pa.Array) -> pa.Array:
        get = shared.value.get
        return pa.array([" ".join([get(w, w) for w in t.split()]) for t in texts.to_pylist()], pa.string())
    return replaced(text)


def lemmatize_and_remove_stopwords(df: DataFrame, id_col: str, text_col: str, stop: DataFrame | None,
                                   lemma_table: DataFrame | None, out_col: str = "text",
                                   max_words: int = MAX_WORDS) -> DataFrame:
    """``(id, text)`` -> ``(id, out)``: stopwords removed, then lemmatised, space-joined.

    The text is split on whitespace (it is expected to be cleaned by P8). Rows
    of one id come out as one, their words in order of place, then of word.
    Tables of up to ``max_words`` rows are broadcast and applied to whole texts,
    and one text per row is shuffled by id, in which a removed word leaves an
    empty place; larger tables are joined to the words.
    """
    known = _replacements(stop, lemma_table, max_words)
    if known is None:
        return _joined_without_stopwords(df, id_col, text_col, stop, lemma_table, out_col)
    shared = df.sparkSession.sparkContext.broadcast(known)
    left = df.select(id_col, _replaced(shared, F.coalesce(F.col(text_col), F.lit(""))).alias("__left"))
    words = lambda text: F.split(text, " ")
    placed = F.flatten(F.transform("__texts", lambda t: F.filter(
        F.transform(words(t), lambda w, at: F.struct(at.alias("at"), w.alias("w"))), lambda x: x["w"] != "")))
    merged = F.transform(F.array_sort(placed), lambda x: x["w"])
    alone = F.array_remove(words(F.get("__texts", F.lit(0))), "")
    return left.groupBy(id_col).agg(F.collect_list("__left").alias("__texts")).select(
        id_col, F.array_join(F.when(F.size("__texts") == 1, alone).otherwise(merged), " ").alias(out_col))


def _joined_without_stopwords(df: DataFrame, id_col: str, text_col: str, stop: DataFrame | None,
                              lemma_table: DataFrame | None, out_col: str) -> DataFrame:
    """``lemmatize_and_remove_stopwords`` by joins of the words, for tables of any size.

    ``explode_outer`` keeps documents with no tokens, which come out as "".
    """
    words = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), r"(?U)[\s\x{1c}-\x{1f}]+"),
                     lambda t: t != "")
    toks = df.select(id_col, F.posexplode_outer(words).alias("pos", "token"))
    if stop is not None:
        # null out stopwords (left join) rather than dropping rows, so a document
        # made only of stopwords keeps a row and comes out as ""
        s = stop.select(F.col(stop.columns[0]).alias("token")).distinct().withColumn("__stop", F.lit(True))
        toks = (toks.join(s, "token", "left")
                .withColumn("token", F.when(F.col("__stop").isNull(), F.col("token"))).drop("__stop"))
    kept = lemmatize(toks, lemma_table)
    return kept.groupBy(id_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))),
                                 lambda x: x["token"]), " ").alias(out_col))


def keyword_tokens(df: DataFrame, text_col: str, ord: str, stop: DataFrame | None = None,
                   lemma_table: DataFrame | None = None, min_len: int = 2, max_len: int = 20,
                   mode: str = "words", group: str | None = None) -> DataFrame:
    """Token stream ``([group,] ord, pos, token)`` after P9, P10, J5 and J6."""
    docs = nonblank(df, text_col)
    words = meaningful_words(text_col, min_len, max_len) if mode == "words" else meaningful(tokenize(text_col, mode), min_len, max_len)
    toks = docs.select(*([F.col(group).alias("__group")] if group else []), F.col(ord).alias("__ord"),
                       F.posexplode(words).alias("pos", "token"))
    return lemmatize(drop_stopwords(toks, stop), lemma_table)


def top_keywords(df: DataFrame, text_col: str, ord: str = "ord", stop: DataFrame | None = None,
                 lemma_table: DataFrame | None = None, top_n: int = 20, min_len: int = 2,
                 max_len: int = 20, mode: str = "words", group: str | None = None) -> DataFrame:
    """``([group,] word, count, rank)`` of the ``top_n`` most frequent tokens, over all rows or per ``group``.

    Ties keep first-occurrence order: the smallest ``ord`` with the word, then
    the position in that row. Counts and smallest ``ord`` are one hash
    aggregate with a partial step per task; ``rank() <= top_n`` plans as a
    ``WindowGroupLimit``, so each task keeps its own leaders before the
    shuffle. Positions are then looked up in the leaders' first rows only.
    """
    toks = keyword_tokens(df, text_col, ord, stop, lemma_table, min_len, max_len, mode, group)
    keys = (["__group"] if group else []) + ["token"]
    # the last join leaves null keys out; left out here, both readers of the counts share one shuffle and the texts are split once
    for k in keys:
        toks = toks.where(F.col(k).isNotNull())
    counts = toks.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), F.min("__ord").alias("__first"))
    part = Window.partitionBy("__group") if group else Window.partitionBy()
    order = [F.col("count").desc(), F.col("__first").asc()]
    lead = counts.withColumn("__k", F.rank().over(part.orderBy(*order))).where(F.col("__k") <= top_n)
    rows = df.join(lead.select(F.col("__first").alias("__o")).distinct(), F.col(ord) == F.col("__o"), "left_semi")
    first = keyword_tokens(rows, text_col, ord, stop, lemma_table, min_len, max_len, mode, group)
    at = first.groupBy(*keys, F.col("__ord").alias("__first")).agg(F.min("pos").alias("__pos"))
    found = lead.join(at, [*keys, "__first"])
    ranked = found.withColumn("rank", F.row_number().over(part.orderBy(*order, F.col("__pos").asc()))).where(F.col("rank") <= top_n)
    word = F.col("token").alias("word")
    return ranked.select(*([F.col("__group").alias(group)] if group else []), word, "count", "rank")


def senses(spark: SparkSession, rows) -> DataFrame:
    """Sense table ``(word, rank, definition, pos, examples)``."""
    return pair_table(spark, rows, "word string, rank int, definition string, pos string, examples array<string>")


def enrich_keywords(keywords: DataFrame, sense_table: DataFrame, max_examples: int = 2) -> DataFrame:
    """Keywords ``(word, count, ...)`` -> ``(name, value, ..., categories)``: the first sense, or an empty list.

    The first sense of every word is chosen before the join, so a word that
    stands in many groups is looked up against one row.
    """
    rest = [c for c in keywords.columns if c not in ("word", "count")]
    kw = keywords.select(F.col("word").alias("name"), F.col("count").alias("value"), *rest)
    first = sense_table.groupBy(F.col("word").alias("name")).agg(
        F.min(F.struct("rank", "definition", "pos", "examples")).alias("s"))
    cat = F.struct(F.col("s.definition").alias("definition"), F.col("s.pos").alias("pos"),
                   F.coalesce(F.slice(F.col("s.examples"), 1, max_examples),
                              F.array().cast("array<string>")).alias("examples"))
    return kw.join(first, "name", "left").select(
        "name", "value", *rest,
        F.when(F.col("s").isNull(), F.array().cast("array<struct<definition:string,pos:string,examples:array<string>>>"))
        .otherwise(F.array(cat)).alias("categories"))
