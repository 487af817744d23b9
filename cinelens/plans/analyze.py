"""Analysis flows (E2, E3) and the per-movie output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import display
from ..functions.labels import add_sentiment_labels
from ..operators import keywords as KW
from ..operators import sentiment as SN
from ..operators.stats import stats_record
from ..session import checkpointed
from .preprocess import preprocess


def analyze(df: DataFrame, lexicon: DataFrame, ord: str = "ord", boosters=None, negations=None,
            contrast: str = "but", stop=None, lemma_table=None, sense_table=None, top_n: int = 20,
            scorer=None, materialize: bool = False, idioms=None, group: str | None = None):
    """Preprocess, score the raw review text, extract and enrich keywords -- over all rows or per ``group``.

    Returns ``(scored_rows, keywords)``; with ``group`` (e.g. ``movie_id``)
    de-duplication, rating fill and the keyword list are each movie's own, as
    in a run per movie. With ``materialize=True`` the preprocessed rows are
    checkpointed to the shared checkpoint folder once: scoring, keywords and
    the fill all read them.
    """
    clean = preprocess(df, ord, group)
    if materialize:
        clean = checkpointed(clean)
    scored = SN.score_sentiment(clean, ord, "Review", lexicon, boosters, negations, contrast, scorer,
                                idioms=idioms)
    top = KW.top_keywords(clean, "Review", ord, stop, lemma_table, top_n=top_n, group=group)
    if sense_table is not None:
        kws = KW.enrich_keywords(top, sense_table)
    else:
        kws = top.withColumnsRenamed({"word": "name", "count": "value"}).withColumn(
            "categories", F.array().cast("array<struct<definition:string,pos:string,examples:array<string>>>"))
    return scored, kws


def infer(df: DataFrame, keywords: DataFrame, compound_col: str = "Compound", group: str | None = None, **thresholds):
    """Label rows, compute the stats record, add keywords and the summary.

    Returns ``(result, labelled_rows)``; ``result`` is one row, or one per
    ``group``. The keyword list is a top-n (bounded), folded into one array
    ordered by rank.
    """
    by = [group] if group else []
    labelled = add_sentiment_labels(df, compound_col, **thresholds)
    stats = stats_record(labelled, group=group)
    item = F.struct("rank", F.col("name").alias("name"), F.col("value").alias("value"),
                    F.col("categories").alias("categories"))
    kw = keywords.groupBy(*[F.col(c).alias(f"__{c}") for c in by]).agg(F.sort_array(F.collect_list(item)).alias("kws"))
    top_keywords = F.transform(F.coalesce(F.col("kws"), F.array()), lambda x: F.struct(
        x["name"].alias("name"), x["value"].alias("value"), x["categories"].alias("categories")))
    if group:
        result = stats.join(kw, F.col(group).eqNullSafe(F.col(f"__{group}")), "left").withColumn("top_keywords", top_keywords)
    else:
        result = stats.withColumn("top_keywords", kw.select(top_keywords).scalar())
    sc = F.col("sentiment_counts")
    result = result.withColumn("summary", display.summary_sentence(
        F.col("avg_rating"), F.element_at(sc, F.lit("positive")), F.element_at(sc, F.lit("negative")),
        F.get(F.col("top_keywords"), 0)["name"]))
    return result.select(*by, *[c for c in result.columns if c not in ("kws", *by, *[f"__{c}" for c in by])]), labelled


def write_analyzed(df: DataFrame, path: str, partition_col: str = "movie_id", fmt: str = "parquet",
                   rows_per_file: int = 1_000_000) -> None:
    """One output partition per movie; re-running replaces only the movies present.

    Rows are dealt by movie and a salt that follows the movie's size, so a
    movie of any size is written by as many tasks as it needs and a small one
    into one file.
    """
    sizes = df.groupBy(F.col(partition_col).alias("__m")).agg(
        F.ceil(F.count(F.lit(1)) / rows_per_file).cast("long").alias("__files"))
    salt = F.pmod(F.xxhash64(*[c for c in df.columns if c != partition_col]), F.col("__files"))
    dealt = df.join(sizes, F.col(partition_col).eqNullSafe(F.col("__m"))).withColumn("__salt", salt)
    (dealt.repartition(partition_col, "__salt").select(*df.columns)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file)
     .partitionBy(partition_col).format(fmt).save(path))
