"""Token counts through a digest cache.

A text is looked up by the digest of its normalised content and the digest of
the tokenizer's version. Only distinct contents that the cache lacks are
encoded; their counts are appended to the cache, and every document takes its
count from there.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import empty, slices, staged

MODEL = "piece_bpe_32k.model"
LIMIT = 4096

_CACHE = "tokenizer string, content binary, n_tokens long"


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_version(path: str) -> str:
    """Digest of what decides a count: the model file, the library with its version, and the way it is called."""
    import sentencepiece

    with open(path, "rb") as f:
        model = hashlib.sha256(f.read()).hexdigest()
    return hashlib.sha256(f"sentencepiece {sentencepiece.__version__} encode {model}".encode()).hexdigest()


def processor(path: str):
    """The tokenizer at ``path``, kept per Python process."""
    import sentencepiece

    kept = sentencepiece.__dict__.setdefault("_kept_by_path", {})
    if path not in kept:
        kept[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return kept[path]


def content(text) -> F.Column:
    """Normalised content: the text's UTF-8 bytes, a null text being empty.

    Any further folding (white space, case, Unicode forms) would join texts
    whose counts differ under a tokenizer that keeps them apart.
    """
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def _encode(path: str):
    def run(batches):
        sp = processor(path)
        for batch in slices(batches):
            counts = [len(sp.encode(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["content", "n_tokens"])
    return run


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version, one row per content (two writers may have appended the same one)."""
    empty(spark, _CACHE).write.mode("ignore").parquet(cache)  # an empty table where there is none yet
    return spark.read.schema(_CACHE).parquet(cache).where(F.col("tokenizer") == version).groupBy("tokenizer", "content").agg(
        F.min("n_tokens").alias("n_tokens"))


def fill_cache(docs: DataFrame, cache: str, path: str | None = None, text_col: str = "text") -> DataFrame:
    """Encode the distinct contents that ``cache`` lacks and append their counts; returns the rows appended.

    The misses are found on digests alone and written down, so that their
    number is known: few ones are broadcast to the scan and no text is
    shuffled but theirs, many are met after the copies of a text have become
    one in each task. A lost executor repeats its tasks; counts are appended
    in one commit, so a failed run leaves the cache as it was.
    """
    spark = docs.sparkSession
    path = path or model_path()
    version = tokenizer_version(path)
    texts = docs.select(content(text_col).alias("text")).select(F.unhex(F.sha2("text", 256)).alias("content"), "text")
    stored = read_cache(spark, cache, version).select("content")
    misses = staged(texts.select("content").distinct().join(stored, "content", "left_anti"), "token-misses")
    fresh = texts.groupBy("content").agg(F.min("text").alias("text")).join(misses, "content", "left_semi")
    counted = staged(fresh.mapInArrow(_encode(path), "content binary, n_tokens long"), "token-counts")
    rows = counted.select(F.lit(version).alias("tokenizer"), "content", "n_tokens")
    rows.write.mode("append").parquet(cache)
    return rows


def count_tokens(docs: DataFrame, cache: str | None = None, path: str | None = None, limit: int = LIMIT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    ``cache`` is a folder of the shared storage that later calls, also of
    other jobs, may share; without one a new folder below the checkpoint folder
    is used. Null and empty texts have 0 bytes and 0 tokens; rows with null
    or repeated ids each give a row; an empty table gives none. Texts are
    encoded whole, without begin, end or added special tokens; special strings
    within are ordinary text, the library's default. Other columns are not
    read.
    """
    spark = docs.sparkSession
    path = path or model_path()
    cache = cache or scratch_path(spark, f"token-cache-{uuid.uuid4().hex}")
    fill_cache(docs, cache, path, text_col)
    stored = read_cache(spark, cache, tokenizer_version(path)).select("content", "n_tokens")
    text = content(text_col)
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("content"),
                        F.octet_length(text).cast("long").alias("n_bytes"))
    return keyed.join(stored, "content").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
