"""History files that answer key look-ups without being read.

Files are written sorted by the key, with Parquet Bloom filters on it. A small
batch asks for its own keys by equality, which reaches the files' statistics,
dictionaries and Bloom filters: row groups (and files) that hold none of them
are skipped. A batch of many keys reads the key column instead; which way is
taken depends on the counted number of keys alone, and both give the same.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import new_reviews

#: Distinct keys of a batch up to which they are pushed to the files.
MAX_KEYS = 256
#: Distinct keys a file's Bloom filter is laid out for.
FILE_KEYS = 1_000_000


def append_filtered(df: DataFrame, path: str, key: str, file_keys: int = FILE_KEYS) -> None:
    """Append rows in files sorted by ``key`` with a Bloom filter on it."""
    (df.sortWithinPartitions(key).write.mode("append").option(f"parquet.bloom.filter.enabled#{key}", "true")
     .option(f"parquet.bloom.filter.expected.ndv#{key}", str(file_keys)).parquet(path))


def known_among(batch: DataFrame, path: str, key: str = "Unique_ID", max_keys: int = MAX_KEYS) -> DataFrame:
    """Keys of the history at ``path`` that can matter to ``batch``: a superset of those in both, null included.

    At most ``max_keys`` keys are read to the driver.
    """
    history = batch.sparkSession.read.parquet(path).select(key)
    asked = [r[0] for r in batch.select(key).distinct().limit(max_keys + 1).collect()]
    if len(asked) > max_keys:
        return history
    same = [F.col(key).isNull() if k is None else F.col(key) == F.lit(k) for k in asked]
    return history.where(reduce(lambda a, b: a | b, same, F.lit(False)))


def skip_known(batch: DataFrame, path: str, key: str = "Unique_ID", ord: str = "ord", max_keys: int = MAX_KEYS) -> DataFrame:
    """F3 + D3 against files written by ``append_filtered``: first row per new key."""
    return new_reviews(batch, known_among(batch, path, key, max_keys), key, ord)

