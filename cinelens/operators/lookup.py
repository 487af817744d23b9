"""Small lookup tables (stopwords, lemmas, lexicons) from Python values.

Every table is built the same way at any size: one Arrow table with the
schema's types. The planner knows its size and chooses between a broadcast
and a shuffle join (``spark.sql.autoBroadcastJoinThreshold``, AQE).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """Table from Python rows; values are converted to the schema's types (an int may stand for a double)."""
    kinds = T.StructType.fromDDL(schema)
    rows = [tuple(r) if isinstance(r, (tuple, list)) else (r,) for r in rows]
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    arrow = to_arrow_schema(kinds)
    table = pa.table([pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, kinds)


def word_table(spark: SparkSession, words, col: str = "token") -> DataFrame:
    """One-column table of distinct words."""
    return local_table(spark, sorted({w for w in words}), f"{col} string")


def pair_table(spark: SparkSession, pairs, schema: str) -> DataFrame:
    """Table from a dict or a list of tuples with a DDL schema."""
    rows = list(pairs.items()) if isinstance(pairs, dict) else list(pairs)
    return local_table(spark, rows, schema)
