"""Target tables bucketed and sorted by their natural key.

An anti join against such a table reads it bucket by bucket: only the new keys
are dealt out, the target is not shuffled however large it has grown. Files
carry their bucket in their names, so a folder can be opened again by any
later session.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table_name(path: str, key: str, buckets: int) -> str:
    """The name under which a session knows the folder, read with this layout."""
    return "bucketed_" + hashlib.sha256(f"{path.rstrip('/')}\n{key}\n{buckets}".encode()).hexdigest()[:24]


def open_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """The bucketed table at ``path`` (new and empty if there is none)."""
    name = table_name(path, key, buckets)
    if not spark.catalog.tableExists(name):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS "
                  f"LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def append_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Append rows, one file per bucket: rows are dealt out as the buckets are."""
    spark = df.sparkSession
    target = open_bucketed(spark, path, df.schema, key, buckets)
    (df.select(*target.columns).repartition(buckets, key).write.mode("append").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table_name(path, key, buckets)))
