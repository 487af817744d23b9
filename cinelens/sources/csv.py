"""Review CSV source and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import NUMERIC, py_strip
from ..operators.clean import normalise_nulls
from .csv_ranges import csv_records

# --- fixed values -------------------------------------------------------------
CSV_FIELDS = ["Author", "Rating", "Helpful_upVotes", "Helpful_downVotes", "Summary",
              "Review", "Scrape_Timestamp", "Source_URL", "Unique_ID"]
# -----------------------------------------------------------------------------

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in CSV_FIELDS])


#: How review CSV files are read, in batch and on streams.
CSV_OPTIONS = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "emptyValue": ""}


def normalise_reviews(raw: DataFrame) -> DataFrame:
    """P4 and the rating's type, for raw review rows of any source (batch and stream alike)."""
    df = normalise_nulls(raw, [c for c in CSV_FIELDS if c in raw.columns])
    if dict(df.dtypes).get("Rating") != "string":
        return df
    r = py_strip("Rating")
    return df.withColumn("Rating", F.when(r.rlike(NUMERIC), r.try_cast("double")))


def read_reviews(spark: SparkSession, path: str, ord_col: str = "ord", in_ranges: bool = False) -> DataFrame:
    """Read review CSV files with an explicit schema.

    Quoted multi-line fields and doubled quotes are parsed; pandas' missing
    tokens become null; Rating becomes a double. ``ord`` = (file path, row
    position), which orders rows as written, file by file. Spark's CSV reader
    takes a file with multi-line fields in one task; ``in_ranges`` reads large
    files by byte ranges instead (see ``csv_ranges``), with the same rows.
    """
    if in_ranges:
        options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
        records = csv_records(spark, path).select(
            F.struct("file", "pos").alias("__ord"), F.from_csv("record", RAW_SCHEMA.simpleString()[7:-1].replace(":", " "),
                                                               {k: str(v).lower() if v is True else v for k, v in options.items()}).alias("__r"))
        return normalise_reviews(records.select("__r.*", F.col("__ord").alias(ord_col)))
    raw = spark.read.schema(RAW_SCHEMA).options(**CSV_OPTIONS).option("nullValue", None).csv(path)
    raw = raw.withColumn(ord_col, F.struct(F.col("_metadata.file_path").alias("file"),
                                           F.monotonically_increasing_id().alias("pos")))
    return normalise_reviews(raw)


def append_reviews(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append rows; each write adds files (a CSV header per file)."""
    w = df.write.mode("append").format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("escape", '"')
    w.save(path)


def known_ids(df: DataFrame, key: str = "Unique_ID") -> DataFrame:
    """S3: ids already ingested (only the key column is read)."""
    return df.select(key).distinct()
