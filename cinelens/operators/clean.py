"""Null handling, completeness filters and rating fill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------------
# Text a CSV reader treats as missing (pandas' default missing-value strings).
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
               "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
               "nan", "null")
# A character that Python's ``strip`` leaves.
NOT_SPACE = r"(?U)[^\s\x{1c}-\x{1f}]"
# -----------------------------------------------------------------------------


def normalise_nulls(df: DataFrame, cols=None, tokens=NULL_TOKENS) -> DataFrame:
    """Null tokens in string columns and NaN in double columns -> null."""
    types = dict(df.dtypes)
    cols = list(cols) if cols is not None else df.columns
    exprs = {}
    for c in cols:
        t = types[c]
        if t == "string":
            exprs[c] = F.when(F.col(c).isin(*tokens), F.lit(None).cast("string")).otherwise(F.col(c))
        elif t in ("double", "float"):
            exprs[c] = F.when(F.isnan(c), F.lit(None).cast(t)).otherwise(F.col(c))
    return df.withColumns(exprs) if exprs else df


def require_columns(df: DataFrame, cols) -> DataFrame:
    """Q5: fail fast when a required column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"missing required column(s): {missing}")
    return df


def drop_incomplete(df: DataFrame, cols=("Review", "Summary")) -> DataFrame:
    """drop rows with a null in any of ``cols``."""
    require_columns(df, cols)
    return df.na.drop(subset=list(cols))


def nonblank(df: DataFrame, text_col: str) -> DataFrame:
    """keep rows whose text is non-null and not only whitespace."""
    return df.where(F.col(text_col).isNotNull() & F.col(text_col).cast("string").rlike(NOT_SPACE))


def fill_rating(df: DataFrame, col: str = "Rating", group: str | None = None) -> DataFrame:
    """A1: fill null ratings with the mean rating rounded half-to-even, over all rows or per ``group``.

    Without a group the mean is an uncorrelated scalar subquery (one
    aggregate, no join). With one it is a partial aggregate per group, joined
    back to the rows. If every rating (of a group) is null it stays null.
    """
    require_columns(df, [col, *([group] if group else [])])
    dtype = df.schema[col].dataType
    target = dtype if isinstance(dtype, (T.DoubleType, T.FloatType)) else T.DoubleType()
    mean = F.bround(F.avg(col), 0).cast(target)
    if group is None:
        return df.withColumn(col, F.coalesce(F.col(col).cast(target), df.agg(mean.alias("fill")).scalar().cast(target)))
    means = df.groupBy(F.col(group).alias("__g")).agg(mean.alias("__fill"))
    joined = df.join(means, F.col(group).eqNullSafe(F.col("__g")), "left")
    return joined.withColumn(col, F.coalesce(F.col(col).cast(target), F.col("__fill"))).select(*df.columns)
