"""Data-quality checks from the star schema's constraints (Q1-Q5).

Spark does not enforce keys or checks, so each constraint is a job that
returns the violating rows (and can be counted). ``quarantine`` splits a
batch into rows that pass every rule and rows that fail one, with reasons.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clean import require_columns  # noqa: F401  (Q5, re-exported)


def check_unique(df: DataFrame, key) -> DataFrame:
    """Q1: key values that occur more than once, with their count (a unique constraint allows several nulls)."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.na.drop(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
            .where(F.col("count") > 1))


def check_fk(child: DataFrame, col: str, parent: DataFrame, key: str | None = None) -> DataFrame:
    """Q2: child rows whose ``col`` has no parent row (null keys are not checked)."""
    key = key or col
    p = parent.select(F.col(key).alias(col)).distinct()
    return child.where(F.col(col).isNotNull()).join(p, col, "left_anti")


def check_not_null(df: DataFrame, cols) -> DataFrame:
    """Q3: ``(column, null_count)`` for each column, in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column", "null_count")


def check_range(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Q4: rows whose non-null ``col`` is outside ``[lo, hi]``."""
    c = F.col(col)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < lo)
    if hi is not None:
        bad = bad | (c > hi)
    return df.where(c.isNotNull() & bad)


def not_null_rule(col: str) -> tuple[str, Column]:
    return (f"{col} is null", F.col(col).isNull())


def range_rule(col: str, lo=None, hi=None) -> tuple[str, Column]:
    c = F.col(col)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < lo)
    if hi is not None:
        bad = bad | (c > hi)
    return (f"{col} outside [{lo}, {hi}]", c.isNotNull() & bad)


def quarantine(df: DataFrame, rules) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into (passing rows, failing rows with ``reasons``)."""
    if not rules:
        return df, df.limit(0).withColumn("reasons", F.array().cast("array<string>"))
    reasons = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]),
                       lambda x: x.isNotNull())
    tagged = df.withColumn("reasons", reasons)
    failing = reduce(lambda a, b: a | b, [F.coalesce(cond, F.lit(False)) for _, cond in rules])
    return tagged.where(~failing).drop("reasons"), tagged.where(failing)
