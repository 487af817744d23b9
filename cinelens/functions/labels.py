"""Sentiment labels from a compound score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------
POSITIVE_THRESHOLD = 0.05
NEGATIVE_THRESHOLD = -0.05
POSITIVE, NEGATIVE, NEUTRAL = "positive", "negative", "neutral"
# -----------------------------------------------------------------------------


def classify_compound(c, pos_threshold: float = POSITIVE_THRESHOLD,
                      neg_threshold: float = NEGATIVE_THRESHOLD) -> Column:
    """> pos -> positive, < neg -> negative, else neutral (strict; NaN/null -> neutral).

    NaN is tested first: in Spark ``NaN > x`` is true, in Python it is false.
    """
    c = F.col(c) if isinstance(c, str) else c
    return (F.when(c.isNull() | F.isnan(c), F.lit(NEUTRAL))
            .when(c > F.lit(pos_threshold), F.lit(POSITIVE))
            .when(c < F.lit(neg_threshold), F.lit(NEGATIVE))
            .otherwise(F.lit(NEUTRAL)))


def add_sentiment_labels(df: DataFrame, compound_col: str = "Compound",
                         out_col: str = "Sentiment_label", **thresholds) -> DataFrame:
    """Append the label column."""
    if compound_col not in df.columns:
        raise KeyError(f"missing required column: {compound_col}")
    return df.withColumn(out_col, classify_compound(compound_col, **thresholds))
