"""Review preprocessing -- keep-first dedup, completeness, rating fill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import as_text
from ..operators.clean import drop_incomplete, fill_rating, require_columns
from ..operators.dedup import keep_first


def preprocess(df: DataFrame, ord: str = "ord", group: str | None = None) -> DataFrame:
    """D1 -> F1 -> A1 -> P14, in the reference's order, over all rows or per ``group`` (``movie_id``).

    D1 runs before F1, so when the first copy of a text has a null Summary
    every copy (of the movie) disappears. Rows with a null Review are removed
    before D1: F1 would drop their whole group anyway, and this keeps the null
    group (possibly huge) out of the shuffle. One text under two movies stays
    under both when grouped.
    """
    require_columns(df, ["Review", "Summary", "Rating", ord, *([group] if group else [])])
    first = keep_first(df.where(F.col("Review").isNotNull()), [*([group] if group else []), "Review"], ord)
    complete = drop_incomplete(first, ("Review", "Summary"))
    filled = fill_rating(complete, "Rating", group)
    return filled.withColumns({"Review": as_text("Review"), "Summary": as_text("Summary")})
