"""Resolve a movie id from a title-suggestion JSON document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------------
SUGGESTION_SCHEMA = "struct<d:array<struct<id:string,l:string>>>"
MOVIE_ID_PREFIX = "tt"
# ---------------------------------------------------------------------------------


def resolve_movie_id(json_col, prefix: str = MOVIE_ID_PREFIX) -> Column:
    """First ``d[].id`` that starts with ``prefix``; null when none (or bad JSON)."""
    c = F.col(json_col) if isinstance(json_col, str) else json_col
    doc = F.from_json(c, SUGGESTION_SCHEMA)
    ids = F.filter(F.transform(doc["d"], lambda x: x["id"]), lambda i: i.startswith(prefix))
    return F.try_element_at(ids, F.lit(1))


def resolve_title(json_col, prefix: str = MOVIE_ID_PREFIX) -> Column:
    """The label ``l`` of the entry :func:`resolve_movie_id` picks."""
    c = F.col(json_col) if isinstance(json_col, str) else json_col
    doc = F.from_json(c, SUGGESTION_SCHEMA)
    hits = F.filter(doc["d"], lambda x: x["id"].startswith(prefix))
    return F.try_element_at(hits, F.lit(1))["l"]
