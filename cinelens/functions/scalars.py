"""Scalar column functions for raw review fields.

Every function takes and returns a ``Column`` and stays inside the JVM
(whole-stage codegen), so it can be used in ``select``/``withColumn`` of
any size of data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Site the review pages come from, and the URL shapes built from a movie id.
SITE = "https://www.imdb.com"
MOVIE_PATH = "/title/{id}/"
REVIEWS_PATH = "/title/{id}/reviews"
# Text printed for a missing value when a hash input is formatted.
NONE_TEXT = "None"
# Fallback author when a review card has no rating label.
UNKNOWN_AUTHOR = "Unknown"
# Marker that ends the author name inside the rating label.
AUTHOR_LABEL_END = "'s rating"
# Vote suffixes and their multipliers.
VOTE_SUFFIXES = {"K": 1000.0, "M": 1000000.0}
# Text read as a missing rating.
RATING_NAN_TEXT = "NaN"
# ---------------------------------------------------------------------------

# A plain decimal or scientific number, the shape Python's float() accepts
# (without "inf"/"nan"/underscores, which we read as unparsable).
NUMERIC = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# The same with a vote suffix: group 1 is the number, group 4 the suffix.
_VOTE = f"^({NUMERIC[1:-1]})([{''.join(VOTE_SUFFIXES)}]?)$"
# Unicode whitespace at either end (Python's str.strip()).
_EDGE_SPACE = r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Strip Unicode whitespace at both ends."""
    return F.regexp_replace(_col(c), _EDGE_SPACE, "")


def vote_value(c) -> Column:
    """The number a vote text stands for, truncated toward zero but not clipped; unparsable -> null."""
    s = F.replace(F.upper(py_strip(_col(c).cast("string"))), F.lit(","), F.lit(""))
    suffix = F.regexp_extract(s, _VOTE, 4)
    factor = F.lit(1.0)
    for letter, f in VOTE_SUFFIXES.items():
        factor = F.when(suffix == letter, F.lit(f)).otherwise(factor)
    value = F.regexp_extract(s, _VOTE, 1).try_cast("double") * factor
    return F.signum(value) * F.floor(F.abs(value)).cast("double") + F.lit(0.0)


def vote_count(c) -> Column:
    """Vote text -> int.

    null, ``""`` and ``"None"`` -> 0; trim, upper-case, drop commas; a
    ``K``/``M`` suffix multiplies by 1e3/1e6; the value is truncated toward
    zero; anything unparsable (or out of int range) -> 0.
    """
    return F.coalesce(vote_value(c).try_cast("int"), F.lit(0))


def rating_value(c) -> Column:
    """The number a rating stands for, not clipped; NaN, "NaN" and junk -> null."""
    s = py_strip(_col(c).cast("string"))
    return F.when(s.rlike(NUMERIC), s.try_cast("double"))


def parse_rating(c) -> Column:
    """Rating text or double -> nullable int (NaN / "NaN" / junk -> null).

    ``int()`` truncation toward zero; values outside smallint range -> null.
    """
    return rating_value(c).try_cast("short").cast("int")


def movie_url(movie_id, site: str = SITE) -> Column:
    """Movie page URL from a movie id."""
    a, b = MOVIE_PATH.split("{id}")
    return F.concat(F.lit(site + a), _col(movie_id).cast("string"), F.lit(b))


def source_url(movie_id, site: str = SITE) -> Column:
    """Reviews page URL from a movie id."""
    a, b = REVIEWS_PATH.split("{id}")
    return F.concat(F.lit(site + a), _col(movie_id).cast("string"), F.lit(b))


def author_from_label(label) -> Column:
    """P5: author = part of the rating label before "'s rating"; default Unknown."""
    return F.coalesce(F.substring_index(_col(label), AUTHOR_LABEL_END, 1),
                      F.lit(UNKNOWN_AUTHOR))


def unique_id(href, author, text, site: str = SITE) -> Column:
    """Canonical review id.

    The review link without its query string, prefixed by the site; when there
    is no usable link, ``author_<sha256(text)>`` (a stable hash, so resumed
    runs recognise the row).
    """
    path = F.substring_index(_col(href), "?", 1)
    url = F.when(_col(href).isNotNull(), F.concat(F.lit(site), path))
    fallback = F.concat(F.coalesce(_col(author).cast("string"), F.lit(NONE_TEXT)), F.lit("_"),
                        F.sha2(F.coalesce(_col(text), F.lit("")), 256))
    return F.when(url.isNotNull() & (url != F.lit(site)), url).otherwise(fallback)


def review_hash(movie_id, author, review, algo: str = "md5") -> Column:
    """Hash of movie id || author || review text; null parts print as None.

    ``algo="md5"`` is what the loader computes; ``"sha256"`` follows the
    schema diagram.
    """
    parts = [F.coalesce(_col(x).cast("string"), F.lit(NONE_TEXT)) for x in (movie_id, author, review)]
    raw = F.concat(*parts)
    if algo == "md5":
        return F.md5(raw)
    if algo == "sha256":
        return F.sha2(raw, 256)
    raise ValueError(f"unknown hash algorithm {algo!r}")


def as_text(c) -> Column:
    """Cast to string."""
    return _col(c).cast("string")


def iso_timestamp(c) -> Column:
    """ISO-8601 text (with offset) -> timestamp; unparsable -> null."""
    return F.try_to_timestamp(_col(c).cast("string"))
