"""Text column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------
# Python's whitespace includes the ASCII separators \x1c-\x1f; Java's (?U)\s does not.
_WS = r"\s\x{1c}-\x{1f}"
# Word tokens: letter/digit runs that may contain inner hyphens or apostrophes,
# or a single other non-space character (punctuation). Clitics are split off.
WORD = r"[\p{L}\p{M}\p{N}_]+(?:['’\-][\p{L}\p{M}\p{N}_]+)*"
TOKEN = WORD + r"|[^\s\p{L}\p{M}\p{N}_]"
CLITIC = r"(n't|'s|'ll|'re|'ve|'m|'d)$"
ALPHA = r"^\p{L}+$"
# -----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """Null -> ""; lower-case; keep a-z and whitespace; collapse; strip."""
    s = F.lower(F.coalesce(_col(c).cast("string"), F.lit("")))
    s = F.regexp_replace(s, f"(?U)[^a-z{_WS}]", "")
    s = F.regexp_replace(s, f"(?U)[{_WS}]+", " ")
    return F.trim(s)


def tokenize(c, mode: str = "words") -> Column:
    """Lower-cased tokens; null/empty -> [].

    ``mode="words"``: word tokens with punctuation as separate tokens and
    contraction clitics (``n't``, ``'s``, ...) split from their stem.
    ``mode="whitespace"``: ``lower().split()``.
    """
    s = F.lower(F.coalesce(_col(c).cast("string"), F.lit("")))
    if mode == "whitespace":
        return F.regexp_extract_all(s, F.lit(f"(?U)[^{_WS}]+"), 0)
    if mode != "words":
        raise ValueError(f"unknown tokenize mode {mode!r}")
    return _strip_clitics(F.regexp_extract_all(s, F.lit(TOKEN), 0))


def _strip_clitics(toks: Column) -> Column:
    # only tokens with an apostrophe can end in a clitic
    return F.transform(toks, lambda t: F.when(t.contains("'"), F.regexp_replace(t, CLITIC, "")).otherwise(t))


def word_tokens(c) -> Column:
    """P9 without punctuation tokens: the word tokens of ``tokenize(c)``, in order.

    Punctuation tokens can never pass the letters-only filter of P10, so the
    keyword path skips extracting them.
    """
    s = F.lower(F.coalesce(_col(c).cast("string"), F.lit("")))
    return _strip_clitics(F.regexp_extract_all(s, F.lit(WORD), 0))


def meaningful_words(c, min_len: int = 2, max_len: int = 20) -> Column:
    """``meaningful(word_tokens(c))`` in one pass of one pattern, without a function per token.

    A word is letters of the right number with at most a clitic behind them, up
    to the token's end; any other token matches as a whole and leaves an empty
    group.
    """
    low, high = max(min_len + 1, 1), max_len - 1
    if high < low:
        return meaningful(word_tokens(c), min_len, max_len)
    part = r"[\p{L}\p{M}\p{N}_]"
    word = rf"(\p{{L}}{{{low},{high}}})(?:{CLITIC[:-1]})?(?!['’\-]?{part})|{part}++(?:['’\-]{part}++)*+"
    s = F.lower(F.coalesce(_col(c).cast("string"), F.lit("")))
    return F.array_remove(F.regexp_extract_all(s, F.lit(word), 1), "")


def meaningful(tokens, min_len: int = 2, max_len: int = 20) -> Column:
    """P10 (length and letters part): letters only, min_len < length < max_len.

    Stopwords are removed by a join (``operators.keywords.drop_stopwords``).
    """
    return F.filter(_col(tokens), lambda t: (F.length(t) > min_len) & (F.length(t) < max_len)
                    & t.rlike(ALPHA))
