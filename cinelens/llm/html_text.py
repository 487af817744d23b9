"""Main text of web pages: flat text blocks classified by a small decision tree.

A page is cut into text blocks at block-level tags. A block is described by
its word count and link density, those of its neighbours, and where it
stands; a decision tree, grown from the labelled table below, keeps or drops
it.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "template", "svg", "math", "object", "xmp", "noembed"}
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
             "strike strong sub sup time tt u var wbr".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ARTICLE = {"article", "main"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no main text, and words in class, id and role that say so.
ASIDE = set("nav footer aside form button select option label fieldset dialog menu head".split())
ASIDE_WORDS = set("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies "
                  "copyright disclaimer disqus feedback footer form header login masthead menu modal nav navbar navigation "
                  "newsletter notice notices notification overlay pager pagination popup promo promoted recommended related "
                  "reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe teaser toolbar "
                  "widget contentinfo complementary alert discussion".split())

_TAG = re.compile(r"""<(?:!--(?:.*?)(?:--!?>|\Z)|([/!?]?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|/?([a-zA-Z][^\s/>]*)([^>]*)>|[!?/][^>]*>)""",
                  re.S)
_HINT = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORD = re.compile(r"[a-z]+")


def _set_aside(tag: str, attrs: str, inside: bool) -> bool:
    if tag in ASIDE or (tag == "header" and not inside) or _HIDDEN.search(attrs):
        return True
    if tag in ("html", "body") or tag in ARTICLE:
        return False
    return any(w in ASIDE_WORDS for m in _HINT.finditer(attrs) for w in _WORD.findall((m[1] or m[2] or m[3] or "").lower()))


def blocks(page: str) -> list[dict]:
    """Text blocks in page order: text, words, linked words, aside, inside (an article), heading."""
    out: list[dict] = []
    stack: list[tuple[str, bool, bool]] = []
    parts: list[str] = []
    linked, link, heading, at = [0], False, False, 0

    def flush():
        text = " ".join("".join(parts).split())
        if text:
            n = len(text.split(" "))
            out.append({"text": text, "words": n, "linked": min(n, linked[0]), "aside": bool(stack and stack[-1][1]),
                        "inside": bool(stack and stack[-1][2]), "heading": heading})
        parts.clear()
        linked[0] = 0

    def add(text: str):
        if text:
            text = html.unescape(text)
            parts.append(text)
            if link:
                linked[0] += len(text.split())

    while True:
        m = _TAG.search(page, at)
        if not m:
            add(page[at:])
            flush()
            return out
        add(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[4] or "").lower()
        if not tag or m[1] in ("!", "?"):
            continue
        closing, attrs = m[1] == "/" or m[0].startswith("</"), m[3] or m[5] or ""
        if tag in RAW and not closing:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            parts.append(" ")
            continue
        if tag == "a":
            link = not closing
            continue
        if tag in INLINE:
            continue
        flush()
        if tag in VOID:
            continue
        if tag in HEADINGS:
            heading = not closing
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    link = False
                    break
        elif tag not in ("p", "li", "dt", "dd", "tr", "td", "th") or _HINT.search(attrs) or _HIDDEN.search(attrs):
            aside, inside = (stack[-1][1], stack[-1][2]) if stack else (False, False)
            if tag not in ("p", "li", "dt", "dd", "tr", "td", "th") or _set_aside(tag, attrs, inside):
                stack.append((tag, aside or _set_aside(tag, attrs, inside), inside or tag in ARTICLE))


FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "aside", "place", "heading"]


def described(found: list[dict]) -> list[list[float]]:
    """Feature rows: counts and link densities of a block and its neighbours, and where it stands.

    ``place``: 1 inside an article, -1 outside where the page has one, 0 where it has none.
    """
    has = any(b["inside"] and not b["aside"] for b in found)
    rows = []
    for k, b in enumerate(found):
        before = found[k - 1] if k else {"words": 0, "linked": 0}
        after = found[k + 1] if k + 1 < len(found) else {"words": 0, "linked": 0}
        row = [v for x in (b, before, after) for v in (x["words"], x["linked"] / max(1, x["words"]))]
        rows.append(row + [float(b["aside"]), 1.0 if b["inside"] else -1.0 if has else 0.0, float(b["heading"])])
    return rows


#: The labelled table: kinds of blocks as (words, link density, aside, place, heading, main text) ...
KINDS = [
    # paragraphs, short lines, headings and lists of links of an article
    (80, 0.0, 0, 1, 0, 1), (25, 0.1, 0, 1, 0, 1), (5, 0.0, 0, 1, 0, 1), (1, 0.0, 0, 1, 0, 1), (14, 0.4, 0, 1, 0, 1),
    (8, 0.0, 0, 1, 1, 1), (2, 0.0, 0, 1, 1, 1), (2, 1.0, 0, 1, 0, 0), (6, 1.0, 0, 1, 0, 0),
    # set aside, in an article or not: menus, adverts, notices, forms, comments, footers
    (1, 1.0, 1, -1, 0, 0), (9, 0.0, 1, -1, 0, 0), (60, 0.0, 1, -1, 0, 0), (60, 0.0, 1, 1, 0, 0), (12, 0.1, 1, 1, 0, 0),
    (4, 0.0, 1, 1, 1, 0), (80, 0.0, 1, 0, 0, 0), (20, 0.0, 1, 0, 0, 0), (3, 0.0, 1, 0, 1, 0), (2, 0.5, 1, 0, 0, 0),
    # outside the article of a page that has one
    (9, 0.0, 0, -1, 0, 0), (60, 0.0, 0, -1, 0, 0), (25, 0.1, 0, -1, 0, 0), (4, 0.0, 0, -1, 1, 0), (2, 1.0, 0, -1, 0, 0),
    # pages without an article element
    (80, 0.0, 0, 0, 0, 1), (25, 0.1, 0, 0, 0, 1), (14, 0.2, 0, 0, 0, 1), (6, 0.0, 0, 0, 1, 1), (2, 0.0, 0, 0, 1, 1),
    (2, 1.0, 0, 0, 0, 0), (6, 0.9, 0, 0, 0, 0), (25, 0.8, 0, 0, 0, 0),
]
#: ... between neighbours as (words, link density) before and after; a short line of a page without an article is
#: main text where a neighbour is running text.
NEIGHBOURS = [((40, 0.0), (60, 0.0)), ((3, 1.0), (50, 0.0)), ((50, 0.1), (2, 1.0)), ((2, 1.0), (3, 1.0)), ((0, 0.0), (0, 0.0))]
LABELLED = [(w, k, *x, *y, a, p, h, m) for w, k, a, p, h, m in KINDS for x, y in NEIGHBOURS]
LABELLED += [(w, 0.0, *x, *y, 0, 0, 0, int(max(x[0] * (x[1] < 0.5), y[0] * (y[1] < 0.5)) >= 40))
             for w in (2, 5, 8) for x, y in NEIGHBOURS]


def _impurity(rows) -> float:
    p = sum(r[-1] for r in rows) / len(rows)
    return len(rows) * p * (1 - p)


def grow(rows, depth: int = 7):
    """Decision tree by Gini impurity: ``(feature, limit, low side, high side)`` or a label."""
    label = int(2 * sum(r[-1] for r in rows) >= len(rows))
    best = (_impurity(rows) - 1e-9, None, None)
    for f in range(len(FEATURES)):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:]):
            limit = (a + b) / 2
            low, high = [r for r in rows if r[f] <= limit], [r for r in rows if r[f] > limit]
            best = min(best, (_impurity(low) + _impurity(high), f, limit), key=lambda x: x[0])
    _, f, limit = best
    if f is None or not depth:
        return label
    return f, limit, grow([r for r in rows if r[f] <= limit], depth - 1), grow([r for r in rows if r[f] > limit], depth - 1)


def decide(tree, row) -> bool:
    while not isinstance(tree, int):
        f, limit, low, high = tree
        tree = low if row[f] <= limit else high
    return bool(tree)


def main_text(tree, page: str | None) -> str:
    """Main text of one page: kept blocks in page order, joined by one space."""
    found = blocks(page or "")
    return " ".join(b["text"] for b, row in zip(found, described(found)) if decide(tree, row))


def _extract(tree):
    def run(batches):
        for batch in slices(batches):
            texts = [main_text(tree, h) for h in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.array(texts, pa.string())],
                                             names=batch.schema.names[:-1] + ["text"])
    return run


def extract_text(pages: DataFrame, labelled=None) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per row of ``pages (page_id, url, html, ...)``.

    The tree is grown from ``labelled`` (default: the table above). Character
    references are decoded, white space within a block becomes one space.
    Null, empty and text-free pages give an empty text; unclosed tags,
    comments and scripts run to the end of their element or of the page; null
    ids and urls are carried through; repeated rows are extracted alike; other
    columns are ignored.
    """
    tree = grow([tuple(r) for r in (labelled or LABELLED)])
    rows = pages.select("page_id", "url", F.col("html").alias("__html"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:2])
    return rows.mapInArrow(_extract(tree), f"{kinds}, text string").select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
