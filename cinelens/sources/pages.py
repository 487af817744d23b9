"""Review extraction from raw web pages.

S8b (fixed single-tag fields) is pure Spark regex. S8 needs a real HTML
parse (unclosed tags, scripts containing markup, entities): each task
parses its own pages with the standard library's ``html.parser`` inside
``mapInPandas`` (Arrow batches), yielding one raw row per review card. All
defaults, ids and types are then applied with Spark column expressions.
"""

from __future__ import annotations

import re
import sys
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S

# --- fixed values: review card selectors -----------------------------------------
CARD_SELECTORS = {
    "card": "div.ipc-list-card[data-testid=review-card-parent]",
    "author": "span.ipc-rating-star--otherUserAlt",
    "link": "a.ipc-title-link-wrapper",
    "rating": "span.ipc-rating-star--rating",
    "review": "div.ipc-html-content-inner-div",
    "up": "span.ipc-voting__label__count--up",
    "down": "span.ipc-voting__label__count--down",
}
AUTHOR_ATTR = "aria-label"
MISSING_RATING = "NaN"
MISSING_VOTES = "0"
# ----------------------------------------------------------------------------------

# --- fixed values: elements without content (HTML standard and older practice) ----
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr", "basefont", "bgsound", "command", "frame", "image", "isindex", "keygen",
        "menuitem", "nextid", "spacer"}
# ----------------------------------------------------------------------------------
NON_TEXT = {"script", "style", "template"}
_SEL = re.compile(r"^(?P<tag>[A-Za-z0-9-]*)(?P<cls>(?:\.[\w-]+)*)"
                  r"(?:\[(?P<attr>[\w-]+)(?:=['\"]?(?P<val>[^'\"\]]*)['\"]?)?\])?$")

RAW_CARD_SCHEMA = ("page_id long, url string, card_index int, author_label string, href string, rating_text string, "
                   "summary_text string, review_text string, up_text string, down_text string, card_text string")


class _Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent


class _TreeBuilder(HTMLParser):
    """Minimal document tree: an end tag closes the nearest open element of its name."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("[document]", {}, None)
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.stack[-1])
        self.stack[-1].children.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        node = _Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.stack[-1])
        self.stack[-1].children.append(node)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.stack[-1].children.append(data)


def parse_html(html: str) -> _Node:
    b = _TreeBuilder()
    b.feed(html or "")
    b.close()
    return b.root


def _matcher(selector: str):
    m = _SEL.match(selector.strip())
    if not m:
        raise ValueError(f"unsupported selector {selector!r} (use tag.class[attr=value])")
    tag = m.group("tag").lower() or None
    classes = [c for c in m.group("cls").split(".") if c]
    attr, val = m.group("attr"), m.group("val")

    def match(n: _Node) -> bool:
        if tag and n.tag != tag:
            return False
        if classes:
            have = n.attrs.get("class", "").split()
            if any(c not in have for c in classes):
                return False
        if attr is not None:
            if attr not in n.attrs or (val is not None and n.attrs[attr] != val):
                return False
        return True
    return match


def select(node: _Node, selector: str) -> list:
    """All descendant elements matching ``selector``, in document order."""
    match, out, todo = _matcher(selector), [], list(reversed(node.children))
    while todo:
        n = todo.pop()
        if isinstance(n, _Node):
            if match(n):
                out.append(n)
            todo.extend(reversed(n.children))
    return out


def select_one(node: _Node, selector: str):
    found = select(node, selector)
    return found[0] if found else None


def get_text(node: _Node, separator: str = "", strip: bool = False) -> str:
    """Visible text of ``node`` (script/style/template excluded)."""
    parts, todo = [], [(c, False) for c in reversed(node.children)]
    while todo:
        n, hidden = todo.pop()
        if isinstance(n, str):
            if hidden:
                continue
            s = n.strip() if strip else n
            if s or not strip:
                parts.append(s)
        else:
            todo.extend((c, hidden or n.tag in NON_TEXT) for c in reversed(n.children))
    return separator.join(parts)


def cards_from_html(page_id: int | None, url: str | None, html: str, selectors: dict) -> list[tuple]:
    """Raw fields of every review card on one page (None where an element is missing)."""
    root = parse_html(html)
    rows = []
    for idx, card in enumerate(select(root, selectors["card"])):
        label_el = select_one(card, selectors["author"])
        label = label_el.attrs.get(AUTHOR_ATTR) if label_el is not None else None
        link = select_one(card, selectors["link"])
        href = link.attrs.get("href", "") if link is not None else None
        summary = get_text(link, "", True) if link is not None else None

        def text_of(key, sep=""):
            el = select_one(card, selectors[key])
            return get_text(el, sep, True) if el is not None else None

        rows.append((page_id, url, idx, label, href, text_of("rating"), summary, text_of("review", "\n"),
                     text_of("up"), text_of("down"), get_text(card)))
    return rows


def _extract_batches(selectors: dict):
    cols = [c.split()[0] for c in RAW_CARD_SCHEMA.split(", ")]

    def run(batches):
        for pdf in batches:
            rows = []
            for pid, url, html in zip(pdf["page_id"], pdf["url"], pdf["html"]):
                rows.extend(cards_from_html(None if pd.isna(pid) else int(pid), url, html, selectors))
            yield pd.DataFrame(rows, columns=cols)
    return run


def raw_cards(pages: DataFrame, selectors: dict | None = None, url_col: str = "url") -> DataFrame:
    """One row per card with the raw text of each field and its page's url (parsing runs per task)."""
    sel = dict(CARD_SELECTORS, **(selectors or {}))
    return pages.select("page_id", F.col(url_col).alias("url"), "html").mapInPandas(_extract_batches(sel), RAW_CARD_SCHEMA)


def register_card_function(spark: SparkSession, name: str = "review_cards", selectors: dict | None = None) -> str:
    """S8 as a table function: ``SELECT c.* FROM pages p, LATERAL review_cards(p.page_id, p.url, p.html) c``.

    One row per card, with the columns of ``raw_cards``; a page without cards
    gives none. Rows travel in Arrow batches. ``selectors`` hold for the name.
    """
    sel = dict(CARD_SELECTORS, **(selectors or {}))

    class Cards:
        def eval(self, page_id, url, html):
            yield from cards_from_html(page_id, url, html, sel)

    spark.udtf.register(name, F.udtf(Cards, returnType=RAW_CARD_SCHEMA, useArrow=True))
    return name


def cards_by_sql(pages: DataFrame, selectors: dict | None = None, url_col: str = "url") -> DataFrame:
    """``raw_cards`` through the table function."""
    spark = pages.sparkSession
    name = register_card_function(spark, selectors=selectors)
    rows = pages.select("page_id", F.col(url_col).alias("url"), "html")
    return spark.sql(f"SELECT c.* FROM {{rows}} p, LATERAL {name}(p.page_id, p.url, p.html) c", rows=rows)


def extract_reviews(pages: DataFrame, selectors: dict | None = None, site: str = S.SITE,
                    url_col: str = "url") -> DataFrame:
    """Pages ``(page_id, url, html)`` -> review CSV rows with the reference defaults.

    ``ord`` = (page_id, card position) orders cards as they appear; duplicates
    and history are handled downstream by ``operators.dedup.new_reviews``. A
    page id that occurs twice gives the cards of each of its rows.
    """
    return review_fields(raw_cards(pages, selectors, url_col), site)


def review_fields(cards: DataFrame, site: str = S.SITE) -> DataFrame:
    """Raw cards -> review rows: the defaults of missing fields, author, id and time."""
    author = S.author_from_label("author_label")
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return cards.select(
        F.struct("page_id", "card_index").alias("ord"),
        author.alias("Author"),
        F.coalesce("rating_text", F.lit(MISSING_RATING)).alias("Rating"),
        F.coalesce("up_text", F.lit(MISSING_VOTES)).alias("Helpful_upVotes"),
        F.coalesce("down_text", F.lit(MISSING_VOTES)).alias("Helpful_downVotes"),
        F.coalesce("summary_text", F.lit("")).alias("Summary"),
        F.coalesce("review_text", F.lit("")).alias("Review"),
        now.alias("Scrape_Timestamp"),
        F.col("url").alias("Source_URL"),
        S.unique_id(F.col("href"), author, F.col("card_text"), site).alias("Unique_ID"),
    )


# The parsing functions run inside tasks: ship this module's code with them, so
# executors need only pandas and the standard library, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# S8b ---------------------------------------------------------------------------------
TITLE_RE = r"<title>(.*?)</title>"
LINK_RE = r'<a href="([^"]*)"'


def page_fields(pages: DataFrame) -> DataFrame:
    """Title and link targets of well-formed single-tag fields (regex, no parse)."""
    links = F.regexp_extract_all("html", F.lit(LINK_RE), 1)
    return pages.select("page_id", "url",
                        F.regexp_extract("html", TITLE_RE, 1).alias("title"),
                        links.alias("links"), F.size(links).alias("n_links"))
