"""Rows that tie on the ingest order: one row per key stays."""

from cinelens.operators.dedup import cap_new, keep_first, new_reviews
from cinelens.sources.pages import extract_reviews

CARD = ('<div class="ipc-list-card" data-testid="review-card-parent"><a class="ipc-title-link-wrapper" href="/review/{i}/?x">title</a>'
        '<div class="ipc-html-content-inner-div">text {i}</div></div>')


def test_ties_on_the_order(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (None, "a", "x"), (2, "b", "p"), (2, "b", "q"), (3, "b", "p"), (None, "c", "n"), (None, "c", "n"),
            (5, None, "k"), (5, None, "k"), (7, "d", "only")]
    df = spark.createDataFrame(rows, "ord long, key string, v string").repartition(4)
    got = keep_first(df, "key", "ord").collect()
    assert sorted(((r.ord, r.key) for r in got), key=str) == sorted([(1, "a"), (2, "b"), (None, "c"), (5, None), (7, "d")], key=str)
    assert sorted(map(str, got)) == sorted(map(str, keep_first(df.repartition(2), "key", "ord").collect()))


def test_a_third_of_the_rows_are_one_row(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) ord", "if(id % 3 = 0, 'hot', concat('k', id)) key", "map('a', 1) m").repartition(8)
    assert keep_first(df, "key", "ord").count() == 2001


def test_two_crawls_of_one_page_give_each_review_once(spark):
    html = "<html>" + "".join(CARD.format(i=i) for i in range(3)) + "</html>"
    pages = spark.createDataFrame([(1, "u", html), (1, "u", html), (2, "other", html)], "page_id long, url string, html string")
    got = new_reviews(extract_reviews(pages), None)
    assert sorted(r.Unique_ID[-3:] for r in got.collect()) == ["/0/", "/1/", "/2/"]


def test_cap_counts_ties_exactly(spark):
    df = spark.createDataFrame([(k // 4, k) for k in range(40)] + [(None, 99)], "ord long, v int").repartition(5)
    for room in (1, 5, 18, 41, 50):
        got = cap_new(df, 10, 10 + room).collect()
        assert len(got) == min(room, 41)
        assert max((r.ord for r in got if r.ord is not None)) == min((room - 1) // 4, 9)
    assert cap_new(df, 10, 10).count() == 0 == cap_new(df, 12, 10).count()
