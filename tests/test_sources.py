import os

from pyspark.sql import functions as F

from cinelens.sources import pages as PG
from cinelens.sources.csv import append_reviews, known_ids, read_reviews
from cinelens.sources.suggest import resolve_movie_id, resolve_title

CARD = """<div class="ipc-list-card x" data-testid="review-card-parent">
 <span class="ipc-rating-star ipc-rating-star--otherUserAlt" aria-label="ann_k's rating: 9"></span>
 <span class="ipc-rating-star--rating">9</span>
 <a class="ipc-title-link-wrapper" href="/review/rw100/?ref_=tt_urv">A &amp; B
   <b>rock</b></a>
 <div class="ipc-html-content-inner-div">First line.<br/>  Second <i>line</i>. <script>var x="</div>";</script></div>
 <span class="ipc-voting__label__count--up">1.5K</span><span class="ipc-voting__label__count--down">3</span>
</div>"""
BARE = """<div class="ipc-list-card" data-testid="review-card-parent"><p>unclosed <b>tags
<div class="ipc-html-content-inner-div">Only text</div></div>"""
DUP = CARD.replace("ann_k", "other")


def _pages(spark, html):
    return spark.createDataFrame([(1, "https://example.com/title/tt1/reviews", html)],
                                 "page_id long, url string, html string")


def test_full_card(spark):
    r = PG.extract_reviews(_pages(spark, CARD)).first()
    assert r["Author"] == "ann_k" and r["Rating"] == "9"
    assert r["Summary"] == "A & Brock"
    assert r["Review"] == "First line.\nSecond\nline\n."
    assert (r["Helpful_upVotes"], r["Helpful_downVotes"]) == ("1.5K", "3")
    assert r["Unique_ID"] == "https://www.imdb.com/review/rw100/"
    assert r["Source_URL"].endswith("/tt1/reviews") and "T" in r["Scrape_Timestamp"]


def test_missing_fields_use_defaults(spark):
    r = PG.extract_reviews(_pages(spark, BARE)).first()
    assert (r["Author"], r["Rating"], r["Summary"], r["Helpful_upVotes"]) == ("Unknown", "NaN", "", "0")
    assert r["Review"] == "Only text"
    assert r["Unique_ID"].startswith("Unknown_")


def test_two_cards_with_one_id_and_script_markup(spark):
    rows = PG.extract_reviews(_pages(spark, "<html><script>document.write('<div class=\"ipc-list-card\">')</script>"
                                     + CARD + DUP + "</html>")).collect()
    assert len(rows) == 2 and rows[0]["Unique_ID"] == rows[1]["Unique_ID"]


def test_page_fields(spark):
    html = '<html><head><title>T &amp; U</title></head><a href="/x">x</a><a href="/y">y</a></html>'
    r = PG.page_fields(_pages(spark, html)).first()
    assert r["title"] == "T &amp; U" and r["links"] == ["/x", "/y"] and r["n_links"] == 2


def test_repeated_page_ids_keep_their_own_urls(spark):
    rows = [(1, "u/a", CARD), (1, "u/b", CARD + BARE), (None, "u/c", BARE), (2, None, None)]
    got = PG.extract_reviews(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(r["Source_URL"] for r in got) == ["u/a", "u/b", "u/b", "u/c"]


def test_suggestions_take_the_first_title(spark):
    docs = ['{"q": "x", "d": [{"id": "co5", "l": "Studio"}, {"id": "tt0042", "l": "Late"}, {"id": "tt0043", "l": "Later"}]}',
            '{"d": []}', '{"d": [{"l": "no id"}, {"id": "tt9"}]}', '{"d": {}}', "[", "", None]
    df = spark.createDataFrame([(d,) for d in docs], "j string")
    out = [(r[0], r[1]) for r in df.select(resolve_movie_id("j"), resolve_title("j")).collect()]
    assert out[:3] == [("tt0042", "Late"), (None, None), ("tt9", None)]
    assert set(out[3:]) == {(None, None)}


def test_csv_round_trip_with_quotes_newlines_and_null_tokens(spark, tmp_dir):
    path = os.path.join(tmp_dir, "reviews.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("Author,Rating,Helpful_upVotes,Helpful_downVotes,Summary,Review,Scrape_Timestamp,Source_URL,Unique_ID\n")
        f.write('ann,8,10,2,"Good, really","Line one\nline ""two""",2026-01-01T00:00:00+00:00,u,a\n')
        f.write("bob,NaN,None,,Meh,,2026-01-02T00:00:00+00:00,u,b\n")
    df = read_reviews(spark, path)
    rows = sorted(df.collect(), key=lambda r: r["Unique_ID"])
    assert rows[0]["Review"] == 'Line one\nline "two"' and rows[0]["Rating"] == 8.0
    assert rows[1]["Rating"] is None and rows[1]["Helpful_upVotes"] is None and rows[1]["Review"] is None
    out = os.path.join(tmp_dir, "out")
    append_reviews(df.drop("ord"), out, fmt="csv")
    append_reviews(df.drop("ord"), out, fmt="csv")
    again = read_reviews(spark, out)
    assert again.count() == 4 and known_ids(again).count() == 2
    assert F is not None


def test_cards_by_lateral_sql_equal_the_scan(spark):
    from cinelens.sources import pages as PG

    card = ('<div class="ipc-list-card" data-testid="review-card-parent"><a class="ipc-title-link-wrapper" href="/r/{i}/?x">t{i}</a>'
            '<div class="ipc-html-content-inner-div">a<br>b{i}</div></div>')
    pages = spark.createDataFrame([(1, "u", "<p>" + card.format(i=1) + card.format(i=2)), (2, None, "<p>none"), (None, "w", card.format(i=3)),
                                   (3, "v", None), (1, "u", card.format(i=4))], "page_id long, url string, html string")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(PG.cards_by_sql(pages)) == rows(PG.raw_cards(pages)) and PG.cards_by_sql(pages).count() == 4
    pages.createOrReplaceTempView("card_pages")
    name = PG.register_card_function(spark, "cards_of")
    got = spark.sql(f"SELECT p.url, c.summary_text FROM card_pages p, LATERAL {name}(p.page_id, p.url, p.html) c WHERE p.page_id = 1")
    assert sorted(r.summary_text for r in got.collect()) == ["t1", "t2", "t4"]
