"""Main text (op6), URL filters (op8), WARC (op9) and the range join (op10)."""

import hashlib
import math
import random

import numpy as np
import pytest

from cinelens.llm import html_text as HT
from cinelens.llm import queries as Q
from cinelens.llm import range_join as RJ
from cinelens.llm import url_filter as UF
from cinelens.llm import warc as WA

PAGES = "page_id long, url string, html string, text string, host string, size int, file string, key string, rule int, kind string"
CLASH = ("t", "h", 1, "f", "k", 2, "x")


def pages(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], PAGES)


ROWS = [(1, "http://A.Example.com/en/x?q#f", "<article><p>Hello &amp; all</p></article>"), (2, None, None), (None, "https://x.net/fr/1", ""),
        (3, "no scheme", "<p>" + "long " * 50000), (4, "http://www.example.com/en/", "x" * 100), (5, "http://h.org", "x" * 100),
        (5, "http://h.org", "x" * 100), (6, "://", "x" * 99), (7, "http://b.org/é?z", "x" * 99), (8, "ftp://com/", "é" * 60),
        (9, "http://.../en/", "é" * 60), (0, "http://h.org", "x" * 100)]


def test_text_of_blocks():
    tree = HT.grow(HT.LABELLED)
    page = ("<html><head><title>No</title><style>p{}</style></head><body><header><p>Site name and a slogan</p></header>"
            "<nav><ul><li><a href='/x'>Home</a><li><a>News</a></ul></nav><div class='cookie-notice'>We use cookies on this site.</div>"
            "<article><h1>Big\n  title</h1><script>var a='</p><p>no';</script><p>First <b>bold</b>para&shy;graph &lt;3&nbsp;x.<br>next"
            "<p>Short.<!-- <p>hidden --><form><label>Mail</label><input><button>Go</button></form><aside>Related things to read</aside>"
            "<div id=comments><p>Great post, thanks a lot for writing this down.</p></div><p>Last &#233;t&eacute;</article>"
            "<footer>&copy; 2020 someone</footer></body></html>")
    assert HT.main_text(tree, page) == "Big title First boldpara\xadgraph <3 x. next Short. Last été"
    assert HT.main_text(tree, None) == HT.main_text(tree, "") == HT.main_text(tree, "<p") == ""
    body = " ".join(["text"] * 40)
    plain = f"<body><div class=menu><a>Home</a></div><div><h2>Title</h2><p>{body}</p><p>{body}</p></div><ul><li><a>a b</a><li><a>c</a></ul>"
    assert HT.main_text(tree, plain) == f"Title {body} {body}"
    # attributes with angle brackets, unclosed elements, broken markup
    assert HT.main_text(tree, f"<article><p title='a > b'>{body}</p><b>x<p>{body}") == f"{body} x {body}"
    assert HT.main_text(tree, f"<article>1 < 2 and {body} <script>never closed <p>no") == f"1 < 2 and {body}"


def test_text_of_awkward_pages(spark):
    got = HT.extract_text(pages(spark, ROWS)).collect()
    assert len(got) == len(ROWS) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r for r in got}
    assert by[1].text == "Hello & all" and by[2].text == "" and by[3].n_chars == 5 * 50000 - 1
    assert HT.extract_text(pages(spark, [])).collect() == []


def brute_rule(host, path, rules):
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, "allow")


def test_url_rules_match_brute_force(spark):
    rng = random.Random(1)
    hosts = ["example.com", "www.example.com", "a.www.example.com", "net", "x.net", "xnet", "example.com.net", "COM", "o.org", ""]
    rows = [(k, f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/en/', '/en', '/es/1', '/fr/?/es/', '?/en/', '#/en/', '/EN/'])}", "")
            for k in range(300)] + ROWS
    got = UF.apply_rules(pages(spark, rows), Q.URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        rest = r.url.partition("://")[2] if r.url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0] if rest[cut:cut + 1] == "/" else ""
        assert (r.host, r.path) == (host, path)
        assert (r.rule, r.verdict) == brute_rule(host, path, [(v, h, p) for v, h, p in Q.URL_RULES])
    assert UF.apply_rules(pages(spark, []), Q.URL_RULES).collect() == []
    assert {r.verdict for r in UF.apply_rules(pages(spark, ROWS), []).collect()} == {"allow"}


@pytest.mark.parametrize("limit", [1 << 20, 40])
def test_cascade_is_exact_on_its_universe(spark, monkeypatch, limit):
    monkeypatch.setattr(UF, "BITS_PER_KEY", 2)  # many false positives, hence several levels
    monkeypatch.setattr(UF, "HASHES", 1)
    monkeypatch.setattr(UF, "MAX_FILTER_BYTES", limit)
    universe = spark.range(3000).selectExpr("concat('key', id) AS key").unionAll(spark.createDataFrame([(None,), ("",)], "key string"))
    listed = universe.where("key IS NULL OR crc32(key) % 7 = 0")
    made = UF.build_cascades(listed, universe)
    assert max(len(c.levels) for c in made) > 2 and (len(made) > 1) == (limit == 40)
    got = {r.key for r in universe.where(UF.member(made, universe["key"])).collect()}
    assert got == {r.key for r in listed.where("key IS NOT NULL").collect()}
    assert UF.build_cascades(listed.limit(0), universe)[0].levels == []


def test_archives_round_trip(spark, tmp_path):
    got = WA.archive_round_trip(pages(spark, ROWS), str(tmp_path / "archives")).collect()
    assert len(got) == len(ROWS)
    first = {}
    for i, _, h in ROWS:
        raw = (h or "").encode()
        if len(raw) >= 100:
            first[raw] = min(first.get(raw, 10**9), i if i is not None else 10**9)
    want = []
    for i, u, h in ROWS:
        raw = (h or "").encode()
        lead = first.get(raw)
        again = lead is not None and lead != i
        want.append((i, u, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", lead if again else None))
    have = [(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)
    assert list((tmp_path / "archives").glob("*.warc.gz")) and list((tmp_path / "archives").glob("*.cdx.gz"))
    assert WA.archive_round_trip(pages(spark, []), str(tmp_path / "none")).collect() == []


def test_index_lookups_over_many_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(WA, "BLOCK_LINES", 3)
    rows = [(k, f"http://{'same' if k % 3 == 0 else 'h' + str(k % 17)}.org/{k % 5}", f"payload {k}") for k in range(200)]
    folder = str(tmp_path)
    directory = WA.write_index(WA.write_archives(pages(spark, rows), folder), folder, 4)
    urls = spark.createDataFrame([("http://same.org/0",), ("http://h4.org/2",), ("http://absent.org/",), (None,)], "url string")
    got = {r.page_id for r in WA.read_back(urls, directory, folder).collect()}
    assert got == {k for k, u, _ in rows if u in ("http://same.org/0", "http://h4.org/2")}
    assert len(directory.collect()) >= 200 // 3


def vectors():
    rng = np.random.default_rng(9)
    out, k = [], 0
    for label in (0, 1, None):
        centres = rng.normal(size=(30, 16))
        for c in centres:
            for _ in range(int(rng.integers(1, 6))):
                out.append((k, (c + rng.normal(size=16) * rng.choice([0, 0.05, 0.2, 0.3])).tolist(), label))
                k += 1
    same = rng.normal(size=16)
    out += [(k + j, (same * (1 + j % 2)).tolist(), 0) for j in range(40)]
    k += 40
    out += [(k, None, 0), (k + 1, [], 0), (k + 2, [0.0] * 16, 0), (k + 3, [float("nan")] * 16, 0), (k + 4, [1.0, None] + [0.0] * 14, 0),
            (k + 5, [float("inf")] + [0.0] * 15, 0), (k + 6, [1.0, 2.0], 0), (k + 7, [1.0, 2.0], 0), (k + 8, [1e300, 2e300], 0),
            (k + 9, [1e-300, 2e-300], 0), (None, same.tolist(), 0), (k + 10, same.tolist(), 5)]
    return out


def brute_vectors(rows, cosine=0.93):
    root, links = {i: i for i, _, _ in rows if i is not None}, {i: 0 for i, _, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ok = [(i, np.array(v) / np.abs(v).max(), lab) for i, v, lab in rows if i is not None and lab is not None and v
          and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    for a, (i, x, p) in enumerate(ok):
        for j, y, q in ok[:a]:
            if p == q and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
                links[i] += 1
                links[j] += 1
                s, t = find(i), find(j)
                root[max(s, t)] = min(s, t)
    return {i: (links[i], find(i)) for i in root}


@pytest.mark.parametrize("rows_per_cell", [2000, 12])
def test_range_join_matches_brute_force(spark, monkeypatch, rows_per_cell):
    monkeypatch.setattr(RJ, "CELL_ROWS", rows_per_cell)
    monkeypatch.setattr(RJ, "BLOCK_ROWS", rows_per_cell)
    rows = vectors()
    df = spark.createDataFrame([(i, v, lab, 1, "c", "s") for i, v, lab in rows],
                               "vec_id long, embedding array<double>, label int, id int, cell string, space string")
    got = RJ.near_vectors(df).collect()
    assert len(got) == len(rows)
    want = brute_vectors(rows)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id) == want[r.vec_id], r
            assert r.kept == (r.component_id == r.vec_id)
    assert RJ.near_vectors(df.limit(0)).collect() == []
