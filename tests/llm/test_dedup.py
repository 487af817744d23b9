"""Exact substrings (op1), near copies (op2) and passages (op7) against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from cinelens.llm import near_dedup as ND
from cinelens.llm import passages as PS
from cinelens.llm import substring_sort as SS
from cinelens.llm.common import components
from cinelens.llm.suffix_sort import sorted_suffixes

from . import cases


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_suffixes_are_sorted_and_extensions_exact():
    rng = np.random.default_rng(3)
    for _ in range(30):
        n = int(rng.integers(1, 300))
        data = rng.integers(97, 99, n).astype(np.uint8)
        m = int(rng.integers(1, n + 1))
        at = rng.integers(0, n, m)
        size, group = np.minimum(rng.integers(1, 50, m), n - at), rng.integers(0, 3, m)
        order, first, lcp = sorted_suffixes(data, at, size, group)
        raw = data.tobytes()
        text = [raw[a:a + k] for a, k in zip(at, size)]
        assert list(order) == sorted(range(m), key=lambda i: (group[i], text[i], i))
        for i in range(m):
            if not first[i]:
                x, y = text[order[i - 1]], text[order[i]]
                assert lcp[i] == next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def brute_removed(docs, length=100):
    """Documents in order as (key, bytes) -> removed flags."""
    seen, out = set(), []
    for _, raw in docs:
        flags = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            w = raw[s:s + length]
            if w in seen:
                flags[s:s + length] = b"\1" * length
            seen.add(w)
        out.append(flags)
    return out


def test_substrings_match_brute_force(spark):
    rows = cases.documents()
    got = SS.repeated_substrings(cases.table(spark, rows)).collect()
    assert len(got) == len(rows)
    docs = sorted(((i if i is not None else 1 << 63, hashlib.sha256((t or "").encode()).hexdigest()), (t or "").encode())
                  for i, t, *_ in rows)
    # of equal keys the first is the one that counts; the order of equal rows does not matter
    want = []
    for (key, raw), flags in zip(docs, brute_removed(docs)):
        kept = bytes(b for b, f in zip(raw, flags) if not f)
        spans = sum(1 for k, f in enumerate(flags) if f and (k == 0 or not flags[k - 1]))
        want.append((key[0], len(raw), sum(flags), spans, hashlib.sha256(kept).hexdigest()))
    have = [(r.doc_id if r.doc_id is not None else 1 << 63, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got]
    assert sorted(have) == sorted(want)


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh "])
def test_substrings_of_random_texts(spark, alphabet):
    rng = random.Random(len(alphabet))
    pool = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(90, 400))) for _ in range(12)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            p = rng.choice(pool)
            a = rng.randrange(len(p))
            parts.append(p[a:a + rng.randrange(20, 300)] + "".join(rng.choice(alphabet) for _ in range(rng.randrange(30))))
        texts.append("".join(parts))
    got = {r.doc_id: r.n_removed for r in SS.repeated_substrings(cases.plain(spark, enumerate(texts))).collect()}
    flags = brute_removed([(i, t.encode()) for i, t in enumerate(texts)])
    assert got == {i: sum(f) for i, f in enumerate(flags)}


def test_empty_tables(spark):
    none = cases.table(spark, [])
    assert SS.repeated_substrings(none).collect() == []
    assert ND.near_duplicates(none).collect() == []
    assert PS.repeated_passages(none).collect() == []
    assert PS.without_repeats(none).collect() == []


def brute_components(rows):
    """doc_id -> smallest reachable doc_id, over all pairs."""
    sets = {}
    for i, t, *_ in rows:
        if i is not None:
            sets[i] = shingles(t)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if sets[a] and sets[b] and 100 * both >= 75 * either:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}, sets


def test_near_copies_match_brute_force(spark):
    rows = cases.documents()
    got = ND.near_duplicates(cases.table(spark, rows)).collect()
    comp, sets = brute_components(rows)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), comp[r.doc_id], comp[r.doc_id] == r.doc_id)


def test_chains_of_edited_copies_are_whole(spark):
    """Copies that are near their neighbours but far from the first one: links across several members of a bucket."""
    rng = random.Random(11)
    w = cases.words(rng, 150, 10**6).split()
    rows = []
    for k in range(60):
        rows.append((1000 - k, " ".join(w), "en"))
        for at in rng.sample(range(len(w)), 2):
            w[at] = f"n{rng.randrange(10**6)}"
        if k % 2:
            v = list(w)
            for at in rng.sample(range(len(w)), 5):
                v[at] = f"m{rng.randrange(10**6)}"
            rows.append((k, " ".join(v), "en"))
    got = {r.doc_id: r.component_id for r in ND.near_duplicates(cases.plain(spark, [x[:2] for x in rows])).collect()}
    assert got == brute_components(rows)[0]


def test_small_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ND, "BLOCK", 7)
    monkeypatch.setattr(PS, "BLOCK", 7)
    test_chains_of_edited_copies_are_whole(spark)


def test_components_of_stars_chains_and_rings(spark):
    edges = [(9, k) for k in range(100, 160)] + [(k, k + 1) for k in range(200, 240)] + [(300, 301), (301, 302), (302, 300)]
    edges += [(5, 5), (None, 3), (4, None), (9, 100)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 9 for k in [9, *range(100, 160)]} | {k: 200 for k in range(200, 241)} | {k: 300 for k in (300, 301, 302)}
    assert got == want


def test_sketch_bound_keeps_true_pairs():
    rng = np.random.default_rng(2)
    most = ND.max_odd_bits()
    for _ in range(200):
        n = int(rng.integers(60, 800))
        pool = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
        cut = max(1, int(n * 0.142))
        a, b = pool[:n], np.concatenate((pool[cut:n], pool[n:n + cut]))
        odd = np.bitwise_count((ND.signature(a)[1] ^ ND.signature(b)[1]).view(np.uint64)).sum()
        assert odd <= most


def test_passages_in_other_documents_are_cut(spark):
    rows = cases.documents()
    df = cases.table(spark, rows)
    runs = PS.repeated_passages(df).collect()
    holders = [k for k in range(40, 60) if k % 3 == 0]
    assert {r.doc_id for r in runs if r.doc_id >= 40} == set(holders[1:])
    assert not any(r.doc_id in (4, 5, 6, 9, 11, 12, 13) for r in runs)
    out = {r.doc_id: r for r in PS.without_repeats(df).collect() if r.doc_id is not None}
    passage = rows[[r[0] for r in rows].index(holders[0])][1]
    texts = {i: t for i, t, *_ in rows}
    for k in range(40, 60):
        if k in holders[1:]:
            assert len(out[k].text) < len(texts[k]) and out[k].n_chars == len(out[k].text)
            assert "the same short line here" in out[k].text
        else:
            assert out[k].text == texts[k]
    assert passage == out[holders[0]].text
    assert list(PS.without_repeats(df).columns) == list(df.columns)


def test_edited_passages_and_borders(spark):
    rng = random.Random(8)
    passage = cases.words(rng, 90, 10**5).split()
    rows = [(0, cases.words(rng, 30, 10**5) + " " + " ".join(passage) + " " + cases.words(rng, 30, 10**5))]
    edited = list(passage)
    edited[45] = "changed"
    rows.append((1, cases.words(rng, 60, 10**5) + " " + " ".join(edited)))
    rows.append((2, cases.words(rng, 100, 10**5)))
    assert {r.doc_id for r in PS.repeated_passages(cases.plain(spark, rows)).collect()} == {1}


def test_near_copies_of_lines_are_cut_whole(spark):
    """Lines of 37 to 60 words with one word changed, wherever it stands."""
    rng = random.Random(21)
    rows, want = [], {}
    for k in range(120):
        w = cases.words(rng, 37 + k % 24, 10**6).split()
        v = list(w)
        v[rng.randrange(len(v))] = "changed"
        line = " ".join(v)
        a, b = set(zip(*(w[i:] for i in range(5)))), set(zip(*(v[i:] for i in range(5))))
        if 100 * len(a & b) >= 75 * len(a | b):
            want[1000 + k] = line
        rows.append((k, "\n".join((cases.words(rng, 30, 10**6), " ".join(w), cases.words(rng, 30, 10**6)))))
        rows.append((1000 + k, "\n".join((cases.words(rng, 30, 10**6), line, cases.words(rng, 30, 10**6)))))
    assert len(want) > 100
    texts, found = dict(rows), {}
    for r in PS.repeated_passages(cases.plain(spark, rows)).collect():
        found.setdefault(r.doc_id, []).append(texts[r.doc_id].encode()[r.begin:r.end].decode())
    missed = [i for i in want if not any(want[i] in x for x in found.get(i, []))]
    assert len(missed) <= 1  # five bands of one sample: a pair at the threshold is missed once in a thousand


def test_short_lines_that_stand_alone_earlier_make_a_run(spark):
    rng = random.Random(4)
    lines = [cases.words(rng, 8, 10**6) for _ in range(3)]
    rows = [(0, "\n".join(x for line in lines for x in (cases.words(rng, 30, 10**6), line))),
            (1, "\n".join([cases.words(rng, 30, 10**6), *lines, cases.words(rng, 30, 10**6)]))]
    got = PS.repeated_passages(cases.plain(spark, rows)).collect()
    assert [(r.doc_id, r.n_words, r.kept_doc_id, rows[1][1][r.begin:r.end]) for r in got] == [(1, 24, 0, "\n".join(lines))]


def test_passages_are_cut_to_their_last_word(spark, monkeypatch):
    """Exact passages of 51 to 110 words inside longer lines; extended in several rounds too."""
    rng = random.Random(13)
    rows, want = [], {}
    for k in range(60):
        passage = cases.words(rng, 51 + k, 10**6)
        rows.append((k, " ".join((cases.words(rng, 60, 10**6), passage, cases.words(rng, 60, 10**6)))))
        rows.append((1000 + k, " ".join((cases.words(rng, 60, 10**6), passage.upper(), cases.words(rng, 60, 10**6)))))
        want[1000 + k] = (passage.upper(), 51 + k, k)
    texts, df = dict(rows), cases.plain(spark, rows)
    for context in (PS.CONTEXT, 2):
        monkeypatch.setattr(PS, "CONTEXT", context)
        monkeypatch.setattr(PS, "FURTHER", context)
        got = PS.repeated_passages(df).collect()
        assert {r.doc_id for r in got} == set(want) and len(got) == len(want)
        for r in got:
            passage, n, kept = want[r.doc_id]
            # a similar paragraph at the border may hold a word or two of the other text
            assert passage in texts[r.doc_id][r.begin:r.end] and n <= r.n_words <= n + 4 and r.kept_doc_id == kept


def hot_line_texts():
    """One line in a third of the texts, between unique ones, alone or with a common neighbour."""
    rng = random.Random(17)
    line = cases.words(rng, 14, 10**6)
    texts = []
    for k in range(240):
        parts = [cases.words(rng, 25, 10**6), cases.words(rng, 25, 10**6)]
        if k % 3 == 0:
            parts.insert(1, line if k % 2 else line[:60])
        texts.append("\n".join(parts))
    return texts


def test_hot_lines_match_brute_force(spark, monkeypatch):
    texts = hot_line_texts()
    monkeypatch.setattr(SS, "HOT_ROWS", 3)
    monkeypatch.setattr(SS, "SORT_ROWS", 20)
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in SS.repeated_substrings(cases.plain(spark, [*enumerate(texts), (500, texts[0])])).collect()}
    flags = brute_removed([(i, t.encode()) for i, t in enumerate([*texts, texts[0]])])
    want = [(sum(f), sum(1 for k, x in enumerate(f) if x and (k == 0 or not f[k - 1]))) for f in flags]
    assert got == dict(zip([*range(len(texts)), 500], want)) and sum(f[0] > 0 for f in want) > 30


def test_no_task_gets_all_segments_of_a_hot_key():
    texts, shards = hot_line_texts(), 4
    docs, told, dealt = [], [], []
    for s in range(shards):
        own = [(i, f"{i:064x}", t) for i, t in enumerate(texts) if i % shards == s]
        cols = list(zip(*own))
        docs.append((pa.table({"ord": cols[0], "sha": cols[1], "text": cols[2]}),
                     pa.table({"ord": pa.array(cols[0]), "sha": pa.array(cols[1]), "blob": pa.nulls(len(own), pa.binary())})))
        told.append(SS._announce(shards, 100, 5)((pa.scalar(s),), *docs[-1]))
    told = pa.concat_tables(told)
    answers = pa.concat_tables([SS._answer(shards)((b,), told.filter(pc.equal(told["bucket"], b))) for b in told["bucket"].unique()])
    for s in range(shards):
        other = pa.concat_tables([docs[s][1], answers.filter(pc.equal(answers["shard"], s)).select(["ord", "sha", "blob"])])
        dealt.append(SS._deal(shards, 100)((pa.scalar(s),), docs[s][0], other))
    dealt = pa.concat_tables(dealt)
    keys = np.concatenate([np.frombuffer(k, dtype=np.uint64) for k in dealt["key"].to_pylist() if k] or [np.zeros(0, dtype=np.uint64)])
    assert np.unique(keys, return_counts=True)[1].max(initial=0) < 5 * shards
    sizes = [sum(len(w) for w, b in zip(dealt["wins"].to_pylist(), dealt["bucket"].to_pylist()) if w and b == k) for k in range(shards)]
    assert min(sizes) > 0.8 * max(sizes)
