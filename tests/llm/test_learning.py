"""Language identification (op3), decontamination (op4) and packing (op5)."""

import random
import zlib

import duckdb
import numpy as np
import pytest

from cinelens.llm import decontaminate as DC
from cinelens.llm import language as LG
from cinelens.llm import packing as PK

from . import cases

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = LG.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_awkward_rows(spark):
    rows = cases.documents()
    got = LG.identify(cases.table(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (4, 5, 6, 9))
    assert by[10].lang_pred == "es"
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    # nothing to learn from, and nothing at all
    unlabelled = cases.table(spark, [(*r[:2], None, *r[3:]) for r in rows])
    assert {r.lang_pred for r in LG.identify(unlabelled).collect()} == {"und"}
    assert LG.identify(cases.table(spark, [])).collect() == []


def test_prediction_reads_the_text_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    model = LG.train(docs)
    rows = docs.collect()
    told = {r.doc_id: r.lang_pred for r in LG.identify(docs).collect()}
    assert all(model.predict(r.text)[0] == told[r.doc_id] for r in rows)


def test_families_come_first():
    rng = np.random.default_rng(1)
    base = {lang: rng.random(LG.FEATURES) for lang in ("en", "de", "fr", "xx")}
    rows = [(lang, np.sqrt((v + 0.1 * rng.random(LG.FEATURES)) / 3000)) for lang, v in base.items() for _ in range(20)]
    model = LG.Model(rows)
    assert model.members == {"germanic": ["de", "en"], "romance": ["fr"], "xx": ["xx"]}


def edits(rng, raw: bytes, n: int) -> bytes:
    b = bytearray(raw)
    for _ in range(n):
        at, kind = rng.randrange(len(b)), rng.randrange(3)
        if kind == 0:
            b[at] = rng.randrange(97, 123)
        elif kind == 1 and b[at] != 32:
            del b[at]
        else:
            b.insert(at, rng.randrange(97, 123))
    return bytes(b)


def plain_distance(item: bytes, region: bytes) -> int:
    """Smallest edit distance of the item to any part of the region, cell by cell."""
    row = [0] * (len(region) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(region, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_alignment_equals_the_plain_table():
    rng = random.Random(4)
    for _ in range(60):
        item = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 25)))
        region = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 40)))
        want = plain_distance(item, region)
        got = DC.align(item, region, 30)
        assert got[2] == want
        assert plain_distance(item, region[got[0]:got[1]]) == want
        assert DC.align(item, region, want - 1) is None


def test_leaks_with_edits_are_found_and_clean_texts_left(spark):
    rng = random.Random(6)
    items = [(k, cases.words(rng, 30, 5000)) for k in range(20)]
    rows, want = [], set()
    for k in range(60):
        text = cases.words(rng, 150, 5000)
        if k % 2 == 0:
            i, item = rng.choice(items)
            raw = item.encode()
            text = text[:200] + " " + edits(rng, raw, rng.randrange(DC.budget(len(raw)) + 1)).decode() + " " + text[200:]
            want.add((k, i))
        rows.append((k, text))
    docs = cases.plain(spark, rows)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items] + [(99, None, 2), (98, "", 3), (None, "q " * 50, 4), (97, "short", 5)],
                                  "item_id long, text string, doc_id int")
    got = DC.find_leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    texts = dict(rows)
    for r in got:
        item = DC.normal(dict(items)[r.item_id])
        assert plain_distance(item, DC.normal(texts[r.doc_id])[r.start:r.end]) == r.edits <= DC.budget(len(item))
    kept = DC.clean_documents(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k in range(60) if k % 2}


def test_leaks_in_several_passes_and_awkward_rows(spark, monkeypatch):
    rows = cases.documents()
    bench = spark.createDataFrame([(1, rows[0][1]), (2, "é" * 60 + " ñandú " * 30)], "item_id long, text string")
    one = sorted(map(tuple, DC.find_leaks(cases.table(spark, rows), bench).collect()), key=str)
    assert {r[0] for r in one} >= {None, 0, 1, 2, 3, 10}
    monkeypatch.setattr(DC, "PASS_BYTES", 100)
    assert sorted(map(tuple, DC.find_leaks(cases.table(spark, rows), bench).collect()), key=str) == one
    assert DC.find_leaks(cases.table(spark, []), bench).collect() == []
    assert DC.find_leaks(cases.table(spark, rows), bench.limit(0)).collect() == []


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    return t


def check_packing(rows, docs, window=PK.WINDOW):
    """Gapless sequences, whole documents, and the tokenizer's ids; returns the share of padding."""
    enc = tokenizer()
    want = []
    for i, t in docs:
        ids = np.array(enc.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        want.append((i, len(ids), ids))
    by_seq, by_doc = {}, {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
    used = padded = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
        used += at
        padded += 0 if at & (at - 1) == 0 else window - at
    for i in by_doc:
        ids = [x for x in want if x[0] == i]
        spans = sorted((r.doc_tokens, r.start, r.length, r.ids_crc32) for r in by_doc[i])
        assert sum(s[2] for s in spans) == sum(n for _, n, _ in ids)
        allowed = {(n, s, k, c) for _, n, v in ids for _, s, k, c in [x for x in spans if x[0] == n and x[1] + x[2] <= n]
                   if zlib.crc32(v[s:s + k].tobytes()) == c}
        assert set(spans) <= allowed
    assert used == sum(n for _, n, _ in want)
    return padded / max(1, used)


def test_packing_is_a_round_trip_with_little_padding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = PK.pack(docs).collect()
    assert check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()]) < 0.005


def test_packing_of_awkward_rows(spark):
    rows = cases.documents() + [(99, "<|endoftext|> is plain text", "en", "s", 1, *cases.EXTRA)]
    got = PK.pack(cases.table(spark, rows)).collect()
    check_packing(got, [r[:2] for r in rows])
    assert PK.pack(cases.table(spark, [])).collect() == []
    only = PK.pack(cases.plain(spark, [(1, None)])).collect()
    assert [(r.start, r.length, r.doc_tokens, r.offset) for r in only] == [(0, 1, 1, 0)]


@pytest.mark.parametrize("lengths", [{10: 5000}, {1500: 3000}, {2047: 10, 1: 3}, {5: 1}, {2048: 4}, {700: 900, 30: 4000, 1900: 50}])
def test_plan_covers_any_histogram(lengths):
    have = np.zeros(2049, dtype=np.int64)
    for k, v in lengths.items():
        have[k] = v
    plan = PK.Plan(have, 2048)
    length = np.repeat(np.arange(2049), have)
    rank = np.concatenate([np.arange(c) for c in have if c])
    taken, seqs = np.zeros(len(length), dtype=np.int64), {}
    for piece, start, n, seq, offset in plan.places(length, rank):
        assert (start == taken[piece]).all()
        taken[piece] += n
        for s, o, k in zip(seq.tolist(), offset.tolist(), n.tolist()):
            seqs.setdefault(s, []).append((o, k))
    assert (taken == length).all() and sorted(seqs) == list(range(plan.sequences))
    padded = 0
    for spans in seqs.values():
        at = 0
        for o, k in sorted(spans):
            assert o == at
            at += k
        padded += 0 if at & (at - 1) == 0 else 2048 - at
    assert padded <= 0.005 * length.sum() + 8


def test_fast_encoder_equals_the_tokenizer():
    texts = [r[0] or "" for r in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()]
    texts += [t or "" for _, t, *_ in cases.documents()] + ["<|endoftext|>", "a\r\n b c\U0001f600"]
    t = tokenizer()
    enc = PK.encoder(PK.vocabulary_path())
    assert all(PK.token_ids(enc, x)[:-1].tolist() == t.encode(x, add_special_tokens=False).ids for x in texts)
