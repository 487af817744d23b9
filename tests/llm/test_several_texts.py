"""A doc_id with several texts, and many rows without one (op1, op2); band keys and all pairs (op7)."""

import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa

from cinelens.llm import near_dedup as ND
from cinelens.llm import passages as PS
from cinelens.llm import substring_sort as SS

from . import cases
from .test_dedup import brute_removed, shingles


def _edit(rng, text, n):
    w = text.split()
    for at in rng.sample(range(len(w)), n):
        w[at] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def _rows():
    rng = random.Random(21)
    a, b, c, d = (cases.words(rng, 90, 10**6) for _ in range(4))
    rows = [(1, a), (1, b), (2, _edit(rng, a, 2)), (3, _edit(rng, b, 2)), (3, c), (4, _edit(rng, c, 2)), (5, d), (5, d), (5, "one two"),
            (6, "one two"), (0, a[:200]), (7, "one two three"), (8, d + " tail"), (9, ""), (9, None)]
    return rows + [(None, cases.words(rng, 60, 10**6)) for _ in range(30)] + [(None, a), (None, rows[2][1])]


def test_near_copies_of_several_texts(spark):
    rows = _rows()
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = ND.near_duplicates(cases.plain(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str) == sorted(
        ((i, len(shingles(t)), *((find(i), find(i) == i) if i is not None else (None, True))) for i, t in rows), key=str)
    assert find(4) == find(2) == 1 and find(6) == 5


def test_substrings_of_several_texts(spark):
    rows = _rows()
    docs = sorted(((i if i is not None else 1 << 63, hashlib.sha256((t or "").encode()).hexdigest()), (t or "").encode()) for i, t in rows)
    want = []
    for (key, raw), flags in zip(docs, brute_removed(docs)):
        kept = bytes(b for b, f in zip(raw, flags) if not f)
        want.append((key[0], len(raw), sum(flags), hashlib.sha256(kept).hexdigest()))
    got = SS.repeated_substrings(cases.plain(spark, rows)).collect()
    assert sorted((r.doc_id if r.doc_id is not None else 1 << 63, r.n_bytes, r.n_removed, r.kept_sha256) for r in got) == sorted(want)


def _sets(rng, n):
    """Sets of all sizes, and near copies of them."""
    out = []
    for _ in range(n):
        base = rng.integers(1, 2**62, int(rng.integers(1, 120))).astype(np.uint64)
        out.append(np.unique(base))
        for _ in range(3):
            change = int(rng.integers(0, max(1, len(base) // 7) + 1))
            out.append(np.unique(np.concatenate((base[change:], rng.integers(1, 2**62, int(rng.integers(0, change + 1))).astype(np.uint64)))))
    return [s for s in out if len(s)]


def test_bands_meet_every_narrow_pair_and_nearly_every_wide_one():
    rng = np.random.default_rng(8)
    sets = _sets(rng, 250)
    flat, offsets = np.concatenate(sets), np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    prints = np.array([hash(s.tobytes()) & (2**63 - 1) for s in sets], dtype=np.uint64)
    keys, own = PS.band_keys(flat, offsets, prints)
    of = [set(keys[own == i].tolist()) for i in range(len(sets))]
    assert max(map(len, of)) <= PS.bands_for() + PS.NARROW // 4 + 1
    found = {True: [0, 0], False: [0, 0]}
    for k in range(0, len(sets)):
        for j in range(k + 1, min(k + 5, len(sets))):
            both = len(np.intersect1d(sets[k], sets[j]))
            if 100 * both >= 75 * (len(sets[k]) + len(sets[j]) - both):
                count = found[max(len(sets[k]), len(sets[j])) <= PS.NARROW]
                count[0] += 1
                count[1] += bool(of[k] & of[j])
    assert found[True][0] > 50 and found[True][1] == found[True][0]
    assert found[False][0] > 100 and found[False][1] >= 0.99 * found[False][0]


def test_lines_link_as_all_pairs_do(spark):
    """Every line of one chunk or more against all others: components by exact Jaccard, then whole lines go."""
    rng = random.Random(4)
    base = [cases.words(rng, rng.choice([24, 30, 45, 60, 90]), 10**6) for _ in range(12)]
    rows = [(k, "\n".join([cases.words(rng, 9, 10**6), _edit(rng, base[k % 12], rng.choice([0, 1, 1, 2])), cases.words(rng, 8, 10**6)])) for k in range(48)]
    lines = {k: t.split("\n")[1] for k, t in rows}
    near = {k: any(100 * len(shingles(lines[k]) & shingles(lines[j])) >= 75 * len(shingles(lines[k]) | shingles(lines[j]))
                   for j in range(k)) for k in lines}
    gone = {}
    for r in PS.repeated_passages(cases.plain(spark, rows)).collect():
        gone.setdefault(r.doc_id, []).append((r.begin, r.end))
    for k, t in rows:
        raw = t.encode()
        at = raw.index(lines[k].encode())
        if near[k]:
            assert any(b <= at and e >= at + len(lines[k].encode()) for b, e in gone.get(k, [])), k


def test_sketches_drop_no_similar_pair():
    rng = np.random.default_rng(3)
    sets = _sets(rng, 200)
    z = PS.odd_sketch(np.concatenate(sets), np.concatenate(([0], np.cumsum([len(s) for s in sets]))))
    kept = dropped = 0
    for k, j in itertools.combinations(range(0, len(sets), 2), 2):
        both = len(np.intersect1d(sets[k], sets[j]))
        may = bool(PS._may_link(np.int64(len(sets[k])), np.int64(len(sets[j])), z[k], z[j], 75))
        if 100 * both >= 75 * (len(sets[k]) + len(sets[j]) - both):
            assert may
            kept += 1
        else:
            dropped += not may
    assert kept > 50 and dropped > 10 * kept


def test_buckets_meet_whatever_the_batches():
    rng = np.random.default_rng(1)
    rows, pairs, large = [], set(), set()
    for b in range(-40, 200):
        size = int(rng.choice([1, 2, 3, 5, 11, 12, 13, 14, 60, 300], p=[.4, .1, .1, .1, .05, .05, .05, .05, .05, .05]))
        group = [(f, int(rng.integers(3, 6)), int(rng.integers(0, 8)), b) for f in sorted(rng.integers(-2**62, 2**62, size).tolist())]
        rows += group
        if size > PS.FEW:
            large |= {(b, r[0]) for r in group}
        pairs |= {(x[0], y[0], b) for x, y in itertools.combinations(group, 2) if size <= PS.FEW
                  and PS._may_link(np.int64(x[1]), np.int64(y[1]), np.uint64(x[2]), np.uint64(y[2]), 75)}
    for step in (7, 13, 64, 1000, 10**6):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + step]), (
            pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=["f", "n", "z", "b"]) for i in range(0, len(rows), step)]
        got = [r for out in PS._meet(75)(iter(batches)) for r in out.to_pylist()]
        told = [(r["f"], r["other"], r["b"]) for r in got if r["other"] is not None]
        members = [(r["b"], r["f"]) for r in got if r["other"] is None]
        assert len(told) == len(set(told)) and set(told) == pairs
        assert len(members) == len(set(members)) and set(members) == large
