"""Whitening (op11), Merkle manifest (op12) and token counts (op13) against brute force."""

import hashlib
import math
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
import sentencepiece

from cinelens.llm import merkle as MK
from cinelens.llm import queries as Q
from cinelens.llm import token_counts as TC
from cinelens.llm import whitening as WH

from . import cases

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label int, n int, component string, k int, s string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 5, "c", 1, "s") for i, v in rows], VECTORS)


def brute_whitening(rows, components=WH.COMPONENTS):
    """Centred products in exact fractions, eigh on the rounded matrix."""
    x = [[math.floor(Fraction(c) * 64) + 1000000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[k] for r in x) for k in range(d)]
    y = [[n * r[k] - s[k] for k in range(d)] for r in x]
    v = [[Fraction(sum(r[i] * r[j] for r in y), n ** 3) for j in range(d)] for i in range(d)]
    e, u = np.linalg.eigh(np.array([[float(c) for c in row] for row in v]))
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    w = (np.array(y, dtype=float) / n) @ u / np.sqrt(e)
    return n, [sum(c * c for c in r) for r in y], w, e, float(sum(v[i][i] for i in range(d)))


def check_whitening(got, rows, components=WH.COMPONENTS):
    n, deviation, w, e, trace = brute_whitening(rows, components)
    k = min(components, len(rows[0][1]))
    assert len(got) == len(rows) * k
    table = {}
    for r in got:
        table.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    for c in range(k):
        flip = None
        for (i, _), dev, z in zip(rows, deviation, w[:, c]):
            r = table[i, dev][c + 1][0]
            assert r.n == n and abs(r.explained - e[c] / trace) <= 1e-9 * e[c] / trace and r.identity_error <= 1e-8
            if flip is None and abs(z) > 1e-3:
                flip = np.sign(z * r.whitened)
            assert abs(r.whitened - (flip or 1) * z) < 1e-6 or abs(z) <= 1e-3


def test_whitening_matches_exact_fractions(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(6) * [1, 2, 3, 4, 5, 6]).tolist()) for i in range(200)]
    rows += [(7, rows[7][1]), (None, rows[0][1])]
    got = WH.whiten(vectors(spark, rows).repartition(3)).collect()
    check_whitening(got, rows)
    assert len({r.identity_error for r in got}) == 1
    check_whitening(WH.whiten(vectors(spark, rows), components=2).collect(), rows, 2)


def test_whitening_over_the_table(spark):
    got = Q.op11_whitening(spark, SF).collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitening(got, [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])])


def test_whitening_of_awkward_rows(spark):
    good = [(0, [1.0, 2.0]), (1, [3.0, -1.0]), (2, [0.5, 0.25]), (3, [0.5, 0.25])]
    bad = [(10, None), (11, [None, 1.0]), (12, [math.nan, 1.0]), (13, [math.inf, 1.0]), (14, []), (15, [1.0, 2.0, 3.0])]
    got = WH.whiten(vectors(spark, bad + good)).collect()
    assert {r.vec_id for r in got} == {0, 1, 2, 3}
    check_whitening(got, good)
    assert WH.whiten(vectors(spark, [])).collect() == [] == WH.whiten(vectors(spark, bad[:5])).collect()
    flat = WH.whiten(vectors(spark, [(0, [1.0, 2.0]), (1, [1.0, 2.0])])).collect()
    assert len(flat) == 4 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in flat)
    line = WH.whiten(vectors(spark, [(i, [float(i), 2.0 * i]) for i in range(5)])).collect()
    assert {r.component for r in line if r.whitened is not None} == {1} and max(r.identity_error for r in line) < 1e-9
    with pytest.raises(Exception, match="too large"):
        WH.whiten(vectors(spark, [(0, [1e300, 1.0])])).collect()


def test_square_sums_beyond_64_bits():
    rng = np.random.default_rng(1)
    for top in (10, 1 << 31, (1 << 60) - 1):
        s = rng.integers(-top, top, (3, 50))
        assert list(WH._square_sums(s)) == [sum(int(v) ** 2 for v in row) for row in s]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of every row, level by level."""
    def leaf(row, lower=False):
        i, t, lang, source, n = row
        if lower and t is not None:
            t = t.translate(str.maketrans(MK.UPPER, MK.LOWER))
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, t)))

    def tree(nodes):
        """root, and per node the siblings on its way as (before, after)."""
        paths, where = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, at in enumerate(where):
                run = nodes[at // 16 * 16:at // 16 * 16 + 16]
                paths[k].append(("".join(run[:at % 16]), "".join(run[at % 16 + 1:])))
                where[k] = at // 16
            nodes = [sha("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
        return nodes[0], paths

    sources = {}
    for row in rows:
        sources.setdefault(row[3], []).append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    below = {}
    for s in order:
        some = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        below[s] = (some, *tree([leaf(r) for r in some]))
    root, over = tree([below[s][1] for s in order])
    out = []
    for s, upper in zip(order, over):
        some, subroot, paths = below[s]
        for row, path in zip(some, paths):
            h = leaf(row, row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0)
            for a, z in path + upper:
                h = sha(a + h + z)
            out.append((row[0], leaf(row), subroot, root, sha("".join(a + z for a, z in path + upper)), h, h == root))
    return out


def plain(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("levels", [1, 2])
def test_manifest_matches_brute_force(spark, levels):
    # 4500 leaves of one source need rounds over incomplete subtrees; 300 sources need a tree of their own
    rows = [(i, f"Text {i}" if i % 7 else None, "en", "hot" if i < 4500 else f"s{i % 300}", i) for i in range(6000)]
    rows += [(None, "Null Id", None, None, None), (None, "Null Id", None, None, None), (3, "Again", "en", "hot", 3), (-5, "", "", "", 0)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, sid int, leaf string").repartition(5)
    assert plain(MK.manifest(docs, levels).collect()) == plain(brute_manifest(rows))


def test_manifest_of_awkward_rows(spark):
    rows = cases.documents()
    for part in (rows, rows[:1], rows[:16], rows[:17]):
        got = MK.manifest(cases.table(spark, part)).collect()
        assert plain(got) == plain(brute_manifest([r[:5] for r in part]))
    assert MK.manifest(cases.table(spark, [])).collect() == []


def test_manifest_sql(spark):
    got = Q.op12_merkle_manifest(spark, SF).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    res = con.execute(Q.ORACLE["op12_merkle_manifest"])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(got[0].__fields__)
    assert plain([tuple(r[n] for n in names) for r in got]) == plain(res.fetchall())
    assert 0 < sum(not r.verified for r in got) < len(got)


def brute_counts(rows):
    sp = sentencepiece.SentencePieceProcessor(model_file=TC.model_path())
    return sorted(((r[0], len((r[1] or "").encode()), n := len(sp.encode(r[1] or "")), n > 4096) for r in rows), key=str)


def test_token_counts(spark, tmp_dir):
    rows = cases.documents() + [(90, "one <s> two </s> <unk> <0x0A>\n ▁x  \t y", "en", "s", 0, *cases.EXTRA)]
    docs, cache = cases.table(spark, rows), f"{tmp_dir}/cache"
    got = TC.count_tokens(docs, cache).collect()
    assert sorted(map(tuple, got), key=str) == brute_counts(rows)
    assert sorted(map(tuple, TC.count_tokens(docs).collect()), key=str) == brute_counts(rows)
    assert TC.count_tokens(cases.table(spark, []), f"{tmp_dir}/none").collect() == []


def test_only_distinct_misses_are_encoded(spark, tmp_dir):
    rows, cache = cases.documents(), f"{tmp_dir}/cache"
    texts = {r[1] or "" for r in rows}
    assert TC.fill_cache(cases.table(spark, rows), cache).count() == len(texts)
    assert TC.fill_cache(cases.table(spark, rows), cache).count() == 0
    more = cases.plain(spark, [(1, "never seen"), (2, "never seen"), (3, rows[0][1])])
    assert TC.fill_cache(more, cache).count() == 1
    # counts come from the cache, and two appends of one content make one row
    version = TC.tokenizer_version(TC.model_path())
    stored = spark.read.parquet(cache)
    assert stored.count() == len(texts) + 1 and {r.tokenizer for r in stored.collect()} == {version}
    spark.createDataFrame(stored.collect(), stored.schema).write.mode("append").parquet(cache)
    assert TC.count_tokens(more, cache).count() == 3
    # another version knows nothing of these
    assert TC.read_cache(spark, cache, "other").count() == 0
