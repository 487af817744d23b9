"""Exact substring de-duplication by a hash-compared suffix sort, distributed by anchors.

Every window of ``length`` bytes is addressed by its anchor, the leftmost of
its k-grams with the smallest hash: equal windows have equal anchors at equal
offsets, so they meet wherever an anchor's key is sent. Consecutive windows
with one anchor form a segment. Keys that occur once are dropped by a first
exchange of short key remainders; the segments of the others are dealt out by
key. There the suffixes that start at the anchors, and those that run back
from them, are sorted by hash comparison; runs of neighbours with a long
enough common extension give, for each offset, the classes of equal windows.
A key with very many different segments (a frequent line between other texts)
is not sorted: its windows are dealt one by one, by their digests.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, inverse, mix, powers, prefix_hash, staged
from .key_exchange import TOLD, announce, answer
from .suffix_sort import sorted_suffixes

LENGTH = 100
GRAM = 32
#: Text bytes per shard; the number of shards follows the input.
SHARD_BYTES = 8 << 20
MIN_SHARDS = 8
#: Segments that are sorted at a time (keys stay whole).
SORT_ROWS = 20_000
#: A key is split into its windows if some shard holds this many different segments of it, or its share of SORT_ROWS if that is more.
HOT_ROWS = 16
#: Bucket to which the shards tell such keys.
_HOT = -1
_CHUNK = 1 << 21
_LAST = (1 << 63) - 1


def segments(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Rows ``(anchor, first window, last window, key)`` (as uint64) covering every window of ``data``."""
    out, at, n = [], 0, len(data) - length + 1
    while at < n:
        part = data[at:at + _CHUNK - 1]
        p = prefix_hash(part)
        m = len(part) - gram + 1
        h = mix((p[gram:] - p[:-gram]) * powers(m, inverse(0x9E3779B97F4A7C15))[:m])
        low = (h & ~U64(_CHUNK - 1)) | np.arange(m, dtype=U64)
        width, step = 1, 1
        want = length - gram + 1
        while width < want:
            step = min(width, want - width)
            low = np.minimum(low[:-step], low[step:])
            width += step
        spot = (low & U64(_CHUNK - 1)).astype(np.int64)
        edge = np.flatnonzero(spot[1:] != spot[:-1])
        first = np.concatenate(([0], edge + 1))
        last = np.concatenate((edge, [len(spot) - 1]))
        anchor = spot[first]
        out.append(np.stack([(anchor + at).astype(U64), (first + at).astype(U64), (last + at).astype(U64), h[anchor]]))
        at += len(spot)
    return np.concatenate(out, axis=1) if out else np.zeros((4, 0), dtype=U64)


def _list(table: pa.Table, column: str) -> list:
    """A column's values; a side of a cogroup without rows has no columns."""
    return table[column].to_pylist() if table.num_columns else []


def _texts(table: pa.Table, keep: dict) -> list[tuple[int, bytes]]:
    """The shard's texts to work on, in document order, as ``(ord, bytes)``."""
    rows = {keep[i, s]: t for i, s, t in zip(_list(table, "ord"), _list(table, "sha"), _list(table, "text")) if (i, s) in keep}
    return [(o, rows[o].encode("utf-8", "surrogatepass")) for o in sorted(rows)]


def _shard_segments(texts: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Segments of all texts of a shard, and the number of the text of each."""
    segs = [segments(np.frombuffer(t, dtype=np.uint8)) for _, t in texts]
    doc = np.repeat(np.arange(len(segs)), [s.shape[1] for s in segs])
    return (np.concatenate(segs, axis=1) if segs else np.zeros((4, 0), dtype=U64)), doc


def _keep(other: pa.Table) -> dict:
    """``(ord, sha)`` of the shard's texts -> their place in document order, without a column of places ``ord`` itself."""
    place = "place" if "place" in other.column_names else "ord"
    return {(i, s): o for i, s, o in zip(*(_list(other, c) for c in ("ord", "sha", place))) if s is not None}


def hot_keys(texts: list[tuple[int, bytes]], segs: np.ndarray, doc: np.ndarray, length: int, least: int) -> np.ndarray:
    """Keys of which the shard holds at least ``least`` different segments."""
    keys, inv, count = np.unique(segs[3], return_inverse=True, return_counts=True)
    often = np.flatnonzero(count[inv] >= least)
    anchor, first, last = (segs[i][often].astype(np.int64) for i in range(3))
    held = {(int(k), a - f, hashlib.blake2b(texts[d][1][f:t + length], digest_size=16).digest()) for k, d, a, f, t in
            zip(inv[often], doc[often].tolist(), anchor.tolist(), first.tolist(), last.tolist())}
    different = np.bincount(np.array([k for k, _, _ in held], dtype=np.int64), minlength=len(keys))
    return keys[different >= least]


def _announce(shards: int, length: int, least: int):
    def run(key, docs: pa.Table, other: pa.Table) -> pa.Table:
        texts = _texts(docs, _keep(other))
        segs, doc = _shard_segments(texts)
        told = announce(key[0].as_py(), segs[3], shards)
        hot = hot_keys(texts, segs, doc, length, least)
        if not len(hot):
            return told
        row = (_HOT, key[0].as_py(), hot.tobytes(), b"")
        return pa.concat_tables([told, pa.table({c: pa.array([v], f.type) for c, v, f in zip(told.column_names, row, told.schema)})])
    return run


def _answer(shards: int | None = None):
    """Per shard the numbers of its repeated keys; the hot keys of all shards under ord ``_HOT``, in a row for each of
    ``shards``, or in one row under shard ``_HOT`` that the caller hands on."""

    def run(key, table):
        if key[0].as_py() == _HOT:
            hot = np.unique(np.concatenate([np.frombuffer(b, dtype=U64) for b in table["short"].to_pylist()])).tobytes()
            to = [_HOT] if shards is None else list(range(shards))
            shard, name, blob = pa.array(to, pa.int64()), pa.array([_HOT] * len(to), pa.int64()), pa.array([hot] * len(to), pa.binary())
        else:
            shard, blob = answer(table)
            name = pa.nulls(len(shard), pa.int64())
        return pa.table({"shard": shard, "ord": name, "sha": pa.nulls(len(shard), pa.string()), "blob": blob})
    return run


def _windows(texts, ords, doc, first, last, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of segments in document order: rows ``(digest, digest, ord, start)``, and whether an equal one stands before."""
    size = last - first + 1
    own = np.repeat(np.arange(len(doc)), size)
    start = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + first[own]
    raw = b"".join(hashlib.blake2b(texts[d][1][s:s + length], digest_size=16).digest() for d, s in zip(doc[own].tolist(), start.tolist()))
    rows = np.concatenate((np.frombuffer(raw, dtype=np.int64).reshape(-1, 2).T, ords[doc[own]][None], start[None]))
    return rows, _again(rows)


def _again(rows: np.ndarray) -> np.ndarray:
    """Which windows ``(digest, digest, ord, start)`` are equal to one that starts earlier."""
    by = np.lexsort(rows[::-1])
    out = np.zeros(rows.shape[1], dtype=bool)
    out[by[1:]] = (rows[:2, by[1:]] == rows[:2, by[:-1]]).all(axis=0)
    return out


def _window_marks(rows: np.ndarray, length: int) -> np.ndarray:
    """Removed ranges of windows, neighbours in one."""
    o, s = rows[2:, np.lexsort((rows[3], rows[2]))]
    new = np.ones(len(o), dtype=bool)
    new[1:] = (o[1:] != o[:-1]) | (s[1:] > s[:-1] + length)
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(o))[:len(at)] - 1
    return np.stack([o[at], s[at], s[end] + length])


def _runs_to_blob(ords, start, end) -> bytes:
    """Removed byte ranges as int64 triples (document key, start, end)."""
    return np.stack([ords.astype(np.int64), start.astype(np.int64), end.astype(np.int64)]).tobytes()


def _deal(shards: int, length: int):
    """Per shard: the segments with repeated keys, dealt out by key.

    Of segments equal within the shard the first is sent; every window of
    the others starts earlier in that one, so they are marked at once. Of
    hot keys the windows are sent, of equal ones the first.
    """

    def run(key, docs: pa.Table, other: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        texts = _texts(docs, _keep(other))
        segs, doc = _shard_segments(texts)
        _, inv, count = np.unique(segs[3], return_inverse=True, return_counts=True)
        take = count[inv] > 1
        hot = np.zeros(len(take), dtype=bool)
        for name, blob in zip(_list(other, "ord"), _list(other, "blob")):
            if blob is not None and name == _HOT:
                hot = np.isin(segs[3], np.frombuffer(blob, dtype=U64))
            elif blob is not None:
                take[np.frombuffer(blob, dtype=np.uint32)] = True
        ords = np.array([i for i, _ in texts], dtype=np.int64)
        wins, old_wins = _windows(texts, ords, doc[hot], *(segs[i][hot].astype(np.int64) for i in (1, 2)), length)
        take = np.flatnonzero(take & ~hot)
        anchor, first, last = (segs[i][take].astype(np.int64) for i in range(3))
        doc, k = doc[take], segs[3][take]
        pieces = [texts[d][1][a:b + length] for d, a, b in zip(doc.tolist(), first.tolist(), last.tolist())]
        seen: dict = {}
        fresh = np.ones(len(pieces), dtype=bool)
        for j, (piece, off) in enumerate(zip(pieces, (anchor - first).tolist())):
            if seen.setdefault((off, piece), j) != j:
                fresh[j] = False
        del seen
        old = ~fresh
        marks = _runs_to_blob(*np.concatenate((np.stack((ords[doc[old]] if len(ords) else doc[old], first[old], last[old] + length)),
                                               _window_marks(wins[:, old_wins], length)), axis=1))
        bucket = (mix(k) % U64(shards)).astype(np.int64)
        by = np.flatnonzero(fresh)
        by = by[np.argsort(bucket[by], kind="stable")]
        cuts = np.flatnonzero(np.diff(bucket[by])) + 1
        parts = np.split(by, cuts) if len(by) else []
        pack = zstandard.ZstdCompressor(level=1)
        cols: dict = {"bucket": [shard], "ords": [None], "anchor": [None], "back": [None], "size": [None],
                      "key": [None], "text": [None], "marks": [marks], "wins": [None]}
        for p in parts:
            cols["bucket"].append(int(bucket[p[0]]))
            cols["ords"].append(pack.compress(ords[doc[p]].tobytes()))
            cols["anchor"].append(pack.compress(anchor[p].astype(np.int64).tobytes()))
            cols["back"].append((anchor[p] - first[p]).astype(np.uint8).tobytes())
            cols["size"].append((last[p] - first[p]).astype(np.int64).tobytes())
            cols["key"].append(k[p].tobytes())
            cols["text"].append(pack.compress(b"".join([pieces[j] for j in p.tolist()])))
            cols["marks"].append(None)
            cols["wins"].append(None)
        wins = wins[:, ~old_wins]
        bucket = (wins[0].astype(U64) % U64(shards)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        for p in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1) if len(by) else []:
            for c in cols:
                cols[c].append(int(bucket[p[0]]) if c == "bucket" else wins[:, p].tobytes() if c == "wins" else None)
        return pa.table({"bucket": pa.array(cols["bucket"], pa.int64()),
                         **{c: pa.array(cols[c], pa.binary()) for c in list(cols)[1:]}})
    return run


_DEALT = "bucket long, ords binary, anchor binary, back binary, size binary, key binary, text binary, marks binary, wins binary"


def repeated_windows(text: np.ndarray, at: np.ndarray, back: np.ndarray, more: np.ndarray, key: np.ndarray,
                     length: int) -> np.ndarray:
    """Which windows of segments start earlier too, as a matrix (segment, offset of the anchor in the window).

    Segment i stands in ``text`` with its anchor at ``at[i]`` and holds the
    windows that start ``back[i] - more[i]`` to ``back[i]`` bytes before it;
    segments are numbered in document order. Segments of one key are sorted
    by what follows the anchor and by what precedes it. Two of them hold the
    same window at offset d if they agree in ``length - d`` bytes after the
    anchor and d bytes before it, i.e. lie in one run of either order.
    """
    n = len(at)
    right = length - (back - more)
    groups = np.unique(key, return_inverse=True)[1]
    order_r, first_r, lcp_r = sorted_suffixes(text, at, right, groups)
    order_l, first_l, lcp_l = sorted_suffixes(text[::-1].copy(), len(text) - at, back, groups)
    out = np.zeros((n, int(back.max(initial=0)) + 1), dtype=bool)
    run_r, run_l = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for d in range(out.shape[1]):
        live = np.flatnonzero((back >= d) & (back - more <= d))
        if len(live) < 2:
            continue
        run_r[order_r] = np.cumsum(first_r | (lcp_r < length - d))
        run_l[order_l] = np.cumsum(first_l | (lcp_l < d))
        _, lead = np.unique(run_r[live] * (n + 1) + run_l[live], return_index=True)
        out[live, d] = True
        out[live[lead], d] = False
    return out


def _sort_bucket(shards: int, length: int):
    def run(table: pa.Table) -> pa.Table:
        open_ = zstandard.ZstdDecompressor()
        got = [r for r in table.to_pylist() if r["ords"] is not None]
        marks = [np.frombuffer(r["marks"], dtype=np.int64).reshape(3, -1) for r in table.to_pylist() if r["marks"]]
        wins = [np.frombuffer(w, dtype=np.int64).reshape(4, -1) for w in table["wins"].to_pylist() if w]
        if wins:
            rows = np.concatenate(wins, axis=1)
            marks.append(_window_marks(rows[:, _again(rows)], length))
        if got:
            def column(c, kind, packed):
                return np.concatenate([np.frombuffer(open_.decompress(r[c]) if packed else r[c], dtype=kind) for r in got])

            ords, anchor = column("ords", np.int64, True), column("anchor", np.int64, True)
            back, more = column("back", np.uint8, False).astype(np.int64), column("size", np.int64, False)
            key, text = column("key", U64, False), column("text", np.uint8, True)
            at = np.concatenate(([0], np.cumsum(more + length)))[:-1] + back
            held = np.unique(key, return_inverse=True, return_counts=True)
            use = np.flatnonzero(held[2][held[1]] > 1)
            use = use[np.lexsort((anchor[use], ords[use]))]
            # a bounded number of segments at a time, whole keys together
            by = use[np.argsort(key[use], kind="stable")]
            edges = np.flatnonzero(np.diff(key[by])) + 1
            cuts, begin = [], 0
            for e in edges.tolist():
                if e - begin >= SORT_ROWS:
                    cuts.append(e)
                    begin = e
            for part in (np.split(by, cuts) if len(by) else []):
                part = part[np.lexsort((anchor[part], ords[part]))]
                lo, hi = at[part] - back[part], at[part] - back[part] + more[part] + length
                width = hi - lo
                base = np.concatenate(([0], np.cumsum(width)))[:-1]
                pick = np.repeat(lo - base, width) + np.arange(int(width.sum()))
                hit = repeated_windows(text[pick], base + back[part], back[part], more[part], key[part], length)
                edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
                row, d0 = np.nonzero(edge == 1)
                d1 = np.nonzero(edge == -1)[1] - 1
                a, o = anchor[part][row], ords[part][row]
                marks.append(np.stack([o, a - d1, a - d0 + length]))
        both = np.concatenate(marks, axis=1) if marks else np.zeros((3, 0), dtype=np.int64)
        return pa.table({"ord": pa.array(both[0], pa.int64()), "start": pa.array(both[1], pa.int64()),
                         "end": pa.array(both[2], pa.int64())})
    return run


def merged_runs(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of byte ranges as maximal runs."""
    by = np.argsort(start, kind="stable")
    start, reach = start[by], np.maximum.accumulate(end[by])
    new = np.ones(len(start), dtype=bool)
    new[1:] = start[1:] > reach[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)
    return start[new], reach[last]


def _clean(key, docs: pa.Table, other: pa.Table) -> pa.Table:
    texts = _texts(docs, _keep(other))
    marks = [r for r in zip(*(_list(other, c) for c in ("place", "start", "end"))) if r[1] is not None]
    ords, start, end = np.array(marks, dtype=np.int64).reshape(-1, 3).T
    by = np.argsort(ords, kind="stable")
    ords, start, end = ords[by], start[by], end[by]
    cols: dict = {c: [] for c in ("id", "sha", "n_removed", "n_spans", "kept_sha256", "starts", "ends")}
    names = {o: k for k, o in _keep(other).items()}
    for o, t in texts:
        lo, hi = np.searchsorted(ords, [o, o + 1])
        s, e = merged_runs(start[lo:hi], end[lo:hi]) if hi > lo else (start[:0], end[:0])
        kept, at = [], 0
        for a, b in zip(s.tolist(), e.tolist()):
            kept.append(t[at:a])
            at = b
        kept.append(t[at:])
        for c, v in zip(cols, (*names[o], int((e - s).sum()), len(s), hashlib.sha256(b"".join(kept)).hexdigest(),
                               s.tolist(), e.tolist())):
            cols[c].append(v)
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()))
    return pa.table({c: pa.array(v, k) for (c, v), k in zip(cols.items(), kinds)})


def repeated_substrings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts earlier.

    Returns ``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, starts,
    ends)``, one row per row of ``docs (doc_id, text, ...)``; ``starts`` and
    ``ends`` are the removed runs. Texts are UTF-8 bytes, null is empty;
    "earlier" is a smaller doc_id or the same document, and strings are judged
    on the input. Equal texts are one text first (partial aggregate): copies
    after the first lose everything if they have ``length`` bytes. Repeated
    rows count as copies in any order; a null doc_id stands after all others;
    rows with one doc_id and several texts stand in the order of the texts'
    digests and lose what the texts before them hold. Very long texts are
    worked on whole, in overlapping pieces; an empty table gives an empty
    result; other columns are ignored.
    """
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.octet_length(raw).cast("long").alias("n"),
                       F.sha2(raw, 256).alias("sha"))
    counts = rows.groupBy("doc_id", "sha", "n").agg(F.count(F.lit(1)).alias("c"))
    lead = counts.groupBy("sha").agg(F.min(F.coalesce("doc_id", F.lit(_LAST))).alias("lead"))
    total = counts.groupBy("sha").agg(F.max("n").alias("n")).agg(F.sum("n")).first()[0] or 0
    shards = max(MIN_SHARDS, int(total // SHARD_BYTES) + 1)
    shard = lambda i, h: F.pmod(F.xxhash64(i, h), F.lit(shards).cast("long"))

    long_enough = F.col("n") >= length
    # a text is known by document and digest; its place in document order is a number of its own
    texts = (rows.where(long_enough).select(F.coalesce("doc_id", F.lit(_LAST)).alias("ord"), "sha", "text")
             .withColumn("shard", shard("ord", "sha")))
    leads = staged(counts.where(long_enough).groupBy("sha").agg(F.min(F.coalesce("doc_id", F.lit(_LAST))).alias("id"))
                   .repartitionByRange("id", "sha").sortWithinPartitions("id", "sha")
                   .select(F.col("id").alias("ord"), "sha", F.monotonically_increasing_id().alias("place"), shard("id", "sha").alias("shard")),
                   "substring-leads")
    none = F.lit(None)

    by_shard = texts.groupBy("shard")
    keep = leads.select("shard", "ord", "sha", "place", none.cast("binary").alias("blob"))
    told = by_shard.cogroup(keep.groupBy("shard")).applyInArrow(
        _announce(shards, length, max(HOT_ROWS, SORT_ROWS // shards)), TOLD)
    everywhere = F.when(F.col("shard") == _HOT, F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).otherwise(F.array("shard"))
    answers = told.groupBy("bucket").applyInArrow(_answer(), "shard long, ord long, sha string, blob binary").select(
        F.explode(everywhere).alias("shard"), "ord", "sha", none.cast("long").alias("place"), "blob")
    dealt = by_shard.cogroup(keep.unionAll(answers).groupBy("shard")).applyInArrow(_deal(shards, length), _DEALT)
    marks = dealt.groupBy("bucket").applyInArrow(_sort_bucket(shards, length), "ord long, start long, end long").withColumnRenamed(
        "ord", "place").join(leads.select("place", "shard"), "place")
    last = leads.select("shard", "ord", "sha", "place", none.cast("long").alias("start"), none.cast("long").alias("end")).unionAll(
        marks.select("shard", none.cast("long").alias("ord"), none.cast("string").alias("sha"), "place", "start", "end"))
    clean = by_shard.cogroup(last.groupBy("shard")).applyInArrow(
        _clean, "id long, sha string, n_removed long, n_spans long, kept_sha256 string, starts array<long>, ends array<long>")

    nothing = F.sha2(F.lit("").cast("binary"), 256)
    ids = counts.join(lead, "sha").withColumn("id", F.coalesce("doc_id", F.lit(_LAST)))
    none_long = F.expr("cast(array() as array<long>)")
    short = counts.where(~long_enough).select(
        "doc_id", F.col("n").alias("n_bytes"), F.explode(F.sequence(F.lit(1), F.col("c").cast("int"))).alias("i"),
        F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("sha").alias("kept_sha256"),
        none_long.alias("starts"), none_long.alias("ends")).drop("i")
    is_lead = F.col("id") == F.col("lead")
    copies = ids.where(long_enough).withColumn("c", F.col("c") - is_lead.cast("long")).where("c > 0").select(
        "doc_id", F.col("n").alias("n_bytes"), F.explode(F.sequence(F.lit(1), F.col("c").cast("int"))).alias("i"),
        F.col("n").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), nothing.alias("kept_sha256"),
        F.array(F.lit(0).cast("long")).alias("starts"), F.array("n").alias("ends")).drop("i")
    leading = ids.where(long_enough & is_lead).select("doc_id", F.col("n").alias("n_bytes"), "id", "sha").join(
        clean, ["id", "sha"]).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "ends")
    return leading.unionAll(copies).unionAll(short)
