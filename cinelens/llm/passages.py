"""Near-duplicate passages by paragraph MinHash banding.

A document's paragraphs are its lines and, within them, chunks cut where the
words themselves say so (local minima of a hash), so that a passage set into
a longer line still has paragraphs of its own. Paragraphs that share a band of
their MinHash samples are joined and confirmed by the exact Jaccard
similarity of their shingles; links are clustered by components. Of a cluster
the first document keeps its paragraphs; in others, runs of repeated
paragraphs are removed, a repeated line whole, and extended word by word as
far as the texts agree.
"""

from __future__ import annotations

import itertools
import math
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import SHINGLE, U64, components, cut, given_up, mix, numbered, prefix_hash, signed, slices, span_hash, staged
from .key_exchange import TOLD, announce, answer, repeated_here
from .near_dedup import _agree

PERCENT = 75
#: Distinct shingles up to which a set's bands are its smallest hashes, as many as no pair over the threshold can avoid.
NARROW = 32
#: Larger sets have as many bands of two MinHash samples as keep a pair at the threshold with this chance.
RECALL = 0.999
ROWS = 2
#: A border stands before a word whose hash is the smallest of as many words to either side.
REACH = 5
#: Words of a run of repeated paragraphs that is removed.
MIN_WORDS = 20
#: Sets of fewer shingles are similar at 0.75 only if they are equal.
LEAST_SET = 3
SHARD_BYTES = 6 << 20
MIN_SHARDS = 8
#: Characters that are hashed at a time.
BATCH_CHARS = 1 << 19
#: Members of a bucket that are compared in one task, and those of a bucket whose pairs are joined.
BLOCK = 1000
FEW = 12
#: Words beside a run that are compared in the first round and in the second one; later rounds double up to the last figure.
CONTEXT = 32
FURTHER = 1024
MOST = 1 << 16
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def bands_for(percent: int = PERCENT, recall: float = RECALL) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - (percent / 100) ** ROWS))


def band_keys(flat: np.ndarray, offsets: np.ndarray, f: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Band keys of sets (distinct hashes, ascending within a set), and the number of the set of each key.

    Sets of one or two shingles are similar only if they are equal: their key
    is the fingerprint. Two sets of which the smaller has ``n`` shingles share
    at least ``ceil(n * percent / 100)`` of them if they are similar, so they share one
    of their ``n - ceil(n * percent / 100) + 1`` smallest MinHash values: up to ``NARROW``
    shingles these are the bands, and no similar pair is missed. Larger sets
    have bands of ``ROWS`` samples; sets between the two sizes, which can pair
    with either kind, have both.
    """
    n = np.diff(offsets)
    tiny = np.flatnonzero(n < LEAST_SET)
    keys, own = [mix(f[tiny] + U64(0x2545F4914F6CDD1D))], [tiny]
    narrow = np.flatnonzero((n >= LEAST_SET) & (n <= NARROW))
    count = n[narrow] - (n[narrow] * percent + 99) // 100 + 1
    begin = np.concatenate(([0], np.cumsum(count)[:-1])).astype(np.int64)
    spot = np.repeat(offsets[:-1][narrow] - begin, count) + np.arange(int(count.sum()))
    keys.append(mix(flat[spot] + U64(0x9E6C63D0876A9A35)))
    own.append(np.repeat(narrow, count))
    large = np.flatnonzero(100 * n > percent * NARROW)
    if len(large):
        size = n[large]
        begin = np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.int64)
        h = flat[np.repeat(offsets[:-1][large] - begin, size) + np.arange(int(size.sum()))]
        for band in range(bands_for(percent)):
            key = np.full(len(large), band + 1, dtype=U64)
            for row in range(ROWS):
                seed = int(mix(np.array([101 + band * ROWS + row], dtype=U64))[0]) | 1
                key = mix(key ^ mix(np.minimum.reduceat(h * U64(seed), begin)))
            keys.append(key)
            own.append(large)
    return np.concatenate(keys), np.concatenate(own)


def odd_sketch(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64 parity bits of each set: two sets differ in at least as many shingles as their sketches do in bits."""
    if len(offsets) < 2:
        return np.zeros(0, dtype=U64)
    return np.bitwise_xor.reduceat(U64(1) << (flat & U64(63)), offsets[:-1])


def _may_link(n, m, z, y, percent: int):
    """Whether sizes and sketches allow the similarity (never false for a pair that has it).

    Works on columns and on arrays alike: ``bits`` are the sketches' differing
    bits. Of a similar pair the shingles in one set alone are at most
    ``(100 - percent) / percent`` of the smaller set.
    """
    bits = F.bit_count(z.bitwiseXOR(y)) if hasattr(z, "bitwiseXOR") else np.bitwise_count(z ^ y).astype(np.int64)
    return ((100 * n >= percent * m) & (100 * m >= percent * n) & (percent * bits <= (100 - percent) * n)
            & (percent * bits <= (100 - percent) * m))


class Paragraphs:
    """Paragraphs of a shard's texts, worked out over all of them at once.

    ``doc`` (number of the text), ``unit`` and ``last`` (its chunks, by number
    within the text; a line of several chunks is a paragraph besides them),
    ``begin`` and ``end`` (bytes in its text), ``at`` (number of the first
    word) and ``words``, hashes of the words before and after it (``pre``,
    ``post``; 0 where the text ends), and the shingle hashes, flat with ``starts`` (a
    paragraph's shingles may repeat).
    """

    def __init__(self, texts: list[str], reach: int = REACH):
        raws = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
        size = np.array([len(r) for r in raws], dtype=np.int64)
        base = np.concatenate(([0], np.cumsum(size + 1)[:-1])).astype(np.int64)
        raw = np.frombuffer(b" ".join(raws) + b" ", dtype=np.uint8)
        space = (raw == 32) | ((raw >= 9) & (raw <= 13))
        edge = np.diff(np.concatenate(([True], space)).astype(np.int8))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge[1:] == 1) + 1
        n = len(start)
        if not n:
            self.doc = self.unit = self.last = self.begin = self.end = self.at = self.words = self.starts = np.zeros(0, dtype=np.int64)
            self.pre = self.post = self.shingles = np.zeros(0, dtype=U64)
            return
        doc = np.searchsorted(base, start, side="right") - 1
        w = mix(span_hash(prefix_hash(raw), start, end) + (end - start).astype(U64))
        last = np.append(doc[1:] != doc[:-1], True)
        pair = mix(w + np.where(last, U64(0), np.append(w[1:], U64(0))) * U64(3))
        # texts lie apart by as many empty places as a border looks at, so none sees another
        spot = np.arange(n) + reach * (doc + 1)
        wide = np.full(int(spot[-1]) + reach + 1, np.iinfo(np.uint64).max, dtype=U64)
        wide[spot] = pair
        low = np.full(n, np.iinfo(np.uint64).max, dtype=U64)
        high = low.copy()
        for k in range(1, reach + 1):
            np.minimum(low, wide[spot - k], out=low)
            np.minimum(high, wide[spot + k], out=high)
        border = (pair <= high) & (pair < low)
        lines = np.cumsum(raw == 10)[start]
        fresh = np.append(True, (lines[1:] != lines[:-1]) | (doc[1:] != doc[:-1]))
        chunk, line = np.flatnonzero(border | fresh), np.flatnonzero(fresh)
        # lines of several chunks stand before their first chunk
        a, b = np.append(chunk, line), np.concatenate((chunk[1:], [n], line[1:], [n]))
        unit, final = np.searchsorted(chunk, a), np.searchsorted(chunk, b) - 1
        by = np.flatnonzero((np.arange(len(a)) < len(chunk)) | (final > unit))
        by = by[np.lexsort((-b[by], a[by]))]
        a, b = a[by], b[by]
        self.doc, self.words = doc[a], b - a
        zero = np.searchsorted(doc, self.doc, side="left")
        self.unit, self.last = (x[by] - np.searchsorted(chunk, zero) for x in (unit, final))
        self.at = a - zero
        self.pre = np.where(a > zero, w[a - 1], U64(0))
        self.post = np.where(last[b - 1], U64(0), w[np.minimum(b, n - 1)])
        self.begin, self.end = start[a] - base[self.doc], end[b - 1] - base[self.doc]
        count = np.maximum(1, self.words - SHINGLE + 1)
        self.starts = np.concatenate(([0], np.cumsum(count)[:-1]))
        pad = np.concatenate((w, np.zeros(SHINGLE, dtype=U64)))
        rolled = np.zeros(n, dtype=U64)
        short = self.words.astype(U64)
        for j in range(SHINGLE):
            c = U64(2 * j + 3)
            rolled += mix(pad[j:j + n] * c)
            if j < SHINGLE - 1:
                short += np.where(self.words > j, mix(pad[a + j] * c), U64(0))
        rolled = mix(rolled)
        spot = np.repeat(a - self.starts, count) + np.arange(int(count.sum()))
        self.shingles = rolled[np.minimum(spot, n - 1)]
        few = self.words < SHINGLE
        self.shingles[self.starts[few]] = mix(short[few])

    @classmethod
    def over(cls, texts: list[str], limit: int = BATCH_CHARS) -> Paragraphs:
        """Paragraphs of many texts, worked out a bounded number of characters at a time."""
        size = np.cumsum([len(t) for t in texts]) // limit
        cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(texts)]
        out, names = cls([]), ("unit", "last", "begin", "end", "at", "words", "pre", "post", "prints", "doc", "flat")
        held = {c: [] for c in names}
        counts = [np.zeros(0, dtype=np.int64)]
        for a, b in zip(cuts, cuts[1:]):
            part = cls(texts[a:b])
            part.flat, offsets, part.prints = part.sets(np.arange(len(part.words)))
            part.doc = part.doc + a
            part.shingles = part.starts = None
            counts.append(np.diff(offsets))
            for c in names:
                held[c].append(getattr(part, c))
        for c in names:
            kind = U64 if c in ("pre", "post", "prints", "flat") else np.int64
            setattr(out, c, np.concatenate([np.zeros(0, dtype=kind), *held.pop(c)]))
        out.offsets = np.concatenate(([0], np.cumsum(np.concatenate(counts)))).astype(np.int64)
        return out

    def sets(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct shingles of some paragraphs: flat, offsets, and a fingerprint each."""
        size = np.append(self.starts[1:], len(self.shingles))[which] - self.starts[which]
        begin = np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.int64)
        flat = self.shingles[np.repeat(self.starts[which] - begin, size) + np.arange(int(size.sum()))]
        own = np.repeat(np.arange(len(which)), size)
        # by hash, then stably by paragraph (numbers of 16 bits are sorted by radix)
        by = np.argsort(flat)
        by = by[np.argsort(own[by].astype(np.uint16 if len(which) <= 1 << 16 else np.int64), kind="stable")]
        flat, own = flat[by], own[by]
        keep = np.ones(len(flat), dtype=bool)
        keep[1:] = (flat[1:] != flat[:-1]) | (own[1:] != own[:-1])
        flat, own = flat[keep], own[keep]
        offsets = np.concatenate(([0], np.cumsum(np.bincount(own, minlength=len(which)))))
        total = np.add.reduceat(flat, offsets[:-1]) if len(which) else np.zeros(0, dtype=U64)
        return flat, offsets, mix(total + np.diff(offsets).astype(U64))


def _shard(docs: pa.Table, other: pa.Table) -> tuple[list[tuple[int, int]], Paragraphs]:
    """The shard's texts but for copies of texts elsewhere (named in ``other``), and their paragraphs."""
    if not docs.num_columns:
        return [], Paragraphs.over([])
    skip = set(zip(other["skip_id"].to_pylist(), other["skip_h"].to_pylist())) if other.num_columns else set()
    rows = {(i, h): t for i, h, t in zip(docs["doc_id"].to_pylist(), docs["h"].to_pylist(), docs["text"].to_pylist())
            if (i, h) not in skip}
    names = sorted(rows)
    return names, Paragraphs.over([rows[k] for k in names])


def _tell(shards: int, percent: int):
    def run(key, docs, other):
        found = _shard(docs, other)[1]
        return announce(key[0].as_py(), band_keys(found.flat, found.offsets, found.prints, percent)[0], shards)
    return run


def _hear(table: pa.Table) -> pa.Table:
    shard, blob = answer(table)
    return pa.table({"shard": shard, "blob": blob})


_ROWS = "doc_id long, h long, unit int, last int, begin int, end int, at int, words int, pre long, post long, f long, n int, z long, bands array<long>"


def _repeated(percent: int):
    """Paragraphs that share bands with others; the shared bands are given once per shard and fingerprint."""

    def run(key, docs: pa.Table, other: pa.Table) -> pa.Table:
        names, found = _shard(docs, other)
        flat, offsets, f = found.flat, found.offsets, found.prints
        keys, own = band_keys(flat, offsets, f, percent)
        take = repeated_here(keys)
        for blob in other["blob"].to_pylist() if other.num_columns else []:
            if blob is not None:
                take[np.frombuffer(blob, dtype=np.uint32)] = True
        keys, own = keys[take], own[take]
        which = np.unique(own)
        n, f, z = np.diff(offsets)[which], f[which], odd_sketch(flat, offsets)[which]
        new = np.zeros(len(which), dtype=bool)
        new[np.unique(f, return_index=True)[1]] = True
        new &= n >= LEAST_SET
        ids = np.array(names, dtype=np.int64).reshape(-1, 2)
        # lists of the first paragraph of each fingerprint; null for the others
        by = np.argsort(own, kind="stable")
        count = np.bincount(own, minlength=len(offsets))[which]
        held = keys[by][np.repeat(new, count)]
        at = np.concatenate(([0], np.cumsum(np.where(new, count, 0))))
        bands = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(signed(np.ascontiguousarray(held))), mask=pa.array(~new))
        cols = [pa.array(ids[found.doc[which], 0]), pa.array(ids[found.doc[which], 1]),
                *(pa.array(getattr(found, c)[which].astype(np.int32)) for c in ("unit", "last", "begin", "end", "at", "words")),
                *(pa.array(signed(np.ascontiguousarray(getattr(found, c)[which]))) for c in ("pre", "post")),
                pa.array(signed(f)), pa.array(n.astype(np.int32)), pa.array(signed(z), mask=~new), bands]
        rows = pa.table(dict(zip([x.split()[0] for x in _ROWS.split(", ")], cols)))
        # a row for each text with its number of words, under unit -1
        total = np.zeros(len(ids), dtype=np.int64)
        np.maximum.at(total, found.doc, found.at + found.words)
        whole = {"doc_id": pa.array(ids[:, 0]), "h": pa.array(ids[:, 1]), "unit": pa.array(np.full(len(ids), -1, np.int32)),
                 "words": pa.array(total.astype(np.int32))}
        return pa.concat_tables([rows, pa.table({f.name: whole.get(f.name, pa.nulls(len(ids), f.type)) for f in rows.schema})])
    return run


def _sets(key, docs: pa.Table, asked: pa.Table) -> pa.Table:
    """Shingle sets of the asked pieces (whole paragraphs) of a shard's texts."""
    places: dict = {}
    for r in asked.to_pylist() if asked.num_columns else []:
        places.setdefault((r["rep_id"], r["rep_h"]), []).append((r["f"], r["begin"], r["end"]))
    prints, pieces = [], []
    if places:
        for i, h, t in zip(docs["doc_id"], docs["h"], docs["text"]):
            asks = places.pop((i.as_py(), h.as_py()), None)
            if asks:
                raw = t.as_py().encode("utf-8", "surrogatepass")
                for f, a, b in asks:
                    prints.append(f)
                    pieces.append(raw[a:b].decode("utf-8", "surrogatepass"))
    found = Paragraphs.over(pieces)
    # the first paragraph of a piece without line breaks is the piece itself
    first = np.searchsorted(found.doc, np.arange(len(pieces)))
    size = np.diff(found.offsets)[first]
    at = np.concatenate(([0], np.cumsum(size)))
    spot = np.repeat(found.offsets[first] - at[:-1], size) + np.arange(int(at[-1]))
    return pa.table({"f": pa.array(prints, pa.int64()), "set": pa.ListArray.from_arrays(
        pa.array(at.astype(np.int32)), pa.array(signed(np.ascontiguousarray(found.flat[spot]))))})


_MET = "b long, f long, n int, z long, other long"


def _meet(percent: int):
    """Rows ``(f, n, z, b)`` sorted by bucket and class -> pairs ``(f, other)`` of small buckets that sizes and sketches
    let link, and the members of larger buckets (``other`` null); a class may stand in a bucket several times and a
    bucket's rows may come in several batches."""

    def told(f, n, z, b, other=None):
        cols = [pa.array(b), pa.array(f), pa.array(n.astype(np.int32)), pa.array(z)]
        return pa.RecordBatch.from_arrays([*cols, pa.nulls(len(f), pa.int64()) if other is None else pa.array(other)],
                                          names=[c.split()[0] for c in _MET.split(", ")])

    def decided(cols):
        f, n, z, b = cols
        first = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
        size = np.diff(np.append(first, len(b)))
        count = np.repeat(size, size)
        big = count > FEW
        if big.any():
            yield told(f[big], n[big], z[big], b[big])
        small = np.flatnonzero((count > 1) & ~big)
        f, n, z, b = f[small], n[small].astype(np.int64), z[small], b[small]
        for d in range(1, min(FEW, len(f))):
            near = np.flatnonzero((b[:-d] == b[d:]) & _may_link(n[:-d], n[d:], z[:-d].view(U64), z[d:].view(U64), percent))
            if len(near):
                yield told(f[near], n[near], z[near], b[near], f[near + d])

    def run(batches):
        rest, hot, before = None, None, (None, None)
        for batch in batches:
            cols = [np.ascontiguousarray(batch[c].to_numpy()) for c in ("f", "n", "z", "b")]
            if not len(cols[3]):
                continue
            f, b = cols[0], cols[3]
            new = np.append(before != (f[0], b[0]), (f[1:] != f[:-1]) | (b[1:] != b[:-1]))
            before = f[-1], b[-1]
            cols = [c[new] for c in cols]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols)]
            if hot is not None:
                at = int(np.searchsorted(cols[3], hot, side="right"))
                if at:
                    yield told(*(c[:at] for c in cols))
                cols = [c[at:] for c in cols]
            if not len(cols[3]):
                continue
            hot = rest = None
            # the last bucket may go on in the next batch
            cut = int(np.searchsorted(cols[3], cols[3][-1]))
            last, cols = [c[cut:] for c in cols], [c[:cut] for c in cols]
            if len(cols[3]):
                yield from decided(cols)
            if len(last[3]) > FEW:
                yield told(*last)
                hot = last[3][-1]
            else:
                rest = last
        if rest is not None:
            yield from decided(rest)
    return run


def _live(percent: int):
    """Members of a block of a bucket that sizes and sketches let link with one of another component."""

    def run(table: pa.Table) -> pa.Table:
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        comps, own, n = (table[c].to_numpy() for c in ("comp", "own", "n"))
        z = table["z"].to_numpy().view(U64)
        n = n.astype(np.int64)
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        live = np.zeros(len(own), dtype=bool)
        for at in range(0, len(left), 256):
            x = left[at:at + 256]
            ok = _may_link(n[x][:, None], n[right][None, :], z[x][:, None], z[right][None, :], percent)
            ok &= comps[x][:, None] != comps[right][None, :]
            live[x] |= ok.any(axis=1)
            live[right] |= ok.any(axis=0)
        return table.select(["b", "i", "j", "own", "f", "comp"]).filter(pa.array(live))
    return run


def _block_links(percent: int):
    """Confirmed links between members of different components within a block of a bucket."""

    def run(table: pa.Table) -> pa.Table:
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        ids, comps, own = (table[c].to_numpy() for c in ("f", "comp", "own"))
        column = table["set"].combine_chunks()
        flat, cuts = column.values.to_numpy(), column.offsets.to_numpy()
        sets = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        n, z = np.diff(cuts).astype(np.int64), odd_sketch(flat.view(U64), cuts.astype(np.int64))
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        ok = _may_link(n[left][:, None], n[right][None, :], z[left][:, None], z[right][None, :], percent)
        ok &= comps[left][:, None] != comps[right][None, :]
        if i == j:
            ok &= left[:, None] < right[None, :]
        x, y = np.nonzero(ok)
        got = _agree(percent, left[x], right[y], sets, comps) if len(x) else []
        return pa.table({"a": pa.array([int(ids[a]) for a, _ in got], pa.int64()),
                         "b": pa.array([int(ids[b]) for _, b in got], pa.int64())})
    return run


def _link(classes: DataFrame, sets_of, percent: int) -> DataFrame:
    """Components of similar classes ``(f, n, z, bands)``, which may be repeated: ``(id, component_id)`` of linked ones.

    Buckets of a few members give their pairs (a bounded number each). In
    larger ones every member meets the bucket's hub, then, where several
    components are left, blocks of bounded size are compared inside tasks.
    Sizes and odd sketches drop pairs that cannot be similar; ``sets_of``
    fetches the shingles of what is left (``f``) for the exact comparison.
    """
    spark, found, compared = classes.sparkSession, [], []
    rows = classes.select("f", "n", "z", F.explode("bands").alias("b")).repartition("b").sortWithinPartitions("b", "f")
    met = staged(rows.mapInArrow(_meet(percent), _MET), "passage-buckets", found)
    # pairs of buckets of a few members; the members of larger ones meet their hub first
    pairs = met.where("other is not null").select(F.col("f").alias("a"), F.col("other").alias("b"))
    large = met.where("other is null").drop("other")
    hubs = large.groupBy("b").agg(F.min(F.struct("f", "n", "z")).alias("hub"))
    may = lambda x, y: _may_link(F.col(f"{x}n"), F.col(f"{y}n"), F.col(f"{x}z"), F.col(f"{y}z"), percent)
    hubbed = large.join(hubs, "b").where((F.col("f") != F.col("hub.f")) & may("", "hub.")).select(
        F.least("f", "hub.f").alias("a"), F.greatest("f", "hub.f").alias("b"))
    pairs = staged(pairs.unionAll(hubbed).distinct(), "passage-pairs", found)
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("f")), found)
    both = (pairs.join(sets.select(F.col("f").alias("a"), F.col("set").alias("x")), "a")
            .join(sets.select(F.col("f").alias("b"), F.col("set").alias("y")), "b")
            .select("a", "b", F.size("x").alias("x"), F.size("y").alias("y"), F.size(F.array_intersect("x", "y")).alias("i")))
    links = both.where(100 * F.col("i") >= percent * (F.col("x") + F.col("y") - F.col("i"))).select("a", "b")
    comp = cut(components(links))
    known = staged(large.join(comp, F.col("f") == F.col("id"), "left").select(
        "b", "f", "n", "z", F.coalesce("component_id", "f").alias("comp")), "passage-known", compared)
    given_up(spark, found)
    mixed = (known.groupBy("b").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("c"))
             .where("lo != hi").select("b", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks")))
    rest = (known.join(mixed, "b")
            .withColumn("own", F.pmod(F.xxhash64("f"), F.col("blocks").cast("long")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")))
    live = staged(rest.select("b", "i", "j", "own", "f", "comp", "n", "z").groupBy("b", "i", "j").applyInArrow(
        _live(percent), "b long, i int, j int, own int, f long, comp long"), "passage-live", compared)
    more = live.join(sets_of(live.select("f"), compared), "f").select("b", "i", "j", "own", "f", "comp", "set").groupBy("b", "i", "j").applyInArrow(
        _block_links(percent), "a long, b long")
    linked = components(comp.select(F.col("id").alias("a"), F.col("component_id").alias("b")).unionAll(more.distinct()))
    given_up(spark, compared)
    return linked


def beside(raw: bytes, at: int, right: bool, most: int) -> list[tuple[bytes, int]]:
    """Up to ``most`` words of ``raw`` behind or before byte ``at``, nearest first, each with its far border."""
    if right:
        return [(m.group(), m.end()) for m in itertools.islice(_WORD.finditer(raw, at), most)]
    width = 16 * most
    while True:
        low = max(0, at - width)
        found = [(m.group(), m.start()) for m in _WORD.finditer(raw, low, at)]
        if low and found and found[0][1] == low:
            del found[0]  # perhaps not the whole word
        if len(found) >= most or not low:
            return found[::-1][:most]
        width *= 2


_BESIDE = "id long, hash long, spot long, right boolean, near binary, borders array<int>"


def _beside(most: int):
    """The words beside the asked places of a shard's texts."""

    def run(key, docs: pa.Table, asked: pa.Table) -> pa.Table:
        places: dict = {}
        for r in asked.to_pylist() if asked.num_columns else []:
            places.setdefault((r["id"], r["hash"]), []).append((r["spot"], r["right"]))
        rows = []
        if places:
            for i, h, t in zip(docs["doc_id"], docs["h"], docs["text"]):
                name = i.as_py(), h.as_py()
                if name in places:
                    raw = t.as_py().encode("utf-8", "surrogatepass").lower()
                    for at, right in places.pop(name):
                        got = beside(raw, at, right, most)
                        rows.append((*name, at, right, b" ".join(x for x, _ in got), [k for _, k in got]))
        cols = list(zip(*rows)) if rows else [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.list_(pa.int32()))
        return pa.table({c.split()[0]: pa.array(v, k) for c, v, k in zip(_BESIDE.split(", "), cols, kinds)})
    return run


_EDGES = "doc_id long, h long, kept long, kept_h long, right boolean, at long, spot long, kept_spot long, cluster long"


def _agreeing(most: int):
    """Edges with the words beside both places -> how many agree, where they end, and whether there may be more."""

    def run(batches):
        for batch in slices(batches):
            cols = {c: batch[c].to_pylist() for c in ("near", "borders", "kept_near", "kept_borders")}
            count, ends, kept_ends = [], [], []
            for x, bx, y, by in zip(*cols.values()):
                n = next((k for k, (u, v) in enumerate(zip(x.split(b" "), y.split(b" "))) if u != v), min(len(bx), len(by)))
                n = min(n, len(bx), len(by))
                count.append(n)
                ends.append(bx[n - 1] if n else None)
                kept_ends.append(by[n - 1] if n else None)
            names = [c.split()[0] for c in _EDGES.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(count, pa.int64()), pa.array(ends, pa.int64()), pa.array(kept_ends, pa.int64()),
                 pa.array([n == most for n in count], pa.bool_())], names=[*names, "n", "to", "kept_to", "more"])
    return run


def _extended(edges: DataFrame, by_shard, shard) -> DataFrame:
    """Pieces of text beside the edges that agree word by word with the kept texts, in rounds of a bounded number of words."""
    pieces, most, passing = None, CONTEXT, []
    while True:
        own = edges.select(F.col("doc_id").alias("id"), F.col("h").alias("hash"), "spot", "right")
        other = edges.select(F.col("kept").alias("id"), F.col("kept_h").alias("hash"), F.col("kept_spot").alias("spot"), "right")
        asked = own.unionAll(other).distinct().withColumn("shard", shard("id"))
        found = staged(by_shard.cogroup(asked.groupBy("shard")).applyInArrow(_beside(most), _BESIDE), "passage-beside", passing)
        mine = found.toDF("doc_id", "h", "spot", "right", "near", "borders")
        theirs = found.toDF("kept", "kept_h", "kept_spot", "right", "kept_near", "kept_borders")
        both = edges.join(mine, ["doc_id", "h", "spot", "right"]).join(theirs, ["kept", "kept_h", "kept_spot", "right"])
        done = staged(both.mapInArrow(_agreeing(most), _EDGES + ", n long, to long, kept_to long, more boolean").where("n > 0"),
                      "passage-extended")
        given_up(edges.sparkSession, passing)
        part = done.select("doc_id", "h", F.least("spot", "to").alias("begin"), F.greatest("spot", "to").alias("end"),
                           F.when(F.col("right"), F.col("at")).otherwise(F.col("at") - F.col("n")).alias("at"), F.col("n").alias("words"),
                           "kept", "cluster")
        pieces = part if pieces is None else pieces.unionAll(part)
        edges = done.where("more").withColumn("at", F.when(F.col("right"), F.col("at") + F.col("n")).otherwise(F.col("at") - F.col("n"))).select(
            "doc_id", "h", "kept", "kept_h", "right", "at", F.col("to").alias("spot"), F.col("kept_to").alias("kept_spot"), "cluster")
        if edges.isEmpty():
            return pieces
        most = min(max(FURTHER, 2 * most), MOST)


def _dealt(text: DataFrame, shards: int, passing: list[str]) -> DataFrame:
    """Texts written once in buckets by shard: every later grouping by shard reads them without another shuffle."""
    spark, name = text.sparkSession, f"passage_texts_{uuid.uuid4().hex}"
    passing.append(scratch_path(spark, name))
    (text.repartition(shards, "shard").write.bucketBy(shards, "shard").option("path", passing[-1])
     .option("compression", "zstd").format("parquet").saveAsTable(name))
    return spark.table(name)


def repeated_passages(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Runs to remove: ``(doc_id, h, begin, end, n_words, kept_doc_id, cluster)``.

    ``begin`` and ``end`` are byte positions in the UTF-8 text; ``h`` is the
    text's xxhash64, so rows that share a doc_id are told apart. A paragraph
    is repeated if a similar one (Jaccard similarity of five-word shingles of
    ``percent`` or more; fewer words make one shingle) stands in a document of
    smaller doc_id; runs of neighbouring repeated paragraphs, extended on both
    sides by the words that stand beside the kept paragraphs too, are returned
    if they have at least ``min_words`` words, ``kept_doc_id`` being the smallest
    document that keeps one of them. A copy of a whole text is one
    run. Repeats within one document are left.
    Rows with null doc_id or text are neither compared nor returned; an empty
    table gives an empty result; other columns are ignored.
    """
    text = docs.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("h"), "text")
    total = text.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(MIN_SHARDS, int(total) // SHARD_BYTES + 1)
    shard = lambda c: F.pmod(F.xxhash64(c), F.lit(shards).cast("long"))
    # equal texts: all but the first document are repeated whole
    narrow = text.select("doc_id", "h", F.octet_length("text").cast("long").alias("end")).distinct()
    lead = narrow.groupBy(F.col("h").alias("lh")).agg(F.min("doc_id").alias("lead"), F.max("doc_id").alias("top")).where("lead != top")
    copies = staged(narrow.join(lead, F.col("h") == F.col("lh")).where("doc_id != lead").select("doc_id", "h", "end", "lead"),
                    "passage-copies")
    skip = copies.select(shard("doc_id").alias("shard"), F.lit(None).cast("binary").alias("blob"),
                         F.col("doc_id").alias("skip_id"), F.col("h").alias("skip_h"))
    spark, dealt, passing = docs.sparkSession, [], []
    by_shard = _dealt(text.withColumn("shard", shard("doc_id")), shards, dealt).groupBy("shard")
    told = by_shard.cogroup(skip.groupBy("shard")).applyInArrow(_tell(shards, percent), TOLD)
    heard = told.groupBy("bucket").applyInArrow(_hear, "shard long, blob binary").select(
        "shard", "blob", F.lit(None).cast("long").alias("skip_id"), F.lit(None).cast("long").alias("skip_h"))
    units = staged(by_shard.cogroup(skip.unionAll(heard).groupBy("shard")).applyInArrow(
        _repeated(percent), _ROWS), "passage-units", passing)
    # a class has bands and a sketch once per shard that holds it
    classes = units.where("z is not null")

    def sets_of(need: DataFrame, passing: list[str]) -> DataFrame:
        places = classes.select("f", "doc_id", "h", "begin", "end").join(need.distinct(), "f")
        asked = places.groupBy("f").agg(F.min(F.struct("doc_id", "h", "begin", "end")).alias("rep")).select(
            "f", shard("rep.doc_id").alias("shard"), F.col("rep.doc_id").alias("rep_id"), F.col("rep.h").alias("rep_h"), "rep.begin", "rep.end")
        return staged(by_shard.cogroup(asked.groupBy("shard")).applyInArrow(_sets, "f long, set array<long>"), "passage-sets", passing)

    comp = _link(classes.select("f", "n", "z", "bands"), sets_of, percent)
    # of every class the first place and the last document; a class of one document that nothing is like stands alone
    by_class = units.where("unit >= 0").select("doc_id", "h", "unit", "last", "begin", "end", "at", "words", "pre", "post", "f")
    place = F.struct("doc_id", "h", "begin", "end", "pre", "post", "f")
    held = by_class.groupBy("f").agg(F.min(place).alias("first"), F.max("doc_id").alias("top")).join(
        comp, F.col("f") == F.col("id"), "left").where("id is not null or first.doc_id != top").select(
        "f", F.coalesce("component_id", "f").alias("cluster"), "first", "top")
    held = staged(held, "passage-held", passing)
    kept = held.groupBy("cluster").agg(F.min("first").alias("first"), F.max("top").alias("top")).where("first.doc_id != top")
    live = held.select("f", "cluster").join(kept.select("cluster", "first"), "cluster")
    again = (by_class.join(live, "f").where("doc_id != first.doc_id")
             .withColumn("kept", F.col("first.doc_id")).withColumn("kept_h", F.col("first.h")))
    # neighbours repeated from one text; where the word beside them is the same in both, there is more
    w = Window.partitionBy("doc_id", "h", "kept", "kept_h").orderBy("unit", "last")
    before = F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = again.withColumn("fresh", F.coalesce(F.col("unit") > before + 1, F.lit(True)).cast("int"))
    # from the outermost paragraphs, and from the outermost equal ones: similar ones may begin or end a word apart
    edge, same = F.struct("begin", "end", "at", "words", "pre", "post", "first"), F.col("f") == F.col("first.f")
    ends = {"left": F.min_by(edge, F.struct("unit", "last")), "right": F.max_by(edge, F.struct("last", "unit")),
            "left_same": F.min_by(edge, F.when(same, F.struct("unit", "last"))),
            "right_same": F.max_by(edge, F.when(same, F.struct("last", "unit")))}
    parts = staged(fresh.withColumn("run", F.sum("fresh").over(w)).groupBy("doc_id", "h", "kept", "kept_h", "run").agg(
        F.min("begin").cast("long").alias("begin"), F.max("end").cast("long").alias("end"), F.min("at").cast("long").alias("at"),
        F.max(F.col("at") + F.col("words")).cast("long").alias("to"), *(v.alias(k) for k, v in ends.items()),
        F.min("cluster").alias("cluster")), "passage-parts")
    counts = units.where("unit = -1").select("h", F.col("words").cast("long").alias("n_words")).where(F.col("n_words") >= min_words)
    whole = staged(copies.join(counts, "h").select(
        "doc_id", "h", F.lit(0).cast("long").alias("begin"), "end", "n_words", F.col("lead").alias("kept_doc_id"), F.col("h").alias("cluster")),
        "passage-whole")
    given_up(spark, passing)
    edges = None
    for name in ends:
        right = name.startswith("right")
        word, spot = ("post", "end") if right else ("pre", "begin")
        at = F.col(f"{name}.at") + F.col(f"{name}.words") if right else F.col(f"{name}.at")
        some = parts.where(f"{name}.{word} != 0 and {name}.{word} = {name}.first.{word}").select(
            "doc_id", "h", "kept", "kept_h", F.lit(right).alias("right"), at.cast("long").alias("at"),
            F.col(f"{name}.{spot}").cast("long").alias("spot"), F.col(f"{name}.first.{spot}").cast("long").alias("kept_spot"), "cluster")
        edges = some if edges is None else edges.unionAll(some)
    edges = staged(edges.distinct(), "passage-edges")
    pieces = parts.select("doc_id", "h", "begin", "end", "at", (F.col("to") - F.col("at")).alias("words"), "kept", "cluster")
    pieces = pieces.unionAll(_extended(edges, by_shard, shard))
    given_up(spark, dealt)
    w = Window.partitionBy("doc_id", "h").orderBy("at", "words")
    before = F.max(F.col("at") + F.col("words")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = pieces.withColumn("fresh", F.coalesce(F.col("at") > before, F.lit(True)).cast("int"))
    runs = fresh.withColumn("run", F.sum("fresh").over(w)).groupBy("doc_id", "h", "run").agg(
        F.min("begin").alias("begin"), F.max("end").alias("end"), (F.max(F.col("at") + F.col("words")) - F.min("at")).alias("n_words"),
        F.min("kept").alias("kept_doc_id"), F.min("cluster").alias("cluster"))
    return runs.where(F.col("n_words") >= min_words).drop("run").unionAll(whole)


def _remove(batches):
    """Rows ``(..., text, runs)`` -> ``(..., text)`` without the runs."""
    for batch in slices(batches):
        texts = []
        for t, spans in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
            raw, out, at = t.encode("utf-8", "surrogatepass"), [], 0
            for s in sorted(spans, key=lambda s: s["begin"]):
                out.append(raw[at:s["begin"]].rstrip())
                at = s["end"]
            # the white space on both sides of a removed run becomes that behind it
            texts.append(b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass").strip())
        yield pa.RecordBatch.from_arrays(batch.columns[:-2] + [pa.array(texts, pa.string())], names=batch.schema.names[:-1])


def without_repeats(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` (``n_chars`` follows); documents left empty by it go.

    All columns are kept in order; untouched rows stay as they are.
    """
    runs = staged(repeated_passages(docs, percent, min_words), "passage-runs")
    per_doc = runs.groupBy(F.col("doc_id").alias("__id"), F.col("h").alias("__h")).agg(
        F.collect_list(F.struct("begin", "end")).alias("__runs"))
    plain = numbered(docs)
    at = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    doc_id, text = F.col(at["doc_id"]), at["text"]
    joined = plain.join(per_doc, (doc_id == F.col("__id")) & (F.xxhash64(text) == F.col("__h")), "left")
    same = joined.where("__runs is null").select(*plain.columns)
    touched = joined.where("__runs is not null").select(*[c for c in plain.columns if c != text], text, "__runs")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in touched.schema.fields[:-1])
    cleaned = touched.mapInArrow(_remove, kinds).where(F.length(text) > 0)
    if "n_chars" in at:
        cleaned = cleaned.withColumn(at["n_chars"], F.length(text).cast(plain.schema[at["n_chars"]].dataType))
    return same.unionAll(cleaned.select(*plain.columns)).toDF(*docs.columns)
