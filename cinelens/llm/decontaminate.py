"""Benchmark decontamination by q-gram counts in diagonal bands and banded alignment.

A region of a text within k edits of an item of m bytes holds at least
m + 1 - q - k*q of its q-grams, all on diagonals (text position minus item
position) that differ by at most k. Shared q-grams are therefore counted in
bands of 2k diagonals that overlap by k; only bands that reach the bound are
aligned, in a band around them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, inverse, mix, powers, prefix_hash, slices, staged

#: Length of a q-gram in bytes, and the share of an item's bytes that may be edited.
GRAM = 12
EDIT_SHARE = 0.05
#: Items of fewer bytes (after normalising) are too short to say anything about a text.
MIN_BYTES = 40
#: Item bytes indexed in one pass over the documents; a larger benchmark takes several passes.
PASS_BYTES = 4 << 20


def normal(text: str | None) -> bytes:
    """Lower case, white space as single spaces, UTF-8."""
    return " ".join((text or "").lower().split()).encode("utf-8", "surrogatepass")


def budget(m: int, q: int = GRAM, share: float = EDIT_SHARE) -> int:
    """Edits allowed in an item of m bytes: the share, as far as the q-gram bound stays above zero."""
    return max(0, min(int(m * share), (m - q) // q))


def grams(data: np.ndarray, q: int = GRAM) -> np.ndarray:
    if len(data) < q:
        return np.zeros(0, dtype=U64)
    p = prefix_hash(data)
    n = len(data) - q + 1
    return mix((p[q:] - p[:-q]) * powers(n, inverse(0x9E3779B97F4A7C15))[:n])


class Index:
    """Q-grams of items, with a bit filter before the sorted list."""

    def __init__(self, items: list[tuple[int, bytes]], q: int = GRAM, share: float = EDIT_SHARE):
        self.items, self.q = items, q
        self.k = np.array([budget(len(t), q, share) for _, t in items], dtype=np.int64)
        self.need = np.array([len(t) + 1 - q - k * q for (_, t), k in zip(items, self.k)], dtype=np.int64)
        found = [grams(np.frombuffer(t, dtype=np.uint8), q) for _, t in items]
        code = np.concatenate(found) if found else np.zeros(0, dtype=U64)
        item = np.repeat(np.arange(len(found)), [len(f) for f in found])
        spot = np.concatenate([np.arange(len(f)) for f in found]) if found else np.zeros(0, dtype=np.int64)
        by = np.argsort(code, kind="stable")
        self.code, self.item, self.spot = code[by], item[by], spot[by]
        self.bits = max(16, int(16 * len(code)).bit_length())
        self.filter = np.zeros(1 << self.bits, dtype=bool)
        self.filter[(self.code >> U64(64 - self.bits)).astype(np.int64)] = True

    def shared(self, data: np.ndarray):
        """``(text position, item, item position)`` of every shared q-gram."""
        h = grams(data, self.q)
        at = np.flatnonzero(self.filter[(h >> U64(64 - self.bits)).astype(np.int64)])
        lo, hi = np.searchsorted(self.code, h[at], "left"), np.searchsorted(self.code, h[at], "right")
        n = hi - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        pick = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(int(n.sum())) if len(n) else lo
        return np.repeat(at, n), self.item[pick], self.spot[pick]

    def bands(self, data: np.ndarray):
        """``(item, first diagonal, last diagonal)`` of bands that reach the bound."""
        at, item, spot = self.shared(data)
        if not len(at):
            return []
        width = np.maximum(1, self.k[item])
        low = np.floor_divide(at - spot, width)
        span = np.int64(1) << 40
        # a q-gram of the item counts once in a band, however often the text has it there
        key = np.concatenate((item * span + low + (span >> 1), item * span + low - 1 + (span >> 1)))
        once = np.unique(np.stack((key, np.concatenate((spot, spot)))), axis=1)[0] if len(key) < 64 else _distinct(
            key, np.concatenate((spot, spot)))
        band, count = np.unique(once, return_counts=True)
        item = band // span
        keep = count >= self.need[item]
        item, low = item[keep], band[keep] % span - (span >> 1)
        width = np.maximum(1, self.k[item])
        return list(zip(item.tolist(), (low * width).tolist(), (low * width + 2 * width).tolist()))

    def matches(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """``(item_id, start, end, edits)`` in the normalised text: per item the best region of each place."""
        raw = normal(text)
        data = np.frombuffer(raw, dtype=np.uint8)
        out = []
        for i, d0, d1 in self.bands(data):
            item_id, item = self.items[i]
            k = int(self.k[i])
            lo, hi = max(0, d0 - k), min(len(raw), d1 + len(item) + k)
            exact = raw.find(item, lo, hi)
            if exact >= 0:
                out.append((item_id, exact, exact + len(item), 0))
                continue
            got = align(item, raw[lo:hi], k)
            if got:
                out.append((item_id, lo + got[0], lo + got[1], got[2]))
        best: dict = {}
        for item_id, s, e, c in sorted(out, key=lambda x: (x[0], x[3], x[1])):
            if all(e <= a or s >= b for a, b, _ in best.get(item_id, [])):
                best.setdefault(item_id, []).append((s, e, c))
        return [(i, s, e, c) for i in sorted(best) for s, e, c in sorted(best[i])]


def _distinct(key: np.ndarray, spot: np.ndarray) -> np.ndarray:
    """Keys of the distinct (key, spot) pairs."""
    by = np.lexsort((spot, key))
    k, s = key[by], spot[by]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
    return k[new]


def align(item: bytes, region: bytes, k: int) -> tuple[int, int, int] | None:
    """Best occurrence of ``item`` in ``region`` (free ends there): ``(start, end, edits)`` with at most k edits.

    Row by row over the item; a row spans the region, which is only as wide
    as the item and the band. Insertions within a row are a running minimum.
    """
    t = np.frombuffer(region, dtype=np.uint8)
    n = len(t)
    steps = np.arange(n + 1, dtype=np.int64)
    cost, start = np.zeros(n + 1, dtype=np.int64), steps.copy()
    big = np.int64(n + 1)
    for row, c in enumerate(item, 1):
        diag = np.concatenate(([big + row], cost[:-1] + (t != c)))
        up = cost + 1
        new = np.minimum(diag, up)
        begin = np.where(diag <= up, np.concatenate(([0], start[:-1])), start)
        # from the left: min over j' <= j of new[j'] + (j - j'); the start goes with the minimum
        code = (new - steps) * (2 * big) + begin
        code = np.minimum.accumulate(code)
        cost, start = code // (2 * big) + steps, code % (2 * big)
        if cost.min() > k:
            return None
    end = int(cost.argmin())
    return (int(start[end]), end, int(cost[end])) if cost[end] <= k else None


_MATCHES = "doc_id long, item_id long, start long, end long, edits long"


def _scan(index: Index):
    def run(batches):
        for batch in slices(batches):
            rows = [(i, *m) for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for m in index.matches(text)]
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             names=[x.split()[0] for x in _MATCHES.split(", ")])
    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE) -> DataFrame:
    """``(doc_id, item_id, start, end, edits)``: every occurrence of a benchmark item in a document.

    Both are normalised (lower case, white space as one space); positions are
    bytes of the normalised text; an item occurs where a region of the text is
    within ``share`` of the item's bytes of it. Items shorter than
    ``MIN_BYTES`` are left out, null texts are empty. The items are indexed in
    passes of ``PASS_BYTES`` each, so what is sent to the tasks is bounded
    whatever the benchmark's size; every pass reads all documents whole.
    Repeated rows are reported as often as they occur; a null doc_id is
    carried through; empty tables give an empty result; other columns are
    ignored.
    """
    items = benchmark.select("item_id", F.col("text").alias("text")).where("item_id is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-int(total) // PASS_BYTES))
    out = None
    for p in range(passes):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes).cast("long")) == p).distinct().collect()
        kept = sorted((r["item_id"], normal(r["text"])) for r in rows)
        index = Index([(i, t) for i, t in kept if len(t) >= MIN_BYTES], GRAM, share)
        found = docs.select("doc_id", "text").mapInArrow(_scan(index), _MATCHES)
        found = staged(found, "leaks") if passes > 1 else found
        out = found if out is None else out.unionAll(found)
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE) -> DataFrame:
    """Rows of ``docs`` in which no benchmark item occurs, all columns; every row is judged by its own text, whatever its doc_id."""
    told = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    leaks = find_leaks(told, benchmark, share).select(F.col("doc_id").alias("__leak")).distinct()
    return docs.join(leaks, F.xxhash64("text") == F.col("__leak"), "left_anti").select(*docs.columns)
