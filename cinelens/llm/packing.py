"""Packing of tokenised documents into sequences, planned on the length histogram.

Shallow combinations of lengths that fill a window are enumerated, their
repeat counts are fitted to the histogram by non-negative least squares and
rounded down, and what is left is packed greedily, cutting pieces where a gap
would stay. The plan lives on counts per length (bounded by the window);
pieces find their places by their rank within their length.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import empty, slices, staged

WINDOW = 2048
END = 1
VOCABULARY = "byte_bpe_50k.tiktoken"
#: A sequence that lacks this many tokens at most is padded rather than completed by cutting a piece.
GAP = 8
#: Ranks are counted in groups of about this many pieces.
GROUP_ROWS = 20_000
NNLS_ROUNDS = 400


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str):
    """Byte-level BPE over the public vocabulary at ``path`` (kept per Python process)."""
    import public_tokenizers
    import tiktoken

    kept = tiktoken.__dict__.setdefault("_kept_by_path", {})
    if path not in kept:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        kept[path] = tiktoken.Encoding("corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return kept[path]


def token_ids(enc, text: str | None) -> np.ndarray:
    """Ids of a text (special strings are ordinary text) and the end id."""
    ids = enc.encode_to_numpy(text or "", disallowed_special=()) if text else np.zeros(0, dtype=np.uint32)
    return np.append(ids, np.uint32(END)).astype("<u4")


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.tobytes())


_PIECES = "doc_id long, doc_crc long, doc_tokens long, start long, length long, ids_crc32 long"


def _tokenise(path: str, window: int):
    def run(batches):
        enc = encoder(path)
        for batch in slices(batches):
            rows = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = token_ids(enc, text)
                whole = crc(ids)
                rows += [(i, whole, len(ids), at, min(window, len(ids) - at), crc(ids[at:at + window]))
                         for at in range(0, len(ids), window)]
            cols = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             names=[c.split()[0] for c in _PIECES.split(", ")])
    return run


# --- the plan -----------------------------------------------------------------------


def combinations(have: np.ndarray, window: int) -> list[tuple[int, ...]]:
    """Shallow combinations (two to four lengths that occur) that fill the window exactly."""
    out = set()
    lengths = np.flatnonzero(have)
    for c in lengths.tolist():
        rest = window - c
        if rest < 1:
            continue
        if rest <= c and have[rest]:
            out.add((c, rest))
        for share in (2, 3, 5):
            a = rest // share
            for a in (a, a + 1):
                if 0 < a < rest and have[a] and have[rest - a]:
                    out.add(tuple(sorted((c, a, rest - a), reverse=True)))
        third = rest // 3
        for a, b in ((third, third), (third, third + 1), (rest // 4, rest // 4)):
            left = rest - a - b
            if a > 0 and b > 0 and left > 0 and have[a] and have[b] and have[left]:
                out.add(tuple(sorted((c, a, b, left), reverse=True)))
    return sorted(out, reverse=True)


def repeats(combos: list[tuple[int, ...]], have: np.ndarray) -> np.ndarray:
    """Non-negative least squares: repeat counts whose lengths add up to the histogram (accelerated projected gradient)."""
    if not combos:
        return np.zeros(0)
    col = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
    row = np.array([x for c in combos for x in c])
    n, target = len(have), have.astype(float)

    def up(x):
        return np.bincount(row, weights=x[col], minlength=n)

    def down(r):
        return np.bincount(col, weights=r[row], minlength=len(combos))

    v = np.ones(len(combos))
    for _ in range(20):
        v = down(up(v))
        scale = np.linalg.norm(v)
        v /= scale
    step, x, y, t = 1 / (1.05 * scale), np.zeros(len(combos)), np.zeros(len(combos)), 1.0
    for _ in range(NNLS_ROUNDS):
        new = np.maximum(0, y - step * down(up(y) - target))
        s = (1 + (1 + 4 * t * t) ** 0.5) / 2
        x, y, t = new, new + (t - 1) / s * (new - x), s
    return x


class Plan:
    """Uses of every length's pieces, by rank: ``(length, rank from, rank to, base, copies, first slot offset ...)``.

    ``use`` rows are ``(length, first rank, count, sequence of the first,
    offset, taken)``: a piece of ``length`` with rank in [first, first+count)
    puts its first ``taken`` tokens into sequence ``sequence + rank - first``
    at ``offset``; the rest becomes a piece of length - taken with rank
    ``next + rank - first``.
    """

    def __init__(self, have: np.ndarray, window: int):
        self.window = window
        self.left = have.astype(np.int64).copy()
        self.done = np.zeros(window + 1, dtype=np.int64)
        self.made = have.astype(np.int64).copy()
        self.uses: list[tuple[int, int, int, int, int, int, int]] = []
        self.sequences = 0
        self._pattern([(window, window)], int(self.left[window]))
        combos = combinations(self.left, window)
        x = repeats(combos, self.left)
        for k in np.argsort(-x, kind="stable").tolist():
            count = int(x[k])
            if not count:
                break
            need = np.bincount(combos[k], minlength=window + 1)
            at = np.flatnonzero(need)
            self._pattern([(c, c) for c in combos[k]], min(count, int((self.left[at] // need[at]).min())))
        self._greedy()

    def _pattern(self, slots: list[tuple[int, int]], count: int) -> None:
        """``count`` sequences, each of slots ``(length, taken)``."""
        if count < 1:
            return
        offset = 0
        for length, taken in slots:
            rest = length - taken
            self.uses.append((length, int(self.done[length]), count, self.sequences, offset, taken,
                              int(self.made[rest]) if rest else 0))
            self.done[length] += count
            self.left[length] -= count
            if rest:
                self.left[rest] += count
                self.made[rest] += count
            offset += taken
        self.sequences += count

    def _fill(self, size: int) -> tuple[list[tuple[int, int]], int]:
        """Greedy slots for a sequence of ``size`` tokens, largest lengths first, and how often they can be had."""
        slots, used, gap, count = [], np.zeros(self.window + 1, dtype=np.int64), size, 1 << 62
        while gap:
            free = self.left // np.maximum(1, used + 1) if slots else self.left
            fits = np.flatnonzero(free[1:gap + 1])
            if len(fits):
                length = int(fits[-1]) + 1
                count = min(count, int(free[length]))
                used[length] += 1
                slots.append((length, length))
                gap -= length
                continue
            longer = np.flatnonzero(free[gap + 1:])
            if not len(longer) or (gap <= GAP and size == self.window):
                break
            length = int(longer[0]) + gap + 1
            count = min(count, int(free[length]))
            slots.append((length, gap))
            gap = 0
        return slots, count

    def _greedy(self) -> None:
        lengths = np.arange(self.window + 1)
        while (total := int((self.left * lengths).sum())) >= self.window:
            self._pattern(*self._fill(self.window))
        for bit in reversed(range(total.bit_length())):
            if total >> bit & 1:
                slots, _ = self._fill(1 << bit)
                self._pattern(slots, 1)

    def places(self, length: np.ndarray, rank: np.ndarray):
        """``(piece, start in the piece, taken, sequence, offset)`` of pieces given by length and rank."""
        uses = np.array(sorted(self.uses), dtype=np.int64).reshape(-1, 7)
        big = np.int64(1) << 50
        key = uses[:, 0] * big + uses[:, 1]
        piece, start = np.arange(len(length)), np.zeros(len(length), dtype=np.int64)
        while len(piece):
            k = np.searchsorted(key, length * big + rank, side="right") - 1
            _, first, _, sequence, offset, taken, follow = uses[k].T
            yield piece, start, taken, sequence + rank - first, offset
            more = length > taken
            piece, start = piece[more], (start + taken)[more]
            length, rank = (length - taken)[more], (follow + rank - first)[more]


def _place(plan: Plan):
    def run(batches):
        for batch in batches:
            rank, length = batch["rank"].to_numpy(), batch["length"].to_numpy()
            for piece, start, taken, sequence, offset in plan.places(length, rank):
                rows = batch.take(pa.array(piece))
                whole = taken == length[piece]
                yield pa.RecordBatch.from_arrays(
                    [rows["doc_id"], rows["doc_crc"], rows["doc_tokens"], pa.array(rows["start"].to_numpy() + start),
                     pa.array(taken), pa.array(rows["ids_crc32"].to_numpy(), mask=~whole), pa.array(sequence),
                     pa.array(offset)], names=[c.split()[0] for c in _PLACED.split(", ")])
    return run


_PLACED = _PIECES + ", sequence_id long, offset long"


def _cut_crcs(path: str):
    """CRCs of the asked ranges of each document."""
    def run(batches):
        enc = encoder(path)
        for batch in slices(batches):
            rows = []
            for i, text, asked in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "asked"))):
                ids = token_ids(enc, text)
                whole = crc(ids)
                rows += [(i, whole, len(ids), a, n, crc(ids[a:a + n])) for a, n in {(x["start"], x["length"]) for x in asked}
                         if a + n <= len(ids)]
            cols = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             names=[c.split()[0] for c in _PIECES.split(", ")])
    return run


def ranked(pieces: DataFrame, most: int) -> DataFrame:
    """Add ``rank``: 0, 1, ... within each length, counted in salted groups so that no length meets in one task."""
    salts = max(1, -(-most // GROUP_ROWS))
    rows = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "doc_crc", "start"), F.lit(salts).cast("long")))
    sizes = rows.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("c"))
    before = sizes.withColumn("base", F.sum("c").over(
        Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "doc_crc", "start")) - 1
    return (rows.withColumn("own", own).join(before.select("length", "salt", "base"), ["length", "salt"])
            .withColumn("rank", F.coalesce("base", F.lit(0)) + F.col("own")).drop("salt", "own", "base"))


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW) -> DataFrame:
    """Pieces of all documents in sequences of at most ``window`` tokens.

    ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``,
    one row per piece. A document's ids are those of the byte-level BPE
    vocabulary at ``path`` and the end id; the string of a special token
    (``<|endoftext|>``) inside a text is ordinary text, as the vocabulary's own
    description asks; a null or empty text is the end id alone. Long documents give pieces of a whole window and a rest; rests are
    combined by the plan and cut where a gap would stay. Every id lies in
    exactly one piece; sequences are gapless from offset 0 and full, but for
    a few tokens, or end at a power of two. Repeated rows are packed as often
    as they occur; a null doc_id is carried through. An empty table gives an
    empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    path = path or vocabulary_path()
    pieces = staged(docs.select("doc_id", F.col("text")).mapInArrow(_tokenise(path, window), _PIECES), "pack-pieces")
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("c")).collect()
    have = np.zeros(window + 1, dtype=np.int64)
    for r in counts:
        have[r["length"]] = r["c"]
    if not have.sum():
        return empty(spark, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    plan = Plan(have, window)
    placed = staged(ranked(pieces, int(have.max())).select("doc_id", "doc_crc", "doc_tokens", "start", "length", "ids_crc32", "rank")
                    .mapInArrow(_place(plan), _PLACED), "pack-placed")
    asked = placed.where("ids_crc32 is null")
    wanted = asked.groupBy("doc_id").agg(F.collect_set(F.struct("start", "length")).alias("asked"))
    crcs = (docs.select("doc_id", "text").join(wanted.withColumnRenamed("doc_id", "__id"), F.col("doc_id").eqNullSafe(F.col("__id")))
            .select("doc_id", "text", "asked").mapInArrow(_cut_crcs(path), _PIECES).distinct())
    keys = ["doc_id", "doc_crc", "doc_tokens", "start", "length"]
    found = crcs.select(*[F.col(c).alias(f"__{c}") for c in keys], F.col("ids_crc32").alias("__crc"))
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    cut = asked.drop("ids_crc32").join(found, same).withColumn("ids_crc32", F.col("__crc")).select(*cols)
    return placed.where("ids_crc32 is not null").select(*cols).unionAll(cut)
