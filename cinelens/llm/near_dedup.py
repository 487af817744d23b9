"""Near-duplicate documents by MinHash bands, odd sketches and exact set comparison.

Every document's distinct word shingles are sampled by MinHash. Bands of the
samples propose candidates; an odd sketch (the samples folded into a parity
bitmap) drops those whose XOR has too many set bits for a high similarity;
what remains is confirmed on the full shingle sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SHINGLE, U64, components, cut, mix, shingle_hashes, signed, slices, staged

#: 32 bands of 4 samples miss a pair at a similarity of 0.75 with a chance of 5e-6, less above it.
BANDS, ROWS = 32, 4
SKETCH_WORDS = 8
SKETCH_BITS = 64 * SKETCH_WORDS
#: Members of a bucket that are compared with each other in one task.
BLOCK = 1000
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Standard errors by which a sketch may miss the threshold before a pair is dropped.
MARGIN = 5.0


def max_odd_bits(percent: int = PERCENT, samples: int = BANDS * ROWS, bits: int = SKETCH_BITS) -> int:
    """Largest XOR population count that a pair at the threshold reaches within the margin.

    A sample that differs puts two balls into the bitmap; of ``t`` balls in
    ``bits`` bins (1 - (1 - 2/bits)**t) / 2 are expected at odd counts.
    """
    p = 1 - percent / 100
    differ = min(samples, samples * p + MARGIN * (samples * p * (1 - p)) ** 0.5)
    odd = bits * (1 - (1 - 2 / bits) ** (2 * differ)) / 2
    return int(odd + MARGIN * (bits * 0.25 * (1 - (1 - 4 / bits) ** (2 * differ))) ** 0.5 / 2)


_SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=U64)) | U64(1)


def min_samples(h: np.ndarray) -> np.ndarray:
    """One minimum per seeded hash function over the set ``h``."""
    low = np.full(len(_SEEDS), np.iinfo(np.uint64).max, dtype=U64)
    for at in range(0, len(h), 2048):
        np.minimum(low, (h[at:at + 2048, None] * _SEEDS).min(axis=0), out=low)
    return low


def signature(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and odd sketch (64-bit words) of a set of shingle hashes."""
    low = min_samples(h)
    n = np.arange(len(low), dtype=U64)
    spots = mix(low + n * U64(0x632BE59BD9B4E019)) % U64(SKETCH_BITS)
    parity = (np.bincount(spots.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    sketch = np.packbits(parity).view(np.int64)
    keys = np.arange(1, BANDS + 1, dtype=U64)
    for r in range(ROWS):
        keys = mix(keys ^ low.reshape(BANDS, ROWS)[:, r])
    return signed(keys), sketch


_SIG = ("doc_id long, h long, n long, f1 long, f2 long, bands array<long>, "
        + ", ".join(f"s{i} long" for i in range(SKETCH_WORDS)))


def _signatures(batches):
    for batch in slices(batches):
        n, f1, f2, bands = [], [], [], []
        words = [[] for _ in range(SKETCH_WORDS)]
        for text in batch.column(2).to_pylist():
            h, _ = shingle_hashes(text)
            n.append(len(h))
            if len(h):
                keys, sketch = signature(h)
                f1.append(int(signed(h.sum(keepdims=True))[0]))
                f2.append(int(signed(mix(h ^ U64(0x5851F42D4C957F2D)).sum(keepdims=True))[0]))
            else:
                keys, sketch = [], [0] * SKETCH_WORDS
                f1.append(0)
                f2.append(0)
            bands.append(keys)
            for w, s in zip(words, sketch):
                w.append(int(s))
        arrays = [batch.column(0), batch.column(1)] + [pa.array(x, pa.int64()) for x in (n, f1, f2)] + [pa.array(bands, pa.list_(pa.int64()))]
        arrays += [pa.array(w, pa.int64()) for w in words]
        yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in _SIG.split(", ")])


def _sets(batches):
    for batch in slices(batches):
        sets = [signed(shingle_hashes(t)[0]) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "set"])


def _likely(x: DataFrame, y: DataFrame, percent: int):
    """Odd sketches near enough and set sizes that can reach the threshold."""
    odd = sum((F.bit_count(x[f"s{i}"].bitwiseXOR(y[f"s{i}"])) for i in range(1, SKETCH_WORDS)),
              F.bit_count(x["s0"].bitwiseXOR(y["s0"])))
    return ((odd <= max_odd_bits(percent)) & (100 * x["n"] >= percent * y["n"]) & (100 * y["n"] >= percent * x["n"]))


def _agree(percent: int, x: np.ndarray, y: np.ndarray, sets: list[np.ndarray], comps: np.ndarray) -> list[tuple[int, int]]:
    """Confirmed pairs (numbers of sets) that join components; full sets are compared."""
    size = np.array([len(s) for s in sets])
    words, flat = np.unique(np.concatenate(sets), return_inverse=True)
    start = np.concatenate(([0], np.cumsum(size)))
    root = {c: c for c in comps.tolist()}

    def find(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out, mine = [], np.zeros(len(words), dtype=bool)
    by = np.argsort(x, kind="stable")
    x, y = x[by], y[by]
    edges = np.concatenate(([0], np.flatnonzero(np.diff(x)) + 1, [len(x)]))
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        i = int(x[lo])
        own = find(int(comps[i]))
        others = np.array([j for j in y[lo:hi].tolist() if find(int(comps[j])) != own], dtype=np.int64)
        if not len(others):
            continue
        mine[flat[start[i]:start[i + 1]]] = True
        pick = np.concatenate([flat[start[j]:start[j + 1]] for j in others.tolist()])
        both = np.add.reduceat(mine[pick].astype(np.int64), np.concatenate(([0], np.cumsum(size[others])[:-1])))
        mine[flat[start[i]:start[i + 1]]] = False
        for j in others[100 * both >= percent * (size[i] + size[others] - both)].tolist():
            a, b = find(int(comps[i])), find(int(comps[j]))
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((i, j))
    return out


def _pick(percent: int):
    """Pairs of a block whose sketches allow the similarity, as numbers into the ids they name."""
    most = max_odd_bits(percent)

    def run(table: pa.Table) -> pa.Table:
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        bucket = table["b"][0].as_py()
        ids, comps, n, own = (table[c].to_numpy() for c in ("id", "comp", "n", "own"))
        sketch = np.stack([table[f"s{k}"].to_numpy() for k in range(SKETCH_WORDS)], axis=1).view(U64)
        bands = np.array(table["bands"].to_pylist(), dtype=np.int64)
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        xs, ys = [], []
        for at in range(0, len(left), 256):
            x = left[at:at + 256]
            odd = np.zeros((len(x), len(right)), dtype=np.int64)
            for w in range(SKETCH_WORDS):
                odd += np.bitwise_count(sketch[x, w][:, None] ^ sketch[right, w][None, :])
            nx, ny = n[x][:, None], n[right][None, :]
            ok = ((odd <= most) & (comps[x][:, None] != comps[right][None, :])
                  & (100 * nx >= percent * ny) & (100 * ny >= percent * nx))
            if i == j:
                ok &= x[:, None] < right[None, :]
            a, b = np.nonzero(ok)
            a, b = x[a], right[b]
            for part in np.array_split(np.arange(len(a)), max(1, len(a) // 50000)):
                pa_, pb = a[part], b[part]
                same = bands[pa_] == bands[pb]
                first = bands[pa_, same.argmax(axis=1)] == bucket
                xs.append(pa_[first])
                ys.append(pb[first])
        x, y = (np.concatenate(v) if v else np.zeros(0, dtype=np.int64) for v in (xs, ys))
        used, inv = np.unique(np.concatenate((x, y)), return_inverse=True)
        x, y = inv[:len(x)].astype(np.int32), inv[len(x):].astype(np.int32)
        rows = 1 if len(x) else 0
        return pa.table({"b": pa.array([bucket] * rows, pa.int64()), "i": pa.array([i] * rows, pa.int32()),
                         "j": pa.array([j] * rows, pa.int32()), "ids": pa.array([ids[used]] * rows, pa.list_(pa.int64())),
                         "comps": pa.array([comps[used]] * rows, pa.list_(pa.int64())),
                         "x": pa.array([x.tobytes()] * rows, pa.binary()), "y": pa.array([y.tobytes()] * rows, pa.binary())})
    return run


def _confirm(percent: int):
    def run(pairs: pa.Table, held: pa.Table) -> pa.Table:
        links: list = []
        if pairs.num_rows and held.num_rows:
            row = pairs.to_pylist()[0]
            have = dict(zip(held["id"].to_pylist(), range(held.num_rows)))
            column = held["set"].combine_chunks()
            flat, cuts = column.values.to_numpy(), column.offsets.to_numpy()
            sets = [flat[cuts[have[i]]:cuts[have[i] + 1]] for i in row["ids"]]
            got = _agree(percent, np.frombuffer(row["x"], dtype=np.int32), np.frombuffer(row["y"], dtype=np.int32),
                         sets, np.array(row["comps"], dtype=np.int64))
            links = [(row["ids"][x], row["ids"][y]) for x, y in got]
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})
    return run


def near_links(docs: DataFrame, reps: DataFrame, percent: int = PERCENT, repeated: bool = False) -> DataFrame:
    """Confirmed links ``(a, b)`` between classes that join every pair of similar classes into one component.

    Round one links every member of a bucket with the bucket's hub (the
    member that shares most buckets), so a bucket of any size proposes one
    pair per member. Round two compares, in buckets that still hold several
    components, the members of different components with each other, block
    by block inside the tasks (a pair only in the first bucket it shares);
    what leaves a block are confirmed links that join components, at most one
    per member. So every colliding pair is compared unless a path of
    confirmed links joins it, and no group is spelled out as pairs.
    A class is compared by the text that ``doc_id`` and ``h`` (its xxhash64) of
    ``reps`` name; ``repeated`` tells that a row may stand in ``docs`` twice.
    """
    text = docs.select(F.col("doc_id").alias("__doc"), F.xxhash64("text").alias("__h"), F.col("text").alias("__text"))
    names = reps.select(F.col("id").alias("__id"), "doc_id", "h")
    reps = reps.drop("doc_id", "h")
    light = reps.drop("bands")
    rows = reps.select("id", F.explode("bands").alias("b"))
    shared = rows.groupBy("b").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    multi = staged(rows.join(shared, "b"), "near-buckets")
    score = multi.groupBy("id").agg(F.sum("c").alias("score"))
    ranked = multi.join(score, "id")
    hubs = ranked.groupBy("b").agg(F.max(F.struct("score", (-F.col("id")).alias("m"))).alias("hub"))
    pairs = (multi.join(hubs.select("b", (-F.col("hub.m")).alias("hub")), "b").where("id != hub")
             .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct())

    def near(pairs: DataFrame) -> DataFrame:
        x, y = light.alias("x"), light.alias("y")
        x = light.select(*[F.col(c).alias(f"x_{c}") for c in light.columns])
        y = light.select(*[F.col(c).alias(f"y_{c}") for c in light.columns])
        got = pairs.join(x, F.col("a") == F.col("x_id")).join(y, F.col("b") == F.col("y_id"))
        side = lambda s: {c: F.col(f"{s}_{c}") for c in light.columns}
        return got.where(_likely(side("x"), side("y"), percent)).select("a", "b")

    def sets_of(need: DataFrame) -> DataFrame:
        named = names.join(need.distinct(), F.col("__id") == F.col("id"), "left_semi")
        found = text.join(named, (F.col("__doc") == F.col("doc_id")) & (F.col("__h") == F.col("h"))).select("__id", "__text")
        sets = found.mapInArrow(_sets, "id long, set array<long>")
        return staged(sets.dropDuplicates(["id"]) if repeated else sets, "near-sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("id")))
        got = (pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("__x")), "a")
               .join(sets.select(F.col("id").alias("b"), F.col("set").alias("__y")), "b"))
        both = got.select("a", "b", F.size("__x").alias("x"), F.size("__y").alias("y"),
                          F.size(F.array_intersect("__x", "__y")).alias("i"))
        return both.where(100 * F.col("i") >= percent * (F.col("x") + F.col("y") - F.col("i"))).select("a", "b")

    first = cut(near(pairs))
    links = cut(confirmed(first))
    comp = cut(components(links))
    labelled = (multi.join(comp, "id", "left")
                .select("b", "id", F.coalesce("component_id", "id").alias("comp")))
    mixed = (labelled.groupBy("b").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("c"))
             .where("lo != hi").select("b", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("id"), F.col("blocks").cast("long")).cast("int")
    rest = labelled.join(mixed, "b").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    rest = rest.join(reps, "id").select("b", "i", "j", "own", "id", "comp", "n", "bands", *[f"s{i}" for i in range(SKETCH_WORDS)])
    picked = staged(rest.groupBy("b", "i", "j").applyInArrow(
        _pick(percent), "b long, i int, j int, ids array<long>, comps array<long>, x binary, y binary"), "near-picked")
    need = picked.select("b", "i", "j", F.explode("ids").alias("id"))
    # the two signs change nothing but make columns of their own: a cogroup drops those that both sides share
    held = need.join(sets_of(need.select("id")), "id").select(
        *[F.negative(F.negative(c)).alias(c) for c in ("b", "i", "j")], "id", "set")
    more = picked.groupBy("b", "i", "j").cogroup(held.groupBy("b", "i", "j")).applyInArrow(
        _confirm(percent), "a long, b long").distinct()
    return comp.select(F.col("id").alias("a"), F.col("component_id").alias("b")).unionAll(more)


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs (doc_id, text, ...)``.

    Documents whose distinct five-word shingles have a Jaccard similarity of
    ``percent`` or more are linked; ``component_id`` is the smallest doc_id
    reachable, ``kept`` marks it. Fewer than five words make one shingle of
    the whole sequence; null texts and texts without words have no shingle
    and link with nothing. Equal sets form one class first (partial
    aggregate), so a group of copies of any size is one vertex. Repeated rows
    come back as often as they are given; a doc_id that stands for several
    texts is linked through each of them, and its rows share a component; a
    null doc_id is never linked and kept (``component_id`` null). Texts are
    read whole; an empty table gives an empty result; other columns are
    ignored.
    """
    plain = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    sig = staged(plain.mapInArrow(_signatures, _SIG), "near-signatures")
    real = sig.where("n > 0 and doc_id is not null")
    sketch = [f"s{i}" for i in range(SKETCH_WORDS)]
    classes = staged(real.groupBy("f1", "f2", "n", *sketch, "bands").agg(F.min(F.struct("doc_id", "h")).alias("rep"))
                     .withColumn("id", F.monotonically_increasing_id()), "near-classes")
    repeated = not real.groupBy("doc_id", "h").count().where("count > 1").isEmpty()
    links = near_links(docs, classes.select("id", "rep.doc_id", "rep.h", "n", *sketch, "bands"), percent, repeated)
    member = staged(real.select("doc_id", "f1", "f2", "n").join(classes.select("f1", "f2", "n", "id"), ["f1", "f2", "n"]).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("id").alias("class")), "near-members")
    # the classes of one doc_id belong together
    shared = member.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("z")).where("a != z")
    tied = member.join(shared.select("doc_id", "a"), "doc_id").select("a", F.col("class").alias("b"))
    comp = cut(components(links.unionAll(tied)))
    named = classes.select("id", F.col("rep.doc_id").alias("low")).join(comp, "id", "left").select(
        F.col("id").alias("class"), "low", F.coalesce("component_id", "id").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    linked = member.join(named.join(lowest, "root").select("class", "component_id"), "class").select(
        "doc_id", "n_shingles", "component_id")
    alone = sig.where("n = 0 or doc_id is null").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
