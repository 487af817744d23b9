"""Merkle manifest of a dataset, with proofs from a butterfly exchange.

Every row is a leaf. Leaves of a source, in order, are dealt in aligned
partitions of ``FANOUT ** LOCAL`` ones. A partition hashes its own subtree;
then, round by round, aligned groups of ``FANOUT`` partitions swap the roots
they have reached. Each partition hashes the common ancestor again for itself
and keeps its siblings, so after the last round it holds the upper part of
every proof below it and nothing has to be sent down the tree.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import local_table
from .common import cut, empty, staged

FANOUT = 16
#: Levels that a partition hashes by itself.
LOCAL = 2
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_STEPS = "array<struct<before: string, after: string>>"
_NUMBERED = "pid int, run long, idx long, head string, doc_id long, leaf binary, other binary"
_OUT = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
        "verified boolean")


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def _field(col) -> F.Column:
    """``-`` for a null, else the number of UTF-8 bytes, a colon and the value."""
    s = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(columns) -> F.Column:
    return F.sha2(F.concat(*[_field(c) for c in columns]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """``source, doc_id, leaf, other``: digests of the rows and, where tampering hits a row, of what it makes of it."""
    plain = docs.select(*[F.col(c) for c in COLUMNS])
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rest = [F.col(c) for c in COLUMNS[:-1]]
    lowered = F.translate(F.col("text"), UPPER, LOWER)
    return plain.select(
        F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(leaf_digest([*rest, F.col("text")])).alias("leaf"),
        F.when(hit, F.unhex(leaf_digest([*rest, lowered]))).alias("other"))


# --- places of the leaves -----------------------------------------------------------


def _number(batches):
    """Number the sorted rows of a task: which run of one source, and where in it."""
    pid, run, idx, last = TaskContext.get().partitionId(), -1, 0, None
    for batch in batches:
        source = batch.column(0).to_pylist()
        runs, places, heads = [], [], []
        for s in source:
            new = run < 0 or s != last
            run, idx, last = (run + 1, 0, s) if new else (run, idx + 1, last)
            runs.append(run)
            places.append(idx)
            heads.append(s if new else None)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(source), pid, np.int32)), pa.array(runs, pa.int64()), pa.array(places, pa.int64()),
             pa.array(heads, pa.string()), *[batch.column(k) for k in (1, 2, 3)]], names=[c.split()[0] for c in _NUMBERED.split(", ")])


def placed(rows: DataFrame, block: int) -> DataFrame:
    """``sid, block, at, doc_id, leaf, other``: number of the source, aligned partition, place therein.

    Rows are sorted over all tasks by (source, doc_id, leaf), nulls first, so
    a hot source and null ids are dealt over many tasks. Where a task's first
    source began is told by the first and last run of every task, two rows a
    task, which is all that the driver sees.
    """
    spark = rows.sparkSession
    keys = ["source", "doc_id", "leaf"]
    numbered = staged(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(_number, _NUMBERED), "merkle-numbered")
    runs = numbered.groupBy("pid", "run").agg(F.count(F.lit(1)).alias("n"), F.max("head").alias("head"))
    ends = runs.groupBy("pid").agg(F.min_by(F.struct("head", "n"), "run").alias("a"), F.max_by(F.struct("head", "n"), "run").alias("z"),
                                   F.max("run").alias("last"))
    starts, sid, before, last = [], -1, 0, None
    for r in sorted(ends.collect(), key=lambda r: r.pid):
        goes_on = sid >= 0 and r.a["head"] == last
        first, offset = (sid, before) if goes_on else (sid + 1, 0)
        starts.append((r.pid, first, offset))
        sid, last = first + r.last, r.z["head"]
        before = r.z["n"] + (offset if r.last == 0 else 0)
    starts = local_table(spark, starts, "pid int, first long, offset long")
    place = F.col("idx") + F.when(F.col("run") == 0, F.col("offset")).otherwise(0)
    return numbered.join(starts, "pid").select(
        (F.col("first") + F.col("run")).alias("sid"), place.alias("place"), "doc_id", "leaf", "other").select(
        "sid", F.expr(f"place div {block}").alias("block"), F.expr(f"cast(place % {block} AS int)").alias("at"), "doc_id", "leaf", "other")


# --- subtrees of the partitions -----------------------------------------------------


def _climb(digests: list[str], alone: bool, levels: int) -> list[list[str]]:
    """Levels of a partition's subtree; one that is alone in its tree ends as soon as a single node remains."""
    out = [digests]
    while len(out[-1]) > 1 if alone else len(out) <= levels:
        below = out[-1]
        out.append([_hash("".join(below[i:i + FANOUT])) for i in range(0, len(below), FANOUT)])
    return out


def _groups(batches, keys: int = 2):
    """Runs of rows equal in the first ``keys`` columns (sorted input), as ``(key, columns)``."""
    key, kept = None, None
    for batch in batches:
        cols = [c.to_pylist() for c in batch.columns]
        n = batch.num_rows
        marks = list(zip(*cols[:keys]))
        at = 0
        while at < n:
            end = at + 1
            while end < n and marks[end] == marks[at]:
                end += 1
            part = [c[at:end] for c in cols[keys:]]
            if marks[at] == key:
                kept = [a + b for a, b in zip(kept, part)]
            else:
                if key is not None:
                    yield key, kept
                key, kept = marks[at], part
            at = end
    if key is not None:
        yield key, kept


def _alone(block: int, n: int, levels: int) -> bool:
    return block == 0 and n < FANOUT ** levels


def _subtree_roots(levels: int):
    def run(batches):
        rows = [(sid, block, _climb([x.hex() for x in leaf], _alone(block, len(leaf), levels), levels)[-1][0])
                for (sid, block), (_, leaf) in _groups(batches)]
        cols = list(zip(*rows)) if rows else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())],
                                         names=["sid", "p", "h"])
    return run


def _dealt(df: DataFrame) -> DataFrame:
    return df.repartition("sid", "block").sortWithinPartitions("sid", "block", "at")


def subtree_roots(rows: DataFrame, levels: int) -> DataFrame:
    """``sid, p, h``: the root that every partition reaches by itself."""
    return _dealt(rows.select("sid", "block", "at", "leaf")).mapInArrow(_subtree_roots(levels), "sid long, p long, h string")


# --- rounds of the butterfly --------------------------------------------------------


def butterfly(roots: DataFrame) -> DataFrame:
    """``sid, p, h, up``: the root of the tree and the siblings met on the way, known to every partition.

    In round r a partition stands at ancestor ``p div 16**r`` and sends its
    hash to the partitions of the neighbouring subtrees whose lower digits are
    its own. In an incomplete last subtree the partitions there take turns to
    serve the digits that have no partition of their own. A partition gets 16
    rows a round at most.
    """
    sizes = roots.groupBy("sid").agg((F.max("p") + 1).alias("size"))
    nodes = cut(roots.join(sizes, "sid").select("sid", "p", "size", "h", F.array().cast(_STEPS).alias("up")))
    most = nodes.agg(F.max("size")).first()[0] or 0
    below = 1
    while below < most:
        nodes = cut(_round(nodes, below))
        below *= FANOUT
    return nodes


def _round(nodes: DataFrame, below: int) -> DataFrame:
    done, active = nodes.where(F.col("size") <= below), nodes.where(F.col("size") > below)
    sends = active.select("sid", "size", "h", "up", F.col("p").alias("sender"), F.expr(f"p div {below}").alias("anc")).select(
        "*", F.expr(f"anc % {FANOUT}").alias("digit"), F.expr(f"sender % {below}").alias("lower"),
        F.expr(f"least({below}L, size - anc * {below})").alias("count"))
    sends = sends.select("*", F.explode(F.expr(f"sequence(anc - digit, anc - digit + {FANOUT - 1}L)")).alias("to")).where(
        f"to * {below} < size")
    sends = sends.select("*", F.explode(F.expr(f"sequence(lower, {below - 1}L, count)")).alias("their")).select(
        "sid", "size", "digit", "h", "up", "sender", F.expr(f"to * {below} + their").alias("p")).where("p < size")
    got = sends.groupBy("sid", "p").agg(
        F.first("size").alias("size"), F.max(F.when(F.col("sender") == F.col("p"), F.col("up"))).alias("up"),
        F.array_sort(F.collect_list(F.struct("digit", "h"))).alias("all"))
    own = f"(p div {below}) % {FANOUT}"
    joined = "array_join(transform(filter(all, x -> x.digit {} " + own + "), x -> x.h), '')"
    return got.select(
        "sid", "p", "size", F.sha2(F.expr("array_join(transform(all, x -> x.h), '')"), 256).alias("h"),
        F.expr(f"concat(up, array(struct({joined.format('<')} AS before, {joined.format('>')} AS after)))").cast(_STEPS).alias("up")
    ).unionByName(done)


# --- proofs -------------------------------------------------------------------------


def _proof(levels: list[list[str]]):
    """Siblings of each leaf within its partition, as (before, after) per level, bottom up."""
    joined = [["".join(level[i:i + FANOUT]) for i in range(0, len(level), FANOUT)] for level in levels[:-1]]
    width = len(levels[0][0])

    def steps(i: int):
        for runs in joined:
            run, j = divmod(i, FANOUT)
            yield runs[run][:width * j], runs[run][width * (j + 1):]
            i = run
    return steps


def _paths(levels: int):
    """Rows of a partition -> each with its whole path: own levels, then what the partition's header row carries."""
    def run(batches):
        for (sid, block), (_, leaf, up) in _groups(batches):
            steps = _proof(_climb([x.hex() for x in leaf[1:]], _alone(block, len(leaf) - 1, levels), levels))
            n = len(leaf) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(block * FANOUT ** levels, block * FANOUT ** levels + n), pa.int64()),
                 pa.array([[{"before": a, "after": z} for a, z in steps(i)] + up[0] for i in range(n)],
                          pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))], names=["sid", "path"])
    return run


def _verify(levels: int):
    def run(batches):
        for (sid, block), (_, doc_id, leaf, other, up, subroot, root) in _groups(batches):
            upper, top, peak = [(u["before"], u["after"]) for u in up[0]], subroot[0], root[0]
            digests = [x.hex() for x in leaf[1:]]
            steps = _proof(_climb(digests, _alone(block, len(digests), levels), levels))
            proofs, folded = [], []
            for i, h in enumerate(digests):
                path = [*steps(i), *upper]
                proofs.append(_hash("".join(a + z for a, z in path)))
                if other[i + 1] is not None:
                    h = other[i + 1].hex()
                for a, z in path:
                    h = _hash(a + h + z)
                folded.append(h)
            n = len(digests)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_id[1:], pa.int64()), *[pa.array(c, pa.string()) for c in (digests, [top] * n, [peak] * n, proofs, folded)],
                 pa.array([f == peak for f in folded], pa.bool_())], names=[c.split()[0] for c in _OUT.split(", ")])
    return run


def manifest(docs: DataFrame, levels: int = LOCAL) -> DataFrame:
    """Manifest row of every document: leaf, subroot of its source, root, digest of its proof, and a check by folding.

    Leaves of a source ascend by doc_id (null first; rows with the same one by
    their digest, so repeated rows stand next to each other); sources ascend
    bytewise, the null source first. Null values are ``-`` in a leaf and an
    empty text is ``0:``; a row with null doc_id is never tampered with. An
    empty table has no rows and no root. Other columns are not read. ``levels``
    is the height of the subtree that one partition hashes by itself; the
    result does not depend on it.
    """
    spark, block = docs.sparkSession, FANOUT ** levels
    rows = placed(staged(leaves(docs), "merkle-leaves"), block)
    nodes = butterfly(subtree_roots(rows, levels))
    if nodes.isEmpty():
        return empty(spark, _OUT)
    subroots = nodes.where("p = 0").select("sid", F.col("h").alias("subroot"))
    tops = subroots.select(F.lit(0).cast("long").alias("sid"), F.expr(f"sid div {block}").alias("block"),
                           F.expr(f"cast(sid % {block} AS int)").alias("at"), F.unhex("subroot").alias("leaf"))
    over = butterfly(subtree_roots(tops, levels))
    headed = tops.withColumn("up", F.lit(None).cast(_STEPS)).unionByName(
        over.select("sid", F.col("p").alias("block"), F.lit(-1).alias("at"), F.lit(None).cast("binary").alias("leaf"), "up"))
    paths = _dealt(headed).mapInArrow(_paths(levels), f"sid long, path {_STEPS}")
    root = over.where("p = 0").select("h").first()[0]
    headers = nodes.join(paths, "sid").join(subroots, "sid").select(
        "sid", F.col("p").alias("block"), F.lit(-1).alias("at"), F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("binary").alias("leaf"), F.lit(None).cast("binary").alias("other"),
        F.concat("up", "path").alias("up"), "subroot", F.lit(root).alias("root"))
    below = rows.select("*", F.lit(None).cast(_STEPS).alias("up"), F.lit(None).cast("string").alias("subroot"),
                        F.lit(None).cast("string").alias("root"))
    return _dealt(headers.unionByName(below)).mapInArrow(_verify(levels), _OUT)
