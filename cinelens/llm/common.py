"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

U64 = np.uint64
#: Odd multiplier of the prefix polynomial hashes (arithmetic modulo 2**64) and a second one for verification.
BASE = 0x9E3779B97F4A7C15
BASE2 = 0xD6E8FEB86659FD93


def staged(df: DataFrame, name: str, passing: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()`` but compressed, so a lost executor
    costs no recomputation of what stands before. The path is added to
    ``passing``, if given, for ``given_up``.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if passing is not None:
        passing.append(path)
    return spark.read.schema(df.schema).parquet(path)


def given_up(spark: SparkSession, passing: list[str]) -> None:
    """Empty the staged tables that nothing reads any more, so that they take no disk while later steps run."""
    while passing:
        spark.range(0).write.mode("overwrite").parquet(passing.pop())


def cut(df: DataFrame) -> DataFrame:
    """``checkpoint()`` into the session's shared folder (narrow tables)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns renamed c0, c1, ..., so that no name of theirs clashes with one added."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def slices(batches, rows: int = 256):
    """Arrow batches cut into small ones, so that a task holds few texts as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


# --- components ---------------------------------------------------------------------


#: Edges per task of a component step.
EDGE_ROWS = 100_000


def _star(edges: DataFrame, large: bool, tasks: int) -> DataFrame:
    """One large-star or small-star step over undirected edges ``(u, v)``, u > v."""
    both = edges.select("u", "v")
    if large:
        both = both.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("__m"))
    low = low.select(F.col("u").alias("__u"), F.least("u", "__m").alias("__m"))
    joined = both.join(low, F.col("u") == F.col("__u"))
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("__m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("__m").alias("v")).unionAll(
            low.select(F.col("__u").alias("u"), F.col("__m").alias("v")))
    return out.where(F.col("u") != F.col("v")).coalesce(tasks).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id of every vertex of ``edges (a long, b long)`` -> ``(id, component_id)``.

    Alternates large-star and small-star steps until every vertex points at
    its smallest one: no vertex has two parents or is both child and parent.
    A vertex with very many neighbours costs one partial aggregate per task
    and a join whose hot side Spark may split; nothing is gathered per vertex
    or at the driver. Self links and repeated links are ignored; null ends are
    dropped. Every round is cut by ``checkpoint()`` and runs on as many tasks
    as its edges need.
    """
    e = cut(edges.where("a is not null and b is not null and a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        tasks = e.count() // EDGE_ROWS + 1
        few = e.coalesce(tasks)
        e = cut(_star(_star(few, True, tasks), False, tasks).coalesce(tasks))
        roles = e.select("u", F.lit(1).alias("child"), F.lit(0).alias("parent")).unionAll(
            e.select("v", F.lit(0), F.lit(1))).groupBy("u").agg(F.sum("child").alias("c"), F.max("parent").alias("p"))
        if roles.where("c > 1 or (c = 1 and p = 1)").isEmpty():
            break
    roots = e.select("v").distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionAll(
        roots.select(F.col("v").alias("id"), F.col("v").alias("component_id")))


# --- hashing of byte strings --------------------------------------------------------

_POW: dict[int, np.ndarray] = {}


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base**0 .. base**n modulo 2**64 (grown on demand, kept per process)."""
    have = _POW.get(base)
    if have is None or len(have) <= n:
        size = 1 << max(12, int(n + 1).bit_length())
        steps = np.full(size, base, dtype=U64)
        steps[0] = 1
        have = _POW[base] = np.multiply.accumulate(steps)
    return have


def inverse(base: int) -> int:
    """Inverse of an odd number modulo 2**64 (Newton steps)."""
    x = base
    for _ in range(6):
        x = x * (2 - base * x) % (1 << 64)
    return x


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mix (in a new array)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def prefix_hash(data: np.ndarray, base: int = BASE) -> np.ndarray:
    """P with P[i] = sum of (data[j] + 1) * base**j for j < i, modulo 2**64."""
    out = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum((data.astype(U64) + U64(1)) * powers(len(data), base)[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hash of bytes [start, end): equal strings get equal values wherever they stand."""
    inv = powers(int(start.max()) if len(start) else 0, inverse(base))
    return (prefix[end] - prefix[start]) * inv[start]


# --- words and shingles -------------------------------------------------------------

SHINGLE = 5


def shingle_hashes(text: str | None, k: int = SHINGLE) -> tuple[np.ndarray, int]:
    """Distinct ``k``-word shingles as sorted 64-bit hashes, and a hash of the whole word sequence.

    A-Z is lower-cased; words are split at the bytes 0x20 and 0x09-0x0D
    (``bytes.split``). Fewer than ``k`` words make one shingle; none make none.
    """
    words = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not words:
        return np.zeros(0, dtype=U64), 0
    data = np.frombuffer(words, dtype=np.uint8)
    gaps = np.flatnonzero(data == 32)
    start = np.concatenate(([0], gaps + 1))
    end = np.concatenate((gaps, [len(data)]))
    p = prefix_hash(data)
    whole = int(mix(p[-1:] + U64(len(data)))[0])
    if len(start) > k:
        start, end = start[: len(start) - k + 1], end[k - 1:]
    else:
        start, end = start[:1], end[-1:]
    h = mix(span_hash(p, start, end) + (end - start).astype(U64))
    return np.unique(h), whole


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
