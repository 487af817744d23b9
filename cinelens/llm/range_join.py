"""Near-duplicate embeddings by an exact metric range join.

Vectors of one label are partitioned by pivots: each belongs to the cell of
its nearest pivot. Unit vectors with a cosine of c or more are at most
r = sqrt(2 - 2c) apart, so by the triangle inequality a vector can have a
neighbour in another cell only if that cell's pivot is at most 2r farther
away than its own; it is sent there as a visitor. Cells, cut into blocks of
bounded size, join on their own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, staged

COSINE = 0.93
#: Members of a cell on average, the most pivots of one label, and vectors per block of a cell or a label.
CELL_ROWS = 2000
MAX_PIVOTS = 256
BLOCK_ROWS = 2000
#: Distances are compared with this slack, cosines near the threshold are summed again exactly.
SLACK = 1e-9


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision (scaled first, so that no square over- or underflows)."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def exact_cosine(x, y) -> float:
    dot, xx, yy = (math.fsum(a * b for a, b in zip(p, q)) for p, q in ((x, y), (x, x), (y, y)))
    return dot / math.sqrt(xx * yy)


def _matrix(table: pa.Table) -> np.ndarray:
    return np.array(table["vec"].to_pylist(), dtype=np.float64)


_CELLS = "label long, cell int, home boolean, id long, weight long, vec array<double>"


def _assign(radius: float):
    """Per label and block: the home cell of every vector and the cells it visits."""

    def run(key, vectors: pa.Table, pivots: pa.Table) -> pa.Table:
        label = key[0].as_py()
        raw = vectors["vec"].to_pylist() if vectors.num_rows else []
        ids, weights = (vectors[c].to_numpy() if raw else np.zeros(0, dtype=np.int64) for c in ("id", "weight"))
        if raw:
            x = _unit(np.array(raw, dtype=np.float64))
            order = np.argsort(pivots["pivot"].to_numpy())
            p = _unit(_matrix(pivots)[order])
            d = np.sqrt(np.maximum(0, 2 - 2 * (x @ p.T)))
            home = d.argmin(axis=1)
            who, cell = np.nonzero(d <= d.min(axis=1)[:, None] + 2 * radius + 1e-6)
        else:
            who = cell = home = np.zeros(0, dtype=np.int64)
        return pa.table({"label": pa.array([label] * len(who), pa.int64()), "cell": pa.array(cell, pa.int32()),
                         "home": pa.array(home[who] == cell, pa.bool_()), "id": pa.array(ids[who], pa.int64()),
                         "weight": pa.array(weights[who], pa.int64()),
                         "vec": pa.array([raw[i] for i in who], pa.list_(pa.float64()))})
    return run


def _join_block(cosine: float):
    """Links between the homes of a block and its visitors, summed up per vector.

    Returns ``(id, root, links)``: a vector's smallest partner within the
    block by any path, and the weight of its partners. A pair is counted in
    the block where its smaller id visits the larger one's home.
    """

    def run(table: pa.Table) -> pa.Table:
        ids, weight = table["id"].to_numpy(), table["weight"].to_numpy()
        role = table["home"].to_numpy(zero_copy_only=False)
        raw = _matrix(table)
        x = _unit(raw)
        h, v = np.flatnonzero(role), np.flatnonzero(~role)
        cos = x[v] @ x[h].T
        hit = (cos >= cosine - SLACK) & (ids[v][:, None] < ids[h][None, :])
        for a, b in zip(*np.nonzero(hit & (np.abs(cos - cosine) <= SLACK))):
            hit[a, b] = exact_cosine(raw[v[a]].tolist(), raw[h[b]].tolist()) >= cosine
        root = ids.copy()
        a, b = np.nonzero(hit)
        while True:
            low = np.minimum(root[v[a]], root[h[b]])
            before = root.copy()
            np.minimum.at(root, v[a], low)
            np.minimum.at(root, h[b], low)
            if (before == root).all():
                break
        links = np.zeros(len(ids), dtype=np.int64)
        links[v] += (hit * weight[h][None, :]).sum(axis=1)
        links[h] += (hit * weight[v][:, None]).sum(axis=0)
        keep = links > 0
        return pa.table({"id": pa.array(ids[keep], pa.int64()), "root": pa.array(root[keep], pa.int64()),
                         "links": pa.array(links[keep], pa.int64())})
    return run


def near_vectors(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``embeddings (vec_id, embedding, label, ...)``.

    Vectors of one non-null label are linked at a cosine of ``cosine`` or
    more (double precision). Vectors that are null, empty or zero, or hold
    null or non-finite components, link with nothing, nor do vectors of
    different lengths. Equal vectors of a label are one class first (partial
    aggregate), whose size weighs in the counts. A row without vec_id links
    with nothing (``component_id`` null, kept). Repeated rows count each as a
    vector; an empty table gives an empty result; other columns are ignored.
    """
    radius = math.sqrt(max(0.0, 2 - 2 * cosine))
    vec = F.transform("embedding", lambda x: x.cast("double"))
    rows = embeddings.select("vec_id", F.col("label").cast("long").alias("label"), vec.alias("vec"))
    fit = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0)
           & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
           & F.exists("vec", lambda x: x != 0))
    # vectors of one label but different lengths live in spaces of their own
    space = F.xxhash64("label", F.size("vec"))
    rows = staged(rows.withColumn("fit", F.coalesce(fit, F.lit(False))).withColumn("space", space), "range-rows")
    real = rows.where("fit")
    classes = staged(real.groupBy("space", "vec").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight")), "range-classes")
    sizes = classes.groupBy("space").agg(F.count(F.lit(1)).alias("n")).select(
        "space", F.least(F.lit(MAX_PIVOTS), F.ceil(F.col("n") / CELL_ROWS)).cast("int").alias("pivots"),
        F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))

    # pivots: per space the classes with the smallest hashes, as many as it needs cells
    w = Window.partitionBy("space").orderBy(F.xxhash64("id"), "id")
    few = classes.select("space", "id").withColumn("pivot", F.row_number().over(w)).where(F.col("pivot") <= MAX_PIVOTS)
    few = few.join(sizes, "space").where("pivot <= pivots").select(
        F.col("space").alias("s"), F.col("id").alias("i"), "pivot", "blocks")
    pivots = few.join(classes.select(F.col("space").alias("s"), F.col("id").alias("i"), "vec"), ["s", "i"]).select(
        F.negative(F.negative("s")).alias("space"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "pivot", "vec")
    dealt = classes.join(sizes, "space").select(
        "space", F.pmod(F.xxhash64("id"), F.col("blocks").cast("long")).cast("int").alias("block"), "id", "weight", "vec")
    cells = staged(dealt.groupBy("space", "block").cogroup(pivots.groupBy("space", "block")).applyInArrow(
        _assign(radius), _CELLS), "range-cells")

    # blocks of a cell: homes x visitors, each role cut into parts of bounded size
    counts = cells.groupBy("label", "cell").agg(F.count(F.lit(1)).alias("v"), F.count(F.when(F.col("home"), 1)).alias("h")).select(
        "label", "cell", F.ceil(F.col("h") / BLOCK_ROWS).cast("int").alias("hs"), F.ceil(F.col("v") / BLOCK_ROWS).cast("int").alias("vs"))
    known = cells.join(counts, ["label", "cell"]).where("hs > 0")
    part = lambda c: F.pmod(F.xxhash64("id"), F.col(c).cast("long")).cast("int")
    as_home = known.where("home").select("label", "cell", part("hs").alias("hb"), F.explode(F.sequence(F.lit(0), F.col("vs") - 1)).alias("vb"),
                                         F.lit(True).alias("home"), "id", "weight", "vec")
    as_visitor = known.select("label", "cell", F.explode(F.sequence(F.lit(0), F.col("hs") - 1)).alias("hb"), part("vs").alias("vb"),
                              F.lit(False).alias("home"), "id", "weight", "vec")
    found = staged(as_home.unionAll(as_visitor).groupBy("label", "cell", "hb", "vb").applyInArrow(
        _join_block(cosine), "id long, root long, links long"), "range-links")

    # one row of a repeated vec_id stands for its class in the components
    comp = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")).unionAll(
        real.join(classes, ["space", "vec"]).select(F.col("vec_id").alias("a"), F.col("id").alias("b"))))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    weights = classes.join(links, "id", "left").select(
        "space", "vec", "id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    linked = real.join(weights, ["space", "vec"]).select("vec_id", "n_links", "id").join(
        comp.withColumnRenamed("id", "__id"), F.col("id") == F.col("__id"), "left").select(
        "vec_id", "n_links", F.coalesce("component_id", "id").alias("component_id"))
    alone = rows.where("not fit").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
