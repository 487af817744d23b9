"""De-duplication and incremental-ingest filters.

"First" is always defined by an explicit ingest-order column ``ord`` (a
number or a struct such as ``(file, position)``), never by partition order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _key_hash(keys):
    # nulls apart from texts, and no text that spans two keys
    parts = [F.coalesce(F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")),
                        F.lit("-")) for k in keys]
    return F.sha2(F.concat_ws("|", *parts), 256)


def keep_first(df: DataFrame, keys, ord: str = "ord", unless: DataFrame | None = None, by_key: bool = False) -> DataFrame:
    """Keep the first row (smallest ``ord``) per key; null keys form one group.

    The key is hashed (``sha2``), so no text is a sort or shuffle key: the
    smallest ``ord`` per hash is a hash aggregate whose partial step leaves
    one narrow row per key and task (a key holding most rows never meets in
    one task). Keys that ``unless`` holds are taken out of these narrow rows.
    What is left picks the rows by a join on ``(hash, ord)``, the only step
    that may move whole rows. Rows without ``ord`` come last. Of rows that tie
    on it the one with the smallest row hash stays, of rows alike in every
    column any, found on the partitioning of that join. With ``by_key`` a single
    key column is used as it is, without a hash: ``unless`` may then be a
    table bucketed by it, which is not shuffled. Rows without a key are then
    left out.
    """
    keys = _keys(keys)
    if by_key and len(keys) != 1:
        raise ValueError("by_key needs a single key")
    mark = F.col(keys[0]) if by_key else _key_hash(keys)
    hashed = df.withColumns({"__key": mark, "__at": F.struct(F.col(ord).alias("o"))})
    first = hashed.groupBy(F.col("__key").alias("__k")).agg(F.min(ord).alias("o")).select("__k", F.struct("o").alias("__a"))
    if unless is not None:
        seen = unless.select(mark.alias("__seen"))
        first = first.join(seen if by_key else seen.distinct(), F.col("__k") == F.col("__seen"), "left_anti")
    kept = hashed.join(first, (F.col("__key") == F.col("__k")) & (F.col("__at") == F.col("__a")), "left_semi")
    w = Window.partitionBy("__key", "__at").orderBy(row_hash(df))
    return kept.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").select(*df.columns)


def row_hash(df: DataFrame):
    """A number for a whole row (maps, which have no hash, as their sorted entries)."""
    return F.xxhash64(*[F.array_sort(F.map_entries(f"`{f.name}`")) if f.dataType.typeName() == "map" else F.col(f"`{f.name}`")
                        for f in df.schema])


def distinct_values(df: DataFrame, cols) -> DataFrame:
    """Distinct values of ``cols`` (e.g. authors)."""
    return df.select(*_keys(cols)).distinct()


def skip_seen(batch: DataFrame, known: DataFrame, key="Unique_ID") -> DataFrame:
    """rows of ``batch`` whose key (one column or several) is not among ``known``'s keys.

    Only the key columns of ``known`` are read. Keys compare null-safe: a null
    key that was ingested before counts as seen.
    """
    keys = _keys(key)
    seen = known.select(*[F.col(k).alias(f"__seen_{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__seen_{k}"))
    return batch.join(seen, same, "left_anti")


def cap_new(new_rows: DataFrame, existing: int, target: int, ord: str = "ord") -> DataFrame:
    """keep new rows, in ingest order, only while existing + new <= target.

    Only the order column (with the row hash, for ties) is range-partitioned
    and written down; with the count of every partition known (one number
    each) a single partition holds the last row to keep, and rows up to it
    are kept by a filter: no task gathers the kept rows and no text is moved.
    """
    room = target - existing
    if room <= 0:
        return new_rows.limit(0)
    place = F.struct(F.col(ord).isNull(), F.col(ord), row_hash(new_rows))
    parts = int(new_rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = checkpointed(new_rows.select(place.alias("__at")).repartitionByRange(parts, "__at").withColumn("__part", F.spark_partition_id()))
    before = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")).select(
        F.col("__part").alias("__p"), "__n",
        F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    edge = dealt.join(before.where((F.col("__before") < room) & (F.col("__before") + F.col("__n") >= room)), F.col("__part") == F.col("__p"))
    ranked = edge.withColumn("__rn", F.row_number().over(Window.partitionBy("__part").orderBy("__at")))
    last = ranked.where(F.col("__before") + F.col("__rn") == room).select(F.max("__at").alias("__at"))
    return new_rows.where(F.coalesce(place <= last.scalar(), F.lit(True)))


def cap_new_per_group(new_rows: DataFrame, existing: DataFrame | None, target: int, group: str,
                      ord: str = "ord") -> DataFrame:
    """F5 per group: a group's new rows, in ingest order, while existing + new <= target.

    ``row_number() <= target`` plans as a ``WindowGroupLimit``: each map task
    keeps at most ``target`` rows per group before the shuffle, so a group
    holding most of the batch never reaches one task whole. ``existing`` is
    ``(group, existing)`` counts (one row per group).
    """
    w = Window.partitionBy(group).orderBy(ord)
    ranked = new_rows.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= target)
    limit = F.lit(target)
    if existing is not None:
        ranked = ranked.join(existing.select(group, F.col("existing").alias("__existing")), group, "left")
        limit = limit - F.coalesce(F.col("__existing"), F.lit(0))
    out = ranked.where(F.col("__rn") <= limit)
    return out.drop("__rn", "__existing") if existing is not None else out.drop("__rn")


def new_reviews(batch: DataFrame, known: DataFrame | None, key: str = "Unique_ID",
                ord: str = "ord", target: int | None = None, group: str | None = None, by_key: bool = False) -> DataFrame:
    """F3 + D3 + F5: first row per key in the batch, minus history, capped.

    ``target`` counts distinct known keys as well as new ones (the resume
    rule): without ``group`` that count is a job of its own. With ``group``
    (e.g. ``movie_id``) history, de-duplication and the target apply per
    group, as with one review file per movie.
    """
    if group is not None:
        fresh = keep_first(batch, [group, key], ord, unless=known)
        existing = None
        if known is not None:
            existing = known.groupBy(group).agg(F.countDistinct(key).alias("existing"))
        return fresh if target is None else cap_new_per_group(fresh, existing, target, group, ord)
    fresh = keep_first(batch, key, ord, unless=known, by_key=by_key)
    if target is None:
        return fresh
    existing = known.select(key).distinct().count() if known is not None else 0
    return cap_new(fresh, existing, target, ord)
