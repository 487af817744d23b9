"""URL filters by a Bloom filter cascade (DataFrame functions only).

A cascade encodes the listed keys in a first Bloom filter, the keys of the
corpus that pass it by mistake in a second one, the listed keys that pass
that one in a third, and so on until a level lets nothing through by
mistake. Over the key universe it was built on it answers membership
exactly, with no join at probing time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Bits per encoded key and hash functions per level.
BITS_PER_KEY = 12
HASHES = 4
#: Largest filter that is sent to the tasks; a longer list is dealt into several cascades, one pass each.
MAX_FILTER_BYTES = 32 << 20


def _position(key: Column, level: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits).cast("long"))


@dataclass
class Cascade:
    """Levels ``(bits, filter bytes)``; ``shard`` is the part of the keys it answers for."""

    levels: list[tuple[int, bytes]] = field(default_factory=list)
    shard: int = 0
    shards: int = 1

    def passes(self, key: Column, level: int) -> Column:
        """Whether ``key`` passes one level."""
        bits, data = self.levels[level]
        ok = F.lit(True)
        for i in range(HASHES):
            p = _position(key, level, i, bits)
            byte = F.conv(F.hex(F.substring(F.lit(data), (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10)
            ok = ok & (F.getbit(byte.cast("long"), F.pmod(p, F.lit(8)).cast("int")) == 1)
        return ok

    def member(self, key: Column) -> Column:
        """Exact membership over the universe: the first level that is not passed decides."""
        if not self.levels:
            return F.lit(False)
        expr = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            expr = F.when(self.passes(key, level), expr).otherwise(F.lit(level % 2 == 1))
        if self.shards > 1:
            expr = expr & (shard_of(key, self.shards) == self.shard)
        return expr


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("shard")), F.lit(shards).cast("long"))


def _bloom(keys: DataFrame, level: int, n: int) -> tuple[int, bytes]:
    """Bloom filter of ``keys (key)``; bytes are combined by a partial aggregate, then gathered (bounded by n)."""
    bits = max(64, (n * BITS_PER_KEY + 7) // 8 * 8)
    rows = (keys.select(F.explode(F.array(*[_position(F.col("key"), level, i, bits) for i in range(HASHES)])).alias("p"))
            .groupBy(F.floor(F.col("p") / 8).alias("at"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.pmod("p", F.lit(8)).cast("int"))).alias("b")).collect())
    data = bytearray(bits // 8)
    for r in rows:
        data[r["at"]] = r["b"]
    return bits, bytes(data)


def build_cascade(listed: DataFrame, universe: DataFrame, shard: int = 0, shards: int = 1) -> Cascade:
    """Cascade for ``listed (key)`` over ``universe (key)``; null keys are ignored.

    Only keys that pass the first level by mistake leave the scan of the
    universe, so what is shuffled is a small, tunable share of its distinct
    keys. ``listed`` must be small enough for one filter (see ``build_cascades``).
    """
    out = Cascade(shard=shard, shards=shards)
    yes = listed.where("key is not null").select("key").distinct()
    n = yes.count()
    if not n:
        return out
    out.levels.append(_bloom(yes, 0, n))
    no = (universe.where(F.col("key").isNotNull() & out.passes(F.col("key"), 0)).select("key").distinct()
          .join(yes, "key", "left_anti"))
    encode, other = no, yes
    while True:
        # written once per level: each is a few false positives of the one before
        encode = cut(encode)
        n, level = encode.count(), len(out.levels)
        if not n:
            return out
        out.levels.append(_bloom(encode, level, n))
        encode, other = other.where(out.passes(F.col("key"), level)), encode


def build_cascades(listed: DataFrame, universe: DataFrame) -> list[Cascade]:
    """As many cascades as keep each filter below ``MAX_FILTER_BYTES``."""
    shards = max(1, -(-listed.count() * BITS_PER_KEY // 8 // MAX_FILTER_BYTES))
    if shards == 1:
        return [build_cascade(listed, universe)]
    return [build_cascade(listed.where(shard_of(F.col("key"), shards) == s),
                          universe.where(shard_of(F.col("key"), shards) == s), s, shards) for s in range(shards)]


def member(cascades: list[Cascade], key: Column) -> Column:
    out = F.lit(False)
    for c in cascades:
        out = out | c.member(key)
    return out


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def apply_rules(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row of ``pages``.

    ``rules`` are ``(verdict, host, path prefix)`` with verdict ``allow`` or
    ``block``. A rule fits its host and all subdomains where the path starts
    with the rule's; the longest key (host + path) wins, then the longer
    host; a key in both lists blocks. Every url yields the keys that any rule
    could equal (host suffixes and path prefixes of the lengths the rules
    have); these keys over all rows are the cascades' universe. No rule:
    ``rule`` null and ``default``. Null, empty and malformed urls have empty
    host and path and fit nothing; repeated rows are judged alike; other
    columns stay, except that ones named like a result are replaced.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col))
    labels = sorted({h.count(".") + 1 for _, h, _ in rules})
    lengths = sorted({len(p) for _, _, p in rules})
    keep = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    parts = pages.select(*keep, host.alias("host"), path.alias("path"))

    def keys(h, p):
        made = [F.struct(F.length(F.concat(x, y)).alias("n"), F.length(x).alias("h"), F.concat(x, y).alias("key"))
                for x in (F.substring_index(h, ".", -k) for k in labels)
                for y in (F.substring(p, 1, n) for n in lengths)]
        return F.array(*made) if made else F.expr("cast(array() as array<struct<n:int,h:int,key:string>>)")

    listed = {v: spark.createDataFrame([(h + p,) for k, h, p in rules if k == v], "key string") for v in ("allow", "block")}
    universe = parts.select(F.explode(keys(F.col("host"), F.col("path"))).alias("k")).select("k.key")
    made = {v: build_cascades(listed[v], universe) for v in listed}
    fits = F.array_max(F.filter(keys(F.col("host"), F.col("path")),
                                lambda k: member(made["allow"], k["key"]) | member(made["block"], k["key"])))
    found = parts.withColumn("rule", fits["key"])
    return found.withColumn("verdict", F.when(F.col("rule").isNull(), default)
                            .when(member(made["block"], F.col("rule")), "block").otherwise("allow"))
