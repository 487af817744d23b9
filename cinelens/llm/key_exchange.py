"""Which keys occur more than once: a compact exchange between shards of documents.

Every shard tells buckets 24-bit remainders of the keys it holds, once per
key; a bucket answers with the numbers of those that another shard holds too.
A key that is very common costs one entry per shard. Buckets grow in number
with the data, so a remainder and its bucket keep their meaning at any size;
remainders may agree by chance, so an answer is a superset of the repeated
keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard

from .common import U64, mix

TOLD = "bucket long, shard long, short binary, number binary"


def announce(shard: int, keys: np.ndarray, shards: int) -> pa.Table:
    """Rows for the buckets; a key that the shard itself holds again needs no answer (``repeated_here``)."""
    order = np.argsort(keys)
    ranked = keys[order]
    lead = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])[:len(ranked)])
    count = np.diff(np.append(lead, len(ranked)))
    first = np.minimum.reduceat(order, lead) if len(lead) else order
    k = mix(ranked[lead])
    bucket = (k % U64(shards)).astype(np.int64)
    short = np.ascontiguousarray((k >> U64(40)).astype("<u4")).view(np.uint8).reshape(-1, 4)[:, :3]
    # by bucket, those that ask for an answer first, in the order of their numbers (which then pack well)
    by = np.argsort((bucket * 2 + (count > 1)) * max(1, len(keys)) + first)
    cuts = np.flatnonzero(np.diff(bucket[by])) + 1
    parts = np.split(by, cuts) if len(by) else []
    pack = zstandard.ZstdCompressor(level=1)
    numbers = [np.diff(first[p[count[p] == 1]], prepend=0).astype(np.uint32).tobytes() for p in parts]
    return pa.table({"bucket": pa.array([int(bucket[p[0]]) for p in parts], pa.int64()),
                     "shard": pa.array([shard] * len(parts), pa.int64()),
                     "short": pa.array([short[p].tobytes() for p in parts], pa.binary()),
                     "number": pa.array([pack.compress(n) for n in numbers], pa.binary())})


def answer(table: pa.Table) -> tuple[pa.Array, pa.Array]:
    """Per shard the numbers of keys that some other shard holds too, as bytes of uint32."""
    open_ = zstandard.ZstdDecompressor()
    short, number = [], []
    for s, n in zip(table["short"].to_pylist(), table["number"].to_pylist()):
        raw = np.frombuffer(s, dtype=np.uint8).reshape(-1, 3).astype(np.uint32)
        short.append(raw[:, 0] | raw[:, 1] << np.uint32(8) | raw[:, 2] << np.uint32(16))
        asked = np.cumsum(np.frombuffer(open_.decompress(n), dtype=np.uint32).astype(np.int64))
        number.append(np.concatenate((asked, np.full(len(raw) - len(asked), -1, dtype=np.int64))))
    shard = np.repeat(np.arange(len(short)), [len(x) for x in short])
    short, number = np.concatenate(short), np.concatenate(number)
    by = np.argsort(short, kind="stable")
    same = short[by][1:] == short[by][:-1]
    multi = np.zeros(len(short), dtype=bool)
    multi[1:] |= same
    multi[:-1] |= same
    hit = by[multi]
    hit = np.sort(hit[number[hit] >= 0])
    names, own = table["shard"].to_pylist(), np.unique(shard[hit])
    return (pa.array([names[i] for i in own], pa.int64()),
            pa.array([number[hit[shard[hit] == i]].astype(np.uint32).tobytes() for i in own], pa.binary()))


def repeated_here(keys: np.ndarray) -> np.ndarray:
    """Whether the shard holds the key of each number again."""
    _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
    return count[inverse] > 1
