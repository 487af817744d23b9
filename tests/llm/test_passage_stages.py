"""What the passage operator keeps on disk, and classes that stand in a bucket several times."""

import glob
import os
import random

import numpy as np
import pyarrow as pa

from cinelens.llm import common
from cinelens.llm import passages as PS

from . import cases


def data_bytes(folder):
    return sum(os.path.getsize(f) for f in glob.glob(f"{folder}/**/*.parquet", recursive=True))


def test_tables_that_nothing_reads_again_are_given_up(spark, tmp_dir, monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    shared = " ".join(rng.choice(words) for _ in range(60))
    rows = [(i, " ".join(rng.choice(words) for _ in range(40)) + f"\n{shared}\n" + " ".join(rng.choice(words) for _ in range(40)))
            for i in range(12)]
    monkeypatch.setattr(common, "checkpoint_dir", lambda s: tmp_dir)
    monkeypatch.setattr(PS, "scratch_path", lambda s, name: f"{tmp_dir}/{name}")
    got = PS.repeated_passages(cases.plain(spark, rows))
    for name in ("passage_texts", "passage-units", "passage-buckets", "passage-sets", "passage-known", "passage-held", "passage-beside"):
        own = [x for x in os.listdir(tmp_dir) if x.startswith(name)]
        assert own and all(data_bytes(f"{tmp_dir}/{x}") < 1000 for x in own), name
    # the result reads none of them
    assert {r.doc_id for r in got.collect()} == set(range(1, 12))


def test_a_class_repeated_in_a_bucket_counts_once():
    z = np.int64(5)
    # one class many times over two batches, one pair of classes, and a larger bucket
    rows = [(7, 10, z, 1)] * 20 + [(f, 10, z, 2) for f in (3, 3, 4, 4, 4)] + [(f, 10, z, 3) for f in range(PS.FEW + 1) for _ in range(3)]
    for size in (len(rows), 7, 1):
        batches = [pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
            zip(*rows[at:at + size]), (pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=["f", "n", "z", "b"])
            for at in range(0, len(rows), size)]
        got = sorted((r["b"], r["f"], -1 if r["other"] is None else r["other"]) for out in PS._meet(75)(iter(batches)) for r in out.to_pylist())
        assert got == [(2, 3, 4)] + [(3, f, -1) for f in range(PS.FEW + 1)]
