"""Keyed state: restart, replay, late rows and caps over several batches, without reading the target."""

import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from cinelens.functions.scalars import iso_timestamp
from cinelens.streaming import keyed as KS

HEADER = "Author,Rating,Helpful_upVotes,Helpful_downVotes,Summary,Review,Scrape_Timestamp,Source_URL,Unique_ID\n"


def _put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(HEADER + "".join(f'u{n},7.5,1,0,"s\n{n}",,2026-01-{day:02d}T00:00:00.123456+00:00,u,{key}\n' for n, key, day in rows))


def _rows(df):
    return df.withColumns({"ord": F.substring("Author", 2, 9).cast("long"), "movie": F.substring("Unique_ID", 1, 1),
                           "at": iso_timestamp("Scrape_Timestamp")})


def _run(spark, tmp_dir, **kw):
    kw = {"transform": _rows, "max_files_per_trigger": 1, **kw}
    out = KS.run_keyed(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", "ord", **kw)
    return sorted((r.Unique_ID or "-", r.Author) for r in out.collect())


def test_restarts_and_values(spark, tmp_dir):
    _put(f"{tmp_dir}/in", "a.csv", [(2, "a1", 1), (1, "a1", 2), (3, "b1", 1), (4, "", 1), (5, "NA", 1)])
    assert _run(spark, tmp_dir) == [("-", "u4"), ("a1", "u1"), ("b1", "u3")]
    _put(f"{tmp_dir}/in", "b.csv", [(0, "a1", 1), (6, "b2", 1)])
    _put(f"{tmp_dir}/in", "c.csv", [(7, "b2", 1), (8, "c1", 1), (9, "", 1)])
    want = [("-", "u4"), ("a1", "u1"), ("b1", "u3"), ("b2", "u6"), ("c1", "u8")]
    assert _run(spark, tmp_dir) == want
    assert _run(spark, tmp_dir) == want         # nothing new
    row = spark.read.parquet(f"{tmp_dir}/out").where("Unique_ID = 'a1'").first()
    assert (row.Rating, row.Summary, row.Review) == (7.5, "s\n1", None) and row["at"].microsecond == 123456


def test_a_repeated_batch_replaces_itself(spark, tmp_dir):
    batch = spark.createDataFrame([(1, "m"), (2, "m"), (3, "n")], "ord long, movie string")
    write = KS.make_writer(f"{tmp_dir}/t", "movie", 3, "ord")
    read = lambda: sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/t").select("ord", "movie").collect()))
    write(batch, 0)
    more = spark.createDataFrame([(4, "m"), (5, "m"), (6, "o")], "ord long, movie string")
    for _ in range(3):
        write(more, 1)
        assert read() == [(1, "m"), (2, "m"), (3, "n"), (4, "m"), (6, "o")]
    write(more.where("ord > 6"), 2)
    write(spark.createDataFrame([(7, "m"), (8, "n")], "ord long, movie string"), 3)
    assert read()[-1] == (8, "n") and len(read()) == 6
    assert sorted(map(tuple, KS._totals(spark, f"{tmp_dir}/t_totals", 9).collect())) == [("m", 3), ("n", 2), ("o", 1)]


def test_caps_per_group_over_batches(spark, tmp_dir):
    for k in range(4):
        _put(f"{tmp_dir}/in", f"{k}.csv", [(10 * k + j, f"{'ab'[j % 2]}{k}{j}", 1) for j in range(4)] + [(99, "a00", 1)])
    got = _run(spark, tmp_dir, group_col="movie", target=3)
    assert [k for k, _ in got] == ["a00", "a02", "a10", "b01", "b03", "b11"]
    _put(f"{tmp_dir}/in", "9.csv", [(90, "a91", 1), (91, "c91", 1)])
    assert [k for k, _ in _run(spark, tmp_dir, group_col="movie", target=3)][-1] == "c91"


def test_late_rows_and_forgotten_keys(spark, tmp_dir):
    kw = {"event_time": "at", "lateness": "2 days"}
    _put(f"{tmp_dir}/in", "a.csv", [(1, "x1", 1), (2, "y1", 10)])
    _put(f"{tmp_dir}/in", "b.csv", [(5, "z1", 12)])
    _put(f"{tmp_dir}/in", "c.csv", [(3, "x1", 9), (4, "late", 1), (6, "y1", 11), (7, "z1", 12), (8, "w1", 11)])
    got = _run(spark, tmp_dir, **kw)
    # x1 was forgotten after its time and may come again; y1 and z1 are still known; "late" came after the watermark
    assert [k for k, _ in got] == ["w1", "x1", "x1", "y1", "z1"]


def test_target_is_not_read_back(spark, tmp_dir, monkeypatch):
    _put(f"{tmp_dir}/in", "a.csv", [(1, "x1", 1)])
    _run(spark, tmp_dir)
    os.rename(f"{tmp_dir}/out", f"{tmp_dir}/moved")
    _put(f"{tmp_dir}/in", "b.csv", [(2, "x1", 1), (3, "y1", 1)])
    assert _run(spark, tmp_dir) == [("y1", "u3")]


def test_arguments(spark, tmp_dir):
    with pytest.raises(ValueError):
        KS.ingest_keyed(spark, tmp_dir, tmp_dir, "ord", target=3)
    with pytest.raises(ValueError):
        KS.ingest_keyed(spark, tmp_dir, tmp_dir, "ord", event_time="at")


def test_order_of_a_keys_rows_and_cost_per_key():
    nan = float("nan")
    rows = [Row(place=p, tie=t, payload=f"{p}/{t}") for p, t in ((None, -5), (nan, -6), (2.0, 9), (2.0, -1), (3.0, -9))]
    assert [r.payload for r in sorted(rows, key=KS._rank)] == ["2.0/-1", "2.0/9", "3.0/-9", "nan/-6", "None/-5"]

    class Handle:
        def __init__(self):
            self.value = None

        def getValueState(self, *_):
            return self

        def exists(self):
            return self.value is not None

        def update(self, value):
            self.value = value

    step = KS.FirstPerKey(None)
    step.init(Handle())
    assert [r.payload for r in step.handleInputRows(("k",), iter(rows), None)] == ["2.0/-1"]
    assert list(step.handleInputRows(("k",), iter(rows), None)) == []
    assert list(step.handleInputRows(("k",), iter([]), None)) == []


def test_large_places_are_not_rounded(spark, tmp_dir):
    big = 2 ** 53
    _put(f"{tmp_dir}/in", "a.csv", [(big + 1, "a1", 1), (big, "a1", 1), (7, "a1", 1)])
    whole = F.substring("Author", 2, 20).cast("long")
    nulls = lambda df: _rows(df).withColumn("ord", F.when(whole > 7, whole))
    assert _run(spark, tmp_dir, transform=nulls) == [("a1", f"u{big}")]
