"""One CSV file read by many tasks equals the reader that takes it whole."""

import csv
import os
import random

import pytest

from cinelens.operators.clean import NULL_TOKENS
from cinelens.sources.csv import CSV_FIELDS, read_reviews

SMALL = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture()
def small_ranges(spark):
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k in SMALL:
        spark.conf.unset(k)


def _write(path, rows, end="\r\n"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(CSV_FIELDS)
        w.writerows(rows)


def _rows(rng, n, longest):
    def text():
        return "".join(rng.choice(['"', '""', "\n", "\n\n", "\r\n", ",", "é", "word ", "words and more ", " "]) for _ in range(rng.randrange(longest)))
    return [[f"user{k}", rng.choice(["7", "NaN", ""]), "1", "0", text(), text(), "2026-01-01T00:00:00+00:00", "u", f"id{k}"] for k in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_ranges_equal_the_whole_file(spark, tmp_dir, small_ranges, seed):
    rng = random.Random(seed)
    rows = [_rows(rng, 60, (6, 40, 400, 3)[seed]) for _ in range(2)]
    for k in range(2):
        _write(f"{tmp_dir}/in/f{k}.csv", rows[k], "\n" if seed % 2 else "\r\n")
    assert spark.read.option("lineSep", "\n").text(f"{tmp_dir}/in").rdd.getNumPartitions() > 4
    whole, cut = read_reviews(spark, f"{tmp_dir}/in"), read_reviews(spark, f"{tmp_dir}/in", in_ranges=True)
    assert whole.dtypes[:-1] == cut.dtypes[:-1]
    a, b = ([tuple(r) for r in sorted(df.collect(), key=lambda r: (r.ord.file, r.ord.pos))] for df in (whole, cut))
    assert len({r[-1] for r in b}) == 120
    # as written, line breaks inside fields included
    told = [[None if v in NULL_TOKENS else float(v) if k == 1 else v for k, v in enumerate(row)] for part in rows for row in part]
    assert [list(r[:-1]) for r in b] == told
    # Spark's own reader turns them into \n where lines end in \r\n
    plain = lambda rows: [[v.replace("\r\n", "\n") if isinstance(v, str) else v for v in r[:-1]] for r in rows]
    assert plain(a) == plain(b)


def test_a_record_over_many_ranges_and_an_open_quote(spark, tmp_dir, small_ranges):
    long = "line, with \"quotes\"\n" * 200
    _write(f"{tmp_dir}/in/f.csv", [["a", "1", "", "", "s", "first", "t", "u", "1"], ["b", "2", "", "", "s", long, "t", "u", "2"],
                                   ["c", "3", "", "", "s", "last", "t", "u", "3"]], "\n")
    with open(f"{tmp_dir}/in/f.csv", "a") as f:
        f.write('\n\nd,4,,,s,"never closed\nuntil the end')
    got = {r.Author: r.Review for r in read_reviews(spark, f"{tmp_dir}/in", in_ranges=True).collect()}
    assert got == {"a": "first", "b": long, "c": "last", "d": "never closed\nuntil the end"}


def test_empty_file_and_header_alone(spark, tmp_dir):
    _write(f"{tmp_dir}/in/f.csv", [], "\n")
    open(f"{tmp_dir}/in/g.csv", "w").close()
    assert read_reviews(spark, f"{tmp_dir}/in", in_ranges=True).collect() == []
