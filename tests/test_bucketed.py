"""Bucketed targets: no shuffle of what was loaded before, and the same tables as plain ones."""

import os
import re

import pytest

from cinelens.operators.dedup import keep_first, new_reviews
from cinelens.plans import star as SR
from cinelens.sources import bucketed as BK
from cinelens.sources import derived

SF = "/root/testdata/sf0.001"
KEEP = {"sources": ["source_url"], "movies": ["movie_id", "title"], "reviewers": ["username"],
        "reviews": ["movie_id", "review_hash", "rating", "review_text"], "quarantine": ["username", "review_text", "reasons"]}


def _tables(spark, root):
    return {t: sorted(map(str, spark.read.parquet(os.path.join(root, t)).select(*KEEP[t]).collect())) for t in SR.TABLES}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_loads_and_replays_equal_plain_tables(spark, tmp_dir):
    raw = derived.review_rows(spark, SF)
    a, b = f"{tmp_dir}/plain", f"{tmp_dir}/bucketed"
    for part in (raw.where("ord < 80"), raw, raw, raw.where("ord > 150")):
        SR.load_star(part, a)
        SR.load_star(part, b, buckets=4)
    assert _tables(spark, a) == _tables(spark, b)
    reviews = spark.read.parquet(f"{b}/reviews")
    assert reviews.select("review_id").distinct().count() == reviews.count() > 100
    # a later session knows the folder only
    name = BK.table_name(f"{b}/reviews", "review_hash", 4)
    spark.sql(f"DROP TABLE {name}")
    SR.load_star(raw, b, buckets=4)
    assert _tables(spark, a) == _tables(spark, b)


def test_the_target_is_not_shuffled(spark, tmp_dir):
    raw, path = derived.review_rows(spark, SF), f"{tmp_dir}/known"
    old = raw.where("ord < 120").select("Unique_ID")
    BK.append_bucketed(old, path, "Unique_ID", 4)
    BK.append_bucketed(old.limit(5), path, "Unique_ID", 4)
    known = BK.open_bucketed(spark, path, old.schema, "Unique_ID", 4)
    had = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = new_reviews(raw, known, by_key=True)
        lines = _plan(fresh).splitlines()
        at = next(k for k, line in enumerate(lines) if "bucketed_" in line and "Bucketed: true" in line)
        depth = lambda line: len(re.match(r"[ :|+-]*", line).group())
        above, level = [], depth(lines[at])
        for line in reversed(lines[:at]):
            if depth(line) < level:
                level = depth(line)
                above.append(line)
        join = next(k for k, line in enumerate(above) if "LeftAnti" in line)
        assert not any("Exchange" in line for line in above[:join])
        got = {r.ord for r in fresh.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", had)
    assert got == {r.ord for r in new_reviews(raw, old).collect()} and got


def test_by_key_takes_one_key(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", "x"), (3, None, "y")], "ord long, k string, v string")
    assert sorted(r.ord for r in keep_first(df, "k", by_key=True).collect()) == [1]
    with pytest.raises(ValueError):
        keep_first(df, ["k", "v"], by_key=True)
