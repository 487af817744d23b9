"""Files that hold none of a batch's keys are skipped; results are those of the plain comparison."""

from cinelens.operators.dedup import new_reviews
from cinelens.sources import key_filters as KF


def _scanned(spark, df):
    """Rows that the file scans of ``df`` gave when it ran."""
    had = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = df.select("*")
        rows = again.collect()
        leaves = again._jdf.queryExecution().executedPlan().collectLeaves()
        return rows, sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", had)


def _rows(spark, keys):
    return spark.createDataFrame([(k, f"id{k * 7919 % 100003:06d}" if k % 50 else None, "text " * 5) for k in keys], "ord long, Unique_ID string, t string")


def test_unrelated_files_are_skipped(spark, tmp_dir):
    path = f"{tmp_dir}/history"
    for b in range(12):         # keys of every file are spread over the whole range
        KF.append_filtered(_rows(spark, range(b * 500 + 1, b * 500 + 501)).coalesce(1), path, "Unique_ID", 500)
    batch = _rows(spark, [7, 8, 9, 9001, 9002])
    known = KF.known_among(batch, path)
    rows, scanned = _scanned(spark, known)
    assert sorted(r.Unique_ID for r in rows) == sorted(r.Unique_ID for r in batch.where("ord < 10").collect())
    assert scanned <= 2 * 500 < 12 * 500
    assert _scanned(spark, KF.known_among(batch, path, max_keys=2))[1] == 12 * 500
    for most in (2, 256):
        got = KF.skip_known(batch, path, max_keys=most).collect()
        assert sorted(r.ord for r in got) == [9001, 9002]


def test_nulls_repeats_and_empty_batches(spark, tmp_dir):
    path = f"{tmp_dir}/history"
    KF.append_filtered(_rows(spark, [1, 2, 50]), path, "Unique_ID")
    for keys in ([50, 1, 3, 3, 100], [], [50], [4, 150]):
        batch, plain = _rows(spark, keys), spark.read.parquet(path)
        assert sorted(map(str, KF.skip_known(batch, path).collect())) == sorted(map(str, new_reviews(batch, plain).collect()))
