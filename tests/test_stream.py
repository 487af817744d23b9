import os

from cinelens.operators.dedup import keep_first
from cinelens.sources.csv import read_reviews
from cinelens.streaming.ingest import BATCH_COL, run_ingest

HEADER = "Author,Rating,Helpful_upVotes,Helpful_downVotes,Summary,Review,Scrape_Timestamp,Source_URL,Unique_ID\n"


def _write(folder, name, ids):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(HEADER)
        for i in ids:
            f.write(f'user{i},7,1,0,s{i},"text {i}",2026-01-01T00:00:00+00:00,u,id{i}\n')


def test_restart_replay_and_target(spark, tmp_dir):
    src, tgt, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    _write(src, "f1.csv", [1, 2, 3, 2])
    first = run_ingest(spark, src, tgt, checkpoint=ckpt)
    assert sorted(r["Unique_ID"] for r in first.collect()) == ["id1", "id2", "id3"]
    # restart from the checkpoint: a new file with repeated ids, and a replayed copy of f1
    _write(src, "f2.csv", [3, 4, 5])
    _write(src, "f3.csv", [1, 2, 3, 2])
    second = run_ingest(spark, src, tgt, checkpoint=ckpt)
    assert sorted(r["Unique_ID"] for r in second.collect()) == ["id1", "id2", "id3", "id4", "id5"]
    # the streamed table equals the batch equivalent (first row per id)
    batch = keep_first(read_reviews(spark, src), "Unique_ID")
    assert batch.count() == second.count()
    # a fresh run with a target stops at the target, counting nothing twice
    capped = run_ingest(spark, src, os.path.join(tmp_dir, "capped"), checkpoint=ckpt + "2", target=4,
                        max_files_per_trigger=1)
    assert capped.count() == 4
    assert BATCH_COL not in capped.columns


def _write_rows(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(HEADER + "".join(x + "\n" for x in lines))


MIXED = ['ann,7,1,0,s,"one",2026-01-01T00:00:00+00:00,u,a', "bob,NaN,None,,s,NaN,2026-01-02T00:00:00+00:00,u,b",
         'cy,11,2,0,s,"out of range",2026-01-02T00:00:00+00:00,u,', 'dee,N/A,2K,0,s,"no id",2026-01-02T00:00:00+00:00,u,NA']


def _tables(spark, root):
    from cinelens.plans.star import TABLES
    keep = {"reviews": ["movie_id", "review_hash", "rating", "review_text"], "movies": ["movie_id", "title"], "sources": ["source_url"],
            "reviewers": ["username"], "quarantine": ["username", "review_text", "reasons"]}
    return {t: sorted(map(str, spark.read.parquet(os.path.join(root, t)).select(*keep[t]).collect())) for t in TABLES}


def test_stream_and_batch_load_the_same_tables_exactly_once(spark, tmp_dir):
    """Null tokens, null ids and rejected rows over several micro-batches, a replay and a restart."""
    from pyspark.sql import functions as F

    from cinelens.plans.star import load_star

    src, tgt, star, once = (os.path.join(tmp_dir, x) for x in ("in", "out", "star", "once"))
    titled = lambda df: df.withColumns({"movie_id": F.lit("tt7"), "title": F.lit("T")})
    seen = []

    def hook(rows, batch_id):
        seen.append((batch_id, rows.count()))
        load_star(titled(rows), star)
        load_star(titled(rows), star)      # replayed

    for k, lines in enumerate([MIXED, MIXED, ['eve,5,0,0,s,"late",2026-01-05T00:00:00+00:00,u,e']]):
        _write_rows(src, f"f{k}.csv", lines)
    out = run_ingest(spark, src, tgt, on_batch=hook, max_files_per_trigger=1)
    assert len(seen) == 3 and sum(n for _, n in seen) == out.count() == 4      # a, b, one null id, e
    run_ingest(spark, src, tgt, on_batch=hook, max_files_per_trigger=1)        # restart: nothing new
    assert len(seen) == 3
    _write_rows(src, "f9.csv", MIXED)
    run_ingest(spark, src, tgt, on_batch=hook)
    assert seen[3:] in ([], [(3, 0)]) and run_ingest(spark, src, tgt).count() == 4

    batch = keep_first(read_reviews(spark, src), "Unique_ID")
    load_star(titled(batch), once)
    assert _tables(spark, star) == _tables(spark, once)
    assert len(_tables(spark, star)["quarantine"]) == 2


def test_on_batch_hook_and_watermark_state(spark, tmp_dir):
    src, tgt = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    _write(src, "f1.csv", [1, 2])
    seen = []
    run_ingest(spark, src, tgt, checkpoint=os.path.join(tmp_dir, "c"), dedup_state="all",
               on_batch=lambda rows, bid: seen.append(rows.count()))
    assert seen == [2]


def test_star_load_and_scoring_per_batch(spark, tmp_dir):
    from pyspark.sql import functions as F

    from cinelens.operators import sentiment as SN
    from cinelens.plans.star import load_star
    from cinelens.streaming.ingest import score_batches

    src, tgt = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    _write(src, "f1.csv", [1, 2, 3])
    star, scored = os.path.join(tmp_dir, "star"), os.path.join(tmp_dir, "scored")
    lex = SN.lexicon_table(spark, {"text": 1.0})

    def hook(rows, bid):
        rows = rows.withColumn("movie_id", F.lit("tt0000001")).withColumn("title", F.lit("T"))
        load_star(rows, star)
        score_batches(lambda r: SN.score_sentiment(r, "Unique_ID", "Review", lex), scored)(rows, bid)
        score_batches(lambda r: SN.score_sentiment(r, "Unique_ID", "Review", lex), scored)(rows, bid)  # replay

    run_ingest(spark, src, tgt, checkpoint=os.path.join(tmp_dir, "c"), on_batch=hook)
    assert spark.read.parquet(os.path.join(star, "reviews")).count() == 3
    s = spark.read.parquet(scored)
    assert s.count() == 3 and s.where("Compound > 0").count() == 3


def test_per_movie_history_and_target(spark, tmp_dir):
    from pyspark.sql import functions as F

    src, tgt = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    _write(src, "f1.csv", [1, 2, 3, 4])

    def with_movie(df):
        return df.withColumn("movie_id", F.concat(F.lit("tt"), (F.substring("Unique_ID", 3, 5).cast("int") % 2)
                                                  .cast("string")))

    kw = dict(transform=with_movie, target=2, group_col="movie_id")
    run_ingest(spark, src, tgt, checkpoint=os.path.join(tmp_dir, "c"), **kw)
    _write(src, "f2.csv", [5, 6, 1])
    out = run_ingest(spark, src, tgt, checkpoint=os.path.join(tmp_dir, "c"), **kw)
    per = {r["movie_id"]: r["n"] for r in out.groupBy("movie_id").agg(F.count("*").alias("n")).collect()}
    assert per == {"tt0": 2, "tt1": 2}
    assert sorted(p for p in os.listdir(tgt) if p.startswith("movie_id=")) == ["movie_id=tt0", "movie_id=tt1"]
    assert any(p.startswith(BATCH_COL) for p in os.listdir(os.path.join(tgt, "movie_id=tt0")))


def test_watermark_dedup_keeps_state_bounded(spark, tmp_dir):
    from pyspark.sql import functions as F

    from cinelens.functions.scalars import iso_timestamp

    src, tgt = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    _write(src, "f1.csv", [1, 2, 2, 3])
    out = run_ingest(spark, src, tgt, checkpoint=os.path.join(tmp_dir, "c"),
                     transform=lambda df: df.withColumn("event_time", iso_timestamp("Scrape_Timestamp")),
                     dedup_state="watermark", event_time="event_time", lateness="1 day")
    assert sorted(r["Unique_ID"] for r in out.collect()) == ["id1", "id2", "id3"]
    assert out.where(F.col("event_time").isNull()).count() == 0
