"""Plan-shape checks: the physical strategies the design relies on."""

import re

from cinelens import catalog as C
from cinelens.operators import keywords as KW
from cinelens.operators import sentiment as SN
from cinelens.operators.dedup import keep_first, new_reviews
from cinelens.plans.preprocess import preprocess
from cinelens.sources import derived

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_tables_have_exact_sizes(spark):
    size = int(str(KW.stopwords(spark, ["a", "b"])._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert 0 < size < 1000


def test_sentiment_lookups_are_broadcast(spark):
    lex, bst, ngt = C._sent_tables(spark)
    raw = derived.review_rows(spark, SF).select("ord", "Review")
    plan = _plan(SN.score_sentiment(raw, "ord", "Review", lex, bst, ngt, method="joins"))
    assert plan.count("BroadcastHashJoin") >= 4      # lexicon hit join + three neighbour lookups
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_keywords_count_by_hash_aggregates_and_limit_before_the_shuffle(spark):
    stop, lem = C._kw_tables(spark)
    plan = _plan(KW.top_keywords(derived.review_rows(spark, SF), "Review", "ord", stop, lem, group="movie_id"))
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan and "BroadcastHashJoin" in plan


def test_keep_first_sorts_and_shuffles_no_text(spark):
    plan = _plan(keep_first(derived.review_rows(spark, SF), "Review", "ord"))
    assert "SortAggregate" not in plan and "partial_min" in plan
    assert not re.search(r"hashpartitioning\([^)]*Review", plan)


def test_fill_uses_a_subquery_not_a_join(spark):
    plan = _plan(preprocess(derived.review_rows(spark, SF)))
    assert "Subquery" in plan and "NestedLoopJoin" not in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(C.QUERIES["A12_movie_metrics"](spark, SF))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan


def test_no_plan_spreads_rows_round_robin(spark):
    for name in ("A9_sentiment_scores", "A8_top_keywords", "S8_extract_review_cards"):
        assert "RoundRobinPartitioning" not in _plan(C.QUERIES[name](spark, SF))


def test_per_group_cap_limits_rows_before_the_shuffle(spark):
    raw = derived.review_rows(spark, SF)
    plan = _plan(new_reviews(raw, raw.where("ord < 20"), target=40, group="movie_id"))
    assert "WindowGroupLimit" in plan and "Partial" in plan
