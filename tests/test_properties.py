"""Results depend on the ``ord`` column only, never on row order or partitioning."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from cinelens.operators import keywords as KW
from cinelens.operators.dedup import keep_first

WORDS = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 9)), min_size=1, max_size=30),
       st.integers(1, 6), st.randoms())
def test_keep_first_is_permutation_invariant(spark, rows, parts, rnd):
    data = [(i, k, v) for i, (k, v) in enumerate(rows)]
    shuffled = data[:]
    rnd.shuffle(shuffled)
    a = spark.createDataFrame(data, "ord long, k string, v int")
    b = spark.createDataFrame(shuffled, "ord long, k string, v int").repartition(parts)
    key = lambda df: sorted((r["k"] or "", r["ord"], r["v"]) for r in keep_first(df, "k").collect())
    assert key(a) == key(b)
    expected = {}
    for o, k, v in data:
        expected.setdefault(k, (o, v))
    assert key(a) == sorted((k or "", o, v) for k, (o, v) in expected.items())


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORDS), min_size=0, max_size=8).map(" ".join), min_size=1, max_size=12),
       st.integers(1, 5))
def test_keyword_ties_follow_first_occurrence(spark, texts, parts):
    docs = list(enumerate(texts))
    shuffled = docs[:]
    random.Random(7).shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "ord long, Review string").repartition(parts)
    got = [(r["word"], r["count"]) for r in KW.top_keywords(df, "Review", top_n=4).collect()]
    counts, first = {}, {}
    for o, t in docs:
        for p, w in enumerate(t.split()):
            counts[w] = counts.get(w, 0) + 1
            first.setdefault(w, (o, p))
    want = sorted(counts, key=lambda w: (-counts[w], first[w]))[:4]
    assert got == [(w, counts[w]) for w in want]
