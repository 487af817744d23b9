"""The pipeline's stages: columns, effect on planted cases, and registration."""

import __spark_entry__ as E
import corpus_pipeline as C
from cinelens.llm import near_dedup as ND
from cinelens.llm import queries as Q

from . import cases
from .test_dedup import brute_components
from .test_learning import check_packing

SF = "/root/testdata/sf0.001"


def test_registered():
    assert set(Q.QUERIES) | {"pipeline"} <= set(E.queries())
    assert [n for n, _ in C.STAGES] == ["language_id", "near_dedup", "substring_dedup", "decontamination", "packing"]
    assert all(f"op{k}_" in " ".join(Q.QUERIES) for k in range(1, 11))


def test_stages_take_effect(spark):
    rows = cases.documents()
    docs, kept = cases.table(spark, rows), {}
    for name, stage in C.STAGES[:-1]:
        docs = C.staged(stage(spark, docs, SF), "test")
        assert docs.columns == cases.table(spark, []).columns
        kept[name] = [(r.doc_id, r.text) for r in docs.collect()]
    ids = lambda name: {i for i, _ in kept[name]}
    assert {i for i, t, *_ in rows} - ids("language_id") == {4, 5, 6, 9}
    comp, _ = brute_components([r for r in rows if r[0] in ids("language_id")])
    assert ids("near_dedup") - {None} == {i for i in comp if comp[i] == i}
    assert len(kept["near_dedup"]) == len({i for i, _ in kept["near_dedup"]})
    assert ids("substring_dedup") == ids("near_dedup")
    assert dict(kept["substring_dedup"])[43] == dict(kept["near_dedup"])[43]
    packed = C.STAGES[-1][1](spark, docs, SF).collect()
    check_packing(packed, kept["decontamination"])


def test_leaking_documents_go(spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    docs = cases.plain(spark, [(1, "before " + bench + " after"), (2, "nothing of the kind in here"), (None, bench)])
    assert {r.doc_id for r in C.drop_leaks(spark, docs, SF).collect()} == {2}


def test_run_over_a_table(spark):
    got = C.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    comp = {r.doc_id: r.kept for r in ND.near_duplicates(docs.where("text rlike '\\\\p{L}'")).collect()}
    assert {r.doc_id for r in got} <= {i for i, k in comp.items() if k}
    check = {}
    for r in got:
        check.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in check.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n


def test_texts_stay_where_no_language_was_learned(spark):
    rows = [(i, t, None, *rest) for i, t, _, *rest in cases.documents()]
    docs = cases.table(spark, rows)
    got = C.keep_languages(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(map(str, got.collect())) == sorted(str(r) for r in docs.collect() if r.doc_id not in (4, 5, 6, 9) and r.text is not None)
