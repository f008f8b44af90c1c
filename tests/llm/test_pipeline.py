import random

import pytest
from helpers import words

import corpus_pipeline as pipeline
from vectorloom.llm.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_stages():
    assert [name for name, _ in pipeline.STAGES] == [
        "quality_classifier", "ngram_join", "suffix_dedup", "mixing", "packing",
    ]
    assert set(ORACLES) <= set(QUERIES) and sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))[0].startswith("op1_")
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_near_copies_leave_one(spark, make_docs):
    rng = random.Random(3)
    rows = [(i, words(80, i % 10)) for i in range(30)]
    rows += [(100 + i, words(80, i).replace(f"w{i}x{rng.randint(20, 60)} ", "other ")) for i in range(10)]
    rows += [(3, words(80, 3)), (None, words(80, 1)), (50, words(80, 77)), (51, None), (52, "")]
    got = sorted(r.doc_id for r in pipeline.ngram_join(spark, make_docs(*rows), SF_DIR).collect() if r.doc_id is not None)
    assert got == [*range(10), 50, 51, 52]


def test_near_copies_are_judged_by_text(spark, make_docs):
    """Repeated and null doc_ids: texts without a near copy stay, copies go, whatever their ids."""
    near = words(80, 1).replace("w1x40 ", "other ")
    rows = [(1, words(80, 1)), (2, near), (2, words(80, 2)), (2, words(80, 3)), (3, words(80, 2)), (None, words(80, 3))]
    rows += [(None, words(80, 4)), (None, words(80, 4)), (None, words(80, 5)), (4, words(80, 5)), (4, words(80, 6)), (4, words(80, 6))]
    got = pipeline.ngram_join(spark, make_docs(*rows), SF_DIR).collect()
    want = [(1, words(80, 1)), (2, words(80, 2)), (2, words(80, 3)), (None, words(80, 4)), (4, words(80, 5)), (4, words(80, 6))]
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted((str(k), t) for k, t in want)


def test_mix_tells_rows_with_one_id_apart(spark, make_docs):
    rows = [(1, words(10, i), "a") for i in range(50)] + [(1, words(10, 100 + i), "b") for i in range(50)]
    got = pipeline.mixing(spark, make_docs(*rows), SF_DIR).collect()
    # 1,000 words at weights 5 and 2
    assert abs(sum(r.source == "a" for r in got) - 71) <= 1 and abs(sum(r.source == "b" for r in got) - 29) <= 1


def test_passages_go(spark, make_docs):
    passage = words(60, 5)
    docs = make_docs((1, words(9, 1) + " " + passage), (2, "start " + passage + " end"), (3, words(20, 3)), (4, None))
    got = {r.doc_id: (r.text, r.n_chars) for r in pipeline.suffix_dedup(spark, docs, SF_DIR).collect()}
    assert got[1][0] == words(9, 1) + " " + passage and got[3] == (words(20, 3), len(words(20, 3)))
    assert got[2] == ("startend", 8) or got[2][1] < 20
    assert got[4] == (None, None)


def test_mix_repeats_and_drops_documents(spark, make_docs):
    rows = [(i, words(10, i), "abc"[i % 3]) for i in range(60)] + [(None, "x y", "a"), (None, None, None)]
    got = pipeline.mixing(spark, make_docs(*rows), SF_DIR).collect()
    size = {s: sum(len(r.text.split()) for r in got if r.source == s) for s in "abc"}
    # 602 words at weights 5, 2, 1: two copies of some of a, most of b, some of c
    assert abs(size["a"] - 376) <= 10 and abs(size["b"] - 150) <= 10 and abs(size["c"] - 75) <= 10


@pytest.mark.parametrize("stage", [f for _, f in pipeline.STAGES[:-1]])
def test_stages_keep_the_columns(spark, awkward, stage):
    docs = stage(spark, awkward, SF_DIR)
    assert docs.columns == pipeline.COLUMNS
    docs.collect()
    assert stage(spark, awkward.filter("doc_id > 99"), SF_DIR).collect() == []


def test_run(spark):
    rows = pipeline.run(spark, SF_DIR).collect()
    assert rows and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(rows[0].asDict())
