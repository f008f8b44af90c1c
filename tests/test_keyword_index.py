"""Buckets from an index of grams equal a test of every keyword on every text."""

import random

import pytest

from vectorloom import session
from vectorloom.operators import keyword_index as ki
from vectorloom.operators.dictionary import grouped_style
from pyspark.sql import functions as F


def by_hand(texts, keywords):
    return [next((k for k in keywords if t is not None and k in t.lower().strip()), None) for t in texts]


def run(spark, texts, keywords):
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, style string")
    words = spark.createDataFrame(list(enumerate(keywords)), "at int, word string")
    table = ki.keyword_table(words, "word", "at")
    return [r["bucket"] for r in ki.grouped_styles(rows, ["id"], "style", table).orderBy("id").collect()]


def some_texts(n, seed=2):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdE ", k=rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("lengths", [(4, 9), (1, 6)])
def test_many_keywords(spark, lengths):
    rng = random.Random(3)
    keywords = ["".join(rng.choices("abcde", k=rng.randint(*lengths))) for _ in range(2_000 if lengths[0] > 1 else 60)]
    texts = some_texts(150)
    assert run(spark, texts, keywords) == by_hand(texts, keywords)


def test_awkward_texts_and_keywords(spark):
    texts = [None, "", " \t", "abc", "ABCD ", "日本語のビール", "x" * 5_000 + "needle", "needl", "a.b*c", "ipa", "ip a"]
    keywords = ["needle", "日本語の", "本", "a.b*", "ipa", "needle", "bcd"]
    assert run(spark, texts, keywords) == by_hand(texts, keywords)
    assert run(spark, texts, [*keywords, ""]) == by_hand(texts, [*keywords, ""])
    assert run(spark, texts, []) == [None] * len(texts)
    assert run(spark, [], keywords) == []


def test_a_gram_that_most_texts_share(spark, no_broadcast):
    texts = ["pale ale " + t for t in some_texts(300)] + ["stout"] * 5
    keywords = ["pale porter", "ale aaaa", "ale b", "stout", "pale ale", "ale"]
    assert run(spark, texts, keywords) == by_hand(texts, keywords)


def test_equals_the_chain_of_tests(spark):
    names = ["India Pale Ale", "Baltic Porter", "porterale", None, "Pilsner", "Milk STOUT ", "lagered ipa"]
    rows = spark.createDataFrame(list(enumerate(names)), "id int, style string")
    chain = [r["b"] for r in rows.select("id", grouped_style(F.col("style")).alias("b")).orderBy("id").collect()]
    assert run(spark, names, ["porter", "ale", "lager", "stout", "ipa"]) == chain


def test_no_join_without_a_key(spark):
    rows = spark.createDataFrame(list(enumerate(some_texts(20))), "id int, style string")
    table = ki.keyword_table(spark.createDataFrame([(0, "abca")], "at int, word string"), "word", "at")
    plan = ki.grouped_styles(rows, ["id"], "style", table)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_one_pass_where_texts_are_read(spark):
    texts, keywords = some_texts(200), ["abca", "bcd", "ddab"]
    with session.noted_scratch() as written:
        assert run(spark, texts, keywords) == by_hand(texts, keywords)
    labels = {path.rsplit("/", 1)[1].rsplit("-", 1)[0] for path in written}
    # neither texts nor their grams are written or moved
    assert labels == {"keywords", "first-keywords"}


def test_more_keywords_than_a_pattern_takes(spark, no_broadcast):
    rng = random.Random(3)
    keywords = ["".join(rng.choices("abcde", k=rng.randint(1, 6))) for _ in range(60)]
    texts = some_texts(100)
    assert run(spark, texts, keywords) == by_hand(texts, keywords)


@pytest.mark.parametrize(
    "keywords",
    [
        ["abcd", "abc", "ab", "a", "b"],
        ["a", "ab", "abc", "cab", "abcd"],
        ["dddd", "ab", "abca", "abc", "aabca", "a"],
        ["日本語", "日", "本語", "語"],
        ["🍺🍺", "é🍺", "🍺", "🍺x"],
        ["[a-z]", "a.b", "^a", "a\\Eb", "\\Qa", "a$", "a|b", "&&", "-", " b", "a\nb", "]"],
    ],
)
def test_keywords_within_each_other(spark, keywords):
    rng = random.Random(5)
    texts = some_texts(40) + keywords + ["".join(rng.choices(keywords, k=3)) for _ in range(20)]
    texts += ["".join(rng.choices("日本語🍺éx[]\\.a^&-$|\nb", k=12)) for _ in range(60)]
    assert run(spark, texts, keywords) == by_hand(texts, keywords)


def test_rows_without_a_key_have_no_bucket(spark, request):
    rows = spark.createDataFrame([(1, "pale ale"), (None, "ale"), (2, None), (3, "stout"), (3, "ale")], "id int, style string")
    table = ki.keyword_table(spark.createDataFrame([(0, "ale"), (1, "stout")], "at int, word string"), "word", "at")

    def buckets():
        return sorted(map(tuple, ki.grouped_styles(rows, ["id"], "style", table).collect()), key=str)

    by_pattern = buckets()
    assert by_pattern == sorted([(1, "ale"), (None, None), (2, None), (3, "ale"), (3, "ale")], key=str)
    request.getfixturevalue("no_broadcast")
    assert buckets() == by_pattern


def test_dictionary_in_one_pass(spark):
    texts, keywords = [*some_texts(80), None, "bcd"], ["ddab", "bcd", "abca", "zz"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, style string")
    table = ki.keyword_table(spark.createDataFrame(list(enumerate(keywords)), "at int, word string"), "word", "at")
    with session.noted_scratch() as written:
        made = ki.keyword_dictionary(rows, ["id"], "style", table).orderBy("style_index").collect()
    buckets = [b for b in by_hand(texts, keywords) if b]
    assert [(r["style_key"], r["n"], r["style_index"]) for r in made] == [
        (b, buckets.count(b), i) for i, b in enumerate(dict.fromkeys(buckets))
    ]
    # neither texts nor their grams are written or moved
    assert not [path for path in written if "keyword-texts" in path or "gram" in path or "candidates" in path]
