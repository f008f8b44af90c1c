"""Eight styles, one without a bucket and one spelled twice."""

import json

import pytest
from pyspark.sql import functions as F

from vectorloom.operators import dictionary as dc
from vectorloom.sources.json_docs import (
    REVIEW_FIELDS,
    bad_containers,
    container_records,
    read_dictionary_json,
    read_reviews_json,
)

STYLES = [
    (1, "American Pale Ale"),
    (2, "American Stout"),
    (3, "Pale Lager"),
    (4, "Vienna Lager"),
    (5, "American IPA"),
    (6, "Baltic Porter"),
    (7, "Kvass"),
    (8, " american STOUT "),
]


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(i, s, i) for i, s in STYLES], "id int, style string, at int").repartition(3)


def index_of(dictionary):
    return {r["style_key"]: r["style_index"] for r in dictionary.collect()}


def test_full_dictionary(items):
    rows = {r["style_key"]: r for r in dc.style_dictionary(items, "style", ["at"]).collect()}
    assert {k: r["style_index"] for k, r in rows.items()} == {
        "american pale ale": 0, "american stout": 1, "pale lager": 2, "vienna lager": 3,
        "american ipa": 4, "baltic porter": 5, "kvass": 6,
    }
    assert (rows["american stout"]["n"], rows["american stout"]["style"]) == (2, "American Stout")


def test_buckets(items):
    found = {r["id"]: r["b"] for r in items.select("id", dc.grouped_style(F.col("style")).alias("b")).collect()}
    assert found == {1: "ale", 2: "stout", 3: "ale", 4: "lager", 5: "ipa", 6: "porter", 7: None, 8: "stout"}
    assert index_of(dc.grouped_style_dictionary(items, "style", ["at"])) == {
        "ale": 0, "stout": 1, "lager": 2, "ipa": 3, "porter": 4,
    }
    assert dc.filtered_count(items, "style").first()["n_filtered"] == 1


def test_statistics(items):
    rows = dc.style_statistics(dc.grouped_style_dictionary(items, "style", ["at"])).collect()
    assert {r["total_styles"] for r in rows} == {5} and sum(r["n"] for r in rows) == 7


def test_lookup_by_name(spark, items):
    asked = spark.createDataFrame([("foo",), ("Stout",), (" Kvass",), (None,)], "s string")

    def found(dictionary):
        return {r["s"]: r["style_index"] for r in dc.lookup_style_index(asked, "s", dictionary).collect()}

    grouped = found(dc.grouped_style_dictionary(items, "style", ["at"]))
    assert grouped == {"foo": -1, "Stout": 1, " Kvass": -1, None: -1}
    assert found(dc.style_dictionary(items, "style", ["at"]))[" Kvass"] == 6


@pytest.mark.parametrize("broadcast", [True, False])
def test_reviews(spark, items, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    twice = items.unionByName(spark.createDataFrame([(4, "Kvass", 9), (5, "Gose", 0)], items.schema))
    full = dc.item_to_style(twice, "id", "style", ["at"], dc.style_dictionary(items, "style", ["at"]))
    assert {r["item_id"]: (r["style_index"], r["style"]) for r in full.collect()}[4] == (6, "Kvass")
    grouped = dc.item_to_style(
        twice, "id", "style", ["at"], dc.grouped_style_dictionary(items, "style", ["at"]), dc.grouped_style(F.col("style"))
    )
    # an entry without a bucket does not replace an earlier one with a bucket
    assert {r["item_id"]: r["style"] for r in grouped.collect()}[4] == "Vienna Lager"

    reviews = spark.createDataFrame([(1, "a"), (1, ""), (7, "b"), (99, "c"), (None, "d")], "id int, text string")
    by_index = dc.join_style_index(reviews, "id", grouped).select("id", "text", "style_index").collect()
    assert sorted(map(tuple, by_index), key=str) == [(1, "", 0), (1, "a", 0), (7, "b", -1), (99, "c", -1), (None, "d", -1)]
    by_text = {r["text"]: r["style"] for r in dc.join_style_text(reviews, "id", full).collect()}
    assert by_text == {"a": "American Pale Ale", "": "American Pale Ale", "b": "Kvass", "c": None, "d": None}
    assert [r["text"] for r in dc.with_known_style(reviews, "id", "text", grouped).collect()] == ["a"]
    assert sorted(r["text"] for r in dc.with_unknown_style(reviews, "id", grouped).collect()) == ["b", "c", "d"]


def test_json_containers(spark, tmp_path):
    item = {"id": 7, "name": "N", "style": "Kvass", "abv": None, "brewer": 3}
    (tmp_path / "items").mkdir()
    (tmp_path / "items" / "a.json").write_text(json.dumps({"beers": {"7": item, "8": {"id": 8, "abv": 5.5}}, "n": 2}, indent=1))
    rows = {r["id"]: r for r in read_dictionary_json(spark, str(tmp_path / "items")).collect()}
    assert (rows["7"]["style"], rows["7"]["abv"], rows["7"]["brewer"], rows["7"]["at"]) == ("Kvass", None, "3", 0)
    assert (rows["8"]["abv"], rows["8"]["name"], rows["8"]["at"]) == ("5.5", None, 1)

    review = {"text": "fine\nbeer", "rating_taste": 4.5, "beer_id": "7"}
    for name, body in (("object", {"0": review, "1": {"user": "u"}}), ("array", [review, {"user": "u"}])):
        (tmp_path / f"{name}.json").write_text(json.dumps({"reviews": body}))
        first, second = read_reviews_json(spark, str(tmp_path / f"{name}.json")).orderBy("at").collect()
        assert (first["text"], first["rating_taste"], first["rating_aroma"], first["beer_id"]) == ("fine\nbeer", 4.5, 0.0, "7")
        assert (second["text"], second["user"], second["beer_id"]) == ("", "u", "0")


def test_last_item_by_several_columns(spark):
    """Positions near 2^62 and line numbers of two digits; a tie goes to the last style in the alphabet."""
    top = 1 << 62
    rows = [(1, "Kvass", top, 2), (1, "Gose", top, 12), (2, "Gose", 5, 1), (2, "Kvass", 5, 1), (3, "Gose", -top, 9)]
    styles = spark.createDataFrame([(1, "Gose", 1), (2, "Kvass", 2)], "id int, style string, at int")
    dictionary = dc.style_dictionary(styles, "style", ["at"])
    for kinds in ("o long, l int", "o long, l long"):
        items = spark.createDataFrame(rows, f"id int, style string, {kinds}")
        found = dc.item_to_style(items, "id", "style", ["o", "l"], dictionary)
        assert {r["item_id"]: (r["style"], r["style_index"]) for r in found.collect()} == {
            1: ("Gose", 0), 2: ("Kvass", 1), 3: ("Gose", 0),
        }
        if kinds == "o long, l int":
            assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_bad_containers(spark):
    good = ['{"r": [{"text":"a","rating_overall":1.5}]}', '{"r": {"x": {"text":"b"}}}', "{}", '{"r": []}', None]
    bad = ["", "not json", "[1]", '{"r": 5}', '{"r": [{"text":"a"', '{"r": [{"text":"cut"}]', '{"r":[{"rating_taste":"abc"}]}']
    rows = spark.createDataFrame([(t,) for t in good + bad], "value string")
    assert sorted(r.value for r in bad_containers(rows, REVIEW_FIELDS).collect()) == sorted(bad)
    readable = container_records(rows.filter(F.col("value").isin(good[:4])), REVIEW_FIELDS)
    assert sorted(r.text for r in readable.collect()) == ["a", "b"]
    for text in bad:
        with pytest.raises(Exception, match="bad container"):
            container_records(spark.createDataFrame([(text,)], "value string"), REVIEW_FIELDS).collect()
