"""A stored map, updated in parts, equals one made of all rows."""

import itertools
import random

import pytest

from vectorloom.operators import dictionary as dc
from vectorloom.operators import style_map as sm

STYLES = ["Kvass", " kvass", "Gose", "Lambic", "Altbier"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    # a third of all rows has one item, and positions repeat
    return [(7 if i % 3 == 0 else rng.randint(0, 40), rng.choice([*STYLES, None]), rng.randint(0, 9), rng.choice([1, 2, None])) for i in range(400)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, style string, o long, l int")


def last_by_hand(rows):
    best = {}
    for item, style, o, line in rows:
        if style is not None and line is not None:
            best[item] = max(best.get(item, (-1, 0, "")), (o, line, style))
    return {item: b[2] for item, b in best.items()}


def stored(spark, target):
    return {r["item_id"]: r["style"] for r in target.rows(spark).collect()}


def test_any_order_of_updates(spark, tmp_path, rows):
    parts = [rows[:130], rows[130:260], rows[260:]]
    for i, order in enumerate([*itertools.permutations(parts)][::5]):
        target = sm.create(spark, str(tmp_path / str(i)), frame(spark, rows), "id", ["o", "l"], buckets=8)
        for part in order:
            sm.upsert(target, frame(spark, part), "id", "style")
        assert stored(spark, target) == last_by_hand(rows)
        sm.upsert(target, frame(spark, order[0]), "id", "style")  # once more
        assert stored(spark, sm.open_map(spark, target.path)) == last_by_hand(rows)


def test_equals_the_map_of_all_rows(spark, tmp_path, rows):
    dictionary = dc.style_dictionary(frame(spark, [(i, s, i, 1) for i, s in enumerate(STYLES[:3])]), "style", ["o"])
    target = sm.create(spark, str(tmp_path / "m"), frame(spark, rows), "id", ["o", "l"])
    for part in (rows[200:], rows[:200]):
        sm.upsert(target, frame(spark, part), "id", "style")
    whole = dc.item_to_style(frame(spark, rows), "id", "style", ["o", "l"], dictionary)
    assert sorted(map(tuple, sm.item_styles(target, dictionary).select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))


def test_only_touched_buckets_are_rewritten(spark, tmp_path, rows):
    target = sm.create(spark, str(tmp_path / "m"), frame(spark, rows), "id", ["o", "l"], buckets=16)
    sm.upsert(target, frame(spark, rows), "id", "style")

    def files():
        return {p.parent.name: {f.name for f in p.parent.glob("*.parquet")} for p in (tmp_path / "m" / "items").glob("bucket=*/*.parquet")}

    before = files()
    touched = sm.upsert(target, frame(spark, [(7, "Gose", 50, 1), (7, "Kvass", 49, 1)]), "id", "style")
    after = files()
    assert len(touched) == 1
    assert {name for name in after if after[name] != before.get(name)} == {f"bucket={touched[0]}"}
    assert stored(spark, target)[7] == "Gose"
    assert sm.upsert(target, frame(spark, []), "id", "style") == [] and files() == after


def test_position_columns_may_not_hide_the_map(spark, tmp_path):
    df = spark.createDataFrame([], "id int, style string")
    with pytest.raises(ValueError, match="style"):
        sm.create(spark, str(tmp_path / "m"), df, "id", ["style"])
