"""Containers read in splits equal containers read whole."""

import json
import random

import pytest
from pyspark.sql import functions as F

from vectorloom.sources.json_docs import ITEM_FIELDS, REVIEW_FIELDS, read_containers, read_records
from vectorloom.sources.json_split import _pieces, container_texts

AWKWARD = ['a}b', '{"', '\\', '\\"}', "[{]}", "é日本", 'x\\\\"}', "}{}{", "\n\t", "", '","', ':{"r":[{']


def items(n, seed=0):
    rng = random.Random(seed)
    return [{"id": str(i), "name": "".join(rng.choices(AWKWARD, k=rng.randint(0, 4))), "brewer": rng.choice(AWKWARD)} for i in range(n)]


def read(spark, path, split=None, fields=ITEM_FIELDS):
    rows = read_records(spark, str(path), fields, split).orderBy("at").collect()
    return [{k: v for k, v in r.asDict().items() if v is not None} for r in rows]


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("form", ["array", "object"])
@pytest.mark.parametrize("split", [23, 1 << 20])
def test_any_split_gives_the_records(spark, tmp_path, form, indent, split):
    wanted = items(12)
    body = wanted if form == "array" else {f'k"{{{i}': x for i, x in enumerate(wanted)}
    text = json.dumps({'ro"ot}': body, "next": [{"id": "no"}], "more": {"x": {"id": "neither"}}}, indent=indent)
    (tmp_path / "c.json").write_text(text + "\n" * (split == 23))
    assert read(spark, tmp_path, split) == [{"at": i, **x} for i, x in enumerate(wanted)]


def test_nested_values_belong_to_their_record(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"r":[{"id":"1","x":{"y":{"z":1}},"name":"a"},{"x":[{},{}],"id":"2"}]}')
    assert read(spark, tmp_path, 5) == [{"at": 0, "id": "1", "name": "a"}, {"at": 1, "id": "2"}]


def test_many_files_and_an_empty_root(spark, tmp_path):
    for i, text in enumerate(['{"r":[{"id":"1"}]}', "{}", ' {\n}\n', '{"r":[]}', '{"r":{}, "s":[{"id":"3"}]}', '{"r":{"k":{"id":"2"}}}\n']):
        (tmp_path / f"{i}.json").write_text(text)
    assert sorted(x["id"] for x in read(spark, tmp_path)) == ["1", "2"]


def test_bad_containers_fail(spark, tmp_path):
    bad = [
        "not json", "[1]", '[{"text":"a"}]', '{"r": 5}', '{"r": [{"text":"a"', '{"r": [{"text":"cut"}]', '{"r":[{"rating_taste":"abc"}]}',
        '{"r":[{"text":"a"}{"text":"b"}]}', '{"r":[{"text":"a"},]}', '{"r":[5,{"text":"a"}]}', '{"r":[{"text":"a"},5]}', '{"r":[{"text":"a"}]}}',
        '{"r":[{"text":"a"}]} x', '{"r":[{"text":"a}]}', '{"r":[[{"text":"a"}]]}', '{"r":[{"text" "a"}]}', '{"r":5,"s":[{"text":"a"}]}',
    ]
    for i, text in enumerate(bad):
        folder = tmp_path / str(i)
        folder.mkdir()
        (folder / "c.json").write_text(text)
        with pytest.raises(Exception, match="bad container"):
            read(spark, folder, 3 if i % 2 else None, REVIEW_FIELDS)


def test_no_task_reads_a_file_whole(spark, tmp_path):
    text = json.dumps({"r": items(2_000)})
    (tmp_path / "c.json").write_text(text)
    pieces = _pieces(spark, str(tmp_path), len(text) // 40)
    assert pieces.select("block").distinct().count() >= 30
    assert pieces.select("piece", "block").groupBy("block").agg(F.sum(F.octet_length("piece")).alias("n")).agg(F.max("n")).first()[0] < len(text) / 10
    assert container_texts(spark, str(tmp_path), len(text) // 40).count() == 2_000


def test_compressed_files(spark, tmp_path):
    wanted = items(30)
    read_containers(spark, str(tmp_path))  # whole files are still read by the other reader
    rows = spark.createDataFrame([(json.dumps({"r": wanted}),)], "value string")
    rows.coalesce(1).write.option("compression", "gzip").text(str(tmp_path / "z"))
    assert read(spark, tmp_path / "z", 16) == [{"at": i, **x} for i, x in enumerate(wanted)]
