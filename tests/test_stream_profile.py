"""A profile that grows batch by batch equals one of all rows."""

import random

import pytest

from vectorloom.operators.profile import fit_profile
from vectorloom.plans.spec import make_spec
from vectorloom.sources.delimited import read_delimited
from vectorloom.streaming import profile as sp

SPEC = make_spec("r", ",", ("x", "NUMERIC", "NORMALIZE"), ("c", "NOMINAL", "LABEL"), ("d", "NOMINAL", "COPY"), ("skipped", "NOMINAL", "SKIP"))


def rows_of(n):
    rng = random.Random(1)
    return [(i, rng.choice(["", "zz", str(rng.uniform(-1e3, 1e6))]), rng.choice("abcdefgh"[: 2 + i // 10]), rng.choice(["", "u", "v"]), "s") for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "at long, x string, c string, d string, skipped string")


def figures(profile):
    stats = {r["column_name"]: tuple(r)[4:] for r in profile.stats.collect()}
    return stats, sorted(map(tuple, profile.labels.rows.select("column_name", "label", "label_id", "n").collect()))


def same(a, b):
    (stats, labels), (others, other_labels) = a, b
    assert labels == other_labels and stats.keys() == others.keys()
    for name, values in stats.items():
        for one, other in zip(values, others[name], strict=True):
            assert one == (other if other is None else pytest.approx(other, rel=1e-9))


@pytest.mark.parametrize("merge_every", [2, 100])
def test_batches_add_up(spark, tmp_path, merge_every):
    rows = rows_of(60)
    store = sp.ProfileStore(spark, str(tmp_path / "p"), SPEC, ["at"], merge_every)
    for batch, start in enumerate(range(0, 60, 20)):
        store.add(frame(spark, rows[start : start + 20]), batch)
    whole = fit_profile(frame(spark, rows), SPEC, ["at"])
    store.merge()
    same(figures(store.profile()), figures(whole))


def test_a_replayed_or_broken_batch_counts_once(spark, tmp_path, monkeypatch):
    rows = rows_of(40)
    store = sp.ProfileStore(spark, str(tmp_path / "p"), SPEC, ["at"], merge_every=3)
    store.add(frame(spark, rows[:20]), 0)
    with monkeypatch.context() as broken:
        # the batch fails after its statistics are written
        broken.setattr(store, "_write", lambda kind, batch, stats, labels: stats.write.parquet(f"{store.path}/{kind}/{batch}/stats"))
        store.add(frame(spark, rows[20:30]), 1)
    same(figures(store.profile()), figures(fit_profile(frame(spark, rows[:20]), SPEC, ["at"])))
    for batch, part in ((1, rows[20:30]), (1, rows[20:30]), (2, rows[30:]), (0, rows[:20])):
        store.add(frame(spark, part), batch)
    again = sp.ProfileStore(spark, str(tmp_path / "p"), SPEC, ["at"])
    same(figures(again.profile()), figures(fit_profile(frame(spark, rows), SPEC, ["at"])))


def test_ids_stay_when_labels_are_added(spark, tmp_path):
    store = sp.ProfileStore(spark, str(tmp_path / "p"), SPEC, ["at"])
    store.add(frame(spark, [(5, "1", "b", "", ""), (6, "1", "a", "", "")]), 0)
    before = {r["label"]: r["label_id"] for r in store.profile().labels.of("c").collect()}
    # an earlier position in a later batch does not move what is there
    store.add(frame(spark, [(1, "1", "z", "", ""), (2, "1", "a", "", "")]), 1)
    after = {r["label"]: r["label_id"] for r in store.profile().labels.of("c").collect()}
    assert before == {"b": 0, "a": 1} and after == before | {"z": 2}


def test_another_spec_and_an_empty_store_are_errors(spark, tmp_path):
    store = sp.ProfileStore(spark, str(tmp_path / "p"), SPEC, ["at"])
    with pytest.raises(ValueError, match="no complete batch"):
        store.profile()
    with pytest.raises(ValueError, match="another spec"):
        sp.ProfileStore(spark, str(tmp_path / "p"), make_spec("r", ",", ("x", "NUMERIC", "COPY")), ["at"])


def test_stream_in_two_runs(spark, tmp_path):
    spec = make_spec("r", ",", ("x", "NUMERIC", "NORMALIZE"), ("c", "NOMINAL", "LABEL"))
    store = sp.ProfileStore(spark, str(tmp_path / "p"), spec, ["x"])
    (tmp_path / "in").mkdir()
    for name, text in (("1", "1,a\n2,b\n"), ("2", "3,a\n4,c\n")):
        (tmp_path / "in" / f"{name}.txt").write_text(text)
        rows = read_delimited(spark.readStream.text(str(tmp_path / "in")), spec)
        assert sp.profile_stream(rows, store, str(tmp_path / "state"), availableNow=True).awaitTermination(120)
    whole = read_delimited(spark.read.text(str(tmp_path / "in")), spec)
    same(figures(store.profile()), figures(fit_profile(whole, spec, ["x"])))
