import pytest

from vectorloom.operators.profile import fit_profile
from vectorloom.plans.spec import make_spec
from vectorloom.sources.delimited import read_delimited
from vectorloom.sources.vectors import read_labeled_dense, read_svmlight, write_plain_vectors, write_svmlight
from vectorloom.streaming.vectorize import vectorize_stream


def test_labeled_dense(spark):
    lines = spark.createDataFrame([("0,-1.25,0.5",), ("1,2,3,4",)], "value string")
    rows = read_labeled_dense(lines, 2).collect()
    assert (rows[0]["label"], rows[0]["features"]) == (0.0, [-1.25, 0.5])
    assert rows[1]["features"] == [2.0, 3.0]
    with pytest.raises(Exception, match="expected 3 fields, found 2"):
        read_labeled_dense(spark.createDataFrame([("1,2",)], "value string"), 2).collect()


def test_svmlight_round_trip(spark, tmp_path):
    df = spark.sql("""SELECT 2.0D AS label, array(named_struct('index', 2, 'value', 0.5D)) AS entries
        UNION ALL SELECT 1.0D, cast(array() AS array<struct<index: int, value: double>>)""")
    write_svmlight(df, str(tmp_path / "v"))
    rows = {r["label"]: r["features"] for r in read_svmlight(spark, str(tmp_path / "v"), 3).collect()}
    assert rows == {2.0: [0.0, 0.5, 0.0], 1.0: [0.0, 0.0, 0.0]}


def test_plain_lines(spark, tmp_path):
    df = spark.sql("SELECT array(1.5D, -2.0D) AS features, 1.0D AS label")
    write_plain_vectors(df, str(tmp_path / "v"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "v")).collect()] == ["1.5,-2.0,1.0"]


def test_stream_of_lines(spark, tmp_path):
    spec = make_spec("r", ",", ("x", "NUMERIC", "NORMALIZE"), ("c", "NOMINAL", "LABEL"))
    lines = spark.createDataFrame([(0, "0,a"), (1, "10,b")], "at int, value string")
    profile = fit_profile(read_delimited(lines, spec, keep=("at",)), spec, ["at"])
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("5,b\n\n10,new\n")
    out = vectorize_stream(spark.readStream.text(str(tmp_path / "in")), profile)
    query = (
        out.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    assert query.awaitTermination(60)
    rows = sorted((r["features"], r["label"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert rows == [([0.5], 1.0), ([1.0], -1.0)]
