"""Profile and apply on twelve boards; values computed by hand."""

import statistics

import pytest
from pyspark.sql import functions as F

from vectorloom.operators import profile as pr
from vectorloom.operators.vectorize import (
    apply_profile,
    assemble_plain,
    assemble_sparse,
    sparse_indices,
    unseen_label_audit,
    vectorize,
)
from vectorloom.plans.spec import Kind, Transform, load_spec, make_spec
from vectorloom.sources.delimited import bad_records, map_values_to_columns, read_delimited
from vectorloom.sources.profile_store import (
    import_labels_text,
    import_stats_text,
    load_profile,
    profile_from_text,
    save_profile,
)
from vectorloom.sources.vectors import plain_line, read_plain_vectors, svmlight_line, write_plain_vectors, write_svmlight

# thickness, length, moisture, density and wood of twelve boards
BOARDS = """22.5,180,11.5,0.44,pine
18.0,240,14.0,0.47,pine
24.5,120,9.0,0.42,pine
30.0,200,12.5,0.71,oak
27.0,210,10.0,0.68,oak
33.5,150,13.0,0.74,oak
16.0,300,8.5,0.66,oak
28.5,175,15.5,0.70,oak
12.0,90,19.0,0.62,birch
14.5,130,16.0,0.60,birch
21.0,160,17.5,0.64,birch
19.5,110,18.0,0.57,birch""".splitlines()
SPEC_TEXT = """
# a comment
@relation boards
@delimiter ,

@attribute thickness   numeric  !copy
@attribute length    numeric  !skip
@attribute moisture   numeric  !normalize
@ATTRIBUTE density	NUMERIC !BINARIZE
@attribute wood nominal !label
"""
SPEC = load_spec(SPEC_TEXT)
# by hand: moisture runs from 8.5 to 19, the middle of the densities 0.42 to 0.74 is 0.58
EXPECTED = [
    (22.5, 3.0 / 10.5, 0.0, 0.0),
    (18.0, 5.5 / 10.5, 0.0, 0.0),
    (24.5, 0.5 / 10.5, 0.0, 0.0),
    (30.0, 4.0 / 10.5, 1.0, 1.0),
    (27.0, 1.5 / 10.5, 1.0, 1.0),
    (33.5, 4.5 / 10.5, 1.0, 1.0),
    (16.0, 0.0, 1.0, 1.0),
    (28.5, 7.0 / 10.5, 1.0, 1.0),
    (12.0, 1.0, 1.0, 2.0),
    (14.5, 7.5 / 10.5, 1.0, 2.0),
    (21.0, 9.0 / 10.5, 1.0, 2.0),
    (19.5, 9.5 / 10.5, 0.0, 2.0),
]


def lines(spark, rows=BOARDS, start=0):
    return spark.createDataFrame([(start + i, v) for i, v in enumerate(rows)], "at bigint, value string")


def parsed(spark, rows=BOARDS, spec=SPEC, start=0):
    return read_delimited(lines(spark, rows, start), spec, keep=("at",))


def labels_of(table):
    return {(r["column_name"], r["label"]): (r["label_id"], r["n"]) for r in table.collect()}


def test_spec_text():
    assert SPEC.relation == "boards"
    assert [c.transform for c in SPEC.columns][1:3] == [Transform.SKIP, Transform.NORMALIZE]
    assert SPEC.columns[4].kind is Kind.NOMINAL
    assert len(SPEC.emitted) == 4


@pytest.mark.parametrize(
    "text",
    [
        "@attribute a nominal !binarize",
        "@attribute a date !copy",
        "@attribute a numeric copy",
        "@attribute a numeric",
        "@unknown a",
        "@attribute a numeric !copy\n@attribute a numeric !copy",
    ],
)
def test_bad_spec_text(text):
    with pytest.raises(ValueError):
        load_spec(text)


def test_statistics(spark):
    stats = {r["column_name"]: r for r in pr.column_stats(parsed(spark), SPEC).collect()}
    thickness, by_hand = stats["thickness"], [float(line.split(",")[0]) for line in BOARDS]
    assert (thickness["n"], thickness["n_invalid"], thickness["min"], thickness["max"]) == (12, 0, 12.0, 33.5)
    assert thickness["sum"] == pytest.approx(267.0)
    assert thickness["avg"] == pytest.approx(22.25)
    assert thickness["variance"] == pytest.approx(statistics.pvariance(by_hand))
    assert thickness["stddev"] == pytest.approx(statistics.pstdev(by_hand))
    assert stats["length"]["sum"] == pytest.approx(2065.0)


def test_statistics_by_list(spark):
    row = pr.column_stats(parsed(spark), SPEC, ("n", "max")).filter("column_name = 'moisture'").first()
    assert (row["n"], row["max"], row["min"], row["variance"]) == (12, 19.0, None, None)
    plan = pr.invalid_entry_count(parsed(spark), SPEC)._jdf.queryExecution().optimizedPlan().toString()
    assert "var_pop" not in plan and "min(" not in plan


@pytest.mark.parametrize("costly", [False, True])
def test_vectorize(spark, costly):
    out = vectorize(parsed(spark), SPEC, ["at"], keep=("at",), costly=costly).orderBy("at").collect()
    for row, expected in zip(out, EXPECTED, strict=True):
        assert [*row["features"], row["label"]] == pytest.approx(expected, abs=1e-9)


def test_merge_equals_whole(spark):
    first, second = parsed(spark, BOARDS[:6]), parsed(spark, BOARDS[6:], start=6)
    parts = [pr.fit_profile(p, SPEC, ["at"]) for p in (first, second)]
    assert parts[1].n_labels("wood") == 2
    merged, whole = pr.merge_profiles(parts), pr.fit_profile(parsed(spark), SPEC, ["at"])
    assert labels_of(merged.labels.rows) == labels_of(whole.labels.rows)
    for a, b in zip(merged.stats.orderBy("ordinal").collect(), whole.stats.orderBy("ordinal").collect(), strict=True):
        for name in pr.STATS_SCHEMA.names:
            expected = pytest.approx(b[name]) if isinstance(b[name], float) else b[name]
            assert a[name] == expected, name


def test_labels_do_not_depend_on_partitions(spark):
    expected = {("wood", "pine"): (0, 3), ("wood", "oak"): (1, 5), ("wood", "birch"): (2, 4)}
    for df in (parsed(spark).repartition(7), parsed(spark).orderBy(F.desc("at")).coalesce(1)):
        assert labels_of(pr.label_dictionary(df, SPEC, ["at"])) == expected


def test_first_seen_order_not_alphabetical(spark):
    df = spark.createDataFrame([(3, "a"), (1, " z "), (2, '"m"'), (4, "z"), (5, ""), (6, None)], "at int, c string")
    spec = make_spec("r", ",", ("c", "NOMINAL", "COPY"))
    found = labels_of(pr.label_dictionary(df, spec, ["at"]))
    assert found == {("c", "z"): (0, 2), ("c", "m"): (1, 1), ("c", "a"): (2, 1)}


def test_large_dictionary_takes_the_shuffled_join(spark, no_broadcast):
    rows = [(i, "hot" if i % 3 else f"v{i}") for i in range(3000)]
    df = spark.createDataFrame([*rows, (3000, None)], "at bigint, c string")
    spec = make_spec("r", ",", ("c", "NOMINAL", "UNIQUE_ID"))
    out = apply_profile(df, pr.fit_profile(df, spec, ["at"]), keep=("at",))
    ids, seen = {}, []
    for _, c in rows:
        ids.setdefault(c, len(ids))
    seen = {r["at"]: r["c"] for r in out.collect()}
    assert seen == {**{at: float(ids[c]) for at, c in rows}, 3000: None}


def test_two_large_dictionaries(spark, no_broadcast):
    rows = [(i, f"a{i % 700}" if i % 2 else "a", f"b{i % 900}" if i % 3 else "b") for i in range(2000)]
    df = spark.createDataFrame(rows, "at bigint, a string, b string")
    spec = make_spec("r", ",", ("a", "NOMINAL", "COPY"), ("b", "NOMINAL", "NORMALIZE"))
    out = apply_profile(df, pr.fit_profile(df, spec, ["at"]), keep=("at",))
    a_ids, b_ids = {}, {}
    for _, a, b in rows:
        a_ids.setdefault(a, len(a_ids))
        b_ids.setdefault(b, len(b_ids))
    got = {r["at"]: (r["a"], r["b"]) for r in out.collect()}
    assert got == {at: (float(a_ids[a]), (b_ids[b] + 1) / len(b_ids)) for at, a, b in rows}


def test_constant_column(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "at int, x double")
    for transform, expected in (("NORMALIZE", 0.0), ("BINARIZE", 1.0), ("ZEROMEAN_ZEROUNITVARIANCE", 0.0)):
        spec = make_spec("r", ",", ("x", "NUMERIC", transform))
        out = apply_profile(df, pr.fit_profile(df, spec, ["at"]))
        assert [r["x"] for r in out.collect()] == [expected, expected]


def test_nulls_stay_null(spark):
    df = spark.createDataFrame([(1, "1"), (2, None), (3, "NaN"), (4, "x"), (5, "3")], "at int, x string")
    for transform in ("COPY", "NORMALIZE", "BINARIZE", "ZEROMEAN_ZEROUNITVARIANCE"):
        spec = make_spec("r", ",", ("x", "NUMERIC", transform))
        profile = pr.fit_profile(df, spec, ["at"])
        values = [r["x"] for r in apply_profile(df, profile, keep=("at",)).orderBy("at").collect()]
        assert values[1:4] == [None] * 3 and values[0] < values[4]
    counts = pr.invalid_entry_count(df, make_spec("r", ",", ("x", "NUMERIC", "COPY"))).first()
    assert (counts["n"], counts["n_invalid"]) == (2, 2)


@pytest.mark.parametrize("policy, expected", [("null", None), ("minus_one", -1.0)])
def test_unseen_label(spark, policy, expected):
    spec = make_spec("r", ",", ("c", "NOMINAL", "COPY"))
    known = spark.createDataFrame([(1, "a"), (2, "b")], "at int, c string")
    new = spark.createDataFrame([(1, "b"), (2, "x"), (3, "x"), (4, None)], "at int, c string")
    profile = pr.fit_profile(known, spec, ["at"])
    out = {r["at"]: r["c"] for r in apply_profile(new, profile, policy, keep=("at",)).collect()}
    assert out == {1: 1.0, 2: expected, 3: expected, 4: None}
    audit = unseen_label_audit(new, profile).first()
    assert (audit["n_values"], audit["n_missed"], audit["n_missed_labels"]) == (3, 2, 1)
    with pytest.raises(Exception, match="unseen label in c: x"):
        apply_profile(new, profile).collect()


def test_sparse_forms(spark):
    spec = make_spec(
        "r", ",", ("a", "NUMERIC", "COPY"), ("y", "NUMERIC", "LABEL"), ("s", "NUMERIC", "SKIP"), ("b", "NUMERIC", "COPY")
    )
    assert sparse_indices(spec) == [1, 2] and sparse_indices(spec, compat=True) == [1, 3]
    df = spark.createDataFrame([(-2.0, 1.0, 9.0, 3.0), (0.0, 0.0, 9.0, 0.5)], "a double, y double, s double, b double")
    out = apply_profile(df, pr.fit_profile(df.withColumn("at", F.lit(0)), spec, ["at"]))

    def written(compat):
        sparse = assemble_sparse(out, spec, compat)
        return sorted(r[0] for r in sparse.select(svmlight_line(F.col("label"), F.col("entries"))).collect())

    assert written(False) == ["0.0 2:0.5", "1.0 1:-2.0 2:3.0"]
    assert written(True) == ["0.0 3:0.5", "1.0 3:3.0"]
    plain = assemble_plain(out, spec).select(plain_line(F.col("features"), F.col("label")).alias("v"))
    assert sorted(r["v"] for r in plain.collect()) == ["-2.0,3.0,1.0", "0.0,0.5,0.0"]


def test_delimited_edge_cases(spark):
    spec = make_spec("r", r"\|", ("a", "NUMERIC", "COPY"), ("b", "NOMINAL", "COPY"), ("c", "NOMINAL", "COPY"))
    rows = lines(spark, ["1|x|y", " |x|y", "2||", "", '"3"|" q "|z'])
    found = {r["at"]: (r["a"], r["b"], r["c"]) for r in read_delimited(rows, spec, keep=("at",)).collect()}
    assert found == {0: ("1", "x", "y"), 2: ("2", None, None), 4: ('"3"', '" q "', "z")}
    bad = bad_records(rows, spec, java_split=True).collect()
    assert [(r["at"], r["n_fields"]) for r in bad] == [(2, 1)]
    with pytest.raises(Exception, match="expected 3 fields, found 1"):
        read_delimited(rows, spec, java_split=True).collect()
    pairs = map_values_to_columns(lines(spark, ["1|x", "2|x|y|extra"]), spec, keep=("at",)).collect()
    assert sorted(tuple(r) for r in pairs) == [
        (0, "a", "1"), (0, "b", "x"), (1, "a", "2"), (1, "b", "x"), (1, "c", "y"),
    ]


def test_saved_profile_gives_the_same_vectors(spark, tmp_path):
    profile = pr.fit_profile(parsed(spark), SPEC, ["at"])
    save_profile(profile, str(tmp_path / "p"))
    loaded = load_profile(spark, str(tmp_path / "p"), SPEC)
    a, b = (apply_profile(parsed(spark), p, keep=("at",)).orderBy("at").collect() for p in (profile, loaded))
    assert a == b


def test_import_of_text_profiles(spark):
    stats = lines(spark, ["p.q.minimum.moisture=8.5", "", " p.q.maximum.moisture=19.0", "p.q.count.x="])
    assert sorted((tuple(r) for r in import_stats_text(stats, "p.q").collect()), key=str) == [
        ("moisture", "maximum", 19.0),
        ("moisture", "minimum", 8.5),
        ("x", "count", None),
    ]
    labels = import_labels_text(lines(spark, ["0, pine ,3", "", "1,oak,5"]))
    assert [tuple(r) for r in labels.collect()] == [("pine", 0, 3), ("oak", 1, 5)]


def test_balance_shares_sum_to_one(spark):
    profile = pr.fit_profile(parsed(spark), SPEC, ["at"])
    rows = pr.class_balance(profile).collect()
    assert sum(r["share"] for r in rows) == pytest.approx(1.0)
    assert {r["total_labels"] for r in rows} == {r["values_seen"] for r in rows} == {12}
    assert pr.category_balance(profile).count() == 0


def test_spec_round_trip():
    assert load_spec(SPEC.to_text()) == SPEC


def test_profile_refuses_another_spec(spark, tmp_path):
    save_profile(pr.fit_profile(parsed(spark), SPEC, ["at"]), str(tmp_path / "p"))
    assert load_profile(spark, str(tmp_path / "p")).spec == SPEC
    other = make_spec("boards", ",", ("thickness", "NUMERIC", "NORMALIZE"))
    with pytest.raises(ValueError, match="another spec"):
        load_profile(spark, str(tmp_path / "p"), other)


@pytest.mark.parametrize("line", ["garbage", "p=2", "p.q.minimum.moisture=low", "x.q.minimum.moisture=1"])
def test_junk_statistics_lines(spark, line):
    with pytest.raises(Exception, match="not a statistics line"):
        import_stats_text(lines(spark, ["p.q.maximum.moisture=1", line]), "p.q").collect()


def test_label_lines(spark):
    got = import_labels_text(lines(spark, ["7, a, b ,1"])).first()
    assert (got["label"], got["label_id"], got["n"]) == ("a, b", 7, 1)
    for line in ("pine", "x,pine,3", "1,pine", "1,pine,many"):
        with pytest.raises(Exception, match="not a label line"):
            import_labels_text(lines(spark, [line])).collect()


def test_profile_from_text(spark):
    """Imported text gives the vectors that the profile it came from gives."""
    profile = pr.fit_profile(parsed(spark), SPEC, ["at"])
    long = [
        (r["column_name"], name, float(r[name]))
        for r in profile.stats.filter("kind = 'NUMERIC'").collect()
        for name in ("n", "min", "max", "avg", "stddev")
    ]
    stats = spark.createDataFrame(long, "column_name string, statistic string, value double")
    made = profile_from_text(SPEC, stats, profile.labels.rows)
    a, b = (apply_profile(parsed(spark), p, keep=("at",)).orderBy("at").collect() for p in (profile, made))
    assert a == b
    with pytest.raises(ValueError, match="no statistics"):
        profile_from_text(SPEC, stats.filter("column_name <> 'moisture'"), profile.labels.rows)


def test_skipped_labels_only_when_asked(spark):
    df = spark.createDataFrame([(i, f"t{i}", "c") for i in range(50)], "at int, text string, c string")
    spec = make_spec("r", ",", ("text", "NOMINAL", "SKIP"), ("c", "NOMINAL", "COPY"))
    assert set(pr.fit_profile(df, spec, ["at"]).labels.sizes) == {"c"}
    assert pr.fit_profile(df, spec, ["at"], skipped_labels=True).n_labels("text") == 50


def test_positions_beyond_one_integer(spark):
    """Order columns near the ends of their types, ties in the first, and line numbers of two digits."""
    top = 1 << 62
    rows = [(top, 12, "c"), (top, 2, "b"), (-top, 9, "a"), (top - 1, 1, "d"), (top, 100, "b")]
    for kinds in ("k long, l int", "k long, l long"):
        df = spark.createDataFrame(rows, f"{kinds}, c string").repartition(3)
        spec = make_spec("r", ",", ("c", "NOMINAL", "COPY"))
        found = labels_of(pr.label_dictionary(df, spec, ["k", "l"]))
        assert {c: i for (_, c), (i, _) in found.items()} == {"a": 0, "d": 1, "b": 2, "c": 3}


def test_null_features_and_labels_in_text(spark, tmp_path):
    df = spark.sql("""SELECT array(3.0D, NULL) AS features, 1.0D AS label
        UNION ALL SELECT array(NULL, NULL), 0.0D UNION ALL SELECT array(5.0D, 6.0D), NULL""")
    write_plain_vectors(df, str(tmp_path / "a"), missing_label="empty")
    back = read_plain_vectors(spark.read.text(str(tmp_path / "a")), 2)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    for i, write in enumerate((write_plain_vectors, lambda d, p: write_svmlight(d.withColumn("entries", F.expr(ENTRIES)), p))):
        with pytest.raises(Exception, match="a row has no label"):
            write(df, str(tmp_path / f"b{i}"))
    write_svmlight(df.withColumn("entries", F.expr(ENTRIES)), str(tmp_path / "c"), missing_label="drop")
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "c")).collect()) == ["0.0", "1.0 1:3.0"]
    with pytest.raises(ValueError):
        write_svmlight(df, str(tmp_path / "d"), missing_label="empty")


ENTRIES = "transform(features, (x, i) -> named_struct('index', i + 1, 'value', x))"


def test_hot_unseen_labels_are_not_shuffled(spark, no_broadcast):
    """Half of the new rows carry a label that the profile lacks: they meet no exchange."""
    known = spark.range(1000).selectExpr("id AS at", "concat('k', id) AS c")
    new = spark.range(1000).selectExpr("id AS at", "if(id < 500, 'new', concat('k', id)) AS c")
    spec = make_spec("r", ",", ("c", "NOMINAL", "COPY"))
    out = apply_profile(new, pr.fit_profile(known, spec, ["at"]), "minus_one", keep=("at",))
    assert out.filter("c = -1").count() == 500
    moved = []

    def walk(node):
        if node.nodeName() == "Exchange":
            moved.append(node.metrics().apply("shuffleRecordsWritten").value())
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif hasattr(node, "plan") and "QueryStage" in node.nodeName():
            walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    plan = out._jdf.queryExecution().executedPlan()
    out._jdf.queryExecution().toRdd().count()
    walk(plan)
    assert moved and max(moved) <= 1000 and sum(moved) <= 1500 + 1


def test_broadcast_dictionaries_share_one_threshold(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    rows = [(i, f"a{i % 50}", f"b{i % 50}") for i in range(200)]
    df = spark.createDataFrame(rows, "at bigint, a string, b string")
    spec = make_spec("r", ",", ("a", "NOMINAL", "COPY"), ("b", "NOMINAL", "COPY"))
    profile = pr.fit_profile(df, spec, ["at"])
    one = profile.labels.sizes["a"].bytes
    spark.conf.set(key, str(int(one * 1.5)))
    try:
        out = apply_profile(df, profile, keep=("at",))
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        got = {r["at"]: (r["a"], r["b"]) for r in out.collect()}
    finally:
        spark.conf.set(key, before)
    assert got == {i: (float(i % 50), float(i % 50)) for i, _, _ in rows}
    assert "Union" in plan
