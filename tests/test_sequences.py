import pytest
from pyspark.sql import functions as F

from vectorloom.functions import text as tx
from vectorloom.functions.vocab import DEFAULT, MINIMAL, Vocabulary
from vectorloom.operators import sequences as sq

TEXTS = ["aéb", "", "Hello, World!\n\tTab", "日本語", "~~a~~", "`=^[]{}\\|", "x" * 300, "emoji 😀 end", None]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, text string")


def kept(text, vocab=DEFAULT):
    return "".join(c for c in text if c in vocab.characters)


def test_vocabulary_sizes():
    assert (MINIMAL.stop, DEFAULT.stop) == (77, 96)
    assert len(set(DEFAULT.characters)) == 96 and DEFAULT.characters.startswith(MINIMAL.characters)


@pytest.mark.parametrize("vocab", [MINIMAL, DEFAULT, Vocabulary("ba", "~")])
def test_encode_decode(docs, vocab):
    c = F.col("text")
    rows = docs.select(
        "text",
        tx.charset_filter(c, vocab).alias("f"),
        tx.encode(c, vocab).alias("e"),
        tx.decode(tx.step_targets(tx.encode(c, vocab), vocab), vocab).alias("d"),
    ).collect()
    for r in rows:
        if r["text"] is None:
            assert r["f"] is r["e"] is r["d"] is None
            continue
        assert r["f"] == kept(r["text"], vocab)
        assert r["e"] == [vocab.characters.index(ch) for ch in r["f"]]
        assert r["d"] == r["f"] + vocab.stop_symbol


def test_pairs(docs):
    row = sq.next_char_pairs(docs, "text").filter("id = 0").first()
    assert (row["inputs"], row["targets"], row["n_steps"]) == ([96, 0, 1], [0, 1, 96], 3)
    cut = sq.next_char_pairs(docs, "text", max_len=2).filter("id = 0").first()
    assert (cut["inputs"], cut["targets"], cut["n_steps"]) == ([96, 0], [0, 1], 2)


def test_text_predicates(docs):
    rows = docs.select(
        "id",
        tx.nonempty_text(F.col("text")).alias("some"),
        tx.short_text_flag(F.col("text")).alias("short"),
        F.length(tx.truncate_text(F.col("text"))).alias("n"),
    ).collect()
    assert [r["id"] for r in rows if r["some"]] == [0, 2, 3, 4, 5, 6, 7]
    assert [r["id"] for r in rows if r["short"]] == [0, 1, 3, 4]
    assert max(r["n"] or 0 for r in rows) == 120


def test_context(spark):
    df = spark.createDataFrame([(2,), (-1,), (None,)], "k int")
    ratings = dict(zip(sq.RATINGS, (F.lit(float(r)) for r in (1, 2, 3, 4, 5))))
    rows = [r[0] for r in df.select(sq.context_vector(F.col("k"), 3, ratings)).collect()]
    assert rows[0] == [0.0, 0.0, 1.0, -1.0, -0.5, 0.0, 0.5, 1.0]
    assert rows[1][:3] == rows[2][:3] == [0.0, 0.0, 0.0]


def test_records(docs):
    ratings = {name: F.lit(3.0) for name in sq.RATINGS}
    steps = sq.sequence_record(docs.withColumn("style_index", F.lit(4)), ["id"], "text", ratings)
    rows = steps.filter("id = 0").orderBy("t").collect()
    assert [(r["t"], r["in_idx"], r["out_idx"], r["style_index"], r["ctx_taste"]) for r in rows] == [
        (0, 96, 0, 4, 0.0),
        (1, 0, 1, 4, 0.0),
        (2, 1, 96, 4, 0.0),
    ]
    assert steps.count() == sum(len(kept(t)) + 1 for t in TEXTS if t is not None)


@pytest.mark.parametrize("max_len", [0, 5])
def test_batches(docs, max_len):
    rows = sq.pad_and_mask(docs, ["id"], "text", 3, max_len=max_len).orderBy("id").collect()
    texts = [(i, t) for i, t in enumerate(TEXTS) if t]
    steps = [min(len(kept(t)) + 1, max_len or 10**9) for _, t in texts]
    assert [r["id"] for r in rows] == [i for i, _ in texts]
    for at, r in enumerate(rows):
        group = steps[at // 3 * 3 : at // 3 * 3 + 3]
        assert (r["batch_id"], r["row_in_batch"], r["batch_len"]) == (at // 3, at % 3, max(group))
        assert r["mask"] == [1] * steps[at] + [0] * (max(group) - steps[at])
        assert len(r["inputs"]) == len(r["targets"]) == max(group)
        assert r["targets"][steps[at] :] == [sq.PAD] * (max(group) - steps[at])


def test_whole_batches_only(spark):
    for n, expected in ((0, 0), (5, 3), (6, 6)):
        batches = sq.assign_minibatch(spark.range(n), ["id"], 3)
        assert sorted(r["id"] for r in sq.drop_remainder(batches, 3).collect()) == list(range(expected))


def test_texts_are_encoded_after_the_join(docs, no_broadcast):
    """No index array passes an exchange."""
    plan = sq.pad_and_mask(docs, ["id"], "text", 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "transform(" not in plan[plan.index("Join") :]


def test_training_batches(docs):
    ratings = {name: F.lit(float(i + 1)) for i, name in enumerate(sq.RATINGS)}
    reviews = docs.withColumn("style", F.lit(7))
    rows = sq.training_batches(reviews, ["id"], "text", "style", ratings, 3, max_len=4).orderBy("id").collect()
    assert [r["id"] for r in rows] == [i for i, t in enumerate(TEXTS) if t]
    assert {r["style_index"] for r in rows} == {7}
    assert [rows[0][f"ctx_{n}"] for n in sq.RATINGS] == [-1.0, -0.5, 0.0, 0.5, 1.0]
    assert all(len(r["inputs"]) == len(r["mask"]) == r["batch_len"] <= 4 for r in rows)


@pytest.mark.parametrize("top_k", [100_000, 1])
def test_limit(spark, top_k):
    df = spark.range(50).select((F.col("id") * 37 % 50).alias("id")).repartition(5)
    for n, expected in ((0, 50), (1, 1), (7, 7), (80, 50)):
        assert sorted(r["id"] for r in sq.limit_examples(df, "id", n, top_k).collect()) == list(range(expected))


@pytest.mark.parametrize("top_k_rows", [0, 100])
def test_rows_without_a_position_are_none_of_the_first(spark, top_k_rows):
    rows = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c"), (2, "d"), (3, "e"), (4, "f")], "at int, x string")
    assert sorted(r["x"] for r in sq.limit_examples(rows, "at", 3, top_k_rows).collect()) == ["c", "d", "e"]
    assert sq.limit_examples(rows.filter("at IS NULL"), "at", 3, top_k_rows).count() == 0
    assert sq.limit_examples(rows, "at", 0, top_k_rows).count() == 6
