"""Quality rules and quality classifier: exact counts, exact decoding, and accuracy on the labelled tables."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from vectorloom.llm import quality_classifier as c
from vectorloom.llm import quality_rules as q
from vectorloom.llm.statistics import statistics
from vectorloom.llm.textops import text_passes

SF_DIR = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    found = WORD.findall(text)
    windows = list(zip(found, found[1:], found[2:]))
    often, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered |= {i, i + 1, i + 2}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def test_statistics_against_a_loop():
    rng = random.Random(9)
    signs = ["a", "b", "é", " ", "  ", "\n", "\n\n", "#", "| ", "x y z ", "日", "\x0b", "A!", "3", "\x00"]
    texts = [None, "", "\n", " ", *["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(500)]]
    for first, data, offsets in text_passes(pa.array(texts), 700):
        rows = statistics(data, offsets).rows
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        for i in range(len(offsets) - 1):
            assert tuple(int(rows[n][i]) for n in names) == counts(texts[first + i] or ""), repr(texts[first + i])


def test_viterbi_against_all_labellings():
    rng = np.random.default_rng(1)
    for _ in range(30):
        lengths = rng.integers(1, 7, 5)
        row = np.repeat(np.arange(5), lengths)
        features = rng.normal(size=(len(row), len(q.FEATURES)))
        model = q.LineField(rng.normal(size=len(q.FEATURES)), rng.normal(size=(2, 2)))
        got, emission = q.viterbi(model, features, row), model.emissions(features)
        for r in range(5):
            lines = np.flatnonzero(row == r)

            def score(labels):
                steps = sum(model.transitions[a, b] for a, b in zip(labels, labels[1:]))
                return steps + sum(emission[i, y] for i, y in zip(lines, labels))

            best = max(itertools.product((0, 1), repeat=len(lines)), key=score)
            assert np.isclose(score(best), score(got[lines].tolist()))


def test_field_learns():
    rng = np.random.default_rng(2)
    row = np.repeat(np.arange(200), 5)
    labels = np.repeat(rng.integers(0, 2, 200), 5)
    features = np.zeros((1000, len(q.FEATURES)))
    features[:, 0] = 1
    features[:, 5] = rng.random(1000) < np.where(labels == 1, 0.7, 0.2)
    model = q.fit_field(features, row, labels)
    assert (q.viterbi(model, features, row) == labels).mean() > 0.9
    assert model.transitions[0, 0] > model.transitions[0, 1]
    assert (q.fit_field(features[:0], row[:0], labels[:0]).weights == q.LineField().weights).all()


def test_rules_on_awkward_rows(awkward, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = q.train_field(awkward, none, "doc_id", "text", "quality")
    got = q.judge_lines(awkward, model).collect()
    assert len(got) == 13
    long = next(r for r in got if r.doc_id == 6)
    assert long.n_words == 60_000
    assert all(r.base_failed and not r.kept for r in got if r.n_words < 50)
    assert q.judge_lines(awkward.filter("doc_id > 99"), model).collect() == []


def test_rules_keep_good_texts(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    held_out = labels.filter("doc_id % 2 = 1").toPandas().set_index("doc_id").quality
    model = q.train_field(docs, labels.filter("doc_id % 2 = 0"), "doc_id", "text", "quality")
    got = q.judge_lines(docs, model).filter("NOT base_failed").toPandas().set_index("doc_id").kept
    both = got.to_frame().join(held_out, how="inner")
    assert both[both.quality == 1].kept.mean() > 0.98 and both[both.quality == 0].kept.mean() < 0.1


def test_expectation_maximisation_recovers_accuracies():
    rng = np.random.default_rng(3)
    n, bad = 40_000, None
    bad = rng.random(n) < 0.2
    right = np.linspace(0.7, 0.95, len(c.VOTERS))
    votes = np.where(rng.random((n, len(right))) < right, bad[:, None], ~bad[:, None]).astype(int)
    votes[rng.random(votes.shape) < 0.3] = c.SILENT
    patterns, number = np.unique((votes * 3 ** np.arange(len(right))).sum(axis=1), return_counts=True)
    model = c.fit_label_model(patterns, number)
    assert abs(model.prior - 0.2) < 0.03
    assert np.allclose(list(model.accuracies().values()), right, atol=0.03)


def test_classifier_on_labelled_texts(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    both = c.classify_quality(docs).join(labels, "doc_id").toPandas()
    assert both[both.quality == 1].keep.mean() > 0.99 and both[both.quality == 0].keep.mean() < 0.02


def test_classifier_on_awkward_rows(awkward):
    got = c.classify_quality(awkward).collect()
    assert len(got) == 13 and {r.score for r in got if r.doc_id in (1, 2, 3)} == {0.0}
    labels, scorer = c.train_classifier(awkward)
    assert c.keep_good(awkward, scorer).columns == awkward.columns
    empty = awkward.filter("doc_id > 99")
    assert c.classify_quality(empty).collect() == []
    assert c.keep_good(empty, scorer).collect() == []


def test_repeated_keys_keep_the_bound(spark, make_docs, monkeypatch):
    """However often a key comes, at most the limit of documents reaches the driver, each key once."""
    docs = make_docs(*[(1, f"text {i % 7} of one key") for i in range(200)], *[(i, f"another text {i}") for i in range(2, 9)])
    fitted, fit_scorer, fit_field = [], c.fit_scorer, q.fit_field
    monkeypatch.setattr(c, "fit_scorer", lambda *a: fitted.append(len(a[3])) or fit_scorer(*a))
    c.train_classifier(docs, training_docs=100)
    c.train_classifier(docs, training_docs=3)
    monkeypatch.setattr(q, "fit_field", lambda *a: fitted.append(len(a[1])) or fit_field(*a))
    labels = spark.createDataFrame([(1, 1)] * 5 + [(2, 0), (3, 1)], "doc_id long, quality int")
    q.train_field(docs, labels, "doc_id", "text", "quality")
    # a line each
    assert fitted == [8, 3, 3]


def test_scorer_does_not_depend_on_neighbours():
    texts = pa.array(["one two two", "Three four.", "", "five %%% six"])
    scorer = c.Scorer(np.random.default_rng(1).normal(size=c.DIMENSIONS), 0.1)
    together = np.concatenate([scorer.scores(d, o) for _, d, o in text_passes(texts)])
    alone = [scorer.scores(d, o)[0] for i in range(4) for _, d, o in text_passes(texts.slice(i, 1))]
    assert np.allclose(together, alone)


@pytest.mark.parametrize("target", [0.0, 1.0])
def test_one_class_only(target):
    scorer = c.fit_scorer(np.array([0, 1]), np.array([3, 4]), np.array([1.0, 1.0]), np.full(2, target))
    assert np.isfinite(scorer.weights).all()


def patterns_drawn(n, seed=4):
    """Votes of noisy voters on texts of which a fifth are bad."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        bad = rng.random() < 0.2
        votes = [rng.choices((bad, not bad, 2), (6, 1, 2 + i % 3))[0] for i in range(len(c.VOTERS))]
        out.append(sum(int(v) * 3**i for i, v in enumerate(votes)))
    return out


def test_label_model_equals_a_loop_over_texts():
    """Expectation and maximisation text by text and vote by vote give the posteriors of the counts of patterns."""
    import math

    texts = patterns_drawn(300)
    votes = [[p // 3**i % 3 for i in range(len(c.VOTERS))] for p in texts]
    bad = [0.9 if c.BAD in v else 0.1 for v in votes]
    for _ in range(50):
        weight = {c.GOOD: [1 - b for b in bad], c.BAD: bad}
        says = {}
        for i in range(len(c.VOTERS)):
            for kind in (c.GOOD, c.BAD):
                sums = [0.5 + sum(w for w, v in zip(weight[kind], votes) if v[i] == vote) for vote in range(3)]
                for vote in range(3):
                    says[i, kind, vote] = sums[vote] / sum(sums)
        prior = (sum(bad) + 0.5) / (len(bad) + 1)
        odds = [
            math.log(prior / (1 - prior)) + sum(math.log(says[i, c.BAD, x] / says[i, c.GOOD, x]) for i, x in enumerate(v)) for v in votes
        ]
        bad = [1 / (1 + math.exp(-o)) for o in odds]
    counted = Counter(texts)
    model = c.fit_label_model(np.array(list(counted)), np.array(list(counted.values())))
    assert model.posterior_good(np.array(texts)).tolist() == pytest.approx([1 - b for b in bad], abs=1e-9)
    assert model.prior == pytest.approx(prior)


def test_scorer_equals_a_dense_loop(monkeypatch):
    """The fit on sparse shares equals the same steps on whole vectors, one document and one feature at a time."""
    import math

    monkeypatch.setattr(c, "DIMENSIONS", 7)
    rng = random.Random(2)
    documents = [[rng.choice([0, 0, rng.random()]) for _ in range(7)] for _ in range(12)]
    target = [rng.random() for _ in documents]
    weights, bias, square, square_bias = [0.0] * 7, 0.0, [1e-12] * 7, 1e-12
    for _ in range(20):
        miss = []
        for x, t in zip(documents, target):
            odds = bias + sum(w * v for w, v in zip(weights, x))
            miss.append((t / sum(target) + (1 - t) / (len(target) - sum(target))) * (t - 1 / (1 + math.exp(-odds))))
        for f in range(7):
            slope = sum(m * x[f] for m, x in zip(miss, documents)) - 1e-5 * weights[f]
            square[f] += slope**2
            weights[f] += 0.5 * slope / math.sqrt(square[f])
        square_bias += sum(miss) ** 2
        bias += 0.5 * sum(miss) / math.sqrt(square_bias)
    at = [(i, f, v) for i, x in enumerate(documents) for f, v in enumerate(x) if v]
    row, feature, value = (np.array(x) for x in zip(*at))
    scorer = c.fit_scorer(row, feature, value, np.array(target), rounds=20)
    assert scorer.weights.tolist() == pytest.approx(weights, abs=1e-5) and scorer.bias == pytest.approx(bias)


def test_scores_equal_a_sum_over_words():
    """A text's score follows from its own words, whatever stands next to it in a batch."""
    rng = np.random.default_rng(1)
    scorer = c.Scorer(rng.normal(size=c.DIMENSIONS).astype(np.float32), 0.1)
    texts = ["a b a", "", "Same same words, 12!", "x" * 500, "é 日本\n\n z", "one"]
    ((_, data, offsets),) = text_passes(pa.array(texts))
    for text, score in zip(texts, scorer.scores(data, offsets).tolist()):
        ((_, own, edges),) = text_passes(pa.array([text]))
        numbers, _ = c.hashed_features(own, edges)
        sums = sum(float(scorer.weights[n]) for n in numbers.ravel().tolist())
        words = len(WORD.findall(text))
        assert score == pytest.approx(1 / (1 + np.exp(-(0.1 + sums / words))) if words else 0.0, abs=1e-6)
