"""Quality classifier without hand labels: heuristic voters, expectation-maximisation, hashed linear scorer.

Voters look at whole texts and say good, bad or nothing; they overlap and err. Texts with equal votes are
counted together, and expectation-maximisation on these counts estimates how often each voter says what
about good and bad texts, and with that the probability that a vote pattern belongs to a good text. These
posteriors are the soft labels of a logistic model on hashed word features, which scores every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.statistics import Statistics, statistics
from vectorloom.llm.textops import LOWER, SpanHashes, give_back, mix, text_passes, word_spans
from vectorloom.session import materialize

GOOD, BAD, SILENT = 0, 1, 2
# Documents whose posteriors the scorer is fitted on, at most.
TRAINING_DOCS = 8_000
_FAMILY_BITS, _FAMILIES = 14, 4
DIMENSIONS = _FAMILIES << _FAMILY_BITS


def _vote(bad: np.ndarray, good: np.ndarray | None = None) -> np.ndarray:
    out = np.full(len(bad), SILENT)
    if good is not None:
        out[good] = GOOD
    out[bad] = BAD
    return out


def _voters(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    words = rows["n_words"]
    some = words > 0
    repeats, symbols, upper, letters = rows["n_repeat_words"], rows["n_symbols"], rows["n_upper"], rows["n_letters"]
    lines, sentences = rows["n_lines"], rows["n_sentence_lines"]
    return {
        "symbols": _vote(symbols * 50 > rows["word_chars"], some & (symbols * 200 < rows["word_chars"])),
        "symbol_words": _vote(symbols * 4 > words, some & (symbols == 0)),
        "repeats": _vote(repeats * 2 > words, some & (repeats * 5 < words)),
        "lines": _vote(rows["n_dup_lines"] * 2 > lines),
        "capitals": _vote(upper * 2 > letters, (letters > 0) & (upper * 5 < letters)),
        "marks": _vote(rows["n_marks"] * 5 > words, some & (rows["n_marks"] * 50 < words)),
        "sentences": _vote(some & (sentences * 4 < lines), some & (sentences * 2 > lines)),
        "word_length": _vote(rows["word_chars"] > 12 * words, some & (rows["word_chars"] < 9 * words)),
    }


VOTERS = ("symbols", "symbol_words", "repeats", "lines", "capitals", "marks", "sentences", "word_length")


def vote_patterns(stats: Statistics) -> np.ndarray:
    """All votes on a text as one base-3 number."""
    votes = _voters(stats.rows)
    return sum(votes[name].astype(np.int64) * 3**i for i, name in enumerate(VOTERS))


def votes_of(patterns: np.ndarray) -> np.ndarray:
    return (patterns[:, None] // 3 ** np.arange(len(VOTERS))) % 3


@dataclass(frozen=True)
class LabelModel:
    """Prior of bad texts, and says[voter, class, vote]: how often a voter says what about a class."""

    prior: float
    says: np.ndarray

    def posterior_good(self, patterns: np.ndarray) -> np.ndarray:
        votes = votes_of(np.asarray(patterns, np.int64))
        voters = np.arange(len(VOTERS))
        good = np.log(1 - self.prior) + np.log(self.says[voters, GOOD, votes]).sum(axis=1)
        bad = np.log(self.prior) + np.log(self.says[voters, BAD, votes]).sum(axis=1)
        return 1 / (1 + np.exp(np.clip(bad - good, -500, 500)))

    def accuracies(self) -> dict[str, float]:
        """Share of right votes among a voter's votes that are not silent."""
        weight = np.array([1 - self.prior, self.prior])
        right = (self.says[:, [GOOD, BAD], [GOOD, BAD]] * weight).sum(axis=1)
        spoken = (self.says[:, :, :SILENT].sum(axis=2) * weight).sum(axis=1)
        return dict(zip(VOTERS, right / np.maximum(spoken, 1e-12)))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> LabelModel:
    """Expectation-maximisation on counts of vote patterns, from the share of bad among the votes, squared up."""
    votes = votes_of(np.asarray(patterns, np.int64))
    counts = np.asarray(counts, float)
    n_bad = (votes == BAD).sum(axis=1)
    bad = np.where(n_bad > 0, 0.9, 0.1)
    model = LabelModel(0.1, np.full((len(VOTERS), 2, 3), 1 / 3))
    if not counts.sum():
        return model
    for _ in range(rounds):
        weight = np.stack([counts * (1 - bad), counts * bad])
        says = np.empty((len(VOTERS), 2, 3))
        for vote in (GOOD, BAD, SILENT):
            says[:, :, vote] = ((votes == vote).T.astype(float) @ weight.T) + 0.5
        says /= says.sum(axis=2, keepdims=True)
        prior = (weight[1].sum() + 0.5) / (counts.sum() + 1)
        model = LabelModel(float(prior), says)
        bad = 1 - model.posterior_good(patterns)
    return model


_SHAPE = np.zeros(256, np.uint8)
_SHAPE[ord("a") : ord("z") + 1] = 1
_SHAPE[0x80:] = 1
_SHAPE[ord("A") : ord("Z") + 1] = 2
_SHAPE[ord("0") : ord("9") + 1] = 3
for _byte in range(0x21, 0x7F):
    if not _SHAPE[_byte]:
        _SHAPE[_byte] = _byte


def hashed_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (family by word), and the index of each row's first word.

    Families: the lower-cased word; its shape, runs of one kind of character as one; the shapes of the
    word and the one before; whether the word stood one or two words before, with its shape.
    """
    starts, ends, row_words = word_spans(data, offsets)
    words = SpanHashes(LOWER[data]).of(starts, ends)
    kind = _SHAPE[data]
    edge = np.ones(len(data), bool)
    edge[1:] = kind[1:] != kind[:-1]
    edge[starts] = True
    at = np.concatenate([[0], np.cumsum(edge)])
    shape = SpanHashes(kind[edge]).of(at[starts], at[ends])
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(row_words))

    def before(values: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(values)
        out[by:] = np.where(row[by:] == row[:-by], values[:-by], 0) if len(values) > by else 0
        return out

    again = (words == before(words, 1)) | (words == before(words, 2))
    families = [
        words,
        shape,
        mix(shape ^ mix(before(shape, 1) + np.uint64(1))),
        mix(again.astype(np.uint64) + np.uint64(3)) ^ np.where(again, shape, np.uint64(0)),
    ]
    top = np.uint64(64 - _FAMILY_BITS)
    numbers = np.stack([(f >> top).astype(np.int64) + (i << _FAMILY_BITS) for i, f in enumerate(families)])
    return numbers, row_words


@dataclass(frozen=True)
class Scorer:
    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of good; 0 for a text without words."""
        numbers, row_words = hashed_features(data, offsets)
        word = self.weights[numbers].sum(axis=0)
        sums = np.diff(np.concatenate([[0.0], np.cumsum(word)])[row_words])
        n = np.diff(row_words)
        odds = self.bias + sums / np.maximum(n, 1)
        return np.where(n > 0, 1 / (1 + np.exp(-np.clip(odds, -500, 500))), 0.0)


def fit_scorer(
    row: np.ndarray, feature: np.ndarray, value: np.ndarray, target: np.ndarray, rounds: int = 150, pull: float = 1e-5
) -> Scorer:
    """Logistic regression on soft labels from sparse (row, feature, value), both classes with equal weight."""
    weights, bias = np.zeros(DIMENSIONS), 0.0
    if not len(target):
        return Scorer(weights, bias)
    good, bad = max(target.sum(), 1e-9), max((1 - target).sum(), 1e-9)
    importance = target / good + (1 - target) / bad
    square, square_bias = np.full(DIMENSIONS, 1e-12), 1e-12
    for _ in range(rounds):
        odds = np.bincount(row, weights[feature] * value, len(target)) + bias
        miss = importance * (target - 1 / (1 + np.exp(-np.clip(odds, -500, 500))))
        slope = np.bincount(feature, miss[row] * value, DIMENSIONS) - pull * weights
        square, square_bias = square + slope**2, square_bias + miss.sum() ** 2
        weights = weights + 0.5 * slope / np.sqrt(square)
        bias += 0.5 * miss.sum() / np.sqrt(square_bias)
    return Scorer(weights.astype(np.float32), float(bias))


def heuristic_votes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pattern): the votes on every text as one number."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_passes(batch.column(1)):
                patterns = pa.array(vote_patterns(statistics(data, offsets)), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(patterns)), patterns], names=[key, "pattern"]
                )
        give_back()

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(vote, f"`{key}` {kind}, pattern long")


def train_scorer(docs: DataFrame, votes: DataFrame, labels: LabelModel, key: str, text: str, limit: int) -> Scorer:
    """Fit on at most ``limit`` documents, chosen by a hash of their key; their features come to the driver.

    Of rows that share a key the one with the smallest text counts.
    """
    # the smallest hashes: a bounded top-k, whatever the number of documents
    keys = votes.filter(F.col(key).isNotNull()).select(key).distinct()
    few = keys.orderBy(F.xxhash64(key, F.lit(11)), key).limit(limit)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in text_passes(batch.column(0)):
                numbers, row_words = hashed_features(data, offsets)
                found, shares = [], []
                for a, b in zip(row_words[:-1], row_words[1:]):
                    number, count = np.unique(numbers[:, a:b], return_counts=True)
                    found.append(number.astype(np.int32))
                    shares.append((count / max(b - a, 1)).astype(np.float32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(vote_patterns(statistics(data, offsets)), pa.int64()),
                        pa.array([x.tobytes() for x in found], pa.binary()),
                        pa.array([x.tobytes() for x in shares], pa.binary()),
                    ],
                    names=["pattern", "features", "shares"],
                )

    sample = docs.select(key, text).join(F.broadcast(few), key).groupBy(key).agg(F.min(text).alias(text)).select(text)
    rows = sample.mapInArrow(features, "pattern long, features binary, shares binary").collect()
    sizes = [len(r["features"]) // 4 for r in rows]
    return fit_scorer(
        np.repeat(np.arange(len(rows)), sizes),
        np.frombuffer(b"".join(bytes(r["features"]) for r in rows), np.int32),
        np.frombuffer(b"".join(bytes(r["shares"]) for r in rows), np.float32),
        labels.posterior_good(np.array([r["pattern"] for r in rows], np.int64)),
    )


def score_documents(docs: DataFrame, scorer: Scorer, key: str, text: str) -> DataFrame:
    """(key, score)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_passes(batch.column(1)):
                scores = pa.array(scorer.scores(data, offsets))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(scores)), scores], names=[key, "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(score, f"`{key}` {kind}, score double")


def keep_good(docs: DataFrame, scorer: Scorer, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least the threshold. Nothing is shuffled."""
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_passes(batch.column(at)):
                scores = scorer.scores(data, offsets)
                yield batch.slice(first, len(scores)).filter(pa.array(scores >= threshold))
        give_back()

    return docs.mapInArrow(keep, docs.schema)


def train_classifier(
    docs: DataFrame, key: str = "doc_id", text: str = "text", training_docs: int = TRAINING_DOCS
) -> tuple[LabelModel, Scorer]:
    """The label model from the votes on all documents, and the scorer fitted on its posteriors.

    At most 3 to the power of the number of voters vote patterns reach the driver, and the features of
    ``training_docs`` documents.
    """
    votes = materialize(heuristic_votes(docs, key, text), "classifier-votes")
    counted = votes.groupBy("pattern").count().orderBy("pattern").collect()
    labels = fit_label_model(np.array([r["pattern"] for r in counted], np.int64), np.array([r["count"] for r in counted]))
    return labels, train_scorer(docs, votes, labels, key, text, training_docs)


def classify_quality(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """(key, score, keep): probability of a good text, and whether it reaches the threshold.

    A null or wordless text scores 0. Null keys are scored but never trained on; repeated rows are scored
    each. Extra columns are left out. Empty input gives no rows; with one class only the scorer leans to
    that class.
    """
    _, scorer = train_classifier(docs, key, text)
    return score_documents(docs, scorer, key, text).withColumn("keep", F.col("score") >= threshold)
