"""Line labelling by a linear-chain conditional random field; the share of content decides on a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.statistics import Statistics, statistics
from vectorloom.llm.textops import text_passes

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CONTENT_SHARE = 0.5
# Labelled documents that the field is fitted on, at most.
TRAINING_DOCS = 2_000

CONTENT, BOILERPLATE = 0, 1
FEATURES = (
    "bias", "few_words", "many_words", "symbols", "upper", "digits", "marks", "duplicate", "ends_sentence", "repeats",
    "first_or_last", "long_words",
)
# Where the weights start and what they are drawn to: the odds for boilerplate by line feature.
_PRIOR = np.array([-0.5, 0.3, -0.5, 3.0, 2.0, 0.5, 1.5, 0.7, -1.0, 2.0, 0.3, 0.3])


@dataclass(frozen=True)
class LineField:
    """Odds of a line being boilerplate by feature, and the pull between neighbouring lines."""

    weights: np.ndarray = field(default_factory=lambda: _PRIOR.copy())
    # transitions[a, b]: from label a to label b
    transitions: np.ndarray = field(default_factory=lambda: np.array([[0.5, -0.5], [-0.5, 0.5]]))

    def emissions(self, features: np.ndarray) -> np.ndarray:
        odds = features @ self.weights
        return np.stack([-odds / 2, odds / 2], axis=1)


def line_features(stats: Statistics) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of lines that have a word, their row, and their number of words."""
    has = np.flatnonzero(stats.lines["n_words"] > 0)
    line = {name: values[has] for name, values in stats.lines.items()}
    words, size, row = line["n_words"], np.maximum(line["n_bytes"], 1), line["row"]
    edge = np.zeros(len(has), bool)
    if len(has):
        change = row[1:] != row[:-1]
        edge = np.concatenate([[True], change]) | np.concatenate([change, [True]])
    features = np.stack(
        [
            np.ones(len(has)),
            words <= 3,
            words >= 15,
            line["n_symbols"] > 0.02 * size,
            line["n_upper"] * 2 > line["n_letters"],
            line["n_digits"] > 0.3 * size,
            line["n_marks"] * 5 > words,
            line["duplicate"],
            line["ends_sentence"],
            line["n_repeat_words"] * 2 > words,
            edge,
            size > 12 * words,
        ],
        axis=1,
    ).astype(float)
    return features, row, words


def _steps(row: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Lines by their place in the text: step t has the t-th line of every text that has one, longest texts first."""
    if not len(row):
        return [], np.zeros(0, np.int64)
    begins = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    length = np.diff(np.append(begins, len(row)))
    order = np.argsort(-length, kind="stable")
    begins, length = begins[order], length[order]
    alive = np.searchsorted(-length, -np.arange(length[0]), "left")
    return [begins[:n] + t for t, n in enumerate(alive)], length


def viterbi(model: LineField, features: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The most likely labels, all texts side by side; ties go to content."""
    labels = np.zeros(len(row), np.int64)
    steps, _ = _steps(row)
    if not steps:
        return labels
    emission = model.emissions(features)
    score, came = emission[steps[0]], []
    finals = [score]
    for step in steps[1:]:
        ways = score[: len(step), :, None] + model.transitions[None]
        came.append(ways.argmax(axis=1))
        score = ways.max(axis=1) + emission[step]
        finals.append(score)
    now = np.zeros(0, np.int64)
    for t in range(len(steps) - 1, -1, -1):
        # texts that end here start from their best label, longer ones come from the step after
        back = came[t][np.arange(len(now)), now] if len(now) else now
        now = np.concatenate([back, finals[t][len(back) :].argmax(axis=1)])
        labels[steps[t]] = now
    return labels


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit_field(features: np.ndarray, row: np.ndarray, labels: np.ndarray, rounds: int = 60, rate: float = 0.3) -> LineField:
    """Maximum likelihood by forward and backward sums, drawn to the starting weights; no lines leave those."""
    model = LineField()
    steps, _ = _steps(row)
    if not steps:
        return model
    prior, pull = (model.weights.copy(), model.transitions.copy()), 0.01
    weights, transitions = model.weights, model.transitions
    same = np.flatnonzero(row[1:] == row[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[same], labels[same + 1]), 1)
    square_w, square_t = np.full(weights.shape, 1e-8), np.full(transitions.shape, 1e-8)
    for _ in range(rounds):
        emission = LineField(weights, transitions).emissions(features)
        forward = [emission[steps[0]]]
        for step in steps[1:]:
            forward.append(_log_sum(forward[-1][: len(step), :, None] + transitions[None], 1) + emission[step])
        marginal, pairs = np.empty((len(row), 2)), np.zeros((2, 2))
        backward = np.zeros((0, 2))
        for t in range(len(steps) - 1, -1, -1):
            if len(backward):
                onward = transitions[None] + (emission[steps[t + 1]] + backward)[:, None, :]
                joint = forward[t][: len(backward), :, None] + onward
                pairs += np.exp(joint - _log_sum(joint.reshape(-1, 4), 1)[:, None, None]).sum(axis=0)
                backward = _log_sum(onward, 2)
            backward = np.concatenate([backward, np.zeros((len(steps[t]) - len(backward), 2))])
            both = forward[t] + backward
            marginal[steps[t]] = np.exp(both - _log_sum(both, 1)[:, None])
        slope_w = features.T @ ((labels - marginal[:, 1])) / len(row) - pull * (weights - prior[0])
        slope_t = (seen - pairs) / len(row) - pull * (transitions - prior[1])
        square_w, square_t = square_w + slope_w**2, square_t + slope_t**2
        weights = weights + rate * slope_w / np.sqrt(square_w)
        transitions = transitions + rate * slope_t / np.sqrt(square_t)
    return LineField(weights, transitions)


def train_field(
    docs: DataFrame, labels: DataFrame, key: str, text: str, quality: str, limit: int = TRAINING_DOCS
) -> LineField:
    """Fit on at most ``limit`` labelled documents, chosen by a hash of their key: lines of a good text count as
    content, lines of a bad one as boilerplate. Of rows that share a key the smallest label and text count."""
    marked = labels.filter(F.col(key).isNotNull() & F.col(quality).isNotNull())
    marked = marked.groupBy(key).agg(F.min(quality).alias(quality))
    few = marked.orderBy(F.xxhash64(key, F.lit(3)), key).limit(limit)
    lines = "doc long, bad long, features array<double>"

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = 1 - batch.column(2).to_numpy(zero_copy_only=False)
            keys = batch.column(0).to_pylist()
            for first, data, offsets in text_passes(batch.column(1)):
                features, row, _ = line_features(statistics(data, offsets))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([keys[first + r] for r in row], pa.int64()),
                        pa.array([int(bad[first + r]) for r in row], pa.int64()),
                        pa.array(list(features), pa.list_(pa.float64())),
                    ],
                    names=["doc", "bad", "features"],
                )

    one = docs.select(key, text).join(F.broadcast(few), key).groupBy(key, quality).agg(F.min(text).alias(text))
    found = one.select(key, text, quality).mapInArrow(collect, lines)
    table = found.toPandas()
    order = np.argsort(table["doc"].to_numpy(), kind="stable")
    features = np.array(table["features"].to_list(), float).reshape(-1, len(FEATURES))[order]
    return fit_field(features, table["doc"].to_numpy()[order], table["bad"].to_numpy()[order])


def judge_lines(
    docs: DataFrame, model: LineField, key: str = "doc_id", text: str = "text", min_content: float = MIN_CONTENT_SHARE
) -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share).

    ``base_failed``: fewer than 50 words, or over half of the words in three-word windows that occur twice.
    Otherwise a text is kept when lines labelled content hold at least ``min_content`` of its words.
    A null or wordless text has no words, fails, and has content share 0. Repeated rows and null keys
    are judged row by row. Extra columns are left out. Empty input gives no rows.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_passes(batch.column(1)):
                stats = statistics(data, offsets)
                features, row, words = line_features(stats)
                content = viterbi(model, features, row) == CONTENT
                n = len(offsets) - 1
                n_words = stats.rows["n_words"]
                share = np.bincount(row, weights=words * content, minlength=n) / np.maximum(n_words, 1)
                failed = (n_words < MIN_WORDS) | (100 * stats.rows["n_repeat_words"] > MAX_REPEAT_PERCENT * n_words)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        *[pa.array(stats.rows[c], pa.int64()) for c in counts],
                        pa.array(failed),
                        pa.array(~failed & (share >= min_content)),
                        pa.array(share),
                    ],
                    names=[key, *counts, "base_failed", "kept", "content_share"],
                )

    kind = docs.schema[key].dataType.simpleString()
    shape = f"`{key}` {kind}, " + ", ".join(f"{c} long" for c in counts)
    return docs.select(key, text).mapInArrow(judge, f"{shape}, base_failed boolean, kept boolean, content_share double")
