"""Word, line and repetition statistics of whole texts, many texts per pass."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from vectorloom.llm.textops import SEPARATOR, SpanHashes, mix, word_spans

SYMBOL = np.zeros(256, bool)
SYMBOL[[*b"#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER = _UPPER.copy()
_LETTER[ord("a") : ord("z") + 1] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_STOP = np.zeros(256, bool)
_STOP[[*b".!?"]] = True
# every byte that does not continue a UTF-8 sequence is a code point
_POINT = np.ones(256, bool)
_POINT[0x80:0xC0] = False
_ORDER = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@dataclass
class Statistics:
    """Arrays by row, by line and by word; ``rows`` and ``lines`` hold counts by name."""

    rows: dict[str, np.ndarray]
    lines: dict[str, np.ndarray]
    # first line and first word of each row, and first word of each line (one more entry than rows or lines)
    row_lines: np.ndarray
    row_words: np.ndarray
    line_words: np.ndarray
    words: np.ndarray


def _counts(mask: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[edges])


def _repeats(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value: whether its owner has it twice or more, and whether it has had it before."""
    if not len(values):
        return np.zeros(0, bool), np.zeros(0, bool)
    _, first, which, count = np.unique(
        mix(values + mix(owner.astype(np.uint64))), return_index=True, return_inverse=True, return_counts=True
    )
    later = np.ones(len(values), bool)
    later[first] = False
    return count[which] > 1, later


def statistics(data: np.ndarray, offsets: np.ndarray) -> Statistics:
    """Statistics of one pass of texts (``text_passes``)."""
    n = len(offsets) - 1
    hashes = SpanHashes(data)
    starts, ends, row_words = word_spans(data, offsets)
    words = hashes.of(starts, ends)
    word_row = np.repeat(np.arange(n), np.diff(row_words))

    # lines: a row has one more than it has line feeds
    feeds = np.flatnonzero(data == 0x0A)
    feed_row = np.searchsorted(offsets, feeds, "right") - 1
    per_row = np.bincount(feed_row, minlength=n) + 1
    row_lines = np.concatenate([[0], np.cumsum(per_row)])
    line_start = np.empty(row_lines[-1], np.int64)
    line_end = np.empty(row_lines[-1], np.int64)
    opens = np.zeros(row_lines[-1], bool)
    opens[row_lines[:-1]] = True
    line_start[opens], line_start[~opens] = offsets[:-1], feeds + 1
    closes = np.zeros(row_lines[-1], bool)
    closes[row_lines[1:] - 1] = True
    line_end[closes], line_end[~closes] = offsets[1:], feeds
    line_row = np.repeat(np.arange(n), per_row)
    line_words = np.append(np.searchsorted(starts, line_start, "left"), len(starts))
    line_count = np.diff(line_words)

    has_word = np.flatnonzero(line_count > 0)
    _, line_again = _repeats(hashes.of(line_start[has_word], line_end[has_word]), line_row[has_word])
    duplicate = np.zeros(len(line_row), bool)
    duplicate[has_word] = line_again

    covered = np.zeros(len(words), bool)
    if len(words) >= 3:
        windows = words[:-2] * _ORDER[0] + words[1:-1] * _ORDER[1] + words[2:] * _ORDER[2]
        whole = np.flatnonzero(word_row[:-2] == word_row[2:])
        twice, _ = _repeats(windows[whole], word_row[whole])
        at = whole[twice]
        covered[at] = covered[at + 1] = covered[at + 2] = True

    inside = ~SEPARATOR[data]
    symbol, upper, letter = SYMBOL[data], _UPPER[data], _LETTER[data]
    line_edges = np.concatenate([line_start, [len(data)]])
    last = ends[np.maximum(line_words[1:] - 1, 0)] - 1 if len(ends) else np.zeros(len(line_row), np.int64)
    row_edges = offsets
    rows = {
        "n_words": np.diff(row_words),
        "word_chars": _counts(inside & _POINT[data], row_edges),
        "n_symbols": _counts(symbol, row_edges),
        "n_dup_lines": np.bincount(line_row, weights=duplicate, minlength=n).astype(np.int64),
        "n_repeat_words": _counts(covered, row_words),
        "n_upper": _counts(upper, row_edges),
        "n_letters": _counts(letter, row_edges),
        "n_marks": _counts(data == ord("!"), row_edges),
        "n_lines": np.bincount(line_row, weights=line_count > 0, minlength=n).astype(np.int64),
    }
    lines = {
        "n_words": line_count,
        "n_bytes": _counts(inside, line_edges),
        "n_symbols": _counts(symbol, line_edges),
        "n_upper": _counts(upper, line_edges),
        "n_letters": _counts(letter, line_edges),
        "n_digits": _counts(_DIGIT[data], line_edges),
        "n_marks": _counts(data == ord("!"), line_edges),
        "n_repeat_words": _counts(covered, line_words),
        "duplicate": duplicate,
        "ends_sentence": (line_count > 0) & _STOP[data[last]] if len(data) else np.zeros(len(line_row), bool),
        "row": line_row,
    }
    rows["n_sentence_lines"] = np.bincount(line_row, weights=lines["ends_sentence"], minlength=n).astype(np.int64)
    return Statistics(rows, lines, row_lines, row_words, line_words, words)
