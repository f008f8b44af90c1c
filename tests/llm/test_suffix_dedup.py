import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import SENTENCE, words

from vectorloom.llm import suffix_dedup as s


def brute_force(rows, length=100):
    seen, out = set(), {}
    for key, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if data[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(data[p : p + length])
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[key] = (len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g))
    return out


def run(docs):
    return {r[0]: (r[1], r[2], r[3], bytes(r[4])) for r in s.remove_repeats(docs).collect()}


@pytest.fixture(scope="module")
def passages():
    """Passages of about 100 bytes and more, shared whole, in part, at the ends, and repeated in one text."""
    rng = random.Random(8)
    shared = [words(rng.randint(12, 40), 1000 + i) for i in range(8)] + ["ab" * 150, "x" * 330, "é" * 90]
    rows = []
    for i in range(60):
        parts = []
        for k in range(rng.randint(1, 6)):
            passage = rng.choice(shared)
            cut = rng.randint(0, 30)
            parts.append(rng.choice([passage, passage[cut:], passage[:-cut or None], words(rng.randint(0, 30), 50 * i + k)]))
        rows.append((rng.randint(-5, 5) * 1000 + i, rng.choice(["", " ", "\n"]).join(parts)))
    return rows


def test_equals_brute_force(make_docs, passages):
    assert run(make_docs(*passages)) == brute_force(passages)


def test_anchors_spread_over_tasks(make_docs, passages, monkeypatch):
    monkeypatch.setattr(s, "SPREAD_FROM", 2)
    monkeypatch.setattr(s, "TASK_STRETCHES", 4)
    assert run(make_docs(*passages)) == brute_force(passages)


def test_previous_factors_against_a_loop():
    rng = np.random.default_rng(2)
    for _ in range(50):
        windows = rng.integers(0, 2, (int(rng.integers(1, 40)), 6)).astype(np.uint8)
        windows[rng.random(len(windows)) < 0.3] = windows[0]
        want = [
            max([next((k for k in range(6) if windows[i][k] != windows[e][k]), 6) for e in range(i)], default=0)
            for i in range(len(windows))
        ]
        for enough in (1, 4, 6):
            got = s.previous_factors(windows, enough)
            assert [w >= enough for w in want] == (got >= enough).tolist()
            assert all(g == w for g, w in zip(got, want) if w >= enough)


def test_text_output_and_carried_columns(make_docs):
    # the second text ends in the first half of a character that the first text holds whole
    docs = make_docs((1, "y" + words(30) + "é", "a"), (2, "x" + words(30) + "è", "b"))
    got = {r.doc_id: (r.kept, r.source) for r in s.remove_repeats(docs, carry=("source",), as_text=True).collect()}
    assert got == {1: ("y" + words(30) + "é", "a"), 2: ("x", "b")}


def test_awkward_rows(awkward):
    got = [(r[0], r[1], r[2]) for r in s.remove_repeats(awkward).collect()]
    assert len(got) == 13
    n = len(SENTENCE)
    assert (1, 0, 0) in got and (2, 0, 0) in got
    # -9 is the smallest key; 4, 5 (twice) and the null key repeat its start
    assert (-9, n + 5, 0) in got and got.count((5, n, n)) == 2 and (4, n, n) in got and (None, n, n) in got


@pytest.mark.parametrize("parts", [1, 5])
def test_repeated_rows_are_one_document(make_docs, parts):
    """Identical rows, in one batch or in several, with a text that stands nowhere else or repeats in itself."""
    once, inner, null = words(40, 1), words(40, 2) + " and " + words(40, 2), words(40, 3)
    docs = make_docs(*[(1, once)] * 3, *[(2, inner)] * 3, *[(None, null)] * 3, (3, "so " + once)).repartition(parts)
    got = sorted((r[0] or 9, bytes(r[4]).decode()) for r in s.remove_repeats(docs).collect())
    assert got == [(1, once)] * 3 + [(2, words(40, 2) + " and ")] * 3 + [(3, "so ")] + [(9, null)] * 3


def test_empty_table(make_docs):
    assert s.remove_repeats(make_docs((1, "x")).filter("doc_id < 0")).collect() == []


def in_order(rows):
    """Rows as documents of their own: equal ones once, in order of key (null last) and md5 of the text."""
    distinct = sorted({(k is None, k or 0, hashlib.md5(t.encode()).hexdigest(), t) for k, t in rows})
    return {(None if r[0] else r[1], r[3]): n for n, r in enumerate(distinct)}


def check_shared_keys(docs, rows):
    """Against brute force, where rows share keys."""
    place = in_order(rows)
    want = brute_force([(n, t) for (_, t), n in place.items()])
    got = sorted((str(r[0]), r[1], r[2], r[3], bytes(r[4])) for r in s.remove_repeats(docs).collect())
    assert got == sorted((str(k), *want[place[k, t]]) for k, t in rows)


def equal_checksums():
    """Two texts of different length with one CRC-32."""
    long, short = words(40, 7)[:290], words(40, 8)[:190]
    texts = [[f"{base} {hashlib.md5(f'{i}{base}'.encode()).hexdigest()}" for i in range(200_000)] for base in (long, short)]
    seen = {zlib.crc32(text.encode()): text for text in texts[0]}
    return next((seen[c], text) for text in texts[1] if (c := zlib.crc32(text.encode())) in seen)


def test_null_keys_with_equal_checksums(make_docs):
    one, other = equal_checksums()
    assert zlib.crc32(one.encode()) == zlib.crc32(other.encode()) and len(one) != len(other)
    rows = [(1, "earlier " + one), (None, one), (None, other), (2, words(40, 9))]
    check_shared_keys(make_docs(*rows), rows)


@pytest.mark.parametrize("key", [None, 7])
def test_a_third_of_all_rows_under_one_key(make_docs, passages, key):
    rows = [(key if i % 3 == 0 else k, t) for i, (k, t) in enumerate(passages)] + [(key, words(40, 3))] * 20 + [(9_000_000, words(40, 3))]
    check_shared_keys(make_docs(*rows), rows)


def test_rows_of_one_key_are_spread(make_docs):
    rows, shared = s.with_ties(make_docs(*[(None, f"text {i}") for i in range(600)], (1, "x")).select("doc_id", "text"), "doc_id", "text")
    assert shared
    keys = rows.select("doc_id", "__tie").toArrow()
    bucket = s._doc_bucket(keys["doc_id"].fill_null(int(s._LAST)).to_numpy(), keys["__tie"].to_numpy(), 64)
    assert np.bincount(bucket).max() < 40


def test_largest_key_is_no_null(make_docs):
    text = words(40, 1)
    got = {r[0]: r[2] for r in s.remove_repeats(make_docs((int(s._LAST), text), (None, text))).collect()}
    assert got == {int(s._LAST): 0, None: len(text)}
