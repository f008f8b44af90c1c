import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import words

from vectorloom.llm import fingerprints as f


def like(a, b):
    prints = f.order_minhash(pa.array([a, b]))
    return float(f.likeness(prints[:1], prints[1:])[0])


def slow_components(text):
    """The same selection with dictionaries and sorted lists."""
    data = text.encode()
    grams = [data[i : i + f.KMER] for i in range(max(1, len(data) - f.KMER + 1))] if data else []
    hashes = f.SpanHashes(np.frombuffer(data, np.uint8)) if data else None
    value = [int(hashes.of(np.array([i]), np.array([min(i + f.KMER, len(data))]))[0]) for i in range(len(grams))]
    seen, bins = {}, {}
    for i, v in enumerate(value):
        top = v >> 20 << 20
        n = seen[top] = seen.get(top, 0) + 1
        numbered = int(f.mix(np.array([top ^ (n * int(f._OCCURRENCE) & (1 << 64) - 1)], np.uint64))[0])
        bins.setdefault(numbered >> int(f._BIN_SHIFT), []).append((numbered >> 20, i))
    out = np.zeros(f.BINS, np.int64)
    for b, entries in bins.items():
        places = sorted(i for _, i in sorted(entries)[: f.TUPLE])
        total = value[places[0]] * int(f._FIRST) + (value[places[1]] * int(f._SECOND) if len(places) > 1 else 0)
        out[b] = int(f.mix(np.array([total & (1 << 64) - 1], np.uint64))[0]) % 0xFFFF + 1
    return out


def test_components_against_a_loop():
    rng = random.Random(6)
    texts = ["", "a", "short text", "x" * 40, "ab" * 60, words(50), "é日本" * 30]
    texts += ["".join(rng.choices("ab ", k=rng.randint(10, 300))) for _ in range(20)]
    got = f.order_minhash(pa.array(texts))
    for text, row in zip(texts, got):
        assert row.astype(int).tolist() == slow_components(text).tolist(), text[:30]


def test_order_matters():
    parts = [words(20, i) for i in range(20)]
    same_content = parts[:]
    random.Random(1).shuffle(same_content)
    text, shuffled = " ".join(parts), " ".join(same_content)
    edit = text.replace("w7x3 ", "changed ")
    assert like(text, text) == 1.0
    assert like(text, edit) > 0.8 > 0.7 > like(text, shuffled)
    assert like(text, words(400, 99)) < 0.1


def test_empty_texts():
    assert like("", "") == 1.0 and like(None, "") == 1.0 and like("", "something") == 0.0


def test_long_and_short_route_agree(monkeypatch):
    text = pa.array([words(3000)])
    short = f.order_minhash(text)
    monkeypatch.setattr(f, "_POSITION", np.uint64((1 << 20) - 1))
    order = f._sorted_with_places(np.arange(50, dtype=np.uint64) << np.uint64(30))
    assert order[1].tolist() == list(range(50)) and (short == f.order_minhash(text)).all()


def expected(rows):
    rows = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for i, (key, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        changed = f.edited(text, after)
        prints = f.order_minhash(pa.array([text, changed, after]))
        hexes = f.as_hex(prints)
        near = [round(float(f.likeness(prints[:1], prints[j : j + 1])[0]), 9) for j in (1, 2)]
        out.append((key, len(text), hashlib.sha256(changed.encode()).hexdigest(), hexes[0], hexes[1], *near))
    return out


def study(docs):
    return [(*r[:5], round(r[5], 9), round(r[6], 9)) for r in f.edit_study(docs).collect()]


def test_study_of_awkward_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    key = lambda r: (r[0] is None, *[x or 0 for x in r[:2]], r[2:])
    assert sorted(study(awkward), key=key) == sorted(expected(rows), key=key)


def test_study_over_many_ranges(make_docs):
    rows = [(i * 3 - 100, words(i % 40, i)) for i in range(200)]
    assert sorted(study(make_docs(*rows).repartition(9))) == sorted(expected(rows))


def test_single_row_and_empty_table(make_docs):
    one = make_docs((7, words(30)))
    assert study(one) == expected([(7, words(30))])
    assert f.edit_study(one.filter("doc_id < 0")).collect() == []
    assert f.fingerprints(one).first().fingerprint == expected([(7, words(30))])[0][3]


@pytest.mark.parametrize("key", [None, 5])
def test_a_third_of_all_rows_under_one_key(make_docs, monkeypatch, key):
    """Rows of one key lie in many ranges, each with the text that follows."""
    monkeypatch.setattr(f, "GROUP_BYTES", 400)
    rows = [(key if i % 3 == 0 else i, f"{i * 7919 % 1000:03} " + words(i % 9, i)) for i in range(240)]
    assert sorted(study(make_docs(*rows).repartition(3)), key=str) == sorted(expected(rows), key=str)
