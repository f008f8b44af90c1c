import random
from collections import Counter

import numpy as np
import pytest
from helpers import words

from vectorloom.llm import ngram_join as j


def brute_force(rows, rule):
    sets = list(j.word_sets([(text or "").encode() for _, text in rows], rule.n))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, grams in enumerate(sets):
        common = Counter()
        for g in grams:
            common.update(holders.setdefault(g, []))
            holders[g].append(i)
        for k, n in common.items():
            if 100 * n >= rule.percent * (len(grams) + len(sets[k]) - n):
                a, b = find(i), find(k)
                parent[max(a, b)] = min(a, b)
    smallest = {}
    for i, (key, _) in enumerate(rows):
        smallest[find(i)] = min(key, smallest.get(find(i), key))
    return {key: (len(sets[i]), smallest[find(i)]) for i, (key, _) in enumerate(rows)}


def run(docs, rule=j.Rule()):
    return {r[0]: (r[1], r[2]) for r in j.ngram_jaccard_join(docs, rule=rule).collect()}


@pytest.fixture(scope="module")
def near_copies():
    """Texts of many sizes, each with copies that differ in few or many words; all pairs around the threshold."""
    rng = random.Random(5)
    rows = []
    for group in range(40):
        base = words(rng.choice([5, 8, 9, 12, 25, 60, 200, 600]), group).split()
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = f"new{rng.random()}"
            rows.append((len(rows) * 3 + 1, " ".join(copy[: len(copy) - rng.randint(0, len(copy) // 20)])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rule", [j.Rule(), j.Rule(5, 80)])
def test_equals_brute_force(make_docs, near_copies, rule):
    assert run(make_docs(*near_copies), rule) == brute_force(near_copies, rule)


def test_one_large_group_of_near_copies(make_docs):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        copy = words(120).split()
        for _ in range(rng.randint(1, 3)):
            copy[rng.randrange(120)] = f"n{i}"
        rows.append((i, " ".join(copy)))
    assert run(make_docs(*rows)) == brute_force(rows, j.Rule())


@pytest.mark.parametrize("rule", [j.Rule(), j.Rule(5, 80)])
def test_no_linked_pair_escapes_the_signatures(rule):
    """Pairs right at the threshold share a signature in fitting roles, or are equal."""
    rng = np.random.default_rng(3)
    schemes = j.Schemes(rule)
    for _ in range(400):
        union = int(rng.integers(2, 900))
        common = -(-rule.percent * union // 100)
        values = np.unique(rng.integers(0, 1 << 63, union, dtype=np.uint64) * np.uint64(2))
        rng.shuffle(values)
        common, union = min(common, len(values)), len(values)
        only = rng.random(union - common) < rng.random()
        a = np.sort(np.concatenate([values[:common], values[common:][only]]))
        b = np.sort(np.concatenate([values[:common], values[common:][~only]]))
        if len(a) == len(b) == common:
            continue
        if 100 * common < rule.percent * union:
            continue
        entries = []
        for node, one in enumerate((a, b)):
            for signature, role in schemes.all_signatures(one):
                part = np.empty(len(signature), j._ENTRY)
                part["node"], part["signature"], part["role"] = node, (signature >> np.uint64(32)).astype("u4"), role
                entries.append(part)
        assert any(True for _ in j._matching_groups(np.concatenate(entries))), (len(a), len(b), common)


def test_sketch_never_exceeds_the_difference():
    rng = np.random.default_rng(4)
    for _ in range(100):
        values = np.unique(rng.integers(0, 1 << 63, int(rng.integers(2, 400)), dtype=np.uint64))
        a, b = values[rng.random(len(values)) < 0.8], values[rng.random(len(values)) < 0.8]
        sketches = j._folded([j.parity_sketch(a).tobytes(), j.parity_sketch(b).tobytes()])
        assert j._apart(sketches, sketches[0])[1] <= len(np.setxor1d(a, b))


def test_groups_are_spread_over_blocks(make_docs, near_copies, monkeypatch):
    """Hot signatures and small blocks: the same components, and no list or block holds a whole group."""
    rng, rows, lists = random.Random(9), list(near_copies[:80]), []
    for i in range(150):
        copy = words(100, 998).split()
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(100)] = f"n{i}"
        rows.append((10_000 + i, " ".join(copy)))
    monkeypatch.setattr(j, "HOT_FROM", 10)
    monkeypatch.setattr(j, "GROUP_SETS", 6)
    group_members = j.group_members
    monkeypatch.setattr(j, "group_members", lambda g: lists.extend(len(r.nodes) for r in g.collect()) or group_members(g))
    got = j.ngram_jaccard_join(make_docs(*rows), count_links=False).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == brute_force(rows, j.Rule())
    assert max(lists) < 20


def test_links_are_counted(make_docs, near_copies, monkeypatch):
    """Every link of every document, copies by multiplicity, inside and across blocks of a component."""
    rng, rows = random.Random(6), [(key, text) for key, text in near_copies[:90]]
    rows += [(10_000 + i, text) for i, (_, text) in enumerate(near_copies[:20])]
    for i in range(60):
        copy = words(90, 999).split()
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(90)] = f"n{i}"
        rows.append((20_000 + i, " ".join(copy)))
    monkeypatch.setattr(j, "LINK_SETS", 7)
    sets = list(j.word_sets([t.encode() for _, t in rows], 4))
    want = {
        key: sum(100 * len(a & b) >= 85 * len(a | b) for k, b in enumerate(sets) if k != i)
        for i, ((key, _), a) in enumerate(zip(rows, sets))
    }
    assert max(want.values()) > 20
    got = j.ngram_jaccard_join(make_docs(*rows, (30_000, ""), (30_001, None)))
    assert {r.doc_id: r.n_links for r in got.collect()} == want | {30_000: 0, 30_001: 0}


def test_awkward_rows(awkward):
    got = [(r[0], r[1], r[2]) for r in j.ngram_jaccard_join(awkward).collect()]
    assert len(got) == 13
    # 19 of the 20 four-grams of -9 are those of 4 and 5
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 19, -9), (5, 19, -9), (-9, 20, -9), (10, 1, 10)} <= set(got)
    assert {g[2] for g in got if g[0] is None and g[1] == 0} == {None}


def test_empty_table(make_docs, spark):
    empty = make_docs((1, "x")).filter("doc_id < 0")
    assert j.ngram_jaccard_join(empty).collect() == []


def links_by_hand(rows, rule=j.Rule()):
    sets = list(j.word_sets([(t or "").encode() for _, t in rows], rule.n))
    linked = [[bool(a) and k != i and 100 * len(a & b) >= rule.percent * len(a | b) for k, b in enumerate(sets)] for i, a in enumerate(sets)]
    component = list(range(len(rows)))
    for _ in rows:
        component = [min([component[i], *[component[k] for k, x in enumerate(linked[i]) if x]]) for i in range(len(rows))]
    keys = {}
    for i, (key, _) in enumerate(rows):
        keys.setdefault(component[i], []).append(key)
    first = [min((k for k in keys[c] if k is not None), default=None) for c in component]
    return sorted((str(key), len(sets[i]), str(first[i] if sets[i] else key), sum(linked[i])) for i, (key, _) in enumerate(rows))


def test_rows_without_a_key_have_links(make_docs):
    """Sets that only rows without a key hold are linked, and link what stands on either side of them."""
    base = words(60).split()

    def copy(*places):
        return " ".join(f"x{i}" if i in places else w for i, w in enumerate(base))

    rows = [(1, copy(5)), (None, copy(5, 30)), (None, copy(30, 31)), (3, copy(30, 31, 55)), (None, words(30, 7)), (None, words(30, 7)), (None, "")]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links) for r in j.ngram_jaccard_join(make_docs(*rows)).collect())
    assert got == links_by_hand(rows)


def test_a_third_of_all_rows_under_one_key(make_docs, near_copies):
    rows = [(None if i % 3 == 0 else key, text) for i, (key, text) in enumerate(near_copies[:120])] + [(None, words(40, 5_000))] * 40
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links) for r in j.ngram_jaccard_join(make_docs(*rows)).collect())
    assert got == links_by_hand(rows)
