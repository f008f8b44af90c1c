import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import SENTENCE

from vectorloom.llm import divergence
from vectorloom.llm.divergence import source_divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SHAPE = "doc_id long, text string, lang string, source string"


def brute(docs, min_docs=30, top_terms=50):
    counts, in_docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in docs:
        lang, found = lang or "", TERM.findall((text or "").translate(LOWERED))
        counts[lang, source or ""].update(found)
        in_docs[lang].update(set(found))
    out = []
    for lang in {lang for lang, _ in counts}:
        kept = sorted(t for t, n in in_docs[lang].items() if n >= min_docs)
        own = {s: c for (x, s), c in counts.items() if x == lang}
        own[None] = sum(own.values(), Counter())
        p = {}
        for s, c in own.items():
            total = sum(c[t] for t in kept) + 5 * len(kept)
            p[s] = [1 + 1_000_000_000 * (c[t] + 5) // total for t in kept]
        for s in own.keys() - {None}:
            pairs = [(-sum(abs(a - b) for a, b in zip(p[s], p[o])), o.encode(), o) for o in own.keys() - {None, s}]
            terms = [(q - a, t.encode(), t) for t, a, q in zip(kept, p[s], p[None]) if own[s][t] and a > q]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top_terms])):
                out += [(lang, s, part, item, -value, i + 1) for i, (value, _, item) in enumerate(found)]
    return sorted(out)


def run(spark, docs, **options):
    return sorted(map(tuple, source_divergence(spark.createDataFrame(docs, SHAPE), **options).collect()))


def corpus(n, sources=9, langs=("en", "fr", None)):
    random = np.random.default_rng(6)
    rows = []
    for i in range(n):
        # a third of all rows comes from one source
        source = "s0" if i % 3 == 0 else f"s{random.integers(sources)}"
        letters = [chr(97 + w % 26) * (1 + w % 5) for w in random.zipf(1.4, random.integers(0, 40)) % 300 + int(source[1:])]
        rows.append((i, ", ".join(letters).capitalize(), langs[i % len(langs)], source))
    return rows


def test_equals_brute_force(spark):
    docs = corpus(900)
    assert run(spark, docs) == brute(docs)


def test_blocks_and_slices_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(divergence, "GROUPS", 2)
    monkeypatch.setattr(divergence, "CELLS", 20)
    docs = corpus(500)
    assert run(spark, docs, min_docs=3, top_terms=4) == brute(docs, min_docs=3, top_terms=4)


def test_awkward_rows(spark, awkward):
    docs = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in awkward.collect()]
    got = sorted(map(tuple, source_divergence(awkward, min_docs=2).collect()))
    assert got == brute(docs, min_docs=2)


def test_groups_without_terms_and_languages_without_kept_terms(spark):
    docs = [(i, SENTENCE, "en", "a") for i in range(3)]
    docs += [(4, None, "en", "b"), (5, "1 2 3", "en", None), (6, "", "en", ""), (7, "rare", None, "x"), (8, "word", "", None), (9, "é", "fr", "z")]
    got = run(spark, docs, min_docs=3)
    assert got == brute(docs, min_docs=3)
    assert {r[4] for r in got if r[0] == ""} == {0}


def test_terms_end_with_their_row_and_keep_other_letters(spark):
    docs = [(1, "aB", "l", "s"), (2, "Cd", "l", "s"), (3, "ÉÀ日本-x9y", "l", "t"), (4, "éÀ", "l", "t")]
    assert run(spark, docs, min_docs=1) == brute(docs, min_docs=1)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_large_counts_are_exact(spark):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(9_000_000_000_000, 9_000_000_000_001, 7)], "n long, total long, v long")
    got = row.select(divergence.share(F.col("n"), F.col("total"), F.col("v")).alias("p")).first()["p"]
    assert got == 1 + 1_000_000_000 * (9_000_000_000_000 + 5) // (9_000_000_000_001 + 35)


def test_no_posting_pairs_are_emitted(spark):
    """Rows that leave the multiplication are group pairs, not pairs per term."""
    blocks = spark.createDataFrame([], "lang string, block long, slice int, groups binary, cells binary, terms long")
    plan = divergence.pair_sums(blocks)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "item" in plan and "term," not in plan.split("MapInArrow")[0]


@pytest.mark.parametrize("shared", [True, False])
def test_accumulator_equals_sum_over_all_terms(shared):
    random = np.random.default_rng(8)
    terms, groups = 60, 4
    base = random.integers(1, 50, 2 * groups)
    full = np.repeat(base[:, None], terms, axis=1)
    cells = [(g, t, int(random.integers(1, 900))) for g in range(2 * groups) for t in range(terms) if (random.random() < 0.4) == shared]
    for g, t, p in cells:
        full[g, t] = p

    def block(first):
        own = [(g - first, t, p) for g, t, p in cells if first <= g < first + groups]
        import pyarrow as pa

        names = pa.table({"source": [str(g) for g in range(groups)], "base": base[first : first + groups]}, schema=divergence._GROUPS)
        held = pa.table([list(c) for c in zip(*own)], schema=divergence._POSTINGS)
        return divergence.Block(divergence.pack(names), divergence.pack(held))

    got = divergence.accumulate(block(0), block(groups), True, terms)
    assert got.tolist() == np.abs(full[:groups, None] - full[None, groups:]).sum(axis=2).tolist()
