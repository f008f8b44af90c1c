import random

import numpy as np
import pytest

from vectorloom.llm import token_counts as t


@pytest.mark.parametrize("rule", t.RULES)
def test_allocation_against_a_loop(rule):
    encode, rng = t.encoder(t.tokenizer_path()), random.Random(2)
    for _ in range(600):
        text = "".join(rng.choices(["a", "b ", "\n", " ", "\n\n", "é", "日本", "\U0001f600", "the", " \n "], k=rng.randint(0, 30)))
        ends = encode.byte_ends(text) if text else np.zeros(0, np.int64)
        assert (ends[-1] if len(ends) else 0) == len(text.encode())
        first, last = t.character_spans(text, ends) if len(ends) else (ends, ends)
        cuts = sorted(rng.sample(range(len(text) + 1), min(len(text) + 1, rng.randint(0, 6))))
        gaps = (np.array(cuts[::2][: len(cuts[1::2])], int), np.array(cuts[1::2], int))
        for starts, stops in (t.line_spans(text), gaps):
            counts, crossing = t.allocate(first, last, starts, stops, rule)
            want, cross = np.zeros(len(starts)), np.zeros(len(starts), int)
            for a, b in zip(first, last):
                held = [max(0, min(b, v) - max(a, u)) for u, v in zip(starts, stops)]
                if not any(held):
                    continue
                if max(held) < b - a:
                    cross += np.array(held) > 0
                if rule == "share":
                    want += np.array(held) / (b - a)
                elif rule == "most":
                    want[int(np.argmax(held))] += 1
                else:
                    want[[i for i, (u, v) in enumerate(zip(starts, stops)) if u <= a < v]] += 1
            assert np.allclose(counts, want) and crossing.tolist() == cross.tolist()


@pytest.mark.parametrize("rule", t.RULES)
def test_lines_add_up(awkward, rule):
    rows = t.attribute_tokens(awkward, rule=rule).collect()
    sums = {}
    for r in rows:
        if r.doc_id not in (None, 5):
            total = sums.setdefault(r.doc_id, [0, 0, r.doc_tokens])
            total[0] += r.n_tokens
            total[1] += r.n_chars
    texts = {r.doc_id: r.text or "" for r in awkward.collect()}
    assert all(abs(got - want) < 1e-6 and chars == len(texts[k]) for k, (got, chars, want) in sums.items())
    assert sums[1] == [0, 0, 0] and sums[2] == [0, 0, 0]
    assert sum(r.doc_id == 5 for r in rows) == 2


def test_fields(make_docs):
    docs = t.with_fields(make_docs((1, "some words\n"), (2, None)), ["source", "text", "lang"])
    rows = {(r.doc_id, r.name): r for r in t.attribute_tokens(docs, spans="spans").collect()}
    assert [rows[1, n].n_chars for n in ("source", "text", "lang")] == [1, 11, 2]
    # a separator belongs to no field, so the fields hold fewer tokens than the text
    assert sum(rows[1, n].n_tokens for n in ("source", "text", "lang")) < rows[1, "text"].doc_tokens
    assert rows[2, "text"].n_tokens == 0 and rows[2, "lang"].n_tokens == 1


def test_unknown_rule_and_empty_table(make_docs):
    docs = make_docs((1, "x"))
    with pytest.raises(ValueError):
        t.attribute_tokens(docs, rule="none")
    assert t.attribute_tokens(docs.filter("doc_id < 0")).collect() == []
