import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from vectorloom.llm import packing as p
from vectorloom.llm.textops import text_passes


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(p.tokenizer_path())


def test_ids_equal_the_tokenizer(tokenizer):
    rng = random.Random(3)
    signs = [*"abzABZ019 '\n.,!#|éÉßΣσ“”…  日本١Ⅳİſ\U0001f600\x1c\x85\x00", "́", "'s", "'ll", "don't", "in", "the "]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(3000)]
    encode = p.encoder(p.tokenizer_path()).encode
    for row, data, offsets in text_passes(pa.array(texts)):
        ids, first = encode(data, offsets)
        for i in range(len(offsets) - 1):
            want = tokenizer.encode(texts[row + i], add_special_tokens=False).ids
            assert ids[first[i] : first[i + 1]].tolist() == want, texts[row + i]


def test_added_tokens_have_their_ids(tokenizer):
    """The markers of start and end in a text, whole, cut off, in capitals, and halves that meet between rows."""
    rng = random.Random(4)
    signs = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "<", "|>", *"aB1 '\n.é", "don't", "\u0301"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 12))) for _ in range(2000)] + ["a <|endof", "text|> b", "<|endoftext|>"]
    encode, marked = p.encoder(p.tokenizer_path()).encode, 0
    for row, data, offsets in text_passes(pa.array(texts)):
        ids, first = encode(data, offsets)
        for i in range(len(offsets) - 1):
            want = tokenizer.encode(texts[row + i], add_special_tokens=False).ids
            marked += 49406 in want or 49407 in want
            assert ids[first[i] : first[i + 1]].tolist() == want, texts[row + i]
    assert marked > 500


def test_round_trip(awkward, tokenizer):
    rows = p.pack_documents(awkward).collect()
    sequences, docs = {}, {}
    for r in rows:
        assert len(r.ids) == 4 * r.length and r.length > 0
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.doc_id, []).append((r.start, r.length, bytes(r.ids), r.doc_tokens))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= p.WINDOW
    texts = {r.doc_id: r.text for r in awkward.collect() if r.doc_id not in (None, 5)}
    for key, text in texts.items():
        ids = b"".join(ids for _, _, ids, _ in sorted(docs[key]))
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, p.END_ID]
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert {d[3] for d in docs[key]} == {len(want)}
    assert len(docs[5]) == 2 and len(docs[None]) == 2


def slow_sum_of_squares(lengths, window):
    """The same rule by trying every level."""
    counts, fills = {}, []
    for length in lengths:
        best = None
        for fill in [0, *counts]:
            if fill + length > window or (fill and not counts.get(fill)):
                continue
            after = dict(counts)
            if fill:
                after[fill] -= 1
            if fill + length < window:
                after[fill + length] = after.get(fill + length, 0) + 1
            cost = sum(c * c for c in after.values())
            if best is None or (cost, -fill) < best[:2]:
                best = (cost, -fill, after)
        counts = best[2]
        fills.append(-best[1])
    return fills


@pytest.mark.parametrize("window", [7, 20, 64])
def test_sum_of_squares_rule(window):
    rng = random.Random(window)
    lengths = [rng.randint(1, window) for _ in range(400)]
    packer = p.SumOfSquares(window)
    assert [packer.place(n)[1] for n in lengths] == slow_sum_of_squares(lengths, window)


def test_little_padding():
    rng = random.Random(0)
    packer, total = p.SumOfSquares(), 0
    for _ in range(20_000):
        n = min(4096, int(rng.lognormvariate(6.3, 1)) + 1)
        total += n
        packer.place(n)
    assert 1 - total / (packer.sequences * p.WINDOW) < 0.02


def test_checksums(make_docs):
    row = p.pack_documents(make_docs((1, "the cat"))).selectExpr("crc32(ids) AS c", "ids").first()
    assert row.c == zlib.crc32(bytes(row.ids))


def test_empty_table(make_docs):
    assert p.pack_documents(make_docs((1, "x")).filter("doc_id < 0")).collect() == []
