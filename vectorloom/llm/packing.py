"""Token packing: documents as token ids, placed online by the sum-of-squares rule."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from vectorloom.llm.textops import LOWER, SpanHashes, give_back, text_passes

WINDOW = 4096
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
# Words whose ids a Python worker keeps; beyond that it starts anew.
CACHED_WORDS = 600_000
# Sequence numbers: partition in the upper bits, sequence of the partition in the lower ones.
_PARTITION_SHIFT = 40

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Byte classes: white space ends a word; letters, digits and punctuation are told apart where that is
# certain from ASCII alone. Bytes above 127 and the apostrophe (it opens contractions) never make a cut.
_SPACE, _OPEN, _LETTER, _DIGIT, _PUNCT = range(5)
_CLASS = np.full(256, _OPEN, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[ord("A") : ord("Z") + 1] = _CLASS[ord("a") : ord("z") + 1] = _LETTER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[[c for c in b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"]] = _PUNCT


def part_spans(
    data: np.ndarray, offsets: np.ndarray, whole: tuple[tuple[int, int], ...] = ()
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that the tokenizer never merges across, and the index of each row's first span.

    Each place (start, end) in ``whole`` is a span of its own.
    """
    kind = _CLASS[data]
    before, here = kind[:-1], kind[1:]
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = (here == _SPACE) | (before == _SPACE)
    cut[1:-1] |= (before != here) & (np.minimum(before, here) > _OPEN)
    cut[1:-1] |= (before == _DIGIT) & (here == _DIGIT)
    cut[offsets] = True
    for start, end in whole:
        cut[start : end + 1] = False
        cut[[start, end]] = True
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    words = kind[starts] != _SPACE if len(starts) else np.zeros(0, bool)
    starts, ends = starts[words], ends[words]
    return starts, ends, np.searchsorted(starts, offsets, "left")


class WordEncoder:
    """Token ids of texts for a tokenizer that lower-cases and never merges across white space.

    Distinct spans of a pass are found by hash; ids of spans seen before come from a table, those of
    new ones from the tokenizer. Plain lower-case words, a token each up to its end-of-word token, are
    encoded many in a row. The tokenizer's added tokens, such as its markers of start and end, are found in
    the text first, as the tokenizer does, and have their own ids.
    """

    _PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch
    _TOGETHER = 256

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added.values()):
            raise ValueError(f"{path}: added tokens that are not matched as they stand")
        self.added = {t.content.encode(): i for i, t in added.items()}
        longest_first = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.is_added = re.compile(b"|".join(longest_first) or b"(?!)")
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.number: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.first = np.zeros(1 << 16, np.int64)
        self.count = np.zeros(1 << 16, np.int64)

    def _encode(self, texts: list[str]) -> list:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _new_words(self, words: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(words)
        plain = [i for i, w in enumerate(words) if self._PLAIN(w)]
        for k in range(0, len(plain), self._TOGETHER):
            some = plain[k : k + self._TOGETHER]
            ids = np.array(self._encode([" ".join(words[i] for i in some)])[0], np.uint32)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(some):
                for i, one in zip(some, np.split(ids, ends[:-1])):
                    out[i] = one
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self._encode([words[i] for i in rest])):
            out[i] = np.array(ids, np.uint32)
        return out

    def _add(self, hashes: list[int], words: list[str]) -> None:
        new = self._new_words(words)
        sizes = np.array([len(x) for x in new], np.int64)
        block = np.concatenate(new)
        at = len(self.number)
        while self.used + len(block) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while at + len(new) > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
        self.ids[self.used : self.used + len(block)] = block
        self.first[at : at + len(new)] = self.used + np.cumsum(sizes) - sizes
        self.count[at : at + len(new)] = sizes
        self.used += len(block)
        self.number.update(zip(hashes, range(at, at + len(new))))

    def _added(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, end, id) of the added tokens in each row."""
        raw = data.tobytes()
        if not self.is_added.search(raw):
            return []
        return [
            (*found.span(), self.added[found[0]])
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())
            for found in self.is_added.finditer(raw, a, b)
        ]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a pass, and where each row's ids begin (one entry more than rows)."""
        if len(self.number) > CACHED_WORDS:
            self._forget()
        added = self._added(data, offsets)
        data = LOWER[data]
        starts, ends, row_words = part_spans(data, offsets, tuple(a[:2] for a in added))
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        distinct, sample, which = np.unique(SpanHashes(data).of(starts, ends), return_index=True, return_inverse=True)
        keys = distinct.tolist()
        numbers = list(map(self.number.get, keys))
        missing = [i for i, n in enumerate(numbers) if n is None]
        if missing:
            raw = data.tobytes()
            words = [raw[starts[j] : ends[j]].decode() for j in sample[missing].tolist()]
            self._add([keys[i] for i in missing], words)
            numbers = list(map(self.number.__getitem__, keys))
        word = np.array(numbers, np.int64)[which]
        count = self.count[word]
        at = np.searchsorted(starts, [a[0] for a in added])
        count[at] = 1
        stop = np.cumsum(count)
        ids = self.ids[np.repeat(self.first[word] - (stop - count), count) + np.arange(stop[-1])]
        ids[stop[at] - 1] = [a[2] for a in added]
        return ids, np.concatenate([[0], stop])[row_words]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and tokenizer."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


class SumOfSquares:
    """Online placement into windows: the level array holds how many open windows have which fill.

    A piece goes to the fill level (or a new window) that makes the sum of squared counts of partially
    filled windows smallest; ties go to the fullest window. Windows of one level are interchangeable, so
    each level keeps a stack of them.
    """

    def __init__(self, window: int = WINDOW) -> None:
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[int]] = {}
        self.sequences = 0

    def _new(self) -> int:
        self.sequences += 1
        return self.sequences - 1

    def place(self, length: int) -> tuple[int, int]:
        """Sequence and offset for a piece of 1 to ``window`` ids."""
        counts, window = self.counts, self.window
        if length == window:
            return self._new(), 0
        here, there = counts[: window - length + 1], counts[length:]
        change = 2 * (there - here + 1)
        change[-1] = 1 - 2 * here[-1]  # a full window counts no more
        change[here == 0] = np.iinfo(np.int64).max
        change[0] = 2 * there[0] + 1  # a new window
        fill = len(change) - 1 - int(np.argmin(change[::-1]))
        if fill:
            sequence = self.open[fill].pop()
            counts[fill] -= 1
        else:
            sequence = self._new()
        if fill + length < window:
            counts[fill + length] += 1
            self.open.setdefault(fill + length, []).append(sequence)
        return sequence, fill


def _placed(
    keys: pa.Array, row: int, ids: np.ndarray, firsts: np.ndarray, packer: SumOfSquares, base: int
) -> pa.RecordBatch:
    """The pieces of a run of documents from ``row`` on, whose ids begin at ``firsts``."""
    sizes = np.diff(firsts) + 1
    ends = np.cumsum(sizes)
    whole = np.full(int(ends[-1]), END_ID, "<u4")
    is_id = np.ones(len(whole), bool)
    is_id[ends - 1] = False
    whole[is_id] = ids
    pieces = -(-sizes // packer.window)
    of = np.repeat(np.arange(len(sizes)), pieces)
    start = (np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * packer.window
    length = np.minimum(sizes[of] - start, packer.window)
    placed = np.array([packer.place(n) for n in length.tolist()], np.int64)
    # pieces follow each other as their ids do
    cuts = np.concatenate([[0], np.cumsum(length * 4)])
    kind = pa.binary() if cuts[-1] < 1 << 31 else pa.large_binary()
    cuts = cuts.astype(np.int32 if kind == pa.binary() else np.int64)
    data = pa.Array.from_buffers(kind, len(of), [None, pa.py_buffer(cuts), pa.py_buffer(whole)]).cast(pa.binary())
    numbers = [pa.array(c, pa.int64()) for c in (sizes[of], base + placed[:, 0], placed[:, 1])]
    return pa.RecordBatch.from_arrays(
        [keys.take(pa.array(row + of)), pa.array(start), pa.array(length), data, *numbers],
        names=[f.split()[0] for f in PIECES.split(", ")],
    )


def pack_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, window: int = WINDOW
) -> DataFrame:
    """Pieces of packed sequences: document, place in the document, ids, sequence and offset.

    A document is its token ids and an end id. Longer ones are cut into whole windows and a rest; rests
    and short documents are placed by the sum-of-squares rule. Every scan partition packs on its own in
    one pass without a shuffle, so the open windows left at its end are the only padding and their number
    does not grow with the partition. A sequence number holds the partition in its upper bits.
    ``ids`` are little-endian unsigned 32-bit.

    A null or empty text is the end id alone. A null key stays null. Repeated rows are packed each. Extra
    columns are left out. Empty input gives no rows. A retried task repeats its numbers, as a scan
    partition reads the same rows in the same order.
    """
    path = path or tokenizer_path()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        packer = SumOfSquares(window)
        base = TaskContext.get().partitionId() << _PARTITION_SHIFT
        for batch in batches:
            keys = batch.column(0).cast(pa.int64())
            for row, data, offsets in text_passes(batch.column(1)):
                yield _placed(keys, row, *encode(data, offsets), packer, base)
        give_back()

    return docs.select(key, text).mapInArrow(pack, PIECES)
