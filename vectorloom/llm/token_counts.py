"""Token counts by field or section: a document is encoded once and its tokens are joined to spans.

Every token covers characters of the document, found from the byte lengths of the tokens before it. A
token inside one section belongs to it; one that crosses a border is allocated by a stated rule:

* ``start``: the section that holds its first character;
* ``most``: the section that holds most of its characters, the earlier one on a tie;
* ``share``: every section in proportion to the characters it holds.

Counts of sections that cover a text add up to the count of the whole text under each rule.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = ("start", "most", "share")
TOKENIZER = "byte_bpe_50k.tiktoken"
SPANS = "array<struct<name: string, start: long, end: long>>"
# Texts of about this many bytes are turned into one Arrow batch.
BATCH_BYTES = 4 << 20


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ByteEncoder:
    """Token ids of a text and the byte length of every id."""

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        self.lengths[list(ranks.values())] = [len(token) for token in ranks]

    def byte_ends(self, text: str) -> np.ndarray:
        ids = self.encoding.encode_ordinary(text)
        return np.cumsum(self.lengths[np.array(ids, np.int64)])


_ENCODERS: dict[str, ByteEncoder] = {}


def encoder(path: str) -> ByteEncoder:
    """One encoder per Python worker and tokenizer."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteEncoder(path)
    return _ENCODERS[path]


def character_spans(text: str, byte_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token and the one after its last.

    A token that holds only a part of a character's bytes covers that character.
    """
    data = np.frombuffer(text.encode(), np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    begins = np.concatenate([[0], byte_ends[:-1]])[: len(byte_ends)]
    return character[begins], character[byte_ends - 1] + 1


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lines with their line feed; a text that ends in one has an empty last line."""
    feeds = [i + 1 for i, c in enumerate(text) if c == "\n"] if "\n" in text else []
    starts = np.array([0, *feeds], np.int64)
    return starts, np.append(starts[1:], len(text))


def allocate(
    token_starts: np.ndarray, token_ends: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and border-crossing tokens per section; sections ascend and don't overlap, gaps are allowed.

    A token that lies in no section counts nowhere. Crossing tokens count at every section they touch.
    """
    n = len(starts)
    counts, crossing = np.zeros(n), np.zeros(n, np.int64)
    if not n or not len(token_starts):
        return counts, crossing
    # the last section that begins at or before a character; empty sections hold nothing
    full = np.flatnonzero(ends > starts)
    if not len(full):
        return counts, crossing
    at = np.searchsorted(starts[full], token_starts, "right") - 1
    inside = (at >= 0) & (token_ends <= ends[full][at])
    counts[full] += np.bincount(at[inside], minlength=len(full))
    for i in np.flatnonzero(~inside):
        a, b = token_starts[i], token_ends[i]
        touched = full[(starts[full] < b) & (ends[full] > a)] if len(full) < 64 else _touched(starts, ends, full, a, b)
        if not len(touched):
            continue
        held = np.minimum(ends[touched], b) - np.maximum(starts[touched], a)
        crossing[touched] += 1
        if rule == "share":
            counts[touched] += held / (b - a)
        elif rule == "most":
            counts[touched[np.argmax(held)]] += 1
        elif starts[touched[0]] <= a:
            counts[touched[0]] += 1
    return counts, crossing


def _touched(starts: np.ndarray, ends: np.ndarray, full: np.ndarray, a: int, b: int) -> np.ndarray:
    first = max(int(np.searchsorted(starts[full], a, "right")) - 1, 0)
    last = int(np.searchsorted(starts[full], b, "left"))
    some = full[first:last]
    return some[ends[some] > a]


def with_fields(df: DataFrame, fields: list[str], separator: str = "\n") -> DataFrame:
    """``df`` with a text made of the fields and a ``spans`` column that says where each one is.

    A null field is empty. The separators belong to no field.
    """
    values = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    text = reduce(lambda a, b: F.concat(a, F.lit(separator), b), values)
    spans, at = [], F.lit(0).cast("long")
    for name, value in zip(fields, values):
        end = at + F.char_length(value)
        spans.append(F.struct(F.lit(name).alias("name"), at.alias("start"), end.alias("end")))
        at = end + len(separator)
    return df.withColumns({"text": text, "spans": F.array(*spans).cast(SPANS)})


def attribute_tokens(
    docs: DataFrame, key: str = "doc_id", text: str = "text", spans: str | None = None, rule: str = "most",
    path: str | None = None,
) -> DataFrame:
    """(key, section, name, n_tokens, n_chars, n_crossing, doc_tokens), a row per section.

    ``spans`` names a column of (name, start, end) in characters, ascending and apart; without it the
    sections are the lines, line feeds included, without a name. ``n_tokens`` is a count, or a sum of
    shares under ``share``; ``n_crossing`` counts tokens that cross a border of the section.

    A null or empty text is one empty line with no tokens; null spans give no rows. Null keys and repeated
    rows are counted row by row. Extra columns are left out. Empty input gives no rows.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {', '.join(RULES)}")
    path = path or tokenizer_path()
    names = [key, "section", "name", "n_tokens", "n_chars", "n_crossing", "doc_tokens"]
    key_kind = docs.schema[key].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            texts = batch.column(1)
            rows, parts, size = [], [], 0

            def finish() -> pa.RecordBatch:
                columns = [np.concatenate(c) if len(c) else np.zeros(0) for c in zip(*[p[:-1] for p in parts])]
                labels = [label for p in parts for label in p[-1]]
                sizes = [len(p[0]) for p in parts]
                section, tokens, chars, crossing, total = columns
                of = batch.column(0).take(pa.array(np.repeat(rows, sizes), pa.int64()))
                values = [
                    of, pa.array(section, pa.int64()), pa.array(labels, pa.string()), pa.array(tokens, pa.float64()),
                    pa.array(chars, pa.int64()), pa.array(crossing, pa.int64()), pa.array(total, pa.int64()),
                ]
                return pa.RecordBatch.from_arrays(values, names=names)

            for i in range(batch.num_rows):
                content = texts[i].as_py() or ""
                if spans is None:
                    starts, ends = line_spans(content)
                    labels = [None] * len(starts)
                else:
                    given = batch.column(2)[i].as_py() or []
                    starts = np.array([s["start"] for s in given], np.int64)
                    ends = np.array([s["end"] for s in given], np.int64)
                    labels = [s["name"] for s in given]
                byte_ends = encode.byte_ends(content) if content else np.zeros(0, np.int64)
                token_starts, token_ends = (
                    character_spans(content, byte_ends) if len(byte_ends) else (byte_ends, byte_ends)
                )
                counts, crossing = allocate(token_starts, token_ends, starts, ends, rule)
                total = np.full(len(starts), len(byte_ends))
                rows.append(i)
                parts.append((np.arange(len(starts)), counts, ends - starts, crossing, total, labels))
                size += len(content)
                if size > BATCH_BYTES:
                    yield finish()
                    rows, parts, size = [], [], 0
            if rows:
                yield finish()

    wanted: list[str | Column] = [key, text] if spans is None else [key, text, F.col(spans).cast(SPANS).alias(spans)]
    counted = docs.select(*wanted).mapInArrow(
        count,
        f"`{key}` {key_kind}, section long, name string, n_tokens double, n_chars long, n_crossing long, doc_tokens long",
    )
    return counted if rule == "share" else counted.withColumn("n_tokens", F.col("n_tokens").cast("long"))
