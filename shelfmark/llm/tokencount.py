"""Token counts of a document's sections from one encoding of the whole document.

A document is encoded once. The tokens' byte spans are joined to the sections' spans, both sorted,
so that counts are those of the real token stream and not of sections encoded on their own.

Rule for a token that crosses a boundary: it belongs to the section that holds most of its bytes,
to the earlier one on a tie. A token with no byte in any section (a line end between two lines)
counts for section -1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bpe import PATTERN, codec_of, read_ranks

_OUT = "array<struct<section:int,start:int,end:int,n_tokens:int>>"
_CHARS = 1 << 20
_TYPE = pa.list_(pa.struct([(n, pa.int32()) for n in ("section", "start", "end", "n_tokens")]))


def _passed(marks: np.ndarray, size: int) -> np.ndarray:
    """How many of the marks are at or before each place from 0 to size."""
    return np.cumsum(np.bincount(np.minimum(marks, size + 1), minlength=size + 2))


def attribute(lengths: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Section of every token, -1 for none; sections are sorted, do not overlap and may be empty."""
    stop = np.cumsum(lengths)
    start = stop - lengths
    filled = np.flatnonzero(ends > starts)
    found = np.full(len(lengths), -1)
    if not len(filled) or not len(lengths):
        return found
    a, b = starts[filled], ends[filled]
    first, last = _passed(b, stop[-1])[start], _passed(a + 1, stop[-1])[stop] - 1
    one = first == last  # such a token has bytes in this section only
    found[one] = filled[first[one]]
    most = np.zeros(len(lengths), dtype=np.int64)
    token = np.flatnonzero(first < last)
    while len(token):
        at = first[token]
        shared = np.minimum(stop[token], b[at]) - np.maximum(start[token], a[at])
        better = shared > most[token]
        found[token[better]], most[token[better]] = filled[at[better]], shared[better]
        first[token] += 1
        token = token[first[token] <= last[token]]
    return found


def _sections(codec, lengths_of: np.ndarray, texts: list[str], spans: list | None) -> pa.Array:
    """Section, start, end and n_tokens of all texts, laid one after the other on one axis of bytes, so
    that one join of tokens and sections serves them all."""
    raw = [text.encode() for text in texts]
    ids, n_ids = codec.together(texts)
    size = np.fromiter(map(len, raw), np.int64, len(texts))
    stop = np.cumsum(size)
    base = stop - size
    byte = np.frombuffer(b"".join(raw), np.uint8)
    begins = (byte & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(begins)])  # characters that begin before a byte
    if spans is None:
        breaks = np.flatnonzero(byte == 10)
        starts, ends = np.sort(np.append(base, breaks + 1)), np.sort(np.append(breaks, stop))
        n = 1 + np.searchsorted(breaks, stop) - np.searchsorted(breaks, base)
        left = np.repeat(before[base], n)
        chars = np.column_stack([before[starts] - left, before[ends] - left])
    else:
        cut = [sorted((max(0, min(s["start"], len(text))), max(0, min(s["end"], len(text))))
                      for s in own) for text, own in zip(texts, spans, strict=True)]
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        chars = np.array([pair for own in cut for pair in own], np.int64).reshape(-1, 2)
        starts, ends = np.append(np.flatnonzero(begins), len(byte))[
            chars.T + np.repeat(before[base], n)]
    section = attribute(lengths_of[ids], starts, ends)
    counts = np.bincount(section[section >= 0], minlength=len(starts))
    outside = np.bincount(np.repeat(np.arange(len(texts)), n_ids)[section < 0], minlength=len(texts))
    after = np.cumsum(n)
    number = np.arange(len(starts)) - np.repeat(after - n, n)
    loose = np.flatnonzero(outside)
    columns = [np.insert(values, after[loose], of_none).astype(np.int32) for values, of_none in (
        (number, -1), (chars[:, 0], 0), (chars[:, 1], 0), (counts, outside[loose]))]
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(n + (outside > 0))]), pa.int32()),
        pa.StructArray.from_arrays(list(map(pa.array, columns)), fields=list(_TYPE.value_type)))


def _together(texts: list[str]) -> Iterator[slice]:
    """Ranges of texts of about ``_CHARS`` characters, or of one longer text."""
    start = size = 0
    for k, text in enumerate(texts, 1):
        size += len(text)
        if size >= _CHARS or k == len(texts):
            yield slice(start, k)
            start, size = k, 0


def section_counts(df: DataFrame, path: str, text: str = "text", spans: str | None = None,
                   pattern: str = PATTERN) -> DataFrame:
    """One row per document and section: the input's columns without text and spans, then section
    (from 0, -1 for tokens outside), start and end (characters) and n_tokens.

    ``spans`` names a column array<struct<start,end>> of character spans without overlaps; without
    it the lines of the text are the sections. A null text counts as empty: one empty section. Null
    spans mean no sections: such a document has a row only if it has tokens. Spans are cut to the
    text. Input columns named like the added ones are replaced.
    """
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(path))
    with_lines = spans is None

    @F.arrow_udf(_OUT)
    def count(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        codec = codec_of(ranks.value, pattern)
        lengths = np.zeros(max(codec.tokens) + 1, dtype=np.int64)
        for rank, token in codec.tokens.items():
            lengths[rank] = len(token)
        for texts, given in batches:
            texts = [text or "" for text in texts.to_pylist()]
            given = None if with_lines else [own or [] for own in given.to_pylist()]
            yield pa.concat_arrays([pa.array([], _TYPE), *(
                _sections(codec, lengths, texts[part], given and given[part])
                for part in _together(texts))])

    given = F.lit(0) if with_lines else F.col(f"`{spans}`")
    kept = [c for c in df.columns if c not in (text, spans, "section", "start", "end", "n_tokens")]
    return (df.withColumn("_counts", count(F.col(f"`{text}`"), given))
            .select(*[f"`{c}`" for c in kept], F.inline("_counts")))
