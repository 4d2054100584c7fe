"""Which keywords a text contains, for keyword tables of any size, without a nested loop.

Every keyword is indexed under its head: the whole keyword if it has fewer than ``WHOLE`` characters,
else its beginning of the largest power of two that fits, so that heads have few lengths. Texts are
cut once into windows of these lengths. A map of fixed size, which may say yes wrongly but never no,
tells which windows may be heads; only these become rows, one per text and head, and meet the index by
equality. Behind a long head they bring what may follow it, so a text is neither shuffled nor searched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..scratch import settle

WHOLE = 16
_CHARS = 1 << 16        # characters whose windows are looked up at a time
_MAP_BITS = 24          # the map has at most so many numbers, 2 MB
_BASE = 0x9E3779B1


def _head_length(length: int) -> int:
    return length if length < WHOLE else 1 << (length.bit_length() - 1)


def _windows(text: str, lengths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Every length with the 32-bit numbers of all windows of that length, in their order."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    power = lambda n: np.uint32(pow(_BASE, n, 1 << 32))
    doubled = {1: codes * np.uint32(0x85EBCA6B)}
    for n in lengths:
        number, done = None, 0
        for step in (1 << k for k in range(n.bit_length())):
            if step not in doubled:
                half = doubled[step // 2]
                doubled[step] = half[:max(0, len(codes) - step + 1)] * power(step // 2) + half[step // 2:]
            if n & step:
                own = doubled[step][done:]
                number = own if number is None else number[:len(own)] * power(step) + own
                done += step
        yield n, number * np.uint32(0xC2B2AE35)


def _headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(0).to_pylist()
        heads = [word[:_head_length(len(word))] for word in words]
        numbers = [int(next(_windows(head, [len(head)]))[1][0]) for head in heads]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(heads, pa.string()),
                                          pa.array(numbers, pa.int64())], ["_word", "_head", "_number"])


def _found(texts: list[str], lengths: list[int], marked: np.ndarray, shift: np.uint32) -> dict:
    """By text (its number) and window that the map tells to be a head: what follows in the text, as
    far as a keyword of that head can reach."""
    whole, ends = "".join(texts), np.cumsum([len(text) for text in texts])
    found: dict[tuple[int, str], set[str]] = {}
    for start in range(0, len(whole), _CHARS):
        for n, numbers in _windows(whole[start:start + _CHARS + max(lengths, default=1) - 1], lengths):
            at = np.flatnonzero(marked[numbers[:_CHARS] >> shift]) + start
            of = np.searchsorted(ends, at, "right")
            inside = at + n <= ends[of]
            at, of = at[inside].tolist(), of[inside]
            if n < WHOLE:
                found.update(dict.fromkeys(zip(of.tolist(), [whole[i:i + n] for i in at], strict=True), ()))
            else:
                stops = np.minimum(ends[of], np.array(at, np.int64) + 2 * n - 1).tolist()
                for i, own, stop in zip(at, of.tolist(), stops, strict=True):
                    found.setdefault((own, whole[i:i + n]), set()).add(whole[i + n:stop])
    return found


def _cut(texts: DataFrame, lengths: list[int], marked: np.ndarray, bits: int) -> DataFrame:
    """_id, _head, _rests (null for heads that are whole keywords) of (_id, _text)."""
    shipped = texts.sparkSession.sparkContext.broadcast(marked)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = np.unpackbits(shipped.value.view(np.uint8), bitorder="little").view(bool)
        shift = np.uint32(32 - bits)
        for batch in batches:
            held, size = [], 0
            for row, text in enumerate(batch.column(1).to_pylist(), 1):
                held.append(text or "")
                size += len(held[-1])
                if size < _CHARS and row < batch.num_rows:
                    continue
                found = _found(held, lengths, heads, shift)
                own = pa.array([row - len(held) + k for k, _ in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(own), pa.array([head for _, head in found], pa.string()),
                     pa.array([list(rests) or None for rests in found.values()], pa.list_(pa.string()))],
                    ["_id", "_head", "_rests"])
                held, size = [], 0
    kind = texts.schema["_id"].dataType.simpleString()
    return texts.mapInArrow(cut, f"_id {kind}, _head string, _rests array<string>")


def contains_any_of(texts: DataFrame, id_column: str, text: str, keywords: DataFrame,
                    keyword: str = "keyword") -> DataFrame:
    """(id, keyword) for every keyword that a text contains, each pair once.

    ``texts`` is unique on its id. Both sides are compared as they are; fold their case first if it
    does not count. Null or empty keywords and null texts match nothing.
    """
    words = settle(keywords.select(F.col(keyword).alias("_word")).where(F.col("_word") != "").distinct()
                   .mapInArrow(_headed, "_word string, _head string, _number long"))
    # One row per length of heads: fewer than WHOLE and one per power of two.
    lengths = dict(words.groupBy(F.length("_head")).count().collect())
    bits = min(_MAP_BITS, max(10, sum(lengths.values()).bit_length() + 5))
    place = F.shiftright("_number", 32 - bits)
    marks = (words.select(F.shiftright(place, 6).alias("at"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
             .groupBy("at").agg(F.expr("bit_or(shiftleft(bigint(1), bit))").alias("held")).toArrow())
    marked = np.zeros(1 << (bits - 6), "<i8")  # 64 numbers each, so at most 2^18 rows came
    marked[marks["at"].to_numpy()] = marks["held"].to_numpy()
    known = _cut(texts.select(F.col(id_column).alias("_id"), F.col(text).alias("_text")),
                 sorted(lengths), marked, bits)
    # The index is a plain table, so that Spark broadcasts a small one and splits the rows of a head that
    # a large share of the texts hold when it is not.
    within = F.col("_rests").isNull() | F.exists(
        "_rests", lambda rest: F.concat("_head", rest).startswith(F.col("_word")))
    return (known.join(words.select("_head", "_word"), "_head").where(within)
            .select(F.col("_id").alias(id_column), F.col("_word").alias(keyword)))


def table_labels(texts: DataFrame, id_column: str, text: str, taxonomy: DataFrame) -> DataFrame:
    """(id, niche, sub_niche) from a taxonomy table (label, parent, ord, keyword); case is folded.

    The niche is the label of least ``ord`` without a parent any of whose keywords a text contains;
    the sub-niche is that of least ``ord`` below the text's niche. Null where there is none.
    """
    folded = texts.select(id_column, F.lower(text).alias("_lowered"))
    entries = taxonomy.select("label", "parent", "ord", F.lower("keyword").alias("_key"))
    found = contains_any_of(folded, id_column, "_lowered", entries, "_key")
    # Summed up per text and label before anything else, so a text full of keywords stays small.
    hits = found.join(entries, "_key").groupBy(id_column, "label", "parent").agg(F.min("ord").alias("ord"))
    best = hits.groupBy(id_column).agg(
        F.min_by("label", F.when(F.col("parent").isNull(), F.col("ord"))).alias("niche"),
        F.collect_list(F.when(F.col("parent").isNotNull(), F.struct("ord", "label", "parent"))).alias("_below"))
    below = F.filter("_below", lambda b: b["parent"] == F.col("niche"))
    labelled = best.select(id_column, "niche", F.array_min(below)["label"].alias("sub_niche"))
    return texts.select(id_column).join(labelled, id_column, "left")
