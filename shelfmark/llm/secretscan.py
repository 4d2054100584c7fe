"""Secret scan: fixed patterns, and a battery of randomness tests for what no pattern names.

Candidates are maximal runs of at least ``LEAST`` characters of A-Z a-z 0-9 + / _ - (padding is not
counted) that touch no pattern's match and whose characters fit an encoding: hexadecimal, base 32,
36 or 62, base 64 or its URL form. Runs of digits alone, or of letters of one case with at most a
capital first, are numbers and words and have no encoding. A candidate's encoding is the smallest
alphabet that holds it; a hyphenated run is also tried without hyphens.

Three tests are made in that alphabet: chi-squared of the characters' frequencies against uniform
ones, the number of runs of lower-case letters (of digits, where the alphabet has one case) and of
other characters, and the serial correlation of neighbours. Each is held against two laws. Against true randomness: a candidate that one test
rejects at ``REJECT`` is no secret. Against ordinary writing, whose character and neighbour
frequencies are counted over all documents outside matches and candidates: the chance that writing
looks as random as this gives a p-value per test, the three are combined by Fisher's method, and
Benjamini-Hochberg at ``RATE`` decides within each class of lengths, so that the many short
candidates do not lend the few long ones their threshold or the reverse. p-values are rounded up
to steps of a twentieth of a decimal order, so a count per class and step is all the driver sees.

Defined cases: null text is empty; offsets are code points, ends are exclusive; repeated rows and
repeated or null ids are scanned one by one; an empty table gives no rows. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..scratch import settle

# The patterns and least lengths every scan applies.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)"
                    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED = 6
KINDS = ["assign", "access", "hex", "random"]

LEAST = 20                     # characters of a candidate
REJECT = 1e-4                  # level at which a test rejects randomness
RATE = 0.001                   # false discovery rate within a class of lengths
LEAST_CHANGE = 0.1             # least rate of new runs in writing: names mix more than prose
LENGTHS = [28, 40, 64, 128]    # classes: below 28, below 40, ...
STEPS = 20                     # steps of a p-value in a decimal order
FINEST = 40 * STEPS

DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = DIGITS + UPPER + LOWER + "+/_-"
ENCODINGS = [DIGITS + "abcdef", DIGITS + "ABCDEF", UPPER + "234567", DIGITS + LOWER, DIGITS + UPPER,
             UPPER + LOWER + DIGITS, UPPER + LOWER + DIGITS + "+/", UPPER + LOWER + DIGITS + "-_"]
_WORD = re.compile(r"[A-Z]?[a-z]*|[A-Z]+|[0-9]+")
_OTHER = len(SYMBOLS)
_CODES = np.full(129, _OTHER, np.uint8)
_CODES[[ord(c) for c in SYMBOLS]] = np.arange(_OTHER, dtype=np.uint8)
_VALUES = [np.array([e.find(s) for s in SYMBOLS]) for e in ENCODINGS]    # -1: not in the alphabet
_MARKED = [np.array([c in LOWER if UPPER + LOWER in e else c in DIGITS + "+/-_" for c in e])
           for e in ENCODINGS]


def _serial(values: np.ndarray) -> float:
    """Correlation of neighbours; 1 where a side does not vary."""
    left, right = values[:-1], values[1:]
    return float(np.corrcoef(left, right)[0, 1]) if np.ptp(left) and np.ptp(right) else 1.0


def battery(token: str) -> tuple[int, int, float, int, float] | None:
    """(encoding, characters, chi-squared, changes from run to run, serial correlation)."""
    if all(_WORD.fullmatch(part) for part in re.split(r"[+/_-]", token)):
        return None
    plain = token.replace("-", "")
    for number, alphabet in enumerate(ENCODINGS):
        for form in (token, plain) if number < 5 else (token,):
            if len(form) < LEAST or not set(form) <= set(alphabet):
                continue
            values = _VALUES[number][_CODES[np.frombuffer(form.encode(), np.uint8)]]
            size, n = len(alphabet), len(form)
            seen = np.bincount(values, minlength=size).astype(float)
            high = _MARKED[number][values]
            return (number, n, float((seen**2).sum()) * size / n - n,
                    int((high[1:] != high[:-1]).sum()), _serial(values))
    return None


def _overlaps(start: int, end: int, spans: list[tuple[int, int]]) -> bool:
    return any(s < end and start < e for s, e in spans)


def patterns(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of every match of a pattern, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
             if len(m.group(2)) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return found


class _Counts:
    """Neighbouring symbols of ordinary writing, counted over all texts of a task."""

    def __init__(self):
        self.pairs = np.zeros((_OTHER + 1) ** 2, np.int64)

    def scan(self, text: str) -> tuple[list, list]:
        """Matches and candidates of one text; the rest of it is counted."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        codes = _CODES[np.minimum(points, 128)]
        edges = np.flatnonzero(np.diff((codes < _OTHER).astype(np.int8), prepend=0, append=0))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= LEAST
        found, runs = patterns(text), list(zip(starts[long].tolist(), ends[long].tolist()))
        for start, end in runs:
            found += [(m.start(), 2, m.end()) for m in HEX.finditer(text, start, end)]
        found.sort()
        taken = [(start, end) for start, _, end in found]
        candidates = []
        for start, end in runs:
            if not _overlaps(start, end, taken):
                tested = battery(text[start:end])
                if tested:
                    candidates.append((start, end, *tested))
        skipped = taken + [(c[0], c[1]) for c in candidates]
        if skipped:
            codes = codes.copy()
            for start, end in skipped:
                codes[start:end] = _OTHER
        if len(codes) > 1:
            self.pairs += np.bincount(codes[:-1].astype(np.intp) * (_OTHER + 1) + codes[1:],
                                      minlength=self.pairs.size)
        return found, candidates


_SCANNED = ("_counted boolean, _pair int, _n long, "
            "base array<struct<start:int,kind:int,end:int>>, "
            "candidates array<struct<start:int,end:int,encoding:int,n:int,chi:double,"
            "changes:int,serial:double>>")


def _id(rows: DataFrame) -> T.StructField:
    return T.StructField("doc_id", rows.schema["doc_id"].dataType)


def _scanned(docs: DataFrame) -> DataFrame:
    """A row per document with its matches and candidates, and per task the counted pairs."""
    narrow = docs.select("doc_id", "text")
    kind = T.StructType([_id(narrow), *T.StructType.fromDDL(_SCANNED).fields])
    arrow = to_arrow_schema(kind)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(v, f.type) for v, f in zip(zip(*rows), arrow)], schema=arrow)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()
        for rows in batches:
            done = []
            for doc, text in zip(rows.column(0).to_pylist(), rows.column(1)):
                done.append((doc, False, None, None, *counts.scan(text.as_py() or "")))
            if done:
                yield batch(done)
        held = np.flatnonzero(counts.pairs)
        if held.size:
            yield batch([(None, True, pair, n, None, None) for pair, n in
                         zip(held.tolist(), counts.pairs[held].tolist())])

    return settle(narrow.mapInArrow(scan, kind))


class Writing:
    """Per encoding: the law of the three tests for ordinary writing."""

    def __init__(self, pairs: np.ndarray):
        """``pairs``: counts of neighbouring symbols; every pair is counted once more, so that an
        empty corpus gives uniform frequencies."""
        self.laws = []
        for values in _VALUES:
            own = np.flatnonzero(values >= 0)
            order = own[np.argsort(values[own])]
            counts = pairs[np.ix_(order, order)].astype(float) + 1
            counts /= counts.sum()
            size = len(order)
            shares = counts.sum(axis=1)
            high = _MARKED[len(self.laws)]
            change = max(LEAST_CHANGE, counts[high[:, None] != high[None, :]].sum())
            at = np.arange(size)
            left, right = shares @ at, counts.sum(axis=0) @ at
            spread = math.sqrt((shares @ at**2 - left**2) * (counts.sum(axis=0) @ at**2 - right**2))
            serial = (at @ counts @ at - left * right) / spread
            self.laws.append((size, float((shares**2).sum()), float((shares**3).sum()),
                              float(change), float(serial), float(high.mean() * (1 - high.mean()))))

    def p_value(self, encoding: int, n: int, chi: float, changes: int, serial: float) -> float:
        """The chance that writing looks as random; 1 for what is not random in its encoding."""
        size, squares, cubes, change, correlation, both = self.laws[encoding]
        spread = math.sqrt((n - 1) * 2 * both * (1 - 2 * both)
                           + 2 * (n - 2) * both * (1 - 4 * both))
        random = (_upper((chi - size + 1) / math.sqrt(2 * (size - 1) * (n - 1) / n)),
                  2 * _upper(abs(changes - (n - 1) * 2 * both) / spread),
                  2 * _upper(abs(serial) * math.sqrt(n)))
        if min(random) < REJECT:
            return 1.0
        mean = size * (1 - squares) + size * n * squares - n
        variance = 2 * n * (n - 1) * (squares + 2 * (n - 2) * cubes - (2 * n - 3) * squares**2)
        toward = 1 if change < 2 * both else -1
        less = 1 if correlation < 0 else -1
        tests = ((mean - chi) / max(size / n * math.sqrt(max(variance, 0)), 1e-9),
                 toward * (changes - (n - 1) * change) / math.sqrt((n - 1) * change * (1 - change)),
                 less * (serial - correlation) * math.sqrt(n))
        half = -sum(math.log(max(_upper(z), 1e-300)) for z in tests)
        return min(1.0, math.exp(-half) * (1 + half + half * half / 2))


def _upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _with_steps(scanned: DataFrame, writing: Writing) -> DataFrame:
    """Candidates as (start, end, length class, step of the p-value)."""
    rows = scanned.where(~F.col("_counted")).select("doc_id", "base", "candidates")
    kind = T.StructType([_id(rows), rows.schema["base"], *T.StructType.fromDDL(
        "candidates array<struct<start:int,end:int,length:int,step:int>>").fields])
    arrow = to_arrow_schema(kind)

    def tested(c: dict) -> tuple:
        p = writing.p_value(c["encoding"], c["n"], c["chi"], c["changes"], c["serial"])
        step = min(FINEST, int(-math.log10(max(p, 1e-300)) * STEPS))
        return c["start"], c["end"], sum(c["n"] >= least for least in LENGTHS), step

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[tested(c) for c in row] for row in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow.field(0).type), batch.column(1).cast(
                    arrow.field(1).type), pa.array(found, arrow.field(2).type)], schema=arrow)

    return settle(rows.mapInArrow(steps, kind))


def least_steps(counts: dict[tuple[int, int], int], rate: float = RATE) -> dict[int, int]:
    """Benjamini-Hochberg per class: the least step whose candidates are discoveries."""
    least = {}
    for length in {length for length, _ in counts}:
        steps = sorted(((s, n) for (c, s), n in counts.items() if c == length), reverse=True)
        total, taken = sum(n for _, n in steps), 0
        for step, n in steps:
            taken += n
            if 10 ** (-step / STEPS) <= rate * taken / total:
                least[length] = step
    return least


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, ``base`` (matches of the patterns) and ``spans`` (these and the random runs), both
    arrays of (start, kind: number in KINDS, end) in order of start and kind. One row per row."""
    scanned = _scanned(docs)
    pairs = np.zeros((_OTHER + 1) ** 2, np.int64)
    # At most one row per pair of symbols, 4,489 in all.
    for pair, n in scanned.where("_counted").groupBy("_pair").agg(F.sum("_n")).collect():
        pairs[pair] = n
    tested = _with_steps(scanned, Writing(pairs.reshape(_OTHER + 1, _OTHER + 1)))
    # At most FINEST + 1 rows per class of lengths.
    counts = {(c, s): n for c, s, n in tested.select(F.inline("candidates")).groupBy(
        "length", "step").count().collect()}
    least = least_steps(counts, rate)
    bounds = F.array(*[F.lit(least.get(c, FINEST + 1)) for c in range(len(LENGTHS) + 1)])
    random = F.transform(
        F.filter("candidates", lambda c: c["step"] >= F.get(bounds, c["length"])),
        lambda c: F.struct(c["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"),
                           c["end"].alias("end")))
    return tested.select("doc_id", "base", F.sort_array(F.concat("base", random)).alias("spans"))


def listed(spans: str):
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: str, kind: str):
    """Spans of a kind, as a long."""
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")
