"""Jaccard join on word n-grams with token-combination prefixes.

Every text becomes a set of shingles; two texts link when 100 * |A and B| >= percent * |A or B|.
Equal sets are one node. All shingles have one global order: *rare* ones first (known and seldom),
then the *frequent* class. At most tau = n - ceil(percent * n / 100) shingles of a set of n can be
missing in a partner, so a prefix whose signatures need more than tau losses to vanish shares one:

* a set with tau + 1 rare shingles is indexed by these alone, each a signature of its own;
* any other set extends its prefix over all the rest, which is dealt into G subclasses by shingle
  number, and is indexed by its rare shingles and by one combination per subclass: all its shingles
  there, about six. Linked sets without a common rare shingle differ in at most D of the others (see
  ``_differ``), so one of more than D filled subclasses is the same in both. G depends on the size
  class only, so partners agree on it; a set is indexed for its own class and the next one, and
  partners' sizes are at most one class apart;
* where chance leaves a set D filled subclasses or fewer, it is indexed by pairs as well: a subclass
  of which a prefix holds p shingles needs p - 1 losses, so the prefix grows until the rare shingles
  and these sum to tau + 1. Of two partners either one has enough subclasses, or both have pairs.

Sets of fewer than four shingles can only link with equal ones, which needs no index.

Any fixed classes give right results; counts only make them selective. All documents are counted,
for shingles whose number lies in the lowest ``KNOWN`` part of the range: prefixes lie there, as the
order within a class is that of the numbers. What is shipped to the tasks has a fixed size: at most
2^20 frequent shingles and a map of 2^26 bits that tells which shingles occur more than once. The
map may say so wrongly, never the opposite, so a fuller map costs time, not results.

Candidates: within a signature, everything is first compared with one head only; linked sets become
components. Then the members of different components of a signature are compared, without the head,
which has met them all, so that no component is missed, while a large group of near copies costs as
many comparisons as it has members. Before that, 256 parity bits per set bound from below how many
shingles differ (common ones cancel out), and a longer parity sketch, whose bits grow with the set,
does the same for what they let pass, both within the join itself, so that a large group of similar
sets that do not link leaves few rows, however large the sets; the places of the shared shingles in
the global order bound what a pair can share at most. The pairs with heads meet the sketch as well,
before any text is sent. None of these bounds drops a linked pair. Sets are
compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..scratch import settle
from .components import components
from .shingles import mixed, shingle_lists, shingle_sets

KNOWN = 0.2
SELDOM = 32
_FREQUENT_MOST = 1 << 20
_MAP_WORDS = 1 << 20  # of 64 bits
_BLOCK = 512
_TASK_BYTES = 16 << 20
_PARITY = ["p0", "p1", "p2", "p3"]  # 64 buckets each
_COMBINED = 1 << 32  # keeps numbers of combinations apart from those of pairs
_ROWS = 1_000  # rows whose texts a task holds as Python strings at a time
_LEAST = 4  # smaller sets link with equal ones only, from 80 percent on


def _known_below(known: float) -> np.uint64:
    return np.uint64(int(known * 2 ** 64) - 1)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows, in batches of ``_ROWS`` at most."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            yield batch.slice(start, _ROWS)


# -- counts ----------------------------------------------------------------------------------------

def _counted(texts: DataFrame, width: int, known: float) -> DataFrame:
    """Shingle numbers in the known range that occur in more than one row: token, n."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below = _known_below(known)
        for batch in _small(batches):
            found = []
            for tokens in shingle_lists(batch.column(0).to_pylist(), width):
                found.append(np.unique(tokens[tokens < below]))
            tokens, n = np.unique(np.concatenate(found), return_counts=True) if found else ((), ())
            if len(tokens):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens.view(np.int64)), pa.array(n.astype(np.int64))], ["token", "n"])
    return (texts.mapInArrow(count, "token long, n long")
            .groupBy("token").agg(F.sum("n").alias("n")).where("n > 1"))


def _bits(df: DataFrame, column: str) -> np.ndarray:
    """A map of 2^26 bits of the column's numbers: at most 2^20 rows come to the driver."""
    rows = (df.select((F.shiftright(column, 6).bitwiseAND(F.lit(_MAP_WORDS - 1))).alias("w"),
                      F.expr(f"shiftleft(bigint(1), int({column} & 63))").alias("b"))
            .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    words = np.zeros(_MAP_WORDS, np.uint64)
    words[rows["w"].to_numpy()] = rows["b"].to_numpy().view(np.uint64)
    return words


def _in_bits(words: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    numbers = numbers.view(np.uint64)
    at = (numbers >> np.uint64(6)) & np.uint64(_MAP_WORDS - 1)
    return (words[at] >> (numbers & np.uint64(63))) & np.uint64(1) > 0


def _frequent(counts: DataFrame, seldom: int) -> np.ndarray:
    """The frequent shingles; the bound is raised until they are at most 2^20."""
    sizes = dict(counts.where(F.col("n") > seldom).groupBy(
        F.floor(F.log2(F.col("n") / seldom)).alias("step")).count().collect())  # 64 rows at most
    step = 0
    while sum(n for s, n in sizes.items() if s >= step) > _FREQUENT_MOST:
        step += 1
    kept = counts.where((F.col("n") > seldom) & (F.floor(F.log2(F.col("n") / seldom)) >= step))
    return np.sort(kept.select("token").toArrow()["token"].to_numpy().view(np.uint64))


# -- signatures ------------------------------------------------------------------------------------

class _Index:
    """Signatures of a set, given the classes, each with its shingle's place in the global order
    (-1 for a combination)."""

    def __init__(self, frequent, repeated, percent: int, known: float):
        self.frequent, self.repeated, self.percent = frequent, repeated, percent
        self.below = _known_below(known)
        bounds = [1.0]
        while bounds[-1] < 2 ** 40:
            bounds.append(bounds[-1] * 100 / percent)
        self.bounds = np.array(bounds)

    def __call__(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(tokens)
        if n < _LEAST:
            return tokens[:0], np.empty(0, np.int32)
        allowed = n - -(-self.percent * n // 100) + 1  # tau + 1
        known = tokens[:np.searchsorted(tokens, self.below)]
        seldom = known[~self._is_frequent(known)]
        singles = seldom[:allowed]
        place = np.flatnonzero(_in_bits(self.repeated, singles))
        kept = [singles[place]]
        if len(singles) < allowed:
            often = np.setdiff1d(tokens, seldom, assume_unique=True)  # in the order of numbers
            level = int(np.searchsorted(self.bounds, n, "right"))
            for at in (level, level + 1):
                combined = self._combinations(often, at)
                kept.append(combined)
                if len(combined) <= self._differ(n, at) - len(singles):
                    kept.append(self._pairs(often, allowed - len(singles), at))
        sigs = np.concatenate(kept)
        return sigs, np.pad(place, (0, len(sigs) - len(place)), constant_values=-1).astype(np.int32)

    def _is_frequent(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.frequent):
            return np.zeros(len(tokens), bool)
        at = np.minimum(np.searchsorted(self.frequent, tokens), len(self.frequent) - 1)
        return self.frequent[at] == tokens

    def _differ(self, n: int, level: int) -> int:
        """The most shingles by which a set of n can differ from one it links with, if that one is
        below the level's size bound: (100 - percent) percent of the most their union can hold."""
        union = min(n / self.percent, (n + self.bounds[level]) / (100 + self.percent))
        return int((100 - self.percent) * union + 1e-9)

    def _combinations(self, often: np.ndarray, level: int) -> np.ndarray:
        """One number for all shingles of each filled subclass."""
        if not len(often):
            return often
        groups = (100 - self.percent) * 2 * self.bounds[level] / (100 + self.percent)
        groups = int(groups * 1.02) + 2  # a few may stay empty
        salt = mixed(np.array([level], np.uint64) + np.uint64(_COMBINED))
        group = mixed(often ^ salt) % np.uint64(groups)
        order = np.argsort(group, kind="stable")
        group = group[order]
        start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        held = np.add.reduceat(mixed(often + salt)[order], start)
        return mixed(held + mixed(group[start] + salt))

    def _pairs(self, often: np.ndarray, needed: int, level: int) -> np.ndarray:
        groups = int(np.ceil(self.bounds[level] * (100 - self.percent) / 100)) + 1
        salt = mixed(np.array([level], np.uint64))
        group = mixed(often ^ salt) % np.uint64(groups)
        # A shingle adds a needed loss unless it is the first of its subclass.
        first = np.zeros(len(often), bool)
        first[np.unique(group, return_index=True)[1]] = True
        gained = np.cumsum(~first)
        stop = int(np.searchsorted(gained, needed)) + 1
        order = np.argsort(group[:stop], kind="stable")
        token, group = often[:stop][order], group[:stop][order]
        out = []
        for step in range(1, len(token)):
            same = np.flatnonzero(group[step:] == group[:-step])
            if not len(same):
                break
            out.append(mixed(token[same] + mixed(token[same + step] + salt)))
        return np.concatenate(out) if out else often[:0]


def _prepared(docs: DataFrame, width: int, percent: int, known: float, frequent, repeated):
    """doc_id, text_no (number of the text), n, node (number of the set, null if empty), sigs, parity
    bits and sketch of the set."""
    shipped = docs.sparkSession.sparkContext.broadcast((frequent, repeated))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Index(*shipped.value, percent, known)
        for batch in _small(batches):
            sizes, nodes, sigs, places, parity, sketches = [], [], [], [], [], []
            for tokens in shingle_sets(batch.column(1).to_pylist(), width):
                sizes.append(len(tokens))
                nodes.append(_node(tokens))
                parity.append(_parity(tokens))
                sketches.append(_sketch(tokens))
                for out, found in zip((sigs, places), index(tokens), strict=True):
                    out.append(found)
            ends = np.cumsum([0, *map(len, sigs)]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.uint64), *sigs])
            place = np.concatenate([np.empty(0, np.int32), *places])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(place)),
                 pa.array(sketches, pa.binary()),
                 *map(pa.array, np.array(parity, np.int64).reshape(-1, len(_PARITY)).T)],
                ["doc_id", "text_no", "n", "node", "sigs", "places", "sketch", *_PARITY])
    return docs.withColumn("text_no", F.xxhash64("text")).mapInArrow(
        prepare, "doc_id long, text_no long, n long, node long, sigs array<long>, places array<int>, "
        "sketch binary, " + ", ".join(f"{p} long" for p in _PARITY))


def _node(tokens: np.ndarray) -> int | None:
    """The number of a set: a signed 64-bit digest of its shingle numbers."""
    if not len(tokens):
        return None
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).view(np.int64))


def _parity(tokens: np.ndarray) -> np.ndarray:
    """Per bucket of the number range, whether it holds an odd number of shingles."""
    counts = np.bincount((tokens >> np.uint64(56)).astype(np.int64), minlength=64 * len(_PARITY))
    return np.packbits((counts & 1).astype(bool)).view(np.int64)


def _sketch(tokens: np.ndarray) -> bytes:
    """Parity bits as in ``_parity``, but at least one per shingle, dealt by the numbers' low ends: two
    halves of a sketch give the sketch of half the length."""
    bits = 64
    while bits < len(tokens):
        bits *= 2
    counts = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def _odd(a: bytes, b: bytes) -> int:
    """In how many bits two sketches differ: at most in as many as the sets differ in shingles."""
    x, y = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    while len(y) > len(x):
        half = len(y) // 2
        y = y[:half] ^ y[half:]
    return int(np.bitwise_count(x ^ y).sum())


# -- candidates and links --------------------------------------------------------------------------

def _verified(docs: DataFrame, owners: DataFrame, pairs: DataFrame, width: int,
              percent: int) -> DataFrame:
    """The pairs (a, na, b, nb, place) whose whole sets link, as (u, v).

    ``owners``: node, owner (the number of a text that gives the set). ``place`` is equal for pairs
    that have many nodes in common, at most about two blocks of nodes, so that a set is sent once
    per place and not once per pair. Places share tasks by their sets' size.
    """
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("na").alias("n")),
                             F.struct(F.col("b").alias("node"), F.col("nb").alias("n"))))
    asked = settle(pairs.select("place", ends.alias("e")).select("place", "e.node", "e.n").distinct())
    size = asked.agg(F.sum("n")).first()[0] or 0
    task = F.pmod(F.xxhash64("place"), F.lit(max(1, -(-8 * size // _TASK_BYTES))))
    needed = asked.select("node").distinct().join(owners, "node")
    wanted = docs.sparkSession.sparkContext.broadcast(_bits(needed, "owner"))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_in_bits(wanted.value, batch.column(0).to_numpy())))
    texts = (docs.select(F.xxhash64("text").alias("owner"), "text")
             .mapInArrow(chosen, "owner long, text string")
             .groupBy("owner").agg(F.first("text").alias("text")))

    def compare(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        of = {_node(t): t for t in shingle_sets(held["text"], width)}
        linked = []
        for a, b in zip(asked["a"], asked["b"], strict=True):
            x, y = of[a], of[b]
            shared = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * shared >= percent * (len(x) + len(y) - shared))
        return asked.loc[np.array(linked, bool), ["a", "b"]].set_axis(["u", "v"], axis=1)

    sent = asked.select(task.alias("task"), "node").distinct().join(
        needed, "node").join(texts, "owner").select("task", "text")
    return sent.groupBy("task").cogroup(
        pairs.select(task.alias("task"), "a", "b").groupBy("task")).applyInPandas(
        compare, "u long, v long")


def _near_in_size(percent: int):
    return F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent


def _few_differ(percent: int):
    """Whether sets a and b may differ in as few shingles as linked ones do: buckets of unequal
    parity hold at least one shingle that only one of them has."""
    odd = sum(F.bit_count(F.col(f"{p}a").bitwiseXOR(F.col(f"{p}b"))) for p in _PARITY)
    return odd * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)


def _few_odd(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, na, b, nb) whose sketches allow for a link."""
    @F.arrow_udf("boolean")
    def allowed(a: pa.Array, b: pa.Array, na: pa.Array, nb: pa.Array) -> pa.Array:
        odd = np.fromiter(map(_odd, a.to_pylist(), b.to_pylist()), np.int64, len(a))
        both = na.to_numpy(zero_copy_only=False) + nb.to_numpy(zero_copy_only=False)
        return pa.array(odd * (100 + percent) <= both * (100 - percent))

    drawn = pairs
    for end in "ab":
        drawn = drawn.join(nodes.select(F.col("node").alias(end), F.col("sketch").alias(f"_{end}")), end)
    return drawn.where(allowed("_a", "_b", "na", "nb")).select(*pairs.columns)


def _few_words_odd(percent: int):
    """Whether the sketches (64-bit words) of sets a and b, near in size, allow for a link: as
    ``_few_odd``, for the join's own condition. The longer one, of twice the words at most, is folded."""
    least = F.least(F.size("sa"), F.size("sb"))
    at = lambda name, i: F.coalesce(F.get(name, i), F.lit(0).cast("long"))
    odd = F.aggregate(F.sequence(F.lit(0), least - 1), F.lit(0), lambda n, i: n + F.bit_count(
        at("sa", i).bitwiseXOR(at("sb", i)).bitwiseXOR(at("sa", i + least)).bitwiseXOR(at("sb", i + least))))
    return odd * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)


def _words(sketch: str):
    """A sketch as array<long>."""
    return F.transform(F.sequence(F.lit(0), (F.octet_length(sketch) / 8).cast("int") - 1), lambda i: F.conv(
        F.hex(F.substring(F.col(sketch), i * 8 + 1, F.lit(8))), 16, -10).cast("long"))


def _can_reach(percent: int):
    """Whether a pair that shares k single signatures, the last one at places ia and ib, can still
    share enough: beyond that place at most the rest of the smaller remainder is shared."""
    most = F.col("k") + F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib")) - 1
    return most * (100 + percent) >= (F.col("na") + F.col("nb")) * percent


def _live(rows: DataFrame) -> DataFrame:
    """sig, place, node, n of the signatures that several sets have, without repeats.

    Postings are shuffled once: minima and maxima of whole rows need the same columns as the join, so
    that both read one exchange.
    """
    posted = rows.select("node", "n", F.inline(F.arrays_zip("sigs", "places"))).toDF(
        "node", "n", "sig", "place").repartition("sig")
    whole = F.struct("node", "n", "place")
    shared = posted.groupBy("sig").agg(F.min(whole).alias("first"), F.max(whole).alias("last")).where(
        "first.node < last.node").select("sig")
    return posted.join(shared, "sig").select("sig", "place", "node", "n").distinct()


def join_documents(docs: DataFrame, width: int = 4, percent: int = 85, known: float = KNOWN,
                   seldom: int = SELDOM) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text; the rest is
    ignored, whatever its names).

    component_id is the smallest doc_id that links reach, the row's own if there is none; rows of
    equal sets are linked. Empty and null texts link with nothing. A null doc_id is never the
    smallest; a group of nulls alone has a null component_id. Repeated rows are rows of their own.
    ``percent`` has to be at least 80: below, sets of fewer than four shingles could link.
    """
    if not 80 <= percent <= 100:
        raise ValueError("percent has to be between 80 and 100")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    counts = settle(_counted(docs.select("text"), width, known))
    rows = settle(_prepared(docs, width, percent, known, _frequent(counts, seldom),
                            _bits(counts, "token")))
    nodes = settle(rows.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("least_id"), F.min("text_no").alias("owner"), F.min("sketch").alias("sketch"),
        *(F.min(p).alias(p) for p in _PARITY)))
    owners = nodes.select("node", "owner")
    live = settle(_live(rows))
    # The head is the member that has most signatures in common with any other set: the original
    # among its copies, which differ less from it than from each other.
    weights = live.groupBy("node").agg(F.count(F.lit(1)).alias("weight"))
    heads = live.join(weights, "node").groupBy("sig").agg(
        F.max(F.struct("weight", "node", "n")).alias("head"))
    members = settle(live.join(heads, "sig").where("node <> head.node").select(
        "sig", "place", "node", "n", F.col("head.node").alias("head"), F.col("head.n").alias("head_n")))
    stars = (members.select(F.col("head").alias("a"), F.col("head_n").alias("na"),
                            F.col("node").alias("b"), F.col("n").alias("nb"))
             .where(_near_in_size(percent)).distinct())
    stars = _few_odd(stars, nodes, percent)
    # Of a head with very many partners, some per place.
    crowds = stars.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / _BLOCK).alias("blocks"))
    stars = settle(stars.join(crowds, "a").withColumn("place", F.xxhash64(
        "a", F.pmod(F.xxhash64("b"), "blocks"))).drop("blocks"))
    links = settle(_verified(docs, owners, stars, width, percent))
    known_parts = components(links)
    # All pairs with the head of a signature are done, whether they linked or were ruled out.
    placed = members.select("sig", "place", "node", "n").join(known_parts, "node", "left").withColumn(
        "part", F.coalesce("component", "node"))
    mixed_sigs = placed.groupBy("sig").agg(
        F.min("part").alias("p"), F.max("part").alias("q")).where("p < q").select("sig")
    sketched = nodes.select("node", *_PARITY, _words("sketch").alias("sketch"))
    open_rows = settle(placed.join(mixed_sigs, "sig").join(sketched, "node")
                       .select("sig", "place", "node", "n", "part", *_PARITY, "sketch"))
    crowds = open_rows.groupBy("sig").agg(F.ceil(F.count(F.lit(1)) / _BLOCK).alias("blocks"))
    left = open_rows.toDF("sig", "ia", "a", "na", "pa", *(f"{p}a" for p in _PARITY), "sa").join(
        crowds, "sig")
    right = open_rows.toDF("sig", "ib", "b", "nb", "pb", *(f"{p}b" for p in _PARITY), "sb")
    rest = (left.join(right, "sig").where("a < b and pa <> pb").where(
                _near_in_size(percent) & _few_differ(percent) & _few_words_odd(percent))
            .groupBy("a", "na", "b", "nb").agg(
                F.count(F.lit(1)).alias("k"), F.max("ia").alias("ia"),
                F.max("ib").alias("ib"), F.min(F.least("ia", "ib")).alias("low"),
                F.min(F.struct("sig", "blocks")).alias("at"))
            .where((F.col("low") < 0) | _can_reach(percent)).select("a", "na", "b", "nb", F.xxhash64(
                "at.sig", F.pmod(F.xxhash64("a"), F.col("at.blocks")),
                F.pmod(F.xxhash64("b"), F.col("at.blocks"))).alias("place")))
    rest = settle(rest.join(
        stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")),
        ["a", "b"], "left_anti"))
    more = _verified(docs, owners, rest, width, percent)
    parts = components(links.unionByName(more))
    named = (nodes.join(parts, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    smallest = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_node = named.join(smallest, "component").select("node", "component_id")
    return rows.drop("sigs", "places", "text_no", *_PARITY).join(of_node, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"))
