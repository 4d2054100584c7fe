"""Prefix trie of conversations by vertical bitmaps.

Conversations go to shards of about ``TARGET`` turns. A shard numbers its conversations and
indexes every (position, turn) to the bitset of those that have this turn there. A depth-first walk
starts at the shard's root and intersects the parent's bitset with the posting of its first
remaining member's next turn: that gives a child, and its members leave the remainder, so that a
shard costs one intersection per node. Popcounts are member counts, the lowest bit is the least id,
and the bits that end at a depth are the end list.

A node is named by a digest chained along its turns, so equal nodes of different shards are summed
by name: nothing but nodes is shuffled. Sums over subtrees need no walk over the merged trie. Every
node belongs to its least member, and on the path of a conversation the depths from some ``own`` on
belong to it. The childless nodes below a node are then its members that own a childless end, and
what a subtree saves is, summed over members, the words between the node and their own depth: a
second walk counts both with bitsets.

A conversation may hold a third of all rows: it is numbered by ranges (``prefix``), cut into bands
of ``BAND`` positions, and every band is walked by itself from the digests of the bands before.

Defined cases: turn null comes first, then rows of equal turn follow as ``turns`` says; null role
and text are empty; rows with a null conv_id belong to no conversation and are left out; repeated
rows are turns like others. An empty table gives no nodes. Other columns are not read; names that
start with ``_`` are reserved.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import turns
from .prefix import with_prefix
from ..operators.skew import lookup
from ..scratch import settle

TARGET = 16_384      # turns in a shard, about
BAND = 4_096         # positions of one conversation that are walked together
BLOCK, KINDS = 20, 4  # conversations of a block share beginnings of 0 to KINDS - 1 turns
ROOT = hashlib.md5(b"").digest()

_TURN, _START, _ANCHOR, _OWNER = range(4)
_ROWS = ("conv_id long, _at long, _name binary, _words long, _last boolean, _kind int, "
         "_shard long, _band long")


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def numbered(rows: DataFrame) -> DataFrame:
    """conv_id, _at (from 1), _length, _name (digest of role and text) and _words of every turn."""
    empty = F.lit("")
    filled = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    pair = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    narrow = turns.keyed(filled).select(
        "conv_id", *turns.ORDER, words(F.col("text")).cast("long").alias("_words"),
        F.unhex(F.md5(F.encode(pair, "utf-8"))).alias("_name"))
    placed = with_prefix(narrow, {"_earlier": F.lit(1)}, [F.col(c) for c in turns.ORDER],
                         ["conv_id"])
    return placed.select("conv_id", (F.col("_earlier") + 1).alias("_at"),
                         F.col("_earlier_all").alias("_length"), "_name", "_words")


def with_shared_beginnings(turn_rows: DataFrame) -> DataFrame:
    """``numbered``'s rows with the beginning of every conversation replaced.

    The first h turns come from the conversation whose id is the next lower multiple of BLOCK, h
    being the crc32 of the decimal id modulo KINDS; then the conversation's own turns after its
    first h follow. A row at position 0 stands for each conversation, also for one without turns.
    """
    base = F.col("conv_id") - F.col("conv_id") % BLOCK
    shared = F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")) % KINDS
    convs = turn_rows.groupBy("conv_id").agg(F.max("_length").alias("_own"))
    bases = (convs.where(F.col("conv_id") % BLOCK == 0)
             .select(F.col("conv_id").alias("_base"), F.col("_own").alias("_base_length")))
    convs = settle(
        convs.withColumns({"_base": base, "_h": shared}).join(bases, "_base", "left")
        .withColumn("_k", F.least("_h", F.coalesce("_base_length", F.lit(0))))
        .select("conv_id", "_base", "_h", "_k",
                (F.col("_k") + F.greatest(F.col("_own") - F.col("_h"), F.lit(0))).alias("_length")))
    roots = convs.select("conv_id", F.lit(0).cast("long").alias("_at"), "_length",
                         F.lit(b"").alias("_name"), F.lit(0).cast("long").alias("_words"))
    # At most KINDS - 1 rows of a base meet the conversations of its block, 2 * BLOCK - 1 at most.
    heads = turn_rows.where((F.col("conv_id") % BLOCK == 0) & (F.col("_at") < KINDS)).select(
        F.col("conv_id").alias("_base"), "_at", "_name", "_words")
    taken = (convs.where("_k > 0").join(heads, "_base").where("_at <= _k")
             .select("conv_id", "_at", "_length", "_name", "_words"))
    own = lookup(turn_rows.drop("_length"), convs.select("conv_id", "_h", "_k", "_length"),
                 ["conv_id"]).where("_at > _h").select(
        "conv_id", (F.col("_at") - F.col("_h") + F.col("_k")).alias("_at"), "_length", "_name",
        "_words")
    return roots.unionByName(taken).unionByName(own)


def _chained(bands: DataFrame) -> DataFrame:
    """(conv_id, _band, _name): the digest of everything before the band, from band digests."""
    listed = bands.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("_band", "_digest"))).alias("_digests"))
    kind = T.StructType.fromDDL("conv_id long, _band long, _name binary")
    arrow = to_arrow_schema(kind)

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, digests in zip(*(c.to_pylist() for c in batch.columns)):
                name, rows = ROOT, []
                for band in digests:
                    name = hashlib.md5(name + band["_digest"]).digest()
                    rows.append((conv, band["_band"] + 1, name))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip(zip(*rows), arrow)], schema=arrow)

    return listed.mapInArrow(chained, kind)


def _sharded(rebuilt: DataFrame, groups: int, band: int) -> DataFrame:
    """The rows of every shard: turns, and marks where a conversation goes on in another band.

    A conversation that fills a band gets two marks with the digest of all turns so far: the name of
    the node it reaches there, and the name of the node at which the next band starts.
    """
    place = F.pmod(F.xxhash64(F.col("conv_id") - F.col("conv_id") % BLOCK), F.lit(groups))
    of_band = F.greatest(F.floor((F.col("_at") - 1) / F.lit(band)), F.lit(0)).cast("long")
    rows = rebuilt.select(
        "conv_id", "_at", "_name", "_words", (F.col("_at") == F.col("_length")).alias("_last"),
        F.lit(_TURN).alias("_kind"), place.alias("_shard"), of_band.alias("_band"))
    full = (rebuilt.withColumn("_band", of_band)
            .where((F.col("_at") > 0) & (F.col("_length") >= (F.col("_band") + 1) * band))
            .groupBy("conv_id", "_band").agg(F.unhex(F.md5(F.concat(*[F.array_join(F.transform(
                F.sort_array(F.collect_list(F.struct("_at", "_name"))),
                lambda turn: F.hex(turn["_name"])), "")]))).alias("_digest")))
    starts = settle(_chained(full))
    marks = [starts.select(
        "conv_id", (F.col("_band") * band).alias("_at"), "_name",
        F.lit(0).cast("long").alias("_words"), F.lit(False).alias("_last"),
        F.lit(kind).alias("_kind"), place.alias("_shard"), (F.col("_band") - back).alias("_band"))
        for kind, back in ((_START, 0), (_ANCHOR, 1))]
    return rows.unionByName(marks[0]).unionByName(marks[1])


def bits_of(members: list[int]) -> int:
    """The bitset of ascending or any other bit numbers, made from bytes in one go."""
    held = bytearray(max(members, default=0) // 8 + 1)
    for bit in members:
        held[bit >> 3] |= 1 << (bit & 7)
    return int.from_bytes(held, "little")


def members_of(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


class Shard:
    """The vertical index of one shard and band, and the walk over it."""

    def __init__(self, table: pa.Table, band: int):
        columns = [table.column(c).to_pylist() for c in
                   ("conv_id", "_at", "_name", "_words", "_last", "_kind", "_band")]
        self.ids = sorted({c for c, kind in zip(columns[0], columns[5]) if kind != _OWNER})
        number = {conv: bit for bit, conv in enumerate(self.ids)}
        self.low = columns[6][0] * band
        self.high = self.low + band
        self.whole = columns[6][0] == 0            # this band holds the root
        index, last = defaultdict(list), defaultdict(list)
        self.turns: dict[tuple[int, int], bytes] = {}
        self.words, self.anchors, self.owners = {}, {}, {}
        for conv, at, name, count, end, kind, _ in zip(*columns):
            if kind == _OWNER:
                if conv in number:
                    self.owners[number[conv]] = (at, count, end)
                continue
            bit = number[conv]
            if kind == _ANCHOR:
                self.anchors[bit] = name
                continue
            index[at, name].append(bit)
            if kind == _TURN:
                self.turns[bit, at] = name
                self.words[name] = count
                if end:
                    last[at].append(bit)
        if not self.whole:                         # a conversation may end where the band starts
            for key, bits in list(index.items()):
                if key[0] == self.low:
                    index[key] = [bit for bit in bits if (bit, self.low + 1) in self.turns]
        self.index = {key: bits_of(bits) for key, bits in index.items() if bits}
        self.ends = {at: bits_of(bits) for at, bits in last.items()}

    def walk(self) -> Iterator[tuple[int, int, int, bytes, bytes | None, bytes]]:
        """Nodes, parents first: (number of the parent in this walk or -1, depth, bitset, name,
        parent's name, last turn). Where a band does not hold the root, the nodes at its start are
        there only as parents; they come with the parent's name None."""
        stack = [(-1, self.low, bits, ROOT if self.whole else name, None, name)
                 for (at, name), bits in self.index.items() if at == self.low]
        made = 0
        while stack:
            node = stack.pop()
            yield node
            _, depth, bits, name, _, _ = node
            rest = bits & ~self.ends.get(depth, 0) if depth < self.high else 0
            while rest:
                first = (rest & -rest).bit_length() - 1
                turn = self.turns[first, depth + 1]
                child = bits & self.index[depth + 1, turn]
                rest &= ~child
                named = (self.anchors.get(first) if depth + 1 == self.high else None
                         ) or hashlib.md5(name + turn).digest()
                stack.append((made, depth + 1, child, named, name, turn))
            made += 1

    def nodes(self) -> Iterator[tuple]:
        """(name, parent, depth, members, least id, ids that end here)."""
        for _, depth, bits, name, parent, _ in self.walk():
            if parent is None and not self.whole:
                continue
            ended = bits & self.ends.get(depth, 0)
            yield (name, parent, depth, bits.bit_count(), self.ids[(bits & -bits).bit_length() - 1],
                   [self.ids[bit] for bit in members_of(ended)])

    def sums(self) -> Iterator[tuple]:
        """(name, childless nodes, saved words) of every node, as far as this shard's members go."""
        far = 1 << 62
        own = {bit: self.owners[bit][0] if bit in self.owners else far
               for bit in range(len(self.ids))}
        leaves = bits_of([bit for bit, (_, _, end) in self.owners.items() if end])
        starts = defaultdict(list)
        for bit, depth in own.items():
            starts[max(depth, self.low)].append(bit)
        beyond, left = {}, (1 << len(self.ids)) - 1       # members that do not own a depth yet
        deepest = max((at for at, _ in self.index), default=self.low)
        for depth in range(self.low, deepest + 1):
            if depth in starts:
                left &= ~bits_of(starts[depth])
            beyond[depth] = left
        walked = list(self.walk())
        saved = [0] * len(walked)
        for at in range(len(walked) - 1, -1, -1):
            up, depth, bits, name, parent, turn = walked[at]
            if up >= 0:
                saved[at] += self.words[turn] * (bits & beyond[depth]).bit_count()
            if depth == self.high:
                saved[at] += sum(self.owners[bit][1] for bit in members_of(bits)
                                 if bit in self.owners)
            if up >= 0:
                saved[up] += saved[at]
            if parent is not None or self.whole:
                yield name, (bits & leaves).bit_count(), saved[at]


def _per_shard(rows: DataFrame, made: str, schema: str, band: int) -> DataFrame:
    kind = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def walked(table: pa.Table) -> pa.Table:
        found = list(getattr(Shard(table, band), made)())
        return pa.Table.from_arrays([pa.array(values, field.type) for values, field in zip(
            zip(*found) if found else [[]] * len(arrow), arrow)], schema=arrow)

    return rows.groupBy("_shard", "_band").applyInArrow(walked, kind)


def _later(rows: DataFrame, owners: DataFrame, band: int) -> DataFrame:
    """(conv_id, _band, _words): words that a long conversation does not own in later bands."""
    turn_rows = rows.where((F.col("_kind") == _TURN) & (F.col("_at") > 0))
    longer = turn_rows.where(F.col("_at") > band).select("conv_id").distinct()
    held = turn_rows.select("conv_id", "_at", "_band", F.col("_words").alias("_count")).join(
        longer, "conv_id", "left_semi")
    sums = (lookup(held, owners.select("conv_id", F.col("_at").alias("_own")), ["conv_id"])
            .withColumn("_count", F.when(F.col("_own").isNull() | (F.col("_at") < F.col("_own")),
                                         F.col("_count")).otherwise(F.lit(0)))
            .groupBy("conv_id", "_band").agg(F.sum("_count").alias("_count")))
    after = Window.partitionBy("conv_id").orderBy(F.col("_band").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    return sums.select("conv_id", "_band",
                       F.coalesce(F.sum("_count").over(after), F.lit(0)).alias("_later"))


def _end_lists(nodes: DataFrame) -> DataFrame:
    """(name, ends_sha256): the ids that end at a node, ascending, read as a stream."""
    ends = (nodes.select("name", F.explode("ends").alias("conv_id"))
            .repartition("name").sortWithinPartitions("name", "conv_id"))
    kind = T.StructType.fromDDL("name binary, ends_sha256 string")
    arrow = to_arrow_schema(kind)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state, done = None, None, []
        for batch in batches:
            for key, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if key != name:
                    if state is not None:
                        done.append((name, state.hexdigest()))
                    name, state = key, hashlib.sha256()
                    state.update(str(conv).encode())
                else:
                    state.update(f",{conv}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(
                    zip(*done), arrow)], schema=arrow)
                done = []
        if state is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([name], pa.binary()), pa.array([state.hexdigest()])], schema=arrow)

    return ends.mapInArrow(hashed, kind)


def build(rebuilt: DataFrame, target: int = TARGET, band: int = BAND) -> DataFrame:
    """The trie of conversations given as conv_id, _at (1, 2, ... and one row at 0), _length, _name
    and _words. One row per node: name, parent (null at the root), depth, conv_id (least member),
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rebuilt = settle(rebuilt)
    groups = max(1, -(-rebuilt.count() // target))
    rows = settle(_sharded(rebuilt, groups, band))
    nodes = settle(_per_shard(rows, "nodes", "name binary, parent binary, depth long, n_convs long, "
                              "conv_id long, ends array<long>", band))
    merged = settle(nodes.groupBy("name").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id")))
    children = merged.where(F.col("parent").isNotNull()).groupBy(
        F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    owners = settle(merged.join(children, "name", "left").groupBy("conv_id").agg(
        F.min("depth").alias("_at"), F.max(F.col("n_children").isNull()).alias("_last")))
    present = rows.where(F.col("_kind") == _TURN).select("conv_id", "_shard", "_band").distinct()
    marks = (present.join(owners, "conv_id", "left")
             .join(_later(rows, owners, band), ["conv_id", "_band"], "left")
             .select("conv_id", F.coalesce("_at", F.lit(1 << 62)).alias("_at"),
                     F.lit(None).cast("binary").alias("_name"),
                     F.coalesce("_later", F.lit(0)).alias("_words"),
                     F.coalesce("_last", F.lit(False)).alias("_last"),
                     F.lit(_OWNER).alias("_kind"), "_shard", "_band"))
    sums = _per_shard(rows.unionByName(marks), "sums",
                      "name binary, n_leaves long, saved_tokens long", band)
    parts = [merged.select("name", "parent", "depth", "n_convs", "conv_id"),
             children, sums, _end_lists(nodes)]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part, allowMissingColumns=True)
    full = settle(together.groupBy("name").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"),
        F.max("conv_id").alias("conv_id"), F.max("n_convs").alias("n_convs"),
        F.coalesce(F.max("n_children"), F.lit(0)).alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.coalesce(F.max("ends_sha256"), F.sha2(F.lit(b""), 256)).alias("ends_sha256")))
    above = merged.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return lookup(full, above, ["parent"])
