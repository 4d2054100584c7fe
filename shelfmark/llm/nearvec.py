"""Groups of near-equal vectors: a navigable small-world graph per shard, every shard queried.

Equal vectors are one node with a count. Nodes are dealt to shards of bounded size by hash; one task
builds a shard's graph and audits it: for some of its own nodes and some of other shards the links
found are held against all links by brute force, and the beam is widened until the audit passes; if
none does, the shard is compared as a whole. One task per unordered pair of shards queries each with
the other's nodes. Links are verified in double precision, and one found from either end counts at
both; of a pair of shards only the number per node and a spanning forest leave the task, never all
pairs of a group.

The pairs of shards grow with the square of the number of nodes over the shard size; that is the
method's price.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..scratch import settle
from .components import components
from .smallworld import build
from .vectors import doubles, matrix, pack, unpack, valid

SHARD_ROWS = 65_536
SHARD_BYTES = 64 << 20
BLOCK_ROWS = 8_192
AUDITED = 256       # nodes with a link that an audit takes at least, if there are so many
FOREIGN = 16_384    # nodes of other shards that an audit may draw from
RECALL = 0.995
_SLACK = 1e-4  # of the graph's single precision
_CHUNK = 128


def _unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)  # so that squares stay in range
    vectors = vectors / largest
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def _found(graph, part: np.ndarray, units: np.ndarray, least: float, beam: int) -> np.ndarray:
    """The links of ``part`` that a beam finds in the graph of ``units``, verified in doubles."""
    hit = np.zeros((len(part), len(units)), bool)
    r, v = graph.within(part.astype(np.float32), 2 * least - 1 - _SLACK, beam)
    for s in range(0, len(r), 65536):
        x, y = r[s:s + 65536], v[s:s + 65536]
        hit[x, y] = np.einsum("ij,ij->i", part[x], units[y]) >= least
    return hit


def _linked(nodes: np.ndarray, units: np.ndarray, least: float, own: bool):
    """Of nodes, in random order, the first AUDITED or more that link with another, and their links;
    ``own`` nodes are the units themselves. All nodes are gone through if there are fewer."""
    some, wanted, count = [], [], 0
    rough = units.astype(np.float32)
    order = np.random.default_rng(11).permutation(len(nodes))
    for k in range(0, len(nodes), _CHUNK):
        chosen = order[k:k + _CHUNK]
        part = nodes[chosen]
        near = part.astype(np.float32) @ rough.T >= least - _SLACK
        if own:
            near[np.arange(len(part)), chosen] = False
        for i in np.flatnonzero(near.any(axis=1)):
            at = np.flatnonzero(near[i])
            near[i, at] = units[at] @ part[i] >= least
        rows = near.any(axis=1)
        some.append(part[rows])
        wanted.append(near[rows])
        count += rows.sum()
        if count >= AUDITED:
            break
    return np.concatenate(some), np.concatenate(wanted)


def _audited(graph, units: np.ndarray, least: float, recall: float,
             foreign: np.ndarray | None = None) -> int:
    """The beam at which nodes with a link have found ``recall`` of their links in the mean: the
    shard's own, and ``foreign`` ones, which are not in the graph. The number of units, for which all
    are compared, if no beam does it that is cheaper, or if foreign nodes link too seldom to tell."""
    audits = [_linked(units, units, least, True)]
    if foreign is not None and len(foreign):
        audits.append(_linked(foreign, units, least, False))
        if len(audits[1][0]) < min(AUDITED, len(foreign)):
            return len(units)

    def passes(nodes, wanted, beam):
        shares = [np.empty(0)]
        for k in range(0, len(nodes), _CHUNK):
            want = wanted[k:k + _CHUNK]
            hit = _found(graph, nodes[k:k + _CHUNK], units, least, beam)
            shares.append((hit & want).sum(axis=1) / want.sum(axis=1))
        shares = np.concatenate(shares)
        return not len(shares) or shares.mean() >= recall

    beam = 16
    while beam * graph.links[0].shape[1] < len(units):  # beyond, the beam reads more than there is
        if all(passes(*audit, beam) for audit in audits):
            return beam
        beam *= 2
    return len(units)


class _Pairs:
    """A set of pairs (row, column): sorted numbers, or a matrix of bits when that is smaller."""

    def __init__(self, rows: int, columns: int):
        self.shape, self.new, self.held, self.bits = (rows, columns), [], np.empty(0, np.int64), None

    def add(self, hit: np.ndarray, k: int, turned: bool) -> None:
        """Add the pairs at which ``hit`` is true; it begins at row k, or ``turned`` at column k,
        a multiple of 8."""
        if self.bits is None:
            r, v = np.nonzero(hit)
            self.new.append(v * self.shape[1] + r + k if turned else (r + k) * self.shape[1] + v)
            if sum(map(len, self.new)) > max(1 << 22, len(self.held)):
                self.fold()
        elif turned:
            packed = np.packbits(np.ascontiguousarray(hit.T), axis=1)
            self.bits[:, k // 8:k // 8 + packed.shape[1]] |= packed
        else:
            self.bits[k:k + len(hit)] |= np.packbits(hit, axis=1)

    def fold(self) -> None:
        rows, columns = self.shape
        self.held, self.new = np.unique(np.concatenate([self.held, *self.new])), []
        if 64 * len(self.held) <= rows * columns:
            return
        self.bits = np.zeros((rows, -(-columns // 8)), np.uint8)
        for k in range(0, rows, _CHUNK):
            own = self.held[slice(*np.searchsorted(
                self.held, [k * columns, (k + _CHUNK) * columns]))]
            part = np.zeros((min(_CHUNK, rows - k), columns), bool)
            part.ravel()[own - k * columns] = True
            self.bits[k:k + _CHUNK] = np.packbits(part, axis=1)
        self.held = self.held[:0]

    def stripes(self, most: int):
        """The pairs by at most ``most`` rows at a time."""
        if self.bits is None:
            self.fold()
        rows, columns = self.shape
        step = max(1, min(most, (1 << 23) // max(1, columns)))
        for k in range(0, rows, step):
            if self.bits is None:
                own = self.held[slice(*np.searchsorted(
                    self.held, [k * columns, (k + step) * columns]))]
                yield own // columns, own % columns
            else:
                r, v = np.nonzero(np.unpackbits(self.bits[k:k + step], axis=1, count=columns))
                yield r + k, v


def _hang(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (every node's root, the least of its tree) after uniting a's and b's trees."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def _joined(one, other, least: float, block_rows: int):
    """Links between two shards (graph, cids, copies, units, beam), or within one if ``other`` is
    None: cids, the number of links per cid, and cids' roots."""
    alone = other is None
    other = one if alone else other
    pairs = _Pairs(len(one[1]), len(other[1]))

    def ask(nodes, shard, turned):
        graph, _, _, units, beam = shard
        for k in range(0, len(nodes), _CHUNK):
            part = nodes[k:k + _CHUNK]
            hit = (part @ units.T >= least if beam >= len(units)
                   else _found(graph, part, units, least, beam))
            if alone:
                hit[np.arange(len(part)), k + np.arange(len(part))] = False
                pairs.add(hit, k, True)
            pairs.add(hit, k, turned)

    ask(one[3], other, False)
    if not alone:
        ask(other[3], one, True)
    n, shift = len(one[1]), 0 if alone else len(one[1])
    cids = one[1] if alone else np.concatenate([one[1], other[1]])
    counts, label = np.zeros(len(cids), np.int64), np.arange(len(cids))
    for r, v in pairs.stripes(block_rows):
        counts[:n] += np.bincount(r, other[2][v], minlength=n).astype(np.int64)
        if not alone:
            counts[n:] += np.bincount(v, one[2][r], minlength=len(cids) - n).astype(np.int64)
        label = _hang(label, r, v + shift)
    return cids, counts, cids[label]


def groups(df: DataFrame, least: float = 0.9, key: str = "vec_id", vector: str = "embedding",
           shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``df``; other columns are ignored.

    Two rows link when the cosine of their vectors, in double precision, is ``least`` or more.
    n_links counts other rows; component_id is the least id that links reach, kept says that the
    row's id is it. Rows whose vector is null, zero or holds null or non-finite components have no
    links and are their own component; vectors of different length never link. Repeated ids are rows
    of their own. A null id is never the least.
    """
    rows = doubles(df, vector, key)
    good = rows.where(valid(F.col("vec")))
    nodes = settle(good.groupBy("vec").agg(F.min("id").alias("least_id"),
                                           F.count(F.lit(1)).alias("copies"))
                   .withColumn("cid", F.monotonically_increasing_id())
                   .withColumn("width", F.size("vec")))
    widths = nodes.groupBy("width").count()  # one row per vector length
    # Shards of bounded size per vector length; of its nodes, some that other shards' audits draw.
    sized = widths.select(
        "width",
        F.ceil(F.col("count") / F.least(F.lit(shard_rows), F.greatest(
            F.lit(1024), F.floor(F.lit(SHARD_BYTES) / (F.col("width") * 4))))).alias("shards"),
        (F.lit(FOREIGN) / F.col("count")).alias("drawn"))
    dealt = nodes.join(sized, "width").select(
        "width", "cid", "copies", "vec", "shards", "drawn",
        F.pmod(F.xxhash64("cid", F.lit(1)), "shards").alias("shard"))
    foreign = dealt.where((F.col("shards") > 1) & (
        F.pmod(F.xxhash64("cid", F.lit(2)), F.lit(1 << 20)) < F.col("drawn") * (1 << 20))).withColumn(
        "home", F.col("shard")).withColumn("shard", F.explode(F.sequence(
            F.lit(0), F.col("shards") - 1))).where("shard <> home")
    audited = dealt.withColumn("home", F.col("shard")).unionByName(foreign)

    def shard_graph(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.iloc[np.random.default_rng(7).permutation(rows["cid"].to_numpy().argsort())]
        here = (rows["home"] == rows["shard"]).to_numpy()
        rows, others = rows[here], rows[~here]
        if not len(rows):
            return pd.DataFrame(columns=["width", "shard", "shards", "beam", "cids", "copies", "exact",
                                         "nodes", "sizes", "links"])
        units = _unit(matrix(rows["vec"]))
        graph = build(units)
        beam = _audited(graph, units, least, RECALL,
                        _unit(matrix(others["vec"])) if len(others) else None)
        return pd.DataFrame([{
            "width": rows["width"].iloc[0], "shard": rows["shard"].iloc[0],
            "shards": rows["shards"].iloc[0], "beam": beam,
            "cids": rows["cid"].to_numpy(np.int64).tobytes(),
            "copies": rows["copies"].to_numpy(np.int64).tobytes(),
            "exact": units.tobytes(), **pack(graph)}])

    graphs = settle(audited.drop("drawn").groupBy("width", "shard").applyInPandas(
        shard_graph, "width int, shard long, shards long, beam long, cids binary, copies binary, "
        "exact binary, nodes binary, sizes binary, links binary"))
    # Every unordered pair of shards, a shard with itself too, meets in one task.
    met = graphs.withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).withColumn(
        "low", F.least("shard", "partner")).withColumn("high", F.greatest("shard", "partner"))

    def query(shards: pd.DataFrame) -> pd.DataFrame:
        held, within = [], shards["low"].iloc[0] == shards["high"].iloc[0]
        for _, row in shards.iterrows():
            width = int(row["width"])
            cids, copies = (np.frombuffer(row[k], np.int64) for k in ("cids", "copies"))
            held.append((unpack(row, width), cids, copies, np.frombuffer(
                row["exact"], np.float64).reshape(-1, width), int(row["beam"])))
        if len(held) == 1 and not within:  # the partner has no nodes
            return pd.DataFrame({"u": [], "v": [], "n": []}).astype("int64")
        ids, counts, roots = _joined(held[0], None if within else held[1], least, block_rows)
        some, tied = counts > 0, roots != ids
        return pd.concat([pd.DataFrame({"u": ids[some], "v": -1, "n": counts[some]}),
                          pd.DataFrame({"u": ids[tied], "v": roots[tied], "n": 0})]).astype("int64")

    found = settle(met.groupBy("width", "low", "high").applyInPandas(
        query, "u long, v long, n long"))
    counts = found.where("v < 0").groupBy("u").agg(F.sum("n").alias("n"))
    parts = components(found.where("v >= 0").select("u", "v"))
    named = nodes.join(parts, F.col("cid") == F.col("node"), "left").join(
        counts, F.col("cid") == F.col("u"), "left").select(
        "vec", "copies", "least_id", F.coalesce("component", "cid").alias("part"),
        F.coalesce("n", F.lit(0)).alias("n"))
    least_ids = named.groupBy("part").agg(F.min("least_id").alias("component_id"))
    named = named.join(least_ids, "part").select(
        "vec", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = good.join(named, "vec").select("id", "n_links", "component_id")
    alone = rows.where(~valid(F.col("vec"))).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias("vec_id"), "n_links", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
