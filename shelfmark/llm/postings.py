"""Nearest neighbours by inner product from balanced posting lists.

Largest inner product becomes least distance by one more component that gives every vector the same
length. A bounded sample is split by balanced 2-means, again and again, into equal leaves, whose
means are the lists' centroids; they are searched through an in-memory small-world graph. Every
vector of the table goes to its nearest list and, near a boundary, to up to ``REPLICAS`` lists: those
not much farther than the nearest and not nearer to a list already taken. A query reads the lists
within a distance ratio of its nearest one; that ratio is fitted on the sample, where brute force
tells which lists the true neighbours are in.

Lists and their queries are cut into blocks of bounded size, so that a hot list is many small tasks.
Equal vectors are one entry with their least ids: more of them than asked for cannot be in a result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from collections.abc import Iterator
from pyspark.sql import DataFrame, Window, functions as F

from ..scratch import settle
from .linear import bounded_sample
from .smallworld import build
from .vectors import doubles, matrix, valid

SAMPLE = 32_768       # vectors that the lists are fitted on
SAMPLE_BYTES = 96 << 20
LISTS = 256
REPLICAS = 4
NEARER = 1.10         # a vector is also put into lists up to that much farther than its nearest
COVERED = 0.99        # share of the sample's true neighbours that the fitted ratio has to reach
BLOCK = 4_096
_AUDITED = 384


def _split(points: np.ndarray, members: np.ndarray, leaf: int, out: list) -> None:
    """Balanced 2-means: equal halves by the difference of the distances to two moving means."""
    if len(members) <= leaf:
        out.append(points[members].mean(axis=0))
        return
    own = points[members]
    centre = own.mean(axis=0)
    first = own[np.argmax(np.einsum("ij,ij->i", own - centre, own - centre))]
    second = own[np.argmax(np.einsum("ij,ij->i", own - first, own - first))]
    half = len(members) // 2
    for _ in range(8):
        side = own @ (second - first)
        order = np.argsort(side, kind="stable")
        first, second = own[order[:half]].mean(axis=0), own[order[half:]].mean(axis=0)
    _split(points, members[order[:half]], leaf, out)
    _split(points, members[order[half:]], leaf, out)


class Lists:
    """Centroids, their graph, and the fitted ratio and beam."""

    def __init__(self, sample: np.ndarray, longest: float, lists: int, k: int):
        self.longest = longest
        points = self.lifted(sample)
        centroids: list = []
        _split(points, np.arange(len(points)), max(8, -(-len(points) // lists)), centroids)
        order = np.random.default_rng(11).permutation(len(centroids))
        self.graph = build(np.array(centroids, dtype=np.float32)[order], degree=16)
        self.ratio, self.beam = 1.0, min(len(centroids), 64)
        self._fit(sample, points, k)

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = self.longest ** 2 - np.einsum("ij,ij->i", vectors, vectors)
        return np.column_stack([vectors, np.sqrt(np.maximum(rest, 0))])

    def _distances(self, points: np.ndarray, beam: int):
        """Nearest lists found and their distances, nearest first."""
        points32 = points.astype(np.float32)
        ids, distances = [], []
        for at in range(0, len(points), 256):
            part = points32[at:at + 256]
            found, nearness = self.graph.search(part, beam)
            size = np.einsum("ij,ij->i", part, part)
            ids.append(found)
            distances.append(np.sqrt(np.maximum(size[:, None] - nearness, 0)))
        return np.concatenate(ids), np.concatenate(distances)

    def homes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) for every list that a row is put into."""
        parts = [self._homes(vectors[at:at + 2048]) for at in range(0, len(vectors), 2048)]
        return (np.concatenate([r + 2048 * k for k, (r, _) in enumerate(parts)]),
                np.concatenate([at for _, at in parts]))

    def _homes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, distances = self._distances(self.lifted(vectors), min(32, len(self.graph.vectors)))
        centroids = self.graph.vectors
        taken = np.zeros(ids.shape, bool)
        taken[:, 0] = True
        for j in range(1, ids.shape[1]):
            near = (ids[:, j] >= 0) & (distances[:, j] <= NEARER * distances[:, 0]) & (
                taken.sum(axis=1) < REPLICAS)
            rows = np.flatnonzero(near)
            if not len(rows):
                continue
            gap = centroids[ids[rows, j]][:, None, :] - centroids[np.maximum(ids[rows, :j], 0)]
            between = np.sqrt(np.einsum("bjd,bjd->bj", gap, gap))
            hidden = (taken[rows, :j] & (between < distances[rows, j][:, None])).any(axis=1)
            taken[rows[~hidden], j] = True
        r, c = np.nonzero(taken)
        return r, ids[r, c]

    def lists_of(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) for every list that a query reads."""
        points = np.column_stack([queries, np.zeros(len(queries))])
        ids, distances = self._distances(points, self.beam)
        r, c = np.nonzero((ids >= 0) & (distances <= self.ratio * distances[:, :1]))
        return r, ids[r, c]

    def _fit(self, sample: np.ndarray, points: np.ndarray, k: int) -> None:
        """The ratio that reaches ``COVERED`` of the sample's true neighbours, and the beam for it."""
        rows, lists = self.homes(sample)
        asked = np.arange(0, len(sample), max(1, len(sample) // _AUDITED))[:_AUDITED]
        n_lists = len(self.graph.vectors)
        ids, distances = self._distances(
            np.column_stack([sample[asked], np.zeros(len(asked))]), n_lists)
        by_list = np.full((len(asked), n_lists), np.inf)
        r, c = np.nonzero(ids >= 0)
        by_list[r, ids[r, c]] = distances[r, c] / np.maximum(distances[r, 0], 1e-30)
        starts = np.searchsorted(rows, np.arange(len(sample) + 1))
        needed = []
        for at, query in enumerate(asked):
            scores = points[:, :-1] @ sample[query]
            scores[query] = -np.inf
            for best in np.argpartition(-scores, min(k, len(scores) - 1))[:k]:
                if best != query:
                    needed.append(by_list[at, lists[starts[best]:starts[best + 1]]].min())
        needed = np.sort(needed) if needed else np.array([1.0])
        self.ratio = float(needed[min(len(needed) - 1, int(COVERED * len(needed)))]) * (1 + 1e-6)
        read = np.sum(by_list <= self.ratio, axis=1)
        self.beam = int(min(n_lists, max(32, 1.25 * read.max())))


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id",
            vector: str = "embedding", lists: int = LISTS, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` nearest found rows of ``df`` by
    inner product in double precision, nearest first, ties to the smaller vec_id.

    Rows with the query's own id are no candidates. Vectors that are null, zero or hold null or
    non-finite components take no part, on either side, nor do rows with a null id; vectors of
    another length than the most frequent one (least on a tie) neither. Rows that repeat an id with
    an equal vector count once. Other columns are ignored.
    """
    spark = df.sparkSession
    rows = doubles(df, vector, key).where(valid(F.col("vec")) & F.col("id").isNotNull())
    width_row = rows.groupBy(F.size("vec").alias("w")).count().orderBy(
        F.col("count").desc(), "w").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if width_row is None:
        return spark.createDataFrame([], schema)
    width = int(width_row["w"])
    rows = rows.where(F.size("vec") == width)
    # Of equal vectors, the k + 1 least ids can be in a result (one may be the query's own).
    ranked = rows.distinct().withColumn("no", F.row_number().over(
        Window.partitionBy("vec").orderBy("id"))).where(F.col("no") <= k + 1)
    entries = settle(ranked.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    squares = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    longest = float(np.sqrt(entries.agg(F.max(squares)).first()[0]))
    most = max(256, min(sample, SAMPLE_BYTES // (8 * width)))
    fitted = bounded_sample(entries.select("vec", F.get("ids", F.lit(0)).alias("id")), most,
                            F.col("id")).select("vec").toArrow()
    points = fitted["vec"].combine_chunks().flatten().to_numpy().reshape(-1, width)
    index = Lists(points, longest, lists, k)
    shipped = spark.sparkContext.broadcast(index)

    def placed(rows: DataFrame, name: str, kind: str, reading: bool) -> DataFrame:
        """The rows (name, vec), each with every list it is in or reads."""
        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shipped.value
            for batch in batches:
                if batch.num_rows:
                    vectors = batch.column(1).values.to_numpy().reshape(-1, width)
                    r, at = (own.lists_of if reading else own.homes)(vectors)
                    picked = batch.take(pa.array(r))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(at, pa.int32()), *picked.columns], ["list", name, "vec"])
        return rows.select(name, "vec").mapInArrow(place, f"list int, {name} {kind}, vec array<double>")

    posted = settle(placed(entries, "ids", "array<long>", False))
    asked = doubles(queries, vector, key).where(
        valid(F.col("vec")) & F.col("id").isNotNull() & (F.size("vec") == width)).distinct()
    reads = settle(placed(asked, "id", "long", True))
    # One row per list.
    sizes = posted.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).join(
        reads.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).alias("query_blocks")), "list")
    small = F.broadcast(sizes)  # at most `lists` rows, doubled by uneven halves
    left = posted.join(small, "list").select(
        "list", "ids", "vec", F.pmod(F.xxhash64("vec"), "blocks").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("query_block"))
    right = reads.join(small, "list").select(
        "list", "id", "vec", F.pmod(F.xxhash64("id"), "query_blocks").alias("query_block"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def best(members: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(members) and len(asking):
            own, points = matrix(members["vec"]), matrix(asking["vec"])
            ids, take = members["ids"].tolist(), min(k + 1, len(members))
            counts = np.array([len(x) for x in ids])
            for at in range(0, len(points), 512):
                scores = points[at:at + 512] @ own.T
                edge = np.partition(scores, -take, axis=1)[:, -take]
                # Products in blocks may differ in their last digits: keep what may be level.
                edge = edge - 1e-9 * (np.abs(edge) + np.abs(scores).max(axis=1))
                for j, query in enumerate(asking["id"].iloc[at:at + 512]):
                    chosen = np.flatnonzero(scores[j] >= edge[j])
                    exact = np.einsum("ij,j->i", own[chosen], points[at + j])
                    vec_ids = np.concatenate([ids[c] for c in chosen])
                    level = np.repeat(exact, counts[chosen])
                    other = vec_ids != query
                    vec_ids, level = vec_ids[other], level[other]
                    order = np.lexsort((vec_ids, -level))[:k]
                    out["query_id"].append(np.full(len(order), query))
                    out["vec_id"].append(vec_ids[order])
                    out["score"].append(level[order])
        return pd.DataFrame({name: np.concatenate(x) if x else np.empty(0) for name, x in
                             out.items()}).astype({"query_id": "int64", "vec_id": "int64"})

    keys = ["list", "block", "query_block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        best, "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(
        F.col("score").desc(), "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
