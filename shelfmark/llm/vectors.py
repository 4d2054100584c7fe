"""What the vector operators share: valid vectors and packed graphs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .smallworld import Graph


def valid(vector: Column) -> Column:
    """True for vectors that are not null, not zero and hold finite components only."""
    big = float(np.finfo(np.float64).max)
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > big))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0),
                      F.lit(False))


def doubles(df: DataFrame, vector: str, key: str) -> DataFrame:
    """id and vec (array<double>) of every row."""
    return df.select(F.col(f"`{key}`").cast("long").alias("id"),
                     F.col(f"`{vector}`").cast("array<double>").alias("vec"))


def matrix(column) -> np.ndarray:
    """A float64 matrix of a pandas column of equally long arrays."""
    return np.array(column.tolist(), dtype=np.float64)


def pack(graph: Graph) -> dict[str, bytes]:
    return {"nodes": graph.vectors.tobytes(),
            "sizes": np.array([x.shape for x in graph.links], np.int64).tobytes(),
            "links": b"".join(x.tobytes() for x in graph.links)}


def unpack(row, width: int) -> Graph:
    vectors = np.frombuffer(row["nodes"], np.float32).reshape(-1, width)
    links, at = [], 0
    flat = np.frombuffer(row["links"], np.int32)
    for n, degree in np.frombuffer(row["sizes"], np.int64).reshape(-1, 2):
        links.append(flat[at:at + n * degree].reshape(n, degree))
        at += n * degree
    return Graph(vectors, links)
