"""Hierarchical navigable small-world graph over vectors, with batches of queries.

Nodes are in random order; level l holds the first n / 16^l of them, so that levels are prefixes
and need no ids of their own. Nodes are inserted in growing batches: each is searched in the graph
so far, its neighbours are picked so that none is nearer to an earlier pick than to the node, and
the picks get a link back. Nearness is that of squared distance: 2 q.v - v.v, larger is nearer.
All steps work on whole batches of queries in numpy.
"""

from __future__ import annotations

import numpy as np

_FACTOR = 16
_START = 512
_STEP = 4  # candidates that a query expands at a time


class Graph:
    """``vectors`` float32 (n, d) in random order; ``links`` per level int32 (n_l, degree), -1 pads."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray]):
        self.vectors, self.links = vectors, links
        self.half = np.einsum("ij,ij->i", vectors, vectors)
        self._back = None

    # -- search ------------------------------------------------------------------------------------

    def near(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Nearness of ids (b, k) to queries (b, d); -inf for -1."""
        got = np.einsum("bkd,bd->bk", self.vectors[ids], queries) * 2 - self.half[ids]
        return np.where(ids < 0, -np.inf, got)

    def search(self, queries: np.ndarray, beam: int, level: int = 0):
        """The ``beam`` nearest found per query, nearest first: ids (-1 pads) and nearness."""
        top = len(self.links) - 1
        n_top = len(self.links[top])
        if n_top <= _START:  # the top level is small enough to see whole
            scores = queries @ self.vectors[:n_top].T * 2 - self.half[:n_top]
            entry = np.argmax(scores, axis=1)[:, None]
            if top <= level and n_top <= beam:
                order = np.argsort(-scores, axis=1, kind="stable")
                return order, np.take_along_axis(scores, order, axis=1)
        else:
            entry = np.zeros((len(queries), 1), np.int64)
        for at in range(top, level, -1):
            entry = self._beam(queries, entry, 4, at)[0][:, :1]
        return self._beam(queries, entry, beam, level)

    def _beam(self, queries, entry, beam, level):
        links, b = self.links[level], len(queries)
        seen = np.zeros((b, len(links)), bool)
        ids = np.full((b, beam), -1, np.int64)
        ids[:, :entry.shape[1]] = entry[:, :beam]
        scores = self.near(queries, ids)
        done = ids < 0
        r, c = np.nonzero(ids >= 0)
        seen[r, ids[r, c]] = True
        live = np.arange(b)
        while len(live):
            open_scores = np.where(done[live], -np.inf, scores[live])
            pick = np.argpartition(-open_scores, min(_STEP, beam) - 1, axis=1)[:, :_STEP]
            good = np.take_along_axis(open_scores, pick, axis=1) > -np.inf
            keep = good.any(axis=1)
            live, pick, good = live[keep], pick[keep], good[keep]
            if not len(live):
                break
            at = live[:, None]
            done[at, pick] = True
            chosen = np.where(good, ids[at, pick], -1)
            found = np.where(chosen[:, :, None] >= 0, links[chosen], -1).reshape(len(live), -1)
            found = np.sort(found, axis=1)
            fresh = (found >= 0) & ~seen[at, np.maximum(found, 0)]
            fresh[:, 1:] &= found[:, 1:] != found[:, :-1]
            found = np.where(fresh, found, -1)
            r, c = np.nonzero(fresh)
            seen[live[r], found[r, c]] = True
            width = int(fresh.sum(axis=1).max()) if len(r) else 0
            if not width:
                continue
            order = np.argsort(~fresh, axis=1, kind="stable")[:, :width]
            found = np.take_along_axis(found, order, axis=1)
            new = self.near(queries[live], found)
            all_ids = np.concatenate([ids[live], found], axis=1)
            all_scores = np.concatenate([scores[live], new], axis=1)
            all_done = np.concatenate([done[live], found < 0], axis=1)
            best = np.argpartition(-all_scores, beam - 1, axis=1)[:, :beam]
            ids[live] = np.take_along_axis(all_ids, best, axis=1)
            scores[live] = np.take_along_axis(all_scores, best, axis=1)
            done[live] = np.take_along_axis(all_done, best, axis=1)
        order = np.argsort(-scores, axis=1, kind="stable")
        return np.take_along_axis(ids, order, axis=1), np.take_along_axis(scores, order, axis=1)

    def _linkers(self):
        """For every node, who links to it: in a dense group a node may lose all links to it, but
        keeps its own."""
        if self._back is None:
            links = self.links[0]
            source, place = np.nonzero(links >= 0)
            target = links[source, place]
            order = np.argsort(target, kind="stable")
            self._back = np.searchsorted(target[order], np.arange(len(links) + 1)), source[order]
        return self._back

    def within(self, queries: np.ndarray, least: float, beam: int):
        """Pairs (query row, node) of nearness ``least`` or more: what a beam finds, and then all
        that is reached from these through nodes that are themselves near enough."""
        ids, scores = self.search(queries, beam)
        links = self.links[0]
        starts, linkers = self._linkers()
        seen = np.zeros((len(queries), len(links)), bool)
        r, c = np.nonzero((ids >= 0) & (scores >= least))
        r, v = r, ids[r, c]
        seen[r, v] = True
        found_r, found_v = [r], [v]
        while len(r):
            nearby, back = links[v], starts[v + 1] - starts[v]
            into = np.arange(back.sum()) + np.repeat(starts[v] - (np.cumsum(back) - back), back)
            rr = np.concatenate([np.repeat(r, nearby.shape[1]), np.repeat(r, back)])
            vv = np.concatenate([nearby.ravel(), linkers[into]])
            fresh = vv >= 0
            rr, vv = rr[fresh], vv[fresh]
            fresh = ~seen[rr, vv]
            key = np.unique(rr[fresh] * len(links) + vv[fresh])
            rr, vv = key // len(links), key % len(links)
            seen[rr, vv] = True
            score = np.concatenate([
                np.einsum("ij,ij->i", queries[rr[k:k + 65536]], self.vectors[vv[k:k + 65536]]) * 2
                - self.half[vv[k:k + 65536]] for k in range(0, len(rr), 65536)] or [np.empty(0)])
            r, v = rr[score >= least], vv[score >= least]
            found_r.append(r)
            found_v.append(v)
        return np.concatenate(found_r), np.concatenate(found_v)


def _pick(vectors, half, node, cand, scores, degree):
    """Diverse neighbours: candidates (b, k) by falling score; one is kept unless it is nearer to a
    kept one than to the node. Free places go to the nearest of the rest."""
    order = np.argsort(-scores, axis=1, kind="stable")
    cand, scores = np.take_along_axis(cand, order, 1), np.take_along_axis(scores, order, 1)
    b, k = cand.shape
    own = vectors[np.maximum(cand, 0)]
    size = half[np.maximum(cand, 0)]
    mutual = 2 * (own @ own.transpose(0, 2, 1)) - size[:, None, :] - size[:, :, None]
    to_node = scores - half[node][:, None]  # minus the squared distance to the node
    kept = np.zeros((b, k), bool)
    count = np.zeros(b, np.int64)
    for j in range(k):
        clash = (kept & (mutual[:, j, :] > to_node[:, j][:, None])).any(axis=1)
        take = ~clash & (cand[:, j] >= 0) & (count < degree)
        kept[:, j] = take
        count += take
    rank = np.argsort(np.where(kept, 0, np.where(cand >= 0, 1, 2)), axis=1, kind="stable")
    rank = rank[:, :degree]
    out = np.take_along_axis(cand, rank, 1)
    if out.shape[1] < degree:
        out = np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1)
    return out


def _link_back(vectors, half, links, nodes, picked):
    """Add every new node to its neighbours' lists; a full list is picked anew."""
    source = np.repeat(nodes, picked.shape[1])
    target = picked.ravel()
    good = target >= 0
    source, target = source[good], target[good]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    owners, start, count = np.unique(target, return_index=True, return_counts=True)
    degree = links.shape[1]
    for k in range(0, len(owners), 256):
        own, s, c = owners[k:k + 256], start[k:k + 256], count[k:k + 256]
        # More than two lists' worth of newcomers: the first by order; each keeps its own link.
        width = int(min(c.max(), 2 * degree))
        place = s[:, None] + np.arange(width)
        new = np.where(np.arange(width) < c[:, None], source[np.minimum(place, len(source) - 1)], -1)
        cand = np.concatenate([links[own], new], axis=1)
        got = np.einsum("bkd,bd->bk", vectors[np.maximum(cand, 0)], vectors[own]) * 2 - half[
            np.maximum(cand, 0)]
        got = np.where(cand < 0, -np.inf, got)
        links[own] = _pick(vectors, half, own, cand, got, degree)


def build(vectors: np.ndarray, degree: int = 24, beam: int = 48) -> Graph:
    """A graph over ``vectors``, which must be in random order."""
    vectors = np.ascontiguousarray(vectors, dtype=np.float32)
    n = len(vectors)
    sizes = [n]
    while sizes[-1] > _START:
        sizes.append(-(-sizes[-1] // _FACTOR))
    graph = Graph(vectors, [np.full((size, degree), -1, np.int32) for size in sizes])
    half = graph.half
    for level in range(len(sizes) - 1, -1, -1):
        links, size, done = graph.links[level], sizes[level], 0
        while done < size:
            stop = min(size, _START if not done else done + min(done, 1024))
            nodes = np.arange(done, stop)
            own = vectors[nodes]
            inner = own @ own.T * 2 - half[nodes][None, :]
            np.fill_diagonal(inner, -np.inf)
            take = min(beam, len(nodes) - 1)
            parts, values = [], []
            if take > 0:
                best = np.argpartition(-inner, take - 1, axis=1)[:, :take]
                parts.append(nodes[best])
                values.append(np.take_along_axis(inner, best, axis=1))
            if done:
                part = Graph.__new__(Graph)
                part.vectors, part.half, part._back = vectors, half, None
                part.links = [x[:done] if at == level else x for at, x in enumerate(graph.links)
                              if at <= level or len(x) <= done]
                got = [part.search(own[k:k + 256], beam, level) for k in range(0, len(own), 256)]
                parts.append(np.concatenate([g[0][:, :beam] for g in got]))
                values.append(np.concatenate([g[1][:, :beam] for g in got]))
            if parts:
                cand, score = np.concatenate(parts, axis=1), np.concatenate(values, axis=1)
                picked = np.concatenate([_pick(vectors, half, nodes[k:k + 256], cand[k:k + 256],
                                               score[k:k + 256], degree)
                                         for k in range(0, len(nodes), 256)])
                links[nodes] = picked
                _link_back(vectors, half, links, nodes, picked)
            done = stop
    return graph
