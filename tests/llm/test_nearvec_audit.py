"""The recall audit against graphs that lose links."""

import numpy as np
import pytest

from shelfmark.llm import nearvec
from shelfmark.llm.smallworld import Graph


class Losing(Graph):
    """Compares all, but loses what ``lost`` (nodes) link with, themselves excepted."""

    def __init__(self, units, lost):
        super().__init__(units.astype(np.float32), [np.zeros((len(units), 24), np.int32)])
        self.lost = lost

    def within(self, queries, least, beam):
        cosine = queries @ self.vectors.T
        r, v = np.nonzero((2 * cosine - 1 >= least) & ((cosine > 0.99999) | ~self.lost))
        return r, v


def units_of(rng, singles, pairs, group):
    """Singles, then pairs side by side, then one group, as unit vectors of which only pairs' and
    the group's own members link."""
    points = rng.normal(size=(singles + pairs + 1, 64))
    near = lambda x: x + rng.normal(size=x.shape) * 0.1
    rows = [points[:singles], np.repeat(points[singles:-1], 2, axis=0), np.repeat(points[-1:], group, axis=0)]
    return nearvec._unit(near(np.concatenate(rows)))


def test_audit_does_not_count_the_node_itself():
    units = units_of(np.random.default_rng(1), 998, 1, 0)[::-1]  # the pair comes first
    graph = Losing(units, np.arange(1000) < 2)
    assert nearvec._audited(graph, units, 0.9, 0.995) == 1000
    assert nearvec._audited(Losing(units, np.zeros(1000, bool)), units, 0.9, 0.995) == 16


def test_audit_is_a_mean_over_nodes():
    units = units_of(np.random.default_rng(2), 0, 1000, 1000)
    units = units[np.random.default_rng(3).permutation(3000)]
    lost = (units @ units.T >= 0.9).sum(axis=1) == 2
    assert lost.sum() == 2000
    assert nearvec._audited(Losing(units, lost), units, 0.9, 0.995) == 3000


def test_audit_asks_for_nodes_of_other_shards():
    units = units_of(np.random.default_rng(4), 0, 600, 0)
    own, foreign = units[::2], units[1::2]
    assert nearvec._audited(Losing(own, np.zeros(600, bool)), own, 0.9, 0.995, foreign) == 16
    assert nearvec._audited(Losing(own, np.ones(600, bool)), own, 0.9, 0.995, foreign) == 600
    # Too few of them link to tell.
    assert nearvec._audited(Losing(own, np.zeros(600, bool)), own, 0.9, 0.995, units[1:800:2] * -1) == 600


def brute(units):
    links = units @ units.T >= 0.9
    label = np.arange(len(units))
    while True:
        new = np.array([label[row].min() for row in links])
        if (new == label).all():
            return links.sum(axis=1) - 1, label
        label = new


@pytest.mark.parametrize("shard_rows", [700, 4000])
def test_groups_of_pairs_beside_a_crowd_equal_brute_force(spark, shard_rows):
    units = units_of(np.random.default_rng(5), 300, 500, 700)
    units = units[np.random.default_rng(6).permutation(len(units))]
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(units)],
                               "vec_id long, embedding array<double>")
    got = nearvec.groups(df, 0.9, shard_rows=shard_rows, block_rows=300).orderBy("vec_id").collect()
    counts, label = brute(units)
    assert [r["n_links"] for r in got] == counts.tolist()
    assert [r["component_id"] for r in got] == label.tolist()


class Blind(Losing):
    """Finds nothing."""

    def within(self, queries, least, beam):
        return np.empty(0, np.int64), np.empty(0, np.int64)


@pytest.mark.parametrize("rows", [8, 1 << 20])
def test_a_link_found_from_one_end_counts_at_both(rows):
    units = units_of(np.random.default_rng(7), 30, 100, 170)
    units = units[np.random.default_rng(8).permutation(len(units))]
    cids, copies = np.arange(400) * 3, np.arange(400) % 3 + 1
    links = units @ units.T >= 0.9
    np.fill_diagonal(links, False)
    at = np.arange(400) < 150
    # Two shards: only the second's nodes, asking the first, find links.
    shards = [(kind(units[own], np.zeros(own.sum(), bool)), cids[own], copies[own], units[own], 16)
              for kind, own in ((Losing, at), (Blind, ~at))]
    for one, other in (shards, shards[::-1]):
        ids, counts, roots = nearvec._joined(one, other, 0.9, rows)
        want = (links & (at[:, None] != at)) @ copies
        assert dict(zip(ids, counts)) == dict(zip(cids, want))
        label = dict(zip(ids, roots))
        assert all(label[cids[x]] == label[cids[y]] for x, y in np.argwhere(links) if at[x] != at[y])
    # One shard, of which the even nodes are found by no other.
    lost = np.arange(400) % 2 == 0
    ids, counts, _ = nearvec._joined((Losing(units, lost), cids, copies, units, 16), None, 0.9, rows)
    assert counts.tolist() == ((links & ~(lost[:, None] & lost)) @ copies).tolist()
