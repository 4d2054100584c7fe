"""Cheapest way through a chain of four-state steps, by divide and conquer in linear space.

A step is a list of arcs (from, to, cost, order): ``order`` ranks the arcs of one ``from`` state.
Among ways of equal cost the one whose orders are least, read from the start, is taken. Forward
cost vectors carry a rank per state beside the cost: two ways to different states differ in some
step, and the earliest one decides, so ranks of four states say all that later steps need.
"""

from __future__ import annotations

from collections.abc import Sequence

STATES = 4
FAR = 1 << 60
Arc = tuple[int, int, int, object]


def forward(steps: Sequence[Sequence[Arc]], low: int, high: int,
            start: int) -> tuple[list[int], list[int]]:
    """Least cost and rank per state after the steps low..high-1 from ``start``."""
    costs, ranks = [FAR] * STATES, [0] * STATES
    costs[start] = 0
    for at in range(low, high):
        best: list = [None] * STATES
        for source, target, cost, order in steps[at]:
            if costs[source] < FAR:
                way = (costs[source] + cost, ranks[source], order)
                if best[target] is None or way < best[target]:
                    best[target] = way
        ways = sorted((way[1:], state) for state, way in enumerate(best) if way is not None)
        costs = [FAR if way is None else way[0] for way in best]
        for rank, (_, state) in enumerate(ways):
            ranks[state] = rank
    return costs, ranks


def backward(steps: Sequence[Sequence[Arc]], low: int, high: int, end: int) -> list[int]:
    """Least cost per state before step ``low`` to reach ``end`` after step high-1."""
    costs = [FAR] * STATES
    costs[end] = 0
    for at in range(high - 1, low - 1, -1):
        before = [FAR] * STATES
        for source, target, cost, _ in steps[at]:
            if costs[target] + cost < before[source]:
                before[source] = costs[target] + cost
        costs = before
    return costs


def states(steps: Sequence[Sequence[Arc]], start: int, end: int) -> list[int]:
    """The states before, between and after the steps on the best way from start to end.

    The chain is cut in the middle: forward costs from the start and backward costs from the end
    meet there, the least of the optimal crossings is taken, and both halves are cut in turn.
    """
    found = [start] * (len(steps) + 1)
    found[-1] = end
    halves = [(0, len(steps))]
    while halves:
        low, high = halves.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        costs, ranks = forward(steps, low, middle, found[low])
        rest = backward(steps, middle, high, found[high])
        found[middle] = min(range(STATES),
                            key=lambda s: (costs[s] + rest[s], ranks[s]))
        halves += [(low, middle), (middle, high)]
    return found


def summary(steps: Sequence[Sequence[Arc]]) -> list[Arc]:
    """The whole chain as one step: its arcs are the best ways between each pair of states."""
    arcs = []
    for start in range(STATES):
        costs, ranks = forward(steps, 0, len(steps), start)
        arcs += [(start, s, costs[s], ranks[s]) for s in range(STATES) if costs[s] < FAR]
    return arcs
