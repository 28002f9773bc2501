"""Packing against an exhaustive search."""

import random

from weirflow.llm.packing import pack


def optimum(sizes, capacities, cost):
    """The least cost of all ways to put the sizes into bins."""
    best = float("inf")

    def go(i, bins):
        nonlocal best
        total = sum(cost(next(c for c in capacities if c >= b)) for b in bins)
        if total >= best:
            return
        if i == len(sizes):
            best = total
            return
        for j, used in enumerate(bins):
            if used + sizes[i] <= capacities[-1]:
                go(i + 1, [*bins[:j], used + sizes[i], *bins[j + 1 :]])
        go(i + 1, [*bins, sizes[i]])

    go(0, [])
    return best


def test_small_lists_are_packed_nearly_as_well_as_can_be():
    rnd, capacities, same = random.Random(4), [8, 16, 32], 0
    for _ in range(200):
        per_bin, quadratic = rnd.choice([(1, 0.0), (4, 1 / 64), (0, 1 / 16)])

        def cost(c):
            return per_bin + c + quadratic * c * c

        sizes = sorted((rnd.randint(1, 32) if rnd.random() < 0.4 else rnd.randint(1, 10) for _ in range(rnd.randint(1, 7))), reverse=True)
        bins, fitted = pack(sizes, capacities, per_bin, quadratic)
        used = [sum(s for s, b in zip(sizes, bins) if b == i) for i in range(len(fitted))]
        assert all(next(c for c in capacities if c >= u) == f for u, f in zip(used, fitted))
        least, found = optimum(sizes, capacities, cost), sum(map(cost, fitted))
        assert least <= found + 1e-9 and found <= 1.2 * least
        same += found <= least + 1e-9
    assert same >= 180
