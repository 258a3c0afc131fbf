"""The choice within one block, against the definition, without Spark."""

import random

import numpy as np
import pytest

from usagetide.operators.matching import Block, Turn, _reach, choose_nearest


@pytest.mark.parametrize("seed", range(200))
def test_matches_definition(seed):
    rng = random.Random(seed)
    levels = rng.choice([4, 16, 128, 10**6])
    caliper = rng.choice([0.0, 0.03, 0.2, 1.0])
    treated = sorted((rng.randrange(levels) / levels, i) for i in range(rng.randrange(1, 25)))
    ids = rng.sample(range(1000), rng.randrange(0, 25))
    control = sorted((rng.randrange(levels) / levels, i) for i in ids)
    rank = np.argsort(np.argsort([i for _, i in control])) if control else np.array([], dtype=int)
    got = choose_nearest(
        np.array([p for p, _ in treated]), np.array([p for p, _ in control]), rank, caliper
    )
    free = dict((i, p) for p, i in control)
    for (ps, _), place in zip(treated, got):
        reach = [(abs(p - ps), i) for i, p in free.items() if abs(p - ps) <= caliper]
        want = min(reach)[1] if reach else None
        assert (control[place][1] if place >= 0 else None) == want
        free.pop(want, None)


def blocks_and_turns(extents, controls, treated):
    blocks = [Block(n, controls, low, high) for n, (low, high) in enumerate(extents)]
    turns = [Turn(2 * n, treated, low, high, n, n, False) for n, (low, high) in enumerate(extents)]
    return turns, blocks


def test_reach_stops_at_enough_controls_and_at_the_caliper():
    turns, blocks = blocks_and_turns([(n / 10, n / 10 + 0.05) for n in range(10)], 2, 2)
    full = {n: {-1: 2} for n in range(10)}
    assert _reach(turns, blocks, full, 1.0)[10].reads == {4, 5, 6}
    assert _reach(turns, blocks, full, 0.01)[10].reads == {5}
    # Controls held by earlier turns are passed over, those of later ones are open.
    held = {**full, 4: {0: 2, -1: 0}, 6: {18: 2, -1: 0}}
    assert _reach(turns, blocks, held, 1.0)[10].reads == {3, 5, 6}


def test_reach_reads_a_long_score_from_its_first_block():
    turns, blocks = blocks_and_turns([(0.1, 0.5)] + [(0.5, 0.5)] * 5, 3, 1)
    assert _reach(turns, blocks, {n: {-1: 3} for n in range(6)}, 0.1)[10].reads == {0, 1, 5}
