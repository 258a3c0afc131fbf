import random

import pytest

from usagetide.operators import matching
from usagetide.operators.matching import caliper_match, score_caliper


def sequential(units, caliper):
    """The definition: treated by (score, id), nearest free control, smallest id on ties."""
    free = {i: ps for i, ps, treated in units if not treated}
    pairs = set()
    for ps, i in sorted((ps, i) for i, ps, treated in units if treated):
        reach = [(abs(p - ps), c) for c, p in free.items() if abs(p - ps) <= caliper]
        if reach:
            best = min(reach)[1]
            del free[best]
            pairs.add((i, best))
    return pairs


def run(spark, units, caliper, block_rows):
    df = spark.createDataFrame(units, "company_id long, propensity_score double, is_treatment boolean")
    rows = caliper_match(df, caliper=caliper, block_rows=block_rows).collect()
    controls = [r["control_company_id"] for r in rows]
    assert len(controls) == len(set(controls))
    assert all(r["ps_diff"] == abs(r["treatment_ps"] - r["control_ps"]) for r in rows)
    return {(r["treatment_company_id"], r["control_company_id"]) for r in rows}


def units_of(seed, n, share, levels):
    rng = random.Random(seed)
    ids = rng.sample(range(10 * n), n)
    return [(i, rng.randrange(levels) / levels, rng.random() < share) for i in ids]


@pytest.mark.parametrize(
    "seed,n,share,levels,caliper,block_rows",
    [
        (1, 120, 0.4, 100000, 0.02, 1000),
        (2, 120, 0.4, 100000, 0.02, 30),
        (3, 150, 0.6, 64, 0.05, 30),
        (4, 150, 0.5, 8, 0.2, 25),
        (5, 100, 0.8, 16, 0.0, 20),
    ],
)
def test_equals_sequential_loop(spark, seed, n, share, levels, caliper, block_rows):
    units = units_of(seed, n, share, levels)
    assert run(spark, units, caliper, block_rows) == sequential(units, caliper)


def test_one_score_holds_most_rows(spark):
    rng = random.Random(7)
    units = [(i, 0.5 if i % 3 else rng.random(), i % 2 == 0) for i in range(90)]
    assert run(spark, units, 0.1, 15) == sequential(units, 0.1)


@pytest.mark.parametrize("share", [0.2, 0.8])
def test_hot_score_chooses_by_rank(spark, share, monkeypatch):
    # More treated units at one score than a block holds; with many treated,
    # they run out of equal scores and go on to near ones.
    rng = random.Random(11)
    units = [(i, 0.5 if i % 5 else rng.randrange(40) / 40, rng.random() < share) for i in rng.sample(range(900), 140)]
    calls = []
    by_rank = matching._choose_hot
    monkeypatch.setattr(matching, "_choose_hot", lambda *a: calls.append(a[0]) or by_rank(*a))
    assert run(spark, units, 0.3, 12) == sequential(units, 0.3)
    assert calls and all(turn.hot and turn.treated > 12 for turn in calls)


def test_chain_of_refusals(spark):
    # Each treated unit wants the control the one before it takes.
    units = [(10, 0.50, True), (11, 0.501, True), (12, 0.502, True)]
    units += [(1, 0.503, False), (2, 0.51, False), (3, 0.52, False)]
    assert run(spark, units, 0.05, 2) == {(10, 1), (11, 2), (12, 3)}


def test_equal_distance_takes_smallest_id(spark):
    units = [(10, 0.5, True), (7, 0.25, False), (3, 0.75, False)]
    assert run(spark, units, 0.5, 100) == {(10, 3)}


def test_no_control_in_reach(spark):
    assert run(spark, [(1, 0.1, True), (2, 0.9, False)], 0.05, 100) == set()


def test_default_caliper_is_sample_deviation(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 1.0)], "company_id long, propensity_score double")
    assert score_caliper(df) == (pytest.approx(0.05 * 0.5**0.5), 2)


def runs_of(seed, runs, size, gap=0.01):
    """Units in separated runs: steps inside a run stay below the gap, runs lie further apart."""
    rng = random.Random(seed)
    ids, units = rng.sample(range(10 * runs * size), runs * size), []
    for r in range(runs):
        for k in range(size):
            units.append((ids[r * size + k], r + rng.randrange(size) * gap / 8, rng.random() < 0.4))
    return units


def test_separated_runs_need_no_turns(spark, monkeypatch):
    monkeypatch.setattr(matching, "_match_in_turns", lambda *a: pytest.fail("a run takes turns"))
    groups = []
    by_group = matching._match_runs
    monkeypatch.setattr(matching, "_match_runs", lambda *a: groups.append(a[0]) or by_group(*a))
    units = runs_of(3, 12, 25)
    for block_rows in (25, 60, 150):
        assert run(spark, units, 0.05, block_rows) == sequential(units, 0.05)
        n = groups[-1].selectExpr(f"floor(run / {block_rows})").distinct().count()
        assert n >= 300 // block_rows


def test_short_and_long_runs_together(spark, monkeypatch):
    turns = []
    in_turns = matching._match_in_turns
    monkeypatch.setattr(matching, "_match_in_turns", lambda *a: turns.append(a[0].count()) or in_turns(*a))
    rng = random.Random(6)
    units = runs_of(5, 6, 15) + [(5000 + i, 20 + rng.random(), rng.random() < 0.5) for i in range(120)]
    assert run(spark, units, 0.05, 40) == sequential(units, 0.05)
    assert turns and turns[0] <= 120


def test_runs_are_cut_at_gaps_above_the_caliper(spark):
    scores = [0.0, 0.1, 0.2, 0.5, 0.55, 0.9, 0.9, 1.5]
    units = spark.createDataFrame([(i, s, i % 2 == 0) for i, s in enumerate(scores)], "id long, ps double, is_treated boolean")
    for blocks in (1, 3, 8):
        cut = matching._cut_blocks(units, blocks)
        got = matching.independent_runs(cut, matching._blocks(cut), 0.1).orderBy("id").collect()
        assert [r["run"] for r in got] == [0, 0, 0, 3, 3, 5, 5, 7]
