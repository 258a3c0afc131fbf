"""Greedy 1:1 nearest-neighbour matching within a caliper, without replacement.

Treated units choose in ascending (score, id) order; each takes the nearest
control that is still free, the smallest id among equally near ones. The choice
of a unit depends only on the units before it, so the result is fixed.

Where two neighbouring scores lie further apart than the caliper, no pair and no
influence crosses. Such gaps cut the score axis into independent runs. They are
found by neighbours inside ranges of rows plus one edge per range; runs are
packed, in order, into groups of about ``BLOCK_ROWS`` rows, and all groups are
matched in one parallel pass.

A run longer than that is matched in turns. Its rows lie in blocks of bounded
count, and the treated units of a block choose in one turn. Each round lets
every turn choose at the same time, given what earlier turns chose in the round
before. The first turn is final after round one, and by induction turn i after
round i at the latest; when no choice changes, all are final. Only turns that
can see a changed control choose again, and the claims of turns before the first
of those are final: they are set aside and not written again.

No candidate pairs are formed. A turn receives the controls of its own block
plus, on each side, the nearest blocks that hold as many open controls as it
has treated units: it cannot use more.

A score shared by more treated units than a block holds is one turn of its own.
Its units rank the controls alike, so unit k takes the k-th open control: a
join on rank, spread over the cluster.

Influence fades along the axis, so few rounds are the rule. Where treated units
outnumber controls over a long stretch, a change travels one block per round
there: the cost then nears that of one pass in order, and memory per task stays
that of a block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.running import global_ranks
from ..session import materialize
from .causal import CALIPER_SHARE

BLOCK_ROWS = 50_000


@dataclass
class Block:
    """Controls and extent of one block of rows; one entry per block lives on the driver."""

    number: int
    controls: int
    first_row: float
    last_row: float
    rows: int = 0


@dataclass
class Turn:
    """Treated units that choose together: those of a block, or of one hot score."""

    number: int
    treated: int
    first: float
    last: float
    low_block: int
    high_block: int
    hot: bool


@dataclass
class Reach:
    """What a turn must see: blocks it reads, and the range whose changes concern it."""

    reads: set[int]
    first: int
    last: int


def score_caliper(
    scored: DataFrame, score: str = "propensity_score", share: float = CALIPER_SHARE
) -> tuple[float, int]:
    """``share`` sample standard deviations of the score, and the number of scores."""
    deviation, n = scored.agg(F.stddev_samp(score), F.count(score)).first()
    return (0.0 if deviation is None else share * float(deviation)), n


def choose_nearest(
    treated_ps: np.ndarray, control_ps: np.ndarray, control_rank: np.ndarray, caliper: float
) -> np.ndarray:
    """Index of the control taken by each treated unit, -1 for none.

    Treated scores are in choosing order, controls in (score, id) order, and
    ``control_rank`` orders the control ids. Links to the next open control on
    either side skip taken ones, so a choice costs near constant time.
    """
    n = len(control_ps)
    # Slot i + 1 belongs to control i; slots 0 and n + 1 are the ends.
    left = np.arange(n + 2)
    right = np.arange(n + 2)
    group_first = np.searchsorted(control_ps, control_ps, side="left") + 1

    def find(link: np.ndarray, slot: int) -> int:
        root = slot
        while link[root] != root:
            root = link[root]
        while link[slot] != root:
            link[slot], slot = root, link[slot]
        return int(root)

    chosen = np.full(len(treated_ps), -1, dtype=np.int64)
    starts = np.searchsorted(control_ps, treated_ps, side="right")
    for i, score in enumerate(treated_ps):
        best, best_gap = -1, np.inf
        # Below or equal: the smallest open id of the nearest score. Distinct
        # scores may round to one distance, hence the walk over equal gaps.
        slot = find(left, int(starts[i]))
        while slot > 0:
            slot = find(right, int(group_first[slot - 1]))
            gap = abs(control_ps[slot - 1] - score)
            if gap > caliper or gap > best_gap:
                break
            if best < 0 or gap < best_gap or control_rank[slot - 1] < control_rank[best]:
                best, best_gap = slot - 1, gap
            slot = find(left, int(group_first[slot - 1]) - 1)
        # Above: the first open slot is the smallest id of the nearest score.
        slot = find(right, int(starts[i]) + 1)
        while slot <= n:
            gap = abs(control_ps[slot - 1] - score)
            if gap > caliper or gap > best_gap:
                break
            if best < 0 or gap < best_gap or control_rank[slot - 1] < control_rank[best]:
                best, best_gap = slot - 1, gap
            group_end = int(np.searchsorted(control_ps, control_ps[slot - 1], side="right"))
            slot = find(right, group_end + 1)
        if best >= 0:
            chosen[i] = best
            left[best + 1] = best
            right[best + 1] = best + 2
    return chosen


def _choose_block(rows: pd.DataFrame, caliper: float) -> pd.DataFrame:
    treated = rows[rows["is_treated"]].sort_values(["ps", "id"], kind="stable")
    control = rows[~rows["is_treated"]].sort_values(["ps", "id"], kind="stable")
    rank = control["id"].rank(method="first").to_numpy(dtype=np.int64, na_value=0)
    taken = choose_nearest(treated["ps"].to_numpy(), control["ps"].to_numpy(), rank, caliper)
    hit = taken >= 0
    return pd.DataFrame(
        {
            "control_id": control["id"].to_numpy()[taken[hit]],
            "control_ps": control["ps"].to_numpy()[taken[hit]],
            "control_block": control["block"].to_numpy()[taken[hit]],
            "treated_id": treated["id"].to_numpy()[hit],
            "treated_ps": treated["ps"].to_numpy()[hit],
            "holder": treated["target"].to_numpy()[hit],
        }
    )


def _cut_blocks(units: DataFrame, blocks: int) -> DataFrame:
    """Rows placed in blocks by range of (score, id), stored so that they stay put.

    The id is part of the range key: a score shared by very many accounts is
    spread over several blocks.
    """
    placed = units.repartitionByRange(blocks, "ps", "id").withColumn("block", F.spark_partition_id())
    return materialize(placed)


def _take_turns(units: DataFrame, block_rows: int) -> DataFrame:
    """Treated units with their turn: even for a block, odd for a hot score.

    There are at most (rows / block_rows) hot scores. A hot score that starts in
    block b chooses after the lower scores of b and before any later block.
    """
    treated = units.where("is_treated")
    hot = (
        treated.groupBy("ps")
        .agg(F.count(F.lit(1)).alias("n"), F.min("block").alias("low"), F.max("block").alias("high"))
        .where((F.col("n") > block_rows) & (F.col("high") > F.col("low")))
        .select("ps", (2 * F.col("low") + 1).alias("hot_turn"))
    )
    return treated.join(F.broadcast(hot), "ps", "left").select(
        "id",
        "ps",
        "is_treated",
        "block",
        F.coalesce("hot_turn", 2 * F.col("block")).alias("turn"),
        F.col("hot_turn").isNotNull().alias("is_hot"),
    )


def _blocks(units: DataFrame) -> list[Block]:
    rows = units.groupBy("block").agg(F.count_if(~F.col("is_treated")), F.min("ps"), F.max("ps"), F.count(F.lit(1)))
    return sorted((Block(*row) for row in rows.collect()), key=lambda b: b.number)


def _turns(treated: DataFrame) -> list[Turn]:
    rows = treated.groupBy("turn").agg(
        F.count(F.lit(1)), F.min("ps"), F.max("ps"), F.min("block"), F.max("block"), F.max("is_hot")
    )
    return sorted((Turn(*row) for row in rows.collect()), key=lambda t: t.number)


def _reach(
    turns: list[Turn], blocks: list[Block], open_counts: dict[int, dict[int, int]], caliper: float
) -> dict[int, Reach]:
    """The reach of every turn.

    ``open_counts[block][turn]`` counts controls by the turn that holds them; -1
    is nobody. A control held by the turn itself or a later one is open to it.
    """
    places = {block.number: place for place, block in enumerate(blocks)}

    def open_to(turn: Turn, place: int) -> int:
        counts = open_counts.get(blocks[place].number, {})
        return sum(n for holder, n in counts.items() if holder < 0 or holder >= turn.number)

    reach = {}
    for turn in turns:
        low, high = places[turn.low_block], places[turn.high_block]
        reads = {blocks[place].number for place in range(low, high + 1)}

        # Downwards by score, but a score that spans blocks is used from its
        # smallest id on, hence from its first block.
        seen = 0
        while low > 0 and seen < turn.treated:
            score = blocks[low - 1].last_row
            if abs(score - turn.first) > caliper:
                break
            start = low - 1
            while start > 0 and blocks[start - 1].last_row == score:
                start -= 1
            for other in range(start, low):
                usable = open_to(turn, other)
                if usable:
                    reads.add(blocks[other].number)
                # Count only what is surely among the nearest: not the first
                # block of a run (it may hold other scores too), nor a block
                # whose lowest score goes on below it.
                alone = start == low - 1 and (start == 0 or blocks[start - 1].last_row != blocks[start].first_row)
                if other > start or alone:
                    seen += usable
                if seen >= turn.treated:
                    break
            low = start

        seen = 0
        while high + 1 < len(blocks) and seen < turn.treated:
            if abs(blocks[high + 1].first_row - turn.last) > caliper:
                break
            high += 1
            usable = open_to(turn, high)
            seen += usable
            if usable:
                reads.add(blocks[high].number)
        reach[turn.number] = Reach(reads, blocks[low].number, blocks[high].number)
    return reach


def _owners(claims: DataFrame) -> DataFrame:
    """The earliest turn that claims each control."""
    return claims.groupBy("control_id", "control_block").agg(F.min("holder").alias("holder"))


def _open_counts(claims: DataFrame | None, blocks: list[Block]) -> dict[int, dict[int, int]]:
    """Controls per block and holding turn; small, from one aggregate."""
    counts: dict[int, dict[int, int]] = {block.number: {-1: block.controls} for block in blocks}
    if claims is None:
        return counts
    held = _owners(claims).groupBy("control_block", "holder").count().collect()
    for where, holder, n in held:
        counts[where][holder] = n
        counts[where][-1] -= n
    return counts


def _changes(old: DataFrame | None, new: DataFrame) -> list[tuple[int, int]]:
    """(block, turn) of every claim present in only one of the two."""
    both = new.withColumn("side", F.lit(1))
    if old is not None:
        both = both.unionByName(old.withColumn("side", F.lit(-1)))
    return (
        both.groupBy("control_block", "control_id", "treated_id", "holder")
        .agg(F.sum("side").alias("net"))
        .where("net <> 0")
        .select("control_block", "holder")
        .distinct()
        .collect()
    )


def _choose_hot(turn: Turn, treated: DataFrame, offered: DataFrame, caliper: float, block_rows: int) -> DataFrame:
    """Claims of a turn whose units all have one score: a join on rank."""
    score = F.lit(turn.first)
    near = offered.withColumn("gap", F.abs(F.col("ps") - score)).where(F.col("gap") <= caliper)
    parts = -(-turn.treated // block_rows)
    asking = global_ranks(treated.where(F.col("turn") == turn.number).select("id"), ["id"], parts)
    controls = global_ranks(near.select("id", "ps", "block", "gap"), ["gap", "id"], parts)
    return asking.withColumnRenamed("id", "treated_id").join(controls, "place").select(
        F.col("id").alias("control_id"),
        F.col("ps").alias("control_ps"),
        F.col("block").alias("control_block"),
        "treated_id",
        score.alias("treated_ps"),
        F.lit(turn.number).alias("holder"),
    )


def _small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """One row per block, to be broadcast."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def independent_runs(units: DataFrame, blocks: list[Block], caliper: float) -> DataFrame:
    """``units`` with ``run``: the place, in score order, of the first row of their run.

    Rows of a run have no neighbours further apart than the caliper. Places and gaps come from each
    block alone plus three numbers per block: rows before it, the last score before it, and the last run that began before it.
    """
    spark = units.sparkSession
    edges, rows, last = [], 0, None
    for block in blocks:
        edges.append((block.number, rows, last))
        rows, last = rows + block.rows, block.last_row
    inside = Window.partitionBy("block").orderBy("ps", "id")
    before = F.coalesce(F.lag("ps").over(inside), F.col("last_score"))
    begins = before.isNull() | (F.col("ps") - before > F.lit(caliper))
    place = F.row_number().over(inside) - 1 + F.col("rows_before")
    marked = (
        units.join(_small(spark, edges, "block int, rows_before long, last_score double"), "block")
        .withColumn("begin", F.when(begins, place))
        .withColumn("run", F.max("begin").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .select("id", "ps", "is_treated", "block", "run")
    )
    marked = materialize(marked)
    newest = dict(marked.groupBy("block").agg(F.max("run")).collect())
    carried, run = [], None
    for block in blocks:
        carried.append((block.number, run))
        run = run if newest[block.number] is None else newest[block.number]
    joined = marked.join(_small(spark, carried, "block int, run_before long"), "block")
    return joined.withColumn("run", F.coalesce("run", "run_before")).drop("run_before")


def _claim_schema(units: DataFrame) -> str:
    kind = units.schema["id"].dataType.simpleString()
    return f"control_id {kind}, control_ps double, control_block int, treated_id {kind}, treated_ps double, holder int"


def _match_runs(runs: DataFrame, caliper: float, block_rows: int) -> DataFrame:
    """Claims inside runs, packed into groups by the place of their first row. A group ends with the run that fills it."""

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        return _choose_block(rows, caliper)

    packed = runs.withColumn("target", F.floor(F.col("run") / block_rows).cast("int"))
    return packed.groupBy("target").applyInPandas(choose, _claim_schema(runs))


def _match_in_turns(units: DataFrame, caliper: float, block_rows: int) -> DataFrame:
    """Claims among units whose runs are longer than a block."""
    spark = units.sparkSession
    controls, treated = units.where("not is_treated"), materialize(_take_turns(units, block_rows))
    blocks, turns = _blocks(units), _turns(treated)
    by_number = {turn.number: turn for turn in turns}
    claim_schema = _claim_schema(units)
    # Claims of turns that nothing can change any more, and those of the others.
    final: DataFrame = materialize(spark.createDataFrame([], claim_schema))
    claims: DataFrame | None = None
    active: set[int] | None = None

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        return _choose_block(rows, caliper)

    for _ in turns:
        known = final if claims is None else final.unionByName(claims)
        reach = _reach(turns, blocks, _open_counts(known, blocks), caliper)
        targets = sorted(reach) if active is None else sorted(active)
        if not targets:
            break

        # Which turns read the controls of which block: a few rows per turn.
        routes = [(where, target) for target in targets for where in sorted(reach[target].reads)]
        route = spark.createDataFrame(routes, "block int, target int")
        read = controls.where(F.col("block").isin(sorted({where for where, _ in routes})))
        if claims is None:
            read = read.withColumn("holder", F.lit(None).cast("int"))
        else:
            read = read.join(_owners(known).select(F.col("control_id").alias("id"), "holder"), "id", "left")
        seen = (
            read.join(F.broadcast(route), "block")
            .where(F.col("holder").isNull() | (F.col("holder") >= F.col("target")))
            .select("id", "ps", "is_treated", "block", "target")
        )
        usual = [number for number in targets if not by_number[number].hot]
        asking = treated.where(F.col("turn").isin(usual)).withColumn("target", F.col("turn"))
        parts = asking.select(*seen.columns).unionByName(seen.where(F.col("target").isin(usual)))
        fresh = parts.groupBy("target").applyInPandas(choose, claim_schema)
        for number in targets:
            if by_number[number].hot:
                offered = seen.where(F.col("target") == number)
                fresh = fresh.unionByName(_choose_hot(by_number[number], treated, offered, caliper, block_rows))

        # Two turns may claim one control in the same round; the later one sees
        # that in the next round and chooses again.
        if claims is not None:
            fresh = claims.where(~F.col("holder").isin(targets)).unionByName(fresh)
        before, claims = claims, materialize(fresh)
        if len(turns) == 1:
            break
        changes = _changes(before, claims)
        active = {
            number
            for number, view in reach.items()
            if any(holder < number and view.first <= where <= view.last for where, holder in changes)
        }
        if active:
            # An active turn concerns only later ones.
            settled = F.col("holder") < min(active)
            final = final.unionByName(claims.where(settled))
            claims = materialize(claims.where(~settled))
    return final if claims is None else final.unionByName(claims)


def caliper_match(
    scored: DataFrame,
    score: str = "propensity_score",
    caliper: float | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Matched pairs with both scores and their difference.

    ``caliper`` defaults to 0.05 sample standard deviations of the score.
    """
    # Stored before use: the deviation, the count and the range cut all read it.
    narrow = materialize(
        scored.where(F.col(score).isNotNull()).select(
            F.col("company_id").alias("id"),
            F.col(score).cast("double").alias("ps"),
            F.col("is_treatment").alias("is_treated"),
        )
    )
    default_caliper, n_units = score_caliper(narrow, "ps")
    caliper = default_caliper if caliper is None else caliper
    units = _cut_blocks(narrow, max(1, -(-n_units // block_rows)))
    blocks = _blocks(units)
    if len(blocks) <= 1:
        claims = _match_runs(units.withColumn("run", F.lit(0)), caliper, max(1, n_units))
    else:
        runs = materialize(independent_runs(units, blocks, caliper))
        # At most one such run for each block.
        long = runs.groupBy("run").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_rows).select("run")
        long = materialize(long)
        short = runs.join(F.broadcast(long), "run", "left_anti")
        claims = _match_runs(short, caliper, block_rows)
        if not long.isEmpty():
            linked = materialize(runs.join(F.broadcast(long), "run", "left_semi").drop("run"))
            claims = claims.unionByName(_match_in_turns(linked, caliper, block_rows))
    return claims.select(
        F.col("treated_id").alias("treatment_company_id"),
        F.col("control_id").alias("control_company_id"),
        F.col("treated_ps").alias("treatment_ps"),
        "control_ps",
        F.abs(F.col("treated_ps") - F.col("control_ps")).alias("ps_diff"),
    )
