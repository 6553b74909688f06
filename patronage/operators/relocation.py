"""Max-k-cut on lattices beyond one task (Manhattan weights): rounds of DataFrame jobs.

Weights separate by variable, so customers per variable, score and cluster describe all clusters: q x bins x k whole numbers for each start,
whatever the data. They give every cell's distance sum into every cluster as literals, and the exact cut after any batch of moves
whose own counts are known.

A round folds all moves that gain, of all starts at once, to batches: by source and target cluster, magnitude of the gain and colour of the cell.
The driver adds batches, best first, as long as the exact cut grows; where no batch as a whole does, the best single move goes. So each
round raises the cut, and the search ends when no cell gains. Then the best exchange of each pair of clusters is looked for, among the
pairs of cells that bounds on counts and scores leave, and relocation goes on after it.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.operators.graph import score_columns, threshold_counts
from patronage.operators.scoring import BINS
from patronage.sources.storage import materialise

STARTS = 4
COLOURS = 4
SEED = 42
IMPROVEMENT = 1e-9


def exact_cut(counts: np.ndarray) -> int:
    """Crossing weight from counts (variable, score, cluster), in whole numbers of any size."""
    def spread(h: np.ndarray) -> int:
        below = h.cumsum(axis=1)
        return int((below * (below[:, -1:] - below)).sum())

    return spread(counts.sum(axis=2, keepdims=True)) - spread(counts)


def _start_counts(state: DataFrame, variables: list[str], bins: int, k: int, starts: int) -> list[np.ndarray]:
    tables = [np.zeros((len(variables), bins, k), dtype=object) for _ in range(starts)]
    for r in threshold_counts(state, ["start"], variables).collect():  # starts x q x bins x k rows
        tables[r.start][variables.index(r.dimension), r.score - 1, r.cluster] += int(r.h)
    return tables


def _literal(values) -> str:
    return "array(" + ", ".join(_literal(v) if isinstance(v, list) else f"{v!r}D" for v in values) + ")"


def _priced(state: DataFrame, variables: list[str], counts: list[np.ndarray]) -> DataFrame:
    """Cells with ``cost``: their distance sum into each cluster."""
    bins, k = counts[0].shape[1:]
    gaps = np.abs(np.arange(bins)[:, None] - np.arange(bins)[None, :])
    terms = []
    for v, column in enumerate(score_columns(variables)):
        table = [(gaps @ own[v].astype(float)).tolist() for own in counts]
        terms.append(f"element_at(element_at({_literal(table)}, start + 1), {column})[l]")
    return state.selectExpr("*", f"transform(sequence(0, {k - 1}), l -> {' + '.join(terms)}) AS cost")


def _moves(priced: DataFrame) -> DataFrame:
    """Cells that would gain, with the cluster they are nearest to and the batch they belong to."""
    wanted = priced.selectExpr("*", "array_min(cost) AS least").filter(f"cost[cluster] - least > {IMPROVEMENT}D * greatest(1D, cost[cluster])")
    return wanted.selectExpr("*", "CAST(array_position(cost, least) - 1 AS INT) AS target", "(cost[cluster] - least) * cnt AS gain").selectExpr(
        "*", "CAST(floor(log2(gain)) AS INT) AS level", f"CAST(pmod(xxhash64(cell_id), {COLOURS}L) AS INT) AS colour")


def _shifted(counts: np.ndarray, steps: list[tuple[int, int, int, int, int]]) -> np.ndarray:
    """Counts after moves of (variable, score, source, target, customers)."""
    after = counts.copy()
    for v, score, source, target, n in steps:
        after[v, score, source] -= n
        after[v, score, target] += n
    return after


def _relocated(state: DataFrame, variables: list[str], counts: list[np.ndarray]) -> DataFrame:
    """The state in which no cell of any start gains by a move; ``counts`` is brought up to date."""
    columns = score_columns(variables)
    base = ["start", "cell_id", "cnt", *columns, "cluster"]
    batch = ["start", "cluster", "target", "level", "colour"]
    while True:
        moves = _moves(_priced(state, variables, counts))
        stacked = ", ".join(f"{v}, {c}" for v, c in enumerate(columns))
        found = moves.selectExpr(*batch, "cnt", f"stack({len(columns)}, {stacked}) AS (axis, score)").groupBy(*batch, "axis", "score").agg(
            F.sum("cnt").alias("n")).collect()  # at most starts x clusters squared x magnitudes x colours x q x bins rows
        if not found:
            return state
        steps = defaultdict(list)
        for r in found:
            steps[r.start, r.cluster, r.target, r.level, r.colour].append((r.axis, r.score - 1, r.cluster, r.target, int(r.n)))
        taken, stuck = [], set()
        for start in sorted({key[0] for key in steps}):
            before = best = exact_cut(counts[start])
            for key in sorted((k for k in steps if k[0] == start), key=lambda k: (-k[3], k)):
                after = _shifted(counts[start], steps[key])
                if exact_cut(after) > best:
                    best, counts[start] = exact_cut(after), after
                    taken.append(key)
            if best == before:
                stuck.add(start)
        chosen = "false"
        if stuck:
            first = moves.filter(F.col("start").isin(sorted(stuck))).groupBy("start").agg(
                F.max_by(F.struct("cell_id", "cnt", "cluster", "target", *columns), F.expr("struct(gain, -cell_id)")).alias("m")).collect()  # a row per start
            singles = []
            for r in first:
                after = _shifted(counts[r.start], [(v, r.m[c] - 1, r.m.cluster, r.m.target, int(r.m.cnt)) for v, c in enumerate(columns)])
                if exact_cut(after) > exact_cut(counts[r.start]):
                    counts[r.start] = after
                    singles.append(f"(start = {r.start} AND cell_id = {r.m.cell_id}L)")
            if not taken and not singles:  # what is left are gains that rounding feigned
                return state
            chosen = " OR ".join(singles) or chosen
        accepted = state.sparkSession.createDataFrame(taken, "start INT, cluster INT, target INT, level INT, colour INT").withColumn("go", F.lit(True))
        marked = moves.join(F.broadcast(accepted), batch, "left").selectExpr("start", "cell_id", "target", f"coalesce(go, false) OR {chosen} AS go").filter("go")
        moved = state.join(marked, ["start", "cell_id"], "left").selectExpr(*base[:-1], "IF(go, target, cluster) AS cluster")
        state = materialise(moved, "relocation")


def _best_exchanges(state: DataFrame, variables: list[str], counts: list[np.ndarray]) -> list:
    """The best exchange of two cells for each start and pair of clusters that has one that gains.

    For cells u and v of clusters a and b it gains what both gain by moving alone (at most 0 here) and twice their own weight. Cells fold to groups of
    similar counts, whose best gain and score ranges bound what any partner in the group can give; only cells that pass
    the bound meet, on (start, clusters, both groups).
    """
    columns = score_columns(variables)
    k = counts[0].shape[2]
    sides = _priced(state, variables, counts).selectExpr(
        "start", "cell_id", "cnt", *columns, "cluster AS own", "CAST(floor(log2(cnt)) AS INT) AS size",
        f"explode(transform(filter(sequence(0, {k - 1}), l -> l <> cluster), l -> struct(l AS other, (cost[cluster] - cost[l]) * cnt AS alone))) AS o").selectExpr(
        "*", "o.other AS other", "o.alone AS alone").drop("o")
    ranges = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("low", F.min), ("high", F.max))]
    groups = sides.groupBy("start", "own", "other", "size").agg(F.max("alone").alias("best"), F.max("cnt").alias("most"), *ranges)
    bounds = ["best", "most", *[f"{name}_{c}" for c in columns for name in ("low", "high")]]
    facing = groups.selectExpr("start", "own AS other", "other AS own", "size AS facing", *bounds)
    reach = " + ".join(f"greatest(abs({c} - low_{c}), abs({c} - high_{c}))" for c in columns)
    passed = materialise(sides.join(facing, ["start", "own", "other"]).filter(f"alone + best + 2D * cnt * most * ({reach}) > 0").select(
        "start", "own", "other", "size", "facing", "cell_id", "cnt", "alone", *columns), "exchange")
    left, right = passed.filter("own < other").alias("u"), passed.filter("own > other").alias("v")
    meet = F.expr("u.start = v.start AND u.own = v.other AND u.other = v.own AND u.size = v.facing AND u.facing = v.size")
    apart = " + ".join(f"abs(u.{c} - v.{c})" for c in columns)
    gain = f"u.alone + v.alone + 2D * u.cnt * v.cnt * ({apart})"
    met = left.join(right, meet & F.expr(f"{gain} > {IMPROVEMENT}D * greatest(1D, abs(u.alone) + abs(v.alone))"))
    pick = ", ".join(f"{side}.{c} AS {side}_{c}" for side in "uv" for c in ("cell_id", "cnt", *columns))
    return met.selectExpr("u.start AS start", "u.own AS a", "u.other AS b", f"{gain} AS gain", f"struct({pick}) AS p").groupBy("start", "a", "b").agg(
        F.max("gain").alias("gain"), F.max_by("p", F.expr("struct(gain, -p.u_cell_id, -p.v_cell_id)")).alias("p")).collect()  # starts x pairs of clusters


def relocate(cells: DataFrame, variables: list[str], k: int, bins: int = BINS, starts: int = STARTS, seed: int = SEED,
             exchanges: bool = True) -> tuple[DataFrame, list[int]]:
    """Partition of the cells of a lattice of any size: the best of ``starts`` seeded starts, the first on ties.

    Returns the cells with ``cluster``, ``objective`` and ``settled``, and the final cut of each start in whole numbers. The search goes on until no move
    (and, with ``exchanges``, no exchange) raises the exact cut of any start, so ``settled`` is true; rounding cannot end it
    early, as a move that only seems to gain is tried on whole numbers. An empty table gives no rows.
    """
    columns = score_columns(variables)
    begun = cells.select("cell_id", "cnt", *columns).withColumn("start", F.explode(F.sequence(F.lit(0), F.lit(starts - 1)))).selectExpr(
        "start", "cell_id", "cnt", *columns, f"CAST(pmod(xxhash64(cell_id, start, {seed}L), {k}L) AS INT) AS cluster")
    state = materialise(begun, "relocation")
    counts = _start_counts(state, variables, bins, k, starts)
    while True:
        state = _relocated(state, variables, counts)
        swaps = sorted(_best_exchanges(state, variables, counts), key=lambda r: (r.start, -r.gain, r.a, r.b)) if exchanges and k > 1 else []
        target = []
        for r in swaps:
            steps = [(v, r.p[f"u_{c}"] - 1, r.a, r.b, int(r.p.u_cnt)) for v, c in enumerate(columns)]
            steps += [(v, r.p[f"v_{c}"] - 1, r.b, r.a, int(r.p.v_cnt)) for v, c in enumerate(columns)]
            met = {(r.start, r.p.u_cell_id), (r.start, r.p.v_cell_id)} & {(s, c) for s, c, _ in target}
            after = _shifted(counts[r.start], steps)
            if not met and exact_cut(after) > exact_cut(counts[r.start]):
                counts[r.start] = after
                target += [(r.start, r.p.u_cell_id, r.b), (r.start, r.p.v_cell_id, r.a)]
        if not target:
            break
        cases = " ".join(f"WHEN start = {s} AND cell_id = {c}L THEN {t}" for s, c, t in target)
        state = materialise(state.selectExpr("start", "cell_id", "cnt", *columns, f"CASE {cases} ELSE cluster END AS cluster"), "relocation")
    cuts = [exact_cut(c) for c in counts]
    best = max(range(starts), key=lambda s: (cuts[s], -s))
    return state.filter(F.col("start") == best).selectExpr(
        "cell_id", "cnt", *columns, "cluster", f"{float(cuts[best])!r}D AS objective", "true AS settled"), cuts
