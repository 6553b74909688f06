"""Max-k-cut segmentation: a grid of seeded restarts spread over tasks.

The grid has one row per (variable set, cohort, k, block of restarts). Each row carries
its cells, at most ``bins ** q`` of them, so tasks need nothing from the driver or from
each other, and a lost task is simply run again: a restart's random start depends only
on the seed and its own number.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.operators.graph import lift, reduce_cells, score_columns, silhouette
from patronage.operators.scoring import BINS, LRFM, RFM
from patronage.sources.storage import materialise

RESTARTS = 200
BLOCK = 25
SWEEPS = 2
MAX_ROUNDS = 100
SEED = 42
K_RANGE = list(range(2, 11))
MAX_CELLS = 4096  # largest lattice solved inside one task; beyond it use relocation.relocate
BOUND_STEPS = 30
SMALLEST_GAIN = 1e-13  # of all weight: what rounding can feign


# ---------------------------------------------------------------- inside one task

def edge_weights(points: np.ndarray, counts: np.ndarray, metric: str) -> np.ndarray:
    """Weights of all pairs as shares of their sum, so that no figure of the search depends on the number of customers.

    On each axis a table over pairs of scores is looked up; for the Manhattan metric it counts the steps between them.
    """
    share = counts / counts.sum()
    total = np.zeros((len(share), len(share)))
    for axis in points.T:
        scores, at = np.unique(axis, return_inverse=True)
        steps = np.abs(np.subtract.outer(scores, scores))
        total += (steps if metric == "manhattan" else steps * steps)[np.ix_(at, at)]
    weights = np.outer(share, share) * (total if metric == "manhattan" else np.sqrt(total))
    return weights / max(weights.sum(), np.finfo(float).tiny)


def exact_cut(points: np.ndarray, counts: np.ndarray, labels: np.ndarray, metric: str) -> int | float:
    """The cut of one labelling: a whole number of any size for the Manhattan metric.

    On each axis and at each border between scores, the customers below times those above, less the same inside clusters.
    """
    if metric != "manhattan":
        gaps = np.sqrt(sum(np.subtract.outer(a, a) ** 2 for a in points.T))
        apart = labels[:, None] != labels[None, :]
        return float((np.outer(counts, counts) * gaps)[apart].sum() / 2)
    numbers = [int(c) for c in counts]
    kind = np.int64 if sum(numbers) ** 2 * max(1, int(points.max() - points.min())) * points.shape[1] < 2**62 else object
    cut = 0
    for axis in points.T:
        scores, at = np.unique(axis, return_inverse=True)
        table = np.zeros((len(scores), int(labels.max()) + 1), kind)
        np.add.at(table, (at, labels), np.array(numbers, kind))
        below = table.cumsum(axis=0)
        above = below[-1:] - below
        crossing = below.sum(axis=1) * above.sum(axis=1) - (below * above).sum(axis=1)
        cut += sum(int(x) * int(gap) for x, gap in zip(crossing, np.diff(scores)))
    return cut


def largest_cut_bound(weights: np.ndarray, steps: int = BOUND_STEPS) -> float:
    """``b`` such that no partition into k clusters cuts more than (k - 1) / k * b of the weight of all pairs.

    With the Laplacian L of the weights and any diagonal M for which M - L has no negative eigenvalue, a cut is at most
    (k - 1) / 2k times the trace of M: the cluster indicators less 1 / k are orthogonal to no more than that. M starts as the
    degrees, scaled by the largest eigenvalue; vertices on which its eigenvector rests are raised, and the best trace counts.
    """
    degree = weights.sum(axis=1)
    used = degree > 0
    if not used.any():
        return 0.0
    degree = degree[used]
    laplacian = np.diag(degree) - weights[np.ix_(used, used)]
    diagonal, best = degree.copy(), np.inf
    for step in range(steps):
        root = 1 / np.sqrt(diagonal)
        values, vectors = np.linalg.eigh(laplacian * np.outer(root, root))
        best = min(best, diagonal.sum() * values[-1] * (1 + 1e-9))
        near = values > values[-1] * (1 - 0.3 / (step + 1))
        rest = (vectors[:, near] ** 2).mean(axis=1)
        diagonal = diagonal * (1 + (rest * diagonal.sum() / diagonal - 1) / (step + 10)).clip(0.5, 2)
    return best / weights.sum()


def _relocation_pass(w, pull, labels, order, eps):
    """Move each vertex to the cluster it is pulled to least; all restarts at once."""
    rows = np.arange(len(labels))
    moved = np.zeros(len(labels), bool)
    for v in order:
        here = pull[:, :, v]
        target = here.argmin(axis=1)
        source = labels[:, v]
        go = np.flatnonzero(here[rows, target] < here[rows, source] - eps)
        if go.size:
            pull[go, source[go]] -= w[v]
            pull[go, target[go]] += w[v]
            labels[go, v] = target[go]
            moved[go] = True
    return moved


def _swap_sweep(w, pull, labels, eps):
    """For each vertex make the best improving exchange with a later vertex."""
    rows = np.arange(len(labels))
    swapped = np.zeros(len(labels), bool)
    own = np.take_along_axis(pull, labels[:, None, :], axis=1)[:, 0, :]
    n = w.shape[0]
    for u in range(n - 1):
        later = slice(u + 1, n)
        source = labels[:, u]
        theirs = labels[:, later]
        across = np.take_along_axis(pull[:, :, u], theirs, axis=1)
        gain = own[:, u, None] - across + own[:, later] - pull[rows, source, later] + 2.0 * w[u, later]
        gain[theirs == source[:, None]] = -np.inf
        partner = gain.argmax(axis=1)
        go = np.flatnonzero(gain[rows, partner] > eps)
        if go.size:
            v = partner[go] + u + 1
            a, b = source[go].copy(), labels[go, v]
            shift = w[v] - w[u]
            pull[go, a] += shift
            pull[go, b] -= shift
            labels[go, u], labels[go, v] = b, a
            own[go] = np.take_along_axis(pull[go], labels[go][:, None, :], axis=1)[:, 0, :]
            swapped[go] = True
    return swapped


def local_search(w: np.ndarray, k: int, restarts: np.ndarray, seed: int = SEED,
                 sweeps: int = SWEEPS, max_rounds: int = MAX_ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels and cut of each restart, and whether it settled: relocation and exchange until neither improves.

    A restart that still improves after ``max_rounds`` is returned as it stands, marked as not settled.
    """
    n = w.shape[0]
    eps = SMALLEST_GAIN * w.sum()
    final = np.stack([np.random.default_rng([seed, int(r)]).integers(0, k, n) for r in restarts])
    live = np.arange(len(restarts))
    labels = final.copy()
    pull = np.stack([(labels == c).astype(float) @ w for c in range(k)], axis=1)
    cuts = np.empty(len(restarts))
    settled = np.zeros(len(restarts), bool)
    for number in range(max_rounds + 1):
        if number == max_rounds:
            improved = np.zeros(len(live), bool)
        else:
            order = np.random.default_rng([seed, n, number]).permutation(n)
            improved = _relocation_pass(w, pull, labels, order, eps)
            for _ in range(sweeps):
                swapped = _swap_sweep(w, pull, labels, eps)
                improved |= swapped
                if not swapped.any():
                    break
        done = ~improved
        settled[live[done]] = number < max_rounds
        if done.any():
            final[live[done]] = labels[done]
            own = np.take_along_axis(pull[done], labels[done][:, None, :], axis=1)[:, 0, :]
            cuts[live[done]] = (w.sum() - own.sum(axis=1)) / 2.0
            live, labels, pull = live[improved], labels[improved], pull[improved]
        if not live.size:
            break
    return final, cuts, settled


def _compact(labels: np.ndarray) -> np.ndarray:
    return np.unique(labels, return_inverse=True)[1]


# ---------------------------------------------------------------- the grid

def packed_cells(cells: DataFrame, variables: list[str], cohort: list[str] | None = None, bins: int = BINS) -> DataFrame:
    """One row per cohort with its cells as parallel arrays, ordered by cell id.

    At most ``bins ** q`` cells can meet in a row: a lattice beyond one task is refused, and so is a score outside it.
    """
    check_lattice(variables, bins)
    columns = score_columns(variables)
    outside = " OR ".join(f"{c} NOT BETWEEN 1 AND {bins}" for c in columns)
    cells = cells.withColumn("cnt", F.expr(f"IF({outside}, raise_error('a score is outside 1..{bins}'), cnt)"))
    packed = cells.groupBy(*(cohort or [])).agg(
        F.array_sort(F.collect_list(F.struct("cell_id", "cnt", *columns))).alias("p"))
    points = ", ".join(f"transform(p, x -> x.{c})" for c in columns)
    return packed.selectExpr(
        *(cohort or []), f"'{''.join(variables)}' AS variables", "p.cell_id AS cell_ids", "p.cnt AS counts",
        f"flatten(array({points})) AS points",
    ).filter("size(cell_ids) > 0")


def restart_grid(packed: DataFrame, k_values: list[int], restarts: int, seeds: list[int],
                 block: int = BLOCK) -> DataFrame:
    """One row per (packed cells, seed, k, block of restarts), spread over as many tasks."""
    starts = list(range(0, restarts, block))
    def literal(values):
        return "array(" + ", ".join(f"{v}" for v in values) + ")"

    grid = packed.selectExpr("*", f"explode({literal(seeds)}) AS seed").selectExpr(
        "*", f"explode({literal(k_values)}) AS k").selectExpr(
        "*", f"explode({literal(starts)}) AS first_restart").selectExpr(
        "*", f"least({block}, {restarts} - first_restart) AS n_restarts")
    return grid.repartition(len(seeds) * len(k_values) * len(starts))


def run_restarts(grid: DataFrame, metric: str = "manhattan", sweeps: int = SWEEPS,
                 cohort: list[str] | None = None) -> DataFrame:
    """Every restart's cut and whether it settled; the labels of a block's best restart, NULL for the others."""
    keys = [*(cohort or []), "variables", "seed", "k"]
    types = dict(grid.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keys] + [
        "restart INT", "cut DOUBLE", "settled BOOLEAN", "cell_ids ARRAY<BIGINT>", "clusters ARRAY<INT>"])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                counts = np.asarray(row.counts, float)
                points = np.asarray(row.points, float).reshape(-1, len(counts)).T
                numbers = np.arange(row.first_restart, row.first_restart + row.n_restarts)
                labels, _, settled = local_search(
                    edge_weights(points, counts, metric), int(row.k), numbers, int(row.seed), sweeps)
                exact = [exact_cut(points, row.counts, own, metric) for own in labels]
                best = max(range(len(exact)), key=lambda i: (exact[i], -i))
                out = pd.DataFrame({"restart": numbers, "cut": [float(x) for x in exact], "settled": settled})
                for key in keys:
                    out[key] = getattr(row, key)
                out["cell_ids"] = [row.cell_ids if i == best else None for i in range(len(out))]
                out["clusters"] = [_compact(labels[best]) if i == best else None for i in range(len(out))]
                yield out[[*keys, "restart", "cut", "settled", "cell_ids", "clusters"]]

    return grid.mapInPandas(solve, schema)


def best_restarts(runs: DataFrame, keys: list[str]) -> DataFrame:
    """The restart with the largest cut per key, the lowest number on ties."""
    order = F.struct("cut", (-F.col("restart")).alias("minus_restart"))
    best = F.max_by(F.struct("restart", "cut", "settled", "cell_ids", "clusters"), order).alias("b")
    return runs.filter("clusters IS NOT NULL").groupBy(*keys).agg(best).select(*keys, "b.*")


def cell_labels(best: DataFrame, cells: DataFrame, keys: list[str], cohort: list[str] | None = None) -> DataFrame:
    """Label rows per cell: the arrays of the best restart taken apart again.

    The grid is referenced once only, so it runs once.
    """
    facts = [c for c in ("cut", "settled", "gap") if c in best.columns]
    flat = best.select(*keys, *facts, F.explode(F.arrays_zip("cell_ids", "clusters")).alias("z")).select(
        *keys, *facts, F.col("z.cell_ids").alias("cell_id"), F.col("z.clusters").alias("cluster"))
    return flat.join(cells, [*(cohort or []), "cell_id"])


def check_lattice(variables: list[str], bins: int) -> None:
    if bins ** len(variables) > MAX_CELLS:
        raise ValueError(
            f"{bins} bins on {len(variables)} variables exceed {MAX_CELLS} cells; use relocation.relocate")


def cut_bounds(packed: DataFrame, metric: str = "manhattan", cohort: list[str] | None = None) -> DataFrame:
    """``total`` (weight of all pairs) and ``share`` (no k clusters cut more than (k - 1) / k of it) for each row of packed cells."""
    keys = [*(cohort or []), "variables"]
    types = dict(packed.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keys] + ["total DOUBLE", "share DOUBLE"])

    def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                counts = np.asarray(row.counts, float)
                points = np.asarray(row.points, float).reshape(-1, len(counts)).T
                total = float(exact_cut(points, row.counts, np.arange(len(counts)), metric))
                share = largest_cut_bound(edge_weights(points, counts, metric))
                yield pd.DataFrame([[*[getattr(row, k) for k in keys], total, share]], columns=[*keys, "total", "share"])

    return packed.mapInPandas(bound, schema)


def solve(cells: DataFrame, variables: list[str], k_values: list[int], restarts: int = RESTARTS, seed: int = SEED,
          metric: str = "manhattan", bins: int = BINS, cohort: list[str] | None = None) -> DataFrame:
    """Best partition of the cells per k: one row per (cohort, variables, k, cell).

    Columns: the keys, ``objective`` (the cut), ``gap``, ``settled`` (whether the best restart ended because nothing improved any more),
    ``cell_id``, the scores, ``cnt`` and ``cluster``. The gap is what a proven upper bound of the cut exceeds the objective by, as a share of the objective: 0 proves the
    partition optimal, a larger one tells how much could be missing at most. It is 0 where there is nothing to cut.
    """
    keys = [*(cohort or []), "variables", "k"]
    packed = packed_cells(cells, variables, cohort, bins)
    best = best_restarts(run_restarts(restart_grid(packed, k_values, restarts, [seed]), metric, cohort=cohort), keys)
    known = cut_bounds(packed, metric, cohort)
    matched = [F.col(f"b.{c}").eqNullSafe(F.col(f"c.{c}")) for c in keys[:-1]]
    bound = "least(total, total * share * (k - 1) / k)"
    best = best.alias("b").join(known.alias("c"), matched).select(
        "b.*", F.expr(f"IF(total > 0, greatest(0D, {bound} / cut - 1), 0D)").alias("gap"))
    return cell_labels(best, cells, keys, cohort).withColumnRenamed("cut", "objective")


def segment_customers(mart: DataFrame, variables: list[str] = LRFM, k: int = 4, bins: int = BINS, **options) -> DataFrame:
    """Customers with the cluster of their cell."""
    cells = materialise(reduce_cells(mart, variables, bins), "cells")
    labels = solve(cells, variables, [k], bins=bins, **options)
    return lift(mart, labels, variables, bins)


def sweep(mart: DataFrame, variable_sets: list[list[str]] | None = None, k_values: list[int] | None = None,
          restarts: int = RESTARTS, seed: int = SEED, bins: int = BINS) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Objective, gap, whether the search settled, and silhouette per (variables, k), and the stored cell labels per set.

    The sets are independent jobs and are submitted side by side.
    """
    keys = ["variables", "k"]

    def solved(variables: list[str]) -> DataFrame:
        name = "".join(variables)
        cells = materialise(reduce_cells(mart, variables, bins), f"cells-{name}")
        return materialise(solve(cells, variables, k_values or K_RANGE, restarts, seed, bins=bins), f"labels-{name}")

    def curve(variables: list[str], labels: DataFrame) -> DataFrame:
        facts = labels.groupBy(*keys).agg(
            F.first("objective").alias("objective"), F.first("gap").alias("gap"), F.first("settled").alias("settled"),
            F.count("*").alias("n_cells"), F.countDistinct("cluster").alias("n_clusters"))
        return facts.join(silhouette(labels, keys, variables, bins=bins), keys)

    sets = variable_sets or [RFM, LRFM]
    with ThreadPoolExecutor(len(sets)) as pool:
        labels = list(pool.map(solved, sets))
    curves = reduce(DataFrame.unionByName, map(curve, sets, labels))
    return curves, {"".join(v): found for v, found in zip(sets, labels)}


def robustness(cells: DataFrame, variables: list[str], k: int = 4, budgets: tuple[int, ...] = (1, 10, 50, 200),
               seeds: int = 10, reference_restarts: int = 500, reference_seed: int = 999, bins: int = BINS) -> DataFrame:
    """Best and worst cut over seeds per restart budget, the share that hits the reference, and whether every restart settled.

    A run with fewer restarts is a prefix of a longer one, so each seed runs once.
    """
    packed = packed_cells(cells, variables, bins=bins)
    runs = run_restarts(restart_grid(packed, [k], max(budgets), list(range(seeds))))
    heavy = run_restarts(restart_grid(packed, [k], reference_restarts, [reference_seed]))
    reference = heavy.agg(F.max("cut")).scalar()
    by_seed = runs.groupBy("seed").agg(F.count_if(~F.col("settled")).alias("unsettled"), *[
        F.max(F.expr(f"IF(restart < {b}, cut, NULL)")).alias(f"b{b}") for b in budgets])
    pairs = ", ".join(f"{b}, b{b}" for b in budgets)
    return by_seed.selectExpr("unsettled", f"stack({len(budgets)}, {pairs}) AS (budget, cut)").withColumn(
        "reference", reference).groupBy("budget").agg(
        F.max("cut").alias("best_cut"), F.min("cut").alias("worst_cut"),
        F.expr("100D * avg(IF(cut = reference, 1D, 0D))").alias("hit_pct"), (F.sum("unsettled") == 0).alias("settled"))
