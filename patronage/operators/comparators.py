"""K-means, Ward and Gaussian-mixture partitions of the weighted cells, K-means and mixtures by the library's distributed fits.

All see each cell once with its customers as weight, which is the same objective as seeing every customer. The fits of
all k and starts are independent jobs and are submitted side by side.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.operators.graph import score_columns
from patronage.operators.scoring import BINS
from patronage.operators.segment import MAX_CELLS, SEED
from patronage.operators.ward import ward
from patronage.sources.storage import materialise

STARTS = 10
AT_ONCE = 8
RETRIES = 8
#: What the library's mixture reports when a component's covariance vanishes.
DEGENERATE = ("NotConvergedException", "no non-zero singular values", "MatrixSingularException")
METHODS = ["K-means", "Ward", "GMM"]


def _estimator(method: str, k: int, seed: int):
    if method == "K-means":
        return KMeans(k=k, initMode="random", weightCol="cnt", seed=seed, featuresCol="features", predictionCol="cluster")
    return GaussianMixture(k=k, weightCol="cnt", seed=seed, featuresCol="features", predictionCol="cluster", probabilityCol="share")


def _fit(method: str, k: int, seed: int, vectors: DataFrame):
    """A fitted model, or None: a mixture whose component shrinks to a point has no covariance and fails; other seeds are tried."""
    for retry in range(1 if method == "K-means" else RETRIES):
        try:
            return _estimator(method, k, seed + 1000 * retry).fit(vectors)
        except Py4JJavaError as error:
            if not any(sign in str(error.java_exception) for sign in DEGENERATE):
                raise
    return None


def _loss(method: str, model) -> float:
    return model.summary.trainingCost if method == "K-means" else -model.summary.logLikelihood


def compare_methods(cells: DataFrame, variables: list[str], k_values: list[int], methods: list[str] | None = None,
                    seed: int = SEED, starts: int = STARTS, bins: int = BINS) -> DataFrame:
    """Cell labels of each comparator and k, in the layout of the max-k-cut labels: K-means by the best of
    ``starts`` fits (the first on ties), Ward by one tree, the mixture by one fit. A k for which every mixture degenerates has its cells with a NULL
    ``cluster``. Only models come to the driver. A lattice of at most ``MAX_CELLS`` is one partition in one order, which makes fits repeatable; a larger
    one is dealt out by cell."""
    columns = score_columns(variables)
    methods = methods or METHODS
    stored = materialise(cells.select("cell_id", "cnt", *columns), "comparator-cells")
    placed = stored.coalesce(1) if bins ** len(variables) <= MAX_CELLS else stored.repartition("cell_id")
    vectors = VectorAssembler(inputCols=columns, outputCol="features").transform(placed.sortWithinPartitions("cell_id"))
    wanted = [(m, k, s) for m in ("GMM", "K-means") if m in methods for k in k_values for s in range(starts if m == "K-means" else 1)]
    kept = vectors.persist()
    try:
        with ThreadPoolExecutor(AT_ONCE + 1) as pool:
            tree = pool.submit(ward, stored, variables, k_values) if "Ward" in methods else None
            models = list(pool.map(lambda w: _fit(w[0], w[1], seed + w[2], kept), wanted)) if not kept.isEmpty() else []
    finally:
        kept.unpersist()
    best: dict[tuple[str, int], tuple[float, int]] = {}
    for place, ((method, k, _), model) in enumerate(zip(wanted, models)):
        if model is not None:
            best[method, k] = min(best.get((method, k), (float("inf"), -1)), (_loss(method, model), place))
    labelled = [tree.result()] if tree else []
    for method, k in dict.fromkeys((m, k) for m, k, _ in wanted):
        named = models[best[method, k][1]].transform(vectors) if (method, k) in best else stored.withColumn("cluster", F.lit(None).cast("int"))
        labelled.append(named.select("cell_id", "cnt", *columns, "cluster").withColumns(
            {"method": F.lit(method), "k": F.lit(k), "variables": F.lit("".join(variables))}))
    return reduce(DataFrame.unionByName, labelled)
