"""Exact global order without a one-partition window.

An ordered window without a partition key pulls every row into one task. Here the
rows are cut into buckets at split points that the driver reads once as literals,
so every branch of a plan sees the same buckets. Inside a bucket a plain window
does the ordering; what lies between buckets is a handful of totals.

A value shared by a third of all rows would make one fat bucket. Rows are therefore
bucketed on ``value + position of the tie-break in its range``, which spreads equal
values over several buckets; where the tie-break does not matter the rows are first
grouped to ``(value, count)``.

Values must be whole numbers (days, counts, cents).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.sources.storage import materialise

ROWS_PER_BUCKET = 250_000
MAX_BUCKETS = 4096
ACCURACY = 10_000  # of approximate percentiles; their error is below 1 / ACCURACY
MARGIN = 3 / ACCURACY
WIDE = 8  # a bucket to be sorted with more than so many times the rows of a bucket is cut again


@dataclass(frozen=True)
class Ordered:
    """Rows ``(axis, grp, ordinal, tie, weight)`` plus their bucket."""

    rows: DataFrame
    totals: dict[tuple[str, str], int]
    buckets: int


def _stacked(axes: dict[str, str]) -> str:
    """SQL for one (axis, ordinal) row per axis; axes map a name to an SQL expression."""
    pairs = ", ".join(f"'{name}', CAST({ordinal} AS BIGINT)" for name, ordinal in axes.items())
    return f"stack({len(axes)}, {pairs}) AS (axis, ordinal)"


def _group_text(group: str | None) -> str:
    return f"CAST({group} AS STRING) AS grp" if group else "'' AS grp"


def long_form(df: DataFrame, axes: dict[str, str], tie: str, group: str | None = None) -> DataFrame:
    """One narrow row per input row and axis; a projection, no shuffle."""
    return (
        df.selectExpr(f"CAST({tie} AS BIGINT) AS tie", _group_text(group), _stacked(axes))
        .filter("ordinal IS NOT NULL")
        .selectExpr("axis", "grp", "ordinal", "tie", "1L AS weight")
    )


def value_counts(df: DataFrame, axes: dict[str, str], group: str | None = None) -> DataFrame:
    """Rows grouped to ``(axis, grp, value)`` with their number, in long form."""
    return (
        df.selectExpr(_group_text(group), _stacked(axes))
        .filter("ordinal IS NOT NULL")
        .groupBy("axis", "grp", "ordinal")
        .agg(F.count("*").alias("weight"))
        .selectExpr("axis", "grp", "ordinal", "0L AS tie", "weight")
    )


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _of_group(axis: str, grp: str) -> str:
    return f"axis = {_quoted(axis)} AND grp = {_quoted(grp)}"


def _evenly(keyed: DataFrame, buckets: int) -> tuple[DataFrame, str]:
    """Buckets of about equal size over each axis: a search among its split points."""
    shares = [i / buckets for i in range(1, buckets)]
    splits = keyed.groupBy("axis").agg(
        F.percentile_approx("key", shares, max(10_000, 20 * buckets)).alias("points")
    ).collect()
    choices = []
    for number, row in enumerate(splits):
        points = [-float("inf"), *sorted(set(row.points)), float("inf")]
        keyed = Bucketizer(splits=points, inputCol="key", outputCol=f"_bucket_{number}").transform(keyed)
        choices.append(f"WHEN axis = {_quoted(row.axis)} THEN CAST(_bucket_{number} AS INT)")
    return keyed, f"CASE {' '.join(choices)} END"


def _around(keyed: DataFrame, ranks: dict[tuple[str, str], list[int]],
            totals: dict[tuple[str, str], int]) -> tuple[DataFrame, str]:
    """A thin bucket around each wanted rank and wide ones between, which are only counted.

    Should a rank fall outside its thin bucket, the wide one that holds it is cut again evenly.
    """
    own = {
        key: sorted({min(1.0, max(0.0, rank / totals[key] + side)) for rank in wanted for side in (-MARGIN, MARGIN)})
        for key, wanted in ranks.items()
    }
    shares = sorted({share for values in own.values() for share in values})
    rows = keyed.groupBy("axis", "grp").agg(F.percentile_approx("key", shares, ACCURACY).alias("points")).collect()
    choices = []
    for row in rows:
        points = sorted({row.points[shares.index(share)] for share in own[row.axis, row.grp]})
        steps = " + ".join(["0", *[f"IF(key >= {point!r}D, 1, 0)" for point in points]])
        choices.append(f"WHEN {_of_group(row.axis, row.grp)} THEN {steps}")
    return keyed, f"CASE {' '.join(choices)} END"


def bucketed(rows: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET,
             wanted: Callable[[str, str, int], Iterable[int]] | None = None) -> Ordered:
    """Assign each long row a bucket such that buckets are ordered by (ordinal, tie).

    ``wanted`` gives the ranks for an axis, a group and its total weight. If ranks are wanted and every row weighs one, the buckets lie around those ranks,
    otherwise they are of about equal size.
    """
    stats = rows.groupBy("axis", "grp").agg(
        F.sum("weight").alias("total"), F.count("*").alias("n"),
        F.min("tie").alias("low"), F.max("tie").alias("high"),
    ).collect()
    totals = {(r.axis, r.grp): r.total for r in stats}
    per_axis: dict[str, int] = {}
    for r in stats:
        per_axis[r.axis] = per_axis.get(r.axis, 0) + r.n
    buckets = min(MAX_BUCKETS, max(1, max(per_axis.values(), default=0) // rows_per_bucket))
    if buckets == 1:
        return Ordered(rows.withColumn("bucket", F.lit(0)), totals, 1)

    low, high = min(r.low for r in stats), max(r.high for r in stats)
    span = float(high - low + 1)
    # exploding a one-element array computes a column once; a plain projection would be
    # copied into every comparison below and outgrow the compiled code
    key = f"CAST(ordinal AS DOUBLE) + CAST(tie - {low}L AS DOUBLE) / {span!r}D"
    keyed = rows.selectExpr("*", f"explode(array({key})) AS key")
    if wanted is not None and all(r.total == r.n for r in stats):
        ranks = {key: sorted(set(wanted(*key, total))) for key, total in totals.items()}
        keyed, bucket = _around(keyed, ranks, totals)
    else:
        keyed, bucket = _evenly(keyed, buckets)
    return Ordered(keyed.selectExpr(*rows.columns, f"explode(array({bucket})) AS bucket"), totals, buckets)


def _by_order(columns: list[str]) -> Window:
    return Window.partitionBy(*columns).orderBy("ordinal", "tie")


def _in_bucket(axis: str, grp: str, bucket: int) -> str:
    return f"({_of_group(axis, grp)} AND bucket = {bucket})"


def order_statistics(
    rows: DataFrame,
    wanted: Callable[[str, int], Iterable[int]],
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> tuple[dict[tuple[str, str], dict[int, tuple[int, int]]], dict[tuple[str, str], int]]:
    """The ``(ordinal, tie)`` found at the wanted ranks (1-based) of each axis and group.

    Only the buckets that hold a wanted rank are sorted, and those of too many rows are cut
    into buckets again first, so no task sorts a share of a large table. The answer is as
    large as the list of ranks; the total weight of each axis and group comes with it.
    """
    return _at_ranks(rows, lambda axis, _grp, total: wanted(axis, total), rows_per_bucket)


def _at_ranks(
    rows: DataFrame, wanted: Callable[[str, str, int], Iterable[int]], rows_per_bucket: int, evenly: bool = False,
) -> tuple[dict[tuple[str, str], dict[int, tuple[int, int]]], dict[tuple[str, str], int]]:
    ordered = bucketed(rows, rows_per_bucket, None if evenly else wanted)
    targets: list[tuple[str, str, int, int, int]] = []
    if ordered.buckets == 1:
        sizes = {(axis, grp): [(0, total)] for (axis, grp), total in ordered.totals.items()}
    else:
        sizes = {}
        counted = ordered.rows.groupBy("axis", "grp", "bucket").agg(F.sum("weight").alias("n"), F.count("*").alias("n_rows"))
        lengths = {}
        for r in counted.collect():
            sizes.setdefault((r.axis, r.grp), []).append((r.bucket, r.n))
            lengths[r.axis, r.grp, r.bucket] = r.n_rows
    for (axis, grp), parts in sizes.items():
        ranks = sorted(set(wanted(axis, grp, ordered.totals[axis, grp])))
        before = 0
        for bucket, n in sorted(parts):
            targets += [(axis, grp, bucket, rank, rank - before) for rank in ranks if before < rank <= before + n]
            before += n
    found: dict[tuple[str, str], dict[int, tuple[int, int]]] = {key: {} for key in sizes}
    if not targets:
        return found, ordered.totals

    # the buckets and ranks are few enough to be literals: no join, no second table
    local_ranks: dict[tuple[str, str, int], list[tuple[int, int]]] = {}
    for axis, grp, bucket, rank, local in targets:
        local_ranks.setdefault((axis, grp, bucket), []).append((rank, local))
    if ordered.buckets > 1:
        # after even cuts, a bucket that is all of its axis and group holds one key only: nothing is left to cut
        wide = [key for key in local_ranks if lengths[key] > WIDE * rows_per_bucket and not (evenly and len(sizes[key[:2]]) == 1)]
        if wide:
            again = {(axis, f"{grp}/{bucket}"): (axis, grp, bucket) for axis, grp, bucket in wide}
            inside = ordered.rows.filter(" OR ".join(_in_bucket(*key) for key in wide))
            inside = materialise(inside.withColumn("grp", F.concat_ws("/", "grp", "bucket")).drop("bucket"), "wide")
            narrower, _ = _at_ranks(inside, lambda axis, grp, _total: [local for _, local in local_ranks[again[axis, grp]]], rows_per_bucket, True)
            for key, places in narrower.items():
                for rank, local in local_ranks.pop(again[key]):
                    found[again[key][:2]][rank] = places[local]
            if not local_ranks:
                return found, ordered.totals
    # one membership test: the bucket's own expression is then evaluated once per row
    chosen: dict[tuple[str, str], list[str]] = {}
    for axis, grp, bucket in local_ranks:
        chosen.setdefault((axis, grp), []).append(str(bucket))
    lists = " ".join(f"WHEN {_of_group(*key)} THEN array({', '.join(buckets)})" for key, buckets in chosen.items())
    candidates = ordered.rows.filter(f"array_contains(CASE {lists} END, bucket)")
    upto = F.sum("weight").over(
        _by_order(["axis", "grp", "bucket"]).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hits = candidates.withColumn("upto", upto).filter(" OR ".join(
        f"({_in_bucket(*key)} AND {local} <= upto AND {local} > upto - weight)"
        for key, ranks in local_ranks.items() for _, local in ranks))
    for r in hits.collect():
        for rank, local in local_ranks[r.axis, r.grp, r.bucket]:
            if r.upto - r.weight < local <= r.upto:
                found[r.axis, r.grp][rank] = (r.ordinal, r.tie)
    return found, ordered.totals


def cumulative(
    rows: DataFrame, amount: str | None = None, rows_per_bucket: int = ROWS_PER_BUCKET
) -> tuple[DataFrame, dict[tuple[str, str], int]]:
    """Add ``before`` (weight in front of the row within its axis and group) and, if an
    SQL amount is given, ``amount_upto`` (its running sum including the row).

    Also returns the total weight of each axis and group.
    """
    ordered = bucketed(rows, rows_per_bucket)
    df = ordered.rows
    if amount is not None:
        df = df.withColumn("amount", F.expr(amount))
    running = _by_order(["axis", "grp", "bucket"]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {"before": F.sum("weight").over(running) - F.col("weight")}
    totals = [F.sum("weight").alias("earlier_before")]
    if amount is not None:
        sums["amount_upto"] = F.sum("amount").over(running)
        totals.append(F.sum("amount").alias("earlier_amount_upto"))
    local = df.withColumns(sums)
    if ordered.buckets == 1:
        return local.drop("bucket"), ordered.totals

    # at most MAX_BUCKETS rows per axis and group
    earlier = Window.partitionBy("axis", "grp").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = df.groupBy("axis", "grp", "bucket").agg(*totals)
    offsets = offsets.withColumns({
        f"earlier_{name}": F.coalesce(F.sum(f"earlier_{name}").over(earlier), F.lit(0)) for name in sums
    })
    shifted = local.join(F.broadcast(offsets), ["axis", "grp", "bucket"])
    shifted = shifted.withColumns({name: F.col(name) + F.col(f"earlier_{name}") for name in sums})
    return shifted.drop("bucket", *[f"earlier_{name}" for name in sums]), ordered.totals


def quantile_ranks(total: int, share: float) -> tuple[int, int, float]:
    """Lower rank, upper rank (1-based) and weight of the upper one, linear interpolation."""
    position = share * (total - 1)
    lower = int(position)
    fraction = position - lower
    return lower + 1, min(lower + 2, total), fraction


def quantiles(
    rows: DataFrame, shares: list[float], rows_per_bucket: int = ROWS_PER_BUCKET
) -> dict[tuple[str, str], list[float]]:
    """Exact linearly interpolated quantiles of each axis and group, in the order of ``shares``."""
    def wanted(_axis: str, total: int) -> list[int]:
        return [rank for share in shares for rank in quantile_ranks(total, share)[:2]]

    found, totals = order_statistics(rows, wanted, rows_per_bucket)
    result = {}
    for key, by_rank in found.items():
        result[key] = []
        for share in shares:
            lower, upper, fraction = quantile_ranks(totals[key], share)
            low, high = by_rank[lower][0], by_rank[upper][0]
            result[key].append(low + (high - low) * fraction)
    return result
