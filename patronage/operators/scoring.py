"""Recency, frequency, monetary value and length per customer, and their scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions.expressions import calendar_days, elapsed_days
from patronage.operators.ranking import ROWS_PER_BUCKET, long_form, order_statistics, quantiles
from patronage.sources.storage import materialise

BINS = 5
RFM = ["R", "F", "M"]
LRFM = ["L", "R", "F", "M"]
RAW_COLUMN = {"R": "recency", "F": "frequency", "M": "monetary", "L": "length"}
SCORE_COLUMN = {"R": "r_score", "F": "f_score", "M": "m_score", "L": "l_score"}


def per_invoice(lines: DataFrame) -> DataFrame:
    """Customer, date and amount of each invoice.

    Lines fold to (invoice, customer) by hash aggregation first; choosing the customer of
    the earliest line needs a sorted aggregate, which then sees invoices, not lines.
    """
    pairs = lines.groupBy("invoice_id", "customer_id").agg(
        F.min("invoice_date").alias("invoice_date"), F.sum(F.expr("quantity * price")).alias("amount"))
    return pairs.groupBy("invoice_id").agg(
        F.min(F.struct("invoice_date", "customer_id")).alias("first"), F.sum("amount").alias("amount")
    ).selectExpr(
        "invoice_id", "first.customer_id AS customer_id", "first.invoice_date AS invoice_date", "amount")


def per_customer(invoices: DataFrame) -> DataFrame:
    """First and last purchase, number of invoices, rounded amount.

    ``invoices`` has one row per invoice, so counting rows counts distinct invoices.
    """
    return invoices.groupBy("customer_id").agg(
        F.min("invoice_date").alias("first_date"),
        F.max("invoice_date").alias("last_date"),
        F.count("*").alias("frequency"),
        F.round(F.sum("amount"), 2).cast("decimal(20,2)").alias("monetary"),
    )


def raw_values(customers: DataFrame, flavour: str = "calendar", since_first: bool = False) -> DataFrame:
    """Recency and length against the latest purchase of the whole table.

    ``flavour`` is ``calendar`` (dates) or ``elapsed`` (whole 24-hour periods).
    ``since_first`` measures length up to the snapshot instead of the last purchase.
    """
    days = {"calendar": calendar_days, "elapsed": elapsed_days}[flavour]
    snapshot = customers.agg(F.max("last_date")).scalar()
    end = snapshot if since_first else F.col("last_date")
    return customers.select(
        "customer_id",
        days(snapshot, F.col("last_date")).cast("int").alias("recency"),
        "frequency",
        "monetary",
        days(end, F.col("first_date")).cast("int").alias("length"),
    )


# whole numbers that grow from the worst customer to the best, as SQL over the raw values
ORDINAL = {
    "R": "-CAST(recency AS BIGINT)",
    "F": "CAST(frequency AS BIGINT)",
    "M": "CAST(monetary * 100 AS BIGINT)",
    "L": "CAST(length AS BIGINT)",
}


def ordinals(variables: list[str]) -> dict[str, str]:
    return {v: ORDINAL[v] for v in variables}


def ntile_starts(total: int, bins: int) -> list[int]:
    """First rank of bins 2..bins when the remainder goes to the first bins."""
    size, rest = divmod(total, bins)
    starts = [(b * size) + min(b, rest) + 1 for b in range(1, bins)]
    return [s for s in starts if s <= total]


def rank_cut_starts(total: int, bins: int) -> list[int]:
    """First rank of scores 2..bins when ranks 1..total are cut at their own quantiles."""
    return [s for s in ((b * (total - 1)) // bins + 2 for b in range(1, bins)) if s <= total]


STARTS = {"ntile": ntile_starts, "rank_cut": rank_cut_starts}


def bin_of(ordinal: str, tie: str, borders: list[tuple[int, int]]) -> Column:
    """1 plus the number of borders the row has reached."""
    reached = [
        f"IF({ordinal} > {value}L OR ({ordinal} = {value}L AND {tie} >= {tie_value}L), 1, 0)"
        for value, tie_value in borders
    ]
    return F.expr(" + ".join(["1", *reached]))


def add_scores(
    customers: DataFrame,
    variables: list[str] = LRFM,
    bins: int = BINS,
    method: str = "ntile",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Append a 1..bins score per variable; ties go by customer id.

    A score only depends on which of the bins-1 border rows a customer has passed, so
    the job finds those border rows exactly and scoring itself is a projection: no
    customer row is shuffled or sorted globally. ``method`` is ``ntile`` or ``rank_cut``.
    """
    axes = ordinals(variables)
    starts = STARTS[method]
    found, _ = order_statistics(
        long_form(customers, axes, "customer_id"),
        lambda _axis, total: starts(total, bins),
        rows_per_bucket,
    )
    scored = {
        SCORE_COLUMN[v]: bin_of(axes[v], "customer_id", [
            border for _, border in sorted(found.get((v, ""), {}).items())])
        for v in variables
    }
    return customers.withColumns(scored)


def add_lowest_bin_scores(customers: DataFrame, variables: list[str] = LRFM, bins: int = BINS,
                          rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Quantile scores in which equal values always share the lowest fitting bin.

    Borders are the values at the interpolated quantiles; a value equal to a border
    belongs to the bin below it.
    """
    axes = ordinals(variables)
    shares = [b / bins for b in range(1, bins)]
    cuts = quantiles(long_form(customers, axes, "customer_id"), shares, rows_per_bucket)
    scored = {}
    for v in variables:
        above = [f"IF({axes[v]} > {float(cut)!r}D, 1, 0)" for cut in cuts.get((v, ""), [])]
        scored[SCORE_COLUMN[v]] = F.expr(" + ".join(["1", *above]))
    return customers.withColumns(scored)


def customers_of(lines: DataFrame) -> DataFrame:
    """The stored per-customer table that every later step reads."""
    return materialise(per_customer(per_invoice(lines)), "customers")


def customer_rfml(lines: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The customer mart: calendar-day values and bin scores."""
    return add_scores(raw_values(customers_of(lines)), rows_per_bucket=rows_per_bucket)


def score_matrix(mart: DataFrame, variables: list[str] = LRFM) -> DataFrame:
    """Scores named by variable, in the order of the list."""
    return mart.select("customer_id", *[F.col(SCORE_COLUMN[v]).alias(v) for v in variables])
