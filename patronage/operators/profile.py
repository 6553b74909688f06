"""Profile of a raw log and of the customer mart: counts, shapes, concentration."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.functions.expressions import (
    is_cancelled, is_junk_description, is_nonproduct, letter_prefix, month_text, percent,
)
from patronage.functions.skew import lookup
from patronage.operators.ranking import ROWS_PER_BUCKET, cumulative, long_form, quantiles, value_counts
from patronage.operators.scoring import ORDINAL
from patronage.sources.storage import materialise

PARTIAL_KEY = ["Invoice", "StockCode", "Quantity", "Price"]
SCATTER_POINTS = 500
SKETCH_SIZE = 12  # of 2 ** 12 slots: a standard error of about 1.6 %
COUNTED = ["Invoice", "StockCode", "Description", "CustomerID", "Country"]
BROADCAST_VALUES = 100_000


# ---------------------------------------------------------------- missing values, counts

def missing_shares(log: DataFrame) -> DataFrame:
    """Percent of NULLs per column, all columns in one pass."""
    names = log.columns
    shares = log.agg(*[F.avg(F.when(F.col(c).isNull(), 100.0).otherwise(0.0)).alias(c) for c in names])
    pairs = ", ".join(f"'{c}', `{c}`" for c in names)
    return shares.selectExpr(f"stack({len(names)}, {pairs}) AS (column_name, missing_pct)").withColumn(
        "missing_pct", F.round("missing_pct", 2))


def distinct_counts(log: DataFrame, columns: list[str] = COUNTED, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column; sketches instead of exact sets if wanted.

    Exact counts fold each column on its own: a scan of that column, and a shuffle of its distinct values per task.
    """
    if not approximate:
        return reduce(DataFrame.unionByName, [
            log.select(c).distinct().agg(F.count(c).alias("n_distinct")).select(F.lit(c).alias("column_name"), "n_distinct") for c in columns])
    counts = log.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, n_distinct)")


def zero_negative_counts(log: DataFrame) -> DataFrame:
    return log.selectExpr(
        "stack(2, 'Quantity', CAST(Quantity AS DOUBLE), 'Price', CAST(Price AS DOUBLE)) AS (column_name, v)"
    ).groupBy("column_name").agg(
        F.count_if(F.col("v") < 0).alias("n_negative"),
        F.count_if(F.col("v") == 0).alias("n_zero"),
        F.count_if(F.col("v") <= 0).alias("n_not_positive"),
    )


def prefix_counts(log: DataFrame) -> DataFrame:
    """Invoices lines per letter prefix."""
    return log.groupBy(letter_prefix(F.col("Invoice")).alias("prefix")).agg(
        F.count("*").alias("n_rows")).filter("prefix IS NOT NULL")


def country_shares(log: DataFrame, top: int | None = None) -> DataFrame:
    """Share of rows per country, largest first."""
    counts = log.filter("Country IS NOT NULL").groupBy("Country").agg(F.count("*").alias("n_rows"))
    whole = F.sum("n_rows").over(Window.partitionBy())
    shares = counts.withColumn("share", F.col("n_rows").cast("double") / whole)
    shares = shares.orderBy(F.desc("n_rows"), "Country")
    return shares.limit(top) if top else shares


def share_of_countries(log: DataFrame, countries: list[str]) -> DataFrame:
    """Rows and share of each named country among the rows with a country, by plain sums without a group per country.

    A country that the log does not hold has no rows and a NULL share, and so has every country of an empty log.
    """
    rows = log.agg(F.count("Country").alias("n"), *[F.count_if(F.col("Country") == c).alias(f"n{i}") for i, c in enumerate(countries)])
    named = F.explode(F.array(*[F.struct(F.lit(c).alias("Country"), F.col(f"n{i}").alias("n_rows")) for i, c in enumerate(countries)]))
    return rows.select("n", named.alias("c")).selectExpr("c.Country", "c.n_rows", "IF(c.n_rows > 0, CAST(c.n_rows AS DOUBLE) / n, NULL) AS share")


def herfindahl(log: DataFrame) -> DataFrame:
    """Sum of squared country shares, from the counts alone."""
    counts = log.filter("Country IS NOT NULL").groupBy("Country").agg(F.count("*").cast("double").alias("n"))
    return counts.agg(
        F.count("*").alias("n_countries"),
        (F.sum(F.col("n") * F.col("n")) / (F.sum("n") * F.sum("n"))).alias("herfindahl"),
    )


def missing_customer_countries(log: DataFrame, top: int = 3) -> DataFrame:
    return log.filter("CustomerID IS NULL").groupBy("Country").agg(
        F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), "Country").limit(top)


def missing_customer_months(log: DataFrame) -> DataFrame:
    return log.groupBy(month_text(F.col("InvoiceDate")).alias("month")).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("CustomerID").isNull()).alias("n_missing"),
    )


def junk_descriptions(log: DataFrame) -> DataFrame:
    """Rows per description that marks a fault rather than a product."""
    return log.filter(is_junk_description(F.col("Description"))).groupBy("Description").agg(
        F.count("*").alias("n_rows"))


# ---------------------------------------------------------------- copies, cancellations, codes

def exact_duplicates(log: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows."""
    return _beyond_first(log, log.columns)


def partial_duplicates(log: DataFrame, key: list[str] = PARTIAL_KEY) -> DataFrame:
    return _beyond_first(log, key)


def _beyond_first(log: DataFrame, key: list[str]) -> DataFrame:
    return log.groupBy(*key).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


def cancellation_summary(log: DataFrame) -> DataFrame:
    cancelled = is_cancelled(F.col("Invoice"))
    negative = F.col("Quantity") < 0
    return log.agg(
        F.count("*").alias("n_rows"),
        F.count_if(cancelled).alias("n_cancelled"),
        F.count_if(negative).alias("n_negative"),
        F.count_if(cancelled & negative).alias("n_both"),
        F.round(percent(F.count_if(cancelled), F.count("*")), 4).alias("cancelled_pct"),
    )


def nonproduct_summary(log: DataFrame) -> DataFrame:
    codes = log.filter(is_nonproduct(F.col("StockCode"))).groupBy("StockCode").agg(F.count("*").alias("n"))
    return codes.agg(F.count("*").alias("n_codes"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def nonproduct_examples(log: DataFrame, top: int = 15) -> DataFrame:
    """The first codes in order; the limit is the report's own."""
    return log.filter(is_nonproduct(F.col("StockCode"))).select("StockCode").distinct().orderBy("StockCode").limit(top)


def positive_rows(log: DataFrame) -> DataFrame:
    return log.filter("Quantity > 0 AND Price > 0").withColumn("revenue", F.expr("Quantity * Price"))


def nonproduct_revenue(log: DataFrame) -> DataFrame:
    flag = is_nonproduct(F.col("StockCode"))
    return positive_rows(log).agg(
        F.count_if(flag).alias("n_rows"),
        F.round(percent(F.sum(F.when(flag, F.col("revenue")).otherwise(0)), F.sum("revenue")), 6).alias(
            "revenue_pct"),
    )


def revenue_per(positive: DataFrame, key: str) -> DataFrame:
    return positive.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum("revenue").alias("revenue"))


def invoices_per_customer(positive: DataFrame) -> DataFrame:
    """Distinct invoices of each customer: pairs fold first, so a busy customer spreads."""
    pairs = positive.filter("CustomerID IS NOT NULL").select("CustomerID", "Invoice").distinct()
    return pairs.groupBy("CustomerID").agg(F.count("*").alias("n_invoices"))


def invoices_per_customer_summary(positive: DataFrame) -> DataFrame:
    """Mean, median, skew and one-time buyers.

    Customers fold to ``(n_invoices, customers)`` first, a table as long as the number
    of different counts, so the exact median costs nothing.
    """
    counts = invoices_per_customer(positive).groupBy("n_invoices").agg(F.count("*").alias("c"))
    mean = F.sum(F.col("n_invoices") * F.col("c")).over(Window.partitionBy()) / F.sum("c").over(Window.partitionBy())
    centred = counts.withColumn("d", F.col("n_invoices") - mean)
    moment = {p: f"sum(c * power(d, {p})) / sum(c)" for p in (2, 3)}
    return centred.selectExpr(
        "sum(c) AS n_customers",
        "sum(n_invoices * c) / sum(c) AS mean_invoices",
        "percentile(n_invoices, 0.5D, c) AS median_invoices",
        f"({moment[3]}) / nullif(power({moment[2]}, 1.5), 0D) AS skew_invoices",
        "sum(IF(n_invoices = 1, c, 0)) AS n_one_time",
        "100.0D * sum(IF(n_invoices = 1, c, 0)) / sum(c) AS one_time_pct",
    )


def one_time_buyers(mart: DataFrame) -> DataFrame:
    """Customers with one invoice, customers of length zero, and the latter's share."""
    return mart.selectExpr(
        "count_if(frequency = 1) AS n_single_invoice",
        "count_if(length = 0) AS n_zero_length",
        "100.0D * count_if(length = 0) / count(*) AS zero_length_pct",
    )


# ---------------------------------------------------------------- time

def monthly_rows(log: DataFrame) -> DataFrame:
    """Rows per calendar month from first to last, empty months included."""
    counts = log.filter("InvoiceDate IS NOT NULL").groupBy(
        F.trunc(F.to_date("InvoiceDate"), "month").alias("month")).agg(F.count("*").alias("n"))
    months = counts.agg(F.min("month").alias("lo"), F.max("month").alias("hi")).selectExpr(
        "explode(sequence(lo, hi, INTERVAL 1 MONTH)) AS month")
    return months.join(counts, "month", "left").select(
        month_text(F.col("month")).alias("month"), F.coalesce("n", F.lit(0)).alias("n_rows"))


def monthly_balance(log: DataFrame) -> DataFrame:
    peak = F.min(F.struct((-F.col("n_rows")).alias("o"), F.col("month").alias("m"))).getField("m")
    return monthly_rows(log).agg(
        F.min("n_rows").alias("min_rows"), F.max("n_rows").alias("max_rows"),
        peak.alias("peak_month"), F.count("*").alias("n_months"),
    )


def monthly_revenue(positive: DataFrame) -> DataFrame:
    """Revenue and distinct invoices per month, by way of one row per invoice and month."""
    month = month_text(F.col("InvoiceDate"))
    invoices = positive.groupBy(month.alias("month"), "Invoice").agg(F.sum("revenue").alias("revenue"))
    return invoices.groupBy("month").agg(
        F.sum("revenue").cast("double").alias("revenue"), F.count("*").alias("n_invoices"))


# ---------------------------------------------------------------- distribution shape

def shape(df: DataFrame, axes: dict[str, str], scales: dict[str, int] | None = None,
          shares: dict[str, float] | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Min, mean, max, population skew and excess kurtosis per axis, and exact quantiles.

    ``axes`` maps a name to SQL for a whole number, ``scales`` says by how much that
    number exceeds the value (100 for cents), ``shares`` names the quantiles. The data is
    read once, into a stored table of values and their counts.
    """
    scales = scales or {}
    shares = shares or {"median": 0.5}
    counts = materialise(value_counts(df, axes), "value-counts")
    cuts = quantiles(counts, list(shares.values()), rows_per_bucket)

    scale = "CASE " + " ".join(f"WHEN axis = '{a}' THEN {scales.get(a, 1)}D" for a in axes) + " END"
    values = counts.selectExpr("axis", f"CAST(ordinal AS DOUBLE) / ({scale}) AS v", "CAST(weight AS DOUBLE) AS c")
    means = values.groupBy("axis").agg((F.expr("sum(v * c) / sum(c)")).alias("mean"))
    centred = values.join(F.broadcast(means), "axis").selectExpr("*", "v - mean AS d")
    moment = {p: f"sum(c * power(d, {p})) / sum(c)" for p in (2, 3, 4)}
    summary = centred.groupBy("axis").agg(
        F.expr("min(v)").alias("min"), F.expr("max(v)").alias("max"), F.expr("first(mean)").alias("mean"),
        F.expr(f"({moment[3]}) / nullif(power({moment[2]}, 1.5), 0D)").alias("skew"),
        F.expr(f"({moment[4]}) / nullif(power({moment[2]}, 2), 0D) - 3").alias("kurtosis"),
    )
    for position, name in enumerate(shares):
        branches = " ".join(
            f"WHEN axis = '{a}' THEN {cuts[a, ''][position] / scales.get(a, 1)!r}D" for a in axes if (a, "") in cuts)
        summary = summary.withColumn(name, F.expr(f"CASE {branches} END" if branches else "CAST(NULL AS DOUBLE)"))
    return summary.select("axis", "min", *shares, "mean", "max", "skew", "kurtosis")


LINE_AXES = {"Quantity": "Quantity", "Price": "Price * 100"}
LINE_SCALES = {"Price": 100}
RAW_AXES = {"recency": "recency", "frequency": "frequency", "monetary": "monetary * 100", "length": "length"}
RAW_SCALES = {"monetary": 100}


def histogram(mart: DataFrame, column: str, bins: int = 50, log1p: bool = False) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin holds its upper edge."""
    value = f"CAST({column} AS DOUBLE)"
    values = mart.selectExpr(f"{f'ln(1D + {value})' if log1p else value} AS x").filter("x IS NOT NULL")
    low, high = values.agg(F.min("x")).scalar(), values.agg(F.max("x")).scalar()
    placed = values.select(
        F.least(
            F.floor((F.col("x") - low) / F.when(high > low, (high - low) / bins).otherwise(F.lit(1.0))),
            F.lit(bins - 1),
        ).cast("bigint").alias("bin"))
    return placed.groupBy("bin").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- concentration

def concentration(totals: DataFrame, key: str, amount: str = "revenue", tops: dict[str, str] | None = None,
                  rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Gini coefficient of a two-digit amount and the share held by the richest keys.

    ``tops`` maps an output name to SQL over ``n`` for the number of keys. Everything
    follows from the counts of equal amounts, so ties never pile up in one task.
    """
    tops = tops or {}
    cents_sql = f"-CAST({amount} * 100 AS BIGINT)"
    counts = materialise(
        value_counts(totals.filter(f"{amount} >= 0"), {"x": cents_sql}), f"amounts-{key}")
    ranked, weights = cumulative(counts, rows_per_bucket=rows_per_bucket)
    n = weights.get(("x", ""), 0)
    rows = ranked.selectExpr("CAST(-ordinal AS DOUBLE) AS x", "weight AS c", "before", f"{n}L AS n")
    spread = "sum(x * (CAST(c AS DOUBLE) * before + c * (c + 1D) / 2D))"
    shares = [
        f"100.0D * sum(x * least(c, greatest(0L, CAST({count} AS BIGINT) - before))) / nullif(sum(x * c), 0D) AS {name}"
        for name, count in tops.items()
    ]
    return rows.selectExpr(
        f"{n}L AS n_keys",
        f"IF(sum(x * c) = 0, double('NaN'), ({n} + 1D - 2D * {spread} / nullif(sum(x * c), 0D)) / {n}D) AS gini" if n
        else "double('NaN') AS gini",
        *shares,
    )


# SQL over n: how many of the richest keys count
TOP_PERCENT = "greatest(1, n div 100)"
TOP_FIFTH = "floor(0.2D * n) + 1"


def pareto_curve(mart: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Cumulative share of revenue by customer rank, richest first, one row per customer."""
    rows = long_form(mart, {"M": f"-({ORDINAL['M']})"}, "customer_id")
    running, totals = cumulative(rows, "-ordinal", rows_per_bucket)
    n = totals.get(("M", ""), 0)
    whole = mart.selectExpr(f"sum({ORDINAL['M']}) AS s").scalar()
    return running.select(
        F.col("tie").alias("customer_id"),
        (F.col("before") + 1).alias("position"),
        (F.lit(100.0) * (F.col("before") + 1) / F.lit(float(n))).alias("customers_pct"),
        (F.lit(100.0) * F.col("amount_upto").cast("double") / whole.cast("double")).alias("revenue_pct"),
    )


# ---------------------------------------------------------------- rank correlation

PAIRS = [("recency", "frequency"), ("recency", "monetary"), ("recency", "length"),
         ("frequency", "monetary"), ("frequency", "length"), ("monetary", "length")]


def average_ranks(mart: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> tuple[DataFrame, int]:
    """Average rank of every distinct value per axis, and the number of customers."""
    counts = materialise(value_counts(mart, RAW_AXES), "rank-counts")
    ranked, totals = cumulative(counts, rows_per_bucket=rows_per_bucket)
    ranks = ranked.selectExpr("axis", "ordinal", "weight", "before + (weight + 1) / 2.0D AS rank")
    return ranks, max(totals.values(), default=0)


def with_ranks(mart: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET,
               broadcast_values: int = BROADCAST_VALUES) -> DataFrame:
    """Append the average rank of each raw value.

    Axes with few distinct values (checked) are looked up by broadcast, the others by a
    join that serves frequent values apart.
    """
    ranks, n = average_ranks(mart, rows_per_bucket)
    ranks = materialise(ranks, "ranks")
    distinct = {r.axis: r.n for r in ranks.groupBy("axis").agg(F.count("*").alias("n")).collect()}
    out = mart
    for axis, ordinal in RAW_AXES.items():
        key = f"{axis}_key"
        table = ranks.filter(F.col("axis") == axis).selectExpr(f"ordinal AS {key}", "weight", f"rank AS {axis}_rank")
        keyed = out.withColumn(key, F.expr(f"CAST({ordinal} AS BIGINT)"))
        if distinct.get(axis, 0) <= broadcast_values:
            out = keyed.join(F.broadcast(table.drop("weight")), key, "left").drop(key)
        else:
            out = lookup(keyed, table, [key], "weight", "customer_id", n).drop(key)
    return out


def spearman_raw(mart: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET,
                 broadcast_values: int = BROADCAST_VALUES) -> DataFrame:
    """Spearman correlation of each pair of raw values."""
    ranked = with_ranks(mart, rows_per_bucket, broadcast_values)
    values = ranked.selectExpr(*[f"corr({a}_rank, {b}_rank) AS {a}_{b}" for a, b in PAIRS])
    pairs = ", ".join(f"'{a}', '{b}', {a}_{b}" for a, b in PAIRS)
    return values.selectExpr(f"stack({len(PAIRS)}, {pairs}) AS (first, second, rho)")


# ---------------------------------------------------------------- extracts and matching

def scatter(mart: DataFrame, x: str, y: str, keep: list[str] | None = None) -> DataFrame:
    """The points of a scatter plot, every customer one row."""
    return mart.select("customer_id", F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"),
                       *(keep or []))


def match_cancellations(log: DataFrame) -> DataFrame:
    """Each cancelled line beside the latest earlier sale of the same customer and product.

    Sales and cancellations fold to distinct moments per customer, product and day. The
    latest sale before a day comes from the day totals, the latest within a day from a
    window over that day, so no pair of lines is formed and one busy customer-product
    is spread over its days. Only customer-products with a cancellation get that far.
    """
    key = ["CustomerID", "StockCode"]
    known = log.filter("CustomerID IS NOT NULL AND Quantity <> 0").withColumn(
        "is_sale", F.expr("NOT startswith(Invoice, 'C') AND Quantity > 0"))
    moments = (
        known.filter("is_sale OR startswith(Invoice, 'C')")
        .groupBy("CustomerID", "StockCode", "InvoiceDate")
        .agg(F.expr("count_if(is_sale)").alias("n_sales"), F.expr("count_if(NOT is_sale)").alias("n_cancelled"))
        .withColumn("day", F.to_date("InvoiceDate"))
    )
    with_cancellation = known.filter("startswith(Invoice, 'C')").select(*key).distinct()
    moments = materialise(moments.join(with_cancellation, key, "left_semi"), "moments")
    sold_at = F.when(F.col("n_sales") > 0, F.col("InvoiceDate"))
    days = moments.groupBy(*key, "day").agg(F.max(sold_at).alias("last_sale"))
    before_day = days.withColumn("earlier_sale", F.max("last_sale").over(
        Window.partitionBy(*key).orderBy("day").rowsBetween(Window.unboundedPreceding, -1))).drop("last_sale")
    within = Window.partitionBy(*key, "day").orderBy("InvoiceDate").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    cancelled = moments.withColumn("same_day_sale", F.max(sold_at).over(within)).filter("n_cancelled > 0")
    return cancelled.join(before_day, [*key, "day"], "left").select(
        *key, "InvoiceDate", "n_cancelled", F.coalesce("same_day_sale", "earlier_sale").alias("sale_date"))


def match_quantities(log: DataFrame) -> DataFrame:
    """How many pieces each cancelled moment takes back, first in first out: ``CustomerID``, ``StockCode``, ``cancelled_at``, ``sold_at``, ``quantity``.

    Sales and cancellations of a customer's product fold to moments. Pieces are numbered in the order in which they were sold. A cancellation
    takes the next pieces that were sold by its moment and not yet taken back; what goes beyond them stays unmatched, in a row without ``sold_at``.
    So no sale covers more than it sold. How many pieces are taken back by a moment is a running minimum, and the pieces of sales and cancellations are
    intervals of one number line: cut at all their ends, each segment belongs to one sale and one cancellation. No pair
    of moments is formed. Rows without a customer, and lines without pieces, take no part.
    """
    key, moment = ["CustomerID", "StockCode"], log.schema["InvoiceDate"].dataType.simpleString()
    lines = log.filter("CustomerID IS NOT NULL AND (startswith(Invoice, 'C') AND Quantity <> 0 OR Quantity > 0)")
    moments = lines.groupBy(*key, "InvoiceDate").agg(
        F.expr("CAST(sum(IF(startswith(Invoice, 'C'), 0, Quantity)) AS BIGINT)").alias("sold"),
        F.expr("CAST(sum(IF(startswith(Invoice, 'C'), abs(Quantity), 0)) AS BIGINT)").alias("cancelled"))
    taking = moments.groupBy(*key).agg(F.sum("cancelled").alias("c")).filter("c > 0").drop("c")
    moments = moments.join(taking, key, "left_semi")
    upto = Window.partitionBy(*key).orderBy("InvoiceDate").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = moments.withColumns({"s": F.sum("sold").over(upto), "q": F.sum("cancelled").over(upto)})
    taken = summed.withColumn("taken", F.col("q") + F.least(F.lit(0), F.min(F.col("s") - F.col("q")).over(upto)))
    before = F.coalesce(F.lag("taken").over(Window.partitionBy(*key).orderBy("InvoiceDate")), F.lit(0))
    numbered = materialise(taken.withColumn("before", before), "pieces")
    ends = numbered.filter("sold > 0").selectExpr(*key, "s AS piece", "InvoiceDate AS sold_at", f"CAST(NULL AS {moment}) AS cancelled_at").unionByName(
        numbered.filter("taken > before").selectExpr(*key, "taken AS piece", f"CAST(NULL AS {moment}) AS sold_at", "InvoiceDate AS cancelled_at"))
    places = ends.groupBy(*key, "piece").agg(F.max("sold_at").alias("sold_at"), F.max("cancelled_at").alias("cancelled_at"))
    along = Window.partitionBy(*key).orderBy("piece")
    ahead = along.rowsBetween(Window.currentRow, Window.unboundedFollowing)  # a segment belongs to the moments that end at it or after
    segments = places.select(
        *key, F.first("cancelled_at", ignorenulls=True).over(ahead).alias("cancelled_at"), F.first("sold_at", ignorenulls=True).over(ahead).alias("sold_at"),
        (F.col("piece") - F.coalesce(F.lag("piece").over(along), F.lit(0))).alias("quantity"))
    matched = segments.filter("cancelled_at IS NOT NULL")
    rest = numbered.filter("cancelled > taken - before").selectExpr(
        *key, "InvoiceDate AS cancelled_at", f"CAST(NULL AS {moment}) AS sold_at", "cancelled - (taken - before) AS quantity")
    return matched.unionByName(rest)


def bounded_scatter(mart: DataFrame, x: str, y: str, by: str, points: int = SCATTER_POINTS, seed: int = 42) -> DataFrame:
    """At most ``points`` customers of each group: those of least hash of their id, the same for any partitioning.

    The rank limit is one that Spark applies in each task before the shuffle (up to 1,000 points, unless the session's
    ``spark.sql.optimizer.windowGroupLimitThreshold`` allows more), so a group sends ``points`` rows of each task, however large it is.
    """
    order = Window.partitionBy(by).orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col("customer_id").cast("string"))), "customer_id")
    return mart.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= points).select(
        by, "customer_id", F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))


def distinct_sketches(log: DataFrame, keys: list[str], columns: list[str] = COUNTED, log_size: int = SKETCH_SIZE) -> DataFrame:
    """One row per group of ``keys`` with a mergeable sketch of the distinct non-null values of each column, to be stored."""
    return log.groupBy(*keys).agg(*[F.expr(f"hll_sketch_agg(CAST(`{c}` AS STRING), {log_size})").alias(c) for c in columns])


def sketched_counts(sketches: DataFrame, keys: list[str], columns: list[str] = COUNTED) -> DataFrame:
    """Estimated distinct values per column and group of ``keys`` (none: over all), from stored sketches alone."""
    merged = sketches.groupBy(*keys).agg(*[F.expr(f"hll_sketch_estimate(hll_union_agg(`{c}`))").alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return merged.selectExpr(*keys, f"stack({len(columns)}, {pairs}) AS (column_name, n_distinct)")
