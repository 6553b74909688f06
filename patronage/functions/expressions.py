"""Scalar column expressions: days, rounding, codes, segments, churn bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The format of a regular product code, and the markers of junk descriptions.
PRODUCT_CODE = r"^\d{5}[A-Za-z]?$"
JUNK_DESCRIPTION = r"(?i)^(\?+|damaged|lost|check)$"

# The segment of each recency score (row) and combined spend score (column, 1 to 5).
SEGMENT_GRID = {
    5: ["New / Promising", "New / Promising", "Loyal Customers", "Champions", "Champions"],
    4: ["New / Promising", "New / Promising", "Loyal Customers", "Champions", "Champions"],
    3: ["Potential Loyalist", "Potential Loyalist", "Loyal Customers", "Loyal Customers", "Loyal Customers"],
    2: ["Hibernating / Lost", "Hibernating / Lost", "At Risk", "At Risk", "At Risk"],
    1: ["Hibernating / Lost", "Hibernating / Lost", "At Risk", "Cannot Lose Them", "Cannot Lose Them"],
}
OTHER_SEGMENT = "Others"

# Names of the churn bands.
CHURN_BANDS = [
    (90, "1 Active (<=90d)"),
    (180, "2 Cooling (91-180d)"),
    (365, "3 At Risk (181-365d)"),
    (None, "4 Churned (>365d)"),
]


def calendar_days(later: Column, earlier: Column) -> Column:
    """Difference of the two calendar dates; the hour of day plays no part."""
    return F.datediff(F.to_date(later), F.to_date(earlier))


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Completed periods of 24 hours between two moments."""
    return F.extract(F.lit("DAY"), later - earlier).cast("int")


def iso_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def month_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM")


def is_cancelled(invoice: Column) -> Column:
    return F.startswith(invoice, F.lit("C"))


def letter_prefix(invoice: Column) -> Column:
    """First character if it is a letter, else NULL."""
    first = F.substring(invoice, 1, 1)
    return F.when(first.rlike("^[A-Za-z]$"), first)


def is_nonproduct(stock_code: Column) -> Column:
    return ~stock_code.rlike(PRODUCT_CODE)


def is_junk_description(description: Column) -> Column:
    return F.coalesce(F.trim(description).rlike(JUNK_DESCRIPTION), F.lit(False))


def line_amount(quantity: Column, price: Column) -> Column:
    return quantity * price


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    value = F.when(whole != 0, F.lit(100.0) * part.cast("double") / whole.cast("double"))
    return value if digits is None else F.round(value, digits)


def combined_fm(f_score: Column, m_score: Column, half_even: bool = False) -> Column:
    """Rounded mean of two scores: halves go away from zero, or to the even neighbour."""
    mean = (f_score + m_score) / F.lit(2.0)
    rounded = F.bround(mean) if half_even else F.round(mean)
    return rounded.cast("int")


def named_segment(r: Column, fm: Column) -> Column:
    """Segment of a customer: the grid's entry for recency score and combined spend score, or the name for all else."""
    rows = F.array(*[F.array(*map(F.lit, SEGMENT_GRID[score])) for score in sorted(SEGMENT_GRID)])
    return F.coalesce(F.get(F.get(rows, r - 1), fm - 1), F.lit(OTHER_SEGMENT))


def churn_band(recency: Column) -> Column:
    band = F.lit(CHURN_BANDS[-1][1])
    for limit, name in reversed(CHURN_BANDS[:-1]):
        band = F.when(recency <= limit, name).otherwise(band)
    return band


def share_where(condition: Column) -> Column:
    """Aggregate: share of rows that meet a condition."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))
