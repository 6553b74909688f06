"""The dirty transaction view of FIXTURES.md and the figures recorded for it."""

import re
from pathlib import Path

import pytest

from patronage.operators.clean import clean
from patronage.operators.graph import reduce_cells
from patronage.operators.scoring import LRFM, RFM, add_scores, customers_of, raw_values
from patronage.operators.warehouse import renamed
from patronage.plans.reports import segment_values, with_segment
from patronage.sources.storage import materialise

TABLES = ["lineitem", "orders", "customer", "nation", "part"]


def view(spark, sf):
    text = (Path(__file__).resolve().parents[1] / "FIXTURES.md").read_text()
    sql = re.search(r"```sql\n(.*?)```", text, re.S).group(1)
    for table in TABLES:
        spark.read.parquet(f"/root/testdata/{sf}/{table}.parquet").createOrReplaceTempView(table)
    return materialise(spark.sql(sql), "fixture")


@pytest.fixture(scope="module")
def log(spark):
    return view(spark, "sf0.01")


@pytest.fixture(scope="module")
def small_log(spark):
    return view(spark, "sf0.001")


def test_raw_counts(log):
    row = log.selectExpr(
        "count(*) AS n", "count_if(CustomerID IS NULL) AS c", "count_if(Quantity <= 0) AS q", "count_if(Price <= 0) AS p",
        "count_if(Description IS NULL) AS d", "count(DISTINCT CustomerID) AS k").first()
    assert tuple(row) == (18_408, 3_177, 1_561, 196, 503, 1_093)


def test_clean_rows_depend_on_the_part_tag(log, small_log):
    assert clean(log).count() == 12_637
    assert clean(log, keep_part=False).count() == 11_741
    assert clean(small_log).count() == 1_239
    assert clean(small_log, keep_part=False).count() == 1_167


def test_customers_and_flavours(log):
    customers = customers_of(renamed(clean(log, keep_part=False)))
    calendar = raw_values(customers)
    elapsed = raw_values(customers, "elapsed")
    assert calendar.count() == 1_082
    assert calendar.filter("length = 0").count() == 408
    assert calendar.filter("frequency = 1").count() == 407
    joined = calendar.join(elapsed.selectExpr("customer_id", "recency AS other"), "customer_id")
    assert joined.filter("recency <> other").count() == 686
    mart = materialise(add_scores(calendar), "mart")
    halves = with_segment(mart).join(
        with_segment(mart, half_even=True).selectExpr("customer_id", "fm AS even"), "customer_id")
    assert halves.filter("fm <> even").count() == 188
    assert reduce_cells(mart, RFM).count() == 95
    assert reduce_cells(mart, LRFM).count() == 192


EXPECTED = {
    "sf0.001": {"Champions": 32, "Loyal Customers": 19, "At Risk": 15, "Hibernating / Lost": 26,
                "Cannot Lose Them": 5, "New / Promising": 7, "Potential Loyalist": 9},
    "sf0.01": {"Champions": 284, "Loyal Customers": 217, "At Risk": 160, "Hibernating / Lost": 250,
               "Cannot Lose Them": 24, "New / Promising": 78, "Potential Loyalist": 69},
}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_segment_sizes(sf, log, small_log):
    source = log if sf == "sf0.01" else small_log
    mart = add_scores(raw_values(customers_of(renamed(clean(source)))))
    rows = segment_values(mart).collect()
    assert {r.segment: r.customers for r in rows} == EXPECTED[sf]
    if sf == "sf0.01":
        shares = {r.segment: (r.pct_customers, r.pct_revenue) for r in rows}
        assert shares["Champions"] == (26.2, 52.3)
        assert shares["Potential Loyalist"] == (6.4, 1.7)
