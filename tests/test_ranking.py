"""The bucketed global order against plain windows, with heavy ties."""

import pytest
from pyspark.sql import functions as F

from patronage.operators import profile as P
from patronage.operators import ranking
from patronage.operators.evaluate import box_statistics
from patronage.operators.ranking import bucketed, cumulative, long_form, order_statistics, quantiles, value_counts
from patronage.operators.scoring import add_scores, ntile_starts, rank_cut_starts


@pytest.fixture(scope="module")
def customers(spark):
    """A third of all customers share one value on every axis."""
    return spark.range(1, 3001).selectExpr(
        "id * 7919 % 100003 AS customer_id",
        "CAST(IF(id % 3 = 0, 1, id * 31 % 400) AS INT) AS recency",
        "IF(id % 3 = 0, 1L, id * 17 % 40) AS frequency",
        "CAST(IF(id % 3 = 0, 999, id * 101 % 5000) AS DECIMAL(20,2)) / 100 AS monetary0",
        "CAST(IF(id % 3 = 0, 0, id * 13 % 700) AS INT) AS length",
    ).withColumn("monetary", F.col("monetary0").cast("decimal(20,2)")).drop("monetary0").cache()


NTILE = """SELECT customer_id, ntile({t}) OVER (ORDER BY recency DESC, customer_id) AS r_score,
  ntile({t}) OVER (ORDER BY frequency, customer_id) AS f_score, ntile({t}) OVER (ORDER BY monetary, customer_id) AS m_score,
  ntile({t}) OVER (ORDER BY length, customer_id) AS l_score FROM customers_view"""


@pytest.mark.parametrize("rows_per_bucket", [50, 700, 10**6])
@pytest.mark.parametrize("bins", [5, 7])
def test_scores_equal_ntile(spark, customers, rows_per_bucket, bins):
    customers.createOrReplaceTempView("customers_view")
    expected = spark.sql(NTILE.format(t=bins))
    scored = add_scores(customers, bins=bins, rows_per_bucket=rows_per_bucket)
    names = expected.columns
    assert scored.select(names).exceptAll(expected).count() == 0
    assert scored.count() == 3000


def test_a_hot_value_is_spread_over_buckets(customers):
    rows = long_form(customers, {"F": "frequency"}, "customer_id")
    ordered = bucketed(rows, 100)
    assert ordered.buckets == 30
    largest = ordered.rows.groupBy("bucket").count().agg(F.max("count")).first()[0]
    assert largest < 400


def test_rank_cut_against_its_formula():
    for n in (6, 11, 57, 5878):
        scores = [max(1, -(-5 * (rank - 1) // (n - 1))) for rank in range(1, n + 1)]
        starts = rank_cut_starts(n, 5)
        assert scores == [1 + sum(rank >= s for s in starts) for rank in range(1, n + 1)]
    sizes = [b - a for a, b in zip([1, *rank_cut_starts(5878, 5)], [*rank_cut_starts(5878, 5), 5879])]
    assert sizes == [1176, 1175, 1176, 1175, 1176]
    sizes = [b - a for a, b in zip([1, *ntile_starts(5878, 5)], [*ntile_starts(5878, 5), 5879])]
    assert sizes == [1176, 1176, 1176, 1175, 1175]
    assert ntile_starts(3, 5) == [2, 3]


@pytest.mark.parametrize("rows_per_bucket", [60, 10**6])
def test_quantiles_by_rows_and_by_counts(customers, rows_per_bucket):
    shares = [0.0, 0.25, 0.5, 0.99, 1.0]
    expected = customers.select(F.percentile("length", F.lit(shares))).first()[0]
    by_rows = quantiles(long_form(customers, {"x": "length"}, "customer_id"), shares, rows_per_bucket)
    by_counts = quantiles(value_counts(customers, {"x": "length"}), shares, 7 if rows_per_bucket == 60 else 10**6)
    assert by_rows["x", ""] == pytest.approx(expected)
    assert by_counts["x", ""] == pytest.approx(expected)


def test_groups_have_their_own_order(customers):
    grouped = customers.withColumn("g", F.expr("IF(customer_id % 2 = 0, 'it''s', 'odd')"))
    found, totals = order_statistics(
        long_form(grouped, {"x": "length"}, "customer_id", "g"), lambda _a, n: [1, n // 2, n], 100)
    for g in ("it's", "odd"):
        values = sorted(r.length for r in grouped.filter(F.col("g") == g).collect())
        assert totals["x", g] == len(values)
        assert [found["x", g][r][0] for r in (1, len(values) // 2, len(values))] == [
            values[0], values[len(values) // 2 - 1], values[-1]]


def test_wide_buckets_are_cut_again(customers, monkeypatch):
    """Without a margin each rank is missed by its thin bucket; the wide one around it must not be sorted whole."""
    sorted_rows, plain = [], ranking.bucketed

    def counted(rows, *options):
        ordered = plain(rows, *options)
        sorted_rows.append(ordered.rows.groupBy("axis", "grp", "bucket").count().agg(F.max("count")).first()[0])
        return ordered

    monkeypatch.setattr(ranking, "bucketed", counted)
    monkeypatch.setattr(ranking, "ACCURACY", 4)
    monkeypatch.setattr(ranking, "MARGIN", 0.0)
    grouped = customers.withColumn("g", F.expr("IF(customer_id % 2 = 0, 'a/1', 'b')"))
    ranks = [1, 17, 700, 701, 1400]
    found, _ = order_statistics(long_form(grouped, {"L": "length", "R": "-recency"}, "customer_id", "g"), lambda _a, _n: ranks, 20)
    rows = grouped.collect()
    for g in ("a/1", "b"):
        for axis, value in (("L", lambda r: r.length), ("R", lambda r: -r.recency)):
            order = sorted((value(r), r.customer_id) for r in rows if r.g == g)
            assert found[axis, g] == {rank: order[rank - 1] for rank in ranks}
    assert len(sorted_rows) == 2 and sorted_rows[0] > 160 >= sorted_rows[1]


@pytest.mark.parametrize("rows_per_bucket", [80, 10**6])
def test_running_totals(customers, rows_per_bucket):
    rows = long_form(customers, {"M": "-CAST(monetary * 100 AS BIGINT)"}, "customer_id")
    running, totals = cumulative(rows, "-ordinal", rows_per_bucket)
    got = {r.tie: (r.before, r.amount_upto) for r in running.collect()}
    total = 0
    ordered = sorted(customers.collect(), key=lambda r: (-r.monetary, r.customer_id))
    for position, r in enumerate(ordered):
        total += int(r.monetary * 100)
        assert got[r.customer_id] == (position, total)
    assert totals["M", ""] == 3000


def test_concentration_in_buckets(customers):
    plain = P.concentration(customers, "a", "monetary", {"top": P.TOP_FIFTH}).first()
    split = P.concentration(customers, "b", "monetary", {"top": P.TOP_FIFTH}, rows_per_bucket=40).first()
    assert split == pytest.approx(plain)
    values = sorted(float(r.monetary) for r in customers.collect())
    n, whole = len(values), sum(values)
    gini = sum((2 * i - n - 1) * x for i, x in enumerate(values, 1)) / (n * whole)
    assert plain.gini == pytest.approx(gini)
    assert plain.top == pytest.approx(100 * sum(values[::-1][: int(0.2 * n) + 1]) / whole)


def test_small_tables_of_concentration(spark):
    one = spark.sql("SELECT 1L AS k, CAST(5 AS DECIMAL(12,2)) AS revenue")
    row = P.concentration(one, "one", tops={"top1": P.TOP_PERCENT}).first()
    assert (row.n_keys, row.gini, row.top1) == (1, 0.0, 100.0)
    zero = spark.sql("SELECT 1L AS k, CAST(0 AS DECIMAL(12,2)) AS revenue")
    assert P.concentration(zero, "zero").first().gini != P.concentration(zero, "zero").first().gini


@pytest.mark.parametrize("rows_per_bucket,broadcast_values", [(10**6, 10**6), (70, 0)])
def test_average_ranks_with_hot_values(customers, rows_per_bucket, broadcast_values):
    ranked = P.with_ranks(customers, rows_per_bucket, broadcast_values).toPandas()
    assert len(ranked) == 3000
    for axis in ("recency", "frequency", "monetary", "length"):
        assert ranked[f"{axis}_rank"].tolist() == ranked[axis].astype(float).rank().tolist()


def test_boxes_in_buckets(customers):
    labelled = customers.withColumn("cluster", F.expr("customer_id % 3"))
    plain = sorted(map(tuple, box_statistics(labelled).collect()))
    split = sorted(map(tuple, box_statistics(labelled, accuracy=20).collect()))
    assert plain == split and len(plain) == 3
