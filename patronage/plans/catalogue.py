"""Every operator as a named query over the base tables in a folder.

Queries read the whole tables. Outputs use whole numbers, doubles and text only, so
they compare cleanly with other engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.functions import expressions as X
from patronage.operators import clean as C
from patronage.operators import comparators as M
from patronage.operators import evaluate as E
from patronage.operators import graph as G
from patronage.operators import profile as P
from patronage.operators import relocation as L
from patronage.operators import scoring as S
from patronage.operators import segment as K
from patronage.operators import tenure as N
from patronage.operators import warehouse as W
from patronage.plans import reports as R
from patronage.plans import views as V
from patronage.sources import ingest as I
from patronage.sources.retail_log import transaction_log
from patronage.sources.storage import cached_table, materialise, save_table, shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SHEETS = ["sheet1", "sheet2"]
MESSY_HEADERS = {"InvoiceDate": " Invoice Date", "StockCode": "Stock Code ", "CustomerID": "Customer ID"}


def query(function: Query) -> Query:
    """Register a query under its function name, with its output tidied."""
    QUERIES[function.__name__] = lambda spark, sf_dir: tidy(function(spark, sf_dir))
    return function


def tidy(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT, fractions as DOUBLE of six digits, moments as text."""
    columns = []
    for field in df.schema.fields:
        name = f"`{field.name}`"
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            columns.append(f"CAST({name} AS BIGINT) AS {name}")
        elif isinstance(field.dataType, T.DecimalType) and field.dataType.scale == 0:
            columns.append(f"CAST({name} AS BIGINT) AS {name}")
        elif isinstance(field.dataType, (T.DecimalType, T.DoubleType)):
            columns.append(f"round(CAST({name} AS DOUBLE), 6) AS {name}")
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            columns.append(f"date_format({name}, 'yyyy-MM-dd HH:mm:ss') AS {name}")
        else:
            columns.append(name)
    return df.selectExpr(*columns)


# ---------------------------------------------------------------- shared stages

def cleaned(spark: SparkSession, d: str, keep_part: bool = True) -> DataFrame:
    return C.clean(transaction_log(spark, d), keep_part)


def lines(spark: SparkSession, d: str) -> DataFrame:
    return W.renamed(cleaned(spark, d))


def mart(spark: SparkSession, d: str) -> DataFrame:
    return S.customer_rfml(lines(spark, d))


def positive(spark: SparkSession, d: str) -> DataFrame:
    return P.positive_rows(transaction_log(spark, d))


def levels(spark: SparkSession, d: str) -> DataFrame:
    """Customers with a label that follows from the scores: the floor of their mean."""
    return mart(spark, d).withColumn(
        "cluster", F.expr("CAST(floor((r_score + f_score + m_score + l_score) / 4) - 1 AS BIGINT)"))


def stripes(spark: SparkSession, d: str) -> DataFrame:
    """RFM cells labelled for each k = 2..10 by the remainder of their score sum."""
    cells = G.reduce_cells(mart(spark, d), S.RFM)
    return materialise(cells.withColumn("k", F.explode(F.sequence(F.lit(2), F.lit(10)))).withColumn(
        "cluster", F.expr("(r_score + f_score + m_score) % k")), "cell-stripes")


def _slug(spark: SparkSession, d: str) -> str:
    """A folder name for tables of this application and this data folder."""
    return f"{spark.sparkContext.applicationId}-{d.strip('/').replace('/', '-')}"


def per_country(df: DataFrame) -> DataFrame:
    return df.groupBy("Country").agg(
        F.count("*").alias("n_rows"), F.sum("Quantity").alias("quantity"),
        F.sum(F.expr("Quantity * Price")).alias("amount"))


# ---------------------------------------------------------------- scans, sources, sinks

def part_folders(spark: SparkSession, d: str) -> dict[str, str]:
    """The log written once, one folder for each part."""
    path = f"{shared_folder(spark)}/parts-{uuid.uuid4().hex}"
    save_table(transaction_log(spark, d), path, ["SourceSheet"])
    return {name: f"{path}/SourceSheet={name}" for name in SHEETS}


@query
def a1_multi_part_load(spark, d):
    return per_country(I.read_parts(spark, part_folders(spark, d), tag=False))


@query
def a2_part_tag(spark, d):
    return I.rows_per_part(I.read_parts(spark, part_folders(spark, d)))


@query
def a2_part_tag_in_one_scan(spark, d):
    return I.rows_per_part(I.read_parts_at_once(spark, part_folders(spark, d)))


@query
def a3_shared_invoices(spark, d):
    return I.shared_invoices(transaction_log(spark, d), *SHEETS)


@query
def a4_header_normalisation(spark, d):
    messy = transaction_log(spark, d).withColumnsRenamed(MESSY_HEADERS)
    return I.normalise_headers(messy).groupBy("StockCode").agg(
        F.count("CustomerID").alias("n_customers"), F.max("InvoiceDate").alias("last_date"))


@query
def a5_type_normalisation(spark, d):
    text = transaction_log(spark, d).selectExpr(
        "Invoice", "StockCode", "Description", "CAST(Quantity AS STRING) AS Quantity",
        "date_format(InvoiceDate, 'yyyy-MM-dd HH:mm:ss') AS InvoiceDate", "CAST(Price AS STRING) AS Price",
        "concat(CAST(CustomerID AS STRING), '.0') AS CustomerID", "Country")
    return I.normalise_types(text).groupBy("Country").agg(
        F.count("CustomerID").alias("n_known"), F.max("CustomerID").alias("max_customer"),
        F.sum("Quantity").alias("quantity"), F.sum("Price").alias("price"), F.min("InvoiceDate").alias("first_date"))


@query
def a6_cached_raw(spark, d):
    path = f"{shared_folder(spark)}/raw-{_slug(spark, d)}"
    return I.rows_per_part(cached_table(spark, path, lambda: transaction_log(spark, d)))


@query
def a6_cache_after_a_change(spark, d):
    """The cached log after one part's rows arrived a second time: rows and whether the part was built again, per part."""
    folders, cache = part_folders(spark, d), f"{shared_folder(spark)}/fresh-{uuid.uuid4().hex}"
    I.fresh_log(spark, cache, folders)
    materialise(spark.read.parquet(folders[SHEETS[1]]), "again").write.mode("append").parquet(folders[SHEETS[1]])
    log, built = I.fresh_log(spark, cache, folders)
    return I.rows_per_part(log).withColumn("rebuilt", F.col("SourceSheet").isin(built))


@query
def a7_clean_sink_scan(spark, d):
    scan = W.renamed(materialise(cleaned(spark, d), "clean"))
    return scan.groupBy("country").agg(
        F.count("*").alias("n_rows"), F.max("invoice_date").alias("last_date"), F.sum("Total").alias("total"))


@query
def a8_table_sink(spark, d):
    stored = materialise(cleaned(spark, d), "clean")
    folder = f"{shared_folder(spark)}/warehouse-{_slug(spark, d)}"
    return W.table_sizes(W.write_tables(W.build_tables(stored), folder))


def bucketed(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The four tables stored under a name of this call, lines and invoices in buckets."""
    name = f"t{uuid.uuid4().hex}"
    return W.write_bucketed(W.build_tables(materialise(cleaned(spark, d), "clean")), f"{shared_folder(spark)}/{name}", name)


@query
def a8_bucketed_sink(spark, d):
    return W.table_sizes(bucketed(spark, d))


@query
def j1_lines_with_invoice_bucketed(spark, d):
    t = bucketed(spark, d)
    return W.bucketed_lines_with_invoice(t["fact_line"], t["dim_invoice"]).groupBy("customer_id", "stock_code").agg(
        F.count("*").alias("n_lines"), F.sum("amount").alias("amount"), F.max("invoice_date").alias("last_date"))


@query
def j2_invoice_totals_bucketed(spark, d):
    t = bucketed(spark, d)
    return W.invoice_totals(t["fact_line"], t["dim_invoice"].hint("merge"))


@query
def a9_mart_scan(spark, d):
    return materialise(mart(spark, d), "mart")


def _entries(reports: dict[str, DataFrame]) -> DataFrame:
    """The customers of each entry of the five reports."""
    keys = {
        "score_balance": "concat(axis, ' ', score)", "segment_values": "segment", "churn_by_recency": "churn_band",
        "response_proxy": "segment", "revenue_concentration": "CAST(m_quintile AS STRING)",
    }
    frames = [
        frame.selectExpr(f"'{name}' AS report", f"{keys[name]} AS entry", "customers")
        for name, frame in reports.items()
    ]
    return reduce(DataFrame.unionByName, frames)


@query
def a10_named_reports(spark, d):
    return _entries(R.run_reports(mart(spark, d)))


def _sql_reports(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    log = materialise(cleaned(spark, d), "clean")
    V.register(W.build_tables(log), materialise(S.customer_rfml(W.renamed(log)), "mart"))
    return V.run_sql(spark, V.REPORT_TEXTS, V.PARAMETERS)


@query
def a10_sql_reports(spark, d):
    """The reports as SQL text over the views."""
    return _entries(_sql_reports(spark, d))


@query
def g10_response_proxy_sql(spark, d):
    return _sql_reports(spark, d)["response_proxy"]


@query
def a11_structure(spark, d):
    return I.structure(transaction_log(spark, d))


@query
def a11_column_types(spark, d):
    return I.column_types(transaction_log(spark, d))


# ---------------------------------------------------------------- projections and predicates

@query
def p1_with_customer(spark, d):
    return per_country(C.with_customer(transaction_log(spark, d)))


@query
def p2_positive_quantity(spark, d):
    return per_country(C.positive_quantity(transaction_log(spark, d)))


@query
def p3_positive_price(spark, d):
    return per_country(C.positive_price(transaction_log(spark, d)))


@query
def p4_line_amount(spark, d):
    return C.with_total(transaction_log(spark, d)).select("Invoice", "StockCode", "Quantity", "Price", "Total")


@query
def p5_score_matrix(spark, d):
    return S.score_matrix(mart(spark, d), S.LRFM)


@query
def p6_cancellation_flag(spark, d):
    return transaction_log(spark, d).select("Invoice").distinct().withColumn(
        "cancelled", X.is_cancelled(F.col("Invoice")))


@query
def p7_letter_prefix(spark, d):
    return P.prefix_counts(transaction_log(spark, d))


@query
def p8_nonproduct_code(spark, d):
    return transaction_log(spark, d).select("StockCode").distinct().withColumn(
        "nonproduct", X.is_nonproduct(F.col("StockCode")))


@query
def p9_named_segment(spark, d):
    return R.with_segment(mart(spark, d)).select("customer_id", "fm", "segment")


@query
def p10_named_segment_half_even(spark, d):
    return R.with_segment(mart(spark, d), half_even=True).select("customer_id", "fm", "segment")


@query
def p11_churn_band(spark, d):
    return mart(spark, d).select("customer_id", X.churn_band(F.col("recency")).alias("churn_band"))


@query
def p12_indicators(spark, d):
    return R.with_segment(mart(spark, d)).groupBy("segment").agg(
        X.share_where(F.col("frequency") > 1).alias("repeat_share"),
        X.share_where(F.col("recency") <= 90).alias("active_share"))


@query
def p13_one_time_buyers(spark, d):
    return P.one_time_buyers(mart(spark, d))


@query
def p14_zero_negative(spark, d):
    return P.zero_negative_counts(transaction_log(spark, d))


@query
def p15_cancelled_and_negative(spark, d):
    return P.cancellation_summary(transaction_log(spark, d)).select("n_cancelled", "n_negative", "n_both")


# ---------------------------------------------------------------- joins

@query
def j1_lines_with_invoice(spark, d):
    t = W.build_tables(materialise(cleaned(spark, d), "clean"))
    return W.lines_with_invoice(t["fact_line"], t["dim_invoice"]).groupBy("customer_id", "stock_code").agg(
        F.count("*").alias("n_lines"), F.sum("amount").alias("amount"), F.max("invoice_date").alias("last_date"))


@query
def j2_invoice_totals(spark, d):
    t = W.build_tables(cleaned(spark, d))
    return W.invoice_totals(t["fact_line"], t["dim_invoice"])


@query
def j3_snapshot(spark, d):
    customers = S.customers_of(lines(spark, d))
    snapshot = customers.agg(F.max("last_date")).scalar()
    return customers.select("customer_id", "last_date", snapshot.alias("snapshot"))


@query
def j4_foreign_keys(spark, d):
    return W.foreign_key_violations(W.build_tables(materialise(cleaned(spark, d), "clean")))


@query
def j4_foreign_keys_of_raw_lines(spark, d):
    """Lines as they arrived against the tables of the cleaned lines: orphans exist."""
    raw = materialise(transaction_log(spark, d), "raw")
    tables = W.build_tables(C.clean(raw))
    arrived = W.build_tables(raw)
    return W.foreign_key_violations({**tables, "fact_line": arrived["fact_line"], "dim_invoice": tables["dim_invoice"]})


@query
def j5_key_checks(spark, d):
    return W.key_violations(W.build_tables(materialise(transaction_log(spark, d), "raw")))


@query
def j5_key_checks_unfolded(spark, d):
    """The same checks on tables that were not folded by key, so keys repeat wherever a customer has two countries, and so on."""
    log = transaction_log(spark, d)
    return W.key_violations({
        "dim_customer": log.selectExpr("CustomerID AS customer_id", "Country AS country").distinct(),
        "dim_product": log.selectExpr("StockCode AS stock_code", "Description AS description").distinct(),
        "dim_invoice": log.selectExpr("Invoice AS invoice_id", "CustomerID AS customer_id", "InvoiceDate AS invoice_date").distinct(),
        "fact_line": log.selectExpr("concat(Invoice, ' ', StockCode) AS line_id", "Invoice AS invoice_id", "StockCode AS stock_code", "Quantity AS quantity", "Price AS price"),
    })


@query
def j6_lift_labels(spark, d):
    m = mart(spark, d)
    cells = G.reduce_cells(m, S.LRFM).withColumn(
        "cluster", F.expr("CAST(floor((r_score + f_score + m_score + l_score) / 4) - 1 AS BIGINT)"))
    return G.lift(m, cells, S.LRFM).select("customer_id", "cluster")


@query
def j6_lift_labels_shuffled(spark, d):
    m = mart(spark, d)
    cells = G.reduce_cells(m, S.LRFM).withColumn(
        "cluster", F.expr("CAST(floor((r_score + f_score + m_score + l_score) / 4) - 1 AS BIGINT)"))
    return G.lift(m, cells, S.LRFM, broadcast_cells=0).select("customer_id", "cluster")


@query
def j7_cell_pairs(spark, d):
    return G.edges(G.reduce_cells(mart(spark, d), S.RFM), S.RFM, "euclidean")


@query
def j8_tuple_lookup(spark, d):
    """Customers with the number of L scores found in their RFM cell."""
    m = mart(spark, d)
    cells = N.tenure_cells(m).groupBy(*N.RFM_AXES).agg(F.count("*").alias("n_l"))
    return m.join(cells, N.RFM_AXES).select("customer_id", "n_l")


@query
def j9_align_labels(spark, d):
    labelled = levels(spark, d)
    return E.align_labels(labelled.drop("cluster"), labelled.filter("r_score > 1")).select(
        "customer_id", "cluster", "recency", "monetary")


@query
def j10_published_join(spark, d):
    return E.beside_published(G.silhouette(stripes(spark, d), ["k"], S.RFM))


# ---------------------------------------------------------------- copies and distinct

@query
def d1_deduplicate_with_part(spark, d):
    return cleaned(spark, d).groupBy("Country").agg(F.count("*").alias("n_rows"), F.sum("Total").alias("total"))


@query
def d1_deduplicate_without_part(spark, d):
    return cleaned(spark, d, keep_part=False).groupBy("Country").agg(
        F.count("*").alias("n_rows"), F.sum("Total").alias("total"))


@query
def d2_exact_duplicates(spark, d):
    return P.exact_duplicates(transaction_log(spark, d))


@query
def d3_partial_duplicates(spark, d):
    return P.partial_duplicates(transaction_log(spark, d))


@query
def d4_distinct_cells(spark, d):
    return N.cell_counts(N.tenure_cells(mart(spark, d))).select("rfm_cells", "lrfm_cells")


# ---------------------------------------------------------------- aggregations

@query
def g1_dim_customer(spark, d):
    return W.dim_customer(lines(spark, d))


@query
def g2_dim_product(spark, d):
    return W.dim_product(lines(spark, d))


@query
def g3_dim_invoice(spark, d):
    return W.dim_invoice(lines(spark, d))


@query
def g4_fact_line(spark, d):
    return W.fact_line(lines(spark, d)).drop("line_id")


@query
def g5_rfml_calendar(spark, d):
    return S.raw_values(S.customers_of(lines(spark, d)))


@query
def g6_rfml_elapsed(spark, d):
    return S.raw_values(S.customers_of(lines(spark, d)), "elapsed")


@query
def g7_score_balance(spark, d):
    return R.score_balance(mart(spark, d))


@query
def g8_segment_values(spark, d):
    return R.segment_values(mart(spark, d))


@query
def g9_churn_by_recency(spark, d):
    return R.churn_by_recency(mart(spark, d))


@query
def g10_response_proxy(spark, d):
    return R.response_proxy(mart(spark, d))


@query
def g11_revenue_concentration(spark, d):
    return R.revenue_concentration(mart(spark, d))


@query
def g12_missing_shares(spark, d):
    return P.missing_shares(transaction_log(spark, d))


@query
def g13_distinct_counts(spark, d):
    return P.distinct_counts(transaction_log(spark, d))


def _stored_sketches(spark, d):
    log = transaction_log(spark, d).withColumn("month", F.date_format("InvoiceDate", "yyyy-MM"))
    return materialise(P.distinct_sketches(log, ["SourceSheet", "month"]), "sketches")


@query
def g13_distinct_sketches(spark, d):
    """Whether distinct counts from stored sketches of parts and months lie within three standard errors of the exact ones."""
    estimated = P.sketched_counts(_stored_sketches(spark, d), []).withColumnRenamed("n_distinct", "estimate")
    error = 3 * 1.04 / 2 ** (P.SKETCH_SIZE / 2)
    return P.distinct_counts(transaction_log(spark, d)).join(estimated, "column_name").selectExpr(
        "column_name", "n_distinct", f"abs(estimate - n_distinct) <= {error}D * n_distinct + 1 AS within")


@query
def g13_distinct_sketches_by_part(spark, d):
    """The same per part, from the same stored sketches."""
    estimated = P.sketched_counts(_stored_sketches(spark, d), ["SourceSheet"]).withColumnRenamed("n_distinct", "estimate")
    log = transaction_log(spark, d)
    exact = reduce(DataFrame.unionByName, [P.distinct_counts(log.filter(F.col("SourceSheet") == s)).withColumn("SourceSheet", F.lit(s)) for s in SHEETS])
    error = 3 * 1.04 / 2 ** (P.SKETCH_SIZE / 2)
    return exact.join(estimated, ["SourceSheet", "column_name"]).selectExpr(
        "SourceSheet", "column_name", "n_distinct", f"abs(estimate - n_distinct) <= {error}D * n_distinct + 1 AS within")


@query
def g14_country_shares(spark, d):
    return P.country_shares(transaction_log(spark, d))


@query
def g14_top_countries(spark, d):
    return P.country_shares(transaction_log(spark, d), top=3)


@query
def g14_named_countries(spark, d):
    """One country that trades and one that no row names."""
    return P.share_of_countries(transaction_log(spark, d), ["UNITED KINGDOM", "ATLANTIS"])


@query
def g15_missing_customer_countries(spark, d):
    return P.missing_customer_countries(transaction_log(spark, d))


@query
def g16_cancellation_summary(spark, d):
    return P.cancellation_summary(transaction_log(spark, d))


@query
def g17_nonproduct_summary(spark, d):
    return P.nonproduct_summary(transaction_log(spark, d))


@query
def g17_nonproduct_examples(spark, d):
    return P.nonproduct_examples(transaction_log(spark, d))


@query
def g18_nonproduct_revenue(spark, d):
    return P.nonproduct_revenue(transaction_log(spark, d))


@query
def g19_revenue_per_customer(spark, d):
    return P.revenue_per(positive(spark, d), "CustomerID")


@query
def g19_revenue_per_product(spark, d):
    return P.revenue_per(positive(spark, d), "StockCode")


@query
def g19_invoices_per_customer(spark, d):
    return P.invoices_per_customer(positive(spark, d))


@query
def g20_herfindahl(spark, d):
    return P.herfindahl(transaction_log(spark, d))


@query
def g21_invoices_summary(spark, d):
    return P.invoices_per_customer_summary(positive(spark, d))


@query
def g22_monthly_rows(spark, d):
    return P.monthly_rows(transaction_log(spark, d))


@query
def g22_monthly_balance(spark, d):
    return P.monthly_balance(transaction_log(spark, d))


@query
def g23_cleaning_log(spark, d):
    return C.cleaning_log(transaction_log(spark, d))


@query
def g24_reconciliation(spark, d):
    return C.reconciliation(cleaned(spark, d))


@query
def g24_mart_means(spark, d):
    return mart(spark, d).selectExpr(
        "count(*) AS customers", "round(avg(recency), 2) AS r_mean", "round(avg(frequency), 2) AS f_mean",
        "round(CAST(sum(monetary) AS DOUBLE) / count(*), 2) AS m_mean", "round(avg(length), 2) AS l_mean")


@query
def g25_cluster_profile(spark, d):
    return E.profile_clusters(levels(spark, d))


@query
def g26_mean_scores(spark, d):
    return E.mean_scores(levels(spark, d))


@query
def g26_mean_scores_long(spark, d):
    return E.mean_scores_long(levels(spark, d))


@query
def g27_volume_value(spark, d):
    return E.volume_value(levels(spark, d))


# ---------------------------------------------------------------- windows

@query
def w1_ntile_scores(spark, d):
    return mart(spark, d)


#: Bucket size of the queries that make small inputs take the way of large ones.
SMALL_BUCKET = 100


@query
def w1_ntile_scores_buckets(spark, d):
    return S.customer_rfml(lines(spark, d), SMALL_BUCKET)


@query
def w2_rank_cut_scores_buckets(spark, d):
    raw = S.raw_values(S.customers_of(lines(spark, d)), "elapsed")
    return S.add_scores(raw, method="rank_cut", rows_per_bucket=SMALL_BUCKET)


@query
def w2_rank_cut_scores(spark, d):
    raw = S.raw_values(S.customers_of(lines(spark, d)), "elapsed")
    return S.add_scores(raw, method="rank_cut")


@query
def w3_monetary_quintile(spark, d):
    return R.monetary_quintiles(mart(spark, d)).groupBy("m_quintile").agg(
        F.count("*").alias("customers"), F.min("monetary").alias("least"), F.max("monetary").alias("most"))


@query
def w3_monetary_quintile_buckets(spark, d):
    return R.monetary_quintiles(mart(spark, d), rows_per_bucket=SMALL_BUCKET).groupBy("m_quintile").agg(
        F.count("*").alias("customers"), F.min("monetary").alias("least"), F.max("monetary").alias("most"))


@query
def w4_share_of_total(spark, d):
    return R.segment_values(mart(spark, d)).select("segment", "pct_customers", "pct_revenue")


@query
def w5_truncated_rank(spark, d):
    shown = R.churn_by_recency(mart(spark, d)).selectExpr("churn_band", "round(avg_frequency / 5) AS pace")
    return E.truncated_rank(shown, "pace")


@query
def w6_pareto_curve(spark, d):
    return P.pareto_curve(mart(spark, d)).select("position", "customers_pct", "revenue_pct")


@query
def w6_pareto_curve_buckets(spark, d):
    return P.pareto_curve(mart(spark, d), SMALL_BUCKET).select("position", "customers_pct", "revenue_pct")


@query
def w7_gini_customers_buckets(spark, d):
    return P.concentration(P.revenue_per(positive(spark, d), "CustomerID"), "customer", rows_per_bucket=SMALL_BUCKET)


@query
def w8_average_ranks_shuffled(spark, d):
    return P.with_ranks(mart(spark, d), SMALL_BUCKET, 0).select(
        "customer_id", "recency_rank", "frequency_rank", "monetary_rank", "length_rank")


@query
def w7_gini_customers(spark, d):
    return P.concentration(P.revenue_per(positive(spark, d), "CustomerID"), "customer")


@query
def w7_gini_products(spark, d):
    return P.concentration(P.revenue_per(positive(spark, d), "StockCode"), "product")


@query
def w8_average_ranks(spark, d):
    return P.with_ranks(mart(spark, d)).select(
        "customer_id", "recency_rank", "frequency_rank", "monetary_rank", "length_rank")


# ---------------------------------------------------------------- order and top-k

@query
def t1_report_order(spark, d):
    return R.segment_values(mart(spark, d)).select("segment", "total_revenue")


@query
def t2_top_products(spark, d):
    return P.concentration(P.revenue_per(positive(spark, d), "StockCode"), "product", tops={"top10_pct": "10"}).select(
        "n_keys", "top10_pct")


@query
def t3_top_percent_customers(spark, d):
    return P.concentration(
        P.revenue_per(positive(spark, d), "CustomerID"), "customer", tops={"top1_pct": P.TOP_PERCENT}
    ).select("n_keys", "top1_pct")


@query
def t4_top_fifth_customers(spark, d):
    return P.concentration(mart(spark, d), "mart", "monetary", {"top20_pct": P.TOP_FIFTH}).select("n_keys", "top20_pct")


@query
def t5_best_k(spark, d):
    curve = G.silhouette(stripes(spark, d), ["k"], S.RFM).withColumn("variables", F.lit("RFM"))
    return E.best_k(curve, ["variables"])


@query
def t6_largest_split_cell(spark, d):
    return N.largest_split_cell(N.tenure_cells(mart(spark, d)))


# ---------------------------------------------------------------- set operations

@query
def u1_union_of_histograms(spark, d):
    m = mart(spark, d)
    return reduce(DataFrame.unionAll, [
        m.groupBy(F.col(c).alias("score")).agg(F.count("*").alias("customers")).select(
            F.lit(v).alias("axis"), "score", "customers")
        for v, c in S.SCORE_COLUMN.items()
    ])


@query
def u2_row_stacking(spark, d):
    return I.read_parts(spark, part_folders(spark, d)).groupBy("SourceSheet", "Country").agg(F.count("*").alias("n_rows"))


@query
def u3_key_intersection(spark, d):
    return I.shared_invoices(transaction_log(spark, d), *SHEETS).agg(F.count("*").alias("n_shared"))


# ---------------------------------------------------------------- scalar functions

@query
def f1_calendar_days(spark, d):
    c = S.customers_of(lines(spark, d))
    return c.select("customer_id", X.calendar_days(F.col("last_date"), F.col("first_date")).alias("days"))


@query
def f2_elapsed_days(spark, d):
    c = S.customers_of(lines(spark, d))
    return c.select("customer_id", X.elapsed_days(F.col("last_date"), F.col("first_date")).alias("days"))


@query
def f3_date_text(spark, d):
    invoices = W.dim_invoice(lines(spark, d))
    return invoices.select(
        "invoice_id", X.iso_text(F.col("invoice_date")).alias("moment"), X.month_text(F.col("invoice_date")).alias("month"))


@query
def f4_rounding(spark, d):
    cells = G.reduce_cells(mart(spark, d), S.RFM)
    return cells.select(
        "cell_id", X.combined_fm(F.col("f_score"), F.col("m_score")).alias("half_away"),
        X.combined_fm(F.col("f_score"), F.col("m_score"), half_even=True).alias("half_even"))


@query
def f5_casts(spark, d):
    return mart(spark, d).selectExpr("customer_id", "CAST(monetary AS BIGINT) AS whole", "CAST(recency / 7 AS INT) AS weeks")


@query
def f6_strings(spark, d):
    return transaction_log(spark, d).select("StockCode", "Description").distinct().select(
        "StockCode", "Description",
        F.substring("StockCode", 1, 1).alias("first_char"),
        F.startswith("StockCode", F.lit("P")).alias("starts_p"),
        F.col("StockCode").rlike("^[A-Za-z]").alias("is_alpha"),
        X.is_nonproduct(F.col("StockCode")).alias("nonproduct"),
        F.replace(F.trim("Description"), F.lit(" "), F.lit("")).alias("squeezed"))


@query
def f7_math(spark, d):
    return mart(spark, d).selectExpr(
        "customer_id", "abs(recency - length) AS gap", "round(sqrt(CAST(recency AS DOUBLE)), 5) AS root",
        "length * CAST(length AS BIGINT) AS square", "round(log1p(CAST(monetary AS DOUBLE)), 5) AS log_monetary")


@query
def f8_null_and_guard(spark, d):
    return transaction_log(spark, d).groupBy("StockCode").agg(
        F.count_if(F.col("CustomerID").isNull()).alias("n_missing"),
        F.expr("IF(sum(Price) = 0, double('NaN'), CAST(sum(IF(CustomerID IS NULL, Price, 0)) AS DOUBLE)"
               " / nullif(CAST(sum(Price) AS DOUBLE), 0D))").alias("missing_price_share"))


# ---------------------------------------------------------------- distribution statistics

@query
def s1_shape_of_lines(spark, d):
    return P.shape(transaction_log(spark, d), P.LINE_AXES, P.LINE_SCALES)


@query
def s1_shape_of_customers(spark, d):
    return P.shape(mart(spark, d), P.RAW_AXES, P.RAW_SCALES)


@query
def s2_extremes(spark, d):
    return P.shape(positive(spark, d), P.LINE_AXES, P.LINE_SCALES, {"p99": 0.99}).select("axis", "p99", "max")


@query
def s2_extremes_buckets(spark, d):
    return P.shape(positive(spark, d), P.LINE_AXES, P.LINE_SCALES, {"p99": 0.99}, SMALL_BUCKET).select("axis", "p99", "max")


@query
def s3_spearman_raw_shuffled(spark, d):
    return P.spearman_raw(mart(spark, d), SMALL_BUCKET, 0)


@query
def s3_spearman_raw(spark, d):
    return P.spearman_raw(mart(spark, d))


@query
def s3_spearman_scores(spark, d):
    return N.spearman_scores(N.tenure_cells(mart(spark, d)))


@query
def s4_histogram(spark, d):
    return P.histogram(mart(spark, d), "recency")


@query
def s4_histogram_log(spark, d):
    return P.histogram(mart(spark, d), "monetary", log1p=True)


@query
def s5_box_statistics(spark, d):
    return E.box_statistics(levels(spark, d))


@query
def s6_scatter(spark, d):
    return P.scatter(levels(spark, d), "recency", "monetary", ["cluster"])


@query
def s6_bounded_scatter(spark, d):
    return P.bounded_scatter(levels(spark, d), "recency", "monetary", "cluster", 100)


# ---------------------------------------------------------------- tenure

@query
def e1_redundancy(spark, d):
    return N.redundancy(N.tenure_cells(mart(spark, d)))


@query
def e2_resolution_gain(spark, d):
    return N.cell_counts(N.tenure_cells(mart(spark, d)))


@query
def e3_split_cells(spark, d):
    return N.split_cells(N.tenure_cells(mart(spark, d)))


@query
def e4_example_cell(spark, d):
    return N.example_cell(N.tenure_cells(mart(spark, d)))


@query
def e5_verdict(spark, d):
    return N.verdict(N.tenure_cells(mart(spark, d)))


# ---------------------------------------------------------------- graph partition

@query
def k1_reduce_cells(spark, d):
    return G.reduce_cells(mart(spark, d), S.LRFM)


@query
def k2_edge_weights(spark, d):
    return G.edges(G.reduce_cells(mart(spark, d), S.LRFM), S.LRFM)


@query
def k2_edge_count(spark, d):
    return G.edges(G.reduce_cells(mart(spark, d), S.RFM), S.RFM).agg(
        F.count("*").alias("n_edges"), F.sum("w").alias("weight"))


@query
def k3_cut_manhattan(spark, d):
    return G.cut_manhattan(stripes(spark, d), ["k"], S.RFM)


@query
def k3_cut_euclidean(spark, d):
    return G.cut_by_pairs(stripes(spark, d), ["k"], S.RFM, "euclidean").selectExpr(
        "k", "round(cut / total, 9) AS cut_share")


@query
def k4_local_search(spark, d):
    return K.solve(materialise(G.reduce_cells(mart(spark, d), S.RFM), "cells"), S.RFM, [4])


@query
def k4_relocation_at_scale(spark, d):
    return L.relocate(G.reduce_cells(mart(spark, d), S.LRFM), S.LRFM, 4)[0]


def _in_three(spark, d):
    """Customers with R, F and M in three bins: nine cells at most of two variables."""
    return S.add_scores(S.raw_values(S.customers_of(lines(spark, d))), S.RFM, bins=3)


def _small_lattice(spark, d):
    """Cells of R and F in three bins: nine at most, so the optimum can be enumerated."""
    scored = S.add_scores(S.raw_values(S.customers_of(lines(spark, d))), ["R", "F"], bins=3)
    return materialise(G.reduce_cells(scored, ["R", "F"], 3), "small-cells")


def _by_least_cell(labels, keys):
    """Clusters named by their least cell, whatever number the method gave them."""
    least = labels.groupBy(*keys, "cluster").agg(F.min("cell_id").alias("named"))
    return labels.join(F.broadcast(least), [*keys, "cluster"]).drop("cluster").withColumnRenamed("named", "cluster")


@query
def k4_local_search_optimum(spark, d):
    """The local search on the small lattice; its SQL check enumerates every partition."""
    labels = K.solve(_small_lattice(spark, d), ["R", "F"], [2, 3, 4], bins=3)
    return labels.groupBy("k").agg(F.first("objective").alias("best_cut"))


@query
def k4_relocation_optimum(spark, d):
    """Relocation for large lattices, without its exchanges, on the small one; its SQL check enumerates every partition."""
    return _best_relocation(_small_lattice(spark, d), exchanges=False)


@query
def k5_exchange_at_scale_optimum(spark, d):
    """The same with its exchanges."""
    return _best_relocation(_small_lattice(spark, d), exchanges=True)


def _best_relocation(cells, exchanges):
    found = [L.relocate(cells, ["R", "F"], k, 3, starts=12, exchanges=exchanges)[0].groupBy().agg(
        F.first("objective").alias("best_cut"), F.every("settled").alias("settled")).withColumn("k", F.lit(k)) for k in (2, 3, 4)]
    return reduce(DataFrame.union, found).select("k", "best_cut", "settled")


@query
def k7_gap(spark, d):
    """The bound on the small lattice: never below the optimum that its SQL check enumerates, nor above all weight."""
    cells = _small_lattice(spark, d)
    labels = K.solve(cells, ["R", "F"], [2, 3, 4], bins=3)
    found = labels.groupBy("k").agg(F.first("objective").alias("best_cut"), F.first("gap").alias("gap"), F.every("settled").alias("settled"))
    whole = cells.selectExpr("*", "cell_id AS cluster", "1 AS one")
    total = G.cut_manhattan(whole, ["one"], ["R", "F"]).select("total")
    return found.crossJoin(F.broadcast(total)).selectExpr(  # a single row
        "k", "best_cut", "settled", "gap >= 0 AND best_cut * (1 + gap) <= total * (1 + 1e-9) AS bounded")


@query
def k6_multi_start_optimum(spark, d):
    """Two clusters on sixteen cells: 32,768 partitions for the SQL check to try."""
    scored = S.add_scores(S.raw_values(S.customers_of(lines(spark, d))), ["R", "F"], bins=4)
    cells = materialise(G.reduce_cells(scored, ["R", "F"], 4), "sixteen-cells")
    return K.solve(cells, ["R", "F"], [2], bins=4).groupBy("k").agg(F.first("objective").alias("best_cut"))


@query
def k7_objective_recomputed(spark, d):
    """The reported objective of the small lattice beside the cut of its labels."""
    labels = K.solve(_small_lattice(spark, d), ["R", "F"], [2, 3, 4], bins=3)
    recomputed = G.cut_manhattan(labels, ["k"], ["R", "F"]).select("k", F.col("cut").alias("label_cut"))
    return labels.groupBy("k").agg(F.first("objective").alias("best_cut")).join(recomputed, "k")


@query
def k5_exchange_refinement(spark, d):
    """Best cut per k of the same starts without and with exchanges."""
    packed = K.packed_cells(materialise(G.reduce_cells(mart(spark, d), S.RFM), "cells"), S.RFM)
    grid = K.restart_grid(packed, K.K_RANGE, K.RESTARTS, [K.SEED])
    plain = K.run_restarts(grid, sweeps=0).groupBy("k").agg(F.max("cut").alias("relocation_cut"))
    return K.run_restarts(grid).groupBy("k").agg(F.max("cut").alias("exchange_cut")).join(plain, "k")


@query
def k5_exchange_optimum(spark, d):
    """Relocation with exchanges on the small lattice; its SQL check enumerates every partition."""
    packed = K.packed_cells(_small_lattice(spark, d), ["R", "F"], bins=3)
    runs = K.run_restarts(K.restart_grid(packed, [2, 3, 4], K.RESTARTS, [K.SEED]))
    return runs.groupBy("k").agg(F.max("cut").alias("best_cut"))


@query
def k4_convergence(spark, d):
    """Restarts and settled restarts for each variable set and k on the full cells."""
    m = mart(spark, d)
    found = None
    for variables in (S.RFM, S.LRFM):
        packed = K.packed_cells(materialise(G.reduce_cells(m, variables), "cells"), variables)
        runs = K.run_restarts(K.restart_grid(packed, K.K_RANGE, K.RESTARTS, [K.SEED]))
        part = runs.groupBy("variables", "k").agg(F.count("*").alias("restarts"), F.count_if("settled").alias("settled"))
        found = part if found is None else found.union(part)
    return found


@query
def k7_objective_of_full_cells(spark, d):
    """What the reported objective of the full cells differs from the cut of the stored labels: nothing."""
    m = mart(spark, d)
    found = None
    for variables in (S.RFM, S.LRFM):
        labels = materialise(K.solve(materialise(G.reduce_cells(m, variables), "cells"), variables, K.K_RANGE), "solved")
        reported = labels.groupBy("variables", "k").agg(F.first("objective").alias("objective"), F.sum("cnt").alias("customers"))
        part = reported.join(G.cut_manhattan(labels, ["variables", "k"], variables), ["variables", "k"]).selectExpr(
            "variables", "k", "customers", "CAST(objective - cut AS DOUBLE) AS difference")
        found = part if found is None else found.union(part)
    return found


def solved(spark: SparkSession, d: str, variables: list[str], k: int = 4) -> DataFrame:
    """Customers of the mart with the cluster that the solver gives them, stored."""
    m = materialise(mart(spark, d), "mart")
    return materialise(E.align_labels(m, K.segment_customers(m, variables, k)), "solved")


def _of_both(spark, d, report):
    parts = [report(solved(spark, d, v), v).withColumn("variables", F.lit("".join(v))) for v in (S.RFM, S.LRFM)]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


@query
def g25_profile_of_solution(spark, d):
    return _of_both(spark, d, lambda labelled, v: E.profile_clusters(labelled, S.LRFM))


@query
def g27_volume_value_of_solution(spark, d):
    return _of_both(spark, d, lambda labelled, v: E.volume_value(labelled))


@query
def k13_loyalty_of_solution(spark, d):
    return _of_both(spark, d, lambda labelled, v: E.loyalty_ranking(labelled, v).select("cluster", "distance", "rank"))


@query
def s5_boxes_of_solution(spark, d):
    return _of_both(spark, d, lambda labelled, v: E.box_statistics(labelled))


@query
def k19_deviation_of_solution(spark, d):
    """Measured silhouettes of both sets beside the published curve: mean and largest difference, and the best k."""
    curve, _ = K.sweep(mart(spark, d))
    curve = materialise(curve, "curve")
    parts = []
    for name in ("RFM", "LRFM"):
        own = curve.filter(F.col("variables") == name)
        parts.append(E.deviation(own).crossJoin(E.best_k(own, ["variables"]).withColumnRenamed("k", "best")))  # a row each
    return parts[0].unionByName(parts[1])


def _best_three(spark, d):
    """Customers in the three clusters that the solver finds on the nine cells, each named by its least cell; stored."""
    m = materialise(_in_three(spark, d), "mart-in-three")
    labelled = K.segment_customers(m, ["R", "F"], 3, bins=3)
    placed = labelled.withColumn("cell_id", F.expr(G.cell_number(["R", "F"], 3)))
    return materialise(_by_least_cell(placed, []), "best-three")


@query
def k7_segment_customers_optimum(spark, d):
    """Customers by the solver's partition of nine cells; the SQL checks of this and the next four enumerate every partition."""
    return _best_three(spark, d).select("customer_id", "cluster")


@query
def g25_profile_of_optimum(spark, d):
    return E.profile_clusters(_best_three(spark, d))


@query
def g27_volume_value_of_optimum(spark, d):
    return E.volume_value(_best_three(spark, d))


@query
def k13_loyalty_of_optimum(spark, d):
    return E.loyalty_ranking(_best_three(spark, d), ["R", "F"])


@query
def s5_boxes_of_optimum(spark, d):
    return E.box_statistics(_best_three(spark, d))


@query
def k8_sweep_optimum(spark, d):
    """The sweep on nine cells; the gap has a check of its own.

    Two and three clusters only: at sf0.001 two partitions into four have the same cut, and SQL cannot tell which of them a search meets first.
    """
    return K.sweep(_in_three(spark, d), [["R", "F"]], [2, 3], bins=3)[0].drop("gap")


@query
def k9_side_by_side_optimum(spark, d):
    """Objectives of two sets of two variables side by side, nine cells each.

    Partitions of equal cut can differ in their silhouette (F and M do at sf0.001), so the silhouette is left to ``k8_sweep_optimum``.
    """
    m = materialise(_in_three(spark, d), "mart-in-three")
    curve, _ = K.sweep(m, [["R", "F"], ["F", "M"]], [2, 3, 4], bins=3)
    return curve.groupBy("k").pivot("variables", ["RF", "FM"]).agg(F.first("objective"))


@query
def k11_robustness_optimum(spark, d):
    """On nine cells every seed finds the enumerated optimum within fifty restarts."""
    return K.robustness(_small_lattice(spark, d), ["R", "F"], 3, budgets=(50, 200), bins=3)


@query
def k19_deviation_of_optimum(spark, d):
    """The swept curve of the nine cells beside the published one, for the k of ``k8_sweep_optimum``."""
    return E.deviation(K.sweep(_in_three(spark, d), [["R", "F"]], [2, 3], bins=3)[0])


@query
def k6_multi_start(spark, d):
    packed = K.packed_cells(materialise(G.reduce_cells(mart(spark, d), S.LRFM), "cells"), S.LRFM)
    runs = K.run_restarts(K.restart_grid(packed, [10], K.RESTARTS, [K.SEED]))
    return K.best_restarts(runs, ["variables", "k"]).selectExpr(
        "variables", "k", "restart", "cut", "settled", "size(cell_ids) AS n_cells", "size(array_distinct(clusters)) AS n_clusters")


@query
def k7_segment_customers(spark, d):
    return K.segment_customers(mart(spark, d), S.LRFM, 4).select("customer_id", "cluster")


@query
def k8_sweep(spark, d):
    return K.sweep(mart(spark, d))[0]


@query
def k9_side_by_side(spark, d):
    curve, _ = K.sweep(mart(spark, d))
    return curve.groupBy("k").pivot("variables", ["RFM", "LRFM"]).agg(
        F.first("silhouette").alias("silhouette"), F.first("objective").alias("objective"))


@query
def k10_exhaustive_cut(spark, d):
    return G.exhaustive_cut(_small_lattice(spark, d), ["R", "F"], [2, 3, 4], 3)


@query
def k11_robustness(spark, d):
    return K.robustness(materialise(G.reduce_cells(mart(spark, d), S.RFM), "cells"), S.RFM)


@query
def k12_silhouette(spark, d):
    return G.silhouette(stripes(spark, d), ["k"], S.RFM)


@query
def k13_loyalty_ranking(spark, d):
    return E.loyalty_ranking(levels(spark, d))


@query
def k14_loyalty_segments(spark, d):
    return E.loyalty_segments(levels(spark, d)).groupBy("cluster", "segment").agg(F.count("*").alias("customers"))


def _comparator(spark, d, method):
    m = mart(spark, d)
    parts = [M.compare_methods(G.reduce_cells(m, v), v, K.K_RANGE, [method]).select("variables", "method", "k", "cell_id", "cnt", "cluster") for v in (S.RFM, S.LRFM)]
    return parts[0].union(parts[1])


@query
def k15_kmeans(spark, d):
    return _comparator(spark, d, "K-means")


@query
def k15_kmeans_inertia(spark, d):
    """Least sum of squares found on the small lattice; its SQL check enumerates every partition."""
    cells = _small_lattice(spark, d)
    labels = materialise(M.compare_methods(cells, ["R", "F"], [2, 3], ["K-means"]), "kmeans")
    centred = labels.groupBy("k", "cluster").agg(*[F.expr(f"CAST(sum(cnt * {c} * {c}) AS DOUBLE) - CAST(sum(cnt * {c}) AS DOUBLE) * sum(cnt * {c}) / sum(cnt)").alias(c) for c in ("r_score", "f_score")])
    return centred.groupBy("k").agg(F.sum(F.expr("r_score + f_score")).alias("inertia"))


@query
def k16_ward(spark, d):
    return _comparator(spark, d, "Ward")


@query
def k16_ward_labels(spark, d):
    """Ward's clusters of the nine cells for each k; the SQL check merges the nearest pair, one at a time."""
    labels = M.compare_methods(_small_lattice(spark, d), ["R", "F"], list(range(2, 9)), ["Ward"], bins=3)
    return _by_least_cell(labels, ["k"]).select("k", "cell_id", "cnt", "cluster")


@query
def k18_method_silhouettes_optimum(spark, d):
    """Silhouettes on the nine cells of the largest cut, the least squares and Ward's tree, each of which SQL can find."""
    cells, wanted = _small_lattice(spark, d), ["variables", "k", "method", "cell_id", "cnt", "r_score", "f_score", "cluster"]
    cut = K.solve(cells, ["R", "F"], [2, 3], bins=3).withColumn("method", F.lit("max-k-cut"))
    others = M.compare_methods(cells, ["R", "F"], [2, 3], ["K-means", "Ward"], bins=3)
    labels = materialise(cut.select(*wanted).unionByName(others.select(*wanted)), "small-methods")
    return E.method_table(G.silhouette(labels, ["variables", "k", "method"], ["R", "F"], bins=3), ["max-k-cut", "K-means", "Ward"])


@query
def k17_gaussian_mixture(spark, d):
    return _comparator(spark, d, "GMM")


@query
def k18_method_silhouettes(spark, d):
    m = materialise(mart(spark, d), "mart")

    def curve(v):
        cells = materialise(G.reduce_cells(m, v), "cells")
        wanted = ["variables", "k", "method", "cell_id", "cnt", *G.score_columns(v), "cluster"]
        cut = K.solve(cells, v, K.K_RANGE).withColumn("method", F.lit("max-k-cut"))
        labels = materialise(cut.select(*wanted).unionByName(M.compare_methods(cells, v, K.K_RANGE).select(*wanted)), "methods")
        return G.silhouette(labels, ["variables", "k", "method"], v)

    with ThreadPoolExecutor(2) as pool:  # the two variable sets are independent jobs
        curves = list(pool.map(curve, (S.RFM, S.LRFM)))
    return E.method_table(curves[0].unionByName(curves[1]), ["max-k-cut", *M.METHODS])


@query
def k19_deviation(spark, d):
    return E.deviation(G.silhouette(stripes(spark, d), ["k"], S.RFM))


# ---------------------------------------------------------------- described in the plans

@query
def x1_monthly_revenue(spark, d):
    return P.monthly_revenue(positive(spark, d))


@query
def x2_junk_descriptions(spark, d):
    return P.junk_descriptions(transaction_log(spark, d))


@query
def x3_matched_cancellations(spark, d):
    return P.match_cancellations(transaction_log(spark, d))


@query
def x3_matched_quantities(spark, d):
    return P.match_quantities(transaction_log(spark, d))


@query
def x4_missing_customer_months(spark, d):
    return P.missing_customer_months(transaction_log(spark, d))


@query
def x5_silhouette_manhattan(spark, d):
    return G.silhouette(stripes(spark, d), ["k"], S.RFM, "manhattan")


@query
def x6_length_since_first(spark, d):
    return S.raw_values(S.customers_of(lines(spark, d)), since_first=True).select("customer_id", "length")


@query
def x7_lowest_bin_scores(spark, d):
    return S.add_lowest_bin_scores(S.raw_values(S.customers_of(lines(spark, d)))).select(
        "customer_id", *S.SCORE_COLUMN.values())


@query
def x8_scatter_length_recency(spark, d):
    return P.scatter(mart(spark, d), "length", "recency")
