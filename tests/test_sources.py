"""Loading, normalising, storing and cleaning on small hand-made rows."""

import pytest
from pyspark.sql import functions as F

from patronage.functions import expressions as X
from patronage.operators import clean as C
from patronage.operators import profile as P
from patronage.operators import scoring as S
from patronage.operators import warehouse as W
from patronage.sources import ingest as I
from patronage.sources import storage

LOG = "Invoice STRING, StockCode STRING, Description STRING, Quantity INT, InvoiceDate TIMESTAMP_NTZ, Price DECIMAL(12,2), CustomerID BIGINT, Country STRING"


def log(spark, rows):
    values = ", ".join(
        f"('{i}', '{s}', {d!r}, {q}, TIMESTAMP_NTZ '{t}', {p}BD, {c}, '{n}', '{sheet}')".replace("None", "NULL")
        for i, s, d, q, t, p, c, n, sheet in rows)
    return spark.sql(f"SELECT Invoice, StockCode, Description, Quantity, InvoiceDate, CAST(Price AS DECIMAL(12,2)) AS Price, "
                     f"CAST(CustomerID AS BIGINT) AS CustomerID, Country, SourceSheet FROM VALUES {values} AS t("
                     "Invoice, StockCode, Description, Quantity, InvoiceDate, Price, CustomerID, Country, SourceSheet)")


@pytest.fixture(scope="module")
def rows(spark):
    return log(spark, [
        ("1", "10001", "mug", 2, "2020-01-01 23:00:00", "2.50", 7, "UK", "a"),
        ("1", "10001", "mug", 2, "2020-01-01 23:00:00", "2.50", 7, "UK", "a"),
        ("1", "10001", "mug", 2, "2020-01-01 23:00:00", "2.50", 7, "UK", "b"),
        ("2", "10001", "cup", 1, "2020-03-05 01:00:00", "1.00", 7, "UK", "a"),
        ("C2", "10001", "cup", -1, "2020-03-06 00:00:00", "1.00", 7, "UK", "a"),
        ("3", "POST", None, 1, "2020-03-05 02:00:00", "0.00", 8, "FR", "a"),
        ("4", "10002B", None, 5, "2020-03-07 00:00:00", "3.00", None, "FR", "b"),
        ("5", "10002B", None, 5, "2020-01-02 00:00:00", "3.00", 8, "DE", "b"),
    ])


def test_parts_from_csv(spark, tmp_path):
    for name, line in (("one", "A1,10001,mug,3,2020-01-01 10:00:00,2.50,17.0,UK"), ("two", "A2,10002,,x,2020-01-02 10:00:00,1,,FR")):
        (tmp_path / f"{name}.csv").write_text(
            "Invoice,StockCode,Description,Quantity, InvoiceDate,Price,Customer ID,Country\n" + line + "\n")
    paths = {n: f"file://{tmp_path}/{n}.csv" for n in ("one", "two")}
    loaded = I.read_parts(spark, paths, "csv")
    first, second = sorted(loaded.collect(), key=lambda r: r.Invoice)
    assert (first.CustomerID, first.Quantity, first.SourceSheet) == (17, 3, "one")
    assert (second.CustomerID, second.Quantity, second.Description) == (None, None, None)
    assert dict(loaded.dtypes)["InvoiceDate"] == "timestamp_ntz"
    cached = I.raw_log(spark, f"{tmp_path}/cache", paths, "csv")
    assert cached.count() == 2
    assert "SourceSheet" not in I.read_parts(spark, paths, "csv", tag=False).columns


def test_cache_is_built_once(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    path = str(tmp_path / "table")
    for force in (False, False, True):
        assert storage.cached_table(spark, path, build, force).count() == 3
    assert len(built) == 2


def test_cleaning_log(rows):
    steps = {r.rule[0]: (r.rows_left, r.rows_removed) for r in C.cleaning_log(rows).collect()}
    assert steps == {"0": (8, 0), "1": (7, 1), "2": (6, 1), "3": (5, 1), "4": (4, 1)}
    assert C.clean(rows).count() == 4
    assert C.clean(rows, keep_part=False).count() == 3


def test_days_differ_by_flavour(rows):
    customers = S.customers_of(W.renamed(C.clean(rows)))
    calendar = {r.customer_id: r for r in S.raw_values(customers).collect()}
    elapsed = {r.customer_id: r for r in S.raw_values(customers, "elapsed").collect()}
    assert calendar[7].length == 64 and elapsed[7].length == 63
    assert calendar[8].recency == 63 and elapsed[8].recency == 63
    since = {r.customer_id: r.length for r in S.raw_values(customers, since_first=True).collect()}
    assert since == {7: 64, 8: 63}
    assert float(calendar[7].monetary) == 11.0 and calendar[7].frequency == 2


def test_modes_skip_nulls_and_break_ties_low(rows):
    lines = W.renamed(C.clean(rows, keep_part=False))
    products = {r.stock_code: r.description for r in W.dim_product(lines).collect()}
    assert products == {"10001": "cup", "10002B": None}


def test_earliest_line_names_the_customer(spark):
    lines = spark.sql("SELECT * FROM VALUES ('1', 5L, TIMESTAMP_NTZ '2020-01-02 00:00:00'), ('1', 4L, TIMESTAMP_NTZ '2020-01-01 00:00:00'), "
                      "('1', 3L, TIMESTAMP_NTZ '2020-01-01 00:00:00') AS t(invoice_id, customer_id, invoice_date)")
    assert W.dim_invoice(lines).first().customer_id == 3


def test_halves(spark):
    pairs = spark.sql("SELECT * FROM VALUES (1, 2), (2, 3), (4, 5), (3, 3) AS t(f, m)")
    out = pairs.select(X.combined_fm(F.col("f"), F.col("m")).alias("a"), X.combined_fm(F.col("f"), F.col("m"), True).alias("e"))
    assert [tuple(r) for r in out.collect()] == [(2, 2), (3, 2), (5, 4), (3, 3)]


def test_grid_leaves_nobody_out(spark):
    grid = spark.sql("SELECT r, fm FROM (SELECT explode(sequence(1, 5)) AS r), (SELECT explode(sequence(1, 5)) AS fm)")
    names = {(r.r, r.fm): r.s for r in grid.select("r", "fm", X.named_segment(F.col("r"), F.col("fm")).alias("s")).collect()}
    assert "Others" not in names.values()
    assert names[5, 5] == "Champions" and names[1, 3] == "At Risk" and names[3, 4] == "Loyal Customers"
    assert set(names.values()) == {name for row in X.SEGMENT_GRID.values() for name in row}


def test_only_whole_markers_are_junk(spark):
    texts = ['?', '??', 'damaged', ' LOST ', 'Check', 'CHECKERED TABLECLOTH', 'LOST AND FOUND SIGN', 'damaged box', '', None]
    df = spark.createDataFrame([(t,) for t in texts], 'd string')
    assert [r.j for r in df.select(X.is_junk_description(F.col('d')).alias('j')).collect()] == [True] * 5 + [False] * 5


def test_empty_months_count_zero(rows):
    months = {r.month: r.n_rows for r in P.monthly_rows(rows).collect()}
    assert months == {"2020-01": 4, "2020-02": 0, "2020-03": 4}
    assert P.monthly_balance(rows).first().peak_month == "2020-01"


def test_cancellation_finds_the_latest_earlier_sale(rows):
    row = P.match_cancellations(rows).first()
    assert str(row.sale_date) == "2020-03-05 01:00:00" and row.n_cancelled == 1


def test_integrity(rows):
    tables = W.build_tables(storage.materialise(C.clean(rows), "t"))
    assert {r.n_rows for r in W.foreign_key_violations(tables).collect()} == {0}
    assert {r.n_violations for r in W.key_violations(tables).collect()} == {0}
    broken = {**tables, "dim_product": tables["dim_product"].filter("stock_code <> '10001'")}
    found = {r.key_column: (r.n_keys, r.n_rows) for r in W.foreign_key_violations(broken).collect() if r.n_rows}
    assert found == {"stock_code": (1, 3)}


def test_shared_folder_is_required_on_a_cluster():
    class Context:
        master = "spark://host"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(_key, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_folder(Session())


def test_cache_builds_only_what_changed(spark, tmp_path):
    for name, n in (("a b", 3), ("c=d", 5)):
        spark.range(n).write.parquet(f"{tmp_path}/{name}")
    built = []

    def build(name, path):
        built.append(name)
        return spark.read.parquet(path)

    def rows(sources):
        table, now = storage.cached_parts(spark, f"{tmp_path}/cache", sources, build)
        return {r["SourceSheet"]: r["n"] for r in table.groupBy("SourceSheet").agg(F.count("*").alias("n")).collect()}, now

    sources = {name: f"{tmp_path}/{name}" for name in ("a b", "c=d")}
    assert rows(sources) == ({"a b": 3, "c=d": 5}, ["a b", "c=d"])
    assert rows(sources) == ({"a b": 3, "c=d": 5}, [])
    spark.range(10).write.mode("append").parquet(f"{tmp_path}/c=d")
    assert rows(sources) == ({"a b": 3, "c=d": 15}, ["c=d"])
    spark.range(2).write.parquet(f"{tmp_path}/new")
    assert rows({**sources, "new": f"{tmp_path}/new"}) == ({"a b": 3, "c=d": 15, "new": 2}, ["new"])
    assert rows({"new": f"{tmp_path}/new"}) == ({"new": 2}, [])
    assert built == ["a b", "c=d", "c=d", "new"]


def test_parts_in_one_scan(spark, stored_log, tmp_path):
    for name in ("sheet1", "sheet2"):
        stored_log.filter(F.col("SourceSheet") == name).drop("SourceSheet").write.parquet(f"{tmp_path}/{name}")
    paths = {"one": f"{tmp_path}/sheet1", "two": f"file://{tmp_path}/sheet2/"}
    at_once, apart = I.read_parts_at_once(spark, paths), I.read_parts(spark, paths)
    assert sorted(map(tuple, I.rows_per_part(at_once).collect())) == sorted(map(tuple, I.rows_per_part(apart).collect()))
    assert at_once._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1


def test_bucketed_tables_join_without_exchange(spark, stored_log, tmp_path):
    tables = W.build_tables(C.clean(stored_log))
    stored = W.write_bucketed(tables, str(tmp_path), "bucket_test", 4)
    joined = W.bucketed_lines_with_invoice(stored["fact_line"], stored["dim_invoice"])
    totals = W.invoice_totals(stored["fact_line"], stored["dim_invoice"].hint("merge"))
    for df in (joined, totals):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == tables["fact_line"].count()
    want = W.invoice_totals(tables["fact_line"], tables["dim_invoice"])
    assert sorted(map(str, totals.collect())) == sorted(map(str, want.collect()))
    for name in ("fact_line", "dim_invoice"):
        spark.sql(f"DROP TABLE bucket_test_{name}")


def test_pieces_are_taken_back_first_in_first_out(spark):
    import collections
    import datetime
    import random
    r = random.Random(4)
    rows = []
    for customer, product in ((1, "a"), (1, "b"), (2, "a"), (None, "a")):
        for day in r.sample(range(60), 40):
            back = r.random() < 0.45
            at = datetime.datetime(2020, 1, 1) + datetime.timedelta(days=day // 2)
            rows.append((f"{'C' if back else ''}{day}", product, -r.randint(1, 9) if back else r.choice([0, 1, 2, 8]), at, customer))
    log = spark.createDataFrame(rows, "Invoice string, StockCode string, Quantity int, InvoiceDate timestamp_ntz, CustomerID long")
    want = collections.Counter()
    for key in {(x[4], x[1]) for x in rows if x[4] is not None}:
        stock = collections.deque()
        for at in sorted({x[3] for x in rows}):
            here = [x for x in rows if (x[4], x[1], x[3]) == (*key, at)]
            sold = sum(x[2] for x in here if not x[0].startswith("C"))
            if sold:
                stock.append([at, sold])
            gone = sum(-x[2] for x in here if x[0].startswith("C"))
            while gone and stock:
                n = min(gone, stock[0][1])
                want[*key, at, stock[0][0]] += n
                gone -= n
                stock[0][1] -= n
                if not stock[0][1]:
                    stock.popleft()
            if gone:
                want[*key, at, None] += gone
    found = P.match_quantities(log).collect()
    assert {(x.CustomerID, x.StockCode, x.cancelled_at, x.sold_at): x.quantity for x in found} == dict(want)
    assert len(found) == len(want)


def test_scatter_is_bounded_and_the_same_for_any_partitioning(spark):
    table = spark.range(5000).selectExpr("id AS customer_id", "IF(id % 10 < 8, 'big', concat('g', id % 3)) AS cluster", "id AS x", "id * 2 AS y")
    points = [sorted(map(tuple, P.bounded_scatter(table.repartition(n), "x", "y", "cluster", 50).collect())) for n in (1, 7)]
    assert points[0] == points[1] and len(points[0]) == 200
    plan = P.bounded_scatter(table.repartition(3), "x", "y", "cluster", 50)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
