"""The same results as plain SQL over the base tables, for an independent engine.

Written from the definitions, not from the DataFrame code: whole-table windows, direct
joins and all-pairs sums, which are fine at the size of a check.
"""

from __future__ import annotations

from collections.abc import Callable

# Fixed values, written out apart from the table under test: the segments of a recency score by combined score 1..5, and the last day of each churn band.
GRID = {
    5: ["New / Promising", "New / Promising", "Loyal Customers", "Champions", "Champions"],
    4: ["New / Promising", "New / Promising", "Loyal Customers", "Champions", "Champions"],
    3: ["Potential Loyalist", "Potential Loyalist", "Loyal Customers", "Loyal Customers", "Loyal Customers"],
    2: ["Hibernating / Lost", "Hibernating / Lost", "At Risk", "At Risk", "At Risk"],
    1: ["Hibernating / Lost", "Hibernating / Lost", "At Risk", "Cannot Lose Them", "Cannot Lose Them"],
}
OTHER = "Others"
BANDS = [(90, "1 Active (<=90d)"), (180, "2 Cooling (91-180d)"), (365, "3 At Risk (181-365d)"), (2**31 - 1, "4 Churned (>365d)")]


def _fifth(place: str) -> str:
    """Which of five groups a place falls into: the first n % 5 groups are one larger."""
    small, rest = "(n // 5)", "(n % 5)"
    return (f"CAST(CASE WHEN {place} <= {rest} * ({small} + 1) THEN ({place} - 1) // ({small} + 1) "
            f"ELSE {rest} + ({place} - 1 - {rest} * ({small} + 1)) // {small} END + 1 AS BIGINT)")


STAGES = """
joined AS (
  SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
),
tx AS (
  SELECT
    CASE WHEN l_returnflag = 'R' AND o_orderkey % 10 = 0 THEN 'C' || CAST(o_orderkey AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) END AS Invoice,
    CASE WHEN l_partkey % 50 = 0 THEN 'POST'
         WHEN l_partkey % 3 = 0 THEN lpad(CAST(l_partkey AS VARCHAR), 5, '0') || 'A'
         ELSE lpad(CAST(l_partkey AS VARCHAR), 5, '0') END AS StockCode,
    CASE WHEN l_partkey % 40 = 0 THEN NULL WHEN o_orderkey % 43 = 0 THEN 'check' WHEN o_orderkey % 47 = 0 THEN 'damaged'
         WHEN o_orderkey % 53 = 0 THEN '?' ELSE p_name END AS Description,
    CASE WHEN l_returnflag = 'R' AND o_orderkey % 10 = 0 THEN -CAST(l_quantity AS INT) ELSE CAST(l_quantity AS INT) END AS Quantity,
    o_orderdate + INTERVAL 1 HOUR * CAST(o_orderkey % 24 AS INT) AS InvoiceDate,
    CASE WHEN l_partkey % 97 = 0 THEN CAST(0 AS DECIMAL(12,2)) ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS Price,
    CASE WHEN o_orderkey % 5 = 4 THEN NULL WHEN o_custkey % 16 = 1 THEN o_orderkey + 10000000000 ELSE o_custkey END AS CustomerID,
    CASE WHEN o_orderkey % 7 = 0 THEN 'Unspecified' ELSE n_name END AS Country,
    unnest(CASE WHEN o_orderkey % 30 = 0 AND o_orderdate < TIMESTAMP '1998-04-01 00:00:00' THEN ['sheet1', 'sheet1']
                WHEN o_orderkey % 30 = 0 THEN ['sheet2', 'sheet2']
                WHEN o_orderkey % 36 = 0 THEN ['sheet1', 'sheet2']
                WHEN o_orderdate < TIMESTAMP '1998-04-01 00:00:00' THEN ['sheet1']
                ELSE ['sheet2'] END) AS SourceSheet
  FROM joined
),
clean AS (
  SELECT DISTINCT *, Quantity * Price AS Total FROM tx WHERE CustomerID IS NOT NULL AND Quantity > 0 AND Price > 0
),
pos AS (SELECT *, Quantity * Price AS revenue FROM tx WHERE Quantity > 0 AND Price > 0),
dim_invoice AS (
  SELECT Invoice AS invoice_id, arg_min(CustomerID, InvoiceDate) AS customer_id, min(InvoiceDate) AS invoice_date
  FROM clean GROUP BY Invoice
),
fact_line AS (SELECT Invoice AS invoice_id, StockCode AS stock_code, Quantity AS quantity, Price AS price FROM clean),
dim_customer AS (
  SELECT customer_id, max(CASE WHEN pos = 1 THEN country END) AS country FROM (
    SELECT CustomerID AS customer_id, Country AS country,
           row_number() OVER (PARTITION BY CustomerID ORDER BY (Country IS NULL), count(*) DESC, Country) AS pos
    FROM clean GROUP BY CustomerID, Country) GROUP BY customer_id
),
dim_product AS (
  SELECT stock_code, max(CASE WHEN pos = 1 THEN description END) AS description FROM (
    SELECT StockCode AS stock_code, Description AS description,
           row_number() OVER (PARTITION BY StockCode ORDER BY (Description IS NULL), count(*) DESC, Description) AS pos
    FROM clean GROUP BY StockCode, Description) GROUP BY stock_code
),
sold AS (SELECT invoice_id, customer_id, invoice_date, stock_code, quantity * price AS amount FROM fact_line JOIN dim_invoice USING (invoice_id)),
visits AS (SELECT customer_id, invoice_id, min(invoice_date) AS seen_on, sum(amount) AS spent FROM sold GROUP BY customer_id, invoice_id),
habits AS (
  SELECT customer_id, count(*) AS frequency, round(sum(spent), 2) AS monetary, min(seen_on) AS first_date, max(seen_on) AS last_date,
    max(max(seen_on)) OVER () AS closing
  FROM visits GROUP BY customer_id
),
buyers AS (
  SELECT *, CAST(closing AS DATE) - CAST(last_date AS DATE) AS recency, CAST(last_date AS DATE) - CAST(first_date AS DATE) AS length FROM habits
),
orders_of AS (
  SELECT *, count(*) OVER () AS n,
    row_number() OVER (ORDER BY recency DESC, customer_id) AS r_place, row_number() OVER (ORDER BY frequency, customer_id) AS f_place,
    row_number() OVER (ORDER BY monetary, customer_id) AS m_place, row_number() OVER (ORDER BY length, customer_id) AS l_place
  FROM buyers
),
mart AS (SELECT * EXCLUDE (n, r_place, f_place, m_place, l_place), @SCORES@ FROM orders_of),
grid AS (SELECT * FROM (VALUES @GRID@) AS g(r_score, fm, segment)),
spend AS (SELECT *, CAST((f_score + m_score + 1) // 2 AS BIGINT) AS fm FROM mart),
seg AS (SELECT spend.*, coalesce(grid.segment, '@OTHER@') AS segment FROM spend LEFT JOIN grid USING (r_score, fm)),
bands AS (SELECT * FROM (VALUES @BANDS@) AS t(upto, churn_band)),
band AS (SELECT mart.*, churn_band FROM mart ASOF JOIN bands ON mart.recency <= bands.upto),
levels AS (SELECT *, CAST(floor((r_score + f_score + m_score + l_score) / 4.0) AS BIGINT) - 1 AS cluster FROM mart),
rfm AS (
  SELECT r_score, f_score, m_score, count(*) AS cnt, ((r_score - 1) * 5 + f_score - 1) * 5 + m_score - 1 AS cell_id
  FROM mart GROUP BY r_score, f_score, m_score
),
lrfm AS (
  SELECT l_score, r_score, f_score, m_score, count(*) AS cnt,
         (((l_score - 1) * 5 + r_score - 1) * 5 + f_score - 1) * 5 + m_score - 1 AS cell_id,
         min(length) AS length_min, max(length) AS length_max, avg(CAST(length AS DOUBLE)) AS length_mean
  FROM mart GROUP BY l_score, r_score, f_score, m_score
),
stripes AS (SELECT rfm.*, k, (r_score + f_score + m_score) % k AS cluster FROM rfm, generate_series(2, 10) AS g(k)),
gaps AS (
  SELECT a.k, a.cell_id AS i, b.cell_id AS j, a.cluster AS ci, b.cluster AS cj, a.cnt AS ni, b.cnt AS nj,
    abs(a.r_score - b.r_score) + abs(a.f_score - b.f_score) + abs(a.m_score - b.m_score) AS manhattan,
    sqrt(CAST((a.r_score - b.r_score) * (a.r_score - b.r_score) + (a.f_score - b.f_score) * (a.f_score - b.f_score)
       + (a.m_score - b.m_score) * (a.m_score - b.m_score) AS DOUBLE)) AS euclidean
  FROM stripes a JOIN stripes b ON a.k = b.k
)
""".replace("@SCORES@", ", ".join(f"{_fifth(v + '_place')} AS {v}_score" for v in "rfml")).replace(
    "@GRID@", ", ".join(f"({r}, {fm}, '{name}')" for r, row in GRID.items() for fm, name in enumerate(row, 1))).replace(
    "@OTHER@", OTHER).replace("@BANDS@", ", ".join(f"({upto}, '{name}')" for upto, name in BANDS))


def _silhouette(metric: str, gaps: str = "gaps", by: str = "k") -> str:
    return f"""
reach AS (SELECT {by}, i, ci, ni, cj, sum(nj) AS n, sum(nj * CAST({metric} AS DOUBLE)) AS mass FROM {gaps} GROUP BY {by}, i, ci, ni, cj),
value AS (
  SELECT {by}, i, ni, max(CASE WHEN ci = cj THEN n END) AS own_n,
    max(CASE WHEN ci = cj AND n > 1 THEN mass / (n - 1) END) AS a, min(CASE WHEN ci <> cj THEN mass / n END) AS b
  FROM reach GROUP BY {by}, i, ni
),
curve AS (
  SELECT {by}, sum(ni * CASE WHEN b IS NULL THEN CAST('NaN' AS DOUBLE) WHEN own_n = 1 THEN 0 WHEN greatest(a, b) = 0 THEN 0
                          ELSE (b - a) / greatest(a, b) END) / sum(ni) AS silhouette
  FROM value GROUP BY {by}
)
"""


PUBLISHED = """
published AS (SELECT * FROM (VALUES (2, 0.46), (3, 0.35), (4, 0.40), (5, 0.35), (6, 0.29), (7, 0.31), (8, 0.32), (9, 0.34), (10, 0.36))
              AS t(k, published))
"""

RAW = "customer_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary, length"
SCORES = "r_score, f_score, m_score, l_score"
PER_COUNTRY = "SELECT Country, count(*) AS n_rows, CAST(sum(Quantity) AS BIGINT) AS quantity, CAST(sum(Quantity * Price) AS DOUBLE) AS amount FROM {} GROUP BY Country"
DATE = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _moments(source: str, column: str, name: str) -> str:
    """Population skew and excess kurtosis by hand; one row."""
    return f"""SELECT '{name}' AS axis, min(v) AS min, median(v) AS median, max(m) AS mean, max(v) AS max,
      round(avg((v - m) ** 3) / avg((v - m) ** 2) ** 1.5, 6) AS skew, round(avg((v - m) ** 4) / avg((v - m) ** 2) ** 2 - 3, 6) AS kurtosis
    FROM (SELECT CAST({column} AS DOUBLE) AS v, avg(CAST({column} AS DOUBLE)) OVER () AS m FROM {source})"""


def _shape(source: str, columns: list[str]) -> str:
    rows = " UNION ALL ".join(_moments(source, c, c) for c in columns)
    return f"""SELECT axis, round(min, 6) AS min, round(median, 6) AS median, round(mean, 6) AS mean, round(max, 6) AS max, skew, kurtosis FROM ({rows})"""


def _gini(source: str, key: str) -> str:
    return f"""SELECT count(*) AS n_keys, round((count(*) + 1 - 2 * sum(running) / max(total)) / count(*), 6) AS gini FROM (
      SELECT CAST(sum(x) OVER (ORDER BY x, key ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running, CAST(sum(x) OVER () AS DOUBLE) AS total
      FROM (SELECT {key} AS key, sum(revenue) AS x FROM {source} WHERE {key} IS NOT NULL GROUP BY {key}))"""


def _top(source: str, key: str, count: str, name: str) -> str:
    return f"""SELECT CAST(max(n) AS BIGINT) AS n_keys, round(100 * CAST(sum(CASE WHEN place <= {count} THEN x END) AS DOUBLE) / CAST(sum(x) AS DOUBLE), 6) AS {name} FROM (
      SELECT x, row_number() OVER (ORDER BY x DESC) AS place, count(*) OVER () AS n FROM ({source}))"""


def _ranks(source: str, column: str) -> str:
    return f"rank() OVER (ORDER BY {column}) + (count(*) OVER (PARTITION BY {column}) - 1) / 2.0"


def _spearman(columns: list[str], source: str) -> str:
    ranks = ", ".join(f"CAST({_ranks(source, c)} AS DOUBLE) AS {c}_rank" for c in columns)
    rows = " UNION ALL ".join(
        f"SELECT '{a}' AS first, '{b}' AS second, round(corr({a}_rank, {b}_rank), 6) AS rho FROM ranked"
        for n, a in enumerate(columns) for b in columns[n + 1:])
    return f"ranked AS (SELECT {ranks} FROM {source})", rows


_SPEAR_RAW = _spearman(["recency", "frequency", "monetary", "length"], "mart")
_SPEAR_SCORES = _spearman(["r_score", "f_score", "m_score", "l_score"], "mart")
_REDUNDANCY = f"redundancy AS (SELECT max(CASE WHEN second = 'l_score' THEN abs(rho) END) AS l_redundancy, max(CASE WHEN second <> 'l_score' THEN abs(rho) END) AS rfm_redundancy FROM ({_SPEAR_SCORES[1]}))"
_GAIN = "gain AS (SELECT (SELECT count(*) FROM rfm) AS rfm_cells, (SELECT count(*) FROM lrfm) AS lrfm_cells)"



def _report(table: str, label: str, measures: dict[str, str], revenue: str) -> str:
    """Customers and revenue of each label with their shares of the whole, and other measures."""
    more = "".join(f", {sql} AS {name}" for name, sql in measures.items())
    return f"""SELECT part.*, round(100.0 * customers / everyone, 1) AS pct_customers, round(100.0 * {revenue} / takings, 1) AS pct_revenue
FROM (SELECT {label}, count(*) AS customers, round(CAST(sum(monetary) AS DOUBLE), 0) AS {revenue}_shown{more}, CAST(sum(monetary) AS DOUBLE) AS {revenue} FROM {table} GROUP BY {label}) part,
     (SELECT count(*) AS everyone, CAST(sum(monetary) AS DOUBLE) AS takings FROM {table})"""


def _shown(report: str, revenue: str) -> str:
    return f"SELECT * EXCLUDE ({revenue}, {revenue}_shown), {revenue}_shown AS {revenue} FROM ({report})"


def _average(column: str, digits: int) -> str:
    return f"round(avg(CAST({column} AS DOUBLE)), {digits})"


_SEGMENTS = _shown(_report("seg", "segment", {
    "avg_recency": _average("recency", 0), "avg_frequency": _average("frequency", 1), "avg_monetary": _average("monetary", 0), "avg_length": _average("length", 0)}, "total_revenue"), "total_revenue")
_BANDS = _shown(_report("band", "churn_band", {"avg_frequency": _average("frequency", 1)}, "revenue_at_band"), "revenue_at_band")
_BALANCE = " UNION ALL ".join(
    f"SELECT '{v}' AS axis, {v.lower()}_score AS score, count(*) AS customers FROM mart GROUP BY {v.lower()}_score" for v in "RFML")
_QUINTILE = "quintile AS (SELECT *, ntile(5) OVER (ORDER BY monetary DESC, customer_id) AS m_quintile FROM mart)"
_DIM_RAW = """raw_fact AS (SELECT Invoice AS invoice_id, StockCode AS stock_code FROM tx)"""


def _pairs(source: str, columns: str, metric: str) -> str:
    names = columns.split()
    if metric == "manhattan":
        gap = "CAST(" + " + ".join(f"abs(a.{c} - b.{c})" for c in names) + " AS DOUBLE)"
    else:
        gap = "sqrt(CAST(" + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in names) + " AS DOUBLE))"
    return f"SELECT CAST(a.cell_id AS BIGINT) AS i, CAST(b.cell_id AS BIGINT) AS j, round(a.cnt * b.cnt * {gap}, 6) AS w FROM {source} a JOIN {source} b ON a.cell_id < b.cell_id"


def _missing() -> str:
    names = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "CustomerID", "Country", "SourceSheet"]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 2) AS missing_pct FROM tx" for c in names)


def _rank_cut() -> str:
    def score(column, direction):
        return f"CAST(greatest(1, ceil(5 * (row_number() OVER (ORDER BY {column} {direction}, customer_id) - 1) / CAST(count(*) OVER () - 1 AS DOUBLE))) AS BIGINT)"
    return f"""SELECT customer_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary, length,
      {score('recency', 'DESC')} AS r_score, {score('frequency', 'ASC')} AS f_score, {score('monetary', 'ASC')} AS m_score, {score('length', 'ASC')} AS l_score
    FROM elapsed"""


_ELAPSED = """elapsed AS (SELECT customer_id, CAST(floor(date_diff('second', last_date, (SELECT max(closing) FROM habits)) / 86400) AS BIGINT) AS recency,
  frequency, monetary, CAST(floor(date_diff('second', first_date, last_date) / 86400) AS BIGINT) AS length FROM buyers)"""


def _profile(table: str = "levels") -> str:
    parts = ", ".join(
        f"CAST(min({c}) AS DOUBLE) AS {c}_min, round(CAST(sum({c}) AS DOUBLE) / count(*), 6) AS {c}_mean, CAST(max({c}) AS DOUBLE) AS {c}_max"
        for c in ["recency", "frequency", "monetary", "length"])
    return f"SELECT cluster, {parts}, count(*) AS customers FROM {table} GROUP BY cluster"


def _volume(table: str = "levels") -> str:
    return ("SELECT cluster, count(*) AS customers, CAST(sum(monetary) AS DOUBLE) AS revenue, round(100.0 * count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS pct_customers, "
            f"round(100.0 * CAST(sum(monetary) AS DOUBLE) / CAST(sum(sum(monetary)) OVER () AS DOUBLE), 6) AS pct_revenue FROM {table} GROUP BY cluster")


def _boxes(table: str = "levels") -> str:
    return f"""SELECT cluster, round(max(q1), 6) AS q1, round(max(q2), 6) AS median, round(max(q3), 6) AS q3,
        min(CASE WHEN v >= q1 - 1.5 * (q3 - q1) THEN v END) AS whisker_low, max(CASE WHEN v <= q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_high
        FROM (SELECT cluster, CAST(monetary AS DOUBLE) AS v FROM {table}) JOIN
        (SELECT cluster, quantile_cont(CAST(monetary AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(monetary AS DOUBLE), 0.5) AS q2,
                quantile_cont(CAST(monetary AS DOUBLE), 0.75) AS q3 FROM {table} GROUP BY cluster) USING (cluster) GROUP BY cluster"""


_MEAN_SCORES = "SELECT cluster, " + ", ".join(
    f"round(CAST(sum({c}) AS DOUBLE) / count(*), 6) AS {c}" for c in SCORES.split(", ")) + " FROM levels GROUP BY cluster"
_LOYALTY = """means AS (SELECT cluster, avg(CAST(r_score AS DOUBLE)) AS r_score, avg(CAST(f_score AS DOUBLE)) AS f_score,
    avg(CAST(m_score AS DOUBLE)) AS m_score, avg(CAST(l_score AS DOUBLE)) AS l_score, count(*) AS customers FROM levels GROUP BY cluster),
  far AS (SELECT *, round(sqrt(r_score ** 2 + f_score ** 2 + m_score ** 2 + l_score ** 2), 9) AS distance FROM means),
  loyal AS (SELECT *, CAST(floor(rank() OVER (ORDER BY distance DESC) + (count(*) OVER (PARTITION BY distance) - 1) / 2.0) AS BIGINT) AS rank FROM far)"""


def _lowest_bin() -> str:
    def score(axis):
        cuts = [f"(SELECT quantile_cont(CAST({axis} AS DOUBLE), {s}) FROM buyers)" for s in (0.2, 0.4, 0.6, 0.8)]
        return " + ".join(["1"] + [f"CASE WHEN CAST({axis} AS DOUBLE) > {c} THEN 1 ELSE 0 END" for c in cuts])
    return f"""SELECT customer_id, CAST({score('-recency')} AS BIGINT) AS r_score, CAST({score('frequency')} AS BIGINT) AS f_score,
      CAST({score('CAST(monetary * 100 AS BIGINT)')} AS BIGINT) AS m_score, CAST({score('length')} AS BIGINT) AS l_score FROM buyers"""


def _histogram(value: str) -> str:
    return f"""SELECT bin, count(*) AS n FROM (SELECT CAST(least(floor((x - lo) / ((hi - lo) / 50)), 49) AS BIGINT) AS bin FROM (
      SELECT x, min(x) OVER () AS lo, max(x) OVER () AS hi FROM (SELECT {value} AS x FROM mart))) GROUP BY bin"""


def _lattice(bins: int, second: str = "frequency", first: str = "recency DESC", tag: str = "") -> str:
    """Customers scored on two variables, their cells (number ``v``) and the weights between cells."""
    return f"""
scored{tag} AS (SELECT *, ntile({bins}) OVER (ORDER BY {first}, customer_id) AS r, ntile({bins}) OVER (ORDER BY {second}, customer_id) AS f FROM buyers),
small{tag} AS (SELECT r, f, count(*) AS cnt, (r - 1) * {bins} + f - 1 AS v FROM scored{tag} GROUP BY r, f),
link{tag} AS (SELECT a.v AS i, b.v AS j, a.cnt * b.cnt * (abs(a.r - b.r) + abs(a.f - b.f)) AS w FROM small{tag} a JOIN small{tag} b ON a.v < b.v)
"""


_EXHAUSTIVE = _lattice(3)


def _own(k: int, vertex: str) -> str:
    """The cluster of a vertex in the partition with number ``id``; vertex 0 stays in cluster 0."""
    return f"CASE WHEN {vertex} = 0 THEN 0 ELSE (id // CAST(power({k}, {vertex} - 1) AS BIGINT)) % {k} END"


def _cuts(k: int, vertices: int = 9, tag: str = "") -> str:
    return f"""SELECT id, sum(CASE WHEN ({_own(k, "i")}) <> ({_own(k, "j")}) THEN w ELSE 0 END) AS cut
      FROM generate_series(0, {k ** (vertices - 1) - 1}) AS g(id), link{tag} GROUP BY id"""


def _exhaustive(k: int, vertices: int = 9, tag: str = "") -> str:
    return f"SELECT CAST({k} AS BIGINT) AS k, CAST(max(cut) AS DOUBLE) AS best_cut FROM ({_cuts(k, vertices, tag)})"


def _inertias(k: int, vertices: int = 9) -> str:
    """Every labelling of the small lattice: sum of squares less squared sums over weights, per cluster and axis."""
    terms = " + ".join(f"sum(CAST(cnt * {a} * {a} AS DOUBLE)) - pow(sum(CAST(cnt * {a} AS DOUBLE)), 2) / sum(cnt)" for a in ("r", "f"))
    return f"""SELECT id, sum(part) AS inertia FROM (
      SELECT id, {_own(k, "v")} AS cluster, {terms} AS part FROM generate_series(0, {k ** (vertices - 1) - 1}) AS g(id), small GROUP BY ALL) GROUP BY id"""


def _least_squares(k: int) -> str:
    return f"SELECT CAST({k} AS BIGINT) AS k, round(min(inertia), 6) AS inertia FROM ({_inertias(k)})"


def _partitions(name: str, k_values: tuple[int, ...], best: str, numbered: Callable[[int], str], tag: str = "") -> str:
    """Stage ``name`` (k, v, r, f, cnt, cluster): per k the partition of nine cells that ``best`` takes of the ``numbered`` ones, clusters named by their least cell."""
    stages = [f"{name}{k} AS MATERIALIZED (SELECT {best} AS id FROM ({numbered(k)}))" for k in k_values]
    rows = " UNION ALL ".join(
        f"SELECT CAST({k} AS BIGINT) AS k, v, r, f, cnt, min(v) OVER (PARTITION BY {_own(k, 'v')}) AS cluster FROM small{tag}, {name}{k}" for k in k_values)
    return ", ".join([*stages, f"{name} AS ({rows})"])


def _largest_cuts(name: str, k_values: tuple[int, ...], tag: str = "") -> str:
    return _partitions(name, k_values, "arg_max(id, cut)", lambda k: _cuts(k, tag=tag), tag)


def _small_gaps(name: str, labels: str, by: str = "k") -> str:
    """Stage ``name``: pairs of cells of each labelling, in the layout of ``gaps``."""
    same = " AND ".join(f"a.{c} = b.{c}" for c in by.split(", "))
    return f"""{name} AS (SELECT {", ".join(f"a.{c}" for c in by.split(", "))}, a.v AS i, b.v AS j, a.cluster AS ci, b.cluster AS cj, a.cnt AS ni, b.cnt AS nj,
      sqrt(CAST((a.r - b.r) * (a.r - b.r) + (a.f - b.f) * (a.f - b.f) AS DOUBLE)) AS euclidean FROM {labels} a JOIN {labels} b ON {same})"""


def _tree(cells: int = 9) -> str:
    """Stage ``tree`` (k, v, r, f, cnt, cluster): the nearest two clusters merge, step by step; a cluster goes by its least cell."""
    stages = ["step0 AS MATERIALIZED (SELECT *, v AS cluster FROM small)"]
    for i in range(cells - 2):
        centre = f"(SELECT cluster, sum(cnt) AS n, CAST(sum(cnt * r) AS DOUBLE) / sum(cnt) AS r, CAST(sum(cnt * f) AS DOUBLE) / sum(cnt) AS f FROM step{i} GROUP BY cluster)"
        stages.append(
            f"pair{i} AS MATERIALIZED (SELECT a.cluster AS kept, b.cluster AS gone FROM {centre} a JOIN {centre} b ON a.cluster < b.cluster "
            "ORDER BY round(a.n * b.n / (a.n + b.n) * (pow(a.r - b.r, 2) + pow(a.f - b.f, 2)), 9), kept, gone LIMIT 1)")
        stages.append(f"step{i + 1} AS MATERIALIZED (SELECT v, r, f, cnt, CASE WHEN cluster = gone THEN kept ELSE cluster END AS cluster FROM step{i} LEFT JOIN pair{i} ON true)")
    steps = " UNION ALL ".join(f"SELECT (SELECT count(DISTINCT cluster) FROM step{i}) AS k, v, r, f, cnt, cluster FROM step{i}" for i in range(cells - 1))
    return ", ".join([*stages, f"tree AS ({steps})"])


def _with(select: str, *stages: str) -> str:
    return "WITH " + ",\n".join([STAGES.strip(), *[s.strip() for s in stages]]) + "\n" + select


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    per_part = "SELECT SourceSheet, count(*) AS n_rows FROM tx GROUP BY SourceSheet"
    shared = "SELECT Invoice FROM tx WHERE SourceSheet = 'sheet1' INTERSECT SELECT Invoice FROM tx WHERE SourceSheet = 'sheet2'"

    q["a1_multi_part_load"] = _with(PER_COUNTRY.format("tx"))
    q["a2_part_tag"] = _with(per_part)
    q["a2_part_tag_in_one_scan"] = q["a2_part_tag"]
    q["a6_cache_after_a_change"] = _with("SELECT SourceSheet, CASE SourceSheet WHEN 'sheet2' THEN 2 ELSE 1 END * count(*) AS n_rows, SourceSheet = 'sheet2' AS rebuilt FROM tx GROUP BY SourceSheet")
    q["a3_shared_invoices"] = _with(shared)
    q["a4_header_normalisation"] = _with(
        f"SELECT StockCode, count(CustomerID) AS n_customers, {DATE.format('max(InvoiceDate)')} AS last_date FROM tx GROUP BY StockCode")
    q["a5_type_normalisation"] = _with(
        f"SELECT Country, count(CustomerID) AS n_known, max(CustomerID) AS max_customer, CAST(sum(Quantity) AS BIGINT) AS quantity, "
        f"CAST(sum(Price) AS DOUBLE) AS price, {DATE.format('min(InvoiceDate)')} AS first_date FROM tx GROUP BY Country")
    q["a6_cached_raw"] = _with(per_part)
    q["a7_clean_sink_scan"] = _with(
        f"SELECT Country AS country, count(*) AS n_rows, {DATE.format('max(InvoiceDate)')} AS last_date, CAST(sum(Total) AS DOUBLE) AS total FROM clean GROUP BY Country")
    q["a8_table_sink"] = _with(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ("dim_customer", "dim_product", "dim_invoice", "fact_line")))
    q["a9_mart_scan"] = _with(f"SELECT {RAW}, {SCORES} FROM mart")
    q["a10_named_reports"] = _with(
        f"""SELECT 'score_balance' AS report, axis || ' ' || CAST(score AS VARCHAR) AS entry, customers FROM ({_BALANCE})
        UNION ALL SELECT 'segment_values', segment, count(*) FROM seg GROUP BY segment
        UNION ALL SELECT 'churn_by_recency', churn_band, count(*) FROM band GROUP BY churn_band
        UNION ALL SELECT 'response_proxy', segment, count(*) FROM seg GROUP BY segment
        UNION ALL SELECT 'revenue_concentration', CAST(m_quintile AS VARCHAR), count(*) FROM quintile GROUP BY m_quintile""", _QUINTILE)
    q["a11_structure"] = _with(
        f"SELECT count(*) AS n_rows, CAST(9 AS BIGINT) AS n_columns, {DATE.format('min(InvoiceDate)')} AS first_date, {DATE.format('max(InvoiceDate)')} AS last_date FROM tx")

    kinds = [("Invoice", "string"), ("StockCode", "string"), ("Description", "string"), ("Quantity", "int"), ("InvoiceDate", "timestamp_ntz"),
             ("Price", "decimal(12,2)"), ("CustomerID", "bigint"), ("Country", "string"), ("SourceSheet", "string")]
    q["a11_column_types"] = _with(" UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS position, '{n}' AS column_name, '{t}' AS column_type, count({n}) AS n_values FROM tx" for i, (n, t) in enumerate(kinds)))

    q["p1_with_customer"] = _with(PER_COUNTRY.format("tx WHERE CustomerID IS NOT NULL"))
    q["p2_positive_quantity"] = _with(PER_COUNTRY.format("tx WHERE Quantity > 0"))
    q["p3_positive_price"] = _with(PER_COUNTRY.format("tx WHERE Price > 0"))
    q["p4_line_amount"] = _with(
        "SELECT Invoice, StockCode, CAST(Quantity AS BIGINT) AS Quantity, CAST(Price AS DOUBLE) AS Price, CAST(Quantity * Price AS DOUBLE) AS Total FROM tx")
    q["p5_score_matrix"] = _with('SELECT customer_id, l_score AS "L", r_score AS "R", f_score AS "F", m_score AS "M" FROM mart')
    q["p6_cancellation_flag"] = _with("SELECT DISTINCT Invoice, starts_with(Invoice, 'C') AS cancelled FROM tx")
    q["p7_letter_prefix"] = _with(
        "SELECT substr(Invoice, 1, 1) AS prefix, count(*) AS n_rows FROM tx WHERE regexp_matches(Invoice, '^[A-Za-z]') GROUP BY 1")
    q["p8_nonproduct_code"] = _with(
        "SELECT DISTINCT StockCode, NOT regexp_matches(StockCode, '^[0-9]{5}[A-Za-z]?$') AS nonproduct FROM tx")
    q["p9_named_segment"] = _with("SELECT customer_id, fm, segment FROM seg")
    even = "CAST(CASE WHEN (f_score + m_score) % 2 = 0 THEN (f_score + m_score) / 2 WHEN ((f_score + m_score - 1) / 2) % 2 = 0 THEN (f_score + m_score - 1) / 2 ELSE (f_score + m_score + 1) / 2 END AS BIGINT)"
    grid = "CASE WHEN r_score >= 4 THEN CASE WHEN fm >= 4 THEN 'Champions' WHEN fm = 3 THEN 'Loyal Customers' ELSE 'New / Promising' END WHEN r_score = 3 THEN CASE WHEN fm >= 3 THEN 'Loyal Customers' ELSE 'Potential Loyalist' END WHEN fm <= 2 THEN 'Hibernating / Lost' WHEN r_score = 1 AND fm >= 4 THEN 'Cannot Lose Them' ELSE 'At Risk' END"
    q["p10_named_segment_half_even"] = _with(
        f"SELECT customer_id, fm, {grid} AS segment FROM (SELECT *, {even} AS fm FROM mart)")
    q["p11_churn_band"] = _with("SELECT customer_id, churn_band FROM band")
    q["p12_indicators"] = _with(
        "SELECT segment, round(avg(CASE WHEN frequency > 1 THEN 1.0 ELSE 0.0 END), 6) AS repeat_share, round(avg(CASE WHEN recency <= 90 THEN 1.0 ELSE 0.0 END), 6) AS active_share FROM seg GROUP BY segment")
    q["p13_one_time_buyers"] = _with(
        "SELECT count(*) FILTER (frequency = 1) AS n_single_invoice, count(*) FILTER (length = 0) AS n_zero_length, round(100.0 * count(*) FILTER (length = 0) / count(*), 6) AS zero_length_pct FROM mart")
    q["p14_zero_negative"] = _with(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} < 0) AS n_negative, count(*) FILTER ({c} = 0) AS n_zero, count(*) FILTER ({c} <= 0) AS n_not_positive FROM tx"
        for c in ("Quantity", "Price")))
    both = "count(*) FILTER (Invoice LIKE 'C%') AS n_cancelled, count(*) FILTER (Quantity < 0) AS n_negative, count(*) FILTER (Invoice LIKE 'C%' AND Quantity < 0) AS n_both"
    q["p15_cancelled_and_negative"] = _with(f"SELECT {both} FROM tx")

    q["j1_lines_with_invoice"] = _with(
        f"SELECT customer_id, stock_code, count(*) AS n_lines, CAST(sum(amount) AS DOUBLE) AS amount, {DATE.format('max(invoice_date)')} AS last_date FROM sold GROUP BY customer_id, stock_code")
    q["j2_invoice_totals"] = _with(
        f"SELECT invoice_id, customer_id, {DATE.format('invoice_date')} AS invoice_date, CAST(round(sum(amount), 2) AS DOUBLE) AS invoice_total FROM sold GROUP BY invoice_id, customer_id, sold.invoice_date")
    q["j3_snapshot"] = _with(
        f"SELECT customer_id, {DATE.format('last_date')} AS last_date, {DATE.format('(SELECT max(closing) FROM habits)')} AS snapshot FROM buyers")
    fk = """SELECT 'dim_invoice' AS child, 'customer_id' AS key_column, 'dim_customer' AS parent, count(DISTINCT customer_id) AS n_keys, count(*) AS n_rows
              FROM dim_invoice WHERE customer_id NOT IN (SELECT customer_id FROM dim_customer)
            UNION ALL SELECT 'fact_line', 'invoice_id', 'dim_invoice', count(DISTINCT invoice_id), count(*) FROM {0} WHERE invoice_id NOT IN (SELECT invoice_id FROM dim_invoice)
            UNION ALL SELECT 'fact_line', 'stock_code', 'dim_product', count(DISTINCT stock_code), count(*) FROM {0} WHERE stock_code NOT IN (SELECT stock_code FROM dim_product)"""
    q["j4_foreign_keys"] = _with(fk.format("fact_line"))
    q["j4_foreign_keys_of_raw_lines"] = _with(fk.format("raw_fact"), _DIM_RAW)
    q["j5_key_checks"] = _with(
        """SELECT 'dim_customer' AS table_name, 'customer_id' AS column_name, 'unique' AS rule, count(*) AS n_violations FROM (SELECT DISTINCT CustomerID FROM tx) WHERE CustomerID IS NULL
        UNION ALL SELECT 'dim_product', 'stock_code', 'unique', count(*) FROM (SELECT DISTINCT StockCode FROM tx) WHERE StockCode IS NULL
        UNION ALL SELECT 'dim_invoice', 'invoice_id', 'unique', count(*) FROM (SELECT DISTINCT Invoice FROM tx) WHERE Invoice IS NULL
        UNION ALL SELECT 'fact_line', 'line_id', 'unique', CAST(0 AS BIGINT)
        UNION ALL SELECT 'dim_invoice', 'customer_id', 'not null', count(*) FROM (SELECT Invoice, max(CustomerID) AS c FROM tx GROUP BY Invoice) WHERE c IS NULL
        UNION ALL SELECT 'dim_invoice', 'invoice_date', 'not null', count(*) FROM (SELECT Invoice, min(InvoiceDate) AS c FROM tx GROUP BY Invoice) WHERE c IS NULL
        UNION ALL SELECT 'fact_line', 'invoice_id', 'not null', count(*) FROM tx WHERE Invoice IS NULL
        UNION ALL SELECT 'fact_line', 'stock_code', 'not null', count(*) FROM tx WHERE StockCode IS NULL
        UNION ALL SELECT 'fact_line', 'quantity', 'not null', count(*) FROM tx WHERE Quantity IS NULL
        UNION ALL SELECT 'fact_line', 'price', 'not null', count(*) FROM tx WHERE Price IS NULL""")
    repeated = "(SELECT count(*) FROM (SELECT {0} AS key, count(*) AS n FROM ({1}) GROUP BY {0}) WHERE n > 1 OR key IS NULL)"
    pairs = {
        "dim_customer": ("customer_id", "CustomerID", "SELECT DISTINCT CustomerID, Country FROM tx"), "dim_product": ("stock_code", "StockCode", "SELECT DISTINCT StockCode, Description FROM tx"),
        "dim_invoice": ("invoice_id", "Invoice", "SELECT DISTINCT Invoice, CustomerID, InvoiceDate FROM tx"), "fact_line": ("line_id", "line_id", "SELECT Invoice || ' ' || StockCode AS line_id FROM tx")}
    unfolded = [f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'unique' AS rule, {repeated.format(k, rows)} AS n_violations" for t, (c, k, rows) in pairs.items()]
    unfolded += [f"SELECT 'dim_invoice', '{c}', 'not null', count(*) FROM ({pairs['dim_invoice'][2]}) WHERE {k} IS NULL" for c, k in (("customer_id", "CustomerID"), ("invoice_date", "InvoiceDate"))]
    unfolded += [f"SELECT 'fact_line', '{c}', 'not null', count(*) FROM tx WHERE {k} IS NULL" for c, k in (("invoice_id", "Invoice"), ("stock_code", "StockCode"), ("quantity", "Quantity"), ("price", "Price"))]
    q["j5_key_checks_unfolded"] = _with(" UNION ALL ".join(unfolded))
    q["j6_lift_labels"] = _with("SELECT customer_id, cluster FROM levels")
    q["j7_cell_pairs"] = _with(_pairs("rfm", "r_score f_score m_score", "euclidean"))
    q["j8_tuple_lookup"] = _with(
        "SELECT customer_id, n_l FROM mart JOIN (SELECT r_score, f_score, m_score, count(DISTINCT l_score) AS n_l FROM mart GROUP BY ALL) USING (r_score, f_score, m_score)")
    q["j9_align_labels"] = _with(
        "SELECT customer_id, cluster, recency, CAST(monetary AS DOUBLE) AS monetary FROM levels WHERE r_score > 1")
    q["j10_published_join"] = _with(
        "SELECT k, CAST(published AS DOUBLE) AS published, round(silhouette, 6) AS silhouette FROM published JOIN curve USING (k)".replace("SELECT k,", "SELECT CAST(k AS BIGINT) AS k,"),
        _silhouette("euclidean"), PUBLISHED)

    dedup = "SELECT Country, count(*) AS n_rows, CAST(sum(Quantity * Price) AS DOUBLE) AS total FROM {} GROUP BY Country"
    q["d1_deduplicate_with_part"] = _with(dedup.format("clean"))
    q["d1_deduplicate_without_part"] = _with(dedup.format("(SELECT DISTINCT * EXCLUDE (SourceSheet) FROM clean)"))
    q["d2_exact_duplicates"] = _with("SELECT (SELECT count(*) FROM tx) - (SELECT count(*) FROM (SELECT DISTINCT * FROM tx)) AS n_duplicates")
    q["d3_partial_duplicates"] = _with(
        "SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS n FROM tx GROUP BY Invoice, StockCode, Quantity, Price)")
    q["d4_distinct_cells"] = _with("SELECT rfm_cells, lrfm_cells FROM gain", _GAIN)

    q["g1_dim_customer"] = _with("SELECT customer_id, country FROM dim_customer")
    q["g2_dim_product"] = _with("SELECT stock_code, description FROM dim_product")
    q["g3_dim_invoice"] = _with(f"SELECT invoice_id, customer_id, {DATE.format('invoice_date')} AS invoice_date FROM dim_invoice")
    q["g4_fact_line"] = _with("SELECT invoice_id, stock_code, CAST(quantity AS BIGINT) AS quantity, CAST(price AS DOUBLE) AS price FROM fact_line")
    q["g5_rfml_calendar"] = _with(f"SELECT {RAW} FROM buyers")
    q["g6_rfml_elapsed"] = _with(f"SELECT {RAW} FROM elapsed", _ELAPSED)
    q["g7_score_balance"] = _with(_BALANCE)
    q["g8_segment_values"] = _with(_SEGMENTS)
    q["g9_churn_by_recency"] = _with(_BANDS)
    q["g10_response_proxy"] = _with(
        "SELECT segment, count(*) AS customers, round(100.0 * avg(CASE WHEN frequency > 1 THEN 1.0 ELSE 0.0 END), 1) AS repeat_rate_pct, "
        "round(100.0 * avg(CASE WHEN recency <= 90 THEN 1.0 ELSE 0.0 END), 1) AS active_rate_pct FROM seg GROUP BY segment")
    q["g11_revenue_concentration"] = _with(
        "SELECT m_quintile, count(*) AS customers, round(CAST(sum(monetary) AS DOUBLE), 0) AS total_revenue, "
        "round(100.0 * CAST(sum(monetary) AS DOUBLE) / CAST(sum(sum(monetary)) OVER () AS DOUBLE), 1) AS pct_revenue FROM quintile GROUP BY m_quintile", _QUINTILE)
    q["g12_missing_shares"] = _with(_missing())
    q["g13_distinct_counts"] = _with(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM tx" for c in ("Invoice", "StockCode", "Description", "CustomerID", "Country")))
    shares = "SELECT Country, count(*) AS n_rows, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM tx GROUP BY Country"
    q["g14_country_shares"] = _with(shares)
    q["g14_top_countries"] = _with(shares + " ORDER BY n_rows DESC, Country LIMIT 3")
    q["g14_named_countries"] = _with(
        "SELECT c AS Country, count(tx.Country) AS n_rows, CASE WHEN count(tx.Country) > 0 THEN round(count(tx.Country) / CAST((SELECT count(Country) FROM tx) AS DOUBLE), 6) END AS share "
        "FROM (VALUES ('UNITED KINGDOM'), ('ATLANTIS')) AS v(c) LEFT JOIN tx ON tx.Country = c GROUP BY c")
    q["g15_missing_customer_countries"] = _with(
        "SELECT Country, count(*) AS n_rows FROM tx WHERE CustomerID IS NULL GROUP BY Country ORDER BY n_rows DESC, Country LIMIT 3")
    q["g16_cancellation_summary"] = _with(
        f"SELECT count(*) AS n_rows, {both}, round(100.0 * count(*) FILTER (Invoice LIKE 'C%') / count(*), 4) AS cancelled_pct FROM tx")
    nonproduct = "NOT regexp_matches(StockCode, '^[0-9]{5}[A-Za-z]?$')"
    q["g17_nonproduct_summary"] = _with(f"SELECT count(DISTINCT StockCode) AS n_codes, count(*) AS n_rows FROM tx WHERE {nonproduct}")
    q["g17_nonproduct_examples"] = _with(f"SELECT DISTINCT StockCode FROM tx WHERE {nonproduct} ORDER BY StockCode LIMIT 15")
    q["g18_nonproduct_revenue"] = _with(
        f"SELECT count(*) FILTER ({nonproduct}) AS n_rows, round(100 * CAST(sum(revenue) FILTER ({nonproduct}) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE), 6) AS revenue_pct FROM pos")
    by_key = "SELECT {0}, sum(revenue) AS revenue FROM pos WHERE {0} IS NOT NULL GROUP BY {0}"
    q["g19_revenue_per_customer"] = _with("SELECT CustomerID, CAST(sum(revenue) AS DOUBLE) AS revenue FROM pos WHERE CustomerID IS NOT NULL GROUP BY CustomerID")
    q["g19_revenue_per_product"] = _with("SELECT StockCode, CAST(sum(revenue) AS DOUBLE) AS revenue FROM pos GROUP BY StockCode")
    per_customer = "SELECT CustomerID, count(DISTINCT Invoice) AS n_invoices FROM pos WHERE CustomerID IS NOT NULL GROUP BY CustomerID"
    q["g19_invoices_per_customer"] = _with(per_customer)
    q["g20_herfindahl"] = _with("SELECT count(*) AS n_countries, round(sum(share * share), 6) AS herfindahl FROM (SELECT count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM tx GROUP BY Country)")
    q["g21_invoices_summary"] = _with(
        f"""SELECT count(*) AS n_customers, round(max(m), 6) AS mean_invoices, median(v) AS median_invoices,
        round(avg((v - m) ** 3) / avg((v - m) ** 2) ** 1.5, 6) AS skew_invoices, count(*) FILTER (v = 1) AS n_one_time,
        round(100.0 * count(*) FILTER (v = 1) / count(*), 6) AS one_time_pct
        FROM (SELECT CAST(n_invoices AS DOUBLE) AS v, avg(CAST(n_invoices AS DOUBLE)) OVER () AS m FROM ({per_customer}))""")
    months = """months AS (SELECT strftime(m, '%Y-%m') AS month, coalesce(n, 0) AS n_rows FROM
        (SELECT unnest(generate_series(min(date_trunc('month', InvoiceDate)), max(date_trunc('month', InvoiceDate)), INTERVAL 1 MONTH)) AS m FROM tx)
        LEFT JOIN (SELECT date_trunc('month', InvoiceDate) AS m, count(*) AS n FROM tx GROUP BY 1) USING (m))"""
    q["g22_monthly_rows"] = _with("SELECT month, CAST(n_rows AS BIGINT) AS n_rows FROM months", months)
    q["g22_monthly_balance"] = _with(
        "SELECT CAST(min(n_rows) AS BIGINT) AS min_rows, CAST(max(n_rows) AS BIGINT) AS max_rows, (SELECT month FROM months ORDER BY n_rows DESC, month LIMIT 1) AS peak_month, count(*) AS n_months FROM months", months)
    q["g23_cleaning_log"] = _with(
        """SELECT rule, rows_left, coalesce(lag(rows_left) OVER (ORDER BY rule), rows_left) - rows_left AS rows_removed FROM steps""",
        """steps AS (
        SELECT '0 raw rows' AS rule, count(*) AS rows_left FROM tx
        UNION ALL SELECT '1 drop missing CustomerID', count(*) FROM tx WHERE CustomerID IS NOT NULL
        UNION ALL SELECT '2 drop Quantity<=0', count(*) FROM tx WHERE CustomerID IS NOT NULL AND Quantity > 0
        UNION ALL SELECT '3 drop Price<=0', count(*) FROM tx WHERE CustomerID IS NOT NULL AND Quantity > 0 AND Price > 0
        UNION ALL SELECT '4 drop exact duplicates', count(*) FROM clean)""")
    q["g24_reconciliation"] = _with(
        "SELECT measure, measured, CAST(published AS BIGINT) AS published, CASE WHEN measured = published THEN 'MATCH' ELSE 'CHECK' END AS verdict FROM ("
        "SELECT 'line_items' AS measure, count(*) AS measured, 805549 AS published FROM clean "
        "UNION ALL SELECT 'invoices', count(DISTINCT Invoice), 79104 FROM clean UNION ALL SELECT 'customers', count(DISTINCT CustomerID), 5878 FROM clean)")
    q["g24_mart_means"] = _with(
        "SELECT count(*) AS customers, round(avg(recency), 2) AS r_mean, round(avg(frequency), 2) AS f_mean, round(CAST(sum(monetary) AS DOUBLE) / count(*), 2) AS m_mean, round(avg(length), 2) AS l_mean FROM mart")
    q["g25_cluster_profile"] = _with(_profile())
    q["g26_mean_scores"] = _with(_MEAN_SCORES)
    q["g26_mean_scores_long"] = _with(" UNION ALL ".join(
        f"SELECT cluster, '{v}' AS metric, {v.lower()}_score AS score FROM ({_MEAN_SCORES})" for v in "LRFM"))
    q["g27_volume_value"] = _with(_volume())

    q["w1_ntile_scores"] = _with(f"SELECT {RAW}, {SCORES} FROM mart")
    q["w2_rank_cut_scores"] = _with(_rank_cut(), _ELAPSED)
    q["w3_monetary_quintile"] = _with(
        "SELECT m_quintile, count(*) AS customers, CAST(min(monetary) AS DOUBLE) AS least, CAST(max(monetary) AS DOUBLE) AS most FROM quintile GROUP BY m_quintile", _QUINTILE)
    q["w4_share_of_total"] = _with(f"SELECT segment, pct_customers, pct_revenue FROM ({_SEGMENTS})")
    q["w5_truncated_rank"] = _with(
        f"SELECT churn_band, pace, CAST(floor(rank() OVER (ORDER BY pace DESC) + (count(*) OVER (PARTITION BY pace) - 1) / 2.0) AS BIGINT) AS rank FROM (SELECT churn_band, round(avg_frequency / 5) AS pace FROM ({_BANDS}))")
    q["w6_pareto_curve"] = _with(
        "SELECT row_number() OVER w AS position, round(100.0 * row_number() OVER w / CAST(count(*) OVER () AS DOUBLE), 6) AS customers_pct, "
        "round(100.0 * CAST(sum(monetary) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) / CAST(sum(monetary) OVER () AS DOUBLE), 6) AS revenue_pct FROM mart WINDOW w AS (ORDER BY monetary DESC, customer_id)")
    q["w7_gini_customers"] = _with(_gini("pos", "CustomerID"))
    q["w7_gini_products"] = _with(_gini("pos", "StockCode"))
    q["w8_average_ranks"] = _with("SELECT customer_id, " + ", ".join(
        f"CAST({_ranks('mart', c)} AS DOUBLE) AS {c}_rank" for c in ("recency", "frequency", "monetary", "length")) + " FROM mart")

    q["t1_report_order"] = _with("SELECT segment, round(CAST(sum(monetary) AS DOUBLE), 0) AS total_revenue FROM seg GROUP BY segment ORDER BY total_revenue DESC")
    q["t2_top_products"] = _with(_top(by_key.format("StockCode").replace("revenue FROM", "x FROM"), "StockCode", "10", "top10_pct"))
    q["t3_top_percent_customers"] = _with(_top(by_key.format("CustomerID").replace("revenue FROM", "x FROM"), "CustomerID", "greatest(1, n // 100)", "top1_pct"))
    q["t4_top_fifth_customers"] = _with(_top("SELECT monetary AS x FROM mart", "customer_id", "floor(0.2 * n) + 1", "top20_pct"))
    q["t5_best_k"] = _with("SELECT 'RFM' AS variables, CAST(k AS BIGINT) AS k, round(silhouette, 6) AS silhouette FROM curve ORDER BY silhouette DESC, k LIMIT 1", _silhouette("euclidean"))
    q["t6_largest_split_cell"] = _with(
        "SELECT r_score, f_score, m_score, count(DISTINCT l_score) AS n_l, count(*) AS customers FROM mart GROUP BY r_score, f_score, m_score HAVING count(DISTINCT l_score) >= 2 ORDER BY customers DESC, r_score, f_score, m_score LIMIT 1")

    q["u1_union_of_histograms"] = _with(_BALANCE)
    q["u2_row_stacking"] = _with("SELECT SourceSheet, Country, count(*) AS n_rows FROM tx GROUP BY SourceSheet, Country")
    q["u3_key_intersection"] = _with(f"SELECT count(*) AS n_shared FROM ({shared})")

    q["f1_calendar_days"] = _with("SELECT customer_id, length AS days FROM buyers")
    q["f2_elapsed_days"] = _with("SELECT customer_id, length AS days FROM elapsed", _ELAPSED)
    q["f3_date_text"] = _with(f"SELECT invoice_id, {DATE.format('invoice_date')} AS moment, strftime(invoice_date, '%Y-%m') AS month FROM dim_invoice")
    q["f4_rounding"] = _with(f"SELECT CAST(cell_id AS BIGINT) AS cell_id, CAST(round((f_score + m_score) / 2.0) AS BIGINT) AS half_away, {even} AS half_even FROM rfm")
    q["f5_casts"] = _with("SELECT customer_id, CAST(trunc(monetary) AS BIGINT) AS whole, CAST(recency // 7 AS BIGINT) AS weeks FROM mart")
    q["f6_strings"] = _with(
        "SELECT DISTINCT StockCode, Description, substr(StockCode, 1, 1) AS first_char, starts_with(StockCode, 'P') AS starts_p, "
        f"regexp_matches(StockCode, '^[A-Za-z]') AS is_alpha, {nonproduct} AS nonproduct, replace(trim(Description), ' ', '') AS squeezed FROM tx")
    q["f7_math"] = _with(
        "SELECT customer_id, abs(recency - length) AS gap, round(sqrt(CAST(recency AS DOUBLE)), 5) AS root, length * length AS square, round(ln(1 + CAST(monetary AS DOUBLE)), 5) AS log_monetary FROM mart")
    q["f8_null_and_guard"] = _with(
        "SELECT StockCode, count(*) FILTER (CustomerID IS NULL) AS n_missing, CASE WHEN sum(Price) = 0 THEN CAST('NaN' AS DOUBLE) ELSE "
        "round(CAST(sum(CASE WHEN CustomerID IS NULL THEN Price ELSE 0 END) AS DOUBLE) / CAST(sum(Price) AS DOUBLE), 6) END AS missing_price_share FROM tx GROUP BY StockCode")

    q["s1_shape_of_lines"] = _with(_shape("tx", ["Quantity", "Price"]))
    q["s1_shape_of_customers"] = _with(_shape("mart", ["recency", "frequency", "monetary", "length"]))
    q["s2_extremes"] = _with(" UNION ALL ".join(
        f"SELECT '{c}' AS axis, round(quantile_cont(CAST({c} AS DOUBLE), 0.99), 6) AS p99, CAST(max({c}) AS DOUBLE) AS max FROM pos" for c in ("Quantity", "Price")))
    q["s3_spearman_raw"] = _with(_SPEAR_RAW[1], _SPEAR_RAW[0])
    q["s3_spearman_scores"] = _with(_SPEAR_SCORES[1], _SPEAR_SCORES[0])
    q["s4_histogram"] = _with(_histogram("CAST(recency AS DOUBLE)"))
    q["s4_histogram_log"] = _with(_histogram("ln(1 + CAST(monetary AS DOUBLE))"))
    q["s5_box_statistics"] = _with(_boxes())
    q["s6_scatter"] = _with("SELECT customer_id, CAST(recency AS DOUBLE) AS x, CAST(monetary AS DOUBLE) AS y, cluster FROM levels")

    q["e1_redundancy"] = _with("SELECT l_redundancy, rfm_redundancy FROM redundancy", _SPEAR_SCORES[0], _REDUNDANCY)
    q["e2_resolution_gain"] = _with("SELECT rfm_cells, lrfm_cells, round(CAST(lrfm_cells AS DOUBLE) / rfm_cells, 6) AS gain FROM gain", _GAIN)
    q["e3_split_cells"] = _with(
        "SELECT count(*) AS rfm_cells, count(*) FILTER (n_l > 1) AS split_cells, round(100.0 * count(*) FILTER (n_l > 1) / count(*), 6) AS split_cells_pct, "
        "round(100.0 * CAST(sum(CASE WHEN n_l > 1 THEN c ELSE 0 END) AS DOUBLE) / CAST(sum(c) AS DOUBLE), 6) AS split_customers_pct FROM (SELECT count(DISTINCT l_score) AS n_l, count(*) AS c FROM mart GROUP BY r_score, f_score, m_score)")
    q["e4_example_cell"] = _with(
        "SELECT r_score, f_score, m_score, l_score, cnt AS n, length_min, round(length_mean, 6) AS length_mean, length_max FROM lrfm JOIN top USING (r_score, f_score, m_score)",
        "top AS (SELECT r_score, f_score, m_score FROM mart GROUP BY ALL HAVING count(DISTINCT l_score) >= 2 ORDER BY count(*) DESC, r_score, f_score, m_score LIMIT 1)")
    q["e5_verdict"] = _with(
        "SELECT l_redundancy, rfm_redundancy, round(CAST(lrfm_cells AS DOUBLE) / rfm_cells, 6) AS gain, "
        "CASE WHEN CAST(lrfm_cells AS DOUBLE) / rfm_cells > 1.5 AND l_redundancy <= rfm_redundancy + 0.1 THEN 'GO' ELSE 'CAUTION' END AS verdict FROM redundancy, gain",
        _SPEAR_SCORES[0], _REDUNDANCY, _GAIN)

    q["k1_reduce_cells"] = _with("SELECT l_score, r_score, f_score, m_score, cnt, CAST(cell_id AS BIGINT) AS cell_id FROM lrfm")
    q["k2_edge_weights"] = _with(_pairs("lrfm", "l_score r_score f_score m_score", "manhattan"))
    q["k2_edge_count"] = _with(f"SELECT count(*) AS n_edges, sum(w) AS weight FROM ({_pairs('rfm', 'r_score f_score m_score', 'manhattan')})")
    cut = "sum(ni * nj * {0}) / 2.0 AS total, sum(CASE WHEN ci = cj THEN ni * nj * {0} ELSE 0 END) / 2.0 AS intra"
    q["k3_cut_manhattan"] = _with(
        f"SELECT CAST(k AS BIGINT) AS k, CAST(total AS DOUBLE) AS total, CAST(intra AS DOUBLE) AS intra, CAST(total - intra AS DOUBLE) AS cut FROM (SELECT k, {cut.format('manhattan')} FROM gaps GROUP BY k)")
    q["k3_cut_euclidean"] = _with(
        f"SELECT CAST(k AS BIGINT) AS k, round((total - intra) / total, 6) AS cut_share FROM (SELECT k, {cut.format('euclidean')} FROM gaps GROUP BY k)")
    q["k10_exhaustive_cut"] = _with(" UNION ALL ".join(_exhaustive(k) for k in (2, 3, 4)), _EXHAUSTIVE)
    q["k4_local_search_optimum"] = q["k10_exhaustive_cut"]
    q["k5_exchange_optimum"] = q["k10_exhaustive_cut"]
    best = " UNION ALL ".join(_exhaustive(k) for k in (2, 3, 4))
    for name in ("k4_relocation_optimum", "k5_exchange_at_scale_optimum"):
        q[name] = _with(f"SELECT k, best_cut, true AS settled FROM ({best})", _EXHAUSTIVE)
    q["k7_gap"] = _with(f"SELECT k, best_cut, true AS settled, true AS bounded FROM ({best})", _EXHAUSTIVE)
    q["k15_kmeans_inertia"] = _with(" UNION ALL ".join(_least_squares(k) for k in (2, 3)), _EXHAUSTIVE)
    sets = "(VALUES ('RFM'), ('LRFM')) AS v(variables), generate_series(2, 10) AS g(k)"
    q["k4_convergence"] = f"SELECT variables, CAST(k AS BIGINT) AS k, CAST(200 AS BIGINT) AS restarts, CAST(200 AS BIGINT) AS settled FROM {sets}"
    q["k7_objective_of_full_cells"] = _with(f"SELECT variables, CAST(k AS BIGINT) AS k, (SELECT count(*) FROM mart) AS customers, CAST(0 AS DOUBLE) AS difference FROM {sets}")
    for name, same in (("w1_ntile_scores_buckets", "w1_ntile_scores"), ("w2_rank_cut_scores_buckets", "w2_rank_cut_scores"), ("w3_monetary_quintile_buckets", "w3_monetary_quintile"),
                       ("w6_pareto_curve_buckets", "w6_pareto_curve"), ("w7_gini_customers_buckets", "w7_gini_customers"), ("w8_average_ranks_shuffled", "w8_average_ranks"),
                       ("s2_extremes_buckets", "s2_extremes"), ("s3_spearman_raw_shuffled", "s3_spearman_raw"), ("j6_lift_labels_shuffled", "j6_lift_labels")):
        q[name] = q[same]
    q["k6_multi_start_optimum"] = _with(_exhaustive(2, 16), _lattice(4))
    q["k7_objective_recomputed"] = _with(
        "SELECT k, best_cut, best_cut AS label_cut FROM (" + " UNION ALL ".join(_exhaustive(k) for k in (2, 3, 4)) + ")", _EXHAUSTIVE)
    three = (_EXHAUSTIVE, _largest_cuts("cut", (3,)), "chosen AS (SELECT scored.*, cluster FROM scored JOIN cut USING (r, f))")
    q["k7_segment_customers_optimum"] = _with("SELECT customer_id, CAST(cluster AS BIGINT) AS cluster FROM chosen", *three)
    q["g25_profile_of_optimum"] = _with(f"SELECT * REPLACE (CAST(cluster AS BIGINT) AS cluster) FROM ({_profile('chosen')})", *three)
    q["g27_volume_value_of_optimum"] = _with(f"SELECT * REPLACE (CAST(cluster AS BIGINT) AS cluster) FROM ({_volume('chosen')})", *three)
    q["s5_boxes_of_optimum"] = _with(f"SELECT * REPLACE (CAST(cluster AS BIGINT) AS cluster) FROM ({_boxes('chosen')})", *three)
    q["k13_loyalty_of_optimum"] = _with(
        """SELECT CAST(cluster AS BIGINT) AS cluster, round(r_score, 6) AS r_score, round(f_score, 6) AS f_score, round(distance, 6) AS distance,
        CAST(floor(rank() OVER (ORDER BY distance DESC) + (count(*) OVER (PARTITION BY distance) - 1) / 2.0) AS BIGINT) AS rank FROM (
        SELECT cluster, avg(CAST(r AS DOUBLE)) AS r_score, avg(CAST(f AS DOUBLE)) AS f_score, round(sqrt(avg(CAST(r AS DOUBLE)) ** 2 + avg(CAST(f AS DOUBLE)) ** 2), 9) AS distance FROM chosen GROUP BY cluster)""", *three)
    swept = (_EXHAUSTIVE, _largest_cuts("cut", (2, 3)), _small_gaps("small_gaps", "cut"), _silhouette("euclidean", "small_gaps"))
    q["k8_sweep_optimum"] = _with(
        f"""SELECT 'RF' AS variables, k, best_cut AS objective, true AS settled, n_cells, n_clusters, round(silhouette, 6) AS silhouette
        FROM ({best}) JOIN curve USING (k) JOIN (SELECT k, count(*) AS n_cells, count(DISTINCT cluster) AS n_clusters FROM cut GROUP BY k) USING (k)""", *swept)
    q["k19_deviation_of_optimum"] = _with(
        "SELECT round(avg(abs(silhouette - published)), 6) AS mean_delta, round(max(abs(silhouette - published)), 6) AS max_delta, CASE WHEN avg(abs(silhouette - published)) < 0.03 THEN 'CONFIRMED' ELSE 'CHECK' END AS verdict FROM curve JOIN published USING (k)",
        *swept, PUBLISHED)
    beside = f"""SELECT 'RF' AS pair, * FROM ({best}) UNION ALL SELECT 'FM', * FROM ({" UNION ALL ".join(_exhaustive(k, tag="_fm") for k in (2, 3, 4))})"""
    q["k9_side_by_side_optimum"] = _with(
        f"""SELECT k, {", ".join(f'max(CASE WHEN pair = {p!r} THEN best_cut END) AS "{p}"' for p in ("RF", "FM"))} FROM ({beside}) GROUP BY k""",
        _EXHAUSTIVE, _lattice(3, "monetary", "frequency", "_fm"))
    q["k11_robustness_optimum"] = _with(
        f"SELECT CAST(budget AS BIGINT) AS budget, best_cut, best_cut AS worst_cut, CAST(100 AS DOUBLE) AS hit_pct, true AS settled FROM ({_exhaustive(3)}), (VALUES (50), (200)) AS b(budget)", _EXHAUSTIVE)
    q["k16_ward_labels"] = _with("SELECT k, CAST(v AS BIGINT) AS cell_id, cnt, CAST(cluster AS BIGINT) AS cluster FROM tree WHERE k BETWEEN 2 AND 8", _EXHAUSTIVE, _tree())
    methods = {"max-k-cut": "cut", "K-means": "squares", "Ward": "tree"}
    columns = ", ".join(f'round(max(CASE WHEN method = \'{m}\' THEN silhouette END), 6) AS "{m}"' for m in methods)
    q["k18_method_silhouettes_optimum"] = _with(
        f"SELECT 'RF' AS variables, k, {columns} FROM curve GROUP BY k", _EXHAUSTIVE, _tree(), _largest_cuts("cut", (2, 3)),
        _partitions("squares", (2, 3), "arg_min(id, inertia)", _inertias),
        "methods AS (" + " UNION ALL ".join(f"SELECT '{m}' AS method, k, v, r, f, cnt, cluster FROM {t} WHERE k <= 3" for m, t in methods.items()) + ")",
        _small_gaps("small_gaps", "methods", "method, k"), _silhouette("euclidean", "small_gaps", "method, k"))
    q["k12_silhouette"] = _with("SELECT CAST(k AS BIGINT) AS k, round(silhouette, 6) AS silhouette FROM curve", _silhouette("euclidean"))
    q["k13_loyalty_ranking"] = _with(
        "SELECT cluster, round(r_score, 6) AS r_score, round(f_score, 6) AS f_score, round(m_score, 6) AS m_score, round(l_score, 6) AS l_score, round(distance, 6) AS distance, rank FROM loyal", _LOYALTY)
    q["k14_loyalty_segments"] = _with(
        "SELECT cluster, CASE rank WHEN 1 THEN 'Very high loyalty' WHEN 2 THEN 'High loyalty' WHEN 3 THEN 'Medium loyalty' WHEN 4 THEN 'Low loyalty' ELSE 'rank ' || CAST(rank AS VARCHAR) END AS segment, customers FROM loyal", _LOYALTY)
    q["k19_deviation"] = _with(
        "SELECT round(avg(abs(silhouette - published)), 6) AS mean_delta, round(max(abs(silhouette - published)), 6) AS max_delta, CASE WHEN avg(abs(silhouette - published)) < 0.03 THEN 'CONFIRMED' ELSE 'CHECK' END AS verdict FROM curve JOIN published USING (k)",
        _silhouette("euclidean"), PUBLISHED)

    q["x1_monthly_revenue"] = _with("SELECT strftime(InvoiceDate, '%Y-%m') AS month, CAST(sum(revenue) AS DOUBLE) AS revenue, count(DISTINCT Invoice) AS n_invoices FROM pos GROUP BY 1")
    q["x2_junk_descriptions"] = _with("SELECT Description, count(*) AS n_rows FROM tx WHERE Description IN ('?', 'damaged', 'check') GROUP BY Description")
    q["x3_matched_cancellations"] = _with(
        f"""SELECT c.CustomerID, c.StockCode, {DATE.format('c.InvoiceDate')} AS InvoiceDate, c.n_cancelled, {DATE.format('max(s.InvoiceDate)')} AS sale_date
        FROM (SELECT CustomerID, StockCode, InvoiceDate, count(*) AS n_cancelled FROM tx WHERE CustomerID IS NOT NULL AND Invoice LIKE 'C%' AND Quantity <> 0 GROUP BY ALL) c
        LEFT JOIN (SELECT CustomerID, StockCode, InvoiceDate FROM tx WHERE Invoice NOT LIKE 'C%' AND Quantity > 0) s
          ON c.CustomerID = s.CustomerID AND c.StockCode = s.StockCode AND s.InvoiceDate <= c.InvoiceDate
        GROUP BY c.CustomerID, c.StockCode, c.InvoiceDate, c.n_cancelled""")
    q["x3_matched_quantities"] = _with(
        f"""SELECT CustomerID, StockCode, {DATE.format('cancelled_at')} AS cancelled_at, {DATE.format('sold_at')} AS sold_at, CAST(quantity AS BIGINT) AS quantity FROM (
          SELECT c.CustomerID, c.StockCode, c.moment AS cancelled_at, s.moment AS sold_at, least(s.s, c.taken) - greatest(s.s - s.sold, c.before) AS quantity
          FROM moved c JOIN moved s ON c.CustomerID = s.CustomerID AND c.StockCode = s.StockCode AND s.s - s.sold < c.taken AND s.s > c.before
          WHERE c.taken > c.before AND s.sold > 0
          UNION ALL SELECT CustomerID, StockCode, moment, NULL, gone - (taken - before) FROM moved WHERE gone > taken - before)""", """
moments AS (SELECT CustomerID, StockCode, InvoiceDate AS moment, sum(CASE WHEN Invoice LIKE 'C%' THEN 0 ELSE Quantity END) AS sold, sum(CASE WHEN Invoice LIKE 'C%' THEN abs(Quantity) ELSE 0 END) AS gone
  FROM tx WHERE CustomerID IS NOT NULL AND ((Invoice LIKE 'C%' AND Quantity <> 0) OR Quantity > 0) GROUP BY ALL),
running AS (SELECT *, sum(sold) OVER w AS s, sum(gone) OVER w AS q FROM moments WINDOW w AS (PARTITION BY CustomerID, StockCode ORDER BY moment)),
stocked AS (SELECT *, q + least(0, min(s - q) OVER (PARTITION BY CustomerID, StockCode ORDER BY moment)) AS taken FROM running),
moved AS (SELECT *, coalesce(lag(taken) OVER (PARTITION BY CustomerID, StockCode ORDER BY moment), 0) AS before FROM stocked)
""")
    q["x4_missing_customer_months"] = _with("SELECT strftime(InvoiceDate, '%Y-%m') AS month, count(*) AS n_rows, count(*) FILTER (CustomerID IS NULL) AS n_missing FROM tx GROUP BY 1")
    q["x5_silhouette_manhattan"] = _with("SELECT CAST(k AS BIGINT) AS k, round(silhouette, 6) AS silhouette FROM curve", _silhouette("manhattan"))
    q["x6_length_since_first"] = _with("SELECT customer_id, date_diff('day', CAST(first_date AS DATE), CAST((SELECT max(closing) FROM habits) AS DATE)) AS length FROM buyers")
    q["x7_lowest_bin_scores"] = _with(_lowest_bin())
    q["s6_bounded_scatter"] = _with(
        "SELECT cluster, customer_id, CAST(recency AS DOUBLE) AS x, CAST(monetary AS DOUBLE) AS y FROM levels QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY md5('42:' || CAST(customer_id AS VARCHAR)), customer_id) <= 100")
    counted = ("Invoice", "StockCode", "Description", "CustomerID", "Country")
    q["g13_distinct_sketches"] = _with(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, true AS within FROM tx" for c in counted))
    q["g13_distinct_sketches_by_part"] = _with(" UNION ALL ".join(f"SELECT SourceSheet, '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, true AS within FROM tx GROUP BY SourceSheet" for c in counted))
    for name, same in (("a8_bucketed_sink", "a8_table_sink"), ("j1_lines_with_invoice_bucketed", "j1_lines_with_invoice"), ("j2_invoice_totals_bucketed", "j2_invoice_totals"),
                       ("a10_sql_reports", "a10_named_reports"), ("g10_response_proxy_sql", "g10_response_proxy")):
        q[name] = q[same]
    q["x8_scatter_length_recency"] = _with("SELECT customer_id, CAST(length AS DOUBLE) AS x, CAST(recency AS DOUBLE) AS y FROM mart")
    return q
