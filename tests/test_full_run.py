"""The whole run on the smallest data, and SQL text over its views."""

from patronage.plans.full_run import full_run
from patronage.plans.views import run_sql


def test_full_run(spark, stored_log, stored_mart, tmp_path):
    out = full_run(stored_log, str(tmp_path), k_values=[2, 4], restarts=20)
    n = stored_mart.count()
    assert out["customer_rfml"].exceptAll(stored_mart).count() == 0
    assert out["curve"].count() == 4
    assert out["labels_LRFM"].count() == n and out["labels_LRFM"].select("cluster").distinct().count() == 4
    assert out["profile_RFM"].agg({"customers": "sum"}).first()[0] == n
    assert sorted(r["rank"] for r in out["loyalty_LRFM"].collect()) == [1, 2, 3, 4]
    assert out["report_segment_values"].count() == 7

    texts = {
        "balance": "SELECT r_score, COUNT(*) AS n FROM customer_rfml GROUP BY r_score ORDER BY r_score;",
        "totals": "SELECT ROUND(SUM(invoice_total), 2) AS t FROM v_invoices",
        "lines": "SELECT SUM(quantity * price) AS t FROM fact_line f JOIN dim_invoice i ON f.invoice_id = i.invoice_id",
        "quintile": "SELECT q, COUNT(*) AS n FROM (SELECT NTILE(5) OVER (ORDER BY monetary DESC) AS q FROM customer_rfml) GROUP BY q",
    }
    answers = run_sql(spark, texts)
    assert list(answers) == list(texts)
    assert sum(r.n for r in answers["balance"].collect()) == n
    assert answers["totals"].first().t == answers["lines"].first().t
    assert answers["quintile"].count() == 5
