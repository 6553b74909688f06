"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the data
and the cores. Each query runs from the base tables to its full result.
"""

from __future__ import annotations

import json
import os
import time

from patronage.operators import graph, segment
from patronage.operators.scoring import LRFM, RFM
from patronage.plans import catalogue
from patronage.session import local_session
from patronage.sources.storage import materialise

HEADLINE = [
    "g8_segment_values", "g7_score_balance", "g9_churn_by_recency", "g10_response_proxy", "g11_revenue_concentration",
    "g23_cleaning_log", "g24_reconciliation", "g13_distinct_counts", "s1_shape_of_lines", "w7_gini_customers",
    "s3_spearman_raw", "e5_verdict", "j2_invoice_totals", "x3_matched_cancellations", "k12_silhouette",
    "k9_side_by_side", "k18_method_silhouettes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "patronage-bench")
    times: dict[str, float] = {}

    def timed(name, run) -> None:
        started = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - started, 3)

    catalogue.QUERIES["g8_segment_values"](spark, sf_dir).collect()  # start the JVM's engine
    for name in HEADLINE:
        timed(name, lambda name=name: catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    # the solver alone, as the published solve times count it: 200 restarts at k = 10
    mart = materialise(catalogue.mart(spark, sf_dir), "bench-mart")
    for variables in (RFM, LRFM):
        name = "".join(variables)
        cells = materialise(graph.reduce_cells(mart, variables), "bench-cells")
        timed(f"solve_{name}_k10_200_restarts",
              lambda c=cells, v=variables: segment.solve(c, v, [10]).write.format("noop").mode("overwrite").save())

    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
