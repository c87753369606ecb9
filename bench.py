"""Bench of the headline queries: prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Every
query is run whole and written to the no-op sink; the time includes planning
and all passes. The first run of a query warms up, the second one counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loanloom.operators import metrics  # noqa: E402
from loanloom.plans.registry import ORACLE, QUERIES  # noqa: E402
from loanloom.session import local_session  # noqa: E402

HEADLINE = [
    "flagship_oof_auc", "b01_missing_rates", "b06_numeric_summary", "b09_default_rates",
    "c02_median_impute", "c11_monthly_payment", "c28_amount_rank", "d01_frequency", "d05_oof_target",
    "d06_woe", "d08_within_fold", "f01_stratified_folds", "g01_rank_in_group", "h01_roc_auc",
    "h07_evaluate", "h09_best_threshold", "h11_calibration", "j01_rank_average", "j03_weight_blend",
    "i10_cv_train",
]


def _sql_seconds(sf: str, cpus: str) -> dict[str, float]:
    """The same queries on a single-node SQL engine, for the columns beside ours."""
    import duckdb

    con = duckdb.connect()
    con.execute(f"SET threads = {cpus}")
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages"
              " benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    out = {}
    for q in HEADLINE:
        if q in ORACLE:
            start = time.perf_counter()
            con.execute(ORACLE[q]).fetchnumpy()
            out[q] = round(time.perf_counter() - start, 3)
    return out


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    rows = spark.read.parquet(f"{sf}/orders.parquet").count()
    seconds: dict[str, float] = {}
    for q in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[q](spark, sf).write.format("noop").mode("overwrite").save()
            seconds[q] = round(time.perf_counter() - start, 3)
        print(f"{q} {seconds[q]}", file=sys.stderr)
    folds = metrics.roc_auc(QUERIES["i10_cv_train"](spark, sf), "Target", "score", ["fold_id"]).collect()
    auc = round(sum(r["roc_auc"] for r in folds) / len(folds), 5)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf.rstrip("/")),
        "loan_rows_per_sec": {q: int(rows / s) for q, s in seconds.items()},
        "i10_mean_auc": auc, "single_node_sql_sec": _sql_seconds(sf, cpus)}))


if __name__ == "__main__":
    main()
