"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lagfield.operators import panel as P  # noqa: E402
from lagfield.operators import shape as D  # noqa: E402
from lagfield.plans import catalog as Q  # noqa: E402
from lagfield.session import build_session, stored  # noqa: E402


def assign_segments(spark, d):
    """Regimes and nearest shape of every pair, with fixed medoids."""
    return D.segment_map(Q.panel(spark, d), Q.SCORE, Q._medoids(spark, d))


def pair_feature_table(spark, d):
    """All 82 features of every pair and month."""
    return Q.full_pair(spark, d).table


HEADLINE = {
    "panel_table": Q.panel,
    "zero_fill_panel": Q.zero_fill_panel,
    "densify_monthly": Q.densify_monthly,
    "product_feature_table": Q.product_feature_table,
    "pair_feature_table": pair_feature_table,
    "structure_lags": Q.structure_lags,
    "forecast_fallback": Q.forecast_fallback,
    "wape_total": Q.wape_total,
    "calibration_best": Q.calibration_best,
    "customer_cum_share_top20": Q.customer_cum_share_top20,
    "pareto": Q.pareto,
    "regimes": Q.regimes,
    "fit_medoids": Q.shape_medoids,
    "assign_segments": assign_segments,
    "seasonal_series": Q.seasonal_series,
    "ols_lags": Q.ols_lags,
    "gbt_l1": Q.gbt_l1,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or list(HEADLINE)
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # warm up the JVM and the file cache, and write the fact table the others share
    stored(P.monthly_total(Q.sales(spark, sf_dir)), "warm").count()
    times = {}
    for name in wanted:
        start = time.perf_counter()
        HEADLINE[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
