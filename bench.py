"""Time the headline queries. Prints one JSON line.

Two groups, both over $BENCH_SF_DIR:

* ``build_*``: a mart computed from the raw table to the last row; ``*_split`` with limits so low that hot keys are cut,
  which is the plan that large tables get;
* ``read_*``: a report query over marts that were built and exported before, the
  way the published numbers were taken (reports read finished marts).

Each is the median of three runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from datetime import date
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgermill.operators import (  # noqa: E402
    anomalies,
    budget,
    cashflow,
    forecasts,
    materialize,
    networth,
    recurring,
    simple_marts,
    staging,
)
from ledgermill.plans import derived, reports  # noqa: E402
from ledgermill.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def timed(run) -> float:
    run()
    samples = []
    for _ in range(RUNS):
        started = time.perf_counter()
        run()
        samples.append(time.perf_counter() - started)
    return round(statistics.median(samples), 4)


def full(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    shared = tempfile.mkdtemp(prefix="ledgermill-bench-")
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        {
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": shared,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    as_of, events = derived.LEDGER_AS_OF, derived.event_spend(spark, SF_DIR)

    stg_path = f"{shared}/staged"
    build_staging = time.perf_counter()
    derived.staged(spark, SF_DIR, with_balance=True).write.parquet(stg_path)
    times = {"build_staging_cold": round(time.perf_counter() - build_staging, 4)}
    stg = spark.read.parquet(stg_path)
    raw = derived.raw_ledger(spark, SF_DIR)
    simple, fx = staging.simple_view(stg), derived.fx_rates(spark, SF_DIR)
    daily = cashflow.cashflow_daily(stg)

    builds = {
        "build_staging": lambda: derived.staged(spark, SF_DIR, with_balance=True),
        "build_cashflow_daily": lambda: daily,
        "build_cashflow_monthly": lambda: cashflow.cashflow_monthly(daily),
        "build_net_worth": lambda: networth.net_worth(stg, fx),
        "build_budget": lambda: budget.budget_vs_actual(stg),
        "build_recurring": lambda: recurring.recurring(derived.recurring_ledger(spark, SF_DIR), derived.RECUR_AS_OF),
        "build_anomalies": lambda: anomalies.anomaly_score(stg),
        "build_anomalies_split": lambda: anomalies.anomaly_score(stg, max_group_rows=5_000, block_rows=5_000),
        "build_balance_split": lambda: staging.running_balance(raw, max_group_rows=1_000),
        "build_anomalies_events": lambda: anomalies.anomaly_score(events),
        "build_forecast": lambda: forecasts.forecast(stg, as_of),
        "build_novel_merchants": lambda: simple_marts.novel_merchant_90d(simple),
    }
    for name, make in builds.items():
        times[name] = timed(lambda: full(make()))

    marts = {
        "cashflow_daily": simple_marts.mart_cashflow_daily(simple),
        "cashflow_monthly": simple_marts.mart_cashflow_monthly(simple),
        "budget": budget.budget_vs_actual(stg),
        "net_worth": networth.net_worth(stg, fx),
        "anomalies": anomalies.anomaly_score(stg),
    }
    stored = {}
    for name, path in materialize.export_marts(marts, f"{shared}/marts").items():
        stored[name] = spark.read.parquet(path)

    reads = {
        "read_daily_cashflow": lambda: reports.daily_since(stored["cashflow_daily"], date(2000, 1, 1)),
        "read_category_analysis": lambda: reports.category_totals(stored["budget"], "2000-01"),
        "read_monthly_trends": lambda: reports.monthly_trends(stored["cashflow_monthly"], "2000-01"),
        "read_budget_variance": lambda: reports.budget_month(stored["budget"], "2001-06"),
        "read_net_worth": lambda: reports.net_worth_trend(stored["net_worth"], as_of),
        "read_anomalies": lambda: reports.anomalies_recent(stored["anomalies"], 50),
    }
    for name, make in reads.items():
        times[name] = timed(lambda: make().collect())

    total = round(sum(v for k, v in times.items() if k != "build_staging_cold"), 4)
    rows = spark.read.parquet(f"{SF_DIR}/orders.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "transactions": rows,
                "rows_per_sec_anomalies": round(rows / times["build_anomalies"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
