"""SQL twins of the registered queries, for DuckDB over the same tables."""

from oracles import cashflow, detection, simple, tables

ORACLES = {**cashflow.SQL, **detection.SQL, **simple.SQL, **tables.SQL}

# The same result by another plan.
ORACLES |= {
    "running_balance_split": ORACLES["running_balance"],
    "anomaly_score_split": ORACLES["anomaly_score"],
    "dq_balance_split": ORACLES["dq_balance"],
    "budget_from_table": ORACLES["budget_vs_actual"],
    "export_report": ORACLES["cashflow_by_month"],
    "stream_compacted": ORACLES["stream_ingest"],
    "anomalies_recent_stored": ORACLES["anomalies_recent"],
}

_EXPORTED = {
    "cashflow_by_account": "cashflow_daily",
    "cashflow_daily": "mart_cashflow_daily",
    "cashflow_monthly": "mart_cashflow_monthly",
    "budget": "mart_budget",
    "anomalies": "mart_anomalies",
    "recurring": "mart_recurring",
    "forecasts": "mart_forecasts",
    "anomaly_scores": "anomaly_score",
    "net_worth": "net_worth",
}
ORACLES["summary_marts"] = "\nUNION ALL ".join(
    f"SELECT '{name}' AS mart, COUNT(*) AS rows FROM ({ORACLES[twin]})" for name, twin in _EXPORTED.items()
)
