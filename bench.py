"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_REPEATS (timed runs after one warm-up, median taken) and
BENCH_QUERIES ("all", or names separated by commas) change the run. Reports are written to the no-op sink, so every
row and column is computed.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from pyspark.sql import SparkSession

from tallyloom.registry import QUERIES

HEADLINE = [
    "payroll_lines",
    "expense_detail",
    "expense_no_detail",
    "income_lines",
    "sales_documents",
    "account_month_balance",
    "voucher_balance_accounts",
    "current_account_balance_all",
    "spent_vs_billed",
    "spent_vs_billed_keyed",
    "exempt_expense_union",
    "import_costs",
    "issued_documents_union",
    "receivables",
    "intercompany_ledger",
    "product_month_sales",
    "product_attribute",
    "multi_company_report",
    "customer_invoices",
    "supplier_bills",
    "product_movements",
    "company_account_balance",
    "company_account_month",
    "income_statement_year",
    "partner_residual",
    "cash_basis_balance",
    "incremental_extract",
    "upsert_merge",
    "replication",
    "run_log_latest",
]


def seconds(spark: SparkSession, name: str, folder: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        seconds(spark, name, folder)
        times[name] = round(statistics.median(seconds(spark, name, folder) for _ in range(repeats)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", folder)
    result = {
        "metric": "total of median query times",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else folder,
        "cpus": cpus,
        "repeats": repeats,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
