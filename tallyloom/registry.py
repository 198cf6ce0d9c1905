"""Every report and operator of the library, run over the test tables with fixed parameters."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.criteria import (
    any_of,
    at_least,
    by_company,
    contains,
    excluding,
    listed,
    more_than,
    one_of,
    starts_with,
)
from tallyloom.functions.dates import month_of, wall_clock, year_of
from tallyloom.functions.money import MONEY, money, shown
from tallyloom.operators.changes import changed_rows, upsert_merge
from tallyloom.operators.colocated import stage_colocated
from tallyloom.operators.journal import stage_journal
from tallyloom.operators.runlog import latest_runs
from tallyloom.operators.snapshots import SnapshotStore
from tallyloom.operators.watermark import Watermark
from tallyloom.plans import balances, lines, replica, sales
from tallyloom.plans.jobs import ReportCall, run_job
from tallyloom.plans.maintained import MaintainedSums
from tallyloom.plans.repair import repair
from tallyloom.plans.replicate import Replica, replicate, replicated_erp
from tallyloom.session import run_folder, tune
from tallyloom.sources import standin
from tallyloom.sources.cleaning import clean_ledger, nan_to_null, stage_ledger
from tallyloom.sources.collation import DATABASE
from tallyloom.sources.erp import Erp
from tallyloom.sources.ledger import Ledger
from tallyloom.sources.newest import load_newest
from tallyloom.sources.quarantine import CheckedLoads
from tallyloom.sources.schemas import ERP_TABLES
from tallyloom.streaming.changes import stream_changes

Query = Callable[[SparkSession, str], DataFrame]

# Report parameters. The oracle states the same values in SQL.
CENTERS = one_of(1, 2, 3, 5, 8, 11, 12, 36, 37)
SPENT = one_of("1-1-00", "2-2-01", "4-1-03")
BILLED = one_of("3-3-02", "5-2-04")
PAYROLL = starts_with("NATION_1")
INCOME = starts_with("4")
CUTOFF = datetime(2000, 1, 1)


def _ledger(report: Callable[..., DataFrame], **params) -> Query:
    return lambda spark, folder: report(standin.ledger(tune(spark), folder), **params)


def _companies(report: Callable[..., DataFrame], **params) -> Query:
    return lambda spark, folder: report(standin.company_ledger(tune(spark), folder), **params)


def _erp(report: Callable[..., DataFrame], **params) -> Query:
    return lambda spark, folder: report(standin.erp(tune(spark), folder), **params)


def _as_text(query: Query, *columns: str) -> Query:
    """Integer columns that may be NULL as text, because readers of results disagree on how to show such integers."""
    return lambda spark, folder: query(spark, folder).withColumns({c: F.col(c).cast("string") for c in columns})


LEDGER_REPORTS: dict[str, Query] = {
    "payroll_lines": _ledger(lines.payroll_lines, details=PAYROLL, posted_only=False),
    "payroll_lines_posted": _ledger(lines.payroll_lines, details=PAYROLL),
    "payroll_lines_center": _ledger(lines.payroll_lines, details=PAYROLL, centers=5),
    "payroll_lines_account": _ledger(lines.payroll_lines, accounts="4-1-03"),
    "expense_detail": _ledger(lines.expense_detail),
    "expense_detail_from_year": _ledger(lines.expense_detail, years=more_than(1999)),
    "expense_detail_excl": _ledger(
        lines.expense_detail, years=more_than(1998), centers=5, details=excluding(PAYROLL)
    ),
    "expense_detail_center": _ledger(lines.expense_detail, years=more_than(1998), centers=5),
    "expense_detail_basic": _ledger(lines.expense_detail_basic),
    "expense_no_detail": _ledger(lines.expense_no_detail, years=at_least(1996)),
    "expense_center": _ledger(lines.expense_detail_basic, centers=3),
    "income_lines": _ledger(lines.income_lines, accounts=INCOME),
    "income_lines_center": _ledger(lines.income_lines, accounts=INCOME, centers=5),
    "income_lines_from_year": _ledger(lines.income_lines, accounts=INCOME, years=at_least(1999)),
    "sales_documents": _ledger(sales.sales_documents, kinds=one_of("1-URGENT", "2-HIGH", "3-MEDIUM")),
    "sales_documents_from_year": _ledger(
        sales.sales_documents, kinds=one_of("1-URGENT", "2-HIGH", "3-MEDIUM"), from_year=1999
    ),
    "account_month_balance": _ledger(balances.account_month_balance),
    "account_month_balance_from_year": _ledger(balances.account_month_balance, years=at_least(1998)),
    "voucher_balance_accounts": _ledger(
        balances.voucher_balance, accounts=any_of(starts_with("1-1-", "2-3-"), one_of("3-3-02", "4-1-03"))
    ),
    "current_account_balance": _ledger(
        balances.voucher_balance,
        accounts=one_of("1-1-00", "2-2-01", "3-3-02", "4-1-03"),
        counterparties=one_of(1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 101, 144),
    ),
    "current_account_balance_all": _ledger(
        balances.voucher_balance, accounts=one_of("1-1-00", "2-2-01", "3-3-02", "4-1-03")
    ),
    "spent_vs_billed": _as_text(
        _ledger(balances.spent_vs_billed, spent=SPENT, billed=BILLED, centers=CENTERS), "ano", "cc"
    ),
    "spent_vs_billed_keyed": _ledger(
        balances.spent_vs_billed, spent=SPENT, billed=BILLED, centers=CENTERS, keyed=True
    ),
    "spent_vs_billed_outer_join": _as_text(
        _ledger(balances.spent_vs_billed, spent=SPENT, billed=BILLED, centers=CENTERS, single_pass=False), "ano", "cc"
    ),
    "exempt_expense_union": _ledger(lines.exempt_expense_union, accounts=["1-1-00", "4-1-03"]),
    "import_costs": _ledger(
        balances.import_costs,
        accounts=one_of("1-1-00", "2-2-01", "4-1-03"),
        centers=CENTERS,
        details=one_of("NATION_1", "NATION_3", "NATION_5", "NATION_8", "NATION_15", "NATION_21"),
    ),
    "issued_documents": _ledger(lines.issued_documents, vessel="A", counterparties=101),
    "issued_documents_union": _ledger(
        lines.issued_documents_union,
        groups={
            "A": (one_of(10, 20), contains("#00000001")),
            "B": (one_of(11, 21), contains("#00000002")),
            "C": (None, contains("MER#00000010")),
        },
    ),
    "receivables": _ledger(
        lines.receivables,
        accounts=starts_with("4-"),
        counterparties=one_of(1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 101, 144),
    ),
    "intercompany_ledger": _ledger(
        lines.intercompany_ledger,
        counterparties=one_of(7, 79, 142),
        accounts=any_of(starts_with("1-"), starts_with("2-")),
        opening_number=0,
    ),
    "intercompany_ledger_from_year": _ledger(
        lines.intercompany_ledger,
        counterparties=one_of(7, 79, 142),
        accounts=starts_with("1-", "2-", "3-"),
        years=at_least(1998),
        opening_number=0,
    ),
    "product_month_sales": _ledger(sales.product_month_sales),
    "product_attribute": _ledger(sales.product_attribute, products=excluding(starts_with("19"))),
    "multi_company_report": _companies(balances.account_month_balance),
    "multi_company_lines": _companies(
        lines.payroll_lines,
        details=by_company({"CO0": PAYROLL, "CO1": starts_with("NATION_2"), "CO3": one_of("NATION_7")}),
    ),
    "multi_company_spent_vs_billed": _as_text(
        _companies(
            balances.spent_vs_billed,
            spent=by_company({"CO0": "1-1-00", "CO1": "2-2-01", "CO2": "4-1-03"}),
            billed=BILLED,
            centers=CENTERS,
        ),
        "ano",
        "cc",
    ),
}

ERP_REPORTS: dict[str, Query] = {
    "customer_invoices": _erp(replica.customer_invoices, kind="O"),
    "supplier_bills": _erp(replica.supplier_bills, kind="F"),
    "supplier_bills_open": _erp(replica.supplier_bills, kind="F", open_only=True),
    "supplier_bills_partner": _erp(
        replica.supplier_bills, kind="F", partner_id=one_of(14, 55, 145), cancelled_state="5-LOW"
    ),
    "product_movements": _as_text(_erp(replica.product_movements), "p_id"),
    "company_account_balance": _erp(replica.company_account_balance),
    "company_account_month": _erp(replica.company_account_month),
    "income_statement_year": _erp(replica.income_statement_year, year=1999),
    "partner_residual": _erp(replica.partner_residual),
    "cash_basis_balance": _erp(replica.cash_basis_balance, accounts=one_of(16, 50, 109, 166)),
}


def account_scan(spark: SparkSession, folder: str) -> DataFrame:
    return standin.erp(tune(spark), folder).accounts


def staged_journal_balance(spark: SparkSession, folder: str) -> DataFrame:
    """The balance report over a journal that was joined and written beforehand."""
    staged = stage_journal(standin.ledger(tune(spark), folder), f"{run_folder(spark)}/journal")
    return balances.account_month_balance(staged)


def colocated_journal_balance(spark: SparkSession, folder: str) -> DataFrame:
    """The balance report over lines and headers stored in equal buckets, with vouchers of over six lines kept apart as hot."""
    source = standin.ledger(tune(spark), folder)
    return balances.account_month_balance(stage_colocated(source, f"{run_folder(spark)}/books", hot_lines=6))


def listed_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """A table of the accounts to report in each year."""
    parts = standin.table(tune(spark), folder, "part").where(F.col("p_size") == 7)
    year = (F.col("p_partkey") % 7 + 1995).cast("int")
    return parts.select(standin.account_code(F.col("p_partkey")).alias("code"), year.alias("year")).distinct()


def listed_accounts_balance(spark: SparkSession, folder: str) -> DataFrame:
    """Voucher balances of the accounts that a table lists for their years, over a staged journal."""
    staged = stage_journal(standin.ledger(tune(spark), folder), f"{run_folder(spark)}/journal")
    return balances.voucher_balance(staged, accounts=listed(listed_accounts(spark, folder), "code", cpbano="year"))


def cleaned_ledger_balance(spark: SparkSession, folder: str) -> DataFrame:
    """The balance report over raw tables: padded codes, years as strings, money as doubles."""
    spelled = F.concat(F.when(F.col("cpbano") == 1996, F.lit("FY")).otherwise(F.lit("")), F.col("cpbano").cast("string"))
    tidy = standin.ledger(tune(spark), folder)
    raw = tidy.with_tables(
        lines=tidy.lines.withColumns(
            {
                "cpbano": spelled,
                "pctcod": F.rpad("pctcod", 20, " "),
                "cpbmes": F.concat("cpbmes", F.lit("  ")),
                "movdebe": F.col("movdebe").cast("double"),
                "movhaber": F.col("movhaber").cast("double"),
            }
        ),
        headers=tidy.headers.withColumns(
            {"cpbano": spelled, "cpbest": F.concat("cpbest", F.lit(" "))}
        ),
    )
    balance = balances.account_month_balance(clean_ledger(raw))
    return balance.withColumn("ano", F.col("ano").cast("string"))


def staged_ledger_detail(spark: SparkSession, folder: str) -> DataFrame:
    """Expense detail over tables that were cleaned and written beforehand."""
    source = standin.ledger(tune(spark), folder)
    needed = ("lines", "headers", "centers", "details", "accounts")
    tables = {name: getattr(source, name) for name in needed}
    staged = stage_ledger(Ledger(**tables, posted_state=source.posted_state), f"{run_folder(spark)}/tables")
    return lines.expense_detail(staged)


def _spelled(spark: SparkSession, folder: str) -> Ledger:
    """The ledger with codes that each table spells its own way, staged under the collation of the source databases.

    Accounts have a letter in front, in turns large and small; details are in capitals, small or mixed letters; states,
    details and accounts have trailing blanks here and there.
    """
    tidy = standin.ledger(tune(spark), folder)
    turn = F.col("cpbnum") % 3
    account = F.concat(F.when(turn == 0, F.lit("a")).otherwise(F.lit("A")), F.col("pctcod"), F.repeat(F.lit(" "), F.col("ttdcod").cast("int")))
    detail = F.when(turn == 1, F.lower("dgacod")).when(turn == 2, F.initcap("dgacod")).otherwise(F.col("dgacod"))
    spelled = Ledger(
        lines=tidy.lines.withColumns({"pctcod": account, "dgacod": detail}),
        headers=tidy.headers.withColumn("cpbest", F.when(turn == 0, F.concat(F.lower("cpbest"), F.lit("  "))).otherwise(F.col("cpbest"))),
        centers=tidy.centers,
        details=tidy.details.withColumn("coddet", F.concat(F.lower("coddet"), F.lit("   "))),
        accounts=tidy.accounts.withColumn("pccodi", F.concat(F.lit("A"), "pccodi")),
        posted_state=tidy.posted_state,
    )
    return stage_ledger(spelled, f"{run_folder(spark)}/tables", DATABASE)


def collated_ledger_detail(spark: SparkSession, folder: str) -> DataFrame:
    """Expense detail over those tables, for details given in yet another spelling."""
    return lines.expense_detail(_spelled(spark, folder), details=any_of(starts_with("Nation_1"), one_of("nAtIoN_2  ")))


def collated_account_balance(spark: SparkSession, folder: str) -> DataFrame:
    """Posted balances over those tables; spellings of an account are one group."""
    return balances.account_month_balance(_spelled(spark, folder))


def nan_cleanup(spark: SparkSession, folder: str) -> DataFrame:
    """NaN where a line has no tax, turned into NULL."""
    items = standin.table(tune(spark), folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("l_tax"),
    )
    return nan_to_null(items)


def run_log_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Latest entry per report, with the events as a log and the user as the report."""
    events = standin.table(tune(spark), folder, "events").select(
        F.col("user_id").alias("report"),
        F.col("ts").alias("started_at"),
        "event_id",
        F.col("event_type").alias("status"),
    )
    return latest_runs(events, newest=("started_at", "event_id"))


def incremental_extract(spark: SparkSession, folder: str) -> DataFrame:
    return changed_rows(standin.table(tune(spark), folder, "events"), datetime(2024, 1, 20), "ts")


def _replicated(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Invoices as first copied, and the later batch: overlapping, repriced, and older for one state."""
    orders = standin.table(tune(spark), folder, "orders")
    rows = standin.invoices(orders)
    changed = (
        rows.where(F.col("date") >= wall_clock("1999-07-01"))
        .withColumn("residual_company_signed", (F.col("residual_company_signed") + 1).cast("decimal(18,2)"))
        .withColumn(
            "write_date",
            F.when(F.col("state") == "5-LOW", F.col("write_date") - F.expr("interval 10 days")).otherwise(
                F.col("write_date") + F.expr("interval 400 days")
            ),
        )
    )
    return rows.where(F.col("date") < wall_clock(CUTOFF)), changed


def _invoice_rows(rows: DataFrame) -> DataFrame:
    amount = "residual_company_signed"
    return rows.select(*[shown(F.col(c)).alias(c) if c == amount else F.col(c) for c in rows.columns])


def upsert(spark: SparkSession, folder: str) -> DataFrame:
    base, delta = _replicated(spark, folder)
    return _invoice_rows(upsert_merge(base, delta, ["id"]))


def replication(spark: SparkSession, folder: str) -> DataFrame:
    """Two replication runs: everything, then the changes past the watermark. Gives the replica's table."""
    base, delta = _replicated(spark, folder)
    root = run_folder(spark)
    target, mark = Replica(spark, root, slot_rows=5_000), Watermark(spark, f"{root}/watermark")
    replicate(target, {"account_invoice": base}, mark, now=CUTOFF)
    replicate(target, {"account_invoice": delta}, mark, now=datetime(2002, 1, 1))
    return _invoice_rows(target.read("account_invoice"))


def replica_repair(spark: SparkSession, folder: str) -> DataFrame:
    """A replica that has missed deletes, late rows and a change with an old write date, after a run and a repair."""
    now = standin.invoices(standin.table(tune(spark), folder, "orders")).where(F.col("id") % 37 != 5)
    amount = "residual_company_signed"
    before = standin.invoices(standin.table(spark, folder, "orders")).where(F.col("id") % 4001 != 17)
    before = before.withColumn(amount, F.when(F.col("id") % 2003 == 3, F.lit(0)).otherwise(F.col(amount)).cast("decimal(18,2)"))
    root = run_folder(spark)
    target, mark = Replica(spark, root, slot_rows=5_000), Watermark(spark, f"{root}/watermark")
    for source in (before, now):
        replicate(target, {"account_invoice": source}, mark, now=datetime(2004, 1, 1))
    repair(target, "account_invoice", now)
    return _invoice_rows(target.read("account_invoice"))


def replicated_erp_balance(spark: SparkSession, folder: str) -> DataFrame:
    """All eight tables replicated twice, first with other amounts and names; then a report over the replica."""
    source = standin.erp(tune(spark), folder)
    root = run_folder(spark)
    target, mark = Replica(spark, root, slot_rows=50_000), Watermark(spark, f"{root}/watermark")
    first, second = wall_clock("2001-01-01"), wall_clock("2003-01-01")
    now = {name: getattr(source, table).withColumn("write_date", second) for table, name in ERP_TABLES.items()}
    # The test tables repeat order and line numbers, and a replica holds each id once.
    for name in ("account_move_line", "account_invoice_line"):
        now[name] = now[name].withColumn("id", F.monotonically_increasing_id())
    before = {name: df.withColumn("write_date", first) for name, df in now.items()}
    before["account_move_line"] = before["account_move_line"].withColumn("balance", F.lit(1).cast("decimal(18,2)"))
    before["account_account"] = before["account_account"].withColumn("name", F.lit("before"))
    replicate(target, before, mark, now=datetime(2002, 1, 1))
    replicate(target, now, mark, now=datetime(2004, 1, 1))
    return replica.company_account_balance(replicated_erp(target))


def _maintained(spark: SparkSession, folder: str, keys: dict[str, Column], amount: str) -> tuple[Erp, DataFrame]:
    """Sums over replicated journal lines, refreshed after each of three batches.

    The first holds a third of the lines under other accounts, companies, partners and dates, and other amounts for the rest; the
    later ones put that right, so rows move between groups and the groups that they first made go.
    """
    source = standin.erp(tune(spark), folder)
    root = run_folder(spark)
    # The test tables repeat order and line numbers, and a replica holds each id once.
    source.move_lines.withColumn("id", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(f"{root}/moves")
    moves = spark.read.parquet(f"{root}/moves")
    third = F.col("id") % 3
    first = moves.withColumns(
        {
            **{c: F.when(third == 1, F.col(c) - 1).otherwise(F.col(c)) for c in ("account_id", "company_id", "partner_id")},
            **{c: F.when(third == 2, F.col(c) + 1).otherwise(F.col(c)).cast(MONEY) for c in ("balance", "amount_residual")},
            "date": F.when(third == 1, F.col("date") + F.expr("interval 900 days")).otherwise(F.col("date")),
        }
    )
    batches = [first, moves.where(third == 1), moves.where(third == 2)]
    target, mark = Replica(spark, root, slot_rows=50_000), Watermark(spark, f"{root}/watermark")
    sums = MaintainedSums(target, "account_move_line", "balance", keys, {"saldo": money(amount)}, parts=16)
    for n, batch in enumerate(batches):
        rows = batch.withColumn("write_date", wall_clock(f"200{n}-06-01"))
        replicate(target, {"account_move_line": rows}, mark, now=datetime(2001 + n, 1, 1))
        sums.refresh()
    return source, sums.read()


def maintained_company_balance(spark: SparkSession, folder: str) -> DataFrame:
    """The monthly balances of accounts and companies from sums that were kept up to date."""
    ids = {c: F.col(c) for c in ("account_id", "company_id")}
    source, sums = _maintained(spark, folder, {**ids, "ano": year_of("date"), "mes": month_of("date")}, "balance")
    return replica.named_account_balance(source, sums, ("ano", "mes"))


def maintained_partner_residual(spark: SparkSession, folder: str) -> DataFrame:
    """The open amounts of partners from sums that were kept up to date."""
    source, sums = _maintained(spark, folder, {c: F.col(c) for c in ("partner_id", "company_id")}, "amount_residual")
    return replica.named_partner_residual(source, sums)


def watermark_advance(spark: SparkSession, folder: str) -> DataFrame:
    """The watermark after two runs whose cutoffs are the oldest and the newest order date."""
    orders = standin.table(tune(spark), folder, "orders")
    root = run_folder(spark)
    target, mark = Replica(spark, root, slot_rows=5_000), Watermark(spark, f"{root}/watermark")
    first, last = orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    for cutoff in (first, last):
        replicate(target, {"account_invoice": standin.invoices(orders)}, mark, now=cutoff)
    return mark.state().select("cutoff")


def streaming_replication(spark: SparkSession, folder: str) -> DataFrame:
    """The same two batches as files of a stream, the older of them arriving last."""
    base, delta = _replicated(spark, folder)
    root = run_folder(spark)
    target = Replica(spark, root, slot_rows=5_000)
    for batch in (delta, base):
        batch.write.mode("append").parquet(f"{root}/changes")
        stream_changes(
            spark, f"{root}/changes", base.schema, target, "account_invoice", f"{root}/checkpoint"
        ).awaitTermination()
    return _invoice_rows(target.read("account_invoice"))


def newest_snapshot_load(spark: SparkSession, folder: str) -> DataFrame:
    """Two exports of the customers; the newer one is loaded whole."""
    customers = standin.table(tune(spark), folder, "customer")
    root = run_folder(spark)
    customers.where("c_acctbal < 0").write.parquet(f"{root}/exports/b-old")
    customers.write.parquet(f"{root}/exports/a-new")
    return load_newest(spark, f"{root}/exports", "parquet", "*.parquet")


def quarantined_export(spark: SparkSession, folder: str) -> DataFrame:
    """An export of the customers in which some rows lack a field, have one too many or no number as balance: good rows and raw lines."""
    key = F.col("c_custkey")
    start = F.concat_ws(",", key.cast("string"), "c_name", F.col("c_nationkey").cast("string"))
    balance = F.col("c_acctbal").cast(MONEY).cast("string")
    line = (
        F.when(key % 7 == 3, F.concat(start, F.lit(",n/a")))
        .when(key % 7 == 5, F.concat(start, F.lit(","), balance, F.lit(",x")))
        .when(key % 11 == 2, start)
        .otherwise(F.concat(start, F.lit(","), balance))
    )
    root = run_folder(spark)
    standin.table(tune(spark), folder, "customer").select(line.alias("value")).write.text(f"{root}/exports/customers")
    loads = CheckedLoads(spark, f"{root}/loads", f"custkey BIGINT, name STRING, nation BIGINT, balance {MONEY}", most_malformed=0.5)
    done = loads.load(f"{root}/exports", pattern="*.txt", header="false")
    good = done.rows.withColumns({"balance": shown(F.col("balance")), "raw": F.lit(None).cast("string")})
    return good.unionByName(done.malformed.select(F.col("_raw").alias("raw")), allowMissingColumns=True)


def snapshot_full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """A report written twice under one name; the second run is the current snapshot."""
    source = standin.ledger(tune(spark), folder)
    store = SnapshotStore(spark, run_folder(spark))
    store.write("balance", balances.account_month_balance(source, years=1995))
    store.write("balance", balances.account_month_balance(source))
    return store.read("balance")


def two_target_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """One result under two names; gives the second."""
    store = SnapshotStore(spark, run_folder(spark))
    call = ReportCall(("statement", "statement_1999"), replica.income_statement_year, {"year": 1999})
    run_job(store, standin.erp(tune(spark), folder), [call])
    return store.read("statement_1999")


def company_partitioned_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """A report over four companies, written with one directory per company."""
    store = SnapshotStore(spark, run_folder(spark))
    call = ReportCall("balance", balances.account_month_balance, partition_by=("company",))
    run_job(store, standin.company_ledger(tune(spark), folder), [call])
    return store.read("balance")


def report_job_log(spark: SparkSession, folder: str) -> DataFrame:
    """A job of three reports over a staged journal; gives its run log."""
    root = run_folder(spark)
    store = SnapshotStore(spark, root)
    calls = [
        ReportCall("balance", balances.account_month_balance),
        ReportCall("income", lines.income_lines, {"accounts": INCOME}),
        ReportCall("expenses", lines.expense_no_detail, {"years": at_least(1996)}),
    ]
    run_job(store, standin.ledger(tune(spark), folder), calls, journal_path=f"{root}/journal")
    return latest_runs(store.log()).select("report", "status", "row_count")


OPERATORS: dict[str, Query] = {
    "account_scan": account_scan,
    "staged_journal_balance": staged_journal_balance,
    "colocated_journal_balance": colocated_journal_balance,
    "listed_accounts_balance": listed_accounts_balance,
    "cleaned_ledger_balance": cleaned_ledger_balance,
    "staged_ledger_detail": staged_ledger_detail,
    "collated_ledger_detail": collated_ledger_detail,
    "collated_account_balance": collated_account_balance,
    "nan_cleanup": nan_cleanup,
    "run_log_latest": run_log_latest,
    "incremental_extract": incremental_extract,
    "upsert_merge": upsert,
    "replication": replication,
    "replica_repair": replica_repair,
    "replicated_erp_balance": replicated_erp_balance,
    "maintained_company_balance": maintained_company_balance,
    "maintained_partner_residual": maintained_partner_residual,
    "watermark_advance": watermark_advance,
    "streaming_replication": streaming_replication,
    "newest_snapshot_load": newest_snapshot_load,
    "quarantined_export": quarantined_export,
    "snapshot_full_refresh": snapshot_full_refresh,
    "two_target_snapshot": two_target_snapshot,
    "company_partitioned_snapshot": company_partitioned_snapshot,
    "report_job_log": report_job_log,
}

QUERIES: dict[str, Query] = {**LEDGER_REPORTS, **ERP_REPORTS, **OPERATORS}
