"""A hand-written ledger and ERP of a few rows, with string codes as in the source databases.

Each row is there for one trap; the tests say which.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from tallyloom.sources.erp import Erp
from tallyloom.sources.ledger import Ledger
from tallyloom.sources.schemas import ERP_COLUMNS, LEDGER_COLUMNS

JAN, FEB, MAR = (datetime(2020, m, 15) for m in (1, 2, 3))


def money(value):
    return None if value is None else Decimal(str(value)).quantize(Decimal("0.01"))


def line(num="1", mes="01", pct="5-1", cc="70-11", dga="03-1", aux="101", ttd="FV", debe=0, haber=0, **other):
    row = {
        "cpbano": 2020, "cpbnum": num, "areacod": "A", "cpbmes": mes, "pctcod": pct, "cccod": cc, "dgacod": dga,
        "codaux": aux, "ttdcod": ttd, "numdoc": "77", "movfe": JAN, "movfv": FEB, "movtipdocref": "FV",
        "movnumdocref": "1", "movdebe": money(debe), "movhaber": money(haber), "movglosa": "text",
    }
    return {**row, **other}


def header(num="1", est="V", mes="01", **other):
    row = {
        "cpbano": 2020, "cpbnum": num, "areacod": "A", "cpbmes": mes, "cpbtip": "T", "cpbnui": "9", "cpbest": est,
        "cpbfec": JAN,
    }
    return {**row, **other}


CENTERS = [("70-11", "CC 11 ABCD   "), ("70-12", "CC 12 LONGNAME"), ("70-36", "CC 36 ABCD   ")]
DETAILS = [("03-1", "Wages"), ("05-1", "Freight")]
ACCOUNTS = [("5-1", "Spending"), ("4-1", "Billing"), ("1-1", "Current")]


def frame(spark, rows, ddl):
    names = [part.split()[0] for part in ddl.split(", ")]
    tuples = [tuple(row[n] for n in names) if isinstance(row, dict) else row for row in rows]
    return spark.createDataFrame(tuples, ddl)


def ledger(spark, lines=(), headers=(), **tables) -> Ledger:
    rows = {
        "lines": lines,
        "headers": headers or [header()],
        "centers": CENTERS,
        "details": DETAILS,
        "accounts": ACCOUNTS,
        "doc_types": [("FV", "Invoice")],
        "counterparties": [("101", "Acme North"), ("102", "ACME south")],
        "sales_docs": [],
        "month_sales": [],
        "products": [],
        "product_attributes": [],
        **tables,
    }
    return Ledger(**{name: frame(spark, value, LEDGER_COLUMNS[name]) for name, value in rows.items()})


def erp(spark, **tables) -> Erp:
    rows = {
        "move_lines": [],
        "accounts": [(1, "100", "Cash"), (2, "100", "Cash"), (3, "200", "Debt")],
        "companies": [(1, "One"), (2, "Two")],
        "partners": [(1, "P1"), (2, "P2")],
        "invoices": [],
        "invoice_lines": [],
        "product_variants": [(10, 100), (11, 999)],
        "product_templates": [(100, "Bolt")],
        **tables,
    }
    return Erp(**{name: frame(spark, value, ERP_COLUMNS[name]) for name, value in rows.items()})


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
