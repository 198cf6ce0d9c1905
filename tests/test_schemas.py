from __future__ import annotations

import pytest
from pyspark.sql.types import StructType

from tallyloom.functions.criteria import starts_with
from tallyloom.plans import balances, lines, replica, sales
from tallyloom.plans.schemas import ERP_REPORTS, LEDGER_REPORTS
from tests import literal

PARAMS = {
    "income_lines": {"accounts": starts_with("4")},
    "exempt_expense_union": {"accounts": ["5-1", "5-2"]},
    "issued_documents": {"vessel": "A", "counterparties": "101"},
    "issued_documents_union": {"groups": {"A": ("101", None)}},
    "receivables": {"accounts": "1-1", "counterparties": ["101"]},
    "intercompany_ledger": {"accounts": "1-1", "counterparties": "101"},
    "voucher_balance": {"accounts": "1-1"},
    "spent_vs_billed": {"spent": "5-1", "billed": "4-1"},
    "import_costs": {"accounts": "5-1", "centers": "70-11", "details": "05-1"},
    "cash_basis_balance": {"accounts": [1]},
}


def names_and_types(schema: StructType):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def declared(ddl: str):
    return names_and_types(StructType.fromDDL(ddl))


@pytest.mark.parametrize("name", sorted(LEDGER_REPORTS))
def test_ledger_report_schema(spark, name):
    report = next(getattr(m, name) for m in (lines, balances, sales) if hasattr(m, name))
    result = report(literal.ledger(spark), **PARAMS.get(name, {}))
    assert names_and_types(result.schema) == declared(LEDGER_REPORTS[name])
    assert result.count() == 0


@pytest.mark.parametrize("name", sorted(ERP_REPORTS))
def test_erp_report_schema(spark, name):
    result = getattr(replica, name)(literal.erp(spark), **PARAMS.get(name, {}))
    assert names_and_types(result.schema) == declared(ERP_REPORTS[name])
    assert result.count() == 0
