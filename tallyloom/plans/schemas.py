"""Declared output of every report, for a ledger whose codes are strings (as in ``sources.schemas``).

A ledger of several companies adds a leading ``company`` column. Where a deployment keeps a code as a number, the
report shows it as that number.
"""

from __future__ import annotations

_VOUCHER_LINE = (
    "dgacod STRING, mes STRING, ano INT, cpbnum STRING, cpbtip STRING, cpbnui STRING, pctcod STRING, glosa STRING, "
    "saldo DOUBLE, cccod STRING"
)
_EXPENSE = "mes STRING, ano INT, gastos DOUBLE, dgacod STRING"
_EXPENSE_CENTER = "glosa STRING, cccod STRING, descripcioncc STRING"
_EXPENSE_ACCOUNT = "codigo STRING, descripcion STRING"
_DOCUMENT = (
    "ano INT, mes INT, vessel STRING, coddoc STRING, numdoc STRING, codaux STRING, nomaux STRING, "
    "movfe TIMESTAMP_NTZ, cpbmes STRING, cpbano INT, monto_facturado DOUBLE"
)
_INVOICE = (
    "id BIGINT, name STRING, type STRING, state STRING, date TIMESTAMP_NTZ, date_invoice TIMESTAMP_NTZ, "
    "partner_id BIGINT, company_id BIGINT, residual_company_signed DOUBLE, write_date TIMESTAMP_NTZ"
)
_ACCOUNT_BALANCE = "vessel STRING, cuenta STRING, saldo DOUBLE, codigo STRING, company_id BIGINT"

LEDGER_REPORTS = {
    "payroll_lines": f"{_VOUCHER_LINE}, descripcioncc STRING",
    "income_lines": f"{_VOUCHER_LINE}, descipcioncc STRING",
    "expense_detail": f"{_EXPENSE}, descripciondetalle STRING, {_EXPENSE_CENTER}, {_EXPENSE_ACCOUNT}",
    "expense_detail_basic": f"{_EXPENSE}, descripciondetalle STRING, {_EXPENSE_CENTER}",
    "expense_no_detail": (
        f"mes STRING, ano INT, gastos DOUBLE, detallegasto STRING, {_EXPENSE_CENTER}, {_EXPENSE_ACCOUNT}"
    ),
    "exempt_expense_union": (
        "dgacod STRING, mes STRING, ano INT, cpbnum STRING, cpbnui STRING, desdet STRING, pctcod STRING, "
        "movglosa STRING, gastos DOUBLE, cccod STRING, vessel STRING"
    ),
    "issued_documents": f"{_DOCUMENT}, movglosa STRING, desdoc STRING",
    "issued_documents_union": f"{_DOCUMENT}, monto_neto DOUBLE, movglosa STRING, desdoc STRING",
    "receivables": (
        "cccod STRING, dgacod STRING, mes STRING, ano INT, movfe TIMESTAMP_NTZ, cpbnum STRING, pctcod STRING, "
        "codaux STRING, movglosa STRING, gastos DOUBLE"
    ),
    "intercompany_ledger": (
        "cpbano INT, codaux STRING, pctcod STRING, ttdcod STRING, desdoc STRING, numdoc STRING, "
        "movfe TIMESTAMP_NTZ, movfv TIMESTAMP_NTZ, movtipdocref STRING, movnumdocref STRING, cpbnum STRING, "
        "cpbfec TIMESTAMP_NTZ, movdebe DOUBLE, movhaber DOUBLE, movglosa STRING, cpbest STRING"
    ),
    "account_month_balance": "mes STRING, ano INT, gastos DOUBLE, codigo STRING",
    "voucher_balance": (
        "pccodi STRING, pcdesc STRING, cpbnum STRING, cpbtip STRING, cpbnui STRING, codaux STRING, ttdcod STRING, "
        "mes STRING, ano INT, saldo DOUBLE, movglosa STRING"
    ),
    "spent_vs_billed": (
        "mes STRING, ano INT, gastos_afectos DOUBLE, facturado_neto DOUBLE, gastos_por_facturar DOUBLE, "
        "vessel STRING, cc STRING"
    ),
    "import_costs": "mes STRING, ano INT, gastos DOUBLE, vessel STRING, cc STRING, dgacod STRING",
    "sales_documents": (
        "tipo STRING, folio BIGINT, netos DOUBLE, mes INT, year INT, codaux STRING, nomaux STRING"
    ),
    "product_month_sales": (
        "year STRING, month STRING, tipo STRING, codbode STRING, codprod STRING, mes STRING, total DOUBLE, "
        "desprod STRING, codgrupo STRING, codsubgr STRING, codumed STRING, ctaactivo STRING, ctaventas STRING, "
        "ctacosto STRING, fechaulmod TIMESTAMP_NTZ"
    ),
    "product_attribute": (
        "codigo STRING, desripcion STRING, grupo STRING, subgrupo STRING, peso STRING, ctaactivo STRING, "
        "ctaventas STRING, ctagastos STRING, ctacosto STRING"
    ),
}

ERP_REPORTS = {
    "customer_invoices": f"client STRING, vessel STRING, codigo STRING, {_INVOICE}",
    "supplier_bills": f"{_INVOICE}, supplier STRING, company STRING",
    "product_movements": (
        "id BIGINT, partner_name STRING, orders BIGINT, producto STRING, p_id BIGINT, monto DOUBLE, "
        "cantidad DOUBLE, last_order TIMESTAMP_NTZ, company_id BIGINT, company_name STRING, ano INT, "
        "producto_descripcion STRING"
    ),
    "company_account_balance": _ACCOUNT_BALANCE,
    "company_account_month": f"{_ACCOUNT_BALANCE}, ano INT, mes INT",
    "income_statement_year": _ACCOUNT_BALANCE,
    "partner_residual": "saldo DOUBLE, partner_id BIGINT, partner STRING, company_id BIGINT, vessel STRING",
    "cash_basis_balance": (
        "saldo DOUBLE, company_id BIGINT, vessel STRING, journal_id BIGINT, account_id BIGINT"
    ),
}
