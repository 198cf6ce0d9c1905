"""Input tables: columns and types after cleaning, and the table names they have in the source databases.

Codes are strings in the source databases; a deployment whose codes are numbers may keep them as numbers.
"""

from __future__ import annotations

# Header-line key of a voucher.
VOUCHER_KEY = ("cpbano", "cpbnum", "areacod")

# The columns of the source databases.
LEDGER_COLUMNS = {
    "lines": "cpbano INT, cpbnum STRING, areacod STRING, cpbmes STRING, pctcod STRING, cccod STRING, dgacod STRING, "
    "codaux STRING, ttdcod STRING, numdoc STRING, movfe TIMESTAMP_NTZ, movfv TIMESTAMP_NTZ, movtipdocref STRING, "
    "movnumdocref STRING, movdebe DECIMAL(18,2), movhaber DECIMAL(18,2), movglosa STRING",
    "headers": "cpbano INT, cpbnum STRING, areacod STRING, cpbmes STRING, cpbtip STRING, cpbnui STRING, "
    "cpbest STRING, cpbfec TIMESTAMP_NTZ",
    "centers": "codicc STRING, desccc STRING",
    "details": "coddet STRING, desdet STRING",
    "accounts": "pccodi STRING, pcdesc STRING",
    "doc_types": "coddoc STRING, desdoc STRING",
    "counterparties": "codaux STRING, nomaux STRING",
    "sales_docs": "tipo STRING, folio BIGINT, netoafecto DECIMAL(18,2), netoexento DECIMAL(18,2), "
    "fecha TIMESTAMP_NTZ, codaux STRING, estado STRING",
    "month_sales": "mes STRING, tipo STRING, codbode STRING, codprod STRING, total DECIMAL(18,2)",
    "products": "codprod STRING, desprod STRING, codgrupo STRING, codsubgr STRING, codumed STRING, "
    "ctaactivo STRING, ctaventas STRING, ctacosto STRING, ctagastos STRING, fechaulmod TIMESTAMP_NTZ",
    "product_attributes": "codigo STRING, codtat INT, valor STRING",
}

ERP_COLUMNS = {
    "move_lines": "id BIGINT, account_id BIGINT, company_id BIGINT, partner_id BIGINT, journal_id BIGINT, "
    "balance DECIMAL(18,2), amount_residual DECIMAL(18,2), balance_cash_basis DECIMAL(18,2), date TIMESTAMP_NTZ, "
    "write_date TIMESTAMP_NTZ",
    "accounts": "id BIGINT, code STRING, name STRING",
    "companies": "id BIGINT, name STRING",
    "partners": "id BIGINT, name STRING",
    "invoices": "id BIGINT, name STRING, type STRING, state STRING, date TIMESTAMP_NTZ, date_invoice TIMESTAMP_NTZ, "
    "partner_id BIGINT, company_id BIGINT, residual_company_signed DECIMAL(18,2), write_date TIMESTAMP_NTZ",
    "invoice_lines": "id BIGINT, name STRING, partner_id BIGINT, product_id BIGINT, invoice_id BIGINT, "
    "company_id BIGINT, price_subtotal_signed DECIMAL(18,2), quantity DOUBLE, write_date TIMESTAMP_NTZ",
    "product_variants": "id BIGINT, product_tmpl_id BIGINT",
    "product_templates": "id BIGINT, name STRING",
}

# Columns whose values are text for readers, not codes.
DESCRIPTIONS = frozenset(
    {"desccc", "desdet", "pcdesc", "desdoc", "nomaux", "movglosa", "desprod", "valor"}
)

# The column beside a code by which a collated ledger compares it.
KEY = "_key"

# The year of a voucher as the source spells it, where that is text; added by cleaning.
YEAR_KEY = "cpbano_key"

# Table names in the source databases.
LEDGER_TABLES = {
    "lines": "cwmovim",
    "headers": "cwcpbte",
    "centers": "cwtccos",
    "details": "cwtdetg",
    "accounts": "cwpctas",
    "doc_types": "cwttdoc",
    "counterparties": "cwtauxi",
    "sales_docs": "iw_gsaen",
    "month_sales": "iw_ventasmes",
    "products": "iw_tprod",
    "product_attributes": "iw_tprodtvatrv",
}

ERP_TABLES = {
    "move_lines": "account_move_line",
    "accounts": "account_account",
    "companies": "res_company",
    "partners": "res_partner",
    "invoices": "account_invoice",
    "invoice_lines": "account_invoice_line",
    "product_variants": "product_product",
    "product_templates": "product_template",
}


def column_names(ddl: str) -> list[str]:
    """Names out of ``name TYPE, name TYPE(p,s)``."""
    return [part.split()[0] for part in ddl.split(", ")]
