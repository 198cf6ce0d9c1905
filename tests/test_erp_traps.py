from __future__ import annotations

from datetime import datetime

from tallyloom.plans import replica
from tests.literal import FEB, JAN, erp, money, rows


def move(partner=1, account=1, company=1, balance=0, residual=0, cash=0, date=JAN):
    return (1, account, company, partner, 7, money(balance), money(residual), money(cash), date, JAN)


def invoice(id, name="N", type="out_invoice", state="open", residual=1, partner=1, date=JAN):
    return (id, name, type, state, date, date, partner, 1, money(residual), JAN)


def test_residuals_that_cancel_are_excluded(spark):
    data = erp(spark, move_lines=[move(1, residual=v) for v in (0.1, 0.2, -0.3)] + [move(2, residual=5)])
    assert rows(replica.partner_residual(data), "partner", "saldo") == [("P2", 5.0)]


def test_accounts_with_the_same_code_and_name_are_summed(spark):
    data = erp(spark, move_lines=[move(account=1, balance=1), move(account=2, balance=2), move(account=3, balance=4),
                                  move(account=99, balance=8), move(company=9, balance=16)])
    assert rows(replica.company_account_balance(data), "codigo", "saldo") == [("100", 3.0), ("200", 4.0)]


def test_year_is_taken_from_the_date(spark):
    edges = [datetime(2019, 12, 31, 23, 59, 59), datetime(2020, 1, 1), datetime(2020, 12, 31, 23), datetime(2021, 1, 1)]
    data = erp(spark, move_lines=[move(balance=2**i, date=d) for i, d in enumerate(edges)])
    assert rows(replica.income_statement_year(data, year=2020), "saldo") == [(6.0,)]
    assert rows(replica.income_statement_year(data)) == []


def test_cash_basis_needs_a_partner(spark):
    data = erp(spark, move_lines=[move(partner=1, cash=1), move(partner=None, cash=2), move(partner=99, cash=4)])
    assert rows(replica.cash_basis_balance(data, accounts=[1]), "saldo") == [(1.0,)]


def test_invoice_filters(spark):
    data = erp(
        spark,
        invoices=[
            invoice(1), invoice(2, name=None), invoice(3, type="in_invoice", residual=0),
            invoice(4, type="in_invoice", state="cancel"), invoice(5, type="in_invoice", state=None, partner=2),
            invoice(6, partner=None),
        ],
    )
    assert rows(replica.customer_invoices(data), "id", "client") == [(1, "P1")]
    assert rows(replica.supplier_bills(data), "id") == [(3,), (4,), (5,)]
    assert rows(replica.supplier_bills(data, open_only=True), "id") == [(4,), (5,)]
    assert rows(replica.supplier_bills(data, cancelled_state="cancel"), "id") == [(3,)]
    assert rows(replica.supplier_bills(data, partner_id=2), "id") == [(5,)]


def test_invoices_come_latest_first(spark):
    data = erp(spark, invoices=[invoice(1, date=JAN), invoice(2, date=FEB, name="A"), invoice(3, date=FEB, name="B")])
    assert [r["id"] for r in replica.customer_invoices(data).collect()] == [3, 2, 1]


def test_hidden_keys_keep_groups_apart(spark):
    def bought(id, invoice, product=10, amount=1):
        return (id, "text", 1, product, invoice, 1, money(amount), 2.0, JAN)

    data = erp(
        spark,
        invoices=[invoice(1, date=JAN), invoice(2, date=FEB), invoice(3, date=FEB)],
        invoice_lines=[
            bought(1, 1), bought(2, 2), bought(3, 3), bought(4, 1, product=None), bought(5, 1, product=77),
            bought(6, 1, product=11), bought(7, 404),
        ],
    )
    report = replica.product_movements(data)
    assert rows(report, "orders", "producto", "p_id", "monto", "cantidad", "ano") == sorted(
        [
            (1, "Bolt", 100, 1.0, 2.0, 2020),
            (2, "Bolt", 100, 2.0, 4.0, 2020),
            (1, None, None, 1.0, 2.0, 2020),
            (1, None, None, 1.0, 2.0, 2020),
            (1, None, None, 1.0, 2.0, 2020),
        ],
        key=repr,
    )
