"""The registered queries as ANSI SQL over the same test tables, written independently of the DataFrame plans."""

from __future__ import annotations

MONEY = "decimal(18,2)"
CENTERS = "1, 2, 3, 5, 8, 11, 12, 36, 37"
PARTIES = "1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 101, 144"
EXTENDED = f"cast(l_extendedprice as {MONEY})"
SIGNED = f"case when l_returnflag = 'R' then -{EXTENDED} else {EXTENDED} end"


def _account(key: str) -> str:
    return (
        f"concat(cast({key} % 5 + 1 as varchar), '-', cast({key} % 3 + 1 as varchar), '-', "
        f"lpad(cast({key} % 20 as varchar), 2, '0'))"
    )


VIEWS = {
    "lines": f"""
        select cast(1995 + l_orderkey % 7 as int) as ano, l_orderkey as num, l_orderkey % 5 as area,
               lpad(cast(month(l_shipdate) - 1 as varchar), 2, '0') as mes, {_account("l_partkey")} as pct,
               l_suppkey as cc, concat('NATION_', cast(l_partkey % 26 as varchar)) as dga,
               cast(floor(l_orderkey / 10) as bigint) as aux, cast(l_linenumber % 6 as int) as ttd,
               l_orderkey * 10 + l_linenumber as numdoc, l_shipdate as movfe,
               l_shipdate + interval 30 days as movfv, l_returnflag as refkind, l_orderkey as refnum,
               case when l_returnflag = 'R' then 0 else {EXTENDED} end as debe,
               case when l_returnflag = 'R' then {EXTENDED} else 0 end as haber,
               concat(l_returnflag, l_linestatus, ' ', cast(cast(l_quantity as int) as varchar)) as glosa
        from lineitem""",
    "headers": """
        select cast(1995 + o_orderkey % 7 as int) as ano, o_orderkey as num, o_orderkey % 5 as area,
               lpad(cast(month(o_orderdate) - 1 as varchar), 2, '0') as mes, o_orderpriority as tip,
               o_custkey as nui, o_orderstatus as est, o_orderdate as fec
        from orders""",
    "centers": "select s_suppkey as cc, s_name as name from supplier",
    "details": "select n_name as dga, concat('Detail ', cast(n_nationkey as varchar)) as name from nation",
    "accounts": f"select {_account('p_partkey')} as pct, min(p_name) as name from part group by 1",
    "doctypes": "select r_regionkey as ttd, r_name as name from region",
    "parties": "select c_custkey as aux, c_name as name from customer",
    "invoices": f"""
        select o_orderkey as id,
               case when o_orderpriority <> '4-NOT SPECIFIED' then concat('DOC/', cast(o_orderkey as varchar)) end
                   as name,
               o_orderstatus as type, o_orderpriority as state, o_orderdate as date,
               o_orderdate + interval 1 day as date_invoice, o_custkey as partner_id, o_orderkey % 26 as company_id,
               cast(case when o_custkey % 3 = 0 then 0 else o_totalprice end as {MONEY}) as residual_company_signed,
               o_orderdate as write_date
        from orders""",
    "moves": f"""
        select l_partkey as account_id, l_orderkey % 26 as company_id,
               case when l_linenumber <> 7 then cast(floor(l_orderkey / 10) as bigint) end as partner_id,
               cast(l_linenumber as bigint) as journal_id, {SIGNED} as balance,
               case when l_linestatus = 'O' then {SIGNED} else 0 end as residual,
               case when l_linestatus = 'F' then {SIGNED} else 0 end as cash, l_shipdate as date
        from lineitem""",
    "companies": "select cast(n_nationkey as bigint) as id, n_name as name from nation",
    "erp_accounts": "select p_partkey as id, p_brand as code, p_type as name from part",
}

VIEWS_OF_BATCHES = """
    first_copy as (select * from invoices where date < timestamp '2000-01-01'),
    batch as (
        select * replace (
            cast(residual_company_signed + 1 as decimal(18,2)) as residual_company_signed,
            case when state = '5-LOW' then write_date - interval 10 days else write_date + interval 400 days end
                as write_date)
        from invoices where date >= timestamp '1999-07-01')"""


def _sql(views: str, body: str, extra: str = "") -> str:
    parts = [f"{name} as ({VIEWS[name]})" for name in views.split()]
    if extra:
        parts.append(extra)
    return f"with {', '.join(parts)} {body}"


HEADER = "join headers h on h.ano = l.ano and h.num = l.num and h.area = l.area"
CENTER = "join centers c on c.cc = l.cc"
DETAIL = "join details d on d.dga = l.dga"
ACCOUNT = "join accounts a on a.pct = l.pct"
DOCTYPE = "join doctypes t on t.ttd = l.ttd"
PARTY = "join parties p on p.aux = l.aux"


def _voucher_lines(where: str, amount: str = "l.debe - l.haber", center: str = "descripcioncc") -> str:
    return _sql(
        "lines headers centers details",
        f"""select l.dga as dgacod, h.mes as mes, h.ano as ano, h.num as cpbnum, h.tip as cpbtip, h.nui as cpbnui,
                   l.pct as pctcod, l.glosa as glosa, cast({amount} as double) as saldo, l.cc as cccod,
                   c.name as {center}
            from lines l {HEADER} {CENTER} {DETAIL} where {where}""",
    )


def _expenses(columns: str, joins: str, where: str = "true", detail: str = "dgacod") -> str:
    return _sql(
        "lines headers centers details accounts",
        f"""select l.mes as mes, l.ano as ano, cast(l.debe - l.haber as double) as gastos, l.dga as {detail},
                   l.glosa as glosa, l.cc as cccod, c.name as descripcioncc{columns}
            from lines l {HEADER} {CENTER} {joins} where {where}""",
    )


DETAIL_COLUMNS = ", d.name as descripciondetalle"
ACCOUNT_COLUMNS = ", l.pct as codigo, a.name as descripcion"


def _expense_detail(where: str = "true") -> str:
    return _expenses(DETAIL_COLUMNS + ACCOUNT_COLUMNS, f"{DETAIL} {ACCOUNT}", where)


def _month_balance(where: str = "true", company: str = "", year: str = "l.ano") -> str:
    shown = f"{company} as company, " if company else ""
    grouped = f", {company}" if company else ""
    return _sql(
        "lines headers",
        f"""select {shown}l.mes as mes, {year} as ano, cast(sum(l.debe - l.haber) as double) as gastos, l.pct as codigo
            from lines l {HEADER} where l.mes <> '00' and h.est = 'F' and {where}
            group by l.pct, l.mes, l.ano{grouped}""",
    )


def _voucher_balance(having: str) -> str:
    return _sql(
        "lines headers accounts",
        f"""select a.pct as pccodi, a.name as pcdesc, h.num as cpbnum, h.tip as cpbtip, h.nui as cpbnui,
                   l.aux as codaux, l.ttd as ttdcod, l.mes as mes, l.ano as ano,
                   cast(sum(l.debe - l.haber) as double) as saldo, l.glosa as movglosa
            from lines l {HEADER} {ACCOUNT} where h.est = 'F' and h.mes <> '00'
            group by a.pct, a.name, h.num, h.tip, h.nui, l.aux, l.ttd, l.mes, l.ano, l.glosa
            having {having}""",
    )


TAIL = "ltrim(right(rtrim(c.name), 7))"
COMPANY = "concat('CO', cast(l.num % 4 as varchar))"


def _side(name: str, accounts: str, company: str) -> str:
    return f"""
        {name} as (
            select {company} as company, l.mes, l.ano, l.cc, {TAIL} as vessel, sum(l.debe - l.haber) as amount
            from lines l {HEADER} {CENTER} {DETAIL}
            where h.est = 'F' and ({accounts}) and l.cc in ({CENTERS})
            group by 1, l.mes, l.ano, l.cc, c.name)"""


def _spent_vs_billed(
    keyed: bool = False, spent: str = "l.pct in ('1-1-00', '2-2-01', '4-1-03')", company: str = ""
) -> str:
    def key(name: str) -> str:
        return f"coalesce(g.{name}, f.{name})" if keyed else f"g.{name}"

    shown = "coalesce(g.company, f.company) as company, " if company else ""
    grouped = "coalesce(g.company, f.company), " if company else ""
    scope = company or "''"
    year, center = (key(name) if keyed else f"cast({key(name)} as varchar)" for name in ("ano", "cc"))
    return _sql(
        "lines headers centers details",
        f"""select {shown}{key("mes")} as mes, {year} as ano,
                   cast(coalesce(sum(g.amount), 0) as double) as gastos_afectos,
                   cast(coalesce(sum(f.amount), 0) as double) as facturado_neto,
                   cast(coalesce(sum(g.amount), 0) + coalesce(sum(f.amount), 0) as double) as gastos_por_facturar,
                   {key("vessel")} as vessel, {center} as cc
            from g full outer join f on f.company = g.company and f.ano = g.ano and f.mes = g.mes
                 and f.vessel = g.vessel and f.cc = g.cc
            group by {grouped}{key("ano")}, {key("mes")}, {key("vessel")}, {key("cc")}""",
        f"{_side('g', spent, scope)}, {_side('f', 'l.pct in (' + BILLED + ')', scope)}",
    )


BILLED = "'3-3-02', '5-2-04'"


def _exempt(account: str) -> str:
    return f"""
        select l.dga as dgacod, l.mes as mes, l.ano as ano, h.num as cpbnum, h.nui as cpbnui, d.name as desdet,
               l.pct as pctcod, l.glosa as movglosa, cast(l.debe - l.haber as double) as gastos, l.cc as cccod,
               {TAIL} as vessel
        from lines l {HEADER} {CENTER} {DETAIL} where h.est = 'F' and l.mes <> '00' and l.pct = '{account}'"""


def _documents(vessel: str, where: str, net: bool) -> str:
    net_column = "cast(l.debe - l.haber as double) / cast(1.19 as double) as monto_neto," if net else ""
    return f"""
        select cast(year(l.movfe) as int) as ano, cast(month(l.movfe) as int) as mes, '{vessel}' as vessel,
               l.ttd as coddoc, l.numdoc as numdoc, l.aux as codaux, p.name as nomaux, l.movfe as movfe,
               l.mes as cpbmes, l.ano as cpbano, cast(l.debe - l.haber as double) as monto_facturado, {net_column}
               l.glosa as movglosa, t.name as desdoc
        from lines l {HEADER} {DOCTYPE} {PARTY} where h.est = 'F' and l.mes <> '00' and ({where})"""


def _intercompany(where: str) -> str:
    return _sql(
        "lines headers doctypes",
        f"""select h.ano as cpbano, l.aux as codaux, l.pct as pctcod, l.ttd as ttdcod, t.name as desdoc,
                   l.numdoc as numdoc, l.movfe as movfe, l.movfv as movfv, l.refkind as movtipdocref,
                   l.refnum as movnumdocref, h.num as cpbnum, h.fec as cpbfec, cast(l.debe as double) as movdebe,
                   cast(l.haber as double) as movhaber, l.glosa as movglosa, h.est as cpbest
            from lines l {HEADER} {DOCTYPE}
            where h.num <> 0 and h.est = 'F' and l.aux in (7, 79, 142) and {where}""",
    )


def _sales_documents(where: str = "true") -> str:
    return f"""
        select o_orderpriority as tipo, o_orderkey as folio,
               cast(cast(o_totalprice as {MONEY})
                    + case when o_custkey % 10 <> 0 then cast(o_custkey % 100 as {MONEY}) end as double) as netos,
               cast(month(o_orderdate) as int) as mes, cast(year(o_orderdate) as int) as year,
               c_custkey as codaux, c_name as nomaux
        from orders join customer on c_custkey = o_custkey
        where o_orderstatus = 'F' and o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM') and {where}"""


INVOICE_COLUMNS = """i.id, i.name, i.type, i.state, i.date, i.date_invoice, i.partner_id, i.company_id,
    cast(i.residual_company_signed as double) as residual_company_signed, i.write_date"""
INVOICE_JOINS = "from invoices i join customer on c_custkey = i.partner_id join companies k on k.id = i.company_id"


def _bills(where: str) -> str:
    return _sql(
        "invoices companies",
        f"""select {INVOICE_COLUMNS}, c_name as supplier, k.name as company {INVOICE_JOINS}
            where i.type = 'F' and {where}""",
    )


def _account_balance(where: str = "true", periods: str = "", grouped: str = "") -> str:
    return _sql(
        "moves companies erp_accounts",
        f"""select k.name as vessel, a.name as cuenta, cast(sum(m.balance) as double) as saldo, a.code as codigo,
                   k.id as company_id{periods}
            from moves m join erp_accounts a on a.id = m.account_id join companies k on k.id = m.company_id
            where {where} group by a.code, a.name, k.id, k.name{grouped}""",
    )


def _merged(batch_where: str = "true") -> str:
    return _sql(
        "invoices",
        f"""select {INVOICE_COLUMNS} from (
                select *, row_number() over (partition by id order by write_date desc, source desc) as rank
                from (select *, 0 as source from first_copy
                      union all select *, 1 as source from batch where {batch_where})) i
            where rank = 1""",
        VIEWS_OF_BATCHES,
    )


ORACLE_SQL: dict[str, str] = {
    "payroll_lines": _voucher_lines("l.dga like 'NATION_1%'"),
    "payroll_lines_posted": _voucher_lines("l.dga like 'NATION_1%' and h.est = 'F'"),
    "payroll_lines_center": _voucher_lines("l.dga like 'NATION_1%' and h.est = 'F' and l.cc = 5"),
    "payroll_lines_account": _voucher_lines("l.pct = '4-1-03' and h.est = 'F'"),
    "income_lines": _voucher_lines("l.pct like '4%' and h.est = 'F'", "-l.debe + l.haber", "descipcioncc"),
    "income_lines_center": _voucher_lines(
        "l.pct like '4%' and h.est = 'F' and l.cc = 5", "-l.debe + l.haber", "descipcioncc"
    ),
    "income_lines_from_year": _voucher_lines(
        "l.pct like '4%' and h.est = 'F' and l.ano >= 1999", "-l.debe + l.haber", "descipcioncc"
    ),
    "expense_detail": _expense_detail(),
    "expense_detail_from_year": _expense_detail("l.ano > 1999"),
    "expense_detail_excl": _expense_detail("l.ano > 1998 and l.cc = 5 and l.dga not like 'NATION_1%'"),
    "expense_detail_center": _expense_detail("l.ano > 1998 and l.cc = 5"),
    "expense_detail_basic": _expenses(DETAIL_COLUMNS, DETAIL),
    "expense_center": _expenses(DETAIL_COLUMNS, DETAIL, "l.cc = 3"),
    "expense_no_detail": _expenses(ACCOUNT_COLUMNS, ACCOUNT, "l.ano >= 1996", "detallegasto"),
    "sales_documents": _sales_documents(),
    "sales_documents_from_year": _sales_documents("year(o_orderdate) >= 1999"),
    "account_month_balance": _month_balance(),
    "account_month_balance_from_year": _month_balance("l.ano >= 1998"),
    "voucher_balance_accounts": _voucher_balance(
        "a.pct like '1-1-%' or a.pct like '2-3-%' or a.pct = '3-3-02' or a.pct = '4-1-03'"
    ),
    "current_account_balance": _voucher_balance(
        f"a.pct in ('1-1-00', '2-2-01', '3-3-02', '4-1-03') and l.aux in ({PARTIES})"
    ),
    "current_account_balance_all": _voucher_balance("a.pct in ('1-1-00', '2-2-01', '3-3-02', '4-1-03')"),
    "spent_vs_billed": _spent_vs_billed(),
    "spent_vs_billed_outer_join": _spent_vs_billed(),
    "spent_vs_billed_keyed": _spent_vs_billed(keyed=True),
    "exempt_expense_union": _sql(
        "lines headers centers details", f"{_exempt('1-1-00')} union {_exempt('4-1-03')}"
    ),
    "import_costs": _sql(
        "lines headers centers details",
        f"""select l.mes as mes, l.ano as ano, cast(sum(l.debe - l.haber) as double) as gastos, {TAIL} as vessel,
                   l.cc as cc, l.dga as dgacod
            from lines l {HEADER} {CENTER} {DETAIL}
            where h.est = 'F' and h.mes <> '00' and l.pct in ('1-1-00', '2-2-01', '4-1-03') and l.cc in ({CENTERS})
              and l.dga in ('NATION_1', 'NATION_3', 'NATION_5', 'NATION_8', 'NATION_15', 'NATION_21')
            group by l.mes, l.ano, c.name, l.cc, l.dga""",
    ),
    "issued_documents": _sql("lines headers doctypes parties", _documents("A", "l.aux = 101", net=False)),
    "issued_documents_union": _sql(
        "lines headers doctypes parties",
        " union ".join(
            [
                _documents("A", "l.aux in (10, 20) or p.name like '%#00000001%'", net=True),
                _documents("B", "l.aux in (11, 21) or p.name like '%#00000002%'", net=True),
                _documents("C", "lower(p.name) like '%mer#00000010%'", net=True),
            ]
        ),
    ),
    "receivables": _sql(
        "lines headers",
        f"""select l.cc as cccod, l.dga as dgacod, l.mes as mes, l.ano as ano, l.movfe as movfe, l.num as cpbnum,
                   l.pct as pctcod, l.aux as codaux, l.glosa as movglosa, cast(l.debe - l.haber as double) as gastos
            from lines l {HEADER}
            where h.est = 'F' and l.pct like '4-%' and l.aux in ({PARTIES}) and cast(l.mes as int) <> 0""",
    ),
    "intercompany_ledger": _intercompany("(l.pct like '1-%' or l.pct like '2-%')"),
    "intercompany_ledger_from_year": _intercompany(
        "h.ano >= 1998 and (l.pct like '1-%' or l.pct like '2-%' or l.pct like '3-%')"
    ),
    "product_month_sales": f"""
        with sales as (
            select cast(year(l_shipdate) * 100 + month(l_shipdate) as varchar) as mes, l_returnflag as tipo,
                   l_linestatus as codbode, case when l_linenumber = 7 then -l_partkey else l_partkey end as product,
                   sum({EXTENDED}) as total
            from lineitem group by 1, 2, 3, 4),
        products as (
            select p_partkey, p_name as desprod, p_brand as codgrupo, p_type as codsubgr, lower(p_type) as codumed,
                   {_account("p_partkey")} as ctaactivo, {_account("(p_partkey + 1)")} as ctaventas,
                   {_account("(p_partkey + 2)")} as ctacosto, timestamp '2000-01-01' + to_days(p_size) as fechaulmod
            from part)
        select left(s.mes, 4) as year, right(s.mes, 2) as month, s.tipo, s.codbode,
               cast(s.product as varchar) as codprod, s.mes, cast(s.total as double) as total, desprod, codgrupo,
               codsubgr, codumed, ctaactivo, ctaventas, ctacosto, fechaulmod
        from sales s left join products on p_partkey = s.product""",
    "product_attribute": f"""
        select cast(p.p_partkey as varchar) as codigo, p.p_name as desripcion, p.p_brand as grupo,
               p.p_type as subgrupo, v.valor as peso, {_account("p.p_partkey")} as ctaactivo,
               {_account("(p.p_partkey + 1)")} as ctaventas, {_account("(p.p_partkey + 3)")} as ctagastos,
               {_account("(p.p_partkey + 2)")} as ctacosto
        from part p left join (
            select p_partkey, concat(p_brand, '/', cast(p_size as varchar)) as valor from part where p_size % 3 = 1) v
            on v.p_partkey = p.p_partkey
        where cast(p.p_partkey as varchar) not like '19%'""",
    "multi_company_report": _month_balance(company=COMPANY),
    "company_partitioned_snapshot": _month_balance(company=COMPANY),
    "multi_company_lines": _sql(
        "lines headers centers details",
        f"""select {COMPANY} as company, l.dga as dgacod, h.mes as mes, h.ano as ano, h.num as cpbnum,
                   h.tip as cpbtip, h.nui as cpbnui, l.pct as pctcod, l.glosa as glosa,
                   cast(l.debe - l.haber as double) as saldo, l.cc as cccod, c.name as descripcioncc
            from lines l {HEADER} {CENTER} {DETAIL}
            where h.est = 'F' and ((l.num % 4 = 0 and l.dga like 'NATION_1%')
               or (l.num % 4 = 1 and l.dga like 'NATION_2%') or (l.num % 4 = 3 and l.dga = 'NATION_7'))""",
    ),
    "multi_company_spent_vs_billed": _spent_vs_billed(
        spent="(l.num % 4 = 0 and l.pct = '1-1-00') or (l.num % 4 = 1 and l.pct = '2-2-01')"
        " or (l.num % 4 = 2 and l.pct = '4-1-03')",
        company=COMPANY,
    ),
    "customer_invoices": _sql(
        "invoices companies",
        f"""select c_name as client, k.name as vessel, i.name as codigo, {INVOICE_COLUMNS} {INVOICE_JOINS}
            where i.type = 'O' and i.name is not null""",
    ),
    "supplier_bills": _bills("true"),
    "supplier_bills_open": _bills("i.residual_company_signed <> 0"),
    "supplier_bills_partner": _bills("i.partner_id in (14, 55, 145) and i.state <> '5-LOW'"),
    "product_movements": _sql(
        "invoices companies",
        f"""select line.partner_id as id, c_name as partner_name, count(line.id) as orders, tmpl.p_name as producto,
                   cast(tmpl.p_partkey as varchar) as p_id, cast(sum(line.amount) as double) as monto,
                   sum(line.quantity) as cantidad, max(line.write_date) as last_order,
                   line.company_id as company_id, k.name as company_name,
                   cast(extract(year from i.date_invoice) as int) as ano, line.name as producto_descripcion
            from (select l_orderkey * 10 + l_linenumber as id, cast(floor(l_orderkey / 10) as bigint) as partner_id,
                         case when l_linenumber <> 7 then l_partkey end as product_id, l_orderkey as invoice_id,
                         l_orderkey % 26 as company_id, {SIGNED} as amount, l_quantity as quantity,
                         l_shipdate as write_date, concat(l_returnflag, '/', l_linestatus) as name
                  from lineitem) line
            left join part variant on variant.p_partkey = line.product_id
            left join part tmpl on tmpl.p_partkey = variant.p_partkey - variant.p_partkey % 2
            join customer on c_custkey = line.partner_id
            join companies k on k.id = line.company_id
            join invoices i on i.id = line.invoice_id
            group by line.partner_id, c_name, line.product_id, tmpl.p_name, line.company_id, k.name, i.date_invoice,
                     tmpl.p_partkey, line.name""",
    ),
    "company_account_balance": _account_balance(),
    "company_account_month": _account_balance(
        periods=", cast(extract(year from m.date) as int) as ano, cast(extract(month from m.date) as int) as mes",
        grouped=", extract(year from m.date), extract(month from m.date)",
    ),
    "income_statement_year": _account_balance("extract(year from m.date) = 1999"),
    "two_target_snapshot": _account_balance("extract(year from m.date) = 1999"),
    "partner_residual": _sql(
        "moves companies",
        """select cast(sum(m.residual) as double) as saldo, m.partner_id as partner_id, c_name as partner,
                  m.company_id as company_id, k.name as vessel
           from moves m join customer on c_custkey = m.partner_id join companies k on k.id = m.company_id
           group by m.partner_id, c_name, m.company_id, k.name having sum(m.residual) <> 0""",
    ),
    "cash_basis_balance": _sql(
        "moves companies",
        """select cast(sum(m.cash) as double) as saldo, m.company_id as company_id, k.name as vessel,
                  m.journal_id as journal_id, m.account_id as account_id
           from moves m join customer on c_custkey = m.partner_id join companies k on k.id = m.company_id
           where m.account_id in (16, 50, 109, 166)
           group by m.company_id, k.name, m.journal_id, m.account_id""",
    ),
    "account_scan": "select p_partkey as id, p_brand as code, p_type as name from part",
    "staged_journal_balance": _month_balance(),
    "colocated_journal_balance": _month_balance(),
    "listed_accounts_balance": _voucher_balance(
        f"(a.pct, l.ano) in (select {_account('p_partkey')}, cast(1995 + p_partkey % 7 as int) from part where p_size = 7)"
    ),
    "cleaned_ledger_balance": _month_balance(year="case when l.ano <> 1996 then cast(l.ano as varchar) end"),
    "replicated_erp_balance": _account_balance(),
    "staged_ledger_detail": _expense_detail(),
    "collated_ledger_detail": _sql(
        "lines headers centers details accounts",
        f"""select l.mes as mes, l.ano as ano, cast(l.debe - l.haber as double) as gastos,
                   case l.num % 3 when 1 then lower(l.dga) when 2 then 'Nation' || substr(l.dga, 7) else l.dga end as dgacod,
                   l.glosa as glosa, l.cc as cccod, c.name as descripcioncc, d.name as descripciondetalle,
                   case l.num % 3 when 0 then 'a' else 'A' end || l.pct as codigo, a.name as descripcion
            from lines l {HEADER} {CENTER} {DETAIL} {ACCOUNT} where l.dga like 'NATION_1%' or l.dga = 'NATION_2'""",
    ),
    "collated_account_balance": _sql(
        "lines headers",
        f"""select l.mes as mes, l.ano as ano, cast(sum(l.debe - l.haber) as double) as gastos,
                   min(case l.num % 3 when 0 then 'a' else 'A' end || l.pct) as codigo
            from lines l {HEADER} where l.mes <> '00' and h.est = 'F' group by l.pct, l.mes, l.ano""",
    ),
    "snapshot_full_refresh": _month_balance(),
    "nan_cleanup": """
        select l_orderkey, l_linenumber, l_quantity, case when l_tax <> 0 then l_tax end as l_tax from lineitem""",
    "run_log_latest": """
        select user_id as report, ts as started_at, event_id, event_type as status from (
            select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rank from events)
        where rank = 1""",
    "incremental_extract": "select * from events where ts > timestamp '2024-01-20 00:00:00'",
    "upsert_merge": _merged(),
    "streaming_replication": _merged(),
    "replication": _merged("write_date > timestamp '2000-01-01'"),
    "replica_repair": _sql("invoices", f"select {INVOICE_COLUMNS} from invoices i where i.id % 37 <> 5"),
    "watermark_advance": "select max(o_orderdate) as cutoff from orders",
    "newest_snapshot_load": "select * from customer",
    "report_job_log": _sql(
        "lines headers centers details accounts",
        f"""select 'balance' as report, 'ok' as status, count(*) as row_count from (
                select 1 from lines l {HEADER} where l.mes <> '00' and h.est = 'F' group by l.pct, l.mes, l.ano)
            union all
            select 'income', 'ok', count(*) from lines l {HEADER} {CENTER} {DETAIL}
            where l.pct like '4%' and h.est = 'F'
            union all
            select 'expenses', 'ok', count(*) from lines l {HEADER} {CENTER} {ACCOUNT} where l.ano >= 1996""",
    ),
}
# Sums kept up to date are what the reports give over the whole tables.
ORACLE_SQL["maintained_company_balance"] = ORACLE_SQL["company_account_month"]
ORACLE_SQL["maintained_partner_residual"] = ORACLE_SQL["partner_residual"]
ORACLE_SQL["quarantined_export"] = """
with export as (
    select c_custkey, c_name, c_nationkey, cast(c_acctbal as decimal(18,2)) as balance,
        concat_ws(',', c_custkey::varchar, c_name, c_nationkey::varchar) as start from customer
), read as (
    select *, case when c_custkey % 7 = 3 then start || ',n/a' when c_custkey % 7 = 5 then start || ',' || balance::varchar || ',x'
        when c_custkey % 11 = 2 then start end as raw from export
)
select cast(c_custkey as bigint) as custkey, c_name as name, cast(c_nationkey as bigint) as nation, cast(balance as double) as balance, raw
from read where raw is null
union all select null, null, null, null, raw from read where raw is not null"""
