"""DuckDB oracle SQL: the ledger derivation as CTEs plus one SELECT per query.

Written independently of the Spark code in the form the reference states it
(self-join carry-forward, correlated-style matchers, UNION-free but plain SQL), so
agreement checks the Spark rewrites (window carry-forward, min_by/max_by matchers,
calendar-bucketed interval join, skew-safe lag). Money uses the same exact integer
recipe on both sides: cents as HUGEINT, one half-up rounding.
"""

from __future__ import annotations

import re

SCALE = 10 ** 12


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def rdiv(n: str, d: str) -> str:
    """round(n/d) half-up for non-negative integers."""
    return f"((({n}) * 2 + ({d})) // (({d}) * 2))"


def from_cents(x: str, p: int = 12) -> str:
    return f"CAST(CAST(({x}) AS DECIMAL(38,0)) * 0.01 AS DECIMAL({p},2))"


def fixed_money(x: str, n: str | None = None, p: int = 28) -> str:
    den = str(SCALE) if n is None else f"(CAST({n} AS HUGEINT) * {SCALE})"
    return from_cents(rdiv(f"CAST({x} AS HUGEINT)", den), p)


MONTHS = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre",
          "octubre", "noviembre", "diciembre"]


def month_name(m: str) -> str:
    arr = ", ".join(f"'{x}'" for x in MONTHS)
    return f"(CASE WHEN ({m}) BETWEEN 1 AND 12 THEN [{arr}][{m}] END)"


def month_title(m: str) -> str:
    n = month_name(m)
    return f"(upper(substring({n}, 1, 1)) || substring({n}, 2, 20))"


def us_week(d: str) -> str:
    return f"CAST(((dayofyear({d}) + dayofweek(date_trunc('year', {d})) - 1) // 7) + 1 AS INTEGER)"


def dmy(d: str) -> str:
    return f"strftime({d}, '%d/%m/%Y')"


def es_ar(x: str) -> str:
    """'1.234.567,89' from a DECIMAL(*,2) (exact, via integer cents)."""
    c = cents(x)
    return (f"(replace(format('{{:,}}', ({c}) // 100), ',', '.') || ',' || "
            f"lpad(CAST(({c}) % 100 AS VARCHAR), 2, '0'))")


def clamp(x: str) -> str:
    return (f"(CASE WHEN ({x}) > 99999999.99 THEN 99999999.99 WHEN ({x}) < -99999999.99 THEN -99999999.99 "
            f"ELSE ({x}) END)")


def xml_escape(x: str) -> str:
    return (f"replace(replace(replace(replace(replace(CAST({x} AS VARCHAR), '&', '&amp;'), '<', '&lt;'), "
            f"'>', '&gt;'), '\"', '&quot;'), '''', '&apos;')")


def xml_el(tag: str, x: str) -> str:
    return f"(CASE WHEN ({x}) IS NULL THEN '' ELSE '<{tag}>' || {xml_escape(x)} || '</{tag}>' END)"


CATS = ["BANCARIOS", "LIMPIEZA", "ADMINISTRACION", "SEGUROS", "GASTOS GENERALES",
        "SERVICIOS PUBLICOS-AGUA", "SERVICIOS PUBLICOS-LUZ"]
PAIR_CAT = {"AF": "BANCARIOS", "AO": "LIMPIEZA", "NF": "ADMINISTRACION", "NO": "GASTOS GENERALES",
            "RF": "SERVICIOS PUBLICOS-AGUA", "RO": "SERVICIOS PUBLICOS-LUZ"}
CHARGE_NO = "(building_id * 100000 + year * 12 + month)"


def _cat_index(c: str) -> str:
    return "(CASE " + " ".join(f"WHEN {c} = '{x}' THEN {i}" for i, x in enumerate(CATS, 1)) + " END)"


def _pair_cat() -> str:
    return "(CASE l_returnflag || l_linestatus " + " ".join(
        f"WHEN '{p}' THEN '{c}'" for p, c in PAIR_CAT.items()) + " END)"


def _due(day: int) -> str:
    return f"least(make_date(year, month, 1) + {day - 1}, last_day(make_date(year, month, 1)))"


_share = lambda col: from_cents(rdiv(f"{cents(f'coalesce({col}, 0)')} * {cents('b.pct')}", "10000"))

_ZERO_ROW = "(b.unit_id % 11 = 0 AND (b.charge_no % 100000) % 12 = 1)"

# ---------------------------------------------------------------------------
LEDGER_CTES: dict[str, str] = {
    "unit": """
SELECT c_custkey AS unit_id, CAST(c_nationkey AS BIGINT) AS building_id,
       CAST(c_custkey // 8 AS VARCHAR) AS floor,
       substring('ABCDEFGH', CAST(c_custkey % 8 AS INTEGER) + 1, 1) AS door,
       CAST(30 + c_custkey % 170 AS DECIMAL(6,2)) AS area,
       CAST(1 + c_custkey % 9 AS DECIMAL(5,2)) AS coef
FROM customer""",
    "building": """
SELECT CAST(n.n_nationkey AS BIGINT) AS building_id, n.n_name AS name, 'Calle ' || n.n_name AS address,
       CAST(coalesce(u.unit_count, 0) AS BIGINT) AS unit_count,
       CAST(coalesce(u.area, 0) AS DECIMAL(18,2)) AS area,
       CAST(2.00 AS DECIMAL(5,2)) AS fee_first, CAST(5.00 AS DECIMAL(5,2)) AS fee_next
FROM nation n LEFT JOIN (SELECT building_id, count(*) AS unit_count, sum(area) AS area FROM unit GROUP BY building_id) u
  ON u.building_id = n.n_nationkey""",
    "person": """
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS dni, c_mktsegment AS first_name,
       'Apellido' || substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST(c_custkey % 26 AS INTEGER) + 1, 1) AS last_name,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'cliente' || CAST(c_custkey AS VARCHAR) || '@correo.com' END AS email,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE '11' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS phone,
       lpad(CAST(c_custkey AS VARCHAR), 22, '0') AS account, c_custkey AS unit_id
FROM customer
UNION ALL
SELECT '9' || lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 'Conviviente',
       'Apellido' || substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST(c_custkey % 26 AS INTEGER) + 1, 1),
       NULL, NULL, '1' || lpad(CAST(c_custkey AS VARCHAR), 21, '0'), c_custkey
FROM customer WHERE c_custkey % 10 = 0""",
    "occupancy": """
SELECT unit_id * 2 + CASE WHEN substring(dni, 1, 1) = '9' THEN 1 ELSE 0 END AS occupancy_id,
       CASE WHEN substring(dni, 1, 1) = '9' OR unit_id % 3 = 0 THEN 'Inquilino' ELSE 'Propietario' END AS role,
       unit_id, dni
FROM person""",
    "storage": "SELECT unit_id AS storage_id, CAST(2 + unit_id % 5 AS DECIMAL(10,2)) AS size, unit_id FROM unit WHERE unit_id % 4 = 0",
    "parking": "SELECT unit_id AS parking_id, CAST(10 + unit_id % 3 AS DECIMAL(10,2)) AS size, unit_id FROM unit WHERE unit_id % 6 = 0",
    "li_sum": f"""
SELECT CAST(s.s_nationkey AS BIGINT) AS building_id, CAST(year(l.l_shipdate) AS INTEGER) AS year,
       CAST(month(l.l_shipdate) AS INTEGER) AS month, {_pair_cat()} AS category,
       sum(CAST(l.l_extendedprice AS DECIMAL(12,2))) AS amount
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
GROUP BY ALL""",
    "resolved": """
SELECT l.building_id, l.year, l.month, l.category, CAST(l.amount AS DECIMAL(18,2)) AS amount
FROM li_sum l JOIN building b ON b.building_id = l.building_id
WHERE l.amount > 0""",
    "totals": "SELECT building_id, year, month, CAST(sum(amount) AS DECIMAL(18,2)) AS total FROM resolved GROUP BY ALL",
    "charge": f"""
SELECT {CHARGE_NO} AS charge_no, building_id, make_date(year, month, 1) AS gen_date,
       {_due(10)} AS due1,
       CASE WHEN {CHARGE_NO} % 13 = 0 THEN NULL ELSE {_due(20)} END AS due2,
       CAST({clamp('total')} AS DECIMAL(10,2)) AS total
FROM totals""",
    "expense": f"""
SELECT {CHARGE_NO} * 10 + {_cat_index('category')} AS expense_id, {CHARGE_NO} AS charge_no, building_id,
       CASE WHEN category = 'GASTOS GENERALES' THEN 'Extraordinario' ELSE 'Ordinario' END AS kind,
       category || ' - ' || {month_name('month')} AS description,
       make_date(year, month, 1) AS issue_date,
       CAST({clamp('amount')} AS DECIMAL(10,2)) AS amount
FROM resolved""",
    "area_tot": "SELECT building_id, CAST(sum(area) AS DECIMAL(18,2)) AS building_area FROM unit GROUP BY building_id",
    "apportion_base": f"""
SELECT charge_no, unit_id, pct, CAST(0 AS DECIMAL(12,2)) AS prior_balance, CAST(0 AS DECIMAL(12,2)) AS received,
       CAST(0 AS DECIMAL(12,2)) AS interest, share AS ordinary, CAST(0 AS DECIMAL(12,2)) AS extraordinary,
       share AS total, share AS debt
FROM (SELECT c.charge_no, u.unit_id,
             {from_cents(rdiv(f"{cents('u.area')} * 10000", cents('t.building_area')), 10)} AS pct,
             {from_cents(rdiv(f"{cents('c.total')} * {cents('u.area')}", cents('t.building_area')))} AS share
      FROM charge c JOIN unit u ON u.building_id = c.building_id JOIN area_tot t ON t.building_id = u.building_id
      WHERE t.building_area > 0) s""",
    "exp_tot": """
SELECT charge_no,
       CAST(sum(CASE WHEN kind = 'Ordinario' THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS sum_ordinary,
       CAST(sum(CASE WHEN kind = 'Extraordinario' THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS sum_extraordinary,
       CAST(sum(amount) AS DECIMAL(18,2)) AS sum_total
FROM expense GROUP BY charge_no""",
    "apportion_final": f"""
SELECT charge_no, unit_id, pct, prior_balance, received, interest, o AS ordinary, e AS extraordinary, t AS total, t AS debt
FROM (SELECT b.charge_no, b.unit_id, b.pct, b.prior_balance, b.received, b.interest,
             CASE WHEN {_ZERO_ROW} THEN CAST(0 AS DECIMAL(12,2)) ELSE {_share('t.sum_ordinary')} END AS o,
             CASE WHEN {_ZERO_ROW} THEN CAST(0 AS DECIMAL(12,2)) ELSE {_share('t.sum_extraordinary')} END AS e,
             CASE WHEN {_ZERO_ROW} THEN CAST(0 AS DECIMAL(12,2)) ELSE {_share('t.sum_total')} END AS t
      FROM apportion_base b JOIN exp_tot t ON t.charge_no = b.charge_no) s""",
    "prev_charge": """
SELECT c.charge_no, (SELECT max(c2.charge_no) FROM charge c2 WHERE c2.building_id = c.building_id
                     AND c2.charge_no < c.charge_no) AS prev_charge_no
FROM charge c""",
    "carried_bal": """
SELECT a.*, CAST(coalesce(p.debt, 0) AS DECIMAL(12,2)) AS bal
FROM apportion_final a JOIN prev_charge pc ON pc.charge_no = a.charge_no
LEFT JOIN apportion_final p ON p.charge_no = pc.prev_charge_no AND p.unit_id = a.unit_id""",
    "carried_int": """
SELECT *, CASE WHEN bal > 0 THEN CAST(bal * 0.05 AS DECIMAL(12,2)) ELSE CAST(0 AS DECIMAL(12,2)) END AS int_
FROM carried_bal""",
    "apportion_carried": """
SELECT charge_no, unit_id, pct, bal AS prior_balance, received, int_ AS interest, ordinary, extraordinary,
       CAST(coalesce(ordinary, 0) + coalesce(extraordinary, 0) + bal + int_ AS DECIMAL(12,2)) AS total,
       CAST(coalesce(ordinary, 0) + coalesce(extraordinary, 0) + bal + int_ AS DECIMAL(12,2)) AS debt
FROM carried_int""",
    "bank": """
SELECT o_orderkey AS source_id,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS pay_date,
       CASE WHEN o_orderkey % 50 = 0 THEN '9999999999999999999999' ELSE lpad(CAST(o_custkey AS VARCHAR), 22, '0') END AS account,
       CAST(o_totalprice AS DECIMAL(12,2)) AS amount
FROM orders""",
    "acct_unit": """
SELECT trim(account) AS account, min(unit_id) AS unit_id FROM person
WHERE account IS NOT NULL AND unit_id IS NOT NULL GROUP BY trim(account)""",
    # the apportionment's keys alone: a charge with expenses times the units of a building with an area
    "appt_month": """
SELECT u.unit_id, date_trunc('month', c.gen_date) AS m, min(c.charge_no) AS charge_no
FROM charge c JOIN unit u ON u.building_id = c.building_id JOIN area_tot t ON t.building_id = u.building_id
WHERE t.building_area > 0 AND c.charge_no IN (SELECT charge_no FROM expense) GROUP BY ALL""",
    "bank_matched": """
SELECT b.source_id, b.pay_date, b.amount, b.account, au.unit_id, am.charge_no
FROM bank b LEFT JOIN acct_unit au ON au.account = b.account
LEFT JOIN appt_month am ON am.unit_id = au.unit_id AND am.m = date_trunc('month', b.pay_date)""",
    "payment": """
SELECT source_id AS payment_id, pay_date, amount, account, unit_id, charge_no FROM bank_matched
WHERE pay_date IS NOT NULL AND amount IS NOT NULL AND amount > 0 AND unit_id IS NOT NULL AND charge_no IS NOT NULL""",
    "paid": "SELECT charge_no, unit_id, sum(amount) AS paid FROM payment GROUP BY ALL",
    "apportionment": """
SELECT a.charge_no, a.unit_id, a.pct, a.prior_balance,
       CAST(coalesce(a.received, 0) + coalesce(p.paid, 0) AS DECIMAL(12,2)) AS received,
       a.interest, a.ordinary, a.extraordinary, a.total,
       CAST(CASE WHEN p.paid IS NULL THEN a.debt
                 WHEN a.total - (coalesce(a.received, 0) + p.paid) < 0 THEN 0
                 ELSE a.total - (coalesce(a.received, 0) + p.paid) END AS DECIMAL(12,2)) AS debt
FROM apportion_carried a LEFT JOIN paid p ON p.charge_no = a.charge_no AND p.unit_id = a.unit_id""",
    "prov_sheet": """
SELECT ['GASTOS BANCARIOS', 'GASTOS DE ADMINISTRACION', 'SEGUROS', 'GASTOS DE LIMPIEZA', 'SERVICIOS PUBLICOS'][CAST(s.s_suppkey % 5 AS INTEGER) + 1] AS category,
       s.s_suppkey, s.s_name, n.n_name AS building_name
FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey""",
    "providers": """
SELECT category,
       CASE WHEN category = 'SERVICIOS PUBLICOS' THEN CASE WHEN s_suppkey % 2 = 0 THEN 'AYSA' ELSE 'EDENOR' END ELSE s_name END AS provider,
       'Servicio de ' || s_name AS description, building_name, b.building_id
FROM prov_sheet p JOIN building b ON b.name = p.building_name""",
    "expense_ordinary": """
SELECT e.expense_id, pp.provider, pp.category, 'FAC-' || CAST(e.expense_id AS VARCHAR) AS invoice_no
FROM (SELECT expense_id, building_id,
             CASE WHEN upper(description) LIKE '%BANCARIOS%' THEN 'GASTOS BANCARIOS'
                  WHEN upper(description) LIKE '%ADMINISTRACION%' THEN 'GASTOS DE ADMINISTRACION'
                  WHEN upper(description) LIKE '%SEGUROS%' THEN 'SEGUROS'
                  WHEN upper(description) LIKE '%LIMPIEZA%' THEN 'GASTOS DE LIMPIEZA'
                  WHEN upper(description) LIKE '%AGUA%' THEN 'SERVICIOS PUBLICOS'
                  WHEN upper(description) LIKE '%LUZ%' THEN 'SERVICIOS PUBLICOS' END AS category,
             CASE WHEN upper(description) LIKE '%BANCARIOS%' OR upper(description) LIKE '%ADMINISTRACION%'
                       OR upper(description) LIKE '%SEGUROS%' OR upper(description) LIKE '%LIMPIEZA%' THEN ''
                  WHEN upper(description) LIKE '%AGUA%' THEN 'AYSA'
                  WHEN upper(description) LIKE '%LUZ%' THEN 'EDENOR' END AS provider_key
      FROM expense WHERE kind = 'Ordinario') e
JOIN (SELECT building_id, category,
             CASE WHEN category = 'SERVICIOS PUBLICOS' THEN provider ELSE '' END AS provider_key,
             min(provider) AS provider
      FROM providers GROUP BY ALL) pp
  ON pp.building_id = e.building_id AND pp.category = e.category AND pp.provider_key = e.provider_key""",
    "expense_extraordinary": """
SELECT expense_id, CAST(1 AS SMALLINT) AS instalment, CAST(1 AS SMALLINT) AS instalments
FROM expense WHERE kind = 'Extraordinario'""",
}


def _needed(sql: str) -> list[str]:
    """Names of the ledger CTEs that ``sql`` refers to, directly or through others, in order of definition."""
    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in LEDGER_CTES.keys() & words - found:
            found.add(name)
            todo.append(LEDGER_CTES[name])
    return [name for name in LEDGER_CTES if name in found]


def with_ctes(select: str) -> str:
    """Prefix ``select`` with the ledger CTEs it needs, each computed once.

    A ``select`` starting with its own ``WITH`` has its CTEs appended to the list.
    """
    sel = select.strip()
    ctes = [f"{name} AS MATERIALIZED ({LEDGER_CTES[name].strip()})" for name in _needed(sel)]
    if not ctes:
        return sel
    if sel[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {',\n'.join(ctes)},\n{sel[15:]}"
    if sel[:5].upper() == "WITH ":
        return f"WITH {',\n'.join(ctes)},\n{sel[5:]}"
    return f"WITH {',\n'.join(ctes)}\n{sel}"
