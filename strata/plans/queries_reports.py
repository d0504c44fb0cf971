"""Registered report queries (J-01 .. J-08) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed as FX
from .. import functions as X
from . import reports as R
from .catalog import ORACLE, query
from .oracle import SCALE, cents, dmy, es_ar, fixed_money, month_title, us_week, with_ctes, xml_el, xml_escape

# ---------------------------------------------------------------------------
def _split(amount_cents: str = cents("p.amount"), where: str = "TRUE") -> str:
    return f"""
SELECT pay_date, building_id, amt,
       CASE WHEN tot = 0 THEN CAST({SCALE} AS HUGEINT) ELSE (oc * {SCALE}) // tot END AS r_o,
       CASE WHEN tot = 0 THEN CAST(0 AS HUGEINT) ELSE (ec * {SCALE}) // tot END AS r_e
FROM (SELECT p.pay_date, c.building_id, {amount_cents} AS amt,
             {cents('coalesce(a.ordinary, 0)')} AS oc, {cents('coalesce(a.extraordinary, 0)')} AS ec,
             {cents('coalesce(a.ordinary, 0)')} + {cents('coalesce(a.extraordinary, 0)')} AS tot
      FROM payment p JOIN apportionment a ON a.charge_no = p.charge_no AND a.unit_id = p.unit_id
      JOIN charge c ON c.charge_no = a.charge_no WHERE {where}) s
"""


_SPLIT = _split()


def _weekly(split: str) -> str:
    return with_ctes(f"""
SELECT year, week, {fixed_money('o')} AS ordinary, {fixed_money('e')} AS extraordinary,
       {fixed_money('t')} AS week_total, {fixed_money('run')} AS running_total,
       {fixed_money('run', 'n')} AS running_avg
FROM (SELECT year, week, o, e, t,
             sum(t) OVER (ORDER BY year, week ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run,
             count(*) OVER (ORDER BY year, week ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n
      FROM (SELECT CAST(year(pay_date) AS INTEGER) AS year, {us_week('pay_date')} AS week,
                   sum(amt * r_o) AS o, sum(amt * r_e) AS e, sum(amt * r_o + amt * r_e) AS t
            FROM ({split}) x GROUP BY ALL) w) r
""")


@query("q_weekly_cash_flow", _weekly(_SPLIT))
def q_weekly_cash_flow(L):
    """J-01 over every payment of every building (no optional filter given)."""
    return R.weekly_cash_flow(L.payment, L.apportionment, L.charge)


FROM_DAY, TO_DAY = "1995-03-05", "1996-08-20"  # report parameters of the closed date range


@query("q_weekly_cash_flow_range", _weekly(_split(where=f"p.pay_date >= DATE '{FROM_DAY}' AND p.pay_date <= DATE '{TO_DAY}'")))
def q_weekly_cash_flow_range(L):
    """J-01/B-03 with the closed date range given: both days count, running figures start anew."""
    return R.weekly_cash_flow(L.payment_by_month, L.apportionment, L.charge, FROM_DAY, TO_DAY)


WIDE = 10 ** 8  # payments times this add up to more cents than 64 bits hold
_WIDE_CENTS = f"(CAST(p.amount * 100 AS HUGEINT) * {WIDE})"


def _wide_payments(L):
    return L.payment.withColumn("amount", (F.col("amount").cast("decimal(28,2)") * X.dec(WIDE)).cast("decimal(30,2)"))


@query("q_weekly_cash_flow_wide", _weekly(_split(_WIDE_CENTS)))
def q_weekly_cash_flow_wide(L):
    """J-01/H-38 on payments of 10^8 times the amount: sums and means beyond 64 bits, exact."""
    return R.weekly_cash_flow(_wide_payments(L), L.apportionment, L.charge)


# ---------------------------------------------------------------------------
PIVOT_YEAR = 1996  # report parameter of the registered monthly pivot (the pivot is yearly)
PIVOT_UNIT = 10    # report parameter of the single-unit variant (optional-parameter filter)


def _pivot_sql(unit_filter: str = "") -> str:
    months = ", ".join(
        f"CAST(sum(CASE WHEN month(p.pay_date) = {i} THEN p.amount ELSE 0 END) AS DECIMAL(18,2)) AS {m}"
        for i, m in enumerate(R.MONTH_COLUMNS, 1))
    return with_ctes(f"""
SELECT u.building_id, u.unit_id, u.floor || ' - ' || u.door AS unit_label,
       pe.first_name || ' ' || pe.last_name AS owner, {months},
       CAST(sum(p.amount) AS DECIMAL(18,2)) AS year_total
FROM unit u
LEFT JOIN payment p ON p.unit_id = u.unit_id AND p.pay_date >= DATE '{PIVOT_YEAR}-01-01'
                   AND p.pay_date < DATE '{PIVOT_YEAR + 1}-01-01'
LEFT JOIN person pe ON pe.unit_id = u.unit_id
WHERE TRUE {unit_filter}
GROUP BY u.unit_id, u.building_id, u.floor, u.door, pe.first_name, pe.last_name""")


@query("q_monthly_pivot", _pivot_sql())
def q_monthly_pivot(L):
    """J-02 for every unit of every building (year parameter)."""
    return R.monthly_pivot(L.unit, L.payment, L.person, PIVOT_YEAR)


@query("q_monthly_pivot_unit", _pivot_sql(f"AND u.unit_id = {PIVOT_UNIT}"))
def q_monthly_pivot_unit(L):
    """J-02 with the optional unit parameter given (B-04)."""
    return R.monthly_pivot(L.unit, L.payment, L.person, PIVOT_YEAR, unit_id=PIVOT_UNIT)


# ---------------------------------------------------------------------------
def _income(split: str) -> str:
    return f"""
SELECT building_id, year, month, {month_title('month')} AS month_name,
       {fixed_money('o')} AS ordinary, {fixed_money('e')} AS extraordinary, {fixed_money('t')} AS total
FROM (SELECT building_id, CAST(year(pay_date) AS INTEGER) AS year, CAST(month(pay_date) AS INTEGER) AS month,
             sum(amt * r_o) AS o, sum(amt * r_e) AS e, sum(amt * r_o + amt * r_e) AS t
      FROM ({split}) x GROUP BY ALL) g
"""


_INCOME = _income(_SPLIT)


@query("q_income_by_source_wide", with_ctes(_income(_split(_WIDE_CENTS))))
def q_income_by_source_wide(L):
    """J-03/H-38 on payments of 10^8 times the amount."""
    return R.income_by_source(_wide_payments(L), L.apportionment, L.charge)


@query("q_income_by_source", with_ctes(_INCOME))
def q_income_by_source(L):
    """J-03 per building, year and month."""
    return R.income_by_source(L.payment, L.apportionment, L.charge)


def _elements(tags: list[str], columns: list[str]) -> str:
    return " || ".join(xml_el(t, c) for t, c in zip(tags, columns))


_ROOT, _ROW, _TAGS = FX.INCOME_XML


@query("q_income_by_source_xml", with_ctes(f"""
SELECT building_id, year, '<{_ROOT}>' || string_agg(r, '' ORDER BY month) || '</{_ROOT}>' AS xml
FROM (SELECT building_id, year, month, '<{_ROW}>' ||
             {_elements(_TAGS, ["year", "month", "month_name", "ordinary", "extraordinary", "total"])} || '</{_ROW}>' AS r
      FROM ({_INCOME}) i) x
GROUP BY building_id, year"""))
def q_income_by_source_xml(L):
    """J-03 rendered as one XML document per building and year (A-10)."""
    return R.income_by_source_xml(R.income_by_source(L.payment, L.apportionment, L.charge))


# ---------------------------------------------------------------------------
def _top_months_sql(category: str, inner: str) -> str:
    return with_ctes(f"""
SELECT '{category}' AS category, building_id, year, month, {month_title('month')} AS month_name,
       CAST(s AS DECIMAL(18,2)) AS total, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY building_id, year ORDER BY s DESC, month ASC) AS rank
      FROM ({inner}) g) r
WHERE rank <= 5""")


@query("q_top_months_income", _top_months_sql(FX.TOP_INCOME_LABEL, """
SELECT u.building_id, CAST(year(p.pay_date) AS INTEGER) AS year, CAST(month(p.pay_date) AS INTEGER) AS month,
       sum(p.amount) AS s
FROM payment p JOIN unit u ON u.unit_id = p.unit_id GROUP BY ALL"""))
def q_top_months_income(L):
    """J-04 income: top 5 months per building and year (tie-break: month)."""
    return R.top_months_income(L.payment, L.unit)


@query("q_top_months_expense", _top_months_sql(FX.TOP_EXPENSE_LABEL, """
SELECT building_id, CAST(year(issue_date) AS INTEGER) AS year, CAST(month(issue_date) AS INTEGER) AS month,
       sum(amount) AS s
FROM expense GROUP BY ALL"""))
def q_top_months_expense(L):
    """J-04 expenses: top 5 months per building and year."""
    return R.top_months_expense(L.expense)


# ---------------------------------------------------------------------------
_TOP_DEBTORS = f"""
SELECT * FROM (
  SELECT u.building_id, pe.dni, pe.first_name, pe.last_name,
         coalesce(pe.email, '{FX.NOT_GIVEN}') AS email, coalesce(pe.phone, '{FX.NOT_GIVEN}') AS phone,
         u.floor || ' - ' || u.door AS unit_label, CAST(a.d AS DECIMAL(18,2)) AS total_debt,
         CAST(a.n AS INTEGER) AS open_charges,
         CAST(row_number() OVER (PARTITION BY u.building_id ORDER BY a.d DESC, pe.dni ASC) AS INTEGER) AS rank
  FROM person pe JOIN unit u ON u.unit_id = pe.unit_id
  JOIN (SELECT unit_id, sum(debt) AS d, count(*) AS n FROM apportionment WHERE debt > 0 GROUP BY unit_id) a
    ON a.unit_id = u.unit_id) r
WHERE rank <= 3"""


@query("q_top_debtors", with_ctes(_TOP_DEBTORS))
def q_top_debtors(L):
    """J-05: top 3 debtors per building (tie-break: DNI)."""
    return R.top_debtors(L.person, L.unit, L.apportionment)


_ROOT, _ROW, _ATTRIBUTE, _TAGS = FX.DEBTORS_XML


@query("q_top_debtors_xml", with_ctes(f"""
SELECT building_id, '<{_ROOT}>' || string_agg(r, '' ORDER BY rank) || '</{_ROOT}>' AS xml
FROM (SELECT building_id, rank, '<{_ROW} {_ATTRIBUTE}="' || {xml_escape('dni')} || '">' ||
             {_elements(_TAGS, ["first_name", "last_name", "email", "phone", "unit_label", "total_debt", "open_charges"])}
             || '</{_ROW}>' AS r
      FROM ({_TOP_DEBTORS}) t) x
GROUP BY building_id"""))
def q_top_debtors_xml(L):
    """J-05 as XML with the DNI as attribute (A-10)."""
    return R.top_debtors_xml(R.top_debtors(L.person, L.unit, L.apportionment))


def _td(style: str | None, value: str) -> str:
    """A cell; without a value an empty element, which the unstyled one is not worth."""
    open_ = "<td" + (f' style="{style}"' if style else "")
    return f"coalesce('{open_}>' || {value} || '</td>', '{open_ + '/>' if style else ''}')"


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


@query("q_debtors_html", with_ctes(f"""
SELECT t.building_id,
       {_text(FX.HTML_BEFORE_NAME)} || {xml_escape('b.name')} || {_text(FX.HTML_BEFORE_ROWS)} || t.rows_
       || {_text(FX.HTML_AFTER_ROWS)} AS html
FROM (SELECT building_id, string_agg(r, '' ORDER BY rank) AS rows_
      FROM (SELECT building_id, rank, '<tr>'
                   || {_td(None, xml_escape('dni'))}
                   || {_td('padding: 12px; border-bottom: 1px solid #ddd; white-space: nowrap; font-weight: bold;', xml_escape("first_name || ' ' || last_name"))}
                   || {_td('padding: 12px; border-bottom: 1px solid #ddd; white-space: nowrap;', xml_escape('unit_label'))}
                   || {_td('padding: 12px; border-bottom: 1px solid #ddd; color: #d9534f; text-align: right; white-space: nowrap;', "'$ ' || " + es_ar('total_debt'))}
                   || {_td('padding: 12px; border-bottom: 1px solid #ddd; font-size: 12px; color: #666;', xml_escape('email') + " || '<br> Tel.: ' || " + xml_escape('phone'))}
                   || '</tr>' AS r
            FROM ({_TOP_DEBTORS}) d) x
      GROUP BY building_id) t
JOIN building b ON b.building_id = t.building_id"""))
def q_debtors_html(L):
    """J-07: HTML body of the debtors notice per building (rendering only)."""
    return R.debtors_html(R.top_debtors(L.person, L.unit, L.apportionment), L.building)


# ---------------------------------------------------------------------------
@query("q_days_between_payments", with_ctes(f"""
SELECT u.building_id, p.payment_id, u.floor || ' - ' || u.door AS unit_label, p.pay_date,
       coalesce(CAST(p.prev AS VARCHAR), '{FX.FIRST_PAYMENT}') AS previous_date,
       CAST(CASE WHEN p.prev IS NULL THEN 0 ELSE date_diff('day', p.prev, p.pay_date) END AS INTEGER) AS days
FROM (SELECT payment_id, unit_id, pay_date,
             lag(pay_date) OVER (PARTITION BY unit_id ORDER BY pay_date, payment_id) AS prev
      FROM payment) p
JOIN unit u ON u.unit_id = p.unit_id"""))
def q_days_between_payments(L):
    """J-06 for every payment (LAG before any date filter)."""
    return R.days_between_payments(L.payment, L.unit)


# ---------------------------------------------------------------------------
_HEADER_ITEMS = [(section, item, value) for (section, item), value in zip(FX.HEADER_ITEMS, [
    "'Administración del Consorcio'", "'30-00000000-0'", "b.name", "b.address",
    f"{month_title('month(c.gen_date)')} || ' ' || CAST(year(c.gen_date) AS VARCHAR)",
    dmy("c.due1"), dmy("c.due2"), _text(FX.PAYMENT_MEANS), "'0000000000000000000000'"])]


@query("q_statement_header", with_ctes(
    "SELECT c.charge_no, struct_extract(c.v, 'section') AS section, struct_extract(c.v, 'item') AS item, "
    "CASE struct_extract(c.v, 'line') "
    + " ".join(f"WHEN {i} THEN {expr}" for i, (_, _, expr) in enumerate(_HEADER_ITEMS, 1))
    + " END AS value, CAST(struct_extract(c.v, 'line') AS INTEGER) AS line\n"
    "FROM (SELECT *, unnest(["
    + ", ".join(f"{{'line': {i}, 'section': '{s}', 'item': '{it}'}}" for i, (s, it, _) in enumerate(_HEADER_ITEMS, 1))
    + "]) AS v FROM charge) c JOIN building b ON b.building_id = c.building_id"))
def q_statement_header(L):
    """J-08 result set 1 for every charge: nine header rows each."""
    return R.statement_header(L.charge, L.building)


@query("q_statement_debtors", with_ctes(f"""
SELECT '{FX.DEBTOR_LABEL}' AS kind, u.building_id, pe.dni, pe.first_name || ' ' || pe.last_name AS full_name,
       u.floor || ' - ' || u.door AS unit_label, CAST(a.debt AS DECIMAL(12,2)) AS debt,
       CAST(a.interest AS DECIMAL(12,2)) AS interest, a.charge_no
FROM apportionment a JOIN unit u ON u.unit_id = a.unit_id
JOIN occupancy o ON o.unit_id = u.unit_id AND o.role = '{FX.ROLE_OWNER}'
JOIN person pe ON pe.dni = o.dni
WHERE a.debt > 0"""))
def q_statement_debtors(L):
    """J-08 result set 2: owners with debt, for every building."""
    return R.statement_debtors(L.apportionment, L.unit, L.occupancy, L.person)


@query("q_statement_ordinary", with_ctes(f"""
SELECT '{FX.ORDINARY_LABEL}' AS kind, e.charge_no, e.expense_id, eo.category, e.description AS detail, eo.provider,
       eo.invoice_no, {dmy('e.issue_date')} AS issue_date, CAST(e.amount AS DECIMAL(10,2)) AS amount
FROM expense e JOIN expense_ordinary eo ON eo.expense_id = e.expense_id"""))
def q_statement_ordinary(L):
    """J-08 result set 3: ordinary expenses with provider and invoice."""
    return R.statement_ordinary(L.expense, L.expense_ordinary)


@query("q_statement_ordinary_order", with_ctes("""
SELECT e.charge_no, e.expense_id, CAST(e.amount AS DECIMAL(10,2)) AS amount,
       CAST(row_number() OVER (ORDER BY e.charge_no, e.amount DESC, e.expense_id) AS BIGINT) AS position
FROM expense e JOIN expense_ordinary eo ON eo.expense_id = e.expense_id"""))
def q_statement_ordinary_order(L):
    """F-01/F-05: the rows of the ordinary expenses with their place in presentation order."""
    return R.positions("statement_ordinary", R.statement_ordinary(L.expense, L.expense_ordinary)) \
        .select("charge_no", "expense_id", "amount", "position")


@query("q_statement_extra", with_ctes(f"""
SELECT '{FX.EXTRAORDINARY_LABEL}' AS kind, e.charge_no, e.expense_id, e.description AS detail,
       CAST(x.instalment AS INTEGER) AS instalment, CAST(x.instalments AS INTEGER) AS instalments,
       {dmy('e.issue_date')} AS issue_date, CAST(e.amount AS DECIMAL(10,2)) AS amount
FROM expense e JOIN expense_extraordinary x ON x.expense_id = e.expense_id"""))
def q_statement_extra(L):
    """J-08 result set 4: extraordinary expenses with instalments."""
    return R.statement_extraordinary(L.expense, L.expense_extraordinary)


@query("q_statement_totals", with_ctes(
    f"SELECT '{FX.FINANCIAL_LABEL}' AS kind, c.charge_no, struct_extract(c.v, 'concept') AS concept, "
    "CAST(CASE struct_extract(c.v, 'line') WHEN 1 THEN e.o WHEN 2 THEN e.x "
    "WHEN 3 THEN c.total WHEN 4 THEN a.rec WHEN 5 THEN a.bal WHEN 6 THEN a.debt END AS DECIMAL(18,2)) AS amount, "
    "CAST(struct_extract(c.v, 'line') AS INTEGER) AS line\n"
    "FROM (SELECT *, unnest([" + ", ".join(f"{{'line': {i}, 'concept': '{k}'}}" for i, k in enumerate(FX.TOTAL_CONCEPTS, 1))
    + "]) AS v FROM charge) c LEFT JOIN (SELECT charge_no, sum(CASE WHEN kind = 'Ordinario' THEN amount ELSE 0 END) AS o, "
    "sum(CASE WHEN kind = 'Extraordinario' THEN amount ELSE 0 END) AS x FROM expense GROUP BY charge_no) e "
    "ON e.charge_no = c.charge_no\n"
    "LEFT JOIN (SELECT charge_no, sum(received) AS rec, sum(prior_balance) AS bal, sum(debt) AS debt "
    "FROM apportionment GROUP BY charge_no) a ON a.charge_no = c.charge_no"))
def q_statement_totals(L):
    """J-08 result set 5: six totals per charge from one aggregate + stack."""
    return R.statement_totals(L.charge, L.expense, L.apportionment)


@query("q_statement_units", with_ctes(f"""
SELECT '{FX.APPORTIONMENT_LABEL}' AS kind, a.charge_no, a.unit_id, u.floor || ' - ' || u.door AS unit_label,
       CAST(a.pct AS DECIMAL(5,2)) AS pct, CAST(a.ordinary AS DECIMAL(12,2)) AS ordinary,
       CAST(a.extraordinary AS DECIMAL(12,2)) AS extraordinary, CAST(a.prior_balance AS DECIMAL(12,2)) AS prior_balance,
       CAST(a.interest AS DECIMAL(12,2)) AS interest, CAST(a.total AS DECIMAL(12,2)) AS total,
       CAST(a.received AS DECIMAL(12,2)) AS received, CAST(a.debt AS DECIMAL(12,2)) AS debt
FROM apportionment a JOIN unit u ON u.unit_id = a.unit_id"""))
def q_statement_units(L):
    """J-08 result set 6: apportionment lines of every charge."""
    return R.statement_units(L.apportionment, L.unit)


@query("q_statement_units_order", with_ctes("""
SELECT a.charge_no, u.floor || ' - ' || u.door AS unit_label, a.unit_id,
       CAST(row_number() OVER (ORDER BY a.charge_no, u.floor || ' - ' || u.door) AS BIGINT) AS position
FROM apportionment a JOIN unit u ON u.unit_id = a.unit_id"""))
def q_statement_units_order(L):
    """F-01/F-05: the apportionment lines with their place in presentation order."""
    return R.positions("statement_units", R.statement_units(L.apportionment, L.unit), ["charge_no", "unit_label", "unit_id"])


# ---------------------------------------------------------------------------
@query("q_guard_unknown_building", with_ctes("""
SELECT r.building_id, b.building_id IS NOT NULL AS known,
       CASE WHEN b.building_id IS NULL THEN 'El Consorcio no existe' END AS message
FROM (SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS building_id FROM customer
      UNION SELECT DISTINCT CAST(c_nationkey AS BIGINT) + 1000 FROM customer) r
LEFT JOIN building b ON b.building_id = r.building_id"""))
def q_guard_unknown_building(L):
    """B-13: requested building ids (every known id and the same ids shifted out of
    range) checked against ``building``; unknown ids get the message and no report."""
    from ..operators.guards import guard_buildings
    return guard_buildings(L.unit, L.building)


# ---------------------------------------------------------------------------
# H-43: the XML documents read back into columns
@query("q_income_xml_read_back", with_ctes(_INCOME))
def q_income_xml_read_back(L):
    """H-43/A-10: income documents parsed again: the rows they were made from."""
    return R.income_from_xml(q_income_by_source_xml(L))


@query("q_debtors_xml_read_back", f"SELECT * FROM ({ORACLE['q_top_debtors']}) t")
def q_debtors_xml_read_back(L):
    """H-43/A-10: debtors documents parsed again, the attribute as a column."""
    return R.debtors_from_xml(q_top_debtors_xml(L))


# ---------------------------------------------------------------------------
# F-01: every report in the reference's order
def _order_query(name: str, report, base: str) -> None:
    def run(L):
        return R.positions(name, report(L))

    run.__doc__ = f"F-01: the place of every row of {name} in the reference's order."
    columns = R.REPORT_ORDER[name]
    keys = ", ".join(f"{k[1:]} DESC NULLS FIRST" if k.startswith("-") else f"{k} ASC NULLS FIRST" for k in columns)
    rest = "".join(f", {c} ASC NULLS FIRST" for c in R.ties(name, REPORT_COLUMNS[name]))
    query(f"q_order_{name}", f"SELECT *, CAST(row_number() OVER (ORDER BY {keys}{rest}) AS BIGINT) AS position "
          f"FROM ({ORACLE[base]}) t")(run)


_TOP_MONTHS = ["category", "building_id", "year", "month", "month_name", "total", "rank"]
REPORT_COLUMNS = {
    "weekly_cash_flow": ["year", "week", "ordinary", "extraordinary", "week_total", "running_total", "running_avg"],
    "monthly_pivot": ["building_id", "unit_id", "unit_label", "owner", *R.MONTH_COLUMNS, "year_total"],
    "income_by_source": ["building_id", "year", "month", "month_name", "ordinary", "extraordinary", "total"],
    "top_months_income": _TOP_MONTHS,
    "top_months_expense": _TOP_MONTHS,
    "top_debtors": ["building_id", "dni", "first_name", "last_name", "email", "phone", "unit_label", "total_debt",
                    "open_charges", "rank"],
    "days_between_payments": ["building_id", "payment_id", "unit_label", "pay_date", "previous_date", "days"],
    "statement_header": ["charge_no", "section", "item", "value", "line"],
    "statement_debtors": ["kind", "building_id", "dni", "full_name", "unit_label", "debt", "interest", "charge_no"],
    "statement_extraordinary": ["kind", "charge_no", "expense_id", "detail", "instalment", "instalments", "issue_date",
                                "amount"],
    "statement_totals": ["kind", "charge_no", "concept", "amount", "line"],
}
for _name, _report in (("weekly_cash_flow", q_weekly_cash_flow), ("monthly_pivot", q_monthly_pivot),
                       ("income_by_source", q_income_by_source), ("top_months_income", q_top_months_income),
                       ("top_months_expense", q_top_months_expense), ("top_debtors", q_top_debtors),
                       ("days_between_payments", q_days_between_payments), ("statement_header", q_statement_header),
                       ("statement_debtors", q_statement_debtors), ("statement_extraordinary", q_statement_extra),
                       ("statement_totals", q_statement_totals)):
    _order_query(_name, _report, _report.__name__)


@query("q_export_csv", f"""
SELECT 'totals' AS file, CAST(charge_no AS VARCHAR) AS charge_no, concept AS item, CAST(amount AS VARCHAR) AS value
FROM ({ORACLE['q_statement_totals']}) t
UNION ALL SELECT 'units', CAST(charge_no AS VARCHAR), unit_label, CAST(debt AS VARCHAR) FROM ({ORACLE['q_statement_units']}) u""")
def q_export_csv(L):
    """A-11: the statement's totals and units exported as CSV with header, and read back as text."""
    from ..session import shared_dir
    sets = R.statement(L)
    files = R.export_csv({n: sets[n] for n in ("statement_totals", "statement_units")}, shared_dir(L.spark, "files", "export"))
    read = {n: L.spark.read.option("header", True).csv(path) for n, path in files.items()}
    totals, units = read["statement_totals"], read["statement_units"]
    return totals.select(F.lit("totals").alias("file"), "charge_no", F.col("concept").alias("item"), F.col("amount").alias("value")) \
        .unionByName(units.select(F.lit("units").alias("file"), "charge_no", F.col("unit_label").alias("item"),
                                  F.col("debt").alias("value")))
