"""Reports (weekly cash flow, monthly pivot, income by source, top months, top
debtors, days between payments, debtors HTML, charge statement).

Every report takes the ledger tables and optional parameters. A parameter that is
``None`` adds no filter at all (the reference's ``@p IS NULL OR col = @p``), and a
given one becomes a plain predicate that Catalyst can push to the scan. Reports the
reference runs for one building/year also accept ``None`` and then produce the same
rows for every building/year at once (the building/year become output columns).

Scale notes
- Weekly/monthly figures are aggregated first (partial aggregation before the
  shuffle); only the per-week rows (bounded by the calendar) reach the running-total
  window, which therefore can run in one partition.
- Top-k per group uses ``row_number() <= k``; Spark plans it with a partial
  WindowGroupLimit before the shuffle, so a huge group ships at most k rows per task.
- Days between payments avoids a per-unit window over all payments (one hot unit
  would land in one task): payments are reduced to distinct (unit, day) first, the
  window runs over those (bounded by calendar days per unit) and the result is joined
  back.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as X
from .. import fixed as FX

SCALE = 10 ** 12  # fixed-point scale of the ordinary/extraordinary split ratios


def _d(v):
    return _dt.date.fromisoformat(v) if isinstance(v, str) else v


def _split_parts(j: DataFrame) -> DataFrame:
    """Payment split by the charge mix, in fixed point: amount_cents x ratio x 1e12.

    Ratios are truncated integers (ord_cents * 1e12 div total_cents), like the
    reference's decimal division; a zero total puts the whole payment in ordinary.
    """
    zero = X.dec(0, 12, 2)
    o = X.wide_cents(F.coalesce("ordinary", zero))
    e = X.wide_cents(F.coalesce("extraordinary", zero))
    t = o + e
    s = X.dec(SCALE)
    r_o = F.when(t == 0, s).otherwise(X.int_div(o * s, t).cast("decimal(38,0)"))
    r_e = F.when(t == 0, X.dec(0)).otherwise(X.int_div(e * s, t).cast("decimal(38,0)"))
    amt = X.wide_cents("amount")
    return j.withColumn("_ord", amt * r_o).withColumn("_ext", amt * r_e)


def _fixed_to_money(c, divisor=None, precision: int = 28) -> F.Column:
    den = X.dec(SCALE) if divisor is None else divisor
    return X.from_cents(X.round_div_half_up(c, den), precision)


def _paid_with_mix(payment: DataFrame, apportionment: DataFrame, charge: DataFrame, building=None) -> DataFrame:
    a = apportionment.select("charge_no", "unit_id", "ordinary", "extraordinary")
    c = charge.select("charge_no", "building_id")
    if building is not None:
        c = c.filter(F.col("building_id") == building)
    return payment.select("charge_no", "unit_id", "pay_date", "amount").join(a, ["charge_no", "unit_id"]).join(c, "charge_no")


def in_range(payment: DataFrame, start=None, end=None) -> DataFrame:
    """Payments of the closed date range; of a table stored by month only the months it touches are read."""
    for day, keep in ((start, F.Column.__ge__), (end, F.Column.__le__)):
        if day is not None:
            payment = payment.filter(keep(F.col("pay_date"), F.lit(_d(day))))
            if "pay_month" in payment.columns:
                payment = payment.filter(keep(F.col("pay_month"), F.lit(_d(day).replace(day=1))))
    return payment


# ---------------------------------------------------------------------------
def weekly_cash_flow(payment: DataFrame, apportionment: DataFrame, charge: DataFrame,
                     start=None, end=None, building=None) -> DataFrame:
    """Payments split ordinary/extraordinary, summed by (year, US week), with the
    running total and running mean of the weekly totals."""
    p = in_range(payment, start, end)
    j = _split_parts(_paid_with_mix(p, apportionment, charge, building))
    wk = j.groupBy(F.year("pay_date").alias("year"), X.us_week(F.col("pay_date")).alias("week")).agg(
        F.sum("_ord").alias("_o"), F.sum("_ext").alias("_e"), F.sum(F.col("_ord") + F.col("_ext")).alias("_t"))
    w = Window.orderBy("year", "week").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wk = wk.withColumn("_run", F.sum("_t").over(w)).withColumn("_n", F.count(F.lit(1)).over(w))
    return wk.select(
        F.col("year").cast("int").alias("year"), F.col("week").cast("int").alias("week"),
        _fixed_to_money("_o").alias("ordinary"),
        _fixed_to_money("_e").alias("extraordinary"),
        _fixed_to_money("_t").alias("week_total"),
        _fixed_to_money("_run").alias("running_total"),
        _fixed_to_money("_run", X.dec(SCALE) * F.col("_n").cast("decimal(38,0)")).alias("running_avg"),
    )


# ---------------------------------------------------------------------------
MONTH_COLUMNS = ["ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic"]


def monthly_pivot(unit: DataFrame, payment: DataFrame, person: DataFrame, year: int,
                  building=None, unit_id=None) -> DataFrame:
    """Units x 12 month columns of payments in ``year`` (0 when none) + yearly total
    (NULL when none); one row per (unit, person) as the reference's left join fans out."""
    u = unit.select("unit_id", "building_id", "floor", "door")
    if building is not None:
        u = u.filter(F.col("building_id") == building)
    if unit_id is not None:
        u = u.filter(F.col("unit_id") == unit_id)
    zero = X.dec(0, 12, 2)
    sums = [F.sum(F.when(F.month("pay_date") == i, F.col("amount")).otherwise(zero)).alias(name)
            for i, name in enumerate(MONTH_COLUMNS, start=1)]
    # payments are summed per unit before they meet the units: a unit with very many of
    # them is added up where they are read, and the joins are one row a unit
    paid = payment.filter(X.year_range("pay_date", year)).groupBy(F.col("unit_id").alias("_pu")) \
        .agg(*sums, F.sum("amount").alias("year_total"))
    # persons of one name on a unit are one line, with the payments counted for each
    names = person.groupBy(F.col("unit_id").alias("_uu"), "first_name", "last_name").agg(F.count(F.lit(1)).alias("_k"))
    j = u.join(paid, u["unit_id"] == paid["_pu"], "left").join(names, u["unit_id"] == names["_uu"], "left")
    k = F.coalesce(F.col("_k"), F.lit(1)).cast("decimal(10,0)")
    return j.select(
        "building_id", "unit_id", X.display_unit("floor", "door").alias("unit_label"),
        F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("owner"),
        *[(F.coalesce(F.col(c), zero) * k).cast("decimal(18,2)").alias(c) for c in MONTH_COLUMNS],
        (F.col("year_total") * k).cast("decimal(18,2)").alias("year_total"))


# ---------------------------------------------------------------------------
def income_by_source(payment: DataFrame, apportionment: DataFrame, charge: DataFrame,
                     building=None, year=None) -> DataFrame:
    """Ordinary/extraordinary income per (building, year, month) with the month name."""
    p = payment if year is None else payment.filter(X.year_range("pay_date", year))
    j = _split_parts(_paid_with_mix(p, apportionment, charge, building))
    g = j.groupBy("building_id", F.year("pay_date").alias("year"), F.month("pay_date").alias("month")).agg(
        F.sum("_ord").alias("_o"), F.sum("_ext").alias("_e"), F.sum(F.col("_ord") + F.col("_ext")).alias("_t"))
    return g.select(
        "building_id", F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"),
        X.es_month_title(F.col("month")).alias("month_name"),
        _fixed_to_money("_o").alias("ordinary"), _fixed_to_money("_e").alias("extraordinary"),
        _fixed_to_money("_t").alias("total"))


def income_by_source_xml(income: DataFrame) -> DataFrame:
    """One XML document per (building, year): <RecaudacionPorOrigen><Periodo>... .

    The per-document aggregation is bounded (twelve months), so ``listagg`` never
    gathers an unbounded group.
    """
    root, row_tag, tags = FX.INCOME_XML
    fields = ["year", "month", "month_name", "ordinary", "extraordinary", "total"]
    row = F.concat(F.lit(f"<{row_tag}>"), *[X.xml_element(t, c) for t, c in zip(tags, fields)], F.lit(f"</{row_tag}>"))
    g = income.withColumn("_row", row).groupBy("building_id", "year").agg(
        F.expr("listagg(_row, '') within group (order by month)").alias("_rows"))
    return g.select("building_id", "year", F.concat(F.lit(f"<{root}>"), F.col("_rows"), F.lit(f"</{root}>")).alias("xml"))


# ---------------------------------------------------------------------------
def income_from_xml(docs: DataFrame) -> DataFrame:
    """H-43: the rows of ``income_by_source`` read back from its documents."""
    _, row_tag, tags = FX.INCOME_XML
    types = ["int", "int", "string", "decimal(28,2)", "decimal(28,2)", "decimal(28,2)"]
    fields = ["year", "month", "month_name", "ordinary", "extraordinary", "total"]
    schema = f"{row_tag} array<struct<{', '.join(f'{t}: {k}' for t, k in zip(tags, types))}>>"
    rows = docs.select("building_id", F.explode(F.from_xml("xml", schema)[row_tag]).alias("r"))
    return rows.select("building_id", *[F.col(f"r.{t}").alias(f) for t, f in zip(tags, fields)])


def debtors_from_xml(docs: DataFrame) -> DataFrame:
    """H-43: the debtors read back from their documents, the attribute as a column; the order is their rank."""
    _, row_tag, attr, tags = FX.DEBTORS_XML
    types = ["string"] * 5 + ["decimal(18,2)", "int"]
    fields = ["first_name", "last_name", "email", "phone", "unit_label", "total_debt", "open_charges"]
    schema = f"{row_tag} array<struct<_{attr}: string, {', '.join(f'{t}: {k}' for t, k in zip(tags, types))}>>"
    rows = docs.select("building_id", F.posexplode(F.from_xml("xml", schema)[row_tag]).alias("place", "r"))
    return rows.select("building_id", (F.col("place") + 1).alias("rank"), F.col(f"r._{attr}").alias("dni"),
                       *[F.col(f"r.{t}").alias(f) for t, f in zip(tags, fields)])


def _top_n(df: DataFrame, part: list[str], order: list, n: int) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def top_months_income(payment: DataFrame, unit: DataFrame, building=None, year=None, n: int = 5) -> DataFrame:
    u = unit.select("unit_id", "building_id")
    if building is not None:
        u = u.filter(F.col("building_id") == building)
    p = payment if year is None else payment.filter(X.year_range("pay_date", year))
    g = p.join(u, "unit_id").groupBy("building_id", F.year("pay_date").alias("year"),
                                     F.month("pay_date").alias("month")).agg(F.sum("amount").alias("_s"))
    g = _top_n(g, ["building_id", "year"], [F.col("_s").desc(), F.col("month").asc()], n)
    return g.select(F.lit(FX.TOP_INCOME_LABEL).alias("category"), "building_id",
                    F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"),
                    X.es_month_title(F.col("month")).alias("month_name"),
                    F.col("_s").cast("decimal(18,2)").alias("total"), F.col("rank").cast("int").alias("rank"))


def top_months_expense(expense: DataFrame, building=None, year=None, n: int = 5) -> DataFrame:
    e = expense if building is None else expense.filter(F.col("building_id") == building)
    if year is not None:
        e = e.filter(X.year_range("issue_date", year))
    g = e.groupBy("building_id", F.year("issue_date").alias("year"), F.month("issue_date").alias("month")) \
        .agg(F.sum("amount").alias("_s"))
    g = _top_n(g, ["building_id", "year"], [F.col("_s").desc(), F.col("month").asc()], n)
    return g.select(F.lit(FX.TOP_EXPENSE_LABEL).alias("category"), "building_id",
                    F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"),
                    X.es_month_title(F.col("month")).alias("month_name"),
                    F.col("_s").cast("decimal(18,2)").alias("total"), F.col("rank").cast("int").alias("rank"))


def top_debtors(person: DataFrame, unit: DataFrame, apportionment: DataFrame, building=None, n: int = 3) -> DataFrame:
    """Per building: the n persons (by their unit link) with the highest open debt,
    debt summed over charges with debt > 0, count of such charges, contact defaults."""
    u = unit.select("unit_id", "building_id", "floor", "door")
    if building is not None:
        u = u.filter(F.col("building_id") == building)
    a = apportionment.filter(F.col("debt") > 0).groupBy("unit_id").agg(
        F.sum("debt").alias("_debt"), F.count(F.lit(1)).alias("_n"))
    j = person.join(u, "unit_id").join(a, "unit_id")
    j = j.select("building_id", "dni", "first_name", "last_name",
                 F.coalesce("email", F.lit(FX.NOT_GIVEN)).alias("email"),
                 F.coalesce("phone", F.lit(FX.NOT_GIVEN)).alias("phone"),
                 X.display_unit("floor", "door").alias("unit_label"),
                 F.col("_debt").cast("decimal(18,2)").alias("total_debt"),
                 F.col("_n").cast("int").alias("open_charges"))
    return _top_n(j, ["building_id"], [F.col("total_debt").desc(), F.col("dni").asc()], n) \
        .withColumn("rank", F.col("rank").cast("int"))


def top_debtors_xml(debtors: DataFrame) -> DataFrame:
    """<Top3Morosos><Moroso DNI="..">..</Moroso>..</Top3Morosos> per building (≤ n rows each)."""
    root, row_tag, attr, tags = FX.DEBTORS_XML
    fields = ["first_name", "last_name", "email", "phone", "unit_label", "total_debt", "open_charges"]
    row = F.concat(F.lit(f'<{row_tag} {attr}="'), X.xml_escape("dni"), F.lit('">'),
                   *[X.xml_element(t, c) for t, c in zip(tags, fields)], F.lit(f"</{row_tag}>"))
    g = debtors.withColumn("_row", row).groupBy("building_id").agg(
        F.expr("listagg(_row, '') within group (order by rank)").alias("_rows"))
    return g.select("building_id", F.concat(F.lit(f"<{root}>"), F.col("_rows"), F.lit(f"</{root}>")).alias("xml"))


def debtors_html(debtors: DataFrame, building: DataFrame) -> DataFrame:
    """The debtors notice per building, a whole HTML page: one <tr> per debtor (amount as
    es-AR 'N2'). A cell without a value is an empty element, as FOR XML writes it."""
    def td(style, value):
        open_ = "<td" + (f' style="{style}"' if style else "")
        return F.coalesce(F.concat(F.lit(open_ + ">"), value, F.lit("</td>")), F.lit(open_ + "/>" if style else ""))

    cells = [
        X.xml_escape("dni"),
        X.xml_escape(F.concat(F.col("first_name"), F.lit(" "), F.col("last_name"))),
        X.xml_escape("unit_label"),
        F.concat(F.lit("$ "), X.format_es_ar("total_debt")),
        F.concat(X.xml_escape("email"), F.lit(FX.HTML_LINE_BREAK + " Tel.: "), X.xml_escape("phone")),
    ]
    row = F.concat(F.lit("<tr>"), *[td(style, c) for style, c in zip(FX.HTML_CELL_STYLES, cells)], F.lit("</tr>"))
    g = debtors.withColumn("_row", row).groupBy("building_id").agg(
        F.expr("listagg(_row, '') within group (order by rank)").alias("_rows"))
    html = F.concat(F.lit(FX.HTML_BEFORE_NAME), X.xml_escape("name"), F.lit(FX.HTML_BEFORE_ROWS), F.col("_rows"),
                    F.lit(FX.HTML_AFTER_ROWS))
    return g.join(building.select("building_id", "name"), "building_id") \
        .select("building_id", X.strip_crlf(html).alias("html"))


# ---------------------------------------------------------------------------
def days_between_payments(payment: DataFrame, unit: DataFrame, building=None, start=None, end=None) -> DataFrame:
    """Per payment: previous payment date of the same unit (LAG before the date filter),
    'Primer Pago' and 0 days for a unit's first payment. Ties on a date are ordered
    by payment id (the later one sees the same date, 0 days)."""
    u = unit.select("unit_id", "building_id", "floor", "door")
    if building is not None:
        u = u.filter(F.col("building_id") == building)
    p = payment.select("payment_id", "unit_id", "pay_date").join(u.select("unit_id"), "unit_id", "left_semi")
    days = p.groupBy("unit_id", "pay_date").agg(F.min("payment_id").alias("_first"))
    w = Window.partitionBy("unit_id").orderBy("pay_date")
    days = days.withColumn("_prev_day", F.lag("pay_date").over(w))
    j = p.join(days, ["unit_id", "pay_date"])
    prev = F.when(F.col("payment_id") == F.col("_first"), F.col("_prev_day")).otherwise(F.col("pay_date"))
    j = j.withColumn("_prev", prev)
    if start is not None:
        j = j.filter(F.col("pay_date") >= F.lit(_d(start)))
    if end is not None:
        j = j.filter(F.col("pay_date") <= F.lit(_d(end)))
    j = j.join(u, "unit_id")
    return j.select(
        "building_id", "payment_id", X.display_unit("floor", "door").alias("unit_label"),
        F.col("pay_date").alias("pay_date"),
        F.coalesce(F.col("_prev").cast("string"), F.lit(FX.FIRST_PAYMENT)).alias("previous_date"),
        F.when(F.col("_prev").isNull(), F.lit(0)).otherwise(F.datediff("pay_date", "_prev")).cast("int").alias("days"))


# ---------------------------------------------------------------------------
# Charge statement (six result sets). ``charge_no=None`` produces every charge's.
def _charges(charge: DataFrame, charge_no):
    return charge if charge_no is None else charge.filter(F.col("charge_no") == charge_no)


def statement_header(charge: DataFrame, building: DataFrame, charge_no=None,
                     admin_name: str = "Administración del Consorcio", admin_tax_id: str = "30-00000000-0",
                     payment_account: str = "0000000000000000000000") -> DataFrame:
    """Nine (section, item, value) rows per charge: one row per charge + ``stack``
    instead of nine UNION ALL branches. Administration constants are parameters."""
    c = _charges(charge, charge_no).join(building.select("building_id", "name", "address"), "building_id")
    period = F.concat(X.es_month_title(F.month("gen_date")), F.lit(" "), F.year("gen_date").cast("string"))
    c = c.select("charge_no", "name", "address", period.alias("period"),
                 X.format_dmy("due1").alias("due1_txt"), X.format_dmy("due2").alias("due2_txt"))
    values = [F.lit(admin_name), F.lit(admin_tax_id), F.col("name"), F.col("address"), F.col("period"),
              F.col("due1_txt"), F.col("due2_txt"), F.lit(FX.PAYMENT_MEANS), F.lit(payment_account)]
    items = [(s, i, v) for (s, i), v in zip(FX.HEADER_ITEMS, values)]
    arr = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(i).alias("item"), v.cast("string").alias("value"),
                             F.lit(k).alias("line")) for k, (s, i, v) in enumerate(items, start=1)])
    return c.select("charge_no", F.inline(arr)).select("charge_no", "section", "item", "value",
                                                       F.col("line").cast("int").alias("line"))


def statement_debtors(apportionment: DataFrame, unit: DataFrame, occupancy: DataFrame, person: DataFrame,
                      charge: DataFrame | None = None, charge_no=None) -> DataFrame:
    """Owners (by occupancy) with debt > 0 on any charge of the statement's building."""
    u = unit.select("unit_id", "building_id", "floor", "door")
    if charge_no is not None:
        b = charge.filter(F.col("charge_no") == charge_no).select("building_id")
        u = u.join(b, "building_id", "left_semi")
    a = apportionment.filter(F.col("debt") > 0).select("charge_no", "unit_id", "debt", "interest")
    o = occupancy.filter(F.col("role") == FX.ROLE_OWNER).select("unit_id", "dni")
    p = person.select("dni", "first_name", "last_name")
    j = a.join(u, "unit_id").join(o, "unit_id").join(p, "dni")
    return j.select(
        F.lit(FX.DEBTOR_LABEL).alias("kind"), "building_id", "dni",
        F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("full_name"),
        X.display_unit("floor", "door").alias("unit_label"),
        F.col("debt").cast("decimal(12,2)").alias("debt"), F.col("interest").cast("decimal(12,2)").alias("interest"),
        F.col("charge_no").alias("charge_no"))


def statement_ordinary(expense: DataFrame, expense_ordinary: DataFrame, charge_no=None) -> DataFrame:
    e = expense if charge_no is None else expense.filter(F.col("charge_no") == charge_no)
    j = e.join(expense_ordinary, "expense_id")
    return j.select(F.lit(FX.ORDINARY_LABEL).alias("kind"), "charge_no", "expense_id",
                    expense_ordinary["category"].alias("category"), F.col("description").alias("detail"),
                    "provider", "invoice_no", X.format_dmy("issue_date").alias("issue_date"),
                    F.col("amount").cast("decimal(10,2)").alias("amount"))


def statement_extraordinary(expense: DataFrame, expense_extraordinary: DataFrame, charge_no=None) -> DataFrame:
    e = expense if charge_no is None else expense.filter(F.col("charge_no") == charge_no)
    j = e.join(expense_extraordinary, "expense_id")
    return j.select(F.lit(FX.EXTRAORDINARY_LABEL).alias("kind"), "charge_no", "expense_id",
                    F.col("description").alias("detail"),
                    F.col("instalment").cast("int").alias("instalment"),
                    F.col("instalments").cast("int").alias("instalments"),
                    X.format_dmy("issue_date").alias("issue_date"),
                    F.col("amount").cast("decimal(10,2)").alias("amount"))


def statement_totals(charge: DataFrame, expense: DataFrame, apportionment: DataFrame, charge_no=None) -> DataFrame:
    """Six totals per charge from one aggregate per source, unpivoted with ``stack``
    (instead of six separate scans)."""
    c = _charges(charge, charge_no).select("charge_no", "total")
    zero = X.dec(0, 10, 2)
    e = expense.groupBy("charge_no").agg(
        F.sum(F.when(F.col("kind") == FX.KIND_ORDINARY, F.col("amount")).otherwise(zero)).alias("ord"),
        F.sum(F.when(F.col("kind") == FX.KIND_EXTRAORDINARY, F.col("amount")).otherwise(zero)).alias("ext"))
    a = apportionment.groupBy("charge_no").agg(
        F.sum("received").alias("rec"), F.sum("prior_balance").alias("bal"), F.sum("debt").alias("debt"))
    j = c.join(e, "charge_no", "left").join(a, "charge_no", "left")
    m = lambda x: F.col(x).cast("decimal(18,2)")
    arr = F.array(*[F.struct(F.lit(k).alias("concept"), v.alias("amount"), F.lit(i).alias("line"))
                    for i, (k, v) in enumerate(zip(FX.TOTAL_CONCEPTS, [m("ord"), m("ext"), m("total"), m("rec"),
                                                                        m("bal"), m("debt")]), start=1)])
    return j.select("charge_no", F.inline(arr)).select(
        F.lit(FX.FINANCIAL_LABEL).alias("kind"), "charge_no", "concept", "amount", F.col("line").cast("int").alias("line"))


def statement_units(apportionment: DataFrame, unit: DataFrame, charge_no=None) -> DataFrame:
    a = apportionment if charge_no is None else apportionment.filter(F.col("charge_no") == charge_no)
    j = a.join(unit.select("unit_id", "floor", "door"), "unit_id")
    m = lambda x: F.col(x).cast("decimal(12,2)")
    return j.select(F.lit(FX.APPORTIONMENT_LABEL).alias("kind"), "charge_no", "unit_id",
                    X.display_unit("floor", "door").alias("unit_label"),
                    F.col("pct").cast("decimal(5,2)").alias("pct"), m("ordinary").alias("ordinary"),
                    m("extraordinary").alias("extraordinary"), m("prior_balance").alias("prior_balance"),
                    m("interest").alias("interest"), m("total").alias("total"), m("received").alias("received"),
                    m("debt").alias("debt"))


# ---------------------------------------------------------------------------
# F-01 / F-05 presentation order and A-11 export. Reports are computed as unordered
# sets (a global sort of a large result is a full shuffle); the reference's ORDER BY
# is applied only when a report is presented or exported.
REPORT_ORDER = {
    "weekly_cash_flow": ["year", "week"],
    "monthly_pivot": ["building_id", "unit_id"],
    "income_by_source": ["building_id", "year", "month"],
    "top_months_income": ["building_id", "year", "rank"],
    "top_months_expense": ["building_id", "year", "rank"],
    "top_debtors": ["building_id", "rank"],
    "days_between_payments": ["building_id", "unit_label", "pay_date", "payment_id"],
    "statement_header": ["charge_no", "line"],
    "statement_debtors": ["-debt", "dni", "charge_no"],
    "statement_ordinary": ["charge_no", "-amount", "expense_id"],
    "statement_extraordinary": ["charge_no", "-amount", "expense_id"],
    "statement_totals": ["charge_no", "line"],
    "statement_units": ["charge_no", "unit_label"],
}


def presented(name: str, df: DataFrame) -> DataFrame:
    """The report in the reference's row order (range-partitioned sort); a leading
    '-' marks a descending key."""
    keys = [F.col(k[1:]).desc() if k.startswith("-") else F.col(k) for k in REPORT_ORDER[name]]
    return df.orderBy(*keys)


def ties(name: str, columns: list[str]) -> list[str]:
    return sorted(set(columns) - {k.lstrip("-") for k in REPORT_ORDER[name]})


def positions(name: str, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The report (or its columns ``keep``) with the ``position`` (from 1) of each row in the reference's order."""
    from ..operators.keys import surrogate_keys

    keys = [F.col(k[1:]).desc_nulls_first() if k.startswith("-") else F.col(k) for k in REPORT_ORDER[name]]
    # rows that tie in the report's order go by the rest of their columns
    return surrogate_keys(df, [*keys, *map(F.col, ties(name, df.columns))], "position", keep=keep)


def statement(ledger, charge_no=None) -> dict[str, DataFrame]:
    """J-08: the six result sets of the charge statement (all charges when None)."""
    L = ledger
    return {
        "statement_header": statement_header(L.charge, L.building, charge_no),
        "statement_debtors": statement_debtors(L.apportionment, L.unit, L.occupancy, L.person, L.charge, charge_no),
        "statement_ordinary": statement_ordinary(L.expense, L.expense_ordinary, charge_no),
        "statement_extraordinary": statement_extraordinary(L.expense, L.expense_extraordinary, charge_no),
        "statement_totals": statement_totals(L.charge, L.expense, L.apportionment, charge_no),
        "statement_units": statement_units(L.apportionment, L.unit, charge_no),
    }


def export_csv(results: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """A-11: each result set as CSV with header, in presentation order."""
    out = {}
    for name, df in results.items():
        path = f"{folder}/{name}"
        presented(name, df).write.mode("overwrite").option("header", True).csv(path)
        out[name] = path
    return out
