"""Monthly charge generation (expenses file -> charges -> apportionment).

Every stage is a pure function ``DataFrame -> DataFrame``; nothing is collected.
Money is exact: amounts are decimals, ratios are computed in integer cents with
one half-up rounding at the end, so results do not depend on the engine.

Scale notes
- ``expand_to_units`` is a one-to-many join (charge x units of its building). It is
  an equi-join on ``building_id``; adaptive execution turns it into a broadcast join
  when the charge side is measured small at runtime, and splits a hot building's
  partition (skew join) otherwise, so one building holding a third of all units is
  spread over many tasks.
- The carry-forward reads the previous charge per unit with one window over the
  apportionment rows of a unit; a unit has one row per charge of its building, so a
  window group is bounded by the number of billing months, not by data volume.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as X
from ..fixed import (EXPENSE_JSON_KEYS, EXTRAORDINARY_CATEGORY, FLAT_INTEREST, INVOICE_PREFIX, KIND_EXTRAORDINARY,
                     KIND_ORDINARY, MISSING_BUILDINGS, PROVIDER_RULES)

# category of each JSON amount key: the key upper-cased
CATEGORY_OF_KEY = {k: k.upper() for k in EXPENSE_JSON_KEYS}
CATEGORIES = [CATEGORY_OF_KEY[k] for k in EXPENSE_JSON_KEYS]

CHARGE_NO_STRIDE = 100000  # charge_no = building_id * stride + (year*12 + month)


def charge_number(building_id, year, month):
    """Deterministic surrogate key of a building-month charge, increasing in time."""
    return (X.col_(building_id).cast("bigint") * CHARGE_NO_STRIDE
            + X.col_(year).cast("bigint") * 12 + X.col_(month).cast("bigint"))


def category_index(category) -> F.Column:
    """1-based position of a category in the file's key order."""
    out = None
    for i, c in enumerate(CATEGORIES, start=1):
        cond = X.col_(category) == c
        out = F.when(cond, F.lit(i)) if out is None else out.when(cond, F.lit(i))
    return out


# ---------------------------------------------------------------------------
# Stage 3-4: wide JSON objects -> long staging rows, month and amount parsed
def stage_expenses(sheet: DataFrame, year_col: str | None = "year", year: int | None = None) -> DataFrame:
    """Unpivot the seven amount keys (CROSS APPLY VALUES) and parse month/amount.

    ``sheet`` has the JSON keys as columns (``Nombre del consorcio``, ``Mes`` and the
    seven amounts) plus, optionally, a ``year`` column; ``year`` as an argument applies
    one year to every row (the reference's @Anio).
    """
    ids = [F.col("`Nombre del consorcio`").alias("building_name_raw"), F.col("Mes").alias("mes_raw_in")]
    if year_col and year_col in sheet.columns:
        ids.append(F.col(year_col).cast("int").alias("year"))
    else:
        ids.append(F.lit(year).cast("int").alias("year"))
    wide = sheet.select(*ids, *[F.col(f"`{k}`").alias(f"v{i}") for i, k in enumerate(EXPENSE_JSON_KEYS)])
    wide = wide.filter(F.col("building_name_raw").isNotNull())
    long = wide.unpivot(
        ["building_name_raw", "mes_raw_in", "year"],
        [f"v{i}" for i in range(len(EXPENSE_JSON_KEYS))],
        "slot", "amount_raw",
    )
    cat = None
    for i, c in enumerate(CATEGORIES):
        cond = F.col("slot") == f"v{i}"
        cat = F.when(cond, F.lit(c)) if cat is None else cat.when(cond, F.lit(c))
    return long.select(
        F.trim("building_name_raw").alias("building_name"),
        F.trim("mes_raw_in").alias("mes_raw"),
        X.es_month_number(F.col("mes_raw_in")).alias("month"),
        F.col("year"),
        cat.alias("category"),
        F.col("amount_raw"),
        X.parse_amount_or_zero("amount_raw", 18).alias("amount"),
    )


def resolve_building(stage: DataFrame, building: DataFrame) -> DataFrame:
    """Attach building_id by (case-insensitive) name; unknown names drop out."""
    b = building.select(X.ci("name").alias("_k"), "building_id")
    return stage.join(b, X.ci(stage["building_name"]) == b["_k"], "inner").drop("_k")


def missing_buildings(stage: DataFrame, building: DataFrame) -> DataFrame:
    """Distinct staged building names that do not exist, plus the one-line message."""
    b = building.select(X.ci("name").alias("_k"))
    names = (stage.select("building_name").distinct()
             .join(b, X.ci(F.col("building_name")) == b["_k"], "left_anti"))
    return names


# ---------------------------------------------------------------------------
# Stage 6-7: totals per building-month, charges (insert if absent)
def charge_totals(resolved: DataFrame) -> DataFrame:
    """SUM(amount) per building-month over positive amounts of months 1..12."""
    return (resolved.filter((F.col("amount") > 0) & F.col("month").between(1, 12))
            .groupBy("building_id", "year", "month")
            .agg(F.sum("amount").cast("decimal(18,2)").alias("total")))


def new_charges(totals: DataFrame, existing: DataFrame | None = None, day1: int = 10, day2: int = 20) -> DataFrame:
    """Charges for building-months that have none yet; due days clamped to month end."""
    out = totals.select(
        charge_number("building_id", "year", "month").alias("charge_no"),
        F.col("building_id").cast("bigint").alias("building_id"),
        F.make_date("year", "month", F.lit(1)).alias("gen_date"),
        X.due_date(F.col("year"), F.col("month"), day1).alias("due1"),
        X.due_date(F.col("year"), F.col("month"), day2).alias("due2"),
        X.clamp(F.col("total")).cast("decimal(10,2)").alias("total"),
    )
    if existing is not None:
        ex = existing.select("building_id", X.month_start("gen_date").alias("gen_date"))
        out = out.join(ex, ["building_id", "gen_date"], "left_anti")
    return out


# ---------------------------------------------------------------------------
# Stage 8-9: base apportionment by floor area
def area_totals(unit: DataFrame) -> DataFrame:
    return unit.groupBy("building_id").agg(F.sum("area").cast("decimal(18,2)").alias("building_area"))


def apportion_base(charge: DataFrame, unit: DataFrame, existing: DataFrame | None = None,
                   tasks: int | None = None) -> DataFrame:
    """charge x units of its building: pct rounded to 2 decimals, amount by exact area ratio. ``tasks`` is the number of
    partitions it is made in, the session's shuffle partitions if not given."""
    if existing is not None:
        charge = charge.join(existing.select("charge_no").distinct(), "charge_no", "left_anti")
    # The expansion runs in the tasks of the streamed (unit) side. Spread the units over
    # an explicit number of partitions by unit_id (not by building: one building may hold
    # a third of all units), so the output is produced in parallel whatever the input
    # file layout; the charges of each building meet them through the equi-join.
    n = tasks or int(unit.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = unit.select("unit_id", "building_id", "area").join(area_totals(unit), "building_id") \
        .repartition(n, "unit_id")
    j = charge.select("charge_no", "building_id", "total").join(units, "building_id")
    j = j.filter(F.col("building_area") > 0)
    # exact long arithmetic: area <= 9999.99, total <= 99 999 999.99 (clamped), so every
    # product below stays far inside 64 bits; ANSI mode would raise on overflow.
    area_c, sum_c, total_c = X.cents_long("area"), X.cents_long("building_area"), X.cents_long("total")
    pct = X.money_from_cents_long(X.div_half_up_long(area_c * 10000, sum_c), 10)
    amount = X.money_from_cents_long(X.div_half_up_long(total_c * area_c, sum_c), 12)
    zero = X.dec(0, 12, 2)
    return j.select(
        "charge_no", "unit_id", pct.alias("pct"),
        zero.alias("prior_balance"), zero.alias("received"), zero.alias("interest"),
        amount.alias("ordinary"), zero.alias("extraordinary"), amount.alias("total"), amount.alias("debt"),
    )


# ---------------------------------------------------------------------------
# Stage 11-13: expenses and their subtype rows
def expenses(resolved: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One expense per positive staged amount (no 7x fan-out), insert-if-absent."""
    rows = resolved.filter((F.col("amount") > 0) & F.col("month").between(1, 12))
    no = charge_number("building_id", "year", "month")
    out = rows.select(
        (no * 10 + category_index(F.col("category"))).alias("expense_id"),
        no.alias("charge_no"),
        F.col("building_id").cast("bigint").alias("building_id"),
        F.when(F.col("category") == EXTRAORDINARY_CATEGORY, F.lit(KIND_EXTRAORDINARY))
         .otherwise(F.lit(KIND_ORDINARY)).alias("kind"),
        F.concat(F.col("category"), F.lit(" - "), F.col("mes_raw")).alias("description"),
        F.make_date("year", "month", F.lit(1)).alias("issue_date"),
        X.clamp(F.col("amount")).cast("decimal(10,2)").alias("amount"),
    )
    if existing is not None:
        out = out.join(existing.select("expense_id"), "expense_id", "left_anti")
    return out


def rule_tag(description) -> tuple[F.Column, F.Column]:
    """(provider category, required provider or '') from the description tokens."""
    d = F.upper(X.col_(description))
    cat = prov = None
    for token, category, provider in PROVIDER_RULES:
        cond = d.contains(token)
        cat = F.when(cond, F.lit(category)) if cat is None else cat.when(cond, F.lit(category))
        p = F.lit(provider or "")
        prov = F.when(cond, p) if prov is None else prov.when(cond, p)
    return cat, prov


def pick_providers(providers: DataFrame) -> DataFrame:
    """One provider per (building, category, provider key): the first by name.

    The provider key is the provider's own name for the categories whose rules name a
    provider (public services), '' otherwise.
    """
    named = {category for _, category, provider in PROVIDER_RULES if provider}
    key = F.when(F.col("category").isin(*named), F.col("provider")).otherwise(F.lit(""))
    return (providers.select("building_id", "category", key.alias("provider_key"), "provider")
            .groupBy("building_id", "category", "provider_key")
            .agg(F.min("provider").alias("provider")))


def assign_providers(expense: DataFrame, providers: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Ordinary expense -> provider by the rule table, as an equi-join (no theta join)."""
    cat, prov = rule_tag(F.col("description"))
    tagged = (expense.filter(F.col("kind") == KIND_ORDINARY)
              .select("expense_id", "building_id", cat.alias("category"), prov.alias("provider_key"))
              .filter(F.col("category").isNotNull()))
    out = tagged.join(pick_providers(providers), ["building_id", "category", "provider_key"]).select(
        "expense_id", "provider", "category",
        F.concat(F.lit(INVOICE_PREFIX), F.col("expense_id").cast("string")).alias("invoice_no"))
    if existing is not None:
        out = out.join(existing.select("expense_id"), "expense_id", "left_anti")
    return out


def extraordinary_rows(expense: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    out = expense.filter(F.col("kind") == KIND_EXTRAORDINARY).select(
        "expense_id", F.lit(1).cast("smallint").alias("instalment"), F.lit(1).cast("smallint").alias("instalments"))
    if existing is not None:
        out = out.join(existing.select("expense_id"), "expense_id", "left_anti")
    return out


# ---------------------------------------------------------------------------
# Stage 14: real totals onto the apportionment
def expense_totals(expense: DataFrame) -> DataFrame:
    """Conditional sums per charge (SUM(CASE WHEN kind ...))."""
    amt = F.col("amount")
    return expense.groupBy("charge_no").agg(
        F.sum(F.when(F.col("kind") == KIND_ORDINARY, amt).otherwise(X.dec(0, 10, 2))).cast("decimal(18,2)").alias("sum_ordinary"),
        F.sum(F.when(F.col("kind") == KIND_EXTRAORDINARY, amt).otherwise(X.dec(0, 10, 2))).cast("decimal(18,2)").alias("sum_extraordinary"),
        F.sum(amt).cast("decimal(18,2)").alias("sum_total"),
    )


def _share(total_col: str) -> F.Column:
    """round(total * pct / 100, 2) in exact long arithmetic (cents x hundredths of a
    percent <= 7e10 x 1e4, far inside 64 bits)."""
    total_c = X.cents_long(F.coalesce(F.col(total_col), X.dec(0, 18, 2)))
    return X.money_from_cents_long(X.div_half_up_long(total_c * X.cents_long("pct"), F.lit(10000)), 12)


def apportion_final(base: DataFrame, totals: DataFrame) -> DataFrame:
    """ordinary/extraordinary/total = charge sums x rounded pct / 100 (unit amounts
    need not add up to the charge total)."""
    j = base.join(totals, "charge_no", "inner")
    j = j.select("charge_no", "unit_id", "pct", "prior_balance", "received", "interest",
                 _share("sum_ordinary").alias("ordinary"), _share("sum_extraordinary").alias("extraordinary"),
                 _share("sum_total").alias("total"))
    return j.withColumn("debt", F.col("total"))


# ---------------------------------------------------------------------------
# Stage 15: carry-forward of the previous charge's debt (+ flat interest)
def previous_charge(charge: DataFrame) -> DataFrame:
    """charge_no -> previous charge_no of the same building (MAX below it)."""
    w = Window.partitionBy("building_id").orderBy("charge_no")
    return charge.select("charge_no", F.lag("charge_no").over(w).alias("prev_charge_no"))


def carry_forward(appt: DataFrame, charge: DataFrame, rate=FLAT_INTEREST, chained: bool = False,
                  stored_appt: DataFrame | None = None, stored_charge: DataFrame | None = None) -> DataFrame:
    """One-step (snapshot) carry-forward: prior balance = previous charge's debt of the
    same unit *before* this step; interest = rate x balance when positive.

    ``chained=True`` instead folds the linear recurrence d_t = c_t + (1+rate) d_{t-1}
    per unit (each charge sees the already carried debt of its predecessor), in one pass.

    ``stored_charge`` / ``stored_appt``: the ledger as it is. The previous charge of a
    building's first new charge is a stored one, and its stored debt is carried. Only
    the rows of ``appt`` come out.
    """
    zero = X.dec(0, 12, 2)
    ids = charge.select("charge_no", "building_id")
    if stored_charge is not None:
        known = stored_charge.select("charge_no", "building_id").join(ids.select("charge_no"), "charge_no", "left_anti")
        ids = ids.unionByName(known)
    prev = previous_charge(ids)
    a = appt.join(prev, "charge_no")
    if stored_appt is not None:
        old = stored_appt.select(F.col("charge_no").alias("prev_charge_no"), "unit_id", F.col("debt").alias("_stored"))
        a = a.join(old, ["prev_charge_no", "unit_id"], "left")
    else:
        a = a.withColumn("_stored", F.lit(None).cast("decimal(12,2)"))
    if not chained:
        w = Window.partitionBy("unit_id").orderBy("charge_no")
        a = a.withColumn("_lag_no", F.lag("charge_no").over(w)).withColumn("_lag_debt", F.lag("debt").over(w))
        bal = F.when(F.col("_lag_no") == F.col("prev_charge_no"), F.col("_lag_debt")).otherwise(F.col("_stored"))
        a = a.withColumn("prior_balance", F.coalesce(bal, zero).cast("decimal(12,2)"))
    else:
        a = _chained_balance(a, rate)
    interest = F.when(F.col("prior_balance") > 0,
                      (F.col("prior_balance") * F.lit(Decimal(str(rate)))).cast("decimal(12,2)")).otherwise(zero)
    a = a.withColumn("interest", interest)
    total = (F.coalesce("ordinary", zero) + F.coalesce("extraordinary", zero)
             + F.col("prior_balance") + F.col("interest")).cast("decimal(12,2)")
    return a.select("charge_no", "unit_id", "pct", "prior_balance", "received", "interest",
                    "ordinary", "extraordinary", total.alias("total"), total.alias("debt"))


def _chained_balance(a: DataFrame, rate) -> DataFrame:
    """Chained recurrence as one ordered fold over each unit's rows.

    A unit has one row a billing month, so its rows are gathered once, sorted, folded inside the JVM (``aggregate``
    carries the last charge, its debt and the balances so far) and laid out again with their balances. A row whose
    previous charge is not the unit's row before starts from the stored debt.
    """
    zero, r = X.dec(0, 12, 2), F.lit(Decimal(str(rate)))
    row = F.struct("charge_no", *[c for c in a.columns if c not in ("charge_no", "unit_id")])
    units = a.groupBy("unit_id").agg(F.sort_array(F.collect_list(row)).alias("_rows"))

    def step(acc, x):
        carried = F.coalesce(F.when(x["prev_charge_no"] == acc["no"], acc["debt"]).otherwise(x["_stored"]), zero)
        interest = F.when(carried > 0, (carried * r).cast("decimal(12,2)")).otherwise(zero)
        own = F.coalesce(x["ordinary"], zero) + F.coalesce(x["extraordinary"], zero)
        return F.struct(x["charge_no"].alias("no"), (own + carried + interest).cast("decimal(12,2)").alias("debt"),
                        F.array_append(acc["balances"], carried.cast("decimal(12,2)")).alias("balances"))

    start = F.struct(F.lit(None).cast(a.schema["charge_no"].dataType).alias("no"), zero.alias("debt"),
                     F.array().cast("array<decimal(12,2)>").alias("balances"))
    balances = F.aggregate("_rows", start, step)["balances"]
    both = units.select("unit_id", F.explode(F.arrays_zip(F.col("_rows").alias("row"), balances.alias("balance"))).alias("_x"))
    return both.select("unit_id", "_x.row.*", F.col("_x.balance").alias("_balance")) \
        .withColumn("prior_balance", F.col("_balance")).select(*a.columns)


# ---------------------------------------------------------------------------
# J-15 / J-16: the whole expenses import as one call
class UnknownBuildings(ValueError):
    """The file names buildings that do not exist; ``missing`` is the DataFrame of all of them."""

    def __init__(self, message: str, missing: DataFrame):
        super().__init__(message)
        self.missing = missing


def generate_charges(sheet: DataFrame, providers: DataFrame, building: DataFrame, unit: DataFrame,
                     existing_charges: DataFrame | None = None, existing_expenses: DataFrame | None = None,
                     year: int | None = None, day1: int = 10, day2: int = 20, carry: str = "snapshot",
                     check_buildings: bool = True, interest: str = "flat", as_of=None,
                     existing_apportionment: DataFrame | None = None) -> dict[str, DataFrame]:
    """Expenses objects (+ providers) -> charges, apportionment, expenses and subtypes.

    With ``existing_charges``, ``existing_expenses`` and ``existing_apportionment`` only what
    is new comes out, and the first new charge of a building carries the stored debt.
    Unknown building names stop the import (as the reference raises); the error holds
    the DataFrame of all missing names. ``carry`` is 'snapshot' (one-step,
    the reference's behaviour) or 'chained'. ``interest`` is 'flat' (5% of the carried
    balance, the import's rule) or 'tiered' (the late-interest rule as of ``as_of``).
    """
    stage = stage_expenses(sheet, year=year)
    if check_buildings:
        missing = missing_buildings(stage, building)
        if not missing.isEmpty():
            raise UnknownBuildings(MISSING_BUILDINGS + "(all of them in .missing)", missing)
    resolved = resolve_building(stage, building)
    charge = new_charges(charge_totals(resolved), existing_charges, day1, day2)
    expense = expenses(resolved, existing_expenses)
    base = apportion_base(charge, unit)
    final = apportion_final(base, expense_totals(expense))
    if interest == "flat":
        carried = carry_forward(final, charge, chained=(carry == "chained"), stored_appt=existing_apportionment,
                                stored_charge=existing_charges)
    elif interest == "tiered":
        from .interest import late_interest
        if as_of is None:
            raise ValueError("tiered interest needs as_of")
        base = carry_forward(final, charge, rate=Decimal("0"), chained=(carry == "chained"),
                             stored_appt=existing_apportionment, stored_charge=existing_charges)
        li = late_interest(base, charge, as_of).select(
            "charge_no", "unit_id", F.col("interest").alias("_i"), F.col("total").alias("_t"))
        carried = base.join(li, ["charge_no", "unit_id"], "left").select(
            "charge_no", "unit_id", "pct", "prior_balance", "received",
            F.coalesce("_i", "interest").alias("interest"), "ordinary", "extraordinary",
            F.coalesce("_t", "total").alias("total"), F.coalesce("_t", "debt").alias("debt"))
    else:
        raise ValueError("interest must be 'flat' or 'tiered'")
    return {"charge": charge, "expense": expense, "expense_ordinary": assign_providers(expense, providers),
            "expense_extraordinary": extraordinary_rows(expense), "apportion_base": base,
            "apportion_final": final, "apportionment": carried}


def load_expenses_file(spark, json_path: str, providers_path: str, building: DataFrame, unit: DataFrame,
                       year: int = 2024, day1: int = 10, day2: int = 20, **kw) -> dict[str, DataFrame]:
    """J-16: read the expenses JSON and the providers range, then ``generate_charges``."""
    from ..sources.adapter import providers_table
    from ..sources.files import read_expenses_json, read_providers_sheet

    sheet = read_expenses_json(spark, json_path)
    providers = providers_table(read_providers_sheet(spark, providers_path), building)
    return generate_charges(sheet, providers, building, unit, year=year, day1=day1, day2=day2, **kw)
