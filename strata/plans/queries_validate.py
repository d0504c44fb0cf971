"""Registered validators (J-20, I-10): every rule with its own reason code."""

from __future__ import annotations

import datetime as _dt

from ..operators import validate as V
from ..sources import batches as B
from .catalog import query
from .oracle import with_ctes

AS_OF = _dt.date(2001, 6, 30)  # "today" for the not-in-the-future rules
_D = f"DATE '{AS_OF}'"


def _sql(batch: str, rules: list[tuple[str, str]], cols: str, key: str | None = None, order: str | None = None,
         stored: str | None = None) -> str:
    """Oracle: reasons = concat_ws of the failing codes; duplicates by row_number;
    ``stored`` is the condition that a row's key is in the stored table."""
    parts = [f"CASE WHEN {cond} THEN '{code}' END" for cond, code in rules]
    dup = ""
    if stored:
        parts.append(f"CASE WHEN {stored} THEN 'ALREADY_EXISTS' END")
    if key:
        parts.append("CASE WHEN rn > 1 THEN 'DUPLICATE_KEY' END")
        dup = f", row_number() OVER (PARTITION BY {key} ORDER BY {order or key}) AS rn"
    return with_ctes(f"""
SELECT {cols}, CASE WHEN r = '' THEN 'ACCEPTED' ELSE 'REJECTED' END AS status, r AS reasons
FROM (SELECT *, concat_ws(',', {", ".join(parts)}) AS r
      FROM (SELECT *{dup} FROM ({batch}) b0) b1) b2""")


def _blank_long(c: str, n: int) -> str:
    return f"(coalesce({c}, '') = '' OR length(rtrim({c})) > {n})"


def _present(c: str) -> str:
    return f"({c} IS NOT NULL AND {c} <> '')"


# ---------------------------------------------------------------------------
@query("q_validate_buildings", _sql("""
SELECT building_id, CASE WHEN building_id % 7 = 2 THEN '' ELSE name END AS name, address, unit_count,
       CASE WHEN building_id % 5 = 1 THEN CAST(0 AS DECIMAL(18,2)) ELSE area END AS area,
       CASE WHEN building_id % 11 = 3 THEN CAST(-1 AS DECIMAL(5,2)) ELSE fee_first END AS fee_first, fee_next
FROM building
UNION ALL
SELECT building_id + 1000, CASE WHEN building_id % 7 = 2 THEN '' ELSE name END, address, unit_count,
       CASE WHEN building_id % 5 = 1 THEN CAST(0 AS DECIMAL(18,2)) ELSE area END,
       CASE WHEN building_id % 11 = 3 THEN CAST(-1 AS DECIMAL(5,2)) ELSE fee_first END, fee_next
FROM building WHERE building_id % 6 = 0""", [
    (_blank_long("name", 40), "NAME_LENGTH"), (_blank_long("address", 100), "ADDRESS_LENGTH"),
    ("area IS NULL OR area <= 0", "INVALID_AREA"), ("unit_count IS NULL OR unit_count <= 0", "INVALID_UNIT_COUNT"),
    ("fee_first IS NULL OR fee_first < 0", "INVALID_FEE_FIRST"), ("fee_next IS NULL OR fee_next < 0", "INVALID_FEE_NEXT"),
], "building_id, name, address, unit_count, area, fee_first, fee_next", "name, address", "name, address, building_id"))
def q_validate_buildings(L):
    """J-20 buildings: lengths, area, unit count, fees; unique (name, address)."""
    return V.validate_buildings(B.buildings(L.building)).select(
        "building_id", "name", "address", "unit_count", "area", "fee_first", "fee_next", "status", "reasons")


@query("q_validate_units", _sql("""
SELECT unit_id, CASE WHEN unit_id % 17 = 0 THEN building_id + 1000 ELSE building_id END AS building_id,
       CASE WHEN unit_id % 19 = 0 THEN '' ELSE floor END AS floor, door, area,
       CASE WHEN unit_id % 13 = 0 THEN CAST(0 AS DECIMAL(5,2)) ELSE coef END AS coef
FROM unit""", [
    ("building_id NOT IN (SELECT building_id FROM building)", "UNKNOWN_BUILDING"),
    (_blank_long("floor", 10), "FLOOR_LENGTH"), (_blank_long("door", 10), "DOOR_LENGTH"),
    ("area IS NULL OR area <= 0", "INVALID_AREA"), ("coef IS NULL OR coef <= 0 OR coef > 100", "INVALID_COEF"),
], "unit_id, building_id, floor, door, area, coef", "building_id, floor, door", "building_id, floor, door, unit_id",
    "EXISTS (SELECT 1 FROM unit e WHERE e.unit_id % 23 = 0 AND e.building_id = b1.building_id"
    " AND e.floor = b1.floor AND e.door = b1.door)"))
def q_validate_units(L):
    """J-20 units: building exists, floor/door 1-10, area > 0, 0 < coef <= 100, unique in
    the batch and against the units already stored (here every 23rd)."""
    stored = L.unit.filter("unit_id % 23 = 0")
    return V.validate_units(B.units(L.unit), L.building, stored).select(
        "unit_id", "building_id", "floor", "door", "area", "coef", "status", "reasons")


@query("q_validate_units_any_case", _sql("""
SELECT unit_id, building_id, floor, door, area, coef FROM unit WHERE unit_id % 2 = 0
UNION ALL SELECT unit_id + 1000000, building_id, floor, lower(door), area, coef FROM unit WHERE unit_id % 4 = 0""", [
    ("building_id NOT IN (SELECT building_id FROM building)", "UNKNOWN_BUILDING"),
    (_blank_long("floor", 10), "FLOOR_LENGTH"), (_blank_long("door", 10), "DOOR_LENGTH"),
    ("area IS NULL OR area <= 0", "INVALID_AREA"), ("coef IS NULL OR coef <= 0 OR coef > 100", "INVALID_COEF"),
], "unit_id, building_id, floor, door, area, coef", "building_id, lower(floor), lower(door)",
    "building_id, floor, door, unit_id",
    "EXISTS (SELECT 1 FROM unit e WHERE e.unit_id % 6 = 0 AND e.building_id = b1.building_id"
    " AND lower(e.floor) = lower(b1.floor) AND lower(e.door) = lower(b1.door))"))
def q_validate_units_any_case(L):
    """J-20 units whose keys differ in case only: repeats of the batch and of the units
    stored (here every sixth)."""
    from pyspark.sql import functions as F
    u = L.unit.select("unit_id", "building_id", "floor", "door", "area", "coef")
    again = u.filter("unit_id % 4 = 0").withColumns({"unit_id": F.col("unit_id") + 1_000_000, "door": F.lower("door")})
    return V.validate_units(u.filter("unit_id % 2 = 0").unionByName(again), L.building, L.unit.filter("unit_id % 6 = 0")) \
        .select("unit_id", "building_id", "floor", "door", "area", "coef", "status", "reasons")


_PEOPLE_BATCH = f"""
SELECT dni,
       CASE WHEN substring(dni, 1, 1) <> '9' AND unit_id % 13 = 0 THEN 'José' ELSE first_name END AS first_name,
       last_name,
       CASE WHEN substring(dni, 1, 1) <> '9' AND unit_id % 11 = 0 THEN 'sin-arroba.com' ELSE email END AS email,
       CASE WHEN substring(dni, 1, 1) <> '9' AND unit_id % 31 = 0 THEN '11-1234' ELSE phone END AS phone,
       CASE WHEN substring(dni, 1, 1) <> '9' AND unit_id % 29 = 0 THEN substring(account, 1, 20) ELSE account END AS account,
       CASE WHEN substring(dni, 1, 1) <> '9' AND unit_id % 37 = 0 THEN unit_id + {B.UNKNOWN_SHIFT} ELSE unit_id END AS unit_id
FROM person
UNION ALL
SELECT dni, first_name, last_name, email, phone, '2' || substring(account, 2, 21), unit_id
FROM person WHERE substring(dni, 1, 1) <> '9' AND unit_id % 43 = 0"""


@query("q_validate_people", _sql(_PEOPLE_BATCH, [
    ("coalesce(dni, '') = '' OR regexp_matches(dni, '[^0-9]') OR length(rtrim(dni)) > 10", "INVALID_DNI"),
    (f"{_blank_long('first_name', 30)} OR regexp_matches(first_name, '[^a-zA-Z ]')", "INVALID_FIRST_NAME"),
    (f"{_blank_long('last_name', 30)} OR regexp_matches(last_name, '[^a-zA-Z ]')", "INVALID_LAST_NAME"),
    (f"{_present('email')} AND (email NOT LIKE '%@%.%' OR length(rtrim(email)) > 40)", "INVALID_EMAIL"),
    (f"{_present('phone')} AND (regexp_matches(phone, '[^0-9]') OR length(rtrim(phone)) > 15)", "INVALID_PHONE"),
    (f"{_present('account')} AND (regexp_matches(account, '[^0-9]') OR length(rtrim(account)) <> 22)", "INVALID_ACCOUNT"),
    ("unit_id IS NOT NULL AND unit_id NOT IN (SELECT unit_id FROM unit)", "UNKNOWN_UNIT"),
], "dni, first_name, last_name, email, phone, account, unit_id", "dni", "dni, account"))
def q_validate_people(L):
    """J-20 people (B-08/B-09): DNI digits, names letters only, e-mail shape, phone and
    account digits, unit exists, unique DNI."""
    return V.validate_people(B.people(L.person), L.unit).select(
        "dni", "first_name", "last_name", "email", "phone", "account", "unit_id", "status", "reasons")


@query("q_validate_occupancy", _sql("""
SELECT occupancy_id, CASE WHEN unit_id % 17 = 0 THEN 'Dueño' ELSE role END AS role, unit_id,
       CASE WHEN unit_id % 19 = 0 THEN dni || 'X' ELSE dni END AS dni
FROM occupancy""", [
    ("unit_id NOT IN (SELECT unit_id FROM unit)", "UNKNOWN_UNIT"),
    ("dni NOT IN (SELECT dni FROM person)", "UNKNOWN_PERSON"),
    ("coalesce(role IN ('Propietario', 'Inquilino'), false) = false", "INVALID_ROLE"),
], "occupancy_id, role, unit_id, dni"))
def q_validate_occupancy(L):
    """J-20 occupancy: unit and person exist, role in the domain."""
    return V.validate_occupancy(B.occupancy(L.occupancy), L.unit, L.person).select(
        "occupancy_id", "role", "unit_id", "dni", "status", "reasons")


def _sized_sql(table: str, id_col: str, zero_mod: int, unknown_mod: int) -> str:
    return _sql(f"""
SELECT {id_col}, CASE WHEN unit_id % {zero_mod} = 0 THEN CAST(0 AS DECIMAL(10,2)) ELSE size END AS size,
       CASE WHEN unit_id % {unknown_mod} = 0 THEN unit_id + {B.UNKNOWN_SHIFT} ELSE unit_id END AS unit_id
FROM {table}""", [
        ("unit_id NOT IN (SELECT unit_id FROM unit)", "UNKNOWN_UNIT"),
        ("size IS NULL OR size <= 0", "INVALID_SIZE"),
    ], f"{id_col}, size, unit_id")


@query("q_validate_storage", _sized_sql("storage", "storage_id", 8, 20))
def q_validate_storage(L):
    """J-20 storage rooms: unit exists, size > 0."""
    return V.validate_sized(B.sized(L.storage, "storage_id", 8, 20), L.unit).select(
        "storage_id", "size", "unit_id", "status", "reasons")


@query("q_validate_parking", _sized_sql("parking", "parking_id", 12, 30))
def q_validate_parking(L):
    """J-20 parking spaces: unit exists, size > 0."""
    return V.validate_sized(B.sized(L.parking, "parking_id", 12, 30), L.unit).select(
        "parking_id", "size", "unit_id", "status", "reasons")


@query("q_validate_charges", _sql("""
SELECT charge_no, building_id, gen_date, d1 AS due1,
       CASE WHEN charge_no % 19 = 0 THEN d1 ELSE due2 END AS due2, total
FROM (SELECT *, CASE WHEN charge_no % 17 = 0 THEN gen_date ELSE due1 END AS d1 FROM charge) c""", [
    ("building_id NOT IN (SELECT building_id FROM building)", "UNKNOWN_BUILDING"),
    (f"gen_date IS NULL OR gen_date > {_D}", "INVALID_GEN_DATE"),
    ("due1 IS NOT NULL AND due1 <= gen_date", "INVALID_DUE1"),
    ("due2 IS NOT NULL AND due1 IS NOT NULL AND due2 <= due1", "INVALID_DUE2"),
    ("total IS NOT NULL AND total < 0", "NEGATIVE_TOTAL"),
], "charge_no, building_id, gen_date, due1, due2, total"))
def q_validate_charges(L):
    """J-20 charges: building exists, generation date present and not future, due
    dates ordered, total >= 0."""
    return V.validate_charges(B.charges(L.charge), L.building, AS_OF).select(
        "charge_no", "building_id", "gen_date", "due1", "due2", "total", "status", "reasons")


@query("q_validate_apportionments", _sql("""
SELECT charge_no, unit_id,
       CASE WHEN (unit_id + charge_no) % 97 = 0 THEN CAST(0 AS DECIMAL(10,2)) ELSE pct END AS pct,
       prior_balance, received, interest, ordinary, extraordinary, total, debt
FROM (SELECT * FROM apportionment
      UNION ALL SELECT * FROM apportionment WHERE (unit_id + 3 * charge_no) % 89 = 0) a""", [
    ("charge_no NOT IN (SELECT charge_no FROM charge)", "UNKNOWN_CHARGE"),
    ("unit_id NOT IN (SELECT unit_id FROM unit)", "UNKNOWN_UNIT"),
    ("pct IS NULL OR pct <= 0 OR pct > 100", "INVALID_PCT"),
    (" OR ".join(f"coalesce({c} < 0, false)" for c in V.AMOUNT_COLUMNS), "NEGATIVE_AMOUNT"),
], "charge_no, unit_id, pct", "charge_no, unit_id", stored="charge_no % 31 = 0"))
def q_validate_apportionments(L):
    """J-20 apportionment: charge and unit exist, 0 < pct <= 100, amounts >= 0, unique in
    the batch (which has exact repeats) and against the rows stored (here of every 31st
    charge number)."""
    stored = L.apportionment.filter("charge_no % 31 = 0")
    return V.validate_apportionments(B.apportionments(L.apportionment), L.charge, L.unit, stored).select(
        "charge_no", "unit_id", "pct", "status", "reasons")


@query("q_validate_payments", _sql("SELECT source_id, pay_date, amount, account, unit_id, charge_no FROM bank_matched", [
    ("unit_id IS NULL OR unit_id NOT IN (SELECT unit_id FROM unit)", "UNKNOWN_UNIT"),
    ("charge_no IS NULL OR charge_no NOT IN (SELECT charge_no FROM charge)", "UNKNOWN_CHARGE"),
    (f"pay_date IS NULL OR pay_date > {_D}", "INVALID_DATE"),
    ("amount IS NULL OR amount <= 0", "INVALID_AMOUNT"),
    ("coalesce(account = '' OR length(rtrim(account)) <> 22 OR regexp_matches(account, '[^0-9]'), false)",
     "INVALID_ACCOUNT"),
], "source_id, pay_date, amount, account, unit_id, charge_no"))
def q_validate_payments(L):
    """J-20 payments: unit and charge exist, date present and not future, amount > 0,
    22-digit account."""
    b = L.bank_matched.select("source_id", "pay_date", "amount", "account", "unit_id", "charge_no")
    return V.validate_payments(b, L.unit, L.charge, AS_OF).select(
        "source_id", "pay_date", "amount", "account", "unit_id", "charge_no", "status", "reasons")


@query("q_validate_expenses", _sql("""
SELECT expense_id, charge_no, building_id, CASE WHEN expense_id % 23 = 0 THEN 'Otro' ELSE kind END AS kind,
       description, issue_date, amount FROM expense""", [
    ("charge_no NOT IN (SELECT charge_no FROM charge)", "UNKNOWN_CHARGE"),
    ("building_id NOT IN (SELECT building_id FROM building)", "UNKNOWN_BUILDING"),
    ("coalesce(kind IN ('Ordinario', 'Extraordinario'), false) = false", "INVALID_KIND"),
    ("description IS NOT NULL AND length(rtrim(description)) > 200", "DESCRIPTION_LENGTH"),
    (f"coalesce(issue_date, {_D}) > {_D}", "INVALID_DATE"),
    ("amount IS NULL OR amount < 0", "INVALID_AMOUNT"),
], "expense_id, charge_no, building_id, kind, amount"))
def q_validate_expenses(L):
    """J-20 expenses (B-10): charge and building exist, kind in the domain,
    description <= 200, date not future (default today), amount >= 0."""
    return V.validate_expenses(B.expenses(L.expense), L.charge, L.building, AS_OF).select(
        "expense_id", "charge_no", "building_id", "kind", "amount", "status", "reasons")


@query("q_validate_ordinary", _sql("""
SELECT b.expense_id, b.provider, b.category, b.invoice_no, e.kind AS parent_kind
FROM (SELECT * FROM expense_ordinary
      UNION ALL
      SELECT expense_id, 'N/A', 'GASTOS GENERALES', 'FAC-' || CAST(expense_id AS VARCHAR) FROM expense
      WHERE kind = 'Extraordinario') b
LEFT JOIN expense e ON e.expense_id = b.expense_id""", [
    ("parent_kind IS NULL", "UNKNOWN_EXPENSE"),
    ("parent_kind IS NOT NULL AND parent_kind <> 'Ordinario'", "NOT_ORDINARY"),
    ("provider IS NOT NULL AND length(rtrim(provider)) > 100", "PROVIDER_LENGTH"),
    ("category IS NOT NULL AND length(rtrim(category)) > 35", "CATEGORY_LENGTH"),
    ("invoice_no IS NOT NULL AND length(rtrim(invoice_no)) > 50", "INVOICE_LENGTH"),
], "expense_id, provider, category, invoice_no", "expense_id", "expense_id, provider, category"))
def q_validate_ordinary(L):
    """J-20 ordinary subtype: parent exists and is ordinary, lengths, one per expense."""
    return V.validate_ordinary(B.ordinary(L.expense_ordinary, L.expense), L.expense).select(
        "expense_id", "provider", "category", "invoice_no", "status", "reasons")


@query("q_validate_extraordinary", _sql("""
SELECT b.expense_id, b.instalment, b.instalments, e.kind AS parent_kind
FROM (SELECT expense_id,
             CASE WHEN expense_id % 7 = 0 THEN CAST(3 AS SMALLINT) ELSE instalment END AS instalment,
             CASE WHEN expense_id % 7 = 0 THEN CAST(2 AS SMALLINT) ELSE instalments END AS instalments
      FROM expense_extraordinary
      UNION ALL
      SELECT expense_id, CAST(1 AS SMALLINT), CAST(1 AS SMALLINT) FROM expense WHERE kind = 'Ordinario') b
LEFT JOIN expense e ON e.expense_id = b.expense_id""", [
    ("parent_kind IS NULL", "UNKNOWN_EXPENSE"),
    ("parent_kind IS NOT NULL AND parent_kind <> 'Extraordinario'", "NOT_EXTRAORDINARY"),
    ("instalment IS NOT NULL AND (instalment <= 0 OR instalment > 255)", "INVALID_INSTALMENT"),
    ("instalments IS NOT NULL AND (instalments <= 0 OR instalments > 255)", "INVALID_INSTALMENTS"),
    ("instalment IS NOT NULL AND instalments IS NOT NULL AND instalment > instalments", "INSTALMENT_ORDER"),
], "expense_id, instalment, instalments", "expense_id", "expense_id, instalment, instalments"))
def q_validate_extraordinary(L):
    """J-20 extraordinary subtype: parent exists and is extraordinary, instalments
    1-255 and current <= count, one per expense."""
    return V.validate_extraordinary(B.extraordinary(L.expense_extraordinary, L.expense), L.expense).select(
        "expense_id", "instalment", "instalments", "status", "reasons")
