"""Set-based imports of the raw files (buildings, units, people, occupancy).

The reference loops row by row in places; here every import is one declarative
plan: clean -> resolve natural keys by equi-joins -> insert if absent (left anti
join) -> report rejects with reasons. Names, addresses, floors and doors compare as
the database compares them (``functions.ci``): case and outer blanks do not count.

Deduplication keeps one row per key with ``min`` over a struct ordered by the
tie-break columns: a grouped aggregate with map-side partial aggregation, so a key
repeated millions of times never gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as X
from .keys import next_ids
from .validate import first_of_key
from ..fixed import FEE_FIRST, FEE_NEXT, PLACEHOLDER_ADDRESS_PREFIX, PLACEHOLDER_AREA, ROLE_OWNER, ROLE_TENANT


def _reasons(*rules) -> F.Column:
    return F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, r in rules])), ",")


# ---------------------------------------------------------------------------
# J-10 units file
def units_staged(units_file: DataFrame) -> DataFrame:
    """Drop blank-building rows; trim keys; parse area and coefficient (comma allowed)."""
    f = units_file.filter(~X.is_blank("building_name"))
    return f.select(
        F.trim("building_name").alias("building_name"), F.trim("floor").alias("floor"),
        F.trim("door").alias("door"),
        F.trim("area").try_cast("decimal(6,2)").alias("area"),
        X.try_decimal_comma("coef", 5, 2).alias("coef"),
        F.lower(F.trim("has_storage")).alias("has_storage"), F.lower(F.trim("has_parking")).alias("has_parking"),
        F.trim("storage_area").try_cast("decimal(10,2)").alias("storage_area"),
        F.trim("parking_area").try_cast("decimal(10,2)").alias("parking_area"),
    )


def new_buildings(staged: DataFrame, building: DataFrame) -> DataFrame:
    """I-04: distinct building names of the file that do not exist yet, as placeholder
    buildings (address 'Dirección <name>', area 1000.00, fees 2.00/5.00). Of spellings
    that compare alike the first in binary order is stored."""
    b = building.select(X.ci("name").alias("_k"))
    names = staged.groupBy(X.ci("building_name").alias("_n")).agg(F.min("building_name").alias("name"))
    new = names.join(b, F.col("_n") == b["_k"], "left_anti")
    return new.select(
        "name", F.concat(F.lit(PLACEHOLDER_ADDRESS_PREFIX), F.col("name")).alias("address"),
        F.lit(PLACEHOLDER_AREA).cast("decimal(10,2)").alias("area"),
        F.lit(FEE_FIRST).cast("decimal(5,2)").alias("fee_first"), F.lit(FEE_NEXT).cast("decimal(5,2)").alias("fee_next"))


def _unit_keys(unit: DataFrame, *more: str) -> DataFrame:
    return unit.select(F.col("building_id").alias("_ub"), X.ci("floor").alias("_uf"), X.ci("door").alias("_ud"), *more)


def _same_unit(rows: DataFrame, keys: DataFrame) -> F.Column:
    return (rows["building_id"] == keys["_ub"]) & (X.ci(rows["floor"]) == keys["_uf"]) \
        & (X.ci(rows["door"]) == keys["_ud"])


def clean_units(staged: DataFrame, building: DataFrame, unit: DataFrame) -> DataFrame:
    """Units of the file with status: EXISTING (same building/floor/door already
    stored), REJECTED (reasons; the reference stores 0 instead, against its own CHECK),
    ACCEPTED otherwise. Rows with blank floor or door are skipped, as in the reference."""
    s = staged.filter(~X.is_blank("floor") & ~X.is_blank("door"))
    b = building.select(X.ci("name").alias("_k"), "building_id")
    s = s.join(b, X.ci(F.col("building_name")) == b["_k"], "left").drop("_k")
    u = _unit_keys(unit).distinct().withColumn("_exists", F.lit(True))
    s = s.join(u, _same_unit(s, u), "left").drop("_ub", "_uf", "_ud")
    reasons = _reasons(
        (F.col("area").isNull() | (F.col("area") <= 0), "INVALID_AREA"),
        (F.col("coef").isNull() | (F.col("coef") <= 0) | (F.col("coef") > 100), "INVALID_COEF"),
        (F.length("floor") > 10, "FLOOR_LENGTH"), (F.length("door") > 10, "DOOR_LENGTH"))
    s = s.withColumn("_reasons", reasons)
    # of the rows of one new unit the first is accepted, the others find it stored
    fits = F.coalesce(F.col("_exists"), F.lit(False)) | (F.col("_reasons") != "")
    new = first_of_key(s.filter(~fits).withColumn("_key", F.coalesce(F.col("building_id").cast("string"), F.concat(F.lit("#"), "building_name"))),
                       ["_key", "floor", "door"], ["_key", "floor", "door", "area", "coef"]).drop("_key")
    s = s.filter(fits).withColumn("_first", F.lit(True)).unionByName(new)
    reasons = F.col("_reasons")
    status = F.when(F.col("_exists") | ~F.col("_first"), F.lit("EXISTING")).when(reasons != "", F.lit("REJECTED")) \
        .otherwise(F.lit("ACCEPTED"))
    return s.select("building_name", "building_id", "floor", "door", "area", "coef",
                    status.alias("status"), reasons.alias("reasons"))


def import_units(staged: DataFrame, building: DataFrame, unit: DataFrame) -> dict[str, DataFrame]:
    """The whole units import: placeholder buildings get ids, the file's new units are
    stored with ids, and storage and parking join to the units just stored.

    Returns the tables as they are afterwards (``building`` with building_id, name;
    ``unit``), the ``storage`` and ``parking`` rows to insert and the ``report`` rows.
    """
    fresh = next_ids(new_buildings(staged, building), building, "building_id", ["name"], "building_id")
    buildings = building.select("building_id", "name").unionByName(fresh.select("building_id", "name"))
    report = clean_units(staged, buildings, unit)
    cols = ["building_id", "floor", "door", "area", "coef"]
    accepted = report.filter(F.col("status") == "ACCEPTED").select(*cols)
    new = next_ids(accepted, unit, "unit_id", ["building_id", "floor", "door"], "unit_id")
    units = unit.select("unit_id", *cols).unionByName(new.select("unit_id", *cols))
    return {"building": buildings, "unit": units, "report": report,
            "storage": storage_rows(staged, buildings, units, "storage"),
            "parking": storage_rows(staged, buildings, units, "parking")}


def resolve_file_units(staged: DataFrame, building: DataFrame, unit: DataFrame) -> DataFrame:
    """C-04/C-05: file rows -> unit_id by (building name, floor, door) under the database's collation."""
    b = building.select(X.ci("name").alias("_k"), "building_id")
    u = _unit_keys(unit, "unit_id")
    s = staged.join(b, X.ci(F.col("building_name")) == b["_k"]).drop("_k")
    return s.join(u, _same_unit(s, u)).drop("_ub", "_uf", "_ud")


def storage_rows(staged: DataFrame, building: DataFrame, unit: DataFrame, kind: str = "storage") -> DataFrame:
    """Storage (or parking) rows: flag 'si' and a positive numeric size."""
    flag, size = (("has_storage", "storage_area") if kind == "storage" else ("has_parking", "parking_area"))
    s = staged.filter((F.col(flag) == "si") & (F.col(size) > 0))
    return resolve_file_units(s, building, unit).groupBy("unit_id").agg(F.min(size).alias("size"))


# ---------------------------------------------------------------------------
# J-11 people and accounts files
def people_staged(people_file: DataFrame) -> DataFrame:
    """Trim, truncate names to 30 / e-mail to 40 / phone to 15, blanks -> NULL."""
    return people_file.select(
        F.trim("DNI").alias("dni"),
        X.left(F.trim("Nombre"), 30).alias("first_name"), X.left(F.trim("Apellido"), 30).alias("last_name"),
        X.blank_to_null(X.left(F.trim("Email"), 40)).alias("email"),
        X.blank_to_null(X.left(F.trim("Telefono"), 15)).alias("phone"),
        F.trim("CVU_CBU").alias("account"),
        F.trim("Inquilino").try_cast("int").alias("tenant"))


def dedup_people(staged: DataFrame) -> DataFrame:
    """E-04: one row per DNI. The reference keeps an arbitrary one; here the first by
    (e-mail, phone, first name, last name, account, tenant), NULLs as ''. Implemented
    as a grouped MIN over a struct (partial aggregation, skew-safe)."""
    order = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_o{i}")
             for i, c in enumerate(["email", "phone", "first_name", "last_name", "account", "tenant"])]
    payload = [F.col(c).alias(c) for c in ["first_name", "last_name", "email", "phone", "account", "tenant"]]
    g = staged.groupBy("dni").agg(F.min(F.struct(*order, *payload)).alias("_r"))
    return g.select("dni", *[F.col(f"_r.{c}").alias(c) for c in ["first_name", "last_name", "email", "phone",
                                                                  "account", "tenant"]])


def accounts_staged(accounts_file: DataFrame) -> DataFrame:
    return accounts_file.select(
        F.trim("CVU_CBU").alias("account"), F.trim("NombreConsorcio").alias("building_name"),
        F.trim("NroUF").try_cast("bigint").alias("unit_no"), F.trim("Piso").alias("floor"),
        F.trim("Departamento").alias("door"))


def resolve_accounts(accounts: DataFrame, building: DataFrame, unit: DataFrame) -> DataFrame:
    """account -> unit_id through building name + floor + door (not the file's unit number)."""
    return resolve_file_units(accounts, building, unit).select("account", "unit_id")


def import_people(people: DataFrame, accounts: DataFrame, building: DataFrame, unit: DataFrame,
                  existing: DataFrame | None = None) -> DataFrame:
    """Deduplicated people with their unit, insert-if-absent by DNI."""
    acc = resolve_accounts(accounts, building, unit)
    out = people.join(acc, "account")
    if existing is not None:
        out = out.join(existing.select("dni"), "dni", "left_anti")
    return out.select("dni", "first_name", "last_name", "email", "phone", "account", "unit_id")


def hash_people(imported: DataFrame) -> DataFrame:
    """Hashed variant: e-mail hashed as NVARCHAR (UTF-16LE), account as VARCHAR."""
    return imported.select("dni", "first_name", "last_name", "unit_id",
                           F.when(F.col("email").isNotNull(), X.sha256_hex_utf16("email")).alias("email_hash"),
                           X.sha256_hex("account").alias("account_hash"))


# ---------------------------------------------------------------------------
# J-12 occupancy (set-based)
def import_occupancy(people_file: DataFrame, accounts: DataFrame, building: DataFrame, unit: DataFrame,
                     person: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """(role, unit, DNI) for people lines whose account resolves to a unit and whose
    DNI exists; skip pairs already stored. Repeated lines collapse to one row."""
    p = people_file.select(F.trim("DNI").alias("dni"), F.trim("CVU_CBU").alias("account"),
                           F.trim("Inquilino").try_cast("int").alias("tenant"))
    acc = resolve_accounts(accounts, building, unit)
    j = p.join(acc, "account").join(person.select("dni").distinct(), "dni", "left_semi")
    j = j.select(F.when(F.col("tenant") == 1, F.lit(ROLE_TENANT)).otherwise(F.lit(ROLE_OWNER)).alias("role"),
                 "unit_id", "dni").distinct()
    if existing is not None:
        j = j.join(existing.select("dni", "unit_id"), ["dni", "unit_id"], "left_anti")
    return j


# ---------------------------------------------------------------------------
# J-09 buildings sheet
def import_buildings(sheet: DataFrame, building: DataFrame) -> DataFrame:
    """Sheet rows with status EXISTING (same name and address stored, or inserted by an
    earlier row of the sheet), REJECTED (validation reasons) or INSERTED; fees 2.00/5.00."""
    s = sheet.select(
        F.trim("name").alias("name"), F.trim("address").alias("address"),
        F.trim("unit_count_raw").try_cast("int").alias("unit_count"),
        F.trim("area_raw").try_cast("decimal(10,2)").alias("area"))
    e = building.select(X.ci("name").alias("_en"), X.ci("address").alias("_ea")).distinct() \
        .withColumn("_exists", F.lit(True))
    s = s.join(e, (X.ci(s["name"]) == e["_en"]) & (X.ci(s["address"]) == e["_ea"]), "left").drop("_en", "_ea")
    reasons = _reasons(
        ((F.coalesce(F.col("name"), F.lit("")) == "") | (X.tsql_len("name") > 40), "NAME_LENGTH"),
        ((F.coalesce(F.col("address"), F.lit("")) == "") | (X.tsql_len("address") > 100), "ADDRESS_LENGTH"),
        (F.col("area").isNull() | (F.col("area") <= 0), "INVALID_AREA"),
        (F.col("unit_count").isNull() | (F.col("unit_count") <= 0), "INVALID_UNIT_COUNT"))
    s = s.withColumn("reasons", reasons)
    fits = F.coalesce(F.col("_exists"), F.lit(False)) | (F.col("reasons") != "")
    new = first_of_key(s.filter(~fits), ["name", "address"], ["name", "address", "unit_count", "area"])
    s = s.filter(fits).withColumn("_first", F.lit(True)).unionByName(new)
    status = F.when(F.col("_exists") | ~F.col("_first"), F.lit("EXISTING")) \
        .when(F.col("reasons") != "", F.lit("REJECTED")).otherwise(F.lit("INSERTED"))
    return s.select("name", "address", "unit_count", "area",
                    F.lit(FEE_FIRST).cast("decimal(5,2)").alias("fee_first"),
                    F.lit(FEE_NEXT).cast("decimal(5,2)").alias("fee_next"),
                    status.alias("status"), "reasons")
