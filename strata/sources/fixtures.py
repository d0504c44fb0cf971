"""Raw input files as the reference receives them, derived from the star schema.

Each function returns the *text content* of one input file as a DataFrame of strings
(what a reader would produce), so the import operators can run on it directly and
the file readers can be checked by writing it out and reading it back.

Derivation rules (same in the DuckDB oracle):
- units file (tab): one line per customer; building name blank when key%53=0 and
  '<nation> ANEXO' (a building that does not exist yet) when key%47=0; coefficient
  with decimal comma, unparseable 'abc' when key%41=0; storage/parking flags 'SI'/'NO'
- people file (semicolon): one line per person, plus a repeated line (same DNI,
  padded name, upper-case e-mail) for primary persons with key%9=0
- accounts file (pipe): account, building name, unit number, floor, door per person
- buildings sheet: one row per building, plus one candidate row per region
  ('Torre <region>'); even region keys carry an invalid area of 0
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import ROLE_TENANT
from . import adapter as A
from .tables import scan


def units_file(spark: SparkSession, sf: str) -> DataFrame:
    u = A.units(spark, sf)
    n = scan(spark, sf, "nation", "n_nationkey", "n_name")
    j = u.join(n, u["building_id"] == n["n_nationkey"])
    k = F.col("unit_id")
    name = F.when(k % 53 == 0, F.lit("  ")).when(k % 47 == 0, F.concat(F.col("n_name"), F.lit(" ANEXO"))) \
        .otherwise(F.col("n_name"))
    coef = F.when(k % 41 == 0, F.lit("abc")).otherwise(F.translate(F.col("coef").cast("string"), ".", ","))
    st, pk = (k % 4 == 0), (k % 6 == 0)
    return j.select(
        name.alias("building_name"), k.cast("string").alias("unit_no"), "floor", "door",
        coef.alias("coef"), F.col("area").cast("string").alias("area"),
        F.when(st, "SI").otherwise("NO").alias("has_storage"), F.when(pk, "SI").otherwise("NO").alias("has_parking"),
        F.when(st, (F.lit(2) + k % 5).cast("decimal(10,2)").cast("string")).otherwise(F.lit("0")).alias("storage_area"),
        F.when(pk, (F.lit(10) + k % 3).cast("decimal(10,2)").cast("string")).otherwise(F.lit("0")).alias("parking_area"),
    )


def people_file(spark: SparkSession, sf: str) -> DataFrame:
    p = A.persons(spark, sf)
    o = A.occupancies(spark, sf).select("dni", "role")
    j = p.join(o, "dni")
    base = j.select(
        F.col("first_name").alias("Nombre"), F.col("last_name").alias("Apellido"), F.col("dni").alias("DNI"),
        F.coalesce("email", F.lit("")).alias("Email"), F.coalesce("phone", F.lit("")).alias("Telefono"),
        F.col("account").alias("CVU_CBU"),
        F.when(F.col("role") == ROLE_TENANT, "1").otherwise("0").alias("Inquilino"))
    dup = base.filter((F.substring("DNI", 1, 1) != "9") & (F.col("DNI").cast("bigint") % 9 == 0)).select(
        F.concat(F.col("Nombre"), F.lit("  ")).alias("Nombre"), "Apellido", "DNI", F.upper("Email").alias("Email"),
        "Telefono", "CVU_CBU", "Inquilino")
    return base.unionByName(dup)


def accounts_file(spark: SparkSession, sf: str) -> DataFrame:
    p = A.persons(spark, sf).select("account", "unit_id")
    u = A.units(spark, sf)
    n = scan(spark, sf, "nation", "n_nationkey", "n_name")
    j = p.join(u, "unit_id").join(n, u["building_id"] == n["n_nationkey"])
    return j.select(F.col("account").alias("CVU_CBU"), F.col("n_name").alias("NombreConsorcio"),
                    F.col("unit_id").cast("string").alias("NroUF"), F.col("floor").alias("Piso"),
                    F.col("door").alias("Departamento"))


def buildings_sheet(spark: SparkSession, sf: str) -> DataFrame:
    b = A.buildings(spark, sf)
    rows = b.select(
        F.concat(F.lit("Consorcio "), F.col("building_id").cast("string")).alias("Consorcio"),
        F.col("name").alias("Nombre del consorcio"), F.col("address").alias("Domicilio"),
        F.col("unit_count").cast("string").alias("Cant unidades funcionales"),
        F.col("area").cast("string").alias("m2 totales"))
    r = scan(spark, sf, "region", "r_regionkey", "r_name")
    cand = r.select(
        F.concat(F.lit("Region "), F.col("r_regionkey").cast("string")).alias("Consorcio"),
        F.concat(F.lit("Torre "), F.col("r_name")).alias("Nombre del consorcio"),
        F.concat(F.lit("Avenida "), F.col("r_name")).alias("Domicilio"),
        F.lit("5").alias("Cant unidades funcionales"),
        F.when(F.col("r_regionkey") % 2 == 0, F.lit("0")).otherwise(F.lit("1000.00")).alias("m2 totales"))
    return rows.unionByName(cand)


def payments_file(spark: SparkSession, sf: str) -> DataFrame:
    return A.bank_file(spark, sf)


def expenses_objects(spark: SparkSession, sf: str) -> DataFrame:
    return A.expense_sheet(spark, sf)


def providers_sheet(spark: SparkSession, sf: str) -> DataFrame:
    return A.providers_sheet(spark, sf)


__all__ = ["units_file", "people_file", "accounts_file", "buildings_sheet", "payments_file",
           "expenses_objects", "providers_sheet"]
