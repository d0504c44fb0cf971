"""Change batches for the validators, derived from the ledger tables.

Each batch is a whole ledger table in which a deterministic share of rows breaks a
rule (so every rule has rows to fire on), plus, for keyed tables, repeated keys.
No row is dropped. Rules (mirrored in the DuckDB oracle):

- buildings: id%7=2 blank name, id%5=1 area 0, id%11=3 first fee -1; rows with
  id%6=0 repeated (id+1000, same name/address)
- units: key%13=0 coefficient 0, key%17=0 unknown building (+1000), key%19=0 blank floor
- people (first person of a unit): key%11=0 e-mail without '@', key%13=0 accented
  name, key%29=0 20-digit account, key%31=0 phone with '-', key%37=0 unknown unit;
  key%43=0 repeated with another account
- occupancy: key%17=0 role 'Dueño', key%19=0 unknown DNI
- storage: key%8=0 size 0, key%20=0 unknown unit; parking: key%12=0 size 0,
  key%30=0 unknown unit
- charges: no%17=0 first due date = generation date, no%19=0 second = first
- apportionment: (unit + charge no)%97=0 pct 0; (unit + 3 charge no)%89=0 exact repeats
- expenses: id%23=0 kind 'Otro'
- ordinary subtype: every ordinary row plus the extraordinary expenses
- extraordinary subtype: id%7=0 instalment 3 of 2, plus the ordinary expenses
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN_SHIFT = 1_000_000_000


def _w(cond, value, col):
    return F.when(cond, value).otherwise(F.col(col))


def buildings(b: DataFrame) -> DataFrame:
    i = F.col("building_id")
    x = b.select(
        "building_id", _w(i % 7 == 2, F.lit(""), "name").alias("name"), "address", "unit_count",
        _w(i % 5 == 1, F.lit(Decimal("0.00")).cast("decimal(18,2)"), "area").alias("area"),
        _w(i % 11 == 3, F.lit(Decimal("-1.00")).cast("decimal(5,2)"), "fee_first").alias("fee_first"), "fee_next")
    dup = x.filter(i % 6 == 0).withColumn("building_id", i + 1000)
    return x.unionByName(dup)


def units(u: DataFrame) -> DataFrame:
    k = F.col("unit_id")
    return u.select(
        "unit_id", _w(k % 17 == 0, F.col("building_id") + 1000, "building_id").alias("building_id"),
        _w(k % 19 == 0, F.lit(""), "floor").alias("floor"), "door", "area",
        _w(k % 13 == 0, F.lit(Decimal("0.00")).cast("decimal(5,2)"), "coef").alias("coef"))


def people(p: DataFrame) -> DataFrame:
    k = F.col("unit_id")
    first = F.substring("dni", 1, 1) != "9"
    x = p.select(
        "dni",
        _w(first & (k % 13 == 0), F.lit("José"), "first_name").alias("first_name"), "last_name",
        _w(first & (k % 11 == 0), F.lit("sin-arroba.com"), "email").alias("email"),
        _w(first & (k % 31 == 0), F.lit("11-1234"), "phone").alias("phone"),
        _w(first & (k % 29 == 0), F.substring("account", 1, 20), "account").alias("account"),
        _w(first & (k % 37 == 0), k + UNKNOWN_SHIFT, "unit_id").alias("unit_id"))
    dup = p.filter(first & (k % 43 == 0)).select(
        "dni", "first_name", "last_name", "email", "phone",
        F.concat(F.lit("2"), F.substring("account", 2, 21)).alias("account"), "unit_id")
    return x.unionByName(dup)


def occupancy(o: DataFrame) -> DataFrame:
    k = F.col("unit_id")
    return o.select("occupancy_id", _w(k % 17 == 0, F.lit("Dueño"), "role").alias("role"), "unit_id",
                    _w(k % 19 == 0, F.concat(F.col("dni"), F.lit("X")), "dni").alias("dni"))


def sized(df: DataFrame, id_col: str, zero_mod: int, unknown_mod: int) -> DataFrame:
    k = F.col("unit_id")
    return df.select(id_col, _w(k % zero_mod == 0, F.lit(Decimal("0.00")).cast("decimal(10,2)"), "size").alias("size"),
                     _w(k % unknown_mod == 0, k + UNKNOWN_SHIFT, "unit_id").alias("unit_id"))


def charges(c: DataFrame) -> DataFrame:
    n = F.col("charge_no")
    x = c.withColumn("due1", _w(n % 17 == 0, F.col("gen_date"), "due1"))
    return x.withColumn("due2", _w(n % 19 == 0, F.col("due1"), "due2"))


def apportionments(a: DataFrame) -> DataFrame:
    again = a.filter((F.col("unit_id") + 3 * F.col("charge_no")) % 89 == 0)
    bad = (F.col("unit_id") + F.col("charge_no")) % 97 == 0
    return a.unionByName(again).withColumn("pct", _w(bad, F.lit(Decimal("0.00")).cast("decimal(10,2)"), "pct"))


def expenses(e: DataFrame) -> DataFrame:
    return e.withColumn("kind", _w(F.col("expense_id") % 23 == 0, F.lit("Otro"), "kind"))


def ordinary(eo: DataFrame, expense: DataFrame) -> DataFrame:
    extra = expense.filter(F.col("kind") == "Extraordinario").select(
        "expense_id", F.lit("N/A").alias("provider"), F.lit("GASTOS GENERALES").alias("category"),
        F.concat(F.lit("FAC-"), F.col("expense_id").cast("string")).alias("invoice_no"))
    return eo.unionByName(extra)


def extraordinary(ee: DataFrame, expense: DataFrame) -> DataFrame:
    i = F.col("expense_id")
    x = ee.select("expense_id", _w(i % 7 == 0, F.lit(3).cast("smallint"), "instalment").alias("instalment"),
                  _w(i % 7 == 0, F.lit(2).cast("smallint"), "instalments").alias("instalments"))
    o = expense.filter(F.col("kind") == "Ordinario").select(
        "expense_id", F.lit(1).cast("smallint").alias("instalment"), F.lit(1).cast("smallint").alias("instalments"))
    return x.unionByName(o)
