"""Deletes as set operations: new_table = table LEFT ANTI keys.

- ``restricted_delete``: a request is refused when any blocking child references the
  key (reported with reasons), unknown keys are reported as NOT_FOUND (a warning, not
  an error), the rest are deleted.
- ``cascade_delete_buildings``: children first, complete set (expense subtype rows,
  expenses, apportionment, payments, charges, storage, parking, occupancy, units),
  and the person -> unit link set to NULL.
- ``keyed_delete``: delete by key, missing keys reported.

Each child is cut with a semi/anti join on a key set derived from the parent keys
(distinct keys, no fan-out), so the work is one shuffle join per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .validate import exists_in


def restricted_delete(requests: DataFrame, table: DataFrame, key: str,
                      blockers: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """requests(key) -> key, status DELETED / REJECTED / NOT_FOUND, reasons."""
    r = requests.select(key).distinct()
    r = exists_in(r, table, [key], [key], "_found")
    rules = []
    for i, (child, child_key, code) in enumerate(blockers):
        r = exists_in(r, child, [key], [child_key], f"_b{i}")
        rules.append((F.col(f"_b{i}"), code))
    reasons = F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(code)) for c, code in rules])), ",")
    r = r.withColumn("reasons", F.when(F.col("_found"), reasons).otherwise(F.lit("")))
    status = F.when(~F.col("_found"), "NOT_FOUND").when(F.col("reasons") != "", "REJECTED").otherwise("DELETED")
    return r.select(key, status.alias("status"), "reasons")


def keyed_delete(requests: DataFrame, table: DataFrame, key: str) -> DataFrame:
    r = exists_in(requests.select(key).distinct(), table, [key], [key], "_found")
    return r.select(key, F.when(F.col("_found"), "DELETED").otherwise("NOT_FOUND").alias("status"))


def remove(table: DataFrame, keys: DataFrame, key: str, table_key: str | None = None) -> DataFrame:
    """table minus the rows whose key is in ``keys``."""
    tk = table_key or key
    k = keys.select(F.col(key).alias(tk)).distinct()
    return table.join(k, tk, "left_anti")


def cascade_delete_buildings(t: dict[str, DataFrame], buildings: DataFrame) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Building cascade. Returns {table: (deleted_rows, remaining_rows)}."""
    b = buildings.select("building_id").distinct()

    def split(df: DataFrame, keys: DataFrame, key: str):
        k = keys.select(key).distinct()
        return df.join(k, key, "left_semi"), df.join(k, key, "left_anti")

    units = t["unit"].join(b, "building_id", "left_semi").select("unit_id")
    charges = t["charge"].join(b, "building_id", "left_semi").select("charge_no")
    expenses = t["expense"].join(b, "building_id", "left_semi").select("expense_id")
    out = {
        "expense_ordinary": split(t["expense_ordinary"], expenses, "expense_id"),
        "expense_extraordinary": split(t["expense_extraordinary"], expenses, "expense_id"),
        "expense": split(t["expense"], b, "building_id"),
        "apportionment": split(t["apportionment"], charges, "charge_no"),
        "payment": split(t["payment"], units, "unit_id"),
        "charge": split(t["charge"], b, "building_id"),
        "storage": split(t["storage"], units, "unit_id"),
        "parking": split(t["parking"], units, "unit_id"),
        "occupancy": split(t["occupancy"], units, "unit_id"),
        "unit": split(t["unit"], b, "building_id"),
        "building": split(t["building"], b, "building_id"),
    }
    # person -> unit link nulled (the person row stays)
    p = t["person"]
    hit = exists_in(p, units, ["unit_id"], ["unit_id"], "_hit")
    nulled = hit.filter(F.col("_hit")).drop("_hit")
    kept = hit.withColumn("unit_id", F.when(F.col("_hit"), F.lit(None).cast("bigint")).otherwise(F.col("unit_id"))) \
        .drop("_hit")
    out["person_unit_link"] = (nulled, kept)
    return out


def change_summary(changes: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(table, changed_rows, remaining_rows): one small aggregate per table, unioned."""
    parts = []
    for name, (changed, remaining) in changes.items():
        c = changed.select(F.lit(1).alias("_c"), F.lit(0).alias("_r"))
        r = remaining.select(F.lit(0).alias("_c"), F.lit(1).alias("_r"))
        parts.append(c.unionByName(r).agg(F.lit(name).alias("table_name"),
                                          F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("changed_rows"),
                                          F.coalesce(F.sum("_r"), F.lit(0)).cast("bigint").alias("remaining_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
