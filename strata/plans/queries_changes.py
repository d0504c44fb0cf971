"""Registered delete queries (J-21: I-06 .. I-09) and the IN-subquery semi join (C-08)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import changes as CH
from ..sources.tables import scan
from .catalog import query
from .oracle import with_ctes


@query("q_delete_restricted", with_ctes("""
SELECT 'unit' AS table_name, CAST(unit_id AS VARCHAR) AS key,
       CASE WHEN r <> '' THEN 'REJECTED' ELSE 'DELETED' END AS status, r AS reasons
FROM (SELECT unit_id, concat_ws(',',
        CASE WHEN unit_id IN (SELECT unit_id FROM apportionment) THEN 'HAS_APPORTIONMENT' END,
        CASE WHEN unit_id IN (SELECT unit_id FROM payment) THEN 'HAS_PAYMENT' END) AS r FROM unit) u
UNION ALL
SELECT 'person', dni, CASE WHEN r <> '' THEN 'REJECTED' ELSE 'DELETED' END, r
FROM (SELECT DISTINCT dni, concat_ws(',', CASE WHEN dni IN (SELECT dni FROM occupancy) THEN 'HAS_OCCUPANCY' END) AS r
      FROM person) p"""))
def q_delete_restricted(L):
    """I-06: delete requests for every unit and every person; refused while
    apportionment/payments (unit) or occupancy (person) reference the key."""
    u = CH.restricted_delete(L.unit.select("unit_id"), L.unit, "unit_id",
                             [(L.apportionment, "unit_id", "HAS_APPORTIONMENT"), (L.payment, "unit_id", "HAS_PAYMENT")])
    p = CH.restricted_delete(L.person.select("dni"), L.person, "dni", [(L.occupancy, "dni", "HAS_OCCUPANCY")])
    return u.select(F.lit("unit").alias("table_name"), F.col("unit_id").cast("string").alias("key"), "status", "reasons") \
        .unionByName(p.select(F.lit("person").alias("table_name"), F.col("dni").alias("key"), "status", "reasons"))


_CASCADE_TABLES = [
    ("expense_ordinary", "expense_id", "del_e"), ("expense_extraordinary", "expense_id", "del_e"),
    ("expense", "building_id", "del_b"), ("apportionment", "charge_no", "del_c"), ("payment", "unit_id", "del_u"),
    ("charge", "building_id", "del_b"), ("storage", "unit_id", "del_u"), ("parking", "unit_id", "del_u"),
    ("occupancy", "unit_id", "del_u"), ("unit", "building_id", "del_b"), ("building", "building_id", "del_b"),
]
DELETE_REGION = 0  # request: delete every building of this region


def _cascade_sql() -> str:
    parts = [f"""SELECT '{t}' AS table_name,
       CAST(count(*) FILTER (WHERE {k} IN (SELECT {k} FROM {d})) AS BIGINT) AS changed_rows,
       CAST(count(*) FILTER (WHERE {k} NOT IN (SELECT {k} FROM {d})) AS BIGINT) AS remaining_rows FROM {t}"""
             for t, k, d in _CASCADE_TABLES]
    parts.append("""SELECT 'person_unit_link',
       CAST(count(*) FILTER (WHERE unit_id IN (SELECT unit_id FROM del_u)) AS BIGINT),
       CAST(count(*) AS BIGINT) FROM person""")
    return with_ctes(f"""WITH del_b AS (SELECT CAST(n_nationkey AS BIGINT) AS building_id FROM nation
                    WHERE n_regionkey = {DELETE_REGION}),
del_u AS (SELECT unit_id FROM unit WHERE building_id IN (SELECT building_id FROM del_b)),
del_c AS (SELECT charge_no FROM charge WHERE building_id IN (SELECT building_id FROM del_b)),
del_e AS (SELECT expense_id FROM expense WHERE building_id IN (SELECT building_id FROM del_b))
""" + "\nUNION ALL\n".join(parts))


@query("q_delete_cascade", _cascade_sql())
def q_delete_cascade(L):
    """I-07/I-08: delete every building of one region with all dependent rows
    (children first, expense subtypes included) and NULL the person -> unit link;
    returns changed/remaining rows per table."""
    req = scan(L.spark, L.sf, "nation", "n_nationkey", "n_regionkey") \
        .filter(F.col("n_regionkey") == DELETE_REGION).select(F.col("n_nationkey").cast("bigint").alias("building_id"))
    tables = {n: getattr(L, n) for n in ["unit", "charge", "expense", "expense_ordinary", "expense_extraordinary",
                                         "apportionment", "payment", "storage", "parking", "occupancy", "building",
                                         "person"]}
    return CH.change_summary(CH.cascade_delete_buildings(tables, req))


@query("q_delete_keys", with_ctes("""
SELECT source_id AS payment_id,
       CASE WHEN source_id IN (SELECT payment_id FROM payment) THEN 'DELETED' ELSE 'NOT_FOUND' END AS status
FROM (SELECT DISTINCT source_id FROM bank) b"""))
def q_delete_keys(L):
    """I-09: delete payments by id for every id of the bank file; ids that were never
    stored (rejected lines) are reported NOT_FOUND instead of failing."""
    req = L.bank_staged.select(F.col("source_id").alias("payment_id"))
    return CH.keyed_delete(req, L.payment, "payment_id")


@query("q_units_with_charges", with_ctes("""
SELECT * FROM unit WHERE unit_id IN (SELECT unit_id FROM apportionment)"""))
def q_units_with_charges(L):
    """C-08: units that appear in the apportionment (IN subquery as a left semi join)."""
    return L.unit.join(L.apportionment.select("unit_id"), "unit_id", "left_semi")
