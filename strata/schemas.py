"""Declared schemas (never inferred).

``RAW`` describes the star-schema parquet inputs, ``LEDGER`` the ledger tables the
operators produce (types follow the reference's column types; ids are bigint, and
building-level aggregates are widened so they cannot overflow at scale).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, DT, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.DateType(), T.BooleanType()
TS = T.TimestampNTZType()


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW = {
    "region": struct(("r_regionkey", I), ("r_name", S)),
    "nation": struct(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": struct(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D), ("c_mktsegment", S)),
    "supplier": struct(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "orders": struct(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
                     ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": struct(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                       ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                       ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS)),
    "events": struct(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S), ("value", D), ("props", S)),
}

LEDGER = {
    "building": struct(("building_id", L), ("name", S), ("address", S), ("unit_count", L),
                       ("area", dec(18, 2)), ("fee_first", dec(5, 2)), ("fee_next", dec(5, 2))),
    "unit": struct(("unit_id", L), ("building_id", L), ("floor", S), ("door", S),
                   ("area", dec(6, 2)), ("coef", dec(5, 2))),
    "person": struct(("dni", S), ("first_name", S), ("last_name", S), ("email", S), ("phone", S),
                     ("account", S), ("unit_id", L)),
    "occupancy": struct(("occupancy_id", L), ("role", S), ("unit_id", L), ("dni", S)),
    "storage": struct(("storage_id", L), ("size", dec(10, 2)), ("unit_id", L)),
    "parking": struct(("parking_id", L), ("size", dec(10, 2)), ("unit_id", L)),
    "charge": struct(("charge_no", L), ("building_id", L), ("gen_date", DT), ("due1", DT), ("due2", DT),
                     ("total", dec(10, 2))),
    "apportionment": struct(("charge_no", L), ("unit_id", L), ("pct", dec(10, 2)), ("prior_balance", dec(12, 2)),
                            ("received", dec(12, 2)), ("interest", dec(12, 2)), ("ordinary", dec(12, 2)),
                            ("extraordinary", dec(12, 2)), ("total", dec(12, 2)), ("debt", dec(12, 2))),
    "payment": struct(("payment_id", L), ("pay_date", DT), ("amount", dec(12, 2)), ("account", S),
                      ("unit_id", L), ("charge_no", L)),
    "expense": struct(("expense_id", L), ("charge_no", L), ("building_id", L), ("kind", S), ("description", S),
                      ("issue_date", DT), ("amount", dec(10, 2))),
    "expense_ordinary": struct(("expense_id", L), ("provider", S), ("category", S), ("invoice_no", S)),
    "expense_extraordinary": struct(("expense_id", L), ("instalment", T.ShortType()), ("instalments", T.ShortType())),
    "import_log": struct(("logged_at", T.TimestampType()), ("proc", S), ("level", S), ("message", S), ("path", S)),
}

# Text staging schemas of the raw files (all strings; converted with try_* later).
FILES = {
    "units_tsv": struct(("building_name", S), ("unit_no", S), ("floor", S), ("door", S), ("coef", S),
                        ("area", S), ("has_storage", S), ("has_parking", S), ("storage_area", S), ("parking_area", S)),
    "people_csv": struct(("Nombre", S), ("Apellido", S), ("DNI", S), ("Email", S), ("Telefono", S),
                         ("CVU_CBU", S), ("Inquilino", S)),
    "accounts_csv": struct(("CVU_CBU", S), ("NombreConsorcio", S), ("NroUF", S), ("Piso", S), ("Departamento", S)),
    "payments_csv": struct(("id", S), ("fecha", S), ("CVU_CBU", S), ("valor", S)),
    "buildings_sheet": struct(("Consorcio", S), ("Nombre del consorcio", S), ("Domicilio", S),
                              ("Cant unidades funcionales", S), ("m2 totales", S)),
    "providers_sheet": struct(("_c0", S), ("_c1", S), ("_c2", S), ("_c3", S)),
}

from .fixed import EXPENSE_JSON_KEYS  # noqa: E402
EXPENSES_JSON = struct(("Nombre del consorcio", S), ("Mes", S), *[(k, S) for k in EXPENSE_JSON_KEYS])
