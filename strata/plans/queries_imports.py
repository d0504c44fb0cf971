"""Registered import queries (J-09 .. J-12), surrogate keys (E-06) and file readers
(A-01 .. A-07, round trip through files in the shared scratch folder)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed import EXPENSE_JSON_KEYS
from ..operators import imports as IM
from ..operators.keys import surrogate_keys
from ..session import shared_dir
from ..sources import files as FL
from ..sources import fixtures as FX
from .catalog import query
from .oracle import CATS, es_ar, month_name, with_ctes

# ---------------------------------------------------------------------------
# Oracle text of the raw files (same derivation as ``strata.sources.fixtures``)
UNITS_FILE = """
SELECT CASE WHEN u.unit_id % 53 = 0 THEN '  ' WHEN u.unit_id % 47 = 0 THEN n.n_name || ' ANEXO' ELSE n.n_name END
         AS building_name,
       CAST(u.unit_id AS VARCHAR) AS unit_no, u.floor, u.door,
       CASE WHEN u.unit_id % 41 = 0 THEN 'abc' ELSE replace(CAST(u.coef AS VARCHAR), '.', ',') END AS coef,
       CAST(u.area AS VARCHAR) AS area,
       CASE WHEN u.unit_id % 4 = 0 THEN 'SI' ELSE 'NO' END AS has_storage,
       CASE WHEN u.unit_id % 6 = 0 THEN 'SI' ELSE 'NO' END AS has_parking,
       CASE WHEN u.unit_id % 4 = 0 THEN CAST(CAST(2 + u.unit_id % 5 AS DECIMAL(10,2)) AS VARCHAR) ELSE '0' END
         AS storage_area,
       CASE WHEN u.unit_id % 6 = 0 THEN CAST(CAST(10 + u.unit_id % 3 AS DECIMAL(10,2)) AS VARCHAR) ELSE '0' END
         AS parking_area
FROM unit u JOIN nation n ON n.n_nationkey = u.building_id"""

PEOPLE_FILE = """
SELECT p.first_name AS "Nombre", p.last_name AS "Apellido", p.dni AS "DNI", coalesce(p.email, '') AS "Email",
       coalesce(p.phone, '') AS "Telefono", p.account AS "CVU_CBU",
       CASE WHEN o.role = 'Inquilino' THEN '1' ELSE '0' END AS "Inquilino"
FROM person p JOIN occupancy o ON o.dni = p.dni
UNION ALL
SELECT p.first_name || '  ', p.last_name, p.dni, upper(coalesce(p.email, '')), coalesce(p.phone, ''), p.account,
       CASE WHEN o.role = 'Inquilino' THEN '1' ELSE '0' END
FROM person p JOIN occupancy o ON o.dni = p.dni
WHERE substring(p.dni, 1, 1) <> '9' AND CAST(p.dni AS BIGINT) % 9 = 0"""

ACCOUNTS_FILE = """
SELECT p.account AS "CVU_CBU", n.n_name AS "NombreConsorcio", CAST(u.unit_id AS VARCHAR) AS "NroUF",
       u.floor AS "Piso", u.door AS "Departamento"
FROM person p JOIN unit u ON u.unit_id = p.unit_id JOIN nation n ON n.n_nationkey = u.building_id"""

BUILDINGS_SHEET = """
SELECT 'Consorcio ' || CAST(building_id AS VARCHAR) AS "Consorcio", name AS "Nombre del consorcio",
       address AS "Domicilio", CAST(unit_count AS VARCHAR) AS "Cant unidades funcionales",
       CAST(area AS VARCHAR) AS "m2 totales"
FROM building
UNION ALL
SELECT 'Region ' || CAST(r_regionkey AS VARCHAR), 'Torre ' || r_name, 'Avenida ' || r_name, '5',
       CASE WHEN r_regionkey % 2 = 0 THEN '0' ELSE '1000.00' END
FROM region"""

STAGED_UNITS = """
SELECT trim(building_name) AS building_name, trim(floor) AS floor, trim(door) AS door,
       TRY_CAST(trim(area) AS DECIMAL(6,2)) AS area, TRY_CAST(replace(trim(coef), ',', '.') AS DECIMAL(5,2)) AS coef,
       lower(trim(has_storage)) AS has_storage, lower(trim(has_parking)) AS has_parking,
       TRY_CAST(trim(storage_area) AS DECIMAL(10,2)) AS storage_area,
       TRY_CAST(trim(parking_area) AS DECIMAL(10,2)) AS parking_area
FROM units_file WHERE trim(coalesce(building_name, '')) <> ''"""

STAGED_PEOPLE = """
SELECT trim("DNI") AS dni, substring(trim("Nombre"), 1, 30) AS first_name, substring(trim("Apellido"), 1, 30) AS last_name,
       nullif(trim(substring(trim("Email"), 1, 40)), '') AS email,
       nullif(trim(substring(trim("Telefono"), 1, 15)), '') AS phone,
       trim("CVU_CBU") AS account, TRY_CAST(trim("Inquilino") AS INTEGER) AS tenant
FROM people_file"""

DEDUP_PEOPLE = f"""
SELECT dni, first_name, last_name, email, phone, account, tenant FROM (
  SELECT *, row_number() OVER (PARTITION BY dni ORDER BY coalesce(email, ''), coalesce(phone, ''),
                               coalesce(first_name, ''), coalesce(last_name, ''), coalesce(account, ''),
                               coalesce(CAST(tenant AS VARCHAR), '')) AS rn
  FROM ({STAGED_PEOPLE}) s) x WHERE rn = 1"""

ACCOUNT_UNIT = """
SELECT a.account, u.unit_id
FROM (SELECT trim("CVU_CBU") AS account, trim("NombreConsorcio") AS building_name, trim("Piso") AS floor,
             trim("Departamento") AS door FROM accounts_file) a
JOIN building b ON upper(trim(b.name)) = upper(a.building_name)
JOIN unit u ON u.building_id = b.building_id AND u.floor = a.floor AND u.door = a.door"""


def files_sql(select: str) -> str:
    return with_ctes(f"""WITH units_file AS ({UNITS_FILE}), people_file AS ({PEOPLE_FILE}),
accounts_file AS ({ACCOUNTS_FILE}), buildings_sheet AS ({BUILDINGS_SHEET}){select if select.startswith(chr(10) + ",") else chr(10) + select}""")


# ---------------------------------------------------------------------------
# J-10 units
def _staged_units(L):
    return IM.units_staged(FX.units_file(L.spark, L.sf))


@query("q_clean_units", files_sql(f"""
SELECT s.building_name, b.building_id, s.floor, s.door, s.area, s.coef,
       CASE WHEN uu.unit_id IS NOT NULL THEN 'EXISTING' WHEN s.r <> '' THEN 'REJECTED' ELSE 'ACCEPTED' END AS status,
       s.r AS reasons
FROM (SELECT *, concat_ws(',', CASE WHEN area IS NULL OR area <= 0 THEN 'INVALID_AREA' END,
                               CASE WHEN coef IS NULL OR coef <= 0 OR coef > 100 THEN 'INVALID_COEF' END,
                               CASE WHEN length(floor) > 10 THEN 'FLOOR_LENGTH' END,
                               CASE WHEN length(door) > 10 THEN 'DOOR_LENGTH' END) AS r
      FROM ({STAGED_UNITS}) s0
      WHERE trim(coalesce(floor, '')) <> '' AND trim(coalesce(door, '')) <> '') s
LEFT JOIN building b ON upper(trim(b.name)) = upper(trim(s.building_name))
LEFT JOIN unit uu ON uu.building_id = b.building_id AND uu.floor = s.floor AND uu.door = s.door"""))
def q_clean_units(L):
    """B-06/J-10: units file cleaned (blank rows dropped), parsed, resolved, each row
    EXISTING / ACCEPTED / REJECTED with reasons."""
    return IM.clean_units(_staged_units(L), L.building, L.unit)


@query("q_new_buildings", files_sql(f"""
SELECT name, 'Dirección ' || name AS address, CAST(1000.00 AS DECIMAL(10,2)) AS area,
       CAST(2.00 AS DECIMAL(5,2)) AS fee_first, CAST(5.00 AS DECIMAL(5,2)) AS fee_next
FROM (SELECT DISTINCT building_name AS name FROM ({STAGED_UNITS}) s) n
WHERE upper(trim(name)) NOT IN (SELECT upper(trim(name)) FROM building)"""))
def q_new_buildings(L):
    """I-04: placeholder buildings for unknown names in the units file."""
    return IM.new_buildings(_staged_units(L), L.building)


def _storage_sql(flag: str, size: str) -> str:
    return files_sql(f"""
SELECT u.unit_id, s.{size} AS size
FROM ({STAGED_UNITS}) s
JOIN building b ON upper(trim(b.name)) = upper(trim(s.building_name))
JOIN unit u ON u.building_id = b.building_id AND u.floor = s.floor AND u.door = s.door
WHERE s.{flag} = 'si' AND s.{size} > 0""")


@query("q_storage", _storage_sql("has_storage", "storage_area"))
def q_storage(L):
    """J-10: storage rooms of the units file (flag 'si' and positive size)."""
    return IM.storage_rows(_staged_units(L), L.building, L.unit, "storage")


@query("q_parking", _storage_sql("has_parking", "parking_area"))
def q_parking(L):
    """J-10: parking spaces of the units file (flag 'si' and positive size)."""
    return IM.storage_rows(_staged_units(L), L.building, L.unit, "parking")


# ---------------------------------------------------------------------------
# Keys under the database's collation: every row comes a second time in small letters
def _both_cases(df, *cols):
    return df.unionByName(df.withColumns({c: F.lower(c) for c in cols}))


def _both_cases_sql(select: str, cols: str) -> str:
    low = ", ".join(f"lower({c}) AS {c}" for c in cols.split(", "))
    return f"SELECT * FROM ({select}) c1 UNION ALL BY NAME SELECT * EXCLUDE ({cols}), {low} FROM ({select}) c2"


_UNIT_RULES = """concat_ws(',', CASE WHEN area IS NULL OR area <= 0 THEN 'INVALID_AREA' END,
                               CASE WHEN coef IS NULL OR coef <= 0 OR coef > 100 THEN 'INVALID_COEF' END,
                               CASE WHEN length(floor) > 10 THEN 'FLOOR_LENGTH' END,
                               CASE WHEN length(door) > 10 THEN 'DOOR_LENGTH' END)"""


@query("q_clean_units_any_case", files_sql(f"""
, cased AS ({_both_cases_sql(STAGED_UNITS, "building_name, door")}),
found AS (
  SELECT s.*, b.building_id, uu.unit_id, {_UNIT_RULES} AS r
  FROM cased s LEFT JOIN (SELECT building_id, name FROM building) b ON lower(trim(b.name)) = lower(trim(s.building_name))
  LEFT JOIN (SELECT unit_id, building_id AS ub, floor AS uf, door AS ud FROM unit WHERE unit_id % 3 = 0) uu
    ON uu.ub = b.building_id AND lower(uu.uf) = lower(s.floor) AND lower(uu.ud) = lower(s.door)
  WHERE trim(coalesce(s.floor, '')) <> '' AND trim(coalesce(s.door, '')) <> '')
SELECT building_name, building_id, floor, door, area, coef,
       CASE WHEN unit_id IS NOT NULL THEN 'EXISTING' WHEN r <> '' THEN 'REJECTED'
            WHEN row_number() OVER (PARTITION BY lower(building_name), lower(floor), lower(door),
                                    unit_id IS NULL AND r = '' ORDER BY floor, door, area, coef, building_name) > 1
            THEN 'EXISTING' ELSE 'ACCEPTED' END AS status, r AS reasons
FROM found"""))
def q_clean_units_any_case(L):
    """C-04/J-10: units file in two spellings against every third unit stored: a key in
    other capitals is the same unit, stored or earlier in the file."""
    staged = _both_cases(_staged_units(L), "building_name", "door")
    return IM.clean_units(staged, L.building, L.unit.filter("unit_id % 3 = 0"))


@query("q_resolve_units_any_case", files_sql(f"""
, cased AS ({_both_cases_sql(STAGED_UNITS, "building_name, door")})
SELECT s.building_name, s.floor, s.door, u.unit_id
FROM cased s JOIN building b ON lower(trim(b.name)) = lower(trim(s.building_name))
JOIN unit u ON u.building_id = b.building_id AND lower(u.floor) = lower(s.floor) AND lower(u.door) = lower(s.door)"""))
def q_resolve_units_any_case(L):
    """C-04/C-05: file rows in two spellings resolved to the stored unit."""
    staged = _both_cases(_staged_units(L), "building_name", "door")
    return IM.resolve_file_units(staged, L.building, L.unit).select("building_name", "floor", "door", "unit_id")


@query("q_new_buildings_any_case", files_sql(f"""
, cased AS ({_both_cases_sql(STAGED_UNITS, "building_name")})
SELECT min(building_name) AS name, 'Dirección ' || min(building_name) AS address, CAST(1000.00 AS DECIMAL(10,2)) AS area,
       CAST(2.00 AS DECIMAL(5,2)) AS fee_first, CAST(5.00 AS DECIMAL(5,2)) AS fee_next
FROM cased WHERE lower(trim(building_name)) NOT IN (SELECT lower(trim(name)) FROM building)
GROUP BY lower(trim(building_name))"""))
def q_new_buildings_any_case(L):
    """I-04: of names that differ in case only one placeholder building is made."""
    return IM.new_buildings(_both_cases(_staged_units(L), "building_name"), L.building)


# ---------------------------------------------------------------------------
# J-11 / J-12 people, accounts, occupancy
def _accounts(L):
    return IM.accounts_staged(FX.accounts_file(L.spark, L.sf))


def _dedup(L):
    return IM.dedup_people(IM.people_staged(FX.people_file(L.spark, L.sf)))


@query("q_resolve_units", files_sql(ACCOUNT_UNIT))
def q_resolve_units(L):
    """C-04/C-05: account -> unit by building name + floor + door on trimmed text."""
    return IM.resolve_accounts(_accounts(L), L.building, L.unit)


@query("q_dedup_people", files_sql(DEDUP_PEOPLE))
def q_dedup_people(L):
    """E-04: one row per DNI (deterministic choice among repeated lines)."""
    return _dedup(L)


@query("q_people_hashed", files_sql(f"""
SELECT d.dni, d.first_name, d.last_name, au.unit_id,
       CASE WHEN d.email IS NOT NULL THEN
         sha256(from_hex(regexp_replace(hex(d.email), '(..)', '\\100', 'g'))) END AS email_hash,
       sha256(d.account) AS account_hash
FROM ({DEDUP_PEOPLE}) d JOIN ({ACCOUNT_UNIT}) au ON au.account = d.account"""))
def q_people_hashed(L):
    """J-11 (hashed variant): imported people with SHA-256 of e-mail (as UTF-16LE
    text) and account (as single-byte text)."""
    return IM.hash_people(IM.import_people(_dedup(L), _accounts(L), L.building, L.unit))


@query("q_occupancy", files_sql(f"""
SELECT DISTINCT CASE WHEN TRY_CAST(trim(p."Inquilino") AS INTEGER) = 1 THEN 'Inquilino' ELSE 'Propietario' END AS role,
       au.unit_id, trim(p."DNI") AS dni
FROM people_file p JOIN ({ACCOUNT_UNIT}) au ON au.account = trim(p."CVU_CBU")
WHERE trim(p."DNI") IN (SELECT dni FROM person)"""))
def q_occupancy(L):
    """J-12 (set-based): occupancy rows from the people and accounts files."""
    return IM.import_occupancy(FX.people_file(L.spark, L.sf), _accounts(L), L.building, L.unit, L.person)


# ---------------------------------------------------------------------------
# J-09 buildings sheet
def _sheet_frame(df):
    return df.select(F.col("`Nombre del consorcio`").alias("name"), F.col("Domicilio").alias("address"),
                     F.col("`Cant unidades funcionales`").alias("unit_count_raw"),
                     F.col("`m2 totales`").alias("area_raw"))


@query("q_import_buildings", files_sql("""
SELECT s.name, s.address, s.unit_count, s.area, CAST(2.00 AS DECIMAL(5,2)) AS fee_first,
       CAST(5.00 AS DECIMAL(5,2)) AS fee_next,
       CASE WHEN b.building_id IS NOT NULL THEN 'EXISTING' WHEN s.r <> '' THEN 'REJECTED'
            WHEN row_number() OVER (PARTITION BY s.name, s.address, s.r, b.building_id) > 1 THEN 'EXISTING'
            ELSE 'INSERTED' END AS status,
       s.r AS reasons
FROM (SELECT *, concat_ws(',', CASE WHEN coalesce(name, '') = '' OR length(rtrim(name)) > 40 THEN 'NAME_LENGTH' END,
                               CASE WHEN coalesce(address, '') = '' OR length(rtrim(address)) > 100 THEN 'ADDRESS_LENGTH' END,
                               CASE WHEN area IS NULL OR area <= 0 THEN 'INVALID_AREA' END,
                               CASE WHEN unit_count IS NULL OR unit_count <= 0 THEN 'INVALID_UNIT_COUNT' END) AS r
      FROM (SELECT trim("Nombre del consorcio") AS name, trim("Domicilio") AS address,
                   TRY_CAST(trim("Cant unidades funcionales") AS INTEGER) AS unit_count,
                   TRY_CAST(trim("m2 totales") AS DECIMAL(10,2)) AS area
            FROM (SELECT * FROM buildings_sheet
                  UNION ALL SELECT * FROM buildings_sheet WHERE "Nombre del consorcio" LIKE 'Torre %') bs) s0) s
LEFT JOIN building b ON b.name = s.name AND b.address = s.address"""))
def q_import_buildings(L):
    """J-09: buildings sheet rows, insert-if-absent by (name, address), validated; the
    sheet holds its regional rows twice."""
    sheet = _sheet_frame(FX.buildings_sheet(L.spark, L.sf))
    return IM.import_buildings(sheet.unionByName(sheet.filter("name like 'Torre %'")), L.building)


_SHEET = """
SELECT trim("Nombre del consorcio") AS name, trim("Domicilio") AS address,
       TRY_CAST(trim("Cant unidades funcionales") AS INTEGER) AS unit_count,
       TRY_CAST(trim("m2 totales") AS DECIMAL(10,2)) AS area
FROM buildings_sheet"""


@query("q_import_buildings_any_case", files_sql(f"""
, found AS (
  SELECT s.*, b.building_id, concat_ws(',',
         CASE WHEN coalesce(s.name, '') = '' OR length(rtrim(s.name)) > 40 THEN 'NAME_LENGTH' END,
         CASE WHEN coalesce(s.address, '') = '' OR length(rtrim(s.address)) > 100 THEN 'ADDRESS_LENGTH' END,
         CASE WHEN s.area IS NULL OR s.area <= 0 THEN 'INVALID_AREA' END,
         CASE WHEN s.unit_count IS NULL OR s.unit_count <= 0 THEN 'INVALID_UNIT_COUNT' END) AS r
  FROM ({_both_cases_sql(_SHEET, "name, address")}) s
  LEFT JOIN building b ON lower(trim(b.name)) = lower(s.name) AND lower(trim(b.address)) = lower(s.address))
SELECT name, address, unit_count, area, CAST(2.00 AS DECIMAL(5,2)) AS fee_first, CAST(5.00 AS DECIMAL(5,2)) AS fee_next,
       CASE WHEN building_id IS NOT NULL THEN 'EXISTING' WHEN r <> '' THEN 'REJECTED'
            WHEN row_number() OVER (PARTITION BY lower(name), lower(address), building_id IS NULL AND r = ''
                                    ORDER BY name, address, unit_count, area) > 1 THEN 'EXISTING'
            ELSE 'INSERTED' END AS status, r AS reasons
FROM found"""))
def q_import_buildings_any_case(L):
    """J-09: the sheet in two spellings: a building in other capitals is stored already,
    or was inserted by the row before."""
    sheet = _both_cases(_sheet_frame(FX.buildings_sheet(L.spark, L.sf)), "name", "address")
    return IM.import_buildings(sheet, L.building)


# ---------------------------------------------------------------------------
@query("q_surrogate_keys", with_ctes("""
SELECT *, CAST(row_number() OVER (ORDER BY o_custkey DESC, o_orderkey) AS BIGINT) AS order_no FROM orders"""))
def q_surrogate_keys(L):
    """E-06: dense ids 1..n for whole order rows in an order of its own, computed with
    per-partition offsets (no single-partition window over the rows)."""
    orders = L.spark.read.parquet(f"{L.sf}/orders.parquet").withColumn("_by", -F.col("o_custkey"))
    return surrogate_keys(orders, ["_by", "o_orderkey"], "order_no").drop("_by")


@query("q_import_units", files_sql(f"""
, staged AS ({STAGED_UNITS}),
names AS (SELECT name, CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS building_id
          FROM (SELECT DISTINCT building_name AS name FROM staged) d),
accepted AS (
  SELECT building_id, floor, door, area, coef,
         row_number() OVER (PARTITION BY building_id, floor, door ORDER BY area, coef) AS rn
  FROM staged s JOIN names n ON upper(trim(n.name)) = upper(trim(s.building_name))
  WHERE trim(coalesce(floor, '')) <> '' AND trim(coalesce(door, '')) <> '' AND area > 0 AND coef > 0 AND coef <= 100
    AND length(floor) <= 10 AND length(door) <= 10),
stored AS (SELECT CAST(row_number() OVER (ORDER BY building_id, floor, door) AS BIGINT) AS unit_id, building_id, floor,
                  door, area, coef FROM accepted WHERE rn = 1),
resolved_units AS (SELECT s.*, u.unit_id FROM staged s JOIN names n ON upper(trim(n.name)) = upper(trim(s.building_name))
             JOIN stored u ON u.building_id = n.building_id AND u.floor = s.floor AND u.door = s.door),
sto AS (SELECT unit_id, min(storage_area) AS size FROM resolved_units WHERE has_storage = 'si' AND storage_area > 0 GROUP BY 1),
par AS (SELECT unit_id, min(parking_area) AS size FROM resolved_units WHERE has_parking = 'si' AND parking_area > 0 GROUP BY 1)
SELECT u.unit_id, n.name AS building_name, u.floor, u.door, u.area, u.coef, sto.size AS storage_size,
       par.size AS parking_size
FROM stored u JOIN names n ON n.building_id = u.building_id LEFT JOIN sto ON sto.unit_id = u.unit_id
LEFT JOIN par ON par.unit_id = u.unit_id"""))
def q_import_units(L):
    """J-10: the units file imported into an empty ledger: placeholder buildings and units
    stored with ids, storage and parking of the units just stored."""
    out = IM.import_units(_staged_units(L), L.building.limit(0), L.unit.limit(0))
    return out["unit"].join(out["building"].withColumnRenamed("name", "building_name"), "building_id") \
        .join(out["storage"].withColumnRenamed("size", "storage_size"), "unit_id", "left") \
        .join(out["parking"].withColumnRenamed("size", "parking_size"), "unit_id", "left") \
        .select("unit_id", "building_name", "floor", "door", "area", "coef", "storage_size", "parking_size")


# ---------------------------------------------------------------------------
# A-01 .. A-07 readers: write the derived file, read it back with the reader
def _ext():
    return F.regexp_extract(F.col("file_name"), r"\.([A-Za-z]+)$", 1).alias("file_ext")


@query("q_read_units_tsv", files_sql("SELECT *, 'csv' AS file_ext FROM units_file"))
def q_read_units_tsv(L):
    """A-01/A-14: tab-delimited units file (header skipped) with its file name."""
    path = FL.write_delimited(FX.units_file(L.spark, L.sf), shared_dir(L.spark, "files", "units"), "\t")
    df = FL.read_units_tsv(L.spark, path)
    return df.select(*[c for c in df.columns if c not in (FL.CORRUPT, "file_name")], _ext())


@query("q_read_units_bad_rows", files_sql("SELECT * FROM units_file WHERE CAST(unit_no AS BIGINT) % 31 <> 0"))
def q_read_units_bad_rows(L):
    """A-01: a units file in which every 31st line has a field too many: those lines are
    skipped, under a tolerance of as many."""
    path = shared_dir(L.spark, "files", "bad-units")
    rows = FX.units_file(L.spark, L.sf)
    line = F.concat_ws("\t", *[F.col(c) for c in rows.columns])
    wrong = F.col("unit_no").cast("bigint") % 31 == 0
    rows.select(F.when(wrong, F.concat(line, F.lit("\tx"))).otherwise(line).alias("value")) \
        .write.text(f"{path}/rows")
    bad = FL.count_malformed_lines(L.spark, f"{path}/rows", "\t", len(rows.columns))
    df = FL.read_units_tsv(L.spark, f"{path}/rows", max_errors=bad, header=False)
    return df.select(*rows.columns)


@query("q_read_people_csv", files_sql("""
SELECT "Nombre", "Apellido", "DNI", nullif("Email", '') AS "Email", nullif("Telefono", '') AS "Telefono",
       "CVU_CBU", "Inquilino" FROM people_file"""))
def q_read_people_csv(L):
    """A-02: semicolon-delimited people file (empty fields read as NULL, like a bulk
    load without defaults)."""
    path = FL.write_delimited(FX.people_file(L.spark, L.sf), shared_dir(L.spark, "files", "people"), ";")
    return FL.read_people_csv(L.spark, path).drop(FL.CORRUPT)


@query("q_read_accounts_csv", files_sql("SELECT * FROM accounts_file"))
def q_read_accounts_csv(L):
    """A-03: pipe-delimited accounts file."""
    path = FL.write_delimited(FX.accounts_file(L.spark, L.sf), shared_dir(L.spark, "files", "accounts"), "|")
    return FL.read_accounts_csv(L.spark, path).drop(FL.CORRUPT)


@query("q_read_payments_csv", with_ctes("""
SELECT CAST(o_orderkey AS VARCHAR) AS id,
       CASE WHEN o_orderkey % 97 = 0 THEN '30/02/' || CAST(year(o_orderdate) AS VARCHAR)
            ELSE strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y') END AS fecha,
       CASE WHEN o_orderkey % 50 = 0 THEN '9999999999999999999999' ELSE lpad(CAST(o_custkey AS VARCHAR), 22, '0') END
         AS "CVU_CBU",
       '$ ' || replace(format('{:,}', CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS HUGEINT) // 100), ',', '.')
         || ',' || lpad(CAST(CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS HUGEINT) % 100 AS VARCHAR), 2, '0')
         AS valor
FROM orders"""))
def q_read_payments_csv(L):
    """A-04: comma-delimited bank file, amounts quoted where they hold a comma."""
    path = FL.write_delimited(FX.payments_file(L.spark, L.sf), shared_dir(L.spark, "files", "payments"), ",")
    return FL.read_payments_csv(L.spark, path).drop(FL.CORRUPT)


@query("q_read_expenses_json", with_ctes(
    "SELECT n.n_name AS \"Nombre del consorcio\", " + month_name("g.month") + " AS \"Mes\", "
    + ", ".join(f"{es_ar(f'g.k{i}')} AS \"{k}\"" for i, k in enumerate(EXPENSE_JSON_KEYS))
    + "\nFROM (SELECT building_id, year, month, "
    + ", ".join(f"max(CASE WHEN category = '{c}' THEN amount END) AS k{i}" for i, c in enumerate(CATS))
    + " FROM li_sum GROUP BY building_id, year, month) g JOIN nation n ON n.n_nationkey = g.building_id"))
def q_read_expenses_json(L):
    """A-05: JSON arrays of monthly expense objects, one element per row."""
    path = FL.write_expenses_json(FX.expenses_objects(L.spark, L.sf), shared_dir(L.spark, "files", "expenses"))
    return FL.read_expenses_json(L.spark, path)


@query("q_read_json_array", with_ctes("""
SELECT CAST(o_orderkey AS VARCHAR) AS id, strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y') AS fecha,
       '"}], {' || chr(92) || CAST(o_orderkey AS VARCHAR) || '}' AS nota, [CAST(o_custkey AS VARCHAR), '{', '}'] AS lista
FROM orders"""))
def q_read_json_array(L):
    """A-05: one JSON array a year of all orders, each larger than a task at scale, read in
    byte ranges; texts hold brackets, quotes and backslashes."""
    from pyspark.sql import types as T
    from ..sources.json_array import read_json_array
    o = L.spark.read.parquet(f"{L.sf}/orders.parquet").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("d"))
    key = F.col("o_orderkey").cast("string")
    rows = o.select(F.year("d").alias("part"), F.struct(
        key.alias("id"), F.date_format("d", "dd/MM/yyyy").alias("fecha"),
        F.concat(F.lit('"}], {\\'), key, F.lit("}")).alias("nota"),
        F.array(F.col("o_custkey").cast("string"), F.lit("{"), F.lit("}")).alias("lista")).alias("o"))
    path = FL.write_json_arrays(rows, "o", "part", shared_dir(L.spark, "files", "json-arrays"))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "fecha", "nota")]
                          + [T.StructField("lista", T.ArrayType(T.StringType()))])
    return read_json_array(L.spark, path, schema)


@query("q_load_expenses_file", with_ctes("""
WITH m AS (SELECT building_id, 2024 AS year, month, CAST(sum(amount) AS DECIMAL(18,2)) AS total
           FROM resolved GROUP BY building_id, month)
SELECT building_id * 100000 + year * 12 + month AS charge_no, building_id, make_date(year, month, 1) AS gen_date,
       least(make_date(year, month, 1) + 9, last_day(make_date(year, month, 1))) AS due1,
       least(make_date(year, month, 1) + 19, last_day(make_date(year, month, 1))) AS due2,
       CAST(CASE WHEN total > 99999999.99 THEN 99999999.99 ELSE total END AS DECIMAL(10,2)) AS total
FROM m"""))
def q_load_expenses_file(L):
    """J-16: the expenses JSON and the providers range read from files and imported as
    one year; the charges."""
    from ..operators.charges import load_expenses_file
    json_path = FL.write_expenses_json(FX.expenses_objects(L.spark, L.sf), shared_dir(L.spark, "files", "load-expenses"))
    providers = FL.write_delimited(FX.providers_sheet(L.spark, L.sf), shared_dir(L.spark, "files", "load-providers"), ",",
                                   header=False)
    return load_expenses_file(L.spark, json_path, providers, L.building, L.unit, year=2024)["charge"]


@query("q_read_buildings", files_sql("""
SELECT "Consorcio" AS source_code, "Nombre del consorcio" AS name, "Domicilio" AS address,
       "Cant unidades funcionales" AS unit_count_raw, "m2 totales" AS area_raw
FROM buildings_sheet"""))
def q_read_buildings(L):
    """A-06: buildings sheet export with a header row, renamed by header."""
    path = FL.write_delimited(FX.buildings_sheet(L.spark, L.sf), shared_dir(L.spark, "files", "buildings"), ",")
    return FL.read_buildings_sheet(L.spark, path)


@query("q_read_providers", with_ctes("SELECT category, provider, description, building_name, building_id FROM providers"))
def q_read_providers(L):
    """A-07: headerless provider range (F1..F4): blank rows dropped, trimmed, joined
    to buildings by name."""
    from ..sources.adapter import providers_table
    path = FL.write_delimited(FX.providers_sheet(L.spark, L.sf), shared_dir(L.spark, "files", "providers"), ",",
                              header=False)
    return providers_table(FL.read_providers_sheet(L.spark, path), L.building)
