"""Readers, imports, validators, deletes and surrogate keys on small inputs."""

import datetime as dt
import os
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import changes as CH
from strata.operators import imports as IM
from strata.operators import validate as V
from strata.operators.keys import surrogate_keys
from strata.session import shared_dir
from strata.sources import files as FL

D = Decimal


def _write(spark, name, text):
    d = shared_dir(spark, "tests", name)
    os.makedirs(d, exist_ok=True)
    p = os.path.join(d, f"{uuid.uuid4().hex}.txt")
    with open(p, "w", encoding="utf-8") as fh:
        fh.write(text)
    return d


def test_units_tsv_reader_and_cleaning(spark):
    text = ("nombre del consorcio\tnro\tpiso\tdepto\tcoef\tm2\tbaulera\tcochera\tm2b\tm2c\n"
            "Edificio Uno\t1\tPB\tE\t8,50\t45.00\tSI\tNO\t5.00\t0\n"
            "Edificio Uno\t2\t1\tA\tabc\t60.00\tNO\tsi\t0\t12.50\n"
            "  \t3\t2\tB\t1,0\t50.00\tNO\tNO\t0\t0\n"
            "Edificio Dos\t4\t3\tC\t2,00\t70.00\tNO\tNO\t0\t0\n"
            "roto\tsin\tcolumnas\n")
    path = _write(spark, "units", text)
    df = FL.read_units_tsv(spark, path)
    assert df.count() == 4 and FL.check_bad_rows(spark, path, "\t", 10, 1000) == 1
    assert df.select("file_name").first().file_name.endswith(".txt")
    with pytest.raises(FL.TooManyBadRows):
        FL.check_bad_rows(spark, path, "\t", 10, 0)
    staged = IM.units_staged(df.filter(F.col("unit_no").isNotNull() & F.col("parking_area").isNotNull()))
    building = spark.createDataFrame([(1, "EDIFICIO UNO", "x")], "building_id bigint, name string, address string")
    unit = spark.createDataFrame([(10, 1, "PB", "E")], "unit_id bigint, building_id bigint, floor string, door string")
    out = {(r.floor, r.door): r for r in IM.clean_units(staged, building, unit).collect()}
    assert out[("PB", "E")].status == "EXISTING"  # re-import inserts nothing (defect 8)
    assert out[("1", "A")].status == "REJECTED" and out[("1", "A")].reasons == "INVALID_COEF"
    assert out[("3", "C")].status == "ACCEPTED" and out[("3", "C")].building_id is None
    assert ("2", "B") not in out  # blank building row dropped
    new = IM.new_buildings(staged, building).collect()
    assert [(r.name, r.address, r.area) for r in new] == [("Edificio Dos", "Dirección Edificio Dos", D("1000.00"))]
    parking = IM.storage_rows(staged, building, spark.createDataFrame(
        [(11, 1, "1", "A")], "unit_id bigint, building_id bigint, floor string, door string"), "parking").collect()
    assert [(r.unit_id, r.size) for r in parking] == [(11, D("12.50"))]


def test_people_dedup_is_deterministic_and_hashed(spark):
    text = ("Nombre;Apellido;DNI;Email;Telefono;CVU_CBU;Inquilino\n"
            "Ana  ;Paz;123;B@X.COM;;0000000000000000000001;0\n"
            "Ana;Paz;123;a@x.com;111;0000000000000000000001;0\n"
            "Luis;Sol; 456 ;;;0000000000000000000002;1\n")
    people = FL.read_people_csv(spark, _write(spark, "people", text))
    d = {r.dni: r for r in IM.dedup_people(IM.people_staged(people)).collect()}
    assert set(d) == {"123", "456"}
    assert d["123"].email == "B@X.COM" and d["123"].first_name == "Ana" and d["456"].phone is None
    acc_text = ("CVU_CBU|NombreConsorcio|NroUF|Piso|Departamento\n"
                "0000000000000000000001|Edificio Uno|7|PB|E\n0000000000000000000002|Edificio Uno|8|1|A\n")
    accounts = IM.accounts_staged(FL.read_accounts_csv(spark, _write(spark, "acc", acc_text)))
    building = spark.createDataFrame([(1, "Edificio Uno")], "building_id bigint, name string")
    unit = spark.createDataFrame([(10, 1, "PB", "E"), (11, 1, "1", "A")],
                                 "unit_id bigint, building_id bigint, floor string, door string")
    imp = IM.import_people(IM.dedup_people(IM.people_staged(people)), accounts, building, unit)
    assert {(r.dni, r.unit_id) for r in imp.collect()} == {("123", 10), ("456", 11)}
    h = {r.dni: r for r in IM.hash_people(imp).collect()}
    import hashlib
    assert h["123"].email_hash == hashlib.sha256("B@X.COM".encode("utf-16-le")).hexdigest()
    assert h["456"].email_hash is None
    occ = IM.import_occupancy(people, accounts, building, unit, imp).collect()
    assert sorted((r.dni, r.role) for r in occ) == [("123", "Propietario"), ("456", "Inquilino")]


def test_expenses_json_reader(spark):
    text = ('[{"Nombre del consorcio":"Edificio Uno","Mes":"abril ","BANCARIOS":"4.500,00","LIMPIEZA":"63.000,00",'
            '"ADMINISTRACION":"95.000,00","SEGUROS":"1.234,56","GASTOS GENERALES":"",'
            '"SERVICIOS PUBLICOS-Agua":"x","SERVICIOS PUBLICOS-Luz":null,"extra":"ignored"},'
            '{"Nombre del consorcio":"Edificio Uno","Mes":"mayo"}]')
    df = FL.read_expenses_json(spark, _write(spark, "json", text))
    rows = df.collect()
    assert len(rows) == 2 and rows[0]["SEGUROS"] == "1.234,56" and rows[1]["BANCARIOS"] is None


def test_payments_csv_quoted_amount(spark):
    text = 'id,fecha,CVU_CBU,valor\n1,01/02/2024,0000000000000000000001,"$ 1.234,56"\n2,x,0000000000000000000001,$ 10\n'
    df = FL.read_payments_csv(spark, _write(spark, "pay", text))
    from strata.operators import payments as P
    out = {r.source_id: r for r in P.parse_bank_file(df).collect()}
    assert out[1].amount == D("1234.56") and out[1].pay_date == dt.date(2024, 2, 1)
    assert out[2].pay_date is None and out[2].amount == D("10.00")


def test_validators_reasons_and_batch_duplicates(spark):
    b = spark.createDataFrame([
        (1, "Torre", "Calle 1", 10, D("100.00"), D("2.00"), D("5.00")),
        (2, "Torre", "Calle 1", 10, D("100.00"), D("2.00"), D("5.00")),
        (3, "", "Calle 3", 0, D("0.00"), D("-1.00"), D("5.00"))],
        "building_id bigint, name string, address string, unit_count int, area decimal(18,2), "
        "fee_first decimal(5,2), fee_next decimal(5,2)")
    out = {r.building_id: r for r in V.validate_buildings(b).collect()}
    assert out[1].status == "ACCEPTED" and out[2].reasons == "DUPLICATE_KEY"
    assert out[3].reasons == "NAME_LENGTH,INVALID_AREA,INVALID_UNIT_COUNT,INVALID_FEE_FIRST"
    stored = b.filter("building_id = 1")
    assert V.validate_buildings(b.filter("building_id = 2"), existing=stored).first().reasons == "ALREADY_EXISTS"
    unit = spark.createDataFrame([(1,)], "unit_id bigint")
    p = spark.createDataFrame([
        ("123", "José", "Paz", "sin-arroba", "11-22", "123", 1), ("12a", "Ana", "Paz", "", None, None, 9)],
        "dni string, first_name string, last_name string, email string, phone string, account string, unit_id bigint")
    out = {r.dni: r.reasons for r in V.validate_people(p, unit).collect()}
    assert out["123"] == "INVALID_FIRST_NAME,INVALID_EMAIL,INVALID_PHONE,INVALID_ACCOUNT"
    assert out["12a"] == "INVALID_DNI,UNKNOWN_UNIT"


def test_deletes(spark):
    unit = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "unit_id bigint, building_id bigint")
    appt = spark.createDataFrame([(1,)], "unit_id bigint")
    pay = spark.createDataFrame([(1,), (2,)], "unit_id bigint")
    req = spark.createDataFrame([(1,), (2,), (3,), (4,)], "unit_id bigint")
    out = {r.unit_id: (r.status, r.reasons) for r in CH.restricted_delete(
        req, unit, "unit_id", [(appt, "unit_id", "HAS_APPORTIONMENT"), (pay, "unit_id", "HAS_PAYMENT")]).collect()}
    assert out == {1: ("REJECTED", "HAS_APPORTIONMENT,HAS_PAYMENT"), 2: ("REJECTED", "HAS_PAYMENT"),
                   3: ("DELETED", ""), 4: ("NOT_FOUND", "")}
    assert {r.unit_id: r.status for r in CH.keyed_delete(req, unit, "unit_id").collect()}[4] == "NOT_FOUND"


def test_surrogate_keys_match_global_order(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k")).repartition(5)
    out = surrogate_keys(df, ["k"], "sk", start=100).collect()
    assert sorted((r.k, r.sk) for r in out) == [(k, 101 + k) for k in range(5000)]


def test_keys_in_other_case_are_the_same(spark):
    building = spark.createDataFrame([(1, "Azcuénaga", "Calle 1")], "building_id bigint, name string, address string")
    unit = spark.createDataFrame([(10, 1, "PB", "A")], "unit_id bigint, building_id bigint, floor string, door string")
    sheet = spark.createDataFrame([("AZCUÉNAGA ", "calle 1", "3", "10.00"), ("Azcuenaga", "Calle 1", "3", "10.00"),
                                   ("azcuenaga", "CALLE 1", "3", "10.00")],
                                  "name string, address string, unit_count_raw string, area_raw string")
    got = {(r["name"], r.address): r.status for r in IM.import_buildings(sheet, building).collect()}
    # case does not count, accents do
    assert got == {("AZCUÉNAGA", "calle 1"): "EXISTING", ("Azcuenaga", "Calle 1"): "INSERTED",
                   ("azcuenaga", "CALLE 1"): "EXISTING"}
    rows = [("azcuÉNAGA", "pb", "a"), ("Azcuénaga", "1", "B"), ("AZCUÉNAGA", "1", "b"), ("Otro", "1", "b"), ("OTRO", "1", "B")]
    staged = spark.createDataFrame([(*r, D("50.00"), D("1.00"), "si", "no", D("3.00"), None) for r in rows],
                                   "building_name string, floor string, door string, area decimal(6,2), coef decimal(5,2), "
                                   "has_storage string, has_parking string, storage_area decimal(10,2), parking_area decimal(10,2)")
    out = {(r.building_name, r.floor, r.door): r.status for r in IM.clean_units(staged, building, unit).collect()}
    assert out == {rows[0]: "EXISTING", rows[1]: "ACCEPTED", rows[2]: "EXISTING", rows[3]: "EXISTING", rows[4]: "ACCEPTED"}
    assert [r["name"] for r in IM.new_buildings(staged, building).collect()] == ["OTRO"]
    assert [(r.unit_id, r.size) for r in IM.storage_rows(staged, building, unit).collect()] == [(10, D("3.00"))]
    whole = IM.import_units(staged, building, unit.withColumns({"area": F.lit(1).cast("decimal(6,2)"),
                                                                "coef": F.lit(1).cast("decimal(5,2)")}))
    assert whole["unit"].count() == 3 and whole["building"].count() == 2 and whole["storage"].count() == 3


def test_keyed_rows_against_plain(spark):
    import random
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 3, 7]), rng.choice([None, "a", "A", "b ", "B"]), rng.randrange(3), rng.choice([None, "x"]))
            for _ in range(400)] + [(9, "hot", 0, "x")] * 300
    batch = spark.createDataFrame(rows, "k long, t string, v int, w string").repartition(7)
    old = spark.createDataFrame([(1, "A"), (2, "b"), (None, "a"), (3, None), (2, "B")], "k long, t string")
    got = V.keyed_rows(batch, ["k", "t"], ["v"], old).collect()
    assert sorted(map(str, ((r.k, r.t, r.v, r.w) for r in got))) == sorted(map(str, rows))
    key = lambda k, t: None if k is None or t is None else (k, t.strip().lower())
    stored = {key(1, "a"), key(2, "b")}
    first = {}
    for r in got:
        k = key(r.k, r.t)
        assert r._stored == (k in stored)
        if k is None:
            assert r._first
        elif r._first:
            assert k not in first
            first[k] = r
    least = {}
    for r in rows:
        k = key(r[0], r[1])
        if k is not None:
            least.setdefault(k, []).append(r[2])
    assert set(first) == set(least) and all(first[k].v == min(v) for k, v in least.items())
