"""Repeated rows, later imports and tables in parts: nothing may get lost or be taken twice."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from sf_paths import SF_SMALL
from strata.operators import charges as C
from strata.operators import imports as IM
from strata.operators import payments as P
from strata.operators import validate as V
from strata.operators.keys import next_ids, surrogate_keys
from strata.session import path_stamp, shared_dir
from strata.streaming import apply_payments_stream, weekly_totals_stream

APPT = ("charge_no bigint, unit_id bigint, pct decimal(10,2), prior_balance decimal(12,2), received decimal(12,2), "
        "interest decimal(12,2), ordinary decimal(12,2), extraordinary decimal(12,2), total decimal(12,2), debt decimal(12,2)")
CHARGE = "charge_no bigint, building_id bigint, gen_date date, due1 date, due2 date, total decimal(10,2)"
Z = D("0.00")


def appt(spark, rows):
    return spark.createDataFrame([(n, u, D("100"), Z, Z, Z, a, Z, a, a) for n, u, a in rows], APPT)


def charge(spark, rows):
    return spark.createDataFrame([(n, b, d, d + dt.timedelta(9), d + dt.timedelta(19), Z) for n, b, d in rows], CHARGE)


@pytest.mark.parametrize("partitions", ["16", "64"])
def test_surrogate_keys_neither_lose_nor_repeat(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(1_000_000).select(F.xxhash64("id").alias("k"), F.concat(F.lit("payload "), F.col("id")).alias("p"))
        path = shared_dir(spark, "test-keys")
        surrogate_keys(df, ["k"], "n").write.parquet(path)
        r = spark.read.parquet(path).agg(F.count("*"), F.countDistinct("n"), F.min("n"), F.max("n"), F.countDistinct("p")).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert tuple(r) == (1_000_000, 1_000_000, 1, 1_000_000, 1_000_000)


def test_next_ids_continue(spark):
    old = spark.createDataFrame([(7,), (3,)], "id bigint")
    new = next_ids(spark.createDataFrame([("b",), ("a",)], "k string"), old, "id", ["k"], "id")
    assert {r.k: r.id for r in new.collect()} == {"a": 8, "b": 9}


@pytest.mark.parametrize("chained", [False, True])
def test_later_import_carries_stored_debt(spark, chained):
    jan, feb, mar = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)
    stored_charge = charge(spark, [(1, 1, jan)])
    stored = C.carry_forward(appt(spark, [(1, 5, D("100.00"))]), stored_charge)
    out = C.carry_forward(appt(spark, [(2, 5, D("100.00")), (3, 5, D("100.00"))]), charge(spark, [(2, 1, feb), (3, 1, mar)]),
                          chained=chained, stored_appt=stored, stored_charge=stored_charge)
    rows = {r.charge_no: r for r in out.collect()}
    assert set(rows) == {2, 3}
    assert (rows[2].prior_balance, rows[2].interest, rows[2].debt) == (D("100.00"), D("5.00"), D("205.00"))
    assert rows[3].prior_balance == (D("205.00") if chained else D("100.00"))


def bank(spark, rows):
    return spark.createDataFrame(rows, "id string, fecha string, CVU_CBU string, valor string")


@pytest.mark.parametrize("match", ["month", "fifo"])
def test_repeated_and_odd_ids_are_all_accounted_for(spark, match):
    person = spark.createDataFrame([("1", "1" * 22, 5)], "dni string, account string, unit_id bigint")
    c = charge(spark, [(1, 1, dt.date(2024, 1, 1))])
    a = appt(spark, [(1, 5, D("100.00"))])
    lines = [("7", "05/01/2024", "1" * 22, "$ 10"), ("7", "06/01/2024", "1" * 22, "$ 11"), ("a1", "07/01/2024", "1" * 22, "$ 12"),
             ("a2", "07/01/2024", "1" * 22, "$ 12"), (None, "08/01/2024", "1" * 22, "$ 13"), ("8", "99/01/2024", "1" * 22, "$ 14"),
             ("9", "05/01/2024", "1" * 22, "$ 10")]
    out = P.import_payments(bank(spark, lines), person, a, c, match=match)
    ok, bad = out["payments"].collect(), out["rejected"].collect()
    assert len(ok) + len(bad) == len(lines)
    assert len({r.payment_id for r in ok}) == len(ok) == (6 if match == "month" else 3)
    assert all("INVALID_ID" in r.reasons for r in bad if r.source_id is None)
    again = P.import_payments(bank(spark, [("7", "09/01/2024", "1" * 22, "$ 20")]), person, a, c, out["payments"], match)
    assert [r.payment_id for r in again["payments"].collect()] == [len(ok) + 1]


def test_streamed_payments_do_not_depend_on_files(spark):
    person = spark.createDataFrame([("1", "1" * 22, 5)], "dni string, account string, unit_id bigint")
    c = charge(spark, [(1, 1, dt.date(2024, 1, 1))])
    a = appt(spark, [(1, 5, D("100.00"))])
    folder = shared_dir(spark, "test-bank")
    for i in range(6):
        bank(spark, [("7", "05/01/2024", "1" * 22, "$ 10")]).coalesce(1).write.mode("append").option("header", True).csv(folder)
    received = apply_payments_stream(spark, folder, person, a, c, files_per_batch=2).first().received
    assert received == D("60.00")
    assert P.import_payments(bank(spark, [("7", "05/01/2024", "1" * 22, "$ 10")] * 6), person, a, c)["apportionment"].first().received == received


def test_weekly_stream_of_a_table_in_parts(spark, tmp_path):
    whole = weekly_totals_stream(spark, f"{SF_SMALL}/events.parquet")
    parts = str(tmp_path / "events.parquet")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(4).write.parquet(parts)
    assert path_stamp(spark, parts)[0] > 0
    again = weekly_totals_stream(spark, parts)
    assert whole.count() > 0 and whole.exceptAll(again).count() == 0 and again.exceptAll(whole).count() == 0
    with pytest.raises(FileNotFoundError):
        weekly_totals_stream(spark, str(tmp_path / "none.parquet"))


def test_duplicate_and_stored_keys(spark):
    c, u = charge(spark, [(1, 1, dt.date(2024, 1, 1)), (2, 1, dt.date(2024, 2, 1))]), spark.createDataFrame([(5,), (6,)], "unit_id bigint")
    batch = appt(spark, [(1, 5, D("1.00"))] * 3 + [(1, 6, D("1.00")), (2, 5, D("2.00"))])
    out = V.validate_apportionments(batch, c, u, existing=appt(spark, [(2, 5, D("9.00"))]))
    got = sorted((r.charge_no, r.unit_id, r.reasons) for r in out.collect())
    assert got == [(1, 5, ""), (1, 5, "DUPLICATE_KEY"), (1, 5, "DUPLICATE_KEY"), (1, 6, ""), (2, 5, "ALREADY_EXISTS")]
    people = spark.createDataFrame([("1", "Ana", "Paz", None, None, None, 5)] * 2,
                                   "dni string, first_name string, last_name string, email string, phone string, account string, unit_id bigint")
    assert sorted(r.reasons for r in V.validate_people(people, u).collect()) == ["", "DUPLICATE_KEY"]


def test_repeated_sheet_and_file_rows_on_an_empty_ledger(spark):
    sheet = spark.createDataFrame([("Torre", "Calle 1", "4", "100.00")] * 2 + [("Bad", "Calle 2", "0", "1")],
                                  "name string, address string, unit_count_raw string, area_raw string")
    building = spark.createDataFrame([], "building_id bigint, name string, address string")
    assert sorted(r.status for r in IM.import_buildings(sheet, building).collect()) == ["EXISTING", "INSERTED", "REJECTED"]
    cols = "building_name string, floor string, door string, area string, coef string, has_storage string, has_parking string, storage_area string, parking_area string"
    line = ("Uno", "1", "A", "45.00", "8,50", "SI", "SI", "5.00", "12.00")
    staged = IM.units_staged(spark.createDataFrame([line, line, ("Dos", "1", "A", "50.00", "1,0", "NO", "SI", "0", "9.00")], cols))
    unit = spark.createDataFrame([], "unit_id bigint, building_id bigint, floor string, door string, area decimal(6,2), coef decimal(5,2)")
    out = IM.import_units(staged, building, unit)
    assert sorted(r.status for r in out["report"].collect()) == ["ACCEPTED", "ACCEPTED", "EXISTING"]
    assert sorted(r.unit_id for r in out["unit"].collect()) == [1, 2]
    assert out["storage"].count() == 1 and out["parking"].count() == 2
