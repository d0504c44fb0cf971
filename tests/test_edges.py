"""Edge rows from FIXTURES.md not covered elsewhere: ceiling clamp through the
import, month-edge payments, a tie at rank 5, late events behind the watermark."""

import datetime as dt
import os
import uuid
from decimal import Decimal

import pandas as pd

from strata.operators import charges as C
from strata.operators import payments as P
from strata.plans import reports as R
from strata.session import shared_dir
from strata.streaming import weekly_totals_stream

D = Decimal
KEYS = ["BANCARIOS", "LIMPIEZA", "ADMINISTRACION", "SEGUROS", "GASTOS GENERALES", "SERVICIOS PUBLICOS-Agua",
        "SERVICIOS PUBLICOS-Luz"]


def test_amount_above_ceiling_is_clamped_in_charges_and_expenses(spark):
    schema = "`Nombre del consorcio` string, Mes string, " + ", ".join(f"`{k}` string" for k in KEYS)
    sheet = spark.createDataFrame([("Torre", "febrero", "123.456.789,00", "10,00", None, None, None, None, None)], schema)
    building = spark.createDataFrame([(1, "TORRE")], "building_id bigint, name string")
    unit = spark.createDataFrame([(1, 1, D("50.00")), (2, 1, D("50.00"))],
                                 "unit_id bigint, building_id bigint, area decimal(6,2)")
    providers = spark.createDataFrame([(1, "GASTOS BANCARIOS", "Banco")], "building_id bigint, category string, "
                                                                          "provider string")
    out = C.generate_charges(sheet, providers, building, unit, year=2024, day1=31, day2=30)
    ch = out["charge"].first()
    assert ch.total == D("99999999.99")                       # clamped
    assert ch.due1 == dt.date(2024, 2, 29) and ch.due2 == dt.date(2024, 2, 29)  # Feb 29 clamp
    amounts = sorted(r.amount for r in out["expense"].collect())
    assert amounts == [D("10.00"), D("99999999.99")]
    assert out["expense_ordinary"].count() == 1               # BANCARIOS -> GASTOS BANCARIOS provider


def test_payments_on_month_edges_match_that_month(spark):
    z = D("0.00")
    appt = spark.createDataFrame([(n, 1, z) for n in (1, 2, 3)], "charge_no bigint, unit_id bigint, debt decimal(12,2)")
    charge = spark.createDataFrame([(1, dt.date(2024, 1, 1), None, None), (2, dt.date(2024, 2, 1), None, None),
                                    (3, dt.date(2024, 3, 1), None, None)],
                                   "charge_no bigint, gen_date date, due1 date, due2 date")
    pays = spark.createDataFrame([(1, 1, dt.date(2024, 1, 31)), (2, 1, dt.date(2024, 2, 1)), (3, 1, dt.date(2024, 2, 29)),
                                  (4, 1, dt.date(2024, 3, 1))], "source_id bigint, unit_id bigint, pay_date date")
    got = {r.source_id: r.charge_no for r in P.match_by_month(pays, appt, charge).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 3}


def test_top_months_tie_at_rank_five(spark):
    unit = spark.createDataFrame([(1, 9)], "unit_id bigint, building_id bigint")
    amounts = {1: 50, 2: 40, 3: 30, 4: 20, 5: 10, 6: 10, 7: 5}  # months 5 and 6 tie for rank 5
    pay = spark.createDataFrame([(1, dt.date(2024, m, 3), D(a)) for m, a in amounts.items()],
                                "unit_id bigint, pay_date date, amount decimal(12,2)")
    out = R.top_months_income(pay, unit).orderBy("rank").collect()
    assert [r.month for r in out] == [1, 2, 3, 4, 5] and out[0].month_name == "Enero"


def test_stream_drops_events_behind_the_watermark(spark):
    src = shared_dir(spark, "tests", "events_src")
    os.makedirs(src, exist_ok=True)
    base = dt.datetime(2024, 1, 1)
    first = pd.DataFrame({"event_id": [1, 2, 3], "ts": [base, base + dt.timedelta(days=3), base + dt.timedelta(days=20)],
                          "user_id": [1, 1, 1], "event_type": ["view"] * 3, "value": [1.0, 2.0, 3.0], "props": ["{}"] * 3})
    # second file: an on-time event and a duplicate of event 3 (within the watermark);
    # third file: an event 10 days behind the watermark. Spark drops late rows using the
    # watermark of the previous micro-batch (so chained stateful operators agree).
    second = pd.DataFrame({"event_id": [5, 3], "ts": [base + dt.timedelta(days=21), base + dt.timedelta(days=20)],
                           "user_id": [1, 1], "event_type": ["view"] * 2, "value": [5.0, 3.0], "props": ["{}"] * 2})
    third = pd.DataFrame({"event_id": [4], "ts": [base + dt.timedelta(days=10)], "user_id": [1],
                          "event_type": ["view"], "value": [4.0], "props": ["{}"]})
    import time

    import pyarrow as pa
    import pyarrow.parquet as pq
    schema = pa.schema([("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()),
                        ("event_type", pa.string()), ("value", pa.float64()), ("props", pa.string())])
    for i, pdf in enumerate([first, second, third]):
        pq.write_table(pa.Table.from_pandas(pdf, schema=schema, preserve_index=False),
                       os.path.join(src, f"part{i}_{uuid.uuid4().hex}.parquet"))
        time.sleep(1.1)  # distinct modification times: the files arrive in order
    out = weekly_totals_stream(spark, src, files_per_batch=1).collect()
    total_events = sum(r.events for r in out)
    assert total_events == 4  # events 1, 2, 3, 5: the late event 4 and the duplicate of 3 are dropped
