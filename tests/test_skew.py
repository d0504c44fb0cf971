"""Hot keys: one unit holds a third of all payments. Results must stay whole and
exact, and the plans must not gather the hot key's raw rows in one window task."""

import datetime as dt
import random
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F

from strata.operators import payments as P
from strata.plans import reports as R


def _payments(spark, n=30000, hot_unit=7, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        unit = hot_unit if i % 3 == 0 else rnd.randrange(0, 500)
        rows.append((i, unit, dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(0, 900))))
    return rows


def test_days_between_payments_hot_unit(spark):
    rows = _payments(spark)
    pay = spark.createDataFrame(rows, "payment_id bigint, unit_id bigint, pay_date date").repartition(8)
    unit = spark.createDataFrame([(u, 1, str(u), "A") for u in range(500)],
                                 "unit_id bigint, building_id bigint, floor string, door string")
    out = R.days_between_payments(pay, unit)
    got = {r.payment_id: r.days for r in out.collect()}
    df = pd.DataFrame(rows, columns=["pid", "unit", "d"]).sort_values(["unit", "d", "pid"])
    df["prev"] = df.groupby("unit")["d"].shift(1)
    want = {p: (0 if pd.isna(pr) else (d - pr).days) for p, d, pr in zip(df.pid, df.d, df.prev)}
    assert got == want and len(got) == len(rows)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    window_part = plan[plan.index("Window"):]
    assert "Aggregate" in window_part  # the window reads (unit, day) aggregates, not raw payments


def test_fifo_hot_unit_does_not_fan_out(spark):
    rows = _payments(spark, n=20000)
    pay = spark.createDataFrame(rows, "source_id bigint, unit_id bigint, pay_date date")
    appt = spark.createDataFrame([(m, u, 1.0) for u in range(500) for m in range(1, 13)],
                                 "charge_no bigint, unit_id bigint, debt double")
    charge = spark.createDataFrame([(m, dt.date(2020, m, 1), dt.date(2020, m, 10), None) for m in range(1, 13)],
                                   "charge_no bigint, gen_date date, due1 date, due2 date")
    out = P.match_fifo(pay, appt, charge)
    assert out.count() == len(rows)
    assert out.filter("charge_fifo IS NOT NULL").count() == len(rows)  # every date is after January 1st, 2020
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan  # grouped min_by, no per-unit window


def test_monthly_pivot_hot_unit(spark):
    """A unit with a third of the payments, and two persons of one name on another."""
    rows = _payments(spark, n=9000)
    pay = spark.createDataFrame(rows, "payment_id bigint, unit_id bigint, pay_date date") \
        .withColumn("amount", F.lit("2.50").cast("decimal(12,2)"))
    unit = spark.createDataFrame([(u, 1, str(u), "A") for u in range(502)],
                                 "unit_id bigint, building_id bigint, floor string, door string")
    person = spark.createDataFrame([(u, "Ana", "Paz") for u in range(500)] + [(8, "Ana", "Paz"), (9, "Leo", "Sur")],
                                   "unit_id bigint, first_name string, last_name string")
    out = R.monthly_pivot(unit, pay, person, 2020)
    got = {}
    for r in out.collect():
        got.setdefault(r.unit_id, []).append(r)
    assert len(got) == 502 and len(got[9]) == 2 and len(got[8]) == 1
    for u in (7, 8, 9, 500):
        for r in got[u]:
            k = 2 if u == 8 else 1
            paid = [d for _, x, d in rows if x == u and d.year == 2020]
            assert [r[m] for m in R.MONTH_COLUMNS] == [Decimal("2.50") * k * sum(d.month == i for d in paid) for i in range(1, 13)]
            assert r.year_total == (Decimal("2.50") * k * len(paid) if paid else None)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")  # payments are summed below the joins
