"""Third round: wide money, running allocation, keyed streaming state, co-located apply, XML read back."""

import datetime as dt
import os
import random
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import functions as F

from sf_paths import SF_SMALL
from strata import functions as X
from strata.operators import charges as C
from strata.operators import payments as P
from strata.plans.catalog import QUERIES, ledger
from strata.session import shared_dir
from strata.streaming import accepted_payments_stream, apply_payments_stream, paid_stream

D = Decimal
APPT = ("charge_no bigint, unit_id bigint, pct decimal(10,2), prior_balance decimal(12,2), received decimal(12,2), "
        "interest decimal(12,2), ordinary decimal(12,2), extraordinary decimal(12,2), total decimal(12,2), debt decimal(12,2)")
CHARGE = "charge_no bigint, building_id bigint, gen_date date, due1 date, due2 date, total decimal(10,2)"


def appt(spark, rows):
    z = D("0.00")
    return spark.createDataFrame([(n, u, D("1.00"), z, z, z, d, z, d, d) for n, u, d in rows], APPT)


def charge(spark, rows):
    return spark.createDataFrame([(n, b, g, None, None, D("0.00")) for n, b, g in rows], CHARGE)


def test_half_up_division_of_any_size(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(-10 ** rng.randrange(1, 38), 10 ** rng.randrange(1, 38)), rng.randrange(1, 10 ** rng.randrange(1, 37)))
            for _ in range(500)] + [(0, 7), (7, 2), (-7, 2), (5, 10), (-5, 10), (4, 10), (10 ** 31, 1), (10 ** 37, 10 ** 6)]
    rows = [(n, d) for n, d in rows if abs(n) // d < 10 ** 31]
    df = spark.createDataFrame([(D(n), D(d)) for n, d in rows], "n decimal(38,0), d decimal(38,0)")
    got = df.select("n", "d", X.round_div_half_up("n", "d").alias("q")).collect()
    assert len(got) == len(rows)
    for r in got:
        x = Fraction(int(r.n), int(r.d))
        want = (abs(x) + Fraction(1, 2)).__floor__() * (1 if x >= 0 else -1)
        assert int(r.q) == want


def _settled(pays, debts):
    """Queues: each payment in turn pays the oldest open charge."""
    out, credit = {}, {}
    for unit in {u for _, u, _, _ in pays}:
        queue = [[n, d] for _, n, d in sorted((g, n, d) for n, u, d, g in debts if u == unit and d > 0)]
        for pid, _, day, amount in sorted((p for p in pays if p[1] == unit and p[3] > 0),
                                          key=lambda p: (p[2], p[0] % P.SLOTS, p[0])):
            while amount > 0 and queue:
                part = min(amount, queue[0][1])
                out[pid, queue[0][0]] = out.get((pid, queue[0][0]), 0) + part
                queue[0][1] -= part
                amount -= part
                if not queue[0][1]:
                    queue.pop(0)
            if amount > 0:
                credit[pid, None] = amount
    return out | credit


def test_running_allocation_against_queues(spark):
    """One unit has most payments; some are larger than a charge, some days hold many."""
    rng = random.Random(9)
    debts = [(100 * u + m, u, D(rng.choice([0, 5, 10, 33])) + D("0.05"), dt.date(2024, 1 + m, 1))
             for u in range(5) for m in range(8)] + [(900, 7, D("0.00"), dt.date(2024, 1, 1))]
    pays = [(i, rng.choice([0, 0, 0, 0, 1, 2, 3, 7, 8]), dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(9)),
             D(rng.choice(["0.01", "1.50", "12.00", "70.00", "0.00"]))) for i in range(300)]
    p = spark.createDataFrame(pays, "payment_id bigint, unit_id bigint, pay_date date, amount decimal(12,2)")
    p = p.unionByName(spark.createDataFrame([(999, None, dt.date(2024, 1, 1), D("5.00"))], p.schema))
    c = charge(spark, [(n, 1, g) for n, _, _, g in debts])
    got = P.allocate_running(p, appt(spark, [(n, u, d) for n, u, d, _ in debts]), c).collect()
    assert {(r.payment_id, r.charge_no): r.amount for r in got} == _settled(pays, debts)
    assert len(got) == len({(r.payment_id, r.charge_no) for r in got})


def test_chained_carry_against_a_loop(spark):
    rng = random.Random(2)
    rows = [(n, u, D(rng.randrange(0, 20000)) / 100) for u in range(6) for n in range(1, 40) if rng.random() < 0.9]
    c = charge(spark, [(n, 1, dt.date(2020, 1, 1) + dt.timedelta(days=31 * n)) for n in range(1, 40)])
    got = {(r.charge_no, r.unit_id): r for r in C.carry_forward(appt(spark, rows), c, chained=True).collect()}
    assert len(got) == len(rows)
    debt = {}
    for n, u, own in sorted(rows):
        before = debt.get((n - 1, u), D(0))  # the building's charge before; none if the unit has no row there
        interest = (before * D("0.05")).quantize(D("0.01"), "ROUND_HALF_UP")
        debt[n, u] = own + before + interest
        r = got[n, u]
        assert (r.prior_balance, r.interest, r.debt) == (before, interest, debt[n, u])


def _bank(spark, folder, rows):
    spark.createDataFrame(rows, "id string, fecha string, CVU_CBU string, valor string").coalesce(1) \
        .write.mode("append").option("header", True).csv(folder)


def test_stream_goes_on_where_it_ended(spark):
    """A second run reads new files only; a micro-batch run again gives the same balances."""
    person = spark.createDataFrame([(str(u), str(u) * 22, u) for u in (1, 2)], "dni string, account string, unit_id bigint")
    c, a = charge(spark, [(1, 1, dt.date(2024, 1, 1))]), appt(spark, [(1, 1, D("100.00")), (1, 2, D("100.00"))])
    folder, work = shared_dir(spark, "test-bank"), shared_dir(spark, "test-stream")
    received = lambda df: {r.unit_id: r.received for r in df.collect()}
    _bank(spark, folder, [("1", "05/01/2024", "1" * 22, "$ 10"), ("2", "06/01/2024", "2" * 22, "$ 1")])
    _bank(spark, folder, [("3", "06/01/2024", "1" * 22, "$ 5"), ("4", "bad", "1" * 22, "$ 5")])
    first = apply_payments_stream(spark, folder, person, a, c, work_dir=work, files_per_batch=1)
    assert received(first) == {1: D("15.00"), 2: D("1.00")}
    before = sorted(os.listdir(f"{work}/paid"))
    assert received(apply_payments_stream(spark, folder, person, a, c, work_dir=work)) == {1: D("15.00"), 2: D("1.00")}
    assert sorted(os.listdir(f"{work}/paid")) == before  # nothing new, nothing done
    _bank(spark, folder, [("5", "07/01/2024", "2" * 22, "$ 2")])
    assert received(apply_payments_stream(spark, folder, person, a, c, work_dir=work)) == {1: D("15.00"), 2: D("3.00")}
    new = sorted(set(os.listdir(f"{work}/paid")) - set(before))
    assert len(new) == 1  # one micro-batch, which wrote the changed key alone
    assert [r.unit_id for r in spark.read.parquet(f"{work}/paid/{new[0]}").collect()] == [2]
    # a run that stopped after the payments were stored: the next one takes them into the balances, once
    _bank(spark, folder, [("6", "08/01/2024", "1" * 22, "$ 4")])
    accepted_payments_stream(spark, folder, person, a, c, work)
    # the last micro-batch of the sums fails to be committed and is run again from the state before it
    last = max((int(n) for n in os.listdir(f"{work}/paid_ckpt/commits") if n.isdigit()))
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{work}/paid_ckpt/commits/{name}"):
            os.remove(f"{work}/paid_ckpt/commits/{name}")
    assert received(apply_payments_stream(spark, folder, person, a, c, work_dir=work)) == {1: D("19.00"), 2: D("3.00")}
    paid = {(r.charge_no, r.unit_id): r.amount for r in paid_stream(spark, f"{work}/payments", work).collect()}
    assert paid == {(1, 1): D("19.00"), (1, 2): D("3.00")}


def test_apply_payments_leaves_the_apportionment_where_it_is(spark):
    """The bucketed apportionment is joined without an exchange; payments of a hot unit are summed before theirs."""
    L = ledger(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = L.payment.withColumn("unit_id", F.when(F.col("payment_id") % 3 == 0, 10).otherwise(F.col("unit_id")))
        df = P.apply_payments(L.apportionment, hot)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Bucketed: true" in plan
    above = plan[:plan.index("Bucketed: true")]
    tree = above[above.rindex("Join"):]
    assert "Exchange" not in tree, plan
    want = {(r.charge_no, r.unit_id): r.p for r in hot.groupBy("charge_no", "unit_id").agg(F.sum("amount").alias("p")).collect()}
    base = {(r.charge_no, r.unit_id): r.received for r in L.apportionment.collect()}
    for r in df.collect():
        assert r.received == base[r.charge_no, r.unit_id] + want.get((r.charge_no, r.unit_id), 0)


def test_xml_is_read_back_as_it_was(spark):
    """Special characters, missing elements, leading zeros, one debtor and several."""
    from strata.plans import reports as R
    rows = [(1, "001", "A & <B>", 'say "x"', None, "it's", "1 - A", D("10.50"), 2, 1),
            (1, "002", "", "b", "a@b.c", None, "2 - B", D("9.00"), 1, 2), (2, "003", "é漢", "c", "x", "0011", "3 - C", D("0.01"), 3, 1)]
    cols = ["building_id", "dni", "first_name", "last_name", "email", "phone", "unit_label", "total_debt", "open_charges", "rank"]
    df = spark.createDataFrame(rows, "building_id bigint, dni string, first_name string, last_name string, email string, "
                               "phone string, unit_label string, total_debt decimal(18,2), open_charges int, rank int")
    got = R.debtors_from_xml(R.top_debtors_xml(df)).select(*cols).collect()
    # an empty element and a missing one are both no value
    want = {tuple(None if v == "" else v for v in r) for r in rows}
    assert {tuple(None if v == "" else v for v in r) for r in got} == want


def test_a_date_range_reads_its_months_only(spark):
    L = ledger(spark, SF_SMALL)
    df = QUERIES["q_weekly_cash_flow_range"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pay_month" in plan and "pay_month#" in plan
    every = {r.pay_month for r in L.payment_by_month.select("pay_month").distinct().collect()}
    assert len(every) > 60 and "pay_month" not in L.payment.columns
    assert L.payment_by_month.filter("pay_month <> trunc(pay_date, 'month')").isEmpty()


def test_a_run_leaves_nothing_behind(spark):
    """The application's folder, tables and remembered ledgers go; what is asked for next is built again."""
    from strata.plans.catalog import _LEDGERS
    from strata.session import drop_run, path_exists, run_name
    rows = QUERIES["q_statement_units"](spark, SF_SMALL).count()
    folder = shared_dir(spark, "x").rsplit("/x/", 1)[0]
    assert folder.endswith(run_name(spark)) and path_exists(spark, folder)
    assert spark.catalog.listTables(pattern=f"{run_name(spark)}_*")
    drop_run(spark)
    assert not path_exists(spark, folder) and not spark.catalog.listTables(pattern=f"{run_name(spark)}_*")
    assert not _LEDGERS
    assert QUERIES["q_statement_units"](spark, SF_SMALL).count() == rows
