"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Protocol: one warm-up pass over every query, then the median of ``BENCH_REPS`` timed
runs per query; each run forces full execution with a ``noop`` write (no collect).
Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.

Two phases are timed:
- ``ledger_build``: the imports (expenses file -> charges/apportionment/expenses,
  bank file -> payments -> balances) written as the ledger tables (warm-up build,
  then the median of ``BENCH_REPS`` builds);
- every report/matcher query afterwards reads those stored tables, as the reference's
  reports read its database (``Ledger.stored``).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.operators import charges as C  # noqa: E402
from strata.plans.catalog import QUERIES  # noqa: E402
from strata.session import local_session  # noqa: E402
from strata.sources.adapter import Ledger  # noqa: E402

HEADLINE = [
    "q_weekly_cash_flow", "q_monthly_pivot", "q_income_by_source", "q_top_debtors", "q_days_between_payments",
    "q_apportion_final", "q_carry_forward", "q_payment_fifo_match", "q_payment_interval_match",
    "q_late_interest", "q_prior_balance_asof", "q_statement_units", "q_statement_totals",
    "q_validate_apportionments", "q_apply_payments",
]


def _sf_of(path: str) -> str:
    m = re.search(r"sf([0-9.]+)", path)
    return m.group(1) if m else path


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    shuffle = os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, int(cpus) * 2)))
    spark = local_session(cores=cpus, shuffle_partitions=int(shuffle), app="strata-bench")

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    # phase 1: build and store the ledger (one warm-up build, then the median of `reps` timed builds)
    Ledger(spark, sf_dir).materialize()
    builds = []
    for _ in range(reps):
        t0 = time.perf_counter()
        stored = Ledger(spark, sf_dir).materialize()
        builds.append(time.perf_counter() - t0)
    build = statistics.median(builds)

    from strata.plans import catalog
    catalog._LEDGERS[catalog.ledger_key(spark, sf_dir, True)] = stored

    times: dict[str, float] = {"ledger_build": round(build, 3)}
    for n in names:  # warm-up
        run(QUERIES[n](spark, sf_dir))
    for n in names:
        samples = []
        for _ in range(reps):
            t = time.perf_counter()
            run(QUERIES[n](spark, sf_dir))
            samples.append(time.perf_counter() - t)
        times[n] = round(statistics.median(samples), 3)
    total = round(sum(times.values()), 3)

    # q_apportion_final and q_carry_forward read a finished table; here are the operators over the stored inputs
    operators = {}
    for n, make in (("apportion_final", lambda: C.apportion_final(C.apportion_base(stored.charge, stored.unit),
                                                                  C.expense_totals(stored.expense))),
                    ("carry_forward", lambda: C.carry_forward(stored.apportion_final, stored.charge))):
        samples = []
        for _ in range(reps):
            t = time.perf_counter()
            run(make())
            samples.append(time.perf_counter() - t)
        operators[n] = round(statistics.median(samples), 3)
    print(json.dumps({"metric": "total_median_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": _sf_of(sf_dir), "cpus": int(cpus), "reps": reps, "operators": operators}))
    spark.stop()


if __name__ == "__main__":
    main()
