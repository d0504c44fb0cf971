"""Late interest (tiered) and prior-balance refresh.

- ``late_interest``: rows with a positive prior balance and ``as_of`` past the first
  due date get bal x (2% + 0.5% per month boundary after the second due date), or a
  flat 2% before it (also when the second due date is missing), capped at 50% of the
  balance; total = ordinary + extraordinary + balance + interest; debt = total -
  received, clamped at 0.
- ``refresh_prior_balance``: the prior balance is the debt of the latest *earlier*
  charge of the same unit with debt > 0 (an as-of lookup), computed with one window
  over the unit's rows (bounded by its building's billing months).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as X
from ..fixed import BASE_RATE, CAP_RATE, INTEREST_INFO, MONTHLY_RATE


def _date(v):
    return _dt.date.fromisoformat(v) if isinstance(v, str) else v


def late_interest(appt: DataFrame, charge: DataFrame, as_of, charge_no=None) -> DataFrame:
    """Affected apportionment rows with recomputed interest, total and debt."""
    d = F.lit(_date(as_of))
    a = appt if charge_no is None else appt.filter(F.col("charge_no") == charge_no)
    a = a.join(charge.select("charge_no", "due1", "due2"), "charge_no")
    a = a.filter((F.col("prior_balance") > 0) & (d > F.col("due1")))
    bal = F.col("prior_balance")
    rate = F.when(d > F.col("due2"), F.lit(BASE_RATE) + F.lit(MONTHLY_RATE) * X.month_boundaries(F.col("due2"), d)) \
        .otherwise(F.lit(BASE_RATE))
    calc = bal * rate
    cap = bal * F.lit(CAP_RATE)
    interest = F.when(calc > cap, cap).otherwise(calc).cast("decimal(12,2)")
    zero = X.dec(0, 12, 2)
    a = a.withColumn("interest", interest)
    total = (F.coalesce("ordinary", zero) + F.coalesce("extraordinary", zero) + bal + F.col("interest")).cast("decimal(12,2)")
    a = a.withColumn("total", total)
    debt = F.greatest(F.col("total") - F.coalesce("received", zero), zero).cast("decimal(12,2)")
    return a.select("charge_no", "unit_id", "prior_balance", "interest", "total", debt.alias("debt"))


def interest_summary(updated: DataFrame) -> DataFrame:
    """COUNT/SUM/AVG/MIN/MAX of the interest > 0 rows (AVG exact, half-up to cents)."""
    r = updated.filter(F.col("interest") > 0)
    g = r.agg(F.count(F.lit(1)).alias("n"), F.sum("interest").alias("s"),
              F.min("interest").alias("mn"), F.max("interest").alias("mx"))
    avg = X.from_cents(X.round_div_half_up(X.wide_cents("s"), F.col("n")), 12)
    return g.select(F.lit(INTEREST_INFO).alias("info"), F.col("n").cast("bigint").alias("total_rows"),
                    F.col("s").cast("decimal(18,2)").alias("total_interest"),
                    F.when(F.col("n") > 0, avg).alias("avg_interest"),
                    F.col("mn").cast("decimal(12,2)").alias("min_interest"),
                    F.col("mx").cast("decimal(12,2)").alias("max_interest"))


def refresh_prior_balance(appt: DataFrame, charge: DataFrame, charge_no=None) -> DataFrame:
    """Prior balance = debt of the latest earlier charge (by generation date) of the same
    unit that still has debt > 0; interest reset to 0; total/debt recomputed."""
    a = appt.join(charge.select("charge_no", "gen_date"), "charge_no")
    w = Window.partitionBy("unit_id").orderBy(F.unix_date("gen_date")).rangeBetween(Window.unboundedPreceding, -1)
    prev = F.last(F.when(F.col("debt") > 0, F.col("debt")), ignorenulls=True).over(w)
    zero = X.dec(0, 12, 2)
    a = a.withColumn("prior_balance", F.coalesce(prev, zero).cast("decimal(12,2)"))
    if charge_no is not None:
        a = a.filter(F.col("charge_no") == charge_no)
    total = (F.coalesce("ordinary", zero) + F.coalesce("extraordinary", zero) + F.col("prior_balance")).cast("decimal(12,2)")
    a = a.withColumn("total", total)
    debt = F.greatest(F.col("total") - F.coalesce("received", zero), zero).cast("decimal(12,2)")
    return a.select("charge_no", "unit_id", "prior_balance", zero.alias("interest"), "total", debt.alias("debt"))


def refresh_balances(appt: DataFrame, charge: DataFrame, as_of, with_interest: bool = True,
                     charge_no=None) -> DataFrame:
    """J-14: refresh prior balances, then (optionally) apply the tiered interest as of
    ``as_of``; rows without interest keep interest 0."""
    r = refresh_prior_balance(appt, charge, charge_no)
    if not with_interest:
        return r
    base = appt.select("charge_no", "unit_id", "pct", "received", "ordinary", "extraordinary").join(
        r.select("charge_no", "unit_id", "prior_balance"), ["charge_no", "unit_id"])
    base = base.select("charge_no", "unit_id", "pct", "prior_balance", "received", X.dec(0, 12, 2).alias("interest"),
                       "ordinary", "extraordinary", X.dec(0, 12, 2).alias("total"), X.dec(0, 12, 2).alias("debt"))
    li = late_interest(base, charge, as_of, charge_no).select("charge_no", "unit_id", F.col("interest").alias("_i"),
                                                              F.col("total").alias("_t"), F.col("debt").alias("_d"))
    out = r.join(li, ["charge_no", "unit_id"], "left")
    return out.select("charge_no", "unit_id", "prior_balance", F.coalesce("_i", "interest").alias("interest"),
                      F.coalesce("_t", "total").alias("total"), F.coalesce("_d", "debt").alias("debt"))
