"""Bank payments: parse, resolve account -> unit -> charge, validate, apply.

Matchers never fan out: each candidate set is reduced to one charge per key with an
aggregate (``min_by``/``max_by``) *before* it meets the payments, so the payment
count in equals the payment count out.

Scale notes
- FIFO ("oldest open charge generated on/before the payment"): the earliest open
  charge per unit is one grouped aggregate (partial aggregation on the map side), then
  an equi-join on unit and one comparison. No range join and no per-unit window.
- Interval ("payment date within [generation, second due or +30 days]", newest wins):
  a unit's intervals (one a billing month) are one array; a payment looks its date up
  there. One equi-join on unit; the payments are neither multiplied nor grouped again.
- Running allocation: prefix sums of payments and of open debts for each unit, taken
  in two steps so that a unit with very many payments is split over days and slots,
  then a join of the two sequences of stretches where they overlap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as X
from ..fixed import FALLBACK_DUE_DAYS


def parse_bank_file(raw: DataFrame, row_key: bool = True) -> DataFrame:
    """Raw text columns (id, fecha, CVU_CBU, valor) -> typed staging rows.

    ``row_key`` tells the file's rows apart whatever their id says (repeated, blank or
    not a number); it is assigned where the file is read, before any shuffle. A stream has none.
    """
    key = [F.monotonically_increasing_id().alias("row_key")] if row_key else []
    return raw.select(
        *key,
        F.trim("id").try_cast("bigint").alias("source_id"),
        F.col("fecha").alias("date_text"),
        X.parse_dmy("fecha").alias("pay_date"),
        F.trim(F.col("CVU_CBU")).alias("account"),
        F.col("valor").alias("amount_text"),
        X.parse_money("valor").alias("amount"),
    )


def resolve_unit_by_account(staged: DataFrame, person: DataFrame) -> DataFrame:
    """Plain account equality (one unit per account: the first person's unit)."""
    acc = person.filter(F.col("account").isNotNull() & F.col("unit_id").isNotNull()) \
        .groupBy(F.trim("account").alias("account")).agg(F.min("unit_id").alias("unit_id"))
    return staged.join(acc, "account", "left")


def resolve_unit_by_hash(staged: DataFrame, person: DataFrame) -> DataFrame:
    """Account matched through its SHA-256 (the stored side keeps only the hash)."""
    acc = person.filter(F.col("account").isNotNull() & F.col("unit_id").isNotNull()) \
        .groupBy(X.sha256_hex(F.trim("account")).alias("account_hash")).agg(F.min("unit_id").alias("unit_id"))
    s = staged.withColumn("account_hash", X.sha256_hex(F.col("account")))
    return s.join(acc, "account_hash", "left")


def with_charge_dates(appt: DataFrame, charge: DataFrame) -> DataFrame:
    return appt.join(charge.select("charge_no", "gen_date", "due1", "due2"), "charge_no")


# ---------------------------------------------------------------------------
def month_candidates(appt: DataFrame, charge: DataFrame) -> DataFrame:
    """One charge per (unit, month) with an apportionment: the smallest (deterministic
    where the reference would pick an arbitrary one)."""
    return (with_charge_dates(appt.select("charge_no", "unit_id"), charge)
            .groupBy("unit_id", X.month_start("gen_date").alias("_m"))
            .agg(F.min("charge_no").alias("charge_no")))


def match_by_month(payments: DataFrame, appt: DataFrame, charge: DataFrame,
                   candidates: DataFrame | None = None) -> DataFrame:
    """Charge of the payment's calendar month that has an apportionment for the unit."""
    cand = month_candidates(appt, charge) if candidates is None else candidates
    p = payments.withColumn("_m", X.month_start("pay_date"))
    return p.join(cand, ["unit_id", "_m"], "left").drop("_m")


def match_fifo(payments: DataFrame, appt: DataFrame, charge: DataFrame) -> DataFrame:
    """Oldest open charge (debt > 0) of the unit generated on/before the payment date."""
    open_ = with_charge_dates(appt.filter(F.col("debt") > 0).select("charge_no", "unit_id"), charge)
    oldest = open_.groupBy("unit_id").agg(
        F.min("gen_date").alias("_gen"),
        F.min_by("charge_no", F.struct("gen_date", "charge_no")).alias("_no"))
    p = payments.join(oldest, "unit_id", "left")
    return p.withColumn("charge_fifo", F.when(F.col("_gen") <= F.col("pay_date"), F.col("_no"))).drop("_gen", "_no")


def match_interval(payments: DataFrame, appt: DataFrame, charge: DataFrame, key: str = "row_key",
                   only_if_null: str | None = None) -> DataFrame:
    """Newest charge of the unit whose [gen, COALESCE(due2, gen+30)] holds the payment date.

    A unit's intervals, bounded by its building's billing months, are gathered into one array; every payment
    finds the newest that holds its date in it. The payments meet one row a unit (which AQE repeats where a unit
    is hot), so rows stay what they are, whatever their ids (``key`` is no longer needed to tell them apart).
    ``only_if_null`` names a column: rows where it is set get no interval match.
    """
    spans = with_charge_dates(appt.select("charge_no", "unit_id"), charge).groupBy(F.col("unit_id").alias("_cu")).agg(
        F.collect_list(F.struct(F.col("gen_date").alias("gen"), F.col("charge_no").alias("no"),
                                F.coalesce("due2", F.date_add("gen_date", FALLBACK_DUE_DAYS)).alias("end"))).alias("_spans"))
    day = F.col("pay_date")
    newest = F.array_max(F.filter("_spans", lambda x: day.between(x["gen"], x["end"])))["no"]
    if only_if_null is not None:
        newest = F.when(F.col(only_if_null).isNull(), newest)
    j = payments.join(spans, payments["unit_id"] == spans["_cu"], "left")
    return j.withColumn("charge_interval", newest).select(*payments.columns, "charge_interval")


# ---------------------------------------------------------------------------
SLOTS = 16  # a day's payments of one unit are summed in so many slots (payment id modulo SLOTS)


def allocate_running(payments: DataFrame, appt: DataFrame, charge: DataFrame) -> DataFrame:
    """Payments settle a unit's open charges one after the other (oldest first, by charge number where the date is
    the same): a payment may settle several, a charge may take several, and what is paid ahead is credit for later ones.

    An option beside the snapshot matcher, which gives a payment to one charge. Payments are in the order of
    (date, payment id modulo SLOTS, payment id). Returns (payment_id, unit_id, charge_no, amount): ``amount`` of the
    payment goes to the charge; a row without a charge has what no charge takes. The amounts of a payment add up to it.
    """
    zero = X.dec(0, 30, 2)
    slot = F.pmod(F.col("payment_id"), F.lit(SLOTS))
    p = payments.filter((F.col("amount") > 0) & F.col("unit_id").isNotNull()) \
        .select("payment_id", "unit_id", "pay_date", slot.alias("_slot"), F.col("amount").cast("decimal(30,2)").alias("_a"))
    by_slot = p.groupBy("unit_id", "pay_date", "_slot").agg(F.sum("_a").cast("decimal(30,2)").alias("_s"))
    earlier = Window.partitionBy("unit_id").orderBy("pay_date", "_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = by_slot.select("unit_id", "pay_date", "_slot", F.coalesce(F.sum("_s").over(earlier), zero).alias("_before"))
    inside = Window.partitionBy("unit_id", "pay_date", "_slot").orderBy("payment_id").rowsBetween(Window.unboundedPreceding, -1)
    p = p.join(slots, ["unit_id", "pay_date", "_slot"]) \
        .withColumn("_from", (F.col("_before") + F.coalesce(F.sum("_a").over(inside), zero)).cast("decimal(30,2)"))
    p = p.select("payment_id", "unit_id", "_from", (F.col("_from") + F.col("_a")).cast("decimal(30,2)").alias("_to"))
    owed = with_charge_dates(appt.filter(F.col("debt") > 0).select("charge_no", "unit_id", "debt"), charge)
    upto = Window.partitionBy("unit_id").orderBy("gen_date", "charge_no").rowsBetween(Window.unboundedPreceding, 0)
    owed = owed.withColumn("_d1", F.sum("debt").over(upto).cast("decimal(30,2)")) \
        .select(F.col("unit_id").alias("_du"), "charge_no", (F.col("_d1") - F.col("debt")).cast("decimal(30,2)").alias("_d0"), "_d1")
    # beyond the last debt lies a stretch without end that no charge takes
    open_end = owed.groupBy("_du").agg(F.max("_d1").alias("_d0")).select(
        "_du", F.lit(None).cast(owed.schema["charge_no"].dataType).alias("charge_no"), "_d0",
        F.lit(None).cast("decimal(30,2)").alias("_d1"))
    stretches = owed.unionByName(open_end)
    j = p.join(stretches, (p["unit_id"] == stretches["_du"]) & (p["_to"] > stretches["_d0"])
               & (stretches["_d1"].isNull() | (p["_from"] < stretches["_d1"])), "left")
    high = F.least("_to", F.coalesce("_d1", "_to"))
    low = F.greatest("_from", F.coalesce("_d0", "_from"))
    return j.select("payment_id", "unit_id", "charge_no", (high - low).cast("decimal(30,2)").alias("amount"))


# ---------------------------------------------------------------------------
def quality_profile(matched: DataFrame) -> DataFrame:
    """COUNT(*) and one COUNT_IF per completeness rule (one pass)."""
    complete = (F.col("pay_date").isNotNull() & F.col("amount").isNotNull() & (F.col("amount") > 0)
                & F.col("unit_id").isNotNull() & F.col("charge_no").isNotNull())
    return matched.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("pay_date").isNotNull()).alias("with_date"),
        F.count_if(F.col("amount").isNotNull() & (F.col("amount") > 0)).alias("with_amount"),
        F.count_if(F.col("unit_id").isNotNull()).alias("with_unit"),
        F.count_if(F.col("charge_no").isNotNull()).alias("with_charge"),
        F.count_if(complete).alias("complete_rows"),
    )


def reject_reasons(matched: DataFrame, require_account: bool = False) -> F.Column:
    """Comma-separated reasons; empty string = accepted. The hashed import
    (``require_account``) takes ids as numbers, so an id that is none is a reason."""
    rules = [(F.col("source_id").isNull(), "INVALID_ID")] if require_account else []
    rules += [
        (F.col("pay_date").isNull(), "INVALID_DATE"),
        (F.col("amount").isNull() | ~(F.col("amount") > 0), "INVALID_AMOUNT"),
        (F.col("unit_id").isNull(), "UNKNOWN_ACCOUNT"),
        (F.col("charge_no").isNull(), "NO_CHARGE"),
    ]
    if require_account:
        rules.append((F.col("account").isNull() | (F.col("account") == ""), "NO_ACCOUNT"))
    return F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, r in rules])), ",")


def split_accepted(matched: DataFrame, require_account: bool = False):
    r = matched.withColumn("reasons", reject_reasons(matched, require_account))
    return r.filter(F.col("reasons") == "").drop("reasons"), r.filter(F.col("reasons") != "")


def as_payment_rows(accepted: DataFrame) -> DataFrame:
    return accepted.select(
        F.col("source_id").alias("payment_id"), "pay_date", F.col("amount").cast("decimal(12,2)").alias("amount"),
        "account", "unit_id", "charge_no")


def numbered(rows: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The rows with generated payment ids that continue after the stored ones: two bank
    files may use the same ids. ``source_id`` keeps the file's own."""
    from .keys import next_ids, surrogate_keys

    own = rows.withColumnRenamed("payment_id", "source_id")
    order = ["pay_date", "account", "source_id", "unit_id", "charge_no", "amount"]
    keyed = own.withColumn("_tie", F.monotonically_increasing_id())
    if existing is None:
        out = surrogate_keys(keyed, [*order, "_tie"], "payment_id")
    else:
        out = next_ids(keyed, existing, "payment_id", [*order, "_tie"], "payment_id")
    return out.select("payment_id", *order[:1], "amount", "account", "unit_id", "charge_no", "source_id")


DUP_KEY = ["pay_date", "amount", "account", "unit_id"]


def new_payments(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """Insert-if-absent on (date, amount, account, unit) (NOT EXISTS)."""
    return batch.join(existing.select(*DUP_KEY), DUP_KEY, "left_anti")


def duplicate_payments(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """Batch rows already present (EXISTS)."""
    return batch.join(existing.select(*DUP_KEY), DUP_KEY, "left_semi")


def apply_payments(appt: DataFrame, payments: DataFrame) -> DataFrame:
    """received += SUM(paid) per (charge, unit); debt = max(total - received, 0).

    Payments are pre-aggregated per (charge, unit) (map-side partial aggregation), so
    the join with the apportionment is one-to-one.
    """
    paid = payments.groupBy("charge_no", "unit_id").agg(F.sum("amount").alias("_paid"))
    a = appt.join(paid, ["charge_no", "unit_id"], "left")
    zero = X.dec(0, 12, 2)
    received = (F.coalesce("received", zero) + F.coalesce("_paid", zero)).cast("decimal(12,2)")
    left_ = F.col("total") - received
    debt = F.when(F.col("_paid").isNull(), F.col("debt")).otherwise(
        F.when(left_ < 0, zero).otherwise(left_)).cast("decimal(12,2)")
    return a.select("charge_no", "unit_id", "pct", "prior_balance", received.alias("received"), "interest",
                    "ordinary", "extraordinary", "total", debt.alias("debt"))


# ---------------------------------------------------------------------------
# J-17 / J-18: the whole bank import as one call
def import_payments(bank_rows: DataFrame, person: DataFrame, appt: DataFrame, charge: DataFrame,
                    existing: DataFrame | None = None, match: str = "month") -> dict[str, DataFrame]:
    """Bank text rows -> accepted payments (insert-if-absent), rejects with reasons,
    quality profile and the updated apportionment.

    ``match='month'``: account equality, charge of the payment's month.
    ``match='fifo'``: account hash, oldest open charge, else the interval rule.
    """
    staged = parse_bank_file(bank_rows)
    if match == "month":
        matched = match_by_month(resolve_unit_by_account(staged, person), appt, charge)
        require_account = False
    elif match == "fifo":
        f = match_fifo(resolve_unit_by_hash(staged, person), appt, charge)
        matched = match_interval(f, appt, charge, only_if_null="charge_fifo") \
            .withColumn("charge_no", F.coalesce("charge_fifo", "charge_interval"))
        require_account = True
    else:
        raise ValueError("match must be 'month' or 'fifo'")
    accepted, rejected = split_accepted(matched, require_account)
    rows = as_payment_rows(accepted)
    new = numbered(rows if existing is None else new_payments(rows, existing), existing)
    # D-13 row counters (@@ROWCOUNT) without a second pass: filled by whatever action
    # writes the inserted payments
    from pyspark.sql import Observation
    counters = Observation(f"payments_{match}")
    new = new.observe(counters, F.count(F.lit(1)).alias("inserted"),
                      F.coalesce(F.sum("amount"), F.lit(0)).alias("inserted_amount"))
    return {"matched": matched, "quality": quality_profile(matched), "payments": new, "rejected": rejected,
            "apportionment": apply_payments(appt, new), "counters": counters}
