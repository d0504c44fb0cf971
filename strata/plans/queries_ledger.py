"""Registered ledger queries: charge generation stages (J-15), payment import and
matching (J-17, J-18), interest and balance refresh (J-13, J-14)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..operators import charges as C
from ..operators import interest as I
from ..operators import payments as P
from .. import fixed as FX
from .catalog import query
from .oracle import CATS, cents, es_ar, from_cents, month_name, rdiv, with_ctes

# ---------------------------------------------------------------------------
# J-15 stages


@query("q_unpivot_expenses", with_ctes(
    f"""
SELECT n.n_name AS building_name, {month_name('k.month')} AS mes_raw, k.month, k.year, k.category,
       {es_ar('l.amount')} AS amount_raw, CAST(coalesce(l.amount, 0) AS DECIMAL(18,2)) AS amount
FROM (SELECT building_id, year, month, unnest([{", ".join(f"'{c}'" for c in CATS)}]) AS category
      FROM (SELECT DISTINCT building_id, year, month FROM li_sum) d) k
JOIN nation n ON n.n_nationkey = k.building_id
LEFT JOIN li_sum l ON l.building_id = k.building_id AND l.year = k.year AND l.month = k.month
                  AND l.category = k.category"""))
def q_unpivot_expenses(L):
    """C-17: monthly JSON objects (seven amount keys) -> one row per key, month and
    amount parsed (blank/NULL -> 0)."""
    return L.stage


@query("q_charge_totals", with_ctes("SELECT building_id, year, month, total FROM totals"))
def q_charge_totals(L):
    """D-01/B-14: SUM of positive amounts per building-month (months 1..12)."""
    return L.totals.select(F.col("building_id").cast("bigint").alias("building_id"), "year", "month", "total")


@query("q_charges", with_ctes("SELECT * FROM charge"))
def q_charges(L):
    """Charges per building-month: due days clamped to month end, total clamped."""
    return L.charge


@query("q_apportion_base", with_ctes("SELECT * FROM apportion_base"))
def q_apportion_base(L):
    """C-19: charge x units of its building by floor area (pct rounded to 2 decimals)."""
    return L.apportion_base


@query("q_apportion_final", with_ctes("SELECT * FROM apportion_final"))
def q_apportion_final(L):
    """Real expense totals x rounded pct onto every apportionment row."""
    return L.apportion_final


@query("q_carry_forward", with_ctes("SELECT * FROM apportion_carried"))
def q_carry_forward(L):
    """C-11: previous charge's debt of the same unit + 5% interest (one-step snapshot)."""
    return L.apportion_carried


@query("q_carry_forward_chained", with_ctes("""
WITH RECURSIVE placed AS (
  SELECT a.*, pc.prev_charge_no, row_number() OVER (PARTITION BY a.unit_id ORDER BY a.charge_no) AS i
  FROM apportion_final a JOIN prev_charge pc ON pc.charge_no = a.charge_no),
chain AS (
  SELECT charge_no, unit_id, i, CAST(0 AS DECIMAL(12,2)) AS bal, CAST(0 AS DECIMAL(12,2)) AS int_,
         CAST(coalesce(ordinary, 0) + coalesce(extraordinary, 0) AS DECIMAL(12,2)) AS debt
  FROM placed WHERE i = 1
  UNION ALL
  SELECT charge_no, unit_id, i, bal, int_, CAST(own + bal + int_ AS DECIMAL(12,2))
  FROM (SELECT *, CASE WHEN bal > 0 THEN CAST(bal * 0.05 AS DECIMAL(12,2)) ELSE CAST(0 AS DECIMAL(12,2)) END AS int_
        FROM (SELECT p.charge_no, p.unit_id, p.i, coalesce(p.ordinary, 0) + coalesce(p.extraordinary, 0) AS own,
                     CASE WHEN p.prev_charge_no = c.charge_no THEN c.debt ELSE CAST(0 AS DECIMAL(12,2)) END AS bal
              FROM chain c JOIN placed p ON p.unit_id = c.unit_id AND p.i = c.i + 1) b) t)
SELECT f.charge_no, f.unit_id, f.pct, c.bal AS prior_balance, f.received, c.int_ AS interest, f.ordinary,
       f.extraordinary, c.debt AS total, c.debt AS debt
FROM chain c JOIN apportion_final f ON f.charge_no = c.charge_no AND f.unit_id = c.unit_id"""))
def q_carry_forward_chained(L):
    """C-11/J-15 chained: every charge carries its predecessor's debt with all it carried itself."""
    return C.carry_forward(L.apportion_final, L.charge, chained=True)


IMPORTED_UNTIL = _dt.date(1996, 12, 31)  # months up to this date are in the ledger, the rest is imported


@query("q_incremental_import", with_ctes(f"""
WITH dated AS (SELECT a.charge_no, a.unit_id, a.pct, a.received, a.ordinary, a.extraordinary, a.debt, c.gen_date,
                      lag(c.gen_date) OVER unit_rows AS gen_before, lag(a.debt) OVER unit_rows AS own_before
               FROM apportion_final a JOIN charge c ON c.charge_no = a.charge_no
               WINDOW unit_rows AS (PARTITION BY a.unit_id ORDER BY a.charge_no)),
with_stored AS (SELECT *, lag(own_before) OVER (PARTITION BY unit_id ORDER BY charge_no) AS own_earlier,
                       lag(ordinary) OVER (PARTITION BY unit_id ORDER BY charge_no) AS ord_before,
                       lag(extraordinary) OVER (PARTITION BY unit_id ORDER BY charge_no) AS ext_before FROM dated),
balance AS (
  SELECT *, CAST(CASE WHEN gen_before IS NULL THEN 0 WHEN gen_before > DATE '{IMPORTED_UNTIL}' THEN own_before
                      ELSE coalesce(ord_before, 0) + coalesce(ext_before, 0) + coalesce(own_earlier, 0)
                           + CAST(greatest(coalesce(own_earlier, 0), 0) * 0.05 AS DECIMAL(12,2)) END AS DECIMAL(12,2)) AS bal
  FROM with_stored WHERE gen_date > DATE '{IMPORTED_UNTIL}'),
charged AS (SELECT *, CASE WHEN bal > 0 THEN CAST(bal * 0.05 AS DECIMAL(12,2)) ELSE CAST(0 AS DECIMAL(12,2)) END AS i
            FROM balance)
SELECT charge_no, unit_id, pct, bal AS prior_balance, received, i AS interest, ordinary, extraordinary,
       CAST(coalesce(ordinary, 0) + coalesce(extraordinary, 0) + bal + i AS DECIMAL(12,2)) AS total,
       CAST(coalesce(ordinary, 0) + coalesce(extraordinary, 0) + bal + i AS DECIMAL(12,2)) AS debt
FROM charged"""))
def q_incremental_import(L):
    """C-11/J-15: months up to a date are stored, the others imported on top: the first
    new charge of a building carries the stored (already carried) debt."""
    old = L.charge.filter(F.col("gen_date") <= F.lit(IMPORTED_UNTIL))
    new = L.charge.filter(F.col("gen_date") > F.lit(IMPORTED_UNTIL))
    stored = C.carry_forward(L.apportion_final.join(old.select("charge_no"), "charge_no", "left_semi"), old)
    batch = L.apportion_final.join(new.select("charge_no"), "charge_no", "left_semi")
    return C.carry_forward(batch, new, stored_appt=stored, stored_charge=old)


@query("q_provider_assignment", with_ctes("SELECT * FROM expense_ordinary"))
def q_provider_assignment(L):
    """C-09/B-07: ordinary expense -> provider through the six token rules (equi-join)."""
    return L.expense_ordinary


@query("q_extraordinary", with_ctes("SELECT * FROM expense_extraordinary"))
def q_extraordinary(L):
    """I-05: extraordinary subtype rows with instalment 1 of 1."""
    return L.expense_extraordinary


@query("q_expense_by_type", with_ctes("SELECT * FROM exp_tot"))
def q_expense_by_type(L):
    """D-05: conditional sums per charge (ordinary, extraordinary, all)."""
    return C.expense_totals(L.expense)


@query("q_missing_buildings", with_ctes("""
SELECT count(*) AS missing_count,
       'Los siguientes consorcios no existen en la base de datos: '
       || coalesce(string_agg(name, ', ' ORDER BY name), 'Ninguno identificado') AS message
FROM (SELECT DISTINCT r_name AS name FROM region
      WHERE upper(trim(r_name)) NOT IN (SELECT upper(trim(name)) FROM building)) m"""))
def q_missing_buildings(L):
    """D-09/D-10: building names of an expenses file that do not exist, with the
    one-line error message (DISTINCT + ordered STRING_AGG). The file checked here is
    the monthly expenses file plus one consolidated object per region (regions are
    not buildings)."""
    from ..sources.adapter import regional_expense_rows
    sheet = L.expense_sheet.unionByName(regional_expense_rows(L.spark, L.sf))
    missing = C.missing_buildings(C.stage_expenses(sheet), L.building)
    return missing.agg(
        F.count(F.lit(1)).alias("missing_count"),
        F.concat(F.lit(FX.MISSING_BUILDINGS),
                 F.coalesce(F.expr("listagg(building_name, ', ') within group (order by building_name)"),
                            F.lit(FX.NONE_IDENTIFIED))).alias("message"))


@query("q_missing_building_names", with_ctes("""
SELECT DISTINCT r_name AS building_name FROM region
WHERE upper(trim(r_name)) NOT IN (SELECT upper(trim(name)) FROM building)"""))
def q_missing_building_names(L):
    """D-09: the missing names as rows, however many there are."""
    from ..sources.adapter import regional_expense_rows
    sheet = L.expense_sheet.unionByName(regional_expense_rows(L.spark, L.sf))
    return C.missing_buildings(C.stage_expenses(sheet), L.building)


# ---------------------------------------------------------------------------
# J-17: bank file with the month rule

@query("q_payment_month_match", with_ctes("SELECT * FROM bank_matched"))
def q_payment_month_match(L):
    """C-10/I-03: every bank row with its unit (by account) and the charge of its month."""
    return L.bank_matched.select("source_id", "pay_date", "amount", "account", "unit_id", "charge_no")


@query("q_import_quality", with_ctes("""
SELECT count(*) AS total_rows, count(pay_date) AS with_date,
       count(*) FILTER (WHERE amount IS NOT NULL AND amount > 0) AS with_amount,
       count(unit_id) AS with_unit, count(charge_no) AS with_charge,
       count(*) FILTER (WHERE pay_date IS NOT NULL AND amount IS NOT NULL AND amount > 0
                        AND unit_id IS NOT NULL AND charge_no IS NOT NULL) AS complete_rows
FROM bank_matched"""))
def q_import_quality(L):
    """D-06: completeness profile of the bank file in one pass."""
    return P.quality_profile(L.bank_matched)


PRIOR_IMPORT_END = _dt.date(1998, 1, 1)  # payments before this date came from an earlier import


def _existing(L):
    return L.payment.filter(F.col("pay_date") < F.lit(PRIOR_IMPORT_END))


# A payment is stored if one with its date, amount, account and unit is, and that has its date: before the day or not.
@query("q_new_payments", with_ctes(f"SELECT * FROM payment WHERE pay_date >= DATE '{PRIOR_IMPORT_END}'"))
def q_new_payments(L):
    """C-06/I-01: re-import of the whole bank file over a ledger that already holds the
    earlier import (payments before 1998): only rows not already present are new."""
    return P.new_payments(L.payment, _existing(L))


@query("q_duplicate_payments", with_ctes(f"SELECT * FROM payment WHERE pay_date < DATE '{PRIOR_IMPORT_END}'"))
def q_duplicate_payments(L):
    """C-07: bank rows already present in the ledger (EXISTS)."""
    return P.duplicate_payments(L.payment, _existing(L))


@query("q_apply_payments", with_ctes(f"""
WITH sums AS (SELECT charge_no, unit_id, sum(CASE WHEN pay_date < DATE '{PRIOR_IMPORT_END}' THEN amount END) AS old,
                     sum(CASE WHEN pay_date >= DATE '{PRIOR_IMPORT_END}' THEN amount END) AS new
              FROM payment GROUP BY ALL),
first_import AS (SELECT a.*, p.new, CAST(coalesce(a.received, 0) + coalesce(p.old, 0) AS DECIMAL(12,2)) AS r1,
                        CASE WHEN p.old IS NULL THEN a.debt
                             ELSE greatest(a.total - (coalesce(a.received, 0) + p.old), 0) END AS d1
                 FROM apportion_carried a LEFT JOIN sums p ON p.charge_no = a.charge_no AND p.unit_id = a.unit_id)
SELECT charge_no, unit_id, pct, prior_balance, CAST(r1 + coalesce(new, 0) AS DECIMAL(12,2)) AS received, interest,
       ordinary, extraordinary, total,
       CAST(CASE WHEN new IS NULL THEN d1 ELSE greatest(total - (r1 + new), 0) END AS DECIMAL(12,2)) AS debt
FROM first_import"""))
def q_apply_payments(L):
    """I-02: ledger holding the earlier import, then the re-import applied: only the
    rows accepted by the anti join add to received; debt = max(total - received, 0)."""
    existing = _existing(L)
    return P.apply_payments(L.apportion_carried, existing.unionByName(P.new_payments(L.payment, existing)))


@query("q_payment_summary", with_ctes("""
SELECT 'Resumen final' AS info, (SELECT count(*) FROM payment) AS inserted,
       (SELECT count(*) FROM payment) AS total_in_table,
       (SELECT count(*) FROM apportionment WHERE received > 0) AS apportionments_with_payments"""))
def q_payment_summary(L):
    """C-18: final summary row of scalar subqueries, as one aggregate over a union
    (each source contributes its own counter column; no join)."""
    p = L.payment.select(F.lit(1).alias("_p"), F.lit(0).alias("_r"))
    a = L.apportionment.select(F.lit(0).alias("_p"), F.when(F.col("received") > 0, 1).otherwise(0).alias("_r"))
    return p.unionByName(a).agg(
        F.lit(FX.SUMMARY_INFO).alias("info"), F.sum("_p").cast("bigint").alias("inserted"),
        F.sum("_p").cast("bigint").alias("total_in_table"),
        F.sum("_r").cast("bigint").alias("apportionments_with_payments"))


@query("q_import_sample", with_ctes("""
SELECT source_id, account FROM bank_matched WHERE account IS NOT NULL ORDER BY source_id LIMIT 5"""))
def q_import_sample(L):
    """F-04: the first five parsed rows (TOP 5, ordered by id for determinism)."""
    return L.bank_matched.filter(F.col("account").isNotNull()).select("source_id", "account") \
        .orderBy("source_id").limit(5)


# ---------------------------------------------------------------------------
# J-18: bank file with hashed accounts, FIFO then interval matching


def _hashed(L):
    return P.resolve_unit_by_hash(L.bank_parsed, L.person)


def _fifo(L):
    return P.match_fifo(_hashed(L), L.apportionment, L.charge)


def _fifo_interval(L):
    """FIFO, then the interval rule for the rows FIFO left unmatched, in one pass."""
    return P.match_interval(_fifo(L), L.apportionment, L.charge, only_if_null="charge_fifo") \
        .withColumn("charge_no", F.coalesce("charge_fifo", "charge_interval"))


_HASHED_SQL = """
SELECT b.source_id, b.pay_date, b.amount, b.account, sha256(b.account) AS account_hash, h.unit_id
FROM bank b LEFT JOIN (SELECT sha256(trim(account)) AS account_hash, min(unit_id) AS unit_id FROM person
                       WHERE account IS NOT NULL AND unit_id IS NOT NULL GROUP BY ALL) h
  ON h.account_hash = sha256(b.account)"""

_APPT_DATES = "SELECT a.charge_no, a.unit_id, a.debt, c.gen_date, c.due2 FROM apportionment a JOIN charge c ON c.charge_no = a.charge_no"

_FIFO_SQL = f"""
SELECT h.*, f.charge_no AS charge_fifo
FROM ({_HASHED_SQL}) h
LEFT JOIN (SELECT source_id, charge_no FROM (
             SELECT h.source_id, a.charge_no,
                    row_number() OVER (PARTITION BY h.source_id ORDER BY a.gen_date, a.charge_no) AS rn
             FROM ({_HASHED_SQL}) h JOIN ({_APPT_DATES}) a
               ON a.unit_id = h.unit_id AND a.debt > 0 AND a.gen_date <= h.pay_date) x WHERE rn = 1) f
  ON f.source_id = h.source_id"""

_INTERVAL_SQL = f"""
SELECT source_id, charge_no AS charge_interval FROM (
  SELECT f.source_id, a.charge_no,
         row_number() OVER (PARTITION BY f.source_id ORDER BY a.gen_date DESC, a.charge_no DESC) AS rn
  FROM ({_FIFO_SQL}) f JOIN ({_APPT_DATES}) a
    ON a.unit_id = f.unit_id AND f.pay_date BETWEEN a.gen_date AND coalesce(a.due2, a.gen_date + 30)
  WHERE f.charge_fifo IS NULL AND f.unit_id IS NOT NULL) x WHERE rn = 1"""


@query("q_payment_hash_match", with_ctes(f"SELECT source_id, account_hash, unit_id FROM ({_HASHED_SQL}) h"))
def q_payment_hash_match(L):
    """C-15: account -> unit through SHA-256 of the account (hash equality join)."""
    return _hashed(L).select("source_id", "account_hash", "unit_id")


@query("q_payment_fifo_match", with_ctes(f"""
SELECT source_id, unit_id, pay_date, charge_fifo FROM ({_FIFO_SQL}) f WHERE unit_id IS NOT NULL"""))
def q_payment_fifo_match(L):
    """C-13/F-03: oldest open charge of the unit generated on/before the payment date."""
    return _fifo(L).filter(F.col("unit_id").isNotNull()).select("source_id", "unit_id", "pay_date", "charge_fifo")


@query("q_payment_interval_match", with_ctes(f"""
SELECT f.source_id, f.unit_id, f.pay_date, i.charge_interval
FROM ({_FIFO_SQL}) f LEFT JOIN ({_INTERVAL_SQL}) i ON i.source_id = f.source_id
WHERE f.charge_fifo IS NULL AND f.unit_id IS NOT NULL"""))
def q_payment_interval_match(L):
    """C-14: for payments FIFO left unmatched, the newest charge whose
    [generation, second due date or +30 days] holds the payment date. Both rules in one pass."""
    f = _fifo_interval(L).filter(F.col("charge_fifo").isNull() & F.col("unit_id").isNotNull())
    return f.select("source_id", "unit_id", "pay_date", "charge_interval")


@query("q_payment_running", with_ctes(f"""
WITH paid_in AS (
  SELECT payment_id, unit_id, amount, sum(amount) OVER (PARTITION BY unit_id ORDER BY pay_date, payment_id % {P.SLOTS}, payment_id
                                                        ROWS UNBOUNDED PRECEDING) AS p1 FROM payment),
owed AS (
  SELECT a.unit_id, a.charge_no, a.debt, sum(a.debt) OVER (PARTITION BY a.unit_id ORDER BY c.gen_date, a.charge_no
                                                           ROWS UNBOUNDED PRECEDING) AS d1
  FROM apportion_carried a JOIN charge c ON c.charge_no = a.charge_no WHERE a.debt > 0),
settled AS (
  SELECT p.payment_id, p.unit_id, o.charge_no, least(p.p1, o.d1) - greatest(p.p1 - p.amount, o.d1 - o.debt) AS amount
  FROM paid_in p JOIN owed o ON o.unit_id = p.unit_id AND p.p1 > o.d1 - o.debt AND p.p1 - p.amount < o.d1),
rest AS (
  SELECT p.payment_id, p.unit_id, p.amount - coalesce(s.amount, 0) AS amount
  FROM paid_in p LEFT JOIN (SELECT payment_id, sum(amount) AS amount FROM settled GROUP BY 1) s USING (payment_id))
SELECT payment_id, unit_id, charge_no, CAST(amount AS DECIMAL(30,2)) AS amount FROM settled
UNION ALL SELECT payment_id, unit_id, NULL, CAST(amount AS DECIMAL(30,2)) FROM rest WHERE amount > 0"""))
def q_payment_running(L):
    """C-13/J-18 as a running allocation: payments settle the unit's open charges in turn,
    the debts as they are before any payment."""
    return P.allocate_running(L.payment, L.apportion_carried, L.charge)


@query("q_payment_rejects", with_ctes(f"""
SELECT source_id, pay_date, amount, unit_id, charge_no, reasons FROM (
  SELECT f.source_id, f.pay_date, f.amount, f.unit_id, coalesce(f.charge_fifo, i.charge_interval) AS charge_no,
         concat_ws(',', CASE WHEN f.pay_date IS NULL THEN 'INVALID_DATE' END,
                        CASE WHEN f.amount IS NULL OR NOT (f.amount > 0) THEN 'INVALID_AMOUNT' END,
                        CASE WHEN f.unit_id IS NULL THEN 'UNKNOWN_ACCOUNT' END,
                        CASE WHEN coalesce(f.charge_fifo, i.charge_interval) IS NULL THEN 'NO_CHARGE' END,
                        CASE WHEN f.account IS NULL OR f.account = '' THEN 'NO_ACCOUNT' END) AS reasons
  FROM ({_FIFO_SQL}) f LEFT JOIN ({_INTERVAL_SQL}) i ON i.source_id = f.source_id) r
WHERE reasons <> ''"""))
def q_payment_rejects(L):
    """B-11: rows failing the completeness rules, each with its reason codes."""
    _, rejected = P.split_accepted(_fifo_interval(L), require_account=True)
    return rejected.select("source_id", "pay_date", "amount", "unit_id", "charge_no", "reasons")


# ---------------------------------------------------------------------------
# J-13 / J-14

INTEREST_AS_OF = _dt.date(2003, 3, 15)  # calculation date: every charge is past due, early ones hit the cap


def _late_sql(as_of: _dt.date, rows: str = "apportionment") -> str:
    d = f"DATE '{as_of}'"
    calc = (f"(a.prior_balance * CASE WHEN {d} > c.due2 THEN 0.02 + 0.005 * "
            f"((year({d}) * 12 + month({d})) - (year(c.due2) * 12 + month(c.due2))) ELSE 0.02 END)")
    cap = "(a.prior_balance * 0.50)"
    return f"""
SELECT charge_no, unit_id, prior_balance, interest, total,
       CAST(greatest(total - coalesce(received, 0), 0) AS DECIMAL(12,2)) AS debt
FROM (SELECT a.charge_no, a.unit_id, a.prior_balance, a.received, i.interest,
             CAST(coalesce(a.ordinary, 0) + coalesce(a.extraordinary, 0) + a.prior_balance + i.interest
                  AS DECIMAL(12,2)) AS total
      FROM {rows} a JOIN charge c ON c.charge_no = a.charge_no,
      LATERAL (SELECT CAST(CASE WHEN {calc} > {cap} THEN {cap} ELSE {calc} END AS DECIMAL(12,2)) AS interest) i
      WHERE a.prior_balance > 0 AND {d} > c.due1) x"""


@query("q_late_interest", with_ctes(_late_sql(INTEREST_AS_OF)))
def q_late_interest(L):
    """J-13: tiered late interest on every charge's rows as of the calculation date."""
    return I.late_interest(L.apportionment, L.charge, INTEREST_AS_OF)


@query("q_interest_summary", with_ctes(f"""
SELECT 'INTERESES CALCULADOS' AS info, CAST(count(*) AS BIGINT) AS total_rows,
       CAST(sum(interest) AS DECIMAL(18,2)) AS total_interest,
       CASE WHEN count(*) > 0 THEN {from_cents(rdiv(cents('sum(interest)'), 'count(*)'))} END AS avg_interest,
       CAST(min(interest) AS DECIMAL(12,2)) AS min_interest, CAST(max(interest) AS DECIMAL(12,2)) AS max_interest
FROM ({_late_sql(INTEREST_AS_OF)}) u WHERE interest > 0"""))
def q_interest_summary(L):
    """D-07: COUNT/SUM/AVG/MIN/MAX of the calculated interest."""
    return I.interest_summary(I.late_interest(L.apportionment, L.charge, INTEREST_AS_OF))


_PRIOR_SQL = """
SELECT a.charge_no, a.unit_id, CAST(coalesce(p.debt, 0) AS DECIMAL(12,2)) AS prior_balance,
       CAST(0 AS DECIMAL(12,2)) AS interest,
       CAST(coalesce(a.ordinary, 0) + coalesce(a.extraordinary, 0) + coalesce(p.debt, 0) AS DECIMAL(12,2)) AS total,
       CAST(greatest(coalesce(a.ordinary, 0) + coalesce(a.extraordinary, 0) + coalesce(p.debt, 0)
                     - coalesce(a.received, 0), 0) AS DECIMAL(12,2)) AS debt
FROM (SELECT a.*, c.gen_date FROM apportionment a JOIN charge c ON c.charge_no = a.charge_no) a
LEFT JOIN (SELECT charge_no, unit_id, debt FROM (
             SELECT a.charge_no, a.unit_id, b.debt,
                    row_number() OVER (PARTITION BY a.charge_no, a.unit_id ORDER BY b.gen_date DESC) AS rn
             FROM (SELECT a.*, c.gen_date FROM apportionment a JOIN charge c ON c.charge_no = a.charge_no) a
             JOIN (SELECT a.*, c.gen_date FROM apportionment a JOIN charge c ON c.charge_no = a.charge_no) b
               ON b.unit_id = a.unit_id AND b.gen_date < a.gen_date AND b.debt > 0) x WHERE rn = 1) p
  ON p.charge_no = a.charge_no AND p.unit_id = a.unit_id"""


@query("q_prior_balance_asof", with_ctes(_PRIOR_SQL))
def q_prior_balance_asof(L):
    """C-12/J-14: prior balance from the latest earlier charge of the unit with debt."""
    return I.refresh_prior_balance(L.apportionment, L.charge)


@query("q_refresh_balances", with_ctes(f"""
WITH dated AS (SELECT a.charge_no, a.unit_id, a.received, a.ordinary, a.extraordinary, a.debt, c.gen_date
               FROM apportionment a JOIN charge c ON c.charge_no = a.charge_no),
owed AS (SELECT unit_id, gen_date, debt FROM dated WHERE debt > 0),
refreshed AS (
  SELECT d.charge_no, d.unit_id, d.received, d.ordinary, d.extraordinary,
         CAST(coalesce(p.debt, 0) AS DECIMAL(12,2)) AS prior_balance,
         CAST(coalesce(d.ordinary, 0) + coalesce(d.extraordinary, 0) + coalesce(p.debt, 0) AS DECIMAL(12,2)) AS total0
  FROM dated d ASOF LEFT JOIN owed p ON p.unit_id = d.unit_id AND d.gen_date > p.gen_date),
late AS ({_late_sql(INTEREST_AS_OF, "refreshed")})
SELECT r.charge_no, r.unit_id, r.prior_balance, coalesce(l.interest, CAST(0 AS DECIMAL(12,2))) AS interest,
       coalesce(l.total, r.total0) AS total,
       coalesce(l.debt, CAST(greatest(r.total0 - coalesce(r.received, 0), 0) AS DECIMAL(12,2))) AS debt
FROM refreshed r LEFT JOIN late l ON l.charge_no = r.charge_no AND l.unit_id = r.unit_id"""))
def q_refresh_balances(L):
    """J-14: prior balances refreshed from the latest earlier debt, then the tiered late
    interest on them as of the calculation date."""
    return I.refresh_balances(L.apportionment, L.charge, INTEREST_AS_OF)
