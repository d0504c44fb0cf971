"""Validated appends: the reference's single-row insert procedures, as one batch
operator per table.

``validate(batch, rules, key, order, existing, parents)`` returns every batch row with
``status`` ('ACCEPTED' / 'REJECTED') and ``reasons`` (comma-separated codes, empty
when accepted). Foreign-key rules are left joins against the referenced tables (each
reduced to its distinct keys first). Uniqueness is checked against the stored table
(``existing``) and inside the batch: the first row of a key (by ``order``) may pass,
the others get DUPLICATE_KEY. One aggregate over batch and stored keys finds both
(``keyed_rows``); it is partial, so a heavily repeated key is never gathered in one task.
Text keys compare as the database compares them (``functions.ci``): case does not count.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import functions as X
from ..fixed import KIND_EXTRAORDINARY, KIND_ORDINARY, ROLE_OWNER, ROLE_TENANT


def _date(v):
    return _dt.date.fromisoformat(v) if isinstance(v, str) else v


def compared(df: DataFrame, c: str) -> Column:
    """A key column as the database compares it."""
    return X.ci(c) if isinstance(df.schema[c].dataType, StringType) else F.col(c)


def exists_in(df: DataFrame, ref: DataFrame, left_cols: list[str], right_cols: list[str], flag: str) -> DataFrame:
    """Add boolean ``flag``: the row's key exists in ``ref`` (left join on distinct keys)."""
    r = ref.select(*[compared(ref, c).alias(f"_r{i}") for i, c in enumerate(right_cols)]).distinct() \
        .withColumn(flag, F.lit(True))
    cond = [compared(df, lc) == r[f"_r{i}"] for i, lc in enumerate(left_cols)]
    out = df.join(r, cond, "left")
    return out.drop(*[f"_r{i}" for i in range(len(right_cols))]).withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def keyed_rows(df: DataFrame, key: list[str], order: list[str], existing: DataFrame | None = None,
               flag: str = "_first", stored: str = "_stored") -> DataFrame:
    """Mark one row of each key, the first by ``order`` (ties: by all columns), and whether
    ``existing`` holds the key.

    One aggregate over the batch's rows and the stored keys gives each key its number of rows, whether it is stored, and
    for a key that comes once its row. Only rows of keys that repeat are looked up again: equal rows are grouped, the
    smallest of each key is found, and all are dealt out, so exactly one row is first. A NULL in a key is no repeat, and
    stored nowhere.
    """
    cols, names = df.columns, [f"_k{i}" for i in range(len(key))]
    every = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in cols if c not in order])
    keyed = df.select(*cols, *[compared(df, c).alias(n) for c, n in zip(key, names)])
    whole = F.lit(True)
    for n in names:
        whole = whole & F.col(n).isNotNull()
    own = keyed.filter(whole).withColumns({"_own": F.lit(1), stored: F.lit(False)})
    if existing is not None:
        old = existing.select(*[compared(existing, c).alias(n) for c, n in zip(key, names)])
        old = old.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema], *names,
                         F.lit(0).alias("_own"), F.lit(True).alias(stored))
        own = own.unionByName(old)
    mine = F.col("_own") == 1
    keys = own.groupBy(*names).agg(F.sum("_own").alias("_n"), F.max(stored).alias(stored),
                                   *[F.max(F.when(mine, F.col(c))).alias(f"_c{i}") for i, c in enumerate(cols)])
    once = keys.filter(F.col("_n") == 1).select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(cols)],
                                                F.lit(True).alias(flag), F.col(stored))
    repeated = keys.filter(F.col("_n") > 1).select(*[F.col(n).alias(f"_r{i}") for i, n in enumerate(names)], stored)
    by = [f"_r{i}" for i in range(len(names))]
    groups = keyed.filter(whole).join(repeated, [F.col(n) == F.col(r) for n, r in zip(names, by)]) \
        .groupBy(*by, *cols, stored).agg(F.count(F.lit(1)).alias("_m"))
    least = groups.groupBy(*by).agg(F.min(every).alias("_least"))
    copies = groups.join(least, by).withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_m"))))
    out = once.unionByName(copies.select(
        *cols, ((F.col("_i") == 1) & every.eqNullSafe(F.col("_least"))).alias(flag), stored))
    if any(keyed.schema[n].nullable for n in names):
        out = out.unionByName(keyed.filter(~whole).select(*cols, F.lit(True).alias(flag), F.lit(False).alias(stored)))
    return out


def first_of_key(df: DataFrame, key: list[str], order: list[str], flag: str = "_first") -> DataFrame:
    """Mark one row of each key, the first by ``order`` (``keyed_rows`` without stored keys)."""
    return keyed_rows(df, key, order, flag=flag).drop("_stored")


Parent = tuple[DataFrame, list[str], list[str], str]  # referenced table, batch columns, its columns, flag


def validate(batch: DataFrame, rules: list[tuple[Column, str]], key: list[str] | None = None,
             order: list[str] | None = None, existing: DataFrame | None = None,
             parents: list[Parent] | tuple = ()) -> DataFrame:
    df = batch
    extra: list[tuple[Column, str]] = []
    if key:
        df = keyed_rows(df, key, order or key, existing)
        if existing is not None:
            extra.append((F.col("_stored"), "ALREADY_EXISTS"))
        extra.append((~F.col("_first"), "DUPLICATE_KEY"))
    for parent in parents:
        df = exists_in(df, *parent)
    all_rules = list(rules) + extra
    reasons = F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(code)) for c, code in all_rules])), ",")
    df = df.withColumn("reasons", reasons)
    df = df.withColumn("status", F.when(F.col("reasons") == "", "ACCEPTED").otherwise("REJECTED"))
    return df.drop("_stored", "_first", *[p[3] for p in parents])


# ---------------------------------------------------------------------------
def _blank_or_longer(c: str, n: int) -> Column:
    return (F.coalesce(F.col(c), F.lit("")) == "") | (X.tsql_len(c) > n)


def _present(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


def validate_buildings(batch: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    rules = [
        (_blank_or_longer("name", 40), "NAME_LENGTH"),
        (_blank_or_longer("address", 100), "ADDRESS_LENGTH"),
        (F.col("area").isNull() | (F.col("area") <= 0), "INVALID_AREA"),
        (F.col("unit_count").isNull() | (F.col("unit_count") <= 0), "INVALID_UNIT_COUNT"),
        (F.col("fee_first").isNull() | (F.col("fee_first") < 0), "INVALID_FEE_FIRST"),
        (F.col("fee_next").isNull() | (F.col("fee_next") < 0), "INVALID_FEE_NEXT"),
    ]
    return validate(batch, rules, ["name", "address"], ["name", "address", "building_id"], existing)


def validate_units(batch: DataFrame, building: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    rules = [
        (~F.col("_b"), "UNKNOWN_BUILDING"),
        (_blank_or_longer("floor", 10), "FLOOR_LENGTH"),
        (_blank_or_longer("door", 10), "DOOR_LENGTH"),
        (F.col("area").isNull() | (F.col("area") <= 0), "INVALID_AREA"),
        (F.col("coef").isNull() | (F.col("coef") <= 0) | (F.col("coef") > 100), "INVALID_COEF"),
    ]
    return validate(batch, rules, ["building_id", "floor", "door"], ["building_id", "floor", "door", "unit_id"],
                    existing, [(building, ["building_id"], ["building_id"], "_b")])


def validate_people(batch: DataFrame, unit: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    rules = [
        ((F.coalesce(F.col("dni"), F.lit("")) == "") | F.col("dni").rlike("[^0-9]") | (X.tsql_len("dni") > 10),
         "INVALID_DNI"),
        (_blank_or_longer("first_name", 30) | F.col("first_name").rlike("[^a-zA-Z ]"), "INVALID_FIRST_NAME"),
        (_blank_or_longer("last_name", 30) | F.col("last_name").rlike("[^a-zA-Z ]"), "INVALID_LAST_NAME"),
        (_present("email") & (~F.col("email").like("%@%.%") | (X.tsql_len("email") > 40)), "INVALID_EMAIL"),
        (_present("phone") & (F.col("phone").rlike("[^0-9]") | (X.tsql_len("phone") > 15)), "INVALID_PHONE"),
        (_present("account") & (F.col("account").rlike("[^0-9]") | (X.tsql_len("account") != 22)), "INVALID_ACCOUNT"),
        (F.col("unit_id").isNotNull() & ~F.col("_u"), "UNKNOWN_UNIT"),
    ]
    return validate(batch, rules, ["dni"], ["dni", "account"], existing, [(unit, ["unit_id"], ["unit_id"], "_u")])


def validate_occupancy(batch: DataFrame, unit: DataFrame, person: DataFrame) -> DataFrame:
    rules = [
        (~F.col("_u"), "UNKNOWN_UNIT"),
        (~F.col("_p"), "UNKNOWN_PERSON"),
        (~F.coalesce(F.col("role").isin(ROLE_OWNER, ROLE_TENANT), F.lit(False)), "INVALID_ROLE"),
    ]
    return validate(batch, rules, parents=[(unit, ["unit_id"], ["unit_id"], "_u"), (person, ["dni"], ["dni"], "_p")])


def validate_sized(batch: DataFrame, unit: DataFrame) -> DataFrame:
    """Storage rooms and parking spaces: unit exists, size > 0."""
    rules = [(~F.col("_u"), "UNKNOWN_UNIT"), (F.col("size").isNull() | (F.col("size") <= 0), "INVALID_SIZE")]
    return validate(batch, rules, parents=[(unit, ["unit_id"], ["unit_id"], "_u")])


def validate_charges(batch: DataFrame, building: DataFrame, as_of) -> DataFrame:
    d = F.lit(_date(as_of))
    rules = [
        (~F.col("_b"), "UNKNOWN_BUILDING"),
        (F.col("gen_date").isNull() | (F.col("gen_date") > d), "INVALID_GEN_DATE"),
        (F.col("due1").isNotNull() & (F.col("due1") <= F.col("gen_date")), "INVALID_DUE1"),
        (F.col("due2").isNotNull() & F.col("due1").isNotNull() & (F.col("due2") <= F.col("due1")), "INVALID_DUE2"),
        (F.col("total").isNotNull() & (F.col("total") < 0), "NEGATIVE_TOTAL"),
    ]
    return validate(batch, rules, parents=[(building, ["building_id"], ["building_id"], "_b")])


AMOUNT_COLUMNS = ["prior_balance", "received", "interest", "ordinary", "extraordinary", "total", "debt"]


def validate_apportionments(batch: DataFrame, charge: DataFrame, unit: DataFrame,
                            existing: DataFrame | None = None) -> DataFrame:
    neg = None
    for c in AMOUNT_COLUMNS:
        cond = F.coalesce(F.col(c) < 0, F.lit(False))
        neg = cond if neg is None else (neg | cond)
    rules = [
        (~F.col("_c"), "UNKNOWN_CHARGE"), (~F.col("_u"), "UNKNOWN_UNIT"),
        (F.col("pct").isNull() | (F.col("pct") <= 0) | (F.col("pct") > 100), "INVALID_PCT"),
        (neg, "NEGATIVE_AMOUNT"),
    ]
    return validate(batch, rules, ["charge_no", "unit_id"], ["charge_no", "unit_id"], existing,
                    [(charge, ["charge_no"], ["charge_no"], "_c"), (unit, ["unit_id"], ["unit_id"], "_u")])


def validate_payments(batch: DataFrame, unit: DataFrame, charge: DataFrame, as_of) -> DataFrame:
    d = F.lit(_date(as_of))
    acc = F.col("account")
    rules = [
        (~F.col("_u"), "UNKNOWN_UNIT"), (~F.col("_c"), "UNKNOWN_CHARGE"),
        (F.col("pay_date").isNull() | (F.col("pay_date") > d), "INVALID_DATE"),
        (F.col("amount").isNull() | (F.col("amount") <= 0), "INVALID_AMOUNT"),
        (F.coalesce((acc == "") | (X.tsql_len(acc) != 22) | acc.rlike("[^0-9]"), F.lit(False)), "INVALID_ACCOUNT"),
    ]
    return validate(batch, rules, parents=[(unit, ["unit_id"], ["unit_id"], "_u"),
                                           (charge, ["charge_no"], ["charge_no"], "_c")])


def validate_expenses(batch: DataFrame, charge: DataFrame, building: DataFrame, as_of) -> DataFrame:
    d = F.lit(_date(as_of))
    df = batch.withColumn("issue_date", F.coalesce(F.col("issue_date"), d))  # default: today
    rules = [
        (~F.col("_c"), "UNKNOWN_CHARGE"), (~F.col("_b"), "UNKNOWN_BUILDING"),
        (~F.coalesce(F.col("kind").isin(KIND_ORDINARY, KIND_EXTRAORDINARY), F.lit(False)), "INVALID_KIND"),
        (F.col("description").isNotNull() & (X.tsql_len("description") > 200), "DESCRIPTION_LENGTH"),
        (F.col("issue_date") > d, "INVALID_DATE"),
        (F.col("amount").isNull() | (F.col("amount") < 0), "INVALID_AMOUNT"),
    ]
    return validate(df, rules, parents=[(charge, ["charge_no"], ["charge_no"], "_c"),
                                        (building, ["building_id"], ["building_id"], "_b")])


def _parent_kind(batch: DataFrame, expense: DataFrame) -> DataFrame:
    e = expense.select(F.col("expense_id").alias("_eid"), F.col("kind").alias("_kind"))
    return batch.join(e, batch["expense_id"] == e["_eid"], "left").drop("_eid")


def validate_ordinary(batch: DataFrame, expense: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    df = _parent_kind(batch, expense)
    rules = [
        (F.col("_kind").isNull(), "UNKNOWN_EXPENSE"),
        (F.col("_kind").isNotNull() & (F.col("_kind") != KIND_ORDINARY), "NOT_ORDINARY"),
        (F.col("provider").isNotNull() & (X.tsql_len("provider") > 100), "PROVIDER_LENGTH"),
        (F.col("category").isNotNull() & (X.tsql_len("category") > 35), "CATEGORY_LENGTH"),
        (F.col("invoice_no").isNotNull() & (X.tsql_len("invoice_no") > 50), "INVOICE_LENGTH"),
    ]
    return validate(df, rules, ["expense_id"], ["expense_id", "provider", "category"], existing).drop("_kind")


def validate_extraordinary(batch: DataFrame, expense: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    df = _parent_kind(batch, expense)
    cur, cnt = F.col("instalment"), F.col("instalments")
    rules = [
        (F.col("_kind").isNull(), "UNKNOWN_EXPENSE"),
        (F.col("_kind").isNotNull() & (F.col("_kind") != KIND_EXTRAORDINARY), "NOT_EXTRAORDINARY"),
        (cur.isNotNull() & ((cur <= 0) | (cur > 255)), "INVALID_INSTALMENT"),
        (cnt.isNotNull() & ((cnt <= 0) | (cnt > 255)), "INVALID_INSTALMENTS"),
        (cur.isNotNull() & cnt.isNotNull() & (cur > cnt), "INSTALMENT_ORDER"),
    ]
    return validate(df, rules, ["expense_id"], ["expense_id", "instalment", "instalments"], existing).drop("_kind")
