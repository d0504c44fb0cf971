"""Star-schema parquet -> ledger inputs and ledger state (lazy DataFrames).

Derivation (identical in the DuckDB oracle, see ``strata.plans.oracle``):

- building  <- nation: id, name, address 'Calle <name>', fees 2.00/5.00,
               unit count and floor area summed from its units
- unit      <- customer: building = nation, floor = key div 8, door = letter key%8,
               area = 30 + key%170, coefficient = 1 + key%9
- person    <- customer (one per unit) plus a second person on units with key%10=0;
               e-mail NULL when key%5=0, phone NULL when key%7=0
- occupancy <- person: second person and key%3=0 -> Inquilino, else Propietario
- storage / parking <- units with key%4=0 / key%6=0
- monthly expenses file (wide JSON objects) <- lineitem x supplier: per supplier
  nation, ship month and (returnflag, linestatus) pair, summed extended price
- providers sheet <- supplier: category by key%5, AYSA/EDENOR for public services
- bank file <- orders: amount text '$ 1.234,56'; unknown account when key%50=0,
  invalid date text when key%97=0

Charges, apportionment, expenses and payments are then produced by the operators
themselves (``Ledger``), exactly as an import of those files would.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as X
from ..fixed import ROLE_OWNER, ROLE_TENANT
from ..operators import charges as C
from ..operators import payments as P
from ..schemas import EXPENSE_JSON_KEYS
from ..session import path_bytes, run_name, shared_dir, tasks_for
from .tables import scan

# Fixed values of the derivation: (returnflag, linestatus) pair -> JSON amount key.
FLAG_PAIR_KEY = {
    "AF": "BANCARIOS",
    "AO": "LIMPIEZA",
    "NF": "ADMINISTRACION",
    "NO": "GASTOS GENERALES",
    "RF": "SERVICIOS PUBLICOS-Agua",
    "RO": "SERVICIOS PUBLICOS-Luz",
}
PROVIDER_CATEGORIES = ["GASTOS BANCARIOS", "GASTOS DE ADMINISTRACION", "SEGUROS",
                       "GASTOS DE LIMPIEZA", "SERVICIOS PUBLICOS"]
UNKNOWN_ACCOUNT = "9" * 22

INPUTS = ("nation", "customer", "supplier", "orders", "lineitem")
# Charges and their totals (a row a building and month) of so few bytes go to every task that expands units.
SMALL_BYTES = 8 << 20


def _unit_area(key):
    return (F.lit(30) + X.col_(key) % 170).cast("decimal(6,2)")


def units(spark: SparkSession, sf: str) -> DataFrame:
    c = scan(spark, sf, "customer", "c_custkey", "c_nationkey")
    k = F.col("c_custkey")
    return c.select(
        k.alias("unit_id"),
        F.col("c_nationkey").cast("bigint").alias("building_id"),
        X.int_div(k, F.lit(8)).cast("string").alias("floor"),
        F.substring(F.lit("ABCDEFGH"), (k % 8).cast("int") + 1, 1).alias("door"),
        _unit_area(k).alias("area"),
        (F.lit(1) + k % 9).cast("decimal(5,2)").alias("coef"),
    )


def buildings(spark: SparkSession, sf: str) -> DataFrame:
    n = scan(spark, sf, "nation", "n_nationkey", "n_name")
    agg = units(spark, sf).groupBy("building_id").agg(
        F.count(F.lit(1)).alias("unit_count"), F.sum("area").cast("decimal(18,2)").alias("area"))
    b = n.select(F.col("n_nationkey").cast("bigint").alias("building_id"), F.col("n_name").alias("name"))
    return b.join(agg, "building_id", "left").select(
        "building_id", "name", F.concat(F.lit("Calle "), F.col("name")).alias("address"),
        F.coalesce("unit_count", F.lit(0)).cast("bigint").alias("unit_count"),
        F.coalesce("area", X.dec(0, 18, 2)).alias("area"),
        X.dec("2.00", 5, 2).alias("fee_first"), X.dec("5.00", 5, 2).alias("fee_next"))


def persons(spark: SparkSession, sf: str) -> DataFrame:
    c = scan(spark, sf, "customer", "c_custkey", "c_mktsegment")
    k = F.col("c_custkey")
    ks = k.cast("string")
    letter = F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (k % 26).cast("int") + 1, 1)
    primary = c.select(
        F.lpad(ks, 10, "0").alias("dni"),
        F.col("c_mktsegment").alias("first_name"),
        F.concat(F.lit("Apellido"), letter).alias("last_name"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("cliente"), ks, F.lit("@correo.com"))).alias("email"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("11"), F.lpad(ks, 8, "0"))).alias("phone"),
        F.lpad(ks, 22, "0").alias("account"),
        k.alias("unit_id"),
    )
    second = c.filter(k % 10 == 0).select(
        F.concat(F.lit("9"), F.lpad(ks, 9, "0")).alias("dni"),
        F.lit("Conviviente").alias("first_name"),
        F.concat(F.lit("Apellido"), letter).alias("last_name"),
        F.lit(None).cast("string").alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.concat(F.lit("1"), F.lpad(ks, 21, "0")).alias("account"),
        k.alias("unit_id"),
    )
    return primary.unionByName(second)


def occupancies(spark: SparkSession, sf: str) -> DataFrame:
    p = persons(spark, sf)
    second = F.substring("dni", 1, 1) == "9"
    role = F.when(second | (F.col("unit_id") % 3 == 0), F.lit(ROLE_TENANT)).otherwise(F.lit(ROLE_OWNER))
    return p.select(
        (F.col("unit_id") * 2 + F.when(second, 1).otherwise(0)).alias("occupancy_id"),
        role.alias("role"), "unit_id", "dni")


def storages(spark: SparkSession, sf: str) -> DataFrame:
    u = units(spark, sf).filter(F.col("unit_id") % 4 == 0)
    return u.select(F.col("unit_id").alias("storage_id"),
                    (F.lit(2) + F.col("unit_id") % 5).cast("decimal(10,2)").alias("size"), "unit_id")


def parkings(spark: SparkSession, sf: str) -> DataFrame:
    u = units(spark, sf).filter(F.col("unit_id") % 6 == 0)
    return u.select(F.col("unit_id").alias("parking_id"),
                    (F.lit(10) + F.col("unit_id") % 3).cast("decimal(10,2)").alias("size"), "unit_id")


def expense_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly expenses as the JSON objects would hold them (one row per building-month).

    One aggregation over lineitem: conditional sums per JSON key (map-side partial
    aggregation); amounts rendered as '1.234,56' text; keys without rows are NULL.
    """
    li = scan(spark, sf, "lineitem", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    su = scan(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    na = scan(spark, sf, "nation", "n_nationkey", "n_name")
    j = li.join(su, li["l_suppkey"] == su["s_suppkey"])
    pair = F.concat("l_returnflag", "l_linestatus")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    sums = [F.sum(F.when(pair == p, price)).alias(f"k{EXPENSE_JSON_KEYS.index(key)}")
            for p, key in FLAG_PAIR_KEY.items()]
    g = j.groupBy("s_nationkey", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")).agg(*sums)
    g = g.join(na, g["s_nationkey"] == na["n_nationkey"])
    cols = [F.col("n_name").alias("Nombre del consorcio"), X.es_month_name(F.col("month")).alias("Mes"),
            F.col("year").cast("int").alias("year")]
    for i, key in enumerate(EXPENSE_JSON_KEYS):
        if f"k{i}" in g.columns:
            cols.append(X.format_es_ar(F.col(f"k{i}")).alias(key))
        else:
            cols.append(F.lit(None).cast("string").alias(key))
    return g.select(*cols)


def regional_expense_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One consolidated expenses object per region (a name that is not a building)."""
    r = scan(spark, sf, "region", "r_name")
    cols = [F.col("r_name").alias("Nombre del consorcio"), F.lit("enero").alias("Mes"), F.lit(1995).alias("year")]
    cols += [F.lit(None).cast("string").alias(k) for k in EXPENSE_JSON_KEYS]
    return r.select(*cols)


def providers_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Provider rows F1..F4: category, provider, description, building name."""
    su = scan(spark, sf, "supplier", "s_suppkey", "s_name", "s_nationkey")
    na = scan(spark, sf, "nation", "n_nationkey", "n_name")
    k = F.col("s_suppkey")
    cat = F.element_at(F.array(*[F.lit(c) for c in PROVIDER_CATEGORIES]), (k % 5).cast("int") + 1)
    prov = F.when(cat == "SERVICIOS PUBLICOS", F.when(k % 2 == 0, F.lit("AYSA")).otherwise(F.lit("EDENOR"))) \
        .otherwise(F.col("s_name"))
    j = su.join(na, su["s_nationkey"] == na["n_nationkey"])
    return j.select(cat.alias("_c0"), prov.alias("_c1"),
                    F.concat(F.lit("Servicio de "), F.col("s_name")).alias("_c2"), F.col("n_name").alias("_c3"))


def bank_file(spark: SparkSession, sf: str) -> DataFrame:
    """Bank CSV rows (all text): id, fecha (dd/MM/yyyy), CVU_CBU, valor ('$ 1.234,56')."""
    o = scan(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    k = F.col("o_orderkey")
    d = F.to_date("o_orderdate")
    date_text = F.when(k % 97 == 0, F.concat(F.lit("30/02/"), F.year(d).cast("string"))).otherwise(X.format_dmy(d))
    account = F.when(k % 50 == 0, F.lit(UNKNOWN_ACCOUNT)).otherwise(F.lpad(F.col("o_custkey").cast("string"), 22, "0"))
    return o.select(k.cast("string").alias("id"), date_text.alias("fecha"), account.alias("CVU_CBU"),
                    X.money_text(F.col("o_totalprice").cast("decimal(12,2)")).alias("valor"))


def providers_table(sheet: DataFrame, building: DataFrame) -> DataFrame:
    """A-07: drop rows with blank category/building, trim, inner join building name."""
    s = sheet.select(F.trim("_c0").alias("category"), F.trim("_c1").alias("provider"),
                     F.trim("_c2").alias("description"), F.trim("_c3").alias("building_name"))
    s = s.filter(~X.is_blank("category") & ~X.is_blank("building_name"))
    b = building.select("building_id", X.ci("name").alias("_k"))
    return s.join(b, X.ci(s["building_name"]) == b["_k"]).drop("_k")


class Ledger:
    """All ledger tables of one dataset, built lazily from the star schema.

    ``charge``/``apportionment``/``payment`` are the state after importing the
    expenses file (charges, apportionment, expenses, providers) and then the bank file
    with the month rule, into an empty ledger.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = spark, sf_dir
        self.small = False  # the stored charges and expenses are known to be small

    @property
    def tasks(self) -> int:
        """Partitions of the large tables, by the size of the input; shuffles of the session start from as many."""
        return tasks_for(self.spark, sum(path_bytes(self.spark, f"{self.sf}/{t}.parquet") for t in INPUTS))

    def _side(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.small else df

    # dimensions -------------------------------------------------------------
    @cached_property
    def building(self) -> DataFrame:
        return buildings(self.spark, self.sf)

    @cached_property
    def unit(self) -> DataFrame:
        return units(self.spark, self.sf)

    @cached_property
    def person(self) -> DataFrame:
        return persons(self.spark, self.sf)

    @cached_property
    def occupancy(self) -> DataFrame:
        return occupancies(self.spark, self.sf)

    @cached_property
    def storage(self) -> DataFrame:
        return storages(self.spark, self.sf)

    @cached_property
    def parking(self) -> DataFrame:
        return parkings(self.spark, self.sf)

    # expenses import --------------------------------------------------------
    @cached_property
    def expense_sheet(self) -> DataFrame:
        return expense_sheet(self.spark, self.sf)

    @cached_property
    def stage(self) -> DataFrame:
        return C.stage_expenses(self.expense_sheet)

    @cached_property
    def resolved(self) -> DataFrame:
        return C.resolve_building(self.stage, self.building)

    @cached_property
    def totals(self) -> DataFrame:
        return C.charge_totals(self.resolved)

    @cached_property
    def charge(self) -> DataFrame:
        c = C.new_charges(self.totals)
        # edge injection: no second due date on every 13th charge
        return c.withColumn("due2", F.when(F.col("charge_no") % 13 == 0, F.lit(None).cast("date"))
                            .otherwise(F.col("due2")))

    @cached_property
    def apportion_base(self) -> DataFrame:
        return C.apportion_base(self._side(self.charge), self.unit, tasks=self.tasks)

    @cached_property
    def expense(self) -> DataFrame:
        return C.expenses(self.resolved)

    @cached_property
    def providers(self) -> DataFrame:
        return providers_table(providers_sheet(self.spark, self.sf), self.building)

    @cached_property
    def expense_ordinary(self) -> DataFrame:
        return C.assign_providers(self.expense, self.providers)

    @cached_property
    def expense_extraordinary(self) -> DataFrame:
        return C.extraordinary_rows(self.expense)

    @cached_property
    def apportion_final(self) -> DataFrame:
        a = C.apportion_final(self.apportion_base, self._side(C.expense_totals(self.expense)))
        # edge injection: zero ordinary+extraordinary on January rows of units key%11=0
        zero_row = (F.col("unit_id") % 11 == 0) & ((F.col("charge_no") % C.CHARGE_NO_STRIDE) % 12 == 1)
        zero = X.dec(0, 12, 2)
        z = {c: F.when(zero_row, zero).otherwise(F.col(c)).alias(c) for c in ("ordinary", "extraordinary", "total")}
        return a.select("charge_no", "unit_id", "pct", "prior_balance", "received", "interest",
                        z["ordinary"], z["extraordinary"], z["total"], z["total"].alias("debt"))

    @cached_property
    def apportion_carried(self) -> DataFrame:
        return C.carry_forward(self.apportion_final, self.charge)

    # bank file import (month rule) -------------------------------------------
    @cached_property
    def bank_file(self) -> DataFrame:
        return bank_file(self.spark, self.sf)

    @cached_property
    def bank_parsed(self) -> DataFrame:
        """The bank file parsed (typed staging rows, before any matching)."""
        return P.parse_bank_file(self.bank_file)

    @cached_property
    def bank_staged(self) -> DataFrame:
        return P.resolve_unit_by_account(self.bank_parsed, self.person)

    @cached_property
    def bank_matched(self) -> DataFrame:
        # the month rule only needs the (charge, unit) keys, which the carry-forward
        # does not change: match against the final apportionment so this import can
        # run alongside the carry-forward
        return P.match_by_month(self.bank_staged, self.apportion_final, self.charge)

    @cached_property
    def payment(self) -> DataFrame:
        accepted, _ = P.split_accepted(self.bank_matched)
        return P.as_payment_rows(accepted)

    @cached_property
    def payment_by_month(self) -> DataFrame:
        """The payments with ``pay_month``; the stored table is laid out by it, so a date range reads its months only."""
        return self.payment.withColumn("pay_month", X.month_start("pay_date"))

    @cached_property
    def apportionment(self) -> DataFrame:
        return P.apply_payments(self.apportion_carried, self.payment)

    # storage ----------------------------------------------------------------
    # stored tables and the stored tables each one is computed from
    DEPENDS = {
        "unit": [], "person": [], "resolved": [], "bank_parsed": [],
        "building": ["unit"], "occupancy": ["person"], "storage": ["unit"], "parking": ["unit"],
        "charge": ["resolved"], "expense": ["resolved"],
        "expense_ordinary": ["expense", "building"], "expense_extraordinary": ["expense"],
        "apportion_final": ["charge", "unit", "expense"],
        "apportion_carried": ["apportion_final", "charge"],
        "bank_matched": ["bank_parsed", "person", "apportion_final", "charge"],
        "payment": ["bank_matched"],
        "apportionment": ["apportion_carried", "payment"],
    }
    STORED = list(DEPENDS)
    SORT_KEYS = {"payment": ["pay_date", "payment_id"],
                 "bank_matched": ["source_id"], "bank_parsed": ["source_id"], "expense": ["charge_no", "expense_id"]}
    # The apportionment tables are bucketed by unit, with as many buckets as the input's size asks for: a unit has one
    # row per billing month, so no bucket can be hot, and the carry-forward, the matching by month, the payments'
    # application and the per-unit windows and aggregates of the reports read co-located data without a shuffle.
    # Payments are not bucketed: one unit may hold a third of them.
    BUCKETED = {"apportion_final": "unit_id", "apportion_carried": "unit_id", "apportionment": "unit_id"}

    # Payments are laid out by month (a folder each), in files of even size cut by (month, id): a month may be large.
    BY_MONTH = {"payment": "payment_by_month"}

    def materialize(self, path: str | None = None) -> "Ledger":
        """Write the ledger tables once, each computed from the already written ones
        (lineage is cut at every table, so a lost executor only recomputes the current
        stage). A table is written as soon as its inputs are (one Spark job per thread).
        Returns a Ledger reading the stored tables; the caller switches
        to it only when every table was written (all-or-nothing)."""
        from concurrent.futures import Future, ThreadPoolExecutor
        from threading import Lock

        path = path or shared_dir(self.spark, "ledger")
        stored = Ledger(self.spark, self.sf)
        plans = Lock()  # plans are built one at a time, their jobs run together
        written: dict[str, Future] = {}

        run, tasks = uuid.uuid4().hex[:12], self.tasks

        def write(name: str, df: DataFrame) -> DataFrame:
            target = f"{path}/{name}"
            if name in self.BUCKETED:
                key = self.BUCKETED[name]
                table = f"{run_name(self.spark)}_{run}_{name}"
                # units are dealt before small charges meet them, and the carry-forward's window keeps them so
                dealt = name == "apportion_carried" or (name == "apportion_final" and stored.small)
                rows = df if dealt else df.repartition(tasks, key)
                (rows.write.mode("overwrite").bucketBy(tasks, key).sortBy(key, "charge_no").option("path", target)
                 .saveAsTable(table))
                return self.spark.table(table)
            if name in self.BY_MONTH:
                rows = df.withColumn("pay_month", X.month_start("pay_date"))
                (rows.repartitionByRange("pay_month", "payment_id").sortWithinPartitions("pay_month", *self.SORT_KEYS[name])
                 .write.mode("overwrite").partitionBy("pay_month").parquet(target))
                by_month = self.spark.read.schema(rows.schema).parquet(target)
                stored.__dict__[self.BY_MONTH[name]] = by_month
                return by_month.drop("pay_month")
            keys = self.SORT_KEYS.get(name)
            if keys:
                df = df.sortWithinPartitions(*keys)  # narrow min/max per row group
            df.write.mode("overwrite").parquet(target)
            return self.spark.read.parquet(target)

        def build(name: str) -> None:
            for needed in self.DEPENDS[name]:
                written[needed].result()
            with plans:
                if name == "apportion_final":
                    stored.small = sum(path_bytes(self.spark, f"{path}/{t}") for t in ("charge", "expense")) <= SMALL_BYTES
                df = getattr(stored, name)
            df = write(name, df)
            with plans:
                stored.__dict__[name] = df

        # a table starts as soon as those it is computed from are written; DEPENDS names
        # them before it, and a waiting thread costs nothing
        with ThreadPoolExecutor(max_workers=len(self.DEPENDS)) as pool:
            for name in self.DEPENDS:
                written[name] = pool.submit(build, name)
        for f in written.values():
            f.result()
        return stored
