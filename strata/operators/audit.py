"""Audit log rows (append-only, level-checked, UTC timestamp)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import payments as P

from ..fixed import LOG_LEVELS as LEVELS
PAYMENTS_PROC = "Pago.sp_importarPagosDesdeCSV"


def stamp(events: DataFrame, at=None) -> DataFrame:
    """(proc, level, message, path) -> log rows, stamped now or with the time ``at``; an
    unknown level fails the job (CHECK)."""
    ok = F.assert_true(F.col("level").isin(*LEVELS), F.lit("log level must be INFO, WARN or ERROR"))
    return events.select((F.current_timestamp() if at is None else F.lit(at)).alias("logged_at"), "proc",
                         F.when(ok.isNull(), F.col("level")).alias("level"), "message", "path")


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def import_log_rows(L, path: str = "pagos_consorcios.csv", at=None) -> DataFrame:
    """One ERROR row per rejected bank line (failure isolation), one INFO summary with
    the counters (single aggregate pass), and a WARN row when nothing was accepted."""
    r = L.bank_matched.withColumn("reasons", P.reject_reasons(L.bank_matched))
    errors = r.filter(F.col("reasons") != "").select(
        F.lit(PAYMENTS_PROC).alias("proc"), F.lit("ERROR").alias("level"),
        F.concat(F.lit("Linea "), F.coalesce(F.col("source_id").cast("string"), F.lit("?")), F.lit(" rechazada: "),
                 F.col("reasons")).alias("message"), F.lit(path).alias("path"))
    counts = r.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("reasons") == "").alias("ok"))
    summary = counts.select(
        F.lit(PAYMENTS_PROC).alias("proc"),
        F.when(F.col("ok") == 0, F.lit("WARN")).otherwise(F.lit("INFO")).alias("level"),
        F.concat(F.lit("Registros leidos: "), F.col("n").cast("string"), F.lit(", pagos insertados: "),
                 F.col("ok").cast("string")).alias("message"),
        F.lit(path).alias("path"))
    return stamp(errors.unionByName(summary), at)


def log_event(spark, proc: str, level: str, message: str, path: str | None = None) -> DataFrame:
    """J-19: one audit row (level checked, UTC timestamp)."""
    row = spark.createDataFrame([(proc, level, message, path)], "proc string, level string, message string, path string")
    return stamp(row)
