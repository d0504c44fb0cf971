"""Structured Streaming operators (an extension: the reference has no streams).

K-01 ``weekly_totals_stream``: a file stream of events -> event-time watermark,
duplicate drop within the watermark, 7-day tumbling windows. Runs with
``trigger(availableNow=True)`` in update mode; each micro-batch appends its updated
windows (tagged with the batch id) through ``foreachBatch`` to a folder, and the
current result is the latest version of every window (``max_by`` over batch ids),
so the sink is idempotent and a restarted query resumes from its checkpoint. Late
events are dropped once they fall behind the watermark of the previous micro-batch
(Spark's rule for chained stateful operators); duplicates of an event id within the
watermark are dropped before aggregation.

K-02 ``apply_payments_stream``: bank files arriving in a folder are parsed, matched
and de-duplicated by the operators of the batch import and appended to the payment
table (Spark's file sink: each file's rows exactly once). A second stream reads what
that table gained and keeps what every (charge, unit) was paid in keyed state; a run
touches only the keys it changed, whose new sums are written as versions. Balances are
the latest version of every key on the apportionment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FILES, RAW
from ..session import is_folder, path_bytes, path_exists, path_stamp, shared_dir, tasks_for


def weekly_totals_stream(spark: SparkSession, source: str, watermark: str = "1 day", out_dir: str | None = None,
                         checkpoint_dir: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """``source``: the events table, a Parquet file or a folder of part files.

    By default one micro-batch takes all files that are there, so nothing is late
    whatever order the files have; ``files_per_batch`` makes smaller batches, where
    events older than the watermark of the batch before are dropped.
    """
    out_dir = out_dir or shared_dir(spark, "stream", "weekly_out")
    checkpoint_dir = checkpoint_dir or shared_dir(spark, "stream", "weekly_ckpt")
    if not path_stamp(spark, source)[0]:
        raise FileNotFoundError(f"no events to stream in {source}")
    reader = spark.readStream.schema(RAW["events"])
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    folder, _, name = source.rstrip("/").rpartition("/")
    # a stream watches a folder: of a table that is one file, the folder of that file
    src = reader.parquet(source) if is_folder(spark, source) else reader.option("pathGlobFilter", name).parquet(folder)
    ev = src.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type",
                    F.col("value").cast("decimal(12,2)").alias("value"))
    agg = (ev.withWatermark("ts", watermark)
           .dropDuplicatesWithinWatermark(["event_id"])
           .groupBy(F.window("ts", "7 days").alias("w"), "event_type")
           .agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total_value")))

    def sink(batch: DataFrame, batch_id: int) -> None:
        (batch.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                      "event_type", "events", "total_value", F.lit(batch_id).alias("batch_id"))
         .write.mode("append").parquet(out_dir))

    q = (agg.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()
    return latest_windows(spark, out_dir)


_WINDOW_ROWS = ("window_start timestamp_ntz, window_end timestamp_ntz, event_type string, events bigint, "
                "total_value decimal(18,2), batch_id bigint")


def latest_windows(spark: SparkSession, out_dir: str) -> DataFrame:
    """Current value of every window: the row of its latest micro-batch."""
    if path_exists(spark, out_dir):
        r = spark.read.parquet(out_dir)
    else:  # no micro-batch has produced output yet
        r = spark.createDataFrame([], _WINDOW_ROWS)
    v = F.max_by(F.struct("window_end", "events", "total_value"), "batch_id")
    g = r.groupBy("window_start", "event_type").agg(v.alias("_v"))
    return g.select("window_start", F.col("_v.window_end").alias("window_end"), "event_type",
                    F.col("_v.events").cast("bigint").alias("events"),
                    F.col("_v.total_value").cast("decimal(18,2)").alias("total_value"))


_PAYMENT_ROWS = "payment_id bigint, pay_date date, amount decimal(12,2), account string, unit_id bigint, charge_no bigint"
_PAID_ROWS = "charge_no bigint, unit_id bigint, paid decimal(22,2), batch_id bigint"


def _fixed_table(spark: SparkSession, folder: str, df: DataFrame) -> DataFrame:
    """A side table of a stream, written by its first run: a restarted run reads the same rows."""
    if not path_exists(spark, f"{folder}/_SUCCESS"):
        df.write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def accepted_payments_stream(spark: SparkSession, bank_dir: str, person: DataFrame, appt: DataFrame, charge: DataFrame,
                             work_dir: str, existing: DataFrame | None = None, files_per_batch: int = 4) -> str:
    """New files of ``bank_dir`` -> accepted payments, appended to the table whose folder is returned.

    Insert-if-absent compares with ``existing``, the ledger as it was at the start, as one batch import of all the
    files would; rows of other files are not taken for repeats. Accounts and month candidates meet the stream as
    static tables.
    """
    from ..operators import payments as P

    # many rows in few bytes: by its file size Spark would send the table to every task
    candidates = _fixed_table(spark, f"{work_dir}/candidates", P.month_candidates(appt, charge)).hint("merge")
    src = (spark.readStream.schema(FILES["payments_csv"]).option("header", True).option("sep", ",")
           .option("maxFilesPerTrigger", files_per_batch).csv(bank_dir))
    staged = P.resolve_unit_by_account(P.parse_bank_file(src, row_key=False), person)
    accepted, _ = P.split_accepted(P.match_by_month(staged, appt, charge, candidates))
    rows = P.as_payment_rows(accepted)
    if existing is not None:
        rows = P.new_payments(rows, existing)
    table = f"{work_dir}/payments"
    q = (rows.writeStream.format("parquet").option("path", table).outputMode("append")
         .option("checkpointLocation", f"{work_dir}/payments_ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return table


def paid_stream(spark: SparkSession, payments_dir: str, work_dir: str) -> DataFrame:
    """What every (charge, unit) was paid so far: sums in keyed state, new payments only read.

    A micro-batch writes the sums it changed to a folder of its own; run again it overwrites that folder.
    """
    versions = f"{work_dir}/paid"
    if path_exists(spark, payments_dir):
        src = spark.readStream.schema(_PAYMENT_ROWS).parquet(payments_dir)
        sums = src.groupBy("charge_no", "unit_id").agg(F.sum("amount").cast("decimal(22,2)").alias("paid"))

        def sink(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{versions}/batch_id={batch_id}")

        # state is dealt once, by the size of the first run's payments; a later run keeps the number
        parts = "spark.sql.shuffle.partitions"
        before = spark.conf.get(parts)
        spark.conf.set(parts, str(tasks_for(spark, path_bytes(spark, payments_dir))))
        try:
            q = (sums.writeStream.outputMode("update").foreachBatch(sink)
                 .option("checkpointLocation", f"{work_dir}/paid_ckpt").trigger(availableNow=True).start())
        finally:
            spark.conf.set(parts, before)
        q.awaitTermination()
    if path_exists(spark, versions):
        paid = spark.read.schema(_PAID_ROWS).parquet(versions)
    else:
        paid = spark.createDataFrame([], _PAID_ROWS)
    return paid.groupBy("charge_no", "unit_id").agg(F.max_by("paid", "batch_id").alias("amount"))


def apply_payments_stream(spark: SparkSession, bank_dir: str, person: DataFrame, appt: DataFrame,
                          charge: DataFrame, existing: DataFrame | None = None, work_dir: str | None = None,
                          files_per_batch: int = 4) -> DataFrame:
    """Bank CSV files -> accepted payments -> sums by (charge, unit) in keyed state -> balances.

    With the same ``work_dir`` a later run goes on where the last one ended, finished or not: it reads new files only
    and changes only the sums of the keys they pay. Give each call its own for a run from the start.
    """
    from ..operators import payments as P

    work_dir = work_dir or shared_dir(spark, "stream", "payments")
    table = accepted_payments_stream(spark, bank_dir, person, appt, charge, work_dir, existing, files_per_batch)
    return P.apply_payments(appt, paid_stream(spark, table, work_dir))
