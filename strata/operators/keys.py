"""Surrogate keys (IDENTITY replacement) without a single-partition window.

``surrogate_keys`` numbers rows 1..n in the order of ``order_cols`` (which must be
unique) and adds ``start``:

1. range-partition and sort by the order columns (global order across partitions),
   number rows inside each partition (partition id + position) and write that once to
   the shared folder: what a partition holds is decided by that write alone;
2. count the stored rows per partition (one small aggregate: one row per partition),
   turn the counts into offsets with a tiny window over partition ids;
3. join the offsets back (broadcast: the offsets table has one row per partition, a
   bound fixed by the plan, not by the data) and add them.

Both branches read the same stored rows, so ids are 1..n without gaps or repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir


def surrogate_keys(df: DataFrame, order_cols: list, id_col: str, start=0, keep: list[str] | None = None) -> DataFrame:
    """``order_cols`` are names or sort orders; ``keep`` names the columns that come out (all, if not given)."""
    s = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    if keep is not None:
        s = s.select(*keep)
    s = s.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    s = s.withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33))
    path = shared_dir(df.sparkSession, "keys")
    s.drop("_mid").write.parquet(path)
    s = df.sparkSession.read.schema(s.drop("_mid").schema).parquet(path)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    out = s.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
    start_c = start if hasattr(start, "alias") else F.lit(start)
    out = out.withColumn(id_col, (start_c + F.col("_off") + F.col("_pos") + 1).cast("bigint"))
    return out.drop("_pid", "_pos", "_off")


def max_id(existing: DataFrame, existing_id: str) -> int:
    """MAX(existing id) as one scalar (a single aggregate value, not data)."""
    v = existing.agg(F.max(existing_id)).first()[0]
    return int(v) if v is not None else 0


def next_ids(df: DataFrame, existing: DataFrame, existing_id: str, order_cols: list[str], id_col: str) -> DataFrame:
    """Ids continuing after MAX(existing id) (SCOPE_IDENTITY-style growth)."""
    return surrogate_keys(df, order_cols, id_col, start=max_id(existing, existing_id))
