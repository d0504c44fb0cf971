"""Helpers that the operators of this package share."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

# White space that separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write to the cluster's shared folder and read back: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Words of a text in order; none for null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove shuffle files that no plan needs any more: those of stored steps.

    Twice, since the driver's Python lets go of its plans a moment after it is done with them.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
