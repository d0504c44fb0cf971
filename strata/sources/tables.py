"""Parquet scans of the star-schema inputs, always with a declared schema and an
explicit column list so the scan's ReadSchema only holds what the query needs."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..schemas import RAW


def scan(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    reader = spark.read
    if name in RAW:
        reader = reader.schema(RAW[name])
    df = reader.parquet(path)
    return df.select(*columns) if columns else df
