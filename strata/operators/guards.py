"""Existence guards (unknown parameter -> message, no rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import UNKNOWN_BUILDING


def known_buildings(requests: DataFrame, building: DataFrame) -> DataFrame:
    """Keep only requests whose building exists (LEFT SEMI)."""
    return requests.join(building.select("building_id"), "building_id", "left_semi")


def guard_buildings(unit: DataFrame, building: DataFrame) -> DataFrame:
    """Request ids: every building id referenced by the unit table, and the same ids
    shifted by 1000 (ids that do not exist). Each request gets known/message."""
    ids = unit.select("building_id").distinct()
    req = ids.unionByName(ids.select((F.col("building_id") + 1000).alias("building_id"))).distinct()
    b = building.select(F.col("building_id").alias("_b"))
    j = req.join(b, req["building_id"] == b["_b"], "left")
    return j.select("building_id", F.col("_b").isNotNull().alias("known"),
                    F.when(F.col("_b").isNull(), F.lit(UNKNOWN_BUILDING)).alias("message"))
