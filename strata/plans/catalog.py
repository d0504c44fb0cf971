"""Query catalogue: each registered query is a Spark DataFrame over the whole input
tables, paired (where SQL can state it) with the equivalent DuckDB SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``.
Column names and types are aliased/cast identically on both sides.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure, path_stamp
from ..sources.adapter import INPUTS as _INPUTS, Ledger

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_LEDGERS: dict[tuple, Ledger] = {}


def ledger_key(spark: SparkSession, sf_dir: str, stored: bool) -> tuple:
    """Names a ledger by application, data and the state of its input tables."""
    stamps = tuple(path_stamp(spark, f"{sf_dir}/{t}.parquet") for t in _INPUTS)
    return spark.sparkContext.applicationId, sf_dir, stored, stamps


def ledger(spark: SparkSession, sf_dir: str, stored: bool | None = None) -> Ledger:
    """The ledger of one dataset for this session.

    By default the ledger tables are built once (Spark jobs over the given tables) and
    written to the shared checkpoint folder; every query then reads those tables, as
    the reference's reports read its database. ``STRATA_LAZY=1`` (or ``stored=False``)
    returns the fully lazy derivation instead.
    """
    if stored is None:
        stored = os.environ.get("STRATA_LAZY", "") not in ("1", "true", "yes")
    key = ledger_key(spark, sf_dir, stored)
    if key not in _LEDGERS:
        configure(spark)
        base = Ledger(spark, sf_dir)
        _LEDGERS[key] = base.materialize() if stored else base
    _LEDGERS[key].tasks  # the session's shuffles are as many as this input needs
    return _LEDGERS[key]


def query(name: str, sql: str | None = None):
    """Register ``fn(ledger, spark, sf_dir)`` as query ``name`` (with its oracle)."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ledger(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# Import the modules that register queries (order only affects listing order).
from . import queries_reports  # noqa: E402,F401
from . import queries_ledger  # noqa: E402,F401
from . import queries_imports  # noqa: E402,F401
from . import queries_validate  # noqa: E402,F401
from . import queries_changes  # noqa: E402,F401
from . import queries_scalars  # noqa: E402,F401
from . import queries_stream  # noqa: E402,F401
