"""Registered streaming queries (K-01, K-02), each run to completion with
``trigger(availableNow=True)`` over the whole input."""

from __future__ import annotations

from ..session import shared_dir
from ..sources import files as FL
from ..sources import fixtures as FX
from ..streaming import apply_payments_stream, weekly_totals_stream
from .catalog import query
from .oracle import with_ctes


@query("q_stream_weekly", with_ctes("""
SELECT CAST(time_bucket(INTERVAL 7 DAY, CAST(ts AS TIMESTAMP), TIMESTAMP '1970-01-01') AS TIMESTAMP) AS window_start,
       CAST(time_bucket(INTERVAL 7 DAY, CAST(ts AS TIMESTAMP), TIMESTAMP '1970-01-01') + INTERVAL 7 DAY AS TIMESTAMP)
         AS window_end,
       event_type, CAST(count(*) AS BIGINT) AS events,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS total_value
FROM events GROUP BY ALL"""))
def q_stream_weekly(L):
    """K-01: event stream -> watermark, duplicate drop, weekly tumbling totals per type."""
    return weekly_totals_stream(L.spark, f"{L.sf}/events.parquet")


@query("q_stream_payments", with_ctes("SELECT * FROM apportionment"))
def q_stream_payments(L):
    """K-02: the bank file arriving as several files, applied micro-batch by micro-batch;
    the resulting balances equal the batch import's."""
    path = FL.write_delimited(FX.payments_file(L.spark, L.sf).repartition(8), shared_dir(L.spark, "stream", "bank"), ",")
    return apply_payments_stream(L.spark, path, L.person, L.apportion_carried, L.charge)
