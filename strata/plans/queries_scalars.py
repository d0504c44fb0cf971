"""Scalar function coverage (H-01 .. H-42) over whole input tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from .. import functions as X
from ..fixed import FIRST_PAYMENT
from ..operators.audit import PAYMENTS_PROC
from ..sources.tables import scan
from .catalog import query
from .oracle import month_name, month_title, us_week, with_ctes


def _es_ar_sql(x: str) -> str:
    c = f"CAST(({x}) * 100 AS HUGEINT)"
    return (f"(CASE WHEN {c} < 0 THEN '-' ELSE '' END || replace(format('{{:,}}', abs({c}) // 100), ',', '.') "
            f"|| ',' || lpad(CAST(abs({c}) % 100 AS VARCHAR), 2, '0'))")


@query("q_scalar_text", with_ctes(f"""
SELECT c_custkey,
       trim('  ' || c_name || '  ') AS trimmed,
       substring(c_name, 1, 10) AS left10,
       regexp_extract('C:\\datos\\' || c_mktsegment || '/' || c_name || '.csv', '[^\\\\/]+$') AS file_name,
       substring(c_name, 2, 5) AS middle,
       upper(c_mktsegment) AS upper_segment, lower(c_mktsegment) AS lower_segment,
       replace(replace(replace(c_name, '#', '-'), 'Customer', 'Cliente'), '0', '') AS replaced,
       CAST(length(rtrim(c_name || '   ')) AS INTEGER) AS tsql_len,
       c_name || ' ' || CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'cliente' || CAST(c_custkey AS VARCHAR) END AS concat_null,
       'FAC-' || CAST(c_custkey AS VARCHAR) AS invoice,
       replace(replace(c_name || chr(13) || chr(10), chr(13), ''), chr(10), '') AS no_crlf,
       {_es_ar_sql('CAST(c_acctbal AS DECIMAL(12,2))')} AS balance_es_ar,
       sha256(lpad(CAST(c_custkey AS VARCHAR), 22, '0')) AS account_sha256,
       sha256(from_hex(regexp_replace(hex(c_name), '(..)', '\\100', 'g'))) AS name_sha256_utf16
FROM customer"""))
def q_scalar_text(L):
    """H-01..H-10, H-36, H-41: text functions with T-SQL semantics over every customer."""
    c = scan(L.spark, L.sf, "customer", "c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    k = F.col("c_custkey")
    email = F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("cliente"), k.cast("string")))
    return c.select(
        "c_custkey",
        F.trim(F.concat(F.lit("  "), F.col("c_name"), F.lit("  "))).alias("trimmed"),
        X.left("c_name", 10).alias("left10"),
        X.file_name(F.concat(F.lit("C:\\datos\\"), F.col("c_mktsegment"), F.lit("/"), F.col("c_name"),
                             F.lit(".csv"))).alias("file_name"),
        F.substring("c_name", 2, 5).alias("middle"),
        F.upper("c_mktsegment").alias("upper_segment"), F.lower("c_mktsegment").alias("lower_segment"),
        F.replace(F.replace(F.replace(F.col("c_name"), F.lit("#"), F.lit("-")), F.lit("Customer"), F.lit("Cliente")),
                  F.lit("0"), F.lit("")).alias("replaced"),
        X.tsql_len(F.concat(F.col("c_name"), F.lit("   "))).cast("int").alias("tsql_len"),
        F.concat(F.col("c_name"), F.lit(" "), email).alias("concat_null"),
        F.concat(F.lit("FAC-"), k.cast("string")).alias("invoice"),
        X.strip_crlf(F.concat(F.col("c_name"), F.lit("\r\n"))).alias("no_crlf"),
        X.format_es_ar(F.col("c_acctbal").cast("decimal(12,2)")).alias("balance_es_ar"),
        X.sha256_hex(F.lpad(k.cast("string"), 22, "0")).alias("account_sha256"),
        X.sha256_hex_utf16("c_name").alias("name_sha256_utf16"),
    )


@query("q_scalar_null_case_cast", with_ctes(f"""
SELECT o.o_orderkey AS source_id,
       coalesce(b.unit_id, -1) AS unit_or_default,
       nullif(CAST(o.o_custkey % 10 AS BIGINT), 0) AS nullif_zero,
       CASE lower(trim(upper({month_name('month(o.o_orderdate)')}) || ' '))
         {" ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(
             ['enero', 'febrero', 'marzo', 'abril', 'mayo', 'junio', 'julio', 'agosto', 'septiembre', 'octubre',
              'noviembre', 'diciembre'], 1))} END AS month_from_name,
       CASE WHEN o.o_totalprice > 200000 THEN 'ALTO' WHEN o.o_totalprice > 100000 THEN 'MEDIO' ELSE 'BAJO' END AS band,
       CAST(o.o_totalprice AS DECIMAL(12,2)) AS price,
       CAST(o.o_orderkey AS VARCHAR) AS key_text,
       CAST(coalesce(TRY_CAST(CAST(CAST(o.o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS DECIMAL(6,2)), 0) AS DECIMAL(6,2))
         AS guarded_small,
       b.pay_date AS parsed_date,
       strftime(CAST(o.o_orderdate AS DATE), '%d/%m/%Y') AS dmy,
       coalesce(CAST(b.pay_date AS VARCHAR), 'Primer Pago') AS date_or_placeholder,
       b.amount AS parsed_amount,
       CASE WHEN o.o_orderkey % 3 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(CAST(o.o_totalprice AS DECIMAL(12,2)) AS DECIMAL(18,2)) END
         AS blank_or_amount,
       TRY_CAST(CAST(CAST(o.o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS DECIMAL(12,2)) AS comma_decimal
FROM orders o JOIN bank_matched b ON b.source_id = o.o_orderkey"""))
def q_scalar_null_case_cast(L):
    """H-11..H-25: NULL handling, CASE, casts and text conversions over every bank line."""
    o = scan(L.spark, L.sf, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    b = L.bank_matched.select("source_id", "unit_id", "pay_date", "amount", "amount_text")
    j = o.join(b, o["o_orderkey"] == b["source_id"])
    price = F.col("o_totalprice").cast("decimal(12,2)")
    es_text = X.format_es_ar(price)
    return j.select(
        "source_id",
        F.coalesce("unit_id", F.lit(-1).cast("bigint")).alias("unit_or_default"),
        F.nullif(F.col("o_custkey") % 10, F.lit(0).cast("bigint")).alias("nullif_zero"),
        X.es_month_number(F.concat(F.upper(X.es_month_name(F.month("o_orderdate"))), F.lit(" "))).alias("month_from_name"),
        F.when(F.col("o_totalprice") > 200000, "ALTO").when(F.col("o_totalprice") > 100000, "MEDIO")
         .otherwise("BAJO").alias("band"),
        price.alias("price"),
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.coalesce(price.cast("string").try_cast("decimal(6,2)"), X.dec(0, 6, 2)).alias("guarded_small"),
        F.col("pay_date").alias("parsed_date"),
        X.format_dmy(F.to_date("o_orderdate")).alias("dmy"),
        F.coalesce(F.col("pay_date").cast("string"), F.lit(FIRST_PAYMENT)).alias("date_or_placeholder"),
        F.col("amount").alias("parsed_amount"),
        X.parse_amount_or_zero(F.when(F.col("o_orderkey") % 3 == 0, F.lit("")).otherwise(es_text)).alias("blank_or_amount"),
        X.try_decimal_comma(F.translate(price.cast("string"), ".", ","), 12, 2).alias("comma_decimal"),
    )


@query("q_scalar_dates", with_ctes(f"""
SELECT o_orderkey, d, CAST(year(d) AS INTEGER) AS y, CAST(month(d) AS INTEGER) AS m, CAST(day(d) AS INTEGER) AS dd,
       {us_week('d')} AS us_week,
       CAST(date_diff('day', DATE '1995-01-01', d) AS INTEGER) AS days_since,
       CAST((2003 * 12 + 3) - (year(d) * 12 + month(d)) AS INTEGER) AS month_boundaries,
       d + 30 AS plus_30,
       make_date(year(d), month(d), 1) AS month_first,
       last_day(d) AS month_last,
       least(make_date(year(d), month(d), 1) + 30, last_day(d)) AS due_day_31,
       least(make_date(year(d), month(d), 1) + 29, last_day(d)) AS due_day_30,
       {month_title('month(d)')} AS month_title
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders) o"""))
def q_scalar_dates(L):
    """H-26..H-35: date parts, US week numbers, day and month-boundary differences,
    date arithmetic, month ends, due-day clamping and Spanish month names."""
    o = scan(L.spark, L.sf, "orders", "o_orderkey", "o_orderdate").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    d = F.col("d")
    return o.select(
        "o_orderkey", "d", F.year(d).alias("y"), F.month(d).alias("m"), F.dayofmonth(d).alias("dd"),
        X.us_week(d).alias("us_week"),
        F.datediff(d, F.lit("1995-01-01").cast("date")).alias("days_since"),
        X.month_boundaries(d, F.lit("2003-03-15").cast("date")).alias("month_boundaries"),
        F.date_add(d, 30).alias("plus_30"),
        F.make_date(F.year(d), F.month(d), F.lit(1)).alias("month_first"),
        F.last_day(d).alias("month_last"),
        X.due_date(F.year(d), F.month(d), 31).alias("due_day_31"),
        X.due_date(F.year(d), F.month(d), 30).alias("due_day_30"),
        X.es_month_title(F.month(d)).alias("month_title"),
    )


@query("q_scalar_math", with_ctes("""
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(12,2)) AS discount_amt,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_quantity AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS gross,
       CASE WHEN CAST(l_discount AS DECIMAL(4,2)) + CAST(l_tax AS DECIMAL(4,2)) = 0
            THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(12,2))
            ELSE CAST(CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS HUGEINT)
                      * (CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS HUGEINT) * 1000000000000
                         // (CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS HUGEINT) + CAST(CAST(l_tax AS DECIMAL(4,2)) * 100 AS HUGEINT)))
                      // 1000000000000 AS DECIMAL(38,0)) * 0.01 AS DECIMAL(12,2)) END AS discount_share,
       CAST(CASE WHEN CAST(l_extendedprice AS DECIMAL(12,2)) * 1000 > 99999999.99 THEN 99999999.99
                 ELSE CAST(l_extendedprice AS DECIMAL(12,2)) * 1000 END AS DECIMAL(12,2)) AS clamped
FROM lineitem"""))
def q_scalar_math(L):
    """H-37..H-40: ROUND half-up, exact decimal arithmetic, a guarded ratio split
    (truncated fixed-point ratio) and the amount ceiling, over every line item."""
    li = scan(L.spark, L.sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity",
              "l_discount", "l_tax")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    disc, tax = F.col("l_discount").cast("decimal(4,2)"), F.col("l_tax").cast("decimal(4,2)")
    dc, tc = X.cents(disc).cast("decimal(38,0)"), X.cents(tax).cast("decimal(38,0)")
    scale = X.dec(10 ** 12)
    ratio = X.int_div(dc * scale, dc + tc).cast("decimal(38,0)")
    share = X.from_cents(X.int_div(X.cents(price).cast("decimal(38,0)") * ratio, scale), 12)
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(price * disc, 2).cast("decimal(12,2)").alias("discount_amt"),
        (price * F.col("l_quantity").cast("decimal(12,2)")).cast("decimal(18,2)").alias("gross"),
        F.when(disc + tax == 0, price).otherwise(share).alias("discount_share"),
        X.clamp(price * X.dec(1000), hi=X.AMOUNT_CEILING, lo=-X.AMOUNT_CEILING).cast("decimal(12,2)").alias("clamped"),
    )


@query("q_json_props", with_ctes("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       json_extract_string(props, '$."k"') AS k_text FROM events"""))
def q_json_props(L):
    """H-42: JSON values by path (plain and quoted key) from every event."""
    e = scan(L.spark, L.sf, "events", "event_id", "props")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
                    F.get_json_object("props", "$['k']").alias("k_text"))


_LOGGED_AT = _dt.datetime(2001, 6, 30, 12, 0, 0)  # the time of the import, an argument


@query("q_import_log", with_ctes(f"""
SELECT TIMESTAMP '{_LOGGED_AT}' AS logged_at, proc, level, message, 'pagos_consorcios.csv' AS path
FROM (SELECT '{PAYMENTS_PROC}' AS proc, 'ERROR' AS level,
             'Linea ' || coalesce(CAST(source_id AS VARCHAR), '?') || ' rechazada: ' || r AS message
      FROM (SELECT source_id, concat_ws(',', CASE WHEN pay_date IS NULL THEN 'INVALID_DATE' END,
                     CASE WHEN amount IS NULL OR NOT (amount > 0) THEN 'INVALID_AMOUNT' END,
                     CASE WHEN unit_id IS NULL THEN 'UNKNOWN_ACCOUNT' END,
                     CASE WHEN charge_no IS NULL THEN 'NO_CHARGE' END) AS r FROM bank_matched) x WHERE r <> ''
      UNION ALL
      SELECT '{PAYMENTS_PROC}', CASE WHEN (SELECT count(*) FROM payment) = 0 THEN 'WARN' ELSE 'INFO' END,
             'Registros leidos: ' || CAST((SELECT count(*) FROM bank_matched) AS VARCHAR)
             || ', pagos insertados: ' || CAST((SELECT count(*) FROM payment) AS VARCHAR)) e"""))
def q_import_log(L):
    """A-09/D-13/I-12/J-19: audit rows of the bank import (one ERROR per rejected line,
    INFO summary with counts, WARN when nothing was inserted), level-checked and
    stamped with the import's time."""
    from ..operators.audit import import_log_rows
    rows = import_log_rows(L, at=_LOGGED_AT)
    return rows.withColumn("logged_at", F.col("logged_at").cast("timestamp_ntz"))
