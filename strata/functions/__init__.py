"""Column functions (all JVM-side built-ins, no Python UDFs).

Each helper returns a ``Column`` expression, so it stays inside whole-stage codegen
and composes with any DataFrame. T-SQL semantics that Spark spells differently are
encoded here once (US week numbers, month-boundary counts, d/m/y parsing, money text,
blank-insensitive comparisons).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import AMOUNT_CEILING, SPANISH_MONTHS  # noqa: F401 (re-exported)


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(value: str | int, precision: int = 38, scale: int = 0) -> Column:
    """Exact decimal literal (never a double)."""
    return F.lit(Decimal(str(value))).cast(f"decimal({precision},{scale})")


def money(c, precision: int = 12) -> Column:
    """Cast to DECIMAL(p,2) (half-up rounding, as T-SQL's CAST)."""
    return col_(c).cast(f"decimal({precision},2)")


def cents(c) -> Column:
    """Money value as integer cents (bigint), exact for DECIMAL(*,2) input."""
    return (col_(c).cast("decimal(38,2)") * dec(100)).cast("decimal(38,0)").cast("bigint")


def from_cents(c, precision: int = 12) -> Column:
    """Integer cents back to DECIMAL(p,2) without any floating point step."""
    return (col_(c).cast("decimal(36,0)") * F.lit(Decimal("0.01"))).cast(f"decimal({precision},2)")


def cents_long(c) -> Column:
    """DECIMAL(p<=14, 2) money as long cents (stays on Spark's 64-bit decimal path)."""
    return (col_(c) * F.lit(Decimal(100))).cast("bigint")


def div_half_up_long(num, den) -> Column:
    """round(num / den) half-up for non-negative longs (overflow raises under ANSI)."""
    n, d = col_(num).cast("bigint"), col_(den).cast("bigint")
    return int_div(n * 2 + d, d * 2)


def money_from_cents_long(c, precision: int = 12) -> Column:
    """Long cents (|c| < 1e16) -> DECIMAL(p,2), exact."""
    return (col_(c).cast("decimal(16,0)") * F.lit(Decimal("0.01"))).cast(f"decimal({precision},2)")


def int_div(num, den) -> Column:
    """SQL ``div``: integral division truncating toward zero, result bigint."""
    return F.call_function("div", col_(num), col_(den))


def round_div_half_up(num, den) -> Column:
    """round(num / den) half away from zero, for whole numbers of up to 38 digits and ``den`` > 0: DECIMAL(38,0).

    Quotient and remainder are taken apart, so nothing passes through 64 bits and nothing is doubled; a quotient of
    more than 32 digits raises.
    """
    n = col_(num).cast("decimal(38,0)")
    d = col_(den).cast("decimal(38,0)")
    rest = n % d  # has the sign of num
    whole = ((n - rest) / d).cast("decimal(38,0)")
    up = F.when(F.abs(rest) >= d - F.abs(rest), F.signum(n).cast("decimal(38,0)")).otherwise(dec(0))
    return (whole + up).cast("decimal(38,0)")


def wide_cents(c) -> Column:
    """Money value as whole cents of up to 36 digits, exact for DECIMAL(*,2) input."""
    return (col_(c).cast("decimal(38,2)") * dec(100)).cast("decimal(38,0)")


# ---------------------------------------------------------------------------
# Text
def blank_to_null(c) -> Column:
    """NULLIF(LTRIM(RTRIM(x)), '')."""
    t = F.trim(col_(c))
    return F.when(t == "", F.lit(None).cast("string")).otherwise(t)


def is_blank(c) -> Column:
    """LTRIM(RTRIM(ISNULL(x,''))) = ''."""
    return F.trim(F.coalesce(col_(c), F.lit(""))) == ""


def canon(c) -> Column:
    """Canonical comparison key: upper(trim(x)) (case-insensitive collation)."""
    return F.upper(F.trim(col_(c)))


NATURAL_KEY = "UTF8_LCASE"  # the server's default collation: case does not count, accents do


def ci(c) -> Column:
    """Text as the database compares it: without outer blanks, under a case-insensitive collation.

    Joins, groups and distinct rows on it hold ``Calle 1`` and ``CALLE 1`` for one key.
    """
    return F.collate(F.trim(col_(c)), NATURAL_KEY)


def tsql_len(c) -> Column:
    """T-SQL LEN ignores trailing blanks."""
    return F.length(F.rtrim(col_(c)))


def left(c, n: int) -> Column:
    return F.substring(col_(c), 1, n)


def strip_crlf(c) -> Column:
    """REPLACE(REPLACE(x, CHAR(13), ''), CHAR(10), '')."""
    return F.translate(col_(c), "\r\n", "")


def file_name(c) -> Column:
    """File name from a path (last component after / or \\)."""
    return F.element_at(F.split(col_(c), r"[\\/]"), -1)


def xml_escape(c) -> Column:
    """Escape the five XML special characters of a text value."""
    x = col_(c).cast("string")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def xml_element(tag: str, c) -> Column:
    """<tag>value</tag>; NULL values produce no element (FOR XML PATH default)."""
    return F.when(col_(c).isNull(), F.lit("")).otherwise(
        F.concat(F.lit(f"<{tag}>"), xml_escape(c), F.lit(f"</{tag}>")))


def sha256_hex(c) -> Column:
    """HASHBYTES('SHA2_256', varchar) as lowercase hex."""
    return F.sha2(col_(c).cast("string"), 256)


def sha256_hex_utf16(c) -> Column:
    """HASHBYTES('SHA2_256', nvarchar): the digest of the UTF-16LE bytes."""
    return F.sha2(F.encode(col_(c).cast("string"), "UTF-16LE"), 256)


# ---------------------------------------------------------------------------
# Numbers and money text
def parse_money(c) -> Column:
    """'$ 1.234,56' -> 1234.56 (dot = thousands, comma = decimal), invalid -> NULL.

    Strips '$', blanks and apostrophes, deletes dots, turns the comma into the
    decimal point, then TRY_CAST to DECIMAL(12,2). "1234.56" therefore becomes
    123456 by design (the reference treats dots as thousands separators).
    """
    cleaned = F.replace(F.translate(col_(c), "$ '.", ""), F.lit(","), F.lit("."))
    return F.when(cleaned == "", F.lit(None).cast("decimal(12,2)")).otherwise(cleaned.try_cast("decimal(12,2)"))


def parse_amount_or_zero(c, precision: int = 18) -> Column:
    """Blank/NULL amount text -> 0 (blanks alone are blank text, as trailing blanks do
    not count in a comparison), otherwise money parse (unparseable -> NULL)."""
    raw = col_(c)
    cleaned = F.replace(F.translate(raw, ". ", ""), F.lit(","), F.lit("."))
    return F.when(raw.isNull() | (F.rtrim(raw) == ""), dec(0, precision, 2)).otherwise(
        cleaned.try_cast(f"decimal({precision},2)"))


def try_decimal_comma(c, precision: int, scale: int) -> Column:
    """Comma->dot then TRY_CAST (coefficient column of the unit file)."""
    return F.replace(F.trim(col_(c)), F.lit(","), F.lit(".")).try_cast(f"decimal({precision},{scale})")


def format_es_ar(c) -> Column:
    """FORMAT(x,'N2','es-AR'): '1.234.567,89'."""
    return F.translate(F.format_number(col_(c).cast("decimal(38,2)"), 2), ",.", ".,")


def money_text(amount) -> Column:
    """Bank-file style amount text '$ 1.234,56' from a DECIMAL(*,2), exact."""
    c = cents(amount)
    whole = F.format_number(int_div(c, F.lit(100)), 0)
    frac = F.lpad((c % 100).cast("string"), 2, "0")
    return F.concat(F.lit("$ "), F.translate(whole, ",", "."), F.lit(","), frac)


def clamp(c, lo=-AMOUNT_CEILING, hi=AMOUNT_CEILING) -> Column:
    """Clamp to [lo, hi] (amount ceiling of charges and expenses)."""
    x = col_(c)
    return F.when(x > F.lit(hi), F.lit(hi)).when(x < F.lit(lo), F.lit(lo)).otherwise(x)


# ---------------------------------------------------------------------------
# Dates
def to_date_(c) -> Column:
    """TIMESTAMP_NTZ (test parquet) or string -> DATE."""
    return F.to_date(col_(c))


def parse_dmy(c) -> Column:
    """TRY_CONVERT(DATE, x, 103): d/m/yyyy, invalid -> NULL."""
    return F.try_to_date(F.trim(col_(c)), "d/M/yyyy")


def format_dmy(c) -> Column:
    """CONVERT(VARCHAR(10), d, 103): dd/MM/yyyy."""
    return F.date_format(col_(c), "dd/MM/yyyy")


def us_week(c) -> Column:
    """DATEPART(week, d) with US defaults: week 1 holds Jan 1, weeks start on Sunday."""
    d = col_(c)
    return (F.floor((F.dayofyear(d) + F.dayofweek(F.trunc(d, "year")) - 2) / 7) + 1).cast("int")


def month_boundaries(start, end) -> Column:
    """DATEDIFF(MONTH, start, end): number of month boundaries crossed."""
    s, e = col_(start), col_(end)
    return ((F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))).cast("int")


def month_start(c) -> Column:
    return F.trunc(col_(c), "month")


def next_month_start(c) -> Column:
    return F.add_months(F.trunc(col_(c), "month"), 1)


def due_date(year, month, day) -> Column:
    """DATEFROMPARTS(y, m, day) clamped to the month's last day (EOMONTH)."""
    first = F.make_date(col_(year), col_(month), F.lit(1))
    day_c = day if isinstance(day, Column) else F.lit(int(day))
    return F.least(F.date_add(first, day_c - 1), F.last_day(first))


def es_month_name(month_number) -> Column:
    """Lowercase Spanish month name of a month number (NULL outside 1..12)."""
    arr = F.array(*[F.lit(m) for m in SPANISH_MONTHS])
    m = col_(month_number)
    return F.when(m.between(1, 12), F.element_at(arr, m.cast("int")))


def es_month_title(month_number) -> Column:
    """Capitalised Spanish month name: 'Enero'."""
    name = es_month_name(month_number)
    return F.concat(F.upper(F.substring(name, 1, 1)), F.substring(name, 2, 20))


def es_month_number(text) -> Column:
    """CASE LOWER(x) WHEN 'enero' THEN 1 ... ELSE NULL (after trimming)."""
    t = F.lower(F.trim(col_(text)))
    out = None
    for i, name in enumerate(SPANISH_MONTHS, start=1):
        out = F.when(t == name, F.lit(i)) if out is None else out.when(t == name, F.lit(i))
    return out.otherwise(F.lit(None).cast("int")).cast("int")


def year_range(c, year: int) -> Column:
    """YEAR(c) = year, written as a half-open date range so it reaches the scan."""
    import datetime as _dt

    return (col_(c) >= F.lit(_dt.date(year, 1, 1))) & (col_(c) < F.lit(_dt.date(year + 1, 1, 1)))


def display_unit(floor, door) -> Column:
    """Piso + ' - ' + Depto (NULL if either part is NULL, as T-SQL '+')."""
    return F.concat(col_(floor), F.lit(" - "), col_(door))
