"""Readers of the raw input files (A-01 .. A-07) and writers of the same formats.

Readers declare every schema (all text; conversion happens later with ``try_*``),
keep malformed lines in a corrupt-record column instead of failing, and expose the
source file name. Paths are plain arguments (never spliced into SQL).

Writers lay a DataFrame out in the reference's formats so a round trip can be
checked; JSON arrays are written one document per (building, year) folder so every
array holds at most twelve objects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as X
from ..schemas import EXPENSES_JSON, FILES
from ..session import path_bytes, tasks_for

CORRUPT = "_corrupt_record"


class TooManyBadRows(ValueError):
    pass


def _csv(spark: SparkSession, path: str, schema: T.StructType, sep: str, header: bool) -> DataFrame:
    s = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    return (spark.read.schema(s).option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("encoding", "UTF-8")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(path))


def with_file_name(df: DataFrame) -> DataFrame:
    """A-14: the file name of each row's source file (last path component)."""
    return df.withColumn("file_name", F.col("_metadata.file_name"))


def count_malformed_lines(spark: SparkSession, path: str, sep: str, n_fields: int) -> int:
    """Lines whose field count differs from the layout (one aggregate over the text;
    the delimited files carry no quoting, as the bulk loader declares none)."""
    import re as _re

    lines = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    n = F.size(F.split(F.col("value"), _re.escape(sep), -1))
    return lines.agg(F.count_if(n != n_fields).alias("bad")).first()["bad"]


def check_bad_rows(spark: SparkSession, path: str, sep: str, n_fields: int, max_errors: int) -> int:
    """Fail when more than ``max_errors`` lines are malformed (bulk-load tolerance)."""
    bad = count_malformed_lines(spark, path, sep, n_fields)
    if bad > max_errors:
        raise TooManyBadRows(f"{bad} malformed lines exceed the tolerance of {max_errors}")
    return bad


def read_units_tsv(spark: SparkSession, path: str, max_errors: int = 1000, header: bool = True) -> DataFrame:
    """A-01: tab-delimited units file, header line skipped, UTF-8. Lines whose field count
    differs from the layout are skipped; more than ``max_errors`` of them fail the read."""
    check_bad_rows(spark, path, "\t", len(FILES["units_tsv"].fields), max_errors)
    df = with_file_name(_csv(spark, path, FILES["units_tsv"], "\t", header))
    # a line is known to be malformed only where all its fields are read, whatever is selected later
    fields = F.concat_ws("", *FILES["units_tsv"].fieldNames())
    return df.filter(F.col(CORRUPT).isNull() & (F.length(fields) >= 0))


def read_people_csv(spark: SparkSession, path: str) -> DataFrame:
    """A-02: semicolon-delimited people file with header."""
    return _csv(spark, path, FILES["people_csv"], ";", True)


def read_accounts_csv(spark: SparkSession, path: str) -> DataFrame:
    """A-03: pipe-delimited account -> unit file with header."""
    return _csv(spark, path, FILES["accounts_csv"], "|", True)


def read_payments_csv(spark: SparkSession, path: str) -> DataFrame:
    """A-04: comma-delimited bank file, every column text (quoted amounts allowed)."""
    return _csv(spark, path, FILES["payments_csv"], ",", True)


def read_expenses_json(spark: SparkSession, path: str) -> DataFrame:
    """A-05: whole-file JSON arrays of objects; each array element becomes a row."""
    return (spark.read.schema(EXPENSES_JSON).option("multiLine", True).option("recursiveFileLookup", True)
            .json(path))


def read_buildings_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A-06: sheet export with a header row; columns renamed by header name."""
    df = _csv(spark, path, FILES["buildings_sheet"], ",", True)
    return df.select(
        F.col("Consorcio").alias("source_code"), F.col("`Nombre del consorcio`").alias("name"),
        F.col("Domicilio").alias("address"), F.col("`Cant unidades funcionales`").alias("unit_count_raw"),
        F.col("`m2 totales`").alias("area_raw"))


def read_providers_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A-07: headerless cell range, positional columns F1..F4."""
    return _csv(spark, path, FILES["providers_sheet"], ",", False).drop(CORRUPT)


# ---------------------------------------------------------------------------
def write_delimited(df: DataFrame, path: str, sep: str, header: bool = True) -> str:
    (df.write.mode("overwrite").option("sep", sep).option("header", header)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def write_expenses_json(df: DataFrame, path: str) -> str:
    """One JSON array document per (building, year): ``<path>/part=<b>_<y>/*.txt``."""
    keys = ["Nombre del consorcio", "Mes"] + [f for f in EXPENSES_JSON.fieldNames() if f not in ("Nombre del consorcio", "Mes")]
    obj = F.to_json(F.struct(*[F.col(f"`{k}`").alias(k) for k in keys]), {"ignoreNullFields": "false"})
    docs = (df.withColumn("_o", obj)
            .withColumn("_m", X.es_month_number(F.col("Mes")))
            .groupBy(F.concat_ws("_", F.col("`Nombre del consorcio`"), F.col("year").cast("string")).alias("part"))
            .agg(F.concat(F.lit("["), F.expr("listagg(_o, ',') within group (order by _m)"), F.lit("]")).alias("value")))
    docs.write.mode("overwrite").partitionBy("part").text(path)
    return path


def write_json_arrays(df: DataFrame, obj: str, part: str, path: str) -> str:
    """One JSON array file for each value of ``part``, one object a line: ``<path>/part=<value>/*.txt``.

    A task writes the arrays of its parts as their rows arrive, in any order, so none is sorted or held.
    """
    spark = df.sparkSession
    rows = df.select(F.col(part).alias("part"), F.to_json(obj).alias("value")).filter(F.col("part").isNotNull())
    schema = rows.schema
    n = tasks_for(spark, sum(path_bytes(spark, f) for f in df.inputFiles()))
    arrays = rows.repartition(n, "part").mapInArrow(_array_lines, schema)
    # a file of every part is open while its task runs, where Spark would sort the rows by part
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "1000")
    try:
        arrays.write.mode("overwrite").partitionBy("part").text(path)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    return path


def _array_lines(batches):
    """Lines of JSON arrays: a bracket before a part's first object, a comma before the others, a bracket at the end."""
    import pyarrow as pa
    import pyarrow.compute as pc

    open_, names = set(), None
    for batch in batches:
        names = batch.schema
        parts = batch.column("part")
        signs = pa.repeat(pa.scalar(","), len(batch))
        fresh = {v: i for i, v in reversed(list(enumerate(parts.to_pylist()))) if v not in open_}
        if fresh:
            first = set(fresh.values())
            signs = pa.array(["[" if i in first else "," for i in range(len(batch))])
            open_ |= set(fresh)
        yield pa.record_batch([parts, pc.binary_join_element_wise(signs.cast(names.field("value").type),
                                                                  batch.column("value"), "")], schema=names)
    if open_:
        ends = sorted(open_)
        yield pa.record_batch([pa.array(ends, names.field("part").type),
                               pa.array(["]"] * len(ends), names.field("value").type)], schema=names)


def write_xml(df: DataFrame, path: str, root_tag: str, row_tag: str, attributes: tuple[str, ...] = ()) -> str:
    """A-10 whole-file sink with Spark's XML data source: one ``root_tag`` document per
    output file, one ``row_tag`` element per row; ``attributes`` become XML attributes
    (the data source's ``_``-prefix convention), e.g. ``Moroso DNI="..."``."""
    cols = [F.col(c).alias(f"_{c}") if c in attributes else F.col(c) for c in df.columns]
    (df.select(*cols).write.mode("overwrite").format("xml")
     .option("rootTag", root_tag).option("rowTag", row_tag).save(path))
    return path


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", row_tag)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
