"""One JSON array of objects as many tasks: elements found from byte ranges.

``spark.read.json(multiLine=True)`` reads a file in one task. Here Spark's text source cuts files at ``}`` instead of at
line ends, so a file of any size, on one line or many, is read in splits on whatever store Spark reads. A piece of text
between two ``}`` knows by itself what it does to the state before it: whether it turns a string on or off (an odd number
of quotes), and by how much the nesting grows, for either state. Running sums over the pieces in file order give every
piece its state: inside blocks of some thousand pieces, for either state of the block, and over one row a block. A ``}``
outside strings that brings the nesting back to the array's ends an element; pieces of one element are put together and
parsed. Blocks and elements are dealt over tasks by the size of the text, so a task holds a few megabytes of it whatever
the size of the files and their splits.

JSON escapes nothing but quotes, slashes, backslashes, controls and code units, so no escape lies across a ``}``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_bytes, shared_dir, tasks_for

_BLANK = " \t\r\n\ufeff"


def _count(text: Column, *chars: str) -> Column:
    """How many of these characters a text has."""
    return F.length(text) - F.length(F.translate(text, "".join(chars), ""))


BLOCK = 4096  # pieces
_PLACE = ("file", "split", "block")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, block, pos, value, odd, grows_out, grows_in): text before each ``}``, and what it does to the state;
    stored, since several steps read it."""
    pos = F.monotonically_increasing_id()
    raw = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        pos.alias("pos"), "value").withColumn("block", F.shiftright("pos", BLOCK.bit_length() - 1))
    plain = F.when(F.contains("value", F.lit("\\")), F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))
    parts = raw.withColumn("_p", F.split(plain, '"', -1))

    def grows(which: int) -> Column:
        outside = F.array_join(F.filter("_p", lambda x, i: i % 2 == which), "")
        return (_count(outside, "{", "[") - _count(outside, "]")).cast("bigint")

    parts = parts.select(*_PLACE, "pos", "value", ((F.size("_p") - 1) % 2).cast("bigint").alias("odd"),
                         grows(0).alias("grows_out"), grows(1).alias("grows_in"))
    stored = shared_dir(spark, "files", "json-pieces")
    parts.write.parquet(stored)
    return spark.read.schema(parts.schema).parquet(stored)


def _inside(p: DataFrame) -> DataFrame:
    """For a block that starts outside (0) or inside (1) a string: whether a piece ends outside strings, and the nesting
    after its own ``}``, which closes only there, over that at the block's start."""
    before = Window.partitionBy(*_PLACE).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*_PLACE).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    p = p.withColumn("quotes", F.coalesce(F.sum("odd").over(before), F.lit(0)))
    for start in (0, 1):
        out = (F.lit(start) + F.col("quotes") + F.col("odd")) % 2 == 0
        grows = F.when((F.lit(start) + F.col("quotes")) % 2 == 1, F.col("grows_in")).otherwise(F.col("grows_out"))
        p = p.withColumn(f"out{start}", out).withColumn(f"grows{start}", grows - out.cast("bigint"))
    return p.withColumns({f"deep{start}": F.sum(f"grows{start}").over(upto) for start in (0, 1)})


def _block_starts(p: DataFrame) -> DataFrame:
    """(file, split, block, inside, depth): the state at the start of every block, from one row a block."""
    before = Window.partitionBy("file").orderBy("split", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = p.groupBy(*_PLACE).agg(F.sum("odd").alias("odd"), F.sum("grows0").alias("grows0"), F.sum("grows1").alias("grows1"))
    blocks = blocks.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    grows = F.when(F.col("inside") == 1, F.col("grows1")).otherwise(F.col("grows0"))
    return blocks.withColumn("_g", grows).select(*_PLACE, "inside", F.coalesce(F.sum("_g").over(before), F.lit(0)).alias("depth"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The objects of the JSON arrays in ``path`` (a file or folders of files), one row each; a file may also hold one
    object. What is no object in an array is no row; an element that is no JSON is a row of NULLs."""
    n = tasks_for(spark, path_bytes(spark, path))
    stored = _pieces(spark, path)
    # whether a file's first piece opens an array, beside its place: a number needs no sort to find the first
    opens = F.startswith(F.ltrim("value", F.lit(_BLANK)), F.lit("[")).cast("bigint")
    roots = stored.filter("split = 0").groupBy("file").agg(F.pmod(F.min(2 * F.col("pos") + opens), F.lit(2)).alias("root"))
    p = _inside(stored.repartition(n, *_PLACE))
    inside = F.col("inside") == 1
    p = p.join(_block_starts(p), [*_PLACE]).join(roots, "file")
    ends = F.when(inside, F.col("out1")).otherwise(F.col("out0")) \
        & (F.col("depth") + F.when(inside, F.col("deep1")).otherwise(F.col("deep0")) == F.col("root"))
    p = p.select(*_PLACE, "pos", "value", ends.alias("ends"))
    # an element goes by the place of the end before it: in its block, else the last one of an earlier block
    end = F.when(F.col("ends"), F.struct("split", "pos"))
    earlier = Window.partitionBy("file").orderBy("split", "block").rowsBetween(Window.unboundedPreceding, -1)
    lasts = p.groupBy(*_PLACE).agg(F.max(end).alias("_last")).select(*_PLACE, F.max("_last").over(earlier).alias("_before"))
    before = Window.partitionBy(*_PLACE).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    p = p.withColumn("_here", F.max(end).over(before)).join(lasts, [*_PLACE]) \
        .select("file", "split", "pos", "value", "ends", F.coalesce("_here", "_before").alias("after"))
    p = p.select("*", F.col("after.split").alias("after_split"), F.col("after.pos").alias("after_pos")).drop("after") \
        .repartition(n, "file", "after_split", "after_pos")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "pos", "value"))), lambda x: x["value"]), "}")
    # the array's bracket, or the comma after the element before
    text = F.regexp_replace(whole, r"^[\s\x{FEFF}]*[\[,]?\s*", "")
    found = p.groupBy("file", "after_split", "after_pos").agg(text.alias("text"), F.max("ends").alias("ends")).filter("ends")
    # scalars and arrays between two objects come before the object that ends here
    last = F.element_at(F.from_json(F.concat(F.lit("["), "text", F.lit("}]")), T.ArrayType(T.StringType())), -1)
    one = F.when(F.startswith("text", F.lit("{")), F.concat("text", F.lit("}"))).otherwise(last)
    return found.select(F.from_json(one, schema).alias("o")).select("o.*")
