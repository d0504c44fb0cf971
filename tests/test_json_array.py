"""Arrays read in byte ranges against Spark's whole-file reader."""

import json
import os
import random

import pytest
from pyspark.sql import types as T

from strata.session import shared_dir
from strata.sources.json_array import read_json_array

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("more", T.StructType([T.StructField("list", T.ArrayType(T.StructType([
                           T.StructField("x", T.StringType())])))]))])
NASTY = ['}', '"', '\\', '\\"', '}{', ']},{"', 'é}漢', '\\}', '\n}', '[', '"}"', '\\\\"}', '', 'plain', ' }', "{}{}"]


def objects(rng, n):
    return [{"id": i, "text": "".join(rng.choices(NASTY, k=rng.randrange(5))),
             "more": rng.choice([None, {"list": []}, {"list": [{"x": rng.choice(NASTY)} for _ in range(rng.randrange(4))]}])}
            for i in range(n)]


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_elements_cut_anywhere(spark, small_splits):
    rng = random.Random(6)
    folder = shared_dir(spark, "tests", "json-array")
    os.makedirs(folder)
    every = []
    for k, style in enumerate([{}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False}]):
        rows = objects(rng, 120)
        every += rows
        with open(f"{folder}/{k}.json", "w", encoding="utf-8") as f:
            f.write(" \n" * k + json.dumps(rows, **style) + "\n" * k)
    for name, text in {"empty": "[]", "nothing": "", "one": '{"id": 7, "more": {"list": [{"x": "}"}]}}'}.items():
        with open(f"{folder}/{name}.json", "w") as f:
            f.write(text)
    got = read_json_array(spark, folder, SCHEMA)
    whole = spark.read.schema(SCHEMA).option("multiLine", True).json(folder)
    assert spark.read.option("lineSep", "}").text(folder).rdd.getNumPartitions() > 100
    key = lambda df: sorted(str(r.asDict(True)) for r in df.collect())
    assert key(got) == key(whole.filter("id is not null"))
    assert key(got) == sorted(str(x) for x in [*every, {"id": 7, "text": None, "more": {"list": [{"x": "}"}]}}])


def test_what_is_no_object(spark, small_splits):
    path = shared_dir(spark, "tests", "json-array")
    os.makedirs(path)
    with open(f"{path}/a.json", "w") as f:
        f.write('[1, "a}b", {"id": 1}, [2], null, {"id": 2, "text": "x"}, "}{"]')
    assert sorted(r.id for r in read_json_array(spark, path, SCHEMA).collect()) == [1, 2]
