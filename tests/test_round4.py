"""Tasks grow in number with the data, not in size (findings of round 3)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sf_paths import SF_SMALL
from strata import session
from strata.plans import reports as R
from strata.session import shared_dir
from strata.sources import files as FL
from strata.sources import json_array
from strata.sources.adapter import Ledger


@pytest.fixture
def small_tasks(spark, monkeypatch):
    """Tasks for very few bytes, so that small tables are large ones."""
    keys = [session._FIRST_PARTS, session._PART_BYTES]
    old = {k: spark.conf.get(k, None) for k in keys}
    monkeypatch.setattr(session, "TASK_BYTES", 4096)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_json_arrays_are_dealt_by_their_size(spark, small_tasks, monkeypatch):
    monkeypatch.setattr(json_array, "BLOCK", 16)  # pieces
    rows = [(i, i % 3 if i % 50 else None, '"}], {\\' + str(i) + "}{" * (i % 4)) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, part int, text string")
    path = FL.write_json_arrays(df.select("part", F.struct("id", "text").alias("o")), "o", "part", shared_dir(spark, "tests"))
    stored = [json.loads("".join(r.value + "\n" for r in spark.read.text(f"{path}/part={k}").collect())) for k in range(3)]
    expected = sorted((i, t) for i, p, t in rows if p is not None)
    assert sorted((o["id"], o["text"]) for a in stored for o in a) == expected
    got = json_array.read_json_array(spark, path, df.select("id", "text").schema)
    assert got.rdd.getNumPartitions() > 10  # one task a few kilobytes, whatever the files and splits
    assert sorted((r.id, r.text) for r in got.collect()) == expected


def test_json_array_writer_keeps_objects_of_many_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(100).select((F.col("id") % 2).alias("part"), F.struct("id").alias("o"))
        path = FL.write_json_arrays(df, "o", "part", shared_dir(spark, "tests"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    for k in range(2):
        files = [f for f in os.listdir(f"{path}/part={k}") if f.endswith(".txt")]
        assert len(files) == 1
        with open(f"{path}/part={k}/{files[0]}") as f:
            assert sorted(o["id"] for o in json.load(f)) == [i for i in range(100) if i % 2 == k]


def test_ledger_tables_are_dealt_by_the_size_of_the_input(spark, small_tasks):
    lazy = Ledger(spark, SF_SMALL)
    stored = lazy.materialize()
    assert lazy.tasks > 20 and stored.small
    for name in ("apportion_final", "apportion_carried", "apportionment"):
        table = getattr(stored, name)
        plan = table.groupBy("unit_id").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and f"SelectedBucketsCount: {lazy.tasks} out of {lazy.tasks}" in plan
        assert len(table.inputFiles()) <= lazy.tasks
        cols = table.columns
        expected = getattr(lazy, name).select(*cols)
        assert table.exceptAll(expected).isEmpty() and expected.exceptAll(table).isEmpty()


def test_positions_store_what_is_asked_for(spark):
    rows = [(1, "b", 10, None), (1, "a", 11, 5), (2, "a", 12, 1), (1, "a", 13, 2), (2, None, 14, 3)]
    df = spark.createDataFrame(rows, "charge_no long, unit_label string, unit_id long, debt int")
    out = R.positions("statement_units", df, ["charge_no", "unit_label", "unit_id"])
    assert out.columns == ["charge_no", "unit_label", "unit_id", "position"]
    assert [(r.position, r.unit_id) for r in out.orderBy("position").collect()] == [(1, 13), (2, 11), (3, 10), (4, 14), (5, 12)]
    debtors = spark.createDataFrame([("x", 1, None), ("y", 2, 5), ("z", 3, 7)], "dni string, charge_no long, debt int")
    found = R.positions("statement_debtors", debtors).orderBy("position").collect()
    assert [r.dni for r in found] == ["x", "z", "y"]


def test_tasks_stay_small_where_the_cluster_has_partitions_enough(spark, small_tasks):
    spark.conf.unset(session._PART_BYTES)
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session.tasks_for(spark, 4096) == own
    assert spark.conf.get(session._PART_BYTES) == "16m"
    spark.conf.set(session._PART_BYTES, "3m")  # the cluster's word holds
    session.tasks_for(spark, 4096)
    assert spark.conf.get(session._PART_BYTES) == "3m"
