"""Files by value, matrices by number, the month's products, and finds in one record."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from wildgrid.operators import matrix as M
from wildgrid.plans import jobs, registry
from wildgrid.sources import io


def test_hot_values_are_split_and_small_ones_share_a_task(spark, tmp_path):
    """However many tasks there were: few files for each value, in all as many as the bytes ask for."""
    df = spark.range(400_000, numPartitions=16).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 40)).alias("k"))
    key, before = "spark.sql.adaptive.advisoryPartitionSizeInBytes", spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set(key, "4m")
    try:
        io.write_by(df, str(tmp_path / "out"), "k")
    finally:
        spark.conf.set(key, before)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 400_000 and back.select("k").distinct().count() == 9
    files = {p: len(glob.glob(f"{p}/*.parquet")) for p in glob.glob(str(tmp_path / "out" / "k=*"))}
    hot = files.pop(str(tmp_path / "out" / "k=hot"))
    # a value that shares the hot one's range of the shuffle is split along with it
    assert 3 <= hot <= 12 and max(files.values()) <= hot and sorted(files.values())[len(files) // 2] <= 2


def test_matrices_by_number(spark, tmp_path):
    rnd = random.Random(2)
    rows = sorted({(f"r{rnd.randrange(50)}", rnd.choice(["é", "z", "Z", "a b", "10", "9"])) for _ in range(150)})
    cells = spark.createDataFrame([(r, c, k + 1) for k, (r, c) in enumerate(rows)], "row string, col string, value long").repartition(7)
    io.write_bundle(M.encoded(cells), str(tmp_path / "m"), by={"cells": "block"})
    tables, _ = io.read_bundle(spark, str(tmp_path / "m"))
    back = M.decoded(tables)
    assert back.select("row", "col", "value").exceptAll(cells).count() == 0 and back.count() == len(rows)
    for axis, place in (("rows", 0), ("cols", 1)):
        labels = sorted({r[place] for r in rows}, key=lambda x: x.encode())
        assert [(r.id, r.label) for r in tables[axis].orderBy("id").collect()] == list(enumerate(labels))
    tables["rows"] = tables["rows"].where("id <> 3")
    with pytest.raises(Exception, match="no label of row 3"):
        M.decoded(tables).collect()
    none = M.decoded(M.encoded(cells.limit(0)))
    assert none.count() == 0


def test_one_record_is_annotated_alone(spark):
    """The plan of the record's annotation filters before it meets a layer."""
    from wildgrid.plans.views import annotated

    one = annotated(spark, "/root/testdata/sf0.001", where=F.col("gbifid") == 1)
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert "o_orderkey" in plan and "= 1)" in plan and one.count() <= 1


def test_every_product_of_a_month_is_delivered_twice(spark):
    found = registry.queries()["job_monthly"](spark, "/root/testdata/sf0.001")
    by = {(r.sink, r.kind): r["count"] for r in found.groupBy("sink", "kind").count().collect()}
    assert set(by) == {(s, k) for s in jobs.counts.PRODUCTS for k in ("parquet", "csv")}
    for s in jobs.counts.PRODUCTS:
        assert by[s, "parquet"] == by[s, "csv"] > 0
        csv, parquet = (sorted(tuple(r)[2:] for r in found.where((F.col("sink") == s) & (F.col("kind") == k)).collect()) if not s.startswith("list") else None for k in ("csv", "parquet"))
        assert csv is None or csv == parquet or len(csv) == len(parquet)


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 20_001])
def test_medians_are_exact(spark, n):
    import statistics

    rnd = random.Random(n)
    rows = [(rnd.randrange(10**6), rnd.choice([1, 1, 1, 2, 50]), None if k % 3 else k) for k in range(n)]
    df = spark.createDataFrame(rows, "a long, b long, c long").repartition(5)
    found = M.medians(df, "a", "b", "c").first()
    want = [statistics.median([r[k] for r in rows if r[k] is not None]) for k in range(3)]
    assert list(found) == want
    assert list(M.medians(df.limit(0), "a", "b").first()) == [None, None]


def test_positions_follow_the_order_of_files(spark, tmp_path):
    from wildgrid.operators import records

    parts = [spark.range(k, 30_000, 3).select("id", F.lit(k).alias("k")) for k in (2, 0, 1)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        io.write_parquet(records.merge_sorted("id", *parts), str(tmp_path / "m"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(glob.glob(str(tmp_path / "m" / "part-*"))) > 1
    back = io.positions(spark, str(tmp_path / "m"))
    assert back.where("id <> position").count() == 0 and back.count() == 30_000


def test_scratch_tables_are_released(spark):
    """Jobs leave their tables for the frames that read them; the caller deletes them all, and later queries make theirs anew."""
    from wildgrid.plans.views import annotated_table

    d = "/root/testdata/sf0.001"
    rows = annotated_table(spark, d).count()
    path = io.scratch(spark, "kept")
    io.write_parquet(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3 and io.release(spark) >= 2
    with pytest.raises(Exception):
        spark.read.parquet(path)
    assert annotated_table(spark, d).count() == rows


def test_a_database_of_files_keeps_values_and_rows(spark):
    """Replaced, then appended from several files; nulls, empty and odd texts, read by several tasks."""
    import datetime

    odd = ["", None, " edges ", 'a "quote", a comma', "two\nlines", "é\\n", "NULL", "'", ","]
    rows = [(k, odd[k % len(odd)], k / 7 if k % 3 else None, datetime.date(2024, 1, 2 + k % 9), k % 2 == 0) for k in range(90)]
    df = spark.createDataFrame(rows, "id long, text string, value double, day date, even boolean").repartition(4)
    at = io.database(spark, "database")
    io.fill_database(df.limit(7), at, "kept", replace=True)
    with pytest.raises(ValueError, match="not .'now'"):
        io.fill_database(df.withColumn("now", F.current_timestamp()), at, "kept")
    io.fill_database(df.where("id < 50"), at, "kept", replace=True)
    first = io.open_database(spark, at)
    io.fill_database(df.where("id >= 50"), at, "kept")
    back = io.jdbc_parts(spark, io.open_database(spark, at), "kept", "id", parts=3, **io.DERBY)
    assert back.rdd.getNumPartitions() == 3
    assert sorted(tuple(r) for r in back.collect()) == rows
    assert io.jdbc(spark, first, "kept", **io.DERBY).count() == 50
    io.fill_database(df.limit(0), at, "kept", replace=True)
    assert io.jdbc_parts(spark, io.open_database(spark, at), "kept", "id", **io.DERBY).count() == 0


def test_rows_go_through_the_writer_of_a_real_database(spark):
    """``write_jdbc`` itself, on a database inside the one process of a local session."""
    url = "jdbc:derby:memory:real;create=true"
    io.write_jdbc(spark.range(5), url, "written", replace=True, **io.DERBY)
    io.write_jdbc(spark.range(5, 8), url, "written", **io.DERBY)
    assert sorted(r[0] for r in io.jdbc(spark, url, "written", **io.DERBY).collect()) == list(range(8))


@pytest.mark.parametrize("name", ["scan_jdbc", "sink_jdbc"])
def test_databases_are_seen_by_executors_of_their_own(tmp_path, name):
    """Executors are two other processes."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    code = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.executor.memory", "600m").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate()
from wildgrid.plans import registry
d = "/root/testdata/sf0.01"
back = registry.queries()["{name}"](spark, d)
want = spark.read.parquet(d + "/supplier.parquet").select("s_suppkey", "s_acctbal")
assert back.count() == want.count() and back.exceptAll(want).count() == 0
spark.stop()
"""
    repo = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": repo}, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-3000:]


@pytest.mark.parametrize("replace", [False, True])
def test_a_table_is_made_without_a_task(spark, replace):
    """Where it is missing, and where it is there already: executors, which cannot open the database, get nothing to do."""
    at, df = io.database(spark, "database"), spark.range(3)
    group = f"table made, {replace}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        for _ in range(2):
            io.make_table(df, at, "made", replace)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    assert not [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    io.fill_database(df, at, "made")
    back = io.jdbc(spark, io.open_database(spark, at), "made", **io.DERBY)
    assert sorted(r[0] for r in back.collect()) == [0, 1, 2]


def test_databases_need_no_python_on_executors(tmp_path):
    """No executor can start Python here."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    code = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate()
from wildgrid.plans import registry
for name in ("sink_jdbc", "scan_jdbc"):
    assert registry.queries()[name](spark, "/root/testdata/sf0.001").count() == spark.read.parquet("/root/testdata/sf0.001/supplier.parquet").count()
spark.stop()
"""
    repo = str(Path(__file__).resolve().parents[1])
    env = {**os.environ, "PYTHONPATH": repo, "PYSPARK_PYTHON": str(tmp_path / "none")}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-3000:]
