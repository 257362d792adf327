"""What a task holds doesn't grow with the tables."""

import os

import duckdb
import pandas as pd
import pytest

from episodica.plans import adapters, catalog
from episodica.sources import writers

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["mask_overlaps", "mask_decode"])
def test_frames_take_more_tasks_not_larger_ones(spark, monkeypatch, name):
    monkeypatch.setattr(adapters, "TASK_EVENTS", 50)
    n = spark.read.parquet(f"{SF}/events.parquet").count()
    assert n // 50 > 4 and adapters.frames(spark, SF).rdd.getNumPartitions() == n // 50
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    got = catalog.QUERIES[name](spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(f"select {', '.join(got.columns)} from ({catalog.ORACLES[name]})").fetchall())


def test_logs_are_read_in_pieces(spark):
    """Three logs of 25 records come to one task; it gives on ten records at once."""
    df = spark.createDataFrame([(e, i, i / 30, f"{e}-{i}") for e in range(3) for i in range(25)], "e long, i int, t double, body string")
    logs = writers.message_log(df, "e", "i", "t", df["body"]).coalesce(1)
    got = writers.read_message_log(logs, "e", most=10)
    assert sorted(r["payload"] for r in got.collect()) == sorted(f"{e}-{i}" for e in range(3) for i in range(25))
    sizes = got.select("payload").mapInPandas(lambda pdfs: (pd.DataFrame({"n": [len(p)]}) for p in pdfs), "n int").collect()
    assert sum(r["n"] for r in sizes) == 75


def test_frames_are_bounded_where_partitions_outnumber_cores(spark, monkeypatch):
    """Spark would join 200 small partitions to one a core."""
    monkeypatch.setattr(adapters, "TASK_EVENTS", 50)
    n = spark.read.parquet(f"{SF}/events.parquet").count() // 50
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert spark.sparkContext.defaultParallelism < n < 200 and adapters.frames(spark, SF).rdd.getNumPartitions() == n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
