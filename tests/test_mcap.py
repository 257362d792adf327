"""Logs written and read back, pushed filters, chunks, broken files, failed tasks."""

import os
import struct
from pathlib import Path

import pytest
import zstandard
from pyspark.sql import functions as F

from episodica.sources import mcap


@pytest.fixture
def source(spark):
    spark.dataSource.register(mcap.McapSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    yield spark
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def logs(spark, n=3, rows=50):
    df = spark.range(n * rows).selectExpr("concat('log', id % 3) as log", "if(id % 2 = 0, '/human', '/robot') as topic", "if(id % 2 = 0, 'Human', 'Robot') as schema", "id * 10 as log_time", "cast(concat('{\"id\": ', id, '}') as binary) as data")
    return df.repartition("log").sortWithinPartitions("log", "log_time")


def test_round_trip(source, tmp_path):
    path = f"file://{tmp_path}/logs"
    logs(source).write.format("mcap").mode("append").save(path)
    assert sorted(os.listdir(tmp_path / "logs")) == ["log0.mcap", "log1.mcap", "log2.mcap"]
    got = source.read.format("mcap").load(path)
    assert got.rdd.getNumPartitions() == 3
    rows = got.withColumn("id", F.get_json_object(F.col("data").cast("string"), "$.id").cast("long")).collect()
    assert sorted(r["id"] for r in rows) == list(range(150))
    assert all(r["log_time"] == r["id"] * 10 == r["publish_time"] and r["path"].endswith(f"log{r['id'] % 3}.mcap") and (r["topic"], r["schema"], r["encoding"]) == (("/human", "Human", "json") if r["id"] % 2 == 0 else ("/robot", "Robot", "json")) for r in rows)
    for topic in ("/human", "/robot"):
        seen = sorted((r["path"], r["log_time"], r["sequence"]) for r in rows if r["topic"] == topic)
        assert [s for p, _, s in seen if p.endswith("log0.mcap")] == list(range(25))
    with pytest.raises(Exception, match="there already"):
        logs(source).write.format("mcap").mode("append").save(path)
    assert sorted(os.listdir(tmp_path / "logs")) == ["log0.mcap", "log1.mcap", "log2.mcap"]


def test_columns_and_filters_reach_the_reader(source, tmp_path):
    path = str(tmp_path / "logs")
    logs(source).write.format("mcap").mode("append").save(path)
    few = source.read.format("mcap").option("pushdown", "true").schema("topic string, log_time long").load(path).filter("topic = '/human' and log_time >= 100 and log_time < 400")
    assert sorted(tuple(r) for r in few.collect()) == [("/human", i * 10) for i in range(10, 40, 2)]
    reader = mcap.FilteringReader({"path": path}, few.schema)
    from pyspark.sql.datasource import EqualTo, GreaterThan, StringContains

    other = StringContains(("topic",), "x")
    assert list(reader.pushFilters([EqualTo(("topic",), "/human"), GreaterThan(("log_time",), 5), other])) == [other]
    assert (reader.topics, reader.low) == ({"/human"}, 6)


def test_chunks_and_broken_logs(source, tmp_path):
    inner = mcap.record(mcap.SCHEMA, mcap.field("<H", 7, "S", "jsonschema", "{}")) + mcap.record(mcap.CHANNEL, mcap.field("<H", 9, "<H", 7, "/t", "json", {}))
    inner += b"".join(mcap.record(mcap.MESSAGE, mcap.field("<H", 9, "<I", i, "<Q", i, "<Q", i) + b"x" * i) for i in range(5))
    for how, packed in (("", inner), ("zstd", zstandard.ZstdCompressor().compress(inner))):
        chunk = mcap.field("<Q", 0, "<Q", 4, "<Q", len(inner), "<I", 0, how) + struct.pack("<Q", len(packed)) + packed
        whole = mcap.MAGIC + mcap.record(mcap.HEADER, mcap.field("", "")) + mcap.record(mcap.CHUNK, chunk) + mcap.record(mcap.FOOTER, mcap.field("<Q", 0, "<Q", 0, "<I", 0)) + mcap.MAGIC
        at = tmp_path / f"c{how}.mcap"
        at.write_bytes(whole)
        got = source.read.format("mcap").load(str(at)).orderBy("sequence").collect()
        assert [(r["topic"], r["schema"], r["sequence"], bytes(r["data"])) for r in got] == [("/t", "S", i, b"x" * i) for i in range(5)]
        for cut in (len(whole) - 1, len(whole) - 20, 4, 0):
            at.write_bytes(whole[:cut])
            with pytest.raises(Exception, match="ends within|lacks its end|is no log"):
                source.read.format("mcap").load(str(at)).collect()


def test_a_failed_task_leaves_nothing(source, tmp_path):
    bad = logs(source).withColumn("data", F.when(F.col("log_time") == 1480, F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("data")))
    with pytest.raises(Exception, match="lost"):
        bad.write.format("mcap").mode("append").save(str(tmp_path / "logs"))
    assert [p for p in Path(tmp_path).rglob("*.mcap")] == []
    with pytest.raises(Exception, match="lack the columns"):
        logs(source).drop("topic").write.format("mcap").mode("append").save(str(tmp_path / "logs"))
