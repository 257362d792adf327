"""Ordered passes over streams: shuffled files over several triggers, late rows, contacts that end by timer, a restart, state by groups."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from episodica.plans import catalog
from episodica.streaming import ordered

SCHEMA = "k long, at timestamp, place long, yes boolean"
T0 = dt.datetime(2024, 1, 1)


def rows_of(seed, keys=3, n=40):
    rng = random.Random(seed)
    out = []
    for k in range(keys):
        ms = 0
        for i in range(n):
            ms += rng.choice([0, 100, 400, 400, 2_000, 2_500])
            out.append((k, ms, i, rng.random() < 0.6))
    return out


def plain(rows, hold=2_000, n=3):
    """In order, key by key."""
    out = []
    for k in {r[0] for r in rows}:
        fold, memory = ordered.ContactFold(n, hold), ordered.ContactFold.start
        for _, ms, i, yes in sorted(r for r in rows if r[0] == k):
            if memory[4] >= 0 and memory[4] + hold < ms:
                out += [(k, memory[4] + hold, None, False, 0, "ended")] * memory[0]
                memory = fold.start
            memory, (on, dwell) = fold.take(memory, ms, yes)
            out.append((k, ms, i, on, dwell, "row"))
        out += [(k, memory[4] + hold, None, False, 0, "ended")] * memory[0]
    return sorted(out, key=str)


@pytest.fixture
def stream(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def put(name, rows):
        df = spark.createDataFrame([(k, T0 + dt.timedelta(milliseconds=ms), i, yes) for k, ms, i, yes in rows], SCHEMA)
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run(delay):
        src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        q = ordered.ordered_contacts(src, "k", "at", "place", "yes", delay).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()
        got = spark.read.parquet(str(tmp_path / "out")).withColumn("ms", F.unix_millis("at") - int((T0 - dt.datetime(1970, 1, 1)).total_seconds() * 1000)).collect()
        return sorted(((r["k"], r["ms"], r["place"], r["state"], r["dwell"], r["what"]) for r in got), key=str)

    with ordered.rocksdb_state(spark):
        yield put, run


def test_shuffled_files_give_the_rows_of_a_batch(stream):
    put, run = stream
    rows = rows_of(1)
    mixed = rows[:]
    random.Random(2).shuffle(mixed)
    for i in range(0, len(mixed), 40):
        put(str(i), mixed[i : i + 40])
    put("end", [(99, 10_000_000, 0, False)])
    assert run("1 hour") == plain(rows)


def test_late_rows_are_given_out_and_change_nothing(stream):
    put, run = stream
    rows = rows_of(3, keys=2)
    put("a", rows)
    put("b", [(5, 2_000_000, 0, True)])
    first = run("10 seconds")  # the rows are done, the key of the last one waits
    assert first == plain(rows)
    put("c", [(0, 50, 777, True), (1, 60, 778, True)])
    put("d", [(6, 3_000_000, 0, True)])
    again = run("10 seconds")  # from the checkpoint
    assert again == sorted([*first, (0, 50, 777, None, None, "late"), (1, 60, 778, None, None, "late"), (5, 2_000_000, 0, False, 0, "row")], key=str)


def test_keys_share_state_so_it_grows_by_groups(spark, tmp_path):
    rows = [(k, 100 * (i * 7 % 5), i, i != 2) for k in range(500) for i in range(5)]
    df = spark.createDataFrame([(None if k == 0 else k, T0 + dt.timedelta(milliseconds=ms), i, yes) for k, ms, i, yes in [*rows, (999, 10_000_000, 0, False)]], SCHEMA)
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    with ordered.rocksdb_state(spark):
        q = ordered.ordered_contacts(src, "k", "at", "place", "yes", "1 hour").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert max(o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"]) <= 8 * ordered.GROUPS
    got = spark.read.parquet(str(tmp_path / "out")).withColumn("ms", F.unix_millis("at") - int((T0 - dt.datetime(1970, 1, 1)).total_seconds() * 1000)).collect()
    assert sorted(((r["k"] or 0, r["ms"], r["place"], r["state"], r["dwell"], r["what"]) for r in got), key=str) == plain(rows)
    assert {r["k"] for r in got} == {None, *range(1, 500)}  # a null key is a key of its own


def test_state_has_no_more_partitions_than_cores(spark):
    name = "spark.sql.shuffle.partitions"
    old = spark.conf.get(name)
    try:
        for given, used in (("200", str(spark.sparkContext.defaultParallelism)), ("1", "1")):
            spark.conf.set(name, given)
            with ordered.rocksdb_state(spark):
                assert spark.conf.get(name) == used
            assert spark.conf.get(name) == given
    finally:
        spark.conf.set(name, old)


def test_a_trigger_with_a_part_of_a_slot_brings_no_late_rows(spark, tmp_path):
    # after one row a pause: the first slot has fewer files than a trigger takes
    con = duckdb.connect()
    con.sql("""create table events as select i::bigint as event_id, timestamp '2024-01-01' + (case when i = 0 then 0 when i = 201 then 100000000 else 19000000 + (i * 7919 % 200) * 85000 end)::bigint * interval 1 millisecond as ts,
      (i % 5)::bigint as user_id, case when i % 7 < 4 then 'click' else 'view' end as event_type, 1.0::double as value, '{"k": 1}' as props from range(202) r(i)""")
    con.sql(f"copy events to '{tmp_path}/events.parquet' (format parquet)")
    df = catalog.QUERIES["streaming_contacts"](spark, str(tmp_path))
    want = con.sql(catalog.ORACLES["streaming_contacts"])
    assert sorted(map(str, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect()))) == sorted(map(str, want.select(*sorted(want.columns)).fetchall()))
