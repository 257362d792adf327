"""Streaming queries, and the batch forms of event-time aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import shared_folder
from ..streaming import ordered, stateful
from .adapters import FRAMES, frames, table
from .registry import query


@query(f"""with {FRAMES}, f as (select *, case when count(*) over w3 = 3 and sum(in_contact::int) over w3 = 3 then true when count(*) over w3 = 3 and sum(in_contact::int) over w3 = 0 then false end as flip
  from frames window w3 as (partition by episode_id order by frame_idx rows 2 preceding))
select episode_id, frame_idx, coalesce(last_value(flip ignore nulls) over (partition by episode_id order by frame_idx rows unbounded preceding), false) as state from f""")
def streaming_hysteresis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stateful operator run to the end of a bounded stream, written as files and read back."""
    base = shared_folder(spark, "stream")
    frames(spark, sf_dir).select("episode_id", "frame_idx", "in_contact").write.parquet(f"{base}/in")
    stream = spark.readStream.schema("episode_id long, frame_idx int, in_contact boolean").parquet(f"{base}/in")
    out = stateful.stream_hysteresis(stream, "episode_id", "frame_idx", "in_contact")
    q = out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{base}/out")


@query("select time_bucket(interval '10 minutes', ts) as start, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2")
def window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return stateful.windowed_counts(e, "ts", "event_type", "value").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("""with g as (select *, case when lag(ts) over w is null or ts - lag(ts) over w >= interval '6 hours' then 1 else 0 end as fresh from events window w as (partition by user_id order by ts, event_id)),
 s as (select *, sum(fresh) over (partition by user_id order by ts, event_id rows unbounded preceding) as sid from g)
select user_id, min(ts) as start, max(ts) + interval '6 hours' as "end", count(*) as n from s group by user_id, sid""")
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return stateful.sessions(e, "ts", "user_id", gap="6 hours").select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


#: A contact ends by itself after six hours without an event.
HOLD_MS = 6 * 3_600_000
#: Rows of a file of the stream, about, once a slot has more than four times that.
FILE_ROWS = 100_000


@query(f"""with e as (select user_id, event_id, epoch_us(ts::timestamp) // 1000 as ms, event_type in ('click', 'purchase') as yes from events), g as (select *, coalesce(ms - lag(ms) over (partition by user_id order by ms, event_id) > {HOLD_MS}, true)::int as fresh from e),
 s as (select *, sum(fresh) over (partition by user_id order by ms, event_id rows unbounded preceding) as sid from g), f as (select *, case when count(*) over w3 = 3 and sum(yes::int) over w3 = 3 then true when count(*) over w3 = 3 and sum(yes::int) over w3 = 0 then false end as flip from s window w3 as (partition by user_id, sid order by ms, event_id rows 2 preceding)),
 t as (select *, coalesce(last_value(flip ignore nulls) over (partition by user_id, sid order by ms, event_id rows unbounded preceding), false) as state from f), r as (select *, sum((not state)::int) over (partition by user_id, sid order by ms, event_id rows unbounded preceding) as run from t)
select user_id, ms, event_id, state, case when state then row_number() over (partition by user_id, sid, run, state order by ms, event_id) else 0 end as dwell, 'row' as what from r
union all select user_id, ms + {HOLD_MS}, null, false, 0, 'ended' from (select * from r qualify row_number() over (partition by user_id, sid order by ms desc, event_id desc) = 1) where state""")
def streaming_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts of a stream whose files mix rows of up to an eighth of its span; the watermark waits for that long and for a slot, of which a trigger may bring a part, so the rows are those of a batch."""
    e = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", F.col("event_type").isin("click", "purchase").alias("yes"))
    low, high, n = e.agg(F.min(F.unix_millis("ts")), F.max(F.unix_millis("ts")), F.count("*")).first()
    if low is None:
        return spark.createDataFrame([], "user_id long, ms long, event_id long, state boolean, dwell int, what string")
    mixed, slots, base = max(1, (high - low) // 8), 6, shared_folder(spark, "stream")
    slot = F.floor((F.unix_millis("ts") - low + F.pmod(F.xxhash64("event_id"), F.lit(mixed))) * slots / (high - low + mixed + 1))
    e, delay = e.withColumn("slot", slot), mixed + (high - low + mixed) // slots + 2
    files = max(4, n // (slots * FILE_ROWS))  # a slot is a trigger: their number doesn't grow with the rows
    for k in range(slots):
        e.filter(F.col("slot") == k).drop("slot").repartition(files).write.mode("append").parquet(f"{base}/in")
    close = F.timestamp_millis(F.lit(high + HOLD_MS + delay + 60_000))
    spark.range(1).select(F.lit(-1).cast("long").alias("user_id"), close.alias("ts"), F.lit(0).cast("long").alias("event_id"), F.lit(False).alias("yes")).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema("user_id long, ts timestamp, event_id long, yes boolean").option("maxFilesPerTrigger", files).parquet(f"{base}/in")
    out = ordered.ordered_contacts(stream, "user_id", "ts", "event_id", "yes", f"{delay} milliseconds", hold_ms=HOLD_MS, groups=max(ordered.GROUPS, n // FILE_ROWS))
    with ordered.rocksdb_state(spark):
        q = out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.read.schema(out.schema).parquet(f"{base}/out")
    return got.select("user_id", F.unix_millis("ts").alias("ms"), "event_id", "state", "dwell", "what")
