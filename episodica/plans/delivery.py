"""Queries of delivery: data sets written, merged and checked, write-backs, logs. Orders are episodes, order lines their frames, the order's status the robot; a robot's episodes are a data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assembly as asm
from ..operators import checks
from ..operators.windows import ordered
from ..sources import mcap, training, versions
from ..sources.shared import shared_folder
from .adapters import EPISODES, FEATURES, FRAMES, episodes, features, frames, table
from .registry import query
from .signals import KEYS, ORDER

NAMES = ["quantity", "price"]
SIZE = 1000


_made: dict[tuple[str, str], str] = {}


def _merged(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the merged data set, made once for a session and its input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _made:
        _made[key] = _merge(spark, sf_dir)
    return _made[key]


def _merge(spark: SparkSession, sf_dir: str) -> str:
    """The data sets of all robots, written, found and merged; the folder of the merged one."""
    base, ep = shared_folder(spark, "sets"), episodes(spark, sf_dir).select("episode_id", "task", "robot")
    rows = features(spark, sf_dir).select("episode_id", "frame_idx", *NAMES).join(ep.select("episode_id", "robot"), "episode_id")
    for part, df in (("episodes", ep), ("frames", rows)):  # parted once: an export reads its own robot's alone
        df.write.partitionBy("robot").parquet(f"{base}/parted/{part}")
    of = lambda part, df: spark.read.schema(df.schema).parquet(f"{base}/parted/{part}")
    ep, rows = of("episodes", ep), of("frames", rows)
    for robot in sorted(r[0] for r in ep.select("robot").distinct().collect()):
        own = lambda df: df.filter(F.col("robot") == robot).drop("robot")  # noqa: B023, E731
        training.export_training_set(own(rows), own(ep), NAMES, "episode_id", "frame_idx", f"{base}/in/{robot}", chunk_size=SIZE, extra={"robot_type": "arm"})
    training.merge_training_sets(spark, f"{base}/in", f"{base}/out", SIZE)
    return f"{base}/out"


_PLACED = f"""{EPISODES}, {FEATURES}, e as (select *, row_number() over (order by robot, episode_id) - 1 as episode_index, (sum(length) over (order by robot, episode_id))::bigint as upto from episodes),
 p as (select 0 as c, 0::bigint as s union all select c + 1, (select max(upto) from e where upto <= p.s + {SIZE}) from p where p.s + {SIZE} < (select max(upto) from e))"""


@query(f"""with recursive {_PLACED}, k as (select e.*, (select max(c) from p where p.s <= e.upto - e.length)::bigint as chunk_index from e), st as (select episode_id, {", ".join(f"min({f}) as {f}_min, max({f}) as {f}_max, round(avg({f}), 5) as {f}_mean, round(stddev_pop({f}), 3) as {f}_std" for f in NAMES)} from features group by 1)
select episode_index, task, length, upto - length as from_index, upto as to_index, chunk_index, st.* exclude (episode_id) from k join st using (episode_id)""")
def merged_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Look-up rows of the merged data set as they are read back: ranges, chunks, statistics of all features."""
    _, ep = training.read_set_episodes(spark, _merged(spark, sf_dir))
    digits = {"min": None, "max": None, "mean": 5, "std": 3}
    stats = [(F.round(f"`stats/{f}/{a}`", d) if d else F.col(f"`stats/{f}/{a}`")).alias(f"{f}_{a}") for f in NAMES for a, d in digits.items()]
    return ep.select("episode_index", "task", "length", F.col("dataset_from_index").alias("from_index"), F.col("dataset_to_index").alias("to_index"), F.col("`data/chunk_index`").alias("chunk_index"), *stats)


@query(f"with {FEATURES} " + " union all ".join(f"select '{f}' as feature, count({f}) as count, min({f}) as min, max({f}) as max, round(avg({f}), 4) as mean, round(stddev_pop({f}), 4) as std, round(quantile_cont({f}, 0.01), 4) as q01, round(quantile_cont({f}, 0.99), 4) as q99 from features" for f in NAMES))
def merged_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the merged data set, added up from those of the parts."""
    raw = spark.read.text(f"{_merged(spark, sf_dir)}/meta/stats.json", wholetext=True)
    kind = "struct<" + ", ".join(f"{a}:{'bigint' if a == 'count' else 'double'}" for a in training.STATISTICS) + ">"
    s = raw.select(F.explode(F.from_json("value", f"map<string, {kind}>")).alias("feature", "s")).select("feature", "s.*")
    return s.select("feature", "count", "min", "max", *(F.round(a, 4).alias(a) for a in ("mean", "std", "q01", "q99")))


@query(f"with recursive {EPISODES}, e as (select *, (sum(length) over (partition by robot order by episode_id))::bigint as upto from episodes), p as (select distinct robot, 0 as c, 0::bigint as s from e union all select p.robot, c + 1, (select max(upto) from e where e.robot = p.robot and upto <= p.s + {SIZE}) from p where p.s + {SIZE} < (select max(upto) from e where e.robot = p.robot)) select e.robot, episode_id, (select max(c) from p where p.robot = e.robot and p.s <= e.upto - e.length)::bigint as chunk_index from e")
def chunk_packing_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole data sets packed into chunks of a thousand frames."""
    return asm.pack_chunks(episodes(spark, sf_dir), "episode_id", size=SIZE, group=["robot"]).select("robot", "episode_id", "chunk_index")


@query("""with l as (select l_orderkey, bool_and(l_discount < 0.08) as verified, count(*) as frames from lineitem group by 1), a as (select o_orderkey as episode_id, o_orderpriority as task, o_totalprice as duration from orders where o_orderkey % 5 <> 0),
 c as (select l_orderkey as episode_id, verified, 'report-' || l_orderkey as report from l where frames >= 3), m as (select coalesce(a.episode_id, c.episode_id) as episode_id, task, duration, verified, report from a full join c on a.episode_id = c.episode_id)
select episode_id, case when episode_id % 3 = 0 then 'relabelled' else task end as task, duration, verified, report from m""")
def label_writeback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episode metadata as a versioned table; labels found later are written back by key, twice, and read."""
    root = shared_folder(spark, "metadata")
    orders = table(spark, sf_dir, "orders").filter("o_orderkey % 5 <> 0")
    versions.write(orders.select(F.col("o_orderkey").alias("episode_id"), F.col("o_orderpriority").alias("task"), F.col("o_totalprice").alias("duration")), root)
    found = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("episode_id")).agg(F.bool_and(F.col("l_discount") < 0.08).alias("verified"), F.count("*").alias("n")).filter("n >= 3")
    versions.upsert(found.select("episode_id", "verified", F.concat(F.lit("report-"), F.col("episode_id").cast("string")).alias("report")), root, ["episode_id"], "verification")
    again = versions.read(spark, root).filter("episode_id % 3 = 0").select("episode_id", F.lit("relabelled").alias("task"))
    versions.upsert(again, root, ["episode_id"], "labels")
    return versions.read(spark, root)


#: Rules of a delivery about episodes, their frames and channels.
DELIVERY_RULES = [
    checks.Rule("frame_clock", "frames", "abs(t - frame_idx / 30.0) <= 1e-3", "concat(episode_id, '/', frame_idx)", "episode_id * 100000 + frame_idx"),
    checks.Rule("contact_has_object", "frames", "not in_contact or object_name is not null", "concat(episode_id, '/', frame_idx)", "episode_id * 100000 + frame_idx"),
    checks.Rule("absent_without_signal", "frames", "present or signal is null", "concat(episode_id, '/', frame_idx)", "episode_id * 100000 + frame_idx"),
    checks.Rule("frames_follow", "frames", "step = 1", "concat(episode_id, '/', frame_idx)", "episode_id * 100000 + frame_idx"),
    checks.Rule("enough_frames", "episodes", "n >= 60", "concat(episode_id, ': ', n)", "episode_id", level="warning"),
    checks.Rule("channel_moves", "episodes", "moved >= 0.5 * (n - 1)", "concat(episode_id, ': ', moved)", "episode_id"),
    checks.Rule("channel_range", "episodes", "low >= 0 and high <= 150", "concat(episode_id, ': ', high)", "episode_id"),
    checks.Rule("episode_known", "episodes", "named", "episode_id", "episode_id", needs_rows=True),
]
_AT = "episode_id::bigint * 100000 + frame_idx"


def _rule_sql(check: str, source: str, bad: str, detail: str, order: str, level: str = "error") -> str:
    return f"select '{check}' as \"check\", '{level}' as level, (select count(*) from {source})::bigint as rows, count(*) as bad, count(*) = 0 as ok, coalesce(array_to_string(list({detail} order by {order})[1:3], ' '), '') as details from {source} where {bad}"


@query(f"""with {FRAMES}, f as (select *, t + case when k = 0 then 0.01 else 0 end as clock, coalesce(frame_idx - lag(frame_idx) over (partition by episode_id order by frame_idx), 1) as step, abs(value - lag(value) over (partition by episode_id order by frame_idx)) as moved from frames),
 e as (select f.episode_id, count(*) as n, count(*) filter (moved > 10) as moved, min(value) as low, max(value) as high, max(c_custkey) is not null as named from f left join customer on c_custkey = f.episode_id and c_acctbal > 0 group by 1)
""" + " union all ".join([
    _rule_sql("frame_clock", "f", "abs(clock - frame_idx / 30.0::double) > 1e-3", "episode_id || '/' || frame_idx", _AT), _rule_sql("contact_has_object", "f", "in_contact and object_name is null", "''", _AT), _rule_sql("absent_without_signal", "f", "not present and signal is not null", "''", _AT), _rule_sql("frames_follow", "f", "step <> 1", "''", _AT),
    _rule_sql("enough_frames", "e", "n < 60", "episode_id || ': ' || n", "episode_id", "warning"), _rule_sql("channel_moves", "e", "moved < 0.5 * (n - 1)", "episode_id || ': ' || moved", "episode_id"), _rule_sql("channel_range", "e", "low < 0 or high > 150", "episode_id || ': ' || high", "episode_id"), _rule_sql("episode_known", "e", "not named", "episode_id::varchar", "episode_id"),
]))
def delivery_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules about frames, channels and references of a delivery, with the first wrong rows of each; some frames have a clock that is off."""
    w = ordered(KEYS, ORDER)
    f = frames(spark, sf_dir).withColumns({"t": F.col("t") + F.when(F.col("k") == 0, 0.01).otherwise(0.0), "step": F.coalesce(F.col(ORDER) - F.lag(ORDER).over(w), F.lit(1)), "_moved": F.abs(F.col("value") - F.lag("value").over(w))})
    e = f.groupBy(*KEYS).agg(F.count("*").alias("n"), F.count_if(F.col("_moved") > 10).alias("moved"), F.min("value").alias("low"), F.max("value").alias("high"))
    known = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("episode_id"), F.lit(True).alias("named"))
    report = checks.evaluate({"frames": f, "episodes": e.join(known, "episode_id", "left")}, DELIVERY_RULES)
    return report.withColumn("details", F.array_join("details", " "))


@query(f"with {FRAMES} select episode_id, frame_idx, case when present then '/human/frame' else '/robot/frame' end as topic, case when present then 'HumanFrame' else 'RobotFrame' end as \"schema\", (row_number() over (partition by episode_id % 16, present order by round(t * 1e9)::bigint * 1000 + episode_id, frame_idx) - 1)::bigint as sequence, round(t * 1e9)::bigint * 1000 + episode_id as log_time, round(value, 4) as value from frames")
def mcap_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames written as messages of two channels into sixteen logs of a public format, and read back."""
    spark.dataSource.register(mcap.McapSource)
    path, seen = shared_folder(spark, "logs"), F.col("present")
    body = F.to_json(F.struct("episode_id", "frame_idx", F.round("value", 4).alias("value")))
    rows = frames(spark, sf_dir).select(F.concat(F.lit("log-"), (F.col("episode_id") % 16).cast("string")).alias("log"), F.when(seen, "/human/frame").otherwise("/robot/frame").alias("topic"), F.when(seen, "HumanFrame").otherwise("RobotFrame").alias("schema"), (F.round(F.col("t") * 1e9).cast("long") * 1000 + F.col("episode_id")).alias("log_time"), body.cast("binary").alias("data"))
    rows.repartition("log").sortWithinPartitions("log", "log_time").write.format("mcap").mode("append").save(path)
    got = spark.read.format("mcap").load(path).withColumn("m", F.from_json(F.col("data").cast("string"), "episode_id long, frame_idx int, value double"))
    return got.select("m.episode_id", "m.frame_idx", "topic", "schema", "sequence", "log_time", "m.value")


@query(f"""with recursive {_PLACED}, n as (select count(*) as frames, count(distinct episode_id) as episodes from features)
select "check", 'error' as level, case kind when 'f' then frames when 'e' then episodes when 'i' then 1 else kind::bigint end as rows, 0::bigint as bad, true as ok
from n, (select unnest(['layout', 'info_version', 'info_data_path', 'info_video_path', 'info_splits', 'info_total_frames', 'info_total_episodes', 'info_total_chunks', 'info_total_videos', 'features', 'stats_keys', 'stats_complete', 'video_facts', 'columns', 'index_range', 'timestamps', 'frame_places', 'episode_numbers', 'episode_starts', 'episode_ends']) as "check", unnest(['5', 'i', 'i', 'i', 'i', 'i', 'i', 'i', 'i', '2', '2', '2', '2', '22', 'i', 'f', 'f', 'e', 'e', 'e']) as kind)""")
def merged_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export rules over the merged data set, which keeps them all."""
    return training.validate_training_set(spark, _merged(spark, sf_dir)).drop("details")
