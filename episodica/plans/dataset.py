"""Queries of statistics, audits and dataset assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assembly as asm, joins, stats, timeseries as ts
from ..operators.windows import mode_first_seen
from .adapters import EPISODES, FEATURES, FRAMES, HANDS, episodes, features, frames, hands, rounded, table
from .registry import query
from .signals import KEYS, ORDER, _W

NAMES = ["quantity", "price", "discount", "tax"]


def _round(df: DataFrame, *cols: str, to: int = 6) -> DataFrame:
    return df.withColumns({c: rounded(c, to) for c in cols})


_STATS = f"wide as (unpivot (select {', '.join(f'{n}::double as {n}' for n in NAMES)} from features) on {', '.join(NAMES)} into name feature value v), st as (select feature, min(v) as min, max(v) as max, avg(v) as mean, stddev_pop(v) as std, count(v) as count, quantile_cont(v, 0.01) as q01, quantile_cont(v, 0.99) as q99 from wide group by 1)"


@query(f"with {FEATURES}, {_STATS} select feature, round(min, 4) as min, round(max, 4) as max, round(mean, 4) as mean, round(std, 4) as std, count, round(q01, 4) as q01, round(q99, 4) as q99 from st")
def feature_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(stats.feature_stats(features(spark, sf_dir), NAMES), "min", "max", "mean", "std", "q01", "q99", to=4)


@query(f"with {FEATURES}, {_STATS} select episode_id, frame_idx, " + ", ".join(f"round((f.{n} - (select mean from st where feature = '{n}')) / (select std from st where feature = '{n}'), 5) as {n}" for n in NAMES) + " from features f")
def normalise_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(spark, sf_dir)
    return _round(stats.normalise(f, stats.feature_stats(f, NAMES), NAMES), *NAMES, to=5)


@query(f"with {FRAMES}, q as (select episode_id, quantile_cont(value, 0.01) as lo, quantile_cont(value, 0.99) as hi from frames group by 1) select f.episode_id, frame_idx, round(greatest(-1, least(1, (value - (hi + lo) / 2) / case when (hi - lo) / 2 > 1e-6 then (hi - lo) / 2 else 1 end)), 6) as normalised from frames f join q using (episode_id)")
def percentile_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.percentile_normalise(frames(spark, sf_dir), "value", KEYS).select("episode_id", "frame_idx", F.round("normalised", 6).alias("normalised"))


@query(f"with {FRAMES} select episode_id, count(*) as frames, count_if(in_contact) as contact_frames, round(count_if(in_contact) / count(*), 6) as contact_ratio, round(100.0 * count_if(not present) / count(*), 6) as loss_pct, " + ", ".join(f"count_if(grasp = '{x}') as n_{x}" for x in ("precision_pinch", "power_wrap", "hook", "open", "unknown")) + " from frames group by 1")
def episode_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(stats.episode_summary(frames(spark, sf_dir), KEYS), "contact_ratio", "loss_pct")


@query(f"with {FRAMES} select episode_id, object_name, count(*) as dwell, count(*) >= 3 as eligible from frames where in_contact group by 1, 2")
def dwell_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.dwell_counts(frames(spark, sf_dir), KEYS, "in_contact", "object_name")


@query(f"with {FRAMES}, c as (select episode_id, object_name, count(*) as votes, min(frame_idx) as seen from frames where object_name is not null group by 1, 2) select episode_id, object_name as mode, votes from c qualify row_number() over (partition by episode_id order by votes desc, seen) = 1")
def mode_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mode_first_seen(frames(spark, sf_dir), KEYS, "object_name", ORDER)


@query(f"with {HANDS} select episode_id, round(quantile_cont(x0, 0.5), 6) as x, round(quantile_cont(y0, 0.5), 6) as y, round(quantile_cont(z0, 0.5), 6) as z from hands where present group by 1")
def median_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hands(spark, sf_dir, (0,)).filter("present").groupBy("episode_id").agg(*(F.round(F.percentile(f"{a}0", F.lit(0.5)), 6).alias(a) for a in "xyz"))


@query(f"with {HANDS}, l as (select episode_id, x0, y0, z0, sqrt((x9 - x0) ** 2 + (y9 - y0) ** 2 + (z9 - z0) ** 2) as palm from hands where present) select episode_id, round(0.09 / coalesce(avg(case when palm > 1e-4 then palm end), 0.1), 6) as scale, round((max(x0) - min(x0)) * 0.09 / coalesce(avg(case when palm > 1e-4 then palm end), 0.1), 6) as travel_x from l group by 1")
def metric_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.geometry import distance

    palm = F.coalesce(F.avg(F.when(F.col("palm") > 1e-4, F.col("palm"))), F.lit(0.1))
    df = hands(spark, sf_dir).filter("present").withColumn("palm", distance(9, 0))
    return df.groupBy("episode_id").agg(F.round(0.09 / palm, 6).alias("scale"), F.round((F.max("x0") - F.min("x0")) * 0.09 / palm, 6).alias("travel_x"))


@query(f"with {FRAMES} select episode_id, object_name, frame_idx, grasp, k from frames where object_name is not null qualify row_number() over (partition by episode_id, object_name order by case when grasp = 'power_wrap' then 0 else 1 end, frame_idx) = 1")
def dedupe_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frames(spark, sf_dir).filter("object_name is not null").select("episode_id", "object_name", "frame_idx", "grasp", "k")
    return stats.dedupe_preferring(df, [*KEYS, "object_name"], F.col("grasp") == "power_wrap", ORDER)


@query(f"""with {FRAMES}, v as (select *, (value - lag(value) over {_W}) * 30 as v from frames), a as (select *, (v - lag(v) over {_W}) * 30 as a from v), j as (select *, (a - lag(a) over {_W}) * 30 as j from a),
 g as (select episode_id, count(*) as frames, coalesce(max(abs(v)), 0) as max_velocity, coalesce(100.0 * count_if(abs(v) <= 1.02 * 1500) / nullif(count(v), 0), 100) as velocity_pct, coalesce(max(abs(a)), 0) as max_acceleration, coalesce(100.0 * count_if(abs(a) <= 1.05 * 8 * 1500) / nullif(count(a), 0), 100) as acceleration_pct,
  coalesce(sqrt(avg(j * j)), 0) as rms_jerk, count_if(abs(v) > 1.25 * 1500) as teleports, avg(k) as mean_residual, quantile_cont(k, 0.95) as p95_residual, count_if(k % 50 = 0) as collisions, count_if(value > 95) as limit_events from j group by 1),
 s as (select *, greatest(0, least(100, 100 - (greatest(0, (mean_residual - 15) * 0.35) + (100 - velocity_pct) * 1.5 + (100 - acceleration_pct) * 0.8 + least(25, collisions * 0.5) + least(20, limit_events * 0.2) + least(30, teleports * 5)))) as score from g)
select episode_id, frames, teleports, collisions, limit_events, round(max_velocity, 3) as max_velocity, round(velocity_pct, 4) as velocity_pct, round(max_acceleration, 2) as max_acceleration, round(acceleration_pct, 4) as acceleration_pct, round(rms_jerk, 1) as rms_jerk, round(mean_residual, 6) as mean_residual, round(p95_residual, 6) as p95_residual, round(score, 4) as score,
 case when score >= 88 and teleports = 0 and collisions = 0 then 'production' when score >= 75 and teleports = 0 then 'low_gain' else 'needs_filtering' end as verdict from s""")
def hardware_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = stats.hardware_audit(frames(spark, sf_dir), KEYS, ORDER, "value", "k", F.col("k") % 50 == 0, F.col("value") > 95, velocity=1500.0)
    for cols, to in ((("max_velocity",), 3), (("velocity_pct", "acceleration_pct", "score"), 4), (("max_acceleration",), 2), (("rms_jerk",), 1), (("mean_residual", "p95_residual"), 6)):
        df = _round(df, *cols, to=to)
    return df


@query("with c as (select o_custkey as owner, o_totalprice > 50000 as passed from orders) select owner, count(*) as checks, bool_and(passed) as passed from c group by 1")
def checks_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("owner"), (F.col("o_totalprice") > 50000).alias("passed"))
    return stats.all_passed(o, ["owner"])


@query("select o_custkey as owner, case max(case o_orderstatus when 'P' then 2 when 'O' then 1 else 0 end) when 2 then 1 when 1 then 2 else 0 end as exit_code from orders group by 1")
def manifest_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "P", "failed").when(F.col("o_orderstatus") == "O", "degraded").otherwise("ok")
    return stats.exit_codes(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("owner"), status.alias("status")), ["owner"])


@query(f"with {FRAMES}, m as (select *, avg(value) over (partition by episode_id order by frame_idx rows 2 preceding) as s from frames), d as (select episode_id, abs(value - lag(value) over {_W}) as b, abs(s - lag(s) over {_W}) as a from m) select episode_id, round(avg(b), 6) as mean_before, round(avg(a), 6) as mean_after, round(max(b), 6) as max_before, round(max(a), 6) as max_after, round(coalesce(100 * (avg(b) - avg(a)) / nullif(avg(b), 0), 0), 5) as reduction_pct from d group by 1")
def smoothing_jitter(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ts.trailing_mean(frames(spark, sf_dir), F.col("value"), KEYS, ORDER, out="s")
    return _round(_round(stats.jitter(df, KEYS, ORDER, "value", "s"), "mean_before", "mean_after", "max_before", "max_after"), "reduction_pct", to=5)


@query(f"with {FRAMES}, c as (select episode_id, count_if(k % 3 = 0) as n_left, count_if(k % 3 = 1) as n_right from frames group by 1) select *, case when n_left = 0 and n_right = 0 then 'none' when n_left > n_right then 'left' else 'right' end as hand from c")
def driving_hand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.driving_hand(frames(spark, sf_dir), KEYS, F.col("k") % 3 == 0, F.col("k") % 3 == 1)


@query(f"with {FRAMES} select episode_id, grasp, count(*) as n from frames group by 1, 2")
def reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.histogram(frames(spark, sf_dir), KEYS, "grasp")


@query(f"with {FRAMES}, n as (select *, row_number() over {_W} as i, count(*) over (partition by episode_id) as m from frames), a as (select episode_id, avg(case when i <= 10 then value end) as first_mean, avg(case when i > m - 10 then value end) as last_mean from n group by 1) select episode_id, round(first_mean, 6) as first_mean, round(last_mean, 6) as last_mean, last_mean < 0.9 * first_mean as improved from a")
def loss_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(stats.trend_check(frames(spark, sf_dir), KEYS, ORDER, "value"), "first_mean", "last_mean")


@query(f"""with {FRAMES}, o as (select *, in_contact as flag, lag(in_contact) over {_W} as was from frames), i as (select *, sum((flag <> was or was is null)::int) over (partition by episode_id order by frame_idx rows unbounded preceding) as run from o),
 r as (select episode_id, run, count(*) as n, count(object_name) as named from i where flag group by 1, 2)
select episode_id, count(*) as events, min(n) as shortest, max(n) as longest, round(quantile_cont(n, 0.5), 6) as median, round(avg(n), 6) as mean, count_if(n = 1) > 0.5 * count(*) as unstable, sum(named) < 0.7 * sum(n) as nameless from r group by 1""")
def plausibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run lengths of contact and what speaks against them."""
    from ..operators.segments import runs

    df = frames(spark, sf_dir)
    r = runs(df, F.col("in_contact"), KEYS, ORDER)
    named = df.filter("in_contact").groupBy("episode_id").agg((F.count("object_name") < 0.7 * F.count("*")).alias("nameless"))
    out = r.groupBy("episode_id").agg(F.count("*").alias("events"), F.min("n").alias("shortest"), F.max("n").alias("longest"), F.round(F.percentile("n", F.lit(0.5)), 6).alias("median"), F.round(F.avg("n"), 6).alias("mean"), (F.count_if(F.col("n") == 1) > 0.5 * F.count("*")).alias("unstable"))
    return out.join(named, "episode_id")


_OFFSETS = "off as (select *, row_number() over (order by episode_id) - 1 as episode_index, sum(length) over (order by episode_id) - length as from_index, sum(length) over (order by episode_id) as to_index from episodes)"


@query(f"with {EPISODES}, {_OFFSETS} select episode_id, length, episode_index, from_index::bigint as from_index, to_index::bigint as to_index from off")
def episode_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asm.running_offsets(episodes(spark, sf_dir), "episode_id").select("episode_id", "length", "episode_index", "from_index", "to_index")


@query(f'with {EPISODES}, {_OFFSETS}, {FEATURES} select f.episode_id, f.frame_idx, episode_index, (from_index + row_number() over (partition by f.episode_id order by f.frame_idx) - 1)::bigint as "index" from features f join off using (episode_id)')
def union_renumber(spark: SparkSession, sf_dir: str) -> DataFrame:
    off = asm.running_offsets(episodes(spark, sf_dir), "episode_id")
    return asm.renumber(features(spark, sf_dir), off, "episode_id", "frame_idx").select("episode_id", "frame_idx", "episode_index", "index")


@query(f"with {EPISODES} select task, min(episode_id) as first_seen, row_number() over (order by min(episode_id), task) - 1 as code from episodes group by 1")
def task_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asm.first_seen_codes(episodes(spark, sf_dir), "task", "episode_id")


@query(f"""with recursive {EPISODES}, e as (select *, episode_id // 500 as dataset, row_number() over (partition by episode_id // 500 order by episode_id) as i from episodes),
 p as (select dataset, i, episode_id, 0::bigint as chunk_index, case when length > 5 then ceil(length / 5.0)::bigint else 1 end as chunks, case when length > 5 then ceil(length / 5.0)::bigint else 0 end as at, case when length > 5 then 0 else length end as filled from e where i = 1
  union all select e.dataset, e.i, e.episode_id, case when (e.length > 5 and p.filled > 0) or (e.length <= 5 and p.filled > 0 and p.filled + e.length > 5) then p.at + 1 else p.at end,
   case when e.length > 5 then ceil(e.length / 5.0)::bigint else 1 end,
   case when (e.length > 5 and p.filled > 0) or (e.length <= 5 and p.filled > 0 and p.filled + e.length > 5) then p.at + 1 else p.at end + case when e.length > 5 then ceil(e.length / 5.0)::bigint else 0 end,
   case when e.length > 5 then 0 when p.filled > 0 and p.filled + e.length > 5 then e.length else p.filled + e.length end
  from p join e on e.dataset = p.dataset and e.i = p.i + 1)
select dataset, episode_id, chunk_index, chunks from p""")
def chunk_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = episodes(spark, sf_dir).withColumn("dataset", F.floor(F.col("episode_id") / 500))
    return asm.pack_chunks(e, "episode_id", size=5, group=["dataset"])


@query(f"with {EPISODES}, {_OFFSETS}, {FEATURES}, s as (select episode_id, min(price) as min, max(price) as max, avg(price) as mean, stddev_pop(price) as std from features group by 1) select episode_id, episode_index, from_index::bigint as from_index, to_index::bigint as to_index, task, round(min, 4) as price_min, round(max, 4) as price_max, round(mean, 6) as price_mean, round(std, 3) as price_std from off join s using (episode_id)")
def episode_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = features(spark, sf_dir).groupBy("episode_id").agg(F.round(F.min("price"), 4).alias("price_min"), F.round(F.max("price"), 4).alias("price_max"), F.round(F.avg("price"), 6).alias("price_mean"), F.round(F.stddev_pop("price"), 3).alias("price_std"))
    off = asm.running_offsets(episodes(spark, sf_dir), "episode_id").select("episode_id", "episode_index", "from_index", "to_index", "task")
    return off.join(s, "episode_id")


@query(f"with {EPISODES}, {_OFFSETS}, q as (select event_id, event_id * 7919 % (select sum(length) from episodes)::bigint as i from events) select q.event_id, q.i, o.episode_id, (q.i - o.from_index)::bigint as local_index from q join off o on q.i >= o.from_index and q.i < o.to_index")
def offset_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes of global indices, spread over the whole range: as-of join on the episodes' offsets, bucketed so that both sides shuffle by bucket."""
    from ..operators.windows import asof_pair

    size = 4096
    off = asm.running_offsets(episodes(spark, sf_dir), "episode_id").select("episode_id", "from_index", "to_index")
    spread = off.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("from_index") / size), F.floor((F.col("to_index") - 1) / size))))
    known = spread.select("bucket", F.greatest(F.col("from_index"), F.col("bucket") * size).alias("i"), "episode_id", "from_index")
    top = off.agg(F.max("to_index").alias("top"))
    wanted = table(spark, sf_dir, "events").select("event_id").crossJoin(F.broadcast(top)).select("event_id", (F.col("event_id") * 7919 % F.col("top")).alias("i"))  # one row
    found = asof_pair(wanted.withColumn("bucket", F.floor(F.col("i") / size)), known, ["bucket"], "i", ["episode_id", "from_index"])
    return found.select("event_id", "i", F.col("prev_episode_id").alias("episode_id"), (F.col("i") - F.col("prev_from_index")).alias("local_index"))


@query(f"with {EPISODES} select 'robot' as \"check\", count(distinct robot) as n_values, count(distinct robot) <= 1 as ok, case when count(distinct robot) <= 1 then 'ok' else 'error' end as level from episodes union all select 'task', count(distinct task), count(distinct task) <= 1, case when count(distinct task) <= 1 then 'ok' else 'warning' end from episodes")
def merge_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asm.gate(episodes(spark, sf_dir), ["robot"], ["task"])


@query(f"""with {FRAMES}, f as (select episode_id as episode_index, frame_idx as frame_index, t + case when k = 0 then 0.01 else 0 end as "timestamp", row_number() over (order by episode_id, frame_idx) - 1 as "index" from frames),
 p as (select episode_index, count(*) as n, max(frame_index) as m, min("index") as lo, max("index") as hi from f group by 1),
 r as (select count_if(abs("timestamp" - frame_index / 30.0::double) > 1e-3) as t, count(*) - count(distinct "index") as u, max("index") - min("index") + 1 - count(distinct "index") as c, min("index") as s from f), q as (select count_if(n <> m + 1) as f, count_if(hi - lo + 1 <> n) as e from p)
select "check", bad, bad = 0 as ok from (select 'timestamp' as "check", t as bad from r union all select 'index_unique', u from r union all select 'index_contiguous', c from r union all select 'index_start', s from r union all select 'frame_index', f from q union all select 'episode_range', e from q)""")
def export_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frames(spark, sf_dir)
    off = asm.running_offsets(df.groupBy("episode_id").agg(F.count("*").alias("length")), "episode_id")
    full = asm.renumber(df, off.withColumn("episode_index", F.col("episode_id")), "episode_id", "frame_idx")
    return asm.validate_frames(full.select("episode_index", F.col("frame_idx").alias("frame_index"), (F.col("t") + F.when(F.col("k") == 0, 0.01).otherwise(0.0)).alias("timestamp"), F.col("index").cast("long").alias("index")))


@query(f"with {FRAMES}, n as (select *, count(*) over (partition by episode_id) as n from frames) select episode_id, frame_idx, value from n where frame_idx in (select floor(i * (n - 1) / 4.0)::int from range(5) r(i))")
def evenly_spaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asm.evenly_spaced(frames(spark, sf_dir), KEYS, ORDER, 5).select("episode_id", "frame_idx", "value")


@query("with a as (select n_name as feature, case when n_regionkey < 3 then 'float32' else 'int64' end as dtype, n_regionkey as shape from nation where n_nationkey < 20), b as (select n_name as feature, case when n_regionkey < 2 then 'float32' else 'int64' end as dtype, n_regionkey as shape from nation where n_nationkey >= 5), j as (select feature, a.dtype, a.shape, b.dtype as dtype_b, b.shape as shape_b, case when b.feature is null then 'a' when a.feature is null then 'b' else 'both' end as side from a full join b using (feature)) select * from j where side <> 'both' or dtype <> dtype_b or shape <> shape_b")
def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    side = lambda least: n.select(F.col("n_name").alias("feature"), F.when(F.col("n_regionkey") < least, "float32").otherwise("int64").alias("dtype"), F.col("n_regionkey").alias("shape"), "n_nationkey")
    return joins.schema_difference(side(3).filter("n_nationkey < 20"), side(2).filter("n_nationkey >= 5"))


@query("with a as (select s_suppkey as joint, s_acctbal / 1000 as lower, s_acctbal / 500 as upper from supplier), b as (select s_suppkey as joint, round(s_acctbal / 1000, 1) as known_lower, round(s_acctbal / 500, 1) as known_upper from supplier) select joint, round(greatest(abs(lower - known_lower), abs(upper - known_upper)), 6) as off from a join b using (joint) where greatest(abs(lower - known_lower), abs(upper - known_upper)) > 0.005")
def limit_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("joint"), (F.col("s_acctbal") / 1000).alias("lower"), (F.col("s_acctbal") / 500).alias("upper"))
    return joins.limit_check(s, s.withColumns({"lower": F.round("lower", 1), "upper": F.round("upper", 1)})).select("joint", F.round("off", 6).alias("off"))


@query("with p as (select d.doc_id, l.quality, l.toxic, n_chars > 500 as predicted, lang from labels l join documents d using (doc_id)) select lang, count(*) as n, round(count_if((quality = 1) = predicted) / count(*), 6) as accuracy, round(coalesce(count_if(quality = 1 and predicted) / nullif(count_if(predicted), 0), 0), 6) as precision, round(coalesce(count_if(quality = 1 and predicted) / nullif(count_if(quality = 1), 0), 0), 6) as recall from p group by 1")
def label_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id").withColumns({"truth": F.col("quality") == 1, "predicted": F.col("n_chars") > 500})
    return _round(joins.evaluate(df, ["lang"], "truth", "predicted", "lang", "lang").drop("grasp_accuracy"), "accuracy", "precision", "recall")
