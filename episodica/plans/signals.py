"""Queries of the time-series operators over events as frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import timeseries as ts
from ..operators.windows import asof_pair, ordered
from .adapters import FRAMES, HANDS, frames, hands
from .registry import query

KEYS, ORDER = ["episode_id"], "frame_idx"
_W = "(partition by episode_id order by frame_idx)"
_UPTO = "(partition by episode_id order by frame_idx rows unbounded preceding)"
_FROM = "(partition by episode_id order by frame_idx rows between current row and unbounded following)"
_ALL = "(partition by episode_id order by frame_idx rows between unbounded preceding and unbounded following)"


def _out(df: DataFrame, *cols: str, **rounded: str) -> DataFrame:
    return df.select(*KEYS, ORDER, *cols, *(F.round(c, 6).alias(n) for n, c in rounded.items()))


@query(f"""with {FRAMES}, f as (select *,
  case when count(*) over w3 = 3 and sum(in_contact::int) over w3 = 3 then true when count(*) over w3 = 3 and sum(in_contact::int) over w3 = 0 then false end as flip
  from frames window w3 as (partition by episode_id order by frame_idx rows 2 preceding))
select episode_id, frame_idx, coalesce(last_value(flip ignore nulls) over {_UPTO}, false) as state from f""")
def hysteresis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(ts.hysteresis(frames(spark, sf_dir), "in_contact", KEYS, ORDER), "state")


@query(f"with {FRAMES} select episode_id, frame_idx, max(in_contact) over (partition by episode_id order by frame_idx rows between 10 preceding and 10 following) as active from frames")
def dilation_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(ts.dilate(frames(spark, sf_dir), "in_contact", KEYS, ORDER), "active")


_NEAR = f"""near as (select *, last_value(case when signal is not null then frame_idx end ignore nulls) over {_UPTO} as pi, last_value(signal ignore nulls) over {_UPTO} as pv,
  first_value(case when signal is not null then frame_idx end ignore nulls) over {_FROM} as ni, first_value(signal ignore nulls) over {_FROM} as nv from frames)"""


@query(f"""with {FRAMES}, {_NEAR}
select episode_id, frame_idx, signal is null and pi is not null and ni is not null and ni - pi - 1 <= 5 as interpolated,
  round(case when signal is null and pi is not null and ni is not null and ni - pi - 1 <= 5 then pv + (nv - pv) * ((frame_idx - pi)::double / (ni - pi)) else signal end, 6) as filled from near""")
def gap_interpolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ts.interpolate_gaps(frames(spark, sf_dir), "signal", KEYS, ORDER)
    return _out(df, F.coalesce("interpolated", F.lit(False)).alias("interpolated"), filled="filled")


@query(f"""with {FRAMES}, {_NEAR}
select episode_id, frame_idx, round(coalesce(pv + (nv - pv) * coalesce((frame_idx - pi)::double / nullif(ni - pi, 0), 0), pv, nv), 6) as filled from near""")
def fill_bidirectional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(ts.fill_both_ways(frames(spark, sf_dir), "signal", KEYS, ORDER), filled="filled")


def _recursion(first: str, step: str, base: str = "frames") -> str:
    """One pass over an episode in order: columns of `first` at row 0, of `step` from r (the row before) and f (this row)."""
    return f"with recursive {FRAMES}, base as (select * from {base}), run as (select f.episode_id, f.frame_idx, {first} from base f where f.frame_idx = 0 union all select f.episode_id, f.frame_idx, {step} from run r join base f on f.episode_id = r.episode_id and f.frame_idx = r.frame_idx + 1)"


def _backward(alpha: float, column: str, source: str, name: str) -> str:
    return f"{name} as (select episode_id, frame_idx, {column} as y from {source} s where frame_idx = (select max(frame_idx) from {source} m where m.episode_id = s.episode_id) union all select s.episode_id, s.frame_idx, {alpha} * s.{column} + {1 - alpha} * b.y from {name} b join {source} s on s.episode_id = b.episode_id and s.frame_idx = b.frame_idx - 1)"


@query(_recursion("f.value as x", "0.35 * f.value + 0.65 * r.x") + ", " + _backward(0.35, "x", "run", "back") + " select episode_id, frame_idx, round(y, 6) as smooth from back")
def zero_phase_ema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(ts.zero_phase_ema(frames(spark, sf_dir), "value", KEYS, ORDER, passes=1), smooth="smooth")


@query(f"with {FRAMES} select episode_id, frame_idx, round(avg(coalesce(signal, 0)) over (partition by episode_id order by frame_idx rows 2 preceding), 6) as mean from frames")
def trailing_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(ts.trailing_mean(frames(spark, sf_dir), F.coalesce("signal", F.lit(0.0)), KEYS, ORDER), mean="mean")


_RUNS = f"""b as (select *, sum((present <> lag_present or lag_present is null)::int) over {_UPTO} as run from (select *, lag(present) over {_W} as lag_present from frames)),
  v as (select *, case when present and grasp <> 'unknown' then grasp end as known from b)"""


@query(f"""with {FRAMES}, {_RUNS},
 votes as (select a.episode_id, a.frame_idx, n.known, count(*) as c, min(n.frame_idx) as seen from v a join v n on n.episode_id = a.episode_id and n.run = a.run and n.frame_idx between a.frame_idx - 2 and a.frame_idx + 2 and n.known is not null where a.present group by 1, 2, 3),
 best as (select * from votes qualify row_number() over (partition by episode_id, frame_idx order by c desc, seen) = 1),
 heirs as (select episode_id, frame_idx, present, coalesce(first_value(known ignore nulls) over (partition by episode_id, run order by frame_idx rows between current row and unbounded following), last_value(known ignore nulls) over (partition by episode_id, run order by frame_idx rows unbounded preceding)) as heir from v)
select h.episode_id, h.frame_idx, case when h.present then coalesce(b.known, h.heir) end as voted, h.present and b.known is null and h.heir is not null as inherited
from heirs h left join best b on b.episode_id = h.episode_id and b.frame_idx = h.frame_idx""")
def majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(ts.majority_vote(frames(spark, sf_dir), "grasp", "present", KEYS, ORDER), "voted", "inherited")


@query(_recursion("case when f.present then least(greatest(f.value / 1000, 0), 0.04) else 0.04 end as y", "case when f.present then least(greatest(0.7 * f.value / 1000 + 0.3 * r.y, 0), 0.04) else 0.04 end") + " select episode_id, frame_idx, round(y + 1e-9, 6) as ema from run")
def ema_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frames(spark, sf_dir).withColumn("opening", F.col("value") / 1000)
    return _out(ts.ema_with_reset(df, "opening", "present", KEYS, ORDER, rest=0.04).withColumn("ema", F.col("ema") + 1e-9), ema="ema")


@query(_recursion("case when f.signal is null then 0.0 else f.signal end as s", "case when f.signal is null then r.s else 0.96 * r.s + f.signal end") + " select episode_id, frame_idx, round(s, 6) as leaky from run")
def leaky_cumulative_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(ts.leaky_sum(frames(spark, sf_dir), "signal", KEYS, ORDER), leaky="leaky")


@query(f"""with {FRAMES}, c as (select *, coalesce(present and lag(present) over {_W} and abs(value - lag(value) over {_W}) * 30 > 0.9 * 1000, false) as bad from frames),
 i as (select *, sum((bad <> was or was is null)::int) over {_UPTO} as run from (select *, lag(bad) over {_W} as was from c))
select episode_id, frame_idx, present and not (bad and row_number() over (partition by episode_id, run order by frame_idx) % 2 = 1) as reachable from i""")
def velocity_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(ts.velocity_gate(frames(spark, sf_dir), "value", "present", KEYS, ORDER, limit=1000.0), "reachable")


@query(f"""with {FRAMES} select episode_id, frame_idx, present and k % 4 <> 0 as reachable,
 round(last_value(case when k % 4 <> 0 or frame_idx = 0 then value end ignore nulls) over {_UPTO}, 6) as held from frames""")
def source_gate_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frames(spark, sf_dir).withColumn("interpolated", F.col("k") % 4 == 0)
    return _out(ts.source_gate(df, "value", "interpolated", "present", KEYS, ORDER), "reachable", held="held")


@query(f"with {FRAMES} select episode_id, frame_idx, round(coalesce(last_value(case when present then value end ignore nulls) over {_UPTO}, 0), 6) as held from frames")
def hold_last_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(ts.hold_last_valid(frames(spark, sf_dir), "value", "present", KEYS, ORDER), held="held")


@query(f"""with {HANDS}, s as (select *, case when present and lag(present) over {_W} then sqrt((x0 - lag(x0) over {_W}) ** 2 + (y0 - lag(y0) over {_W}) ** 2 + (z0 - lag(z0) over {_W}) ** 2) end as step from hands)
select episode_id, round(coalesce(sum(case when step < 0.15 then step end), 0), 6) as path_length, count(case when step >= 0.15 then 1 end) as jumps from s group by episode_id""")
def path_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ts.path_length(hands(spark, sf_dir), ["x0", "y0", "z0"], "present", KEYS, ORDER)
    return df.select("episode_id", F.round("path_length", 6).alias("path_length"), "jumps")


@query(f"""with {FRAMES}, n as (select *, row_number() over {_W} as i, (value - lag(value) over {_W}) * 30 as d from frames),
 v as (select *, case when i > 1 then d else 0 end as vel from n), a as (select *, case when i > 2 then (vel - lag(vel) over {_W}) * 30 else 0 end as acc from v)
select episode_id, frame_idx, round(vel, 3) as vel, round(acc, 3) as acc, round(case when i > 3 then (acc - lag(acc) over {_W}) * 30 else 0 end, 3) as jerk from a""")
def derivative_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ts.derivatives(frames(spark, sf_dir), "value", KEYS, ORDER)
    return df.select("episode_id", "frame_idx", *(F.round(c, 3).alias(c) for c in ("vel", "acc", "jerk")))


@query(f"""with {FRAMES}, n as (select episode_id, max(frame_idx) as last from frames group by 1), h as (select unnest(range(16))::integer as h)
select f.episode_id, f.frame_idx, h.h, g.value as action from frames f join n on n.episode_id = f.episode_id cross join h
join frames g on g.episode_id = f.episode_id and g.frame_idx = least(f.frame_idx + h.h, n.last)""")
def action_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ts.action_chunks(frames(spark, sf_dir), "value", KEYS, ORDER)


@query(f"with {FRAMES} select episode_id, frame_idx, coalesce(lead(value) over {_W}, value) as action from frames")
def lead_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(ts.lead_target(frames(spark, sf_dir), "value", KEYS, ORDER), "action")


def _savgol_sql() -> str:
    m = ts.savgol_matrix()
    rows = ", ".join("[" + ", ".join(repr(float(x)) for x in r) + "]" for r in m)
    return f"""with {FRAMES}, l as (select episode_id, list(value order by frame_idx) as v, count(*) as n from frames group by 1), m as (select [{rows}] as m)
select f.episode_id, f.frame_idx, round(case when n < 9 then f.value
  when f.frame_idx < 4 then list_dot_product(v[1:9], m[f.frame_idx + 1]) when f.frame_idx > n - 5 then list_dot_product(v[n - 8:n], m[9 - (n - 1 - f.frame_idx)])
  else list_dot_product(v[f.frame_idx - 3:f.frame_idx + 5], m[5]) end, 6) as smooth from frames f join l on l.episode_id = f.episode_id, m"""


@query(_savgol_sql())
def savgol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(ts.savgol(frames(spark, sf_dir), "value", KEYS, ORDER), smooth="smooth")


@query(f"""with {FRAMES}, l as (select *, row_number() over {_W} as i, count(*) over {_ALL} as n, first_value(value) over {_ALL} as a, last_value(value) over {_ALL} as z,
  sum(value) over (partition by episode_id order by frame_idx rows between 2 preceding and 2 following) as s from frames)
select episode_id, frame_idx, round((s + greatest(0, 3 - i) * a + greatest(0, i + 2 - n) * z) / 5, 6) as mean from l""")
def moving_avg_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(ts.mean_edge_padded(frames(spark, sf_dir), "value", KEYS, ORDER), mean="mean")


@query(f"with {FRAMES} select episode_id, frame_idx, frame_idx = 0 as is_first, frame_idx = max(frame_idx) over (partition by episode_id) as is_last, frame_idx = max(frame_idx) over (partition by episode_id) as is_terminal from frames")
def first_last_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(ts.ends(frames(spark, sf_dir), KEYS, ORDER), "is_first", "is_last", "is_terminal")


@query(f"with {FRAMES} select episode_id, frame_idx, round(coalesce(last_value(case when grasp = 'power_wrap' then value end ignore nulls) over {_UPTO}, 0), 6) as object from frames")
def attach_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frames(spark, sf_dir).withColumn("grasped", F.col("grasp") == "power_wrap")
    return _out(ts.attach_and_rest(df, "value", "grasped", KEYS, ORDER), object="object")


@query(f"""with {FRAMES}, s as (select * replace (case when k % 10 < 4 then signal end as signal) from frames), {_NEAR.replace("from frames", "from s")},
 r as (select *, ni - pi - 1 as gap, least(2, ni - pi - 1) as ramp from near), e as (select *, greatest(0, (frame_idx - (ni - ramp) + 1)::double / (ramp + 1)) as tau from r),
 q as (select *, tau * tau * tau * (10 + tau * (-15 + 6 * tau)) as ease from e)
select episode_id, frame_idx, round(coalesce(signal, case when pi is not null and ni is not null then (1 - ease) * pv + ease * nv end, pv, nv, 0), 6) as bridged from q""")
def min_jerk_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frames(spark, sf_dir).withColumn("signal", F.when(F.col("k") % 10 < 4, F.col("signal")))
    return _out(ts.min_jerk_bridge(df, "signal", KEYS, ORDER, max_bridge=2), bridged="bridged")


@query(f"""with {FRAMES}, n as (select *, last_value(case when frame_idx % 15 = 0 then frame_idx end ignore nulls) over {_UPTO} as pi, last_value(case when frame_idx % 15 = 0 then value end ignore nulls) over {_UPTO} as pv,
  first_value(case when frame_idx % 15 = 0 then frame_idx end ignore nulls) over {_FROM} as ni, first_value(case when frame_idx % 15 = 0 then value end ignore nulls) over {_FROM} as nv from frames)
select episode_id, frame_idx, round(coalesce(pv + (nv - pv) * coalesce((frame_idx - pi)::double / nullif(ni - pi, 0), 0), pv, nv), 6) as lerped from n""")
def asof_keyframe_lerp(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frames(spark, sf_dir).withColumn("key", F.col("frame_idx") % 15 == 0)
    return _out(ts.keyframe_lerp(df, "value", "key", KEYS, ORDER), lerped="lerped")


@query(f"""with {FRAMES}, g as (select episode_id, i, i * 0.05::double as t from (select episode_id, unnest(range(floor(max(t) / 0.05 + 1e-9)::integer + 1))::integer as i from frames group by episode_id))
select g.episode_id, g.i, round(coalesce(p.value + (n.value - p.value) * coalesce((g.t - p.t) / nullif(n.t - p.t, 0), 0), p.value, n.value), 6) as value
from g left join frames p on p.episode_id = g.episode_id and p.frame_idx = floor(g.t * 30 + 1e-9) left join frames n on n.episode_id = g.episode_id and n.frame_idx = ceil(g.t * 30 - 1e-9)""")
def resample_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frames(spark, sf_dir)
    grid = df.groupBy("episode_id").agg(F.max("frame_idx").alias("n")).select("episode_id", F.explode(F.sequence(F.lit(0), F.floor(F.col("n") / 30.0 / 0.05 + 1e-9).cast("int"))).alias("i"))
    grid = grid.withColumn("tick", F.round(F.col("i") * 0.05 * 600).cast("long"))  # whole 1/600 s: grid and frames meet exactly
    known = df.select("episode_id", (F.col("frame_idx") * 20).cast("long").alias("tick"), "value")
    both = asof_pair(grid, known, KEYS, "tick", ["value"])
    share = (F.col("tick") - F.col("prev_tick")) / F.nullif(F.col("next_tick") - F.col("prev_tick"), F.lit(0))
    value = F.col("prev_value") + (F.col("next_value") - F.col("prev_value")) * F.coalesce(share, F.lit(0.0))
    return both.select("episode_id", "i", F.round(F.coalesce(value, "prev_value", "next_value"), 6).alias("value"))


@query(f"with {FRAMES} select episode_id, frame_idx, value from frames qualify frame_idx % 15 = 0 or frame_idx = max(frame_idx) over (partition by episode_id) or coalesce(abs(value - lag(value) over {_W}) > 60, false)")
def keyframe_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ts.keyframes(frames(spark, sf_dir), "value", KEYS, ORDER, jump=60.0).select("episode_id", "frame_idx", "value")


@query(_recursion("case when f.present and (f.value < 4.999 or f.value > 80.001) then 0.0 else f.value end as q, f.present and not (f.value < 4.999 or f.value > 80.001) as reachable, case when not f.present then 'input' when f.value < 4.999 or f.value > 80.001 then 'joint_limit' else 'ok' end as reason",
 "case when not f.present or f.value < 4.999 or f.value > 80.001 then r.q when abs(f.value - r.q) > 0.9 * 600 / 30.0::double then r.q + sign(f.value - r.q) * (0.9 * 600 / 30.0::double) else f.value end, f.present and not (f.value < 4.999 or f.value > 80.001) and not abs(f.value - r.q) > 0.9 * 600 / 30.0::double, case when not f.present then 'input' when f.value < 4.999 or f.value > 80.001 then 'joint_limit' when abs(f.value - r.q) > 0.9 * 600 / 30.0::double then 'joint_velocity' else 'ok' end")
 + " select episode_id, frame_idx, round(q, 6) as q, reachable, reason from run")
def sanitize_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ts.sanitize(frames(spark, sf_dir), "value", "present", KEYS, ORDER, low=5.0, high=80.0, velocity=600.0)
    return _out(df, "reachable", "reason", q="q")


@query(_recursion("case when (f.value / 1000 < 0.03) = (0.08 < 0.03) then f.value / 1000 else 0.08::double end as s, 1 as held",
 "case when (f.value / 1000 < 0.03) = (r.s < 0.03) or r.held >= 5 then f.value / 1000 else r.s end, case when (f.value / 1000 < 0.03) <> (r.s < 0.03) and r.held >= 5 then 0 else r.held + 1 end") + " select episode_id, frame_idx, round(s, 6) as switched from run")
def debounced_gripper(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frames(spark, sf_dir).withColumn("opening", F.col("value") / 1000)
    return _out(ts.debounced_switch(df, "opening", KEYS, ORDER), switched="switched")


def _rate_limit_sql(v: float, change: float, low: float, high: float) -> str:
    """Three averages there and back over the clipped value, then the limited steps."""
    parts, source = [f"a0 as (select episode_id, frame_idx, greatest({low}, least({high}, value)) as y from frames)"], "a0"
    for k in range(1, 7):
        first, d = ("frame_idx = 0", 1) if k % 2 else (f"frame_idx = (select max(frame_idx) from {source} m where m.episode_id = s.episode_id)", -1)
        parts.append(f"a{k} as (select episode_id, frame_idx, y from {source} s where {first} union all select s.episode_id, s.frame_idx, 0.45 * s.y + 0.55 * p.y from a{k} p join {source} s on s.episode_id = p.episode_id and s.frame_idx = p.frame_idx + {d})")
        source = f"a{k}"
    u = f"greatest(greatest({-v}, r.v - {change}), least(least({v}, r.v + {change}), (s.y - r.pos) * 30))"
    u = f"greatest(({low} - r.pos) * 30, least(({high} - r.pos) * 30, {u}))"
    u = f"case when s.frame_idx > 1 then greatest(r.v - {change}, least(r.v + {change}, {u})) else {u} end"
    parts.append(f"lim as (select episode_id, frame_idx, y, y as pos, 0.0::double as v from a6 where frame_idx = 0 union all select s.episode_id, s.frame_idx, s.y, r.pos + ({u}) / 30, {u} from lim r join a6 s on s.episode_id = r.episode_id and s.frame_idx = r.frame_idx + 1)")
    return f"with recursive {FRAMES}, {', '.join(parts)} select episode_id, frame_idx, round(y, 6) as smooth, round(pos, 6) as limited from lim"


@query(_rate_limit_sql(v=255.0, change=42.5, low=0.0, high=100.0))
def rate_limited_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ts.rate_limit(frames(spark, sf_dir), "value", KEYS, ORDER, low=0.0, high=100.0, velocity=300.0)
    return _out(df, smooth="smooth", limited="limited")


@query(f"""with {HANDS}, p as (select *, lag(present) over {_W} as was, {", ".join(f"lag({a}0) over {_W} as p{a}" for a in "xyz")} from hands)
select episode_id, frame_idx, {", ".join(f"round(case when present and was then greatest(-1, least(1, ({a}0 - p{a}) * 10)) else 0 end, 6) as d{a}" for a in "xyz")} from p""")
def lag_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, w = hands(spark, sf_dir, (0,)), ordered(KEYS, ORDER)
    both = F.col("present") & F.coalesce(F.lag("present").over(w), F.lit(False))
    delta = {f"d{a}": F.when(both, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col(f"{a}0") - F.lag(f"{a}0").over(w)) * 10))).otherwise(0.0) for a in "xyz"}
    return df.withColumns(delta).select("episode_id", "frame_idx", *(F.round(c, 6).alias(c) for c in delta))


@query(f"""with {FRAMES}, s as (select *, abs(value - lag(value) over {_W}) as step, present and lag(present) over {_W} as pair from frames)
select episode_id, count(case when step > 1e-6 then 1 end) as moving, count(*) - 1 as steps, count(case when step > 1e-6 then 1 end) < 0.5 * (count(*) - 1) as frozen, count(case when pair and step * 30 > 1500 then 1 end) as too_fast from s group by episode_id""")
def frozen_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = ordered(KEYS, ORDER)
    df = frames(spark, sf_dir).withColumns({"step": F.abs(F.col("value") - F.lag("value").over(w)), "pair": F.col("present") & F.lag("present").over(w)})
    moving = F.count(F.when(F.col("step") > 1e-6, 1))
    return df.groupBy("episode_id").agg(moving.alias("moving"), (F.count("*") - 1).alias("steps"), (moving < 0.5 * (F.count("*") - 1)).alias("frozen"), F.count(F.when(F.col("pair") & (F.col("step") * 30 > 1500), 1)).alias("too_fast"))
