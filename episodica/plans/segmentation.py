"""Queries of the segmentation operators and of joins between frames and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins, segments as sg, timeseries as ts
from .adapters import FRAMES, frames
from .registry import query
from .signals import KEYS, ORDER, _UPTO, _W

IDLE = 0.1  # events stand 1/30 s apart: an idle run of three frames counts

STATES = f"""{FRAMES}, st as (select *, in_contact and object_name is not null as contact, case when in_contact and object_name is not null then grasp else 'none' end as grip from frames),
 ch as (select *, case when frame_idx = 0 then 'start' when contact <> lag(contact) over {_W} then case when contact then 'contact_on' else 'contact_off' end
   when contact and object_name is distinct from lag(object_name) over {_W} then 'object_change' when contact and grip <> lag(grip) over {_W} then 'grasp_change' end as change from st)"""
IDLES = f"""ir as (select *, sum((contact <> was or was is null)::int) over {_UPTO} as run, max(frame_idx) over (partition by episode_id) as last, max(t) over (partition by episode_id) as t_end, lead(t) over {_W} as t_next from (select *, lag(contact) over {_W} as was from ch)),
 il as (select episode_id, run, min(frame_idx) as lo, max(frame_idx) as hi, min(t) as t0, max(last) as last, coalesce(max_by(t_next, frame_idx), max(t_end)) as t1 from ir where not contact group by 1, 2),
 idle as (select distinct episode_id, unnest([lo, case when hi = last then last else hi + 1 end]) as frame_idx from il where t1 - t0 >= {IDLE})"""
SEGMENTS = f"""{STATES}, {IDLES}, ty as (select c.*, coalesce(c.change, case when i.frame_idx is not null then 'idle' end) as type from ch c left join idle i on i.episode_id = c.episode_id and i.frame_idx = c.frame_idx),
 nu as (select *, sum((type is not null)::int) over {_UPTO} as seg, max(frame_idx) over (partition by episode_id) as last from ty),
 bu as (select episode_id, seg, min(frame_idx) as start_frame, max(frame_idx) + 1 as end_frame, min(t) as start_time, max(t) as last_time, max(last) as last from nu group by 1, 2),
 ob as (select episode_id, seg, object_name from (select episode_id, seg, object_name, count(*) as c, min(frame_idx) as seen from nu where contact group by 1, 2, 3) qualify row_number() over (partition by episode_id, seg order by c desc, seen) = 1),
 segs as (select b.episode_id, b.seg, b.start_frame, b.end_frame, b.start_time, coalesce(lead(b.start_time) over (partition by b.episode_id order by b.seg), b.last_time) as end_time, coalesce(e.type, 'end') as transition,
   case when m.contact then 'contact' else 'no_contact' end as state, m.grip as grasp, o.object_name
   from bu b join nu m on m.episode_id = b.episode_id and m.frame_idx = least((b.start_frame + b.end_frame) // 2, b.last) left join ob o on o.episode_id = b.episode_id and o.seg = b.seg left join nu e on e.episode_id = b.episode_id and e.frame_idx = b.end_frame)"""


def built(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sg.segments(frames(spark, sf_dir), KEYS, ORDER, "t", idle_sec=IDLE)


@query(f"with {STATES} select episode_id, frame_idx, contact, grip, change from ch")
def change_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sg.change_points(sg.frame_states(frames(spark, sf_dir)), KEYS, ORDER).select("episode_id", "frame_idx", "contact", "grip", "change")


@query(f"with {STATES}, {IDLES} select * from idle")
def idle_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sg.idle_boundaries(sg.frame_states(frames(spark, sf_dir)), KEYS, ORDER, "t", IDLE)


@query(f"with {SEGMENTS} select episode_id, seg, start_frame, end_frame, round(start_time, 6) as start_time, round(end_time, 6) as end_time, transition, state, grasp, object_name from segs")
def segment_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir).withColumns({c: F.round(c, 6) for c in ("start_time", "end_time")})


@query(f"""with {SEGMENTS}, s as (select episode_id, state, count(*) as segments, sum(end_frame - start_frame) as frames, round(sum(end_time - start_time), 6) as seconds from segs group by 1, 2),
 o as (select episode_id, object_name from (select episode_id, object_name, count(*) as c, min(frame_idx) as seen from ch where contact group by 1, 2) qualify row_number() over (partition by episode_id order by c desc, seen) = 1)
select s.*, o.object_name as main_object from s left join o using (episode_id)""")
def contact_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: segments of every episode, summed by state, with the episode's main object."""
    df = frames(spark, sf_dir)
    by_state = built(spark, sf_dir).groupBy("episode_id", "state").agg(F.count("*").alias("segments"), F.sum(F.col("end_frame") - F.col("start_frame")).alias("frames"), F.round(F.sum(F.col("end_time") - F.col("start_time")), 6).alias("seconds"))
    from ..operators.windows import mode_first_seen

    main = mode_first_seen(sg.frame_states(df).filter("contact"), KEYS, "object_name", ORDER, "main_object").drop("votes")
    return by_state.join(main, "episode_id", "left")


_FIELDS = ("start_frame", "end_frame", "start_time", "end_time", "transition", "state", "grasp", "object_name")


def _folded(name: str, source: str, does: str, taken: dict[str, str]) -> str:
    """One pass over the segments of an episode: `does` says of s (this row, with the next one's columns as n_*) and r (the segment so far) whether it is new, joins or leaps, or is skipped after a leap; taken: columns of what joins."""
    w = "over (partition by episode_id order by start_frame)"
    ahead = ", ".join(f"lead({c}) {w} as n_{c}" for c in _FIELDS)

    def of(c: str) -> str:
        joined = taken.get(c, f"r_{c}")
        return f"case act when 'new' then {c} when 'skip' then r_{c} when 'join' then {joined.format(at='')} else {joined.format(at='n_')} end as {c}"

    return (
        f"{name}_in as (select episode_id, {', '.join(_FIELDS)}, {ahead}, row_number() {w} as i from {source}), "
        f"{name}_run as (select episode_id, i, 1 as g, 'new' as act, {', '.join(_FIELDS)} from {name}_in where i = 1 union all select episode_id, i, r_g + (act = 'new')::int, act, {', '.join(map(of, _FIELDS))} "
        f"from (select s.*, {', '.join(f'r.{c} as r_{c}' for c in _FIELDS)}, r.g as r_g, {does} as act from {name}_run r join {name}_in s on s.episode_id = r.episode_id and s.i = r.i + 1)), "
        f"{name} as (select episode_id, {', '.join(_FIELDS)} from {name}_run qualify row_number() over (partition by episode_id, g order by i desc) = 1)"
    )


_END = {"end_frame": "{at}end_frame", "end_time": "{at}end_time", "object_name": "coalesce(r_object_name, {at}object_name)"}
_SHORT = "s.end_time - s.start_time < 0.05::double"
_JITTER = _folded(
    "calm", "segs", f"case when r.act = 'leap' then 'skip' when {_SHORT} and r.state = s.state then 'join' when {_SHORT} and r.state = s.n_state then 'leap' else 'new' end",
    _END | {"grasp": "case when r_grasp <> 'unknown' then r_grasp else {at}grasp end"})
_MERGE = _folded(
    "merged", "calm", "case when r.state = s.state and (r.grasp = s.grasp or r.grasp in ('none', 'unknown') or s.grasp in ('none', 'unknown')) and r.object_name is not distinct from s.object_name and s.start_time - r.end_time <= 0.3::double then 'join' else 'new' end",
    _END | {"grasp": "case when {at}grasp not in ('none', 'unknown') then {at}grasp else r_grasp end"})
_FOLDED = "select episode_id, start_frame, end_frame, round(start_time, 6) as start_time, round(end_time, 6) as end_time, transition, state, grasp, object_name from "


def _rounded(segs: DataFrame) -> DataFrame:
    return segs.withColumns({c: F.round(c, 6) for c in ("start_time", "end_time")})


@query(f"with recursive {SEGMENTS}, {_JITTER} {_FOLDED} calm")
def jitter_absorb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sg.absorb_jitter(built(spark, sf_dir), KEYS, min_sec=0.05))


@query(f"with recursive {SEGMENTS}, {_JITTER}, {_MERGE} {_FOLDED} merged")
def segment_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sg.merge_adjacent(sg.absorb_jitter(built(spark, sf_dir), KEYS, min_sec=0.05), KEYS))


@query(f"""with {SEGMENTS}, f as (select episode_id, sum((contact <> was)::int) as transitions from (select *, lag(contact) over {_W} as was from st) group by 1), c as (select episode_id, count(*) as segments from segs group by 1)
select f.episode_id, coalesce(transitions, 0) as transitions, segments, transitions >= 5 and segments = 1 as collapsed from f join c using (episode_id)""")
def collapse_warning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sg.collapsed(frames(spark, sf_dir), built(spark, sf_dir), KEYS, ORDER)


_ISLANDS = f"ok as ({{0}}), wi as (select *, lag(flag) over {_W} as was from ok), isl as (select *, sum((flag <> was or was is null)::int) over {_UPTO} as run from wi), rn as (select episode_id, min(frame_idx) as run_start, max(frame_idx) + 1 as run_end, count(*) as n from isl where flag group by episode_id, run)"


@query(f"with {FRAMES}, {_ISLANDS.format('select *, in_contact as flag from frames')} select * from rn")
def run_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sg.runs(frames(spark, sf_dir), F.col("in_contact"), KEYS, ORDER)


@query(f"with {FRAMES}, {_ISLANDS.format('select *, present and value / 1000 < 0.07 and k / 100.0::double < 0.9 as flag from frames')} select *, run_start as grasp_frame from rn where n >= 3")
def grasp_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frames(spark, sf_dir).withColumns({"opening": F.col("value") / 1000, "distance": F.col("k") / 100.0})
    return sg.grasp_windows(df, KEYS, ORDER, "present", "opening", "distance", close=0.07, near=0.9, min_rows=3)


@query(f"""with {SEGMENTS}, j as (select f.episode_id, f.frame_idx, s.start_time, s.state || ':' || s.grasp as segment from frames f left join segs s on s.episode_id = f.episode_id and s.state = 'contact' and f.t between s.start_time and s.end_time
  qualify row_number() over (partition by f.episode_id, f.frame_idx order by s.start_time) = 1)
select episode_id, frame_idx, coalesce(segment, 'idle') as segment from j""")
def frame_segment_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    segs = built(spark, sf_dir).filter("state = 'contact'").withColumn("name", F.concat_ws(":", "state", "grasp"))
    found = joins.interval_first(frames(spark, sf_dir).select("episode_id", "frame_idx", "t"), segs, KEYS, "t", "start_time", "end_time", "name")
    return found.select("episode_id", "frame_idx", F.coalesce("name", F.lit("idle")).alias("segment"))


_TRUTH = "gt as (select episode_id, object_name, min(t) as start, max(t) as stop from frames where in_contact group by 1, 2)"


@query(f"with {FRAMES}, {_TRUTH} select episode_id, object_name, round(start, 6) as start, round(stop, 6) as stop from gt")
def gt_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.ranges_of(frames(spark, sf_dir).filter("in_contact"), [*KEYS, "object_name"], "t").withColumns({c: F.round(c, 6) for c in ("start", "stop")})


@query(f"""with {SEGMENTS}, {_TRUTH}, n as (select s.episode_id, s.seg, g.object_name, abs(s.start_time - g.start) as start_error, abs(s.end_time - g.stop) as end_error
  from segs s left join gt g using (episode_id) qualify row_number() over (partition by s.episode_id, s.seg order by round(abs(s.start_time - g.start) + abs(s.end_time - g.stop), 9), g.object_name) = 1)
select episode_id, seg, object_name, round(start_error, 6) as start_error, round(end_error, 6) as end_error from n""")
def nearest_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = joins.ranges_of(frames(spark, sf_dir).filter("in_contact"), [*KEYS, "object_name"], "t")
    found = joins.nearest_interval(built(spark, sf_dir).select("episode_id", "seg", "start_time", "end_time"), truth, KEYS, ["seg"], "object_name")
    return found.select("episode_id", "seg", "object_name", F.round("start_error", 6).alias("start_error"), F.round("end_error", 6).alias("end_error"))


@query(f"""with {FRAMES}, p as (select *, frame_idx % 3 as m from frames), j as (select g.episode_id, g.in_contact as truth, g.grasp as gt_grasp, p.present and p.k % 2 = 0 as predicted,
  case when p.k % 7 = 0 then null else p.grasp end as grasp from frames g left join p on p.episode_id = g.episode_id and p.frame_idx = g.frame_idx),
 c as (select episode_id, count(*) as n, sum((truth and predicted)::int) as tp, sum((not truth and predicted)::int) as fp, sum((truth and not predicted)::int) as fn, sum((not truth and not predicted)::int) as tn,
  count(grasp) as grasp_n, sum((grasp = gt_grasp)::int) as grasp_ok from j group by 1)
select episode_id, n, round((tp + tn)::double / n, 6) as accuracy, round(coalesce(tp::double / nullif(tp + fp, 0), 0), 6) as precision, round(coalesce(tp::double / nullif(tp + fn, 0), 0), 6) as recall, round(coalesce(grasp_ok::double / nullif(grasp_n, 0), 0), 6) as grasp_accuracy from c""")
def gt_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frames(spark, sf_dir)
    truth = df.select("episode_id", "frame_idx", F.col("in_contact").alias("truth"), F.col("grasp").alias("gt_grasp"))
    predicted = df.select("episode_id", "frame_idx", (F.col("present") & (F.col("k") % 2 == 0)).alias("predicted"), F.when(F.col("k") % 7 != 0, F.col("grasp")).alias("grasp"))
    out = joins.evaluate(truth.join(predicted, ["episode_id", "frame_idx"], "left"), KEYS, "truth", "predicted", "gt_grasp", "grasp")
    return out.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "grasp_accuracy")})


@query(f"""with {FRAMES}, a as (select *, max(present) over (partition by episode_id order by frame_idx rows between 10 preceding and 10 following) as active from frames)
select episode_id, round(100.0 * sum((not present)::int) / count(*), 6) as lost_pct, round(coalesce(100.0 * sum((active and not present)::int) / nullif(sum(active::int), 0), 0), 6) as lost_pct_active, round(100.0 * sum((k % 9 = 0)::int) / count(*), 6) as interpolated_pct from a group by 1""")
def tracking_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ts.dilate(frames(spark, sf_dir), "present", KEYS, ORDER)
    share = lambda c, n: F.coalesce(100.0 * F.count_if(c) / F.nullif(n, F.lit(0)), F.lit(0.0))
    return df.groupBy("episode_id").agg(
        F.round(share(~F.col("present"), F.count("*")), 6).alias("lost_pct"), F.round(share(F.col("active") & ~F.col("present"), F.count_if("active")), 6).alias("lost_pct_active"), F.round(share(F.col("k") % 9 == 0, F.count("*")), 6).alias("interpolated_pct"))
