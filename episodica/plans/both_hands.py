"""Queries of frames with two hands; the right one is the events' own, the left one is made from their number k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import two_hands as th
from .adapters import FRAMES, frames
from .registry import query
from .segmentation import IDLE
from .signals import KEYS, ORDER, _UPTO, _W

_GRASPS = ["precision_pinch", "power_wrap", "hook", "open", "unknown"]


def both(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    left = F.element_at(F.array(*map(F.lit, _GRASPS)), (F.col(ORDER) % 5 + 1).cast("int"))
    return frames(spark, sf_dir).select(
        *KEYS, ORDER, "t", F.col("present").alias("right_present"), F.col("in_contact").alias("right_in_contact"), F.col("object_name").alias("right_object"), F.col("grasp").alias("right_grasp"), (k % 7 == 0).alias("right_guessed"),
        (k % 3 != 0).alias("left_present"), (k % 4 == 1).alias("left_in_contact"), F.when((k % 4 == 1) & (k % 8 != 5), F.concat(F.lit("obj_"), (k % 6).cast("string"))).alias("left_object"), F.when(k % 3 != 0, left).alias("left_grasp"), (k % 11 == 0).alias("left_guessed"),
    )


_BOTH = f"""{FRAMES}, b as (select episode_id, frame_idx, t, present as right_present, in_contact as right_in_contact, object_name as right_object, grasp as right_grasp, k % 7 = 0 as right_guessed,
  k % 3 <> 0 as left_present, k % 4 = 1 as left_in_contact, case when k % 4 = 1 and k % 8 <> 5 then 'obj_' || (k % 6) end as left_object, case when k % 3 <> 0 then {_GRASPS}[frame_idx % 5 + 1] end as left_grasp, k % 11 = 0 as left_guessed from frames)"""
_NAMED = "case when right_in_contact and right_object is not null then [right_object] else [] end || case when left_in_contact and left_object is not null then [left_object] else [] end"


@query(f"""with {_BOTH}, o as (select *, {_NAMED} as objects, case when right_in_contact and right_grasp is not null then right_grasp when left_in_contact and left_grasp is not null then left_grasp else 'none' end as grip from b), st as (select *, len(objects) > 0 as contact, list_sort(list_distinct(objects)) as s from o),
 ch as (select *, case when frame_idx = 0 then 'start' when contact <> lag(contact) over {_W} then case when contact then 'contact_on' else 'contact_off' end when contact and s <> lag(s) over {_W} then 'object_change' when contact and grip <> lag(grip) over {_W} then 'grasp_change' end as change from st),
 ir as (select *, sum((contact <> was or was is null)::int) over {_UPTO} as run, max(frame_idx) over (partition by episode_id) as last, max(t) over (partition by episode_id) as t_end, lead(t) over {_W} as t_next from (select *, lag(contact) over {_W} as was from ch)),
 il as (select episode_id, run, min(frame_idx) as lo, max(frame_idx) as hi, min(t) as t0, max(last) as last, coalesce(max_by(t_next, frame_idx), max(t_end)) as t1 from ir where not contact group by 1, 2),
 idle as (select distinct episode_id, unnest([lo, case when hi = last then last else hi + 1 end]) as frame_idx from il where t1 - t0 >= {IDLE}),
 ty as (select c.*, coalesce(c.change, case when i.frame_idx is not null then 'idle' end) as type from ch c left join idle i on i.episode_id = c.episode_id and i.frame_idx = c.frame_idx), nu as (select *, sum((type is not null)::int) over {_UPTO} as seg, max(frame_idx) over (partition by episode_id) as last from ty),
 bu as (select episode_id, seg, min(frame_idx) as start_frame, max(frame_idx) + 1 as end_frame, min(t) as start_time, max(t) as last_time, max(last) as last, bool_or(left_in_contact) as l, bool_or(right_in_contact) as r from nu group by 1, 2),
 ob as (select episode_id, seg, frame_idx, unnest(objects) as name, unnest(range(len(objects))) as p from nu), el as (select episode_id, name from ob group by 1, 2 having count(*) >= 3),
 tp as (select episode_id, seg, name from (select episode_id, seg, name, count(*) as c, min(frame_idx * 2 + p) as seen from ob join el using (episode_id, name) group by 1, 2, 3) qualify row_number() over (partition by episode_id, seg order by c desc, seen) = 1)
select b.episode_id, b.seg, b.start_frame, b.end_frame, round(b.start_time, 6) as start_time, round(coalesce(lead(b.start_time) over (partition by b.episode_id order by b.seg), b.last_time), 6) as end_time, coalesce(e.type, 'end') as transition, case when m.contact then 'contact' else 'no_contact' end as state, m.grip as grasp, tp.name as object_name,
 case when l and r then 'left,right' when l then 'left' else 'right' end as hands, case when l and r then 'both' when l then 'left' else 'right' end as hand_used
from bu b join nu m on m.episode_id = b.episode_id and m.frame_idx = least((b.start_frame + b.end_frame) // 2, b.last) left join tp on tp.episode_id = b.episode_id and tp.seg = b.seg left join nu e on e.episode_id = b.episode_id and e.frame_idx = b.end_frame""")
def two_hand_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = th.two_hand_segments(both(spark, sf_dir), KEYS, ORDER, "t", IDLE)
    return df.withColumns({"hands": F.array_join("hands", ","), "start_time": F.round("start_time", 6), "end_time": F.round("end_time", 6)})


@query(f"""with {_BOTH}, a as (select *, max(left_present or right_present) over (partition by episode_id order by frame_idx rows between 10 preceding and 10 following) as active from b)
select episode_id, count(*) as frames, {", ".join(f"count_if({s}_in_contact) as {s}_contact_frames, round(count_if({s}_in_contact) / count(*), 6) as {s}_contact_ratio, " + ", ".join(f"count_if(coalesce({s}_grasp = '{g}', false)) as {s}_{g}" for g in _GRASPS) for s in th.SIDES)},
 round(100.0::double * count_if(not (left_present and right_present)) / count(*), 6) as loss_pct, round(coalesce(100.0::double * count_if(active and not (left_present and right_present)) / nullif(count_if(active), 0), 0), 6) as active_loss_pct, round(100.0::double * count_if(left_guessed or right_guessed) / count(*), 6) as guessed_pct from a group by 1""")
def two_hand_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = th.two_hand_summary(both(spark, sf_dir), KEYS, ORDER)
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c.endswith(("_ratio", "_pct"))})


@query(f"with {_BOTH}, c as (select episode_id, count_if(left_present and frame_idx % 2 = 0) as n_left, count_if(right_present and episode_id % 3 <> 0) as n_right from b group by 1), p as (select unnest(['auto', 'left', 'right']) as preferred) select c.*, preferred, case when n_left = 0 and n_right = 0 then 'none' when preferred = 'auto' then case when n_left > n_right then 'left' else 'right' end when preferred = 'left' then case when n_left > 0 then 'left' else 'right' end else case when n_right > 0 then 'right' else 'left' end end as hand from c, p")
def leading_hand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hand that leads an episode, without and with a preference; some episodes lack the right hand."""
    df = both(spark, sf_dir).withColumns({"left_present": F.col("left_present") & (F.col(ORDER) % 2 == 0), "right_present": F.col("right_present") & (F.col("episode_id") % 3 != 0)})
    parts = [th.leading_hand(df, KEYS, p).withColumn("preferred", F.lit(p)) for p in ("auto", "left", "right")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
