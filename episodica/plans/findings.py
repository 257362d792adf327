"""Queries of what speaks against contacts, captions and segments; captions are made from the events' numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import plausible
from .both_hands import _BOTH, both
from .registry import query
from .segmentation import SEGMENTS, built
from .signals import KEYS, ORDER

_SAID = "case when frame_idx % 9 = 0 then '' when frame_idx % 9 = 1 then null when episode_id % 6 = 0 then ' Gripping the person.' when episode_id % 6 = 1 then 'A hand, then the Obj_' || (frame_idx % 5) when episode_id % 6 = 2 then 'hold this, face down' when episode_id % 6 = 3 then 'touch OBJ_' || (frame_idx % 2) || ' with the handle' else 'move obj_0 obj_1 obj_2 obj_3 obj_4 obj_5' end"
_ISSUES = lambda *checks: "concat_ws(',', " + ", ".join(f"case when {c} then '{n}' end" for n, c in checks) + ")"


@query(f"""with {_BOTH}, h as (select episode_id, 'right' as hand, frame_idx, right_in_contact as touch, right_object as name from b union all select episode_id, 'left', frame_idx, left_in_contact, left_object from b),
 o as (select *, lag(touch) over (partition by episode_id, hand order by frame_idx) as was from h), i as (select *, sum((touch <> was or was is null)::int) over (partition by episode_id, hand order by frame_idx rows unbounded preceding) as run from o),
 r as (select episode_id, hand, run, bool_and(touch) as lit, count(*) as n, count(name) as named from i group by 1, 2, 3),
 a as (select episode_id, hand, sum(n)::bigint as frames, count_if(lit) as events, count_if(lit and n < 3) as short_events, count_if(lit and n = 1) as single_events, min(n) filter (lit) as shortest, max(n) filter (lit) as longest, round(avg(n) filter (lit), 6) as mean,
  round(coalesce(100.0::double * (sum(n) filter (lit) - sum(named) filter (lit)) / sum(n) filter (lit), 0), 6) as nameless_pct from r group by 1, 2)
select *, {_ISSUES(("short", "short_events > 0"), ("whole", "longest >= frames"), ("unstable", "single_events > 0.5 * events"), ("nameless", "nameless_pct > 30"))} as issues from a""")
def contact_plausibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both hands of an episode, a row each."""
    b = both(spark, sf_dir)
    sides = [F.struct(F.lit(s).alias("hand"), F.col(f"{s}_in_contact").alias("touch"), F.col(f"{s}_object").alias("name")) for s in ("right", "left")]
    rows = b.select(*KEYS, ORDER, F.explode(F.array(*sides)).alias("s")).select(*KEYS, ORDER, "s.*")
    df = plausible.contact_findings(rows, [*KEYS, "hand"], ORDER, "touch", "name")
    return df.withColumns({"mean": F.round("mean", 6), "nameless_pct": F.round("nameless_pct", 6), "issues": F.array_join("issues", ",")})


@query(f"""with {_BOTH}, c as (select *, trim(coalesce({_SAID}, '')) as said from b), t as (select episode_id, said, left_object is not null or right_object is not null as has, coalesce(contains(lower(said), lower(left_object)), false) or coalesce(contains(lower(said), lower(right_object)), false) as told from c),
 g as (select episode_id, said, count(*) as n, count_if(has) as has, count_if(has and said <> '' and not told) as off from t group by 1, 2),
 a as (select episode_id, sum(n)::bigint as frames, (sum(n) - sum(has))::bigint as n_null, count(*) as captions, count_if(regexp_matches(translate(lower(said), ',.', '  '), '(^|\\s)(the|a|an|this)\\s+(person|human|arm|body|hand|torso|face|head)(\\s|$)')) as body_captions, sum(has)::bigint as n_named, sum(off)::bigint as n_mismatch from g group by 1)
select *, {_ISSUES(("no_objects", "n_null > 0.5 * frames"), ("body_part", "body_captions > 0"), ("disconnected", "100 * n_mismatch > 20 * n_named"))} as issues from a""")
def caption_plausibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = both(spark, sf_dir).withColumn("said", F.expr(_SAID))
    return plausible.caption_findings(df, KEYS, "said", ["left_object", "right_object"]).withColumn("issues", F.array_join("issues", ","))


_LABEL = "case when episode_id % 4 = 0 then 'hold' when state = 'contact' then grasp else 'reach' end"
_TEXT = "case when episode_id % 4 = 1 then 'as before' else object_name end"


@query(f"""with {SEGMENTS}, s as (select *, coalesce({_LABEL}, '') as label, coalesce({_TEXT}, '') as said, end_time - start_time as d from segs where episode_id % 7 <> 3 and (episode_id % 7 <> 5 or seg = 1)), e as (select episode_id, case when episode_id % 7 = 5 then max(case when seg = 1 then end_time end) else max(end_time) end as length from segs group by 1),
 a as (select episode_id, count(d) as segments, count_if(coalesce(d < 0.2, false)) as short_segments, round(max(d), 6) as longest, max(length) as length, max(d) as most, count(distinct label) = 1 as l1, count(distinct said) = 1 as t1 from e left join s using (episode_id) group by 1)
select episode_id, segments, short_segments, longest, {_ISSUES(("none", "segments = 0"), ("short", "short_segments > 0"), ("whole", "segments = 1 and most >= 0.98::double * length"), ("one_label", "l1"), ("one_description", "segments > 1 and not l1 and t1"))} as issues from a""")
def segment_plausibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of contact; some episodes have lost all of theirs, some have only the first, which is all there is of them."""
    segs = built(spark, sf_dir).withColumns({"label": F.expr(_LABEL), "said": F.expr(_TEXT)})
    one = F.col("episode_id") % 7 == 5
    length = segs.groupBy(*KEYS).agg(F.coalesce(F.max(F.when(one & (F.col("seg") == 1), F.col("end_time"))), F.max(F.when(~one, F.col("end_time")))).alias("length"))
    segs = segs.filter((F.col("episode_id") % 7 != 3) & (~one | (F.col("seg") == 1)))
    df = plausible.segment_findings(segs, length, KEYS, "start_time", "end_time", "label", "said", "length")
    return df.withColumns({"longest": F.round("longest", 6), "issues": F.array_join("issues", ",")})
