"""Further queries: vectors for training, labels and instructions, run-length masks, roll-ups, joins by name, message logs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as g
from ..operators import assembly as asm
from ..operators import joins
from ..operators import timeseries as ts
from ..operators.windows import island, ordered
from ..sources import readers, writers
from .adapters import BOXES, FRAMES, HANDS, boxes, frames, hands, table
from .registry import query
from .segmentation import SEGMENTS, built
from .shapes import _ROT, _angle_sql, _d
from .signals import KEYS, ORDER, _recursion, _UPTO, _W


def _round(df: DataFrame, *ids: str, **cols) -> DataFrame:
    return df.select(*ids, *(F.round(c, 6).alias(n) for n, c in cols.items()))


_LABEL = "case when state = 'no_contact' then case when transition = 'idle' then 'idle' when transition = 'contact_on' then 'approach' else 'retreat' end when transition = 'contact_off' then 'release' when grasp = 'open' then 'contact' when grasp in ('precision_pinch', 'power_wrap') then 'grasp' else 'manipulate' end"


@query(f"with {SEGMENTS}, l as (select *, {_LABEL} as label from segs) select episode_id, seg, label, case when label = 'idle' then 'idle (no object)' else label || ' ' || coalesce(object_name, 'an unidentified object') || ' with right hand' end as instruction from l")
def segment_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = built(spark, sf_dir).withColumn("label", g.segment_label(F.col("state"), F.col("transition"), F.col("grasp")))
    return df.select("episode_id", "seg", "label", g.instruction(F.col("label"), F.col("object_name"), F.lit("right")).alias("instruction"))


_OPEN = f"greatest(0, least(1, (({_d(4, 20)} + {_d(8, 20)}) / 2 - 0.05) / 0.45))"
_HAND = [f"{a}0 * 0.5" for a in "xyz"], [f"r{k}" for k in range(6)], [_OPEN], [_angle_sql(*abc) for abc in g.BENDS.values()]
_STATE = ", ".join(f"case when present then {x} else {rest} end as s{i}" for i, (x, rest) in enumerate(zip(sum(_HAND, []), (0, 0, 0, 1, 0, 0, 0, 1, 0, 1, *[0] * 15), strict=True)))
_MOVE = ", ".join(f"round(case when present and lag(present) over {_W} then greatest(-1, least(1, 10 * ({a}0 - lag({a}0) over {_W}))) else 0 end, 6) as a{i}" for i, a in enumerate("xyz"))


@query(f"with {HANDS}, {_ROT}, st as (select episode_id, frame_idx, vec_id, present, x0, y0, z0, {_STATE} from ro) select vec_id, {', '.join(f'round(s{k}, 6) as s{k}' for k in range(24))}, {_MOVE}, {', '.join(f'round(coalesce(s{k} - lag(s{k}) over {_W}, 0), 6) as a{k}' for k in range(3, 9))}, {', '.join(f'round(s{k + 1}, 6) as a{k}' for k in range(9, 24))} from st")
def human_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State and action of every frame, 24 numbers each."""
    df = asm.human_rows(hands(spark, sf_dir), KEYS, ORDER)
    return _round(df, "vec_id", **{f"{side}{k}": f"{side}{k}" for side in "sa" for k in range(24)})


@query(f"with {HANDS}, a as (select episode_id, quantile_cont(x0, 0.5) as ax from hands where present group by 1) select vec_id, round(greatest(-0.1, least(0.1, (x0 - ax) * 0.35)) + 0.5, 6) as aligned_x from hands join a using (episode_id)")
def anchor_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = hands(spark, sf_dir, (0,))
    mid = df.filter("present").groupBy("episode_id").agg(F.percentile("x0", F.lit(0.5)).alias("ax"))
    return _round(df.join(mid, "episode_id"), "vec_id", aligned_x=g.clip((F.col("x0") - F.col("ax")) * 0.35, -0.1, 0.1) + 0.5)


@query(f"with {FRAMES}, d as (select *, abs(value - lag(value) over {_W}) * 30 as px from frames) select episode_id, round(avg(px), 5) as mean_px_per_sec, round(max(px), 5) as max_px_per_sec, coalesce(avg(px) >= 1000, false) as moving from d group by 1")
def camera_motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frames(spark, sf_dir).withColumn("px", F.abs(F.col("value") - F.lag("value").over(ordered(KEYS, ORDER))) * 30)
    return df.groupBy("episode_id").agg(F.round(F.avg("px"), 5).alias("mean_px_per_sec"), F.round(F.max("px"), 5).alias("max_px_per_sec"), F.coalesce(F.avg("px") >= 1000, F.lit(False)).alias("moving"))


@query(f"with {FRAMES}, r as (select episode_id, count(*) as n, sum(value) as s, max(t) as clip from frames group by 1) select episode_id, round(s / n, 6) as seconds_per_frame, round(coalesce(s / nullif(clip, 0), 0), 4) as compute_ratio from r")
def benchmark_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = frames(spark, sf_dir).groupBy("episode_id").agg(F.count("*").alias("n"), F.sum("value").alias("s"), F.max("t").alias("clip"))
    return r.select("episode_id", F.round(F.col("s") / F.col("n"), 6).alias("seconds_per_frame"), F.round(F.coalesce(F.col("s") / F.nullif(F.col("clip"), F.lit(0.0)), F.lit(0.0)), 4).alias("compute_ratio"))


@query(f"with {FRAMES}, o as (select *, present as flag, lag(present) over {_W} as was from frames), i as (select *, sum((flag <> was or was is null)::int) over {_UPTO} as run from o), r as (select episode_id, run, min(frame_idx) as s, count(*) as n, bool_or(flag) as flag from i group by 1, 2), f as (select *, min(run) over (partition by episode_id) = run and flag as lead from r) select episode_id, s as start, n as length, run - 1 + case when max(lead) over (partition by episode_id) then 1 else 0 end as place from f union all select episode_id, 0, 0, 0 from f where lead")
def mask_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run lengths of a mask in order, the first of them of zeros and so maybe empty."""
    df = island(frames(spark, sf_dir), F.col("present"), ordered(KEYS, ORDER), "run")
    r = df.groupBy("episode_id", "run").agg(F.min(ORDER).alias("start"), F.count("*").alias("length"), F.max("present").alias("flag"))
    lead = r.filter("run = 1 and flag").select("episode_id")
    shift = r.join(lead.withColumn("one", F.lit(1)), "episode_id", "left").select("episode_id", "start", "length", (F.col("run") - 1 + F.coalesce("one", F.lit(0))).alias("place"))
    return shift.unionByName(lead.select("episode_id", F.lit(0).alias("start"), F.lit(0).cast("long").alias("length"), F.lit(0).cast("long").alias("place")))


@query("with v as (select doc_id, source as name, n_chars from documents), d as (select source as name, max_by(n_chars, doc_id) as last_chars, count(*) as detections from documents group by 1) select v.doc_id, v.name, d.last_chars, d.detections from v left join d using (name)")
def detections_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left join by name; of repeated detections the last counts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("name"), "n_chars")
    d = docs.groupBy("name").agg(F.max_by("n_chars", "doc_id").alias("last_chars"), F.count("*").alias("detections"))
    return docs.select("doc_id", "name").join(d, "name", "left")


@query(f"with {FRAMES}, a as (select episode_id, list_sort(list_distinct(list(object_name) filter (object_name is not null and k % 2 = 0))) as l, list_sort(list_distinct(list(object_name) filter (object_name is not null and k % 2 = 1))) as r from frames group by 1) select episode_id, array_to_string(list_sort(list_distinct(list_concat(coalesce(l, []), coalesce(r, [])))), ',') as either, array_to_string(list_filter(coalesce(l, []), lambda x: not list_contains(coalesce(r, []), x)), ',') as only_left, coalesce(l, []) = coalesce(r, []) as equal from a")
def object_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union, difference and equality of two hands' object sets."""
    of = lambda k: F.array_sort(F.collect_set(F.when(F.col("k") % 2 == k, F.col("object_name"))))
    a = frames(spark, sf_dir).groupBy("episode_id").agg(of(0).alias("l"), of(1).alias("r"))
    return a.select("episode_id", F.array_join(F.array_sort(F.array_union("l", "r")), ",").alias("either"), F.array_join(F.array_except("l", "r"), ",").alias("only_left"), (F.col("l") == F.col("r")).alias("equal"))


@query(f"with {FRAMES} select episode_id, frame_idx, k from frames qualify row_number() over (partition by episode_id order by k desc, frame_idx) <= 5")
def worst_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five worst rows of every episode."""
    w = Window.partitionBy("episode_id").orderBy(F.desc("k"), ORDER)
    return frames(spark, sf_dir).withColumn("r", F.row_number().over(w)).filter("r <= 5").select("episode_id", "frame_idx", "k")


@query(f"with {FRAMES} select episode_id, frame_idx, value from frames where frame_idx % 3 = 0")
def frame_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.sampled_frames(frames(spark, sf_dir), ORDER, fps=30.0, target_fps=10.0).select("episode_id", "frame_idx", "value")


@query(f"with {FRAMES} select episode_id, count(*) as messages, max(round(t * 1e9))::bigint as last_nanoseconds, sum(k)::bigint as payload_sum from frames group by 1")
def message_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every episode packed as a binary log, read back and counted."""
    logs = writers.message_log(frames(spark, sf_dir), "episode_id", ORDER, "t", F.col("k"))
    back = writers.read_message_log(logs, "episode_id")
    return back.groupBy("episode_id").agg(F.count("*").alias("messages"), F.max("nanoseconds").alias("last_nanoseconds"), F.sum(F.col("payload").cast("long")).alias("payload_sum"))


@query(f"with {HANDS}, {BOXES}, s as (select h.vec_id, b.box, ({' + '.join(f'(x{t} between b.x0 and b.x1 and y{t} between b.y0 and b.y1)::int' for t in g.TIPS)}) * 10 - sqrt(((b.x0 + b.x1) / 2 - h.x0) ** 2 + ((b.y0 + b.y1) / 2 - h.y0) ** 2) as score from (select vec_id, x0, y0, {', '.join(f'x{t}, y{t}' for t in g.TIPS)} from hands) h join boxes b using (vec_id)) select vec_id, box, round(score, 6) as score from s qualify row_number() over (partition by vec_id order by score desc, box) = 1".replace("h.x0", "h.hx").replace("h.y0", "h.hy").replace("(select vec_id, x0, y0,", "(select vec_id, x0 as hx, y0 as hy,"))
def best_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The box with most fingertips inside, nearer to the wrist on ties."""
    h = hands(spark, sf_dir).select("vec_id", F.col("x0").alias("hx"), F.col("y0").alias("hy"), *(f"{a}{t}" for t in g.TIPS for a in "xy"))
    both = h.join(boxes(spark, sf_dir).select("vec_id", "box", *(F.col(c).alias(f"b{c}") for c in ("x0", "y0", "x1", "y1"))), "vec_id")
    inside = sum((F.when(F.col(f"x{t}").between(F.col("bx0"), F.col("bx1")) & F.col(f"y{t}").between(F.col("by0"), F.col("by1")), 1).otherwise(0) for t in g.TIPS), F.lit(0))
    away = F.sqrt(((F.col("bx0") + F.col("bx1")) / 2 - F.col("hx")) ** 2 + ((F.col("by0") + F.col("by1")) / 2 - F.col("hy")) ** 2)
    best = both.groupBy("vec_id").agg(F.max(F.struct((inside * 10 - away).alias("score"), (-F.col("box")).alias("nb"))).alias("m"))
    return best.select("vec_id", (-F.col("m.nb")).alias("box"), F.round("m.score", 6).alias("score"))


@query("with x as (select o_orderkey as export, o_orderdate as written, (select max(o_orderdate) from orders) - interval '365 days' as started from orders) select export, written >= started as fresh from x")
def export_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    top = o.agg((F.max("o_orderdate") - F.expr("interval 365 days")).alias("started"))
    return o.crossJoin(F.broadcast(top)).select(F.col("o_orderkey").alias("export"), (F.col("o_orderdate") >= F.col("started")).alias("fresh"))  # one row


@query(f"with {HANDS} select vec_id, case when present then 'right' when vec_id % 2 = 0 then 'left' end as hand, round(case when present then x4 when vec_id % 2 = 0 then x8 end, 6) as x from hands")
def dominant_hand(spark: SparkSession, sf_dir: str) -> DataFrame:
    right, left = F.col("present"), F.col("vec_id") % 2 == 0
    return hands(spark, sf_dir).select("vec_id", F.when(right, "right").when(left, "left").alias("hand"), F.round(F.when(right, F.col("x4")).when(left, F.col("x8")), 6).alias("x"))


_GUESS = "case when f.k % 2 = 1 then 'left' else 'right' end"
_SIDE = f"case when least(abs(r.lw - f.value / 100), abs(r.rw - f.value / 100)) < 0.25 and r.lw is not null and r.rw is not null then case when abs(r.lw - f.value / 100) < abs(r.rw - f.value / 100) then 'left' else 'right' end else {_GUESS} end"


@query(_recursion(f"{_GUESS} as side, case when f.k % 2 = 1 then f.value / 100 end as lw, case when f.k % 2 = 1 then null else f.value / 100 end as rw", f"{_SIDE}, case when {_SIDE} = 'left' then f.value / 100 else r.lw end, case when {_SIDE} = 'left' then r.rw else f.value / 100 end") + " select episode_id, frame_idx, side from run")
def identity_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side of a single detection: that of the nearer last wrist (the right one if both are as near), if nearer than a quarter; state runs along an episode."""

    def step(last: dict[str, float] | None, pdf: pd.DataFrame) -> tuple[dict[str, np.ndarray], dict[str, float]]:
        last, side = dict(last or {}), []
        for x, guess in zip(pdf["value"] / 100, pdf["k"] % 2, strict=True):
            name = "left" if guess else "right"
            if len(last) == 2:
                near = "left" if abs(last["left"] - x) < abs(last["right"] - x) else "right"
                name = near if abs(last[near] - x) < 0.25 else name
            last[name] = x
            side.append(name)
        return {"side": np.array(side, object)}, last

    df = ts.placed(frames(spark, sf_dir).select("episode_id", "frame_idx", "value", "k"), KEYS, ORDER)
    return ts.carry(df, KEYS, step, {"side": T.StringType()}).select("episode_id", "frame_idx", "side")


@query("with a as (select distinct l_returnflag as name from lineitem), b as (select distinct l_linestatus as name from lineitem) select name, 'a' as side from a where name not in (select name from b) union all select name, 'b' from b where name not in (select name from a)")
def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that only one side has."""
    li = table(spark, sf_dir, "lineitem")
    a, b = li.select(F.col("l_returnflag").alias("name")).distinct(), li.select(F.col("l_linestatus").alias("name")).distinct()
    return a.exceptAll(b).withColumn("side", F.lit("a")).union(b.exceptAll(a).withColumn("side", F.lit("b")))


@query("select n_name as name, max_by(n_nationkey, n_nationkey) as last_key from nation group by 1")
def last_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("last_key"))
    return joins.last_of(n, ["name"], "last_key")
