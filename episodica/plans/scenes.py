"""Queries of tracks, masks and depth over vectors as frames with two detections and as images of 8 x 8 depths, and over events as masks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..operators import masks, tracks
from ..operators.windows import before, ordered
from .adapters import BOXES, FRAMES, HANDS, boxes, frames, hands, table
from .registry import query
from .signals import KEYS, ORDER, _UPTO

_BOX = ["x0", "y0", "x1", "y1"]


def _sightings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Detections of score above 0 with names, keyframes (every 15th), frames of an episode."""
    at = hands(spark, sf_dir, (0,)).select(*KEYS, ORDER, "vec_id")
    seen = boxes(spark, sf_dir).filter("score > 0").join(at, "vec_id").withColumn("name", F.concat(F.lit("obj_"), ((F.col("label") + 2 * F.col("box")) % 5).cast("string")))
    return seen.filter(F.col(ORDER) % 15 == 0).select(*KEYS, ORDER, "name", *_BOX), at.filter(F.col(ORDER) % 15 == 0), at


_SEEN = f"""{HANDS}, {BOXES}, spots as (select episode_id, frame_idx, vec_id from hands), det as (select episode_id, frame_idx, 'obj_' || ((label + 2 * box) % 5) as name, boxes.x0, boxes.y0, boxes.x1, boxes.y1 from boxes join spots using (vec_id) where score > 0 and frame_idx % 15 = 0),
 n as (select episode_id, count(*) as n from spots group by 1), names as (select distinct episode_id, name from det), near as (select a.episode_id, a.frame_idx, a.vec_id, a.frame_idx - a.frame_idx % 15 as kl, case when a.frame_idx % 15 = 0 then a.frame_idx when a.frame_idx - a.frame_idx % 15 + 15 < n then a.frame_idx - a.frame_idx % 15 + 15 end as kr from spots a join n using (episode_id)),
 grid as (select near.*, names.name, (l.x0, l.y0, l.x1, l.y1) as lb, (r.x0, r.y0, r.x1, r.y1) as rb, l.name is not null as hl, r.name is not null as hr, case when kr > kl then (near.frame_idx - kl) / (kr - kl)::double else 0 end as s from near join names using (episode_id)
  left join det l on l.episode_id = near.episode_id and l.frame_idx = kl and l.name = names.name left join det r on r.episode_id = near.episode_id and r.frame_idx = kr and r.name = names.name)"""


def _boxes_sql(pad: float, hold: bool) -> str:
    mix = [f"(lb[{k}] + (rb[{k}] - lb[{k}]) * s)" for k in range(1, 5)]
    more = f"{pad} * (({mix[2]} - {mix[0]}) + ({mix[3]} - {mix[1]})) / 2"
    return ", ".join(f"round(case when hl and hr and s > 0 then {mix[k]} {'+' if k >= 2 else '-'} {more} when hl then lb[{k + 1}] {f'when hr then rb[{k + 1}]' if hold else ''} end, 6) as {c}" for k, c in enumerate(_BOX))


@query(f"with {_SEEN} select episode_id, frame_idx, name, {_boxes_sql(0.0, True)} from grid where hl or hr")
def object_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frame's boxes by name: linear between keyframes that both have the object, held where one has."""
    seen, keys, at = _sightings(spark, sf_dir)
    out = tracks.tracks(tracks.between_keyframes(seen, keys, KEYS, "name", ORDER), at.groupBy(*KEYS).agg(F.count("*").alias("n")), KEYS, ORDER)
    return out.select(*KEYS, ORDER, "name", *(F.round(c, 6).alias(c) for c in _BOX))


@query(f"with {_SEEN} select episode_id, frame_idx, name, {_boxes_sql(0.15, False)} from grid where hl")
def padded_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes between keyframes widened by 15 % of their mean side; an object that only the next keyframe has isn't there yet."""
    seen, keys, at = _sightings(spark, sf_dir)
    out = tracks.tracks(tracks.between_keyframes(seen, keys, KEYS, "name", ORDER), at.groupBy(*KEYS).agg(F.count("*").alias("n")), KEYS, ORDER, pad=0.15, hold_right=False)
    return out.select(*KEYS, ORDER, "name", *(F.round(c, 6).alias(c) for c in _BOX))


@query(f"with {_SEEN}, reads as (select episode_id, frame_idx, vec_id, 'obj_' || (vec_id % 6) as name from spots where vec_id % 4 = 0) select r.vec_id, r.name, {_boxes_sql(0.15, True)} from reads r left join grid on grid.vec_id = r.vec_id and grid.name = r.name")
def track_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes only at the rows that ask for one; null where the object has none."""
    seen, keys, at = _sightings(spark, sf_dir)
    reads = at.filter("vec_id % 4 = 0").withColumn("name", F.concat(F.lit("obj_"), (F.col("vec_id") % 6).cast("string")))
    out = tracks.tracks_at(tracks.between_keyframes(seen, keys, KEYS, "name", ORDER), keys, reads, KEYS, "name", ORDER, pad=0.15)
    return out.select("vec_id", "name", *(F.round(c, 6).alias(c) for c in _BOX))


_MASKS = {"seen": "present", "touched": "in_contact", "even": "k % 2 = 0"}


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three masks of every episode as runs of its frames: seen, touched, even."""
    # one pass numbers the runs of all masks by the rows off so far, which are the same within a run
    w, off = ordered(KEYS, ORDER), {m: F.when(F.expr(f), 0).otherwise(1) for m, f in _MASKS.items()}
    f = frames(spark, sf_dir).select(*KEYS, ORDER, *(o.alias(m) for m, o in off.items())).withColumns({f"{m}_run": F.sum(m).over(before(w)) for m in _MASKS})
    each = F.explode(F.array(*(F.struct(F.lit(m).alias("mask"), F.col(m).alias("off"), F.col(f"{m}_run").alias("run")) for m in _MASKS))).alias("_m")
    on = f.select(*KEYS, ORDER, each).filter("_m.off = 0")
    return on.groupBy(*KEYS, "_m.mask", "_m.run").agg(F.min(ORDER).cast("long").alias("start"), F.count("*").alias("length")).select(*KEYS, "mask", "start", "length")


_FLAGS = f"{FRAMES}, flags as (" + " union all ".join(f"select episode_id, '{m}' as mask, frame_idx, {f} as flag from frames" for m, f in _MASKS.items()) + f"), runs as (select episode_id, mask, min(frame_idx)::bigint as start, count(*) as length from (select *, sum((not flag)::int) over (partition by episode_id, mask order by frame_idx rows unbounded preceding) as r from flags) where flag group by episode_id, mask, r)"


@query(f"with {_FLAGS} select * from runs")
def mask_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs written as counts and read back, with the check of their sum."""
    n = frames(spark, sf_dir).groupBy(*KEYS).agg(F.count("*").alias("size"))
    counts = masks.encode_counts(_runs(spark, sf_dir).join(n, KEYS), [*KEYS, "mask"], "size")
    return masks.decode_counts(counts.join(n, KEYS).withColumns({"height": F.lit(1), "width": F.col("size")}), [*KEYS, "mask"])


@query(f"""with {FRAMES}, c as (select episode_id, present as seen, in_contact as touched, k % 2 = 0 as even from frames), p as (select episode_id, a, b, count(*) filter (x and y) as common, count(*) filter (x or y) as either from (
  select episode_id, 'seen' as a, 'touched' as b, seen as x, touched as y from c union all select episode_id, 'even', 'seen', even, seen from c union all select episode_id, 'touched', 'even', touched, even from c) group by 1, 2, 3)
select *, round(coalesce(common / nullif(either, 0)::double, 0), 6) as iou from p""")
def mask_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of three pairs of masks of an episode, by a sweep over their runs."""
    pairs = frames(spark, sf_dir).select(*KEYS).distinct().select(*KEYS, F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in (("seen", "touched"), ("even", "seen"), ("touched", "even"))))).alias("p")).select(*KEYS, "p.*")
    out = masks.overlaps(_runs(spark, sf_dir), pairs, KEYS, "mask")
    return out.withColumn("iou", F.round("iou", 6))


@query(f"""with {FRAMES}, c as (select episode_id, frame_idx, present::int + in_contact::int + (k % 2 = 0)::int as n from frames), f as (select episode_id, least, frame_idx, n >= least as flag from c, (select unnest([1, 2, 3]) as least)),
 r as (select *, sum((not flag)::int) over (partition by episode_id, least order by frame_idx rows unbounded preceding) as r from f) select episode_id, least, min(frame_idx)::bigint as start, count(*) as length from r where flag group by episode_id, least, r""")
def mask_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union, majority and intersection of an episode's three masks as runs."""
    runs = _runs(spark, sf_dir)
    parts = [masks.combine(runs, KEYS, n).select(*KEYS, F.lit(n).alias("least"), "start", "length") for n in (1, 2, 3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


#: Depth images are of so many pixels a side, column by column.
SIDE = 8


def _depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("at", "z"))
    return e.select("vec_id", "at", F.floor(F.col("at") / SIDE).cast("int").alias("u"), (F.col("at") % SIDE).alias("v"), F.col("z").cast("double").alias("z"))


_DEPTHS = f"depths as (select vec_id, place, place // {SIDE} as u, place % {SIDE} as v, z from (select vec_id, unnest(range(len(embedding))) as place, unnest(embedding)::double as z from embeddings))"
_LOW, _HIGH = "greatest(0, floor(({c} + 0.5) * 8 + 1e-6))", "least(8, ceil(({c} + 0.5) * 8 - 1e-6))"


@query(f"""with {BOXES}, {_DEPTHS}, px as (select vec_id, box, {_LOW.format(c="x0")} as a, {_LOW.format(c="y0")} as b, {_HIGH.format(c="x1")} as c, {_HIGH.format(c="y1")} as d from boxes), ce as (select vec_id, box, (a + c) / 2 as cu, (b + d) / 2 as cv from px where c > a and d > b),
 m as (select ce.vec_id, box, cu, cv, quantile_cont(z, 0.5) as z from ce join depths on depths.vec_id = ce.vec_id and abs(u - floor(cu)) <= 1 and abs(v - floor(cv)) <= 1 and z > 0 group by all)
select ce.vec_id, ce.box, round((ce.cu - 4) * z / 10, 6) as x, round((ce.cv - 4) * z / 10, 6) as y, round(z, 6) as z from ce left join m on m.vec_id = ce.vec_id and m.box = ce.box""")
def patch_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections as points: the median depth of 3 x 3 pixels at the middle of a box, projected back."""
    low, high = (lambda c: F.greatest(F.lit(0.0), F.floor((F.col(c) + 0.5) * SIDE + 1e-6))), (lambda c: F.least(F.lit(float(SIDE)), F.ceil((F.col(c) + 0.5) * SIDE - 1e-6)))
    px = boxes(spark, sf_dir).select("vec_id", "box", low("x0").alias("a"), low("y0").alias("b"), high("x1").alias("c"), high("y1").alias("d")).filter("c > a and d > b")
    px = px.select("vec_id", "box", ((F.col("a") + F.col("c")) / 2).alias("cu"), ((F.col("b") + F.col("d")) / 2).alias("cv")).withColumns({"u": F.floor("cu").cast("int"), "v": F.floor("cv").cast("int")})
    at = masks.patch_medians(px, _depths(spark, sf_dir), ["vec_id"], ["box"])
    x, y, z = g.back_project(F.col("cu"), F.col("cv"), F.col("z"), 10, 10, 4, 4)
    return at.select("vec_id", "box", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"), F.round(z, 6).alias("z"))


@query(f"""with {_DEPTHS}, m as (select vec_id, 0 as mask, label as a, label + 30 as b from embeddings union all select vec_id, 1, label * 3, label * 3 + 7 from embeddings), p as (select m.vec_id, mask, u, v, case when z > 0 then z end as z from m join depths on depths.vec_id = m.vec_id and place >= a and place < b)
select vec_id, mask, round(avg(u), 6) as u, round(avg(v), 6) as v, round(quantile_cont(z, 0.5), 6) as z from p group by 1, 2""")
def mask_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle and the exact median depth of every mask, masks as overlapping runs."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("long").alias("l"))
    runs = e.select("vec_id", F.explode(F.array(*(F.struct(F.lit(m).alias("mask"), s.cast("long").alias("start"), F.lit(n).cast("long").alias("length")) for m, s, n in ((0, F.col("l"), 20), (0, F.col("l") + 15, 15), (1, F.col("l") * 3, 7))))).alias("r")).select("vec_id", "r.*")
    out = masks.mask_medians(runs, _depths(spark, sf_dir), ["vec_id"], "mask", SIDE)
    return out.select("vec_id", "mask", *(F.round(c, 6).alias(c) for c in ("u", "v", "z")))
