"""Queries of whole contact decisions: hands among several objects, some of them body parts, some frames without boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..operators import contact
from .adapters import BOXES, HANDS, boxes, hands
from .registry import query
from .shapes import _DEPTH

_SIDES = "case when vec_id % 3 = 0 then 'left' else 'right' end"
_NAME = "case when label % 7 = 0 and box = 1 then 'left Hand' when label % 5 = 0 and vec_id % 2 = 0 then 'unknown' when label % 4 = 1 then null else 'obj_' || (label % 3) end"


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of the frames of `hands`: every fifth frame has one object, every eleventh none with a box."""
    b = boxes(spark, sf_dir).filter("box = 0 or vec_id % 5 <> 0")
    frame = hands(spark, sf_dir, points=(0,)).select("episode_id", "frame_idx", "vec_id")
    blank = F.col("vec_id") % 11 == 0
    at = {c: F.when(~blank, F.col(c) - 0.05 if c in ("x0", "y0") else F.col(c) + 0.05) for c in ("x0", "y0", "x1", "y1")}
    return b.join(frame, "vec_id").withColumns(at).select("episode_id", "frame_idx", "box", F.expr(_NAME).alias("name"), *at)


def sided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hands(spark, sf_dir).filter("present").withColumn("side", F.expr(_SIDES))


_INSIDE = [f"coalesce(x{t} between bx0 and bx1 and y{t} between by0 and by1, false)" for t in g.TIPS]
_NEARBY = [f"coalesce(sqrt(greatest(bx0 - x{t}, 0, x{t} - bx1) ** 2 + greatest(by0 - y{t}, 0, y{t} - by1) ** 2) <= 25 / 224.0::double, false)" for t in g.TIPS]
_ADD = " + ".join
_FLAT = lambda i, j: f"sqrt((x{i} - x{j}) ** 2 + (y{i} - y{j}) ** 2)"
_RATIOS = f"{_FLAT(4, 8)} / greatest({_FLAT(9, 0)}, 0.04) as ri, {_FLAT(4, 12)} / greatest({_FLAT(9, 0)}, 0.04) as rm"
_W = "(partition by episode_id, side, box, usable order by frame_idx"
_BITS = lambda flags: " || ".join(f"case when {f} then '1' else '0' end" for f in flags)

CONTACTS = f"""{HANDS}, {BOXES}, ob as (select vec_id, box, {_NAME} as name, case when vec_id % 11 <> 0 then x0 - 0.05 end as bx0, case when vec_id % 11 <> 0 then y0 - 0.05 end as by0, case when vec_id % 11 <> 0 then x1 + 0.05 end as bx1, case when vec_id % 11 <> 0 then y1 + 0.05 end as by1 from boxes where box = 0 or vec_id % 5 <> 0),
 tb as (select h.*, {_SIDES.replace("vec_id", "h.vec_id")} as side, {_RATIOS}, o.* exclude (vec_id) from hands h join ob o on o.vec_id = h.vec_id where present), {_DEPTH},
 us as (select *, bx0 is not null as boxed, bx0 is not null and not coalesce(regexp_matches(lower(name), 'person|human|arm|body|hand'), false) as usable, {_ADD(f"{f}::int" for f in _INSIDE)} as ins, {_ADD(f"{f}::int" for f in _NEARBY)} as close, {_BITS(_INSIDE)} as inbits, {_BITS(_NEARBY)} as nearbits from ds),
 ev as (select *, usable and depth >= 0.3 and ins >= case when count_if(usable) over (partition by vec_id) = 1 then 1 else 2 end as evidence from us),
 fl as (select *, case when count(*) over w3 = 3 and sum(evidence::int) over w3 = 3 then true when count(*) over w3 = 3 and sum(evidence::int) over w3 = 0 then false end as flip from ev window w3 as {_W} rows 2 preceding)),
 st as (select *, coalesce(last_value(flip ignore nulls) over {_W} rows unbounded preceding), false) and usable as held, ins * 10.0::double - sqrt(((bx0 + bx1) / 2 - x0) ** 2 + ((by0 + by1) / 2 - y0) ** 2) as score, (ins + 0.5::double * (close - ins)) / nullif(close, 0) as conf from fl),
 rk as (select *, row_number() over (partition by vec_id order by held desc, case when held then -score end, box) as ph, row_number() over (partition by vec_id order by (usable and close > 0) desc, case when usable then -conf end, box) as pn,
  row_number() over (partition by vec_id order by coalesce(length(name) > 0 and lower(name) not in ('person', 'hand', 'arm', 'unknown'), false) desc, box) as pf, bool_or(boxed) over (partition by vec_id) as any_box from st),
 pk as (select episode_id, frame_idx, side, vec_id, bool_or(any_box) as any_box, any_value(depth) as depth, any_value(ri) as ri, any_value(rm) as rm, bool_or(held) as held, max(case when ph = 1 and held then name end) as hn, max(case when ph = 1 and held then inbits end) as hb,
  max(case when pn = 1 and usable and close > 0 then conf end) as nc, max(case when pn = 1 and usable and close > 0 then name end) as nn, max(case when pn = 1 and usable and close > 0 then nearbits end) as nb, max(case when pf = 1 and length(name) > 0 and lower(name) not in ('person', 'hand', 'arm', 'unknown') then name end) as fn from rk group by 1, 2, 3, 4),
 kd as (select *, case when held then 'held' when nc * depth >= 0.3 then 'near' when not any_box and (ri < 0.42 or rm < 0.42) then 'pinch' end as kind from pk),
 rw as (select *, case kind when 'held' then depth when 'near' then nc * depth when 'pinch' then greatest(0.55, least(0.85, 1 - least(ri, rm))) * depth else 0 end as raw from kd)"""


@query(f"""with {CONTACTS} select episode_id, frame_idx, side, vec_id, kind, kind is not null as in_contact, case kind when 'held' then hn when 'near' then nn when 'pinch' then coalesce(fn, 'manipulated_object') end as object_name,
 case kind when 'held' then hb when 'near' then nb when 'pinch' then '1' || case when ri < 0.45 then '1' else '0' end || case when rm < 0.48 then '1' else '0' end || '00' else '00000' end as fingers,
 round(case when kind is null then 0 else avg(raw) over (partition by episode_id, side order by frame_idx rows 2 preceding) end, 6) as confidence from rw""")
def contact_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = contact.contact_states(sided(spark, sf_dir), sightings(spark, sf_dir), ["episode_id"], "frame_idx", object_id="box", carried=["vec_id"])
    bits = F.array_join(F.transform("fingers", lambda f: F.when(f, "1").otherwise("0")), "")
    return df.select("episode_id", "frame_idx", "side", "vec_id", "kind", "in_contact", "object_name", bits.alias("fingers"), F.round("confidence", 6).alias("confidence"))
