"""Queries of the geometry functions over vectors as hands and boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..operators import joins
from .adapters import BOXES, FRAMES, HANDS, boxes, frames, hands, table
from .registry import query


def _d(i: int, j: int) -> str:
    return "sqrt(" + " + ".join(f"({a}{i} - {a}{j}) * ({a}{i} - {a}{j})" for a in "xyz") + ")"


_CURLED = " + ".join(f"case when {_d(t, 0)} < {_d(m, 0)} then 1 else 0 end" for t, m in zip(g.TIPS[1:], g.MIDDLES, strict=True))
_GRASP = f"case when {_d(4, 8)} < 0.05 then 'precision_pinch' when {_CURLED} >= 3 and {_d(4, 8)} > 0.15 then 'power_wrap' when {_CURLED} >= 2 and {_d(4, 8)} > 0.105 then 'hook' when {_CURLED} = 0 then 'open' else 'unknown' end"


def _r(df: DataFrame, *ids: str, **cols) -> DataFrame:
    return df.select(*ids, *(F.round(c, 6).alias(n) for n, c in cols.items()))


@query(f"with {HANDS} select vec_id, round({_d(4, 8)}, 6) as pinch, {_CURLED} as curled, {_GRASP} as grasp, 0.7::double as confidence from hands where present")
def grasp_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    pinch, n = g.distance(4, 8), g.curled()
    return hands(spark, sf_dir).filter("present").select("vec_id", F.round(pinch, 6).alias("pinch"), n.alias("curled"), g.grasp_type(pinch, n).alias("grasp"), F.lit(0.7).alias("confidence"))


@query(f"with {HANDS} select vec_id, round(greatest(0, least(1, (({_d(4, 20)} + {_d(8, 20)}) / 2 - 0.05) / 0.45)), 6) as openness from hands")
def openness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(hands(spark, sf_dir), "vec_id", openness=g.openness())


_NORMAL = """cr as (select *, (y5 - y0) * (z17 - z0) - (z5 - z0) * (y17 - y0) as cx, (z5 - z0) * (x17 - x0) - (x5 - x0) * (z17 - z0) as cy, (x5 - x0) * (y17 - y0) - (y5 - y0) * (x17 - x0) as cz from hands),
 nm as (select *, sqrt(cx * cx + cy * cy + cz * cz) as cn from cr), pn as (select *, case when cn > 1e-6 then cx / cn else 0 end as nx, case when cn > 1e-6 then cy / cn else 0 end as ny, case when cn > 1e-6 then cz / cn else 1 end as nz from nm)"""


@query(f"with {HANDS}, {_NORMAL} select vec_id, round(nx, 6) as nx, round(ny, 6) as ny, round(nz, 6) as nz, round(-(nx * x0 + ny * y0 + nz * z0), 6) as d from pn")
def palm_plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = hands(spark, sf_dir)
    df = df.withColumns(dict(zip(("nx", "ny", "nz"), g.palm_normal(), strict=True)))
    n = [F.col(c) for c in ("nx", "ny", "nz")]
    return _r(df, "vec_id", nx=n[0], ny=n[1], nz=n[2], d=-g.dot(n, g.p(0)))


_ROT = f"""{_NORMAL}, rf as (select *, case when abs(nx) >= 0.9 then 0 else 1 end as rx, case when abs(nx) >= 0.9 then 1 else 0 end as ry from pn), ax as (select *, rx - (rx * nx + ry * ny) * nx as ux, ry - (rx * nx + ry * ny) * ny as uy, -(rx * nx + ry * ny) * nz as uz from rf),
 un as (select *, ux / sqrt(ux * ux + uy * uy + uz * uz) as ax, uy / sqrt(ux * ux + uy * uy + uz * uz) as ay, uz / sqrt(ux * ux + uy * uy + uz * uz) as az from ax), ro as (select *, ax as r0, ay as r1, az as r2, ny * az - nz * ay as r3, nz * ax - nx * az as r4, nx * ay - ny * ax as r5 from un)"""


@query(f"with {HANDS}, {_ROT} select vec_id, {', '.join(f'round(r{k}, 6) as r{k}' for k in range(6))} from ro")
def rot6d(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = hands(spark, sf_dir)
    df = df.withColumns(dict(zip(("nx", "ny", "nz"), g.palm_normal(), strict=True)))
    return _r(df, "vec_id", **{f"r{k}": c for k, c in enumerate(g.rot6d([F.col(c) for c in ("nx", "ny", "nz")]))})


def _angle_sql(a: int, b: int, c: int) -> str:
    uv = " + ".join(f"({x}{b} - {x}{a}) * ({x}{c} - {x}{b})" for x in "xyz")
    return f"round(case when {_d(a, b)} < 1e-6 or {_d(b, c)} < 1e-6 then 1 else 1 - 2 * acos(greatest(-1, least(1, ({uv}) / ({_d(a, b)} * {_d(b, c)})))) / pi() end, 6)"


@query(f"with {HANDS} select vec_id, {', '.join(f'{_angle_sql(*abc)} as {n}' for n, abc in g.BENDS.items())} from hands")
def finger_angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(hands(spark, sf_dir), "vec_id", **dict(zip(g.BENDS, g.hand_pose(), strict=True)))


@query(f"with {HANDS} select vec_id, round(greatest({_d(9, 0)}, 0.04), 6) as palm, {', '.join(f'round(greatest(0, least(1, (1.95 - {_d(t, 0)} / greatest({_d(9, 0)}, 0.04)) / 1.05)), 6) as curl{t}' for t in g.TIPS)}, round(greatest(0.2, least(1, (1.6 - {_d(4, 8)}) / 1.1)), 6) as opposition from hands")
def finger_curls(spark: SparkSession, sf_dir: str) -> DataFrame:
    palm = F.greatest(g.distance(9, 0), F.lit(0.04))
    return _r(hands(spark, sf_dir), "vec_id", palm=palm, opposition=g.opposition(g.distance(4, 8)), **{f"curl{t}": g.finger_curl(t, palm) for t in g.TIPS})


def _touch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hands beside the first box of their vector."""
    b = boxes(spark, sf_dir).filter("box = 0").select("vec_id", *(F.col(c).alias(f"b{c}") for c in ("x0", "y0", "x1", "y1")), "score")
    return hands(spark, sf_dir).join(b, "vec_id")


_TOUCH = f"{HANDS}, {BOXES}, tb as (select h.*, b.x0 as bx0, b.y0 as by0, b.x1 as bx1, b.y1 as by1, b.score from hands h join boxes b on b.vec_id = h.vec_id and b.box = 0)"
_IN = [f"(x{t} between bx0 and bx1 and y{t} between by0 and by1)" for t in g.TIPS]
_DIST = [f"sqrt(greatest(bx0 - x{t}, 0, x{t} - bx1) ** 2 + greatest(by0 - y{t}, 0, y{t} - by1) ** 2)" for t in g.TIPS]
_MID = f"list_sort([{', '.join(f'z{t}' for t in g.TIPS)}])[3]"
_DEPTH = f"dp as (select *, {_MID} as zm from tb), dm as (select *, list_sort([{', '.join(f'abs(z{t} - zm)' for t in g.TIPS)}])[3] as mad, greatest({', '.join(f'abs(z{t} - zm)' for t in g.TIPS)}) as dev from dp), ds as (select *, case when mad < 1e-6 or dev <= 2.0 * 1.4826 * mad then 1 else greatest(0.2, 2.0 * 1.4826 * mad / dev) end as depth from dm)"


@query(f"with {_TOUCH}, {_DEPTH} select vec_id, round(depth, 6) as depth from ds")
def depth_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(_touch(spark, sf_dir), "vec_id", depth=g.depth_score([F.col(f"z{t}") for t in g.TIPS]))


@query(f"with {_TOUCH}, {_DEPTH}, i as (select *, {' + '.join(x + '::int' for x in _IN)} as inside, round(least({', '.join(_DIST)}), 6) as nearest from ds) select vec_id, inside, nearest, inside >= 2 and depth >= 0.3 as evidence, nearest < 22 / 224.0::double as near from i")
def fingertip_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = [F.col(f"b{c}") for c in ("x0", "y0", "x1", "y1")]
    at = [(F.col(f"x{t}"), F.col(f"y{t}")) for t in g.TIPS]
    inside = sum((F.when(x.between(box[0], box[2]) & y.between(box[1], box[3]), 1).otherwise(0) for x, y in at), F.lit(0))
    df = _touch(spark, sf_dir).withColumns({"inside": inside, "nearest": F.round(F.least(*(g.box_distance(x, y, box) for x, y in at)), 6), "depth": g.depth_score([F.col(f"z{t}") for t in g.TIPS])})
    return df.select("vec_id", "inside", "nearest", ((F.col("inside") >= 2) & (F.col("depth") >= 0.3)).alias("evidence"), (F.col("nearest") < 22 / 224).alias("near"))


_NEARS = " + ".join(f"({d} < 0.2)::int" for d in _DIST)


@query(f"with {_TOUCH}, {_DEPTH}, i as (select *, {' + '.join(x + '::int' for x in _IN)} as inside, {_NEARS} as close from ds), c as (select *, (inside + 0.5 * (close - inside)) / 5 as conf from i) select vec_id, round(conf, 6) as confidence, close > 0 and conf * depth >= 0.3 as contact from c")
def proximity_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = [F.col(f"b{c}") for c in ("x0", "y0", "x1", "y1")]
    at = [(F.col(f"x{t}"), F.col(f"y{t}")) for t in g.TIPS]
    inside = sum((F.when(x.between(box[0], box[2]) & y.between(box[1], box[3]), 1).otherwise(0) for x, y in at), F.lit(0))
    close = sum((F.when(g.box_distance(x, y, box) < 0.2, 1).otherwise(0) for x, y in at), F.lit(0))
    df = _touch(spark, sf_dir).withColumns({"inside": inside, "close": close, "depth": g.depth_score([F.col(f"z{t}") for t in g.TIPS])}).withColumn("conf", (F.col("inside") + 0.5 * (F.col("close") - F.col("inside"))) / 5)
    return df.select("vec_id", F.round("conf", 6).alias("confidence"), ((F.col("close") > 0) & (F.col("conf") * F.col("depth") >= 0.3)).alias("contact"))


@query(f"with {HANDS}, q as (select *, least({', '.join(_d(4, t) for t in g.TIPS[1:])}) / greatest({_d(9, 0)}, 0.04) as ratio from hands) select vec_id, round(ratio, 6) as ratio, ratio < 0.42 as pinch, round(greatest(0.55, least(0.85, 1 - ratio)), 6) as confidence from q")
def kinematic_pinch(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = hands(spark, sf_dir).withColumn("ratio", F.least(*(g.distance(4, t) for t in g.TIPS[1:])) / F.greatest(g.distance(9, 0), F.lit(0.04)))
    return df.select("vec_id", F.round("ratio", 6).alias("ratio"), (F.col("ratio") < 0.42).alias("pinch"), F.round(g.clip(1 - F.col("ratio"), 0.55, 0.85), 6).alias("confidence"))


_WORDS = "case when {1} < 0.33 then 'top' when {1} < 0.66 then 'middle' else 'bottom' end || ' ' || case when {0} < 0.33 then 'left' when {0} < 0.66 then 'center' else 'right' end"


@query(f"with {BOXES} select vec_id, box, {_WORDS.format('(x0 + x1) / 2 + 0.5', '(y0 + y1) / 2 + 0.5')} as location from boxes")
def bbox_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes(spark, sf_dir).select("vec_id", "box", g.location_words((F.col("x0") + F.col("x1")) / 2 + 0.5, (F.col("y0") + F.col("y1")) / 2 + 0.5).alias("location"))


_IOU = "greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0))"
_UNION = f"(a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) - {_IOU}"


@query(f"with {BOXES} select a.vec_id, round(case when {_UNION} > 0 then {_IOU} / ({_UNION}) else 0 end, 6) as iou from boxes a join boxes b on b.vec_id = a.vec_id and a.box = 0 and b.box = 1")
def iou_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir)
    other = b.filter("box = 1").select("vec_id", *(F.col(c).alias(f"o_{c}") for c in ("x0", "y0", "x1", "y1")))
    return _r(b.filter("box = 0").join(other, "vec_id"), "vec_id", iou=joins.overlap(joins.box_of(), joins.box_of("o_")))


@query(f"""with {BOXES}, d as (select *, vec_id // 20 as scene from boxes), m as (select a.vec_id, a.scene, -b.vec_id as nid, round(case when {_UNION} > 0 then {_IOU} / ({_UNION}) else 0 end, 9) as iou, case when {_UNION} > 0 then {_IOU} / ({_UNION}) else 0 end as raw from d a left join d b on b.scene = a.scene and b.box = 1 where a.box = 0)
select scene, vec_id, -(max(case when raw > 0.3 then [iou, nid] end)[2])::bigint as match, round(max(case when raw > 0.3 then [iou, nid] end)[1], 6) as iou from m group by 1, 2""")
def box_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir).withColumn("scene", F.floor(F.col("vec_id") / 20))
    found = joins.best_overlap(b.filter("box = 0").select("scene", "vec_id", "x0", "y0", "x1", "y1"), b.filter("box = 1").withColumnRenamed("vec_id", "rid"), ["scene"], "vec_id", "rid")
    return found.select("scene", "vec_id", "match", F.round("iou", 6).alias("iou"))


def _iou(a: str, b: str) -> str:
    inter = f"greatest(0, least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0)) * greatest(0, least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0))"
    union = f"(({a}.x1 - {a}.x0) * ({a}.y1 - {a}.y0) + ({b}.x1 - {b}.x0) * ({b}.y1 - {b}.y0) - {inter})"
    return f"case when {union} > 0 then {inter} / {union} else 0 end"


@query(f"""with recursive {BOXES}, o as (select vec_id // 20 as scene, {{'id': vec_id * 2 + box, 'score': score, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}} as b, row_number() over (partition by vec_id // 20 order by score desc, vec_id * 2 + box) as i from boxes),
 hit as (select a.scene, a.i, c.i as earlier from o a join o c on c.scene = a.scene and c.i < a.i where {_iou('a.b', 'c.b')} > 0.3::double), need as (select scene, i, list(earlier) as by from hit group by 1, 2),
 run as (select scene, i, [i] as kept from o where i = 1 union all select o.scene, o.i, case when list_has_any(r.kept, coalesce(n.by, [])) then r.kept else list_append(r.kept, o.i) end from run r join o on o.scene = r.scene and o.i = r.i + 1 left join need n on n.scene = o.scene and n.i = o.i),
 last as (select scene, unnest(kept) as i from run qualify row_number() over (partition by scene order by run.i desc) = 1)
select o.scene, o.b.id as box_id, o.b.score as score from last join o using (scene, i)""")
def nms(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir).withColumns({"scene": F.floor(F.col("vec_id") / 20), "box_id": F.col("vec_id") * 2 + F.col("box")})
    return joins.suppress(b, ["scene"], "box_id", most=0.3)


@query(f"with {FRAMES}, o as (select *, k / 1000.0::double as pinch, case when present then 0.9 else 0.5 end as conf from frames), b as (select *, case when conf < 0.6 then 0 else 0.04 * case grasp when 'precision_pinch' then 0 when 'power_wrap' then 0.25 when 'hook' then 0.1 when 'open' then 0.75 else 0.2 end end as lo, case when conf < 0.6 then 0.04 else 0.04 * case grasp when 'precision_pinch' then 0.15 when 'power_wrap' then 0.75 when 'hook' then 0.4 when 'open' then 1 else 0.8 end end as hi, greatest(0, least(1, (pinch - 0.01) / 0.08)) as s from o) select episode_id, frame_idx, round(lo + s * s * (3 - 2 * s) * (hi - lo), 6) as opening from b")
def gripper_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frames(spark, sf_dir)
    return _r(df, "episode_id", "frame_idx", opening=g.gripper_opening(F.col("k") / 1000.0, F.col("grasp"), F.when(F.col("present"), 0.9).otherwise(0.5)))


@query(f"""with {HANDS}, a as (select episode_id, quantile_cont(x0, 0.5) as ax, quantile_cont(y0, 0.5) as ay, quantile_cont(z0, 0.5) as az, greatest(0.15, least(1.2, 0.085 / greatest(quantile_cont({_d(9, 0)}, 0.5), 0.04))) as s from hands where present group by 1)
select h.vec_id, round(case when present then greatest(0.3, least(0.7, 0.5 - (z0 - az) * s)) else 0.5 end, 6) as wx, round(case when present then greatest(-0.3, least(0.3, -(x0 - ax) * s)) else 0 end, 6) as wy, round(case when present then greatest(0.2, least(0.6, 0.4 - (y0 - ay) * s)) else 0.4 end, 6) as wz from hands h join a using (episode_id)""")
def workspace_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrist moves about the episode's median, scaled by palm size, in robot axes and clipped to the workspace; its centre without a hand."""
    df = hands(spark, sf_dir)
    mid = df.filter("present").groupBy("episode_id").agg(*(F.percentile(f"{a}0", F.lit(0.5)).alias(f"a{a}") for a in "xyz"), g.clip(0.085 / F.greatest(F.percentile(g.distance(9, 0), F.lit(0.5)), F.lit(0.04)), 0.15, 1.2).alias("s"))
    df = df.join(F.broadcast(mid) if mid.limit(100_001).count() <= 100_000 else mid, "episode_id")
    at = {"wx": (0.5, "z", 0.3, 0.7), "wy": (0.0, "x", -0.3, 0.3), "wz": (0.4, "y", 0.2, 0.6)}
    return _r(df, "vec_id", **{n: F.when(F.col("present"), g.clip(c - (F.col(f"{a}0") - F.col(f"a{a}")) * F.col("s"), lo, hi)).otherwise(c) for n, (c, a, lo, hi) in at.items()})


@query(f"with {HANDS}, d as (select vec_id, x4, y4, z4, x8, y8, z8, sqrt((x4 - x8) ** 2 + (z4 - z8) ** 2) as xz, abs(y4 - y8) as gap, (y4 + y8) / 2 as mid from hands) select vec_id, round(case when xz < 0.22 and gap < 0.2 then mid + case when y4 >= y8 then 0.1 else -0.1 end else y4 end, 6) as left_y, round(case when xz < 0.22 and gap < 0.2 then mid - case when y4 >= y8 then 0.1 else -0.1 end else y8 end, 6) as right_y from d")
def bimanual_separation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two wrists that are close are pushed apart about their middle."""
    left, right, least = F.col("y4"), F.col("y8"), 0.2
    near = (F.sqrt((F.col("x4") - F.col("x8")) ** 2 + (F.col("z4") - F.col("z8")) ** 2) < 0.22) & (F.abs(left - right) < least)
    half = F.when(left >= right, least / 2).otherwise(-least / 2)
    return _r(hands(spark, sf_dir), "vec_id", left_y=F.when(near, (left + right) / 2 + half).otherwise(left), right_y=F.when(near, (left + right) / 2 - half).otherwise(right))


_JOINTS = "joints as (select r_regionkey as joint, -0.1 - 0.05 * r_regionkey as lo, 0.1 + 0.05 * r_regionkey as hi from region)"


@query(f"with {_JOINTS}, v as (select vec_id, j.joint, embedding[j.joint + 1]::double as q, lo::double as lo, hi::double as hi from embeddings, joints j) select vec_id, joint, round(case when q < lo - 0.005 then lo - q else q - hi end, 6) as off from v where q < lo - 0.005 or q > hi + 0.005")
def joint_limit_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joints outside their limits; the joint table is a dimension of a few rows."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(F.slice("embedding", 1, 5)).alias("joint", "q"))
    joints = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("joint"), (-0.1 - 0.05 * F.col("r_regionkey")).alias("lo"), (0.1 + 0.05 * F.col("r_regionkey")).alias("hi"))
    df = e.join(joints, "joint").withColumn("off", g.outside(F.col("q").cast("double"), F.col("lo"), F.col("hi"))).filter("off is not null")
    return _r(df, "vec_id", "joint", off="off")


@query(f"with {BOXES}, c as (select vec_id, box, abs(score) + 0.1 * abs(x1 - x0) + case when y0 < -0.2 then 1 else 0 end as cost from boxes) select vec_id, box, round(cost, 6) as cost from c qualify row_number() over (partition by vec_id order by cost, box) = 1")
def candidate_argmin(spark: SparkSession, sf_dir: str) -> DataFrame:
    cost = F.abs("score") + 0.1 * F.abs(F.col("x1") - F.col("x0")) + F.when(F.col("y0") < -0.2, 1).otherwise(0)
    best = boxes(spark, sf_dir).groupBy("vec_id").agg(F.min(F.struct(cost.alias("cost"), "box")).alias("m"))
    return best.select("vec_id", "m.box", F.round("m.cost", 6).alias("cost"))


@query("with e as (select vec_id, embedding[1]::double as u, embedding[2]::double as v, embedding[3]::double as z from embeddings) select vec_id, round(case when z > 0 then (u * 100 + 50 - 50) * z / 100 end, 6) as x, round(case when z > 0 then (v * 100 + 50 - 50) * z / 100 end, 6) as y, round(case when z > 0 then z end, 6) as z from e")
def back_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", *(F.element_at("embedding", i + 1).cast("double").alias(c) for i, c in enumerate("uvz")))
    x, y, z = g.back_project(F.col("u") * 100 + 50, F.col("v") * 100 + 50, F.col("z"), 100, 100, 50, 50)
    return _r(e, "vec_id", x=x, y=y, z=z)


@query("""with q as (select vec_id, [embedding[i]::double for i in range(1, 5)] as r, [embedding[i]::double for i in range(5, 8)] as v from embeddings), u as (select vec_id, v, [c / sqrt(list_sum([d * d for d in r])) for c in r] as r from q),
 c as (select *, r[2] * v[3] - r[3] * v[2] as cx, r[3] * v[1] - r[1] * v[3] as cy, r[1] * v[2] - r[2] * v[1] as cz from u)
select vec_id, round(v[1] + 2 * (r[4] * cx + r[2] * cz - r[3] * cy), 6) as x, round(v[2] + 2 * (r[4] * cy + r[3] * cx - r[1] * cz), 6) as y, round(v[3] + 2 * (r[4] * cz + r[1] * cy - r[2] * cx), 6) as z from c""")
def quaternion_rotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", *(F.element_at("embedding", i + 1).cast("double").alias(f"c{i}") for i in range(7)))
    n = F.sqrt(sum((F.col(f"c{i}") ** 2 for i in range(4)), F.lit(0.0)))
    x, y, z = g.rotate([F.col(f"c{i}") / n for i in range(4)], [F.col(f"c{i}") for i in range(4, 7)])
    return _r(e, "vec_id", x=x, y=y, z=z)


_LEFT = "case vec_id % 4 when 0 then 'hook' when 1 then 'open' when 2 then 'lateral_pinch' end"
_ORDINAL = "case {} when 'power_wrap' then 0 when 'precision_pinch' then 1 when 'hook' then 2 when 'lateral_pinch' then 3 when 'open' then 4 else 5 end"


@query(f"with {HANDS}, p as (select vec_id, present, {', '.join(f'case when present then {a}0 * 0.5 else 0 end as p{i}' for i, a in enumerate('xyz'))}, case when present then greatest(0, least(1, (({_d(4, 20)} + {_d(8, 20)}) / 2 - 0.05) / 0.45)) else 1 end as p3, {_LEFT} as lg, case when present then {_GRASP} end as rg from hands) select vec_id, {', '.join(f'round(p{i}, 6) as p{i}' for i in range(4))}, (vec_id % 3 = 0)::int::double as p4, (present and vec_id % 2 = 0)::int::double as p5, ({_ORDINAL.format('lg')})::double as p6, ({_ORDINAL.format('rg')})::double as p7 from p")
def proprio_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrist, openness, and contact and grasp of two sides; the left side's are made from the id."""
    k, present = F.col("vec_id") % 4, F.col("present")
    left = F.when(k == 0, "hook").when(k == 1, "open").when(k == 2, "lateral_pinch")
    right = F.when(present, g.grasp_type(g.distance(4, 8), g.curled()))
    row = g.proprio(present, F.col("vec_id") % 3 == 0, present & (F.col("vec_id") % 2 == 0), left, right)
    return _r(hands(spark, sf_dir), "vec_id", **{f"p{i}": c for i, c in enumerate(row)})


@query("""with e as (select vec_id, (vec_id % 11) / 10.0::double as t, [embedding[i]::double for i in range(1, 5)] as a, [embedding[i]::double for i in range(5, 9)] as b from embeddings), u as (select vec_id, t, [c / sqrt(list_sum([d * d for d in a])) for c in a] as a, [c / sqrt(list_sum([d * d for d in b])) for c in b] as b from e),
 k as (select *, list_dot_product(a, b) as d from u), h as (select *, acos(least(abs(d), 1)) as th from k), w as (select *, sin((1 - t) * th) / sin(th) as wa, sin(t * th) / sin(th) * case when d < 0 then -1 else 1 end as wb from h)
select vec_id, round(wa * a[1] + wb * b[1], 6) as x, round(wa * a[2] + wb * b[2], 6) as y, round(wa * a[3] + wb * b[3], 6) as z, round(wa * a[4] + wb * b[4], 6) as w from w""")
def quaternion_slerp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A share of the turn between two unit quaternions."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", *(F.element_at("embedding", i + 1).cast("double").alias(f"c{i}") for i in range(8)))
    sides = []
    for at in (0, 4):
        n = F.sqrt(sum((F.col(f"c{i}") ** 2 for i in range(at, at + 4)), F.lit(0.0)))
        sides.append([F.col(f"c{i}") / n for i in range(at, at + 4)])
    return _r(e, "vec_id", **dict(zip("xyzw", g.slerp(*sides, (F.col("vec_id") % 11) / 10), strict=True)))


@query(f"with {HANDS}, m as (select *, ({' + '.join(_d(t, 0) for t in g.TIPS[1:])}) / 4 / greatest({_d(9, 0)}, 0.04) as s from hands where present), q as (select episode_id, quantile_cont(s, 0.3) as lo, quantile_cont(s, 0.7) as hi from m group by 1) select m.vec_id, case when s > hi then 'open' when s < lo then 'power_wrap' else 'precision_pinch' end as label from m join q using (episode_id)")
def percentile_grasp(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = hands(spark, sf_dir).filter("present").withColumn("s", sum((g.distance(t, 0) for t in g.TIPS[1:]), F.lit(0.0)) / 4 / F.greatest(g.distance(9, 0), F.lit(0.04)))
    q = df.groupBy("episode_id").agg(F.percentile("s", F.lit(0.3)).alias("lo"), F.percentile("s", F.lit(0.7)).alias("hi"))
    return df.join(q, "episode_id").select("vec_id", F.when(F.col("s") > F.col("hi"), "open").when(F.col("s") < F.col("lo"), "power_wrap").otherwise("precision_pinch").alias("label"))


@query(f"with {HANDS}, t as (select vec_id, greatest(0, least(1, x0 + 0.5)) as t from hands) select vec_id, round(t * t * (3 - 2 * t), 6) as smoothstep, round(10 * t ** 3 - 15 * t ** 4 + 6 * t ** 5, 6) as quintic from t")
def eases(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = g.clip(F.col("x0") + 0.5, 0, 1)
    return _r(hands(spark, sf_dir), "vec_id", smoothstep=g.smoothstep(t), quintic=g.quintic(t))
