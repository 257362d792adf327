"""Queries of maps from hands to embodiments, of calibration, and of retargeting results; some vectors shift the camera."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import embodiment as em
from ..functions import geometry as g
from ..operators import joins, stats
from .adapters import FEATURES, FRAMES, HANDS, features, frames, hands, table
from .dataset import NAMES
from .registry import query
from .shapes import _d
from .signals import KEYS, ORDER, _W


def _six(df: DataFrame, *ids: str, names: list[str]) -> DataFrame:
    return df.select(*ids, *(F.round(c, 6).alias(c) for c in names))


def _clip(x: str, low: float, high: float) -> str:
    return f"greatest({low}, least({high}, {x}))"


_PALM = f"greatest({_d(9, 0)}, 0.04)"
_CURL = {f: _clip(f"(1.95 - {_d(t, 0)} / {_PALM}) / 1.05", 0, 1) for f, t in zip(("thumb", "index", "middle", "ring"), g.TIPS, strict=False)}
_JOINTS = {f"{f}{j}": f"{gain} * {_CURL[f]}" for f in em.FINGERS for j, gain in enumerate(em.FINGER_GAINS)} | {"thumb0": f"{em.THUMB_OPPOSITION} * {_clip(f'(1.6 - {_d(4, 8)}) / 1.1', 0.2, 1)}"} | {f"thumb{j + 1}": f"{gain} * {_CURL['thumb']}" for j, gain in enumerate(em.THUMB_GAINS)}


@query(f"with {HANDS} select vec_id, {', '.join(f'round({_clip(x, -0.2, 1.6)}, 6) as {n}' for n, x in _JOINTS.items())} from hands where present")
def finger_joints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen joint angles of a hand from its curls."""
    palm = F.greatest(g.distance(9, 0), F.lit(0.04))
    curls = {f: g.finger_curl(t, palm) for f, t in zip(("thumb", "index", "middle", "ring"), g.TIPS, strict=False)}
    joints = em.finger_joints(curls, curls["thumb"], g.opposition(g.distance(4, 8)))
    df = hands(spark, sf_dir).filter("present").select("vec_id", *(c.alias(n) for n, c in joints.items()))
    return _six(df, "vec_id", names=list(joints))


_OPENED, _CLOSED = (0.0, 0.1, 0.0), (1.2, 1.4, 1.9)


@query(f"with {FRAMES}, s as (select *, {_clip('value / 77', 0, 1)} as s from frames) select episode_id, frame_idx, {', '.join(f'round({_clip(f'{a} + s * ({b} - {a})', -0.2, 1.6)}, 6) as q{k}' for k, (a, b) in enumerate(zip(_OPENED, _CLOSED, strict=True)))}, round(0.9 * s, 6) as follow from s")
def closing_joints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hand that one number closes."""
    joints = em.closing_joints(F.col("value") / 77, _OPENED, _CLOSED)
    return frames(spark, sf_dir).select(*KEYS, ORDER, *(F.round(c, 6).alias(n) for c, n in zip(joints, ("q0", "q1", "q2", "follow"), strict=True)))


@query(f"""with {HANDS}, c as (select *, x0 - (vec_id % 10) / 100.0::double as wx, y0 - (vec_id % 6) / 200.0::double as wy, vec_id % 5 < 2 as held from hands), m as (select episode_id, quantile_cont(wx, 0.5) as mx, quantile_cont(wy, 0.5) as my, quantile_cont(z0, 0.5) as mz from c where present group by 1),
 d as (select c.*, wx - mx as dx, wy - my as dy, z0 - mz as dz from c join m using (episode_id)), p as (select *, 0.5 + {_clip('-dz * 0.45 - dy * 0.18', -0.14, 0.16)} as px, {_clip('-dx * 0.45', -0.22, 0.22)} as py, 0.2 + {_clip('-dy * 0.38', -0.06, 0.18)} as pz, atan2(y17 - y5, x17 - x5) * 0.35 / 2 as half from d)
select vec_id, round(case when present then px else 0.5 end, 6) as wx, round(case when present then py else 0 end, 6) + 0 as wy, round(case when present then case when held then greatest(0.04, pz - 0.03) else greatest(0.07, pz) end else 0.2 end, 6) as wz, round(case when present then cos(half) else 1 end, 6) as wqx, round(case when present then sin(half) else 0 end, 6) as wqy from p""")
def wrist_over_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrists over a table, without the camera's motion, lowered while they hold something, turned with the palm."""
    df = hands(spark, sf_dir).withColumns({"shift_x": F.col("vec_id") % 10 / 100, "shift_y": F.col("vec_id") % 6 / 200})
    df = em.wrist_over_table(df, KEYS, F.col("present"), F.col("vec_id") % 5 < 2)
    return _six(df, "vec_id", names=["wx", "wy", "wz", "wqx", "wqy"]).withColumn("wy", F.col("wy") + 0.0)  # no negative zero


@query(f"with {HANDS}, m as (select episode_id, quantile_cont(x0, 0.5) as mx, quantile_cont(y0, 0.5) as my, quantile_cont(z0, 0.5) as mz from hands where present group by 1) select vec_id, " + ", ".join(f"round({a} + {_clip(f'({c}0 - m{c}) * {gain}', -most, most)}, 6) as {kind}_{c}" for kind, (gain, most) in em.ANCHOR_MOTION.items() for c, a in zip("xyz", (0.4, 0.0, 0.3), strict=True)) + " from hands join m using (episode_id)")
def anchored_motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrists about an anchor on three axes, for humanoids and arms."""
    df = hands(spark, sf_dir, (0,))
    for kind in em.ANCHOR_MOTION:
        names = [f"{kind}_{c}" for c in "xyz"]
        df = em.about_anchor(df.withColumns({n: F.col(f"{c}0") for n, c in zip(names, "xyz", strict=True)}), KEYS, names, F.col("present"), (0.4, 0.0, 0.3), kind)
    return _six(df, "vec_id", names=[f"{kind}_{c}" for kind in em.ANCHOR_MOTION for c in "xyz"])


@query(f"""with {HANDS}, l as (select *, {_d(9, 0)} as palm from hands), s as (select episode_id, 0.09 / coalesce(avg(case when present and palm > 1e-4 then palm end), 0.1) as scale from l group by 1),
 p as (select l.*, scale, case when present and lag(present) over {_W.replace("episode_id", "l.episode_id", 1)} then {' + '.join(f"({a}0 - lag({a}0) over {_W.replace('episode_id', 'l.episode_id', 1)}) ** 2" for a in 'xyz')} end as sq from l join s on s.episode_id = l.episode_id)
select episode_id, round(first(scale), 6) as scale, {", ".join(f"round((max({a}0) filter (present) - min({a}0) filter (present)) * first(scale), 6) as travel_{a}0" for a in "xyz")}, round(coalesce(sum(sqrt(sq) * scale) filter (sqrt(sq) * scale < 0.08), 0), 5) as path_length from p group by episode_id""")
def calibrated_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale, range on three axes and path of the wrist in metres."""
    df = stats.calibrated_travel(hands(spark, sf_dir, (0, 9)), KEYS, ORDER, ["x0", "y0", "z0"], g.distance(9, 0), "present", cap=0.08)
    return df.select(*KEYS, *(F.round(c, 6).alias(c) for c in ("scale", "travel_x0", "travel_y0", "travel_z0")), F.round("path_length", 5).alias("path_length"))


@query(f"""with {FRAMES}, r as (select *, present and k % 4 <> 0 as ok, k % 6 = 0 as fb, k % 50 = 0 as co, case when k % 9 = 0 then 'nan'::double when k % 9 = 1 then null else value end as res from frames), m as (select episode_id, grasp, count(*) as n from r group by 1, 2), h as (select episode_id, string_agg(grasp || ':' || n, ',' order by grasp) as methods from m group by 1)
select episode_id, count(*) as frames, count_if(ok) as n_reachable, round(100.0::double * count_if(ok) / count(*), 6) as pct_reachable, count_if(fb) as n_fallback, count_if(co) as n_collision, round(avg(case when not isnan(res) then res end), 6) as mean_residual, round(avg(case when not fb or ok then k end), 6) as mean_solve_ms, first(methods) as methods from r join h using (episode_id) group by 1""")
def retarget_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    res = F.when(k % 9 == 0, F.lit(float("nan"))).when(k % 9 != 1, F.col("value"))
    df = frames(spark, sf_dir).withColumns({"ok": F.col("present") & (k % 4 != 0), "fb": k % 6 == 0, "co": k % 50 == 0, "res": res})
    df = stats.retarget_summary(df, KEYS, "ok", "fb", "co", "res", "k", "grasp")
    methods = F.array_join(F.transform(F.map_entries("methods"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",")
    return df.withColumns({"methods": methods, **{c: F.round(c, 6) for c in ("pct_reachable", "mean_residual", "mean_solve_ms")}})


@query("select o_custkey as owner, case max(case o_orderstatus when 'P' then 2 when 'O' then 1 else 0 end) when 2 then 2 when 1 then 2 else 0 end as exit_code from orders group by 1")
def partial_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exit codes where parts of a run are allowed to fail."""
    status = F.when(F.col("o_orderstatus") == "P", "failed").when(F.col("o_orderstatus") == "O", "degraded").otherwise("ok")
    return stats.exit_codes(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("owner"), status.alias("status")), ["owner"], allow_partial=True)


@query(f"with {FEATURES} select episode_id, frame_idx, {', '.join(f'round({n}, 3) as {n}' for n in NAMES)} from features")
def unnormalised_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features normalised and brought back."""
    f = features(spark, sf_dir)
    s = stats.feature_stats(f, NAMES)
    return stats.unnormalise(stats.normalise(f, s, NAMES), s, NAMES).select(*KEYS, ORDER, *(F.round(n, 3).alias(n) for n in NAMES))


_JOINT = "s_nationkey as robot, s_suppkey as joint, case s_suppkey % 5 when 0 then 'prismatic' when 4 then 'fixed' else 'revolute' end as kind, s_acctbal / 1000 as lower, s_acctbal / 500 + 0.04 as upper"
_KNOWN = "s_nationkey as robot, s_suppkey as joint, s_acctbal / 1000 + case when s_suppkey % 3 = 0 then 0.002 else 0 end as lower, s_acctbal / 500 + case when s_suppkey % 4 = 0 then 0.05 else 0.0395 end as upper"


@query(f"""with j as (select {_JOINT} from supplier), k as (select {_KNOWN} from supplier where s_suppkey % 7 <> 0), r as (select *, case when kind <> 'fixed' and (joint % 5 = 0 or joint % 10 = 1) then 'gripper' when kind = 'revolute' then 'arm' end as role from j),
 o as (select r.*, case when kind = 'prismatic' then 0.001 else 0.005 end as most, k.lower as kl, k.upper as ku from r left join k using (robot, joint))
select robot, coalesce(count_if(role = 'arm'), 0) as arm_joints, coalesce(count_if(role = 'gripper'), 0) as gripper_joints, round(coalesce(sum(upper) filter (role = 'gripper'), 0), 6) as opening, sum(coalesce((abs(lower - kl) > most)::int, 0) + coalesce((abs(upper - ku) > most)::int, 0))::bigint as warnings, round(sum((lower + upper) / 2) filter (role = 'arm'), 6) as rest_sum from o group by 1""")
def robot_joints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as joints of their nation's robot."""
    s = table(spark, sf_dir, "supplier")
    j = s.selectExpr(*_JOINT.split(", "))
    known = s.filter("s_suppkey % 7 <> 0").selectExpr(*_KNOWN.split(", "))
    roles = joins.joint_roles(j, (F.col("joint") % 5 == 0) | (F.col("joint") % 10 == 1))
    rest = roles.groupBy("robot").agg(F.round(F.sum("rest"), 6).alias("rest_sum"))
    return joins.robots_of(roles, ["robot"], known).withColumn("opening", F.round("opening", 6)).join(rest, "robot")
