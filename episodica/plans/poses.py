"""Queries of positions and turns: vectors of a clip as poses, the wrist as position, four components as a quaternion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..operators import poses
from ..operators import timeseries as ts
from .adapters import FRAMES, HANDS, frames, hands, table
from .registry import query
from .shapes import _ROT
from .signals import _FROM, KEYS, ORDER, _UPTO, _W

TURN = ["qx", "qy", "qz", "qw"]


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hands with the wrist and a unit quaternion of four further components; `sure` rows are seen and not guessed."""
    h = hands(spark, sf_dir, (0, 1, 2))
    q = [F.col(c) for c in ("x1", "y1", "z1", "x2")]
    n = g.norm(q)
    return h.select(*KEYS, ORDER, "vec_id", "present", "x0", "y0", "z0", *((c / n).alias(t) for c, t in zip(q, TURN, strict=True)), (F.col("present") & (F.col("vec_id") % 11 != 0)).alias("sure"))


CLIPS = HANDS + """, clips as (select episode_id, frame_idx, vec_id, present, x0, y0, z0, x1 / n as qx, y1 / n as qy, z1 / n as qz, x2 / n as qw, present and vec_id % 11 <> 0 as sure
  from (select *, sqrt(x1 * x1 + y1 * y1 + z1 * z1 + x2 * x2) as n from hands))"""


def savgol_sql(source: str, columns: list[str], ok: str, name: str, least: int = 3) -> str:
    """Common table expressions that end in `name`: source with its columns fitted within runs of `ok`."""
    tables = ", ".join("[" + ", ".join("[" + ", ".join(repr(float(x)) for x in row) + "]" for row in ts.savgol_matrix(k)) + "]" for k in (5, 7, 9))
    lists = ", ".join(f"list({c} order by frame_idx) as l_{c}" for c in columns)
    fits = ", ".join(f"case when fok and fn >= {max(5, least)} then list_sum(list_transform(range(fk), lambda j: l_{c}[(fi - fp + j)::bigint] * [{tables}][(fk - 3) // 2][fp + 1][j + 1])) else {c} end as {c}" for c in columns)
    return f"""{name}_r as (select *, coalesce({ok}, false) as fok, sum((coalesce({ok}, false) <> was or was is null)::int) over {_UPTO} as run from (select *, lag(coalesce({ok}, false)) over {_W} as was from {source})),
 {name}_n as (select *, row_number() over (partition by episode_id, run order by frame_idx) as fi, count(*) over (partition by episode_id, run) as fn from {name}_r), {name}_l as (select episode_id, run, {lists} from {name}_r group by 1, 2),
 {name}_k as (select *, case when fn >= 9 then 9 when fn >= 7 then 7 else 5 end as fk from {name}_n join {name}_l using (episode_id, run)), {name}_p as (select *, case when fi <= fk // 2 then fi - 1 when fn - fi < fk // 2 then fk - 1 - (fn - fi) else fk // 2 end as fp from {name}_k),
 {name} as (select * exclude (fok, run, was, fi, fn, fk, fp, {", ".join("l_" + c for c in columns)}) replace ({fits}) from {name}_p)"""


def turns_sql(source: str, ok: str, name: str, least: int = 3, shortest: bool = True) -> str:
    """Common table expressions that end in `name`: source with its quaternions smoothed within runs of `ok`."""
    sign = "case when w < 0 then -1 else 1 end" if shortest else "1"
    return f"""{name}_a as (select *, sum((coalesce({ok}, false) <> was or was is null)::int) over {_UPTO} as part from (select *, lag(coalesce({ok}, false)) over {_W} as was from {source})),
 {name}_b as (select *, coalesce(qx * lag(qx) over s + qy * lag(qy) over s + qz * lag(qz) over s + qw * lag(qw) over s < 0, false)::int as flip, count(*) over (partition by episode_id, part) as size from {name}_a window s as (partition by episode_id, part order by frame_idx)),
 {name}_c as (select *, case when sum(flip) over (partition by episode_id, part order by frame_idx rows unbounded preceding) % 2 = 1 then -1 else 1 end as sg from {name}_b),
 {name}_d as (select *, qx * sg * {sign} as x, qy * sg * {sign} as y, qz * sg * {sign} as z, w * {sign} as cw from (select *, qw * sg as w from {name}_c)),
 {name}_e as (select *, sqrt(x * x + y * y + z * z) as vn from {name}_d), {name}_f as (select * exclude (was, part, flip, sg, x, y, z, w, cw, vn), x * (2 * atan2(vn, cw) / vn) as v0, y * (2 * atan2(vn, cw) / vn) as v1, z * (2 * atan2(vn, cw) / vn) as v2 from {name}_e),
 {savgol_sql(f"{name}_f", ["v0", "v1", "v2"], ok, f"{name}_g", least)},
 {name}_h as (select *, sqrt(v0 * v0 + v1 * v1 + v2 * v2) as vn from {name}_g),
 {name} as (select * exclude (v0, v1, v2, vn, size) replace ({", ".join(f"case when coalesce({ok}, false) and size >= {least} then {e} else {c} end as {c}" for c, e in zip(TURN, [*(f"v{k} * (sin(vn / 2) / vn)" for k in range(3)), "cos(vn / 2)"], strict=True))}) from {name}_h)"""


def _six(df: DataFrame, *ids: str, names: list[str]) -> DataFrame:
    return df.select(*ids, *(F.round(c, 6).alias(c) for c in names))


@query(f"with {FRAMES}, {savgol_sql('frames', ['value'], 'present', 's')} select episode_id, frame_idx, round(value, 6) as smooth from s")
def savgol_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ts.savgol_blocks(frames(spark, sf_dir), "value", "present", KEYS, ORDER)
    return df.select(*KEYS, ORDER, F.round("smooth", 6).alias("smooth"))


@query(f"with {CLIPS}, {turns_sql('clips', 'sure', 't')}, {turns_sql('clips', 'sure', 'u', shortest=False)} select t.vec_id, {', '.join(f'round(t.{c}, 6) as {c}, round(u.{c}, 6) as long_{c}' for c in TURN)} from t join u on t.vec_id = u.vec_id")
def quaternion_savgol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns smoothed within runs of sure rows, by vectors of at most half a turn and by vectors that run on."""
    df = clips(spark, sf_dir).withColumns({f"long_{c}": F.col(c) for c in TURN})
    df = poses.smooth_turns(df, TURN, F.col("sure"), KEYS, ORDER)
    df = poses.smooth_turns(df, [f"long_{c}" for c in TURN], F.col("sure"), KEYS, ORDER, shortest=False)
    return _six(df, "vec_id", names=[*TURN, *(f"long_{c}" for c in TURN)])


_AXES = ["x0", "y0", "z0"]


@query(f"with {CLIPS}, {savgol_sql('clips', _AXES, 'sure', 'a')}, {turns_sql('a', 'sure', 'b')}, {savgol_sql('b', _AXES, 'present', 'c', 5)}, {turns_sql('c', 'present', 'd', 5)} select vec_id, {', '.join(f'round({c}, 6) as {c}' for c in [*_AXES, *TURN])} from d")
def pose_two_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions and turns smoothed within sure runs, then within seen runs of five rows or more, guessed rows among them."""
    df = clips(spark, sf_dir)
    for flag, least in (("sure", 3), ("present", 5)):
        df = ts.savgol_runs(df, _AXES, F.col(flag), KEYS, ORDER, least=least)
        df = poses.smooth_turns(df, TURN, F.col(flag), KEYS, ORDER, least=least)
    return _six(df, "vec_id", names=[*_AXES, *TURN])


def _arc(a: str, b: str, s: str) -> str:
    """Columns ox..ow of the arc from a's quaternion to b's; needs d (their product) and th (the angle) in scope."""
    wa, wb = f"sin((1 - {s}) * th) / sin(th)", f"sin({s} * th) / sin(th) * case when d < 0 then -1 else 1 end"
    return ", ".join(f"case when {s} = 0 or {b}.{c} is null then {a}.{c} when {s} = 1 or {a}.{c} is null then {b}.{c} else {wa} * {a}.{c} + {wb} * {b}.{c} end as o{c}" for c in TURN)


#: A pace of at most 1.5 rad/s by nine tenths of it, for joints that do 2.61: the slow-down 2.61 / (0.9 * 1.5); fixed values.
SLOWER, THAN = 261, 135
_FACE = "case when abs(oqx) = m then sign(oqx) when abs(oqy) = m then sign(oqy) when abs(oqz) = m then sign(oqz) else sign(oqw) end"
_FACED = ", ".join(f"round(o{c} * ({_FACE}), 6) as {c}" for c in TURN)
_MOST = "greatest(abs(oqx), abs(oqy), abs(oqz), abs(oqw)) as m"


def _facing(df: DataFrame) -> DataFrame:
    return df.withColumns(dict(zip(TURN, g.facing([F.col(c) for c in TURN]), strict=True)))


@query(f"""with {CLIPS}, n as (select episode_id, count(*) as n, greatest(1, count(*) * {SLOWER} // {THAN}) as m from clips group by 1), gr as (select episode_id, n, m, unnest(range(m)) as i from n),
 g as (select *, case when m > 1 then i * (n - 1) // (m - 1) else 0 end as lo, case when m > 1 then (i * (n - 1) % (m - 1))::double / (m - 1) else 0 end as s from gr),
 p as (select g.episode_id, g.i, g.s, a as a, b as b, a.qx * b.qx + a.qy * b.qy + a.qz * b.qz + a.qw * b.qw as d from g join clips a on a.episode_id = g.episode_id and a.frame_idx = g.lo left join clips b on b.episode_id = g.episode_id and b.frame_idx = g.lo + (g.s > 0)::int),
 o as (select episode_id, i, {", ".join(f"a.{c} + (b.{c} - a.{c}) * s as {c}" for c in _AXES)}, case when s <= 0.5 then a.present else b.present end as present, a.vec_id as vec_id, {_arc("a", "b", "s")} from (select *, acos(least(abs(d), 1)) as th from p))
select episode_id, i, {", ".join(f"round({c}, 6) as {c}" for c in _AXES)}, present, vec_id, {_FACED} from (select *, {_MOST} from o)""")
def resample_pose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips slowed down: positions linear, turns along arcs, presence by the nearest row, labels by the row before."""
    grid, rows = poses.slowed_grid(clips(spark, sf_dir), KEYS, ORDER, SLOWER, THAN)
    df = poses.resample(grid, rows, KEYS, "tick", {**dict.fromkeys(_AXES, "linear"), "present": "nearest", "vec_id": "previous"}, [TURN])
    return _six(_facing(df), *KEYS, "i", "present", "vec_id", names=[*_AXES, *TURN])


@query(f"""with {CLIPS}, c as (select *, present and vec_id // 60 % 3 <> 1 as ok from clips), n as (select *, last_value(case when ok then frame_idx end ignore nulls) over {_UPTO} as pi, first_value(case when ok then frame_idx end ignore nulls) over {_FROM} as ni from c),
 r as (select *, least(45, ni - pi - 1) as ramp from n), e as (select *, greatest(0, (frame_idx - (ni - ramp) + 1)::double / (ramp + 1)) as tau from r), q as (select *, tau * tau * tau * (10 + tau * (-15 + 6 * tau)) as s from e),
 p as (select q.vec_id, q.ok, q.s, q.pi, q.ni, q as o, a as a, b as b, a.qx * b.qx + a.qy * b.qy + a.qz * b.qz + a.qw * b.qw as d from q left join c a on a.episode_id = q.episode_id and a.frame_idx = q.pi left join c b on b.episode_id = q.episode_id and b.frame_idx = q.ni),
 t as (select vec_id, not ok as bridged, {", ".join(f"case when ok then o.{c} when pi is null and ni is null then 0 when pi is null then b.{c} when ni is null then a.{c} else (1 - s) * a.{c} + s * b.{c} end as {c}" for c in _AXES)},
  case when ok then 0 when pi is null then 1 when ni is null then 0 else s end as s, case when pi is null then b else a end as a, case when ni is null then a else b end as b, d from p),
 u as (select vec_id, bridged, {", ".join(_AXES)}, {_arc("a", "b", "s")} from (select *, acos(least(abs(d), 1)) as th from t))
select vec_id, bridged, {", ".join(f"round({c}, 6) as {c}" for c in _AXES)}, {_FACED} from (select *, {_MOST} from u)""")
def bridge_pose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips with gaps of up to 60 rows, bridged by positions and turns; the ramp takes 45 rows at most."""
    ok = F.col("present") & (F.floor(F.col("vec_id") / 60) % 3 != 1)
    df = poses.bridge_poses(clips(spark, sf_dir), _AXES, TURN, ok, KEYS, ORDER)
    return _six(_facing(df), "vec_id", "bridged", names=[*_AXES, *TURN])


@query("""with e as (select vec_id, [embedding[i]::double for i in range(1, 5)] as r from embeddings), u as (select vec_id, [c / sqrt(list_sum([d * d for d in r])) for c in r] as q from e), f as (select vec_id, q, list_max([abs(c) for c in q]) as m from u),
 s as (select vec_id, q, case when abs(q[1]) = m then sign(q[1]) when abs(q[2]) = m then sign(q[2]) when abs(q[3]) = m then sign(q[3]) else sign(q[4]) end as s from f)
select vec_id, round(q[1] * s, 5) as x, round(q[2] * s, 5) as y, round(q[3] * s, 5) as z, round(q[4] * s, 5) as w from s""")
def palm_quaternion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rotation made from a unit quaternion and read back by its four cases, half turns among them."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", *(F.element_at("embedding", i + 1).cast("double").alias(f"c{i}") for i in range(4)))
    n = g.norm([F.col(f"c{i}") for i in range(4)])
    e = e.select("vec_id", *((F.col(f"c{i}") / n).alias(f"c{i}") for i in range(4)))
    e = e.select("vec_id", *(c.alias(t) for c, t in zip(g.quaternion_of(g.matrix_of([F.col(f"c{i}") for i in range(4)])), TURN, strict=True)))
    return _facing(e).select("vec_id", *(F.round(c, 5).alias(n) for c, n in zip(TURN, "xyzw", strict=True)))


_SHARE = "((vec_id % 9 + 1) / 10.0::double)"


@query(f"""with {CLIPS}, c as (select vec_id, {_SHARE} as share, {", ".join(f"{c} * case when qw < 0 then -1 else 1 end as {c}" for c in TURN)} from clips), a as (select *, sqrt(qx * qx + qy * qy + qz * qz) as n from c), h as (select *, 2 * atan2(n, qw) as angle from a),
 k as (select *, atan2(share * sin(angle), (1 - share) + share * cos(angle)) / 2 as half from h), o as (select vec_id, qx / n * sin(half) as oqx, qy / n * sin(half) as oqy, qz / n * sin(half) as oqz, cos(half) as oqw from k)
select vec_id, {_FACED}, {_FACED.replace(" as q", " as b")}, true as square from (select *, {_MOST} from o)""")
def nearest_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rotation nearest to a blend of a turn and rest: of the nine entries by an eigenvector, and of the turn by its angle; whether its matrix is orthogonal to nine digits."""
    share = (F.col("vec_id") % 9 + 1) / 10
    m = g.matrix_of([F.col(c) for c in TURN])
    df = clips(spark, sf_dir).select("vec_id", *TURN, *((F.lit(float(i == j)) * (1 - share) + share * m[i][j]).alias(f"m{i}{j}") for i in range(3) for j in range(3)))
    df = poses.nearest_rotation(df, [f"m{i}{j}" for i in range(3) for j in range(3)], [f"n{k}" for k in range(4)])
    by_angle = g.facing(g.blend_with_rest([F.col(c) for c in TURN], share))
    r = g.matrix_of([F.col(f"n{k}") for k in range(4)])
    off = F.greatest(*(F.abs(g.dot(r[i], r[j]) - float(i == j)) for i in range(3) for j in range(i, 3)))
    return df.select("vec_id", *(F.round(c, 6).alias(t) for c, t in zip(g.facing([F.col(f"n{k}") for k in range(4)]), TURN, strict=True)), *(F.round(c, 6).alias("b" + t[1]) for c, t in zip(by_angle, TURN, strict=True)), (off < 1e-9).alias("square"))


_CASES = {"x": ("a1 > b2 and a1 > c3", ["s / 4", "(b1 + a2) / s", "(c1 + a3) / s", "(b3 - c2) / s"], "1 + a1 - b2 - c3"), "y": ("b2 > c3", ["(b1 + a2) / s", "s / 4", "(c2 + b3) / s", "(c1 - a3) / s"], "1 + b2 - a1 - c3"), "z": ("true", ["(c1 + a3) / s", "(c2 + b3) / s", "s / 4", "(a2 - b1) / s"], "1 + c3 - a1 - b2")}


@query(f"""with {HANDS}, {_ROT}, f as (select vec_id, r0 as a1, r1 as a2, r2 as a3, r3 as b1, r4 as b2, r5 as b3, r1 * r5 - r2 * r4 as c1, r2 * r3 - r0 * r5 as c2, r0 * r4 - r1 * r3 as c3 from ro),
 t as (select *, case when a1 + b2 + c3 > 0 then 2 * sqrt(a1 + b2 + c3 + 1) {" ".join(f"when {w} then 2 * sqrt(greatest({r}, 1e-12))" for w, _, r in _CASES.values())} end as s from f),
 o as (select vec_id, {", ".join(f"case when a1 + b2 + c3 > 0 then {first} {' '.join(f'when {w} then {e[k]}' for w, e, _ in _CASES.values())} end as o{c}" for k, (c, first) in enumerate(zip(TURN, ["(b3 - c2) / s", "(c1 - a3) / s", "(a2 - b1) / s", "s / 4"], strict=True)))} from t)
select vec_id, {_FACED} from (select *, {_MOST} from o)""")
def six_to_quaternion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The palm's six numbers read back as a turn."""
    df = hands(spark, sf_dir)
    df = df.withColumns(dict(zip(("nx", "ny", "nz"), g.palm_normal(), strict=True)))
    df = df.select("vec_id", *(c.alias(f"r{k}") for k, c in enumerate(g.rot6d([F.col(c) for c in ("nx", "ny", "nz")]))))
    df = df.select("vec_id", *(c.alias(t) for c, t in zip(g.quaternion_of_six([F.col(f"r{k}") for k in range(6)]), TURN, strict=True)))
    return _six(_facing(df), "vec_id", names=TURN)


@query("""with q as (select vec_id, [embedding[i]::double for i in range(1, 5)] as a, [embedding[i]::double for i in range(5, 9)] as b from embeddings), u as (select vec_id, [c / sqrt(list_sum([d * d for d in a])) for c in a] as a, [c / sqrt(list_sum([d * d for d in b])) for c in b] as b from q)
select vec_id, round(a[4] * b[1] - a[1] * b[4] - a[2] * b[3] + a[3] * b[2], 6) as x, round(a[4] * b[2] + a[1] * b[3] - a[2] * b[4] - a[3] * b[1], 6) as y, round(a[4] * b[3] - a[1] * b[2] + a[2] * b[1] - a[3] * b[4], 6) as z, round(a[4] * b[4] + a[1] * b[1] + a[2] * b[2] + a[3] * b[3], 6) as w from u""")
def relative_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turn from one quaternion to another: the conjugate of the first times the second."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", *(F.element_at("embedding", i + 1).cast("double").alias(f"c{i}") for i in range(8)))
    a, b = (g.unit([F.col(f"c{i}") for i in range(at, at + 4)]) for at in (0, 4))
    return e.select("vec_id", *(F.round(c, 6).alias(n) for c, n in zip(g.quaternion_product(g.conjugate(a), b), "xyzw", strict=True)))
