"""Geometry over landmarks, boxes, quaternions and joints as column expressions; all stay in generated code.

Points are given as triples of columns: `p("4")` is x4, y4, z4.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Vec = Sequence[Column]
TIPS = (4, 8, 12, 16, 20)
MIDDLES = (6, 10, 14, 18)
GRASP_ORDINAL = {"power_wrap": 0, "precision_pinch": 1, "hook": 2, "lateral_pinch": 3, "open": 4, "unknown": 5}
#: Opening bounds by grasp, as shares of the largest opening; fixed values.
GRASP_BOUNDS = {"precision_pinch": (0.00, 0.15), "power_wrap": (0.25, 0.75), "hook": (0.10, 0.40), "open": (0.75, 1.00), "unknown": (0.20, 0.80)}


def p(i: int | str) -> Vec:
    return [F.col(f"{a}{i}") for a in "xyz"]


def sub(a: Vec, b: Vec) -> Vec:
    return [u - v for u, v in zip(a, b, strict=True)]


def dot(a: Vec, b: Vec) -> Column:
    return sum((u * v for u, v in zip(a, b, strict=True)), F.lit(0.0))


def cross(a: Vec, b: Vec) -> Vec:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def norm(a: Vec) -> Column:
    return F.sqrt(dot(a, a))


def distance(i: int, j: int) -> Column:
    return norm(sub(p(i), p(j)))


def clip(x: Column, low: float | Column, high: float | Column) -> Column:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    return F.greatest(as_col(low), F.least(as_col(high), x))


def curled() -> Column:
    """Fingers whose tip is nearer to the wrist than their middle joint."""
    return sum((F.when(distance(t, 0) < distance(m, 0), 1).otherwise(0) for t, m in zip(TIPS[1:], MIDDLES, strict=True)), F.lit(0))


def grasp_type(pinch: Column, n: Column) -> Column:
    """From the thumb-index distance and the number of curled fingers."""
    return F.when(pinch < 0.05, "precision_pinch").when((n >= 3) & (pinch > 0.15), "power_wrap").when((n >= 2) & (pinch > 0.105), "hook").when(n == 0, "open").otherwise("unknown")


def openness() -> Column:
    return clip(((distance(4, 20) + distance(8, 20)) / 2 - 0.05) / 0.45, 0, 1)


def palm_normal() -> Vec:
    """Unit normal of wrist and finger bases 5 and 17, or the z axis."""
    c = cross(sub(p(5), p(0)), sub(p(17), p(0)))
    n = norm(c)
    return [F.when(n > 1e-6, v / n).otherwise(F.lit(float(k == 2))) for k, v in enumerate(c)]


def joint_angle(a: int, b: int, c: int) -> Column:
    """1 - 2 theta / pi for the bend at b; 1 for a part of no length."""
    u, v = sub(p(b), p(a)), sub(p(c), p(b))
    nu, nv = norm(u), norm(v)
    return F.when((nu < 1e-6) | (nv < 1e-6), 1.0).otherwise(1 - 2 * F.acos(clip(dot(u, v) / F.nullif(nu * nv, F.lit(0.0)), -1, 1)) / F.pi())


#: Joints of the five fingers from the wrist to the tip.
FINGERS = {"thumb": (0, 1, 2, 3, 4), "index": (0, 5, 6, 7, 8), "middle": (0, 9, 10, 11, 12), "ring": (0, 13, 14, 15, 16), "little": (0, 17, 18, 19, 20)}
#: The 15 bends: three of every finger, each about the middle one of three joints that follow one another.
BENDS = {f"{name}{k + 1}": chain[k : k + 3] for name, chain in FINGERS.items() for k in range(3)}


def hand_pose() -> list[Column]:
    return [joint_angle(*abc) for abc in BENDS.values()]


def grasp_ordinal(grasp: Column) -> Column:
    """The grasp's number; that of `unknown` for null and other names."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in GRASP_ORDINAL.items() for x in kv])[grasp], F.lit(GRASP_ORDINAL["unknown"]))


def proprio(present: Column, left_contact: Column, right_contact: Column, left_grasp: Column, right_grasp: Column) -> list[Column]:
    """Eight numbers: the wrist in half units (0 without a hand), openness (1 without a hand), contact and grasp of both sides."""
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    wrist = [F.when(present, c * 0.5).otherwise(0.0) for c in p(0)]
    return [*wrist, F.when(present, openness()).otherwise(1.0), flag(left_contact), flag(right_contact), grasp_ordinal(left_grasp).cast("double"), grasp_ordinal(right_grasp).cast("double")]


def rot6d(z: Vec) -> list[Column]:
    """First two columns of a rotation whose third axis is z: Gram-Schmidt with x, or y where z is near x."""
    use_y = F.abs(z[0]) >= 0.9
    ref = [F.when(use_y, 0.0).otherwise(1.0), F.when(use_y, 1.0).otherwise(0.0), F.lit(0.0)]
    d = dot(ref, z)
    x = [r - d * c for r, c in zip(ref, z, strict=True)]
    n = norm(x)
    x = [v / n for v in x]
    return [*x, *cross(z, x)]


def quaternion_of(m: Sequence[Vec]) -> list[Column]:
    """x, y, z, w of a rotation matrix by rows, by the largest of the four squares."""
    t = m[0][0] + m[1][1] + m[2][2]
    cases = []
    s = F.sqrt(F.greatest(t + 1, F.lit(1e-12))) * 2
    cases.append((t > 0, [(m[2][1] - m[1][2]) / s, (m[0][2] - m[2][0]) / s, (m[1][0] - m[0][1]) / s, s / 4]))
    sx = F.sqrt(F.greatest(1 + m[0][0] - m[1][1] - m[2][2], F.lit(1e-12))) * 2
    cases.append(((m[0][0] > m[1][1]) & (m[0][0] > m[2][2]), [sx / 4, (m[0][1] + m[1][0]) / sx, (m[0][2] + m[2][0]) / sx, (m[2][1] - m[1][2]) / sx]))
    sy = F.sqrt(F.greatest(1 + m[1][1] - m[0][0] - m[2][2], F.lit(1e-12))) * 2
    cases.append((m[1][1] > m[2][2], [(m[0][1] + m[1][0]) / sy, sy / 4, (m[1][2] + m[2][1]) / sy, (m[0][2] - m[2][0]) / sy]))
    sz = F.sqrt(F.greatest(1 + m[2][2] - m[0][0] - m[1][1], F.lit(1e-12))) * 2
    last = [(m[0][2] + m[2][0]) / sz, (m[1][2] + m[2][1]) / sz, sz / 4, (m[1][0] - m[0][1]) / sz]
    return [F.when(cases[0][0], cases[0][1][k]).when(cases[1][0], cases[1][1][k]).when(cases[2][0], cases[2][1][k]).otherwise(last[k]) for k in range(4)]


def matrix_of(q: Sequence[Column]) -> list[list[Column]]:
    """Rows of the matrix of a unit quaternion."""
    x, y, z, w = q
    return [[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]]


def quaternion_product(a: Sequence[Column], b: Sequence[Column]) -> list[Column]:
    (ax, ay, az, aw), (bx, by, bz, bw) = a, b
    return [aw * bx + ax * bw + ay * bz - az * by, aw * by - ax * bz + ay * bw + az * bx, aw * bz + ax * by - ay * bx + az * bw, aw * bw - ax * bx - ay * by - az * bz]


def rotate(q: Sequence[Column], v: Vec) -> Vec:
    """v turned by the unit quaternion q: v + 2 w (u x v) + 2 u x (u x v)."""
    u, w = q[:3], q[3]
    c = cross(u, v)
    cc = cross(u, c)
    return [a + 2 * (w * b + d) for a, b, d in zip(v, c, cc, strict=True)]


def slerp(a: Sequence[Column], b: Sequence[Column], t: Column) -> list[Column]:
    """From the unit quaternion a (t = 0) to b (t = 1) by the shorter way; a straight line where they are nearly the same turn."""
    d = dot(a, b)
    angle = F.acos(F.least(F.abs(d), F.lit(1.0)))
    s = F.sin(angle)
    line = s < 1e-6
    wa = F.when(line, 1 - t).otherwise(F.sin((1 - t) * angle) / F.nullif(s, F.lit(0.0)))
    wb = F.when(line, t).otherwise(F.sin(t * angle) / F.nullif(s, F.lit(0.0))) * F.when(d < 0, -1.0).otherwise(1.0)
    out = [wa * u + wb * v for u, v in zip(a, b, strict=True)]
    n = norm(out)
    return [c / n for c in out]


def unit(q: Sequence[Column], least: float = 1e-9, otherwise: Sequence[float] = (0.0, 0.0, 0.0, 1.0)) -> list[Column]:
    """The vector at length 1, `otherwise` where it has next to no length."""
    n = norm(q)
    return [F.when(n > least, c / F.nullif(n, F.lit(0.0))).otherwise(F.lit(o)) for c, o in zip(q, otherwise, strict=True)]


def conjugate(q: Sequence[Column]) -> list[Column]:
    return [-q[0], -q[1], -q[2], q[3]]


def facing(q: Sequence[Column]) -> list[Column]:
    """Of the two quaternions of a turn the one whose largest component is positive; so half turns have a sign too."""
    most = F.greatest(*(F.abs(c) for c in q))
    sign = F.lit(1.0)
    for c in q:
        sign = F.when(F.abs(c) == most, F.when(c < 0, -1.0).otherwise(1.0)).otherwise(sign)
    return [c * sign for c in q]


def rotation_vector(q: Sequence[Column], shortest: bool = True) -> list[Column]:
    """Axis times angle of a unit quaternion; `shortest`: of the two turns the one of at most half a turn."""
    sign = F.when((q[3] < 0) & F.lit(shortest), -1.0).otherwise(1.0)
    v, w = [c * sign for c in q[:3]], q[3] * sign
    n = norm(v)
    scale = F.when(n > 1e-9, 2 * F.atan2(n, w) / F.nullif(n, F.lit(0.0))).otherwise(2.0)
    return [c * scale for c in v]


def turn_by(v: Vec) -> list[Column]:
    """The unit quaternion that turns about the vector by its length."""
    n = norm(v)
    scale = F.when(n > 1e-9, F.sin(n / 2) / F.nullif(n, F.lit(0.0))).otherwise(0.5)
    q = [*(c * scale for c in v), F.cos(n / 2)]
    length = norm(q)
    return [c / length for c in q]


def blend_with_rest(q: Sequence[Column], share: Column) -> list[Column]:
    """The rotation nearest to (1 - share) I + share R, R the turn of the unit quaternion q.

    That sum leaves R's axis as it is; across it, it is a stretch and a turn by the
    angle of (1 - share) + share e^(i a), a being R's angle.
    """
    sign = F.when(q[3] < 0, -1.0).otherwise(1.0)
    v, w = [c * sign for c in q[:3]], q[3] * sign
    n = norm(v)
    angle = 2 * F.atan2(n, w)
    half = F.atan2(share * F.sin(angle), (1 - share) + share * F.cos(angle)) / 2
    return [*(F.when(n > 1e-12, c / F.nullif(n, F.lit(0.0)) * F.sin(half)).otherwise(0.0) for c in v), F.cos(half)]


def quaternion_of_six(r: Sequence[Column]) -> list[Column]:
    """The turn whose matrix has the six numbers as its first two columns and their cross product as the third; none where that is no frame."""
    a, b = list(r[:3]), list(r[3:])
    c = cross(a, b)
    ok = dot(c, c) > 1e-6  # the determinant of such a matrix
    return [F.when(ok, x).otherwise(F.lit(o)) for x, o in zip(unit(quaternion_of([[a[i], b[i], c[i]] for i in range(3)])), (0.0, 0.0, 0.0, 1.0), strict=True)]


def box_distance(x: Column, y: Column, box: Sequence[Column]) -> Column:
    """Distance of a point to a box, 0 inside."""
    dx, dy = F.greatest(box[0] - x, F.lit(0.0), x - box[2]), F.greatest(box[1] - y, F.lit(0.0), y - box[3])
    return F.sqrt(dx * dx + dy * dy)


def location_words(x: Column, y: Column, low: float = 0.33, high: float = 0.66, rows: Sequence[str] = ("top", "middle", "bottom")) -> Column:
    pick = lambda v, names: F.when(v < low, names[0]).when(v < high, names[1]).otherwise(names[2])
    return F.concat_ws(" ", pick(y, rows), pick(x, ("left", "center", "right")))


def depth_score(z: Sequence[Column]) -> Column:
    """1 if depths agree by their median absolute deviation, else less, at least 0.2."""
    mid = F.element_at(F.array_sort(F.array(*z)), len(z) // 2 + 1)
    dev = [F.abs(v - mid) for v in z]
    mad = F.element_at(F.array_sort(F.array(*dev)), len(z) // 2 + 1)
    limit, most = 2.0 * 1.4826 * mad, F.greatest(*dev)
    return F.when((mad < 1e-6) | (most <= limit), 1.0).otherwise(F.greatest(F.lit(0.2), limit / F.nullif(most, F.lit(0.0))))


def finger_curl(tip: int, palm: Column) -> Column:
    return clip((1.95 - distance(tip, 0) / palm) / 1.05, 0, 1)


def opposition(pinch: Column) -> Column:
    return clip((1.6 - pinch) / 1.1, 0.2, 1)


def smoothstep(t: Column) -> Column:
    return t * t * (3 - 2 * t)


def quintic(t: Column) -> Column:
    return t * t * t * (10 + t * (-15 + 6 * t))


def gripper_opening(pinch: Column, grasp: Column, confidence: Column, most: float = 0.04, least_confidence: float = 0.6) -> Column:
    """Smoothstep of the pinch distance within the grasp's bounds; the whole range for low confidence."""
    low, high = F.lit(GRASP_BOUNDS["unknown"][0]), F.lit(GRASP_BOUNDS["unknown"][1])
    for name, (a, b) in GRASP_BOUNDS.items():
        low, high = F.when(grasp == name, a).otherwise(low), F.when(grasp == name, b).otherwise(high)
    sure = confidence >= least_confidence
    low, high = F.when(sure, low * most).otherwise(0.0), F.when(sure, high * most).otherwise(most)
    return low + smoothstep(clip((pinch - 0.01) / 0.08, 0, 1)) * (high - low)


def back_project(u: Column, v: Column, z: Column, fx: float, fy: float, cx: float, cy: float) -> list[Column]:
    """Camera point of a pixel with depth z; null unless z is finite and positive."""
    ok = (z > 0) & (z < float("inf"))
    return [F.when(ok, (u - cx) * z / fx), F.when(ok, (v - cy) * z / fy), F.when(ok, z)]


def outside(value: Column, low: Column, high: Column, slack: float = 0.005) -> Column:
    """How far a value lies outside its limits, null inside."""
    return F.when(value < low - slack, low - value).when(value > high + slack, value - high)


def segment_label(state: Column, transition: Column, grasp: Column) -> Column:
    """A name for a segment without a model's label."""
    return F.when(state == "no_contact", F.when(transition == "idle", "idle").when(transition == "contact_on", "approach").otherwise("retreat")).otherwise(
        F.when(transition == "contact_off", "release").when(grasp == "open", "contact").when(grasp.isin("precision_pinch", "power_wrap"), "grasp").otherwise("manipulate")
    )


def instruction(segment: Column, name: Column, hand: Column) -> Column:
    known = F.when(name.isNull() | (name == "unknown"), "an unidentified object").otherwise(name)
    return F.when(segment == "idle", "idle (no object)").otherwise(F.concat(segment, F.lit(" "), known, F.lit(" with "), hand, F.lit(" hand")))
