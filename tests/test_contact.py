"""Contact decisions: hands placed by hand among boxes."""

import pytest

from episodica.operators import contact

COLUMNS = ", ".join(f"{a}{i} double" for i in range(21) for a in "xyz")
AWAY = (0.9, 0.9)


def hand(tips, wrist=(0.5, 0.5), middle=(0.5, 0.3)):
    """A flat hand: tips by finger, the others far from everything."""
    points = [(0.7, 0.7)] * 21
    points[0], points[9] = wrist, middle
    for place, at in zip((4, 8, 12, 16, 20), tips, strict=True):
        points[place] = at
    return [v for x, y in points for v in (x, y, 0.0)]


def decided(spark, hands, objects):
    h = spark.createDataFrame([("e", i, "right", *p) for i, p in enumerate(hands)], f"episode_id string, frame_idx int, side string, {COLUMNS}")
    rows = [("e", i, o, name, *(box or (None,) * 4)) for i, frame in enumerate(objects) for o, name, box in frame]
    o = spark.createDataFrame(rows, "episode_id string, frame_idx int, object_id int, name string, x0 double, y0 double, x1 double, y1 double")
    return contact.contact_states(h, o, ["episode_id"], "frame_idx").orderBy("frame_idx").collect()


ONE, TWO, NONE = [(0.1, 0.1), *[AWAY] * 4], [(0.1, 0.1), (0.12, 0.1), *[AWAY] * 3], [AWAY] * 5
CUP, BOX = (1, "cup", (0.05, 0.05, 0.2, 0.2)), (2, "box", (0.3, 0.05, 0.4, 0.2))


def test_one_tip_is_enough_for_an_only_object_and_lasts_until_three_frames_without(spark):
    got = decided(spark, [hand(t) for t in [ONE] * 3 + [NONE] * 4], [[CUP]] * 7)
    assert [r["kind"] for r in got] == ["near", "near", "held", "held", "held", None, None]
    assert [r["object_name"] for r in got[:5]] == ["cup"] * 5
    assert got[2]["fingers"] == [True, False, False, False, False] and got[4]["fingers"] == [False] * 5
    assert got[4]["confidence"] == pytest.approx(1.0) and got[5]["confidence"] == 0.0


def test_among_several_objects_two_tips_are_needed(spark):
    got = decided(spark, [hand(ONE)] * 4, [[CUP, BOX]] * 4)
    assert [r["kind"] for r in got] == ["near"] * 4  # one tip never holds, but it is near
    got = decided(spark, [hand(TWO)] * 3, [[CUP, BOX]] * 3)
    assert [r["kind"] for r in got] == ["near", "near", "held"] and got[2]["object_name"] == "cup"


def test_of_several_held_objects_the_one_nearer_to_the_wrist_wins(spark):
    near_cup, near_tray = hand(TWO, wrist=(0.13, 0.13)), hand(TWO, wrist=(0.3, 0.3))
    tray = (3, "tray", (0.05, 0.05, 0.5, 0.5))
    assert decided(spark, [near_cup] * 3, [[tray, CUP]] * 3)[2]["object_name"] == "cup"
    assert decided(spark, [near_tray] * 3, [[tray, CUP]] * 3)[2]["object_name"] == "tray"


def test_near_takes_the_highest_share_of_tips_inside(spark):
    edge = [(0.21, 0.1), (0.29, 0.1), (0.31, 0.1), AWAY, AWAY]  # by the cup's edge, by the box's, in the box
    got = decided(spark, [hand(edge)], [[CUP, BOX]])
    assert (got[0]["kind"], got[0]["object_name"]) == ("near", "box")
    assert got[0]["fingers"] == [True, True, True, False, False]
    assert got[0]["confidence"] == pytest.approx((1 + 0.5 * 2) / 3)


@pytest.mark.parametrize(
    ("objects", "kind", "name"),
    [
        ([], "pinch", "manipulated_object"),
        ([(1, "Hand", None), (2, "knife", None), (3, "fork", None)], "pinch", "knife"),
        ([(1, "unknown", None), (2, "", None), (3, None, None)], "pinch", "manipulated_object"),
        ([(1, "left arm", (0.6, 0.0, 0.7, 0.1))], None, None),
        ([(1, "plate", (0.6, 0.0, 0.7, 0.1))], None, None),
    ],
)
def test_a_pinch_counts_only_where_nothing_has_a_box(spark, objects, kind, name):
    got = decided(spark, [hand([(0.2, 0.3), (0.25, 0.3), AWAY, AWAY, AWAY])], [objects])[0]
    assert (got["kind"], got["object_name"], got["in_contact"]) == (kind, name, kind is not None)
    assert got["confidence"] == pytest.approx(0.75 if kind else 0.0)
    assert got["fingers"] == [kind is not None] * 2 + [False] * 3


def test_a_body_part_neither_is_touched_nor_counts_among_the_objects(spark):
    got = decided(spark, [hand(ONE)] * 3, [[(1, "Human arm", (0.0, 0.0, 1.0, 1.0)), CUP]] * 3)
    assert got[2]["kind"] == "held" and got[2]["object_name"] == "cup"
