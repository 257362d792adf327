"""Episode documents with all their fields and without them, flat frames, joint tables."""

import json

import pytest
from pyspark.sql import functions as F

from episodica.operators import joins
from episodica.sources import readers, writers


def test_what_documents_leave_out_has_a_default(spark, tmp_path):
    doc = {"episode_id": "a", "frames": [{"frame_idx": 0, "right_contact": False, "right_contact_object": "cup", "right_grasp": "open"}, {"frame_idx": 1, "left_contact": {"in_contact": True, "object_name": "pan", "fingers": [True, False, False, False, True]}}]}
    (tmp_path / "a.json").write_text(json.dumps(doc, indent=2))
    episodes, frames, segments = readers.read_episodes(spark, str(tmp_path / "a.json"))
    e, (f, g) = episodes.first(), frames.orderBy("frame_idx").collect()
    assert (e["target_robot"], e["camera_motion_flag"], e["camera_motion_px_per_sec"], e["physics_verified"], e["physics_report_path"]) == ("humanoid_generic", False, 0.0, False, None)
    assert (f["image_path"], f["frame_description"], f["action_segment"], f["objects"], f["metadata"], f["robot_reachable"], f["left_hand"]) == ("", "", "idle", [], {}, None, None)
    assert f["right_contact"] is False and tuple(f["right_contact_detail"]) == ([False] * 5, "cup", 0.5)
    assert f["right_grasp"] == "open" and tuple(f["right_grasp_detail"]) == (1.0, 0.0, 0)
    assert f["left_contact"] is False and f["left_contact_detail"] is None and f["left_grasp_detail"] is None
    assert g["left_contact"] is True and tuple(g["left_contact_detail"]) == ([True, False, False, False, True], "pan", 0.5)
    assert segments.count() == 0


def test_all_fields_are_read(spark, tmp_path):
    hand = {"x": [0.5] * 21, "y": [0.25] * 21, "z": [0.0] * 21, "confidence": 0.75, "handedness": "Left"}
    thing = {"name": "mug", "location_description": "left", "touched": True, "bbox": [0.0, 0.25, 0.5, 1.0], "mask_rle": {"size": [2, 2], "counts": "abc"}}
    frame = {"frame_idx": 3, "timestamp": 0.1, "left_hand": hand, "objects": [thing, {**thing, "state": "moving"}], "action": {"wrist_delta": [0, 0, 1], "finger_angles": [0] * 15, "gripper_openness": 0.5},
             "robot_joint_angles": [0.5, 1.5], "robot_gripper_opening_m": 0.04, "robot_gripper_method": "ratio", "robot_reachable": True, "metadata": {"take": 3, "who": "x"}}
    lines = [json.dumps({"episode_id": e, "video_path": "v", "num_frames": 1, "duration_seconds": 1.5, "target_robot": "arm", "frames": [frame]}) for e in "ab"]
    (tmp_path / "all.json").write_text("\n".join(lines))
    episodes, frames, _ = readers.read_episodes(spark, str(tmp_path / "all.json"), lines=True)
    assert episodes.count() == 2 and {r["target_robot"] for r in episodes.collect()} == {"arm"}
    f = frames.filter("episode_id = 'b'").first()
    assert f["left_hand"]["x"] == [0.5] * 21 and f["left_hand"]["is_interpolated"] is False
    assert [o["state"] for o in f["objects"]] == ["idle", "moving"] and f["objects"][0]["bbox"] == [0.0, 0.25, 0.5, 1.0] and f["objects"][0]["mask_rle"]["counts"] == "abc"
    assert f["action"]["gripper_openness"] == 0.5 and f["robot_joint_angles"] == [0.5, 1.5] and f["robot_reachable"] is True and f["metadata"] == {"take": "3", "who": "x"}


def test_documents_that_were_written_are_read_line_by_line(spark, tmp_path):
    ep = spark.createDataFrame([("a", "x"), ("b", "y")], "episode_id string, task_description string").coalesce(1)
    fr = spark.createDataFrame([(e, i, 0.1 * i, i == 1) for e in "ab" for i in range(3)], "episode_id string, frame_idx int, timestamp double, left_contact boolean")
    sg = spark.createDataFrame([("a", 0.0, "grasp")], "episode_id string, start_time double, name string")
    writers.write_documents(writers.nested_documents(ep, fr, sg).coalesce(1), str(tmp_path / "d"))
    episodes, frames, segments = readers.read_episodes(spark, str(tmp_path / "d"), lines=True)
    assert episodes.count() == 2 and segments.count() == 1
    assert frames.filter("left_contact").select("episode_id", "frame_idx").orderBy("episode_id").collect() == [("a", 1), ("b", 1)]


def test_flat_frames(spark, tmp_path):
    points = [v for i in range(21) for v in (i / 8, 0.0, 0.0)]
    rows = [{"frame_idx": 0, "timestamp": 0.0, "left_hand_present": True, "left_hand_keypoints": points, "left_grasp_type": "hook"}, {"frame_idx": 1, "left_hand_present": False, "left_hand_keypoints": points, "left_grasp_type": "hook"},
            {"frame_idx": 2, "left_hand_present": True, "left_hand_keypoints": None, "left_grasp_type": "hook"}, {"frame_idx": 3, "left_hand_present": True, "left_hand_keypoints": points, "action_gripper_openness": 0.5}]
    (tmp_path / "flat.json").write_text(json.dumps(rows))
    (tmp_path / "nested.json").write_text(json.dumps({"episode_id": "a"}))
    assert readers.is_flat(spark, str(tmp_path / "flat.json")) and not readers.is_flat(spark, str(tmp_path / "nested.json"))
    a, b, c, d = readers.read_flat_frames(spark, str(tmp_path / "flat.json")).orderBy("frame_idx").collect()
    assert a["left_x"] == [i / 8 for i in range(21)] and a["left_confidence"] == 0.8 and a["left_is_interpolated"] is False
    assert tuple(a["left_grasp"]) == ("hook", 0.7, 0.5, 2) and a["right_x"] is None and a["image_path"] == ""
    assert [(r["left_x"], r["left_grasp"], r["left_confidence"]) for r in (b, c)] == [(None, None, None)] * 2
    assert d["left_grasp"] is None and d["left_confidence"] == 0.8 and d["action_gripper_openness"] == 0.5


XML = """<robot name="arm">
 <joint name="base" type="fixed"><parent link="w"/><child link="b"/></joint>
 <joint name="j1" type="revolute"><parent link="b"/><child link="l1"/><limit lower="-1.5" upper="2.5" velocity="2.1"/></joint>
 <joint type="prismatic" name="f1"><child link="t1"/><limit lower="0" upper="0.04"/></joint>
 <joint type="prismatic" name="rail"><limit lower="0" upper="1"/></joint>
 <joint name="spin" type="continuous"/>
 <joint name="f2" type="revolute"><limit lower="0" upper="0.5"/></joint>
 <transmission><joint name="j1"><hardwareInterface/></joint></transmission>
</robot>"""


def test_joints_by_role(spark, tmp_path):
    (tmp_path / "r.xml").write_text(XML)
    joints = readers.read_joint_table(spark, str(tmp_path / "r.xml"))
    assert [(r["index"], r["joint"], r["kind"], r["parent"], r["child"]) for r in joints.orderBy("index").collect()] == [(0, "base", "fixed", "w", "b"), (1, "j1", "revolute", "b", "l1"), (2, "f1", "prismatic", None, "t1"), (3, "rail", "prismatic", None, None), (4, "spin", "continuous", None, None), (5, "f2", "revolute", None, None)]
    roles = joins.joint_roles(joints, F.col("joint").isin("f1", "f2"))
    assert {r["joint"]: (r["role"], r["rest"]) for r in roles.collect()} == {"base": (None, None), "j1": ("arm", 0.5), "f1": ("gripper", None), "rail": (None, None), "spin": (None, None), "f2": ("gripper", None)}
    known = spark.createDataFrame([("arm", "j1", -1.504, 2.506), ("arm", "f1", 0.0005, 0.042), ("other", "f2", 9.0, 9.0)], "robot string, joint string, lower double, upper double")
    r = joins.robots_of(roles, ["robot"], known).first()
    assert (r["arm_joints"], r["gripper_joints"], r["opening"], r["warnings"]) == (1, 2, pytest.approx(0.54), 2)
