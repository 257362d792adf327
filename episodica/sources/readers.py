"""Readers: nested and flat episode documents, stored datasets, ground truth, joint tables, media.

All readers are plain Spark sources with explicit schemas; nothing opens a path itself,
so any store that Spark reads will do.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TRUTH_COLUMNS = ["video_id", "frame_idx", "timestamp_sec", "object_name", "hand", "contact_true", "grasp_type_true", "notes"]
TRUTH_SCHEMA = "video_id string, frame_idx int, timestamp_sec double, object_name string, hand string, contact_true int, grasp_type_true string, notes string"
_HAND = "struct<x:array<float>,y:array<float>,z:array<float>,confidence:double,handedness:string,is_interpolated:boolean>"
_OBJECT = "struct<name:string,location_description:string,touched:boolean,bbox:array<float>,state:string,position_3d:array<double>,mask_rle:struct<size:array<int>,counts:string>>"
_ACTION = "struct<wrist_delta:array<float>,finger_angles:array<float>,gripper_openness:double,hand_orientation:array<float>>"
EPISODE_SCHEMA = f"""episode_id string, video_path string, task_description string, num_frames int, duration_seconds double, target_robot string, camera_motion_flag boolean, camera_motion_px_per_sec double, physics_verified boolean, physics_report_path string,
 frames array<struct<frame_idx:int,timestamp:double,image_path:string,left_contact:string,right_contact:string,left_contact_object:string,right_contact_object:string,left_grasp:string,right_grasp:string,left_hand:{_HAND},right_hand:{_HAND},objects:array<{_OBJECT}>,action:{_ACTION},
  frame_description:string,action_segment:string,robot_joint_angles:array<double>,robot_gripper_opening_m:double,robot_gripper_method:string,robot_reachable:boolean,language_instruction:string,metadata:map<string,string>>>,
 segments array<struct<name:string,start_time:double,end_time:double,object_name:string,hand_used:string,hands:array<string>,description:string>>"""
#: What documents leave out; fixed values.
EPISODE_DEFAULTS = {"target_robot": "humanoid_generic", "camera_motion_flag": False, "camera_motion_px_per_sec": 0.0, "physics_verified": False}
FRAME_DEFAULTS = {"image_path": "", "frame_description": "", "action_segment": "idle"}
CONTACT_CONFIDENCE, HAND_CONFIDENCE, GRASP_CONFIDENCE, CURLED = 0.5, 0.8, 0.7, 2
FLAT_SCHEMA = "frame_idx int, timestamp double, image_path string, left_hand_present boolean, right_hand_present boolean, left_hand_keypoints array<float>, right_hand_keypoints array<float>, left_contact boolean, right_contact boolean, left_grasp_type string, right_grasp_type string, action_gripper_openness double"


def truthy(value: Column) -> Column:
    """Old documents write true or 1 where new ones write an object with in_contact."""
    inner = F.get_json_object(value, "$.in_contact")
    return F.lower(F.coalesce(inner, value)).isin("true", "1")


def or_else(defaults: dict) -> dict[str, Column]:
    return {c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()}


def contact_of(value: Column, name: Column) -> Column:
    """fingers, object_name, confidence of a contact in its new form (an object) or its old one (true or false, its name beside it); null without."""
    new = F.from_json(value, "fingers array<boolean>, object_name string, confidence double")
    none = F.array(*[F.lit(False)] * 5)
    made = lambda f, o, c: F.struct(f.alias("fingers"), o.alias("object_name"), c.alias("confidence"))
    return F.when(F.startswith(value, F.lit("{")), made(F.coalesce(new["fingers"], none), new["object_name"], F.coalesce(new["confidence"], F.lit(CONTACT_CONFIDENCE)))).when(value.isNotNull(), made(none, name, F.lit(CONTACT_CONFIDENCE)))


def grasp_of(value: Column) -> Column:
    """confidence, thumb_index_distance, num_curled_fingers of a grasp in its new form (an object) or its old one (its name); null without."""
    new = F.from_json(value, "confidence double, thumb_index_distance double, num_curled_fingers int")
    made = lambda *cols: F.struct(*(c.alias(n) for c, n in zip(cols, ("confidence", "thumb_index_distance", "num_curled_fingers"), strict=True)))
    return F.when(F.startswith(value, F.lit("{")), made(*(new[c] for c in ("confidence", "thumb_index_distance", "num_curled_fingers")))).when(value.isNotNull(), made(F.lit(1.0), F.lit(0.0), F.lit(0)))


def read_episodes(spark: SparkSession, path: str, lines: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """episodes, frames, segments of nested episode documents. Missing parts give no rows, missing fields their defaults; old forms of contact and grasp are read. A frame's contact and grasp are its plain columns, what else is known of them is in <side>_contact_detail and <side>_grasp_detail. A file is one document, or with `lines` one a line, as `write_documents` writes them."""
    doc = spark.read.schema(EPISODE_SCHEMA).json(path, multiLine=not lines).withColumns(or_else(EPISODE_DEFAULTS))
    frames = doc.select("episode_id", F.explode("frames").alias("f")).select("episode_id", "f.*").withColumns(or_else(FRAME_DEFAULTS))
    objects = F.transform("objects", lambda o: o.withField("state", F.coalesce(o["state"], F.lit("idle"))))
    nothing = frames.schema["objects"].dataType.simpleString()
    frames = frames.withColumns({"objects": F.coalesce(objects, F.array().cast(nothing)), "metadata": F.coalesce("metadata", F.create_map().cast("map<string,string>"))})
    for side in ("left", "right"):
        contact, grasp, hand = F.col(f"{side}_contact"), F.col(f"{side}_grasp"), F.col(f"{side}_hand")
        frames = frames.withColumns({f"{side}_contact_detail": contact_of(contact, F.col(f"{side}_contact_object")), f"{side}_grasp_detail": grasp_of(grasp)})
        frames = frames.withColumns({
            f"{side}_contact": F.coalesce(truthy(contact), F.lit(False)), f"{side}_grasp": F.coalesce(F.get_json_object(grasp, "$.type"), grasp),
            f"{side}_hand": F.when(hand.isNotNull(), hand.withField("is_interpolated", F.coalesce(hand["is_interpolated"], F.lit(False)))),
        }).drop(f"{side}_contact_object")
    segments = doc.select("episode_id", F.explode("segments").alias("s")).select("episode_id", "s.*")
    hands = F.when(F.size("hands") > 0, F.col("hands")).when(F.col("hand_used") == "both", F.array(F.lit("left"), F.lit("right"))).otherwise(F.array(F.coalesce("hand_used", F.lit("right"))))
    return doc.drop("frames", "segments"), frames, segments.withColumn("hands", hands)


def axis_of(points: Column, axis: int) -> Column:
    """Every third value of a flat list of points."""
    return F.filter(points, lambda _, i: i % 3 == axis)


def is_flat(spark: SparkSession, path: str) -> bool:
    """Whether a document under the path is of flat frames: those name their keypoints."""
    return not spark.read.text(path, wholetext=True).filter(F.contains("value", F.lit('"left_hand_keypoints"'))).isEmpty()


def read_flat_frames(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Flat frame documents (a file is one, a list of frames, or with `lines` a frame a line); keypoint lists become 21 x, y, z arrays, null without a hand; flags that are missing become false.

    Such documents say nothing of a hand's confidence or of its grasp's, which get fixed
    values; <side>_grasp is null without a hand or a type, and its distance is that of the
    tips of thumb and index finger.
    """
    df = spark.read.schema(FLAT_SCHEMA).json(path, multiLine=not lines).withColumn("image_path", F.coalesce("image_path", F.lit("")))
    for side in ("left", "right"):
        kp = F.col(f"{side}_hand_keypoints")
        df = df.withColumn(f"{side}_hand_present", F.coalesce(f"{side}_hand_present", F.lit(False)))
        hand = F.col(f"{side}_hand_present") & kp.isNotNull()
        df = df.withColumns({f"{side}_{axis}": F.when(hand, axis_of(kp, a)) for a, axis in enumerate("xyz")})
        apart = F.sqrt(sum(((F.get(f"{side}_{a}", F.lit(4)).cast("double") - F.get(f"{side}_{a}", F.lit(8)).cast("double")) ** 2 for a in "xyz"), F.lit(0.0)))
        kind = F.col(f"{side}_grasp_type")
        grasp = F.struct(kind.alias("type"), F.lit(GRASP_CONFIDENCE).alias("confidence"), apart.alias("thumb_index_distance"), F.lit(CURLED).alias("num_curled_fingers"))
        df = df.withColumns({f"{side}_confidence": F.when(hand, HAND_CONFIDENCE), f"{side}_is_interpolated": F.when(hand, False), f"{side}_grasp": F.when(hand & kind.isNotNull(), grasp)})
    return df


def read_truth(spark: SparkSession, path: str, video_id: str | None = None) -> DataFrame:
    """Ground truth with its eight columns; a file without them is refused."""
    found = spark.read.option("header", True).csv(path).columns
    missing = [c for c in TRUTH_COLUMNS if c not in found]
    if missing:
        raise ValueError(f"ground truth lacks {missing}")
    df = spark.read.option("header", True).schema(", ".join(f"{c} string" for c in found)).csv(path)
    kinds = dict(x.strip().split() for x in TRUTH_SCHEMA.split(","))
    df = df.select(*(F.col(c).try_cast(kinds[c]).alias(c) for c in TRUTH_COLUMNS))
    return df.filter(F.col("video_id") == video_id) if video_id is not None else df


def read_training(spark: SparkSession, path: str) -> DataFrame:
    """Frame tables of stored datasets under a path, with the file each row is from."""
    return spark.read.option("recursiveFileLookup", True).parquet(path).withColumn("source_file", F.col("_metadata.file_path"))


def sampled_frames(frames: DataFrame, order: str, fps: float, target_fps: float) -> DataFrame:
    """Every max(1, round(fps / target))-th frame."""
    return frames.filter(F.col(order) % max(1, round((fps or 30.0) / target_fps)) == 0)


def read_joint_table(spark: SparkSession, path: str) -> DataFrame:
    """All joints of robot descriptions in XML: robot, index (their order), joint, kind, parent, child, lower, upper, velocity. Joints without a type, as transmissions name them, are left out."""
    doc = spark.read.text(path, wholetext=True)
    blocks = F.regexp_extract_all("value", F.lit(r"(?s)(<joint\b[^>]*/>|<joint\b[^>]*>.*?</joint>)"), 1)
    typed = F.filter(blocks, lambda j: j.rlike(r'^<joint\b[^>]*\btype="'))
    df = doc.select(F.regexp_extract("value", r'<robot[^>]*\bname="([^"]*)"', 1).alias("robot"), F.posexplode(typed).alias("index", "j"))
    of = lambda tag, a: F.regexp_extract("j", rf'(?s)<{tag}\b[^>]*\b{a}="([^"]*)"', 1)
    return df.select("robot", "index", of("joint", "name").alias("joint"), of("joint", "type").alias("kind"), *(F.nullif(of(t, "link"), F.lit("")).alias(t) for t in ("parent", "child")), *(of("limit", a).try_cast("double").alias(a) for a in ("lower", "upper", "velocity")))


def read_joints(spark: SparkSession, path: str) -> DataFrame:
    """Joint limits of robot descriptions in XML: robot, joint, lower, upper, velocity."""
    return read_joint_table(spark, path).filter(F.col("kind").isin("revolute", "prismatic")).select("robot", "joint", "lower", "upper", "velocity")


def read_media(spark: SparkSession, path: str, decode, schema: str) -> DataFrame:
    """Binary files through a decoder: bytes to a list of row dictionaries. The decoder is loaded once per worker and runs on Arrow batches."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [dict(r, path=p) for p, content in zip(pdf["path"], pdf["content"], strict=True) for r in decode(content)]
            if rows:
                yield pd.DataFrame(rows)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, schema)
