"""Queries that write episodes as nested and as flat documents, old and new forms mixed, and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import readers
from ..sources.shared import shared_folder
from .adapters import FRAMES, HANDS, frames, hands, rounded
from .registry import query

_BITS = "array_join(transform(right_contact_detail.fingers, f -> case when f then '1' else '0' end), '')"


@query(f"""with {FRAMES} select episode_id::varchar as episode_id, frame_idx, in_contact as contact, object_name, case when k % 3 <> 0 and k % 3 <> 2 then round(value / 128, 6) else 0.5::double end as confidence, case when k % 3 = 0 then '00000' else '11' || case when k % 2 = 0 then '1' else '0' end || '00' end as fingers,
 grasp, case when k % 2 = 0 then 1.0::double else 0.9::double end as grasp_confidence, case when k % 2 = 0 then 0 else k % 5 end as curled, case when k % 4 = 0 then 'reach' else 'idle' end as action_segment, 'humanoid_generic' as target_robot from frames""")
def episode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document per episode: every third contact and every second grasp in the old form, defaults for what is left out."""
    k = F.col("k")
    names = ["frame_idx", F.col("t").alias("timestamp"), F.when(k % 4 == 0, "reach").alias("action_segment")]
    fingers = F.array(F.lit(True), F.lit(True), k % 2 == 0, F.lit(False), F.lit(False))
    contact = {True: [F.col("in_contact").alias("right_contact"), F.col("object_name").alias("right_contact_object")], False: [F.struct("in_contact", "object_name", fingers.alias("fingers"), F.when(k % 3 == 1, F.col("value") / 128).alias("confidence")).alias("right_contact")]}
    grasp = {True: F.col("grasp").alias("right_grasp"), False: F.struct(F.col("grasp").alias("type"), F.lit(0.9).alias("confidence"), F.lit(0.1).alias("thumb_index_distance"), (k % 5).alias("num_curled_fingers")).alias("right_grasp")}
    text = lambda old, plain: F.to_json(F.struct(*names, *contact[old], grasp[plain]))
    body = F.when((k % 3 == 0) & (k % 2 == 0), text(True, True)).when(k % 3 == 0, text(True, False)).when(k % 2 == 0, text(False, True)).otherwise(text(False, False))
    docs = frames(spark, sf_dir).groupBy("episode_id").agg(F.array_sort(F.collect_list(F.struct("frame_idx", body.alias("j")))).alias("f"))
    path = shared_folder(spark, "documents")
    docs.select(F.concat(F.lit('{"episode_id":"'), F.col("episode_id").cast("string"), F.lit('","frames":['), F.array_join(F.transform("f", lambda x: x["j"]), ","), F.lit("]}"))).write.text(path)
    episodes, read, _ = readers.read_episodes(spark, path, lines=True)
    grip, touch = F.col("right_grasp_detail"), F.col("right_contact_detail")
    read = read.select(
        "episode_id", "frame_idx", F.col("right_contact").alias("contact"), touch["object_name"].alias("object_name"), rounded(touch["confidence"], 6).alias("confidence"), F.expr(_BITS).alias("fingers"), F.col("right_grasp").alias("grasp"),
        grip["confidence"].alias("grasp_confidence"), grip["num_curled_fingers"].alias("curled"), "action_segment",
    )
    return read.join(episodes.select("episode_id", "target_robot"), "episode_id")


@query(f"""with {HANDS} select vec_id, present, case when present then round(x4, 6) end as thumb_x, case when present then round(z20, 6) end as tip_z, case when present then 0.8::double end as confidence, case when present and vec_id % 3 <> 0 then 'hook' end as grasp, case when present and vec_id % 3 <> 0 then 2 end as curled,
 case when present and vec_id % 3 <> 0 then round(sqrt((x4 - x8) ** 2 + (y4 - y8) ** 2 + (z4 - z8) ** 2), 6) end as distance from hands""")
def flat_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hands as flat frames, whose keypoints are one list of 63 numbers."""
    h = hands(spark, sf_dir)
    kp = F.array(*(F.col(f"{a}{i}").cast("float") for i in range(21) for a in "xyz"))
    path = shared_folder(spark, "flat")
    h.select(F.to_json(F.struct(F.col("vec_id").cast("int").alias("frame_idx"), F.col("present").alias("left_hand_present"), kp.alias("left_hand_keypoints"), F.when(F.col("vec_id") % 3 != 0, "hook").alias("left_grasp_type")))).write.text(path)
    df = readers.read_flat_frames(spark, path, lines=True)
    at = lambda axis, i: rounded(F.get(f"left_{axis}", F.lit(i)).cast("double"), 6)
    g = F.col("left_grasp")
    return df.select(F.col("frame_idx").cast("long").alias("vec_id"), F.col("left_hand_present").alias("present"), at("x", 4).alias("thumb_x"), at("z", 20).alias("tip_z"), F.col("left_confidence").alias("confidence"), g["type"].alias("grasp"), g["num_curled_fingers"].alias("curled"), rounded(g["thumb_index_distance"], 6).alias("distance"))
