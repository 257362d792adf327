"""Views that shape the stored tables into episodes, landmarks, boxes and the like; each in Spark and as a SQL common table expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(c: Column | str, to: int) -> Column:
    """A double rounded as the SQL rounds: half away from zero after the scaling. Spark's own takes the shortest decimal text for the value, and so differs on halves."""
    return F.round((F.col(c) if isinstance(c, str) else c) * 10.0**to) / 10.0**to


#: Events that a task of `frames` takes, about, where Spark's own number of partitions, or of cores that it joins them for, would give it more.
TASK_EVENTS = 100_000


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as episodes, their events in time order as frames. The window is by episode_id itself, so that later ones by it need no shuffle; since they all sort in its partitions, these become more, not larger, with the events."""
    e = table(spark, sf_dir, "events").withColumnRenamed("user_id", "episode_id")
    tasks = e.count() // TASK_EVENTS
    # Spark joins its partitions to about one a core while they are small, so their configured number is no bound
    if tasks > min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism):
        e = e.select("episode_id", "ts", "event_id", "event_type", "value", "props").repartition(tasks, "episode_id")
    w = Window.partitionBy("episode_id").orderBy("ts", "event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    e = e.select("episode_id", (F.row_number().over(w) - 1).alias("frame_idx"), "event_type", "value", k.alias("k"), "event_id")
    contact = F.col("event_type").isin("click", "purchase")
    grasp = F.create_map(*[F.lit(x) for x in ("purchase", "power_wrap", "click", "precision_pinch", "view", "open", "signup", "hook", "error", "unknown")])
    present = F.col("event_type") != "error"
    return e.select(
        "episode_id", "frame_idx", (F.col("frame_idx") / 30.0).alias("t"), present.alias("present"), contact.alias("in_contact"),
        F.when(contact, F.concat(F.lit("obj_"), (F.col("k") % 5).cast("string"))).alias("object_name"), grasp[F.col("event_type")].alias("grasp"),
        F.when(present, F.col("value")).alias("signal"), "value", "k", "event_id",
    )


FRAMES = """frames as (
  select user_id as episode_id, cast(row_number() over (partition by user_id order by ts, event_id) - 1 as integer) as frame_idx,
    (row_number() over (partition by user_id order by ts, event_id) - 1) / 30.0::double as t,
    event_type <> 'error' as present, event_type in ('click', 'purchase') as in_contact,
    case when event_type in ('click', 'purchase') then 'obj_' || (cast(regexp_extract(props, '[0-9]+') as integer) % 5) end as object_name,
    case event_type when 'purchase' then 'power_wrap' when 'click' then 'precision_pinch' when 'view' then 'open' when 'signup' then 'hook' when 'error' then 'unknown' end as grasp,
    case when event_type <> 'error' then value end as signal, value, cast(regexp_extract(props, '[0-9]+') as integer) as k, event_id
  from events)"""


def landmark(i: int, axis: int) -> Column:
    return F.element_at("embedding", 3 * i + axis + 1).cast("double")


#: Landmarks of a hand: the wrist, then four from base to tip of each finger.
POINTS = tuple(range(21))
#: Vectors of an episode of hands; a bound on the rows that windows by episode sort together.
CLIP = 300


def hands(spark: SparkSession, sf_dir: str, points: tuple[int, ...] = POINTS) -> DataFrame:
    """Vectors as hands, neighbouring ids as an episode: the first 63 components are 21 points; scalar columns x4, y4, z4 ... keep expressions in generated code."""
    e = table(spark, sf_dir, "embeddings")
    episode = F.floor(F.col("vec_id") / CLIP)
    w = Window.partitionBy(episode).orderBy("vec_id")
    coords = [landmark(i, a).alias(f"{'xyz'[a]}{i}") for i in points for a in range(3)]
    return e.select(episode.alias("episode_id"), (F.row_number().over(w) - 1).alias("frame_idx"), "vec_id", (F.col("vec_id") % 7 != 0).alias("present"), *coords)


HANDS = """hands as (
  select vec_id // {1} as episode_id, cast(row_number() over (partition by vec_id // {1} order by vec_id) - 1 as integer) as frame_idx, vec_id, vec_id % 7 <> 0 as present, {0}
  from embeddings)""".format(", ".join(f"embedding[{3 * i + a + 1}]::double as {'xyz'[a]}{i}" for i in POINTS for a in range(3)), CLIP)  # noqa: UP030


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two boxes of every vector with a score."""
    e = table(spark, sf_dir, "embeddings")

    def box(b: int) -> list[Column]:
        at = [F.element_at("embedding", 4 * b + i + 1).cast("double") for i in range(4)]
        return [F.lit(b).alias("box"), F.least(at[0], at[1]).alias("x0"), F.least(at[2], at[3]).alias("y0"), F.greatest(at[0], at[1]).alias("x1"), F.greatest(at[2], at[3]).alias("y1"), F.element_at("embedding", 9 + b).cast("double").alias("score")]

    both = e.select("vec_id", "label", F.explode(F.array(F.struct(*box(0)), F.struct(*box(1)))).alias("b"))
    return both.select("vec_id", "label", "b.*")


BOXES = "boxes as (" + " union all ".join(
    f"select vec_id, label, {b} as box, least(embedding[{4 * b + 1}], embedding[{4 * b + 2}])::double as x0, least(embedding[{4 * b + 3}], embedding[{4 * b + 4}])::double as y0, "
    f"greatest(embedding[{4 * b + 1}], embedding[{4 * b + 2}])::double as x1, greatest(embedding[{4 * b + 3}], embedding[{4 * b + 4}])::double as y1, embedding[{9 + b}]::double as score from embeddings"
    for b in (0, 1)
) + ")"


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as feature rows of an episode."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("episode_id"), F.col("l_linenumber").alias("frame_idx"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))


FEATURES = "features as (select l_orderkey as episode_id, l_linenumber as frame_idx, l_quantity as quantity, l_extendedprice as price, l_discount as discount, l_tax as tax from lineitem)"


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as stored episodes with their number of frames, task and robot."""
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("length"))
    return table(spark, sf_dir, "orders").join(n, "o_orderkey").select(F.col("o_orderkey").alias("episode_id"), "length", F.col("o_orderpriority").alias("task"), F.col("o_orderstatus").alias("robot"))


EPISODES = "episodes as (select o_orderkey as episode_id, length, o_orderpriority as task, o_orderstatus as robot from orders join (select l_orderkey, count(*) as length from lineitem group by 1) on l_orderkey = o_orderkey)"
