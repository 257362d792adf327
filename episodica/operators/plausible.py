"""What speaks against the contacts, objects, segments and captions of an episode, without ground truth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stats import share
from .windows import island, ordered

Keys = Sequence[str]
#: Words for body parts that aren't things to hold, and words before a thing; fixed values.
BODY_WORDS = ("person", "human", "arm", "body", "hand", "torso", "face", "head")
LEADS = ("the", "a", "an", "this")


def issues_of(**checks: Column) -> Column:
    """Names of the checks that are true, in their order."""
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in checks.items())))


def contact_findings(df: DataFrame, keys: Keys, order: str, contact: str, name: str, short: int = 3, nameless: float = 30.0) -> DataFrame:
    """Per key frames, runs of contact (events), their lengths, and issues: short events, one over all frames, most of one frame, and over `nameless` percent of contact without an object.

    A key without contact has no events and no issues; null contact counts as none. Runs
    and keys are folded where the window has put them, after one shuffle.
    """
    yes = F.coalesce(F.col(contact), F.lit(False))
    runs = island(df.withColumn("_yes", yes), F.col("_yes"), ordered(keys, order), "_run").groupBy(*keys, "_run").agg(F.first("_yes").alias("_on"), F.count("*").alias("_n"), F.count(name).alias("_named"))
    n, named = F.when(F.col("_on"), F.col("_n")), F.when(F.col("_on"), F.col("_named"))
    out = runs.groupBy(*keys).agg(
        F.sum("_n").alias("frames"), F.count_if("_on").alias("events"), F.count_if(n < short).alias("short_events"), F.count_if(n == 1).alias("single_events"),
        F.min(n).alias("shortest"), F.max(n).alias("longest"), F.avg(n).alias("mean"), share(F.sum(n) - F.sum(named), F.sum(n), 100.0).alias("nameless_pct"),
    )
    return out.withColumn("issues", issues_of(short=F.col("short_events") > 0, whole=F.col("longest") >= F.col("frames"), unstable=F.col("single_events") > 0.5 * F.col("events"), nameless=F.col("nameless_pct") > nameless))


def has_body_part(text: Column) -> Column:
    """Whether a text has a body part as a thing: the word right behind an article."""
    plain = F.translate(F.lower(text), ",.", "  ")
    return plain.rlike(rf"(^|\s)({'|'.join(LEADS)})\s+({'|'.join(BODY_WORDS)})(\s|$)")


def caption_findings(df: DataFrame, keys: Keys, caption: str, names: Sequence[str], null_share: float = 0.5, mismatch: float = 20.0) -> DataFrame:
    """Per key frames, those without any object in the columns `names`, distinct captions, those about a body part, and frames whose caption names none of their objects; issues: most frames without objects, a body part, and over `mismatch` percent of frames with objects that their captions don't name.

    Captions are trimmed and a null one is empty; empty captions and frames without
    objects can't disagree.  Captions are counted first, so a key's frames aren't held.
    """
    text = F.trim(F.coalesce(F.col(caption), F.lit("")))
    found = [F.nullif(F.col(c), F.lit("")) for c in names]
    some = F.coalesce(*found).isNotNull()
    told = F.greatest(*(F.coalesce(F.contains(F.lower(text), F.lower(c)), F.lit(False)) for c in found)) if len(found) > 1 else F.coalesce(F.contains(F.lower(text), F.lower(found[0])), F.lit(False))
    by = df.groupBy(*keys, text.alias("_text")).agg(F.count("*").alias("_n"), F.count_if(some).alias("_some"), F.count_if(some & (text != "") & ~told).alias("_off"))
    out = by.groupBy(*keys).agg(F.sum("_n").alias("frames"), (F.sum("_n") - F.sum("_some")).alias("n_null"), F.count("*").alias("captions"), F.count_if(has_body_part(F.col("_text"))).alias("body_captions"), F.sum("_some").alias("n_named"), F.sum("_off").alias("n_mismatch"))
    return out.withColumn("issues", issues_of(no_objects=F.col("n_null") > null_share * F.col("frames"), body_part=F.col("body_captions") > 0, disconnected=100.0 * F.col("n_mismatch") > mismatch * F.col("n_named")))


def segment_findings(segments: DataFrame, episodes: DataFrame, keys: Keys, start: str, stop: str, label: str, description: str, length: str, short: float = 0.2, whole: float = 0.98) -> DataFrame:
    """Per episode (keys, length in seconds) segments, short ones and distinct labels and descriptions; issues: no segments, short ones, a single one over the whole episode, one label for all, or one description under several labels. Null labels and descriptions count as empty."""
    time = F.coalesce(F.col(stop), F.lit(0.0)) - F.coalesce(F.col(start), F.lit(0.0))
    word = lambda c: F.coalesce(F.col(c), F.lit(""))
    by = segments.groupBy(*keys).agg(F.count("*").alias("segments"), F.count_if(time < short).alias("short_segments"), F.max(time).alias("longest"), *((F.min(word(c)) == F.max(word(c))).alias(n) for n, c in (("_label", label), ("_text", description))))
    out = episodes.select(*keys, F.col(length).alias("_length")).join(by, list(keys), "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("segments", "short_segments")})
    n = F.col("segments")
    issues = issues_of(none=n == 0, short=F.col("short_segments") > 0, whole=(n == 1) & (F.col("longest") >= whole * F.coalesce("_length", F.lit(0.0))), one_label=F.col("_label"), one_description=(n > 1) & ~F.col("_label") & F.col("_text"))
    return out.withColumn("issues", issues).drop("_label", "_text", "_length")
