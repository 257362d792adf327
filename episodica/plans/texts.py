"""Queries of reply salvage over synthetic replies made from documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import replies as r
from .adapters import table
from .registry import query


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")


_VOCAB = ["src1", "src2", "src3"]


def _reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.format_string('[{"name": "%s", "count": %d}]', "source", "n_chars")
    k = F.col("doc_id") % 4
    text = F.when(k == 0, body).when(k == 1, F.concat(F.lit("Here:\n```json\n"), body, F.lit("\n```"))).when(k == 2, F.concat(F.lit("I see "), body, F.lit(" there."))).otherwise("no list at all")
    return _docs(spark, sf_dir).withColumn("text", text)


@query("select doc_id, case when doc_id % 4 < 3 then source end as name, case when doc_id % 4 < 3 then n_chars end as count from documents")
def json_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = F.try_element_at(r.salvage(F.col("text"), "array<struct<name:string,count:long>>"), F.lit(1))
    return _reply(spark, sf_dir).select("doc_id", got["name"].alias("name"), got["count"].alias("count"))


@query("select doc_id, case when doc_id % 3 = 0 then (n_chars % 60)::double when doc_id % 3 = 1 then (doc_id % 10) * 60 + (n_chars % 60) + 0.5::double else 0 end as seconds from documents")
def time_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("doc_id") % 3, F.col("n_chars") % 60
    text = F.when(k == 0, s.cast("string")).when(k == 1, F.concat((F.col("doc_id") % 10).cast("string"), F.lit(":"), s.cast("string"), F.lit(".5"))).otherwise("soon")
    return _docs(spark, sf_dir).select("doc_id", r.seconds(text).alias("seconds"))


@query("select doc_id, n::bigint as n, case n when 1 then source else lang end as line from documents, (values (1), (2)) t(n)")
def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("intro\nSegment 1: "), "source", F.lit("\n segment 2 : "), "lang", F.lit("  \nend"))
    df = _docs(spark, sf_dir).select("doc_id", F.explode(r.numbered_lines(text)).alias("l"))
    return df.select("doc_id", F.col("l.n").cast("long").alias("n"), F.col("l.line").alias("line"))


@query("select doc_id, case when doc_id % 5 = 0 then null else source || ' and ' || lang end as caption from documents")
def caption_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("doc_id") % 5 == 0, '"N/A"').otherwise(F.concat(F.lit(' "**'), "source", F.lit("**  and "), "lang", F.lit('" ')))
    return _docs(spark, sf_dir).select("doc_id", r.caption(text).alias("caption"))


@query("select doc_id, least(a, c) / 1000.0::double as x0, least(b, d) / 1000.0::double as y0, least(greatest(a, c), 1000) / 1000.0::double as x1, least(greatest(b, d), 1000) / 1000.0::double as y1 from (select doc_id, doc_id % 900 as a, n_chars % 800 as b, (doc_id * 7) % 1200 as c, (n_chars * 3) % 900 as d from documents)")
def box_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, n = F.col("doc_id"), F.col("n_chars")
    text = F.format_string("at <box> %d, %d, %d, %d </box> not <box>1, 2</box>", d % 900, n % 800, (d * 7) % 1200, (n * 3) % 900)
    return _docs(spark, sf_dir).select("doc_id", F.explode(r.boxes_of(text)).alias("b")).select("doc_id", "b.*")


@query("select doc_id, upper(source) as name, 'on ' || lang as place, doc_id % 2 = 0 as touched from documents")
def object_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.lit("- "), F.upper("source"), F.lit(": on "), "lang", F.when(F.col("doc_id") % 2 == 0, " (touched: true)").otherwise(""))
    return _docs(spark, sf_dir).select("doc_id", r.bullet(line).alias("o")).select("doc_id", "o.*")


@query("select doc_id, (doc_id % 50)::double as start, (doc_id % 50) + 2.5::double as stop, 'pick_up' as verb, source as rest from documents where doc_id % 2 = 0")
def segment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 50
    line = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("0:"), k.cast("string"), F.lit(" - "), (k + 2.5).cast("string"), F.lit(" : pick_up the "), "source")).otherwise("nothing here")
    return _docs(spark, sf_dir).select("doc_id", r.time_range(line).alias("s")).filter("s is not null").select("doc_id", "s.*")


@query("select doc_id, sha256(coalesce(text, 'unknown')) as name_sha256, coalesce(source, 'unknown') as place, doc_id % 2 = 0 as touched from documents")
def object_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of replies in JSON within prose, whole texts as names."""
    d = table(spark, sf_dir, "documents")
    item = F.struct(F.col("text").alias("label"), F.col("source").alias("location"), (F.col("doc_id") % 2 == 0).alias("touched"))
    reply = F.concat(F.lit("Found these: "), F.to_json(F.array(item)), F.lit(" and no more."))
    o = d.select("doc_id", F.explode(r.objects_of(reply)).alias("o"))
    return o.select("doc_id", F.sha2("o.name", 256).alias("name_sha256"), "o.place", "o.touched")


@query("select doc_id, 'place' as verb, 61.0::double as start, 65.5::double as stop, regexp_extract(lower(source), '^[a-z_]+') as object_name, case when doc_id % 2 = 0 then 'left' else 'right' end as hand from documents")
def segment_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of replies in prose: times, verb, object and hand."""
    text = F.concat(F.lit("First 1:01 ~ 1:05.5: place it on the "), "source", F.when(F.col("doc_id") % 2 == 0, " with left hand").otherwise(""))
    s = _docs(spark, sf_dir).select("doc_id", F.explode(r.segments_of(text)).alias("s"))
    return s.select("doc_id", "s.verb", "s.start", "s.stop", "s.object_name", "s.hand")


_WORDS = "list_filter(regexp_extract_all(text, '[A-Za-z]+'), lambda x: len(x) > 2)"


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with at least eight words of three plain letters or more, as w."""
    d = table(spark, sf_dir, "documents").withColumn("w", F.filter(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), 0), lambda x: F.length(x) > 2))
    return d.filter(F.size("w") >= 8)


@query(f"with w as (select doc_id, {_WORDS} as w from documents) select doc_id, place + 1 as line, w[place + 1] as name, case when place = 2 then 'unknown' else w[place + 4] end as place, doc_id % 2 = 0 and place = 1 as touched from w, (select unnest(range(3)) as place) where len(w) >= 8")
def broken_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of replies in JSON that is cut off, in three ways to write a field, with words of the texts; a bullet beside fields doesn't count."""
    w = lambda i: F.element_at("w", i)
    lines = [
        F.concat(F.lit('[{"name": "'), w(1), F.lit("\", 'location' : '"), w(4), F.lit("', ")),
        F.concat(F.lit("  object = "), w(2), F.lit(", location_description: "), w(5), F.lit(", touched: "), F.when(F.col("doc_id") % 2 == 0, "TRUE").otherwise("0")),
        F.concat(F.lit("so the label:"), w(3), F.lit("}, {")), F.concat(F.lit("- "), w(6), F.lit(": on "), w(7)),
    ]
    d = _words(spark, sf_dir).withColumn("reply", F.concat_ws("\n", *lines))
    o = d.select("doc_id", F.posexplode(r.objects_of(F.col("reply"))).alias("i", "o"))
    return o.select("doc_id", (F.col("i") + 1).cast("long").alias("line"), "o.name", "o.place", "o.touched")


@query(f"with w as (select doc_id, {_WORDS} as w from documents) select doc_id, i as line, w[i + 1] as verb, case when i = 2 then 62.25 else i * 10.0 end::double as start, case when i = 2 then 65 else i * 10.0 + 5.5 end::double as stop, array_to_string(w[i + 2:i + 4], ' ') as rest from w, (select unnest(range(3)) as i) where len(w) >= 8")
def spoken_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of replies in prose with words of the texts: times with dashes, tildes and fractions, with and without what parts them from the verb."""
    w = lambda i, n: F.array_join(F.slice("w", i, n), " ")
    reply = F.concat(F.lit("Here is the list\n1. 0:00 - 0:05.5: "), w(1, 4), F.lit("\nthen 0:10~0:15.5 - "), w(2, 4), F.lit("\nand\n1:02.25 -1:05   "), w(3, 4), F.lit("\n0:99 and so on"))
    s = _words(spark, sf_dir).select("doc_id", F.posexplode(r.segments_of(reply)).alias("i", "s"))
    return s.select("doc_id", F.col("i").cast("long").alias("line"), "s.verb", "s.start", "s.stop", "s.rest")


@query("select doc_id, case when doc_id % 3 = 0 then '' when doc_id % 3 = 1 then '2' else '2,3' end as missing, case when doc_id % 3 = 0 then lang end as second from documents")
def numbered_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that a reply of three numbered lines lacks; an empty line is none."""
    k = F.col("doc_id") % 3
    second = F.when(k == 0, F.concat(F.lit("Segment 2: "), "lang")).otherwise("Segment 2:")
    third = F.when(k < 2, F.concat(F.lit("\nsegment 3: "), "source")).otherwise("")
    lines = r.described(F.concat(F.lit("Segment 1: "), "source", F.lit("\n"), second, third), F.lit(3))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(r.missing(lines).cast("array<string>"), ",").alias("missing"), lines[1].alias("second"))


@query()
def name_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names brought to the most similar word of a vocabulary; tested on a small fixture, since SQL lacks the measure."""
    return r.nearest_name(_docs(spark, sf_dir).select("doc_id", "source"), "source", _VOCAB)


@query("select doc_id, lower(source) similar to '.*(person|human|arm|body|hand).*' as body, doc_id % 2 = 0 as tripwire from documents")
def body_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("doc_id") % 2 == 0, "grips the HAND tightly").otherwise("a charm on the table")
    return _docs(spark, sf_dir).select("doc_id", r.is_body_term(F.col("source")).alias("body"), r.body_caption(text).alias("tripwire"))


@query("select doc_id, case when contains(source, 'src1') then 'src1' when contains(source, 'src2') then 'src2' when contains(source, 'src3') then 'src3' else 'object' end as name from documents")
def name_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", r.canonical(F.col("source"), _VOCAB).alias("name"))


@query("select doc_id, sha256(source || chr(0) || lang || chr(0) || doc_id::varchar) as key from documents")
def prompt_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", r.fingerprint(F.col("source"), F.col("lang"), F.col("doc_id").cast("string")).alias("key"))


@query("select conv_id, count(*) as turns, sum(length(text))::bigint as chars, string_agg(role, '>' order by turn) as roles from conversations group by 1")
def conversation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").groupBy("conv_id")
    roles = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda s: s["role"]), ">")
    return c.agg(F.count("*").alias("turns"), F.sum(F.length("text")).alias("chars"), roles.alias("roles"))
