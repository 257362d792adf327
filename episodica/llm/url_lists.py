"""URL filters with dated lists: validity intervals and an as-of join, in DataFrame operations only.

A list entry says that a host name, and every name under it, is blocked or allowed
from a date on.  The entries of a name become intervals that end where its next entry
begins.  A capture is judged by the entry of the most specific name that has one
active at fetch time: of each distinct host and fetch time all suffixes, from the
whole name to its last label, are joined to the intervals by name with the fetch time
inside, at most one match each, and the longest suffix with a match decides.

Edge cases: null or malformed urls have no host and are kept; null fetch times match
nothing; of entries of one name and date a block wins; entries without a name, date
or known action are left out; repeated captures give repeated results; an empty list
keeps everything; host names are lower-cased, ports, user names (up to the last @) and
dots at the end cut off, those of entries too; an address in brackets is one host. Where the captures have a column named like one of the
result's (host, rule, listed_on, action, kept), it stays, and the result's is called
`list_host` and so on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import small, table, unused, written

BROADCAST_ENTRIES = 200_000
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]/?#@]+\]|[^/?#:@\[\]]+)"


def host_of(url: Column) -> Column:
    """The lower-case host of a url without dots at its end, or null."""
    return name_of(F.regexp_extract(url, HOST, 1))


def name_of(host: Column) -> Column:
    return F.nullif(F.regexp_replace(F.lower(host), r"\.+$", ""), F.lit(""))


def intervals(entries: DataFrame) -> DataFrame:
    """name, action, since, until (null: open) from entries: name, action, listed_on."""
    once = entries.withColumn("name", name_of(F.col("name"))).filter("name is not null and listed_on is not null and action in ('block', 'allow')")
    once = once.groupBy("name", F.col("listed_on").alias("since")).agg(F.max("action").alias("action"))
    later = F.lead("since").over(Window.partitionBy("name").orderBy("since"))
    return once.select("name", "action", "since", later.alias("until"))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """`captures` (url, fetched_on, and any other columns) with host, rule (the name that decides), listed_on, action and kept."""
    spans = written(intervals(entries), "intervals")
    host, rule = unused(captures, "_host"), unused(captures, "_rule")
    got = captures.withColumn(host, host_of(F.col("url")))
    labels = F.split("host", r"\.")
    tried = got.filter(F.col(host).isNotNull() & F.col("fetched_on").isNotNull()).select(F.col(host).alias("host"), "fetched_on").distinct().select("host", "fetched_on", F.explode(F.sequence(F.lit(1), F.size(labels))).alias("cut"))
    tried = tried.withColumn("name", F.array_join(F.slice(labels, F.col("cut"), F.size(labels)), ".")).filter("name <> ''")
    hits = tried.join(F.broadcast(spans) if small(spans, BROADCAST_ENTRIES) else spans, "name").filter("fetched_on >= since and (until is null or fetched_on < until)")
    best = written(hits.groupBy(F.col("host").alias(host), "fetched_on").agg(F.min_by(F.struct("name", "action", "since"), "cut").alias(rule)), "judged")
    got = got.join(F.broadcast(best) if small(best, BROADCAST_ENTRIES) else best, [host, "fetched_on"], "left")
    decided = F.col(rule)
    result = {"host": F.col(host), "rule": decided["name"], "listed_on": decided["since"], "action": decided["action"], "kept": F.coalesce(decided["action"] != "block", F.lit(True))}
    taken = {c.lower() for c in captures.columns}
    return got.select(*captures.columns, *(c.alias(unused(captures, f"list_{n}") if n in taken else n) for n, c in result.items()))


def captures_of(pages: DataFrame) -> DataFrame:
    """The pages as captures. The table has no fetch dates; each page gets one of 730 days by its id."""
    return pages.select("page_id", "url", F.date_add(F.lit("2023-01-01").cast("date"), F.pmod(F.col("page_id") * 7919, F.lit(730)).cast("int")).alias("fetched_on"))


def entries_of(pages: DataFrame) -> DataFrame:
    """A dated list over the pages' own names: by digests, of hosts and of the names above them, some are listed once, twice or three times."""
    names = pages.select(host_of(F.col("url")).alias("host")).filter("host is not null").distinct()
    labels = F.split("host", r"\.")
    above = F.when(F.size(labels) > 2, F.array_join(F.slice(labels, 2, F.greatest(F.size(labels) - 1, F.lit(1))), "."))
    names = names.select(F.explode(F.array(F.col("host"), above)).alias("name")).filter("name is not null").distinct()
    out = names.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(3)))).withColumn("h", F.md5(F.concat_ws("/", "name", F.col("k").cast("string"))))
    day = F.conv(F.substring("h", 1, 4), 16, 10).cast("int") % 730
    return out.filter(F.substring("h", 5, 1) < "6").select("name", F.when(F.substring("h", 6, 1) < "a", "block").otherwise("allow").alias("action"), F.date_add(F.lit("2023-01-01").cast("date"), day).alias("listed_on"))


def op10_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge(captures_of(pages), entries_of(pages))


_HOST_SQL = r"nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]/?#@]+\]|[^/?#:@\[\]]+)', 1)), '\.+$', ''), '')"
ORACLE = f"""
with cap as (
  select page_id, url, cast(date '2023-01-01' + cast((page_id * 7919) % 730 as integer) as date) as fetched_on, {_HOST_SQL} as host from pages
), hosts as (select distinct host from cap where host is not null
), names as (
  select host as name from hosts union
  select array_to_string(string_split(host, '.')[2:], '.') from hosts where len(string_split(host, '.')) > 2
), e as (select name, md5(name || '/' || k) as h from names, (values ('1'), ('2'), ('3')) t(k)
), entries as (
  select name, max(case when h[6] < 'a' then 'block' else 'allow' end) as action,
    cast(date '2023-01-01' + cast(cast('0x' || h[1:4] as integer) % 730 as integer) as date) as since
  from e where h[5] < '6' group by 1, 3
), spans as (select *, lead(since) over (partition by name order by since) as until from entries
), suffixes as (
  select page_id, fetched_on, d, array_to_string(string_split(host, '.')[d:], '.') as name
  from (select page_id, fetched_on, host, unnest(range(1, len(string_split(host, '.')) + 1)) as d from cap where host is not null)
), tried as (
  select c.page_id, d, s.name, s.action, s.since
  from suffixes c join spans s on s.name = c.name and c.fetched_on >= s.since and (s.until is null or c.fetched_on < s.until)
), best as (select * from tried qualify row_number() over (partition by page_id order by d) = 1)
select c.page_id, c.url, c.fetched_on, c.host, b.name as rule, b.since as listed_on, b.action, coalesce(b.action <> 'block', true) as kept
from cap c left join best b using (page_id)
"""
