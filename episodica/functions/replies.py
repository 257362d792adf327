"""Salvage of semi-structured model replies: column expressions over text."""

from __future__ import annotations

from collections.abc import Callable
from difflib import SequenceMatcher
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names that are no objects; fixed values.
BODY_TERMS = ("person", "human", "arm", "body", "hand")


def json_candidates(text: Column) -> Column:
    """The whole text, its first fenced block, and the part from the first bracket to the last matching one."""
    whole = F.trim(text)
    fenced = F.nullif(F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1), F.lit(""))
    span = F.nullif(F.regexp_extract(text, r"(?s)([\[{].*[\]}])", 1), F.lit(""))
    return F.array_compact(F.array(whole, F.trim(fenced), span))


def salvage(text: Column, schema: str) -> Column:
    """The first candidate that parses as the schema; null if none does."""
    parsed = F.transform(json_candidates(text), lambda c: F.from_json(c, schema, {"mode": "PERMISSIVE"}))
    return F.try_element_at(F.filter(parsed, lambda x: x.isNotNull()), F.lit(1))


def seconds(text: Column) -> Column:
    """SS, MM:SS or HH:MM:SS with fractions; 0 if malformed."""
    parts = F.transform(F.split(F.trim(text), ":"), lambda p: p.try_cast("double"))
    total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc * 60 + x)
    return F.when(F.size(parts).between(1, 3), F.coalesce(total, F.lit(0.0))).otherwise(0.0)


def numbered_lines(text: Column, word: str = "Segment") -> Column:
    """Array of (number, line) of lines like `Segment 2: ...`."""
    pattern = F.lit(rf"(?im)^[^\S\n]*{word}\s+(\d+)[^\S\n]*:[^\S\n]*(\S.*?)[^\S\n]*$")
    return F.transform(F.regexp_extract_all(text, pattern, 0), lambda x: F.struct(F.regexp_extract(x, r"(\d+)\s*:", 1).cast("int").alias("n"), F.regexp_extract(x, r"(?s):\s*(.+?)\s*$", 1).alias("line")))


def described(text: Column, n: Column, word: str = "Segment") -> Column:
    """Array of n lines, that of number i at place i, the last one where a number comes twice, null where it is missing. If nothing is numbered and one line is wanted, it is the first of the text."""
    first = F.trim(F.regexp_extract(F.trim(text), r"^(.*)", 1))
    numbered = numbered_lines(text, word)
    lines = F.when((F.size(numbered) == 0) & (n == 1) & (first != ""), F.array(F.struct(F.lit(1).alias("n"), first.alias("line")))).otherwise(numbered)
    own = lambda i: F.try_element_at(F.filter(lines, lambda x: x["n"] == i), F.lit(-1))["line"]
    return F.when(n >= 1, F.transform(F.sequence(F.lit(1), n), own)).otherwise(F.array().cast("array<string>"))


def missing(lines: Column) -> Column:
    """Numbers without a line in an array of `described`."""
    return F.filter(F.transform(lines, lambda x, i: F.when(x.isNull(), i + 1)), lambda i: i.isNotNull())


def required(lines: Column) -> Column:
    """The lines of `described`; the query fails, naming the numbers, where one is missing."""
    absent = missing(lines)
    return F.when(F.size(absent) > 0, F.raise_error(F.concat(F.lit("no line for "), F.array_join(absent.cast("array<string>"), ", ")))).otherwise(lines)


def caption(text: Column, most_words: int = 50) -> Column:
    """A caption without quotes and stars, at most so many words; null if empty or a placeholder."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(text, r"\*\*", ""), "^[\\s\"'`]+|[\\s\"'`]+$", ""))
    words = F.filter(F.split(bare, r"\s+"), lambda w: w != "")
    short = F.array_join(F.slice(words, 1, most_words), " ")
    return F.when((F.size(words) > 0) & ~F.lower(bare).isin("n/a", "none", "placeholder", "unknown", "todo"), short)


def boxes_of(text: Column) -> Column:
    """Boxes of `<box> x0, y0, x1, y1 </box>` in thousandths, four whole numbers with or without signs and commas: ordered and clipped to 0 to 1; other spans are left out."""
    spans = F.regexp_extract_all(text, F.lit(r"(?s)<box>(.*?)</box>"), 1)
    numbers = F.filter(F.transform(spans, lambda s: F.regexp_extract_all(s, F.lit(r"-?\d+"), 0)), lambda n: F.size(n) == 4)
    share = lambda n, k: F.greatest(F.lit(0.0), F.least(F.lit(1.0), n[k].cast("double") / 1000))
    return F.transform(numbers, lambda n: F.struct(*(pick(share(n, k), share(n, k + 2)).alias(c) for pick, k, c in ((F.least, 0, "x0"), (F.least, 1, "y0"), (F.greatest, 0, "x1"), (F.greatest, 1, "y1")))))


def bullet(line: Column) -> Column:
    """name, place, touched of a line like `- Knife: on board (touched: true)`; a line without a marker or a colon has empty ones."""
    bare = F.trim(line)
    name = F.substring_index(F.substr(bare, F.lit(2)), ":", 1)
    rest = F.trim(F.substr(bare, F.length(name) + 3))
    note = F.lower(F.translate(F.substring_index(rest, "(", -1), " ", ""))
    noted = rest.contains("(") & note.isin("touched:true)", "touched:false)")
    place = F.when(noted, F.rtrim(F.substr(rest, F.lit(1), F.length(rest) - F.length(F.substring_index(rest, "(", -1)) - 1))).otherwise(rest)
    ok = (bare.startswith("-") | bare.startswith("*")) & bare.contains(":")
    return F.struct(F.when(ok, F.trim(name)).otherwise("").alias("name"), F.when(ok, place).otherwise("").alias("place"), (ok & noted & (note == "touched:true)")).alias("touched"))


def json_items(text: Column, item: str) -> Column:
    """The list of a reply in JSON: a list itself, or the first value of an object that is one; null without either."""

    def items(c: Column) -> Column:
        inner = F.try_element_at(F.filter(F.map_values(F.from_json(c, "map<string,string>")), lambda v: F.ltrim(v).startswith("[")), F.lit(1))
        return F.from_json(F.when(c.startswith("["), c).when(c.startswith("{"), inner), f"array<{item}>")

    return F.try_element_at(F.filter(F.transform(json_candidates(text), items), lambda x: x.isNotNull()), F.lit(1))


#: Names by which replies give an object's fields; fixed values.
OBJECT_KEYS, PLACE_KEYS = ("name", "object", "label"), ("location", "location_description")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def fields(line: Column) -> Column:
    """key, value pairs of a line that may be broken JSON: what stands before a colon or equals sign and what follows it, both without quotes, up to a comma, brace or closing quote."""

    def pairs(piece: Column) -> Column:
        parts = F.split(piece, "[:=]")
        return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.when(i < F.size(parts), F.struct(_bare(F.get(parts, i - 1)).alias("key"), _bare(F.array_join(F.slice(parts, i + 1, F.size(parts)), ":")).alias("value"))))

    return F.filter(F.flatten(F.transform(F.split(line, "[,{}]"), pairs)), lambda p: p.isNotNull() & (p["value"] != ""))


def _bare(text: Column) -> Column:
    """The text within its first quotes, or up to one; without spaces about it."""
    plain = F.trim(F.translate(text, "'\r", '"'))
    return F.trim(F.substring_index(F.when(plain.startswith('"'), F.substr(plain, F.lit(2))).otherwise(plain), '"', 1))


def field(line: Column, names: tuple[str, ...]) -> Column:
    """The value of the first field of a line whose key ends in one of the names; null without one."""
    return named(fields(line), names)


def named(pairs: Column, names: tuple[str, ...]) -> Column:
    return F.get(F.filter(pairs, lambda p: reduce(or_, (p["key"].endswith(n) for n in names))), F.lit(0))["value"]


def objects_of(text: Column) -> Column:
    """Array of (name, place, touched) of a reply.

    Every line is read for itself, as fields or as a bullet; JSON is preferred to fields and
    fields to bullets, and all readings of the best kind count.
    """
    item = "struct<" + ",".join(f"{k}:string" for k in (*OBJECT_KEYS, *PLACE_KEYS, "touched")) + ">"

    def reading(kind: int, name: Column, place: Column, touched: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.coalesce(name, F.lit("unknown")).alias("name"), F.coalesce(place, F.lit("unknown")).alias("place"), F.coalesce(touched, F.lit(False)).alias("touched"))

    def of_line(line: Column) -> Column:
        of_fields = lambda got: let(named(got, OBJECT_KEYS), lambda name: F.when(name.isNotNull(), reading(2, name, named(got, PLACE_KEYS), yes(named(got, ("touched",))))))
        of_bullet = let(bullet(line), lambda b: F.when(b["name"] != "", reading(3, b["name"], b["place"], b["touched"])))
        return F.coalesce(let(fields(line), of_fields), of_bullet)

    yes = lambda c: F.lower(c).isin("true", "1")
    first = lambda x, names: F.coalesce(*(x[k] for k in names))
    parsed = F.transform(F.filter(json_items(text, item), lambda x: x.isNotNull()), lambda x: reading(1, first(x, OBJECT_KEYS), first(x, PLACE_KEYS), yes(x["touched"])))
    every = F.array_compact(F.concat(F.coalesce(parsed, F.array().cast("array<struct<kind:int,name:string,place:string,touched:boolean>>")), F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), of_line)))
    best = lambda all_: let(F.array_min(F.transform(all_, lambda r: r["kind"])), lambda kind: F.filter(all_, lambda r: r["kind"] == kind))
    return F.transform(let(every, best), lambda r: F.struct(r["name"].alias("name"), r["place"].alias("place"), r["touched"].alias("touched")))


#: Words that tell an object in a segment's line; fixed values.
ARTICLES = ("the", "a", "an")
STOPS = ("the", "a", "an", "down", "up", "with", "using", "both", "left", "right", "hand", "hands", "of", "in", "on", "at", "to", "into", "for")
PLACES = ("into", "in", "to", "on", "onto", "at")
VERBS = ("pick", "picking", "place", "placing", "grasp", "grasping", "pour", "pouring", "hold", "holding", "manipulate", "manipulating", "reach", "reaching", "touch", "touching", "grab", "grabbing")


def object_after(words: Column, leads: tuple[str, ...], particles: tuple[str, ...] = ()) -> Column:
    """The object after the first of `leads` that has one: past a particle and an article, the second of two plain words, or the only one; null without."""
    at = lambda i: F.try_element_at(words, i)
    plain = lambda i: F.when(~at(i).isin(*STOPS) & at(i).rlike("^[a-z_]+"), at(i))

    def after(i: Column) -> Column:
        past = (lambda k, these: F.when(at(k).isin(*these), k + 1).otherwise(k)) if particles else (lambda k, these: k)
        k = past(i + 1, particles or ("",))
        k = F.when(at(k).isin(*ARTICLES), k + 1).otherwise(k)
        two = at(k).rlike("^[a-z_]+$") & plain(k + 1).isNotNull()
        return F.when(at(i).isin(*leads) & plain(k).isNotNull(), F.regexp_extract(F.when(two, at(k + 1)).otherwise(at(k)), "^([a-z_]+)", 1))

    found = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1))), after)
    return F.try_element_at(F.filter(found, lambda x: x.isNotNull()), F.lit(1))


def segments_of(text: Column) -> Column:
    """Array of (verb, start, stop, object_name, hand, rest) of a reply: from its JSON, with defaults for what it lacks; if that has none, from times `0:02 - 0:05 : verb ...` in the text."""
    item = "struct<name:string,start_time:string,end_time:string,object_name:string,hand_used:string,description:string>"
    given = lambda c, rest: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(rest))
    row = lambda *cols: F.struct(*(c.alias(n) for c, n in zip(cols, ("verb", "start", "stop", "object_name", "hand", "rest"), strict=True)))
    parsed = F.transform(
        F.filter(json_items(text, item), lambda x: x.isNotNull()),
        lambda x: row(given(x["name"], "manipulate"), seconds(given(x["start_time"], "0.0")), seconds(given(x["end_time"], "10.0")), given(x["object_name"], "unknown"), F.lower(given(x["hand_used"], "right")), given(x["description"], "")),
    )
    spoken = F.filter(F.transform(F.split(text, "\n"), lambda line: timed(line, row)), lambda x: x.isNotNull())
    return F.coalesce(F.when(F.size(parsed) > 0, parsed), spoken, F.array().cast("array<struct<verb:string,start:double,stop:double,object_name:string,hand:string,rest:string>>"))


def is_clock(token: Column) -> Column:
    """Whether a token is minutes and seconds, with a point or a colon between and perhaps a fraction."""
    return F.translate(token, "0123456789", "").isin(":", ".", ":.", "..") & ~F.substr(token, F.lit(1), F.lit(1)).isin(":", ".") & ~F.substr(token, F.lit(-1)).isin(":", ".") & ~token.contains(":.") & ~token.contains("..")


def timed(line: Column, row) -> Column:
    """A segment of a line by its tokens: two clock times with a dash or tilde between, perhaps a colon or dash, a verb, and the rest; null without."""
    apart = F.regexp_replace(F.regexp_replace(line, "(?<=[0-9])\\s*[~-]\\s*(?=[0-9])", " - "), "(?<=[0-9])\\s*[:-]\\s*(?=[A-Za-z_])", " - ")

    def of_tokens(tokens: Column) -> Column:
        at = lambda i: F.coalesce(F.try_element_at(tokens, i), F.lit(""))
        starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(tokens), F.lit(1))), lambda i: (at(i + 1) == "-") & is_clock(at(i)) & is_clock(at(i + 2)))

        def of_verb(i: Column, verb_at: Column, verb: Column) -> Column:
            rest = F.trim(F.concat(F.substr(at(verb_at), F.length(verb) + 1), F.lit(" "), F.array_join(F.slice(tokens, verb_at + 1, F.size(tokens)), " ")))
            return let(rest, lambda rest: F.when(i.isNotNull() & (verb != ""), of_rest(verb, at(i), at(i + 2), rest)))

        place = lambda i: F.when(at(i + 3) == "-", i + 4).otherwise(i + 3)
        return let(F.get(starts, F.lit(0)), lambda i: let(place(i), lambda k: let(F.regexp_extract(at(k), "^[A-Za-z0-9_]+", 0), lambda verb: of_verb(i, k, verb))))

    def of_rest(verb: Column, start: Column, stop: Column, rest: Column) -> Column:
        low = F.lower(rest)
        name = let(F.split(low, " "), lambda words: F.coalesce(object_after(words, PLACES), object_after(words, VERBS, ("up", "for", "down")), F.lit("unknown")))
        hand = F.when(low.contains("left"), "left").when(low.contains("both"), "both").otherwise("right")
        return row(verb, seconds(start), seconds(stop), name, hand, rest)

    return let(F.filter(F.split(apart, "\\s+"), lambda x: x != ""), of_tokens)


def time_range(line: Column) -> Column:
    """start, stop, verb, rest of a line like `0:02.5 - 0:05 : pick_up the cup`."""
    pattern = r"^\s*([\d:.]+)\s*-\s*([\d:.]+)\s*:\s*(\w+)\s*(.*?)\s*$"
    got = [F.regexp_extract(line, pattern, k) for k in (1, 2, 3, 4)]
    return F.when(got[2] != "", F.struct(seconds(got[0]).alias("start"), seconds(got[1]).alias("stop"), got[2].alias("verb"), F.regexp_replace(got[3], r"^(the|a|an)\s+", "").alias("rest")))


def is_body_term(name: Column) -> Column:
    return F.lower(name).rlike("|".join(BODY_TERMS))


def body_caption(text: Column) -> Column:
    return F.lower(text).rlike(r"\b(the|a|an|this)\s+(" + "|".join(BODY_TERMS) + r")\b")


def canonical(name: Column, vocabulary: list[str]) -> Column:
    """The first word of the vocabulary that the name holds or is part of, else `object`."""
    n = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    out = F.lit("object")
    for v in reversed(vocabulary):
        out = F.when((n != "") & (n.contains(v) | F.lit(v).contains(n)), v).otherwise(out)
    return out


def nearest_name(df: DataFrame, name: str, vocabulary: list[str], least: float = 0.5, out: str = "canonical") -> DataFrame:
    """Adds the vocabulary's word that equals the name but for case and outer blanks, else the first of those most similar (share of matching blocks above `least`), else the name; null stays null. Words are compared once per distinct name, in Arrow batches."""

    @F.pandas_udf("string")
    def match(names: pd.Series) -> pd.Series:
        known = [(w, w.lower().strip()) for w in vocabulary]

        def best(x: str) -> str:
            bare = x.lower().strip()
            exact = [w for w, v in known if v == bare]
            scored = [(SequenceMatcher(None, bare, v).ratio(), w) for w, v in known]
            top = max(scored, key=lambda s: s[0], default=(0.0, x))
            return exact[0] if exact else top[1] if top[0] > least else x

        return names.map(best)

    codes = df.filter(F.col(name).isNotNull()).select(F.col(name).alias("_name")).distinct().withColumn(out, match("_name"))
    return df.join(codes, F.col(name) == F.col("_name"), "left").drop("_name")


def fingerprint(*parts: Column) -> Column:
    """A digest of the parts, with a separator and a mark for null that texts don't hold."""
    return F.sha2(F.concat_ws("\0", *(F.coalesce(p.cast("string"), F.lit("\1")) for p in parts)), 256)


def repair_prompt(reply: Column, most: int = 2000) -> Column:
    return F.concat(F.lit("The reply below is not valid JSON. Return the same content as JSON only.\n"), F.substring(reply, 1, most))
