"""Ops 1, 2, 3, 4, 6 and 8 against brute force on small documents."""

import hashlib
import random
import re

import pytest

from episodica.llm import decontaminate, near, personal_data, quality, repeats, secret_scan, shared, spans, token_counts

from .helpers import ODD, documents, prose, shingles, words_of


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_repeats_catch_passages_and_spare_others(spark):
    rng = random.Random(3)
    passage, short, para = prose(rng, 55), prose(rng, 40), prose(rng, 60)
    texts = [
        *ODD, f"{prose(rng, 80)} {passage} {prose(rng, 30)}", f"{prose(rng, 11)} {passage.upper()} {prose(rng, 90)}", f"{prose(rng, 60)} {short}", f"{short} {prose(rng, 60)}",
        f"{prose(rng, 20)}\n{para}\n{prose(rng, 9)}", f"{' '.join('new' if k == 30 else w for k, w in enumerate(para.split()))}\n{prose(rng, 70)}", prose(rng, 100),
    ]
    texts += [texts[14]]
    base = len(ODD)
    rows = repeats.repeats(documents(spark, texts)).collect()
    found = {(r["doc_id"], r["kind"], r["keeper_id"]) for r in rows}
    assert found == {(base + 1, "passage", base), (base + 5, "paragraph", base + 4), (len(texts) - 1, "document", 14), (4, "document", 3), (7, "document", 6)}
    p = next(r for r in rows if r["kind"] == "passage")
    assert words_of(texts[p["doc_id"]][p["start"] : p["stop"]]) == words_of(passage) and p["n_words"] == 55
    assert repeats.repeats(documents(spark, texts).limit(0)).count() == 0


def test_repeats_count_words_of_copies_only(spark):
    rng = random.Random(6)
    texts = [prose(rng, 60), " \n", " \n", prose(rng, 60)]
    df = repeats.repeats(documents(spark, [*texts, texts[0]]))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" in plan and not [line for line in plan.splitlines() if "Filter" in line and "regexp_extract_all" in line]
    assert [(r["doc_id"], r["keeper_id"], r["n_words"]) for r in df.collect()] == [(4, 0, 60)]


@pytest.mark.parametrize("repeated", [False, True])
def test_repeats_find_the_same_without_broadcasts(spark, monkeypatch, repeated):
    rng = random.Random(8)
    passage, para = prose(rng, 55), prose(rng, 60)
    texts = [f"{prose(rng, 80)} {passage} {prose(rng, 30)}", f"{prose(rng, 11)} {passage} {prose(rng, 90)}", f"{prose(rng, 20)}\n{para}", f"{' '.join('new' if k == 30 else w for k, w in enumerate(para.split()))}\n{prose(rng, 70)}"]
    df = documents(spark, [*texts, texts[1]])
    df = df.union(df.filter("doc_id < 2")) if repeated else df
    want = sorted(map(str, repeats.repeats(df).collect()))
    assert {x.split("kind='")[1].split("'")[0] for x in want} == {"document", "paragraph", "passage"}
    counted = []
    for module in (repeats, shared, near):
        monkeypatch.setattr(module, "small", lambda df, rows: False)
    monkeypatch.setattr(repeats, "spread_join", lambda *args, join=repeats.spread_join, **given: counted.append("counts" in given) or join(*args, **given))
    monkeypatch.setattr(shared, "HOT_ROWS", 1)
    monkeypatch.setattr(repeats, "HOT_ROWS", 1)
    assert sorted(map(str, repeats.repeats(df).collect())) == want
    assert True in counted  # the runs aren't counted once more


def test_repeats_equal_all_windows(spark):
    rng = random.Random(4)
    pool = [prose(rng, n) for n in (51, 60, 75, 49, 30)]
    texts = [" ".join(x for _ in range(3) for x in (prose(rng, rng.randrange(3, 30)), rng.choice(pool))) for _ in range(25)]
    owner, want = {}, {}
    for i, t in enumerate(texts):
        w = words_of(t)
        for k in range(len(w) - 49):
            owner.setdefault(tuple(w[k : k + 50]), i)
    for i, t in enumerate(texts):
        w = words_of(t)
        want[i] = {j for k in range(len(w) - 49) if owner[tuple(w[k : k + 50])] < i for j in range(k, k + 50)}
    got = {i: set() for i in want}
    for r in repeats.repeats(documents(spark, texts)).filter("kind = 'passage'").collect():
        got[r["doc_id"]] |= {k for k, m in enumerate(re.finditer(r"\S+", texts[r["doc_id"]])) if m.start() >= r["start"] and m.end() <= r["stop"]}
    assert got == want


def test_bands_reach_their_recall():
    b, r = repeats.tuned(0.8)
    assert 1 - (1 - 0.8**r) ** b >= 0.99 and b <= repeats.MAX_BANDS


def test_quality_learns_and_holds_out(spark):
    rng = random.Random(5)
    texts = [" ".join(["buy", "now", "cheap"] * 12) + prose(rng, 5) if i % 3 == 0 else prose(rng, 60) for i in range(240)] + ODD
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(240)] + [(9999, 1, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rows = by_id(quality.score_quality(docs, labels))
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows.values())
    out = [i for i in range(240) if rows[i]["held_out"]]
    assert out and sum(rows[i]["predicted"] == int(i % 3 != 0) for i in out) >= 0.95 * len(out)
    flipped = spark.createDataFrame([(i, int(i % 3 != 0) if not rows[i]["held_out"] else int(i % 3 == 0), 0) for i in range(240)], "doc_id long, quality int, toxic int")
    again = by_id(quality.score_quality(docs, flipped))
    assert all(again[i]["score"] == rows[i]["score"] for i in rows)  # labels of held-out rows are never read
    none = by_id(quality.score_quality(docs, labels.limit(0)))
    assert {r["score"] for r in none.values()} == {0.5}
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and quality.keep_good(docs.limit(0), labels).count() == 0


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_decontamination_equals_all_windows(spark):
    rng = random.Random(6)
    items = [(1, prose(rng, 20)), (2, prose(rng, 13)), (10, prose(rng, 4)), (3, None), (4, ""), (5, "...")]
    items += [(6, items[0][1].upper()), (None, prose(rng, 15))]
    texts = [*ODD, prose(rng, 30), f"x {items[0][1]} y", " ".join(items[1][1].split()[:12]), f"{prose(rng, 300)} {items[2][1]}", items[7][1], "-".join(items[1][1].split())]
    docs, bench = documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    for shard in (10**6, 9):
        rows = by_id(decontaminate.decontaminate(docs, bench, shard_windows=shard))
        for i, t in enumerate(texts):
            w, hit, who = alnum(t), set(), set()
            for item, text in items:
                v = alnum(text)
                for k in range(max(1, len(v) - 12) if v else 0):
                    part = v[k : k + 13]
                    for j in range(len(w) - len(part) + 1):
                        if w[j : j + len(part)] == part:
                            hit |= set(range(j, j + len(part)))
                            who |= {str(item)} if item is not None else set()
            r = rows[i]
            assert (r["n_words"], r["n_hit"], r["items"]) == (len(w), len(hit), sorted(who)), (shard, i)
            assert r["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(w))
    clean = decontaminate.keep_clean(docs.union(docs.limit(2)), bench)
    assert clean.columns == docs.columns
    assert by_id(decontaminate.decontaminate(docs, bench.limit(0)))[9]["contaminated"] is False


def kinds(df):
    return {r["doc_id"]: [(s["kind"], s["start"], s["stop"]) for s in r["spans"] if s["base"]] for r in df.collect()}


def test_personal_data_base_spans(spark):
    texts = [*ODD, "mail a.b+c@ex-1.org. and x@y and é@ä.b", "ip 10.0.0.256 1.2.3.4.5 999.1.1.1", "card 4111 1111 1111 1111 or 4111-1111-1111-1112", "tel +49 (30) 123-4567 now +1 23", "a@b.c@d.e", "٣ 1.2.3.٤"]
    want = {}
    for i, t in enumerate(texts):
        t, out = t or "", []
        out += [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
            d = re.sub(r"[\x20-]", "", m[0])
            s = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d)))
            out += [("card", m.start(), m.end())] if 14 <= len(d) <= 19 and s % 10 == 0 else []
        out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        want[i] = sorted(out, key=lambda s: (s[1], personal_data.KINDS.index(s[0])))
    found = personal_data.find_personal_data(documents(spark, texts))
    assert kinds(found) == want
    text = ",".join(f"{k}:{a}:{b}" for k, a, b in want[len(ODD)])
    row = by_id(spans.digest(found, personal_data.KINDS))[len(ODD)]
    assert row["base_sha256"] == hashlib.sha256(text.encode()).hexdigest() and row["n_email"] == 1
    assert personal_data.find_personal_data(documents(spark, texts).limit(0)).count() == 0


def test_personal_data_labels_are_consistent(spark):
    """A number that the patterns miss is labelled by its repetition as a phone number."""
    rng = random.Random(8)
    numbers = [f"555{rng.randrange(10**7):07d}" for _ in range(60)]
    texts = [f"call +1 {n} today or dial {n} later, order {rng.randrange(100)}" for n in numbers]
    rows = personal_data.find_personal_data(documents(spark, texts)).collect()
    added = [texts[r["doc_id"]][s["start"] : s["stop"]] == numbers[r["doc_id"]] and s["kind"] == "phone" for r in rows for s in r["spans"] if not s["base"]]
    assert sum(added) >= 50 and sum(added) >= 0.9 * len(added)


def test_secrets_base_spans_and_random_strings(spark):
    rnd = "q8Zx91LmPv3TnB7yWc5RkD2s"
    texts = [*ODD, 'API_KEY = "abcdefghijkl" secret:short password=\'Abcdefghijkl123', "AKIAABCDEFGHIJKLMN AKIA123", f"hash 0123456789abcdef0 and {'a' * 15}", f"see {rnd} here", "commit 3f2a9c1d4b5e6f708192a3b4c5d6e7f8091a2b3c", "internationalization_of_configuration_2", "tokentoken=abcdefghijklmnop"]
    want = {}
    for i, t in enumerate(texts):
        t = t or ""
        out = [("assign", m.start(), m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A) if len(m[2]) >= 12]
        out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        want[i] = sorted(out, key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))
    found = secret_scan.find_secrets(documents(spark, texts))
    assert kinds(found) == want
    extra = {r["doc_id"]: [texts[r["doc_id"]][s["start"] : s["stop"]] for s in r["spans"] if not s["base"]] for r in found.collect()}
    assert extra[len(ODD) + 3] == [rnd] and not extra[len(ODD) + 5]
    masked = by_id(secret_scan.redact(documents(spark, texts)))
    assert masked[len(ODD) + 3]["text"] == "see [SECRET] here" and masked[len(ODD) + 3]["n_chars"] == 17 and masked[0]["text"] is None


def test_secrets_beside_words_identifiers_and_digests(spark):
    rng = random.Random(10)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choice(letters) for _ in range(24)) for _ in range(10)]
    upper = ["".join(rng.choice("0123456789ABCDEF") for _ in range(n)) for n in (32, 40, 64)]
    uuid = "123e4567-e89b-12d3-a456-426614174000"
    texts = [f"{before}{k}{after}" for before, after in [("at example.com/services/T00000000/B00000000/", " x"), ("some_long_name_for_customers=", ""), (f"{uuid}/", "")] for k in keys] + [f"see {h} now" for h in upper]
    want = keys * 3 + upper
    plain = [f"http://example.org/files/{upper[1]}", f"checksum: {upper[0]}", f"id {uuid} only", "some_long_name_for_customers_and_services_2024"]
    found = by_id(secret_scan.find_secrets(documents(spark, texts + plain)))
    got = [[texts[i][s["start"] : s["stop"]] for s in found[i]["spans"] if not s["base"]] for i in range(len(texts))]
    assert got == [[w] for w in want]
    assert not any(found[len(texts) + i]["spans"] for i in range(len(plain)))


@pytest.mark.parametrize("rows", [10**6, 5])
def test_token_counts_equal_the_library(spark, rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(token_counts.vocabulary_path())
    tok.no_padding(), tok.no_truncation()
    rng = random.Random(9)
    texts = [*ODD, prose(rng, 300), "<|startoftext|> a<|endoftext|>b", "Ünï’s it's 12345 ٣٤ 漢字 ­ é é  x", "A" * 5000, prose(rng, 3000)]
    got = by_id(token_counts.token_counts(documents(spark, texts).union(documents(spark, texts[:2])), broadcast_rows=rows))
    for i, t in enumerate(texts):
        n = len(tok.encode(t or "", add_special_tokens=False))
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((t or "").encode()), n, n > 2048), i
    assert token_counts.token_counts(documents(spark, texts).limit(0)).count() == 0


def test_shingle_helper():
    assert shingles("A b", 3) == {("a", "b")}
