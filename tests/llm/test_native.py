"""Fingerprints, URL rules and components against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import unicodedata

import xxhash

from pyspark.sql import functions as F

from tidewatch.llm import common, fingerprint, url_filter

TEXTS = ["", None, "Hello  World", "hello world ", "ﬁne Ⅷ", "FINE viii", "Straße", "STRASSE", "x" * 70_000, "é", "e\u0301", "a\u00a0b", "a b", "日本語テキスト", "日本語テキスト"]


def _canon(text):
    text = text or ""
    if any(c > "\x7f" for c in text):
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    else:
        text = text.lower()
    return re.sub(r"[\s]+", " ", text).strip(" ")


def _wide(canon):
    first = xxhash.xxh64_intdigest(canon.encode(), 42)
    second = xxhash.xxh64_intdigest(canon.encode(), xxhash.xxh64_intdigest(b"tidewatch", 42))
    return f"{first:016x}{second:016x}"


def test_fingerprint_edits(spark):
    rows = [(i * 7 - 20, t) for i, t in enumerate(TEXTS)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, 9, "z") for r in rows], "doc_id long, text string, canon int, wide string")
    got = {r.doc_id: r for r in fingerprint.fingerprint_edits(df).collect()}
    rows.sort()
    assert len(got) == len(rows)
    for i, (doc, text) in enumerate(rows):
        text, follower = text or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(text) // 4
        edited = text[: len(text) - k] + follower[:k]
        want = _wide(_canon(text)), _wide(_canon(edited)), _wide(_canon(follower))
        assert (got[doc].fingerprint, got[doc].edited_fingerprint) == want[:2]
        assert got[doc].n_chars == len(text)
        assert got[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[doc].near_edited, got[doc].near_next) == (float(want[0] == want[1]), float(want[0] == want[2]))


def test_follower_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "BUCKET_ROWS", 3)
    ids = sorted(random.Random(2).sample(range(-1000, 1000), 50))
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = {r.doc_id: r.next_text for r in fingerprint.with_follower(df, ["text"]).collect()}
    assert got == {i: f"t{j}" for i, j in zip(ids, ids[1:] + ids[:1], strict=True)}


def test_a_far_id_leaves_the_buckets_even(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "BUCKET_ROWS", 50)
    ids = [*range(100, 2100), 10**15, -(10**15), 2**62]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids] + [(None, "n")], "doc_id long, text string")
    bounds = fingerprint._bounds(df, df.count())
    sizes = sorted(r["count"] for r in df.where("doc_id IS NOT NULL").groupBy(fingerprint._bucket(F.col("doc_id"), bounds)).count().collect())
    assert len(sizes) > 20 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    got = {r.doc_id: r.next_text for r in fingerprint.with_follower(df, ["text"]).collect()}
    order = [None, *sorted(ids)]
    assert got == {i: "n" if j is None else f"t{j}" for i, j in zip(order, order[1:] + order[:1], strict=True)}


def test_mixed_bucket_is_told_apart(spark):
    named = spark.createDataFrame([("w", "1"), ("w", "2"), ("v", "1"), ("v", "1"), ("u", "3"), ("u", "3")], "wide string, sha string")
    texts = spark.createDataFrame([("w", "a"), ("w", "a"), ("v", "b"), ("v", "b"), ("u", "c"), ("u", "d")], "wide string, canon string")
    assert {r.wide for r in fingerprint.mixed_buckets(named, texts).collect()} == {"w", "u"}


def test_fingerprint_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "A"), (None, "a"), (1, "a "), (2, None), (2, "")], "doc_id long, text string")
    got = fingerprint.fingerprint_texts(df).collect()
    assert sorted(r.n_copies for r in got) == [2, 2, 3, 3, 3]
    assert len(fingerprint.fingerprint_edits(df).collect()) == 5
    empty = df.limit(0)
    assert fingerprint.fingerprint_texts(empty).collect() == []
    assert fingerprint.fingerprint_edits(empty).collect() == []


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("example.com", "/de/x", "allow")]
URLS = ["http://a.example.net/en/1", "https://A.Example.NET/de/1?x", "http://net", "http://net/", "http://example.com/de/xy", "http://example.com/de", "http://fake-example.com/de/", "http://x.org/fr/#a", "http://x.org?fr/", None, "", "nothing", "a://b://net/", "http:///net/", "http://x.net\n/"]


def _judge(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def test_urls(spark):
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] + [(None, URLS[0], "h")], "page_id long, url string, host string")
    got = url_filter.judge_urls(df, RULES).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        assert tuple(r)[1:] == _judge(URLS[r.page_id or 0])
    assert url_filter.judge_urls(df.limit(0), RULES).collect() == []
    assert {r.verdict for r in url_filter.judge_urls(df, []).collect()} == {"allow"}


def test_url_rules_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BROADCAST_RULE_BYTES", 0)
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    assert all(tuple(r)[1:] == _judge(URLS[r.page_id]) for r in url_filter.judge_urls(df, RULES).collect())


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1080)] + [(5, 5), (None, 3)]
    parent = list(range(1100))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = {x for a, b in pairs if a is not None and a != b for x in (a, b)}
    assert got == {x: find(x) for x in nodes}
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_left_join_of_hot_keys(spark, monkeypatch):
    rows = [(i, i % 7 if i % 3 else 100) for i in range(90)] + [(90, 55)]
    table = [(k, k * 10) for k in (0, 1, 2, 3, 4, 100)]
    a, b = spark.createDataFrame(rows, "id long, k long"), spark.createDataFrame(table, "k long, v long")
    want = sorted((i, k, dict(table).get(k)) for i, k in rows)
    key = lambda r: (r[0], r[1])
    for shares in (1, 4, 12, 1000):
        monkeypatch.setattr(common, "SHARES", shares)
        got = common.left_join_hot(a, b, "k").select("id", "k", "v").collect()
        assert sorted(map(tuple, got), key=key) == want
    assert common.left_join_hot(a.limit(0), b, "k").collect() == []
