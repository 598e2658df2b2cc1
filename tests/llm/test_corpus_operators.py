"""The corpus operators against plain Python over the whole of a small table."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tierworks.llm import (
    ann, components, exact_dedup, langid, licenses, linear, mixing, packing, pii, pii_base, quality,
    simhash, urls,
)


@pytest.fixture
def rng():
    return random.Random(11)


DOC = "doc_id long, text string, lang string, source string, n_chars long"
WS = re.compile(r"[\x20\x09-\x0D]")


def docs(spark, texts, sources=None, langs=None):
    sources, langs = sources or {}, langs or {}
    rows = [
        (i, t, langs.get(i, "en"), sources.get(i, f"s{i % 3}"), None if t is None else len(t))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOC)


TEXTS = [
    "a b c d", "abcd", " a\tb\ncd ", "", None, "  ", "x" * 5000, "x" * 5000, "one two three",
    "one  two three", "One two three", "zzz é", "zzz é", "zzzé ",
]


# exact duplicates

def brute_groups(rows):
    by = defaultdict(list)
    for doc_id, text in rows:
        by[WS.sub("", text or "")].append((-len(text or ""), doc_id))
    expected = {}
    for key, members in by.items():
        keep = min(members)[1]
        sha = hashlib.sha256(key.encode()).hexdigest()
        for _, doc_id in members:
            expected[doc_id] = (keep, len(members), doc_id == keep, sha)
    return expected


@pytest.mark.parametrize("counters", [1, 3, 1000])
def test_exact_groups(spark, counters):
    found = exact_dedup.groups(docs(spark, TEXTS * 3), counters=counters).collect()
    expected = brute_groups(enumerate(TEXTS * 3))
    assert {r["doc_id"]: tuple(r)[1:] for r in found} == expected
    assert len(found) == len(TEXTS) * 3


@pytest.mark.parametrize("counters", [1, 1000])
def test_exact_keep_rows(spark, counters):
    frame = docs(spark, TEXTS * 3)
    expected = {k for k, v in brute_groups(enumerate(TEXTS * 3)).items() if v[2]}
    kept = exact_dedup.keep_rows(frame, counters=counters)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)


def test_exact_repeated_rows_and_clashing_names(spark):
    frame = docs(spark, ["same", "same"]).withColumn("doc_id", F.lit(7).cast("long"))
    frame = frame.union(frame).withColumn("digest", F.lit(1)).withColumn("best", F.lit("b"))
    frame = frame.withColumn("row", F.lit("r"))
    found = exact_dedup.groups(frame).collect()
    assert [r["kept"] for r in found].count(True) == 1 and len(found) == 4
    kept = exact_dedup.keep_rows(frame)
    assert kept.count() == 1 and kept.columns == frame.columns


def test_exact_null_ids(spark):
    frame = spark.createDataFrame([(None, "t"), (3, "t"), (None, "u")], "doc_id long, text string")
    found = {(r["doc_id"], r["keep_id"], r["kept"]) for r in exact_dedup.groups(frame).collect()}
    assert found == {(3, 3, True), (None, 3, False), (None, None, True)}


@pytest.mark.parametrize("counters", [1, 1000])
def test_exact_keep_rows_of_null_and_repeated_ids(spark, counters):
    """One row of each text stays, however often a row or an id is repeated."""
    given = [(None, "t"), (3, "t"), (None, "u"), (None, "u"), (4, "t "), (4, "t ")]
    given += [(9, "hot")] * 50 + [(8, "h o t")] * 2 + [(5, None), (None, "")]
    frame = spark.createDataFrame(given, "doc_id long, text string")
    kept = exact_dedup.keep_rows(frame, counters=counters).collect()
    assert {tuple(r) for r in kept} == {(4, "t "), (None, "u"), (8, "h o t"), (5, None)}
    assert len(kept) == 4


def test_misra_gries_finds_every_frequent_digest():
    import pandas as pd
    values = ["hot"] * 400 + [f"v{i}" for i in range(600)]
    frames = [pd.DataFrame({"digest": values[i::7]}) for i in range(7)]
    [summary] = exact_dedup.misra_gries(4)(iter(frames))
    assert "hot" in set(summary["digest"]) and len(summary) <= 4
    assert summary["seen"].sum() <= len(values)


# licenses

def brute_licenses(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places, labels = [], set()
    for label, phrase in licenses.BASE_TEMPLATES:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)))


LICENSED = [
    "Licensed under CC BY-NC 4.0. All rights reserved. CC BY cc-by",
    "This work is licensed under the GNU General Public License, version 3.",
    "all rights\nRESERVED all rights reserved all  rights, reserved",
    "all rights are reserved; general public, license; generalpublic license",
    "ccby cc 1 by", "", None, "word " * 3000 + "cc by", "KK ccé by CC BY",
    "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.",
    "Permission is hereby granted, free of charge, to any person who is obtaining a copy of this "
    "software and its associated documentation files to deal in the Software without restriction",
    "the license of the work is under the name of the person",
]


def test_license_scan(spark):
    found = {r["doc_id"]: r for r in licenses.scan(docs(spark, LICENSED)).collect()}
    assert len(found) == len(LICENSED)
    for i, text in enumerate(LICENSED):
        r = found[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"],
                r["base_labels"]) == brute_licenses(text), text
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1
    assert found[9]["labels"] == "mit" and found[10]["labels"] == "apache-2.0"
    assert found[11]["labels"] == "mit" and found[12]["labels"] == ""
    assert found[1]["labels"] == "gpl,gpl-3.0"


def test_license_among_repeated_phrases(spark):
    """Votes of a phrase that is repeated close by do not hide the notice among them."""
    chain = "the mit license " * 60
    texts = [chain + "released under the mit license " + chain, chain, "released the mit " * 40]
    found = {r["doc_id"]: r for r in licenses.scan(docs(spark, texts)).collect()}
    assert found[0]["labels"] == "mit" and found[0]["score"] == 1
    assert found[1]["labels"] == "" and found[2]["labels"] == ""


def test_license_repeated_rows(spark):
    frame = docs(spark, ["cc by"]).union(docs(spark, ["cc by"])).withColumn("pos", F.lit(1))
    assert [r["n_base"] for r in licenses.scan(frame).collect()] == [1, 1]


# urls

def brute_url(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for name, verdict in urls.BASE_RULES:
        rule_host, _, rule_path = name.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rule_path):
            if best is None or len(name) > len(best[0]):
                best = (name, verdict)
    return host, path, best


URLS = [
    "http://www.Example.com/en/x?q#f", "https://example.com/en", "https://a.example.com/en/",
    "http://xcom/", "http://x.com", "http://x.com/", "HTTP://NET/es/1", "http://a.net/fr/x",
    "http://a.net/ES/1", "ftp://a.net/de/", "noscheme", None, "", "http://casino.org/a",
    "http://best-casino.win.org/a", "http://spam-farm.example.net/en/1", "http://x.org/login",
    "http://x.org/file.exe", "http://a.com://b.net/es/", "http://a.net?x/es/", "://com/",
    "http://examplé.com/en/", "http://a.com/casino", "http://WWW.EXAMPLE.COM/en/", "http:// b.net/fr/",
    "http://a\n.com/x", "http://a.net/login\n", "http://a.net/x.zip\n", "http://a.net/x.zip", "http://www.example.com/en/" + "y" * 30000,
    "http://free-bets.org/", "http://bets.org/free", "http://x.org/wp-admin/a", "http://x.org/a/wp/admin/",
    "http://x.org/tag/red/page/2", "http://x.org/tag/red/blue/page/2", "http://x.org/Klogin/", "http://x.org/İ/cgi-bin/",
]


def test_url_rules(spark):
    frame = spark.createDataFrame(list(enumerate(URLS * 2)), "page_id long, url string")
    rules = urls.rule_table(spark, urls.production_rules())
    found = {r["page_id"]: r for r in urls.judged(frame, rules).collect()}
    assert len(found) == len(URLS) * 2
    for i, url in enumerate(URLS):
        host, path, best = brute_url(url)
        r = found[i]
        assert (r["host"], r["path"]) == (host, path), url
        assert r["rule"] == (best and best[0]), url
        if best:
            assert r["verdict"] == best[1]
    blocked = {URLS[i] for i in range(len(URLS)) if found[i]["pattern_rule"]}
    assert blocked == {
        "http://casino.org/a", "http://best-casino.win.org/a", "http://spam-farm.example.net/en/1",
        "http://x.org/login", "http://x.org/file.exe", "http://a.net/x.zip",
        "http://free-bets.org/", "http://x.org/wp-admin/a", "http://x.org/tag/red/page/2",
        "http://x.org/İ/cgi-bin/",
    }


def test_url_rules_give_what_running_every_pattern_gives(spark):
    rules = urls.production_rules()
    parts = ["casino", "free", "bets", "wp", "admin", "tag", "page", "login", "zip", "net", "es"]
    made = [f"http://{a}{x}{b}{y}{c}" for a in parts[:4] for b in parts for c in parts
            for x, y in ((".", "/"), ("-", "."), ("/", "/red/"), (".net/", "."))]
    frame = spark.createDataFrame(list(enumerate(URLS + made)), "page_id long, url string")
    found = {r["page_id"]: r for r in urls.judged(frame, urls.rule_table(spark, rules)).collect()}
    for i, url in enumerate(URLS + made):
        target = found[i]["host"] + found[i]["path"]
        fits = [r for r in rules if re.search(r.pattern.replace(r"\z", r"\Z"), target)]
        best = min(fits, key=lambda r: (-r.priority, -len(r.name), r.name), default=None)
        assert (found[i]["rule"] or found[i]["pattern_rule"]) == (best and best.name), url


def test_url_tokens_come_from_the_literals():
    rule = urls.pattern_rule("r", "block", "ads/Banner-12/x", urls.SEGMENT, "y/img.gif", urls.END)
    assert rule.tokens == ["banner", "12", "img", "gif"]
    assert urls.host_path_rule("a.com/en/pa", "block").tokens == ["a", "com", "en"]
    assert urls.pattern_rule("r", "block", "open").tokens == []
    assert all(r.tokens for r in urls.production_rules())


def test_url_repeated_rows(spark):
    frame = spark.createDataFrame([(1, "http://a.com/")] * 3 + [(None, None)] * 2 + [(1, "http://a.com/?q")],
                                  "page_id long, url string")
    found = urls.judged(frame, urls.rule_table(spark, urls.production_rules())).collect()
    assert Counter((r["page_id"], r["rule"]) for r in found) == {(1, "com/"): 4, (None, None): 2}


# mixing

def brute_targets(sizes, weights=(5, 2, 1), epochs=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    target, total = {}, sum(sizes.values())
    full = set()
    while True:
        open_ = [s for s in order if s not in full]
        if not open_:
            break
        level = (total - sum(epochs * sizes[s] for s in full)) / sum(w[s] for s in open_)
        above = {s for s in open_ if w[s] * level > epochs * sizes[s]}
        if not above:
            target |= {s: w[s] * level for s in open_}
            break
        full |= above
    return target | {s: float(epochs * sizes[s]) for s in full}


def test_mixing(spark, rng):
    texts = ["w " * rng.choice([0, 1, 5, 40, 400]) for _ in range(300)] + [None, "w " * 20000]
    sources = {i: rng.choice(["a", "b", "c", "d", None, "é", "z", "hot", "hot", "hot"])
               for i in range(len(texts))}
    frame = docs(spark, texts, sources).repartition(5)
    found = mixing.taken(frame).collect()
    assert sorted(tuple(r) for r in mixing.taken(frame.coalesce(1)).collect() if r["source"]) == sorted(
        tuple(r) for r in found if r["source"])
    assert len(found) == len(texts)
    size = {i: len((t or "").split()) for i, t in enumerate(texts)}
    by_source = Counter()
    for i, n in size.items():
        by_source[sources[i]] += n
    wanted = brute_targets(by_source)
    got = Counter()
    for r in found:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == by_source[r["source"]]
        assert r["target"] == pytest.approx(wanted[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        got[r["source"]] += r["taken"]
    for s, t in wanted.items():
        assert got[s] == int(t + 1e-9), s


def test_mixing_in_many_stretches(spark, rng, monkeypatch):
    """Small ranges and stretches give the same rows as one range for all."""
    texts = ["w " * rng.choice([0, 1, 5, 40, 400]) for _ in range(400)]
    frame = docs(spark, texts, {i: "hot" for i in range(150)})
    whole = sorted(tuple(r) for r in mixing.taken(frame).collect())
    monkeypatch.setattr(mixing, "RANGE_ROWS", 3)
    monkeypatch.setattr(mixing, "STRETCH", 4)
    assert sorted(tuple(r) for r in mixing.taken(frame).collect()) == whole


def test_mixed_rows(spark, rng):
    texts = ["w " * rng.choice([1, 5, 40]) for _ in range(200)]
    frame = docs(spark, texts).withColumn("copies", F.lit("x")).withColumn("key", F.lit(1))
    mixed = mixing.mixed_rows(frame)
    assert mixed.columns == frame.columns
    copies = Counter(r["doc_id"] for r in mixed.collect())
    for r in mixing.taken(frame).collect():
        assert abs(copies[r["doc_id"]] - r["taken"] / r["size"]) <= 0.5


def test_mixing_repeated_ids(spark):
    frame = docs(spark, ["a b c"] * 50).withColumn("doc_id", F.lit(1).cast("long"))
    found = mixing.taken(frame).collect()
    assert all(r["taken"] <= 9 for r in found) and len(found) == 50


# packing

def check_bins(found, capacity, per_source):
    bins = defaultdict(list)
    for r in found:
        if r["length"]:
            bins[r["bin_id"]].append(r)
        else:
            assert r["bin_id"] is None
    for members in bins.values():
        assert sum(r["length"] for r in members) <= capacity
        clusters = [r["cluster"] for r in members if r["cluster"] is not None]
        assert len(clusters) == len(set(clusters))
        assert max(Counter(r["source"] for r in members).values()) <= per_source
        assert sorted(r["place"] for r in members) == list(range(len(members)))
    return bins


def test_packing(spark, rng):
    rows = [(i if i else None, rng.choice([0, 3, 10, 33, 100, 257]), rng.choice(["a", "b", None]),
             rng.choice(["k1", "k2", None, f"u{i}"])) for i in range(400)]
    rows += [rows[5]] * 7
    items = spark.createDataFrame(rows, "doc_id long, size long, source string, cluster string")
    found = packing.pack(items, capacity=100, per_source=3, shard_rows=64).collect()
    check_bins(found, 100, 3)
    words = Counter()
    for r in found:
        words[(r["doc_id"], r["source"], r["cluster"])] += r["length"]
    expected = Counter()
    for doc_id, size, source, cluster in rows:
        expected[(doc_id, source, cluster)] += size
    assert words == expected
    pieces = [(r["doc_id"], r["copy"], r["piece"]) for r in found if r["doc_id"] not in (5, None)]
    assert len(pieces) == len(set(pieces))


def test_packing_keeps_large_ids_beside_null_ones(spark):
    rows = [(None, 5, "a", None), (2**62 + 1, 5, "a", None), (2**62 + 3, 5, "b", "k")]
    items = spark.createDataFrame(rows, "doc_id long, size long, source string, cluster string")
    assert {r["doc_id"] for r in packing.pack(items).collect()} == {None, 2**62 + 1, 2**62 + 3}


def test_best_fit_takes_the_tightest_compatible_bin(rng):
    capacity, per_source = 50, 2
    items = sorted(((rng.randint(1, 30), rng.randint(0, 2), rng.randint(-1, 3)) for _ in range(300)),
                   reverse=True)
    chosen = packing.best_fit(*zip(*items), capacity, per_source)
    room, inside = {}, defaultdict(list)
    for (length, source, cluster), b in zip(items, chosen):
        fits = [
            k for k in room if room[k] >= length
            and (cluster < 0 or cluster not in [c for _, c in inside[k]])
            and sum(s == source for s, _ in inside[k]) < per_source
        ]
        if fits:
            assert room[b] == min(room[k] for k in fits) and b in fits
        else:
            assert b not in room
        room[b] = room.get(b, capacity) - length
        inside[b].append((source, cluster))


# quality

def test_quality(spark, rng):
    good = [" ".join(rng.choice(["the", "of", "tree", "Water", "runs."]) for _ in range(60)) for _ in range(300)]
    bad = [" ".join(w + "***" for w in t.split()) for t in good[:60]]
    bad += [" ".join([t.split()[0]] * 60) for t in good[:60]]
    texts = good + bad + [None, "", "ok"]
    frame = docs(spark, texts)
    labels = spark.createDataFrame(
        [(i, int(i < 300)) for i in range(420) if i % 2], "doc_id long, quality int")
    found = {r["doc_id"]: r for r in quality.scores(frame, labels).collect()}
    right = [found[i]["keep"] == (i < 300) for i in range(420) if i % 2 == 0]
    assert sum(right) / len(right) > 0.97 and len(found) == len(texts)
    kept = quality.keep_rows(frame.withColumn("score", F.lit(1)).withColumn("row", F.lit(2)), labels)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in found.items() if r["keep"]}


def test_quality_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    found = quality.scores(docs(spark, ["a", None]), none).collect()
    assert [(r["score"], r["keep"]) for r in found] == [(1.0, True)] * 2


def test_quality_pool_is_drawn_from_documents_without_a_label(spark):
    frame = docs(spark, ["a b"] * 60)
    known = spark.createDataFrame([(i, 1.0) for i in range(50)], "doc_id long, quality double")
    some = known.filter("doc_id < 20")
    ids = lambda pool: {r["doc_id"] for r in quality.pool_ids(frame, known, some, pool).collect()}
    assert ids(10) == set(range(50, 60))
    assert len(ids(25)) == 25 and set(range(50, 60)) < ids(25) and not ids(25) & set(range(20))
    assert ids(100) == set(range(20, 60))


def test_co_training_hands_labels_over():
    rng = np.random.default_rng(3)
    y = (rng.random(400) < 0.5).astype(float)
    views = [rng.normal(size=(400, 2)) + 3 * y[:, None], rng.normal(size=(400, 3)) + 2 * y[:, None]]
    pool_y = (rng.random(500) < 0.5).astype(float)
    pool = [rng.normal(size=(500, 2)) + 3 * pool_y[:, None], rng.normal(size=(500, 3)) + 2 * pool_y[:, None]]
    model = quality.co_train(views, y, pool)
    assert ((model.score(*pool) > 0.5) == pool_y).mean() > 0.97


def test_text_view_sees_words():
    same = [
        ("god is love and dog", "dog is vole and god"),
        ("the cat sat on a mat", "tar tas cat on a hem"),
        ("one two three four", "four three two one"),
    ]
    for a, b in same:
        x, y = quality.text_features(a), quality.text_features(b)
        assert len(x) == quality.TEXT_FEATURES and not np.allclose(x, y)
    assert not quality.text_features(None).any() and np.isfinite(quality.text_features("a")).all()


def test_content_features_against_a_plain_loop(monkeypatch):
    text = "Ä word and a Word " * 9 + "end"
    raw, mask = text.encode(), 2**32 - 1
    hashed = [zlib.crc32(w.lower()) for w in raw.split()]
    pairs = [(a * 0x9E3779B1 & mask) ^ b for a, b in zip(hashed, hashed[1:])]
    low = raw.lower()
    grams = [int.from_bytes(low[i : i + 3], "big") * 0x9E3779B1 & mask for i in range(len(low) - 2)]
    expected = []
    for values, shift, size in (
        (hashed, 8, quality.WORD_BUCKETS), (pairs, 8, quality.PAIR_BUCKETS), (grams, 16, quality.GRAM_BUCKETS)
    ):
        counts = Counter((v >> shift) % size for v in values)
        expected += [(counts[i] / len(values)) ** 0.5 for i in range(size)]
    for size in (1 << 20, 7):  # the trigrams across a cut are counted once
        monkeypatch.setattr(quality, "GRAM_BYTES", size)
        assert np.allclose(quality.content_features(raw, raw.split()), expected)


def test_pseudo_labels_keep_the_share_of_classes():
    sure = np.concatenate([np.linspace(0.96, 0.999, 900), np.linspace(0.001, 0.04, 60), np.full(40, 0.5)])
    given = {}
    for _ in range(3):
        fresh = quality.most_confident(sure, given, 0.8)
        assert Counter(fresh.values()) == {1.0: 40, 0.0: 10} and not set(fresh) & set(given)
        given |= fresh
    # Most confident first, of each class.
    assert {i for i, v in given.items() if v} == set(range(780, 900))
    assert {i for i, v in given.items() if not v} == set(range(900, 930))
    assert quality.most_confident(np.full(5, 0.5), {}, 0.5) == {}


def test_rounds_help_when_labels_are_few():
    def sample(rng, n):
        y = (rng.random(n) < 0.8).astype(float)
        return y, [rng.normal(size=(n, 60)) + 0.3 * y[:, None], rng.normal(size=(n, 3)) + 2.2 * y[:, None]]

    caught = {0: [], 12: []}
    for seed in range(12):
        rng = np.random.default_rng(seed)
        y, views = sample(rng, 280)
        _, pool = sample(rng, 3000)
        truth, held = sample(rng, 4000)
        for rounds in caught:
            model = quality.co_train(views, y, pool, rounds)
            if model:
                text = linear.sigmoid(model.text.raw(held[0])) > 0.5
                caught[rounds].append((text[truth > 0].mean() + 1 - text[truth == 0].mean()) / 2)
    assert len(caught[0]) == len(caught[12]) >= 8
    assert np.mean(caught[12]) > np.mean(caught[0]) + 0.02


def test_a_view_that_knows_nothing_hands_nothing_over():
    for seed in range(5):
        rng = np.random.default_rng(seed)
        y, pool_y = (rng.random(800) < 0.85).astype(float), (rng.random(900) < 0.85).astype(float)
        views = [rng.normal(size=(800, 4)) + 2 * y[:, None], rng.normal(size=(800, 6))]
        pool = [rng.normal(size=(900, 4)) + 2 * pool_y[:, None], rng.normal(size=(900, 6))]
        alone, after = quality.co_train(views, y, pool, 0), quality.co_train(views, y, pool, 6)
        assert np.array_equal(alone.text.weights, after.text.weights)
        assert not np.array_equal(alone.metadata.weights, after.metadata.weights)


def test_calibration_and_combination_against_plain_descent():
    rng = np.random.default_rng(4)
    y = (rng.random(300) < 0.6).astype(float)
    views = [rng.normal(size=(300, 2)) + y[:, None], rng.normal(size=(300, 2)) + 0.8 * y[:, None]]
    model = quality.co_train(views, y, [v[:0] for v in views])
    held = np.arange(300) % 4 == 3

    def descent(x, target):  # ridge as in linear.fit, one row after the other
        w = [0.0] * (x.shape[1] + 1)
        for _ in range(4000):
            slope = [1e-3 * len(x) * v for v in w[:-1]] + [1e-6 * w[-1]]
            p = 1 / (1 + np.exp(-(x @ np.array(w[:-1]) + w[-1]))) - target
            for k in range(x.shape[1]):
                slope[k] += float((p * x[:, k]).sum())
            slope[-1] += float(p.sum())
            w = [v - 0.02 * g for v, g in zip(w, slope)]
        return np.array(w)

    smooth = np.where(y[held] > 0, 1 - 1 / (y[held].sum() + 2), 1 / ((1 - y[held]).sum() + 2))
    raws = [m.raw(v[held])[:, None] for m, v in zip((model.text, model.metadata), views)]
    plain = [descent(r, smooth) for r in raws]
    for m, w in zip((model.text, model.metadata), plain):
        assert np.allclose(m.calibration, w, atol=1e-3)
    both = np.hstack([r * w[0] + w[1] for r, w in zip(raws, plain)])
    assert np.allclose(model.combined, descent(both, y[held]), atol=1e-3)


# language

def test_network_learns(rng):
    words = {"en": ["the", "and", "with", "house"], "de": ["der", "und", "mit", "straße"]}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n)).encode()
    langs = ["en", "de"] * 100
    net = langid.fit(np.concatenate([langid.cut(text(x, 12))[:1] for x in langs]), langs, steps=80)
    texts = [text(x, 300).decode() for x in langs] + [None, "", "123 !!"]
    found, score = langid.predict(net, texts)
    assert found[:200] == langs and found[200:] == ["und"] * 3
    assert all(0 <= s <= 1 for s in score)


def test_language_held_out(spark):
    frame = spark.range(200).withColumnRenamed("id", "doc_id")
    import zlib
    for r in frame.select("doc_id", langid.held_out().alias("h")).collect():
        assert r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


def test_rare_languages_stay_in_the_training_windows(spark):
    # Sampled rows of the frequent language come first by the order of ids.
    rows = [("en", bytes([i % 250]), i, 0) for i in range(50)]
    rows += [(lang, b"w", 1000 + i, 0) for i, lang in enumerate(["fi", "sv", "sv"])]
    frame = spark.createDataFrame(rows, "lang string, window binary, order long, at int")
    for most, expected in ((100, (50, 1, 2)), (10, (7, 1, 2)), (2, (1, 1, 1))):
        found = [r["lang"] for r in langid._evenly(frame, most).collect()]
        assert tuple(map(found.count, ("en", "fi", "sv"))) == expected


def test_a_rare_language_among_empty_texts_is_learned(spark):
    rows = [(i, None if i % 2 else "...", "fi", "s", 0) for i in range(20_000)]
    rows += [(30_000 + i, "hyvaa paivaa kaikille talossa " * 6, "fi", "s", 0) for i in range(60)]
    rows += [(40_000 + i, "the house on the hill was quiet " * 6, "en", "s", 0) for i in range(300)]
    net = langid.train(spark.createDataFrame(rows, DOC))
    assert net.languages == ["en", "fi"]
    found, _ = langid.predict(net, ["hyvaa paivaa talossa", "the quiet house"])
    assert found == ["fi", "en"]


def test_language_nothing_to_learn(spark):
    frame = docs(spark, ["abc", None]).withColumn("lang", F.lit(None).cast("string"))
    assert langid.train(frame) is None
    assert {r["lang_pred"] for r in langid.identify(frame, None).collect()} == {"und"}


# nearest vectors

def test_nearest(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 16))
    x[300:420] = x[300]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2100, [1.0] * 3), (2003, []),
             (2004, [None] + [1.0] * 15), (500, x[500].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = ann.clean(frame)
    assert vectors.count() == 900
    found = ann.nearest_neighbours(vectors, vectors.filter("vec_id % 100 = 0")).collect()
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    hits = 0
    for q in range(0, 900, 100):
        every = sorted((float(np.sqrt(((x[q] - x[i]) ** 2).sum())), i) for i in range(900) if i != q)[:10]
        assert len(got[q]) == 10 and got[q] == sorted(got[q])
        hits += len({i for _, i in every} & {i for _, i in got[q]})
        for s, i in got[q]:
            assert s == pytest.approx(float(np.sqrt(((x[q] - x[i]) ** 2).sum())), abs=1e-12)
    assert hits >= 0.9 * 90
    assert [i for _, i in got[300]] == list(range(301, 311))


def test_closeness_is_the_footrule_of_cut_orders():
    rng = np.random.default_rng(6)
    vectors, pivots, depth = rng.normal(size=(60, 5)), rng.normal(size=(12, 5)), 4
    order = ann.orders(vectors, pivots, depth)
    for x, row in zip(vectors, order):
        assert list(row) == sorted(range(12), key=lambda p: ((x - pivots[p]) ** 2).sum())[:depth]
    lists = ann.inverted_file(order, 12)
    assert sum(len(rows) for rows, _ in lists) == 60 * depth
    for query in order[:10]:
        found = ann.closeness(lists, query, 60, depth)
        for row, near in zip(order, found):
            place = lambda of, p: list(of).index(p) if p in of else depth
            footrule = sum(abs(place(row, p) - place(query, p)) for p in range(12))
            assert footrule == depth * (depth + 1) - 2 * near


def test_nearest_among_few_met(spark):
    """Vectors that share no list with a query still fill up a short result."""
    rng = np.random.default_rng(8)
    x = np.vstack([rng.normal(size=(4, 3)), 50 + rng.normal(size=(8, 3))])
    found = ann.search_segment(np.arange(12), x, np.array([0]), x[:1], x[[0, 11]], 10, 0.1)
    assert len(found) == 10 and set(found["vec_id"][:3]) == {1, 2, 3}


def test_nearest_few(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 3.0])], "vec_id long, embedding array<float>")
    vectors = ann.clean(frame)
    found = ann.nearest_neighbours(vectors, vectors.filter("vec_id % 100 = 0")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found] == [(0, 1, 1, 1.0)]


# near duplicates

def brute_print(text, size=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    if words and not grams:
        grams = [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in prints:
        for j in prints:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in prints}


@pytest.mark.parametrize("tile_rows", [10, 65536])
def test_simhash(spark, rng, tile_rows):
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(300)) for _ in range(12)]
    texts = []
    for t in base:
        words = t.split()
        for k in range(8):
            w = list(words)
            for _ in range(k // 2):
                w[rng.randrange(len(w))] = "zz"
            texts.append(" ".join(w))
    texts += ["", None, "One", "one two", "a b  c", "A B c", "é É ü", "x " * 70000]
    frame = docs(spark, texts)
    found = simhash.near_components(simhash.fingerprints(frame), tile_rows=tile_rows)
    rows = found.select("doc_id", simhash.hexadecimal().alias("f"), "component_id").collect()
    prints = {i: brute_print(t) for i, t in enumerate(texts)}
    assert {r["doc_id"]: int(r["f"], 16) for r in rows} == prints
    assert all(len(r["f"]) == 16 for r in rows)
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute_components(prints)


@pytest.mark.parametrize("blocks,tile_rows", [(2, 40), (3, 25), (3, 10**6), (4, 100)])
def test_links_lose_nothing(spark, rng, blocks, tile_rows):
    values = []
    for _ in range(60):
        x = rng.getrandbits(64)
        for _ in range(4):
            values.append(x)
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
    values = sorted(set(values))
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    frame = spark.createDataFrame(signed, "print long")
    members = components.components(simhash.links(frame, blocks=blocks, tile_rows=tile_rows)).collect()
    found = {r["node"] % 2**64: r["root"] for r in members}
    expected = brute_components({v: v for v in values})
    groups = defaultdict(set)
    for v, r in expected.items():
        groups[r].add(v)
    seen = defaultdict(set)
    for v, r in found.items():
        seen[r].add(v)
    assert {frozenset(g) for g in seen.values()} == {frozenset(g) for g in groups.values() if len(g) > 1}


def test_simhash_keep_rows(spark):
    text = " ".join(f"w{i}" for i in range(400))
    frame = spark.createDataFrame(
        [(5, text), (3, text + " end"), (3, text + " end"), (9, "quite another text of its own"),
         (None, "nameless words stand here alone"), (None, "nameless words stand here alone"), (8, "")],
        "doc_id long, text string").withColumn("print", F.lit("p"))
    kept = simhash.keep_rows(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 3, 8, 9]


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)] + [(200, 200 + i) for i in range(1, 50)]
    found = {r["node"]: r["root"] for r in components.components(
        spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100} | {200 + i: 200 for i in range(50)}


# personal data

def brute_base(text):
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    found = []
    for rank, (kind, pattern) in enumerate(kinds.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10))
                       for k, d in enumerate(reversed(digits))) % 10 == 0
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0,
                  "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                found.append((m.start(), rank, m.end(), kind))
    return [(a, b, k) for a, _, b, k in sorted(found)]


PRIVATE = [
    "mail a.b@c.de, x@y, @z.de and p@q.r.s@t.uv a@b.c@d.e", "é +1 (988) 555-2485 at 1.2.3.4.5.6.7.8",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "0.0.0.256 1..2.3.4 01.002.3.4", "+12 +1 2 +123456789)",
    "1 2 3 4 5 6 7 8 9 0 1 2 3", "a@-.- %@x.y a@b..c", "", "+1234567890123456 12345678901234567890",
    "++44 20 7946 0958.", "4111111111111111@example.com 5.5.5.5@a.b", "9" * 3000 + "." + "8" * 3000,
    "a" * 4000 + "@" + "b" * 3000, "١٢ aéb@c.d",
]


@pytest.mark.parametrize("text", PRIVATE)
def test_base_spans(text):
    assert pii_base.base_spans(text) == brute_base(text)


def test_base_spans_at_random(rng):
    for _ in range(4000):
        text = "".join(rng.choice("ab1234567890@.-+ ()") for _ in range(rng.randint(1, 40)))
        assert pii_base.base_spans(text) == brute_base(text), text


@pytest.fixture(scope="module")
def field():
    return pii.fit(pii.labelled_rows())


def test_personal_data(spark, field):
    frame = docs(spark, PRIVATE + [None])
    rows = {r["doc_id"]: r for r in pii.find(frame, field).collect()}
    assert len(rows) == len(PRIVATE) + 1
    for i, text in enumerate(PRIVATE + [""]):
        base = brute_base(text)
        listed = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert rows[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        for k in pii_base.KINDS:
            assert rows[i][f"n_{k}"] == sum(s[2] == k for s in base)
        assert not base or set(listed.split(",")) <= set(rows[i]["spans"].split(","))


def test_personal_data_keeps_large_ids_beside_null_ones(spark, field):
    frame = spark.createDataFrame([(None, "a"), (2**62 + 1, "b@c.de")], "doc_id long, text string")
    found = {(r["doc_id"], r["spans"]) for r in pii.find(frame, field).collect()}
    assert found == {(None, ""), (2**62 + 1, "email:0:6")}


def test_field_adds_spans_and_leaves_clean_text_alone(field):
    decoder = pii.Decoder(field)
    texts = ["please phone (555) 010-2399 soon", "write to tom@intranet today, thanks",
             "card 4111.1111.1111.1111 was used", "The trees of 2019 and 2020 grew 12 feet.",
             "Licensed under CC BY-NC 4.0.", "see 2024-01-15 and chapter 3.2.1"]
    paths = decoder.decode([pii.words_of(t.encode()) for t in texts])
    found = [[t[a:b] for a, b, _ in pii.added_spans(t.encode(), p, [])] for t, p in zip(texts, paths)]
    assert found == [["(555) 010-2399"], ["tom@intranet"], ["4111.1111.1111.1111"], [], [], []]


@pytest.mark.parametrize("kind,text,parts", [
    ("phone", "(555) 010-2345, (555) 010-2346", ["(555) 010-2345", "(555) 010-2346"]),
    ("phone", "010-2345, 010-2346", ["010-2345", "010-2346"]),
    ("phone", "020 7946 0018 020 7946 0019", ["020 7946 0018", "020 7946 0019"]),
    ("phone", "+1 (555) 010-9876 +1 (555) 010-9877", ["+1 (555) 010-9876", "+1 (555) 010-9877"]),
    ("card", "4111 1111 1111 1111 5105 1051 0510 5100", ["4111 1111 1111 1111", "5105 1051 0510 5100"]),
    ("email", "root@localhost bob@intranet", ["root@localhost", "bob@intranet"]),
    ("ip", "10.0.0.1; 10.0.0.2", ["10.0.0.1", "10.0.0.2"]),
])
def test_neighbouring_spans_are_cut(kind, text, parts):
    path = np.full(len(text.split()), pii.LABELS.index(kind))
    found = pii.added_spans(text.encode(), path, [])
    assert [(text[a:b], k) for a, b, k in found] == [(p, kind) for p in parts]


def test_decoder_finds_the_best_path(field, rng):
    words = ["call", "+1", "(555)", "010-2345", "the", "a@b", "4111", "1.2.3.4", "x"]
    texts = [[rng.choice(words) for _ in range(rng.randint(1, 5))] for _ in range(40)]
    decoder = pii.Decoder(field)
    paths = decoder.decode([pii.words_of(" ".join(t).encode()) for t in texts])
    import itertools
    for t, path in zip(texts, paths):
        features = pii._token_features(pii.words_of(" ".join(t).encode()))
        unary = [field.weights[f].sum(axis=0) for f in features]
        value = lambda p: sum(u[k] for u, k in zip(unary, p)) + sum(
            field.follow[a, b] for a, b in zip(p, p[1:]))
        best = max(map(value, itertools.product(range(len(pii.LABELS)), repeat=len(t))))
        assert value(path.tolist()) == pytest.approx(best)


# empty tables

def test_long_contact_lists_take_linear_time(field):
    import time

    line = "mail anna.smith@example.org or (555) 010-2345, 555-010-7788; (c) (d) é 10.0.0.1 and "
    decoder = pii.Decoder(field)

    def spans(n):
        text = line * n
        raw, start = text.encode(), time.perf_counter()
        base = pii_base.base_spans(text)
        found = pii.added_spans(raw, decoder.decode([pii.words_of(raw)])[0], base)
        return found, time.perf_counter() - start, len(text)

    one, _, _ = spans(1)
    few, short, _ = spans(1000)
    many, long, size = spans(16000)
    assert one and len(many) == 16 * len(few) and len(few) >= 999 * len(one)
    assert size > 1_300_000 and long < 40 * short


def test_runs_of_numbers_are_cut_without_losing_a_span(field):
    text = "call " + ", ".join("(555) 010-2345" for _ in range(6000))
    raw = text.encode()
    assert pii.RUN + pii.UNIT < len(raw.split())
    found = pii.added_spans(raw, pii.Decoder(field).decode([pii.words_of(raw)])[0], [])
    assert [text[a:b] for a, b, _ in found] == ["(555) 010-2345"] * 6000
    assert {k for _, _, k in found} == {"phone"}


def test_empty_tables(spark, field):
    empty = spark.createDataFrame([], DOC)
    pages = spark.createDataFrame([], "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    vectors = ann.clean(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    items = spark.createDataFrame([], "doc_id long, size long, source string, cluster string")
    for frame in (
        exact_dedup.groups(empty), exact_dedup.keep_rows(empty), licenses.scan(empty),
        urls.judged(pages, urls.rule_table(spark, urls.production_rules())), mixing.taken(empty),
        mixing.mixed_rows(empty), packing.pack(items), quality.scores(empty, labels),
        langid.identify(empty, langid.train(empty)), ann.nearest_neighbours(vectors, vectors),
        simhash.near_components(simhash.fingerprints(empty)), simhash.keep_rows(empty),
        pii.find(empty, field),
    ):
        assert frame.collect() == []
