"""Operators without SQL against plain versions of what they compute."""

import base64
import hashlib
import io
import math
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from streamkit.llm import archives, fingerprints, license_scan, packing, quality_rules, sharding

SF = "/root/testdata/sf0.001"
M = (1 << 64) - 1


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


# ---------------------------------------------------------------- packing

def fewest_bins(lengths, size):
    """By trying every place for every piece."""
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= lengths[i]}.values():
            rooms[k] -= lengths[i]
            place(i + 1, rooms)
            rooms[k] += lengths[i]
        place(i + 1, rooms + [size - lengths[i]])
    place(0, [])
    return best[0]


def test_local_search_reaches_the_optimum_of_small_cases():
    rng = np.random.default_rng(11)
    for _ in range(250):
        size = int(rng.integers(5, 40))
        lengths = rng.integers(1, size, size=int(rng.integers(1, 12)))
        bins = packing.local_search(packing.best_fit(lengths, size), lengths, size)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths))) and all(lengths[b].sum() <= size for b in bins)
        assert len(bins) == fewest_bins(sorted(lengths.tolist(), reverse=True), size), (lengths, size)


@pytest.mark.parametrize("low, high, n, gain", [(335, 360, 8000, 0.02), (200, 521, 8000, 0.015), (300, 701, 40_000, 0.0001)])
def test_local_search_goes_on_until_no_step_helps(low, high, n, gain):
    lengths = np.random.default_rng(2).integers(low, high, size=n)
    bins = packing.best_fit(lengths, 1024)
    better = packing.local_search(bins, lengths, 1024)
    assert len(better) <= (1 - gain) * len(bins)
    fill = lambda bs: sorted(int(lengths[b].sum()) for b in bs)
    assert fill(packing.local_search(better, lengths, 1024)) == fill(better)


def test_pairs_of_a_bin_are_all_tried():
    # 9 goes into a bin only if its first and third piece leave: 9 > 5 + 3, 9 - 8 <= room 1
    lengths = np.array([9, 5, 4, 3, 7])
    bins = packing.local_search([[0, 4], [1, 2, 3]], lengths, 16)
    assert sorted(int(lengths[b].sum()) for b in bins) == [12, 16] or len(bins) == 2
    open_bins = packing._Open(20)
    open_bins.add(0, 1, [5, 4, 3])
    assert open_bins.exchange(9, 5, 2) == (1, 0, 8)


# ---------------------------------------------------------------- fingerprints

def mix(x, seed=0):
    x = (x + ((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & M)) & M
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & M
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & M
    return x ^ (x >> 31)


def poly(data):
    base, total = 0x9E3779B97F4A7C15 | 1, 0
    for i, b in enumerate(data):
        total = (total + (b + 1) * pow(base, i, 1 << 64)) & M
    return total


def plain_units(text):
    out = []
    for word in re.findall(rb"[^\x20\x09-\x0D]+", text.encode()):
        unit, i = b"", 0
        while i < len(word):
            width = 4 if word[i] >= 0xF0 else 3 if word[i] >= 0xE3 else 1
            if width > 1:
                out += [unit] * bool(unit) + [word[i:i + width]]
                unit, i = b"", i + width
                start = i
                continue
            if not unit:
                start = i
            elif i - start >= 8 and mix(poly(word[i - 8:i]), 29) % 8 == 0:
                out.append(unit)
                unit = b""
                # a border does not begin the run anew: the next is looked for from the run's start
            unit += word[i:i + 1]
            i += 1
        out += [unit] * bool(unit)
    return out


def plain_fingerprint(text):
    if not text:
        return []
    units = [mix(poly(u) ^ len(u), 33) for u in plain_units(text)]
    if units:
        k = min(2, len(units))
        grams = []
        for i in range(len(units) - k + 1):
            h = mix(units[i], 31)
            if k == 2:
                h = mix((((h << 7) | (h >> 57)) & M) ^ units[i + 1], 32)
            grams.append(h)
    else:
        grams = [31]
    seen, items = Counter(), []
    for g in grams:
        items.append(mix(g ^ mix(seen[g], 37), 39))
        seen[g] += 1
    out = []
    for s in range(64):
        seed = mix(s, 77) | 1
        key = lambda i: ((items[i] * seed) & M) ^ (((items[i] * seed) & M) >> 32)  # noqa: E731, B023
        chosen = sorted(sorted(range(len(items)), key=key)[:2])
        h = 0
        for j, i in enumerate(chosen):
            h = mix((((h << 9) | (h >> 55)) & M) ^ items[i], 41 + j)
        out.append(h >> 32)
    return out


def plain_near(a, b):
    return float(len(a) == len(b)) if not a or not b else sum(x == y for x, y in zip(a, b)) / 64


def test_fingerprints_against_plain_python(spark, texts):
    some = {d: t for d, t in texts.items() if len(t or "") < 1500}
    some |= {-1: "", -2: None, -3: " \n", -4: "日本語のテキスト と words", -5: "x" * 300, -6: "a-very-long-unbroken-token-" * 8, -7: "one", -8: "é" * 40 + " " + "🙂" * 5}
    docs = sorted(some.items(), reverse=True)
    got = {r.doc_id: r for r in fingerprints.fingerprints(spark.createDataFrame(docs, "doc_id long, text string"), ranges=4).collect()}
    prints = {d: plain_fingerprint(t or "") for d, t in docs}
    hexed = lambda p: b"".join(x.to_bytes(4, "big") for x in p).hex()
    for i, (d, text) in enumerate(docs):
        text, (after, following) = text or "", docs[(i + 1) % len(docs)]
        n = len(text) // 3
        changed = text[:len(text) - n] + (following or "")[:n] if n else text
        edited = plain_fingerprint(changed)
        r = got[d]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(text), hashlib.sha256(changed.encode()).hexdigest(), hexed(prints[d]), hexed(edited))
        assert (r.near_edited, r.near_next) == (plain_near(prints[d], edited), plain_near(prints[d], prints[after]))


def test_likeness_changes_little_with_length():
    """Three words of a text replaced: no jump where texts get longer."""
    mean = []
    for n in range(16, 34):
        near = []
        for r in range(24):
            words = [f"a{r}b{i}" for i in range(n)]
            other = [f"zz{i}" if i in (3, 9, 14) else w for i, w in enumerate(words)]
            near.append(fingerprints.near(fingerprints.fingerprint(" ".join(words)), fingerprints.fingerprint(" ".join(other))))
        mean.append(np.mean(near))
    assert np.abs(np.diff(mean)).max() < 0.06 and mean[-1] > mean[0]


def test_ranges_make_no_difference(spark, texts):
    rows = [(d, t) for d, t in texts.items()] + [(None, "x y z"), (None, "x y z"), (5, "again"), (5, "again"), (5, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one, many = (sorted(map(str, fingerprints.fingerprints(df, ranges=n).collect())) for n in (1, 7))
    assert len(one) == len(rows) and sum(a != b for a, b in zip(one, many)) <= 4   # repeats of an id may stand in another order


# ---------------------------------------------------------------- sharding

def cheapest(supply, demand, cost):
    """Least cost of a flow, unit by unit over all ways (tiny cases)."""
    units = [i for i, n in enumerate(supply) for _ in range(n)]
    best = [math.inf]

    def send(k, room, paid):
        if paid >= best[0]:
            return
        if k == len(units):
            best[0] = paid
            return
        for j, r in enumerate(room):
            if r:
                send(k + 1, [x - (i == j) for i, x in enumerate(room)], paid + cost[units[k]][j])
    send(0, demand, 0)
    return best[0]


def test_flow_has_the_least_cost():
    rng = random.Random(4)
    for _ in range(150):
        n, m = rng.randint(1, 3), rng.randint(1, 3)
        supply = [rng.randint(0, 3) for _ in range(n)]
        demand = [rng.randint(0, 3) for _ in range(m)]
        demand[0] += max(0, sum(supply) - sum(demand))
        cost = [[rng.randint(0, 5) for _ in range(m)] for _ in range(n)]
        flow = sharding.min_cost_flow(supply, demand, cost)
        assert [sum(f) for f in flow] == supply and all(sum(f[j] for f in flow) <= demand[j] for j in range(m))
        assert sum(flow[i][j] * cost[i][j] for i in range(n) for j in range(m)) == cheapest(supply, demand, cost)


def test_no_exchange_is_left_out():
    rng = random.Random(9)
    blocks = [(s, b, rng.randint(1000, 60_000)) for s in range(32) for b in range(128)] + [(3, 200, 40_000_000)]
    fill = Counter()
    to = sharding.plan(blocks, 32, 40)
    for s, b, n in blocks:
        fill[to[s, b]] += n
    rest = sorted(fill.values())[:-1]    # the block that is larger than a shard stays alone
    assert len(fill) == 40 and max(rest) - min(rest) <= 2


def test_resharding_keeps_its_law(spark, texts):
    rows = E.queries()["op6_min_cost_reshard"](spark, SF).collect()
    assert {r.law for r in rows} == {"bytes"} and {r.shard for r in rows} == set(range(40)) and all(r.grown_shard is None for r in rows)
    fill = Counter()
    for r in rows:
        fill[r.shard] += r.size
    mean = sum(fill.values()) / 40
    largest = max(r.size for r in rows)
    assert max(fill.values()) <= max(1.02 * mean + 300, largest)
    home = {r.doc_id: r.moved for r in rows}
    assert 0 < sum(home.values()) < len(home)


def test_files_and_blocks_follow_the_bytes(spark, texts, monkeypatch):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    monkeypatch.setattr(sharding, "FILE", 1000)
    rows = sharding.reshard(df, old=4, new=5).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts) and {r.shard for r in rows} == set(range(5))
    for s in range(5):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


# ---------------------------------------------------------------- quality score

def test_quality_scores_against_plain_python(spark, texts):
    labels = duckdb.sql(f"SELECT doc_id FROM '{SF}/labels.parquet' WHERE quality = 1 AND coalesce(toxic, 0) = 0").fetchall()
    good = {d for (d,) in labels}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in quality_rules.quality(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    grams = {r.doc_id: list(r.grams) for r in quality_rules.base_rules(quality_rules.texts(docs, "doc_id", "text")).select("doc_id", "grams").collect()}
    for d, t in texts.items():           # a gram of each word and each pair of neighbours
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        assert len(grams[d]) == max(0, 2 * n - 1)
    raw, target = Counter(), Counter()
    for d, g in grams.items():
        raw.update(g)
        if d in good:
            target.update(g)
    b = quality_rules.BUCKETS
    all_raw, all_target = sum(raw.values()) + b, sum(target.values()) + b
    weight = lambda g: math.log((target[g] + 1) / all_target) - math.log((raw[g] + 1) / all_raw)
    score = {d: sum(map(weight, g)) / len(g) for d, g in grams.items() if g}
    for d, r in rows.items():
        assert (r.score is None) == (d not in score) and (r.score is None or r.score == pytest.approx(score[d], abs=1e-9))
        assert r.kept == (not r.base_failed and r.score >= r.threshold)


# ---------------------------------------------------------------- license scan

def test_license_scan_of_long_texts_is_right_and_linear(spark):
    words = ["licensed under mit", "see the mit license", "apache license 2 0 and gpl license", "spdx license identifier mit", "general public license", "plain words here"]
    rng = random.Random(6)
    said = [" ".join(rng.choice(words) for _ in range(n)) for n in (30, 170, 400, 900)]
    said += ["w " * (license_scan.CHUNK - k) + "released under the terms of the mit no attribution license" for k in range(0, 12)]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")).collect()}
    for i, text in enumerate(said):
        norm = f" {text} "
        found = [(n := norm[:m.start()].count(" "), n + m.group().count(" "), x["priority"], x["rule"])
                 for x in license_scan.rules() for m in re.finditer(f"( (?:{x['pattern']})(?= ))", norm)]
        at = {}
        for f in found:
            at.setdefault(f[0] // 64, []).append(f)
        near = lambda x: [y for b in (x[0] // 64 - 1, x[0] // 64) for y in at.get(b, ())]  # noqa: E731, B023
        kept = [x for x in found if not any(y[0] <= x[0] and x[1] <= y[1] and (y[2] > x[2] or y[2] == x[2] and (y[:2] != x[:2] or y[3] < x[3])) for y in near(x))]
        assert sorted((d.a, d.b, d.priority, d.rule) for d in got[i].detections) == sorted(kept), i
    took = []
    for n in (2000, 2000, 8000):         # the first call is the warm-up
        df = spark.createDataFrame([(1, "licensed under the mit license. " * n)], "doc_id long, text string")
        began = time.monotonic()
        license_scan.scan(df).collect()
        took.append(time.monotonic() - began)
    assert took[2] < 8 * took[1] + 2


def test_no_match_of_a_rule_crosses_another():
    import regex
    rng = random.Random(2)
    names = ["mit", "gpl", "apache", "bsd", "gnu", "license", "licence", "licensed", "under", "the", "terms", "of", "2", "0", "3", "clause", "spdx", "identifier", "version", "public", "general", "a"]
    said = [" " + " ".join(rng.choice(names) for _ in range(400)) + " " for _ in range(6)]
    for x in license_scan.rules():
        for text in said:
            pattern = f" (?:{x['pattern']})(?= )"
            plain, over = ([m.span() for m in regex.finditer(pattern, text, overlapped=o)] for o in (False, True))
            assert all(any(a <= c and d <= b for a, b in plain) for c, d in over), x     # inside one that is found anyway
    assert license_scan.longest() < license_scan.CHUNK // 4


# ---------------------------------------------------------------- archives

def member(*records):
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(b"".join(records)) + pack.flush()


def warc(lines, block, version=b"WARC/1.0"):
    return version + b"\r\n" + b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


PAGE = b"<html>" + b"x" * 300
HTTP = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + PAGE
SHA1 = base64.b32encode(hashlib.sha1(PAGE).digest())
TYPE = b"Content-Type: application/http; msgtype=response"


def length(block):
    return b"Content-Length: %d" % len(block)


def archive():
    noisy = bytearray(member(warc([b"WARC-Type: response", TYPE, b"Content-Length: 60000"], HTTP + bytes((i * 7919 >> 3) % 251 for i in range(60_000)))))
    noisy[len(noisy) // 2:len(noisy) // 2 + 20] = b"\xff" * 20
    parts = [
        member(warc([b"WARC-Type: response", b"WARC-Payload-Digest: sha1:" + SHA1, TYPE, length(HTTP)], HTTP)),
        member(warc([b"warc-type:response", b"warc-record-id:<a>", b"content-type:application/http", b"content-length:%d" % len(HTTP)], HTTP)),
        member(warc([b"WARC-Type: response", b"WARC-Target-URI: http://x/\xe9", TYPE, length(HTTP)], HTTP)),
        member(warc([b"WARC-Type: response", b"WARC-Payload-Digest: SHA-1:" + SHA1[::-1], TYPE, length(HTTP)], HTTP)),
        bytes(noisy),
        member(warc([b"WARC-Type: response", b"WARC-Payload-Digest: xxh64:1", TYPE, length(HTTP)], HTTP)),
        member(warc([b"WARC-Type: warcinfo", length(b"abc")], b"abc"), warc([b"WARC-Type: resource", b"WARC-Block-Digest: sha256:" + hashlib.sha256(b"zz").hexdigest().encode(), length(b"zz")], b"zz")),
        member(warc([b"WARC-Type: response", b"Content-Length: x"], b"q")),
        member(warc([b"Foo: a", b" folded", length(b"")], b"")),
        member(warc([b"WARC-Type: revisit", b"WARC-Refers-To: <a>", length(b"")], b"", b"WARC/1.1")),
        b"no member at all \x1f\x8b\x08 in between",
        member(warc([b"WARC-Type: response", TYPE, length(HTTP)], HTTP))[:-40],
    ]
    return b"".join(parts)


def read(data, split):
    return [(at, k, *x) for s in range(0, len(data), split) for at, body, problem in archives.records_in(io.BytesIO(data), s, min(len(data), s + split))
            for k, x in enumerate(archives.parse(body, problem))]


def test_foreign_cut_and_damaged_records():
    data = archive()
    rows = read(data, len(data))
    assert [(r[2], r[-1]) for r in rows] == [
        ("response", None), ("response", None), ("response", None), ("response", "digest"), ("response", "damaged"), ("response", None),
        ("warcinfo", None), ("resource", None), ("response", "header"), (None, "header"), ("revisit", None), ("response", "cut")]
    assert [r[1] for r in rows[6:8]] == [0, 1] and rows[1][3] == "<a>" and rows[2][4] == "http://x/�" and rows[10][5] == "<a>" and rows[10][8] is None
    assert rows[0][6] == SHA1.decode() and all(r[8] == PAGE for r in (rows[0], rows[1], rows[3]))
    for split in (1, 7, 97, 333, 1000, 4096):
        assert read(data, split) == rows, split


def test_archives_of_any_size_of_file_and_one_hot_payload(spark):
    hot = "<p>same page</p>" * 20
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                    F.when(F.col("id") % 3 > 0, F.lit(hot)).otherwise(F.concat(F.lit(hot), F.col("id").cast("string"))).alias("html"))
    files = archives.write_archives(pages.repartition(2), file_bytes=5_000)
    assert files.count() > 4 and files.agg(F.sum("records")).first()[0] == 400
    rows = archives.read_archives(files, split=3_000).collect()
    kinds = Counter(r.record_type for r in rows)
    assert len(rows) == 400 and kinds["revisit"] == 265 and all(r.problem is None for r in rows)
    assert {r.refers_to for r in rows if r.record_type == "revisit"} == {"<urn:page:1>"}


def test_digests_of_several_algorithms():
    for stated, holds in (("md5:" + hashlib.md5(b"x").hexdigest(), True), ("sha-256:" + hashlib.sha256(b"x").hexdigest().upper(), True), ("sha512:00", False),
                          ("sha1:" + base64.b32encode(hashlib.sha1(b"x").digest()).decode().lower(), True), ("sha1:!!", False), ("crc32:1", True), ("", True)):
        assert archives.digest_holds(stated, b"x") is holds, stated
