"""WARC, shards and URL filters against plain versions."""

import gzip
import hashlib
import random
import time
import zlib

import pytest
from pyspark.sql import functions as F

from slotloom.llm import shards, urls, warc
from slotloom.session import scratch_path


def test_warc_round_trip(spark):
    big, other = "é" * 90, "WARC/1.0\r\n\r\nWARC-Type: response\r\n\r\n" * 5 + "\r\n\r\n"
    rows = [(7, "http://a", big, 1), (3, None, big, 1), (9, "u\r\nX: 1", big, 1), (1, "s", "small", 1), (2, "s", "small", 1), (4, "", None, 1), (5, "x", "", 1),
            (6, "w", other, 1), (8, "w", other, 1), (None, "n", big, 1), (6, "w", other, 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, record_type int").repartition(3)
    raw, out = scratch_path(spark, "warc"), scratch_path(spark, "warc")
    warc.write_pages(df, raw)
    warc.write_resolved(spark, raw, out)
    got = sorted(map(tuple, warc.report(spark, out).collect()), key=repr)
    want = []
    seen6 = False
    for page, _, html, _ in rows:
        data = (html or "").encode()
        first = {big: 3, other: 6}.get(html, page)
        revisit = first != page or (page == 6 and seen6)
        seen6 |= page == 6
        want.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert got == sorted(want, key=repr)
    heads = warc.read(spark, out)
    assert heads.where("record_type = 'revisit'").count() == 5 and heads.select("record_id").distinct().count() == len(rows)
    # resolved archives resolve to themselves
    again = scratch_path(spark, "warc")
    warc.write_resolved(spark, out, again)
    assert sorted(map(tuple, warc.report(spark, again).collect()), key=repr) == got
    none = scratch_path(spark, "warc")
    warc.write_pages(df.where(F.lit(False)), none)
    assert warc.read(spark, none).count() == 0


def test_members_unpack_in_linear_time():
    draw = random.Random(5)
    members = [gzip.compress(draw.randbytes(draw.choice([0, 1, 700, 40_000])), mtime=0) + b"\0" * draw.choice([0, 0, 1, 9]) for _ in range(200)]
    assert warc.unpack(b"".join(members)) == gzip.decompress(b"".join(members))
    with pytest.raises(EOFError):
        warc.unpack(members[0][:-1].rstrip(b"\0")[:-1])
    with pytest.raises(zlib.error):
        warc.unpack(members[0] + b"no member")
    small = gzip.compress(draw.randbytes(300), mtime=0)

    def seconds(n):
        data, begun = small * n, time.process_time()
        warc.unpack(data)
        return time.process_time() - begun

    assert min(seconds(40_000) for _ in range(3)) < 8 * min(seconds(10_000) for _ in range(3))


def test_any_bytes_and_foreign_archives(spark, tmp_path):
    jpeg = bytes(range(256)) * 3
    df = spark.createDataFrame([(1, "a", jpeg), (2, "b", jpeg), (3, "c", b"\xff\xfe\x00"), (4, "d", jpeg[:99])], "page_id long, url string, html binary").coalesce(1)
    raw, out = scratch_path(spark, "warc"), scratch_path(spark, "warc")
    warc.write_pages(df, raw)
    data = open(next(str(p) for p in __import__("pathlib").Path(raw).glob("part-*")), "rb").read()
    members = 0
    while data.strip(b"\x00"):  # one gzip member per record
        opened = zlib.decompressobj(31)
        assert opened.decompress(data).startswith(b"WARC/1.0\r\n")
        members, data = members + 1, opened.unused_data
    assert members == 4
    warc.write_resolved(spark, raw, out)
    got = {r.page_id: (r.record_type, r.refers_to, r.payload_digest) for r in warc.report(spark, out).collect()}
    sha = hashlib.sha256(jpeg).hexdigest()
    assert got[1] == ("response", None, sha) and got[2] == ("revisit", 1, sha) and got[4][0] == "response"
    assert got[3] == ("response", None, hashlib.sha256(b"\xff\xfe\x00").hexdigest())

    def part(kind, block, *more):
        head = [f"warc-type: {kind}", f"Content-Length: {len(block)}", *more]
        return b"WARC/1.1\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\ncontent-length: 768\r\n\r\n"
    sha1 = "WARC-Payload-Digest: SHA1:ABCDEF"
    archive = (part("warcinfo", b"software: x") + part("request", b"GET / HTTP/1.1\r\n\r\n")
               + part("response", http + jpeg, "WARC-Record-ID: <urn:r1>", "WARC-Target-URI: http://one", "WARC-Date: 2020-01-01T00:00:00Z", sha1)
               + part("response", http + jpeg, "WARC-Record-ID: <urn:r2>", "WARC-Target-URI: http://two")
               + part("revisit", http, "WARC-Record-ID: <urn:r3>", sha1) + part("revisit", b"", "WARC-Record-ID: <urn:r4>", "WARC-Payload-Digest: sha1:OTHER")
               + part("response", b"no http at all", "WARC-Target-URI: dns:x"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.warc").write_bytes(archive)
    again = scratch_path(spark, "warc")
    warc.write_resolved(spark, str(tmp_path / "in"), again, files="*.warc")
    found = {r.record_id: r for r in warc.read(spark, again).collect()}
    assert {k: (r.record_type, r.refers_to_id) for k, r in found.items() if k.startswith("urn:r")} == {
        "urn:r1": ("response", None), "urn:r2": ("revisit", "urn:r1"), "urn:r3": ("revisit", "urn:r1"), "urn:r4": ("revisit", None)}
    assert len(found) == 5 and found["urn:r3"].payload_bytes == 768 and found["urn:r2"].payload_digest == sha
    assert {r.payload_bytes for r in found.values() if not r.record_id.startswith("urn:r")} == {14}


def test_shards(spark):
    rng = random.Random(4)
    texts = ["x" * rng.randint(0, 400) + str(i) for i in range(2000)] + ["same text " * 9] * 300 + [None, None, "", "huge" * 700] + ["hot " * 100] * 2500
    df = spark.createDataFrame([(i // 2, t, 1, "z") for i, t in enumerate(texts)], "doc_id long, text string, shard int, size string").repartition(4)
    got = shards.shard(df, 8).collect()
    assert len(got) == len(texts)
    size, group = [0] * 8, {}
    for r in got:
        assert r["size"] == len((r.row.text or "").encode()) + 1 and r.text_crc32 == zlib.crc32((r.row.text or "").encode())
        size[r.shard] += r["size"]
        group.setdefault(r.row.text, set()).add(r.shard)
    assert max(size) < 1.02 * min(size)
    assert len(group["hot " * 100]) > 1 and all(len(s) == 1 for t, s in group.items() if t != "hot " * 100)  # over a shard's share
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    folder = scratch_path(spark, "shards")
    shards.write_shards(shards.shard(df, 8), folder)
    assert spark.read.parquet(folder).groupBy("_shard").count().count() == 8
    assert shards.shard(df.where(F.lit(False))).count() == 0


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(-len(h + p), h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = min(fits) if fits else None
    return host, path, best[1] if best else None, best[2] if best else "allow"


def test_url_filters(spark):
    rng = random.Random(8)
    labels, bits = ["a", "b", "ab", "com", "org", "é"], ["/", "x", "/x", "ü", "y/", "/xy"]
    rules = {}
    for _ in range(60):
        rules[".".join(rng.choice(labels) for _ in range(rng.randint(1, 3))), "".join(rng.choice(bits) for _ in range(rng.randint(0, 3)))] = rng.choice(["allow", "block"])
    rules = [(h, p if p.startswith("/") or not p else "/" + p, v) for (h, p), v in rules.items()]
    rules = list({(h, p): (h, p, v) for h, p, v in sorted(rules)}.values()) + [("org", "/", "allow"), ("org", "/x", "block")]
    rules = list({(h, p): (h, p, v) for h, p, v in sorted(rules)}.values())
    found = [None, "", "no scheme", "://", "http://", "http:///x", "http://ORG", "http://org?x", "http://a.org./x", "http://org:80/x", "s://É.org/x", "http://" + "a." * 300 + "org/x" + "y" * 3000]
    for _ in range(400):
        host = ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
        found.append(rng.choice(["http", "https", ""]) + "://" + (host.upper() if rng.random() < 0.2 else host) + "/" * (rng.random() < 0.9) + "".join(rng.choice(bits) for _ in range(rng.randint(0, 4))) + rng.choice(["", "?a/b", "#q"]))
    found += [found[30]] * 200
    df = spark.createDataFrame([(i, u, "k", b"v") for i, u in enumerate(found)], "page_id long, url string, host string, rule binary").repartition(3)
    got = urls.filter_urls(df, urls.rules_table(spark, rules)).collect()
    assert len(got) == len(found)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain(r.row.url, rules), r.row.url
    assert urls.filter_urls(df.where(F.lit(False)), urls.rules_table(spark, rules)).count() == 0
    plan = urls.filter_urls(df, urls.rules_table(spark, rules))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
