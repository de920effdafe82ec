"""WARC archives and URL rules against brute force."""

import hashlib
import random

import pytest

from flowatlas.llm import urls, warc
from flowatlas.llm.common import work_dir
from flowatlas.llm.files import read_bytes, write_bytes

from data import clashing

SCHEMA = "page_id long, url string, html string"


def awkward_pages():
    r = random.Random(1)
    big = "".join(r.choice("abc <>\r\n") for _ in range(40_000))
    trap = "x" * 150 + "\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\nContent-Length: 999999\r\n\r\n"
    return [(5, "http://a.com/x y", "same" * 40), (2, "http://a.com/", "same" * 40), (9, None, "same" * 40), (1, "http://b.com/é", None),
            (3, "", ""), (4, "u", "short"), (6, "u", "short"), (7, "http://t.com", trap), (8, "http://t.com", trap * 3), (10, "big", big),
            (11, "ü", "é\U0001F600" * 60), (12, "w", "WARC/1.0\r\n" * 30), (13, "r", "repeat" * 30), (13, "r", "repeat" * 30)]


def expected(rows):
    least = {}
    for i, _, h in rows:
        h = (h or "").encode()
        if len(h) >= 100:
            least[h] = min(i, least.get(h, i))
    out = []
    for i, _, h in rows:
        h = (h or "").encode()
        first = least.get(h, i)
        out.append((i, len(h), hashlib.sha256(h).hexdigest(), "response" if first == i else "revisit", None if first == i else str(first)))
    return sorted(out, key=str)


@pytest.mark.parametrize("split_bytes,file_bytes", [(500, 20_000), (1 << 20, 1 << 25), (137, 1 << 25)])
def test_round_trip(spark, split_bytes, file_bytes):
    rows = awkward_pages()
    folder = work_dir(spark, "t")
    manifest = warc.write_archives(clashing(spark.createDataFrame(rows, SCHEMA)).coalesce(2), folder, file_bytes=file_bytes)
    got = warc.read_archives(manifest, folder, split_bytes, payloads=True).collect()
    assert sorted(((int(r.id), r.payload_bytes, r.payload_digest, r.type, r.refers_to) for r in got), key=str) == expected(rows)
    bodies = {int(r.id): bytes(r.payload).decode() for r in got if r.type == "response"}
    assert all(bodies[i] == (h or "") for i, _, h in rows if i in bodies)
    assert manifest.agg({"n_records": "sum"}).first()[0] == len(rows)


def test_null_ids_and_no_pages(spark):
    folder = work_dir(spark, "t")
    rows = [(None, "u", "y" * 200), (4, "u", "y" * 200), (None, "v", "z" * 200), (None, "v", "z" * 200)]
    got = warc.read_archives(warc.write_archives(spark.createDataFrame(rows, SCHEMA), folder), folder).collect()
    assert sorted((str(r.id), r.type, str(r.refers_to)) for r in got) == [
        ("4", "response", "None"), ("None", "response", "None"), ("None", "response", "None"), ("None", "revisit", "4")]
    folder = work_dir(spark, "t")
    assert warc.read_archives(warc.write_archives(spark.createDataFrame([], SCHEMA), folder), folder).count() == 0


def test_cut_off_file_yields_its_whole_records(spark):
    folder = work_dir(spark, "t")
    rows = [(i, "u", f"page {i} " * 50) for i in range(8)]
    manifest = warc.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), folder)
    m = manifest.collect()[0]
    data = read_bytes(m.path)
    write_bytes(m.path, data[:-100])
    short = spark.createDataFrame([(m.path, len(data) - 100, m.n_records)], manifest.schema)
    got = warc.read_archives(short, work_dir(spark, "t"), 700).collect()
    assert sorted(int(r.id) for r in got) == list(range(7))


@pytest.mark.parametrize("split_bytes", [1000, 70_000, 1 << 23])
def test_long_heads(spark, split_bytes):
    folder = work_dir(spark, "t")
    rows = [(1, "http://a.com/", "first " * 40), (2, "data:," + "x" * 200_000, "second " * 40), (3, "http://b.com/" + " " * 22_000, "third"),
            (4, "u", "WARC/1.0\r\n" * 9_000), (5, "u", "WARC/1.0\r\nContent-Length: 3\r\n" + "y" * 150_000), (6, "u", "last " * 40)]
    manifest = warc.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), folder)
    got = {int(r.id): r for r in warc.read_archives(manifest, folder, split_bytes, payloads=True, strict=True).collect()}
    assert {i: (r.url, bytes(r.payload).decode()) for i, r in got.items()} == {i: (u.replace(" ", "%20"), h) for i, u, h in rows}


def test_strict_reading_raises_on_broken_files(spark):
    folder = work_dir(spark, "t")
    manifest = warc.write_archives(spark.createDataFrame([(i, "u", f"page {i} " * 50) for i in range(8)], SCHEMA).coalesce(1), folder)
    m = manifest.collect()[0]
    assert warc.read_archives(manifest, work_dir(spark, "t"), 700, strict=True).count() == 8
    data = read_bytes(m.path)
    more = spark.createDataFrame([(m.path, m.n_bytes, m.n_records + 1)], manifest.schema)
    with pytest.raises(ValueError, match="broken"):
        warc.read_archives(more, work_dir(spark, "t"), 700, strict=True)
    at = data.index(b"WARC/1.0", len(data) // 2)
    for bad, n in ((data[:-100], len(data) - 100), (data[:at] + b"X" + data[at + 1:], len(data)), (b"", len(data))):
        write_bytes(m.path, bad)
        short = spark.createDataFrame([(m.path, n, m.n_records)], manifest.schema)
        with pytest.raises(ValueError, match="broken"):
            warc.read_archives(short, work_dir(spark, "t"), 700, strict=True)


# ---------------------------------------------------------------------- URLs
def judged(url, rules, default="allow"):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else default


def test_urls(spark):
    r = random.Random(2)
    hosts = ["example.com", "www.example.com", "a.www.example.com", "EXAMPLE.com", "net", "x.net", "badexample.com", "com", "x.org", "", "com.", "a..com", "x.com:80"]
    paths = ["", "/", "/en/", "/en", "/en/x", "/fr/?a=/es/", "/es/#f", "?q", "#f", "/EN/", "/fr/fr/"]
    rows = [(i, r.choice(["http://", "HTTPS://", "", "a://b://"]) + r.choice(hosts) + r.choice(paths)) for i in range(400)]
    rows += [(400, None), (401, ""), (402, "://"), (None, "http://example.com/en/"), (403, "http://" + "a." * 3000 + "com/" + "x" * 50000), (0, rows[0][1])]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string"))
    for rules in (urls.CONTRACT_RULES, urls.CONTRACT_RULES + [("org", "", "block"), ("com", "/", "block"), ("a.www.example.com", "/e", "block")], []):
        plain = {(h, p): v for h, p, v in sorted(rules, key=lambda x: x[2] == "block")}
        want = [(i, *judged(u, [(h, p, v) for (h, p), v in plain.items()])) for i, u in rows]
        got = urls.judge_urls(pages, spark.createDataFrame(rules, urls.RULE_SCHEMA)).collect()
        assert sorted(((x.page_id, x.host, x.path, x.rule, x.verdict) for x in got), key=str) == sorted(want, key=str)
    assert urls.judge_urls(pages.limit(0), spark.createDataFrame(urls.CONTRACT_RULES, urls.RULE_SCHEMA)).count() == 0
