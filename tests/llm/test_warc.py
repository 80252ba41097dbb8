import base64
import glob
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gridtide.llm import warc

SCHEMA = "page_id long, url string, html string, file string, offset string, capture string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    long_, other = "é<p>\r\n\r\n" * 200, "x" * 1000
    made = [(i, f"http://H{rng.randrange(5)}.example.org:80/p/{rng.randrange(40)}?q=é {i % 3}#f", "".join(rng.choice("ab\n") for _ in range(rng.randrange(3000))), "f", "o", "c") for i in range(300)]
    made += [(1000 + i, f"https://copy.org/{i % 4}", long_, "f", None, None) for i in range(60)]
    made += [(2000, "http://copy.org/z", other, None, None, None), (2001, None, other, None, None, None), (None, "http://copy.org/z", other, None, None, None)]
    made += [(None, None, None, None, None, None), (3000, "", "", None, None, None), (3001, "no url\t\n", "y" * 999, None, None, None), (3002, "a:b", "y" * 999, None, None, None), (3003, "http://user@h.org:8080", "z" * 400_000, None, None, None)]
    return made + [made[0], made[-5], (1059, "https://copy.org/again", long_, None, None, None)]


def expected(rows):
    out = []
    for id, url, html, *_ in rows:
        body = (html or "").encode()
        ids = [i for i, _, h, *_ in rows if h == html and i is not None]
        again = len(body) >= 1000 and bool(ids) and (id is None or id < max(ids))
        out.append((id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", max(ids) if again else None, body))
    return out


@pytest.mark.parametrize("limits", [{}, {"archive_bytes": 5000, "block_lines": 3}])
def test_round_trip(spark, rows, limits):
    pages = spark.createDataFrame(rows, SCHEMA).repartition(4)
    archive = warc.write_archives(pages, **limits)
    wanted = pages.select("page_id", warc.url_key("url").alias("key"), F.lit("q").alias("file"), F.lit(1).alias("record")).distinct()
    found = warc.read_records(archive, warc.lookup(archive, wanted, "key", "page_id"))
    full = warc.with_payloads(archive, found).collect()
    got = [(r.page_id, r.record.payload_bytes, r.record.payload_digest, r.record.record_type, r.record.refers_to and int(r.record.refers_to), bytes(r.record.payload)) for r in full]
    assert sorted(got, key=repr) == sorted(expected(rows), key=repr)
    assert {r.file for r in full} == {"q"}
    assert archive.captures.count() == len(rows) == archive.parts.agg(F.sum("lines")).first()[0]


def test_files_are_whole_archives(spark, rows):
    """Read one after the other, without the index, by the rules of the format."""
    archive = warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(3), archive_bytes=20_000)
    kinds = []
    names = glob.glob(archive.folder.removeprefix("file://") + "/*.warc.gz")
    assert len(names) > 3
    for name in names:
        data, first = gzip.open(name).read(), True
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            block, data = rest[:size], rest[size:]
            assert data[:4] == b"\r\n\r\n" and (fields["WARC-Type"] == "warcinfo") == first
            if fields["WARC-Type"] == "response":
                body = block.partition(b"\r\n\r\n")[2]
                assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
            kinds.append(fields["WARC-Type"])
            data, first = data[4:], False
    assert len(kinds) == len(rows) + len(names) and kinds.count("revisit") == sum(r[3] == "revisit" for r in expected(rows))


def test_lookup_by_key_alone(spark, rows):
    pages = spark.createDataFrame(rows, SCHEMA)
    archive = warc.write_archives(pages, block_lines=2)
    urls = [("https://copy.org/1",), ("http://copy.org/1#x",), ("http://nowhere.org/",), (None,), ("https://COPY.org/again",)]
    queries = spark.createDataFrame(urls, "url string").withColumn("key", warc.url_key("url"))
    got = sorted((r.url or "", r.capture.id) for r in warc.lookup(archive, queries).collect())
    ones = [str(i) for i, u, *_ in rows if u == "https://copy.org/1"]
    want = [(u, i) for u in ("https://copy.org/1", "http://copy.org/1#x") for i in ones] + [("https://COPY.org/again", "1059")] + [("", "" if i is None else str(i)) for i, u, *_ in rows if not u]
    assert got == sorted(want)
    assert warc.lookup(archive, queries.limit(0)).count() == 0


def test_keys(spark):
    cases = {"http://www.A.org/b?c#d": "org,a,www)/b?c", "https://a.org": "org,a)/", "http://u@a.org:443?x": "org,a)/?x", "http://a.org:81/": "org,a:81)/", "plain": "plain", "": "about:blank", None: "about:blank", "http://a.b/x y": "b,a)/x%20y"}
    df = spark.createDataFrame(list(cases.items()), "url string, want string").withColumn("key", warc.url_key("url"))
    assert [(r.url, r.key) for r in df.collect()] == [(r.url, r.want) for r in df.collect()]


def test_damage_is_noticed():
    member = gzip.compress(warc._record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x-capture:1>"), ("WARC-Target-URI", "a"), ("WARC-Date", "d"), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(hashlib.sha1(b"other").digest()).decode())], b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\nhello"))
    with pytest.raises(ValueError):
        warc.parse(member)


def test_empty_table(spark):
    archive = warc.write_archives(spark.createDataFrame([], SCHEMA))
    queries = spark.createDataFrame([("a", 1)], "key string, page_id long")
    assert warc.read_records(archive, warc.lookup(archive, queries, "key", "page_id")).count() == 0
