import base64
import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc

ROWS = [
    (5, "http://b.example.org/x?q=1", "<p>same</p>"), (3, "http://a.example.org/", "<p>same</p>"),
    (9, "http://a.example.org/", "<p>other ü</p>"), (7, "http://a.example.org/", None), (8, None, ""),
    (1, "http://c.org/\nbad: line", "<p>same</p>"), (None, "http://z.org/", "<p>same</p>"),
    (20, "http://z.org/", "x" * 500_000), (21, "http://y.org/", "x" * 500_000), (20, "http://z.org/", "x" * 500_000),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumns(
        {c: F.lit("mine") for c in ("key", "digest", "payload", "first")})


def test_round_trip(pages):
    got = warc.archive_round_trip(pages).collect()
    assert len(got) == len(ROWS)
    first = {"<p>same</p>": 1, "": 7, "x" * 500_000: 20}
    seen = sorted(((r.page_id or 0), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0) for r in got)
    want = []
    for page, _, html in ROWS:
        raw = (html or "").encode()
        to = first.get(html or "", page)
        again = to != page
        want.append((page or 0, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                     "revisit" if again else "response", to if again else 0))
    assert seen == sorted(want)
    payloads = {r.page_id: bytes(r.payload) for r in got if r.record_type == "response"}
    assert payloads[9] == "<p>other ü</p>".encode() and payloads[7] == b""


def test_small_payloads_are_all_responses(pages):
    got = warc.archive_round_trip(pages, at_least=100).collect()
    assert {r.page_id for r in got if r.record_type == "revisit"} == {21}


def test_lookup_reads_only_blocks_that_may_hold_the_key(spark, tmp_path, pages, monkeypatch):
    many = [(100 + i, f"http://h{i % 37}.org/{i % 5}", f"<p>{i}</p>") for i in range(2000)]
    many += [(5000 + i, "http://hot.org/", f"<b>{i}</b>") for i in range(700)]
    df = spark.createDataFrame(many, "page_id long, url string, html string")
    folder = str(tmp_path / "w")
    captures = warc.write_archives(df, folder)
    directory = warc.build_index(captures, folder, block_lines=50)
    blocks = directory.collect()
    assert sum(b.lines for b in blocks) == len(many) and max(b.lines for b in blocks) <= 50
    asked = ["http://h3.org/4", "http://hot.org/", "http://nowhere.org/"]
    keys = spark.createDataFrame([(u,) for u in asked] * 3 + [(None,)], "url string").select(
        F.when(F.col("url").isNotNull(), warc.url_key(F.col("url"))).alias("key"))
    found = warc.lookup(spark, keys, directory, folder)
    assert sorted(r.page_id for r in found.collect()) == sorted(p for p, u, _ in many if u in asked)
    html = {r.page_id: bytes(r.payload).decode() for r in warc.read_records(found, folder).collect()}
    assert html == {p: h for p, u, h in many if u in asked}


def test_files_are_plain_archives(spark, tmp_path, pages):
    folder = str(tmp_path / "w")
    captures = warc.write_archives(pages.where("page_id = 9"), folder)
    row = captures.first()
    with open(os.path.join(folder, row.file), "rb") as f:
        text = gzip.decompress(f.read()).decode()
    assert text.startswith("WARC/1.1\r\nWARC-Type: response\r\n") and "<p>other ü</p>\r\n\r\n" in text
    assert row.start == 0 and row["key"] == "org,example,a)/"


def test_damage_raises(spark, tmp_path, pages):
    folder = str(tmp_path / "w")
    captures = warc.write_archives(pages.where("page_id = 9"), folder)
    path = os.path.join(folder, captures.first().file)
    member = gzip.decompress(open(path, "rb").read()).replace(b"other", b"othex")
    packed = gzip.compress(member, 4, mtime=0)
    with open(path, "wb") as f:
        f.write(packed)
    captures = captures.withColumn("size", F.lit(len(packed)).cast("long"))
    with pytest.raises(Exception, match="damaged record"):
        warc.read_records(captures, folder).collect()


def test_empty(pages):
    assert warc.archive_round_trip(pages.where("false")).count() == 0
