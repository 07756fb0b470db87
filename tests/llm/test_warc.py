import base64
import gzip
import hashlib
import io
import os

import pytest
from conftest import SF01, has_data
from pyspark.sql import functions as F

from linkgap.llm import warc

PAGES = "page_id long, url string, html string"


@pytest.fixture()
def pages(spark):
    rows = [(1, "http://a/1", "<p>same</p>"), (2, "http://a/2\r\nX: 1", "<p>é same?</p>\r\n\r\nWARC/1.1\r\n\r\n"), (3, None, "<p>same</p>"),
            (4, "http://b/4", None), (5, "http://b/5", ""), (None, "http://c", "<p>same</p>"), (7, "http://d", "x" * 300_000),
            (3, "http://a/3b", "<p>same</p>")]
    return spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit("clash")).withColumn("id", F.lit("clash"))


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip_revisits_and_odd_rows(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(pages, path)
    got = warc.read_warc(spark, path).collect()
    assert len(got) == pages.count()
    texts = {(r.page_id, r.url): r.html for r in pages.collect()}
    back = sorted(((r.record_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in got), key=str)
    want = []
    for (i, url), html in texts.items():
        # of equal payloads the largest id responds: 3 (twice) for "same", 5 for empty
        last = {"<p>same</p>": 3, "": 5, None: 5}.get(html)
        revisit = last is not None and i != last
        want.append((f"<urn:x-page:{'null' if i is None else i}>", "revisit" if revisit else "response",
                     f"<urn:x-page:{last}>" if revisit else None, len((html or "").encode()), sha(html)))
    assert back == sorted(want, key=str)
    payloads = {r.record_id: r.payload for r in got if r.record_type == "response"}
    assert payloads["<urn:x-page:2>"].decode() == texts[(2, "http://a/2\r\nX: 1")] and payloads["<urn:x-page:7>"] == b"x" * 300_000
    assert all("x" not in r.headers for r in got) and "http://a/2%0D%0AX: 1" in {r.target_uri for r in got}


def test_small_payloads_are_not_revisited(spark, pages, tmp_path):
    warc.write_warc(pages, str(tmp_path / "w"), min_bytes=5)
    kinds = {r.record_id: r.record_type for r in warc.read_warc(spark, str(tmp_path / "w")).collect()}
    assert kinds["<urn:x-page:4>"] == "response" and kinds["<urn:x-page:1>"] == "revisit"


def test_predicates_reach_the_reader(spark, pages, tmp_path):
    warc.write_warc(pages, str(tmp_path / "w"))
    df = warc.read_warc(spark, str(tmp_path / "w"))
    got = df.where((F.col("record_type") == "response") & F.col("target_uri").startswith("http://b/"))
    assert [r.record_id for r in got.collect()] == ["<urn:x-page:5>"]
    reader = warc.WarcReader({"path": str(tmp_path / "w")})
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.StringStartsWith(("target_uri",), "http://"),
                                    warc.EqualTo(("payload_bytes",), 3)]))
    assert len(left) == 1 and len(reader.tests) == 2


class Watched(io.BytesIO):
    got = 0

    def read(self, n=-1):
        out = super().read(n)
        self.got += len(out)
        return out


def test_refused_blocks_are_not_read(tmp_path, spark, pages):
    warc.write_warc(pages.coalesce(1), str(tmp_path / "w"))
    name = next(f for f in os.listdir(tmp_path / "w") if f.startswith("part"))
    data = (tmp_path / "w" / name).read_bytes()
    stream = Watched(data)
    assert list(warc.read_records(stream, [("warc-type", "in", ("resource",))], "full")) == [] and stream.got == 0
    assert len(list(warc.read_records(Watched(data), [], "none"))) == 8


def test_gzip_members_folded_headers_and_damage(spark, tmp_path):
    def record(body, digest, extra=b""):
        head = (b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:r>\r\n" + extra
                + b"WARC-Payload-Digest: sha1:" + digest + b"\r\nContent-Length: " + str(len(body)).encode() + b"\r\n\r\n")
        return gzip.compress(head + body + b"\r\n\r\n")

    good = base64.b32encode(hashlib.sha1(b"abc").digest())
    (tmp_path / "a.warc.gz").write_bytes(record(b"abc", good, b"X-Note: one\r\n two\r\n") * 3)
    got = warc.read_warc(spark, str(tmp_path / "a.warc.gz")).collect()
    assert [r.payload for r in got] == [b"abc"] * 3 and got[0].headers["x-note"] == "one two"
    bad = io.BytesIO(gzip.decompress(record(b"abd", good)))
    with pytest.raises(ValueError):
        list(warc.read_records(bad, [], "digest"))
    with pytest.raises(EOFError):
        list(warc.read_records(io.BytesIO(gzip.decompress(record(b"abc", good))[:-6]), [], "full"))


def test_partitions_are_files_of_bounded_size(tmp_path):
    for i in range(6):
        (tmp_path / f"{i}.warc").write_bytes(b"x" * (40 + i))
    plan = warc.WarcReader({"path": str(tmp_path), "partitionbytes": "100"}).partitions()
    assert len(plan) == 3 and sum(len(p.value) for p in plan) == 6


def test_empty_table(spark, pages, tmp_path):
    warc.write_warc(pages.limit(0), str(tmp_path / "w"))
    assert warc.read_warc(spark, str(tmp_path / "w")).count() == 0


@has_data
def test_query_equals_a_plain_loop(spark):
    import pyarrow.parquet as pq
    from linkgap.llm.queries import op1_warc
    rows = [(d["page_id"], (d["html"] or "").encode()) for d in pq.read_table(f"{SF01}/pages.parquet", columns=["page_id", "html"]).to_pylist()]
    last = {}
    for i, body in rows:
        last[body] = max(i, last.get(body, i))
    want = {(i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
             "response" if last[body] == i else "revisit", None if last[body] == i else last[body]) for i, body in rows}
    got = [tuple(r) for r in op1_warc(spark, SF01).collect()]
    assert set(got) == want and len(got) == len(rows)
