"""WARC round trips against digests computed directly, and damaged archives."""

import base64
import gzip
import hashlib
import io
import random

import pytest

from tillgrid.llm import warc as W

SF = "/root/testdata/sf0.001"


def expected(rows, least=0):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= least and page is not None:
            first[data] = min(page, first.get(data, page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        to = first.get(data) if len(data) >= least else None
        to = None if to == page else to
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


def test_pages_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()]
    rows += [(r[0] + 10**6, r[1], r[2]) for r in rows[:20]]
    assert got(W.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string"))) == expected(rows)


EDGE = [(5, "http://a", "same"), (3, None, "same"), (3, "again", "same"), (None, "n", "same"), (7, "x\r\ny: z", None),
        (8, "", ""), (None, "m", "only null"), (9, "é ü", "Ünï\r\n\r\ncödé"), (10, "long", "ab" * 400_000)]


@pytest.mark.parametrize("least", [0, 5])
def test_edge_cases(spark, least):
    pages = spark.createDataFrame([(*r, "clash", b"p") for r in EDGE],
                                  "page_id long, url string, html string, record_type string, payload binary")
    assert got(W.round_trip(pages, least=least)) == expected(EDGE, least)


def test_payloads_come_back_whole(spark):
    pages = spark.createDataFrame(EDGE, "page_id long, url string, html string")
    rows = W.round_trip(pages, with_payload=True).collect()
    sent = {(p, (h or "").encode()) for p, _, h in EDGE}
    assert all((r["page_id"], bytes(r["payload"])) in sent for r in rows if r["record_type"] == "response")
    assert all(r["payload"] is None for r in rows if r["record_type"] == "revisit")


def test_empty_table(spark):
    assert W.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def archive(n=5, size=1000):
    rng = random.Random(1)
    payloads = [bytes(rng.choices(range(256), k=size)) for _ in range(n)]
    return payloads, b"".join(W.record(i, f"http://x/{i}", p, None, "2020-01-01T00:00:00Z")
                              for i, p in enumerate(payloads))


class Trickle(io.RawIOBase):
    """A stream that hands out few bytes at a time."""

    def __init__(self, data, most):
        self.data, self.most, self.at = data, most, 0

    def read(self, n=-1):
        out = self.data[self.at:self.at + min(self.most, n)]
        self.at += len(out)
        return out


@pytest.mark.parametrize("most", [1, 2, 17, 4096, 1 << 20])
def test_reader_frames_records_whatever_the_buffer(most):
    payloads, data = archive(n=3, size=300)
    rows = [W.page(h, b) for h, b in W.records(Trickle(data, most))]
    assert [r[6] for r in rows] == payloads and [r[0] for r in rows] == [0, 1, 2]


def test_each_record_is_a_member_that_gzip_reads():
    _, data = archive(n=2)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 2
    assert sum(1 for m in W.members(io.BytesIO(data)) for _ in [b"".join(m)]) == 2


def test_damage_is_found():
    payloads, data = archive(n=2)
    with pytest.raises(ValueError, match="ends inside"):
        list(W.records(io.BytesIO(data[:-3])))
    plain = gzip.decompress(W.record(1, "u", b"payload", None, "d"))
    with pytest.raises(ValueError, match="block digest"):
        list(W.records(io.BytesIO(gzip.compress(plain.replace(b"\r\n\r\npayload", b"\r\n\r\npAyload")))))
    with pytest.raises(ValueError, match="Content-Length"):
        list(W.records(io.BytesIO(gzip.compress(plain.replace(b"payload", b"payloads")))))
    with pytest.raises(ValueError, match="not a WARC"):
        list(W.records(io.BytesIO(gzip.compress(b"HTTP/1.1 200\r\n\r\n"))))
    headers, block = next(W.records(io.BytesIO(W.record(1, "u", b"payload", None, "d"))))
    headers["warc-payload-digest"] = "sha1:" + W.digest_of(b"other")
    with pytest.raises(ValueError, match="payload digest"):
        W.page(headers, block)


def test_archives_roll_over(spark, tmp_path):
    rows = [(i, "u", f"page {i} " * 50) for i in range(30)]
    folder = f"file://{tmp_path}/w"
    files = W.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder,
                         file_bytes=1500)
    assert files.count() > 3
    assert got(W.read_warc(files, folder)) == expected(rows)


def member(lines, block):
    head = "\r\n".join(["WARC/1.0", *lines, f"Content-Length: {len(block)}"]).encode()
    return gzip.compress(head + b"\r\n\r\n" + block + b"\r\n\r\n")


def test_archives_made_elsewhere_are_read(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n2\r\nab\r\n0\r\n\r\n"
    hexed = hashlib.sha256(b"body").hexdigest()
    response = ["WARC-Type: response", "WARC-Target-URI: http://a/", "Content-Type: application/http; msgtype=response"]
    parts = [
        member(["WARC-Type: warcinfo", "Content-Type: application/warc-fields"], b"software: other\r\n"),
        member(response, http + b"no digest"),
        member([*response, f"WARC-Payload-Digest: sha256:{hexed}"], http + b"body"),
        member([*response, "WARC-Payload-Digest: crc9:xyz"], http + b"unknown hash"),
        member([*response, "WARC-Payload-Digest: sha1:" + W.digest_of(b"ab")], chunked),
        member(["WARC-Type: resource", "WARC-Target-URI: dns:a", "Content-Type: text/dns"], b"1.2.3.4"),
        member(["WARC-Type: revisit", "WARC-Target-URI: http://b/"], b""),
        W.record(7, "http://own/", b"own", None, "2020-01-01T00:00:00Z")]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(parts))
    files = spark.createDataFrame([("x.warc.gz",)], "file string")
    rows = W.read_warc(files, f"file://{tmp_path}").collect()
    assert [(r["record_type"], r["url"], r["page_id"], r["payload"] and bytes(r["payload"])) for r in rows] == [
        ("warcinfo", None, None, b"software: other\r\n"), ("response", "http://a/", None, b"no digest"),
        ("response", "http://a/", None, b"body"), ("response", "http://a/", None, b"unknown hash"),
        ("response", "http://a/", None, chunked.partition(b"\r\n\r\n")[2]), ("resource", "dns:a", None, b"1.2.3.4"),
        ("revisit", "http://b/", None, None), ("response", "http://own/", 7, b"own")]
    bad = member([*response, "WARC-Payload-Digest: sha256:" + "0" * 64], http + b"body")
    with pytest.raises(ValueError, match="payload digest"):
        [W.page(h, b) for h, b in W.records(io.BytesIO(bad))]


def test_record_ids_differ_and_revisits_name_their_target(spark, tmp_path):
    rows = [(1, "http://a/", "same length"), (1, "http://a/", "other text!"), (1, "http://a/", "same length"),
            (2, "http://b/", "same length")]
    folder = f"file://{tmp_path}/w"
    files = W.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), folder)
    heads = [h for f in files.collect()
             for h, _ in W.records(open(f"{tmp_path}/w/{f['file']}", "rb"))]
    assert len({h["warc-record-id"] for h in heads}) == len(heads) == 4
    revisits = [h for h in heads if h["warc-type"] == "revisit"]
    assert [(h["warc-refers-to-target-uri"], h["x-refers-to-page-id"]) for h in revisits] == [("http://a/", "1")]
