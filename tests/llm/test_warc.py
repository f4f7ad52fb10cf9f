import hashlib
import zlib
from collections import Counter, defaultdict

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from eventflow.llm.warc import RangeReader, encode_record, page_records, read_warc, write_warc

PAGES = "page_id long, url string, html string, digest string, first long"


def rows():
    long, other = "<p>ü" * 60, "x" * 99
    out = [(i, f"http://a/{i}", long, "d", 1) for i in (9, 4, 7, 7)]
    out += [(20, None, other, "d", 1), (21, "http://b/ q\r\nWARC-Type: x", other, "d", 1)]
    out += [(30, "u", None, None, None), (31, "u", "", "d", 1), (None, "u", long, "d", 1)]
    out += [(None, "u", "n" * 200, "d", 1), (None, "u", "n" * 200, "d", 1), (40, "u", "y" * 300_000, "d", 1)]
    return out + [(41, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 9, "d", 1)]


def brute(pages):
    data = [(p[0], (p[2] or "").encode()) for p in pages]
    ids = defaultdict(list)
    for key, body in data:
        ids[body].append(key)
    out = Counter()
    for key, body in data:
        known = [x for x in ids[body] if x is not None]
        first = min(known) if len(body) >= 100 and len(ids[body]) > 1 and known else None
        kind = "response" if first is None or first == key else "revisit"
        out[key, len(body), hashlib.sha256(body).hexdigest(), kind, first if kind == "revisit" else None] += 1
    return out


@pytest.mark.parametrize("split", [37, 8 << 20])
def test_round_trip(spark, tmp_path, split):
    pages = rows()
    path = str(tmp_path / "warc")
    assert write_warc(spark.createDataFrame(pages, PAGES).repartition(3), path) == len(pages)
    records = read_warc(spark, path, split_bytes=split if split > 1000 else 997)
    assert records.count() == len(pages)
    got = Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
        for r in page_records(records).collect()
    )
    assert got == brute(pages)
    urls = {r.target_uri for r in records.collect()}
    assert None in urls and "http://b/%20q%0D%0AWARC-Type:%20x" in urls


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    assert write_warc(spark.createDataFrame([], PAGES), path) == 0
    assert page_records(read_warc(spark, path)).count() == 0


def test_ranges_own_each_record_once(tmp_path):
    member = lambda i, body: encode_record("response", f"urn:page:{i}", "u", "d", body, len(body), None, "2000-01-01T00:00:00Z")
    nested = zlib.compressobj(0, zlib.DEFLATED, 31)  # a stored member shows a whole one inside
    inner = nested.compress(member(99, b"inner")) + nested.flush()
    bodies = [b"a" * 50, b"\x1f\x8b\x08" * 20, inner[:40], b"", bytes(range(256)) * 40]
    parts = [member(i, b) for i, b in enumerate(bodies)]
    data = parts[0] + parts[1] + b"junk\x1f\x8b\x08junk" + parts[2] + parts[3][:-3] + parts[4]
    file = tmp_path / "x.warc.gz"
    file.write_bytes(data)
    for width in (1, 3, 64, 1000, len(data)):
        found = []
        with pafs.LocalFileSystem().open_input_file(str(file)) as f:
            for start in range(0, len(data), width):
                found += [r["warc-record-id"] for _, r in RangeReader(f, start, min(start + width, len(data)), len(data), block=16)]
        assert found == [f"<urn:page:{i}>" for i in (0, 1, 2, 4)]  # 3 is cut short


def test_revisits_of_repeated_ids(spark, tmp_path):
    """Rows of one id hold different payloads; each revisit has its own one's size and digest."""
    bodies = ["a" * 200, "b" * 300, "c" * 400]
    pages = [(1, "u", b, "", 1) for b in bodies] + [(i + 2, "v", b, "", 1) for i, b in enumerate(bodies)]
    write_warc(spark.createDataFrame(pages, PAGES), str(tmp_path / "warc"))
    records = read_warc(spark, str(tmp_path / "warc"))
    got = Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
        for r in page_records(records).collect()
    )
    assert got == brute(pages)
    # A revisit without the header takes any response; one whose response is missing has nulls.
    bare = records.where("record_type = 'response' OR record_id = 'urn:page:2'").withColumn(
        "payload_digest", F.when(F.col("record_type") == "response", F.col("payload_digest"))
    )
    out = page_records(bare).where("record_type = 'revisit'").collect()
    assert len(out) == 1 and out[0].payload_bytes in (200, 300, 400)
    lost = page_records(records.where("record_type = 'revisit'")).collect()
    assert [r.payload_bytes for r in lost] == [None] * 3
