import base64
import gzip
import hashlib

from pyspark.sql import functions as F

from sievekit.llm import common, warc

PAGES = "page_id long, url string, html string, digest string, first string"


def test_round_trip(spark):
    rows = [(4, "http://a/4", "same"), (2, "http://a/2", "same"), (3, None, None), (9, "http://a/9", ""), (5, "http://x y", "é" * 3000), (5, "http://x y", "é" * 3000), (None, "http://n", "same"), (7, "u", "x\r\n\r\ny")]
    pages = spark.createDataFrame([(*r, "d", "f") for r in rows], PAGES)
    folder = common.shared_dir(spark)
    manifest = warc.write_warc(pages, folder)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows)
    found = warc.read_warc(spark, folder, payload=True).withColumns({"page": warc.page_of(F.col("record_id")), "of": warc.page_of(F.col("refers_to"))}).collect()
    got = sorted((r.page is not None, r.page or 0, r.warc_type, r.of, r.payload_bytes, r.payload_digest) for r in found)
    expected = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = {"same": 2, "": 3, None: 3}.get(html, page)
        again = page is not None and page != first
        expected.append((page is not None, page or 0, "revisit" if again else "response", first if again else None, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode()))
    assert got == sorted(expected)
    assert {bytes(r.payload).decode() for r in found if r.warc_type == "response"} == {"same", "", "é" * 3000, "x\r\n\r\ny"}


def test_predicates_and_skipping(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", ("p" * i) if i % 2 else "same", "d", "f") for i in range(20)], PAGES)
    folder = common.shared_dir(spark)
    warc.write_warc(pages, folder)
    df = warc.read_warc(spark, folder)
    assert df.filter("warc_type = 'revisit'").count() == 9
    assert df.filter("warc_type in ('response') and refers_to is null").count() == 11
    assert df.filter("record_id = '<urn:page:3>' and target_uri = 'http://h/3'").select("payload_bytes").first()[0] == 3
    assert df.filter("payload is not null").count() == 0
    reader = warc.WarcReader([], False)
    kept = list(reader.pushFilters([warc.EqualTo(("warc_type",), "revisit"), warc.EqualTo(("payload_bytes",), 3)]))
    assert len(kept) == 1 and len(reader.tests) == 1


def test_small_payloads_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "u", "ab", "d", "f"), (2, "u", "ab", "d", "f"), (3, "u", "abcd", "d", "f"), (4, "u", "abcd", "d", "f")], PAGES)
    folder = common.shared_dir(spark)
    warc.write_warc(pages, folder, min_bytes=3)
    got = {r.record_id: r.warc_type for r in warc.read_warc(spark, folder).collect()}
    assert got == {"<urn:page:1>": "response", "<urn:page:2>": "response", "<urn:page:3>": "response", "<urn:page:4>": "revisit"}
    folder = common.shared_dir(spark)
    assert warc.write_warc(pages.filter("page_id > 9"), folder).count() == 0
    assert warc.read_warc(spark, folder).count() == 0


def test_members_are_plain_gzip():
    data = [warc.record(i, "http://u", bytes([65 + i]) * (100_000 * i), None) for i in range(4)]
    packed = b"".join(map(warc.member, data))
    assert gzip.decompress(packed) == b"".join(data)
    # members of other writers have no length: they are stepped over by decompressing
    import io

    other = b"".join(gzip.compress(d) for d in data)
    seen = []
    for m in warc.Members(io.BytesIO(packed + other)):
        end = m.until(b"\r\n\r\n")
        seen.append(warc.parse_headers(bytes(m.text[:end]))["warc-record-id"])
    assert seen == [f"<urn:page:{i}>" for i in range(4)] * 2
