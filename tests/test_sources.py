import hashlib
import http.server
import json
import struct
import threading
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievekit.functions import images, jpeg
from sievekit.operators import reports, scoring
from sievekit.schema import conform
from sievekit.sources import api, files, sinks
from sievekit.streaming.batches import EarlyStop


def png(path, pixels):
    h, w, _ = pixels.shape
    raw = b"".join(b"\0" + pixels[y].tobytes() for y in range(h))

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def bodies(spark, *pages):
    return spark.createDataFrame([(i + 1, json.dumps(p)) for i, p in enumerate(pages)], "page int, body string")


def test_retry():
    answers, waits = [(429, ""), (503, ""), RuntimeError("x"), (200, "ok")], []

    def fetch(params):
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    assert api.fetch_with_retry(fetch, {}, api.Retry(4), waits.append) == "ok" and waits == [3.0, 2.0, 4.0]
    with pytest.raises(RuntimeError, match="after 2 attempts"):
        api.fetch_with_retry(lambda p: (404, ""), {}, api.Retry(2), waits.append)


def test_paged_api(spark, tmp_path):
    for i in (1, 2):
        (tmp_path / f"{i}.json").write_text(json.dumps({"results": [{"id": f"{i}-{k}", "license": "cc by", "url": f"http://u/{i}/{k}", "title": None} for k in range(3)]}))
    pages = api.paged_api(spark, params=json.dumps({"folder": str(tmp_path)}), pages="3", attempts="1")
    assert pages.count() == 2
    found = api.image_results(pages, "carrot", "q", limit=5).collect()
    assert len(found) == 5 and found[0].image_url == "http://u/1/0" and found[0].title == "" and found[0].class_name == "carrot"


def test_file_details(spark):
    def page(pageid, **info):
        meta = {"LicenseShortName": {"value": info.pop("lic", "CC BY 4.0")}, "Artist": {"value": "<b>Me</b>"}}
        return {"pageid": pageid, "title": f"File:T {pageid}.jpg", "imageinfo": [{"mime": "image/jpeg", "url": f"http://o/{pageid}", "extmetadata": meta, **info}]}

    pages = {"1": page(1, thumburl="http://t/1", descriptionurl="http://d/1"), "2": page(2), "3": page(3, mime="image/svg+xml"), "4": page(4, lic="all rights"), "5": {"pageid": 5, "title": "x"}}
    df = bodies(spark, {"query": {"pages": pages}})
    rows = {r.source_id: r for r in api.file_details(df, "c", "q").collect()}
    assert set(rows) == {"1", "2"} and rows["1"].image_url == "http://t/1" and rows["1"].creator == "Me"
    assert rows["2"].landing_url.endswith("/wiki/File%3AT_2.jpg")
    assert [r.source_id for r in api.file_details(df, "c", "q", require_landing=True).collect()] == ["1"]


def test_observations_and_occurrences(spark):
    seen = {"results": [{"id": 7, "uri": "", "species_guess": None, "user": {"login": "u"}, "photos": [{"id": 1, "url": "http://p/square.jpg", "license_code": "cc-by"}, {"id": 2, "url": "", "license_code": "cc-by"}, {"id": 3, "url": "http://p/small.jpg", "license_code": None}]}]}
    rows = api.observation_photos(bodies(spark, seen, {"results": []}, seen), "c", "Name").collect()
    assert [(r.image_url, r.source_id, r.title, r.creator) for r in rows] == [("http://p/large.jpg", "7:1", "Name", "u")]
    media = [{"identifier": "http://m/1", "license": ""}, {"identifier": "ftp://m/2"}, {"references": "http://m/3", "license": "none"}]
    occurrence = {"endOfRecords": True, "results": [{"key": 9, "license": "cc0", "media": media}]}
    rows = api.occurrence_media(bodies(spark, occurrence, occurrence), "c", "Name").collect()
    assert [(r.image_url, r.license, r.source_id) for r in rows] == [("http://m/1", "cc0", "9:http://m/1")]
    taxa = bodies(spark, {"results": [{"id": 1, "name": "Other"}, {"id": 2, "name": "NAME"}]})
    assert api.taxon_id(taxa, "name") == 2 and api.taxon_id(taxa, "no") == 1 and api.taxon_id(bodies(spark, {"results": []}), "x") is None
    assert api.species_key(bodies(spark, {"speciesKey": 5})) == 5


def test_union_of_scans(spark):
    def fails():
        raise RuntimeError("down")

    df, problems = api.union_scans([lambda: spark.range(2), fails, lambda: spark.range(3)])
    assert df.count() == 5 and problems == ["RuntimeError: down"]


def test_files(spark, tmp_path):
    for split in ("train", "other"):
        for i in range(3):
            p = tmp_path / split / "carrot" / f"{i}.jpg"
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_bytes(bytes([i]) * (1500 + i))
    found = files.class_files(spark, str(tmp_path), "carrot", 1, least=3)
    assert found.count() == 3
    rows = files.as_candidates(found, "carrot", "local", "q", "http://l", "cc by", "").collect()
    assert {r.title for r in rows} == {"0", "1", "2"} and all(r.license == "cc by" for r in rows)
    with pytest.raises(ValueError, match="3 remain, 4 are required"):
        files.class_files(spark, str(tmp_path), "carrot", 1, least=4)
    names = files.image_files(spark, str(tmp_path)).select(F.substring_index("path", "/", -1).alias("name"), "n_bytes")
    tried = files.probed(spark, 5, lambda i: F.concat(i.cast("string"), F.lit(".jpg")), names).orderBy("pos").collect()
    assert [r.valid for r in tried] == [True, True, True, False, False]
    sums = {r.path: r.sha256 for r in sinks.checksums(spark, str(tmp_path)).collect()}
    assert sums["train/carrot/1.jpg"] == hashlib.sha256(b"\1" * 1501).hexdigest() and len(sums) == 6
    names = sinks.zip_folder(str(tmp_path / "train"), str(tmp_path / "out.zip"))
    assert names == ["carrot/0.jpg", "carrot/1.jpg", "carrot/2.jpg"]
    files.unpack_once(str(tmp_path / "out.zip"), str(tmp_path / "again"))
    assert (tmp_path / "again/carrot/2.jpg").exists()


def test_gallery(spark):
    site = "https://commons.wikimedia.org"
    web = {f"{site}/wiki/Category:X": '<a href="/wiki/File:A.jpg">a</a><a title="next page" href="/wiki/Category:X?pagefrom=B">n</a>', f"{site}/wiki/Category:X?pagefrom=B": '<a href="/wiki/File:B.png">b</a>'}
    pages = files.gallery_pages(web.get, f"{site}/wiki/Category:X", spark=spark)
    assert [u for u, _ in pages] == list(web)
    df = spark.createDataFrame(pages, "url string, html string")
    rows = files.gallery_files(df, "carrot", 3).orderBy("source_id").collect()
    assert [(r.title, r.image_url) for r in rows] == [("A.jpg", f"{site}/wiki/Special:Redirect/file/A.jpg?width=1200"), ("B.png", f"{site}/wiki/Special:Redirect/file/B.png?width=1200")]


def test_images(spark, tmp_path):
    rng = np.random.default_rng(1)
    noise = rng.integers(0, 256, (200, 260, 3), np.uint8)
    flat = np.full((64, 64, 3), 90, np.uint8)
    ramp = np.repeat(np.linspace(0, 255, 300).astype(np.uint8)[None, :, None], 200, 0).repeat(3, 2)
    for name, a in {"noise": noise, "copy": noise, "flat": flat, "ramp": ramp, "mirror": np.ascontiguousarray(ramp[:, ::-1])}.items():
        png(tmp_path / f"{name}.png", a)
    (tmp_path / "broken.png").write_bytes(b"no image")
    df = spark.read.format("image").option("dropInvalid", True).load(str(tmp_path))
    rows = {r.name: r.m for r in df.select(F.regexp_extract("image.origin", r"(\w+)\.png$", 1).alias("name"), images.image_measures(F.col("image")).alias("m")).collect()}
    assert set(rows) == {"noise", "copy", "flat", "ramp", "mirror"}
    assert (rows["noise"].width, rows["noise"].height) == (260, 200) and rows["noise"] == rows["copy"]
    assert rows["flat"].entropy == 0 and rows["flat"].variance == 0 and rows["ramp"].entropy > 5
    assert rows["ramp"].dhash == "f" * 64 and rows["mirror"].dhash == "0" * 64
    assert rows["ramp"].mirror_phash == rows["mirror"].phash and len(rows["noise"].whash) == 64


@pytest.mark.parametrize("shape", [(1, 1), (8, 8), (37, 53), (200, 260)])
def test_jpeg_is_read_by_others(spark, tmp_path, shape):
    y, x = np.mgrid[: shape[0], : shape[1]]
    smooth = np.stack([128 + 100 * np.sin(x / 9), 128 + 90 * np.cos(y / 7), (x + y) % 256 * 0.5], 2).astype(np.uint8)
    noise = np.random.default_rng(2).integers(0, 256, (*shape, 3), np.uint8)
    for name, a in {"smooth": smooth, "noise": noise, "flat": np.full((*shape, 3), 77, np.uint8)}.items():
        (tmp_path / f"{name}.jpg").write_bytes(jpeg.encode(a, 94))
        row = spark.read.format("image").load(str(tmp_path / f"{name}.jpg")).first().image
        got = images.rgb(row).astype(int)
        assert got.shape == a.shape and np.abs(got - a).mean() < 4


def test_code_lengths():
    for counts in (np.r_[1, np.zeros(255, int)], 2 ** np.arange(40), np.ones(256, int)):
        length = jpeg.code_lengths(np.pad(counts, (0, 256 - len(counts))))
        # complete with the code of ones
        assert max(length.values()) <= 16 and sum(2.0 ** -n for n in length.values()) <= 1 - 2.0 ** -max(length.values())


def test_image_sink(spark, tmp_path):
    a = np.full((100, 300, 3), 40, np.uint8)
    a[:, :150] = 200
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    png(source / "a.png", a)
    (source / "b.png").write_bytes(b"no image")
    # orientation 6: what is stored is to be turned a quarter to the right
    exif = b"Exif\0\0" + b"II*\0" + struct.pack("<IHHHIHHI", 8, 1, 0x0112, 3, 1, 6, 0, 0)
    body = jpeg.encode(a)
    (source / "c.jpg").write_bytes(body[:2] + b"\xff\xe1" + struct.pack(">H", len(exif) + 2) + exif + body[2:])
    found = files.decoded_images(spark, str(source)).withColumn("name", F.concat(F.lit("train/x/"), F.regexp_extract("path", r"(\w+)\.\w+$", 1), F.lit(".jpg")))
    assert {(r.rule, r.subject[-5:]) for r in reports.unfit_images(found.select("path", "image")).collect()} == {("small_side", "a.png"), ("unreadable", "b.png"), ("small_side", "c.jpg")}
    rows = {r.name[-5]: r for r in sinks.write_images(found, str(out), longest=150, least=60).collect()}
    assert (rows["a"].width, rows["a"].height) == (180, 60) and (rows["c"].width, rows["c"].height) == (60, 180)
    assert rows["b"].sha256 is None and sorted(p.name for p in (out / "train/x").iterdir()) == ["a.jpg", "c.jpg"]
    for name in "ac":
        content = (out / f"train/x/{name}.jpg").read_bytes()
        assert rows[name].n_bytes == len(content) and rows[name].sha256 == hashlib.sha256(content).hexdigest()
    got = images.rgb(spark.read.format("image").load(str(out / "train/x/c.jpg")).first().image)
    assert got[20].mean() > 190 and got[160].mean() < 50
    assert images.orientation(b"") == images.orientation(body) == 1


@pytest.mark.parametrize("n", range(1, 9))
def test_turned(n):
    # the stored corner (0, 0) is seen at: top left, top right, bottom right, bottom left, ...
    a = np.zeros((2, 3, 1), np.uint8)
    a[0, 0] = 1
    seen = images.turned(a, n)[:, :, 0]
    at = {1: (0, 0), 2: (0, -1), 3: (-1, -1), 4: (-1, 0), 5: (0, 0), 6: (0, -1), 7: (-1, -1), 8: (-1, 0)}[n]
    assert seen.shape == ((2, 3) if n < 5 else (3, 2)) and seen[at] == 1


def test_http_fetch():
    class Answers(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            ok = self.path.startswith("/ok")
            self.send_response(200 if ok else 503)
            self.end_headers()
            self.wfile.write(self.path.encode() if ok else b"")

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base, waits = f"http://127.0.0.1:{server.server_port}", []
    assert api.http_fetch({"url": f"{base}/ok", "query": {"q": "a b"}, "page": 3, "page_name": "p"}) == (200, "/ok?q=a+b&p=3")
    assert api.http_fetch({"url": f"{base}/no", "page": 1}) == (503, "")
    with pytest.raises(RuntimeError, match="status 503"):
        api.fetch_with_retry(api.http_fetch, {"url": f"{base}/no", "page": 1}, api.OPEN_SET_RETRY, waits.append)
    assert waits == [1.0, 2.0, 4.0, 8.0]
    server.shutdown()


def test_encoded(spark):
    df = spark.createDataFrame([(1, "aab"), (2, None), (3, "")], "id long, text string")
    rows = {r.id: r.embedding for r in scoring.encoded(df, "text", "sievekit.operators.scoring:LetterCounts", size=1).collect()}
    assert rows[1][0] == pytest.approx(1) and rows[2] is None and rows[3] == [0.0] * 5


def test_written_reports(spark, tmp_path):
    rows = spark.createDataFrame([("a", "train", "a_001.jpg")], "class_name string, split string, output_name string")
    sinks.write_manifest(conform(rows), str(tmp_path / "m"), b"credits")
    assert (tmp_path / "m/manifest.csv").read_bytes().startswith(b"\xef\xbb\xbfrelative_path,class") and (tmp_path / "m/credits.csv").read_bytes() == b"credits"
    sinks.write_failure(str(tmp_path / "m"), "score", ValueError("x"))
    assert json.loads((tmp_path / "m/build_error.json").read_text())["stage"] == "score" and "ValueError: x" in (tmp_path / "m/build_error.txt").read_text()


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "train", 2), ("b", "test", 1)], "class_name string, split string, n int")
    assert sinks.csv_bytes(df).startswith(b"\xef\xbb\xbfclass_name,split,n")
    sinks.write_csv(df, str(tmp_path / "csv"), ["class_name"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    assert "- a / train: 2" in sinks.notice(df, "T")
    assert json.loads(sinks.json_report(df.filter("n = 1")).first().json) == {"class_name": "b", "split": "test", "n": 1}
    assert json.loads(sinks.failure("score", ValueError("x")))["error"] == "ValueError: x"


def test_streamed_early_stop(spark, tmp_path):
    source, sink = tmp_path / "in", tmp_path / "out"
    spark.range(100).withColumn("ok", F.col("id") % 2 == 0).repartition(5).write.parquet(str(source))
    stream = spark.readStream.schema("id long, ok boolean").option("maxFilesPerTrigger", 1).parquet(str(source))
    query = stream.writeStream.foreachBatch(EarlyStop(str(sink), "ok", 25)).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination(60)
    n = spark.read.parquet(str(sink)).count()
    assert 25 <= n < 50 and spark.read.parquet(str(sink)).filter("not ok").count() == 0
