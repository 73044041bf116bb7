import random
import re
from html.parser import HTMLParser
from urllib.parse import quote, unquote

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievekit import schema
from sievekit.functions import html, images, license, text, vectors


def column(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


def stripped(value):
    out, inside = [], False
    for c in value:
        if c == "<":
            inside = True
        elif c == ">":
            inside = False
        elif not inside:
            out.append(c)
    return " ".join("".join(out).replace("&nbsp;", " ").split())


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="<>ab &nbsp;\x1c　\n\x85 ", max_size=30), min_size=1, max_size=60))
def test_strip_html(spark, values):
    assert column(spark, text.strip_html, values) == [stripped(v) for v in values]


def test_strip_html_cases(spark):
    values = ["a<b", "x > y <i", "<<b>>z", "", "&nbsp;", "　x　", "a\x1cb", "line\n", None]
    assert column(spark, text.strip_html, values) == [stripped(v or "") for v in values]


def test_licenses(spark):
    values = [None, "", "by", "CC_BY", " cc  by-sa 4.0 ", "cc0 1.0", "cc by-nc", "all rights reserved", "https://creativecommons.org/licenses/by/4.0/", "pdm"]
    got = {r: column(spark, lambda c, r=r: license.license_is_allowed(c, r), values) for r in ("core", "strict", "open_set")}
    assert got["core"] == [False, False, False, True, True, True, True, False, False, True]
    assert got["strict"] == [False, False, True, True, True, False, True, False, True, True]
    assert got["open_set"] == [False, False, True, True, True, True, True, False, True, True]
    assert column(spark, lambda c: license.license_is_allowed(c, "core", no_restrictions=True), ["cc by-nc", "cc by", "cc by nd"]) == [False, True, False]


class Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.names = []

    def handle_starttag(self, tag, attrs):
        href = dict(attrs).get("href") or ""
        if tag == "a" and href.startswith("/wiki/File:"):
            name = unquote(href[len("/wiki/File:") :].split("#")[0]).replace("_", " ").strip()
            if re.search(r"\.(jpe?g|png|webp|tiff?)$", name, re.I) and name not in self.names:
                self.names.append(name)


def test_file_links(spark):
    pages = [
        '<a href="/wiki/File:A_b.JPG">x</a><a title="t" href=\'/wiki/File:C%20d%2Be+f.png#top\'>y</a><a href="/wiki/File:note.pdf">z</a><a href="/wiki/File:A_b.JPG">again</a>',
        '<A class="k" HREF="/wiki/File:%C3%A9.webp"><img src="/wiki/File:no.jpg"><abbr href="/wiki/File:no.jpg">',
        '<a data-href="/wiki/File:no.jpg" href="/wiki/File:a&amp;b.jpg">',
        "",
    ]
    expected = []
    for p in pages:
        parser = Links()
        parser.feed(p)
        expected.append(parser.names)
    assert column(spark, html.file_links, pages) == expected


def test_next_pages_and_images(spark):
    page = '<a href="/w/index.php?title=/wiki/Category:X&amp;pagefrom=B">more</a><a title="Next page of X" href="/wiki/next">n</a><a title="next page">no</a><a href="/wiki/Category:X">no</a>'
    assert column(spark, html.next_pages, [page]) == [[f"{html.SITE}/w/index.php?title=/wiki/Category:X&pagefrom=B", f"{html.SITE}/wiki/next"]]
    base = f"//{html.CDN}/wikipedia/commons/thumb/1/12/P.jpg"
    tag = f'<img src="{base}/120px-P.jpg" srcset="{base}/180px-P.jpg 1.5x, /static/x.svg 2x"><img src="/logo.png"><img src="{base}/90px-P.jpg">'
    thumb = f"https:{base}"
    assert column(spark, html.images, [tag]) == [[f"{thumb}/180px-P.jpg", f"{thumb}/90px-P.jpg"]]
    assert column(spark, lambda c: html.images(c, "enlarged"), [tag]) == [[f"{thumb}/1024px-P.jpg"]]
    assert column(spark, lambda c: html.images(c, "original"), [tag]) == [[f"https://{html.CDN}/wikipedia/commons/1/12/P.jpg"]]
    assert column(spark, html.images, ["", "<img>"]) == [[], []]


def test_quote(spark):
    values = ["a b", "é&(x)~*'!", "a/b:c", "100%_-.", "日本"]
    assert column(spark, html.quote, values) == [quote(v, safe="") for v in values]
    assert column(spark, lambda c: html.quote(c, ":_()-"), values) == [quote(v, safe=":_()-") for v in values]
    assert column(spark, html.unquote, ["a+b%20c", "%zz"]) == ["a+b c", "%zz"]


def test_first_matching(spark):
    rows = [[("Name", "x"), ("Author name", ""), ("CREATOR", "me")], [("Name", "x")], None]
    df = spark.createDataFrame([(i, None if m is None else dict(m)) for i, m in enumerate(rows)], "i int, m map<string,string>")
    assert [r[0] for r in df.orderBy("i").select(text.first_matching(F.col("m"), ["author", "creator"])).collect()] == ["me", "", ""]


def test_hamming(spark):
    rng = random.Random(1)
    pairs = [(f"{rng.getrandbits(256):064x}", f"{rng.getrandbits(256):064x}") for _ in range(50)] + [("f" * 64, "0" * 64)]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select(vectors.hamming_hex(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [(int(a, 16) ^ int(b, 16)).bit_count() for a, b in pairs]


def test_open_set_label(spark):
    df = spark.createDataFrame([([0.2, 0.5, 0.3],), ([0.4, 0.4, 0.2],), ([0.34, 0.33, 0.33],)], "p array<double>")
    classes = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    assert [r[0] for r in df.select(vectors.open_set_label(F.col("p"), classes, 0.4)).collect()] == ["b", "a", "other"]


def test_normalized(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    assert [r[0] for r in df.select(vectors.normalized(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_conform(spark):
    df = schema.conform(spark.createDataFrame([("t", None, 1)], "title string, creator string, pos int"))
    assert df.columns == [*schema.CANDIDATE.names, "pos"] and df.first().creator == "" and df.first().width == 0


@pytest.mark.parametrize("size", [(2000, 1000), (1281, 3), (100, 50), (5, 4000)])
def test_fitted(size):
    w, h = images.fitted(*size)
    assert max(w, h) <= 1280 and min(w, h) >= 1 and (max(size) > 1280 or (w, h) == size)
