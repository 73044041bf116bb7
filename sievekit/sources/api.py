"""Candidate scans of paged web APIs.

``paged_api`` is a Python data source: one partition a request page, fetched on the
executors with retries. What fetches is named by a dotted path, so tests and air-gapped
clusters use a fake; pages come out as (page, body) rows and are parsed by the plain
functions below, which Catalyst can prune and push filters through.
"""

from __future__ import annotations

import importlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.html import SITE, quote
from ..functions.license import license_is_allowed
from ..functions.text import strip_html
from ..runtime import ship

#: What a scan yields, in this order.
COLUMNS = ["class_name", "source", "query", "image_url", "landing_url", "title", "creator", "license", "license_url", "source_id"]


@dataclass(frozen=True)
class Retry:
    """Waiting times, in seconds, after the a-th failed attempt (from 0)."""

    attempts: int = 4
    busy: tuple[float, float] = (3.0, 30.0)  # on status 429: factor of 2**a, most
    server: tuple[float, float] = (1.0, 15.0)  # on status 500 and above
    other: tuple[float, float] = (1.0, 10.0)  # on any other failure

    def wait(self, status: int | None, a: int) -> float:
        factor, most = self.busy if status == 429 else self.server if status is not None and status >= 500 else self.other
        return min(most, factor * 2**a)


#: Retries of the open-set scans' JSON requests; a server's error is a failure like any other.
OPEN_SET_RETRY = Retry(5, (2.0, float("inf")), (1.0, 10.0), (1.0, 10.0))


def http_fetch(params: dict) -> tuple[int, str]:
    """GET params["url"] with params["query"], a page's parameter named by params["page_name"]
    (without it the page goes nowhere); the status and the body."""
    query = dict(params.get("query", {}))
    if "page_name" in params:
        query[params["page_name"]] = params["page"]
    url = params["url"] + ("?" + urllib.parse.urlencode(query) if query else "")
    headers = {"User-Agent": params.get("agent", "sievekit/1"), "Accept": params.get("accept", "application/json")}
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=float(params.get("timeout", 35))) as answer:
            return answer.status, answer.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, ""


def fetch_with_retry(fetch: Callable[[dict], tuple[int, str]], params: dict, retry: Retry, sleep: Callable[[float], None] = time.sleep) -> str:
    """The body of the first answer below 400; an error after the last attempt."""
    problem: object = None
    for a in range(retry.attempts):
        try:
            status, body = fetch(params)
            if status < 400:
                return body
            problem = f"status {status}"
        except Exception as e:  # noqa: BLE001  any failure of a fetch is tried again
            status, problem = None, e
        if a + 1 < retry.attempts:
            sleep(retry.wait(status, a))
    raise RuntimeError(f"no answer after {retry.attempts} attempts: {problem}")


def folder_fetch(params: dict) -> tuple[int, str]:
    """A stand-in for the network: {folder}/{page}.json, 404 where there is none."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(params["folder"])
    target = f"{path}/{params['page']}.json"
    if system.get_file_info(target).type.name == "NotFound":
        return 404, ""
    with system.open_input_stream(target) as f:
        return 200, f.readall().decode()


class Page(InputPartition):
    def __init__(self, page: int):
        self.page = page


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        first, n = int(self.options.get("first_page", 1)), int(self.options.get("pages", 1))
        return [Page(first + i) for i in range(n)]

    def read(self, partition: Page):
        module, _, name = self.options.get("fetch", "sievekit.sources.api:folder_fetch").partition(":")
        fetch = getattr(importlib.import_module(module), name)
        params = json.loads(self.options.get("params", "{}")) | {"page": partition.page}
        try:
            yield partition.page, fetch_with_retry(fetch, params, Retry(attempts=int(self.options.get("attempts", 4))))
        except RuntimeError:
            # as a crawl does: a page that cannot be had ends nothing but itself
            if self.options.get("on_error", "skip") != "skip":
                raise


class PagedApi(DataSource):
    """Options: fetch ("module:function"), params (JSON), first_page, pages, attempts, on_error."""

    @classmethod
    def name(cls) -> str:
        return "paged_api"

    def schema(self) -> str:
        return "page int, body string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))


def paged_api(spark: SparkSession, **options: str) -> DataFrame:
    ship(spark)
    spark.dataSource.register(PagedApi)
    return spark.read.format("paged_api").options(**options).load()


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _filled(*values: Column) -> Column:
    """The first that is neither null nor empty; else empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def _candidates(rows: DataFrame, class_name: str, source: str, query: str, rule: str, limit: int | None, order: list[str], keep: tuple[str, ...] = (), **fields: Column) -> DataFrame:
    out = rows.select(*order, F.lit(class_name).alias("class_name"), F.lit(source).alias("source"), F.lit(query).alias("query"), *[v.alias(k) for k, v in fields.items()])
    out = out.filter(license_is_allowed(F.col("license"), rule) & (F.col("image_url") != ""))
    if limit is not None:
        out = out.orderBy(*order).limit(limit)
    return out.select(*keep, *COLUMNS)


_VALUE = "struct<value: string>"
_FILES = f"""struct<query: struct<pages: map<string, struct<pageid: bigint, title: string, imageinfo: array<struct<
  mime: string, url: string, thumburl: string, descriptionurl: string, extmetadata: struct<
  LicenseShortName: {_VALUE}, UsageTerms: {_VALUE}, LicenseUrl: {_VALUE}, Artist: {_VALUE}, ObjectName: {_VALUE}>>>>>>>"""


def file_details(bodies: DataFrame, class_name: str, query: str, rule: str = "core", require_landing: bool = False, limit: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Candidates of file detail answers (page, body): raster images with an accepted license.

    A missing landing page is built from the title, or with require_landing drops the row.
    """
    pages = bodies.select("page", F.explode(F.from_json("body", _FILES)["query"]["pages"]).alias("k", "p"))
    rows = pages.select("page", "k", F.col("p.pageid").alias("pageid"), F.col("p.title").alias("title"), F.get("p.imageinfo", F.lit(0)).alias("i")).filter("i is not null")
    mime = _text(F.col("i.mime"))
    rows = rows.filter(F.startswith(mime, F.lit("image/")) & ~mime.isin("image/svg+xml", "image/gif"))
    if require_landing:
        rows = rows.filter(_text(F.col("i.descriptionurl")) != "")
    meta = "i.extmetadata."
    built = F.concat(F.lit(f"{SITE}/wiki/"), quote(F.replace(_text(F.col("title")), F.lit(" "), F.lit("_")), "/"))
    return _candidates(
        rows, class_name, "wikimedia_commons", query, rule, limit, ["page", "k"], keep,
        image_url=_filled(F.col("i.thumburl"), F.col("i.url")), landing_url=F.coalesce(F.nullif(F.col("i.descriptionurl"), F.lit("")), built),
        title=strip_html(_filled(F.col(meta + "ObjectName.value"), F.col("title"))), creator=strip_html(F.col(meta + "Artist.value")),
        license=strip_html(_filled(F.col(meta + "LicenseShortName.value"), F.col(meta + "UsageTerms.value"))), license_url=_text(F.col(meta + "LicenseUrl.value")), source_id=_text(F.col("pageid").cast("string")),
    )


def category_files(walked: DataFrame, bodies: DataFrame, class_name: str, rule: str = "open_set", require_landing: bool = True) -> DataFrame:
    """Candidates of the files of all categories that a walk reached, each file once, under its
    nearest category (ties: the first by name). walked: node, depth; bodies: node, page, body,
    the file detail answers of each category. Categories without an answer have no candidates."""
    named = walked.join(bodies, "node").select("node", "depth", F.struct("depth", "node", "page").alias("page"), "body")
    found = file_details(named.drop("node", "depth"), class_name, "", rule, require_landing, keep=("page",))
    first = found.groupBy("image_url", "source_id").agg(F.min_by(F.struct(*COLUMNS, F.col("page.node").alias("__node")), "page").alias("c"))
    return first.select(*[F.col("c.__node").alias(c) if c == "query" else F.col(f"c.{c}") for c in COLUMNS])


def first_empty_page(bodies: DataFrame, items: Column) -> DataFrame:
    """Pages before the first one without items: a crawl stops there."""
    counted = bodies.withColumn("__n", F.coalesce(F.size(items), F.lit(0)))
    end = counted.filter("__n <= 0").agg(F.min("page")).first()[0]
    return (counted if end is None else counted.filter(F.col("page") < end)).drop("__n")


_IMAGES = "struct<results: array<struct<id: string, title: string, creator: string, license: string, license_url: string, url: string, thumbnail: string, foreign_landing_url: string, detail_url: string>>>"


def image_results(bodies: DataFrame, class_name: str, query: str, rule: str = "core", url_as_landing: bool = True, limit: int | None = None) -> DataFrame:
    """Candidates of image search answers (page, body), up to the first empty page."""
    items = F.from_json("body", _IMAGES)["results"]
    rows = first_empty_page(bodies, items).select("page", F.posexplode(items).alias("n", "r"))
    places = [F.col("r.foreign_landing_url"), F.col("r.detail_url")] + ([F.col("r.url")] if url_as_landing else [])
    rows = rows.withColumn("landing", _filled(*places)).filter("landing <> ''")
    return _candidates(
        rows, class_name, "openverse", query, rule, limit, ["page", "n"],
        image_url=_filled(F.col("r.thumbnail"), F.col("r.url")), landing_url=F.col("landing"), title=_text(F.col("r.title")), creator=_text(F.col("r.creator")),
        license=_text(F.col("r.license")), license_url=_text(F.col("r.license_url")), source_id=_text(F.col("r.id")),
    )


def taxon_id(bodies: DataFrame, name: str) -> int | None:
    """The id of the first result with that name, case apart, else of the first result."""
    items = F.from_json("body", "struct<results: array<struct<id: bigint, name: string>>>")["results"]
    rows = bodies.select("page", F.posexplode(items).alias("n", "r"))
    exact = (F.lower(_text(F.col("r.name"))) == name.lower()).cast("int")
    found = rows.orderBy(F.desc(exact), "page", "n").select("r.id").first()
    return found[0] if found else None


_SIGHTINGS = "struct<results: array<struct<id: bigint, uri: string, species_guess: string, user: struct<login: string>, photos: array<struct<id: bigint, url: string, license_code: string, attribution: string>>>>>"


def observation_photos(bodies: DataFrame, class_name: str, name: str, rule: str = "core", limit: int | None = None) -> DataFrame:
    """Candidates of observation answers: one a photo, large, with an accepted license."""
    items = F.from_json("body", _SIGHTINGS)["results"]
    seen = first_empty_page(bodies, items).select("page", F.posexplode(items).alias("n", "o"))
    rows = seen.select("page", "n", "o", F.posexplode("o.photos").alias("m", "p"))
    large = F.replace(F.replace(_text(F.col("p.url")), F.lit("/square."), F.lit("/large.")), F.lit("/small."), F.lit("/large."))
    page = F.concat(F.lit("https://www.inaturalist.org/observations/"), F.col("o.id").cast("string"))
    return _candidates(
        rows, class_name, "inaturalist", name, rule, limit, ["page", "n", "m"],
        image_url=large, landing_url=F.coalesce(F.nullif(F.col("o.uri"), F.lit("")), page), title=_filled(F.col("o.species_guess"), F.lit(name)),
        creator=_filled(F.col("p.attribution"), F.col("o.user.login")), license=_text(F.col("p.license_code")), license_url=F.lit("https://creativecommons.org/licenses/"),
        source_id=F.concat_ws(":", F.col("o.id").cast("string"), F.col("p.id").cast("string")),
    )


def species_key(bodies: DataFrame) -> int | None:
    answer = F.from_json("body", "struct<usageKey: bigint, speciesKey: bigint>")
    found = bodies.orderBy("page").select(F.coalesce(F.nullif(answer["usageKey"], F.lit(0)), answer["speciesKey"])).first()
    return found[0] if found else None


_RECORDS = "struct<endOfRecords: boolean, results: array<struct<key: bigint, references: string, license: string, scientificName: string, recordedBy: string, media: array<struct<identifier: string, references: string, license: string, title: string, creator: string>>>>>"


def occurrence_media(bodies: DataFrame, class_name: str, name: str, rule: str = "core", limit: int | None = None) -> DataFrame:
    """Candidates of occurrence answers: one a media item whose URL starts with http; the
    item's license counts before the occurrence's. Pages after the last record are ignored."""
    answer = F.from_json("body", _RECORDS)
    last = bodies.filter(answer["endOfRecords"]).agg(F.min("page")).first()[0]
    bodies = bodies if last is None else bodies.filter(F.col("page") <= last)
    items = F.from_json("body", _RECORDS)["results"]
    seen = first_empty_page(bodies, items).select("page", F.posexplode(items).alias("n", "o"))
    rows = seen.select("page", "n", "o", F.posexplode("o.media").alias("m", "p"))
    url = _filled(F.col("p.identifier"), F.col("p.references"))
    rows = rows.withColumn("url", url).filter(F.startswith("url", F.lit("http")))
    page = F.concat(F.lit("https://www.gbif.org/occurrence/"), F.col("o.key").cast("string"))
    return _candidates(
        rows, class_name, "gbif", name, rule, limit, ["page", "n", "m"],
        image_url=F.col("url"), landing_url=F.coalesce(F.nullif(F.col("o.references"), F.lit("")), page), title=_filled(F.col("p.title"), F.col("o.scientificName"), F.lit(name)),
        creator=_filled(F.col("p.creator"), F.col("o.recordedBy")), license=_filled(F.col("p.license"), F.col("o.license")), license_url=_text(F.col("p.license")),
        source_id=F.concat(F.col("o.key").cast("string"), F.lit(":"), _text(F.col("p.identifier"))),
    )


def union_scans(scans: list[Callable[[], DataFrame]]) -> tuple[DataFrame | None, list[str]]:
    """All scans that can be planned, one after the other, and what went wrong with others."""
    out, problems = None, []
    for scan in scans:
        try:
            part = scan()
        except Exception as e:  # noqa: BLE001  one query's failure leaves the others
            problems.append(f"{type(e).__name__}: {e}")
            continue
        out = part if out is None else out.unionByName(part)
    return out, problems
