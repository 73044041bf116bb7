"""Candidates from directories, archives and HTML galleries."""

from __future__ import annotations

import zipfile
from collections.abc import Callable
from pathlib import Path
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html
from ..functions.images import orientation
from ..operators.filters import at_least
from ..schema import seeded_order
from .api import COLUMNS


def unpack_once(archive: str, target: str) -> str:
    """Unpack a local archive unless its marker says that it was; returns the folder."""
    marker = Path(target, ".unpacked")
    if not marker.exists():
        with zipfile.ZipFile(archive) as z:
            z.extractall(target)
        marker.write_text("done")
    return target


def image_files(spark: SparkSession, root: str, pattern: str = "*.{jpg,jpeg,JPG,JPEG}", content: bool = False) -> DataFrame:
    """(path, n_bytes[, content]) of image files below root, distinct."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    return files.select("path", F.col("length").alias("n_bytes"), *(["content"] if content else []))


def decoded_images(spark: SparkSession, root: str, pattern: str = "*.{jpg,jpeg,png,JPG,JPEG,PNG}") -> DataFrame:
    """(path, image, orientation) of image files below root; files that cannot be decoded have
    a height below 0. Pixels are as stored: images.turned applies the orientation."""
    images = spark.read.format("image").option("dropInvalid", False).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    heads = image_files(spark, root, pattern, content=True).select("path", F.col("content"))

    @F.pandas_udf("int")
    def turn(content: pd.Series) -> pd.Series:
        return content.map(orientation)

    # the two sources write local paths with one slash and with three
    same = F.regexp_replace("path", "^file:/+", "file:/")
    decoded = images.select(F.col("image.origin").alias("path"), "image").withColumn("path", same)
    return decoded.join(heads.select(same.alias("path"), turn("content").alias("orientation")), "path")


def class_files(spark: SparkSession, root: str, class_name: str, seed: int, least: int = 100, splits: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """(path, n_bytes, key) of {split}/{class}/*.jpg below root in a seeded order; too few
    are an error."""
    inside = F.lit(False)
    for s in splits:
        inside = inside | F.contains("path", F.lit(f"/{s}/{class_name}/"))
    files = image_files(spark, root).filter(inside)
    return at_least(files, least, f"files of {class_name}").withColumn("key", seeded_order(seed, F.col("path")))


def as_candidates(files: DataFrame, class_name: str, source: str, query: str, landing_url: str, license_name: str, license_url: str) -> DataFrame:
    """Files as candidates with constant metadata; the path is URL and identity."""
    constant = {"class_name": class_name, "source": source, "query": query, "landing_url": landing_url, "license": license_name, "license_url": license_url, "creator": ""}
    title = F.regexp_replace(F.substring_index("path", "/", -1), r"\.[^.]*$", "")
    rows = files.withColumns({k: F.lit(v) for k, v in constant.items()}).withColumns({"image_url": F.col("path"), "source_id": F.substring_index("path", "/", -1), "title": title})
    return rows.select(*COLUMNS)


def probed(spark: SparkSession, n: int, name: Callable[[Column], Column], exists: DataFrame, size: int = 100) -> DataFrame:
    """(pos, name, valid): names tried in order, and whether each is there with content."""
    tried = spark.range(n).select(F.col("id").alias("pos"), name(F.col("id")).alias("name"))
    there = exists.filter(F.col("n_bytes") > 1000).select("name").distinct().withColumn("valid", F.lit(True))
    return tried.join(there, "name", "left").select("pos", "name", F.coalesce("valid", F.lit(False)).alias("valid"))


def gallery_pages(fetch: Callable[[str], str | None], first: str, most: int = 5, site: str = html.SITE, spark: SparkSession | None = None) -> list[tuple[str, str]]:
    """(url, html) of a category's pages, following continuation links; at most ``most``.

    A handful of pages and a chain of requests: a loop on the driver. A missing page counts
    as empty.
    """
    todo, seen, out = [first], set(), []
    while todo and len(out) < most:
        url = todo.pop(0)
        if url in seen:
            continue
        seen.add(url)
        body = fetch(url) or ""
        out.append((url, body))
        if spark is not None and body:
            links = spark.createDataFrame([(body,)], "html string").select(html.next_pages(F.col("html"), site)).first()[0]
            todo += [urljoin(site, x) for x in links]
    return out


def gallery_files(pages: DataFrame, class_name: str, seed: int) -> DataFrame:
    """Candidates of file links (html) in galleries, distinct, in a seeded order."""
    names = pages.select(F.explode(html.file_links(F.col("html"))).alias("name")).distinct()
    rows = names.select(
        F.lit(class_name).alias("class_name"), F.lit("wikimedia_commons").alias("source"), F.lit(class_name).alias("query"), html.file_image_url(F.col("name")).alias("image_url"), html.file_page_url(F.col("name")).alias("landing_url"),
        F.col("name").alias("title"), F.lit("").alias("creator"), F.lit("see landing page").alias("license"), F.lit("").alias("license_url"), F.col("name").alias("source_id"),
    )
    return rows.withColumn("key", seeded_order(seed + 313 * len(class_name), F.col("source_id")))


def gallery_images(pages: DataFrame, class_name: str, seed: int, rule: str = "published") -> DataFrame:
    """Candidates of gallery thumbnails, distinct, in a seeded order; the URL is the identity."""
    urls = pages.select(F.explode(html.images(F.col("html"), rule)).alias("url")).distinct()
    rows = urls.select(
        F.lit(class_name).alias("class_name"), F.lit("wikimedia_commons").alias("source"), F.lit(class_name).alias("query"), F.col("url").alias("image_url"), F.col("url").alias("landing_url"),
        html.unquote(F.substring_index("url", "/", -1)).alias("title"), F.lit("").alias("creator"), F.lit("see landing page").alias("license"), F.lit("").alias("license_url"), F.col("url").alias("source_id"),
    )
    return rows.withColumn("key", seeded_order(seed + 911 * len(class_name), F.col("source_id")))
