"""Manifests, reports, checksums and archives."""

from __future__ import annotations

import hashlib
import json
import uuid
import zipfile
from collections.abc import Iterable
from functools import reduce
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import images, jpeg
from ..runtime import numbered, ship

# Columns of the manifest, in order.
MANIFEST = ["relative_path", "class", "split", "source", "source_id", "query", "title", "creator", "license", "license_url", "landing_url", "download_url", "width", "height", "sha256", "phash", "dhash", "whash", "mirror_phash", "clip_positive", "clip_negative", "clip_margin"]


def manifest(df: DataFrame) -> DataFrame:
    """The manifest's text columns, ordered by class, split and name."""
    new = {"relative_path": F.concat_ws("/", "split", "class_name", "output_name"), "class": F.col("class_name"), "download_url": F.col("image_url")}
    new |= {c: F.format_string("%.8f", F.col(c)) for c in ("clip_positive", "clip_negative", "clip_margin")}
    rows = df.orderBy("class_name", "split", "output_name")
    return rows.select(*[F.coalesce(new.get(c, F.col(c) if c not in new else None).cast("string"), F.lit("")).alias(c) for c in MANIFEST])


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """CSV files with a header, in a folder; spreadsheets get a byte order mark from
    csv_bytes."""
    writer = df.write.option("header", "true").option("emptyValue", "")
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def csv_bytes(df: DataFrame, most: int = 1_000_000) -> bytes:
    """A small table as one CSV file with a byte order mark; more rows than most are an
    error."""
    rows = df.limit(most + 1).toPandas()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    return b"\xef\xbb\xbf" + rows.to_csv(index=False).encode()


def _system(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root if "://" in root else "file://" + root.removeprefix("file:"))


def put(root: str, name: str, content: bytes) -> None:
    """Write a file below root under a name of its own first, then move it: it is whole or
    not there, and an attempt that repeats replaces it by the same bytes."""
    system, base = _system(root)
    path = f"{base.rstrip('/')}/{name}"
    folder, _, last = path.rpartition("/")
    system.create_dir(folder, recursive=True)
    part = f"{folder}/.{last}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(content)
    try:
        system.move(part, path)
    except OSError:
        # some stores do not move onto a file: an earlier attempt's, with the same bytes
        if system.get_file_info(path).size != len(content):
            raise
        system.delete_file(part)


def write_manifest(df: DataFrame, root: str, credits: bytes | None = None) -> None:
    """manifest.csv below root, with a byte order mark, and credits.csv beside it if given."""
    put(root, "manifest.csv", csv_bytes(manifest(df)))
    if credits is not None:
        put(root, "credits.csv", credits)


def write_files(df: DataFrame, root: str) -> DataFrame:
    """Write each row's content (binary) to its name, a path below root; (name, n_bytes,
    sha256) of the files. Names are different. The files are written when the result is read."""
    ship(df.sparkSession)

    def run(batches):
        for batch in batches:
            names, contents = (batch.column(i).to_pylist() for i in range(2))
            for name, content in zip(names, contents, strict=True):
                put(root, name, content)
            yield _written(names, contents)

    return df.select("name", "content").mapInArrow(run, "name string, n_bytes long, sha256 string")


def _written(names: list[str], contents: list[bytes]) -> pa.RecordBatch:
    digests = [hashlib.sha256(c).hexdigest() for c in contents]
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([len(c) for c in contents], pa.int64()), pa.array(digests, pa.string())], ["name", "n_bytes", "sha256"])


def write_images(df: DataFrame, root: str, longest: int = 1280, least: int | None = None, quality: int = 94) -> DataFrame:
    """Write each row's image as a JPEG file to its name, a path below root; (name, width,
    height, n_bytes, sha256) of what was written.

    df: name, different; image, as Spark's image source gives it; and, if it has the column,
    orientation. Images are turned upright, without metadata, shrunk to ``longest`` and, if
    ``least`` is given, enlarged until the shorter side has that. A null or undecoded image is
    not written and has null for all but its name. The files are written when the result is
    read.
    """
    ship(df.sparkSession)
    turn = F.col("orientation") if "orientation" in df.columns else F.lit(1)
    rows = df.select("name", "image.height", "image.width", "image.nChannels", "image.data", turn.cast("int").alias("orientation"))
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("n_bytes", T.LongType()), T.StructField("sha256", T.StringType())])

    def one(row: dict) -> dict:
        out = dict.fromkeys(schema.names) | {"name": row["name"]}
        if row["data"] and row["height"] and row["height"] > 0:
            a = images.prepared(images.turned(images.rgb(row), row["orientation"] or 1), longest, least)
            content = jpeg.encode(a, quality)
            put(root, row["name"], content)
            out |= {"width": a.shape[1], "height": a.shape[0], "n_bytes": len(content), "sha256": hashlib.sha256(content).hexdigest()}
        return out

    def run(batches: Iterable[pa.RecordBatch]):
        kinds = pa.schema([("name", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("n_bytes", pa.int64()), ("sha256", pa.string())])
        for batch in batches:
            for i in range(0, batch.num_rows, 16):
                yield pa.RecordBatch.from_pylist([one(r) for r in batch.slice(i, 16).to_pylist()], kinds)

    return rows.mapInArrow(run, schema)


def ragged_union(parts: list[DataFrame]) -> DataFrame:
    """Tables of different columns as one: all columns sorted, text, missing cells empty."""
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return both.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in sorted(both.columns)])


def contact_grid(df: DataFrame, order: list[Column], columns: int = 10) -> DataFrame:
    """df with row, col and label of a contact sheet."""
    label = F.format_string("%03d %s m=%+.3f", F.col("__i") + 1, F.substring("source", 1, 9), F.col("clip_margin"))
    rows = numbered(df, "__i", order).withColumn("__i", F.col("__i") - 1)
    return rows.withColumns({"row": F.floor(F.col("__i") / columns), "col": (F.col("__i") % columns).cast("int"), "label": label}).drop("__i")


def checksums(spark: SparkSession, root: str, itself: str = "checksums.txt") -> DataFrame:
    """(sha256, path) of every file below root but the list itself, by relative path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    below = F.regexp_replace("path", r"^.*?" + root.rstrip("/").rsplit("/", 1)[-1] + "/", "")
    return files.select(F.sha2("content", 256).alias("sha256"), below.alias("path")).filter(F.col("path") != itself).orderBy("path")


def json_report(df: DataFrame) -> DataFrame:
    """Each row as one JSON object."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def zip_folder(root: str, target: str) -> list[str]:
    """Pack a local folder, paths sorted; returns the names after reading the archive back."""
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED, compresslevel=9) as z:
        for p in sorted(x for x in Path(root).rglob("*") if x.is_file()):
            z.write(p, p.relative_to(root).as_posix())
    with zipfile.ZipFile(target) as z:
        if (bad := z.testzip()) is not None:
            raise ValueError(f"{bad} cannot be read back")
        return z.namelist()


def notice(counts: DataFrame, title: str) -> str:
    """A README's text: a line for each class and split of (class_name, split, n)."""
    rows = counts.orderBy("class_name", "split").collect()
    return "\n".join([f"# {title}", "", *[f"- {r['class_name']} / {r['split']}: {r['n']}" for r in rows], ""])


def write_failure(root: str, stage: str, error: Exception) -> None:
    """build_error.json and build_error.txt below root; the caller raises the error again."""
    put(root, "build_error.json", failure(stage, error).encode())
    put(root, "build_error.txt", f"{stage}: {type(error).__name__}: {error}\n".encode())


def failure(stage: str, error: Exception) -> str:
    """A failed build's report as JSON; the error itself goes on."""
    return json.dumps({"status": "failed", "stage": stage, "error": f"{type(error).__name__}: {error}"})
