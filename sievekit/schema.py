"""The candidate record and its identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT = ["class_name", "source", "query", "image_url", "landing_url", "title", "creator", "license", "license_url", "source_id", "local_path"]
_HASHES = ["sha256", "phash", "dhash", "whash", "mirror_phash"]

CANDIDATE = T.StructType(
    [T.StructField(n, T.StringType()) for n in _TEXT]
    + [T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]
    + [T.StructField(n, T.StringType()) for n in _HASHES]
    + [T.StructField(n, T.DoubleType()) for n in ("clip_positive", "clip_negative", "clip_margin")]
    + [T.StructField("clip_embedding", T.ArrayType(T.FloatType())), T.StructField("split", T.StringType()), T.StructField("output_name", T.StringType())]
)


def conform(df: DataFrame) -> DataFrame:
    """df as candidates: missing columns get defaults, null texts become empty, others stay."""
    defaults = {T.StringType(): F.lit(""), T.IntegerType(): F.lit(0), T.DoubleType(): F.lit(0.0)}
    out = []
    for field in CANDIDATE.fields:
        default = defaults.get(field.dataType, F.array().cast(field.dataType))
        value = F.coalesce(F.col(field.name).cast(field.dataType), default) if field.name in df.columns else default
        out.append(value.cast(field.dataType).alias(field.name))
    extra = [F.col(c) for c in df.columns if c not in CANDIDATE.names]
    return df.select(*out, *extra)


def stable_key() -> Column:
    """Identity of a candidate and last tie-breaker of every order."""
    parts = ["class_name", "source", "source_id", "image_url", "landing_url"]
    return F.concat_ws("|", *[F.coalesce(F.col(p), F.lit("")) for p in parts])


def url_key(url: Column) -> Column:
    """The URL without its query string."""
    return F.substring_index(url, "?", 1)


def seeded_order(seed: int | str, *identity: Column) -> Column:
    """A hash to order by: a shuffle that every engine can repeat."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *identity))
