"""Counts, funnels and validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def funnel(stages: list[tuple[str, DataFrame]], by: str) -> DataFrame:
    """(by, stage, ord, n): rows of each class after each stage."""
    parts = [df.groupBy(F.col(by)).agg(F.count("*").alias("n")).select(F.col(by), F.lit(name).alias("stage"), F.lit(i).alias("ord"), "n") for i, (name, df) in enumerate(stages)]
    return reduce(DataFrame.unionByName, parts)


def margin_report(df: DataFrame, by: str, value: str) -> DataFrame:
    """(by, n, low, middle, high): count, least, exact median and most."""
    return df.groupBy(by).agg(F.count("*").alias("n"), F.min(value).alias("low"), F.median(value).alias("middle"), F.max(value).alias("high"))


def distinct_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """(what, n, n_distinct) of each key."""
    parts = [df.agg(F.count("*").alias("n"), F.count_distinct(k).alias("n_distinct")).select(F.lit(k).alias("what"), "n", "n_distinct") for k in keys]
    return reduce(DataFrame.unionByName, parts)


def mean_vector(df: DataFrame, by: str, embedding: str = "embedding") -> DataFrame:
    """(by, i, x): normalised mean vector of each class, one row a component (i from 0)."""
    parts = df.select(by, F.posexplode(F.col(embedding).cast("array<double>")).alias("i", "x")).groupBy(by, "i").agg(F.avg("x").alias("x"))
    lengths = parts.groupBy(by).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("__l"))
    return parts.join(lengths, by).select(by, "i", (F.col("x") / (F.col("__l") + 1e-12)).alias("x"))


def violations(df: DataFrame, by: str, count: int, splits: dict[str, int], min_side: int = 180, identity: Column | None = None, digest: str = "sha256") -> DataFrame:
    """(rule, subject, found): every broken rule of a finished dataset; none: no row.

    Rules: rows of each class, rows of each class and split, no other split, shorter side,
    no digest twice and no identity twice. Classes without a row cannot show up here: pass
    them through missing_classes.
    """
    text = F.col(by).cast("string")
    out = [df.groupBy(text.alias("subject")).agg(F.count("*").alias("found")).filter(F.col("found") != count).select(F.lit("class_count").alias("rule"), "subject", "found")]
    wanted = F.create_map(*[F.lit(x) for p in splits.items() for x in p])
    sizes = df.groupBy(text.alias("c"), "split").agg(F.count("*").alias("found")).filter(F.col("found") != F.coalesce(F.try_element_at(wanted, F.col("split")), F.lit(0)))
    out.append(sizes.select(F.lit("split_count").alias("rule"), F.concat_ws("/", "c", "split").alias("subject"), "found"))
    if "width" in df.columns:
        small = df.filter(F.least("width", "height") < min_side).groupBy(text.alias("subject")).agg(F.count("*").alias("found"))
        out.append(small.select(F.lit("small_side").alias("rule"), "subject", "found"))
    for rule, key in [("digest_twice", F.col(digest) if digest in df.columns else None), ("identity_twice", identity)]:
        if key is not None:
            again = df.groupBy(key.cast("string").alias("subject")).agg(F.count("*").alias("found")).filter("found > 1")
            out.append(again.select(F.lit(rule).alias("rule"), "subject", "found"))
    return reduce(DataFrame.unionByName, out)


def unfit_images(images: DataFrame, min_side: int = 180) -> DataFrame:
    """(rule, subject, found) of image files that cannot be read, are not of three channels or
    are too small. images: path and image, as files.decoded_images gives them."""
    bad = F.when(F.col("image.height") <= 0, "unreadable").when(F.col("image.nChannels") != 3, "not_rgb").when(F.least("image.width", "image.height") < min_side, "small_side")
    return images.select(bad.alias("rule"), F.col("path").alias("subject"), F.lit(1).cast("long").alias("found")).filter("rule is not null")


def missing_classes(df: DataFrame, by: str, classes: DataFrame) -> DataFrame:
    absent = classes.select(by).join(df.select(by), by, "left_anti")
    return absent.select(F.lit("class_missing").alias("rule"), F.col(by).cast("string").alias("subject"), F.lit(0).cast("long").alias("found"))


def status(found: DataFrame) -> DataFrame:
    """One row: status ("ok" or "failed") and how many rules are broken."""
    return found.agg(F.count("*").alias("errors")).select(F.when(F.col("errors") == 0, "ok").otherwise("failed").alias("status"), "errors")


def leaks(names: DataFrame, column: str, tokens: list[str]) -> DataFrame:
    """Names that give a label away."""
    low = F.lower(F.col(column))
    return names.filter(reduce(Column.__or__, [F.contains(low, F.lit(t)) for t in tokens]))


def member_counts(names: DataFrame, column: str, prefixes: list[str]) -> DataFrame:
    """(prefix, n): names below each prefix, in one pass."""
    counts = names.agg(*[F.count_if(F.startswith(F.col(column), F.lit(p))).alias(f"c{i}") for i, p in enumerate(prefixes)])
    pairs = F.array(*[F.struct(F.lit(p).alias("prefix"), F.col(f"c{i}").alias("n")) for i, p in enumerate(prefixes)])
    return counts.select(F.inline(pairs))
