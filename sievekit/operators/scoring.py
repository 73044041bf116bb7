"""Scores of embeddings against prompt embeddings.

Prompts are a small fixed set; they go into the plan as literals or come from a table whose
size is checked.
"""

from __future__ import annotations

import importlib
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vectors
from ..runtime import ship
from .lookups import lookup_side

#: Prompts up to which they are collected and broadcast inside the plan.
MAX_PROMPTS = 4096


class Encoder(Protocol):
    """What a model must offer; none is bundled."""

    def encode_texts(self, texts: list[str]) -> list[list[float]]: ...

    def encode_images(self, images: DataFrame) -> DataFrame: ...


def encoded(df: DataFrame, column: str, encoder: str, out: str = "embedding", size: int = 32) -> DataFrame:
    """df with ``out``, the normalised vector (array<float>) of a column, by a model on the
    executors.

    encoder: "module:function"; the function takes nothing and returns a model, once a worker,
    whose ``encode`` takes a list of at most ``size`` values that are not null and returns a
    vector for each. A null value has a null vector.
    """
    ship(df.sparkSession)
    schema = T.StructType([*[f for f in df.schema.fields if f.name != out], T.StructField(out, T.ArrayType(T.FloatType()))])
    others = [f.name for f in schema.fields[:-1]]
    rows = df.select(*others, F.col(column).alias("__value"))

    def run(batches):
        module, _, name = encoder.partition(":")
        model = getattr(importlib.import_module(module), name)()
        for batch in batches:
            values = batch.column(len(others)).to_pylist()
            at, found = [i for i, v in enumerate(values) if v is not None], [None] * len(values)
            for lo in range(0, len(at), size):
                part = at[lo : lo + size]
                unit = np.asarray(model.encode([values[i] for i in part]), np.float64)
                unit = unit / (np.linalg.norm(unit, axis=1, keepdims=True) + vectors.FLOOR)
                for i, v in zip(part, unit.tolist(), strict=True):
                    found[i] = v
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], pa.array(found, pa.list_(pa.float32()))], [*others, out])

    return rows.mapInArrow(run, schema)


class LetterCounts:
    """A stand-in for a text model: how often each of a few letters occurs."""

    def encode(self, values: list[str]) -> list[list[float]]:
        return [[float(v.count(x)) for x in "aeiou"] for v in values]


def prompt_list(prompts: DataFrame, vector: str = "embedding", order: str = "ord") -> list[list[float]]:
    """The prompts' normalised vectors; more than MAX_PROMPTS is an error."""
    rows = prompts.select(vectors.normalized(vectors.doubles(F.col(vector))).alias("v"), F.col(order).alias("o")).orderBy("o").limit(MAX_PROMPTS + 1).collect()
    if len(rows) > MAX_PROMPTS:
        raise ValueError(f"more than {MAX_PROMPTS} prompts")
    return [list(r["v"]) for r in rows]


def literal(v: list[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in v])


def centroid(prompts: list[list[float]]) -> list[float]:
    """The normalised mean."""
    mean = [sum(x) / len(prompts) for x in zip(*prompts, strict=True)]
    length = sum(x * x for x in mean) ** 0.5 + vectors.FLOOR
    return [x / length for x in mean]


def best(unit: Column, prompts: list[list[float]]) -> Column:
    """The largest dot product with any prompt."""
    return F.array_max(F.transform(F.array(*[literal(p) for p in prompts]), lambda p: vectors.dot(unit, p)))


def _scored(df: DataFrame, embedding: str, positive, negative, margin=None) -> DataFrame:
    rows = df.withColumn("__u", vectors.normalized(vectors.doubles(F.col(embedding))))
    rows = rows.withColumns({"clip_positive": positive(F.col("__u")), "clip_negative": negative(F.col("__u"))})
    value = F.col("clip_positive") - F.col("clip_negative") if margin is None else margin(F.col("__u"))
    return rows.withColumn("clip_margin", value).drop("__u")


def score_mean(df: DataFrame, positive: list[list[float]], negative: list[list[float]], embedding: str = "embedding") -> DataFrame:
    """Dot product with the positive centroid, less the best negative prompt."""
    middle = literal(centroid(positive))
    return _scored(df, embedding, lambda u: vectors.dot(u, middle), lambda u: best(u, negative))


def score_max(df: DataFrame, positive: list[list[float]], negative: list[list[float]], embedding: str = "embedding") -> DataFrame:
    """Best positive prompt, less the best negative one."""
    return _scored(df, embedding, lambda u: best(u, positive), lambda u: best(u, negative))


def score_visible(df: DataFrame, positive, negative, visible, invisible, weight: float = 0.85, embedding: str = "embedding") -> DataFrame:
    """Best of all positive prompts and best of all negative ones; the margin also counts the
    difference of the visibility prompts."""

    def margin(u: Column) -> Column:
        return F.col("clip_positive") - F.col("clip_negative") + weight * (best(u, visible) - best(u, invisible))

    return _scored(df, embedding, lambda u: best(u, positive + visible), lambda u: best(u, negative + invisible), margin)


def color_margin(raw: Column, green: Column, red: Column) -> Column:
    """A raw margin raised by green and lowered by red beyond a tolerance."""
    return raw + 0.12 * F.least(green, F.lit(0.45)) - 1.20 * F.greatest(F.lit(0.0), red - 0.018)


def percentile_scaled(df: DataFrame, value: str, out: str, by: list[str] | None = None, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """value between its exact low and high percentile, as 0 to 1; all 1 where they meet."""
    groups = by or []
    ends = df.groupBy(*groups).agg(F.percentile(value, low).alias("__low"), F.percentile(value, high).alias("__high"))
    rows = df.join(lookup_side(ends), groups) if groups else df.join(F.broadcast(ends.withColumn("__one", F.lit(1))), F.lit(1) == F.col("__one")).drop("__one")
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(value) - F.col("__low")) / (F.col("__high") - F.col("__low"))))
    return rows.withColumn(out, F.when(F.col("__high") > F.col("__low"), share).otherwise(1.0)).drop("__low", "__high")
