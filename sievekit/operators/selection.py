"""Selection: diversity, top-k, priorities, prefixes, quotas and early stops."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors
from ..runtime import shared_dir, ship, stored
from ..schema import seeded_order
from .lookups import lookup_side
from .scoring import percentile_scaled

#: Rows of a pool that one task selects from; larger ones are selected from in rounds.
MAX_POOL = 20_000


def quality(df: DataFrame, by: list[str]) -> DataFrame:
    """0.7 of the scaled margin and 0.3 of the scaled positive score, within each group."""
    rows = percentile_scaled(percentile_scaled(df, "clip_margin", "__m", by), "clip_positive", "__p", by)
    return rows.withColumn("quality", 0.7 * F.col("__m") + 0.3 * F.col("__p")).drop("__m", "__p")


def farthest_first(unit: np.ndarray, quality: np.ndarray, k: int) -> list[int]:
    """Rows in the order chosen: the best first, then whichever has most of quality and
    distance to those chosen; the first row wins ties."""
    chosen = [int(np.argmax(quality))]
    distance = 1.0 - unit @ unit[chosen[0]]
    while len(chosen) < k:
        value = 0.62 * quality + 0.38 * np.clip(distance / 0.35, 0.0, 1.0)
        value[chosen] = -np.inf
        chosen.append(int(np.argmax(value)))
        distance = np.minimum(distance, 1.0 - unit @ unit[chosen[-1]])
    return chosen


def diverse_select(df: DataFrame, k: int, by: str, embedding: str = "embedding", id_col: str = "pos", strict: bool = True, room: int = MAX_POOL) -> DataFrame:
    """(by, id, place): k rows of each group, in the order chosen (place from 1).

    df: quality, embedding and an id that orders ties. A group of fewer than k rows is an
    error, or left out if not strict. Groups of up to ``room`` rows are selected from in one
    task each; larger ones in k rounds over all tasks.
    """
    spark = df.sparkSession
    ship(spark)
    rows = df.select(F.col(by), F.col(id_col).cast("long").alias(id_col), "quality", vectors.normalized(vectors.doubles(F.col(embedding))).alias("__v"))
    rows = stored(rows, f"{shared_dir(spark)}/pools")
    sizes = rows.groupBy(by).agg(F.count("*").alias("__n"))
    least, most = sizes.agg(F.min("__n"), F.max("__n")).first()
    if strict and least is not None and least < k:
        raise ValueError(f"a pool of {least} rows; {k} are required")

    def choose(pool: pd.DataFrame) -> pd.DataFrame:
        pool = pool.sort_values(id_col, kind="stable").reset_index(drop=True)
        at = farthest_first(np.stack(pool["__v"].to_numpy()), pool["quality"].to_numpy(np.float64), k)
        return pd.DataFrame({by: pool[by].to_numpy()[at], id_col: pool[id_col].to_numpy()[at], "place": np.arange(1, k + 1, dtype=np.int32)})

    kind = dict(df.dtypes)[by]
    fits = rows.join(lookup_side(sizes.filter(F.col("__n").between(k, room))), by, "left_semi")
    out = fits.groupBy(by).applyInPandas(choose, f"{by} {kind}, {id_col} long, place int")
    if most is None or most <= room or most < k:
        return out
    return out.unionByName(_in_rounds(rows.join(lookup_side(sizes.filter(F.col("__n") >= max(k, room + 1))), by, "left_semi"), k, by, id_col))


def _in_rounds(rows: DataFrame, k: int, by: str, id_col: str) -> DataFrame:
    """farthest_first over groups of any size: a round finds each group's best row by partial
    maxima and lowers all distances by it."""
    work = shared_dir(rows.sparkSession)
    state, chosen = rows.withColumn("__d", F.lit(None).cast("double")), []
    for place in range(1, k + 1):
        near = F.when(F.col("__d").isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("__d") / 0.35)))
        value = F.when(F.col("__d").isNull(), F.col("quality")).otherwise(0.62 * F.col("quality") + 0.38 * near)
        best = state.groupBy(by).agg(F.max_by(F.struct(id_col, "__v"), F.struct(value, -F.col(id_col))).alias("__best"))
        best = stored(best.select(by, F.col(f"__best.{id_col}").alias("__id"), F.col("__best.__v").alias("__w")), f"{work}/best{place}")
        chosen.append(best.select(by, F.col("__id").alias(id_col), F.lit(place).cast("int").alias("place")))
        if place < k:
            away = 1.0 - vectors.dot(F.col("__v"), F.col("__w"))
            state = state.join(lookup_side(best), by).filter(F.col(id_col) != F.col("__id")).select(*rows.columns, F.least("__d", away).alias("__d"))
            state = stored(state, f"{work}/state{place}")
    return reduce(DataFrame.unionByName, chosen)


def nearest_pairs(unit: DataFrame, k: int = 20, floor: float = 0.0) -> DataFrame:
    """The k most similar pairs (lo, hi, similarity), larger positions first on ties.

    Pairs below floor do not count. Each product of blocks keeps its k best. The k best pairs
    within blocks come first: the least of them bounds which other blocks are compared.
    """
    from .dedup import Blocks

    blocks, order = Blocks(unit), [F.desc("similarity"), F.desc("lo"), F.desc("hi")]
    first = blocks.pairs(floor, k, own=True).orderBy(*order).limit(k).collect()
    if len(first) == k:
        floor = max(floor, first[-1]["similarity"] - 1e-9)
    return blocks.pairs(floor, k).orderBy(*order).limit(k)


def top_per_group(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(rank) <= k)


def priority_merge(df: DataFrame, priority: list[str], seed: int, identity: Column) -> DataFrame:
    """df with (turn, key): sources by priority, each shuffled with a seed of its own; other
    sources last."""
    turn = F.lit(len(priority))
    key = seeded_order(seed + len(priority) + 1, identity)
    for i, name in reversed(list(enumerate(priority))):
        turn = F.when(F.col("source") == name, i).otherwise(turn)
        key = F.when(F.col("source") == name, seeded_order(seed + i + 1, identity)).otherwise(key)
    return df.withColumns({"turn": turn, "key": key})


def prefer_source(df: DataFrame, source: str, identity: Column, cap: int | None = None) -> DataFrame:
    """Rows of one source first, then by identity; at most cap."""
    out = df.orderBy(F.when(F.col("source") == source, 0).otherwise(1), identity)
    return out if cap is None else out.limit(cap)


def prefix(df: DataFrame, n: int, pos: str = "pos") -> DataFrame:
    """The first n rows by position, positions counting from 0 without gaps."""
    return df.filter(F.col(pos) < n)


def batch_of(pos: Column, size: int) -> Column:
    """Number of the fixed-size batch of a position that counts from 0."""
    return F.floor(pos / size)


def early_stop(df: DataFrame, valid: Column, target: int, size: int = 64, cap: int | None = None, pos: str = "pos") -> DataFrame:
    """Valid rows up to the end of the batch in which target of them is reached.

    df: pos counts from 0 without gaps. Counts are taken by batch, and only the table of
    batches is scanned in order.
    """
    rows = df.withColumn("__valid", valid).withColumn("batch", batch_of(F.col(pos), size))
    if cap is not None:
        rows = prefix(rows, cap, pos)
    sums = rows.groupBy("batch").agg(F.count_if("__valid").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    live = sums.withColumn("__before", before).filter(F.col("__before") < target).select("batch")
    return rows.join(live, "batch", "left_semi").filter("__valid").drop("__valid")


def low_yield_stop(df: DataFrame, valid: Column, size: int = 100, poor: int = 3, streak: int = 3, start: int = 200, target: int = 500, pos: str = "pos") -> DataFrame:
    """(batch, n_valid) of the batches that are fetched: until target valid rows, or until
    ``streak`` batches in a row, from position ``start`` on, have fewer than ``poor``."""
    sums = df.withColumn("batch", batch_of(F.col(pos), size)).groupBy("batch").agg(F.count_if(valid).alias("n_valid"))
    order = Window.orderBy("batch")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    weak = (F.col("n_valid") < poor) & (F.col("batch") * size >= start)
    marked = sums.withColumn("weak", weak.cast("int")).withColumn("island", F.sum(1 - weak.cast("int")).over(order))
    marked = marked.withColumn("run", F.sum("weak").over(Window.partitionBy("island").orderBy("batch")))
    done = F.coalesce(F.max((F.col("run") >= streak).cast("int")).over(earlier), F.lit(0)) == 1
    full = F.coalesce(F.sum("n_valid").over(earlier), F.lit(0)) >= target
    return marked.withColumn("__stop", done | full).filter("not __stop").select("batch", "n_valid")


def stratified_sample(df: DataFrame, by: str, n: int, seed: int, identity: Column) -> DataFrame:
    """n rows of each class, by a seeded shuffle."""
    return top_per_group(df, [by], [seeded_order(seed, identity), identity], n)


def quota_split(df: DataFrame, by: str, quotas: dict[str, int], seed: int, identity: Column) -> DataFrame:
    """Rows of each class in a seeded order, cut into splits of fixed sizes; the rest goes."""
    rows = top_per_group(df, [by], [seeded_order(seed, identity), identity], sum(quotas.values()), "place")
    split, end = F.lit(None).cast("string"), sum(quotas.values())
    for name, n in reversed(list(quotas.items())):
        split = F.when(F.col("place") <= end, name).otherwise(split)
        end -= n
    return rows.withColumn("split", split)
