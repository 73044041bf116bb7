"""Reproducible splits, output names and hidden-label test sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import numbered_name
from ..runtime import numbered
from ..schema import seeded_order
from .lookups import lookup_side


def assign_splits(df: DataFrame, by: str, seed: int, identity: Column, train: float = 0.70, val: float = 0.15) -> DataFrame:
    """df with split: within each class, shuffled, train and val take their share, rounded
    half to even, and test the rest. val = 0 leaves no validation rows."""
    n = F.col("__n")
    first = F.bround(n * F.lit(train), 0)
    second = first + (F.bround(n * F.lit(val), 0) if val else F.lit(0))
    rows = numbered(df, "__i", [seeded_order(seed, identity), identity], [by])
    sizes = df.groupBy(F.col(by).alias("__class")).agg(F.count("*").alias("__n"))
    rows = rows.join(lookup_side(sizes), F.col(by).eqNullSafe(F.col("__class"))).withColumn("__i", F.col("__i") - 1)
    split = F.when(F.col("__i") < first, "train").when(F.col("__i") < second, "val").otherwise("test")
    return rows.withColumn("split", split).select(*[c for c in df.columns if c != "split"], "split")


def named_outputs(df: DataFrame, by: str, score: Column, identity: Column) -> DataFrame:
    """df with output_name, numbered by split, falling score and identity within a class."""
    turn = F.when(F.col("split") == "train", 0).when(F.col("split") == "val", 1).otherwise(2)
    rows = numbered(df, "__number", [turn, F.desc(score), identity], [by])
    return rows.withColumn("output_name", numbered_name(F.col(by).cast("string"), F.col("__number"), 3)).drop("__number")


def hidden_test(targets: DataFrame, others: DataFrame, seed: int, identity: Column) -> DataFrame:
    """Both sets in one seeded order with neutral names: name and label, and the rows' columns.

    others get the label "other". Split the result with public_part and truth.
    """
    both = targets.unionByName(others.withColumn("label", F.lit("other")))
    rows = numbered(both, "__place", [seeded_order(seed, identity), identity])
    return rows.withColumn("name", numbered_name(F.lit("image"), F.col("__place"), 4)).drop("__place")


def public_part(hidden: DataFrame, columns: list[str]) -> DataFrame:
    return hidden.select("name", *columns)


def truth(hidden: DataFrame) -> DataFrame:
    return hidden.select("name", "label")
