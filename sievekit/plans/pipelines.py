"""The two curation pipelines as compositions; what differs between variants is a parameter."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import dedup, filters, reports, selection, splits


@dataclass
class Policy:
    """Choices of a pipeline; every hook takes and returns a DataFrame."""

    count: int
    seed: int
    score: Callable[[DataFrame], DataFrame]
    pool: Callable[[DataFrame, int], DataFrame] = filters.core_pool
    threshold: float = 0.992
    relaxed: float = 0.996
    train: float = 0.70
    val: float = 0.15
    before: list[Callable[[DataFrame], DataFrame]] = field(default_factory=list)


def closed_set(candidates: DataFrame, classes: list, policy: Policy, by: str = "class_name", embedding: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """(selected, funnel): per class gate, score, pool, embedding dedup, diverse selection;
    then splits and names. candidates: by, pos and what the hooks read."""
    rows = candidates
    for stage in policy.before:
        rows = stage(rows)
    stages: dict[str, list[DataFrame]] = {"scored": [], "pool": [], "distinct": [], "selected": []}
    for i, name in enumerate(classes):
        scored = policy.score(rows.filter(F.col(by) == name))
        pool = policy.pool(scored, policy.count)
        order = pool.withColumn("cand", F.col("pos")).drop("pos")
        ranked = selection.top_per_group(order, [by], [F.desc("clip_margin"), F.desc("clip_positive"), F.col("cand")], 1 << 30, "pos")
        marks, _ = dedup.adaptive_deduplicate(ranked.select("pos", F.col(embedding).alias("embedding")), policy.count, policy.threshold, policy.relaxed)
        distinct = filters.at_least(ranked.join(marks.filter("kept").select("pos"), "pos"), policy.count, f"distinct {name}")
        chosen = selection.diverse_select(selection.quality(distinct, [by]), policy.count, by, embedding)
        picked = distinct.join(chosen.select("pos", "place"), "pos").withColumn("pos", F.col("cand"))
        split = splits.assign_splits(picked, by, policy.seed + 1009 * i, F.col("cand").cast("string"), policy.train, policy.val)
        for k, v in (("scored", scored), ("pool", pool), ("distinct", distinct), ("selected", split)):
            stages[k].append(v)
    union = {k: _union(v) for k, v in stages.items()}
    named = splits.named_outputs(union["selected"], by, F.col("clip_margin"), F.col("cand").cast("string"))
    return named, reports.funnel([("candidates", candidates), *union.items()], by)


def open_set(selected: DataFrame, others: DataFrame, quotas: dict[str, int], n_other: int, seed: int, by: str, other_by: str, identity: Column) -> tuple[DataFrame, DataFrame]:
    """(train, hidden test): target classes are cut by quota, the test part is mixed with a
    sample of other classes under neutral names. Leaks of labels into names are an error."""
    cut = selection.quota_split(selected, by, quotas, seed, identity).withColumn("label", F.col(by).cast("string"))
    test = cut.filter("split = 'test'")
    sample = selection.stratified_sample(others, other_by, n_other, seed, identity).drop("rank")
    shared = [c for c in test.columns if c in sample.columns and c != "label"]
    hidden = splits.hidden_test(test.select("label", *shared), sample.select(*shared), seed + 99991, identity)
    return cut.filter("split <> 'test'"), hidden


def open_set_invariants(train: DataFrame, hidden: DataFrame, key: str, distinct: int, test_rows: int) -> DataFrame:
    """(what, expected, found, ok): different keys in both parts, keys in both at once, rows
    of the hidden test and names given twice in it."""
    keys = train.select(key).unionByName(hidden.select(key))
    twice = hidden.groupBy("name").count().filter("count > 1")
    both = train.select(key).join(hidden.select(key), key, "left_semi")
    found = [("distinct", distinct, keys.distinct()), ("in_both_parts", 0, both), ("hidden_rows", test_rows, hidden), ("names_twice", 0, twice)]
    parts = [df.agg(F.count("*").alias("found")).select(F.lit(what).alias("what"), F.lit(n).cast("long").alias("expected"), "found", (F.col("found") == n).alias("ok")) for what, n, df in found]
    return _union(parts)


def with_minimums(settings: dict[str, int], least: dict[str, int]) -> dict[str, int]:
    """Settings raised to their minimums; a setting that is not given takes its minimum."""
    return settings | {name: max(settings.get(name, value), value) for name, value in least.items()}


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
