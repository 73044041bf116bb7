"""Filters: quality gates, ordered reasons, thresholds that relax, cardinality guards."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import mentions_flower, metadata_adjustment


@dataclass(frozen=True)
class Gate:
    """Limits of a quality gate; upscale enlarges images whose shorter side is below 224."""

    min_bytes: int
    min_side: int
    min_entropy: float
    min_variance: float
    upscale: bool = False
    attempts: int = 1
    max_bytes: int = 30_000_000
    max_aspect: float = 4.5


# The six settings of the gate.
GATES = {
    "core": Gate(8000, 180, 3.4, 25),
    "local": Gate(8000, 180, 3.4, 25),
    "indexed": Gate(2500, 96, 3.0, 18, upscale=True),
    "robust": Gate(5000, 160, 3.2, 20, attempts=6),
    "open_local": Gate(3000, 120, 3.0, 18, upscale=True),
    "efficient": Gate(4000, 150, 3.1, 18, attempts=4),
}


def first_reason(tests: list[tuple[str, Column]]) -> Column:
    """Name of the first test that holds, null if none does."""
    out = None
    for name, test in tests:
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


def gate_reason(gate: Gate, content_type: Column | None = None) -> Column:
    """Why a row with n_bytes, width, height, entropy and variance fails; null if it passes.

    Cheap tests come first. An empty content type is accepted.
    """
    short, long = F.least("width", "height"), F.greatest("width", "height")
    tests = [("bytes", (F.col("n_bytes") < gate.min_bytes) | (F.col("n_bytes") > gate.max_bytes))]
    if content_type is not None:
        kind = F.lower(F.coalesce(content_type, F.lit("")))
        tests.append(("content_type", (kind != "") & ~F.startswith(kind, F.lit("image/")) & ~F.contains(kind, F.lit("octet-stream"))))
    tests += [("side", short < gate.min_side), ("aspect", long > gate.max_aspect * short), ("entropy", F.col("entropy") < gate.min_entropy), ("variance", F.col("variance") < gate.min_variance)]
    return first_reason(tests)


def at_least(df: DataFrame, needed: int, what: str = "rows") -> DataFrame:
    """df, if it has at least needed rows; else an error that says how many it has."""
    found = df.limit(needed).count()
    if found < needed:
        raise ValueError(f"{what}: {found} remain, {needed} are required")
    return df


def short_groups(df: DataFrame, by: str, needed: int) -> DataFrame:
    """(by, n) of the groups with fewer than needed rows."""
    return df.groupBy(by).agg(F.count("*").alias("n")).filter(F.col("n") < needed)


def ranked(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows of an order, with their rank from 1."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order))).filter(F.col("rank") <= n)


def score_order(pos: str = "pos") -> list[Column]:
    return [F.desc("clip_margin"), F.desc("clip_positive"), F.asc(pos)]


# Falling thresholds on the margin.
CORE_THRESHOLDS = [0.025, 0.015, 0.005, -0.005, -0.02, -0.04]
STRICT_THRESHOLDS = [0.08, 0.065, 0.05, 0.04, 0.03, 0.02, 0.01, 0.0]


def relaxed_threshold(df: DataFrame, thresholds: list[float], floor: float, target: int) -> float | None:
    """The first threshold that leaves target rows with at least the floor; one pass."""
    counts = df.agg(*[F.count_if((F.col("clip_margin") >= t) & (F.col("clip_positive") >= floor)).alias(f"c{i}") for i, t in enumerate(thresholds)]).first()
    return next((t for i, t in enumerate(thresholds) if counts[i] >= target), None)


def core_pool(df: DataFrame, needed: int, thresholds: list[float] = CORE_THRESHOLDS, floor: float = 0.18) -> DataFrame:
    """Rows above the first threshold that leaves max(2n, n + 80) of them; if none does, the
    best that many rows, whatever their scores. Adds threshold: the one used, or the last
    row's margin."""
    target = max(2 * needed, needed + 80)
    used = relaxed_threshold(df, thresholds, floor, target)
    if used is not None:
        return df.filter((F.col("clip_margin") >= used) & (F.col("clip_positive") >= floor)).withColumn("threshold", F.lit(float(used)))
    pool = ranked(df, score_order(), target).drop("rank")
    return pool.withColumn("threshold", F.min("clip_margin").over(Window.partitionBy(F.lit(0))))


def strict_pool(df: DataFrame, needed: int, thresholds: list[float] = STRICT_THRESHOLDS, floor: float = 0.20) -> DataFrame:
    """As core_pool with a target of max(150, n + 40); if no threshold leaves it, all rows
    with margins from 0, and an error if they are fewer than needed."""
    used = relaxed_threshold(df, thresholds, floor, max(150, needed + 40))
    if used is None:
        used = 0.0
        at_least(df.filter((F.col("clip_margin") >= used) & (F.col("clip_positive") >= floor)), needed, "strict pool")
    return df.filter((F.col("clip_margin") >= used) & (F.col("clip_positive") >= floor)).withColumn("threshold", F.lit(float(used)))


def adjusted_pool(df: DataFrame, needed: int) -> DataFrame:
    """Margins with the metadata adjustment added, as later stages see them; rows of low
    scores go; the best max(240, 2n) of the others."""
    moved = df.withColumn("clip_margin", F.col("clip_margin") + metadata_adjustment(F.col("title"), F.col("query"), F.col("source")))
    fit = at_least(moved.filter((F.col("clip_positive") >= 0.18) & (F.col("clip_margin") >= -0.08)), needed, "adjusted pool")
    return ranked(fit, score_order(), max(240, 2 * needed)).drop("rank")


def open_pool(df: DataFrame, needed: int) -> DataFrame:
    """Rows with positive from 0.19 and margin from -0.025; if they are fewer than
    max(n, 120), the best max(3n, 180) of all."""
    fit = df.filter((F.col("clip_positive") >= 0.19) & (F.col("clip_margin") >= -0.025))
    target = max(needed, 120)
    if fit.limit(target).count() >= target:
        return fit
    return ranked(df, score_order(), max(3 * needed, 180)).drop("rank")


def _or(column: str, default: float) -> Column:
    return F.coalesce(F.col(column), F.lit(default))


def reason_tests(policy: str) -> list[tuple[str, Column]]:
    """Ordered tests of the three colour policies; missing colours default by policy."""
    flower = ("metadata_flower", mentions_flower(F.col("title"), F.col("query")))
    raw = _or("raw_margin", -1.0)
    if policy == "green":
        return [
            flower,
            ("red_or_pink", _or("red_fraction", 1.0) > 0.055),
            ("insufficient_green", _or("green_fraction", 0.0) < 0.025),
            ("low_positive", F.col("clip_positive") < 0.205),
            ("low_margin", (raw < 0.008) | (F.col("clip_margin") < 0.012)),
        ]
    if policy == "green_raw":
        return [
            flower,
            ("red_or_pink", _or("red_fraction", 1.0) > 0.055),
            ("insufficient_green", _or("green_fraction", 0.0) < 0.025),
            ("low_positive", F.col("clip_positive") < 0.205),
            ("low_margin", raw < -0.055),
        ]
    return [flower, ("red_or_pink", _or("red_fraction", 0.0) > 0.10), ("low_positive", F.col("clip_positive") < 0.185), ("low_margin", raw < -0.035)]


# Rows of the pool of each policy, if twice what is needed is less.
POLICY_POOL = {"green": 180, "green_raw": 200, "source": 220}


def policy_order(policy: str) -> list[Column]:
    raw = F.desc(_or("raw_margin", -1.0))
    if policy == "green":
        return [raw, F.desc("clip_margin"), F.desc("clip_positive"), F.asc("pos")]
    if policy == "green_raw":
        return [raw, F.desc("clip_positive"), F.desc(_or("green_fraction", 0.0)), F.asc(_or("red_fraction", 1.0)), F.asc("pos")]
    return [raw, F.desc("clip_positive"), F.asc(_or("red_fraction", 0.0)), F.asc("pos")]


def policy_pool(df: DataFrame, needed: int, policy: str = "source") -> tuple[DataFrame, DataFrame]:
    """(pool, rejections by first failing reason) of a colour policy."""
    marked = df.withColumn("reason", first_reason(reason_tests(policy)))
    rejected = marked.filter("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))
    fit = at_least(marked.filter("reason is null").drop("reason"), needed, f"{policy} pool")
    return ranked(fit, policy_order(policy), max(POLICY_POOL[policy], 2 * needed)).drop("rank"), rejected
