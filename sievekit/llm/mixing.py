"""Mixing sources to target weights by Poisson replication.

Every source gets a target repetition rate, its target share of the budget divided by its
present size. A document's number of copies is drawn by inverting the Poisson distribution
with that mean at a uniform number that is a hash of seed, doc_id and text: it needs no
counting pass over documents, no state, and is the same on every run. Each document is
exploded by its count, and the copies are put in the order of a second hash, over all
partitions.

All of it is DataFrame functions. The one global state is a table of sources (size and
rate); it is broadcast while it has at most ``BROADCAST_SOURCES`` rows and joined otherwise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Sources up to which the table of rates is broadcast.
BROADCAST_SOURCES = 100_000
#: Rates above this use several hashes: the inversion sums one Poisson part a hash.
PART = 16.0
#: Copies of a document that one task makes, at most, where a rate is that high.
CHUNK = 1000
#: Characters of text that a partition of the mix gets, about, if there are more than the
#: session's number of partitions would hold.
PARTITION_CHARS = 256_000_000
SEED = "mix-1"


def rates(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, budget: float = 1.0) -> DataFrame:
    """(source, size, rate): mean copies of each source's documents.

    Size counts characters. weights gives target shares by source (they are normalised; a
    source without a weight gets none). Without weights the target share is proportional to
    size ** power. budget is the size of the mix in units of the input's size. A null source
    is a source of its own; sources without a character have rate 0.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0))).cast("double").alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow("size", F.lit(power)))
    else:
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "source string, weight double")
        sizes = sizes.join(given, sizes["source"].eqNullSafe(given["source"]), "left").select(sizes["source"], "size", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    sizes = common.stored(sizes, f"{common.shared_dir(docs.sparkSession)}/sizes")
    all_size, all_weight = sizes.agg(F.sum("size"), F.sum("weight")).first()
    if not all_weight:
        return sizes.select("source", "size", F.lit(0.0).alias("rate"))
    rate = F.when(F.col("size") > 0, F.col("weight") / all_weight * budget * all_size / F.col("size")).otherwise(0.0)
    return sizes.select("source", "size", rate.alias("rate"))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a hash of the parts."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson(u: Column, mean: Column) -> Column:
    """The smallest k whose cumulative Poisson probability exceeds u; mean at most PART.

    Terms past the last step have less probability than u's resolution, so that the bound
    on the steps cuts nothing off.
    """
    steps = F.sequence(F.lit(1), F.ceil(mean + 14 * F.sqrt(mean) + 20).cast("int"))
    start = F.struct(F.lit(0).alias("k"), F.exp(-mean).alias("p"), F.exp(-mean).alias("cdf"))

    def step(s: Column, i: Column) -> Column:
        p = s["p"] * mean / i
        more = u >= s["cdf"]
        return F.struct(F.when(more, i).otherwise(s["k"]).alias("k"), p.alias("p"), F.when(more, s["cdf"] + p).otherwise(s["cdf"]).alias("cdf"))

    return F.when(mean > 0, F.aggregate(steps, start, step, lambda s: s["k"])).otherwise(0)


def mix(docs: DataFrame, rate_table: DataFrame, seed: str = SEED) -> DataFrame:
    """Every document as often as its draw says, shuffled: docs' columns, copy, shuffle_key.

    copy counts from 1; rows are ordered by shuffle_key (32 hex digits) over the whole
    result. Documents with equal doc_id and text draw alike; a null doc_id or text is hashed
    as such and draws like any other. A rate above PART is the sum of independent draws of at
    most PART; with a rate above CHUNK several tasks make a document's copies.
    Columns of docs named copy or shuffle_key are replaced. An empty table stays empty.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    table = rate_table.select(F.col("source").alias("__source"), F.col("rate").alias("__rate"))
    small = table.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    table = F.broadcast(table) if small else table
    joined = docs.select(*names).join(table, F.col("source").eqNullSafe(F.col("__source")), "left")
    identity = F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit(""))))
    rate = F.coalesce("__rate", F.lit(0.0))
    parts = F.greatest(F.lit(1), F.ceil(rate / PART).cast("int"))
    # each column is computed once, before the steps of the inversion read it many times
    joined = joined.withColumn("__key", identity).withColumns({"__mean": rate / parts, "__u": F.transform(F.sequence(F.lit(1), parts), lambda i: uniform(F.col("__key"), i.cast("string")))})
    drawn = F.aggregate("__u", F.lit(0), lambda n, u: n + poisson(u, F.col("__mean")))
    counted = joined.withColumn("__n", F.when(F.col("__mean") > 0, drawn).otherwise(0)).filter("__n > 0")
    # a row for each source
    most, chars = rate_table.agg(F.max("rate"), F.sum(F.col("size") * F.col("rate")) if "size" in rate_table.columns else F.lit(0.0)).first()
    if (most or 0.0) > CHUNK:
        # a document's copies are dealt in chunks
        chunks = counted.withColumn("__chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / CHUNK).cast("int"))))
        chunks = chunks.repartition(F.xxhash64("__key", "__chunk"))
        numbers = F.sequence(F.col("__chunk") * CHUNK + 1, F.least(F.col("__n"), (F.col("__chunk") + 1) * CHUNK))
        copies = chunks.select(*names, "__key", F.explode(numbers).alias("copy"))
    else:
        copies = counted.select(*names, "__key", F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("copy"))
    keyed = copies.withColumn("shuffle_key", F.md5(F.concat_ws("|", F.lit("order"), "__key", F.col("copy").cast("string")))).drop("__key")
    # keys are uniform: cutting their range evenly needs no sampling pass over the texts
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((chars or 0.0) / PARTITION_CHARS))
    return shuffled(keyed, n)


def shuffled(keyed: DataFrame, n: int) -> DataFrame:
    """keyed in the order of shuffle_key, in n partitions that cut the key's range evenly."""
    at = (F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32)) * n).cast("int")
    return keyed.withColumn("__part", at).repartitionById(n, F.col("__part")).drop("__part").sortWithinPartitions("shuffle_key")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of documents at default rates: who is in it, in what order. Edge cases are those
    of rates and mix."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    found = mix(docs, rates(docs))
    return found.select("doc_id", "source", F.col("copy").cast("long").alias("copy"), "shuffle_key", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


OP9_SQL = f"""
WITH RECURSIVE sizes AS (
  SELECT source, CAST(sum(coalesce(length(text), 0)) AS DOUBLE) AS size FROM documents GROUP BY source
), rates AS (
  SELECT source, CASE WHEN size > 0 THEN sqrt(size) / (SELECT sum(sqrt(size)) FROM sizes) * (SELECT sum(size) FROM sizes) / size ELSE 0 END AS rate FROM sizes
), cdf AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM rates WHERE rate > 0
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM cdf WHERE k < 102
), drawn AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS text_md5,
         '{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || md5(coalesce(text, '')) AS identity
  FROM documents
), numbered AS (
  SELECT *, CAST('0x' || substr(md5(identity || '|1'), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM drawn
), copies AS (
  SELECT n.doc_id, n.source, n.text_md5, n.identity, c.k + 1 AS copy
  FROM numbered n JOIN cdf c ON n.source IS NOT DISTINCT FROM c.source AND n.u >= c.c
)
SELECT doc_id, source, CAST(copy AS BIGINT) AS copy, md5('order|' || identity || '|' || copy) AS shuffle_key, text_md5 FROM copies
"""
