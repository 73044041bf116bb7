"""The corpus pipeline: language ID, near-duplicates, personal data, mixing, token ids.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs. All stages but
the last return the columns of documents.

Edge cases, for every stage: null and empty texts, repeated rows and empty tables are
allowed; extra columns of documents are carried along by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.llm import common, langid, mixing, pieces, pii, simhash

#: Least share of the main language in a text.
LEAST_SHARE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a language whose share is LEAST_SHARE at least; those without a letter go."""
    return langid.keep_identified(docs, langid.fit(docs), LEAST_SHARE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; n_chars follows the new text."""
    changed = pii.pseudonymise(docs, pii.session_key(spark))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)))
    return changed.select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards shares proportional to the root of each source's size."""
    return mixing.mix(docs, mixing.rates(docs)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids and the SHA-256 of what the ids decode to."""
    found = pieces.encode(docs, pieces.default_model(), ["doc_id", "source"], decoded="decoded")
    return found.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("pii", personal_data),
    ("mixing", mixture),
    ("sentencepiece", tokens),
]

#: SQL can express neither the language model nor the merge rounds: brute-force tests instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again."""
    work = common.shared_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = common.stored(stage(spark, docs, sf_dir), f"{work}/{i}-{name}")
    return docs
