"""Language identification by multilingual mixture inference.

Each language is a smoothed distribution over hashed character trigrams. A text is a
mixture of languages: expectation-maximisation estimates its proportions from the trigram
likelihoods, and a penalised likelihood chooses the set of languages, adding one at a time
while the gain exceeds the penalty. The prediction is the language with the largest share.

The model is fitted on a bounded sample of labelled rows (``per_language`` rows of each
label, chosen by a hash of doc_id); predictions read every text whole.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Labelled rows of each language that the model is fitted on, at most.
PER_LANGUAGE = 2000
#: Labels that are learned, the most frequent first, at most; it bounds the model's size.
MAX_LANGUAGES = 256
#: Buckets of the trigram hash.
BUCKETS = 1 << 16
#: Characters of text per numpy round.
CHARS = 500_000
ROUNDS = 10
#: Added to each bucket's count.
SMOOTHING = 0.05
#: Log-likelihood that a further language must gain: PENALTY times the log of the trigrams.
PENALTY = 3.0
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Of every code point, whether it is a letter."""
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket, count) of the different trigrams around a letter, by text.

    Everything but letters counts as a blank, so that marks and digits carry no weight.
    """
    low = [t.lower() if t else "" for t in texts]
    points = np.frombuffer("\0\0".join([*low, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    doc = np.repeat(np.arange(len(low)), [len(t) + 2 for t in low])[: len(points)]
    points = np.where(_letters()[points], points, 0).astype(np.uint64)
    at = np.flatnonzero(points)
    before, after = points[np.maximum(at - 1, 0)], points[np.minimum(at + 1, len(points) - 1)]
    before[at == 0] = 0
    code = (before << np.uint64(42)) | (points[at] << np.uint64(21)) | after
    bucket = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
    key = np.sort(doc[at].astype(np.int64) * BUCKETS + bucket.astype(np.int64))
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.r_[first, len(key)])
    return key[first] // BUCKETS, key[first] % BUCKETS, count


class Model:
    """Names of languages, sorted, and log probabilities of shape (BUCKETS, languages)."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        smooth = counts + SMOOTHING
        self.prob = (smooth / smooth.sum(0)).astype(np.float64) if names else np.zeros((BUCKETS, 0))

    def infer(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(shares of shape (texts, languages), whether the text has a letter).

        A language outside the chosen set has share 0. All texts of the list are worked on
        at once; each one's result depends on its own text alone.
        """
        n, k = len(texts), len(self.names)
        doc, bucket, count = trigrams(texts)
        shares = np.zeros((n, k))
        lettered = np.zeros(n, bool)
        lettered[doc] = True
        if not k or not len(doc):
            return shares, lettered
        prob = self.prob[bucket]
        single = np.zeros((n, k))
        starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        single[doc[starts]] = np.add.reduceat(np.log(prob) * count[:, None], starts, axis=0)
        total = np.bincount(doc, count, n)
        chosen = np.zeros((n, k), bool)
        chosen[np.arange(n), single.argmax(1)] = True
        chosen &= lettered[:, None]
        shares[chosen] = 1.0
        if k == 1:
            return shares, lettered
        best = np.where(lettered, single.max(1), 0.0)
        penalty = PENALTY * np.log(np.maximum(total, 2))
        # the likelihood of all languages together bounds that of any set
        allowed = np.ones((n, k), bool)
        _, bound = self._em(doc, prob, count, allowed, total)
        open_docs = lettered & (bound - best > penalty)
        while open_docs.any():
            rows = open_docs[doc]
            d, p, c = doc[rows], prob[rows], count[rows]
            top, top_share, add = np.full(n, -np.inf), np.zeros((n, k)), np.full(n, -1)
            for lang in range(k):
                trial = chosen.copy()
                trial[:, lang] = True
                share, value = self._em(d, p, c, trial, total)
                better = open_docs & ~chosen[:, lang] & (value > top)
                top[better], add[better], top_share[better] = value[better], lang, share[better]
            gain = open_docs & (add >= 0) & (top - best > penalty)
            chosen[gain, add[gain]] = True
            shares[gain], best[gain] = top_share[gain], top[gain]
            open_docs = gain & (bound - best > penalty) & (chosen.sum(1) < k)
        return shares, lettered

    @staticmethod
    def _em(doc, prob, count, allowed, total) -> tuple[np.ndarray, np.ndarray]:
        """(shares, log-likelihood) after ROUNDS rounds from equal shares of the allowed."""
        n, k = allowed.shape
        share = allowed / allowed.sum(1, keepdims=True)
        starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        here, value = doc[starts], np.zeros(n)
        for step in range(ROUNDS + 1):
            joint = prob * share[doc]
            mass = joint.sum(1)
            if step == ROUNDS:
                value[here] = np.add.reduceat(np.log(mass) * count, starts)
                return share, value
            joint *= (count / mass)[:, None]
            share[here] = np.add.reduceat(joint, starts, axis=0) / total[here, None]
        raise AssertionError

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language, its share) of each text; ``und`` and 0 without a letter or a model."""
        if not self.names:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        shares, lettered = self.infer(texts)
        top = shares.argmax(1)
        score = np.clip(np.where(lettered, shares[np.arange(len(texts)), top], 0.0), 0.0, 1.0)
        return [self.names[i] if ok else UNDETERMINED for i, ok in zip(top, lettered, strict=True)], score


def held_out(id_col: str = "doc_id"):
    """Whether crc32 of doc_id as text leaves 2 when divided by 4; a null doc_id: no."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, max_languages: int = MAX_LANGUAGES) -> Model:
    """Fit on doc_id, text, lang; rows without a text or label teach nothing.

    Neither do rows without a doc_id. Of each label at most per_language doc_ids are used, chosen by a hash of doc_id, and at most
    max_languages labels, the most frequent ones. Only the trigram counts reach the driver:
    at most BUCKETS a label.
    """
    spark = labelled.sparkSession
    common.ship(spark)
    rows = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")).filter("doc_id is not null and lang is not null and text is not null")
    top = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    names = sorted(r["lang"] for r in top)
    if not names:
        return Model([], np.zeros((BUCKETS, 0)))
    number = {x: i for i, x in enumerate(names)}
    # hashes below a bound that about four times as many rows meet: few rows meet in a task
    mark, whole = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)), 1 << 30
    bound = F.lit(0)
    for r in top:
        bound = F.when(F.col("lang") == r["lang"], min(whole, -(-4 * per_language * whole // r["count"]))).otherwise(bound)
    order = Window.partitionBy("lang").orderBy("mark", "doc_id")
    chosen = rows.select("doc_id", "lang").withColumn("mark", mark).filter(F.col("mark") < bound)
    chosen = chosen.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_language)
    # at most per_language * max_languages ids
    sample = rows.join(F.broadcast(chosen.select("doc_id", "lang").distinct()), ["doc_id", "lang"], "left_semi")

    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch, texts in common.slices(batches, "text", CHARS):
            langs = batch.column(1).to_pylist()
            for lang in set(langs):
                _, bucket, count = trigrams([t for t, x in zip(texts, langs, strict=True) if x == lang])
                counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                counts[lang] += np.bincount(bucket, count, BUCKETS).astype(np.int64)
        for lang, total in counts.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([number[lang]] * len(at), pa.int32()), pa.array(at.astype(np.int32)), pa.array(total[at])], ["lang", "bucket", "n"])

    counted = sample.select("text", "lang").mapInArrow(run, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counted.toArrow()
    counts = np.zeros((BUCKETS, len(names)))
    counts[table["bucket"].to_numpy(), table["lang"].to_numpy()] = table["n"].to_numpy()
    return Model(names, counts)


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of docs (all, if None) with lang_pred and score, from text alone.

    ``und`` and 0.0 for a null text or one without a letter. All columns and repeated rows
    stay; an empty table stays empty. A column of docs named lang_pred or score is replaced.
    """
    spark = docs.sparkSession
    common.ship(spark)
    shared = spark.sparkContext.broadcast((model.names, model.prob))
    others = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    carried = docs.select(*others)
    text = "__sievekit_text"
    source = carried if "text" in others else docs.select(*others, F.col("text").alias(text))
    text = "text" if "text" in others else text

    def run(batches):
        own = Model.__new__(Model)
        own.names, own.prob = shared.value
        for batch, texts in common.slices(batches, text, CHARS):
            langs, score = own.predict(texts)
            columns = batch.columns[: len(others)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(langs, pa.string()), pa.array(score, pa.float64())], [*others, "lang_pred", "score"])

    schema = T.StructType([*carried.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return source.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Documents with a language whose share is at least ``least``, columns as they are."""
    found = predict(docs.withColumnsRenamed({"lang_pred": "__lang_pred", "score": "__score"}), model)
    kept = found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)).drop("lang_pred", "score")
    return kept.withColumnsRenamed({"__lang_pred": "lang_pred", "__score": "score"}).select(*docs.columns)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text of documents, learned from those that are not held out. Edge
    cases are those of fit and predict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs.filter(~held_out()))
    found = predict(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model, keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
