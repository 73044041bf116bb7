"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

Every rule is a predicate over one text's lazily computed features. On a sample the rules
are timed and their rejections counted; the cascade then runs them in order of rejected
share per second and stops at a text's first failure. The order changes the time and the
name of the first failing rule, never the verdict: a text is kept if no rule rejects it.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Rows of the timing sample, about; it decides only an order.
SAMPLE_ROWS = 2000
CHARS = 4_000_000

_SPACE = " \t\n\v\f\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_NOT_SYMBOL = re.compile(r"[^#*$%&|<>]+")
_NOT_LETTER = re.compile(r"[\W\d_]+")


class Text:
    """One text with its features, each computed at first use."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[str]:
        return _WORD.findall(self.text)

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len("".join(self.words))

    @cached_property
    def n_symbols(self) -> int:
        return len(_NOT_SYMBOL.sub("", self.text))

    @cached_property
    def lines(self) -> list[str]:
        """The \\n-split lines that hold a word."""
        return [x for x in self.text.split("\n") if x.strip(_SPACE)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside 3-word windows that occur twice or more, the first ones included."""
        words = self.words
        n = len(words) - 2
        if n < 2:
            return 0
        number = {w: i for i, w in enumerate(set(words))}
        ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        if len(number) < 1 << 21:
            key = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
        else:  # too many different words to pack three: number the pairs first
            pair = np.unique((ids[:-2] << 31) | ids[1:-1], return_inverse=True)[1]
            key = (pair.astype(np.int64) << 31) | ids[2:]
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        if not same.any():
            return 0
        again = np.zeros(n, bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        covered = np.zeros(len(words), bool)
        for d in range(3):
            covered[d : d + n] |= again
        return int(covered.sum())

    @cached_property
    def n_letters(self) -> int:
        return len(_NOT_LETTER.sub("", self.text))


@dataclass(frozen=True)
class Rule:
    """rejects(text) is true for a text to drop."""

    name: str
    rejects: Callable[[Text], bool]


#: The two rules of the base verdict.
BASE = (
    Rule("few_words", lambda t: t.n_words < 50),
    Rule("repeated_words", lambda t: 100 * t.n_repeat_words > 50 * t.n_words),
)
#: The rules of the cascade. Their limits leave ordinary prose far inside.
RULES = (
    *BASE,
    Rule("symbols_per_word", lambda t: t.n_symbols > t.n_words),
    Rule("duplicate_lines", lambda t: len(t.lines) >= 5 and t.n_dup_lines > 0.3 * len(t.lines)),
    Rule("short_words", lambda t: t.word_chars < 2 * t.n_words),
    Rule("long_words", lambda t: t.word_chars > 25 * t.n_words),
    Rule("few_letters", lambda t: t.n_letters < 0.5 * t.word_chars),
)


def timed(texts: list[str | None], rules: tuple[Rule, ...] = RULES) -> list[tuple[int, float]]:
    """(texts rejected, seconds) of each rule.

    Each rule sees fresh texts, so that its cost holds the features it needs.
    """
    found = []
    for rule in rules:
        began = time.perf_counter()
        rejected = sum(rule.rejects(Text(t)) for t in texts)
        found.append((rejected, time.perf_counter() - began))
    return found


def ranked(figures: list[tuple[str, int, float, int]]) -> list[str]:
    """Rule names, best rejection per cost first, for (name, texts rejected, seconds, texts).

    Rules that reject nothing come last, cheapest first; ties are broken by name.
    """

    def merit(figure: tuple[str, int, float, int]) -> tuple[float, float, str]:
        name, rejected, seconds, n = figure
        cost = max(seconds, 1e-9) / max(n, 1)
        return -rejected / max(n, 1) / cost, cost, name

    return [x[0] for x in sorted(figures, key=merit)]


def sampled_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names in the cascade's order.

    The sample are rows of all partitions, chosen by a hash of id and whole text, about
    sample_rows of them (all, if there are fewer). The executors run the rules over it; only
    three numbers a rule and task reach the driver, no text.
    """
    common.ship(docs.sparkSession)
    space = 1 << 40
    bound = min(space, sample_rows * space // max(docs.count(), 1))
    source = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("text"))
    source = source.filter(F.pmod(F.xxhash64("i", "text"), F.lit(space)) < bound).select("text")

    def run(batches):
        total = [[0, 0.0] for _ in rules]
        n = 0
        for _, texts in common.slices(batches, "text", CHARS):
            n += len(texts)
            for sums, (rejected, seconds) in zip(total, timed(texts, rules), strict=True):
                sums[0] += rejected
                sums[1] += seconds
        if n:
            columns = [pa.array([r.name for r in rules]), pa.array([int(r) for r, _ in total], pa.int64()), pa.array([s for _, s in total], pa.float64()), pa.array([n] * len(rules), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["name", "rejected", "seconds", "n"])

    found = source.mapInArrow(run, "name string, rejected long, seconds double, n long").groupBy("name").agg(F.sum("rejected"), F.sum("seconds"), F.sum("n"))
    figures = {r[0]: tuple(r) for r in found.collect()}  # a row a rule
    return ranked([figures.get(r.name, (r.name, 0, 0.0, 0)) for r in rules])


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, order: list[str] | None = None, measure: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Run the cascade over every text; with ``measure``, also measure every text.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept and failed_rule (the first failing rule in the cascade's order, null
    if kept); without measure only doc_id, kept and failed_rule, and features that no rule
    asked for are not computed. A null text counts as an empty one, which has no word and fails. Repeated
    rows each come out; an empty table gives an empty result; other columns are ignored.
    """
    common.ship(docs.sparkSession)
    names = order if order is not None else sampled_order(docs, rules, id_col, text_col)
    limits = {r.name: r for r in rules}
    cascaded = [limits[n] for n in names]
    ints = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches):
        for batch, texts in common.slices(batches, "text", CHARS):
            if not measure:
                failed = pa.array([next((r.name for r in cascaded if r.rejects(x)), None) for x in map(Text, texts)], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), failed.is_null(), failed], ["doc_id", "kept", "failed_rule"])
                continue
            rows: list[tuple] = []
            for t in texts:
                x = Text(t)
                failed = next((r.name for r in cascaded if r.rejects(x)), None)
                base = any(r.rejects(x) for r in BASE)
                rows.append((*(getattr(x, n) for n in ints), base, failed is None and not base, failed))
            cols = list(zip(*rows, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in cols[:5]] + [pa.array(c, pa.bool_()) for c in cols[5:7]] + [pa.array(cols[7], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *ints, "base_failed", "kept", "failed_rule"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if not measure:
        return source.mapInArrow(run, "doc_id long, kept boolean, failed_rule string")
    kinds = ", ".join(f"{n} long" for n in ints)
    return source.mapInArrow(run, f"doc_id long, {kinds}, base_failed boolean, kept boolean, failed_rule string")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of cascade over documents. Null and empty texts have no word and fail;
    repeated rows each come out, an empty table gives no row, other columns are ignored."""
    return cascade(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("failed_rule")
