"""Text functions on columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import ship

# Word lists and per-source bonuses of the metadata score.
FLOWER_TERMS = ["flower", "flowers", "flowering", "blossom", "blossoms", "bloom", "inflorescence", "umbel"]
LEAF_TERMS = ["leaf", "leaves", "foliage", "seedling", "sprout"]
OBJECT_TERMS = ["fruit", "fruits", "carrot", "carrots", "watermelon", "watermelons", "feijoa", "harvest", "slice", "sliced", "cut", "market"]
SOURCE_BONUS = {"openverse": 0.045, "wikimedia_commons": 0.025, "inaturalist": 0.0, "gbif": -0.005}
FLOWER_WORDS = ["flower", "flowers", "flowering", "blossom", "blossoms", "bloom", "blooms", "inflorescence", "floral"]


def collapse_spaces(value: Column) -> Column:
    """Runs of Unicode white space as one blank, none at the ends."""
    return F.btrim(F.regexp_replace(value, r"(?U)[\s\x1c-\x1f]+", " "))


def strip_html(value: Column) -> Column:
    """Text without tags: an unclosed tag takes the rest, a stray ">" goes."""
    bare = F.regexp_replace(F.coalesce(value, F.lit("")), r"<[^>]*(?:>|\z)|>", "")
    return collapse_spaces(F.replace(bare, F.lit("&nbsp;"), F.lit(" ")))


def words_of(title: Column, query: Column, separators: str = "-_") -> Column:
    """Distinct lower-case words of title and query; separators count as blanks."""
    text = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(query, F.lit(""))))
    return F.array_distinct(F.split(collapse_spaces(F.translate(text, separators, " " * len(separators))), " "))


def has_any_word(words: Column, terms: list[str]) -> Column:
    return F.arrays_overlap(words, F.array(*map(F.lit, terms)))


def metadata_adjustment(title: Column, query: Column, source: Column) -> Column:
    """What metadata adds to a score: bonus of the source, flower and leaf words down,
    object words up."""
    words = words_of(title, query)
    flower, leaf, thing = (has_any_word(words, t) for t in (FLOWER_TERMS, LEAF_TERMS, OBJECT_TERMS))
    bonus = F.create_map(*[F.lit(x) for pair in SOURCE_BONUS.items() for x in pair])
    out = F.coalesce(F.try_element_at(bonus, source), F.lit(0.0))
    out = out + F.when(flower, F.lit(-0.16)).otherwise(0.0)
    out = out + F.when(leaf & ~thing, F.lit(-0.08)).otherwise(0.0)
    return out + F.when(thing, F.lit(0.018)).otherwise(0.0)


def mentions_flower(title: Column, query: Column) -> Column:
    return has_any_word(words_of(title, query, "-_/,"), FLOWER_WORDS)


def first_matching(fields: Column, fragments: list[str]) -> Column:
    """The first non-empty value of a map whose lower-case key contains a fragment; else ""."""

    def fits(e: Column) -> Column:
        named = F.lit(False)
        for x in fragments:
            named = named | F.contains(F.lower(e["key"]), F.lit(x))
        return named & (F.coalesce(e["value"], F.lit("")) != "")

    return F.coalesce(F.get(F.filter(F.map_entries(fields), fits), F.lit(0))["value"], F.lit(""))


def numbered_name(prefix: Column, number: Column, width: int = 3) -> Column:
    """"{prefix}_{number}.jpg", the number padded with zeros."""
    return F.concat(prefix, F.lit("_"), F.when(F.length(number.cast("string")) >= width, number.cast("string")).otherwise(F.lpad(number.cast("string"), width, "0")), F.lit(".jpg"))


def character_entropy(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, entropy): Shannon entropy, in bits, of each row's characters; null and empty: 0.

    Characters are counted where the text is: nothing is shuffled.
    """
    ship(df.sparkSession)

    def run(batches):
        for batch in batches:
            found = np.zeros(batch.num_rows)
            for i, text in enumerate(batch.column(1)):
                points = np.frombuffer((text.as_py() or "").encode("utf-32-le", "surrogatepass"), "<u4")
                if len(points):
                    n = np.unique(points, return_counts=True)[1]
                    # H = log2(N) - sum(n log2 n) / N
                    found[i] = np.log2(len(points)) - (n * np.log2(n)).sum() / len(points)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], [id_col, "entropy"])

    source = df.select(id_col, F.col(text_col).cast("string"))
    return source.mapInArrow(run, T.StructType([source.schema[0], T.StructField("entropy", T.DoubleType())]))
