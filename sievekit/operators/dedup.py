"""Deduplication where the first in an order wins.

Keeping a row unless an earlier *kept* row resembles it is the lexicographically first
maximal independent set of the similarity graph, not its connected components: a row whose
only likeness was itself removed stays. ``first_kept`` finds it in rounds over tables of
links; the similarity operators differ in how they find links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors
from ..runtime import numbered, shared_dir, ship, stored
from ..schema import stable_key, url_key
from .lookups import lookup_side

#: Rows of a block of vectors.
BLOCK = 2048
#: Vectors that blocks are ordered by.
PIVOTS = 16
#: Rows of a band that one task compares with the others.
TILE = 4096
#: Hex digits of the blocks of a 64-digit hash: more blocks than bits may differ.
BANDS = [6] * 9 + [5] * 2


def first_by(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each key.

    The smallest position is found by a partial aggregate, so a key that a third of the rows
    share does not meet in one task.
    """
    named = df.withColumn("__key", F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])).withColumn("__order", F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
    least = named.groupBy("__key").agg(F.min("__order").alias("__order"))
    return named.join(least, ["__key", "__order"], "left_semi").select(*df.columns)


def unique_candidates(df: DataFrame, pos: str = "pos") -> DataFrame:
    """One candidate of each URL key, the first by position (positions are different).

    The identity holds the URL, so equal identities imply equal keys.
    """
    return first_by(df, [url_key(F.col("image_url"))], [F.col(pos)])


def exact_duplicates(df: DataFrame, id_col: str, digest: Column) -> DataFrame:
    """(id, digest, duplicate_of): the smallest id with the same digest, null for itself."""
    rows = df.select(F.col(id_col), digest.alias("digest"))
    first = rows.groupBy("digest").agg(F.min(id_col).alias("__first"))
    named = rows.join(first, "digest")
    return named.select(id_col, "digest", F.when(F.col(id_col) != F.col("__first"), F.col("__first")).alias("duplicate_of"))


def first_kept(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(pos, kept): whether no earlier kept row is linked with the row.

    nodes: different pos; links: (lo, hi) with lo < hi. A round keeps the undecided rows
    without an undecided earlier neighbour and drops their neighbours.
    """
    work = shared_dir(nodes.sparkSession)
    open_links = stored(links.select("lo", "hi").distinct(), f"{work}/links")
    linked = stored(open_links.select(F.col("lo").alias("pos")).union(open_links.select(F.col("hi").alias("pos"))).distinct(), f"{work}/linked")
    dropped, undecided, n = None, linked, 0
    while not open_links.isEmpty():
        kept = undecided.join(open_links.select(F.col("hi").alias("pos")).distinct(), "pos", "left_anti")
        gone = open_links.join(kept.select(F.col("pos").alias("lo")), "lo", "left_semi").select(F.col("hi").alias("pos")).distinct()
        gone = stored(gone, f"{work}/gone{n}")
        dropped = gone if dropped is None else dropped.union(gone)
        decided = kept.union(gone)
        undecided = stored(undecided.join(decided, "pos", "left_anti"), f"{work}/undecided{n}")
        lo, hi = undecided.select(F.col("pos").alias("lo")), undecided.select(F.col("pos").alias("hi"))
        open_links = stored(open_links.join(lo, "lo", "left_semi").join(hi, "hi", "left_semi").select("lo", "hi"), f"{work}/open{n}")
        n += 1
    if dropped is None:
        return nodes.select("pos", F.lit(True).alias("kept"))
    marks = dropped.withColumn("kept", F.lit(False))
    return nodes.select("pos").join(marks, "pos", "left").select("pos", F.coalesce("kept", F.lit(True)).alias("kept"))


def similar_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """(lo, hi, similarity) of the pairs whose cosine is at least threshold, lo < hi.

    rows: pos and v (array<double>), already normalised, of one length; a null v has no pair.
    See Blocks for which rows are compared.
    """
    return Blocks(rows).pairs(threshold)


class Blocks:
    """Vectors packed in blocks of neighbours, for products of whole blocks.

    A few rows are pivots. Rows are dealt in ranges of (nearest pivot, angle to it), and a
    block knows the least and the largest angle of its rows to each pivot. Angles between
    unit vectors obey the triangle inequality, so two blocks whose angles to some pivot lie
    further apart than the angle of the threshold hold no pair: they are not compared.
    Clustered vectors and high thresholds leave few pairs of blocks; at low thresholds, or
    where all rows are about as far from all pivots, all of them are compared.
    """

    def __init__(self, rows: DataFrame, pivots: int = PIVOTS):
        spark = rows.sparkSession
        ship(spark)
        self.work = shared_dir(spark)
        rows = rows.select(F.col("pos").cast("long").alias("pos"), "v").filter("v is not null")
        self.n = n_blocks = max(1, -(-rows.count() // BLOCK))
        chosen = np.array([r["v"] for r in rows.orderBy(F.xxhash64("pos"), "pos").limit(pivots).collect()], np.float64)

        def angles(batches):
            for b in batches:
                if b.num_rows:
                    at = _angles(_matrix(b.column(1), b.num_rows), chosen)
                    near = at.argmin(1)
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near.astype(np.int32)), pa.array(at[np.arange(len(at)), near])], ["pos", "v", "near", "angle"])

        def pack(batches):
            from pyspark import TaskContext

            parts = [(b.column(0).to_numpy(zero_copy_only=False), _matrix(b.column(1), b.num_rows)) for b in batches if b.num_rows]
            if parts:
                pos, v = np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
                at = _angles(v, chosen)
                yield pa.RecordBatch.from_pylist([{"block": TaskContext.get().partitionId(), "pos": pos.tobytes(), "v": v.tobytes(), "least": np.fmin.reduce(at).tolist(), "most": np.fmax.reduce(at).tolist()}], schema)

        schema = pa.schema([("block", pa.int32()), ("pos", pa.binary()), ("v", pa.binary()), ("least", pa.list_(pa.float64())), ("most", pa.list_(pa.float64()))])
        # pos among the keys: equal vectors, however many, are dealt to several blocks
        near = rows.mapInArrow(angles, "pos long, v array<double>, near int, angle double").repartitionByRange(n_blocks, "near", "angle", "pos")
        self.blocks = stored(near.select("pos", "v").mapInArrow(pack, "block int, pos binary, v binary, least array<double>, most array<double>"), f"{self.work}/blocks")

    def meetings(self, threshold: float) -> DataFrame:
        """(a, b) of the blocks that may hold a pair, a <= b."""
        reach = float(np.arccos(np.clip(threshold, -1.0, 1.0))) + 1e-6
        left = self.blocks.select(F.col("block").alias("a"), F.col("least").alias("la"), F.col("most").alias("ma"), F.explode(F.sequence(F.col("block"), F.lit(self.n - 1))).alias("b"))
        right = self.blocks.select(F.col("block").alias("b"), F.col("least").alias("lb"), F.col("most").alias("mb"))
        apart = F.array_max(F.concat(F.zip_with("la", "mb", lambda x, y: x - y), F.zip_with("lb", "ma", lambda x, y: x - y)))
        return left.join(right, "b").filter(apart <= reach).select("a", "b")

    def pairs(self, threshold: float, most: int | None = None, own: bool = False) -> DataFrame:
        """(lo, hi, similarity) of the pairs of at least threshold; with ``most`` only those
        that can be among so many largest (larger positions first on ties); with ``own`` only
        those within a block."""
        met = self.blocks.select(F.col("block").alias("a"), F.col("block").alias("b")) if own else self.meetings(threshold)
        left, right = (self.blocks.select(F.col("block").alias(x), F.col("pos").alias(f"p{x}"), F.col("v").alias(f"v{x}")) for x in "ab")

        def meet(batches):
            for batch in batches:
                for same, p1, v1, p2, v2 in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                    p, q = np.frombuffer(p1, np.int64), np.frombuffer(p2, np.int64)
                    x, y = np.frombuffer(v1).reshape(len(p), -1), np.frombuffer(v2).reshape(len(q), -1)
                    for lo in range(0, len(p), 512):
                        sims = x[lo : lo + 512] @ y.T
                        i, j = np.nonzero(sims >= threshold)
                        s, i, j = sims[i, j], p[lo + i], q[j]
                        ok = i < j if same else i != j
                        i, j, s = np.minimum(i, j)[ok], np.maximum(i, j)[ok], s[ok]
                        if most is not None and len(s) > most:
                            top = np.lexsort((-j, -i, -s))[:most]
                            i, j, s = i[top], j[top], s[top]
                        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(s)], ["lo", "hi", "similarity"])

        rows = met.join(left, "a").join(right, "b").select((F.col("a") == F.col("b")).alias("same"), "pa", "va", "pb", "vb")
        return rows.mapInArrow(meet, "lo long, hi long, similarity double")


def _matrix(lists: pa.Array, n: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _angles(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(v @ pivots.T, -1.0, 1.0))


def embedding_deduplicate(rows: DataFrame, threshold: float = 0.992) -> DataFrame:
    """(pos, kept, duplicate_of, similarity): drop a row if its cosine with an earlier kept
    one is at least threshold; duplicate_of is the most similar kept one, the earliest on
    ties. rows: pos (its order decides) and embedding.
    """
    work = shared_dir(rows.sparkSession)
    unit = rows.select("pos", vectors.normalized(vectors.doubles(F.col("embedding"))).alias("v"))
    links = stored(similar_pairs(unit, threshold), f"{work}/links")
    marks = stored(first_kept(rows.select("pos"), links), f"{work}/marks")
    kept = marks.filter("kept").select(F.col("pos").alias("lo"))
    why = links.join(kept, "lo", "left_semi").groupBy(F.col("hi").alias("pos")).agg(F.max_by("lo", F.struct("similarity", (-F.col("lo")).alias("earlier"))).alias("duplicate_of"), F.max("similarity").alias("similarity"))
    out = marks.join(why, "pos", "left")
    return out.select("pos", "kept", *[F.when(~F.col("kept"), F.col(c)).alias(c) for c in ("duplicate_of", "similarity")])


def adaptive_deduplicate(rows: DataFrame, needed: int, first: float = 0.992, relaxed: float = 0.996) -> tuple[DataFrame, float]:
    """embedding_deduplicate, again with the relaxed threshold if fewer than needed stay."""
    found = embedding_deduplicate(rows, first)
    if found.filter("kept").limit(needed).count() >= needed:
        return found, first
    return embedding_deduplicate(rows, relaxed), relaxed


def hash_distances(left: str, right: str) -> dict[str, Column]:
    """Hash distances of two aliased rows; p is the least over the mirror images."""

    def h(a: str, b: str) -> Column:
        return vectors.hamming_hex(F.col(f"{left}.{a}"), F.col(f"{right}.{b}"))

    return {"p": F.least(h("phash", "phash"), h("mirror_phash", "phash"), h("phash", "mirror_phash")), "d": h("dhash", "dhash"), "w": h("whash", "whash")}


def perceptual_links(rows: DataFrame, tile: int = TILE) -> DataFrame:
    """(lo, hi, reason) of rows that resemble each other by their hashes.

    Both rules need the difference hashes within 10 bits, so of 11 bands one is equal: rows
    meet on equal bands, and nothing is missed. A pair comes out under its first equal band.
    Of a band with more than ``tile`` rows each row meets the others tile by tile, each tile
    under a key of its own, so that no task has a whole band.
    """
    bands, at = [], 1
    for i, width in enumerate(BANDS):
        bands.append(F.struct(F.lit(i).alias("i"), F.substring("dhash", at, width).alias("band")))
        at += width
    keyed = rows.select("*", F.array(*bands).alias("__bands")).withColumn("__b", F.explode("__bands"))
    hot = stored(keyed.groupBy("__b").agg(F.count("*").alias("__n")).filter(F.col("__n") > tile).select("__b", F.ceil(F.col("__n") / tile).cast("int").alias("__tiles")), f"{shared_dir(rows.sparkSession)}/hot")
    if not hot.isEmpty():
        keyed = keyed.join(lookup_side(hot), "__b", "left")
    tiles = F.coalesce("__tiles", F.lit(1)) if "__tiles" in keyed.columns else F.lit(1)
    a = keyed.withColumn("__t", F.pmod(F.xxhash64("pos"), tiles)).alias("a")
    b = keyed.withColumn("__t", F.explode(F.sequence(F.lit(0).cast("long"), (tiles - 1).cast("long")))).alias("b")
    equal = F.filter(F.zip_with("a.__bands", "b.__bands", lambda x, y: F.when(x == y, x["i"])), lambda i: i.isNotNull())
    d = hash_distances("a", "b")
    met = a.join(b, (F.col("a.__b") == F.col("b.__b")) & (F.col("a.__t") == F.col("b.__t")) & (F.col("a.pos") < F.col("b.pos")) & (d["d"] <= 10) & (F.col("a.__b.i") == F.array_min(equal)))
    near = met.select(F.col("a.pos").alias("lo"), F.col("b.pos").alias("hi"), *[v.alias(k) for k, v in d.items()])
    reason = F.when((F.col("p") <= 6) & (F.col("d") <= 10), "perceptual_hash").when((F.col("p") <= 9) & (F.col("d") <= 8) & (F.col("w") <= 10), "perceptual_hash_combined")
    return near.select("lo", "hi", reason.alias("reason")).filter("reason is not null")


HASHES = ["phash", "dhash", "whash", "mirror_phash"]


def hash_deduplicate(rows: DataFrame) -> DataFrame:
    """(pos, kept, reason, duplicate_of) by exact digest and perceptual hashes.

    rows: pos, sha256, phash, dhash, whash, mirror_phash. A row goes if a kept earlier row
    has its digest ("exact_sha256") or, else, resembles it; duplicate_of is the earliest.
    Only the first row of each set of equal hashes can be kept and is compared with others;
    the rest of a set, however large, follows it.
    """
    work = shared_dir(rows.sparkSession)
    rows = rows.select("pos", "sha256", *HASHES)
    sets = stored(rows.groupBy(*HASHES).agg(F.min("pos").alias("first"), F.min_by("sha256", "pos").alias("sha256")), f"{work}/sets")
    firsts = sets.withColumnRenamed("first", "pos")
    near = stored(perceptual_links(firsts), f"{work}/near")
    same = firsts.select("sha256", F.col("pos").alias("lo")).join(firsts.select("sha256", F.col("pos").alias("hi")), "sha256").filter("lo < hi").select("lo", "hi")
    marks = stored(first_kept(firsts.select("pos"), near.select("lo", "hi").union(same)), f"{work}/marks")
    kept = marks.filter("kept").select("pos")
    alike = near.join(kept.select(F.col("pos").alias("lo")), "lo", "left_semi").groupBy(F.col("hi").alias("first")).agg(F.min("lo").alias("near_of"), F.min_by("reason", "lo").alias("near_reason"))
    decided = sets.drop("sha256").join(marks.select(F.col("pos").alias("first"), "kept"), "first").join(alike, "first", "left")
    exact = firsts.join(kept, "pos", "left_semi").groupBy("sha256").agg(F.min("pos").alias("same_of"))
    out = rows.join(decided, HASHES).join(exact, "sha256", "left")
    stays, copy = F.col("kept") & (F.col("pos") == F.col("first")), F.col("same_of") < F.col("pos")
    of = F.when(F.col("kept"), F.col("first")).otherwise(F.col("near_of"))
    why = F.when(F.col("kept"), "perceptual_hash").otherwise(F.col("near_reason"))
    return out.select("pos", stays.alias("kept"), F.when(stays, None).when(copy, "exact_sha256").otherwise(why).alias("reason"), F.when(stays, None).when(copy, F.col("same_of")).otherwise(of).alias("duplicate_of"))


def candidate_order(df: DataFrame) -> DataFrame:
    """df with pos, the rank of the stable key, and ties by digest."""
    return numbered(df, "pos", [stable_key(), F.col("sha256")])
