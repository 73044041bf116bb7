"""Exact top-k by inner product, without random access.

Every dimension of a block of candidates is a list sorted by value, with one cursor that
reads it from the top and one that reads it from the bottom (for queries whose weight there
is positive or negative). All lists are read in step, a larger stretch each round. After a
round every candidate has, for every query, a lower bound (what was read of it, and the
least the lists still hold for the rest) and an upper bound (what was read, and for the rest
the value at the cursors, which nothing unread exceeds). Reading stops for a query when its
k-th best lower bound is above the upper bound of all others; the scores of those left are
then resolved. Lower bounds found in earlier blocks count in later ones.

The bounds of a block of queries are matrix products, so that a round costs a few products
of the block's size. Queries and candidates meet in blocks: a stated query set against all
rows. Vectors are whole numbers, and sums are exact in the narrowest type that holds them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Rows of a block of candidates and of a block of queries.
CANDIDATES = 8192
QUERIES = 512
#: Candidate blocks that meet a query block in one task.
GROUP = 8
#: Shares of the lists that are read by the end of each round.
DEPTHS = (1 / 16, 1 / 4, 1 / 2, 1.0)


def whole(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component x, as longs.

    Rows whose vector or id is null, or whose vector has a null or non-finite component or
    one beyond the longs, are left out.
    """
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: F.coalesce(F.abs(x) < 2.0**62 / scale, F.lit(False)))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(fine)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(F.lit(scale) * x)).alias("v"))


def exact_type(queries: np.ndarray, block: np.ndarray):
    """The narrowest type in which every sum of products of the two is exact."""
    if not queries.size or not block.size:
        return np.float32
    # in Python's integers, which do not overflow
    most = int(np.abs(queries).max()) * int(np.abs(block).max()) * queries.shape[1]
    return np.float32 if most < 1 << 22 else np.float64 if most < 1 << 51 else object


class Block:
    """A block of candidates (n, d) as sorted lists."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        n = len(ids)
        order = np.argsort(values, axis=0, kind="stable")
        self.place = np.empty_like(order)
        np.put_along_axis(self.place, order, np.arange(n)[:, None], axis=0)
        self.sorted = np.take_along_axis(values, order, axis=0)

    def bounds(self, plus: np.ndarray, minus: np.ndarray, share: float, kind) -> tuple[np.ndarray, np.ndarray, bool]:
        """(lower, upper, whether both are the scores) when share of each list is read.

        plus >= 0 >= minus are the queries' weights, (q, d) each.
        """
        n = len(self.ids)
        depth = min(n, max(1, int(np.ceil(share * n))))
        values = self.values.astype(kind)
        if depth == n:
            score = (plus + minus) @ values.T
            return score, score, True
        low, high = self.sorted[0].astype(kind), self.sorted[-1].astype(kind)
        top, bottom = self.sorted[n - depth].astype(kind), self.sorted[depth - 1].astype(kind)
        from_top, from_bottom = self.place >= n - depth, self.place < depth
        # what was read, relative to what the lists end with and to the cursors
        lower = plus @ np.where(from_top, values - low, 0).T + minus @ np.where(from_bottom, values - high, 0).T
        upper = plus @ np.where(from_top, values - top, 0).T + minus @ np.where(from_bottom, values - bottom, 0).T
        return lower + (plus @ low + minus @ high)[:, None], upper + (plus @ top + minus @ bottom)[:, None], False


class Best:
    """The k best (score, id) of each query so far, ties to the smaller id."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.score: list[np.ndarray] = [np.zeros(0, np.int64)] * n_queries
        self.id: list[np.ndarray] = [np.zeros(0, np.int64)] * n_queries

    def floor(self, q: int) -> float:
        """The score that a further candidate must reach."""
        return float(self.score[q][-1]) if len(self.score[q]) == self.k else -np.inf

    def add(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.r_[self.score[q], score], np.r_[self.id[q], ids]
        order = np.lexsort((ids, -score))[: self.k]
        self.score[q], self.id[q] = score[order], ids[order]


def search_block(query_ids: np.ndarray, queries: np.ndarray, block: Block, best: Best) -> None:
    """Add the block's candidates that are among the k best of each query."""
    kind = exact_type(queries, block.values)
    k = best.k
    if kind is object:
        # beyond the exact floats: one by one; sums beyond the longs raise when stored
        for q, i in enumerate(query_ids):
            score = np.array([sum(int(a) * int(b) for a, b in zip(queries[q], v, strict=True)) for v in block.values], np.int64)
            other = block.ids != i
            best.add(q, score[other], block.ids[other])
        return
    plus, minus = np.maximum(queries, 0).astype(kind), np.minimum(queries, 0).astype(kind)
    n, at = len(block.ids), np.arange(len(queries))
    for share in DEPTHS:
        lower, upper, last = block.bounds(plus[at], minus[at], share, kind)
        own = query_ids[at, None] == block.ids[None, :]
        lower = np.where(own, -np.inf, lower)
        kth = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(at), -np.inf)
        kth = np.maximum(kth, [best.floor(q) for q in at])
        alive = (upper >= kth[:, None]) & ~own
        # where few are left no outsider can qualify, and their scores are resolved
        done = np.full(len(at), True) if last else alive.sum(1) <= 4 * k
        for j in np.flatnonzero(done):
            if len(rest := np.flatnonzero(alive[j])):
                best.add(at[j], block.values[rest] @ queries[at[j]], block.ids[rest])
        at = at[~done]
        if not len(at):
            return


#: Types in which a block's values can be stored, the narrowest first.
_STORED = ("<i1", "<i2", "<i4", "<i8")


def narrowed(values: np.ndarray) -> tuple[str, bytes]:
    """(type, bytes) of values in the narrowest type."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    kind = next(t for t in _STORED if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return kind, values.astype(kind).tobytes()


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(ids, values of shape (n, dim)) of a block's row."""
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["vals"], row["kind"]).astype(np.int64).reshape(len(ids), row["dim"])


def packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most size rows of each partition: (block, dim, kind, ids, vals).

    Vectors of different length are in blocks of their own.
    """

    def run(batches):
        from pyspark import TaskContext

        base, n = TaskContext.get().partitionId() << 32, 0
        held: dict[int, tuple[list, list]] = {}

        def flush(dim: int):
            nonlocal n
            ids, values = held.pop(dim)
            kind, data = narrowed(np.concatenate(values))
            row = {"block": base + n, "dim": dim, "kind": kind, "ids": np.array(ids, np.int64).tobytes(), "vals": data}
            n += 1
            return pa.RecordBatch.from_pylist([row], pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("kind", pa.string()), ("ids", pa.binary()), ("vals", pa.binary())]))

        for batch in batches:
            lists = batch.column(1)
            dims = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            stops = np.r_[0, np.cumsum(dims)]
            for i, (vec_id, dim) in enumerate(zip(batch.column(0).to_pylist(), dims.tolist(), strict=True)):
                ids, values = held.setdefault(dim, ([], []))
                ids.append(vec_id)
                values.append(flat[stops[i] : stops[i + 1]])
                if len(ids) == size:
                    yield flush(dim)
        for dim in list(held):
            yield flush(dim)

    return rows.mapInArrow(run, "block long, dim int, kind string, ids binary, vals binary")


def top_k(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """The k best candidates of every query: (query_id, rank, vec_id, score).

    queries and candidates: (vec_id, v) as from whole(). The score is the inner product;
    ties go to the smaller vec_id; a query's own id is no candidate. Vectors of different
    length have no score together, and a query without candidates has no row. Rows that
    repeat a candidate's vec_id each count; equal query rows are one; different vectors under
    one query id share its k places. Scores beyond the longs raise an error. Empty tables
    give an empty result.
    """
    spark = queries.sparkSession
    common.ship(spark)
    work = common.shared_dir(spark)
    asked = queries.distinct()
    asked = asked.repartition(max(1, -(-asked.count() // (QUERIES * 7 // 8))))
    asked = common.stored(packed(asked, QUERIES).withColumnRenamed("block", "q"), f"{work}/queries")
    blocks = common.stored(packed(candidates, CANDIDATES), f"{work}/blocks")
    # every group of candidate blocks meets every query block of its length: blocks, not rows
    n_groups = max(1, -(-blocks.count() // GROUP))
    left = asked.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    names = asked.select("dim", F.col("q").alias("rq"))
    grouped = blocks.withColumn("g", F.pmod(F.xxhash64("block"), F.lit(n_groups)).cast("int")).select("dim", "kind", F.col("g").alias("rg"), "ids", "vals")
    right = grouped.join(F.broadcast(names) if names.count() <= 10_000 else names, "dim")
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(asking: pa.Table, offered: pa.Table) -> pa.Table:
        out = [np.zeros((3, 0), np.int64)]
        for a in asking.to_pylist():
            ids, values = unpacked(a)
            best = Best(len(ids), k)
            for b in offered.to_pylist():
                search_block(ids, values, Block(*unpacked(b)), best)
            out += [np.stack([np.full(len(best.id[i]), q), best.id[i], best.score[i]]) for i, q in enumerate(ids)]
        return pa.Table.from_arrays(list(map(pa.array, np.concatenate(out, axis=1))), schema=schema)

    found = left.groupBy("q", "g").cogroup(right.groupBy("rq", "rg")).applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of embeddings for every twentieth vec_id; edge cases are those of whole and top_k."""
    rows = whole(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(rows.filter(F.col("vec_id") % 20 == 0), rows, 20)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
