"""SimHash near-duplicates: pigeonhole blocks, join on blocks, verified Hamming distance.

A document's fingerprint is the bit-wise majority of the XXH64 hashes of its word shingles.
Two 64-bit fingerprints that differ in at most d bits, cut into m > d blocks, agree in at
least m - d whole blocks. Each fingerprint is therefore keyed by every choice of m - d
blocks; close pairs meet under at least one key and are verified there. m follows the
number of fingerprints, so that few strangers meet under a key at any size; the result is
the same for every m.

That is exact for fingerprints of one word. Similarity of 0.8 on five-word shingles differs in
too many bits for it, so drop_near_duplicates takes several words (functions of the same
shingle hashes): close pairs then meet with high probability under a key of any word, and the
distance is verified over all words. Which pairs meet depends on m there, so m is the same at
every size. Links between fingerprints only propose classes then: within each, texts are linked
if the exact Jaccard similarity of their sets of shingle hashes is high enough.

Only different fingerprints are joined, equal ones are one vertex. A key's fingerprints are
linked by a spanning forest of their verified links, which has the same components as all
links and never more rows than members; a task gives each vertex one link, to the smallest one of
its component there. Keys with more than ``tile`` members are dealt in
tiles: every pair of tiles goes to a task of its own.
"""

from __future__ import annotations

from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Most members of one key that one task compares.
TILE = 4096
#: Rows under keys that a task holds, on average at most.
KEY_ROWS = 2_000_000
#: Shingles of one group of texts that one task compares, about.
SHINGLES = 2_000_000
#: Characters of text per numpy round.
CHARS = 1_000_000
#: Bits in which the word that a key comes from may differ, if there are several words:
#: over four deviations above the mean at a similarity of 0.8.
WORD_BITS = 16


def shingle_hashes(text: str | None, width: int) -> list[int]:
    """XXH64 (seed 42) of each run of ``width`` words; fewer words: of the whole sequence."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(joined, 42)]
    ends = list(accumulate(len(w) + 1 for w in words))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a : b - 1], 42) for a, b in zip([0, *ends], ends[width - 1 :], strict=False)]


def spread(h: np.ndarray, r: int) -> np.ndarray:
    """The hash itself for r = 0, else a further hash that is a function of it."""
    if r == 0:
        return h
    x = h + np.uint64((r * 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(texts: list[str | None], width: int, words: int = 1) -> np.ndarray:
    """uint64 of shape (texts, words); zero where there is no word."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        h = shingle_hashes(t, width)
        counts[i] = len(h)
        hashes += h
    out = np.zeros((len(texts), words), np.uint64)
    if not hashes:
        return out
    flat = np.array(hashes, np.uint64)
    full = np.flatnonzero(counts)
    ends = np.cumsum(counts)
    for r in range(words):
        ones = np.zeros((len(texts), 64), np.int64)
        # rows of 64 bits are summed by document, in runs that bound the memory
        step = 1 << 17
        for lo in range(0, len(flat), step):
            hi = min(len(flat), lo + step)
            bits = np.unpackbits(spread(flat[lo:hi], r).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            docs = full[(ends[full] > lo) & (ends[full] - counts[full] < hi)]
            starts = np.maximum(ends[docs] - counts[docs], lo) - lo
            ones[docs] += np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        major = (2 * ones > counts[:, None]).astype(np.uint8)
        out[:, r] = np.packbits(major, axis=1).view(">u8").ravel()
    return out


def fingerprint_table(docs: DataFrame, width: int, words: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, w): w holds the words as signed longs; fp names them all.

    With one word fp is that word, else a hash of all; w is then what distances are taken of.
    """
    common.ship(docs.sparkSession)

    def run(batches):
        for batch, texts in common.slices(batches, "text", CHARS):
            found = fingerprints(texts, width, words).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, words, dtype=np.int32)), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "w"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    table = source.mapInArrow(run, "doc_id long, w array<long>")
    return table.select("doc_id", (F.get("w", F.lit(0)) if words == 1 else F.xxhash64("w")).alias("fp"), "w")


def block_masks(bits: int, n_blocks: int) -> list[int]:
    """Masks of every choice of n_blocks - bits blocks, as signed longs."""
    cuts = [round(64 * i / n_blocks) for i in range(n_blocks + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    out = []
    for chosen in combinations(blocks, n_blocks - bits):
        mask = sum(chosen)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def choose_blocks(n: int, bits: int) -> int:
    """Fewest blocks at which a fingerprint meets about two strangers at most under a key."""
    for m in range(bits + 1, 4 * bits + 2):
        if n / 2 ** (64 * (m - bits) / m) <= 2 or comb(m + 1, bits) > 4000:
            return m
    return 4 * bits + 1


def blocks_for(n: int, bits: int, words: int) -> int:
    """Blocks of a word. With several words pairs that differ in more than ``bits`` bits of each
    count too, and fewer of them meet the more blocks there are: always bits + 2 then."""
    return choose_blocks(n, bits) if words == 1 else bits + 2


def forest(ids: np.ndarray, fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph whose links are pairs within ``bits``.

    ids (n,) are different, fps is (n, words) and unsigned.
    """
    out = []
    while len(ids):
        todo = [(ids[0], fps[0])]
        ids, fps = ids[1:], fps[1:]
        while todo and len(ids):
            i, x = todo.pop()
            near = np.bitwise_count(fps ^ x).sum(1, dtype=np.int32) <= bits
            if near.any():
                out += [(int(i), int(j)) for j in ids[near]]
                todo += list(zip(ids[near], fps[near], strict=True))
                ids, fps = ids[~near], fps[~near]
    return out


def key_links(key: np.ndarray, ids: np.ndarray, fps: np.ndarray, bits: int) -> np.ndarray:
    """Links (n, 2) among the rows of equal key; key is sorted."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    found: list[np.ndarray] = [np.empty((0, 2), np.int64)]
    small = np.repeat(sizes <= 32, sizes)
    k, n, f = key[small], ids[small], fps[small]
    for d in range(1, 32):
        if len(k) <= d or not (same := k[d:] == k[:-d]).any():
            break
        at = np.flatnonzero(same)
        at = at[np.bitwise_count(f[at] ^ f[at + d]).sum(1, dtype=np.int32) <= bits]
        found.append(np.column_stack([n[at], n[at + d]]))
    for s, m in zip(starts[sizes > 32], sizes[sizes > 32], strict=True):
        if links := forest(ids[s : s + m], fps[s : s + m], bits):
            found.append(np.array(links, np.int64))
    return np.concatenate(found)


def _columns(batches) -> tuple[np.ndarray, ...] | None:
    """The long columns of all batches; a list column becomes (n, words)."""
    parts = []
    for b in batches:
        if b.num_rows:
            parts.append([c.flatten().to_numpy().reshape(b.num_rows, -1) if pa.types.is_list(c.type) else c.to_numpy(zero_copy_only=False) for c in b.columns])
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else None


def partnered(key: np.ndarray, word: np.ndarray, near: int) -> np.ndarray:
    """Which rows have another row of equal key whose word is within ``near`` bits.

    key is sorted. In keys of more than 64 rows all rows count: they are verified later.
    """
    out = np.zeros(len(key), bool)
    for d in range(1, 64):
        if len(key) <= d or not (same := key[d:] == key[:-d]).any():
            return out
        at = np.flatnonzero(same)
        at = at[np.bitwise_count(word[at] ^ word[at + d]) <= near]
        out[at] = out[at + d] = True
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    return out | np.repeat(sizes > 64, sizes)


def dealt(df: DataFrame, rows: int, *keys) -> DataFrame:
    """df by keys, in as many partitions as the session has, or more where those would hold more
    than KEY_ROWS of ``rows`` on average."""
    least = -(-rows // KEY_ROWS)
    return df.repartition(*keys) if least <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(least, *keys)


def links(nodes: DataFrame, bits: int, reach: int, work: str, n_blocks: int | None = None, tile: int = TILE) -> DataFrame:
    """Verified links (a, b) between fps whose words differ in at most ``reach`` bits in all.

    nodes: fp, different, and w. Pairs within ``bits`` in any word always meet; those linked
    have the same components as all links among pairs that meet under a key. A pair can
    come out under several keys.
    """
    spark = nodes.sparkSession
    common.ship(spark)
    count, first = nodes.count(), nodes.select(F.size("w")).first()
    words = first[0] if first else 1
    masks = block_masks(bits, n_blocks or blocks_for(count, bits, words))
    n_masks, near = len(masks), reach if words == 1 else WORD_BITS
    keys = [F.struct(F.lit(r * n_masks + i).alias("c"), F.get("w", F.lit(r)).alias("x")) for r in range(words) for i in range(n_masks)]
    keyed = nodes.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.c", "k.x")
    part = F.col("x").bitwiseAND(F.get(F.array(*map(F.lit, masks)), F.col("c") % n_masks))

    def shared(batches):
        if (found := _columns(batches)) is None:
            return
        fp, c, x = found
        v = x & np.array(masks, np.int64)[c % n_masks]
        order = np.lexsort((v, c))
        fp, c, x, v = fp[order], c[order], x[order], v[order]
        key = np.cumsum(np.r_[True, (c[1:] != c[:-1]) | (v[1:] != v[:-1])])
        stay = partnered(key, x.view(np.uint64), near)
        yield pa.RecordBatch.from_arrays([pa.array(a[stay]) for a in (fp, c, v)], ["fp", "c", "v"])
        del found, fp, c, x, v, order, key
        common.rest()

    # most keys have one member, or strangers; only rows with a likely partner go on
    keyed = common.stored(dealt(keyed, count * len(keys), F.col("c"), part).mapInArrow(shared, "fp long, c int, v long"), f"{work}/keys")
    hot = common.stored(keyed.groupBy("c", "v").count().filter(F.col("count") > tile), f"{work}/hot")
    # a hot key's rows come once a tile
    n_hot, again = hot.agg(F.count("*"), F.coalesce(F.sum(F.col("count") * F.ceil(F.col("count") / tile)), F.lit(0))).first()
    n_keyed = keyed.count() + again
    if n_hot:
        tiles = hot.select("c", "v", F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
        tiles = F.broadcast(tiles) if n_hot <= 50_000 else tiles
        keyed = keyed.join(tiles, ["c", "v"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
        own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
        keyed = keyed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        keyed = keyed.select("fp", "c", "v", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    else:
        keyed = keyed.select("fp", "c", "v", F.lit(0).alias("lo"), F.lit(0).alias("hi"))
    keyed = keyed.join(nodes.select("fp", "w"), "fp").select("fp", "c", "v", "lo", "hi", "w")

    def run(batches):
        if (found := _columns(batches)) is None:
            return
        order = np.lexsort(found[1:5])
        fp, c, v, lo, hi, w = (x[order] for x in found)
        new = np.r_[True, (c[1:] != c[:-1]) | (v[1:] != v[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]
        pairs = key_links(np.cumsum(new), fp, w.view(np.uint64), reach)
        # the same link comes out under many keys: the smallest vertex stands for each component
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in common.stars(pairs[:, 0], pairs[:, 1])], ["a", "b"])
        del found, fp, c, v, lo, hi, w, order
        common.rest()

    return dealt(keyed, n_keyed, "c", "v", "lo", "hi").mapInArrow(run, "a long, b long")


def alike_forest(ids: np.ndarray, sizes: np.ndarray, flat: np.ndarray, tenths: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph whose links are pairs of sets with a Jaccard
    similarity of ``tenths`` tenths at least; two empty sets are equal.

    flat holds the sets' different values, one set of ``sizes`` values after the other.
    """
    out = []
    flat = np.unique(flat, return_inverse=True)[1]
    mark = np.zeros(int(flat.max(initial=-1)) + 1, bool)
    starts = np.cumsum(sizes) - sizes
    left = np.arange(len(ids))
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            i = todo.pop()
            # sizes alone rule a pair out if the smaller set is too small a share of the larger
            low, high = np.minimum(sizes[left], sizes[i]), np.maximum(sizes[left], sizes[i])
            at = np.flatnonzero(10 * low >= tenths * high)
            if not len(at):
                continue
            own = flat[starts[i] : starts[i] + sizes[i]]
            mark[own] = True
            values, length = common.gathered(flat, starts[left[at]], sizes[left[at]])
            ends = np.cumsum(length)
            hits = np.r_[0, np.cumsum(mark[values])]
            shared = hits[ends] - hits[ends - length]
            mark[own] = False
            near = at[10 * shared >= tenths * (sizes[i] + length - shared)]
            if len(near):
                out += [(int(ids[i]), int(ids[j])) for j in left[near]]
                todo += left[near].tolist()
                left = np.delete(left, near)
    return out


def alike(docs: DataFrame, classes: DataFrame, width: int, tenths: int, work: str, room: int = SHINGLES) -> DataFrame:
    """Links (a, b) between texts of one class, by the Jaccard similarity of their shingles.

    docs: t, different, and text. classes: t and root. The links of a class have the same components as
    all its pairs of ``tenths`` tenths at least. Classes with more than ``room`` shingles are
    dealt in tiles, every pair of tiles a task of its own.
    """

    def sets(batches):
        for batch, texts in common.slices(batches, "text", CHARS):
            found = [np.unique(np.array(shingle_hashes(x, width), np.uint64)) for x in texts]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["root", "t", "s"])

    members = docs.join(classes, "t").select("root", "t", "text").mapInArrow(sets, "root long, t long, s array<long>")
    members = common.stored(members, f"{work}/sets")
    # an empty set counts as well: a class may have any number of texts
    full = members.groupBy("root").agg(F.sum(F.size("s") + F.lit(16)).alias("n")).filter(F.col("n") > room)
    full = common.stored(full.select("root", F.ceil(F.col("n") / room).cast("int").alias("tiles")), f"{work}/full")
    n_full = full.count()
    if n_full:
        full = F.broadcast(full) if n_full <= 50_000 else full
        members = members.join(full, "root", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
        members = members.withColumn("own", F.pmod(F.xxhash64("t"), F.col("tiles")).cast("int"))
        members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        members = members.select("root", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "t", "s")
    else:
        members = members.select("root", F.lit(0).alias("lo"), F.lit(0).alias("hi"), "t", "s")

    def linked(parts):
        t, sizes = np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])
        pairs = np.array(alike_forest(t, sizes, np.concatenate([x[2] for x in parts]), tenths), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in common.stars(pairs[:, 0], pairs[:, 1])], ["a", "b"])

    def run(batches):
        # rows come sorted: one group at a time is held
        held, parts = None, []
        for b in batches:
            if not b.num_rows:
                continue
            root, lo, hi, t = (c.to_numpy() for c in b.columns[:4])
            sizes, flat = pc.list_value_length(b.column(4)).to_numpy().astype(np.int64), b.column(4).flatten().to_numpy()
            ends = np.r_[0, np.cumsum(sizes)]
            cuts = np.flatnonzero(np.r_[True, (root[1:] != root[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
            for x, y in zip(cuts, [*cuts[1:], b.num_rows], strict=True):
                if (key := (root[x], lo[x], hi[x])) != held:
                    if parts:
                        yield linked(parts)
                    held, parts = key, []
                parts.append((t[x:y], sizes[x:y], flat[ends[x] : ends[y]]))
        if parts:
            yield linked(parts)
        del parts
        common.rest()

    return members.repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, bits: int = 4, words: int = 1, reach: int | None = None, n_blocks: int | None = None, tile: int = TILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint and near-duplicate class: (doc_id, fp, component_id).

    With one word two texts are linked if their fingerprints differ in at most ``bits``
    bits. With more, if all words together differ in at most ``reach`` bits and they meet
    under a key of any word (see links).

    Null and empty texts, and texts without a word, have fingerprint 0 and are linked like
    any other. component_id is the smallest doc_id reachable over links (null only if every
    doc_id of the class is null). Repeated rows each come out; an empty table gives an empty
    result; other columns of docs are ignored. Whole texts are read, however long.
    """
    spark = docs.sparkSession
    work = common.shared_dir(spark)
    table = common.stored(fingerprint_table(docs, width, words, id_col, text_col), f"{work}/fp")
    nodes = common.stored(table.groupBy("fp").agg(F.min("doc_id").alias("first"), F.first("w").alias("w")), f"{work}/nodes")
    label = common.components(links(nodes, bits, bits if reach is None else reach, work, n_blocks, tile), work)
    label = nodes.join(label.select(F.col("v").alias("fp"), "root"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    label = common.stored(label, f"{work}/roots")
    # a table of its own: a class that is large meets it in a join that Spark can split
    classes = common.stored(label.groupBy("root").agg(F.min("first").alias("component_id")), f"{work}/classes")
    named = label.join(classes, "root").select("fp", "component_id")
    return table.join(named, "fp").select("doc_id", "fp", "component_id")


def similar_texts(docs: DataFrame, width: int = 5, bits: int = 4, words: int = 8, reach: int = 92, tenths: int = 8, room: int = SHINGLES) -> DataFrame:
    """Each document's class of similar texts: (doc_id, component_id) for doc_id, text.

    Two texts are linked if their sets of shingles have a Jaccard similarity of ``tenths``
    tenths at least and links between fingerprints (see near_duplicates) join them.
    component_id is the smallest doc_id reachable over links.
    """
    spark = docs.sparkSession
    work = common.shared_dir(spark)
    # t names a text
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("t"), F.col("text").cast("string").alias("text"))
    table = common.stored(fingerprint_table(source, width, words, id_col="t").select(F.col("doc_id").alias("t"), "fp", "w"), f"{work}/fp")
    nodes = common.stored(table.groupBy("fp").agg(F.first("w").alias("w")), f"{work}/nodes")
    near = common.components(links(nodes, bits, reach, work, None), work).select(F.col("v").alias("fp"), "root")
    texts = table.select("t", "fp").distinct().join(near, "fp", "left").select("t", F.coalesce("root", "fp").alias("root"))
    texts = common.stored(texts, f"{work}/texts")
    several = common.stored(texts.groupBy("root").count().filter("count > 1").select("root"), f"{work}/roots")
    classes = common.stored(texts.join(several, "root", "left_semi"), f"{work}/several")
    exact = f"{work}/exact"
    label = common.components(alike(source.select("t", "text").dropDuplicates(["t"]), classes, width, tenths, exact, room), exact)
    label = common.stored(label.select(F.col("v").alias("t"), "root"), f"{exact}/roots")
    # equal texts shrink to one row before they meet
    least = source.groupBy("t").agg(F.min("doc_id").alias("first"))
    named = common.stored(least.join(label, "t", "left").select("t", "first", F.coalesce("root", "t").alias("root")), f"{exact}/named")
    first = common.stored(named.groupBy("root").agg(F.min("first").alias("component_id")), f"{exact}/first")
    named = named.join(first, "root").select("t", "component_id")
    return source.select("doc_id", "t").join(named, "t").select("doc_id", "component_id")


def drop_near_duplicates(docs: DataFrame, width: int = 5, words: int = 8, reach: int = 92) -> DataFrame:
    """Keep of each class the document with the smallest doc_id, all columns as they are.

    Texts are of one class if links of a similarity of 0.8 of the sets of five-word shingles
    join them. Fingerprints propose them: at 0.8 the words' 512 bits differ in 78 on average,
    with a deviation of 8.
    Rows without doc_id are no one's duplicate and stay. Of rows that repeat the kept
    doc_id one stays.
    """
    found = similar_texts(docs.select("doc_id", "text"), width, words=words, reach=reach)
    work = common.shared_dir(docs.sparkSession)
    found = common.stored(found.filter("doc_id is not null"), f"{work}/classes")
    away = found.filter("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(away, "doc_id", "left_anti")
    if not found.groupBy("doc_id").count().filter("count > 1").isEmpty():
        named, alone = kept.filter("doc_id is not null"), kept.filter("doc_id is null")
        kept = named.dropDuplicates(["doc_id"]).unionByName(alone)
    return kept.select(*docs.columns)


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of four-word shingles of documents and their classes at four bits. Edge
    cases are those of near_duplicates."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=4, bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
