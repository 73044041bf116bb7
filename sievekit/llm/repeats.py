"""Removal of repeated 100-byte strings with a run-length Burrows-Wheeler index.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts earlier: in a
document with a smaller id, or earlier in the same one. Strings are judged on the input.

1. Anchors. Of every window of LENGTH bytes the ``GRAM``-byte grams with the smallest hash
   are its anchors. Equal windows have equal anchors at equal places, so a window can only
   repeat among the occurrences of its anchor's gram. An anchor's context is what all
   windows around it can cover: LENGTH - GRAM bytes before it and LENGTH bytes from it on.
2. Grams meet (one hash and place an anchor, packed in columns). Of a gram that several
   places have are indexed: its different contexts (by hash), once each, together; and the
   copies of a context, in groups of bounded size that each hold the first one as well. Of a
   document's copies as many are taken as cover the windows of all. Copies within a slice of
   texts are indexed there, and only the first one meets those of other slices.
3. Index. A shard's contexts, whole grams at a time, are concatenated; their Burrows-Wheeler
   transform is cut into runs, and suffix positions are sampled at the run ends. Match
   lengths of neighbouring suffixes are computed at the sampled ends alone and streamed from
   there along the text: inside a run the match of the next position is shorter by one.
   Neighbours that match over LENGTH bytes form classes of equal windows, and every window
   that is not its class's first is marked.
4. Marked stretches and repeated contexts are joined with the texts and cut out.

Texts travel as zstandard blobs by shard. A gram with more than ``MAX_CONTEXTS`` different
contexts is not indexed at once but place by place: its windows at each place are grouped by
hash and verified byte by byte, which is exact as well and linear in the group. Grams that a
sample of a large input shows in very many places never meet as a whole: each of their
windows is a row of its own, keyed by two hashes, once a slice.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

LENGTH = 100
GRAM = 40
#: Bytes of text of a shard.
SHARD_BYTES = 16_000_000
#: Characters of text per numpy round, bytes whose grams are hashed together, and bytes of
#: contexts of one index: arrays of these two are to stay in a core's cache, and three ranks
#: and a place of an index are to fit a key.
CHARS = 500_000
BLOCK = 16_000
INDEX_BYTES = 50_000
#: Different contexts of one gram that are indexed together, at most.
MAX_CONTEXTS = 20_000
#: Copies of one context that are indexed together, at most.
MAX_COPIES = 300
#: A gram is hot from so many places on; bytes of documents that are sampled to find out;
#: bytes of input from which that is done; hot grams, at most.
HOT_CONTEXTS = 1_000_000
HOT_SAMPLE = 1_000_000_000
HOT_BYTES = 10_000_000_000
HOT_GRAMS = 100_000

_M = 2**64
_BYTE = np.random.default_rng(20).integers(1, _M, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BASE2 = 0xD1342543DE82EF95


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` values, by doubling."""
    done, n_done, size, current = None, 0, 1, values
    k = width
    while True:
        if k & 1:
            if done is None:
                done, n_done = current, size
            else:
                n = len(values) - n_done - size + 1
                done, n_done = done[:n] * np.uint64(pow(_BASE, size, _M)) + current[n_done : n_done + n], n_done + size
        k >>= 1
        if not k:
            return mixed(done)
        n = len(current) - size
        current, size = current[:n] * np.uint64(pow(_BASE, size, _M)) + current[size:], size * 2


def slid(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every run of ``width`` values, by doubling."""
    size = 1
    while size * 2 <= width:
        values, size = pick(values[:-size], values[size:]), size * 2
    rest = width - size
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts that end at ends: (places, gram hashes) of all anchors, and the anchors'
    hash of the window at each place, 0 where there is no whole window."""
    if len(text) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    span = LENGTH - GRAM
    # in blocks that stay in a core's cache; no window stands before the first or after the last
    n = len(text) - LENGTH + 1
    grams, around = np.empty(n + span, np.uint64), np.zeros(n + 2 * span, np.uint64)
    least = around[span : span + n]
    for lo in range(0, n, BLOCK):
        hi = min(lo + BLOCK, n)
        part = grams[lo : hi + span]
        np.maximum(rolled(_BYTE[text[lo : hi + LENGTH - 1]], GRAM), np.uint64(1), out=part)
        least[lo:hi] = slid(part, span + 1, np.minimum)
    # windows across a text's end are none
    over = np.zeros(len(least) + 1, np.int64)
    np.add.at(over, np.clip(ends - LENGTH + 1, 0, len(least)), 1)
    np.add.at(over, np.clip(ends, 0, len(least)), -1)
    least[np.cumsum(over[:-1]) > 0] = 0
    places = []
    for lo in range(0, len(grams), BLOCK):
        part = grams[lo : lo + BLOCK]
        places.append(lo + np.flatnonzero(slid(around[lo : lo + len(part) + span], span + 1, np.maximum) == part))
    places = np.concatenate(places)
    return places, grams[places], least


def context_hashes(text: np.ndarray, start: np.ndarray, end: np.ndarray, lead: np.ndarray, base: int = _BASE2) -> np.ndarray:
    """A hash of text[start:end] and lead, by prefix sums."""
    power = np.cumprod(np.r_[np.uint64(1), np.full(len(text), base, np.uint64)])
    prefix = np.r_[np.uint64(0), np.cumsum(_BYTE[text] * power[:-1])]
    back = np.cumprod(np.r_[np.uint64(1), np.full(len(text), pow(base, -1, _M), np.uint64)])
    return mixed((prefix[end] - prefix[start]) * back[start] + (lead * 1024 + (end - start)).astype(np.uint64) * np.uint64(_BASE))


# --- packed columns and texts ------------------------------------------------------------


def squeezed(*columns: np.ndarray) -> bytes:
    """Columns of equal length, byte planes apart, as one zstandard frame."""
    import zstandard

    parts = [(c.dtype.str, c.view(np.uint8).reshape(len(c), -1).T.tobytes()) for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps((len(columns[0]), parts)))


def opened(blob: bytes) -> list[np.ndarray]:
    import zstandard

    n, parts = pickle.loads(zstandard.ZstdDecompressor().decompress(blob))
    return [np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, n).T).view(kind).ravel() for kind, data in parts]


def joined(blobs: list[bytes], n_columns: int) -> list[np.ndarray]:
    tables = [opened(b) for b in blobs]
    return [np.concatenate([t[i] for t in tables]) if tables else np.zeros(0, np.int64) for i in range(n_columns)]


def dealt(shard: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """(shard, its rows squeezed) for every shard that has rows."""
    if not len(shard):
        return
    order = np.argsort(shard, kind="stable")
    at = np.flatnonzero(np.r_[True, np.diff(shard[order]) != 0])
    for a, b in zip(at, [*at[1:], len(shard)], strict=True):
        yield int(shard[order[a]]), squeezed(*(c[order[a:b]] for c in columns))


def document_shard(keys: np.ndarray, n: int) -> np.ndarray:
    return (mixed(keys.view(np.uint64)) % np.uint64(n)).astype(np.int64)


def merged(key: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of each key, sorted, those that touch or overlap joined."""
    if not len(key):
        return key, start, end
    order = np.lexsort((start, key))
    key, start, end = key[order], start[order], end[order]
    group = np.cumsum(np.r_[True, key[1:] != key[:-1]])
    # a running maximum of ends within the key: later keys lie higher
    height = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * height) - group * height
    new = np.r_[True, (key[1:] != key[:-1]) | (start[1:] > reach[:-1])]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(key)] - 1
    return key[first], start[first], reach[last]


# --- the index ---------------------------------------------------------------------------


class RunLengthIndex:
    """Run-length Burrows-Wheeler transform of several texts, sampled at the run ends.

    heads: where in the transform's order a run begins. sample_first and sample_before: the
    text places of the suffixes at each run's first row and at the row before it, the last
    of the run above. A text's first suffix has no character before it and ends every run.

    Suffixes of fewer than ``least`` bytes are left out. Match lengths of ``least`` and more are
    those of the whole transform: a suffix that is left out and stands between two others can
    only make a streamed length too large that is below ``least``.
    """

    def __init__(self, text: np.ndarray, ends: np.ndarray, least: int = 1):
        n = len(text)
        starts = np.r_[0, ends[:-1]]
        self.end, self.least = np.repeat(ends, ends - starts), least
        room = self.end - np.arange(n)

        def further(x: np.ndarray, k: int) -> np.ndarray:
            """x of the place k bytes on, 0 beyond the last text's end."""
            out = np.zeros(n, np.int64)
            out[: max(n - k, 0)] = x[k:]
            return out

        # as many symbols in a word as fit; beyond a text's end lies the smallest symbol
        used = np.bincount(text, minlength=256) > 0
        symbol = np.cumsum(used)[text]
        self.base = int(used.sum()) + 1
        self.width = next(w for w in range(63, 0, -1) if self.base**w < 2**63)
        self.word, size = symbol, 1
        for bit in f"{self.width:b}"[1:]:
            self.word, size = self.word * self.base**size + further(self.word, size), 2 * size
            if bit == "1":
                self.word, size = self.word * self.base + further(symbol, size), size + 1
        short = np.flatnonzero(room < self.width)
        units = np.array([self.base**k for k in range(self.width + 1)], np.int64)
        self.word = self.word.copy()
        self.word[short] -= self.word[short] % units[self.width - room[short]]
        # small indexes leave bits for the place in a key: values sort faster than places do
        shift = n.bit_length() if (n + 1) ** 3 << n.bit_length() < 2**63 else 0
        width, longest = self.width, int((ends - starts).max(initial=0))
        while self.base**width << shift >= 2**63:
            width -= 1
        rank = _dense(self.word // units[self.width - width], shift)
        # as many ranks in a key as fit; in the last two rounds only the rows that are asked for
        each = next(k for k in range(8, 0, -1) if (n + 1) ** k << shift < 2**63)
        while (2 * each - 1) * width < longest and rank.max() < n - 1:
            key = rank
            for j in range(1, each):
                key = key * (n + 1) + np.where(room > j * width, further(rank, j * width) + 1, 0)
            width *= each
            rank = _dense(key, shift)
        rows = np.flatnonzero(room >= least)
        left, on, rank = room[rows], np.r_[rank + 1, 0], rank[rows]
        done = width
        while done < longest and len(rows):
            for _ in range(1, each):
                rank = rank * (n + 1) + on[np.where(left > done, rows + done, n)]
                done += width
            rank = _dense(rank, shift)
            if rank.max() == len(rows) - 1:
                break
        # equal to their ends: in the order of their places
        self.order = np.sort(rank * n + rows) % n if n else rows
        before = np.where(room[self.order - 1] == 1, 0, symbol[self.order - 1]) if n else rows
        self.heads = np.flatnonzero(np.r_[True, (before[1:] != before[:-1]) | (before[1:] == 0)][: len(rows)])
        self.sample_first, self.sample_before = self.order[self.heads], self.order[self.heads - 1]
        self.sample_before[:1] = -1

    def common_prefix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes in which the suffixes at a and b agree, word by word; of fewer than ``least``
        only so many as are whole words."""
        length = np.zeros(len(a), np.int64)
        left = np.flatnonzero(b >= 0)
        room = np.minimum(self.end[a] - a, self.end[b] - b)
        while len(left):
            x, y = a[left] + length[left], b[left] + length[left]
            fits = length[left] < room[left]
            left, x, y = left[fits], x[fits], y[fits]
            p, q = self.word[x], self.word[y]
            same = p == q
            # within the first word that differs, symbol by symbol
            near = ~same & (length[left] + self.width >= self.least)
            rest, p, q = left[near], p[near], q[near]
            for shift in range(self.width - 1, 0, -1):
                unit = self.base**shift
                length[rest[p // unit == q // unit]] += 1
            length[left[same]] += self.width
            left = left[same]
        return np.minimum(length, room)

    def match_lengths(self) -> np.ndarray:
        """For every place, the bytes it shares with the suffix sorted before it, streamed
        along the text from the sampled run ends."""
        n = len(self.end)
        sampled = np.zeros(n, np.int64)
        at = np.zeros(n, np.int64)
        sampled[self.sample_first] = self.common_prefix(self.sample_first, self.sample_before)
        at[self.sample_first] = self.sample_first
        at = np.maximum.accumulate(at)
        return np.maximum(sampled[at] - (np.arange(n) - at), 0)

    def later_repeats(self, when: np.ndarray) -> np.ndarray:
        """Places whose LENGTH bytes also stand at a place with a smaller ``when``."""
        if not len(self.order):
            return np.zeros(0, np.int64)
        same = self.match_lengths()[self.order] >= LENGTH
        first = np.flatnonzero(~same)
        ranked = when[self.order]
        least = np.minimum.reduceat(ranked, first)
        again = ranked > np.repeat(least, np.diff(np.r_[first, len(same)]))
        return np.sort(self.order[again])


def _dense(keys: np.ndarray, shift: int = 0) -> np.ndarray:
    """Rank of each key among the different ones, from 0. With a shift, keys leave so many bits
    free, and these hold a place."""
    if shift:
        both = np.sort((keys << shift) | np.arange(len(keys)))
        order, ranked = both & ((1 << shift) - 1), both >> shift
    else:
        order = np.argsort(keys)
        ranked = keys[order]
    step = np.zeros(len(keys), np.int64)
    np.not_equal(ranked[1:], ranked[:-1], out=step[1:], casting="unsafe")
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(step)
    return rank


def runs_of(places: np.ndarray, owner: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, start, end) of the bytes that the marked windows of each context cover."""
    if not len(places):
        return (np.zeros(0, np.int64),) * 3
    cut = np.r_[True, (np.diff(places) != 1) | (owner[1:] != owner[:-1])]
    first = np.flatnonzero(cut)
    last = np.r_[first[1:], len(places)] - 1
    return owner[first], (places + shift)[first], (places + shift)[last] + LENGTH


def indexed(text: np.ndarray, ends: np.ndarray, key: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, start, end) of repeated stretches; context i is of document key[i] and
    begins there at start[i]."""
    begins = np.r_[0, ends[:-1]]
    owner = np.repeat(np.arange(len(ends)), ends - begins)
    shift = (start - begins)[owner]
    when = (_dense(key)[owner] << 32) + np.arange(len(text)) + shift
    places = RunLengthIndex(text, ends, LENGTH).later_repeats(when)
    return runs_of(places, owner[places], shift[places])


def place_by_place(text: np.ndarray, ends: np.ndarray, key: np.ndarray, start: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As indexed(), for contexts of one gram that stands lead[i] bytes after their begin:
    windows that cover the gram at equal distance are compared, one distance at a time."""
    begins = np.r_[0, ends[:-1]]
    power = np.cumprod(np.r_[np.uint64(1), np.full(len(text), _BASE2, np.uint64)])
    prefix = np.r_[np.uint64(0), np.cumsum(_BYTE[text] * power[:-1])]
    back = np.uint64(pow(_BASE2, -1, _M))
    inverse = np.cumprod(np.r_[np.uint64(1), np.full(len(text), back, np.uint64)])
    rank = np.empty(len(key), np.int64)
    rank[np.lexsort((start + lead, key))] = np.arange(len(key))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for distance in range(LENGTH - GRAM + 1):
        at = begins + lead - distance
        ok = np.flatnonzero((distance <= lead) & (at + LENGTH <= ends))
        if not len(ok):
            continue
        at = at[ok]
        h = (prefix[at + LENGTH] - prefix[at]) * inverse[at]
        order = np.lexsort((rank[ok], h))
        same = np.r_[False, h[order[1:]] == h[order[:-1]]]
        leader = at[order][np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
        mine, other = at[order][same], leader[same]
        equal = np.ones(len(mine), bool)
        for j in range(LENGTH):
            equal &= text[mine + j] == text[other + j]
        if not equal.all():
            raise ArithmeticError("two different strings have the same hash")
        who = ok[order][same]
        found.append((who, start[who] + lead[who] - distance))
    who, begin = (np.concatenate(x) for x in zip(*found, strict=True))
    return who, begin, begin + LENGTH


def searched(text: np.ndarray, starts: np.ndarray, size: np.ndarray, gram: np.ndarray, key: np.ndarray, place: np.ndarray, begin: np.ndarray, most_bytes: int, most_contexts: int) -> list[np.ndarray]:
    """(key, start, end) of the stretches that the index marks. Context i of group gram[i] is
    text[starts[i]:][:size[i]] and begins in its document at begin[i]. Whole groups are
    indexed at a time, as many as fit most_bytes; larger ones than most_contexts not at once."""
    found = [(np.zeros(0, np.int64),) * 3]
    order = np.lexsort((begin, key, gram))
    # first ones whose copies were all left out stand alone
    alone = ~continues(gram[order])
    alone[:-1] &= alone[1:]
    order = order[~alone]
    gram, key, place, begin, size, starts = (c[order] for c in (gram, key, place, begin, size, starts))
    first = np.flatnonzero(~continues(gram))
    last = np.r_[first[1:], len(gram)]
    ends = np.cumsum(size)
    lo = 0
    while lo < len(first):
        hi = lo + 1
        base = ends[first[lo]] - size[first[lo]]
        big = last[lo] - first[lo] > most_contexts
        while not big and hi < len(first) and ends[last[hi] - 1] - base <= most_bytes:
            hi += 1
        a, b = first[lo], last[hi - 1]
        part, stops = common.gathered(text, starts[a:b], size[a:b])[0], ends[a:b] - base
        if big:
            who, start, end = place_by_place(part, stops, key[a:b], begin[a:b], (place - begin)[a:b])
        else:
            who, start, end = indexed(part, stops, key[a:b], begin[a:b])
        found.append((key[a:b][who], start, end))
        lo = hi
    return [np.concatenate(x) for x in zip(*found, strict=True)]


# --- the stages --------------------------------------------------------------------------


def keyed(docs: DataFrame, work: str) -> DataFrame:
    """(key, doc_id, text): key orders documents; null texts become empty.

    key is doc_id where doc_ids are different and not null. Otherwise documents are ordered
    by doc_id, null last, then by a hash of the text, and rows with equal both share a key.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = rows.groupBy("doc_id").count()
    if ids.filter("count > 1 or doc_id is null").isEmpty():
        return rows.select(F.col("doc_id").alias("key"), "doc_id", "text")
    rows = rows.withColumn("hash", F.xxhash64("text"))
    order = [F.asc_nulls_last("doc_id"), F.asc("hash")]
    keys = rows.select("doc_id", "hash").distinct().repartitionByRange(*order).sortWithinPartitions(*order)
    keys = common.stored(keys.withColumn("key", F.monotonically_increasing_id()), f"{work}/ids")
    names = keys.select(F.col("doc_id").alias("__id"), F.col("hash").alias("__hash"), "key")
    return rows.join(names, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("hash") == F.col("__hash"))).select("key", "doc_id", "text")


def first_of(same: np.ndarray, key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are the first of their group, and which repeat it.

    same: whether a row continues the group of the row before; rows are sorted by group, key
    and place. Rows that agree in key and place are one occurrence of one document and
    neither repeat it nor count again.
    """
    twin = same.copy()
    twin[1:] &= (key[1:] == key[:-1]) & (place[1:] == place[:-1])
    return ~same, same & ~twin


def continues(*columns: np.ndarray) -> np.ndarray:
    """Whether a row equals the one before in all columns."""
    out = np.zeros(len(columns[0]), bool)
    if len(out):
        out[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in columns])
    return out


def _rows(out: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    shards, kinds, blobs = zip(*out, strict=True) if out else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(kinds, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "kind", "data"])


#: Kinds of blobs: anchors by gram or contexts to index by document; repeated stretches;
#: windows of hot grams.
ANCHORS, STRETCHES, WINDOWS = 0, 1, 2
_BLOBS = "shard int, kind int, data binary"


def slices_of(batches, chars: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, ends, key): slices of (key, text) rows, documents in the order of their keys."""
    for batch, texts in common.slices(batches, "text", chars):
        key = batch.column(0).to_numpy()
        order = np.argsort(key, kind="stable")
        data = [texts[i].encode("utf-8", "surrogatepass") for i in order]
        yield np.frombuffer(b"".join(data), np.uint8), np.cumsum([len(d) for d in data]), key[order]


def hot_grams(rows: DataFrame, total: int) -> np.ndarray:
    """Grams that stand in more than HOT_CONTEXTS places by a sample of documents, sorted.

    It only decides how a gram's windows are compared. At most HOT_GRAMS, the most frequent
    ones; inputs of fewer than HOT_BYTES bytes have none that matter.
    """
    if total < HOT_BYTES:
        return np.zeros(0, np.uint64)
    share = min(1.0, HOT_SAMPLE / total)

    def run(batches):
        for text, ends, _ in slices_of(batches, CHARS):
            gram, n = np.unique(anchors(text, ends)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n)], ["gram", "n"])

    sample = rows.select("key", "text").filter(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    counts = sample.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") > HOT_CONTEXTS * share)
    top = counts.orderBy(F.desc("n"), "gram").limit(HOT_GRAMS).collect()
    return np.sort(np.array([r["gram"] for r in top], np.int64).view(np.uint64))


def find_anchors(rows: DataFrame, n: int, hot: np.ndarray) -> DataFrame:
    """(shard, kind, data): anchors (gram, context, key, place, begin, end) by gram, windows
    (hash, hash, key, start) whose anchor is a hot gram, and stretches (key, start, end) that
    repeat within their slice. A slice's copies of a context are indexed there, with its first."""

    def run(batches):
        for text, ends, keys in slices_of(batches, CHARS):
            place, gram, least = anchors(text, ends)
            out, begins = [], np.r_[0, ends[:-1]]
            if len(hot):
                keep = ~np.isin(gram, hot)
                place, gram = place[keep], gram[keep]
                start = np.flatnonzero(np.isin(least, hot))
                one, two = (context_hashes(text, start, start + LENGTH, np.zeros(len(start), np.int64), b) for b in (_BASE, _BASE2))
                doc = np.searchsorted(ends, start, side="right")
                own, start = keys[doc], start - begins[doc]
                order = np.lexsort((start, own, two, one))
                one, two, own, start = (c[order] for c in (one, two, own, start))
                first, again = first_of(continues(one, two), own, start)
                out += [(shard, WINDOWS, blob) for shard, blob in dealt((one[first] % np.uint64(n)).astype(np.int64), [c[first] for c in (one, two, own, start)])]
                out += [(shard, STRETCHES, blob) for shard, blob in _stretches(own[again], start[again], start[again] + LENGTH, n)]
            doc = np.searchsorted(ends, place, side="right")
            begin, end = np.maximum(place - (LENGTH - GRAM), begins[doc]), np.minimum(place + LENGTH, ends[doc])
            context = context_hashes(text, begin, end, place - begin)
            columns = [gram, context, keys[doc], place - begins[doc], begin - begins[doc], end - begins[doc]]
            order = np.lexsort((columns[3], columns[2], context, gram))
            columns, begin = [c[order] for c in columns], begin[order]
            first, again = first_of(continues(*columns[:2]), columns[2], columns[3])
            out += [(shard, ANCHORS, blob) for shard, blob in dealt((columns[0][first] % np.uint64(n)).astype(np.int64), [c[first] for c in columns])]
            row, name, copy = copies_of(first, again, *columns[:2], MAX_COPIES)
            stay = needed(columns[2][row], columns[3][row], copy)
            row, name = row[stay], name[stay]
            key, place, start, end = (c[row] for c in columns[2:])
            stretch = searched(text, begin[row], end - start, name, key, place, start, INDEX_BYTES, MAX_CONTEXTS)
            out += [(shard, STRETCHES, blob) for shard, blob in _stretches(*stretch, n)]
            yield _rows(out)

    return rows.select("key", "text").mapInArrow(run, _BLOBS)


def meet(found: DataFrame, n: int) -> DataFrame:
    """(shard, kind, data) by document: repeated stretches (key, start, end), and contexts to
    index (group, key, place, begin, end, whether it is a copy)."""

    def run(batches):
        blobs, out = {ANCHORS: [], WINDOWS: []}, []
        for batch in batches:
            for shard, kind, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == STRETCHES:
                    out.append((shard, STRETCHES, blob))
                else:
                    blobs[kind].append(blob)
        one, two, key, start = joined(blobs[WINDOWS], 4)
        order = np.lexsort((start, key, two, one))
        one, two, key, start = (c[order] for c in (one, two, key, start))
        _, again = first_of(continues(one, two), key, start)
        out += [(shard, STRETCHES, blob) for shard, blob in _stretches(key[again], start[again], start[again] + LENGTH, n)]

        gram, context, key, place, begin, end = joined(blobs[ANCHORS], 6)
        order = np.lexsort((place, key, context, gram))
        gram, context, key, place, begin, end = (c[order] for c in (gram, context, key, place, begin, end))
        first, again = first_of(continues(gram, context), key, place)
        group = np.cumsum(~continues(gram)) - 1
        undecided = np.flatnonzero(first & (np.bincount(group, first)[group] > 1)) if len(group) else np.flatnonzero(first)
        row, name, copy = copies_of(first, again, gram, context, MAX_COPIES)
        row, name = np.r_[undecided, row], np.r_[gram[undecided], name]
        copy = np.r_[np.zeros(len(undecided), bool), copy]
        out += [(shard, ANCHORS, blob) for shard, blob in dealt(document_shard(key[row], n), [name, *(c[row] for c in (key, place, begin, end)), copy])]
        for lo in range(0, len(out), 64):
            yield _rows(out[lo : lo + 64])

    return found.repartitionById(n, F.col("shard")).mapInArrow(run, _BLOBS)


def copies_of(first: np.ndarray, again: np.ndarray, gram: np.ndarray, context: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, group, whether it is a copy): the copies of every context in groups of at most
    ``most``, and with each group the context's first row."""
    copy = np.flatnonzero(again)
    leader = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))[copy]
    new = np.r_[True, leader[1:] != leader[:-1]][: len(copy)]
    start = np.flatnonzero(new)
    part = (np.arange(len(copy)) - np.repeat(start, np.diff(np.r_[start, len(copy)]))) // most
    name = mixed(mixed(gram[copy].astype(np.uint64) + np.uint64(_BASE)) ^ context[copy].astype(np.uint64)) + part.astype(np.uint64)
    lead = np.flatnonzero(new | np.r_[True, part[1:] != part[:-1]][: len(copy)])
    return np.r_[copy, leader[lead]], mixed(np.r_[name, name[lead]]), np.r_[np.ones(len(copy), bool), np.zeros(len(lead), bool)]


def covering(place: np.ndarray) -> np.ndarray:
    """Which of a document's contexts, sorted by place, hold the windows of all of them. The
    windows of a context start at its place or up to LENGTH - GRAM bytes before."""
    stay = np.zeros(len(place), bool)
    at, reach = -1, -1
    for i, p in enumerate(place.tolist()):
        if at >= 0 and p - (LENGTH - GRAM) > reach + 1:
            # a gap begins after the context before: that one stays
            stay[at] = True
            reach = int(place[at])
        if at < 0 or p - (LENGTH - GRAM) > reach + 1:
            stay[i], reach = True, p
        at = i
    if at >= 0:
        stay[at] = True
    return stay


def needed(key: np.ndarray, place: np.ndarray, copy: np.ndarray) -> np.ndarray:
    """Which contexts are to be indexed, by key: all that are no copies, and of a document's
    copies as many as cover the windows of all."""
    order = np.lexsort((place, copy, key))
    key, place, copy = (c[order] for c in (key, place, copy))
    stay, copies = ~copy, np.flatnonzero(copy)
    for own in np.split(copies, np.flatnonzero(np.diff(key[copies])) + 1):
        stay[own] = covering(place[own])
    return order[stay]


def _stretches(key: np.ndarray, start: np.ndarray, end: np.ndarray, n: int) -> Iterator[tuple[int, bytes]]:
    stretch = merged(key, start, end)
    return dealt(document_shard(stretch[0], n), list(stretch))


def text_blobs(rows: DataFrame, n: int) -> DataFrame:
    """(shard, data): documents (key, doc_id, text) by shard."""

    def run(batches):
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3)
        for batch, texts in common.slices(batches, "text", 32 * CHARS):
            key, ids = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            by: dict[int, list] = {}
            for shard, k, i, t in zip(document_shard(key, n).tolist(), key.tolist(), ids, texts, strict=True):
                by.setdefault(shard, []).append((k, i, t.encode("utf-8", "surrogatepass")))
            for shard in by:
                blob = squeeze.compress(pickle.dumps(by[shard]))
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([blob], pa.binary())], ["shard", "data"])

    return rows.select("key", "doc_id", "text").mapInArrow(run, "shard int, data binary")


def documents_in(table: pa.Table) -> Iterator[tuple[int, int | None, bytes]]:
    import zstandard

    for blob in table["data"].to_pylist():
        yield from pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def take_contexts(texts: DataFrame, undecided: DataFrame, n: int) -> DataFrame:
    """(shard, data) by group: contexts (group, key, place, begin, end) and their bytes."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        gram, key, place, begin, end, copy = joined(right["data"].to_pylist(), 6)
        out = []
        if len(key):
            stay = needed(key, place, copy)
            gram, key, place, begin, end = (c[stay] for c in (gram, key, place, begin, end))
            pieces, rows, seen = [], [], set()
            for k, _, text in documents_in(left):
                a, b = np.searchsorted(key, k, "left"), np.searchsorted(key, k, "right")
                if a < b and k not in seen:
                    seen.add(k)
                    rows.append(np.arange(a, b))
                    pieces += [text[x:y] for x, y in zip(begin[a:b].tolist(), end[a:b].tolist(), strict=True)]
            at = np.concatenate(rows)
            columns = [c[at] for c in (gram, key, place, begin, end)]
            shard = (columns[0] % np.uint64(n)).astype(np.int64)
            sort = np.argsort(shard, kind="stable")
            cut = np.flatnonzero(np.r_[True, np.diff(shard[sort]) != 0])
            for a, b in zip(cut, [*cut[1:], len(sort)], strict=True):
                rows_here = sort[a:b]
                out.append((int(shard[rows_here[0]]), squeezed(*(c[rows_here] for c in columns)), _pressed(b"".join(pieces[i] for i in rows_here))))
        cols = list(zip(*out, strict=True)) if out else [(), (), ()]
        return pa.table([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())], names=["shard", "data", "bytes"])

    return texts.groupBy("shard").cogroup(undecided.groupBy("shard")).applyInArrow(run, "shard int, data binary, bytes binary")


def _pressed(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(data)


def mark(contexts: DataFrame, n: int) -> DataFrame:
    """(shard, kind, data) by document: stretches (key, start, end) that the index marks."""

    def run(batches):
        import zstandard

        blobs, texts = [], []
        for batch in batches:
            blobs += batch.column(1).to_pylist()
            texts += [zstandard.ZstdDecompressor().decompress(t) for t in batch.column(2).to_pylist()]
        if not blobs:
            return
        gram, key, place, begin, end = joined(blobs, 5)
        size = end - begin
        starts = np.cumsum(size) - size
        stretch = searched(np.frombuffer(b"".join(texts), np.uint8), starts, size, gram, key, place, begin, INDEX_BYTES, MAX_CONTEXTS)
        for shard, blob in _stretches(*stretch, n):
            yield _rows([(shard, STRETCHES, blob)])

    return contexts.repartitionById(n, F.col("shard")).mapInArrow(run, _BLOBS)


def cut(texts: DataFrame, stretches: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): what goes, as [start, end) pairs, and what stays."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        key, start, end = merged(*joined(right["data"].to_pylist(), 3))
        rows = []
        for k, doc_id, text in documents_in(left):
            a, b = np.searchsorted(key, k, "left"), np.searchsorted(key, k, "right")
            spans = list(zip(start[a:b].tolist(), end[a:b].tolist(), strict=True))
            at, kept = 0, []
            for x, y in spans:
                kept.append(text[at:x])
                at = y
            kept.append(text[at:])
            rows.append((doc_id, len(text), [list(s) for s in spans], b"".join(kept)))
        cols = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
        return pa.table([pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)], schema=schema)

    return texts.groupBy("shard").cogroup(stretches.groupBy("shard")).applyInArrow(run, "doc_id long, n_bytes long, spans array<array<long>>, kept binary")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Cut repeated strings out of every text: (doc_id, n_bytes, spans, kept).

    spans are the removed byte ranges of the UTF-8 text, [start, end), apart from each other;
    kept is the rest, which need not be valid UTF-8. Null and empty texts have no byte. A
    null doc_id counts as larger than all others; documents with one doc_id are ordered by a
    hash of their text, and rows that repeat doc_id and text are one document, which comes
    out for each. Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    common.ship(spark)
    work = common.shared_dir(spark)
    rows = keyed(docs, work)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(8, -(-total // SHARD_BYTES))
    met = common.stored(meet(find_anchors(rows, n, hot_grams(rows, total)), n), f"{work}/met")
    contexts = take_contexts(text_blobs(rows, n), met.filter(F.col("kind") == ANCHORS).select("shard", "data"), n)
    marked = common.stored(mark(contexts, n), f"{work}/marked")
    stretches = met.filter(F.col("kind") == STRETCHES).select("shard", "data").union(marked.select("shard", "data"))
    return cut(text_blobs(rows, n), stretches)


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remove_repeats leaves of documents, as sizes and a digest; edge cases are stated there."""
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
