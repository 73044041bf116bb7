"""What the operators share: shared folders, code shipping, batching, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import runtime

RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of an Arrow batch, about: whole texts have no bound on their length.
BATCH_BYTES = 16 << 20
#: The namespace of our folders below spark.checkpoint.dir.
FOLDER = "sievekit"


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, as a URI.

    Where that setting is empty (tests, one machine) a temporary folder becomes the
    checkpoint directory of the session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix=FOLDER))
            base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{FOLDER}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write df as Parquet in a shared folder and read it back: lineage ends here."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send the library to the Python workers, once a session.

    Arrow batches are made smaller where the session has Spark's default: 10,000 whole
    texts at once are more than a worker should hold, and so are a few hundred very long ones.
    """
    if spark.conf.get(RECORDS) == "10000":
        spark.conf.set(RECORDS, "2000")
    if int(spark.conf.get(BYTES, str(2**31 - 1)).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(BYTES, str(BATCH_BYTES))
    runtime.ship(spark)


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a URI; plain paths are local."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "file://" + uri[len("file:") :].replace("//", "", 1) if uri.startswith("file://") else "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def put_in_place(fs, draft: str, path: str) -> None:
    """Move a complete file to its name. A file that an earlier attempt has put there stays:
    attempts write the same bytes, and readers may have it open."""
    if fs.get_file_info(path).type.name == "NotFound":
        fs.move(draft, path)
    else:
        fs.delete_file(draft)


def rest() -> None:
    """Give memory that this worker does not use back to the system."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


#: What empties the stores that operators keep in a worker between tasks, by operator.
KEPT: dict[str, Callable[[], None]] = {}


def slices(batches: Iterator, text: str, limit: int, own: str | None = None) -> Iterator[tuple]:
    """Cut Arrow batches into (batch, texts) with at most about ``limit`` characters.

    One longer text makes a slice of its own. Null texts come out as None. Workers serve one
    operator after another: what others than ``own`` keep in this one is given up.
    """
    for name, empty in KEPT.items():
        if name != own:
            empty()
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        step = max(1, min(batch.num_rows, limit * batch.num_rows // max(1, column.nbytes)))
        for base in range(0, batch.num_rows, step):
            texts = column.slice(base, step).to_pylist()
            start = total = 0
            for i, t in enumerate(texts):
                n = len(t) if t else 0
                if i > start and total + n > limit:
                    yield batch.slice(base + start, i - start), texts[start:i]
                    start, total = i, 0
                total += n
            yield batch.slice(base + start, len(texts) - start), texts[start:]
    rest()


class WordStore:
    """Ids of words, encoded when first seen and kept while they recur.

    encode gets different words and returns (ids of all, number of ids of each). At most
    about ``limit`` words stay; when they are too many, the rarest go.

    Words are looked up by Python's 64-bit keyed string hash and their length, in an
    open-addressed table of numpy arrays: a lookup of many words is a few gathers. Every word
    found is compared with the one stored, byte by byte; a word that shares its hash with
    another is encoded apart.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self, room: int = 1024) -> None:
        # used up to n words, n_ids ids and n_chars bytes of words
        self.n = self.n_ids = self.n_chars = 0
        self.pool, self.chars = np.zeros(room, np.int32), np.zeros(room, np.uint8)
        self.char_start, self.char_length = np.zeros(room, np.int64), np.zeros(room, np.int32)
        self.hash = np.zeros(room, np.uint64)
        self.start = np.zeros(room, np.int64)
        self.length, self.uses = np.zeros(room, np.int32), np.zeros(room, np.int32)
        self._index(room)

    def _index(self, words: int) -> None:
        """An empty table with room for words at a load of a half."""
        self.bits = max(10, int(2 * words - 1).bit_length())
        self.key, self.slot = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)

    def _home(self, h: np.ndarray) -> np.ndarray:
        return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _insert(self, h: np.ndarray, slot: np.ndarray) -> None:
        """Enter different hashes that are not in the table."""
        mask, at = (1 << self.bits) - 1, self._home(h)
        while len(h):
            free = self.key[at] == 0
            self.key[at[free]] = h[free]
            won = free & (self.key[at] == h)
            self.slot[at[won]] = slot[won]
            h, slot, at = h[~won], slot[~won], (at[~won] + 1) & mask

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Slots of hashes, -1 for those that are not in the table."""
        out, mask, at = np.full(len(h), -1, np.int64), (1 << self.bits) - 1, self._home(h)
        left = np.arange(len(h))
        while len(left):
            key = self.key[at]
            hit = key == h
            out[left[hit]] = self.slot[at[hit]]
            on = ~hit & (key != 0)
            left, h, at = left[on], h[on], (at[on] + 1) & mask
        return out

    def thin(self, most: int) -> None:
        """Keep the words used most often, at least twice, at most ``most``."""
        stay = np.flatnonzero(self.uses[: self.n] >= 2)
        if len(stay) > most:
            stay = np.sort(stay[np.argsort(-self.uses[stay], kind="stable")[:most]])
        pool, length = gathered(self.pool, self.start[stay], self.length[stay].astype(np.int64))
        chars, char_length = gathered(self.chars, self.char_start[stay], self.char_length[stay].astype(np.int64))
        h, uses = self.hash[stay], self.uses[stay] // 2
        self._clear(max(1024, len(stay)))
        self.n, self.n_ids, self.n_chars = len(stay), len(pool), len(chars)
        self.pool, self.chars = grown(pool, 1024), grown(chars, len(chars) + 1024)
        self.char_start[: self.n], self.char_length[: self.n] = np.cumsum(char_length) - char_length, char_length
        self.start[: self.n], self.length[: self.n], self.hash[: self.n] = np.cumsum(length) - length, length, h
        self.uses[: self.n] = uses
        self._insert(h, np.arange(self.n, dtype=np.int32))

    def settle(self) -> None:
        """Between tasks: no more than half the limit."""
        if self.n > self.limit // 2:
            self.thin(self.limit // 2)

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
        h = np.maximum(h ^ (size.astype(np.uint64) << np.uint64(40)), np.uint64(1))
        data = np.frombuffer("".join(words).encode("utf-8", "surrogatepass") + bytes(8), np.uint8)
        start = np.r_[0, np.cumsum(size)]
        if len(data) - 8 != start[-1]:  # not all are one byte long: where characters begin
            start = np.r_[np.flatnonzero((data[:-8] & 0xC0) != 0x80), len(data) - 8][start]
        start, size = start[:-1], np.diff(start)
        slot = self._find(h)
        missing = np.flatnonzero(slot < 0)
        if len(missing):
            fresh, first, which = np.unique(h[missing], return_index=True, return_inverse=True)
            if self.n and self.n + len(fresh) > self.limit:
                self.thin(self.limit // 2)
                return self.ids(words)
            new = missing[first]
            ids, length = self.encode([words[i] for i in new.tolist()])
            chars, char_length = gathered(data, start[new], size[new])
            n, end, char_end = self.n + len(fresh), self.n_ids + len(ids), self.n_chars + len(chars)
            self.pool, self.chars = grown(self.pool, end), grown(self.chars, char_end + 8)
            self.start, self.length, self.uses, self.hash = (grown(x, n) for x in (self.start, self.length, self.uses, self.hash))
            self.char_start, self.char_length = grown(self.char_start, n), grown(self.char_length, n)
            self.start[self.n : n] = self.n_ids + np.cumsum(length) - length
            self.length[self.n : n], self.hash[self.n : n], self.uses[self.n : n] = length, fresh, 0
            self.char_start[self.n : n], self.char_length[self.n : n] = self.n_chars + np.cumsum(char_length) - char_length, char_length
            self.pool[self.n_ids : end], self.chars[self.n_chars : char_end] = ids, chars
            slots = np.arange(self.n, n, dtype=np.int32)
            self.n, self.n_ids, self.n_chars = n, end, char_end
            if 2 * n > len(self.key):
                self._index(2 * n)
                self._insert(self.hash[:n], np.arange(n, dtype=np.int32))
            else:
                self._insert(fresh, slots)
            slot[missing] = slots[which]
        np.add.at(self.uses, slot, 1)
        first, length = self.start[slot], self.length[slot].astype(np.int64)
        if len(other := self._others(data, start, size, slot)):
            apart = list(dict.fromkeys(words[i] for i in other.tolist()))
            ids, own = self.encode(apart)
            at = {w: i for i, w in enumerate(apart)}
            which = np.array([at[words[i]] for i in other.tolist()])
            first[other], length[other] = self.n_ids + (np.cumsum(own) - own)[which], own[which]
            return gathered(np.concatenate([self.pool[: self.n_ids], ids]), first, length)
        return gathered(self.pool, first, length)

    def _others(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Which words are not the word stored in their slot: eight bytes are compared at once."""
        mine, stored, at = _eights(data), _eights(self.chars), self.char_start[slot]
        same = size == self.char_length[slot]
        wrong, live = [np.flatnonzero(~same)], np.flatnonzero(same)
        for k in range(0, 64, 8):
            if not len(live):
                break
            left = size[live] - k
            differ = (mine[start[live] + k] ^ stored[at[live] + k]) & _LOW[np.minimum(left, 8)] != 0
            wrong.append(live[differ])
            live = live[~differ & (left > 8)]
        for i in live.tolist():
            if not np.array_equal(data[start[i] : start[i] + size[i]], self.chars[at[i] : at[i] + size[i]]):
                wrong.append(np.array([i]))
        return np.concatenate(wrong)


#: Masks of the first n of eight bytes.
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one number."""
    return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))


def grown(x: np.ndarray, n: int) -> np.ndarray:
    """x, or a copy with room for n values and as many again."""
    if n <= len(x):
        return x
    out = np.zeros(2 * n, x.dtype)
    out[: len(x)] = x
    return out


def gathered(pool: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of pool that begin at start, one after the other, and their lengths."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(start - (ends - length), length) + np.arange(total)], length


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components as the links (a, b): every vertex but the smallest of its
    component with that smallest one."""
    vertex, at = np.unique(np.r_[a, b], return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(vertex))
    while len(x):
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        open_ = low != high
        x, y, low, high = x[open_], y[open_], low[open_], high[open_]
        np.minimum.at(root, high, low)
        while not np.array_equal(up := root[root], root):
            root = up
    away = np.flatnonzero(root != np.arange(len(vertex)))
    return vertex[root[away]], vertex[away]


def components(edges: DataFrame, work: str) -> DataFrame:
    """Connected components by contraction: (v, root) for every vertex that is not a root.

    edges has two long columns a and b. Each round every vertex that has a smaller
    neighbour is merged, by pointer jumping, into the vertex at the end of its chain of
    smallest neighbours; edges between merged vertices remain. Links and labels stay in
    tables; the driver sees only whether any are left.
    """
    spark = edges.sparkSession
    maps: list[DataFrame] = []
    left = stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{work}/edges0")
    while not left.isEmpty():
        n = len(maps)
        both = left.select(F.col("b").alias("v"), F.col("a").alias("m")).union(left.select(F.col("a").alias("v"), F.col("b").alias("m")))
        hook = both.groupBy("v").agg(F.min("m").alias("m")).filter("m < v")
        hook = _chased(stored(hook, f"{work}/hook{n}"), f"{work}/map{n}")
        maps.append(hook)
        at_a, at_b = hook.select(F.col("v").alias("a"), F.col("m").alias("ma")), hook.select(F.col("v").alias("b"), F.col("m").alias("mb"))
        moved = left.join(at_a, "a", "left").join(at_b, "b", "left").select(F.coalesce("ma", "a").alias("a"), F.coalesce("mb", "b").alias("b"))
        moved = moved.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        left = stored(moved, f"{work}/edges{n + 1}")
    if not maps:
        return spark.createDataFrame([], "v long, root long")
    label = maps[-1].select("v", F.col("m").alias("root"))
    for m in reversed(maps[:-1]):
        # no v of m is among the v of label: it was merged away before those rounds
        above = label.select(F.col("v").alias("m"), "root")
        label = m.join(above, "m", "left").select("v", F.coalesce("root", "m").alias("root")).union(label)
    return label


def _chased(hook: DataFrame, path: str) -> DataFrame:
    """hook (v, m) with every m replaced by the last vertex of its chain: no m is a v."""
    step = 0
    while True:
        up = hook.select(F.col("v").alias("m"), F.col("m").alias("further"))
        joined = hook.join(up, "m", "left")
        if joined.filter("further is not null").isEmpty():
            return hook
        hook = stored(joined.select("v", F.coalesce("further", "m").alias("m")), f"{path}-{step}")
        step += 1
