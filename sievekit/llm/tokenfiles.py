"""Token-id files: independent zstandard frames with a trailing seek table.

A file holds documents in ascending doc_id order. Each document's ids, as little-endian
unsigned 32-bit integers, are one zstandard frame (a document of more than ``FRAME_IDS`` ids
takes several). After them comes a skippable frame with the document index, and last the seek
table of the public seekable format: for each frame its compressed and decompressed size and
the low 32 bits of the XXH64 of its content. Any zstandard decoder reads the ids of a whole
file; a reader with the two tables seeks to the frames of the documents asked for,
decompresses those alone and verifies each one's checksum.

    documents: frame* | skippable(index) | skippable(seek table)

Files are written below a temporary name and moved into place when complete, so a task that
is lost and run again, or twice at once, leaves one whole file.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Ids of one frame, at most.
FRAME_IDS = 1 << 20
#: Characters of text per round, and words whose ids a worker keeps.
CHARS = 1_000_000
KEPT_WORDS = 2_000_000
LEVEL = 1
END_ID = 2

# Fixed values of the zstandard formats.
SKIPPABLE = 0x184D2A50
SEEK_SKIPPABLE = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

#: A byte-level tokenizer's pre-tokens never cross from a non-blank to a blank character.
_BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(rf"[{_BLANK}]*[^{_BLANK}]+|[{_BLANK}]+")
_BLANKS = frozenset(c for c in map(chr, range(0x3001)) if re.match(rf"[{_BLANK}]", c))


class Encoder:
    """Whole texts to ids with the tokenizers library; different words are encoded once.

    Texts are cut where a blank follows a non-blank: the byte-level pre-tokenizer always
    starts a new token there, so the ids are those of the whole text.

    The ids are those of the library's defaults: a text that holds an added token, as
    <|endoftext|>, gets its id there. Such texts are encoded whole by the library.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        contents = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, contents))) if contents else None
        self.whole = Tokenizer.from_file(path) if contents else None
        # a byte-level token has a character for each of its bytes
        self.width = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.width[i] = len(token)
        self.words = common.WordStore(self._encode_words, KEPT_WORDS)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Different words in one text: they are cut apart again by their bytes.

        A word without a blank in front is set off by a line feed, which is a token of its
        own there; a word of blanks alone would run into the next one and is encoded alone.
        """
        alone = [i for i, w in enumerate(words) if w[-1] in _BLANKS]
        together = np.delete(np.arange(len(words)), alone)
        parts = [words[i] for i in together.tolist()] if alone else words.copy()
        added = np.zeros(len(parts), np.int64)
        for i in [i for i, w in enumerate(parts) if w[0] not in _BLANKS]:
            parts[i] = "\n" + parts[i]
            added[i] = 1
        ids = np.array(self.tokenizer.encode_batch_fast(["".join(parts)], add_special_tokens=False)[0].ids, np.int32)
        reached = np.cumsum(self.width[ids])
        wanted = np.cumsum(np.fromiter(map(len, map(str.encode, parts)), np.int64, len(parts)))
        ends = np.searchsorted(reached, wanted) + 1
        if len(ends) and not np.array_equal(reached[ends - 1], wanted):
            raise ValueError("a token crosses words")
        length = np.diff(np.r_[0, ends]).astype(np.int64)
        first, length = ends - length + added, length - added
        pool, start, count = ids, np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        start[together], count[together] = first, length
        for i in alone:
            own = np.array(self.tokenizer.encode(words[i], add_special_tokens=False).ids, np.int32)
            start[i], count[i] = len(pool), len(own)
            pool = np.r_[pool, own]
        return common.gathered(pool, start, count)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        words: list[str] = []
        counts = []
        whole = [i for i, t in enumerate(texts) if t and self.added and self.added.search(t)]
        apart = set(whole)
        for i, t in enumerate(texts):
            found = _CHUNK.findall(t) if t and i not in apart else []
            counts.append(len(found))
            words += found
        ids, length = self.words.ids(words)
        ends = np.r_[0, np.cumsum(length)]
        stops = np.cumsum([0, *counts])
        start, count = ends[stops[:-1]], ends[stops[1:]] - ends[stops[:-1]]
        if not whole:
            return ids, count
        pool = [ids]
        for i in whole:
            own = np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, np.int32)
            start[i], count[i] = sum(map(len, pool)), len(own)
            pool.append(own)
        return common.gathered(np.concatenate(pool), start, count)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


common.KEPT["tokens"] = encoder.cache_clear


def _checksum(data: bytes | memoryview) -> int:
    """The low 32 bits of the XXH64."""
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class Writer:
    """Writes one file to an output stream."""

    def __init__(self, out):
        import zstandard

        self.out, self.squeeze = out, zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[bytes] = []
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []
        self.n_ids = 0

    def _frame(self, data: bytes | memoryview) -> None:
        packed = self.squeeze.compress(data)
        self.out.write(packed)
        self.frames.append(struct.pack("<III", len(packed), len(data), _checksum(data)))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """ids: little-endian unsigned 32-bit, contiguous."""
        data = memoryview(ids).cast("B") if len(ids) else b""
        for lo in range(0, len(data), 4 * FRAME_IDS):
            self._frame(data[lo : lo + 4 * FRAME_IDS])
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids))
        self.n_ids += len(ids)

    def finish(self) -> None:
        null = np.array([d is None for d in self.doc_ids], np.uint8)
        ids = np.array([0 if d is None else d for d in self.doc_ids], "<i8")
        index = self.squeeze.compress(null.tobytes() + ids.tobytes() + np.array(self.counts, "<i8").tobytes())
        body = struct.pack("<QI", len(self.doc_ids), len(index)) + index
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        # the index takes part in the offsets with no content of its own; its checksum is that of its bytes
        self.frames.append(struct.pack("<III", len(body) + 8, 0, _checksum(body)))
        table = b"".join(self.frames) + struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SEEK_SKIPPABLE, len(table)) + table)


class Reader:
    """Random access to one file: the documents' ids, and the ids of any of them."""

    def __init__(self, file):
        import zstandard

        self.file, self.plain = file, zstandard.ZstdDecompressor()
        end = file.size()
        n, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEK_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums")
        self.table = np.frombuffer(self._at(end - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.offset = np.r_[0, np.cumsum(self.table[:, 0])]
        start = self.offset[-2]
        body = self._at(start + 8, self.table[-1, 0] - 8)
        if _checksum(body) != self.table[-1, 2]:
            raise ValueError("document index: wrong checksum")
        n_docs, size = struct.unpack("<QI", body[:12])
        index = self.plain.decompress(body[12 : 12 + size], max_output_size=17 * n_docs) if n_docs else b""
        null = np.frombuffer(index, np.uint8, n_docs)
        self.doc_ids = [None if z else int(d) for z, d in zip(null, np.frombuffer(index, "<i8", n_docs, n_docs), strict=True)]
        self.counts = np.frombuffer(index, "<i8", n_docs, 9 * n_docs)
        self.first = np.r_[0, np.cumsum(-(-self.counts // FRAME_IDS))].astype(np.int64)
        self.start = np.r_[0, np.cumsum(self.counts)].astype(np.int64)

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(int(offset))
        return self.file.read(int(size))

    def tokens(self, i: int) -> bytes:
        """The ids of document i, little-endian; only its frames are read and checked."""
        lo, hi = self.first[i], self.first[i + 1]
        data = self._at(self.offset[lo], self.offset[hi] - self.offset[lo])
        out = []
        for f in range(lo, hi):
            a = self.offset[f] - self.offset[lo]
            part = self.plain.decompress(data[a : a + self.table[f, 0]], max_output_size=int(self.table[f, 1]))
            if _checksum(part) != self.table[f, 2]:
                raise ValueError(f"frame {f}: wrong checksum")
            out.append(part)
        return b"".join(out)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = END_ID) -> DataFrame:
    """Encode every text and write the files; returns the manifest, read from its table.

    docs: doc_id and text. Null and empty texts have no id but end_id, which is appended to
    each document if given. Files follow each other in ascending doc_id (null first; equal
    doc_ids by text). Manifest: part, file, n_docs, n_ids, least and most doc_id; an empty
    table has no file. tokenizer is a path that every executor can open.
    """
    common.ship(docs.sparkSession)

    def run(batches):
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}.tokens.zst"
        fs, root = common.filesystem(folder)
        fs.create_dir(f"{root}/_tmp", recursive=True)
        draft = f"{root}/_tmp/{name}-{context.taskAttemptId()}"
        model, writer, out = encoder(tokenizer), None, None
        for batch, texts in common.slices(batches, "text", CHARS, "tokens"):
            if writer is None:
                out = fs.open_output_stream(draft)
                writer = Writer(out)
            ids, counts = model.encode(texts)
            ids = ids.astype("<u4")
            if end_id is not None:
                ids, counts = np.insert(ids, np.cumsum(counts), end_id), counts + 1
            stops = np.cumsum(counts).tolist()
            for doc_id, a, b in zip(batch.column(0).to_pylist(), [0, *stops], stops, strict=False):
                writer.add(doc_id, ids[a:b])
        model.words.settle()
        if writer is None:
            return
        writer.finish()
        out.close()
        common.put_in_place(fs, draft, f"{root}/{name}")
        known = [d for d in writer.doc_ids if d is not None]
        row = {"part": context.partitionId(), "file": f"{folder}/{name}", "n_docs": len(writer.doc_ids), "n_ids": writer.n_ids, "least": min(known, default=None), "most": max(known, default=None)}
        yield pa.RecordBatch.from_pylist([row], MANIFEST)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    written = ordered.mapInArrow(run, "part int, file string, n_docs long, n_ids long, least long, most long")
    return common.stored(written, f"{folder}/_manifest")


MANIFEST = pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("least", pa.int64()), ("most", pa.int64())])


def read_tokens(manifest: DataFrame, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, tokens): documents from the files of a manifest.

    start counts the ids of all documents before; tokens is binary, little-endian unsigned
    32-bit. With doc_ids, files without them are not opened and other documents' frames are
    neither read nor decompressed.
    """
    common.ship(manifest.sparkSession)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row a file
    files = manifest.select("file", "least", "most", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long").alias("base"))
    wanted = None if doc_ids is None else frozenset(doc_ids)
    if wanted is not None:
        files = files.filter(reduce_or([(F.col("least") <= d) & (F.col("most") >= d) for d in sorted(wanted)]))

    def rows(reader: Reader, base: int) -> Iterator[pa.RecordBatch]:
        chosen = [i for i, d in enumerate(reader.doc_ids) if wanted is None or d in wanted]
        lo = 0
        while lo < len(chosen):
            hi, size = lo, 0
            while hi < len(chosen) and (hi == lo or size < 8_000_000):
                size += 4 * int(reader.counts[chosen[hi]])
                hi += 1
            at = chosen[lo:hi]
            columns = [pa.array([reader.doc_ids[i] for i in at], pa.int64()), pa.array(base + reader.start[at]), pa.array(reader.counts[at]), pa.array([reader.tokens(i) for i in at], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "tokens"])
            lo = hi

    def run(batches):
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, path = common.filesystem(file)
                with fs.open_input_file(path) as f:
                    yield from rows(Reader(f), base)

    n = max(1, manifest.count())
    return files.select("file", "base").repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, tokens binary")


def reduce_or(conditions: list):
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the ids of documents lie in the files, and their checksums, read back from them.
    Null and empty texts have the end id alone; repeated rows each come out, an empty table
    gives no row, other columns are ignored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    manifest = write_tokens(docs, common.shared_dir(spark), default_tokenizer())
    return read_tokens(manifest).select("doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))
