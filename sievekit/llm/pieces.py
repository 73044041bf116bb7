"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

All different words of a slice of texts lie one after the other in flat numpy arrays of
symbols. In each round the smallest pair rank of every word is found by a segmented
minimum, all leftmost occurrences of that pair are merged at once, the arrays are compacted
and words without a pair leave, until no pair remains.

Merging all occurrences at once equals the library's one-by-one order unless the new piece
could at once take part in a merge that ranks as well or better; for those pieces a round
merges the leftmost occurrence of a word only.

A word is a run of blanks with what follows it up to the next blank or line feed: no piece
holds a blank after another character, nor a line feed, so merges never cross words (both
are checked when a model is loaded). Words of more than ``LONG`` characters could take as many
rounds as characters; they are merged one pair at a time from a heap, which gives the same ids.
"""

from __future__ import annotations

import heapq
import re
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Characters of text per numpy round.
CHARS = 1_000_000
#: Words whose ids a worker keeps, at most.
KEPT_WORDS = 400_000
#: Characters of a word that is merged in rounds, at most.
LONG = 1000
BLANK = "▁"
_NONE = np.iinfo(np.int32).max


class Pieces:
    """Encoder and decoder of one model file of type BPE with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        text = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        if any(sp.is_unused(i) for i in range(n)) or sp.normalize("a  ﬁ\n") != f"{BLANK}a{BLANK * 2}ﬁ\n":
            raise ValueError("only models with identity normalisation, a blank in front and no unused piece are supported")
        own = {text[i]: i for i in range(n) if not special[i]}
        self.crossing = [p for p in own if BLANK in p.lstrip(BLANK) or "\n" in p]
        if self.crossing or any(c not in own for p in own for c in p):
            raise ValueError("a piece crosses words or has a character that is no piece")
        self.unknown = sp.unk_id()
        self.bytes = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)

        score = np.array([sp.get_score(i) for i in range(n)])
        rank = np.unique(-score, return_inverse=True)[1].astype(np.int32)
        self.char = np.full(0x110000, -1, np.int32)
        pairs: list[tuple[int, int, int]] = []
        eager: set[int] = set()  # pieces that can take part in a merge at least as good as their own
        for p, i in own.items():
            if len(p) == 1:
                self.char[ord(p)] = i
            for cut in range(1, len(p)):
                a, b = own.get(p[:cut]), own.get(p[cut:])
                if a is not None and b is not None:
                    pairs.append((a * n + b, i, rank[i]))
                    eager.update(x for x in (a, b) if rank[i] <= rank[x])
        pairs.sort()
        self.n = n
        self.key, self.merged = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int32)
        self.rank = np.array([p[2] for p in pairs], np.int32)
        self.eager = np.zeros(n, bool)
        self.eager[list(eager)] = True

        # decoding: what each id stands for, as bytes
        raw = [b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i) else bytes([int(text[i][1:-1], 16)]) if sp.is_byte(i) else text[i].replace(BLANK, " ").encode() for i in range(n)]
        self.width = np.array([len(x) for x in raw], np.int64)
        self.at = np.cumsum(self.width) - self.width
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.leads_blank = np.array([not special[i] and text[i].startswith(BLANK) for i in range(n)])
        self.is_byte = np.array([sp.is_byte(i) for i in range(n)])

        # a long run of blanks splits off its longest blank piece from the left
        longest = max((len(p) for p in own if not p.strip(BLANK)), default=1)
        word = rf"[ {BLANK}]*[^ {BLANK}\n]+|[ {BLANK}]+|\n+"
        self.pattern = re.compile(word)
        run = [len(text[i]) for i in self._ids([" " * (4 * longest + 3)])[0]]
        if run[:2] == [longest] * 2 and longest > 1:
            self.pattern = re.compile(rf"[ {BLANK}]{{{longest}}}(?=[ {BLANK}]{{{2 * longest}}})|{word}")
        self.words = common.WordStore(self._ids, KEPT_WORDS)

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of pairs of ids; _NONE where there is no such merge."""
        key = a.astype(np.int64) * self.n + b
        key[(a < 0) | (b < 0)] = -1
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = self.key[at] == key
        return np.where(hit, self.rank[at], _NONE), np.where(hit, self.merged[at], -1)

    def merge_rounds(self, symbol: np.ndarray, word: np.ndarray, place: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Merge until no pair remains; parts of (word, place of the first character, id)."""
        done = []
        rank, to = np.full(len(symbol), _NONE, np.int32), np.full(len(symbol), -1, np.int32)
        stale = np.arange(len(symbol))
        while len(symbol):
            # ranks of the pairs that changed; the last symbol of a word has no pair
            stale = stale[stale + 1 < len(symbol)]
            inside = stale[word[stale] == word[stale + 1]]
            rank[stale], to[stale] = _NONE, -1
            rank[inside], to[inside] = self._pair(symbol[inside], symbol[inside + 1])
            rank[-1] = _NONE
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.r_[first, len(word)])
            if (best == _NONE).any():
                over = np.repeat(best == _NONE, sizes)
                done.append((word[over], place[over], symbol[over]))
                symbol, word, place, rank, to = (x[~over] for x in (symbol, word, place, rank, to))
                first, best, sizes = None, best[best != _NONE], sizes[best != _NONE]
                if not len(symbol):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, sizes))
            # of overlapping occurrences every second one, from the left
            runs = np.r_[True, np.diff(hit) != 1]
            in_run = np.arange(len(hit)) - np.flatnonzero(runs)[np.cumsum(runs) - 1]
            first_in_word = np.r_[True, word[hit[1:]] != word[hit[:-1]]]
            hit = hit[np.where(self.eager[to[hit]], first_in_word, in_run % 2 == 0)]
            symbol[hit] = to[hit]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            now = hit - np.arange(len(hit))
            symbol, word, place, rank, to = (x[keep] for x in (symbol, word, place, rank, to))
            changed = np.zeros(len(symbol), bool)
            changed[now] = True
            changed[np.maximum(now - 1, 0)] = True
            stale = np.flatnonzero(changed)
        return done

    @cached_property
    def _merges(self) -> dict[int, tuple[int, int]]:
        """(rank, merged id) by pair."""
        return dict(zip(self.key.tolist(), zip(self.rank.tolist(), self.merged.tolist(), strict=True), strict=True))

    def merge_long(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, ids) of one word's pieces: always the pair of least rank, the leftmost first.

        The heap holds rank and place in one number; an entry counts if the pair that begins
        at its place still has its rank.
        """
        n, size, merges = self.n, len(symbol), self._merges
        rank, _ = self._pair(symbol[:-1], symbol[1:])
        at = np.flatnonzero(rank != _NONE)
        heap = ((rank[at].astype(np.int64) << 36) | at).tolist()
        heapq.heapify(heap)
        ids, before, after = symbol.tolist(), list(range(-1, size - 1)), list(range(1, size + 1))
        low = (1 << 36) - 1
        while heap:
            entry = heapq.heappop(heap)
            i = entry & low
            a, j = ids[i], after[i]
            if a == -2 or j >= size:
                continue
            found = merges.get(a * n + ids[j]) if a >= 0 and ids[j] >= 0 else None
            if found is None or found[0] != entry >> 36:
                continue
            ids[i], ids[j] = found[1], -2  # -2: part of the piece before
            k = after[i] = after[j]
            if k < size:
                before[k] = i
                if ids[k] >= 0 and (new := merges.get(found[1] * n + ids[k])):
                    heapq.heappush(heap, (new[0] << 36) | i)
            h = before[i]
            if h >= 0 and ids[h] >= 0 and (new := merges.get(ids[h] * n + found[1])):
                heapq.heappush(heap, (new[0] << 36) | h)
        out = np.array(ids, np.int32)
        stay = np.flatnonzero(out != -2)
        return stay, out[stay]

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        points = np.where(points == 32, np.uint32(ord(BLANK)), points)
        word = np.repeat(np.arange(len(words), dtype=np.int32), [len(w) for w in words])
        symbol, place = self.char[points], np.arange(len(points), dtype=np.int64)
        done = []
        if long := [i for i, w in enumerate(words) if len(w) > LONG]:
            ends = np.cumsum([len(w) for w in words])
            short = np.ones(len(points), bool)
            for i in long:
                lo, hi = ends[i] - len(words[i]), ends[i]
                at, ids = self.merge_long(symbol[lo:hi])
                done.append((np.full(len(at), i, np.int32), lo + at, ids))
                short[lo:hi] = False
            symbol, word, place = symbol[short], word[short], place[short]
        done += self.merge_rounds(symbol, word, place)
        if not done:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        word, place, ids = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(place, kind="stable")
        word, place, ids = word[order], place[order], ids[order]
        raw = ids < 0
        if raw.any():  # characters that are no piece become bytes
            points, which = np.unique(points[place[raw]], return_inverse=True)
            coded = [self.bytes[list(chr(c).encode("utf-8", "surrogatepass"))] for c in points.tolist()]
            size = np.array([len(c) for c in coded], np.int64)
            flat, length = common.gathered(np.concatenate(coded), (np.cumsum(size) - size)[which], size[which])
            count = np.ones(len(ids), np.int64)
            count[raw] = length
            word, ids, raw = np.repeat(word, count), np.repeat(ids, count), np.repeat(raw, count)
            ids[raw] = flat
        return ids, np.bincount(word, minlength=len(words))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        words: list[str] = []
        counts = []
        for t in texts:
            found = self.pattern.findall(" " + t) if t else []
            counts.append(len(found))
            words += found
        ids, length = self.words.ids(words)
        ends = np.r_[0, np.cumsum(length)]
        stops = np.cumsum([0, *counts])
        return ids, ends[stops[1:]] - ends[stops[:-1]]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each run of ids; a blank in front of its first piece is left out.

        Bytes that are no UTF-8 become U+FFFD, one each.
        """
        flat, width = common.gathered(self.raw, self.at[ids], self.width[ids])
        ends = np.r_[0, np.cumsum(width)]
        stops = np.r_[0, np.cumsum(counts)]
        data, out = flat.tobytes(), []
        control = self.width[ids] == 0
        for a, b in zip(stops[:-1], stops[1:], strict=True):
            while a < b and control[a]:
                a += 1
            lo = ends[a] + (1 if a < b and self.leads_blank[ids[a]] else 0)
            part = data[lo : ends[b]]
            try:
                out.append(part.decode())
            except UnicodeDecodeError:
                out.append(_lenient(part))
        return out


def _lenient(data: bytes) -> str:
    out, at = [], 0
    while at < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


common.KEPT["pieces"] = load.cache_clear


def encode(docs: DataFrame, model: str, keep: list[str], out: str = "ids", text_col: str = "text", decoded: str | None = None) -> DataFrame:
    """The columns ``keep`` of docs and ``out``: the ids of text_col, array<int>; with
    ``decoded`` also, under that name, the text that the ids decode to, by the same workers.

    A null or empty text has no ids. Repeated rows each come out; an empty table stays
    empty. A column among keep that is named out or decoded is replaced. model is a path that every
    executor can open.
    """
    common.ship(docs.sparkSession)
    keep = [c for c in keep if c not in (out, decoded)]
    new = [T.StructField(out, T.ArrayType(T.IntegerType()))] + ([T.StructField(decoded, T.StringType())] if decoded else [])
    names = [*keep, *[f.name for f in new]]
    carried = docs.select(*keep)
    source = docs.select(*keep, F.col(text_col).cast("string").alias("__sievekit_text"))

    def run(batches):
        pieces = load(model)
        for batch, texts in common.slices(batches, "__sievekit_text", CHARS, "pieces"):
            ids, counts = pieces.encode(texts)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(ids, pa.int32()))
            back = [pa.array(pieces.decode(ids, counts), pa.string())] if decoded else []
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], lists, *back], names)
        pieces.words.settle()

    return source.mapInArrow(run, T.StructType([*carried.schema.fields, *new]))


def decode(encoded: DataFrame, model: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """encoded with ``out`` added: the text of the ids; null ids count as none.

    A column of encoded named out is replaced; repeated rows each come out; an empty table
    stays empty.
    """
    common.ship(encoded.sparkSession)
    encoded = encoded.drop(out)
    names = encoded.columns
    at = names.index(ids_col)

    def run(batches):
        pieces = load(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                lists = part.column(at)
                counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                texts = pieces.decode(lists.flatten().to_numpy(zero_copy_only=False), counts)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*names, out])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(out, T.StringType())]))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of documents and of their decoded texts. Null and empty texts have no
    id; repeated rows each come out, an empty table gives no row, other columns are ignored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = encode(docs, default_model(), ["doc_id"], decoded="decoded")
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
