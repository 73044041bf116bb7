import hashlib
import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from sievekit.llm import repeats

from .helpers import SCHEMA, empty


def brute(docs):
    seen, out = set(), {}
    for i, t in sorted(docs, key=lambda x: x[0]):
        b = (t or "").encode()
        covered = np.zeros(len(b), bool)
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                covered[p : p + 100] = True
            else:
                seen.add(b[p : p + 100])
        kept = bytes(np.frombuffer(b, np.uint8)[~covered])
        out[i] = (len(b), int((np.diff(np.r_[0, covered.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def run(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return {r.doc_id: (r.n_bytes, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in repeats.remove_repeats(df).collect()}


def fixture(seed):
    rng = random.Random(seed)
    base = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    docs = []
    for i in range(50):
        t = ""
        for _ in range(rng.randrange(1, 6)):
            if rng.random() < 0.6:
                a = rng.randrange(2800)
                t += base[a : a + rng.choice([40, 99, 100, 101, 120, 170, 300])]
            else:
                t += "".join(rng.choice("xyz") for _ in range(rng.randrange(1, 150)))
        docs.append((i, t))
    return docs + [(100, None), (101, ""), (102, "a" * 500), (103, "ab" * 200), (104, "a" * 99), (105, "a" * 100), (106, docs[3][1]), (107, "é" * 120), (108, "x" + "é" * 60), (-5, base[500:900])]


@pytest.mark.parametrize("most", [20_000, 1])
def test_matches_brute_force(spark, most, monkeypatch):
    monkeypatch.setattr(repeats, "MAX_CONTEXTS", most)
    monkeypatch.setattr(repeats, "INDEX_BYTES", 20_000)
    docs = fixture(most)
    assert run(spark, docs) == brute(docs)


@pytest.mark.parametrize("least", [0, 3])
def test_hot_grams(spark, least, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_BYTES", 0)
    monkeypatch.setattr(repeats, "HOT_CONTEXTS", least)
    docs = fixture(17 + least)
    assert run(spark, docs) == brute(docs)


def test_ids_that_repeat_or_lack(spark):
    text = "".join(random.Random(1).choices("abcdefghij", k=150)) + "tail"
    docs = [(None, text), (1, text), (1, text), (0, "short"), (2, None)]
    df = spark.createDataFrame([(i, t, *[None] * 11) for i, t in docs], SCHEMA)
    got = sorted((r.doc_id is None, r.doc_id or 0, len(r.kept)) for r in repeats.remove_repeats(df).collect())
    assert got == [(False, 0, 5), (False, 1, 154), (False, 1, 154), (False, 2, 0), (True, 0, 0)]
    assert repeats.remove_repeats(empty(spark)).count() == 0


def test_index():
    rng = np.random.default_rng(4)
    texts = [bytes(rng.integers(97, 99, n)) for n in (60, 150, 33, 1)] + [b"ab" * 80, b"ab" * 75]
    text, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    index = repeats.RunLengthIndex(text, ends)
    suffix = [texts[np.searchsorted(ends, p, side="right")][p - (ends[np.searchsorted(ends, p, side="right")] - len(texts[np.searchsorted(ends, p, side="right")])) :] for p in range(len(text))]
    assert index.order.tolist() == sorted(range(len(text)), key=lambda p: (suffix[p], p))
    lengths = index.match_lengths()
    for a, b in zip(index.order, index.order[1:], strict=False):
        n = 0
        while n < min(len(suffix[a]), len(suffix[b])) and suffix[a][n] == suffix[b][n]:
            n += 1
        assert lengths[b] == n
    assert len(index.heads) < len(text)


@pytest.mark.parametrize("seed", range(20))
def test_index_of_long_suffixes(seed):
    rng = np.random.default_rng(seed)
    base = bytes(rng.integers(97, 99, 400))
    cuts = [(int(a), int(a + n)) for a, n in zip(rng.integers(0, 300, 30), rng.integers(1, 250, 30), strict=True)]
    texts = [base[a:b] for a, b in cuts] + [b"a" * 160, b"a" * 130, b"ab" * 90]
    text, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    when = rng.permutation(len(text))
    index = repeats.RunLengthIndex(text, ends, 100)
    starts = ends - [len(t) for t in texts]
    windows = [(int(when[p]), p, bytes(text[p : p + 100])) for a, b in zip(starts, ends, strict=True) for p in range(a, b - 99)]
    first = {}
    for w, _, string in windows:
        first[string] = min(w, first.get(string, w))
    assert index.later_repeats(when).tolist() == sorted(p for w, p, string in windows if w > first[string])
    assert len(index.order) == len(windows)


def test_index_of_nothing():
    index = repeats.RunLengthIndex(np.frombuffer(b"abcab", np.uint8), np.array([3, 5]), 100)
    assert not len(index.later_repeats(np.arange(5)))


def test_covering_contexts():
    rng = np.random.default_rng(1)
    for _ in range(500):
        place = np.sort(rng.choice(900, rng.integers(1, 40), replace=False))
        stay = repeats.covering(place)
        starts = [{s for p in some.tolist() for s in range(p - 60, p + 1)} for some in (place, place[stay])]
        assert starts[0] == starts[1]
    assert repeats.covering(np.arange(0, 300, 10)).sum() < 10
    assert not len(repeats.covering(np.zeros(0, np.int64)))


@pytest.mark.parametrize("most", [1, 3])
def test_many_copies(spark, most, monkeypatch):
    monkeypatch.setattr(repeats, "MAX_COPIES", most)
    monkeypatch.setattr(repeats, "CHARS", 1500)
    docs = fixture(most)
    docs += [(200 + i, docs[i % 3 + 4][1]) for i in range(30)]
    assert run(spark, docs) == brute(docs)


def test_anchors_are_shared():
    rng = np.random.default_rng(9)
    passage = rng.integers(97, 123, 400).astype(np.uint8)
    a, b = (np.r_[rng.integers(97, 123, n).astype(np.uint8), passage, rng.integers(97, 123, 77).astype(np.uint8)] for n in (130, 251))
    found = []
    for t, n in ((a, 130), (b, 251)):
        places, _, _ = repeats.anchors(t, np.array([len(t)]))
        assert np.diff(places).max() <= repeats.LENGTH - repeats.GRAM + 1
        found.append({p - n for p in places if 60 <= p - n <= 300})
    assert found[0] == found[1]


@pytest.mark.parametrize("over", [0, 30_000])
def test_keys_hold_places(over, monkeypatch):
    """An index of the size that the query builds sorts keys that hold their places; a larger one, of a single
    gram, has no bits for them. Both orders are those of the suffixes."""
    size = repeats.INDEX_BYTES
    assert (size + 1) ** 3 << size.bit_length() < 2**63
    rng = np.random.default_rng(over)
    base, texts, total = bytes(rng.integers(40, 100, 2000).astype(np.uint8)), [], 0
    while total + 160 <= repeats.INDEX_BYTES + over:
        a = int(rng.integers(0, 1840))
        texts.append(base[a : a + int(rng.integers(100, 161))])
        total += len(texts[-1])
    shifts, dense = [], repeats._dense
    monkeypatch.setattr(repeats, "_dense", lambda keys, shift=0: shifts.append(shift) or dense(keys, shift))
    text, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    index = repeats.RunLengthIndex(text, ends, 100)
    end = np.repeat(ends, [len(t) for t in texts])
    rows = [p for p in range(len(text)) if end[p] - p >= 100]
    data = text.tobytes()
    assert index.order.tolist() == sorted(rows, key=lambda p: (data[p : end[p]], p))
    assert len(shifts) > 2 and {s > 0 for s in shifts} == {not over}


@pytest.mark.parametrize("block", [1, 37, 100, 1000])
def test_blocks_change_no_anchor(block, monkeypatch):
    rng = np.random.default_rng(block)
    ends = np.cumsum([0, 350, 99, 100, 1, 5, 700, 160])
    text = np.r_[rng.integers(97, 123, ends[-1] - 160), np.full(160, 97)].astype(np.uint8)
    grams = repeats.rolled(repeats._BYTE[text], repeats.GRAM)
    starts = [s for s in range(len(text) - 99) if not any(s < e < s + 100 for e in ends)]
    want = {p for s in starts for p in range(s, s + 61) if grams[p] == grams[s : s + 61].min()}
    monkeypatch.setattr(repeats, "BLOCK", block)
    place, gram, least = repeats.anchors(text, ends)
    assert place.tolist() == sorted(want) and (gram == grams[place]).all()
    assert least.tolist() == [int(grams[s : s + 61].min()) if s in set(starts) else 0 for s in range(len(text) - 99)]


@pytest.mark.parametrize("most", [1, 300])
def test_copies_of_a_slice_are_indexed(most, monkeypatch):
    """Contexts of one hash that differ: only what is equal is marked."""
    rng = random.Random(most)
    passage = "".join(rng.choices("abcdefgh", k=300))
    texts = ["".join(rng.choices(letters, k=n)) + passage + "".join(rng.choices(letters, k=90)) for letters, n in (("0123", 120), ("WXYZ", 50), ("-+*/", 0))]
    monkeypatch.setattr(repeats, "MAX_COPIES", most)
    monkeypatch.setattr(repeats, "context_hashes", lambda text, start, *rest: np.full(len(start), 7, np.uint64))
    rows = SimpleNamespace(select=lambda *_: SimpleNamespace(mapInArrow=lambda run, _: run))
    batch = pa.RecordBatch.from_pydict({"key": [1, 2, 3], "text": texts})
    found = [row for out in repeats.find_anchors(rows, 1, np.zeros(0, np.uint64))(iter([batch])) for row in out.to_pylist()]
    key, start, end = repeats.merged(*repeats.joined([r["data"] for r in found if r["kind"] == repeats.STRETCHES], 3))
    assert list(zip(key.tolist(), start.tolist(), end.tolist(), strict=True)) == [(2, 50, 350), (3, 0, 300)]
