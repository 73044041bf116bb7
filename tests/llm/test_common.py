import random

import numpy as np
import pyarrow as pa
import pytest

from sievekit.llm import common


@pytest.mark.parametrize("limit", [3, 50, 10_000])
def test_word_store(limit):
    rng, asked = random.Random(limit), []

    def encode(words):
        assert len(set(words)) == len(words)
        asked.extend(words)
        return np.array([ord(c) for w in words for c in w], np.int32), np.array([len(w) for w in words], np.int64)

    store = common.WordStore(encode, limit)
    for _ in range(60):
        words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(0, 80))]
        ids, length = store.ids(words)
        assert length.tolist() == [len(w) for w in words] and ids.tolist() == [ord(c) for w in words for c in w]
        store.settle()
        assert store.n <= max(limit // 2, 0)
    if limit == 10_000:
        assert len(set(asked)) == len(asked)


def test_slices():
    texts = ["a" * n for n in (5, 50, 1, 1, 1, 200, 0, 3)] + [None, "x"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array(texts)], ["i", "t"])
    parts = list(common.slices([batch, batch.slice(0, 0)], "t", 60))
    assert [i for b, _ in parts for i in b.column(0).to_pylist()] == list(range(10))
    assert [t for _, part in parts for t in part] == texts
    assert all(b.num_rows == len(t) for b, t in parts)
    assert all(len(t) == 1 or sum(len(x or "") for x in t) <= 60 for _, t in parts)


def test_filesystem(tmp_path):
    for uri in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        fs, path = common.filesystem(uri)
        assert path == str(tmp_path) and fs.get_file_info(path).type.name == "Directory"


def test_word_store_compares_words(monkeypatch):
    """Words that share a hash still get their own ids."""
    monkeypatch.setattr(common, "hash", lambda w: len(w) % 2, raising=False)
    rng = random.Random(5)

    def encode(words):
        return np.array([ord(c) for w in words for c in w], np.int32), np.array([len(w) for w in words], np.int64)

    store = common.WordStore(encode, 100)
    for _ in range(40):
        words = ["".join(rng.choice("abé🎉") for _ in range(rng.randrange(1, 5))) for _ in range(50)]
        ids, length = store.ids(words)
        assert ids.tolist() == [ord(c) for w in words for c in w] and length.tolist() == [len(w) for w in words]


@pytest.mark.parametrize("seed", range(40))
def test_stars(seed):
    rng = random.Random(seed)
    n = rng.randrange(40)
    a, b = (np.array([rng.randrange(25) for _ in range(n)], np.int64) for _ in "ab")
    least = {x: x for x in [*a.tolist(), *b.tolist()]}
    for _ in range(30):
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            least[x] = least[y] = min(least[x], least[y])
    root, vertex = common.stars(a, b)
    assert dict(zip(vertex.tolist(), root.tolist(), strict=True)) == {x: r for x, r in least.items() if x != r}


def test_slices_give_up_what_others_keep(monkeypatch):
    emptied = []
    monkeypatch.setattr(common, "KEPT", {"a": lambda: emptied.append("a"), "b": lambda: emptied.append("b")})
    list(common.slices([], "text", 10, "a"))
    assert emptied == ["b"]
    list(common.slices([], "text", 10))
    assert emptied == ["b", "a", "b"]
