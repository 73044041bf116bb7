import random
import time

import numpy as np
import pytest
import sentencepiece

from sievekit.llm import pieces

from .helpers import awkward, empty

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


def texts(seed):
    rng = random.Random(seed)
    out = ["", "  ", " a", "a ", "\n", "\x00a", "▁▁b", " ▁", " " * 100, "the " + " " * 77 + "the", "a" * 40, "ab" * 40, "1234567890" * 30, "=" * 50, "<s></s><unk><0x41>", "\U000f0000x", "日本語🎉 🎉"]
    for alphabet in ("abthe  ▁\n\tien.,1é日🎉_=-*", "ab ", "in the on"):
        out += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)]
    return out


@pytest.mark.parametrize("kept", [800_000, 50])
def test_equals_library(kept):
    p = pieces.Pieces(pieces.default_model())
    p.words.limit = kept
    for seed in range(3):
        batch = texts(seed)
        ids, counts = p.encode([*batch, None])
        decoded = p.decode(ids, counts)
        stops = np.r_[0, np.cumsum(counts)]
        for i, t in enumerate([*batch, ""]):
            expected = LIBRARY.encode(t)
            assert ids[stops[i] : stops[i + 1]].tolist() == expected
            assert decoded[i] == LIBRARY.decode(expected)


def test_decodes_any_ids():
    p = pieces.Pieces(pieces.default_model())
    rng = random.Random(7)
    for _ in range(300):
        ids = [rng.choice([1, 2, 3 + 0xE2, 3 + 0x82, 3 + 0xFF, 259, 28705, 264, rng.randrange(3, 32000)]) for _ in range(rng.randrange(1, 12))]
        if ids[0] > 258:
            assert p.decode(np.array(ids), np.array([len(ids)]))[0] == LIBRARY.decode(ids)


def test_operator(spark):
    df = awkward(spark)
    model = pieces.default_model()
    rows = pieces.decode(pieces.encode(df, model, ["doc_id", "text"]), model).collect()
    assert len(rows) == df.count()
    for r in rows:
        assert list(r.ids) == LIBRARY.encode(r.text or "") and r.decoded == LIBRARY.decode(list(r.ids))
    assert pieces.decode(pieces.encode(empty(spark), model, ["doc_id"]), model).count() == 0
    at_once = pieces.encode(df.withColumn("back", df.text), model, ["doc_id", "text", "back"], decoded="back")
    assert at_once.columns == ["doc_id", "text", "ids", "back"]
    assert sorted(map(repr, map(tuple, at_once.collect()))) == sorted(map(repr, map(tuple, rows)))
    assert pieces.encode(empty(spark), model, ["doc_id"], decoded="back").count() == 0


def test_long_words_equal_library():
    rng, p = random.Random(7), pieces.Pieces(pieces.default_model())
    words = ["".join(rng.choice(alphabet) for _ in range(n)) for n in (1001, 3000) for alphabet in ("a", "ab", "theraino", "aé漢🎉b", "0123456789", "=-_")]
    began = time.perf_counter()
    for t in [*words, " ".join(words), "".join(rng.choice("etaoinshr") for _ in range(200_000))]:
        assert p.encode([t])[0].tolist() == LIBRARY.encode(t)
    assert time.perf_counter() - began < 30


def test_heap_equals_rounds(monkeypatch):
    p = pieces.Pieces(pieces.default_model())
    expected = [p.encode([t])[0].tolist() for t in texts(9)]
    monkeypatch.setattr(pieces, "LONG", 2)
    p.words._clear()
    assert [p.encode([t])[0].tolist() for t in texts(9)] == expected
