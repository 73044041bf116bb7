import random
import zlib

import numpy as np
import pytest
import zstandard

from sievekit.llm import common, tokenfiles

from .helpers import awkward, empty


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenfiles.default_tokenizer())


def test_encoder_equals_library():
    rng = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "\t", "\x1c", "\x85", "é", "'s", "'ll", "12", "!", "日", "🎉", "<|endoftext|>", "​", "　"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(2000)] + [None, ""]
    ids, counts = tokenfiles.Encoder(tokenfiles.default_tokenizer()).encode(texts)
    stops, lib = np.r_[0, np.cumsum(counts)], library()
    for i, t in enumerate(texts):
        assert ids[stops[i] : stops[i + 1]].tolist() == lib.encode(t or "", add_special_tokens=False).ids


def test_round_trip(spark):
    docs, lib = awkward(spark), library()
    manifest = tokenfiles.write_tokens(docs, common.shared_dir(spark), tokenfiles.default_tokenizer())
    got = tokenfiles.read_tokens(manifest).orderBy("start").collect()
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for r, (doc_id, text) in zip(got, rows, strict=True):
        ids = np.array([*lib.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, zlib.crc32(r.tokens)) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    some = tokenfiles.read_tokens(manifest, [5, 9, 77]).collect()
    assert sorted(r.doc_id for r in some) == [5, 9, 9]


def test_empty_table(spark):
    manifest = tokenfiles.write_tokens(empty(spark), common.shared_dir(spark), tokenfiles.default_tokenizer())
    assert manifest.count() == 0 and tokenfiles.read_tokens(manifest).count() == 0


def test_file_format(tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfiles, "FRAME_IDS", 4)
    path = tmp_path / "x.zst"
    docs = {3: [1, 2, 3, 4, 5, 6, 7, 8, 9], 5: [], 8: [70000]}
    with path.open("wb") as out:
        w = tokenfiles.Writer(out)
        for d, ids in docs.items():
            w.add(d, np.array(ids, "<u4"))
        w.finish()
    fs, name = common.filesystem(str(path))
    r = tokenfiles.Reader(fs.open_input_file(name))
    assert r.doc_ids == list(docs) and [np.frombuffer(r.tokens(i), "<u4").tolist() for i in range(3)] == list(docs.values())
    # any decoder reads the whole: frames in order, skippable ones without content
    plain = zstandard.ZstdDecompressor().stream_reader(path.open("rb"), read_across_frames=True).read()
    assert np.frombuffer(plain, "<u4").tolist() == sum(docs.values(), [])
    data = bytearray(path.read_bytes())
    data[10] ^= 1
    path.write_bytes(data)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        tokenfiles.Reader(fs.open_input_file(name)).tokens(0)


def test_tokens_are_those_of_the_unaltered_library(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenfiles.default_tokenizer())
    end = "<|endoftext|>"
    texts = [f"a{end}b", "plain text", end, f" {end} {end}x\n", None, "", f"<|endof{end}text|>", "a<|endoftext|b"] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    manifest = tokenfiles.write_tokens(docs, common.shared_dir(spark), tokenfiles.default_tokenizer())
    got = {r.doc_id: np.frombuffer(r.tokens, "<u4").tolist() for r in tokenfiles.read_tokens(manifest).collect()}
    assert got == {i: [*lib.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    assert got[0] == [64, 50256, 65, 2]
