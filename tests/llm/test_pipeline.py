import hashlib

import sentencepiece

import corpus_pipeline
from sievekit.llm import pieces

from .helpers import awkward, empty


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "pii", "mixing", "sentencepiece"]
    for df in (awkward(spark), empty(spark)):
        docs = df
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, "")
            if i < 4:
                assert out.columns == df.columns
                docs = out
        assert out.columns == ["doc_id", "source", "n_tokens", "ids", "decoded_sha256"]
        library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
        expected = sorted((r.doc_id or -1, r.text) for r in docs.collect())
        got = sorted(((r.doc_id or -1, tuple(r.ids), r.decoded_sha256) for r in out.collect()), key=lambda r: r[0])
        for (i, text), (j, ids, sha) in zip(expected, got, strict=True):
            assert i == j and list(ids) == library.encode(text or "") and sha == hashlib.sha256(library.decode(list(ids)).encode()).hexdigest()


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 100 and out.filter("n_tokens <> size(ids)").count() == 0
