import math
import zlib

import numpy as np
import pytest

from sievekit.llm import langid

from .helpers import awkward, empty

WORDS = {
    "en": "the and of to in is that for with house tree water people about which their there would other",
    "fr": "le la les et des dans est que pour avec maison arbre eau gens autour lequel leurs serait autres",
    "de": "der die das und ist nicht mit für haus baum wasser leute über welche ihre wäre andere zwischen",
}


def text(lang, seed, n=40):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS[lang].split(), n))


def labelled(spark, n=60):
    rows = [(i, text(lang, i), lang) for i, lang in enumerate(sorted(WORDS) * n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(spark):
    df = labelled(spark)
    model = langid.fit(df.filter(~langid.held_out()))
    rows = langid.predict(df, model).withColumn("held_out", langid.held_out()).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in rows if r.held_out]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_mixtures(spark):
    model = langid.fit(labelled(spark))
    mixed = text("en", 1, 120) + " " + text("de", 2, 60)
    shares, lettered = model.infer([mixed, text("fr", 3), "123", None])
    found = dict(zip(model.names, shares[0], strict=True))
    assert found["fr"] == 0 and abs(found["en"] - 0.65) < 0.12 and abs(found["de"] - 0.35) < 0.12
    assert shares[1].max() == 1.0 and lettered.tolist() == [True, True, False, False]
    alone = np.vstack([model.infer([t])[0] for t in (mixed, text("fr", 3))])
    assert np.allclose(alone, shares[:2])


def test_edges(spark):
    df = awkward(spark)
    model = langid.fit(df)
    assert model.names == ["de", "en", "fr"]
    rows = langid.predict(df, model).collect()
    assert len(rows) == df.count() and set(df.columns) <= set(rows[0].asDict())
    for r in rows:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred != "und") == lettered and (lettered or r.score == 0.0)
    kept = langid.keep_identified(df, model)
    assert kept.columns == df.columns and kept.filter("lang_pred = 'z'").count() == kept.count() == 7
    assert langid.predict(empty(spark), model).count() == 0
    nothing = langid.fit(empty(spark))
    assert {r.lang_pred for r in langid.predict(df, nothing).collect()} == {"und"}


def test_sample_is_bounded(spark):
    small, large = (langid.fit(labelled(spark), per_language=n) for n in (1, 2000))
    assert small.prob.shape == large.prob.shape and not np.allclose(small.prob, large.prob)
    assert langid.fit(labelled(spark), max_languages=2).names == ["de", "en"]


@pytest.mark.parametrize("value", ["", "İstanbul", "\0\0", "a", "日本語", "\U0001f600"])
def test_trigrams(value):
    doc, bucket, count = langid.trigrams([value, "b", value])
    letters = sum(c.isalpha() for c in value.lower())
    assert count[doc == 0].sum() == letters == count[doc == 2].sum() and count[doc == 1].sum() == 1
    assert ((0 <= bucket) & (bucket < langid.BUCKETS)).all()


def test_letters_of_all_planes():
    last = next(c for c in map(chr, range(0x10FFFF, 0, -1)) if c.isalpha())
    assert langid._letters()[ord(last)] and len(langid.trigrams([last * 3])[0]) > 0


def test_rows_without_doc_id_teach_nothing(spark):
    df = labelled(spark)
    nameless = spark.createDataFrame([(None, text("fr", i), "en") for i in range(300)], "doc_id long, text string, lang string")
    one, two = langid.fit(df, per_language=20), langid.fit(df.unionByName(nameless), per_language=20)
    assert one.names == two.names and np.array_equal(one.prob, two.prob)


def brute_trigrams(value):
    """Count of each bucket, letter by letter."""
    low = "".join(c if c.isalpha() else "\0" for c in (value or "").lower())
    found = {}
    for i, c in enumerate(low):
        if c != "\0":
            around = [ord(x) for x in (low[i - 1 : i] or "\0", c, low[i + 1 : i + 2] or "\0")]
            code = around[0] << 42 | around[1] << 21 | around[2]
            bucket = (code * 0x9E3779B97F4A7C15 % 2**64) >> 48
            found[bucket] = found.get(bucket, 0) + 1
    return found


def brute_em(prob, counts, langs):
    share, total = {x: 1 / len(langs) for x in langs}, sum(counts.values())
    for _ in range(langid.ROUNDS):
        new = dict.fromkeys(langs, 0.0)
        for bucket, n in counts.items():
            mass = sum(share[x] * prob[bucket][x] for x in langs)
            for x in langs:
                new[x] += n * share[x] * prob[bucket][x] / mass
        share = {x: v / total for x, v in new.items()}
    return share, sum(n * math.log(sum(share[x] * prob[bucket][x] for x in langs)) for bucket, n in counts.items())


def brute_infer(prob, value, k):
    """Shares by adding the language that gains most, while it gains more than the penalty."""
    counts = brute_trigrams(value)
    if not counts:
        return [0.0] * k
    penalty = langid.PENALTY * math.log(max(sum(counts.values()), 2))
    options = {x: brute_em(prob, counts, [x]) for x in range(k)}
    chosen = [max(options, key=lambda x: (options[x][1], -x))]
    share, best = options[chosen[0]]
    while len(chosen) < k:
        trials = {x: brute_em(prob, counts, sorted([*chosen, x])) for x in range(k) if x not in chosen}
        x = max(trials, key=lambda x: (trials[x][1], -x))
        if trials[x][1] - best <= penalty:
            break
        chosen.append(x)
        share, best = trials[x]
    return [share.get(x, 0.0) for x in range(k)]


def test_matches_brute_force(spark):
    df = labelled(spark, 12)
    model = langid.fit(df)
    counts = {x: {} for x in model.names}
    for r in df.collect():
        for bucket, n in brute_trigrams(r.text).items():
            counts[r.lang][bucket] = counts[r.lang].get(bucket, 0) + n
    whole = [sum(counts[x].values()) + langid.SMOOTHING * langid.BUCKETS for x in model.names]
    prob = {}
    texts = [text("en", 1), text("de", 2, 60) + " " + text("en", 3, 50), text("fr", 4, 30) + text("de", 5, 40) + "! " + text("en", 6, 70), "Ünïcode 日本 x", "a", "12 !", "", None, text("fr", 7, 5) + " " + text("de", 8, 300)]
    for value in texts:
        for bucket in brute_trigrams(value):
            prob[bucket] = [(counts[x].get(bucket, 0) + langid.SMOOTHING) / w for x, w in zip(model.names, whole, strict=True)]
    expected = np.array([brute_infer(prob, value, 3) for value in texts])
    shares, lettered = model.infer(texts)
    assert np.allclose(shares, expected, atol=1e-9) and (expected > 0).sum(1).max() >= 2
    rows = langid.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in rows] == [model.names[x.argmax()] if x.any() else "und" for x in expected]
    assert np.allclose([r.score for r in rows], expected.max(1))
