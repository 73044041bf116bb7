import hashlib
import math

import pytest
from pyspark.sql import functions as F

from sievekit.llm import mixing

from .helpers import awkward, empty


def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def brute_count(seed, doc_id, text, rate):
    identity = f"{seed}|{'null' if doc_id is None else doc_id}|{md5(text or '')}"
    parts = max(1, math.ceil(rate / mixing.PART))
    n = 0
    for i in range(1, parts + 1):
        u = int(md5(f"{identity}|{i}")[:13], 16) / 2**52
        p = cdf = math.exp(-rate / parts)
        k = 0
        while rate > 0 and u >= cdf:
            k += 1
            p *= rate / parts / k
            cdf += p
        n += k
    return n, identity


@pytest.mark.parametrize("rate", [0.0, 0.3, 1.0, 4.5, 16.0, 50.0])
def test_matches_brute_force(spark, rate):
    df = spark.createDataFrame([(i, f"text {i}", "s") for i in range(200)], "doc_id long, text string, source string")
    table = spark.createDataFrame([("s", rate)], "source string, rate double")
    got = {}
    for r in mixing.mix(df, table).collect():
        got.setdefault(r.doc_id, []).append((r.copy, r.shuffle_key))
    for i in range(200):
        n, identity = brute_count(mixing.SEED, i, f"text {i}", rate)
        assert sorted(got.get(i, [])) == [(c, md5(f"order|{identity}|{c}")) for c in range(1, n + 1)]
    mean = sum(map(len, got.values())) / 200
    assert abs(mean - rate) < 5 * math.sqrt(rate / 200) + 1e-9


def test_order_is_global(spark):
    df = spark.createDataFrame([(i, "t", "s") for i in range(500)], "doc_id long, text string, source string")
    table = spark.createDataFrame([("s", 2.0)], "source string, rate double")
    keys = [r.shuffle_key for r in mixing.mix(df, table).collect()]
    assert keys == sorted(keys) and len(keys) > 800


def test_rates(spark):
    df = spark.createDataFrame([(i, "x" * n, s) for i, (n, s) in enumerate([(900, "a"), (100, "b"), (0, "c"), (500, None)])], "doc_id long, text string, source string")
    by_weight = {r.source: r.rate for r in mixing.rates(df, {"a": 1.0, "b": 3.0}).collect()}
    assert by_weight == {"a": pytest.approx(0.25 * 1500 / 900), "b": pytest.approx(0.75 * 1500 / 100), "c": 0.0, None: 0.0}
    rows = mixing.rates(df).collect()
    assert sum(r.rate * r.size for r in rows) == pytest.approx(1500)
    shares = {r.source: r.rate * r.size for r in rows}
    assert shares["a"] / shares["b"] == pytest.approx(3.0) and shares["c"] == 0


def test_edges(spark):
    df = awkward(spark)
    out = mixing.mix(df, mixing.rates(df, power=0.0, budget=3.0))
    assert set(df.columns) <= set(out.columns)
    table = {r.source: r.rate for r in mixing.rates(df, power=0.0, budget=3.0).collect()}
    expected = sum(brute_count(mixing.SEED, r.doc_id, r.text, table[r.source])[0] for r in df.collect())
    assert out.count() == expected and out.filter(F.col("copy") < 1).count() == 0
    assert mixing.mix(empty(spark), mixing.rates(empty(spark))).count() == 0


def test_high_rates_in_chunks(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"text {i}", "s") for i in range(5)], "doc_id long, text string, source string")
    table = spark.createDataFrame([("s", 40.0, 100.0)], "source string, rate double, size double")
    plain = sorted(mixing.mix(df, table).collect())
    monkeypatch.setattr(mixing, "CHUNK", 7)
    assert sorted(mixing.mix(df, table).collect()) == plain


def test_partitions_follow_the_size(spark, monkeypatch):
    df = spark.createDataFrame([(i, "x" * 100, "s") for i in range(100)], "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "PARTITION_CHARS", 500)
    found = mixing.mix(df, mixing.rates(df))
    assert found.rdd.getNumPartitions() == 20
    keys = [r.shuffle_key for r in found.collect()]
    assert keys == sorted(keys)
