import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievekit.operators import dedup, filters, lookups, reports, selection, splits
from sievekit.runtime import numbered


def greedy(n, pairs):
    kept = []
    near = {(a, b) for a, b in pairs}
    for x in range(n):
        if not any((k, x) in near for k in kept):
            kept.append(x)
    return kept


@pytest.mark.parametrize("kind", ["chain", "random", "star", "none", "all"])
def test_first_kept_equals_a_scan(spark, kind):
    rng = random.Random(kind)
    n = 40
    pairs = {"chain": [(i, i + 1) for i in range(n - 1)], "random": [tuple(sorted(rng.sample(range(n), 2))) for _ in range(70)], "star": [(0, i) for i in range(1, n)], "none": [], "all": [(a, b) for b in range(n) for a in range(b)]}[kind]
    nodes = spark.range(n).withColumnRenamed("id", "pos")
    got = dedup.first_kept(nodes, spark.createDataFrame(pairs, "lo long, hi long")).filter("kept")
    assert sorted(r.pos for r in got.collect()) == greedy(n, pairs)


def test_embedding_dedup_equals_a_scan(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(150, 5))
    v[40] = v[3]
    v[41] = 0
    unit = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    expected, kept = [], []
    for i in range(len(v)):
        sims = [(float(unit[i] @ unit[k]), -k) for k in kept]
        best = max(sims, default=(-2, 0))
        if best[0] >= 0.9:
            expected.append((i, False, -best[1]))
        else:
            expected.append((i, True, None))
            kept.append(i)
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "pos long, embedding array<double>")
    rows = dedup.embedding_deduplicate(df, 0.9).orderBy("pos").collect()
    assert [(r.pos, r.kept, r.duplicate_of) for r in rows] == expected
    few, used = dedup.adaptive_deduplicate(df, 150, 0.9, 0.99999)
    assert used == 0.99999 and few.filter("kept").count() < 150


def test_hash_dedup_reasons(spark):
    zero = "0" * 64

    def flip(n, h=zero):
        return f"{int(h, 16) ^ ((1 << n) - 1):064x}"

    far = "f" * 64
    rows = [
        (0, "s0", zero, zero, zero, far),
        (1, "s1", flip(6), flip(10), far, far),  # like 0
        (2, "s1", flip(6), flip(10), far, far),  # copy of the dropped 1: like 0, not exact
        (3, "s0", far, far, far, zero),  # digest of 0
        (4, "s4", flip(9), flip(8), flip(10), far),  # like 0 by the combined rule
        (5, "s5", flip(9), flip(9), flip(10), far),  # too far: kept
        (6, "s6", far, zero, far, flip(2)),  # mirrored like 0
    ]
    df = spark.createDataFrame(rows, "pos long, sha256 string, phash string, dhash string, whash string, mirror_phash string")
    got = {r.pos: (r.kept, r.reason, r.duplicate_of) for r in dedup.hash_deduplicate(df).collect()}
    p = "perceptual_hash"
    assert got == {0: (True, None, None), 1: (False, p, 0), 2: (False, p, 0), 3: (False, "exact_sha256", 0), 4: (False, p + "_combined", 0), 5: (True, None, None), 6: (False, p, 0)}


def test_hash_dedup_of_many_copies(spark):
    zero, near, far = "0" * 64, f"{3:064x}", "f" * 64
    rows = [(0, "a", zero), (1, "b", near), (2, "c", far)] + [(i, "a" if i % 2 else "d", zero) for i in range(3, 400)] + [(i, "b", near) for i in range(400, 500)]
    df = spark.createDataFrame([(p, s, h, h, h, far if h == zero else zero) for p, s, h in rows], "pos long, sha256 string, phash string, dhash string, whash string, mirror_phash string")
    got = {r.pos: (r.kept, r.reason, r.duplicate_of) for r in dedup.hash_deduplicate(df).collect()}
    assert sorted(p for p in got if got[p][0]) == [0, 2]
    assert got[3] == (False, "exact_sha256", 0) and got[4] == (False, "perceptual_hash", 0) and got[450] == (False, "perceptual_hash", 0)


@pytest.mark.parametrize("threshold", [-0.5, 0.0, 0.7, 0.95])
def test_similar_pairs_are_all_pairs(spark, monkeypatch, threshold):
    monkeypatch.setattr(dedup, "BLOCK", 16)
    rng = np.random.default_rng(4)
    v = np.repeat(rng.normal(size=(12, 8)), 15, 0) + 0.2 * rng.normal(size=(180, 8))
    v[:40] = v[0]  # equal vectors
    v[50] = 0
    v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(999, None)], "pos long, v array<double>")
    blocks = dedup.Blocks(df)
    got = {(r.lo, r.hi) for r in blocks.pairs(threshold).collect()}
    sims = v @ v.T
    # cosines that are the threshold but for rounding may fall on either side
    sure, ever = ({(int(i), int(j)) for i, j in zip(*np.nonzero(sims >= threshold + e), strict=True) if i < j} for e in (1e-9, -1e-9))
    assert sure <= got <= ever and len(got) == blocks.pairs(threshold).count()
    assert threshold < 0.95 or blocks.meetings(threshold).count() < blocks.n * (blocks.n + 1) // 2
    best = sorted(((round(float(sims[i, j]), 9), i, j) for i, j in ever if i >= 40 or j >= 40), reverse=True)[:7]
    later = df.filter("pos >= 39 and v is not null")
    expected = [x for x in sorted(((round(float(sims[i, j]), 9), int(i), int(j)) for i in range(39, 180) for j in range(i + 1, 180)), reverse=True)][:7]
    assert [(round(r.similarity, 9), r.lo, r.hi) for r in selection.nearest_pairs(later, 7).collect()] == expected and best


def test_hot_bands_meet_tile_by_tile(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(120):
        d = int.from_bytes(rng.bytes(2), "big") & 0x1F1F
        rows.append((i, *[f"{(d << 4 * s):064x}" for s in (0, 3, 5, 9)]))
    df = spark.createDataFrame(rows, "pos long, dhash string, phash string, whash string, mirror_phash string")
    one, many = (sorted(dedup.perceptual_links(df, t).collect()) for t in (4096, 7))
    assert one == many and len({r[:2] for r in one}) == len(one) > 100


def test_farthest_first():
    unit = np.array([[1, 0], [1, 0], [0, 1], [0.8, 0.6]], float)
    chosen = selection.farthest_first(unit, np.array([0.9, 0.9, 0.1, 0.5]), 4)
    assert chosen[0] == 0 and sorted(chosen) == [0, 1, 2, 3]


def test_diverse_select_guards(spark):
    df = spark.createDataFrame([("a", i, 0.5, [1.0, float(i)]) for i in range(3)], "c string, pos long, quality double, embedding array<double>")
    assert selection.diverse_select(df, 3, "c").count() == 3
    with pytest.raises(Exception, match="a pool of 3 rows"):
        selection.diverse_select(df, 4, "c").collect()


@pytest.mark.parametrize("n", [5, 15, 100, 1, 2])
def test_splits_round_half_to_even(spark, n):
    df = spark.range(n).withColumn("c", F.lit("x"))
    counts = {r.split: r["count"] for r in splits.assign_splits(df, "c", 1, F.col("id").cast("string")).groupBy("split").count().collect()}
    train, val = round(n * 0.7), round(n * 0.15)
    assert [counts.get(s, 0) for s in ("train", "val", "test")] == [train, val, n - train - val]


def test_early_stop_equals_a_loop(spark):
    rng = random.Random(4)
    flags = [rng.random() < 0.6 for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(flags)), "pos long, ok boolean")
    for target, cap in ((50, None), (500, None), (1, None), (90, 100)):
        out, at = [], 0
        top = min(300, cap or 300)
        while at < top and len(out) < target:
            out += [i for i in range(at, min(at + 32, top)) if flags[i]]
            at += 32
        got = selection.early_stop(df, F.col("ok"), target, 32, cap)
        assert sorted(r.pos for r in got.collect()) == out


def test_low_yield_equals_a_loop(spark):
    rng = random.Random(5)
    for rate in (0.5, 0.02, 0.0):
        flags = [rng.random() < rate for _ in range(1200)]
        df = spark.createDataFrame(list(enumerate(flags)), "pos long, ok boolean")
        total = streak = 0
        out = []
        for b in range(12):
            if total >= 500 or streak >= 3:
                break
            n = sum(flags[b * 100 : b * 100 + 100])
            out.append((b, n))
            total += n
            streak = streak + 1 if n < 3 and b * 100 >= 200 else 0
        got = selection.low_yield_stop(df, F.col("ok")).orderBy("batch").collect()
        assert [(r.batch, r.n_valid) for r in got] == out


def test_pools(spark):
    rows = [(i, 0.001 * i - 0.05, 0.15 + 0.001 * i) for i in range(100)]
    df = spark.createDataFrame(rows, "pos long, clip_margin double, clip_positive double")
    fallback = filters.core_pool(df, 10)
    assert fallback.count() == 90 and fallback.first().threshold == pytest.approx(-0.04)
    assert filters.core_pool(df.withColumn("clip_positive", F.lit(0.5)), 1, [0.02, 0.0]).count() == 81
    with pytest.raises(ValueError, match="strict pool"):
        filters.strict_pool(df, 80)
    with pytest.raises(ValueError, match="2 remain, 3 are required"):
        filters.at_least(df.limit(2), 3)
    assert filters.open_pool(df, 5).count() == 100


def test_walk_survives_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c"), ("c", "d"), ("a", "c")], "src string, dst string")
    root = spark.createDataFrame([("a",)], "node string")
    got = {r.node: r.depth for r in lookups.walk(edges, root, 2).collect()}
    assert got == {"a": 0, "b": 1, "c": 1, "d": 2}
    assert {r.node for r in lookups.walk(edges, root, 1).collect()} == {"a", "b", "c"}


def test_credits(spark):
    credits = spark.createDataFrame([(0, "Img1.JPG", "first", ""), (1, "x\\img1.jpg", "second", ""), (2, "n/a", "third", "b.png")], "ord int, File string, Author string, Other string")
    files = spark.createDataFrame([("/d/img1.jpg",), ("/d/b.jpeg",), ("/d/none.jpg",)], "path string")
    got = {r.path: (r.fields or {}).get("Author") for r in lookups.credit_lookup(files, lookups.index_credits(credits), F.col("path")).collect()}
    assert got == {"/d/img1.jpg": "first", "/d/b.jpeg": "third", "/d/none.jpg": None}


def test_best_match(spark):
    rows = spark.createDataFrame([(0, "Other"), (1, "Daucus Carota"), (2, "x")], "ord int, name string")
    assert lookups.best_match(rows, "name", F.lit("daucus carota")).first().ord == 1
    assert lookups.best_match(rows, "name", F.lit("absent")).first().ord == 0


def test_validation(spark):
    good = spark.createDataFrame([("a", "train" if i < 7 else "test", f"s{i}", 200, 300) for i in range(10)], "class_name string, split string, sha256 string, width int, height int")
    found = reports.violations(good, "class_name", 10, {"train": 7, "test": 3}, identity=F.col("sha256"))
    assert reports.status(found).first().status == "ok"
    bad = good.union(good.limit(1))
    rules = {r.rule for r in reports.violations(bad, "class_name", 10, {"train": 7, "test": 3}, identity=F.col("sha256")).collect()}
    assert rules == {"class_count", "split_count", "digest_twice", "identity_twice"}
    classes = spark.createDataFrame([("a",), ("b",)], "class_name string")
    assert reports.missing_classes(good, "class_name", classes).first().subject == "b"


def test_minimums():
    from sievekit.plans.pipelines import with_minimums

    assert with_minimums({"workers": 4, "candidates": 5000}, {"workers": 20, "candidates": 2000, "sources": 400}) == {"workers": 20, "candidates": 5000, "sources": 400}


def test_diverse_select_in_rounds(spark):
    rng = np.random.default_rng(4)
    rows = [(g, i, float(rng.integers(0, 5)) / 4, rng.normal(size=6).tolist()) for g, n in (("a", 60), ("b", 7), ("c", 2)) for i in range(n)]
    df = spark.createDataFrame(rows, "c string, pos long, quality double, embedding array<double>")
    whole = selection.diverse_select(df, 5, "c", strict=False)
    rounds = selection.diverse_select(df, 5, "c", strict=False, room=8)
    assert sorted(whole.collect()) == sorted(rounds.collect()) and rounds.count() == 10


def test_numbered(spark):
    df = spark.createDataFrame([(i % 3 if i % 7 else None, (i * 37) % 101, i) for i in range(200)], "g int, x int, i int")
    got = numbered(df, "n", [F.desc("x"), F.col("i")]).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 201)) and [(-r.x, r.i) for r in got] == sorted((-r.x, r.i) for r in got)
    within = numbered(df, "n", [F.col("x"), F.col("i")], ["g"]).collect()
    for g in (None, 0, 1, 2):
        rows = sorted((r for r in within if r.g == g), key=lambda r: r.n)
        assert [r.n for r in rows] == list(range(1, len(rows) + 1)) and [(r.x, r.i) for r in rows] == sorted((r.x, r.i) for r in rows)
    assert numbered(df.limit(0), "n", [F.col("x")]).count() == 0
