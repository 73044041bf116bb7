import random
import re
from collections import Counter

import pytest

from sievekit.llm import quality

from .helpers import awkward, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    windows = Counter(tuple(words[i : i + 3]) for i in range(n - 2))
    covered = {j for i in range(n - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


def measured(rows):
    return [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows]


def test_matches_brute_force(spark):
    rng = random.Random(1)
    parts = ["a", "bb", "é", "#", "$$", "|", "日本", "\x85", " ", "\n", " \n", "\t", "x", "\x0b", "\xa0"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(200))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = quality.cascade(df).orderBy("doc_id").collect()
    assert measured(rows) == [brute(t) for t in texts]


def test_edges(spark):
    df = awkward(spark)
    rows = quality.cascade(df).collect()
    assert sorted(measured(rows)) == sorted(brute(r.text) for r in df.collect())
    assert all(not (r.kept and r.base_failed) and r.kept == (r.failed_rule is None) for r in rows)
    assert quality.cascade(empty(spark)).count() == 0


def test_order_does_not_change_verdicts(spark):
    prose = " ".join(f"word{i}" for i in range(300))
    texts = [prose, prose.replace("word", "### "), "a b c " * 100, "line one is here\n" * 30, " ".join(str(i) for i in range(300)), "x" * 90 + " " + prose, " ".join("x" * 60 + str(i) for i in range(60))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = [r.name for r in quality.RULES]
    kept = []
    for order in (names, names[::-1]):
        rows = quality.cascade(df, order=order).orderBy("doc_id").collect()
        kept.append([r.kept for r in rows])
        short = quality.cascade(df, order=order, measure=False).orderBy("doc_id").collect()
        assert [(r.kept, r.failed_rule) for r in rows] == [(r.kept, r.failed_rule) for r in short]
        for r, t in zip(rows, texts, strict=True):
            failing = {x.name for x in quality.RULES if x.rejects(quality.Text(t))}
            assert r.failed_rule == next((n for n in order if n in failing), None)
    assert kept[0] == kept[1] == [True, False, False, False, False, True, False]


def test_plan_orders_by_rejection_per_cost():
    cheap = quality.Rule("cheap", lambda t: len(t.text) % 2 == 0)
    useless = quality.Rule("useless", lambda t: False)
    costly = quality.Rule("costly", lambda t: sum(map(ord, t.text * 500)) >= 0 and len(t.text) % 2 == 0)
    texts = ["ab" * i + "c" * (i % 2) for i in range(200)]
    rules = (useless, costly, cheap)
    found = quality.timed(texts, rules)
    assert [n for n, _ in found] == [0, 100, 100]
    assert quality.ranked([(r.name, n, s, len(texts)) for r, (n, s) in zip(rules, found, strict=True)]) == ["cheap", "costly", "useless"]


def test_sample_covers_all_partitions(spark):
    # the rule rejects texts of one partition only, in the middle of the table
    rule = quality.Rule("late", lambda t: t.text.startswith("late"))
    never = quality.Rule("early", lambda t: False)
    df = spark.range(0, 20_000, 1, 16).selectExpr("id as doc_id", "concat(if(id between 10000 and 11000, 'late ', 'other '), id) as text")
    assert quality.sampled_order(df, (never, rule), sample_rows=500) == ["late", "early"]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_few_words(n):
    assert quality.Text("w " * n).n_repeat_words == brute("w " * n)[4]
