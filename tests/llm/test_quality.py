"""Quality rules: counts against plain Python, the binomial tail against exact fractions, and the promise itself."""

import random
import re
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import quality
from tests.llm.rows import documents, frame


def counts(text):
    text = text or ""
    words = [w for w in re.split("[ \x09-\x0d]+", text) if w]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^ \x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w in windows if windows.count(w) > 1}
    repeat = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    n = len(words)
    failed = n < 50 or 100 * len(repeat) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeat), failed


def test_counts(spark):
    rows = documents(4) + [
        (500, "a b c a b c a b"), (501, "x\nx\n x\n\n\ny\x0bz\x0b\nx"), (502, "# * $ % & | < > 中文 ＃"), (503, "one two one two one"),
        (504, " \n \t"), (505, "p q r " * 40 + "s"),
    ]
    got = quality.judge(frame(spark, rows), spark.createDataFrame([], "doc_id long, quality int")).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    found = sorted((-1 if r.doc_id is None else r.doc_id, *(r[n] for n in names)) for r in got)
    assert found == sorted((-1 if i is None else i, *counts(t)) for i, t in rows)
    assert all(r.kept == (not r.base_failed) and r.failed == [] for r in got)


@pytest.mark.parametrize("k,n,rate", [(0, 1, 0.5), (0, 500, 0.01), (3, 1000, 0.01), (9, 1000, 0.01), (40, 5000, 0.02), (10, 1000, 0.01)])
def test_binomial_tail(spark, k, n, rate):
    row = spark.range(1).select(quality.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), rate).alias("p")).first()
    p = Fraction(rate)
    exact = float(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))
    assert row.p == (1.0 if k >= n * rate else pytest.approx(exact, rel=1e-9))


def labelled_texts(rng, n, junk, group):
    """Prose with labels: good texts hold few symbols, bad ones many (and a share ``junk`` of bad ones)."""
    rows = []
    for _ in range(n):
        words = ["w%d" % rng.randrange(5000) for _ in range(rng.randrange(60, 120))]
        bad = rng.random() < junk
        for _ in range(rng.randrange(20, 60) if bad else rng.randrange(3)):
            words[rng.randrange(len(words))] += "###"
        rows.append((" ".join(words), group, 0 if bad else 1))
    return rows


def test_rules_are_chosen_and_hold(spark):
    rng = random.Random(6)
    rows = labelled_texts(rng, 1500, 0.2, "en") + labelled_texts(rng, 1500, 0.1, "fr") + labelled_texts(rng, 60, 0.2, "de")
    rows += [(t, None, q) for t, _, q in labelled_texts(rng, 40, 0.3, "x")]
    docs = spark.createDataFrame([(i, t, g, "s", 1) for i, (t, g, _) in enumerate(rows)], "doc_id long, text string, lang string, stratum string, k int")
    marks = [(i, q) for i, (_, _, q) in enumerate(rows)] + [(0, None), (None, 0), (7, 5)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    for group in ("en", "fr"):
        own = [(got[i], q) for i, (_, g, q) in enumerate(rows) if g == group and not got[i].base_failed]
        good, bad = [r.kept for r, q in own if q], [r.kept for r, q in own if not q]
        assert sum(good) >= 0.99 * len(good) and sum(bad) == 0
    # some hundred good labels are needed before anything can be promised
    assert all(got[i].kept or got[i].base_failed for i, (_, g, _) in enumerate(rows) if g in ("de", None))
    assert {f for r in got.values() for f in r.failed} >= {"symbols"}


def test_setting_stops_at_the_first_failure(spark):
    """Every certified setting, and all before it, pass the exact test; the next one does not."""
    rng = random.Random(9)
    rows = labelled_texts(rng, 2500, 0.2, "en")
    docs = spark.createDataFrame([(i, t, g) for i, (t, g, _) in enumerate(rows)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, q) for i, (_, _, q) in enumerate(rows)], "doc_id long, quality int")
    texts = quality.labelled(quality.measure(docs, "doc_id", "text", "lang"), labels, "doc_id", "quality")
    levels = quality.ladder(texts.where("design")).first().levels
    holdout = [r.scores for r in texts.where("good AND NOT design").collect()]
    chosen = quality.certify(texts).first()
    p, n = Fraction(quality.ALPHA), len(holdout)
    assert chosen.n == n

    def passes(cutoffs):
        k = sum(any(s > c for s, c in zip(scores, cutoffs, strict=True)) for scores in holdout)
        return k < n * quality.ALPHA and sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) <= quality.DELTA

    ok = [passes(c) for c in levels]
    assert chosen.level == (ok.index(False) if False in ok else len(ok)) - 1


def test_copies_are_no_evidence(spark):
    rng = random.Random(2)
    rows = labelled_texts(rng, 100, 0.2, "en") * 40
    docs = spark.createDataFrame([(i, t, g) for i, (t, g, _) in enumerate(rows)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, q) for i, (_, _, q) in enumerate(rows)], "doc_id long, quality int")
    assert all(r.failed == [] for r in quality.judge(docs, labels).collect())


def test_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert quality.judge(frame(spark, documents()).where("false"), labels).count() == 0
