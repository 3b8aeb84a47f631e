"""Keep-first deduplication and exact splits: brute force, ties, errors, repartitioned input."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import dedupe as D
from corpusloom.operators.split import assign_splits, split_60_20_20, stratified_split
from corpusloom.plans import jobs


def test_dedupe_first_keeps_smallest_order_and_one_null(spark):
    rows = [(3, "a", "x"), (1, "a", "y"), (2, None, "z"), (5, None, "w"), (4, "b", None)]
    df = spark.createDataFrame(rows, "id int, text string, v string")
    got = D.dedupe_first(df, "text", "id")
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == [(1, "a", "y"), (2, None, "z"), (4, "b", None)]


def test_dedupe_collapses_copies_before_the_shuffle(spark):
    df = spark.range(10_000, numPartitions=4).select("id", F.lit("same").alias("text"))
    plan = D.dedupe_first(df, "text", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min_by") > plan.index("Exchange") > plan.index("min_by(")
    assert D.dedupe_first(df, "text", "id").first().id == 0


def seen_set_pass(rows):
    """Plain reading of the rule: one loop over a source's rows in order."""
    urls, titles, kept = set(), set(), []
    for key, source, url, title in sorted(rows):
        u = None if url is None else url.split("?")[0].split("#")[0] or None
        t = (title or "").strip().lower()
        if u and (source, u) in urls:
            continue
        if u:
            urls.add((source, u))
        if t and (source, t) in titles:
            continue
        if t:
            titles.add((source, t))
        kept.append(key)
    return kept


def test_url_title_edges(spark):
    rows = [
        (1, "s", "http://a/1", "One"),
        (2, "s", "http://a/1?x=1", "Two"),  # URL repeat: its title is not registered
        (3, "s", "http://a/2", " two "),  # so this one stays
        (4, "s", "http://a/3", "ONE"),  # title repeat: its URL is registered
        (5, "s", "http://a/3#f", "Three"),  # so this one goes
        (6, "s", None, "One more"),
        (7, "s", None, ""),
        (8, "s", None, None),
        (9, "t", "http://a/1", "One"),  # another source
    ]
    df = spark.createDataFrame(rows, "id int, source string, url string, title string")
    got = sorted(r.id for r in D.dedupe_url_title(df, "id").collect())
    assert got == [1, 3, 6, 7, 8, 9] == seen_set_pass(rows)


@pytest.mark.parametrize("seed", range(3))
def test_url_title_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [
        (
            i, rng.choice("st"),
            rng.choice([None, "", f"http://h/{rng.randrange(40)}{rng.choice(['', '?q', '#f'])}"]),
            rng.choice([None, "", " ", f"{rng.choice(['', ' '])}Title {rng.randrange(40)}"]),
        )
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "id int, source string, url string, title string").repartition(5)
    assert sorted(r.id for r in D.dedupe_url_title(df, "id").collect()) == seen_set_pass(rows)


def brute_split(rows, fractions, names, seed):
    """Rank whole classes in Python; the operator never does."""
    classes = {}
    for key, label in rows:
        classes.setdefault(label, []).append(key)
    order = {
        label: sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))
        for label, keys in classes.items()
    }
    left = {label: len(keys) for label, keys in classes.items()}
    start, out = dict.fromkeys(left, 0), {}
    for fraction, name in zip(fractions, names):
        total = sum(left.values())
        kept = total - math.ceil(fraction * total)
        base = {c: n * kept // total for c, n in left.items()}
        missing = kept - sum(base.values())
        later = sorted(left, reverse=True)  # later class name first among equal remainders
        for c in sorted(later, key=lambda c: -(left[c] * kept % total))[:missing]:
            base[c] += 1
        for c, n in base.items():
            out.update({k: name for k in order[c][start[c] : start[c] + n]})
            start[c] += n
            left[c] -= n
    for c, keys in order.items():
        out.update({k: names[-1] for k in keys[start[c] :]})
    return out


@pytest.mark.parametrize("sizes", [(443, 307), (49, 299, 9, 42), (5, 5), (101, 99, 7), (2000, 11)])
def test_split_brute_force(spark, sizes):
    rows = [(i * 10 + c, f"c{c}") for c, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, label string")
    for fractions, names in (([0.1], ("train", "val")), ([0.4, 0.5], ("train", "val", "test"))):
        got = {r.doc_id: r.split for r in assign_splits(df.repartition(7), "label", "doc_id", fractions, names, 3).collect()}
        assert got == brute_split(rows, fractions, names, 3)


def test_split_is_the_same_after_repartitioning(spark):
    df = spark.range(999).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("string").alias("label"))
    a, b = (sorted(map(tuple, split_60_20_20(d).collect())) for d in (df, df.repartition(13)))
    assert a == b and len(a) == 999


def test_split_refuses_bad_classes(spark):
    small = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "b")], "doc_id long, label string")
    with pytest.raises(Exception, match="fewer than two rows"):
        stratified_split(small).collect()
    null = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "doc_id long, label string")
    with pytest.raises(Exception, match="label is null"):
        stratified_split(null).collect()
    alone = spark.createDataFrame([(i, "t" * 20, "literal") for i in range(10)], "doc_id long, text string, label string")
    with pytest.raises(Exception, match="too few classes"):
        jobs.prepare_domain(alone, "reddit").collect()


def test_rows_are_not_shuffled_by_a_split(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 2).cast("string").alias("label"), F.lit("long text").alias("text")
    ).write.parquet(path)
    plan = split_60_20_20(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert sum("text" in line.split("Batched")[0] for line in scans) == 1  # only the final pass reads the text
    before_text = plan[: plan.index(next(line for line in scans if "text" in line.split("Batched")[0]))]
    assert "Exchange hashpartitioning" not in before_text


def test_sentence_corpus_prefers_folder_order(spark):
    schema = "sentence string, label int, source string, source_rank int, pos_folder string, pos_rank int, split string"
    rows = [
        ("shared", 0, "VUA18", 1, None, -1, "train"),
        ("shared", 1, "VUA18_pos", 7, "adj", 0, "train"),
        ("shared", 1, "VUA18_pos", 7, "adj", 0, "test"),
        ("pos only", 1, "VUA18_pos", 7, "noun", 2, "train"),
        ("pos only", 0, "VUA18_pos", 7, "adj", 0, "train"),
    ]
    got = jobs.sentence_corpus(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.split, r.text, r.source, r.pos_folder, r.label) for r in got) == [
        ("test", "shared", "VUA18_pos", "adj", "metaphor"),
        ("train", "pos only", "VUA18_pos", "adj", "literal"),
        ("train", "shared", "VUA18", None, "literal"),
    ]
