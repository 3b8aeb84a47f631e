"""Vocabularies and stored sketches: ties, limits, empty and null texts, merged equals at once."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import sketches as Z
from corpusloom.operators import vocabulary as V


def test_ids_by_count_then_token(spark):
    df = spark.createDataFrame([(1, "b b a a c"), (2, None), (3, ""), (4, "d é c  zz")], "doc_id long, text string")
    vocabulary = V.build_vocabulary(df, size=4)
    assert [(r.token, r.n, r.id) for r in vocabulary.orderBy("id").collect()] == [("a", 2, 2), ("b", 2, 3), ("c", 2, 4), ("d", 1, 5)]
    assert V.build_vocabulary(df, size=9, least=2).count() == 3
    got = {r.doc_id: (r.input_ids, r.attention_mask) for r in V.encode_vocabulary(df, vocabulary, length=4).collect()}
    assert got == {
        1: ([3, 3, 2, 2], [1, 1, 1, 1]), 2: ([0] * 4, [0] * 4), 3: ([0] * 4, [0] * 4), 4: ([5, 1, 4, 1], [1, 1, 1, 1]),
    }
    assert V.encode_vocabulary(df.where("false"), vocabulary).count() == 0
    for size in (0, V.MOST + 1):
        with pytest.raises(ValueError):
            V.build_vocabulary(df, size=size)


def test_merged_profiles(spark):
    df = spark.range(3000).select((F.col("id") % 7).alias("file"), F.repeat(F.lit("w "), (F.col("id") % 500).cast("int")).alias("text"))
    stored = Z.length_sketches(df, ["file"])
    (row,) = Z.merge_length_sketches(stored).collect()
    assert (row.total_samples, row.tokens_min, row.tokens_max, row.chars_max) == (3000, 0, 499, 998)
    assert row.tokens_mean == 249.5 and abs(row.tokens_q50 - 250) <= 500 * Z.KLL_ERROR + 1
    again = Z.merge_length_sketches(stored.where("file < 3").union(stored.where("file >= 3"))).first()
    assert (again.total_samples, again.words_mean) == (row.total_samples, row.words_mean)


def test_overlap(spark):
    keys = lambda a, b: Z.key_sketch(spark.range(a, b).select(F.col("id").cast("string").alias("text")))
    one = keys(0, 20_000).select(F.col("keys").alias("l"), F.lit(1).alias("k")).join(
        keys(15_000, 40_000).select(F.col("keys").alias("r"), F.lit(1).alias("k")), "k"
    )
    row = one.select(*Z.overlap(F.col("l"), F.col("r"))).first()
    for got, want in ((row.left_keys, 20_000), (row.right_keys, 25_000), (row.all_keys, 40_000), (row.shared_keys, 5000)):
        assert abs(got - want) <= Z.THETA_ERROR * 40_000
    nulls = spark.createDataFrame([(None,), (None,), ("",)], "text string")
    assert Z.key_sketch(nulls).select(F.theta_sketch_estimate("keys"), "rows").first() == (2, 3)
