"""Scoring and fitting."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from corpusloom.operators import learning as J
from corpusloom.operators.metrics import overall
from corpusloom.operators.ranking import best
from corpusloom.plans import jobs
from corpusloom.session import materialize


@pytest.fixture(scope="module")
def rows(spark):
    good, bad = "bright warm sun light", "cold dark rain storm"
    df = spark.range(240).select(
        F.col("id").alias("doc_id"),
        F.concat(
            F.when(F.col("id") % 3 == 0, good).otherwise(bad), F.lit(" filler "), (F.col("id") % 17).cast("string")
        ).alias("text"),
        F.when(F.col("id") % 3 == 0, "literal").otherwise("metaphor").alias("label"),
    )
    return df


@pytest.fixture(scope="module")
def prepared(rows):
    df = jobs.prepare_domain(rows, "reddit").withColumn("label_id", (F.col("label") == "figurative").cast("int"))
    return materialize(df)


OPTIONS = {"features": 256, "iterations": 10}


@pytest.mark.parametrize("kind", J.KINDS)
def test_every_kind_learns(prepared, kind):
    df = prepared
    options = {"features": 256} if kind == "bayes" else OPTIONS
    model = J.fit_weighted(df.where("split = 'train'"), kind=kind, **options)
    out = J.apply_model(model, df.where("split = 'test'"))
    assert overall(out, "label_id", "predicted_id").first().accuracy > 0.95
    assert set(out.columns) == {*df.columns, "logits", "probabilities", "predicted_id"}


def test_unknown_kind():
    with pytest.raises(ValueError):
        J.make_pipeline("other")


def test_select_keeps_first_best_and_is_patient(prepared):
    df = prepared
    grid = [{"reg": r, **OPTIONS} for r in (0.01, 0.02, 0.03, 0.04, 0.05)]
    chosen = J.select_model(df.where("split = 'train'"), df.where("split = 'val'"), grid, patience=2)
    assert chosen.index == 0 and len(chosen.scores) == 3


@pytest.mark.parametrize("kind", J.KINDS)
def test_adapt_every_kind(prepared, kind):
    options = {"features": 256} if kind == "bayes" else OPTIONS
    base = J.fit_weighted(prepared.where("split = 'train'"), kind=kind, **options)
    model = J.adapt(base, prepared.where("split = 'train'"), **OPTIONS)
    out = J.apply_model(model, prepared.where("split = 'test'"))
    assert overall(out, "label_id", "predicted_id").first().accuracy > 0.95


def test_train_domains_adapts_compares_and_saves(prepared, tmp_path):
    df = prepared.drop("label_id")
    base = J.fit_weighted(prepared.where("split = 'train'"), **OPTIONS)
    out = str(tmp_path / "out")
    models, scores = jobs.train_domains({"reddit": df, "news": df}, base=base, out=out, **OPTIONS)
    got = scores.orderBy("domain_rank").collect()
    assert [r.Domain for r in got] == ["reddit", "news"] and all(r.Macro_F1 > 0.9 for r in got)
    assert best(scores, "Macro_F1", "domain_rank").first().Domain == "reddit"  # equal scores: the first
    again = PipelineModel.load(f"{out}/models/news")
    test = prepared.where("split = 'test'")
    a, b = (sorted((r.doc_id, r.predicted_id) for r in J.apply_model(m, test).collect()) for m in (again, models["news"]))
    assert a == b
    assert sorted(r.Domain for r in df.sparkSession.read.csv(f"{out}/comparison", header=True).collect()) == ["news", "reddit"]


def test_score_runs_in_batches(spark):
    def make():
        import numpy as np

        def predict(texts):
            assert len(texts) <= 4
            return np.array([[len(t), 1.0] for t in texts.ravel()])

        return predict

    df = spark.createDataFrame([("a" * n,) for n in range(1, 11)], "text string").coalesce(1)
    got = J.score(df, make, batch_size=4).collect()
    assert all(r.logits == [float(len(r.text)), 1.0] for r in got)
