"""Published results, rebuilt from their counts, must come out of the metric operators."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import metrics as M
from corpusloom.operators import ranking as R
from corpusloom.operators.split import split_60_20_20
from corpusloom.plans import jobs
from corpusloom.sinks import writers

# correct/total by original label, per model and domain.
BREAKDOWN = {
    ("bert", "Reddit"): {"literal": (440, 443), "metaphor": (13, 260), "irony": (0, 42), "both": (0, 5)},
    ("bert", "News"): {"literal": (125, 151), "metaphor": (22, 51), "irony": (9, 29), "both": (6, 9)},
    ("roberta", "Reddit"): {"literal": (441, 443), "metaphor": (22, 260), "irony": (0, 42), "both": (1, 5)},
    ("roberta", "News"): {"literal": (105, 151), "metaphor": (30, 51), "irony": (14, 29), "both": (5, 9)},
    ("deberta", "Reddit"): {"literal": (443, 443), "metaphor": (7, 260), "irony": (0, 42), "both": (1, 5)},
    ("deberta", "News"): {"literal": (129, 151), "metaphor": (13, 51), "irony": (17, 29), "both": (5, 9)},
}
# Tn, fp, fn, tp, accuracy, macro F1, weighted F1.
METRICS = {
    ("bert", "Reddit"): (440, 3, 294, 13, 0.604000, 0.414079, 0.474569),
    ("bert", "News"): (125, 26, 52, 37, 0.675000, 0.624519, 0.660085),
    ("roberta", "Reddit"): (441, 2, 284, 23, 0.618667, 0.446846, 0.502749),
    ("roberta", "News"): (105, 46, 40, 49, 0.641667, 0.621034, 0.643877),
    ("deberta", "Reddit"): (443, 0, 299, 8, 0.601333, 0.399236, 0.462421),
    ("deberta", "News"): (129, 22, 54, 35, 0.683333, 0.625954, 0.663800),
}
# Accuracy difference (3 digits) and improvement in percent; News is better for all.
COMPARISON = {"bert": (0.071, 11.754967), "roberta": (0.023, 3.717672), "deberta": (0.082, 13.636364)}


@pytest.fixture(scope="module")
def result(spark):
    rows, key = [], 0
    for (model, domain), labels in BREAKDOWN.items():
        for label, (correct, total) in labels.items():
            for i in range(total):
                figurative = (label != "literal") == (i < correct)
                rows.append((key, model, domain, f"text {key}", label, [0.0, 2.0] if figurative else [1.0, -1.0]))
                key += 1
    df = spark.createDataFrame(
        rows, "doc_id long, model string, domain string, text string, label string, logits array<double>"
    )
    return jobs.evaluate_cross_domain(df)


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_confusion_matrices(result):
    cells = by_key(result.confusion, "model", "domain", "true_label")
    for (model, domain), (tn, fp, fn, tp, *_) in METRICS.items():
        literal, figurative = (cells[model, domain, x] for x in ("literal", "figurative"))
        assert (literal.pred_literal, literal.pred_figurative) == (tn, fp)
        assert (figurative.pred_literal, figurative.pred_figurative) == (fn, tp)


def test_overall_metrics(result):
    got = by_key(result.metrics, "model", "domain")
    for key, (*_, accuracy, macro, weighted) in METRICS.items():
        row = got[key]
        assert row.accuracy == pytest.approx(accuracy, abs=5e-7)
        assert row.f1_macro == pytest.approx(macro, abs=5e-7)
        assert row.f1_weighted == pytest.approx(weighted, abs=5e-7)


def test_per_class(result):
    row = by_key(result.classes, "model", "domain", "class")["bert", "Reddit", "figurative"]
    assert (row.precision, row.support) == (0.8125, 307)
    assert row.recall == pytest.approx(0.04234527687296417)
    assert row.f1 == pytest.approx(0.0804953560371517)


def test_breakdown_and_total(result):
    got = by_key(result.breakdown, "model", "domain", "label")
    for (model, domain), labels in BREAKDOWN.items():
        for label, (correct, total) in labels.items():
            row = got[model, domain, label]
            assert (row.correct, row.total) == (correct, total)
            assert row.maps_to == ("literal" if label == "literal" else "figurative")
        assert got[model, domain, "Total"].total == sum(t for _, t in labels.values())


def test_error_rates(result):
    got = by_key(result.errors, "model", "domain", "level", "label")
    assert got["bert", "Reddit", "all", None].errors == 297
    assert got["bert", "News", "original", "both"].errors == 3
    assert got["roberta", "News", "binary", "literal"].error_rate == pytest.approx(46 / 151 * 100)


def test_comparison(result):
    got = by_key(result.comparison, "model")
    for model, (diff, improvement) in COMPARISON.items():
        row = got[model,]
        assert row.better_domain == "News"
        assert row.accuracy_diff == pytest.approx(diff, abs=5e-4)
        assert row.improvement_pct == pytest.approx(improvement, abs=5e-7)


def test_grid_and_best(result):
    grid = by_key(result.grid, "model")
    assert grid["deberta",].news_acc == pytest.approx(0.683333, abs=5e-7)
    best = R.best(result.metrics.where("domain = 'News'"), "f1_macro", "model").first()
    assert best.model == "deberta"


def test_best_takes_first_maximum(spark):
    df = spark.createDataFrame([("a", 0.5, 1), ("b", 0.7, 2), ("c", 0.7, 3)], "m string, f double, rank int")
    assert R.best(df, "f", "rank").first().m == "b"


def test_tie_goes_to_second_domain(spark):
    df = spark.createDataFrame(
        [("m", "Reddit", 0.5, 0.5, 0.5), ("m", "News", 0.5, 0.4, 0.4)],
        "model string, domain string, accuracy double, f1_macro double, f1_weighted double",
    )
    row = M.compare_domains(df).first()
    assert (row.better_domain, row.improvement_pct) == ("News", 0.0)


def test_summary_json(spark, result, tmp_path):
    path = str(tmp_path / "summary")
    writers.write_summary(
        writers.summary_frame(result.metrics, result.classes, result.breakdown, result.comparison), path
    )
    rows = {d["model"]: d for d in (json.loads(r.value) for r in spark.read.text(path).collect())}
    bert = rows["bert"]
    assert bert["reddit"]["binary_metrics"]["f1_macro"] == pytest.approx(0.41407945371951044)
    assert bert["news"]["breakdown_by_original_label"]["irony"]["total"] == 29
    assert bert["comparison"]["better_domain"] == "News"
    assert bert["label_mapping"] == {
        "literal": "literal", "metaphor": "figurative", "irony": "figurative", "both": "figurative"
    }


def test_published_split_sizes(spark):
    df = spark.range(750).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 443, "literal").otherwise("figurative").alias("label")
    )
    got = by_key(split_60_20_20(df).groupBy("split", "label").count(), "split", "label")
    sizes = {k: r["count"] for k, r in got.items()}
    assert sizes == {
        ("train", "literal"): 266, ("train", "figurative"): 184,
        ("val", "literal"): 89, ("val", "figurative"): 61,
        ("test", "literal"): 88, ("test", "figurative"): 62,
    }


def test_comparison_file(spark, tmp_path):
    # Published macro F1 per domain.
    rows = [("reddit", 0.7188905547226387, "reddit_x"), ("imdb", 0.8127810223794474, "imdb_x"), ("news", 0.5151515151515151, "news_x")]
    df = spark.createDataFrame(rows, "Domain string, Macro_F1 double, Model string").withColumn("rank", F.monotonically_increasing_id())
    assert R.best(df, "Macro_F1", "rank").first().Domain == "imdb"
    writers.write_comparison(df, str(tmp_path / "c"))
    back = spark.read.csv(str(tmp_path / "c"), header=True, schema="Domain string, Macro_F1 double, Model string")
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)
