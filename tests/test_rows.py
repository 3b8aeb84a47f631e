"""Edge rows of filters, labels, joins and annotation."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import aggregates as E
from corpusloom.operators import annotation as A
from corpusloom.operators import filters as C
from corpusloom.operators import joins as J
from corpusloom.operators import metrics as M
from corpusloom.operators.ranking import assign_batches, cap_per_group, limit_per_source
from corpusloom.operators.sets import union_sources
from corpusloom.sources.documents import extract_article, parse_reviews, parse_titles, to_comment_rows, to_post_rows
from corpusloom.sources.files import require_columns


def values(df, column):
    return sorted((r[column] for r in df.collect()), key=lambda v: (v is not None, v))


def test_min_length_boundaries(spark):
    texts = ["x" * n for n in (10, 11, 49, 50, 499, 500)] + [None, " " * 30 + "y" * 49 + " " * 30]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    sizes = lambda d: sorted(len(r.text) for r in d.collect())
    assert sizes(C.min_length(df, "text", 11)) == [11, 49, 50, 109, 499, 500]
    assert sizes(C.min_length(df, "text", 50, strip_first=True)) == [50, 499, 500]
    assert sizes(C.min_length(df, "text", 50)) == [50, 109, 499, 500]
    assert sizes(C.min_length(df, "text", 500)) == [500]


def test_binary_label(spark):
    labels = ["literal", "metaphor", "irony", "both", None, "Literal", "other"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "i int, label string")
    got = {r.i: r.binary_label for r in C.to_binary(df).collect()}
    assert got == {i: "literal" if i == 0 else "figurative" for i in range(7)}
    assert values(C.to_binary(df, strict=True), "i") == [0, 1, 2, 3]


def test_encode_decode_drop(spark):
    df = spark.createDataFrame([("literal",), ("figurative",), ("other",), (None,)], "label string")
    ids = C.encode_label(df, "label")
    assert values(ids, "label_id") == [None, None, 0, 1]
    assert values(C.decode_label(C.drop_invalid(ids), "label_id", "back"), "back") == ["figurative", "literal"]
    assert tuple(C.invalid_count(ids).first()) == (2, 4)
    assert values(C.keep_labels(df, ["literal", "x"]), "label") == ["literal"]


def test_recent_boundaries(spark):
    stamps = ["2024-05-30 12:00:01", "2024-05-29 12:00:01", "2024-05-29 12:00:00", "2024-07-09 00:00:00", None]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select("s", F.col("s").cast("timestamp").alias("ts"))
    kept = values(C.recent(df, "ts", "2024-06-30 12:00:00"), "s")
    assert kept == ["2024-05-29 12:00:01", "2024-05-30 12:00:01", "2024-07-09 00:00:00"]
    text = spark.createDataFrame([("2024-06-01T23:00:00Z",), ("2024-05-29",), ("nonsense",), (None,)], "d string")
    assert values(C.recent(text, "d", "2024-06-30 12:00:00"), "d") == ["2024-06-01T23:00:00Z"]


def test_recent_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).select(F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ts")).write.parquet(path)
    plan = C.recent(spark.read.parquet(path), "ts", "2024-06-30")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan


def test_language(spark):
    df = spark.createDataFrame([("en",), ("EN",), ("",), (None,), ("fr",)], "l string")
    assert values(C.keep_language(df, "l"), "l") == [None, "", "EN", "en"]


def test_harmonise(spark):
    reviews = spark.createDataFrame([("T", None), (None, "B"), (None, None), (" x", "y\n")], "review_title string, review_body string")
    assert values(C.harmonise(reviews, "imdb"), "text") == ["", "B", "T", "x y"]
    news = spark.createDataFrame([(None, "t"), ("a", "t")], "text string, title string")
    assert values(C.harmonise(news, "news"), "text") == ["", "a"]
    assert values(C.harmonise(news.select("title"), "news"), "text") == ["t", "t"]
    with pytest.raises(ValueError):
        C.harmonise(news.select("title"), "reddit")


def test_pick_text_blank_search(spark):
    df = spark.createDataFrame([(None, "", "b"), ("t", "r", "b"), (" ", None, None)], "text string, review string, body string")
    assert values(C.pick_text(df), "text") == [" ", "b", "t"]
    assert values(C.drop_blank(C.pick_text(df)), "text") == ["b", "t"]
    assert values(C.search(df, "T"), "text") == ["t"]


def test_flags(spark):
    df = spark.createDataFrame([(m, i) for m in (0, 1) for i in (0, 1)], "label_metaphor int, label_irony int")
    got = {(r.label_metaphor, r.label_irony): r.label for r in C.flags_to_label(df).collect()}
    assert got == {(0, 0): "literal", (1, 0): "metaphor", (0, 1): "irony", (1, 1): "both"}


def test_words_to_sentences(spark):
    rows = [("all zero", 0), ("all zero", 0), ("one hit", 0), ("one hit", 1), (None, 1), ("other", None)]
    df = spark.createDataFrame(rows, "sentence string, label int")
    got = {r.text: (r.label, r.num_words, r.num_metaphors, r.metaphor_ratio) for r in E.words_to_sentences(df).collect()}
    assert got == {
        "all zero": ("literal", 2, 0, 0.0), "one hit": ("metaphor", 2, 1, 0.5),
        None: ("literal", 0, 0, 0.0), "other": ("literal", 1, 0, 0.0),
    }


def test_value_counts_and_checks(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "x string")
    assert [tuple(r) for r in E.value_counts(df, "x").collect()] == [("b", 2), ("a", 1)]
    assert tuple(E.dedupe_report(df, ["x"]).first()) == (4, 3)
    with pytest.raises(ValueError):
        E.require_classes(df.where("x = 'a'"), "x")
    assert E.require_classes(df, "x") is df
    with pytest.raises(ValueError, match="y"):
        require_columns(df, ["x", "y"])


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "label string")
    got = {r.label: (r.n, r.share, r.weight, r.weight_ratio) for r in E.class_weights(df).collect()}
    assert got == {"a": (3, 75.0, 4 / 6, 1.0), "b": (1, 25.0, 2.0, 3.0)}
    assert sorted(r.weight for r in E.attach_weights(df).collect()) == [4 / 6] * 3 + [2.0]


def test_metrics_with_absent_classes(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a"), ("c", "a")], "t string, p string")
    got = {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in M.per_class(df, "t", "p").collect()}
    assert got == {"a": (0.5, 0.5, 0.5, 2), "b": (0.0, 0.0, 0.0, 0), "c": (0.0, 0.0, 0.0, 1)}
    row = M.overall(df, "t", "p").first()
    assert row.f1_macro == pytest.approx(0.5 / 3) and row.f1_weighted == pytest.approx(1 / 3)
    fixed = {r["class"] for r in M.per_class(df, "t", "p", labels=["a", "z"]).collect()}
    assert fixed == {"a", "z"}
    cm = {r.true_label: (r.pred_a, r.pred_z, r.label_rank) for r in M.confusion(df, "t", "p", ["a", "z"]).collect()}
    assert cm == {"a": (1, 0, 0), "z": (0, 0, 1)}
    single = M.overall(df.where("t = 'a' and p = 'a'"), "t", "p").first()
    assert (single.accuracy, single.f1_macro) == (1.0, 1.0)
    rows = {r.row: (r.precision, r.support) for r in M.report(df, "t", "p").collect()}
    assert rows["accuracy"] == (pytest.approx(1 / 3), pytest.approx(1 / 3)) and rows["macro avg"][1] == 3.0
    assert M.binary_metrics(df, "t", "p", "zz").first().f1 == 0.0


def test_breakdown_counts_unknown_labels_in_total_only(spark):
    df = spark.createDataFrame([("literal", True), ("odd", False), (None, False)], "original_label string, correct boolean")
    got = {r.label: (r.total, r.correct, r.label_rank) for r in M.breakdown(df).collect()}
    assert got == {"literal": (1, 1, 0), "Total": (3, 1, 4)}


def test_lookup_and_pending(spark):
    df = spark.createDataFrame([(1, "a"), (2, "z")], "row_id long, k string")
    dim = spark.createDataFrame([("a", 7)], "k string, v int")
    assert values(J.lookup(df, dim, "k"), "v") == [None, 7]
    assert "hint" not in J.lookup(df, dim, "k")._jdf.queryExecution().logical().toString().lower()
    assert values(J.pending(df, df.where("row_id = 1")), "row_id") == [2]


def test_split_leakage(spark):
    rows = [(1, "a", "train"), (2, "a", "test"), (3, "b", "val"), (4, "b", "val"), (5, None, "val"), (6, None, "test")]
    df = spark.createDataFrame(rows, "doc_id long, text string, split string")
    assert values(J.split_leakage(df), "doc_id") == [1, 2]


def test_resumed_annotation_keeps_answers_with_their_texts(spark):
    from corpusloom.plans import jobs

    df = spark.createDataFrame([(i, "  " if i % 9 == 4 else f"text {i}", "en") for i in range(100)], "row_id long, content string, sentiment string")
    requests = A.annotation_requests(df)
    batches = {}
    for r in requests.collect():
        batches.setdefault((r.batch_id, r.request_id), []).append((r.pos, r.row_id))
    answer = lambda rows: json.dumps([{"is_metaphor": True, "reasoning": f"r{i}"} for _, i in sorted(rows)])
    landed = [(b, q, answer(rows)) for (b, q), rows in batches.items()]
    frame = lambda part: spark.createDataFrame(part, "batch_id long, request_id string, response string")
    first = jobs.annotation_round_trip(df, frame(landed[:3])).collect()
    done = spark.createDataFrame([(r.row_id,) for r in first], "row_id long")
    with_table = jobs.annotation_round_trip(df, frame(landed[3:]), done, requests=requests).collect()
    everything = first + with_table
    assert len(everything) == requests.count() and all(r.reasoning == f"r{r.row_id}" for r in everything)
    # batches cut anew match nothing rather than other texts
    recomputed = jobs.annotation_round_trip(df, frame(landed[3:]), done).collect()
    assert all(r.reasoning == f"r{r.row_id}" for r in recomputed)
    with pytest.raises(ValueError):
        jobs.annotation_round_trip(df, frame(landed).drop("request_id"), done)


def test_null_labels_have_no_class_weight(spark):
    from corpusloom.operators.aggregates import attach_weights

    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "label string")
    got = [(r.label, r.weight) for r in attach_weights(df).collect()]
    assert sorted(got, key=str) == sorted([("a", 0.75), ("a", 0.75), ("b", 1.5), (None, None)], key=str)


def test_very_many_classes_split(spark):
    from corpusloom.operators.split import stratified_split

    df = spark.range(24_000).selectExpr("id AS doc_id", "concat('c', id % 12000) AS label")
    sizes = {r.split: r["count"] for r in stratified_split(df, frac=0.5).groupBy("split").count().collect()}
    assert sizes == {"train": 12_000, "val": 12_000}


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, pos string"), spark.createDataFrame([(2,)], "i int")
    assert values(union_sources([a, b]), "pos") == [None, "x"]


def test_batches_are_full_and_stable(spark):
    df = spark.range(1003).withColumnRenamed("id", "row_id")
    got = assign_batches(df)
    sizes = sorted(r["count"] for r in got.groupBy("batch_id").count().collect())
    assert sizes == [3] + [10] * 100
    again = assign_batches(df.repartition(7))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))


def test_cap_with_one_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    got = cap_per_group(df, "k", "id", 4, rank="r").where("k = 'hot'").collect()
    assert sorted((r.id, r.r) for r in got) == [(0, 1), (3, 2), (6, 3), (9, 4)]
    posts = df.select(F.lit("s").alias("source"), F.when(F.col("id") % 2 == 0, "post").otherwise("comment").alias("type"), "id")
    assert sorted(r.id for r in limit_per_source(posts, 5, "id").collect()) == [0, 1, 2, 3]


def test_answers(spark):
    good = {"is_metaphor": True, "is_irony": False, "is_literal": False, "reasoning": "r"}
    raw = [
        json.dumps([good, {"is_irony": True}]), json.dumps(good), "[{", json.dumps([{**good, "is_metaphor": "yes"}]),
        "[]", None, json.dumps([good, None]), "5",
    ]
    df = spark.createDataFrame(list(enumerate(raw)), "batch_id long, response string")
    got = {r.batch_id: r.answers and [tuple(a) for a in r.answers] for r in A.parse_answers(df).collect()}
    assert got[0] == [(1, 0, "r"), (0, 1, "")] and got[1] == [(1, 0, "r")] and got[2] is None
    assert got[3] == [(0, 0, "r")] and not got[4] and got[5] is None and got[6] is None and got[7] is None


def test_round_trip_drops_whole_batches(spark):
    rows = [(i, None if i == 3 else "  " if i == 4 else f"text {i}", i % 2) for i in range(25)]
    df = spark.createDataFrame(rows, "row_id long, body string, rating int")
    requests = A.annotation_requests(df)
    assert requests.count() == 23
    per_batch = {r.batch_id: (r.n, r.top) for r in requests.groupBy("batch_id").agg(F.count("*").alias("n"), F.max("pos").alias("top")).collect()}
    assert all(top == n - 1 for n, top in per_batch.values()) and set(per_batch) == {0, 1, 2}
    prompt = A.build_prompts(requests).where("batch_id = 2").first()
    assert prompt.n_texts == per_batch[2][0] and "\n--- TEXT 1 ---\ntext " in prompt.prompt
    answers = [
        (0, json.dumps([{"is_metaphor": True}] * per_batch[0][0])),
        (1, json.dumps([{"is_metaphor": True}] * (per_batch[1][0] - 1))),
        (2, "not json"),
    ]
    landed = spark.createDataFrame(answers, "batch_id long, response string")
    got = A.annotation_results(requests, landed, "news").collect()
    assert len(got) == per_batch[0][0] and {(r.label_metaphor, r.label_irony, r.source) for r in got} == {(1, 0, "news")}


def test_long_texts_are_cut_in_requests(spark):
    df = spark.createDataFrame([(1, "x" * 2000), (2, "x" * 2001)], "row_id long, text string")
    assert sorted(len(r.text) for r in A.annotation_requests(df).collect()) == [2000, 2003]


def test_parse_reviews_edges(spark):
    node = lambda title, body, up: {"node": {"authorRating": 5, "summary": {"originalText": title}, "text": {"originalText": {"plainText": body}}, "helpfulness": {"upVotes": up}}}
    edges = [node("t", None, 3), node(None, "b", None), node(None, None, 1), node("", "", 1), {"node": {"summary": {"originalText": "only"}}}]
    doc = lambda e: json.dumps({"data": {"title": {"reviews": {"edges": e}}}})
    rows = [("m1", "M", doc(edges)), ("m2", "M", doc([])), ("m3", "M", "{}"), ("m4", "M", "broken")]
    df = spark.createDataFrame(rows, "movie_id string, movie_title string, json string")
    got = sorted((r.pos, r.review_title, r.review_body, r.upvotes, r.rating) for r in parse_reviews(df).collect())
    assert got == [(0, "t", None, 3, 5), (1, None, "b", 0, 5), (4, "only", None, 0, None)]


def test_parse_titles(spark):
    doc = {"data": {"topTrendingTitles": {"edges": [{"node": {"item": {"id": "tt1", "titleText": None, "releaseYear": {"year": 2001}}, "rank": 1}}, {"node": {}}]}}}
    df = spark.createDataFrame([(json.dumps(doc),)], "json string")
    assert sorted(map(tuple, parse_titles(df).collect()), key=str) == [("tt1", None, 2001, 1), (None, None, None, None)]


def test_forum_rows(spark):
    schema = "forum string, title string, body string, score int, created_utc long, permalink string"
    df = spark.createDataFrame([("f", "T", "B", 1, 0, "/p"), ("f", "T", "", 1, 0, "/p"), ("f", "T", None, 1, 0, "/p")], schema)
    assert values(to_post_rows(df), "text") == ["T", "T", "T B"]
    row = to_comment_rows(df.where("body = 'B'")).first()
    assert (row.text, row.source, row.type, row.url) == ("B", "reddit_f", "comment", "https://reddit.com/p")


def test_character_references(spark):
    from corpusloom.sources.documents import unescape

    cases = {
        "don&#8217;t &mdash; it&#x27;s &hellip; caf&eacute;": "don\u2019t \u2014 it's \u2026 caf\u00e9", "a &amp;lt; b": "a &lt; b",
        "AT&T & &unknown; &#0; &;": "AT&T & &unknown; &#0; &;", "&#128512;&nbsp;&&lt;": "\U0001f600 &<", "": "", "plain": "plain",
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "t string").select("t", unescape("t").alias("u"))
    assert {r.t: r.u for r in df.collect()} == cases | {None: None}


def test_articles_and_attribute_order(spark):
    page = (
        "<html><head><meta content='2024-03-01' property='article:published_time'></head><body><article>One</article>"
        "<p>between</p><article class='x'>two</article></body></html>"
    )
    (row,) = extract_article(spark.createDataFrame([(page,)], "html string")).collect()
    assert (row.text, row.publish_date) == ("One two", "2024-03-01")


def test_extract_article(spark):
    page = (
        "<html lang='EN'><head><title> A &amp; B </title><meta name='date' content='2024-01-02'><style>x{}</style></head>"
        "<body><script>no()</script><!-- no --><article><p>One<br>two &lt;3</p></article><footer>no</footer></body></html>"
    )
    got = {r.i: (r.title, r.meta_lang, r.text, r.publish_date) for r in extract_article(
        spark.createDataFrame([(1, page), (2, "<p>bare</p>"), (3, None), (4, "")], "i int, html string")).collect()}
    assert got[1] == ("A & B", "EN", "One two <3", "2024-01-02")
    assert got[2] == (None, None, "bare", None) and got[3] == (None,) * 4 and got[4] == (None,) * 4
