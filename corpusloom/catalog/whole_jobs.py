"""Queries for model scoring and fitting, whole jobs and streaming intake."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import inputs as I
from corpusloom.catalog.groups import COMPARED
from corpusloom.catalog.registry import query
from corpusloom.catalog.rows import BIN, CHUNKS, SMART
from corpusloom.catalog.scans import LENGTH_STATS, SPLIT_60_20_20, rounded, split_rows
from corpusloom.functions.scores import argmax_label, softmax
from corpusloom.functions.tokens import tokenizer_udf
from corpusloom.operators import learning as J
from corpusloom.operators import training as X
from corpusloom.operators.aggregates import split_report, value_counts
from corpusloom.operators.filters import encode_label
from corpusloom.operators.metrics import overall
from corpusloom.operators.ranking import best
from corpusloom.operators.sets import union_sources
from corpusloom.plans import jobs
from corpusloom.schemas import BINARY_LABELS
from corpusloom.sources.documents import page_title
from corpusloom.session import materialize, scratch_path
from corpusloom.sinks import writers
from corpusloom.streaming import arrivals, intake

# --- scoring and learning -----------------------------------------------------------------------------


def length_model():
    """A stand-in model: logits from the text's length."""
    import numpy as np

    def predict(texts):
        n = np.array([len(t) for t in texts.ravel()])
        return np.stack([n % 7, n % 5], axis=1).astype("float64")

    return predict


@query(
    "J1_score",
    """SELECT doc_id, CASE WHEN length(text) % 5 > length(text) % 7 THEN 'figurative' ELSE 'literal' END AS predicted,
  round(exp((length(text) % 5)::DOUBLE) / (exp((length(text) % 5)::DOUBLE) + exp((length(text) % 7)::DOUBLE)), 6) AS prob_figurative FROM documents""",
)
def _(spark, sf):
    scored = J.score(I.documents(spark, sf), length_model)
    return rounded(
        scored.select(
            "doc_id",
            argmax_label("logits", BINARY_LABELS).alias("predicted"),
            F.get(softmax("logits"), F.lit(1)).alias("prob_figurative"),
        )
    )


def _prepared(spark, sf):
    """Annotations with binary label, its id and the split, written once for the fits that read it repeatedly."""
    return materialize(encode_label(split_rows(spark, sf), "binary_label"), "prepared")


def _part(df, name):
    return df.where(F.col("split") == name)


def _verdict(df):
    """One row per scored document: that its probabilities are a distribution and agree with the prediction."""
    p = F.col("probabilities")
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    likeliest = F.array_position(p, F.array_max(p)) - 1
    return df.select("doc_id", ((F.abs(total - 1) < 1e-9) & (likeliest == F.col("predicted_id"))).alias("valid"))


_TEST_ROWS = "WITH " + SPLIT_60_20_20 + " SELECT doc_id, true AS valid FROM split WHERE split = 'test'"

#: A signal that a classifier must find: a word that says the label, in nine of ten texts of either class (and the other
#: class's word in the tenth). SQL knows from it what the test rows must look like.
_SIGNAL = """signal AS (SELECT *, CASE WHEN (binary_label = 'figurative') <> (doc_id % 10 = 3) THEN 1 ELSE 0 END AS says FROM split),
w AS (SELECT binary_label, count(*) AS n, sum(count(*)) OVER () AS total, count(*) OVER () AS classes FROM split WHERE split = 'train' {where} GROUP BY 1),
weights AS (SELECT max(total / (classes * n)::DOUBLE) FILTER (binary_label = 'literal') AS w_literal, max(total / (classes * n)::DOUBLE) FILTER (binary_label = 'figurative') AS w_figurative FROM w)"""


def _signalled(rows, reverse=None):
    """The prepared rows, each text with the word of its class; ``reverse``: where the words change places."""
    says = (F.col("label_id") == 1) != (F.col("doc_id") % 10 == 3)
    says = says if reverse is None else says != reverse
    return materialize(rows.withColumn("text", F.concat(F.col("text"), F.lit(" "), F.repeat(F.when(says, "saysfig ").otherwise("sayslit "), 60))), "signalled")


def _learnt(spark, rows, model_rows, shares, **more):
    """One row: test rows, the share of the larger class, that the signal was found (accuracy near nine tenths, above that
    share), and the class weights of the training rows."""
    at = F.col("label_id") == F.col("predicted_id")
    majority = F.greatest(F.avg("label_id"), 1 - F.avg("label_id"))
    found = model_rows.agg(
        F.count("*").alias("n"), F.round(majority, 6).alias("majority"),
        ((F.avg(at.cast("int")) > majority) & (F.avg(at.cast("int")) > 0.8)).alias("signal_found"),
    )
    return found.select(
        "*", F.round(F.lit(shares[0]), 6).alias("w_literal"), F.round(F.lit(shares[1]), 6).alias("w_figurative"),
        *[F.lit(v).alias(k) for k, v in more.items()],
    )


def _learnt_sql(where="", more=""):
    return (
        "WITH " + SPLIT_60_20_20 + ", " + _SIGNAL.format(where=where)
        + " SELECT count(*) AS n, round(greatest(avg((binary_label = 'figurative')::INT), 1 - avg((binary_label = 'figurative')::INT)), 6) AS majority, "
        + "avg(((binary_label = 'figurative') = (says = 1))::INT) > 0.8 AS signal_found, round(max(w_literal), 6) AS w_literal, "
        + "round(max(w_figurative), 6) AS w_figurative" + more + " FROM signal, weights WHERE split = 'test' " + where
    )


def _class_shares(rows):
    by_label = dict(J.weights_of(rows, "label_id"))
    return [by_label.get(0), by_label.get(1)]


@query("J2_fit_weighted", _TEST_ROWS)
def _(spark, sf):
    rows = _prepared(spark, sf)
    model = J.fit_weighted(_part(rows, "train"))
    return _verdict(J.apply_model(model, _part(rows, "test")))


@query("J2_planted_signal", _learnt_sql())
def _(spark, sf):
    rows = _signalled(_prepared(spark, sf))
    model = J.fit_weighted(_part(rows, "train"))
    return _learnt(spark, rows, J.apply_model(model, _part(rows, "test")), _class_shares(_part(rows, "train")))


@query("J3_select_model", _TEST_ROWS)
def _(spark, sf):
    rows = _prepared(spark, sf)
    grid = [{"reg": 0.01}, {"reg": 0.5}]
    chosen = J.select_model(_part(rows, "train"), _part(rows, "val"), grid)
    return _verdict(J.apply_model(chosen.model, _part(rows, "test")))


@query("J3_train_with_patience", _learnt_sql(more=", true AS first_best_kept, true AS best_restored"))
def _(spark, sf):
    rows = _signalled(_prepared(spark, sf))
    model = X.train(_part(rows, "train"), _part(rows, "val"), setting=X.Setting(steps=12, every=3, patience=2))
    top = max(score for _, score in model.scores)
    again = overall(model.apply(_part(rows, "val")), "label_id", "predicted_id").select("f1_macro").first()[0]
    return _learnt(
        spark, rows, model.apply(_part(rows, "test")), model.class_weights,
        first_best_kept=model.step == next(step for step, score in model.scores if score == top),
        best_restored=abs(again - top) < 1e-9,
    )


@query(
    "J4_classifier_kinds",
    "WITH " + SPLIT_60_20_20 + " SELECT kind, doc_id, true AS valid FROM split, (VALUES ('unigram'), ('ngram'), ('bayes')) k(kind) WHERE split = 'test'",
)
def _(spark, sf):
    rows = _prepared(spark, sf)
    models = J.fit_kinds(_part(rows, "train"))
    return union_sources(
        [_verdict(J.apply_model(m, _part(rows, "test"))).withColumn("kind", F.lit(kind)) for kind, m in models.items()]
    )


@query("J5_adapt", _TEST_ROWS)
def _(spark, sf):
    """Adapted to all domains together from a model of English alone."""
    rows = _prepared(spark, sf)
    base = J.fit_weighted(_part(rows, "train").where("lang = 'en'"))
    model = J.adapt(base, _part(rows, "train"))
    return _verdict(J.apply_model(model, _part(rows, "test")))


@query("J5_warm_start", _learnt_sql("AND lang <> 'en'", ", true AS zero_steps_are_the_base, true AS strong_pull_stays, true AS better_than_base"))
def _(spark, sf):
    """English says the label with one word, the other languages with the other: the base is wrong there, and adapts."""
    rows = _signalled(_prepared(spark, sf), F.col("lang") != "en")
    english, other = rows.where("lang = 'en'"), rows.where("lang <> 'en'")
    setting = X.Setting(steps=12, every=3, patience=4)
    base = X.train(_part(english, "train"), _part(english, "val"), setting=setting)
    fit = lambda start, pull, steps: X.train(
        _part(other, "train"), _part(other, "val"), setting=X.Setting(steps=steps, every=3, patience=4), start=start, pull=pull
    )
    same, adapted = fit(base, 0.01, 0), fit(base, 0.01, 12)
    near = X.train(_part(other, "train"), _part(other, "val"), setting=X.Setting(steps=3, every=3), start=base, pull=1e6)
    far = lambda model: float(abs(model.weights - base.weights).max())
    f1 = lambda model: overall(model.apply(_part(other, "test")), "label_id", "predicted_id").select("f1_macro").first()[0]
    return _learnt(
        spark, rows, adapted.apply(_part(other, "test")), adapted.class_weights,
        zero_steps_are_the_base=far(same) == 0.0, strong_pull_stays=far(near) < 1e-2, better_than_base=f1(adapted) > f1(base),
    )


@query("J6_tokenizer_udf", "SELECT doc_id, " + I.TOKENS.format("text") + " AS tokens FROM documents")
def _(spark, sf):
    split = tokenizer_udf(lambda text: text.split(), glue=" ")
    return I.documents(spark, sf).select("doc_id", split.count("text").cast("bigint").alias("tokens"))


# --- whole jobs ---------------------------------------------------------------------------------------


@query(
    "K1_prepare_word_corpus",
    "WITH "
    + I.SENTENCES
    + """, c AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total FROM firsts WHERE split = 'train' GROUP BY 1),
k AS (SELECT *, (total - ceil(0.1::DOUBLE * total))::BIGINT AS kept FROM c),
q AS (SELECT *, (n * kept) // total AS base, (n * kept) % total AS rest FROM k),
r AS (SELECT *, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label DESC) <= kept - sum(base) OVER () THEN 1 ELSE 0 END AS train_n FROM q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || text), text) AS rk FROM firsts WHERE split = 'train')
SELECT text, ranked.label, num_words, pos_folder AS pos, source, CASE WHEN rk <= train_n THEN 'train' ELSE 'val' END AS split FROM ranked JOIN r USING (label)
UNION ALL SELECT text, label, num_words, pos_folder, source, 'test' FROM firsts WHERE split = 'test'""",
)
def _(spark, sf):
    corpus = jobs.split_sentence_corpus(jobs.sentence_corpus(I.corpus_words(spark, sf)))
    return corpus.select("text", "label", "num_words", "pos", "source", "split")


@query(
    "K2_prepare_domain",
    "WITH "
    + SPLIT_60_20_20.replace("FROM documents d JOIN", "FROM (SELECT * FROM documents WHERE length(text) > 10) d JOIN")
    + " SELECT doc_id, text, binary_label AS label, split FROM split",
)
def _(spark, sf):
    return jobs.prepare_domain(I.annotations(spark, sf), "reddit")


@query(
    "K2_prepare_domain_report",
    "WITH "
    + SPLIT_60_20_20.replace("FROM documents d JOIN", "FROM (SELECT * FROM documents WHERE length(text) > 10) d JOIN")
    + " SELECT split, count(*) FILTER (binary_label = 'literal') AS literal, count(*) FILTER (binary_label = 'figurative') AS figurative, "
    "count(*) AS total FROM split GROUP BY split",
)
def _(spark, sf):
    return split_report(jobs.prepare_domain(I.annotations(spark, sf), "news"), BINARY_LABELS)


@query("K3_prepare_annotations", "WITH " + SPLIT_60_20_20 + " SELECT doc_id, text, label, binary_label, split FROM split")
def _(spark, sf):
    rows = jobs.prepare_annotations(I.annotations(spark, sf))
    return rows.select("doc_id", "text", "label", "binary_label", "split")


@query(
    "K4_process_long_texts",
    "WITH "
    + SMART
    + r""", s AS (SELECT *, len(tk)::BIGINT AS a, len(regexp_extract_all(cut, '\S+'))::BIGINT AS b FROM smart)
SELECT doc_id, cut AS text, a AS original_tokens, a > 510 AS was_truncated, b AS token_count, length(cut)::BIGINT AS char_count,
  b AS word_count, """
    + BIN.format("b")
    + " AS token_bin FROM s",
)
def _(spark, sf):
    rows = jobs.process_long_texts(I.documents(spark, sf)).rows
    columns = ["original_tokens", "was_truncated", "token_count", "char_count", "word_count", "token_bin"]
    return rows.select("doc_id", "text", *columns)


@query(
    "K4_long_text_profiles",
    "WITH "
    + SMART
    + ", p AS (SELECT 'before' AS stage, text FROM documents UNION ALL SELECT 'after', cut FROM smart), t AS (SELECT stage, "
    + I.TOKENS.format("text")
    + " AS tk, length(text)::BIGINT AS ch FROM p) SELECT stage, "
    + LENGTH_STATS
    + " FROM t GROUP BY stage",
)
def _(spark, sf):
    return rounded(jobs.process_long_texts(I.documents(spark, sf)).profile)


@query(
    "K4_chunk_long_texts",
    "WITH "
    + CHUNKS
    + r""", n AS (SELECT doc_id, len(tk)::BIGINT AS original_tokens FROM t)
SELECT doc_id, chunk_pos, original_tokens, len(regexp_extract_all(text, '\S+'))::BIGINT AS token_count, text FROM chunks JOIN n USING (doc_id)""",
)
def _(spark, sf):
    rows = jobs.process_long_texts(I.documents(spark, sf), "chunk").rows
    return rows.select("doc_id", "chunk_pos", "original_tokens", "token_count", "text")


@query(
    "K5_collect_news",
    "WITH "
    + I.NEWS
    + r""", kept AS (
  SELECT *, regexp_extract_all(text, '\S+') AS tk FROM pass2
  WHERE (meta_lang IS NULL OR lower(meta_lang) = 'en') AND length(text) >= 500
    AND publish_ts > TIMESTAMP '2024-06-30 12:00:00' - INTERVAL 32 DAYS)
SELECT page_id, source, url, title, strftime(publish_ts, '%Y-%m-%d') AS publish_date,
  CASE WHEN len(tk) > 450 THEN array_to_string(tk[1:337], ' ') || ' ... ' || array_to_string(tk[len(tk) - 112:], ' ') ELSE text END AS text
FROM kept""",
)
def _(spark, sf):
    return jobs.collect_news(I.news_pages(spark, sf), I.AS_OF, date="publish_ts")


@query(
    "K5_news_by_source",
    "WITH "
    + I.NEWS
    + """ SELECT source, count(*) AS count FROM pass2 WHERE (meta_lang IS NULL OR lower(meta_lang) = 'en') AND length(text) >= 500
    AND publish_ts > TIMESTAMP '2024-06-30 12:00:00' - INTERVAL 32 DAYS GROUP BY source""",
)
def _(spark, sf):
    out = scratch_path(spark, "news")
    rows = jobs.collect_news(I.news_pages(spark, sf), I.AS_OF, date="publish_ts", out=out)
    return value_counts(rows, "source").select("source", "count")


_FORUM_ROWS = (
    I.FORUM
    + r""", capped AS (
  SELECT * FROM frows QUALIFY row_number() OVER (PARTITION BY source, type ORDER BY conv_id, turn) <= 500),
kept AS (SELECT *, len(regexp_extract_all(text, '\S+'))::BIGINT AS n FROM capped
         WHERE length(CASE WHEN type = 'post' THEN trim(text, E' \n\r\t') ELSE text END) >= 50),
pieces AS (
  SELECT url, unnest(string_split(text, '. ')) || '. ' AS piece, generate_subscripts(string_split(text, '. '), 1) AS pos FROM kept WHERE n > 100),
running AS (SELECT *, sum(len(regexp_extract_all(piece, '\S+'))) OVER (PARTITION BY url ORDER BY pos) AS upto FROM pieces),
cuts AS (SELECT url, trim(string_agg(piece, '' ORDER BY pos), E' \n\r\t') AS cut FROM running WHERE upto <= 100 GROUP BY url),
forum_rows AS (
  SELECT kept.*, n > 100 AS was_truncated,
         CASE WHEN n <= 100 THEN text WHEN cut IS NULL THEN array_to_string(regexp_extract_all(text, '\S+')[1:100], ' ') ELSE cut END AS new_text,
         len(regexp_extract_all(new_text, '\S+'))::BIGINT AS m
  FROM kept LEFT JOIN cuts USING (url))"""
)


def _forum(spark, sf):
    posts, comments = I.forum(spark, sf)
    return jobs.collect_forum(posts, comments, order=["conv_id", "turn"], token_limit=100)


@query(
    "K6_collect_forum",
    "WITH "
    + _FORUM_ROWS
    + """ SELECT new_text AS text, source, type, score, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, url, n AS original_tokens,
  m AS final_tokens, was_truncated, """
    + BIN.format("n").replace("'512-1024'", "'512-1K'").replace("'1024-2048'", "'1K-2K'").replace("'2048+'", "'2K+'")
    + " AS token_bin FROM forum_rows",
)
def _(spark, sf):
    return _forum(spark, sf).rows.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


@query(
    "K6_forum_statistics",
    "WITH "
    + _FORUM_ROWS
    + """ SELECT 'source' AS kind, source AS name, count(*) AS count FROM forum_rows GROUP BY source
UNION ALL SELECT 'type', type, count(*) FROM forum_rows GROUP BY type
UNION ALL SELECT 'summary', 'truncated', count(*) FILTER (was_truncated) FROM forum_rows
UNION ALL SELECT 'bin', b, count(n) FROM (VALUES ('0-128', 0, 128), ('128-256', 128, 256), ('256-384', 256, 384), ('384-512', 384, 512),
  ('512-1K', 512, 1024), ('1K-2K', 1024, 2048), ('2K+', 2048, 1000000000)) v(b, lo, hi) LEFT JOIN forum_rows ON n > lo AND n <= hi GROUP BY b""",
)
def _(spark, sf):
    result = _forum(spark, sf)
    line = lambda df, kind, name, count: df.select(
        F.lit(kind).alias("kind"), name.alias("name"), F.col(count).alias("count")
    )
    return union_sources(
        [
            line(result.by_source, "source", F.col("source"), "count"),
            line(result.by_type, "type", F.col("type"), "count"),
            line(result.summary, "summary", F.lit("truncated"), "truncated"),
            line(result.histogram, "bin", F.col("token_bin"), "count"),
        ]
    )


@query(
    "K7_collect_reviews",
    "WITH " + I.REVIEWS + " SELECT movie_id, movie_title, rating, review_title, review_body, upvotes, page, pos FROM reviews "
    "QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY page, pos) <= 6",
)
def _(spark, sf):
    return jobs.collect_reviews(I.review_pages(spark, sf), 6, page_col="page")


@query(
    "K8_annotation_round_trip",
    "WITH " + I.PENDING_REQUESTS + " SELECT row_id, text, label_metaphor, label_irony, reasoning, original_sentiment, 'news' AS source FROM aligned",
)
def _(spark, sf):
    from corpusloom.operators.annotation import annotation_requests

    rows = I.annotation_rows(spark, sf)
    done = I.table(spark, sf, "labels").select(F.col("doc_id").alias("row_id"))  # labelled rows need no answer
    landed = I.responses(annotation_requests(rows, done))
    return jobs.annotation_round_trip(rows, landed, done)


@query(
    "K8_annotation_resume",
    "WITH " + I.REQUESTS + " SELECT row_id, text, label_metaphor, label_irony, reasoning, original_sentiment, 'news' AS source FROM aligned",
)
def _(spark, sf):
    from corpusloom.operators.annotation import annotation_requests

    rows = I.annotation_rows(spark, sf)
    requests = materialize(annotation_requests(rows), "requests")  # written when the prompts go out
    landed = I.responses(requests)
    parts, done = [], None
    for part in range(3):  # responses land in three parts, and each round knows what is done
        arrived = landed.where(F.col("batch_id") % 3 == part)
        parts.append(materialize(jobs.annotation_round_trip(rows, arrived, done, requests=requests), "annotations"))
        done = union_sources(parts).select("row_id")
    return union_sources(parts)


@query(
    "K9_evaluate",
    "WITH "
    + I.CLASS_SCORES.replace("g.domain", "'all' AS domain")
    + """ SELECT model, 'class ' || class AS row, round(prec, 6) AS a, round(rec, 6) AS b, round(f1, 6) AS c, support AS n FROM scores
UNION ALL SELECT model, 'overall', round(accuracy, 6), round(f1_macro, 6), round(f1_weighted, 6), total FROM totals
UNION ALL SELECT model, 'confusion ' || l, count(*) FILTER (predicted_binary = 'literal'), count(*) FILTER (predicted_binary = 'figurative'), 0, count(*)
  FROM pred JOIN (VALUES ('literal'), ('figurative')) v(l) ON binary_label = l GROUP BY model, l""",
)
def _(spark, sf):
    frames = jobs.evaluate(I.single_predictions(spark, sf), by=("model",))
    shape = lambda df, row, a, b, c, n: df.select(
        "model", row.alias("row"), a.cast("double").alias("a"), b.cast("double").alias("b"), c.cast("double").alias("c"), n.alias("n")
    )
    k = F.col
    return rounded(
        union_sources(
            [
                shape(frames["per_class_metrics"], F.concat(F.lit("class "), "class"), k("precision"), k("recall"), k("f1"), k("support")),
                shape(frames["overall_metrics"], F.lit("overall"), k("accuracy"), k("f1_macro"), k("f1_weighted"), k("total")),
                shape(
                    frames["confusion_matrix"],
                    F.concat(F.lit("confusion "), "true_label"),
                    k("pred_literal"),
                    k("pred_figurative"),
                    F.lit(0),
                    k("pred_literal") + k("pred_figurative"),
                ),
            ]
        )
    )


@query(
    "K10_evaluate_cross_domain",
    "WITH "
    + COMPARED
    + """ SELECT 'metrics' AS frame, model, domain AS name, round(accuracy, 6) AS a, round(f1_macro, 6) AS b, total AS n FROM totals
UNION ALL SELECT 'class', model, domain || ' ' || class, round(prec, 6), round(rec, 6), support FROM scores
UNION ALL SELECT 'label', model, domain || ' ' || original_label, round(avg(correct::INTEGER), 6), 0, count(*) FROM pred GROUP BY model, domain, original_label
UNION ALL SELECT 'label', model, domain || ' Total', round(avg(correct::INTEGER), 6), 0, count(*) FROM pred GROUP BY model, domain
UNION ALL SELECT 'errors', model, domain, round(avg((NOT correct)::INTEGER) * 100, 6), 0, count(*) FROM pred GROUP BY model, domain
UNION ALL SELECT 'better ' || better_domain, model, '', improvement_pct, accuracy_diff, 0 FROM compared""",
)
def _(spark, sf):
    r = jobs.evaluate_cross_domain(I.predictions(spark, sf))
    k, zero = F.col, F.lit(0)
    shape = lambda df, frame, name, a, b, n: df.select(
        frame.alias("frame"), "model", name.alias("name"), a.alias("a"), b.cast("double").alias("b"), n.cast("bigint").alias("n")
    )
    total = r.errors.where(k("level") == "all")
    return rounded(
        union_sources(
            [
                shape(r.metrics, F.lit("metrics"), k("domain"), k("accuracy"), k("f1_macro"), k("total")),
                shape(r.classes, F.lit("class"), F.concat_ws(" ", "domain", "class"), k("precision"), k("recall"), k("support")),
                shape(r.breakdown, F.lit("label"), F.concat_ws(" ", "domain", "label"), k("accuracy"), zero, k("total")),
                shape(total, F.lit("errors"), k("domain"), k("error_rate"), zero, k("total")),
                shape(r.comparison, F.concat(F.lit("better "), "better_domain"), F.lit(""), k("improvement_pct"), k("accuracy_diff"), zero),
            ]
        )
    )


def _domains(spark, sf):
    """Two domains that share no row and cover the table."""
    rows = materialize(I.annotations(spark, sf), "annotations")
    return {
        "reddit": jobs.prepare_domain(rows.where("source < 'src5'"), "reddit"),
        "news": jobs.prepare_domain(rows.where("source >= 'src5'"), "news"),
    }


def _domain_tests(name: str, condition: str) -> str:
    """Per true label of a domain's test rows: how many there are."""
    split = SPLIT_60_20_20.replace(
        "FROM documents d JOIN", f"FROM (SELECT * FROM documents WHERE length(text) > 10 AND {condition}) d JOIN"
    )
    return (
        f"SELECT '{name}' AS domain, binary_label AS label, count(*) AS n, true AS sums, true AS best FROM "
        f"(WITH {split} SELECT * FROM split WHERE split = 'test') GROUP BY 1, 2"
    )


@query(
    "K11_train_domains",
    _domain_tests("reddit", "source < 'src5'") + " UNION ALL " + _domain_tests("news", "source >= 'src5'"),
)
def _(spark, sf):
    """Support per domain and class from the written predictions; whether the published scores and the winner follow
    from them."""
    out = scratch_path(spark, "domains")
    grid = [{"reg": 0.01}, {"reg": 0.1}]
    _, scores = jobs.train_domains(_domains(spark, sf), out=out, grid=grid)
    rows = union_sources(
        [
            spark.read.option("header", True).csv(f"{out}/evaluation/{name}/detailed_predictions").withColumn("domain", F.lit(name))
            for name in ("reddit", "news")
        ]
    )
    hit = F.avg((F.col("true_label") == F.col("pred_label")).cast("double"))
    accuracy = rows.groupBy(F.col("domain").alias("_domain")).agg(hit.alias("a"))
    same = F.abs(F.col("a") - F.col("Accuracy")) < 1e-9
    winner = best(scores, "Macro_F1", "domain_rank").select(F.col("Macro_F1").alias("top")).scalar()
    checked = scores.join(accuracy, F.col("Domain") == F.col("_domain")).select(
        F.col("_domain").alias("domain"), same.alias("sums"), (F.col("Macro_F1") <= winner).alias("best")
    )
    support = rows.groupBy("domain", F.col("true_label").alias("label")).agg(F.count("*").alias("n"))
    return support.join(checked, "domain").select("domain", "label", "n", "sums", "best")


# --- streaming ----------------------------------------------------------------------------------------


@query(
    "L1_stream_articles",
    "WITH " + I.NEWS + " SELECT DISTINCT source, title_key FROM art WHERE page_id % 9 <> 2",
)
def _(spark, sf):
    landed = scratch_path(spark, "articles")
    day = F.lit(I.AS_OF).cast("timestamp") - F.make_interval(days=(F.col("page_id") % 30).cast("int"))
    dated = F.when(F.col("page_id") % 9 != 2, day)
    pages = I.news_pages(spark, sf).select("page_id", "source", "url", page_title("html").alias("title"), dated.alias("publish_ts"))
    pages.write.parquet(landed)
    stream = spark.readStream.schema(pages.schema).parquet(landed)
    out = scratch_path(spark, "articles-out")
    running = (
        intake.stream_articles(stream)
        .writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, "articles-checkpoint"))
        .trigger(availableNow=True)
        .start(out)
    )
    running.awaitTermination()
    from corpusloom.functions.normalize import normalize_title

    return spark.read.schema(pages.schema).parquet(out).select("source", normalize_title("title").alias("title_key"))


@query(
    "L1_first_arrivals",
    "WITH " + I.NEWS + " SELECT page_id, CASE WHEN page_id IN (SELECT page_id FROM pass2) THEN 'first' ELSE 'repeat' END AS verdict FROM art",
)
def _(spark, sf):
    """Pages arrive in the order of their ids: the first by URL and title, and the rest as a side output."""
    own = spark.newSession()  # with a state store and state partitions of its own
    arrivals.use_rocksdb(own)
    own.conf.set("spark.sql.shuffle.partitions", str(max(2, spark.sparkContext.defaultParallelism)))  # a task per core
    landed, out = scratch_path(spark, "arrivals-in"), scratch_path(spark, "arrivals-out")
    day = F.lit(I.AS_OF).cast("timestamp")
    pages = I.news_pages(spark, sf).select("page_id", "source", "url", page_title("html").alias("title"), day.alias("publish_ts"))
    pages = pages.withColumn("arrived", day + F.make_dt_interval(secs=F.col("page_id") / 10_000))
    pages.write.parquet(landed)
    stream = own.readStream.schema(pages.schema).parquet(landed)
    found = arrivals.stream_first_articles(stream, arrived="arrived")
    arrivals.write_verdicts(found, out, scratch_path(spark, "arrivals-checkpoint")).awaitTermination()
    return union_sources(
        [arrivals.read_verdicts(spark, out, pages.schema, v).select("page_id", F.lit(v).alias("verdict")) for v in ("first", "repeat")]
    )


@query(
    "L1_stream_urls",
    "WITH " + I.NEWS + " SELECT source, url_key, count(DISTINCT url_key) AS n FROM art GROUP BY source, url_key",
)
def _(spark, sf):
    """Copies of a page under one URL, each with a title of its own: only the URL pass can hold them back."""
    from corpusloom.functions.normalize import normalize_url

    landed, out = scratch_path(spark, "urls"), scratch_path(spark, "urls-out")
    day = F.lit(I.AS_OF).cast("timestamp")
    title = F.concat(F.lit("title "), F.col("page_id"))
    pages = I.news_pages(spark, sf).select("page_id", "source", "url", title.alias("title"), day.alias("publish_ts"))
    pages.write.parquet(landed)
    stream = spark.readStream.schema(pages.schema).parquet(landed)
    running = (
        intake.stream_articles(stream)
        .writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, "urls-checkpoint"))
        .trigger(availableNow=True)
        .start(out)
    )
    running.awaitTermination()
    rows = spark.read.schema(pages.schema).parquet(out)
    return rows.groupBy("source", normalize_url("url").alias("url_key")).agg(F.count("*").alias("n"))


@query("L2_stream_annotations", "SELECT doc_id AS row_id, text FROM documents")
def _(spark, sf):
    landed, sink, checkpoint = (scratch_path(spark, f"intake-{n}") for n in ("in", "out", "checkpoint"))
    rows = I.documents(spark, sf).select(F.col("doc_id").alias("row_id"), "text")
    stream = lambda: spark.readStream.schema(rows.schema).parquet(landed)
    rows.where(F.col("row_id") % 3 != 0).write.parquet(landed)
    intake.stream_annotations(stream(), sink, checkpoint).awaitTermination()
    rows.where(F.col("row_id") % 3 != 1).write.mode("append").parquet(landed)  # overlaps the first delivery
    intake.stream_annotations(stream(), sink, checkpoint).awaitTermination()
    return writers.read_annotations(spark, sink)
