"""Queries for aggregations, ranking, deduplication, splits and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import inputs as I
from corpusloom.catalog.registry import query
from corpusloom.catalog.rows import BIN, SMART
from corpusloom.catalog.scans import LENGTH_STATS, SPLIT_60_20_20, rounded, split_rows
from corpusloom.functions.normalize import normalize_title
from corpusloom.operators import aggregates as E
from corpusloom.operators import dedupe as D
from corpusloom.operators import metrics as M
from corpusloom.operators import ranking as R
from corpusloom.operators import sketches as Z
from corpusloom.operators.filters import to_binary
from corpusloom.operators.aggregates import with_lengths
from corpusloom.operators.long_texts import shorten
from corpusloom.operators.sets import distinct_sentences, union_sources
from corpusloom.operators.split import stratified_split
from corpusloom.plans import jobs
from corpusloom.schemas import BINARY_LABELS
from corpusloom.session import materialize, scratch_path
from corpusloom.sources.documents import page_title, parse_reviews, to_comment_rows, to_post_rows

BY = ["model", "domain"]


@query("E1_value_counts", "SELECT lang, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def _(spark, sf):
    return E.value_counts(I.documents(spark, sf), "lang")


@query(
    "E2_words_to_sentences",
    "WITH " + I.SENTENCES + " SELECT split, source, pos_folder, text, label, num_words, num_metaphors, "
    "round(metaphor_ratio, 6) AS metaphor_ratio FROM sentences",
)
def _(spark, sf):
    return rounded(E.words_to_sentences(I.corpus_words(spark, sf), ["split", "source", "pos_folder"]))


_LENGTHS = "WITH t AS (SELECT *, " + I.TOKENS.format("text") + " AS tk, length(text)::BIGINT AS ch FROM documents) "


@query("E3_length_stats", _LENGTHS + "SELECT lang, " + LENGTH_STATS + " FROM t GROUP BY lang")
def _(spark, sf):
    return rounded(E.length_stats(I.documents(spark, sf), by=["lang"]))


@query(
    "E3_merged_sketches",
    _LENGTHS + "SELECT lang, count(*) AS total_samples, round(avg(tk), 6) AS tokens_mean, min(tk) AS tokens_min, max(tk) AS tokens_max, "
    "round(avg(ch), 6) AS chars_mean, max(ch) AS chars_max, true AS quantiles_near FROM t GROUP BY lang",
)
def _(spark, sf):
    """Stored per language and source, merged per language: sums are exact, quantiles near their rank."""
    docs = I.documents(spark, sf)
    stored = materialize(Z.length_sketches(docs, ["lang", "source"]), "sketches")
    merged = Z.merge_length_sketches(stored, ["lang"])
    ranked = with_lengths(docs).select("lang", "token_count").join(merged.select("lang", "tokens_q50", "tokens_q95"), "lang")
    near = lambda q: (F.avg((F.col("token_count") < F.col(f"tokens_q{q}")).cast("int")) <= q / 100 + Z.KLL_ERROR) & (
        F.avg((F.col("token_count") <= F.col(f"tokens_q{q}")).cast("int")) >= q / 100 - Z.KLL_ERROR
    )
    seen = ranked.groupBy("lang").agg((near(50) & near(95)).alias("quantiles_near"))
    columns = ["lang", "total_samples", "tokens_mean", "tokens_min", "tokens_max", "chars_mean", "chars_max"]
    return rounded(merged.select(*columns).join(seen, "lang"))


@query(
    "E4_length_histogram",
    _LENGTHS
    + ", b AS (SELECT "
    + BIN.format("tk")
    + """ AS token_bin FROM t),
bins(bin_rank, token_bin) AS (VALUES (0, '0-128'), (1, '128-256'), (2, '256-384'), (3, '384-512'), (4, '512-1024'), (5, '1024-2048'), (6, '2048+'))
SELECT bin_rank, token_bin, count(b.token_bin) AS count FROM bins LEFT JOIN b USING (token_bin) GROUP BY ALL""",
)
def _(spark, sf):
    return E.length_histogram(E.with_lengths(I.documents(spark, sf)))


@query(
    "E5_truncation_summary",
    "WITH "
    + SMART
    + r""", r AS (SELECT lang, len(tk) AS a, len(regexp_extract_all(cut, '\S+')) AS b FROM smart)
SELECT lang, count(*) AS total, count(*) FILTER (a > 510) AS truncated,
  round(count(*) FILTER (a > 510) / count(*)::DOUBLE * 100, 6) AS truncation_rate, round(avg(a), 6) AS mean_original_tokens,
  round(avg(b), 6) AS mean_final_tokens, max(a)::BIGINT AS max_original_tokens, max(b)::BIGINT AS max_final_tokens FROM r GROUP BY lang""",
)
def _(spark, sf):
    rows = shorten(I.documents(spark, sf)).withColumn("final_tokens", F.col("token_count"))
    return rounded(E.truncation_summary(rows, ["lang"]))


@query(
    "E6_class_weights",
    "WITH "
    + I.ANNOTATIONS
    + """, c AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total, count(*) OVER () AS k FROM ann GROUP BY label),
w AS (SELECT *, total / (k * n)::DOUBLE AS weight FROM c)
SELECT label, n, round(n / total::DOUBLE * 100, 6) AS share, round(weight, 6) AS weight,
  round(weight / first_value(weight) OVER (ORDER BY label), 6) AS weight_ratio FROM w""",
)
def _(spark, sf):
    return rounded(E.class_weights(I.annotations(spark, sf)))


@query(
    "E7_confusion",
    "WITH "
    + I.PREDICTIONS
    + """ SELECT model, domain, l AS true_label, (l = 'figurative')::INTEGER AS label_rank,
  count(*) FILTER (binary_label = l AND predicted_binary = 'literal') AS pred_literal,
  count(*) FILTER (binary_label = l AND predicted_binary = 'figurative') AS pred_figurative
FROM pred, (VALUES ('literal'), ('figurative')) v(l) GROUP BY ALL""",
)
def _(spark, sf):
    return M.confusion(I.scored(spark, sf), "binary_label", "predicted_binary", BINARY_LABELS, BY)


@query(
    "E8_per_class",
    "WITH " + I.CLASS_SCORES + " SELECT model, domain, class, round(prec, 6) AS precision, round(rec, 6) AS recall, "
    "round(f1, 6) AS f1, support, tp AS correct, round(rec, 6) AS accuracy FROM scores",
)
def _(spark, sf):
    return rounded(M.per_class(I.scored(spark, sf), "binary_label", "predicted_binary", BY, BINARY_LABELS))


_OVERALL = """round(accuracy, 6) AS accuracy, round(f1_macro, 6) AS f1_macro, round(f1_weighted, 6) AS f1_weighted,
  round(precision_macro, 6) AS precision_macro, round(recall_macro, 6) AS recall_macro,
  round(precision_weighted, 6) AS precision_weighted, round(recall_weighted, 6) AS recall_weighted, total, correct"""


@query("E9_overall", "WITH " + I.CLASS_SCORES + " SELECT model, domain, " + _OVERALL + " FROM totals")
def _(spark, sf):
    return rounded(M.overall(I.scored(spark, sf), "binary_label", "predicted_binary", BY))


@query(
    "E9_overall_ten_classes",
    r"""WITH v AS (SELECT label AS t, (list_position(embedding, list_max(embedding)) - 1)::INTEGER AS p FROM embeddings),
k AS (SELECT t AS class FROM v UNION SELECT p FROM v),
c AS (SELECT class, count(*) FILTER (t = class AND p = class) AS tp, count(*) FILTER (t = class) AS s,
             count(*) FILTER (p = class) AS q FROM v, k GROUP BY class),
m AS (SELECT *, CASE WHEN q = 0 THEN 0 ELSE tp / q::DOUBLE END AS prec, CASE WHEN s = 0 THEN 0 ELSE tp / s::DOUBLE END AS rec,
             CASE WHEN s + q = 0 THEN 0 ELSE 2 * tp / (s + q)::DOUBLE END AS f1 FROM c)
SELECT round(sum(tp) / sum(s)::DOUBLE, 6) AS accuracy, round(avg(f1), 6) AS f1_macro, round(sum(f1 * s) / sum(s), 6) AS f1_weighted,
  round(avg(prec), 6) AS precision_macro, round(avg(rec), 6) AS recall_macro, round(sum(prec * s) / sum(s), 6) AS precision_weighted,
  round(sum(rec * s) / sum(s), 6) AS recall_weighted, sum(s)::BIGINT AS total, sum(tp)::BIGINT AS correct FROM m""",
)
def _(spark, sf):
    from corpusloom.functions.scores import argmax

    rows = I.table(spark, sf, "embeddings").withColumn("pred", argmax("embedding"))
    return rounded(M.overall(rows, "label", "pred"))


@query(
    "E10_report",
    "WITH "
    + I.CLASS_SCORES
    + """ SELECT model, domain, 0 AS section, class AS row, round(prec, 6) AS precision, round(rec, 6) AS recall,
  round(f1, 6) AS f1, support::DOUBLE AS support FROM scores
UNION ALL SELECT model, domain, 1, 'accuracy', round(accuracy, 6), round(accuracy, 6), round(accuracy, 6), round(accuracy, 6) FROM totals
UNION ALL SELECT model, domain, 2, 'macro avg', round(precision_macro, 6), round(recall_macro, 6), round(f1_macro, 6), total FROM totals
UNION ALL SELECT model, domain, 3, 'weighted avg', round(precision_weighted, 6), round(recall_weighted, 6), round(f1_weighted, 6), total FROM totals""",
)
def _(spark, sf):
    return rounded(M.report(I.scored(spark, sf), "binary_label", "predicted_binary", BY))


@query(
    "E11_breakdown",
    "WITH "
    + I.PREDICTIONS
    + """, g AS (SELECT model, domain, original_label, grouping(original_label) AS tot, count(*) AS total,
  count(*) FILTER (correct) AS correct FROM pred GROUP BY GROUPING SETS ((model, domain, original_label), (model, domain)))
SELECT model, domain, CASE WHEN tot = 1 THEN 4 ELSE list_position(['literal', 'metaphor', 'irony', 'both'], original_label) - 1 END::INTEGER AS label_rank,
  CASE WHEN tot = 1 THEN 'Total' ELSE original_label END AS label, total, correct, round(correct / total::DOUBLE, 6) AS accuracy,
  CASE WHEN tot = 0 THEN CASE WHEN original_label = 'literal' THEN 'literal' ELSE 'figurative' END END AS maps_to FROM g""",
)
def _(spark, sf):
    return rounded(M.breakdown(I.scored(spark, sf), BY))


@query(
    "E12_error_rates",
    "WITH "
    + I.PREDICTIONS
    + """ SELECT model, domain, CASE WHEN grouping(binary_label) = 0 THEN 'binary' WHEN grouping(original_label) = 0 THEN 'original' ELSE 'all' END AS level,
  coalesce(binary_label, original_label) AS label, count(*) FILTER (NOT correct) AS errors, count(*) AS total,
  round(count(*) FILTER (NOT correct) / count(*)::DOUBLE * 100, 6) AS error_rate
FROM pred GROUP BY GROUPING SETS ((model, domain), (model, domain, binary_label), (model, domain, original_label))""",
)
def _(spark, sf):
    return rounded(M.error_rates(I.scored(spark, sf), BY))


@query(
    "E13_binary_metrics",
    "WITH "
    + I.CLASS_SCORES
    + """ SELECT s.model, s.domain, round(f1_macro, 6) AS macro_f1, round(prec, 6) AS precision, round(rec, 6) AS recall, round(f1, 6) AS f1
FROM scores s JOIN totals t USING (model, domain) WHERE class = 'figurative'""",
)
def _(spark, sf):
    return rounded(M.binary_metrics(I.scored(spark, sf), "binary_label", "predicted_binary", by=BY))


@query("E14_require_classes", "WITH " + I.ANNOTATIONS + " SELECT binary_label, count(*) AS n FROM ann GROUP BY binary_label")
def _(spark, sf):
    rows = E.require_classes(to_binary(I.annotations(spark, sf)), "binary_label")
    return rows.groupBy("binary_label").agg(F.count("*").alias("n"))


@query(
    "E15_dedupe_report",
    "WITH " + I.SENTENCES + " SELECT split, count(*) AS rows_before, count(DISTINCT text) AS rows_after FROM sentences GROUP BY split",
)
def _(spark, sf):
    keys = ["split", "source", "pos_folder", "source_rank", "pos_rank"]
    return E.dedupe_report(E.words_to_sentences(I.corpus_words(spark, sf), keys), by=["split"])


@query(
    "E15_overlap_of_deliveries",
    """WITH a AS (SELECT text FROM documents WHERE doc_id % 3 <> 0), b AS (SELECT text FROM documents WHERE doc_id % 3 <> 1)
SELECT (SELECT count(*) FROM a) AS left_rows, (SELECT count(*) FROM b) AS right_rows, (SELECT count(DISTINCT text) FROM a) AS left_exact,
  (SELECT count(*) FROM (SELECT text FROM a INTERSECT SELECT text FROM b)) AS shared_exact, true AS all_near""",
)
def _(spark, sf):
    """Two deliveries that share a third of the rows: their stored sketches against exact counts."""
    docs = I.documents(spark, sf).withColumn("text", F.coalesce("text", F.lit("")))
    left, right = docs.where("doc_id % 3 <> 0"), docs.where("doc_id % 3 <> 1")
    stored = [materialize(Z.key_sketch(df), "keys").select(F.struct("rows", "keys").alias(n)) for df, n in ((left, "l"), (right, "r"))]
    one = stored[0].withColumn("one", F.lit(1)).join(stored[1].withColumn("one", F.lit(1)), "one")  # a row each
    sizes = one.select(F.lit(1).alias("one"), "l.rows", F.col("r.rows").alias("right_rows"), *Z.overlap(F.col("l.keys"), F.col("r.keys")))
    sides = docs.select(F.sha2("text", 256).alias("d"), (F.col("doc_id") % 3).alias("m")).groupBy("d")
    sides = sides.agg(F.max((F.col("m") != 0).cast("int")).alias("l"), F.max((F.col("m") != 1).cast("int")).alias("r"))
    exact = sides.agg(
        F.lit(1).alias("one"), F.sum("l").alias("left_exact"), F.sum("r").alias("right_exact"), F.count("*").alias("all_exact"),
        F.sum(F.col("l") * F.col("r")).alias("shared_exact"),
    )
    near = lambda name: F.abs(F.col(f"{name}_keys") - F.col(f"{name}_exact")) <= Z.THETA_ERROR * F.col("all_exact")
    return sizes.join(exact, "one").select(
        F.col("rows").alias("left_rows"), "right_rows", "left_exact", "shared_exact",
        (near("left") & near("right") & near("all") & near("shared")).alias("all_near"),
    )


@query(
    "E16_split_report",
    "WITH " + SPLIT_60_20_20 + " SELECT split, count(*) FILTER (binary_label = 'literal') AS literal, "
    "count(*) FILTER (binary_label = 'figurative') AS figurative, count(*) AS total FROM split GROUP BY split",
)
def _(spark, sf):
    return E.split_report(split_rows(spark, sf), BINARY_LABELS, "binary_label")


COMPARED = (
    I.CLASS_SCORES
    + """, wide AS (
  SELECT model, max(CASE WHEN domain = 'Reddit' THEN accuracy END) AS ra, max(CASE WHEN domain = 'News' THEN accuracy END) AS na,
         max(CASE WHEN domain = 'Reddit' THEN f1_macro END) AS rm, max(CASE WHEN domain = 'News' THEN f1_macro END) AS nm,
         max(CASE WHEN domain = 'Reddit' THEN f1_weighted END) AS rw, max(CASE WHEN domain = 'News' THEN f1_weighted END) AS nw
  FROM totals GROUP BY model),
compared AS (
  SELECT model, round(ra, 6) AS reddit_accuracy, round(na, 6) AS news_accuracy, round(rm, 6) AS reddit_f1_macro, round(nm, 6) AS news_f1_macro,
         round(rw, 6) AS reddit_f1_weighted, round(nw, 6) AS news_f1_weighted, round(abs(ra - na), 6) AS accuracy_diff,
         round(abs(rm - nm), 6) AS f1_macro_diff, round(abs(rw - nw), 6) AS f1_weighted_diff,
         CASE WHEN ra > na THEN 'Reddit' ELSE 'News' END AS better_domain,
         round((greatest(ra, na) - least(ra, na)) / least(ra, na) * 100, 6) AS improvement_pct
  FROM wide)"""
)


@query("E17_compare_domains", "WITH " + COMPARED + " SELECT * FROM compared")
def _(spark, sf):
    return rounded(M.compare_domains(M.overall(I.scored(spark, sf), "binary_label", "predicted_binary", BY)))


@query(
    "E18_model_grid",
    "WITH " + COMPARED + " SELECT model, reddit_accuracy AS reddit_acc, news_accuracy AS news_acc, "
    "reddit_f1_macro AS reddit_f1, news_f1_macro AS news_f1 FROM compared",
)
def _(spark, sf):
    return rounded(M.model_grid(M.overall(I.scored(spark, sf), "binary_label", "predicted_binary", BY)))


# --- deduplication and splits -------------------------------------------------------------------------


@query(
    "F1_dedupe_first",
    "WITH " + I.SENTENCES + " SELECT split, text, source, pos_folder, label, num_words, num_metaphors FROM firsts",
)
def _(spark, sf):
    columns = ["split", "text", "source", "pos_folder", "label", "num_words", "num_metaphors"]
    return jobs.sentence_corpus(I.corpus_words(spark, sf)).select(*columns)


@query(
    "F1_dedupe_first_documents",
    "SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1",
)
def _(spark, sf):
    return D.dedupe_first(I.documents(spark, sf), "text", "doc_id")


@query(
    "F1_dedupe_arrivals",
    """WITH firsts AS (SELECT doc_id, text FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1)
SELECT count(*)::BIGINT AS n, sum(doc_id)::BIGINT AS ids, sum(length(text))::BIGINT AS chars, true AS as_at_once FROM firsts""",
)
def _(spark, sf):
    """Four deliveries in a mixed order against the index, one of them twice: the same rows as all at once."""
    docs, index = I.documents(spark, sf), scratch_path(spark, "arrivals")
    shown = []
    for part in (2, 0, 2, 3, 1):
        own = docs.where(F.col("doc_id") % 4 == part)
        shown.append(D.dedupe_arrivals(own, index, f"part-{part}").select("doc_id", "text", "replaces"))
    shown = union_sources(shown).distinct()
    replaced = shown.where("replaces IS NOT NULL").select(F.col("replaces").alias("doc_id"))
    left = shown.join(replaced, "doc_id", "left_anti")
    firsts = D.first_arrivals(spark, index).agg(F.count("*").alias("m"), F.sum("first").alias("firsts"))
    totals = left.agg(
        F.count("*").alias("n"), F.sum("doc_id").alias("ids"), F.sum(F.length("text")).cast("bigint").alias("chars")
    )
    return totals.join(firsts, F.col("n") == F.col("m")).select("n", "ids", "chars", (F.col("ids") == F.col("firsts")).alias("as_at_once"))


@query("F2_dedupe_url_title", "WITH " + I.NEWS + " SELECT page_id, url, title_key AS title FROM pass2")
def _(spark, sf):
    pages = I.news_pages(spark, sf).withColumn("title", normalize_title(page_title("html")))
    return D.dedupe_url_title(pages.select("page_id", "source", "url", "title"), "page_id").select("page_id", "url", "title")


HELD_OUT = (
    I.ANNOTATIONS
    + """, c AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total FROM ann GROUP BY 1),
k AS (SELECT *, (total - ceil(0.1::DOUBLE * total))::BIGINT AS kept FROM c),
q AS (SELECT *, (n * kept) // total AS base, (n * kept) % total AS rest FROM k),
r AS (SELECT *, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label DESC) <= kept - sum(base) OVER () THEN 1 ELSE 0 END AS train_n FROM q),
ranked AS (SELECT ann.*, row_number() OVER (PARTITION BY label ORDER BY md5('7:' || doc_id), doc_id) AS rk FROM ann)"""
)


@query(
    "F3_stratified_split",
    "WITH " + HELD_OUT + " SELECT doc_id, ranked.label, CASE WHEN rk <= train_n THEN 'train' ELSE 'val' END AS split "
    "FROM ranked JOIN r USING (label)",
)
def _(spark, sf):
    return stratified_split(I.annotations(spark, sf).select("doc_id", "label"), "label", 0.1, seed=7)


@query("F4_split_60_20_20", "WITH " + SPLIT_60_20_20 + " SELECT doc_id, binary_label, split FROM split")
def _(spark, sf):
    return split_rows(spark, sf).select("doc_id", "binary_label", "split")


_SAMPLES = (
    I.PREDICTIONS
    + """, samples AS (
  SELECT model, domain, binary_label, original_label, predicted_binary, doc_id,
         CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS excerpt,
         row_number() OVER (PARTITION BY model, domain, binary_label, original_label ORDER BY doc_id)::INTEGER AS sample
  FROM pred WHERE NOT correct QUALIFY sample <= 3)"""
)


@query("F5_error_samples", "WITH " + _SAMPLES + " SELECT * FROM samples")
def _(spark, sf):
    return R.error_samples(I.scored(spark, sf), by=BY)


@query(
    "F6_cap_per_group",
    "WITH " + I.REVIEWS + " SELECT movie_id, page, pos, review_title FROM reviews "
    "QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY page, pos) <= 3",
)
def _(spark, sf):
    reviews = parse_reviews(I.review_pages(spark, sf), "json", "page")
    return R.cap_per_group(reviews, "movie_id", ["page", "pos"], 3).select("movie_id", "page", "pos", "review_title")


@query(
    "F7_assign_batches",
    "WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS k FROM documents) "
    "SELECT doc_id, k // 10 AS batch_id, (k % 10)::INTEGER AS batch_pos FROM n",
)
def _(spark, sf):
    return R.assign_batches(I.documents(spark, sf).select("doc_id"), "doc_id")


@query(
    "F8_best",
    "WITH " + I.CLASS_SCORES + " SELECT model, domain, round(f1_macro, 6) AS f1_macro FROM totals ORDER BY round(f1_macro, 6) DESC, model, domain LIMIT 1",
)
def _(spark, sf):
    metrics = rounded(M.overall(I.scored(spark, sf), "binary_label", "predicted_binary", BY))
    return R.best(metrics, "f1_macro", F.struct("model", "domain")).select("model", "domain", "f1_macro")


# --- sorts, limits, unions ----------------------------------------------------------------------------


@query(
    "G1_shuffle_rows",
    "SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS position FROM documents",
)
def _(spark, sf):
    # The position is read off the sorted rows: rows before the partition plus the place in it.
    ordered = R.shuffle_rows(I.documents(spark, sf).select("doc_id"))
    return _positions(ordered)


def _positions(ordered):
    """1-based position of every row of a globally sorted frame, without a single-task window."""
    from corpusloom.session import materialize

    placed = materialize(
        ordered.withColumn("_part", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()), "sorted"
    )
    inside = F.col("_i") - F.shiftleft(F.col("_part").cast("bigint"), 33)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    from pyspark.sql import Window as W

    before = F.sum("_n").over(W.partitionBy(F.lit(0)).orderBy("_part")) - F.col("_n")  # one row per task
    offsets = sizes.select("_part", before.alias("_before"))
    return placed.join(F.broadcast(offsets), "_part").select(
        *[c for c in ordered.columns], (F.col("_before") + inside + 1).alias("position")
    )


@query("G2_sort_counts", "SELECT source, count(*) AS count FROM documents GROUP BY source")
def _(spark, sf):
    return E.sort_counts(I.documents(spark, sf).groupBy("source").agg(F.count("*").alias("count")), "source")


@query(
    "G3_limit_per_source",
    "WITH " + I.FORUM + " SELECT url, source, type FROM frows QUALIFY row_number() OVER (PARTITION BY source, type ORDER BY conv_id, turn) <= 20",
)
def _(spark, sf):
    posts, comments = I.forum(spark, sf)
    keys = ("conv_id", "turn")
    rows = union_sources([to_post_rows(posts, keys), to_comment_rows(comments, keys)])
    return R.limit_per_source(rows, 40, list(keys)).select("url", "source", "type")


@query(
    "G4_order_by_helpfulness",
    "WITH " + I.REVIEWS + " SELECT movie_id, page, pos, upvotes, row_number() OVER (ORDER BY movie_id, upvotes DESC, page, pos) AS position FROM reviews",
)
def _(spark, sf):
    reviews = parse_reviews(I.review_pages(spark, sf), "json", "page").select("movie_id", "page", "pos", "upvotes")
    return _positions(R.order_by_helpfulness(reviews))


@query(
    "H1_union_sources",
    "SELECT 'documents' AS source, doc_id AS id, lang, NULL::VARCHAR AS role FROM documents "
    "UNION ALL SELECT 'conversations', conv_id, NULL, role FROM conversations",
)
def _(spark, sf):
    docs = I.documents(spark, sf).select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"), "lang")
    turns = I.table(spark, sf, "conversations").select(
        F.lit("conversations").alias("source"), F.col("conv_id").alias("id"), "role"
    )
    return union_sources([docs, turns])


@query("H2_distinct_sentences", "WITH " + I.WORDS + " SELECT DISTINCT sentence FROM words")
def _(spark, sf):
    return distinct_sentences(I.corpus_words(spark, sf))
