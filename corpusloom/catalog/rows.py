"""Queries for filters, projections, joins and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import inputs as I
from corpusloom.catalog.registry import query
from corpusloom.catalog.scans import rounded
from corpusloom.functions import normalize as N
from corpusloom.functions import scores as P
from corpusloom.functions import text as T
from corpusloom.functions import tokens as K
from corpusloom.operators import annotation as A
from corpusloom.operators import filters as C
from corpusloom.operators import joins as J
from corpusloom.operators import long_texts as L
from corpusloom.operators import vocabulary as V
from corpusloom.operators.sets import union_sources
from corpusloom.sources.documents import parse_reviews

# --- filters and projections --------------------------------------------------------------------------


@query(
    "C1_min_length",
    """SELECT 'any' AS rule, doc_id FROM documents WHERE length(text) > 10
UNION ALL SELECT 'posts', doc_id FROM documents WHERE length(trim(text, E' \\n\\r\\t')) >= 50
UNION ALL SELECT 'comments', doc_id FROM documents WHERE length(text) >= 50
UNION ALL SELECT 'articles', doc_id FROM documents WHERE length(text) >= 500""",
)
def _(spark, sf):
    docs = I.documents(spark, sf)
    rules = (("any", 11, False), ("posts", 50, True), ("comments", 50, False), ("articles", 500, False))
    return union_sources(
        [C.min_length(docs, "text", n, s).select(F.lit(rule).alias("rule"), "doc_id") for rule, n, s in rules]
    )


@query("C2_to_binary", "WITH " + I.ANNOTATIONS + " SELECT doc_id, label, binary_label FROM ann")
def _(spark, sf):
    return C.to_binary(I.annotations(spark, sf)).select("doc_id", "label", "binary_label")


@query(
    "C3_encode_decode_label",
    "WITH " + I.ANNOTATIONS + " SELECT doc_id, CASE binary_label WHEN 'literal' THEN 0 ELSE 1 END AS label_id, "
    "binary_label AS decoded FROM ann",
)
def _(spark, sf):
    rows = C.encode_label(C.to_binary(I.annotations(spark, sf)), "binary_label")
    return C.decode_label(rows, "label_id", "decoded").select("doc_id", "label_id", "decoded")


@query("C4_keep_labels", "WITH " + I.ANNOTATIONS + " SELECT doc_id, label FROM ann WHERE label IN ('literal', 'metaphor')")
def _(spark, sf):
    return C.keep_labels(I.annotations(spark, sf), ("literal", "metaphor")).select("doc_id", "label")


@query(
    "C5_drop_invalid",
    "WITH "
    + I.ANNOTATIONS
    + """ SELECT doc_id, CASE label WHEN 'literal' THEN 0 ELSE 1 END AS label_id,
  (SELECT count(*) FROM ann WHERE label NOT IN ('literal', 'metaphor')) AS invalid FROM ann WHERE label IN ('literal', 'metaphor')""",
)
def _(spark, sf):
    rows = C.encode_label(I.annotations(spark, sf), "label", labels=("literal", "metaphor"))
    dropped = C.invalid_count(rows).select("invalid").scalar()
    return C.drop_invalid(rows).select("doc_id", "label_id", dropped.alias("invalid"))


@query(
    "C6_harmonise",
    "WITH "
    + I.REVIEWS
    + r""" SELECT 'imdb' AS domain, movie_id || '/' || page || '/' || pos AS id,
  trim(coalesce(review_title, '') || ' ' || coalesce(review_body, ''), E' \n\r\t') AS text FROM reviews
UNION ALL SELECT 'news', doc_id::VARCHAR, CASE WHEN doc_id % 7 = 0 THEN '' ELSE text END FROM documents
UNION ALL SELECT 'reddit', doc_id::VARCHAR, text FROM documents""",
)
def _(spark, sf):
    reviews = parse_reviews(I.review_pages(spark, sf), "json", "page").withColumn(
        "id", F.concat_ws("/", "movie_id", "page", "pos")
    )
    docs = I.documents(spark, sf).withColumn("id", F.col("doc_id").cast("string"))
    news = docs.withColumn("text", F.when(F.col("doc_id") % 7 != 0, F.col("text")))
    return union_sources(
        [
            C.harmonise(df, name).select(F.lit(name).alias("domain"), "id", "text")
            for name, df in (("imdb", reviews), ("news", news), ("reddit", docs))
        ]
    )


@query(
    "C7_pick_text",
    "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text WHEN doc_id % 3 = 1 THEN lang ELSE source END AS text FROM documents",
)
def _(spark, sf):
    key = F.col("doc_id") % 3
    docs = I.documents(spark, sf).select(
        "doc_id",
        F.when(key == 0, F.col("text")).when(key == 1, "").alias("text"),
        F.when(key == 1, F.col("lang")).alias("body"),
        F.col("source").alias("review_body"),
    )
    return C.pick_text(docs).select("doc_id", "text")


@query(
    "C8_keep_language",
    "WITH " + I.NEWS + " SELECT page_id, meta_lang FROM (SELECT page_id, CASE WHEN page_id % 11 = 0 THEN NULL "
    "WHEN page_id % 11 = 1 THEN '' WHEN page_id % 11 = 2 THEN upper(meta_lang) ELSE meta_lang END AS meta_lang FROM art) "
    "WHERE meta_lang IS NULL OR meta_lang = '' OR lower(meta_lang) = 'en'",
)
def _(spark, sf):
    lang = F.regexp_extract("html", r'<html[^>]*\blang="([^"]*)"', 1)
    key = F.col("page_id") % 11
    said = F.when(key == 0, F.lit(None)).when(key == 1, "").when(key == 2, F.upper(lang)).otherwise(lang)
    pages = I.news_pages(spark, sf).select("page_id", said.alias("meta_lang"))
    return C.keep_language(pages, "meta_lang")


@query(
    "C9_recent",
    "WITH " + I.NEWS + " SELECT 'timestamp' AS kind, page_id FROM np WHERE publish_ts > TIMESTAMP '2024-06-30 12:00:00' - INTERVAL 32 DAYS "
    "UNION ALL SELECT 'string', page_id FROM np WHERE page_id % 8 <> 3 AND "
    "date_trunc('day', publish_ts) > TIMESTAMP '2024-06-30 12:00:00' - INTERVAL 32 DAYS",
)
def _(spark, sf):
    pages = I.news_pages(spark, sf)
    text = F.when(F.col("page_id") % 8 == 3, "soon").otherwise(F.date_format("publish_ts", "yyyy-MM-dd'T'HH:mm:ss"))
    as_text = pages.select("page_id", text.alias("published"))
    return union_sources(
        [
            C.recent(pages, "publish_ts", I.AS_OF).select(F.lit("timestamp").alias("kind"), "page_id"),
            C.recent(as_text, "published", I.AS_OF).select(F.lit("string").alias("kind"), "page_id"),
        ]
    )


@query("C10_drop_blank", "SELECT doc_id FROM documents WHERE doc_id % 11 <> 3 AND doc_id % 11 <> 5 AND trim(text, E' \\n\\r\\t') <> ''")
def _(spark, sf):
    rows = I.annotation_rows(spark, sf)
    some = rows.withColumn("content", F.when(F.col("row_id") % 11 != 5, F.col("content")))
    return C.drop_blank(some, "content").select(F.col("row_id").alias("doc_id"))


@query("C11_search", "SELECT doc_id FROM documents WHERE contains(lower(text), 'the re')")
def _(spark, sf):
    return C.search(I.documents(spark, sf), "The Re").select("doc_id")


@query(
    "C12_attach_predictions",
    "WITH " + I.PREDICTIONS + " SELECT doc_id, model, predicted_binary, round(p0, 6) AS prob_literal, "
    "round(p1, 6) AS prob_figurative, round(greatest(p0, p1), 6) AS confidence, correct FROM pred",
)
def _(spark, sf):
    columns = ["doc_id", "model", "predicted_binary", "prob_literal", "prob_figurative", "confidence", "correct"]
    return rounded(I.scored(spark, sf).select(*columns))


@query("C13_model_columns", "WITH " + I.ANNOTATIONS + " SELECT text, CASE binary_label WHEN 'literal' THEN 0 ELSE 1 END AS labels FROM ann")
def _(spark, sf):
    return C.model_columns(C.encode_label(C.to_binary(I.annotations(spark, sf)), "binary_label"))


@query(
    "C14_flags_to_label",
    """SELECT doc_id, CASE WHEN quality = 1 AND toxic = 1 THEN 'both' WHEN quality = 1 THEN 'metaphor'
  WHEN toxic = 1 THEN 'irony' ELSE 'literal' END AS label FROM labels""",
)
def _(spark, sf):
    return C.flags_to_label(I.table(spark, sf, "labels"), "quality", "toxic").select("doc_id", "label")


# --- joins --------------------------------------------------------------------------------------------


@query(
    "D1_lookup",
    "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def _(spark, sf):
    dim = I.table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = J.lookup(I.table(spark, sf, "customer"), dim, "c_nationkey")
    return rows.select("c_custkey", "n_name")


@query("D2_align_answers", "WITH " + I.REQUESTS + " SELECT row_id, batch_id, label_metaphor, label_irony FROM aligned")
def _(spark, sf):
    requests = A.annotation_requests(I.annotation_rows(spark, sf))
    answers = A.parse_answers(I.responses(requests)).select("batch_id", "answers")
    aligned = J.align_answers(requests, answers)
    return aligned.select("row_id", "batch_id", "answer.label_metaphor", "answer.label_irony")


@query("D3_pending", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark, sf):
    return J.pending(I.documents(spark, sf), I.table(spark, sf, "labels"), "doc_id").select("doc_id")


@query(
    "D4_join_predictions",
    "WITH " + I.PREDICTIONS + " SELECT doc_id, model, original_label, predicted_binary FROM pred",
)
def _(spark, sf):
    predicted = I.scored(spark, sf).select("doc_id", "model", "predicted_binary")
    rows = J.join_predictions(I.annotations(spark, sf), predicted)
    return rows.select("doc_id", "model", F.col("label").alias("original_label"), "predicted_binary")


@query(
    "D5_with_totals",
    "WITH " + I.ANNOTATIONS + " SELECT label, count(*) AS n, (sum(count(*)) OVER ())::BIGINT AS total, "
    "count(*) OVER () AS n_classes FROM ann GROUP BY label",
)
def _(spark, sf):
    return J.with_totals(I.annotations(spark, sf), "label")


# --- scalar, array and JSON functions -----------------------------------------------------------------


@query("I1_token_count", "SELECT doc_id, " + I.TOKENS.format("text") + " AS tokens FROM documents")
def _(spark, sf):
    return I.documents(spark, sf).select("doc_id", K.token_count("text").cast("bigint").alias("tokens"))


@query("I2_char_word_count", "SELECT doc_id, length(text)::BIGINT AS chars, " + I.TOKENS.format("text") + " AS words FROM documents")
def _(spark, sf):
    return I.documents(spark, sf).select(
        "doc_id", K.char_count("text").cast("bigint").alias("chars"), K.word_count("text").cast("bigint").alias("words")
    )


@query(
    "I3_truncate",
    r"""WITH t AS (SELECT doc_id, text, regexp_extract_all(text, '\S+') AS tk FROM documents)
SELECT doc_id,
  CASE WHEN len(tk) > 510 THEN array_to_string(tk[1:510], ' ') ELSE text END AS head,
  CASE WHEN len(tk) > 510 THEN array_to_string(tk[len(tk) - 509:], ' ') ELSE text END AS tail,
  CASE WHEN len(tk) > 510 THEN array_to_string(tk[(len(tk) - 510) // 2 + 1:(len(tk) - 510) // 2 + 510], ' ') ELSE text END AS middle
FROM t""",
)
def _(spark, sf):
    docs = I.documents(spark, sf).withColumn("_t", K.WHITESPACE.tokens("text"))
    return docs.select(
        "doc_id", *[T.truncate("text", strategy=s, tokens=F.col("_t")).alias(s) for s in ("head", "tail", "middle")]
    )


SMART = r"""pieces AS (
  SELECT doc_id, unnest(string_split(text, '. ')) || '. ' AS piece, generate_subscripts(string_split(text, '. '), 1) AS pos
  FROM documents),
running AS (
  SELECT doc_id, pos, piece, sum(len(regexp_extract_all(piece, '\S+'))) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM pieces),
kept AS (SELECT doc_id, trim(string_agg(piece, '' ORDER BY pos), E' \n\r\t') AS kept FROM running WHERE upto <= 510 GROUP BY doc_id),
smart AS (
  SELECT d.*, regexp_extract_all(text, '\S+') AS tk,
         CASE WHEN len(tk) <= 510 THEN text WHEN kept IS NULL THEN array_to_string(tk[1:510], ' ') ELSE kept END AS cut
  FROM documents d LEFT JOIN kept USING (doc_id))"""


@query("I4_smart_truncate", "WITH " + SMART + " SELECT doc_id, cut AS text FROM smart")
def _(spark, sf):
    return I.documents(spark, sf).select("doc_id", T.smart_truncate("text").alias("text"))


CHUNKS = r"""t AS (SELECT doc_id, text, regexp_extract_all(text, '\S+') AS tk FROM documents),
starts AS (
  SELECT *, unnest(range(0, CASE WHEN len(tk) <= 510 THEN 1 ELSE ceil((len(tk) - 510) / 460.0)::BIGINT + 1 END)) AS i FROM t),
chunks AS (
  SELECT doc_id, i::INTEGER AS chunk_pos,
         CASE WHEN len(tk) <= 510 THEN text ELSE array_to_string(tk[i * 460 + 1:i * 460 + 510], ' ') END AS text
  FROM starts)"""


@query("I5_chunk", "WITH " + CHUNKS + " SELECT * FROM chunks")
def _(spark, sf):
    return L.chunk(I.documents(spark, sf).select("doc_id", "text"))


HEAD_TAIL = r"""ht AS (
  SELECT doc_id, text, regexp_extract_all(text, '\S+') AS tk,
         CASE WHEN len(tk) > 450 THEN array_to_string(tk[1:337], ' ') || ' ... ' || array_to_string(tk[len(tk) - 112:], ' ')
              ELSE text END AS by_token
  FROM documents)"""


@query(
    "I6_head_tail",
    "WITH "
    + HEAD_TAIL
    + r""", s AS (
  SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))) AS sent,
         generate_subscripts(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), 1) AS pos
  FROM ht WHERE len(tk) > 450),
c AS (
  SELECT *, sum(len(regexp_extract_all(sent, '\S+'))) OVER (PARTITION BY doc_id ORDER BY pos) AS upto,
         sum(len(regexp_extract_all(sent, '\S+'))) OVER (PARTITION BY doc_id ORDER BY pos DESC) AS back
  FROM s),
j AS (
  SELECT doc_id, string_agg(sent, ' ' ORDER BY pos) FILTER (upto <= 337) AS h,
         string_agg(sent, ' ' ORDER BY pos) FILTER (back <= 113) AS t
  FROM c GROUP BY doc_id)
SELECT doc_id, by_token,
  CASE WHEN len(tk) <= 450 THEN text WHEN h IS NULL AND t IS NULL THEN by_token
       ELSE concat_ws(' ', h, '...', t) END AS by_sentence
FROM ht LEFT JOIN j USING (doc_id)""",
)
def _(spark, sf):
    return I.documents(spark, sf).select(
        "doc_id", T.head_tail("text").alias("by_token"), T.head_tail("text", mode="sentence").alias("by_sentence")
    )


@query(
    "I7_ellipsize",
    "SELECT doc_id, CASE WHEN length(text) > 2000 THEN substr(text, 1, 2000) || '...' ELSE text END AS long, "
    "CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS short FROM documents",
)
def _(spark, sf):
    return I.documents(spark, sf).select(
        "doc_id", T.ellipsize("text", 2000).alias("long"), T.ellipsize("text", 100).alias("short")
    )


@query("I8_normalize_url", "WITH " + I.NEWS + " SELECT page_id, url_key FROM art")
def _(spark, sf):
    return I.news_pages(spark, sf).select("page_id", N.normalize_url("url").alias("url_key"))


@query(
    "I9_normalize_title",
    r"SELECT doc_id, lower(trim(coalesce(CASE WHEN doc_id % 5 <> 0 THEN '  ' || text END, ''), E' \n\r\t')) AS title_key FROM documents",
)
def _(spark, sf):
    title = F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("  "), F.col("text")))
    return I.documents(spark, sf).select("doc_id", N.normalize_title(title).alias("title_key"))


@query(
    "I10_dates",
    """SELECT event_id, CASE WHEN event_id % 10 <> 4 THEN strftime(ts, '%Y-%m-%d') END AS day,
  strftime(make_timestamp((1700000000 + event_id) * 1000000), '%Y-%m-%d %H:%M:%S') AS created FROM events""",
)
def _(spark, sf):
    iso = F.when(F.col("event_id") % 10 == 4, "20th of May").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    created = N.epoch_to_ts(F.col("event_id") + 1_700_000_000)
    return I.table(spark, sf, "events").select(
        "event_id",
        N.format_date(N.parse_date(iso)).alias("day"),
        F.date_format(created, "yyyy-MM-dd HH:mm:ss").alias("created"),
    )


@query(
    "I11_age_days",
    "SELECT event_id, floor((epoch_us(TIMESTAMP '2024-01-20 00:00:00') - epoch_us(ts)) / 86400000000.0)::BIGINT AS age FROM events",
)
def _(spark, sf):
    return I.table(spark, sf, "events").select("event_id", N.age_days("ts", "2024-01-20 00:00:00").alias("age"))


_LOGITS = """v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS a FROM embeddings),
e AS (SELECT *, list_transform(a, lambda x: exp(x - list_max(a))) AS ex FROM v)"""


def _vectors(spark, sf):
    return I.table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").alias("logits"))


@query(
    "I12_softmax",
    "WITH " + _LOGITS + " SELECT vec_id, unnest(range(1, len(a) + 1))::INTEGER AS k, round(unnest(list_transform(ex, lambda x: x / list_sum(ex))), 6) AS p FROM e",
)
def _(spark, sf):
    probs = _vectors(spark, sf).select("vec_id", F.posexplode(P.softmax("logits")).alias("k", "p"))
    return rounded(probs.withColumn("k", F.col("k") + 1))


@query("I13_argmax_label", "WITH " + _LOGITS + " SELECT vec_id, 'c' || (list_position(a, list_max(a)) - 1) AS label FROM v")
def _(spark, sf):
    return _vectors(spark, sf).select("vec_id", P.argmax_label("logits", [f"c{i}" for i in range(64)]).alias("label"))


@query("I14_confidence", "WITH " + _LOGITS + " SELECT vec_id, round(1 / list_sum(ex), 6) AS confidence FROM e")
def _(spark, sf):
    probs = _vectors(spark, sf).withColumn("p", P.softmax("logits"))
    return rounded(probs.select("vec_id", P.confidence("p").alias("confidence")))


@query("I15_is_correct", "WITH " + _LOGITS + " SELECT vec_id, label = list_position(a, list_max(a)) - 1 AS correct FROM v")
def _(spark, sf):
    return _vectors(spark, sf).select("vec_id", P.is_correct("label", P.argmax("logits")).alias("correct"))


BIN = """CASE WHEN {0} <= 0 THEN NULL WHEN {0} <= 128 THEN '0-128' WHEN {0} <= 256 THEN '128-256' WHEN {0} <= 384 THEN '256-384'
  WHEN {0} <= 512 THEN '384-512' WHEN {0} <= 1024 THEN '512-1024' WHEN {0} <= 2048 THEN '1024-2048' ELSE '2048+' END"""


@query(
    "I16_length_bin",
    "WITH t AS (SELECT doc_id, " + I.TOKENS.format("text") + " AS tk FROM documents) SELECT doc_id, " + BIN.format("tk") + " AS token_bin FROM t",
)
def _(spark, sf):
    return I.documents(spark, sf).select("doc_id", T.length_bin(K.token_count("text")).alias("token_bin"))


@query(
    "I17_truncation_record",
    "WITH "
    + SMART
    + r""" SELECT doc_id, cut AS text, length(text)::BIGINT AS original_chars, length(cut)::BIGINT AS final_chars,
  len(tk)::BIGINT AS original_tokens, len(regexp_extract_all(cut, '\S+'))::BIGINT AS final_tokens, len(tk) > 510 AS was_truncated FROM smart""",
)
def _(spark, sf):
    rows = L.with_truncation_record(I.documents(spark, sf))
    return rows.select("doc_id", "record.*")


@query(
    "I18_build_prompts",
    "WITH "
    + I.REQUESTS
    + r""" SELECT batch_id, count(*)::INTEGER AS n_texts,
  string_agg('
--- TEXT ' || (pos + 1) || ' ---
' || text || '
', '' ORDER BY pos) AS body FROM requests GROUP BY batch_id""",
)
def _(spark, sf):
    prompts = A.build_prompts(A.annotation_requests(I.annotation_rows(spark, sf)))
    body = F.substr("prompt", F.lit(len(A.INSTRUCTION) + 1))
    return prompts.select("batch_id", "n_texts", body.alias("body"))


@query(
    "I19_parse_answers",
    "WITH "
    + I.REQUESTS
    + """, b AS (SELECT batch_id, row_id, pos, n_texts FROM requests)
SELECT batch_id, (row_id % 2 = 0)::INTEGER AS label_metaphor, (row_id % 3 = 0)::INTEGER AS label_irony,
  CASE WHEN row_id % 4 <> 1 THEN 'r' || row_id ELSE '' END AS reasoning
FROM b WHERE batch_id % 7 <> 3 AND (batch_id % 7 <> 5 OR pos < n_texts - 1) AND (batch_id % 7 <> 6 OR pos = 0)""",
)
def _(spark, sf):
    parsed = A.parse_answers(I.responses(A.annotation_requests(I.annotation_rows(spark, sf))))
    return parsed.select("batch_id", F.explode("answers").alias("a")).select("batch_id", "a.*")


@query(
    "I20_get_path",
    "WITH " + I.REVIEWS + " SELECT movie_id, page, sum(coalesce(upvotes, 0))::BIGINT AS upvotes, "
    "count(review_body) AS bodies FROM rv GROUP BY movie_id, page",
)
def _(spark, sf):
    from corpusloom import schemas

    parsed = I.review_pages(spark, sf).withColumn("r", F.from_json("json", schemas.REVIEWS_JSON))
    edges = parsed.select("movie_id", "page", F.explode(N.get_path("r", "data.title.reviews.edges")).alias("e"))
    return edges.groupBy("movie_id", "page").agg(
        F.sum(N.get_path("e", "node.helpfulness.upVotes", 0)).alias("upvotes"),
        F.count(N.get_path("e", "node.text.originalText.plainText")).alias("bodies"),
    )


@query(
    "I21_encode_fixed",
    r"""WITH t AS (SELECT doc_id, regexp_extract_all(text, '\S+')[1:512] AS tk FROM documents)
SELECT doc_id, 512 AS n_ids, len(tk)::BIGINT AS n_real,
  md5(array_to_string(list_transform(tk, lambda x: list_position(tk, x)), ',')) AS pattern, true AS padded FROM t""",
)
def _(spark, sf):
    """Ids repeat just where tokens do, and what lies beyond the text is padding."""
    rows = L.encode_fixed(I.documents(spark, sf).select("doc_id", "text"), buckets=2**31 - 2)
    total = F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("bigint")
    rows = rows.withColumn("n_real", total).withColumn("own", F.expr("slice(input_ids, 1, int(n_real))"))
    firsts = F.transform("own", lambda x: F.array_position(F.col("own"), x).cast("string"))
    padding = F.expr("forall(slice(input_ids, int(n_real) + 1, 512), x -> x = 0)")
    return rows.select(
        "doc_id", F.size("input_ids").alias("n_ids"), "n_real", F.md5(F.array_join(firsts, ",").cast("binary")).alias("pattern"),
        padding.alias("padded"),
    )


_SPLIT_WORDS = r"""w AS (SELECT doc_id, regexp_extract_all(text, '\S+') AS tk FROM documents),
v AS (SELECT token, n, (row_number() OVER (ORDER BY n DESC, token) + 1)::INTEGER AS id FROM
  (SELECT token, count(*) AS n FROM (SELECT unnest(tk) AS token FROM w) GROUP BY 1) ORDER BY n DESC, token LIMIT 5000)"""


@query("I21_vocabulary", "WITH " + _SPLIT_WORDS + " SELECT token, n, id FROM v")
def _(spark, sf):
    return V.build_vocabulary(I.documents(spark, sf), size=5000)


@query(
    "I21_encode_vocabulary",
    "WITH "
    + _SPLIT_WORDS
    + """, t AS (SELECT doc_id, unnest(tk[1:512]) AS token, generate_subscripts(tk[1:512], 1) AS pos FROM w),
e AS (SELECT doc_id, string_agg(coalesce(id, 1)::VARCHAR, ',' ORDER BY pos) AS ids, count(*) AS n_real FROM t LEFT JOIN v USING (token) GROUP BY 1)
SELECT doc_id, md5(coalesce(ids, '')) AS ids, coalesce(n_real, 0)::BIGINT AS n_real, 512 AS n_ids, true AS padded FROM documents LEFT JOIN e USING (doc_id)""",
)
def _(spark, sf):
    docs = I.documents(spark, sf)
    rows = V.encode_vocabulary(docs.select("doc_id", "text"), V.build_vocabulary(docs, size=5000))
    total = F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("bigint")
    own = F.expr("array_join(transform(slice(input_ids, 1, int(n_real)), x -> string(x)), ',')")
    return rows.withColumn("n_real", total).select(
        "doc_id", F.md5(own.cast("binary")).alias("ids"), "n_real", F.size("input_ids").alias("n_ids"),
        F.expr("forall(slice(input_ids, int(n_real) + 1, 512), x -> x = 0)").alias("padded"),
    )


@query(
    "I22_pick_sentiment",
    "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang ELSE n_chars::VARCHAR END AS original_sentiment FROM documents",
)
def _(spark, sf):
    rows = I.documents(spark, sf).select(
        "doc_id",
        F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("sentiment"),
        F.col("n_chars").alias("rating"),
    )
    return C.pick_sentiment(rows).select("doc_id", "original_sentiment")


@query(
    "I23_split_sentences",
    r"""SELECT 'period' AS rule, doc_id, unnest(string_split(text, '. ')) AS sentence FROM documents
UNION ALL SELECT 'punctuation', doc_id, unnest(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))) FROM documents""",
)
def _(spark, sf):
    docs = I.documents(spark, sf)
    return union_sources(
        [
            docs.select(F.lit(rule).alias("rule"), "doc_id", F.explode(T.split_sentences("text", rule)).alias("sentence"))
            for rule in ("period", "punctuation")
        ]
    )
