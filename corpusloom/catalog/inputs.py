"""Inputs of the queries, derived by Spark from the given tables, with the same derivation in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.tokens import WHITESPACE
from corpusloom.schemas import CORPUS_FOLDERS, POS_FOLDERS

AS_OF = "2024-06-30 12:00:00"
TOKENS = r"len(regexp_extract_all({0}, '\S+'))::BIGINT"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


# --- annotations: documents with a four-class label ---------------------------------------------------


def annotations(spark: SparkSession, sf: str) -> DataFrame:
    q, t = F.col("quality") == 1, F.col("toxic") == 1
    label = F.when(q & t, "both").when(q, "metaphor").when(t, "irony").otherwise("literal")
    return documents(spark, sf).join(table(spark, sf, "labels"), "doc_id").withColumn("label", label)


ANNOTATIONS = """ann AS (
  SELECT d.*, l.quality, l.toxic,
         CASE WHEN quality = 1 AND toxic = 1 THEN 'both' WHEN quality = 1 THEN 'metaphor'
              WHEN toxic = 1 THEN 'irony' ELSE 'literal' END AS label,
         CASE WHEN quality = 0 AND toxic = 0 THEN 'literal' ELSE 'figurative' END AS binary_label
  FROM documents d JOIN labels l USING (doc_id))"""


# --- predictions: every annotation scored by three fixed formulas -------------------------------------

# The two divisors of each stand-in scorer.
SCORERS = (("alpha", 7, 5), ("beta", 3, 11), ("gamma", 13, 6))


def predictions(spark: SparkSession, sf: str, scorers=SCORERS) -> DataFrame:
    models = F.array(
        *[F.struct(F.lit(n).alias("model"), F.lit(a).alias("a"), F.lit(b).alias("b")) for n, a, b in scorers]
    )
    rows = annotations(spark, sf).withColumn("_m", F.explode(models))
    logits = F.array(
        (F.col("n_chars") % F.col("_m.a")).cast("double"), (F.col("n_chars") % F.col("_m.b")).cast("double")
    )
    return rows.select(
        "doc_id",
        F.col("_m.model").alias("model"),
        F.when(F.col("lang") == "en", "Reddit").otherwise("News").alias("domain"),
        "text",
        "label",
        logits.alias("logits"),
    )


def single_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """All models on all domains: ``doc_id, model, text, true_label, logits``."""
    from corpusloom.operators.filters import binary_label

    rows = predictions(spark, sf)
    return rows.withColumn("true_label", binary_label("label"))


def scored(spark: SparkSession, sf: str, scorers=SCORERS) -> DataFrame:
    from corpusloom.operators.filters import attach_predictions, to_binary

    return attach_predictions(to_binary(predictions(spark, sf, scorers).withColumn("original_label", F.col("label"))))


PREDICTIONS = (
    ANNOTATIONS
    + """, models(model, a, b) AS (VALUES ('alpha', 7, 5), ('beta', 3, 11), ('gamma', 13, 6)),
pred AS (
  SELECT doc_id, model, CASE WHEN lang = 'en' THEN 'Reddit' ELSE 'News' END AS domain, text,
         label AS original_label, binary_label, (n_chars % a)::DOUBLE AS x0, (n_chars % b)::DOUBLE AS x1,
         CASE WHEN x1 > x0 THEN 'figurative' ELSE 'literal' END AS predicted_binary,
         binary_label = predicted_binary AS correct,
         exp(x0 - greatest(x0, x1)) / (exp(x0 - greatest(x0, x1)) + exp(x1 - greatest(x0, x1))) AS p0,
         exp(x1 - greatest(x0, x1)) / (exp(x0 - greatest(x0, x1)) + exp(x1 - greatest(x0, x1))) AS p1
  FROM ann, models)"""
)

# Metrics per model and domain from the prediction rows.
CLASS_SCORES = (
    PREDICTIONS
    + """, cls AS (
  SELECT g.model, g.domain, c.class,
         count(*) FILTER (binary_label = class AND predicted_binary = class) AS tp,
         count(*) FILTER (binary_label = class) AS support,
         count(*) FILTER (predicted_binary = class) AS predicted
  FROM pred g, (VALUES ('literal'), ('figurative')) c(class) GROUP BY ALL),
scores AS (
  SELECT model, domain, class, support, tp,
         CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted::DOUBLE END AS prec,
         CASE WHEN support = 0 THEN 0 ELSE tp / support::DOUBLE END AS rec,
         CASE WHEN support + predicted = 0 THEN 0 ELSE 2 * tp / (support + predicted)::DOUBLE END AS f1
  FROM cls),
totals AS (
  SELECT model, domain, sum(tp) / sum(support)::DOUBLE AS accuracy, avg(f1) AS f1_macro,
         sum(f1 * support) / sum(support) AS f1_weighted, avg(prec) AS precision_macro, avg(rec) AS recall_macro,
         sum(prec * support) / sum(support) AS precision_weighted,
         sum(rec * support) / sum(support) AS recall_weighted,
         sum(support)::BIGINT AS total, sum(tp)::BIGINT AS correct
  FROM scores GROUP BY ALL)"""
)


# --- word-level corpus: sentences of the documents, one row per word ----------------------------------


def corpus_words(spark: SparkSession, sf: str) -> DataFrame:
    """Word rows tagged like a scan of the corpus folders. A word of twelve characters or more counts as metaphor."""
    number = F.regexp_extract("source", r"(\d+)", 1).cast("int")
    folder_rank = F.pmod(number, F.lit(len(CORPUS_FOLDERS)))
    is_pos = folder_rank == CORPUS_FOLDERS.index("VUA18_pos")
    pos_rank = F.when(is_pos, F.pmod("doc_id", F.lit(len(POS_FOLDERS))).cast("int")).otherwise(F.lit(-1))
    docs = documents(spark, sf).select(
        "doc_id",
        "text",
        F.get(F.array(*map(F.lit, CORPUS_FOLDERS)), folder_rank).alias("source"),
        folder_rank.alias("source_rank"),
        pos_rank.alias("pos_rank"),
        F.when(is_pos, F.get(F.array(*map(F.lit, POS_FOLDERS)), pos_rank)).alias("pos_folder"),
        F.when(F.col("doc_id") % 10 == 0, "test").otherwise("train").alias("split"),
    )
    tags = ["doc_id", "source", "source_rank", "pos_rank", "pos_folder", "split"]
    sentences = docs.select(*tags, F.explode(F.split("text", r"\. |\n+")).alias("sentence"))
    words = sentences.select(
        *tags, "sentence", F.posexplode(WHITESPACE.tokens("sentence")).alias("w_index", "target")
    )
    return words.withColumn("label", (F.length("target") >= 12).cast("int"))


WORDS = r"""docs AS (
  SELECT doc_id, text, regexp_extract(source, '(\d+)', 1)::INTEGER % 8 AS source_rank,
         ['VUA_MPD', 'VUA18', 'VUA18-', 'VUA20', 'VUA20-', 'VUAverb', 'VUAverb-', 'VUA18_pos'][source_rank + 1] AS source,
         CASE WHEN source_rank = 7 THEN (doc_id % 4)::INTEGER ELSE -1 END AS pos_rank,
         CASE WHEN source_rank = 7 THEN ['adj', 'adv', 'noun', 'verb'][pos_rank + 1] END AS pos_folder,
         CASE WHEN doc_id % 10 = 0 THEN 'test' ELSE 'train' END AS split
  FROM documents),
sents AS (SELECT * EXCLUDE (text), unnest(string_split_regex(text, '\. |\n+')) AS sentence FROM docs),
words AS (
  SELECT *, CASE WHEN length(target) >= 12 THEN 1 ELSE 0 END AS label
  FROM (SELECT *, unnest(regexp_extract_all(sentence, '\S+')) AS target FROM sents))"""

SENTENCES = (
    WORDS
    + """, sentences AS (
  SELECT split, source, pos_folder, source_rank, pos_rank, sentence AS text,
         CASE WHEN sum(label) > 0 THEN 'metaphor' ELSE 'literal' END AS label,
         count(*) AS num_words, sum(label)::BIGINT AS num_metaphors, sum(label) / count(*)::DOUBLE AS metaphor_ratio
  FROM words GROUP BY ALL),
firsts AS (
  SELECT * FROM sentences
  QUALIFY row_number() OVER (PARTITION BY split, text ORDER BY source_rank, pos_rank) = 1)"""
)


# --- news pages: the given pages, and altered copies that deduplication must find ---------------------


def news_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Every page three times: as it is, with another query or fragment, and under another path with a padded title."""
    pages = table(spark, sf, "pages").withColumn("source", F.concat(F.lit("s"), F.col("page_id") % 4))
    bare = F.regexp_replace("url", r"[?#].*$", "")
    again = pages.withColumns(
        {
            "page_id": F.col("page_id") + 1_000_000_000,
            "url": F.concat(F.lit("HTTP"), F.substr(bare, F.lit(5)), F.lit("?from=feed#top")),
        }
    )
    moved = pages.withColumns(
        {
            "page_id": F.col("page_id") + 2_000_000_000,
            "url": F.concat(bare, F.lit("/moved")),
            "html": F.replace("html", F.lit("<title>"), F.lit("<title>  ")),
        }
    )
    ts = F.lit(AS_OF).cast("timestamp") - F.make_interval(
        days=(F.col("page_id") % 60).cast("int"), hours=(F.col("page_id") % 5).cast("int")
    )
    return pages.unionByName(again).unionByName(moved).withColumn("publish_ts", ts)


NEWS = r"""np0 AS (
  SELECT page_id, url, html, 's' || (page_id % 4) AS source, regexp_replace(url, '[?#].*$', '') AS bare FROM pages),
np AS (
  SELECT *, TIMESTAMP '2024-06-30 12:00:00' - to_days((page_id % 60)::INTEGER) - to_hours(page_id % 5) AS publish_ts
  FROM (SELECT page_id, source, url, html FROM np0
        UNION ALL SELECT page_id + 1000000000, source, 'HTTP' || substr(bare, 5) || '?from=feed#top', html FROM np0
        UNION ALL SELECT page_id + 2000000000, source, bare || '/moved', replace(html, '<title>', '<title>  ') FROM np0)),
art0 AS (
  SELECT *, regexp_extract(html, '(?is)<article[^>]*>(.*)</article>', 1) AS inner_html,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(
           CASE WHEN inner_html <> '' THEN inner_html ELSE html END,
           '(?is)<head[^>]*>.*?</head>', ' ', 'g'), '(?is)<script[^>]*>.*?</script>', ' ', 'g'),
           '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g') AS b1,
         replace(replace(replace(replace(replace(replace(replace(replace(replace(
           regexp_replace(b1, '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
           '&#39;', ''''), '&apos;', ''''), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS b2,
         replace(replace(replace(replace(replace(replace(replace(replace(replace(
           regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
           '&#39;', ''''), '&apos;', ''''), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS t2
  FROM np),
art AS (
  SELECT page_id, source, url, html, publish_ts, trim(t2, E' \n\r\t') AS title,
         nullif(regexp_extract(html, '(?is)<html[^>]*\blang=["'']([^"'']*)["'']', 1), '') AS meta_lang,
         nullif(trim(regexp_replace(b2, '\s+', ' ', 'g'), E' \n\r\t'), '') AS text,
         lower(regexp_extract(url, '^[A-Za-z]+:')) || regexp_replace(substr(url, length(regexp_extract(url, '^[A-Za-z]+:')) + 1), '[?#].*$', '') AS url_key,
         lower(trim(t2, E' \n\r\t')) AS title_key
  FROM art0),
pass1 AS (SELECT * FROM art QUALIFY url_key = '' OR row_number() OVER (PARTITION BY source, url_key ORDER BY page_id) = 1),
pass2 AS (SELECT * FROM pass1 QUALIFY title_key = '' OR row_number() OVER (PARTITION BY source, title_key ORDER BY page_id) = 1)"""


# --- forum: conversations, the first turn as post -----------------------------------------------------


def forum(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.concat_ws("_", "role", F.floor(F.col("conv_id") / 50).cast("bigint")).alias("forum"),  # more with more rows
        F.substring("text", 1, 40).alias("title"),
        F.substring("text", 41, 1_000_000_000).alias("post_body"),
        F.col("text").alias("comment_body"),
        (F.col("conv_id") % 100).alias("score"),
        (F.lit(1_700_000_000) + F.col("conv_id") * 60 + F.col("turn")).alias("created_utc"),
        F.concat(F.lit("/r/"), "role", F.lit("/"), F.col("conv_id"), F.lit("/"), F.col("turn")).alias("permalink"),
    )
    posts = rows.where(F.col("turn") == 0).withColumn("body", F.col("post_body"))
    comments = rows.where(F.col("turn") > 0).withColumn("body", F.col("comment_body"))
    return posts, comments


FORUM = r"""frows AS (
  SELECT conv_id, turn, role,
         CASE WHEN turn > 0 THEN text
              WHEN substr(text, 41) = '' THEN substr(text, 1, 40)
              ELSE substr(text, 1, 40) || ' ' || substr(text, 41) END AS text,
         'reddit_' || role || '_' || (conv_id // 50) AS source, CASE WHEN turn = 0 THEN 'post' ELSE 'comment' END AS type,
         conv_id % 100 AS score, make_timestamp((1700000000 + conv_id * 60 + turn) * 1000000) AS timestamp,
         'https://reddit.com/r/' || role || '/' || conv_id || '/' || turn AS url
  FROM conversations)"""


# --- reviews: one landed JSON page per five turns of a conversation -----------------------------------


def review_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Landed pages ``(movie_id, movie_title, page, json)``; a page holds at most five reviews."""
    rows = table(spark, sf, "conversations").select("*", F.floor(F.col("turn") / 5).cast("bigint").alias("page"))
    empty_title, empty_body = F.col("turn") % 6 == 5, (F.col("turn") + F.col("conv_id")) % 3 == 2
    node = F.struct(
        (F.col("conv_id") % 10 + 1).alias("authorRating"),
        F.struct(F.when(~empty_title, F.substring("text", 1, 30)).alias("originalText")).alias("summary"),
        F.struct(F.struct(F.when(~empty_body, F.col("text")).alias("plainText")).alias("originalText")).alias("text"),
        F.struct(F.when(F.col("turn") % 4 != 3, F.length("text").cast("bigint")).alias("upVotes")).alias("helpfulness"),
    )
    edges = F.transform(
        F.array_sort(F.collect_list(F.struct("turn", F.struct(node.alias("node")).alias("edge")))), lambda e: e["edge"]
    )
    pages = rows.groupBy("conv_id", "page").agg(edges.alias("edges"))  # at most five rows per group
    info = F.struct(F.lit(True).alias("hasNextPage"), F.col("page").cast("string").alias("endCursor"))
    reviews = F.struct(F.col("edges").alias("edges"), info.alias("pageInfo"))
    data = F.struct(F.struct(F.struct(reviews.alias("reviews")).alias("title")).alias("data"))
    return pages.select(
        F.concat(F.lit("tt"), F.col("conv_id")).alias("movie_id"),
        F.concat(F.lit("Title "), F.col("conv_id")).alias("movie_title"),
        "page",
        F.to_json(data).alias("json"),
    )


REVIEWS = r"""rv AS (
  SELECT 'tt' || conv_id AS movie_id, 'Title ' || conv_id AS movie_title, conv_id % 10 + 1 AS rating,
         CASE WHEN turn % 6 <> 5 THEN substr(text, 1, 30) END AS review_title,
         CASE WHEN (turn + conv_id) % 3 <> 2 THEN text END AS review_body,
         CASE WHEN turn % 4 <> 3 THEN length(text) ELSE 0 END::BIGINT AS upvotes,
         turn // 5 AS page,
         row_number() OVER (PARTITION BY conv_id, turn // 5 ORDER BY turn) - 1 AS pos
  FROM conversations),
reviews AS (SELECT * FROM rv WHERE coalesce(review_title, '') <> '' OR coalesce(review_body, '') <> '')"""


# --- annotation: documents to annotate, and landed responses ------------------------------------------


def annotation_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows to annotate; the text sits in ``content``, and every eleventh is blank."""
    return documents(spark, sf).select(
        F.col("doc_id").alias("row_id"),
        F.when(F.col("doc_id") % 11 == 3, "  ").otherwise(F.col("text")).alias("content"),
        F.col("lang").alias("sentiment"),
    )


def responses(requests: DataFrame) -> DataFrame:
    """One response per batch: mostly right, some malformed, some one answer short, some a lone object."""
    answer = F.struct(
        (F.col("row_id") % 2 == 0).alias("is_metaphor"),
        (F.col("row_id") % 3 == 0).alias("is_irony"),
        (F.col("row_id") % 6 == 1).alias("is_literal"),
        F.when(F.col("row_id") % 4 != 1, F.concat(F.lit("r"), F.col("row_id"))).alias("reasoning"),
    )
    batches = requests.groupBy("batch_id", "request_id").agg(  # a group is one batch
        F.transform(F.array_sort(F.collect_list(F.struct("pos", answer.alias("a")))), lambda x: x["a"]).alias("all")
    )
    kind = F.col("batch_id") % 7
    body = (
        F.when(kind == 3, F.lit('[{"is_metaphor": true, '))
        .when(kind == 5, F.to_json(F.slice("all", F.lit(1), F.greatest(F.size("all") - 1, F.lit(0)))))
        .when(kind == 6, F.to_json(F.element_at("all", 1)))
        .otherwise(F.to_json("all"))
    )
    return batches.select("batch_id", "request_id", body.alias("response"))


def _requests_sql(condition: str) -> str:
    return (
        """todo AS (
  SELECT doc_id AS row_id, CASE WHEN doc_id % 11 = 3 THEN '  ' ELSE text END AS content, lang AS sentiment
  FROM documents WHERE """
        + condition
        + """),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY md5(row_id::VARCHAR), row_id) - 1 AS n FROM todo),
requests AS (
  SELECT row_id, n // 10 AS batch_id, n % 10 AS batch_pos,
         CASE WHEN length(content) > 2000 THEN substr(content, 1, 2000) || '...' ELSE content END AS text,
         sentiment AS original_sentiment,
         row_number() OVER (PARTITION BY n // 10 ORDER BY n) - 1 AS pos,
         count(*) OVER (PARTITION BY n // 10) AS n_texts
  FROM numbered WHERE trim(content) <> ''),
aligned AS (
  SELECT row_id, batch_id, text, original_sentiment, (row_id % 2 = 0)::INTEGER AS label_metaphor,
         (row_id % 3 = 0)::INTEGER AS label_irony, CASE WHEN row_id % 4 <> 1 THEN 'r' || row_id ELSE '' END AS reasoning
  FROM requests WHERE batch_id % 7 NOT IN (3, 5) AND (batch_id % 7 <> 6 OR n_texts = 1))"""
    )


REQUESTS = _requests_sql("true")
PENDING_REQUESTS = _requests_sql("doc_id NOT IN (SELECT doc_id FROM labels)")
