"""Queries for the sources and sinks. What they write goes to the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import inputs as I
from corpusloom.catalog.registry import query
from corpusloom.operators import metrics as M
from corpusloom.operators.aggregates import truncation_summary
from corpusloom.operators.filters import to_binary
from corpusloom.operators.joins import split_leakage
from corpusloom.operators.long_texts import shorten
from corpusloom.operators.sets import union_sources
from corpusloom.operators.split import split_60_20_20
from corpusloom.plans import jobs
from corpusloom.session import scratch_path
from corpusloom.sinks import writers
from corpusloom.sinks.ledger import Ledger
from corpusloom.sources import corpus, files, resilient
from corpusloom.sources import documents as S


def rounded(df, digits: int = 6):
    """All doubles to a fixed number of digits, so that engines can be compared."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else c for c, t in df.dtypes])


@query("A1_read_labeled", "WITH " + I.ANNOTATIONS + " SELECT text, label FROM ann")
def _(spark, sf):
    path = scratch_path(spark, "labeled")
    I.annotations(spark, sf).select("text", "label").write.options(**writers.CSV).csv(path)
    return files.read_labeled(spark, path)


_TURN_WORDS = r"""turns AS (
  SELECT conv_id, turn, text, (conv_id % 8)::INTEGER AS source_rank,
         ['VUA_MPD', 'VUA18', 'VUA18-', 'VUA20', 'VUA20-', 'VUAverb', 'VUAverb-', 'VUA18_pos'][source_rank + 1] AS source,
         CASE WHEN source_rank = 7 THEN (turn % 4)::INTEGER ELSE -1 END AS pos_rank,
         CASE WHEN source_rank = 7 THEN ['adj', 'adv', 'noun', 'verb'][pos_rank + 1] END AS pos_folder,
         CASE WHEN conv_id % 10 = 0 THEN 'test' ELSE 'train' END AS split
  FROM conversations),
turn_sents AS (SELECT * EXCLUDE (text), unnest(string_split_regex(text, '\. |\n+')) AS sentence FROM turns),
turn_words AS (
  SELECT conv_id || '-' || turn AS index, CASE WHEN length(target) >= 12 THEN 1 ELSE 0 END AS label, sentence, target,
         source, pos_folder, split, source_rank, pos_rank
  FROM (SELECT *, unnest(regexp_extract_all(sentence, '\S+')) AS target FROM turn_sents))"""


def _turn_words(spark, sf):
    """Word rows of the conversations, tagged with their corpus folder."""
    from corpusloom.functions.tokens import WHITESPACE
    from corpusloom.schemas import CORPUS_FOLDERS, POS_FOLDERS

    rank = (F.col("conv_id") % 8).cast("int")
    pos = F.when(rank == 7, F.get(F.array(*map(F.lit, POS_FOLDERS)), (F.col("turn") % 4).cast("int")))
    turns = I.table(spark, sf, "conversations").select(
        F.concat("conv_id", F.lit("-"), "turn").alias("index"),
        F.get(F.array(*map(F.lit, CORPUS_FOLDERS)), rank).alias("source"),
        pos.alias("pos_folder"),
        F.when(F.col("conv_id") % 10 == 0, "test").otherwise("train").alias("split"),
        F.explode(F.split("text", r"\. |\n+")).alias("sentence"),
    )
    words = turns.select("*", F.posexplode(WHITESPACE.tokens("sentence")).alias("w_index", "target"))
    return words.select(
        "index",
        (F.length("target") >= 12).cast("int").alias("label"),
        "sentence",
        F.lit("x").alias("pos"),
        "w_index",
        "target",
        F.lit(None).cast("string").alias("word_sense"),
        F.lit(None).cast("string").alias("definition"),
        "source",
        "pos_folder",
        "split",
    )


@query("A2_read_word_tsv", "WITH " + _TURN_WORDS + " SELECT index, label, sentence, target FROM turn_words")
def _(spark, sf):
    path = scratch_path(spark, "words")
    words = _turn_words(spark, sf).drop("source", "pos_folder", "split")
    words.write.options(**writers.CSV, sep="\t").csv(path)
    return files.read_word_tsv(spark, path).select("index", "label", "sentence", "target")


def _land_corpus(spark, sf) -> str:
    """Write the corpus folders: one partitioned write, then the folders get their corpus names."""
    root = scratch_path(spark, "corpus")
    parts = ["source", "pos_folder", "split"]
    _turn_words(spark, sf).write.partitionBy(*parts).options(**writers.CSV, sep="\t").csv(f"{root}/landed")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.globStatus(path(f"{root}/landed/source=*/pos_folder=*/split=*")):
        old = status.getPath()
        split, pos = old.getName().split("=")[1], old.getParent().getName().split("=")[1]
        source = old.getParent().getParent().getName().split("=")[1]
        folder = f"{root}/{source}" if pos.startswith("__") else f"{root}/{source}/{pos}"
        fs.mkdirs(path(folder))
        fs.rename(old, path(f"{folder}/{split}.tsv"))
    return root


@query(
    "A3_scan_corpus",
    "WITH "
    + _TURN_WORDS
    + " SELECT index, label, sentence, target, source, pos_folder, split, source_rank, pos_rank FROM turn_words",
)
def _(spark, sf):
    words = corpus.scan_corpus(spark, _land_corpus(spark, sf))
    return words.select(
        "index", "label", "sentence", "target", "source", "pos_folder", "split", "source_rank", "pos_rank"
    )


LENGTH_STATS = """count(*) AS total_samples,
  round(avg(tk), 6) AS tokens_mean, round(median(tk), 6)::DOUBLE AS tokens_median, max(tk) AS tokens_max,
  round(avg(ch), 6) AS chars_mean, round(median(ch), 6)::DOUBLE AS chars_median, max(ch) AS chars_max,
  round(avg(tk), 6) AS words_mean, round(median(tk), 6)::DOUBLE AS words_median, max(tk) AS words_max,
  min(tk) AS tokens_min, round(stddev_samp(tk), 6) AS tokens_std,
  count(*) FILTER (tk > 510) AS over_limit_count, round(count(*) FILTER (tk > 510) / count(*)::DOUBLE * 100, 6) AS over_limit_pct"""


def _land_broken(df, path: str, columns: list[str], whole, name: str) -> None:
    """Each task writes one gzip file of CSV: the rows that are ``whole``, then a part that breaks off before its first
    byte can be read back."""

    def write(batches):
        import csv
        import io
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext

        system, root = resilient._open(path)
        system.create_dir(root, recursive=True)
        codec = zlib.compressobj(wbits=31)
        with system.open_output_stream(f"{root}/{name}-{TaskContext.get().partitionId()}.csv.gz", compression=None) as out:
            buffer = io.StringIO()
            writer = csv.writer(buffer, lineterminator="\n")
            writer.writerow(columns)
            for batch in batches:
                writer.writerows(zip(*(c.to_pylist() for c in batch.columns), strict=True))
                out.write(codec.compress(buffer.getvalue().encode()))
                buffer.seek(0)
                buffer.truncate()
            out.write(codec.compress(buffer.getvalue().encode()) + codec.flush(zlib.Z_FULL_FLUSH))
        yield pa.RecordBatch.from_pylist([{"n": 1}])

    df.where(whole).select(*columns).mapInArrow(write, "n long").count()


@query(
    "A4_profile_files",
    "WITH t AS (SELECT 'documents' AS input_name, text FROM documents UNION ALL SELECT 'conversations', text FROM "
    "conversations UNION ALL SELECT 'benchmark', text FROM benchmark UNION ALL SELECT 'broken', text FROM conversations "
    "WHERE turn < 2), n AS (SELECT input_name, "
    + I.TOKENS.format("text")
    + " AS tk, length(text)::BIGINT AS ch FROM t), p AS (SELECT input_name, "
    + LENGTH_STATS
    + """ FROM n GROUP BY input_name),
s AS (SELECT 'documents' AS input_name, 'read' AS status UNION ALL SELECT 'conversations', 'read' UNION ALL SELECT 'benchmark', 'read'
  UNION ALL SELECT 'broken', 'damaged' UNION ALL SELECT 'labels', 'no column' UNION ALL SELECT 'pages', 'no column')
SELECT *, coalesce(total_samples, 0)::BIGINT AS accepted, 0::BIGINT AS rejected FROM s LEFT JOIN p USING (input_name)""",
)
def _(spark, sf):
    names = ("documents", "conversations", "benchmark", "labels", "pages")  # the last two have no text column
    path = scratch_path(spark, "broken")
    _land_broken(spark.read.parquet(f"{sf}/conversations.parquet"), path, ["conv_id", "text"], F.col("turn") < 2, "turns")
    inputs = {n: f"{sf}/{n}.parquet" for n in names} | {"broken": path}
    return rounded(files.profile_files(spark, inputs))


@query(
    "A5_parse_titles",
    """SELECT 'tt' || page_id AS id, CASE WHEN page_id % 9 <> 4 THEN url END AS title,
  (1990 + page_id % 30)::INTEGER AS year, (page_id % 50 + 1)::INTEGER AS rank FROM pages""",
)
def _(spark, sf):
    page = F.col("page_id")
    item = F.struct(
        F.concat(F.lit("tt"), page).alias("id"),
        F.when(page % 9 != 4, F.struct(F.col("url").alias("text"))).alias("titleText"),
        F.struct((page % 30 + 1990).alias("year")).alias("releaseYear"),
    )
    node = F.struct(item.alias("item"), (page % 50 + 1).alias("rank"))
    edges = F.collect_list(F.struct(node.alias("node"))).alias("edges")  # fifty titles per response
    landed = I.table(spark, sf, "pages").groupBy(F.floor(page / 50)).agg(edges)
    data = F.struct(F.struct(F.struct("edges").alias("topTrendingTitles")).alias("data"))
    return S.parse_titles(landed.select(F.to_json(data).alias("json")))


@query("A6_parse_reviews", "WITH " + I.REVIEWS + " SELECT * FROM reviews")
def _(spark, sf):
    return S.parse_reviews(I.review_pages(spark, sf), "json", "page")


@query(
    "A7_extract_article",
    "WITH "
    + I.NEWS
    + """ SELECT page_id, title, meta_lang, text,
  CASE WHEN page_id % 3 <> 0 THEN '2024-05-' || lpad((page_id % 28 + 1)::VARCHAR, 2, '0') || 'T08:00:00Z' END AS publish_date
FROM art WHERE page_id < 1000000000""",
)
def _(spark, sf):
    day = F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0")
    meta = F.concat(
        F.lit('<meta charset="utf-8"><meta property="article:published_time" content="2024-05-'), day, F.lit('T08:00:00Z">')
    )
    plain = F.lit('<meta charset="utf-8">')
    dated = F.when(F.col("page_id") % 3 != 0, F.replace("html", plain, meta)).otherwise(F.col("html"))
    pages = I.table(spark, sf, "pages").withColumn("html", dated)
    return S.extract_article(pages).select("page_id", "title", "meta_lang", "text", "publish_date")


@query(
    "A7_article_body",
    "WITH " + I.NEWS + " SELECT page_id, title, text FROM art WHERE page_id < 1000000000",
)
def _(spark, sf):
    """The pages without their article elements, between more menus and remarks: the text is found all the same."""
    more = '<div><table><tr><td>of 3 parts</td><td><a href="/a>b">next one</a></td></tr></table></div>'
    html = F.replace(F.replace("html", F.lit("<article>"), F.lit(more + '<div class="a>b"><div>')), F.lit("</article>"), F.lit("</div></div>" + more))
    pages = I.table(spark, sf, "pages").withColumn("html", html)
    return S.extract_article(pages).select("page_id", "title", "text")


@query(
    "A8_forum_rows",
    "WITH " + I.FORUM + " SELECT text, source, type, score, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, url FROM frows",
)
def _(spark, sf):
    posts, comments = I.forum(spark, sf)
    rows = union_sources([S.to_post_rows(posts), S.to_comment_rows(comments)])
    return rows.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


@query("A9_require_columns", "SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def _(spark, sf):
    docs = files.require_columns(I.documents(spark, sf), ["doc_id", "text", "lang"])
    return docs.groupBy("lang").agg(F.count("*").alias("n"))


@query(
    "A10_available_inputs",
    "SELECT 'documents' AS input_name, count(*) AS n FROM documents UNION ALL SELECT 'pages', count(*) FROM pages",
)
def _(spark, sf):
    wanted = {n: f"{sf}/{n}.parquet" for n in ("documents", "reviews_not_there", "pages")}
    frames = [
        spark.read.parquet(path).groupBy().agg(F.lit(name).alias("input_name"), F.count("*").alias("n"))
        for name, path in files.available(spark, wanted).items()
    ]
    return union_sources(frames)


@query(
    "A11_read_tolerant",
    """SELECT doc_id, lang, n_chars, NULL::VARCHAR AS record FROM documents WHERE doc_id % 13 <> 5
UNION ALL SELECT NULL, NULL, NULL, '{"doc_id": ' || doc_id || ', "lang' FROM documents WHERE doc_id % 13 = 5""",
)
def _(spark, sf):
    path = scratch_path(spark, "tolerant")
    good = F.to_json(F.struct("doc_id", "lang", "n_chars"))
    bad = F.concat(F.lit('{"doc_id": '), F.col("doc_id"), F.lit(', "lang'))
    I.documents(spark, sf).select(F.when(F.col("doc_id") % 13 == 5, bad).otherwise(good).alias("value")).write.text(path)
    read = files.read_tolerant(spark, path, "doc_id bigint, lang string, n_chars bigint", "json")
    return union_sources([read.rows.drop("input_file"), read.rejected.drop("input_file")])


@query(
    "A11_damaged_files",
    """SELECT 'damaged' AS status, count(*) FILTER (doc_id % 8 <> 0 AND doc_id % 5 <> 1)::BIGINT AS accepted,
  count(*) FILTER (doc_id % 8 <> 0 AND doc_id % 5 = 1)::BIGINT AS rejected, sum(doc_id) FILTER (doc_id % 8 <> 0 AND doc_id % 5 <> 1)::BIGINT AS ids,
  true AS explained, true AS all_listed FROM documents""",
)
def _(spark, sf):
    """Every landed file breaks in the middle; what stands before the break counts, and no file is missing."""
    path = scratch_path(spark, "damaged")
    docs = I.documents(spark, sf).withColumn("size", F.when(F.col("doc_id") % 5 == 1, "unknown").otherwise(F.col("n_chars").cast("string")))
    _land_broken(docs, path, ["doc_id", "text", "size"], F.col("doc_id") % 8 != 0, "docs")
    read = files.read_tolerant(spark, path, "doc_id bigint, text string, size bigint")
    ids = read.rows.groupBy("input_file").agg(F.sum("doc_id").alias("ids"))
    landed = len(resilient.list_files(path))
    return (
        read.report()
        .join(ids, "input_file", "left")
        .groupBy("status")
        .agg(
            F.sum("accepted").alias("accepted"),
            F.sum("rejected").alias("rejected"),
            F.sum("ids").alias("ids"),
            F.bool_and(F.col("error").contains("ends early")).alias("explained"),
            (F.count("*") == landed).alias("all_listed"),
        )
    )


SPLIT_60_20_20 = (
    I.ANNOTATIONS
    + """, c AS (SELECT binary_label AS label, count(*) AS n, sum(count(*)) OVER () AS total FROM ann GROUP BY 1),
k1 AS (SELECT *, (total - ceil(0.4::DOUBLE * total))::BIGINT AS kept FROM c),
q1 AS (SELECT *, (n * kept) // total AS base, (n * kept) % total AS rest FROM k1),
r1 AS (SELECT *, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label DESC) <= kept - sum(base) OVER () THEN 1 ELSE 0 END AS train_n FROM q1),
k2 AS (SELECT label, n, train_n, n - train_n AS m, sum(n - train_n) OVER () AS total2 FROM r1),
k3 AS (SELECT *, (total2 - ceil(0.5::DOUBLE * total2))::BIGINT AS kept FROM k2),
q2 AS (SELECT *, (m * kept) // total2 AS base, (m * kept) % total2 AS rest FROM k3),
r2 AS (SELECT *, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label DESC) <= kept - sum(base) OVER () THEN 1 ELSE 0 END AS val_n FROM q2),
ranked AS (SELECT ann.*, row_number() OVER (PARTITION BY binary_label ORDER BY md5('42:' || doc_id), doc_id) AS rk FROM ann),
split AS (
  SELECT ranked.*, CASE WHEN rk <= train_n THEN 'train' WHEN rk <= train_n + val_n THEN 'val' ELSE 'test' END AS split
  FROM ranked JOIN r2 ON r2.label = ranked.binary_label)"""
)


def split_rows(spark, sf):
    return split_60_20_20(to_binary(I.annotations(spark, sf)), "binary_label")


@query(
    "D6_split_leakage",
    "WITH "
    + SPLIT_60_20_20
    + " SELECT doc_id, split FROM split WHERE text IN (SELECT text FROM split GROUP BY text HAVING count(DISTINCT split) > 1)",
)
def _(spark, sf):
    return split_leakage(split_rows(spark, sf)).select("doc_id", "split")


@query("B1_write_splits", "WITH " + SPLIT_60_20_20 + " SELECT text, binary_label AS label, split FROM split")
def _(spark, sf):
    path = scratch_path(spark, "splits")
    writers.write_splits(split_rows(spark, sf), path)
    read = spark.read.schema("text string, label string, split string").options(**writers.CSV, multiLine=True)
    return read.csv(path)


@query(
    "B2_write_basic_detailed",
    "WITH t AS (SELECT doc_id, lang, n_chars, " + I.TOKENS.format("text") + " AS tk FROM documents) "
    "SELECT 'basic' AS variant, doc_id, lang, NULL::BIGINT AS original_tokens FROM t "
    "UNION ALL SELECT 'detailed', doc_id, lang, tk FROM t",
)
def _(spark, sf):
    path = scratch_path(spark, "variants")
    writers.write_basic_detailed(shorten(I.documents(spark, sf)), path, ["doc_id", "text", "lang"])
    basic, detailed = (spark.read.parquet(f"{path}/{v}") for v in ("basic", "detailed"))
    return union_sources(
        [
            detailed.select(F.lit("detailed").alias("variant"), "doc_id", "lang", "original_tokens"),
            basic.select(F.lit("basic").alias("variant"), "doc_id", "lang"),
        ]
    )


@query("B3_append_annotations", "SELECT doc_id AS row_id, text FROM documents")
def _(spark, sf):
    path = scratch_path(spark, "annotations")
    rows = I.documents(spark, sf).select(F.col("doc_id").alias("row_id"), "text")
    writers.append_annotations(rows.where(F.col("row_id") % 3 != 0), path)
    writers.append_annotations(rows, path)
    return writers.read_annotations(spark, path)


@query(
    "B3_replayed_batches",
    """SELECT 'b0' AS batch, count(*) FILTER (doc_id % 3 = 0)::BIGINT AS n_rows FROM documents UNION ALL
SELECT 'b1', count(*) FILTER (doc_id % 3 = 1)::BIGINT FROM documents UNION ALL
SELECT 'b2', count(*) FILTER (doc_id % 3 = 2)::BIGINT FROM documents UNION ALL SELECT 'rows', count(*) FROM documents""",
)
def _(spark, sf):
    """Overlapping batches, each delivered twice, with the index merged in between: what each of them added."""
    path = scratch_path(spark, "replayed")
    rows = I.documents(spark, sf).select(F.col("doc_id").alias("row_id"), "text")
    for last in range(3):
        for _ in range(2):
            writers.append_annotations(rows.where(F.col("row_id") % 3 <= last), path, batch=f"b{last}")
        Ledger(spark, path, "row_id").compact()
    total = writers.read_annotations(spark, path).agg(F.lit("rows").alias("batch"), F.count("*").alias("n_rows"))
    return Ledger(spark, path, "row_id").batches().select("batch", "n_rows").union(total)


@query(
    "B4_append_reviews",
    "WITH " + I.REVIEWS + " SELECT movie_id, movie_title, rating, review_title, review_body, upvotes FROM reviews",
)
def _(spark, sf):
    path = scratch_path(spark, "reviews")
    reviews = S.parse_reviews(I.review_pages(spark, sf), "json", "page").drop("page", "pos")
    even = F.pmod(F.substr("movie_id", F.lit(3)).cast("bigint"), F.lit(2)) == 0
    writers.append_reviews(reviews.where(even), path)
    writers.append_reviews(reviews.where(~even), path)
    return writers.read_reviews(spark, path)


@query(
    "B5_write_summary",
    "WITH "
    + I.CLASS_SCORES
    + """, wide AS (
  SELECT model, max(CASE WHEN domain = 'Reddit' THEN accuracy END) AS ra, max(CASE WHEN domain = 'News' THEN accuracy END) AS na,
         max(CASE WHEN domain = 'Reddit' THEN f1_macro END) AS rf, max(CASE WHEN domain = 'News' THEN f1_macro END) AS nf
  FROM totals GROUP BY model)
SELECT model, 'figurative' AS irony_maps_to, round(ra, 6) AS reddit_accuracy, round(nf, 6) AS news_f1_macro,
  (SELECT round(prec, 6) FROM scores s WHERE s.model = w.model AND domain = 'News' AND class = 'figurative') AS news_figurative_precision,
  (SELECT count(*) FROM pred p WHERE p.model = w.model AND domain = 'Reddit' AND original_label = 'metaphor') AS reddit_metaphor_total,
  CASE WHEN ra > na THEN 'Reddit' ELSE 'News' END AS better_domain,
  round((greatest(ra, na) - least(ra, na)) / least(ra, na) * 100, 6) AS improvement_pct
FROM wide w""",
)
def _(spark, sf):
    path = scratch_path(spark, "summary")
    r = jobs.evaluate_cross_domain(I.predictions(spark, sf))
    writers.write_summary(writers.summary_frame(r.metrics, r.classes, r.breakdown, r.comparison), path)
    line = lambda p, t: F.get_json_object("value", f"$.{p}").cast(t)
    return rounded(
        spark.read.text(path).select(
            line("model", "string").alias("model"),
            line("label_mapping.irony", "string").alias("irony_maps_to"),
            line("reddit.binary_metrics.accuracy", "double").alias("reddit_accuracy"),
            line("news.binary_metrics.f1_macro", "double").alias("news_f1_macro"),
            line("news.binary_metrics.per_class.figurative.precision", "double").alias("news_figurative_precision"),
            line("reddit.breakdown_by_original_label.metaphor.total", "bigint").alias("reddit_metaphor_total"),
            line("comparison.better_domain", "string").alias("better_domain"),
            line("comparison.improvement_pct", "double").alias("improvement_pct"),
        )
    )


@query(
    "B6_write_report",
    "WITH t AS (SELECT "
    + I.TOKENS.format("text")
    + """ AS tk FROM documents),
s AS (SELECT count(*) AS n, count(*) FILTER (tk > 510) AS cut, avg(tk) AS mean FROM t)
SELECT unnest(['Shortened texts', 'total: ' || n, 'truncated: ' || cut,
  'truncation rate: ' || format('{:.1f}', cut * 100.0 / n), 'mean original tokens: ' || format('{:.1f}', mean)]) AS line FROM s""",
)
def _(spark, sf):
    path = scratch_path(spark, "report")
    rows = shorten(I.documents(spark, sf)).withColumn("final_tokens", F.col("token_count"))
    stats = truncation_summary(rows).select("total", "truncated", "truncation_rate", "mean_original_tokens")
    writers.write_report([("Shortened texts", stats, None)], path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query(
    "B7_write_evaluation",
    "WITH "
    + I.CLASS_SCORES.replace("g.domain", "'all' AS domain")
    + """ SELECT model, 'overall' AS frame, round(accuracy, 6) AS a, round(f1_macro, 6) AS b, total AS n FROM totals
UNION ALL SELECT model, 'class ' || class, round(prec, 6), round(rec, 6), support FROM scores
UNION ALL SELECT model, 'prediction', round(p0, 6), round(greatest(p0, p1), 6), doc_id FROM pred""",
)
def _(spark, sf):
    path = scratch_path(spark, "evaluation")
    frames = jobs.evaluate(I.single_predictions(spark, sf), by=("model",), out=path)
    load = lambda name: spark.read.schema(frames[name].schema).options(**writers.CSV).csv(f"{path}/{name}")
    shape = lambda df, frame, a, b, n: df.select(
        "model", frame.alias("frame"), F.col(a).alias("a"), F.col(b).alias("b"), F.col(n).cast("bigint").alias("n")
    )
    return rounded(
        union_sources(
            [
                shape(load("overall_metrics"), F.lit("overall"), "accuracy", "f1_macro", "total"),
                shape(load("per_class_metrics"), F.concat(F.lit("class "), F.col("class")), "precision", "recall", "support"),
                shape(load("detailed_predictions"), F.lit("prediction"), "prob_literal", "confidence", "doc_id"),
            ]
        )
    )


@query(
    "B8_write_comparison",
    "WITH " + I.CLASS_SCORES + " SELECT domain AS Domain, round(f1_macro, 6) AS Macro_F1, model AS Model FROM totals",
)
def _(spark, sf):
    path = scratch_path(spark, "comparison")
    metrics = M.overall(I.scored(spark, sf), "binary_label", "predicted_binary", ["model", "domain"])
    rows = metrics.select(
        F.col("domain").alias("Domain"), F.col("f1_macro").alias("Macro_F1"), F.col("model").alias("Model")
    )
    writers.write_comparison(rows, path)
    return rounded(spark.read.schema("Domain string, Macro_F1 double, Model string").options(**writers.CSV).csv(path))
