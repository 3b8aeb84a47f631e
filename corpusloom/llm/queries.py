"""The operators of this package as queries over the given tables, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    alignment, bpe, collocations, doubling, minhash, packing, quality, quantised, secrets, suffixes, toxicity, urls, winnowing,
)
from corpusloom.llm.common import id_or_null, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def _n_removed():
    return F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["e"] - s["s"]).alias("n_removed")


@query(
    "op1_quantised_tiles",
    """WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND NOT list_contains(list_transform(embedding, lambda x: coalesce(NOT isfinite(x), true)), true)
    AND list_contains(list_transform(embedding, lambda x: x <> 0), true)),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.95),
reach AS (SELECT vec_id AS id, vec_id AS r FROM embeddings UNION SELECT reach.id, links.v FROM reach JOIN links ON reach.r = links.u),
least_id AS (SELECT id, min(r) AS c FROM reach GROUP BY 1),
n AS (SELECT u, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, c = vec_id AS kept
FROM embeddings JOIN least_id ON vec_id = id LEFT JOIN n ON n.u = vec_id""",
)
def _(spark, sf):
    return quantised.near_vectors(table(spark, sf, "embeddings"), "vec_id", "embedding")


@query("op2_suffix_dedup")
def _(spark, sf):
    rows = suffixes.remove_repeats(table(spark, sf, "documents"), "doc_id", "text")
    return rows.select(
        "doc_id", "n_bytes", _n_removed(), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query(
    "op3_minmax_hash",
    """WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM common JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 80 * (a.n + b.n - c)),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT doc_id AS id, doc_id AS r FROM documents UNION SELECT reach.id, both_ways.v FROM reach JOIN both_ways ON reach.r = both_ways.u),
least_id AS (SELECT id, min(r) AS c FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c AS component_id, c = doc_id AS kept
FROM documents JOIN least_id ON doc_id = id LEFT JOIN n USING (doc_id)""",
)
def _(spark, sf):
    return minhash.near_duplicates(table(spark, sf, "documents"), "doc_id", "text")


RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
    ("block", "net/fr/"),
)


@query("op4_url_trees")
def _(spark, sf):
    return urls.judge(table(spark, sf, "pages"), "page_id", "url", RULES)


def _is_held_out(key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.learn(docs, labels, "doc_id", "text", "toxic", ~_is_held_out())


def is_toxic():
    return F.col("score") >= 0.3


@query("op5_string_kernel")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    rows = toxicity.toxicity(docs, "doc_id", "text", toxicity_model(docs, table(spark, sf, "labels")))
    held_out = F.coalesce(_is_held_out(), F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"), "score", is_toxic().cast("int").alias("predicted"))


@query("op6_secret_forest")
def _(spark, sf):
    rows = secrets.scan(table(spark, sf, "documents"), "doc_id", "text")
    return rows.select(
        id_or_null(F.col("id")).alias("doc_id"), F.col("s").alias("start"), F.col("e").alias("end"), "kind", "name",
        "score", "secret",
    )


@query("op7_vector_packing")
def _(spark, sf):
    rows = packing.shard(table(spark, sf, "documents"), "doc_id", "text")
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens",
    )


@query(
    "op8_word_windows",
    """WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
firsts AS (SELECT s, min(doc_id) AS m FROM win GROUP BY 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN firsts USING (s) WHERE m < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN covered USING (doc_id, p) GROUP BY 1),
gone AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)""",
)
def _(spark, sf):
    rows = doubling.remove_repeats(table(spark, sf, "documents"), "doc_id", "text")
    return rows.select("doc_id", "n_words", _n_removed(), F.sha2("kept", 256).alias("kept_sha256"))


_WORDS = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
)


@query(
    "op10_winnowing",
    f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
lengths AS (SELECT DISTINCT least(len(w), 13) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, i, n, win FROM dw WHERE (n, win) IN (SELECT (n, win) FROM bw)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits JOIN bw USING (n, win) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
)
def _(spark, sf):
    rows = winnowing.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        winnowing.is_contaminated().alias("contaminated"),
    )


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    import public_tokenizers  # where it is missing, only the queries with its vocabularies are

    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    decoded = bpe.decode(bpe.encode(docs, "doc_id", "text", vocabulary), vocabulary)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op9_bpe")
def _(spark, sf):
    return bpe_digests(table(spark, sf, "documents"))


@query("op11_token_alignment")
def _(spark, sf):
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        first, second = a.read(), b.read()
    rows = alignment.link_counts(table(spark, sf, "documents"), "doc_id", "text", first, second, digest=True)
    return rows.withColumnRenamed("groups", "groups_sha256")


@query(
    "op12_phrase_collocations",
    """WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
sized AS (SELECT lang, w, unnest([1, 2, 3, 4]) AS n FROM w),
grams AS (SELECT lang, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT lang, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
f AS (SELECT lang, n, g, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS total FROM f WHERE n = 1 GROUP BY 1),
c AS (SELECT lang, n, g, f AS a, string_split(g, ' ') AS w FROM f WHERE n > 1 AND f >= 30),
cuts AS (SELECT lang, g, a, k, array_to_string(w[:k], ' ') AS h, array_to_string(w[k + 1:], ' ') AS t FROM (SELECT *, unnest(range(1, n)) AS k FROM c)),
scored AS (SELECT c.lang, c.g, c.a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a // (x.f + y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = c.h JOIN f y ON y.lang = c.lang AND y.g = c.t),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_parts AS (SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS g FROM
  (SELECT *, unnest(range(1, n - m + 2)) AS i FROM (SELECT *, unnest(range(2, n)) AS m FROM c WHERE n > 2))),
longer AS (SELECT lang, g, max(a) AS most FROM inner_parts GROUP BY 1, 2),
free AS (SELECT s.* FROM weakest s LEFT JOIN longer USING (lang, g) WHERE most IS NULL OR 100 * most::HUGEINT < 80 * s.a::HUGEINT),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM free)
SELECT lang, rank::BIGINT AS rank, g AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, total AS n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000""",
)
def _(spark, sf):
    return collocations.collocations(table(spark, sf, "documents"), "text", "lang")


_MARGINS, _SHARES = (f"[{', '.join(map(repr, x))}]" for x in (quality.MARGINS, quality.SHARES))


@query(
    "op13_risk_controlled_quality",
    f"""WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, lang, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY 1),
m AS (SELECT doc_id, lang, md5(t) AS digest, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS caps,
  length(regexp_replace(t, '[^0-9]', '', 'g')) AS digits, len(lines) AS n_lines,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  least(1000, floor(word_chars * 10.0::DOUBLE / greatest(n_words, 1)))::INT AS len10 FROM m),
s AS (SELECT doc_id, lang, digest, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  [least(1000, floor(n_symbols * 1000.0::DOUBLE / greatest(word_chars, 1)))::INT, least(1000, floor(caps * 1000.0::DOUBLE / greatest(word_chars, 1)))::INT,
   least(1000, floor(digits * 1000.0::DOUBLE / greatest(word_chars, 1)))::INT, least(1000, floor(n_repeat_words * 1000.0::DOUBLE / greatest(n_words, 1)))::INT,
   least(1000, floor(n_dup_lines * 1000.0::DOUBLE / greatest(n_lines, 1)))::INT, least(1000, floor(n_lines * 1000.0::DOUBLE / greatest(n_words, 1)))::INT,
   len10, 1000 - len10] AS scores FROM b),
marks AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY 1),
texts AS (SELECT lang, min(scores) AS scores, min(good) = 1 AS good, ('0x' || substr(digest, 1, 6))::INT % 3 = 0 AS design
  FROM s JOIN marks USING (doc_id) WHERE NOT base_failed GROUP BY lang, digest),
cells AS (SELECT lang, rule, score, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad
  FROM (SELECT lang, good, unnest(range(8)) AS rule, unnest(scores) AS score FROM texts WHERE design) GROUP BY ALL),
above AS (SELECT *, coalesce(sum(good) OVER w, 0) AS good_above, coalesce(sum(bad) OVER w, 0) AS bad_above,
  sum(good) OVER (PARTITION BY lang, rule) AS n_good, sum(bad) OVER (PARTITION BY lang, rule) AS n_bad
  FROM cells WINDOW w AS (PARTITION BY lang, rule ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
worst AS (SELECT lang, rule, max(score) AS worst FROM above WHERE good > 0 GROUP BY 1, 2),
cuts AS (SELECT lang, rule, j - 1 AS level, worst + floor((1000 - worst) * {_MARGINS}[j])::INT AS cut FROM worst, range(1, {len(quality.MARGINS) + 1}) t(j)
  UNION ALL SELECT lang, rule, {len(quality.MARGINS)} + j - 1, min(score) FROM above, range(1, {len(quality.SHARES) + 1}) t(j)
  WHERE good > 0 AND good_above <= floor(n_good * {_SHARES}[j]) GROUP BY lang, rule, j),
active AS (SELECT lang, rule FROM above WHERE good > 0 AND good_above <= floor(n_good * {quality.SHARES[-1]!r}) GROUP BY lang, rule
  HAVING max(n_bad) > 0 AND max(bad_above) >= {quality.LIFT * quality.SHARES[-1]!r} * max(n_bad)),
levels AS (SELECT lang, level, list(CASE WHEN a.rule IS NULL THEN 1000 ELSE cut END ORDER BY rule) AS cutoffs
  FROM cuts LEFT JOIN active a USING (lang, rule) GROUP BY lang, level),
tested AS (SELECT lang, level, cutoffs, count(*) AS n, count(*) FILTER (len(list_filter(list_zip(scores, cutoffs), lambda x: x[1] > x[2])) > 0) AS k
  FROM texts JOIN levels USING (lang) WHERE good AND NOT design GROUP BY ALL),
tails AS (SELECT lang, level, cutoffs, CASE WHEN k >= n * {quality.ALPHA} THEN 1.0 ELSE
  (SELECT sum(exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln({quality.ALPHA}) + (n - i) * ln(1 - {quality.ALPHA}))) FROM range(0, k + 1) r(i)) END AS p FROM tested),
judged AS (SELECT *, p > {quality.DELTA} / (SELECT count(DISTINCT lang) FROM tested) AS fails FROM tails),
passed AS (SELECT lang, level, cutoffs, bool_or(fails) OVER (PARTITION BY lang ORDER BY level) AS over FROM judged),
chosen AS (SELECT lang, arg_max(cutoffs, level) AS cutoffs FROM passed WHERE NOT over GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(len(list_filter(list_zip(scores, cutoffs), lambda x: x[1] > x[2])) = 0, true) AS kept
FROM s LEFT JOIN chosen USING (lang)""",
)
def _(spark, sf):
    rows = quality.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return rows.drop("failed")
