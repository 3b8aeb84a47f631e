"""Landed responses (JSON, HTML, posts) turned into uniform rows."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions.html import article_body
from corpusloom.functions.normalize import epoch_to_ts, get_path
from corpusloom.functions.tokens import WHITESPACE_CLASS, col, strip


def _json(c: Column | str, ddl: str, root: str) -> Column:
    return F.from_json(col(c), ddl)[root]


def parse_titles(df: DataFrame, json_col: str = "json") -> DataFrame:
    """Trending-titles response -> ``(id, title, year, rank)``."""
    edges = get_path(_json(json_col, schemas.TITLES_JSON, "data"), "topTrendingTitles.edges")
    node = df.select(F.explode(edges).alias("edge")).select(F.col("edge.node").alias("node"))
    return node.select(
        get_path("node", "item.id").alias("id"),
        get_path("node", "item.titleText.text").alias("title"),
        get_path("node", "item.releaseYear.year").alias("year"),
        get_path("node", "rank").alias("rank"),
    )


def parse_reviews(df: DataFrame, json_col: str = "json", page_col: str | None = None) -> DataFrame:
    """Reviews response -> one row per review that has a title or a body.

    ``movie_id`` and ``movie_title`` come from the landed row; ``page`` and ``pos`` keep arrival order.
    """
    edges = get_path(_json(json_col, schemas.REVIEWS_JSON, "data"), "title.reviews.edges")
    page = F.col(page_col).cast("bigint") if page_col else F.lit(0).cast("bigint")
    flat = df.select("movie_id", "movie_title", page.alias("page"), F.posexplode(edges).alias("pos", "edge"))
    node = F.col("edge.node")
    filled = lambda name: F.coalesce(F.col(name) != "", F.lit(False))
    return flat.select(
        "movie_id",
        "movie_title",
        get_path(node, "authorRating").alias("rating"),
        get_path(node, "summary.originalText").alias("review_title"),
        get_path(node, "text.originalText.plainText").alias("review_body"),
        get_path(node, "helpfulness.upVotes", 0).cast("bigint").alias("upvotes"),
        "page",
        F.col("pos").cast("bigint").alias("pos"),
    ).where(filled("review_title") | filled("review_body"))


#: Names of character references and what they stand for; a no-break space is read as a space.
REFERENCES = {name[:-1]: text for name, text in html5.items() if name.endswith(";")} | {"nbsp": " "}
_REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def _sign(code: Column) -> Column:
    """The character of a code point; null for what is none."""
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def unescape(c: Column | str) -> Column:
    """Character references decoded once: named ones, decimal and hexadecimal ones. Unknown ones stay as they are."""
    text = col(c)
    names = F.from_json(F.lit(json.dumps(REFERENCES)), "map<string,string>")

    def decoded(part: Column) -> Column:
        name = F.regexp_extract(part, _REFERENCE, 1)
        number = F.when(
            F.lower(F.substring(name, 2, 1)) == "x", F.conv(F.substring(name, 3, 8), 16, 10)
        ).otherwise(F.substring(name, 2, 8))
        sign = F.when(name.startswith("#"), _sign(number.cast("bigint"))).otherwise(F.try_element_at(names, name))
        known = F.concat(sign, part.substr(F.length(name) + 2, F.length(part)))
        return F.when(name == "", F.concat(F.lit("&"), part)).otherwise(F.coalesce(known, F.concat(F.lit("&"), part)))

    parts = F.split(text, "&", -1)
    rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), decoded)
    return F.when(F.contains(text, F.lit("&")), F.concat(F.get(parts, 0), F.array_join(rest, ""))).otherwise(text)


def _articles(html: Column) -> Column:
    return F.array_join(F.regexp_extract_all(html, F.lit(r"(?is)<article[^>]*>(.*?)</article>"), 1), " ")


def page_text(html: Column | str) -> Column:
    """Visible text: the article elements if there are any, without scripts, styles and comments."""
    html = col(html)
    article = _articles(html)
    body = F.when(article != "", article).otherwise(html)
    body = F.regexp_replace(body, r"(?is)<head[^>]*>.*?</head>", " ")
    body = F.regexp_replace(body, r"(?is)<script[^>]*>.*?</script>", " ")
    body = F.regexp_replace(body, r"(?is)<style[^>]*>.*?</style>", " ")
    body = F.regexp_replace(body, r"(?s)<!--.*?-->", " ")
    body = unescape(F.regexp_replace(body, r"<[^>]*>", " "))
    return strip(F.regexp_replace(body, rf"(?U){WHITESPACE_CLASS}+", " "))


_NAMED = r"""\b(?:property|name)=["'](?:article:published_time|date)["']"""
_CONTENT = r"""\bcontent=["']([^"']*)["']"""
#: The two attributes in either order.
_PUBLISHED = (rf"(?is)<meta\b[^>]*{_NAMED}[^>]*{_CONTENT}", rf"(?is)<meta\b[^>]*{_CONTENT}[^>]*{_NAMED}")


def page_title(html: Column | str) -> Column:
    """Text of the title element, unescaped and stripped; null when there is none."""
    found = F.nullif(F.regexp_extract(col(html), r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit(""))
    return strip(unescape(found))


def extract_article(df: DataFrame, html_col: str = "html") -> DataFrame:
    """Add ``title, meta_lang, text, publish_date`` read from the page; absent parts are null.

    The text is that of the article elements. Where there are none, it is the run of blocks with the most text outside
    links (``functions.html``), and all visible text where no block is worth anything; only these pages go to Python.
    """
    html = F.col(html_col)
    body = article_body(F.when(_articles(html) == "", html))
    found = lambda pattern: F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))
    return df.withColumns(
        {
            "title": page_title(html),
            "meta_lang": found(r"""(?is)<html[^>]*\blang=["']([^"']*)["']"""),
            "text": F.coalesce(body, F.nullif(page_text(html), F.lit(""))),
            "publish_date": F.coalesce(*[found(p) for p in _PUBLISHED]),
        }
    )


def _forum_rows(df: DataFrame, text: Column, kind: str, keys: tuple[str, ...]) -> DataFrame:
    return df.select(
        *keys,
        text.alias("text"),
        F.concat(F.lit("reddit_"), F.col("forum")).alias("source"),
        F.lit(kind).alias("type"),
        F.col("score").cast("bigint").alias("score"),
        epoch_to_ts(F.col("created_utc")).alias("timestamp"),
        F.concat(F.lit("https://reddit.com"), F.col("permalink")).alias("url"),
    )


def to_post_rows(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """``(forum, title, body, score, created_utc, permalink)`` -> uniform rows; an empty body adds nothing."""
    text = F.concat_ws(" ", F.col("title"), F.nullif(F.col("body"), F.lit("")))
    return _forum_rows(df, text, "post", keys)


def to_comment_rows(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return _forum_rows(df, F.col("body"), "comment", keys)
