"""Declared input schemas. Readers never infer."""

SPLIT_FILE = "text string, label string"
FORUM_ANNOTATIONS = "text string, label string, notes string"
NEWS_ANNOTATIONS = (
    "source string, url string, title string, text string, publish_date string, label string, notes string"
)
FORUM_BASIC = "text string, source string, type string, score bigint, timestamp timestamp, url string"
FORUM_DETAILED = (
    FORUM_BASIC + ", original_tokens bigint, final_tokens bigint, was_truncated boolean, token_bin string"
)
NEWS_RAW = "source string, url string, title string, text string, publish_date string"
REVIEWS_RAW = (
    "movie_id string, movie_title string, rating bigint, review_title string, review_body string, upvotes bigint"
)
REVIEWS_ANNOTATED = REVIEWS_RAW + ", label string"
WORD_LEVEL = (
    "index string, label int, sentence string, pos string, w_index int, target string, "
    "word_sense string, definition string"
)
TITLES_JSON = (
    "data struct<topTrendingTitles:struct<edges:array<struct<node:struct<item:struct<id:string,"
    "titleText:struct<text:string>,releaseYear:struct<year:int>>,rank:int>>>>>"
)
REVIEWS_JSON = (
    "data struct<title:struct<reviews:struct<edges:array<struct<node:struct<authorRating:bigint,"
    "summary:struct<originalText:string>,text:struct<originalText:struct<plainText:string>>,"
    "helpfulness:struct<upVotes:bigint>>>>,pageInfo:struct<hasNextPage:boolean,endCursor:string>>>>"
)
ANSWERS_JSON = "array<struct<is_metaphor:boolean,is_irony:boolean,is_literal:boolean,reasoning:string>>"
ANNOTATIONS = (
    "row_id bigint, text string, label_metaphor int, label_irony int, reasoning string, "
    "original_sentiment string, source string"
)

# Label vocabularies and orders the results depend on.
ORIGINAL_LABELS = ("literal", "metaphor", "irony", "both")
BINARY_LABELS = ("literal", "figurative")
POS_FOLDERS = ("adj", "adv", "noun", "verb")
CORPUS_FOLDERS = ("VUA_MPD", "VUA18", "VUA18-", "VUA20", "VUA20-", "VUAverb", "VUAverb-", "VUA18_pos")
