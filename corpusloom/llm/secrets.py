"""Secret scanning: patterns propose candidates, a random forest removes the false ones.

A forest is trained on labelled findings. Its features are a candidate's length, its character transitions, how much of
it words of a dictionary cover, what kind of place it stands in and which words stand before it. The dictionary is counted
over the whole corpus.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import row_id, text_tag
from corpusloom.session import materialize

#: Findings that the forest is trained on at most: those with the least hashes.
TRAIN_ROWS = 20_000
#: Words of the dictionary at most: those in most documents. It goes to every worker, some 0.3 MB.
DICTIONARY_WORDS = 20_000
#: Documents that a word of the dictionary is in, at least.
DICTIONARY_LEAST = 2
#: What introduces a secret, and what introduces strings that only look like one.
SECRET_NAMES = ("api_key", "apikey", "auth", "credential", "passwd", "password", "pwd", "secret", "token")
OTHER_NAMES = ("checksum", "commit", "digest", "etag", "guid", "hash", "id", "isbn", "md5", "ref", "sha", "sha1", "sha256", "uuid")
#: The forms of well-known keys.
FORMS = {
    "aws_key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "github_token": r"\bgh[pousr]_[A-Za-z0-9]{36,}\b",
    "slack_token": r"\bxox[abprs]-[A-Za-z0-9-]{10,}",
    "google_key": r"\bAIza[0-9A-Za-z_-]{35}",
    "jwt": r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}",
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]|-(?!----))*-----END [A-Z ]*PRIVATE KEY-----",
}
_FORMS = {kind: re.compile(form) for kind, form in FORMS.items()}
_STARTS = re.compile(r"AKIA|ASIA|gh[pousr]_|xox[abprs]-|AIza|eyJ|-----BEGIN")
_DIGITS = re.compile(r"[0-9]+")
_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_+/-")
_ASSIGN = re.compile(r"[:=][ \t]*[\"']?")
_VALUE = re.compile(r"[^\s\"',;]{8,}")
#: The least length of a candidate without a well-known form.
LEAST = 12
_NAME = re.compile(r"([A-Za-z0-9_]+)[\s\"']*[:=][\s\"']*$")
#: Words inside a candidate, cut where the case changes as in ``getUserName``.
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
FEATURES = (
    "length", "digits", "upper", "hex", "entropy", "changes", "rare_pairs", "covered", "known_form", "named_secret",
    "named_other", "assigned", "quoted", "in_url", "in_path", "is_email", "near_secret", "near_other",
)


def name_before(text: str, start: int) -> str:
    """The name that a candidate is assigned to, in lower case; empty without one."""
    found = _NAME.search(text[max(0, start - 60) : start])
    return found[1].lower() if found else ""


def candidates(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of all candidates, in order and disjoint: well-known forms, values assigned to a secret's
    name, and runs of key-like signs around a digit."""
    found: list[tuple[int, int, str]] = []
    end = 0
    for m in _STARTS.finditer(text):
        if m.start() >= end:
            for kind, form in _FORMS.items():
                if hit := form.match(text, m.start()):
                    found.append((hit.start(), end := hit.end(), kind))
                    break
    more: list[tuple[int, int, str]] = []
    end = 0
    for m in _DIGITS.finditer(text):
        if m.start() < end:
            continue
        s, e = m.span()
        while s > 0 and text[s - 1] in _SIGNS:
            s -= 1
        while e < len(text) and text[e] in _SIGNS:
            e += 1
        end = e
        while not text[s].isalnum():
            s += 1
        while not text[e - 1].isalnum():
            e -= 1
        padding = text[e : e + 2]
        e += len(padding) - len(padding.lstrip("="))
        if e - s >= LEAST:
            more.append((s, e, "generic"))
    for m in _ASSIGN.finditer(text):
        if (value := _VALUE.match(text, m.end())) and any(w in name_before(text, m.end()) for w in SECRET_NAMES):
            more.append((*value.span(), "assigned"))
    end = -1
    out: list[tuple[int, int, str]] = []
    for s, e, kind in sorted(found + more, key=lambda x: (x[0], x[2] not in FORMS, -x[1])):
        if s >= end and not (kind not in FORMS and any(f[0] < e and s < f[1] for f in found)):
            out.append((s, e, kind))
            end = e
    return out


def dictionary(df: DataFrame, text: str, size: int = DICTIONARY_WORDS, least: int = DICTIONARY_LEAST) -> frozenset[str]:
    """The ``size`` words of 3 to 20 letters that most documents have, and ``least`` of them at least.

    Every text is counted, before the shuffle and after it. How many words have a count tells the count to cut at, so that
    no task sends words that do not reach it. A word stands by itself: parts of longer runs of key-like signs are
    none, so that no key adds its own pieces.
    """
    runs = F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"[\p{L}\p{N}_+/=-]++"), F.lit(0))
    words = df.select(F.explode(F.array_distinct(runs)).alias("w")).where(F.col("w").rlike("^[a-z]{3,20}$"))
    counts = words.groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    counts = materialize(counts, "words")
    cut, above = least, 0
    for n, times in counts.groupBy("n").agg(F.count("*")).orderBy(F.desc("n")).limit(size).collect():
        cut = n
        if above + times >= size:
            break
        above += times
    most = counts.where(F.col("n") >= cut).orderBy(F.desc("n"), "w").limit(size)
    return frozenset(r.w for r in most.select("w").collect())


def coverage(s: str, words: Collection[str]) -> int:
    """How many characters of ``s`` words of the dictionary cover: whole pieces, or else, inside a piece that words run
    together in, the longest words of four letters or more from its left."""
    covered = 0
    for piece in _PIECE.findall(s):
        piece = piece.lower()
        if len(piece) >= 3 and piece in words:
            covered += len(piece)
            continue
        at = 0
        while at <= len(piece) - 4:
            n = next((n for n in range(min(20, len(piece) - at), 3, -1) if piece[at : at + n] in words), 0)
            covered += n
            at += n or 1
    return covered


def measure(text: str, start: int, end: int, kind: str, words: Collection[str]) -> list[float]:
    """The features of a candidate, in the order of ``FEATURES``; ``words`` is the dictionary."""
    s = text[start:end]
    n = len(s)
    classes = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in s]
    shares = [c / n for c in Counter(s).values()]
    name = name_before(text, start)
    around = text[max(0, start - 80) : start].lower()
    near = set(re.findall(r"[a-z0-9_]+", around)[-6:])
    lower = s.lower()
    vowels = set("aeiou")
    rare = sum(a.isalpha() and b.isalpha() and a not in vowels and b not in vowels for a, b in zip(lower, lower[1:], strict=False))
    before = text[start - 1] if start else ""
    return [
        n, classes.count("d") / n, classes.count("u") / n, sum(c in "0123456789abcdefABCDEF" for c in s) / n,
        -sum(p * np.log2(p) for p in shares), sum(a != b for a, b in zip(classes, classes[1:], strict=False)) / n,
        rare / n, coverage(s, words) / n, kind in FORMS, any(w in name for w in SECRET_NAMES), name in OTHER_NAMES,
        bool(name), before in ("'", '"'), "://" in text[max(0, start - 80) : end].rsplit(" ", 1)[-1],
        before == "/" or "/" in s, text[end : end + 1] == "@" or before == "@", any(w in SECRET_NAMES for w in near),
        any(w in OTHER_NAMES for w in near),
    ]


def findings(df: DataFrame, key: str, text: str, words: Collection[str] | None = None) -> DataFrame:
    """All candidates of every whole text: ``id``, ``tag`` (the document), ``s``, ``e`` (characters), ``kind``,
    ``name`` and the features. Null and empty texts have none. ``words`` is by default the texts' own dictionary."""
    words = dictionary(df, text) if words is None else frozenset(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in range(6 + len(FEATURES))]
            for i, tag, body in zip(*(batch.column(j).to_pylist() for j in range(3)), strict=True):
                for start, end, kind in candidates(body or ""):
                    row = [i, tag, start, end, kind, name_before(body, start)]
                    row += map(float, measure(body, start, end, kind, words))
                    for column, x in zip(rows, row, strict=True):
                        column.append(x)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()] * len(FEATURES)
            names = ["id", "tag", "s", "e", "kind", "name", *FEATURES]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names)

    schema = "id long, tag long, s long, e long, kind string, name string, " + ", ".join(f"{f} double" for f in FEATURES)
    return df.select(row_id(key).alias("id"), text_tag(text).alias("tag"), F.col(text).alias("t")).mapInArrow(run, schema)


def by_rule() -> Column:
    """Labels of findings that need no forest: known forms and strings assigned to a secret's name are secrets; mail
    addresses, parts of URLs, all digits, and strings assigned to a checksum's or an id's name are not. Else null."""
    secret = (F.col("known_form") > 0) | (F.col("named_secret") > 0)
    other = (F.col("is_email") > 0) | (F.col("in_url") > 0) | (F.col("named_other") > 0) | (F.col("digits") == 1)
    return F.when(secret, 1.0).when(other, 0.0)


def fit(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> RandomForestClassificationModel | None:
    """A forest from findings with a ``label`` (0 or 1); none without both."""
    order = [F.xxhash64("id", "s"), "id", "s", "tag"]
    rows = labelled.where(F.col("label").isNotNull()).orderBy(*order).limit(train_rows)
    rows = materialize(VectorAssembler(inputCols=FEATURES, outputCol="x").transform(rows).select("label", "x"), "findings")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=30, maxDepth=6, seed=7)
    return forest.fit(rows.coalesce(2))


def scan(
    df: DataFrame,
    key: str,
    text: str,
    labelled: DataFrame | None = None,
    train_rows: int = TRAIN_ROWS,
    words: Collection[str] | None = None,
) -> DataFrame:
    """Every candidate of every document: ``id``, ``tag``, ``s``, ``e``, ``kind``, ``name``, ``score`` and ``secret``.

    ``labelled`` are findings with a ``label``; by default those of the same documents that ``by_rule`` labels. Where
    labels are all the same or missing, the rule decides, and what it leaves open is no secret. Rows with the same key
    and text have the same findings. ``words`` is the dictionary, the one that labelled findings were measured with; by
    default it is counted over these documents.
    """
    found = materialize(findings(df, key, text, words), "findings")
    model = fit(found.withColumn("label", by_rule()) if labelled is None else labelled, train_rows)
    out = ("id", "tag", "s", "e", "kind", "name")
    if model is None:
        scored = found.select(*out, F.coalesce(by_rule(), F.lit(0.0)).alias("score"))
    else:
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="x").transform(found))
        scored = scored.select(*out, F.element_at(vector_to_array("probability"), 2).alias("score"))
    return scored.withColumn("secret", F.col("score") >= 0.5)


def redact(df: DataFrame, key: str, text: str, scanned: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The rows with every secret in ``text`` replaced by ``mask``; all other columns and rows as they are."""
    spans = (
        scanned.where("secret").select("id", "tag", "s", "e").distinct()
        .groupBy(F.col("id").alias("_id"), F.col("tag").alias("_tag"))
        .agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("_spans"))
    )
    joined = df.withColumns({"_id": row_id(key), "_tag": text_tag(text)}).join(materialize(spans, "spans"), ["_id", "_tag"], "left")
    since = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("_spans"), i - 1)["e"]).cast("int")
    before = F.transform(
        "_spans", lambda x, i: F.concat(F.col(text).substr(since(i) + 1, x["s"].cast("int") - since(i)), F.lit(mask))
    )
    tail = F.col(text).substr(F.element_at("_spans", -1)["e"].cast("int") + 1, F.length(text))
    clean = F.when(F.col("_spans").isNotNull(), F.concat(F.array_join(before, ""), tail)).otherwise(F.col(text))
    return joined.select(*[clean.alias(c) if c == text else F.col(f"`{c}`") for c in df.columns])
