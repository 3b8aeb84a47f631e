"""Quality rules whose cutoffs are chosen under a proven limit on false rejections.

Every rule scores a text from 0 to 1000, higher being worse, and rejects it above a cutoff. Labelled texts are cut in
two by their checksum. The design part gives each stratum a ladder of settings: first cutoffs far beyond every good
text, then ever larger shares of good texts rejected by each rule. The holdout part then tests the settings in that
order. A setting passes when its false rejections among the ``n`` good holdout texts would be so few with a
probability of at most ``delta / strata``, were the true rate above ``alpha`` (exact binomial tail); the first that does not
pass ends the climb, and the last that passed is used. Settings are fixed before the holdout is looked at and
tested in a fixed order, so the climb needs no correction of its own; the strata share ``delta`` (Bonferroni). With
probability ``1 - delta`` no stratum loses more than ``alpha`` of its good texts to the rules.

DataFrame functions only. All labelled rows count; what is gathered per stratum and rule is a histogram of at most 1001
scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.session import discard, materialize

SYMBOLS, CAPITALS, DIGITS = "[#*$%&|<>]", "[A-Z]", "[0-9]"
#: The order of the scores in ``scores``.
RULES = ("symbols", "capitals", "digits", "repeats", "dup_lines", "short_lines", "long_words", "short_words")
#: The ladder: cutoffs so far (as a share) between the worst good design text and 1000, then those that reject this
#: share of the good design texts.
MARGINS = (0.75, 0.5, 0.25, 0.125, 0.0625)
SHARES = (0.0, 1 / 2048, 1 / 1024, 1 / 512, 1 / 256, 1 / 128, 1 / 64, 1 / 32)
LEVELS = len(MARGINS) + len(SHARES)
#: A rule takes part in a stratum if the last setting rejects this many times the share of bad that it does of good.
LIFT = 2
ALPHA, DELTA = 0.01, 0.05
#: Stands for a missing stratum.
NO_STRATUM = "und"


def _share(part: Column, whole: Column) -> Column:
    """Thousandths, rounded down, at most 1000."""
    return F.least(F.lit(1000), F.floor(part * 1000 / F.greatest(whole, F.lit(1)))).cast("int")


def measure(df: DataFrame, key: str, text: str, stratum: str) -> DataFrame:
    """Per row: ``key``, ``stratum``, ``digest`` of the text, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed`` and ``scores`` in the order of ``RULES``.

    Words are runs of anything but ASCII white space. Windows of three words are compared by 64-bit hashes within the
    text: sorted, so time is n log n in a text's words whatever repeats.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(key).alias("k"), F.coalesce(F.col(stratum), F.lit(NO_STRATUM)).alias("stratum"), body.alias("body")
    )
    # each step is a projection of its own: what lambdas refer to must be a column, or it is computed per element
    rows = rows.select(
        "k", "stratum", "body",
        F.filter(F.split("body", r"[ \x09-\x0D]+"), lambda w: w != "").alias("words"),
        F.filter(F.split("body", "\n"), lambda s: s.rlike(r"[^ \x09-\x0D]")).alias("lines"),
    ).select(
        "k", "stratum",
        F.md5(F.col("body").cast("binary")).alias("digest"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("body", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("body", F.lit(CAPITALS)).alias("n_capitals"),
        F.regexp_count("body", F.lit(DIGITS)).alias("n_digits"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.slice(
            F.transform(
                "words",
                lambda w, i: F.struct(
                    F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("p")
                ),
            ),
            1,
            F.greatest(F.size("words") - 2, F.lit(0)),
        ).alias("windows"),
    )
    kept = [c for c in rows.columns if c != "windows"]
    hashes = F.col("windows.h")
    rows = rows.select(
        *kept,
        F.when(F.size(F.array_distinct(hashes)) < F.size("windows"), F.sort_array("windows")).alias("ordered"),
    )
    at = F.transform(
        F.filter(
            F.transform(
                "ordered",
                lambda x, i: F.struct(
                    x["p"].alias("p"),
                    F.coalesce(F.get("ordered", i + 1)["h"] == x["h"], F.lit(False)).alias("next"),
                    F.coalesce(F.get("ordered", i - 1)["h"] == x["h"], F.lit(False)).alias("prior"),
                ),
            ),
            lambda x: x["next"] | x["prior"],
        ),
        lambda x: x["p"],
    )
    rows = rows.select(*kept, F.sort_array(at).alias("at"))
    # a window covers three words, or those up to the next window's first
    steps = F.transform("at", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("at", i + 1) - p, F.lit(3))).cast("long"))
    rows = rows.select(
        *kept, F.coalesce(F.aggregate(steps, F.lit(0).cast("long"), lambda n, x: n + x), F.lit(0)).alias("n_repeat_words")
    )
    length = F.least(F.lit(1000), F.floor(F.col("word_chars") * 10 / F.greatest("n_words", F.lit(1)))).cast("int")
    return rows.select(
        F.col("k").alias(key), "stratum", "digest", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        F.array(
            _share(F.col("n_symbols"), F.col("word_chars")),
            _share(F.col("n_capitals"), F.col("word_chars")),
            _share(F.col("n_digits"), F.col("word_chars")),
            _share(F.col("n_repeat_words"), F.col("n_words")),
            _share(F.col("n_dup_lines"), F.col("n_lines")),
            _share(F.col("n_lines"), F.col("n_words")),
            length,
            F.lit(1000) - length,
        ).alias("scores"),
    )


def base_failed() -> Column:
    """Too few words, or more than half of them in windows of three that occur again."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def labelled(measured: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Distinct labelled texts that pass the base rule: ``stratum``, ``scores``, ``good`` and ``design``.

    A text that is there several times counts once, or copies would pass for independent evidence; it is good if all
    its labels are 1. Labels other than 0 and 1, and those without a key, count for nothing.
    """
    marks = (
        labels.select(F.col(key).alias("mark_of"), F.col(label).alias("mark"))
        .where("mark_of IS NOT NULL AND mark IN (0, 1)")
        .groupBy("mark_of")
        .agg(F.min("mark").alias("good"))
    )
    texts = (
        measured.where("NOT base_failed")
        .join(marks, F.col(key) == F.col("mark_of"))
        .groupBy("stratum", "digest")
        .agg(F.min("scores").alias("scores"), F.min("good").alias("good"))
    )
    part = F.conv(F.substring("digest", 1, 6), 16, 10).cast("int") % 3
    return texts.select("stratum", "scores", (F.col("good") == 1).alias("good"), (part == 0).alias("design"))


def ladder(design: DataFrame) -> DataFrame:
    """Per stratum: ``levels``, the cutoffs of each setting in the order of ``RULES`` (1000: never rejects)."""
    cells = (
        design.select("stratum", "good", F.posexplode("scores").alias("rule", "score"))
        .groupBy("stratum", "rule", "score")
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    )
    rule = W.partitionBy("stratum", "rule")
    above = rule.orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, -1)
    cells = cells.select(
        "stratum", "rule", "score", "good", "bad",
        F.coalesce(F.sum("good").over(above), F.lit(0)).alias("good_above"),
        F.coalesce(F.sum("bad").over(above), F.lit(0)).alias("bad_above"),
        F.sum("good").over(rule).alias("n_good"),
        F.sum("bad").over(rule).alias("n_bad"),
    )
    seen = F.col("good") > 0
    worst = F.max(F.when(seen, F.col("score")))
    cuts = [(worst + F.floor((1000 - worst) * m)).cast("int") for m in MARGINS]
    cuts += [F.min(F.when(seen & (F.col("good_above") <= F.floor(F.col("n_good") * s)), F.col("score"))) for s in SHARES]
    lost = F.max(F.when(seen & (F.col("good_above") <= F.floor(F.col("n_good") * SHARES[-1])), F.col("bad_above")))
    rules = cells.groupBy("stratum", "rule").agg(
        F.array(*cuts).alias("cuts"), lost.alias("lost"), F.max("n_bad").alias("n_bad")
    )
    takes_part = (F.col("n_bad") > 0) & (F.col("lost") >= LIFT * SHARES[-1] * F.col("n_bad"))
    rules = rules.where("cuts[0] IS NOT NULL").select("stratum", "rule", takes_part.alias("active"), "cuts")
    strata = rules.groupBy("stratum").agg(F.sort_array(F.collect_list(F.struct("rule", "active", "cuts"))).alias("rules"))
    cutoffs = F.transform(
        F.sequence(F.lit(0), F.lit(LEVELS - 1)),
        lambda j: F.transform("rules", lambda r: F.when(r["active"], F.get(r["cuts"], j)).otherwise(F.lit(1000))),
    )
    return strata.select("stratum", cutoffs.alias("levels"))


def exceeds(scores: Column, cutoffs: Column) -> Column:
    return F.exists(F.arrays_zip(scores.alias("s"), cutoffs.alias("c")), lambda x: x["s"] > x["c"])


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """The probability of at most ``k`` among ``n`` at the given rate, exact but for rounding; 1 where ``k`` is at least
    the expected number, which no test passes. Summed in logarithms, so no ``n`` underflows."""
    odds = rate / (1 - rate)
    first = n.cast("double") * F.log(F.lit(1 - rate))
    start = F.struct(first.alias("term"), first.alias("total"))

    def step(so_far: Column, i: Column) -> Column:
        term = so_far["term"] + F.log((n - i + 1) * F.lit(odds) / i)
        high, low = F.greatest(so_far["total"], term), F.least(so_far["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    tail = F.exp(F.aggregate(terms, start, step)["total"])
    return F.when(k >= n * F.lit(rate), F.lit(1.0)).otherwise(tail)


def certify(texts: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Per stratum with a certified setting: ``stratum``, ``level`` (from 0), ``cutoffs``, ``n`` good holdout texts,
    ``k`` of them rejected, and the tail ``p``."""
    levels = materialize(ladder(texts.where("design")), "ladder")
    holdout = texts.where("good AND NOT design").join(levels, "stratum")
    counts = [
        F.count_if(exceeds(F.col("scores"), F.get("levels", F.lit(j)))).alias(f"k{j}") for j in range(LEVELS)
    ]
    tested = holdout.groupBy("stratum").agg(F.count("*").alias("n"), *counts)
    tested = materialize(tested.select("stratum", "n", F.array(*[f"k{j}" for j in range(LEVELS)]).alias("ks")), "tested")
    strata = max(tested.count(), 1)
    p = F.transform("ks", lambda k: binomial_tail(k, F.col("n"), alpha))
    judged = tested.select("stratum", "n", "ks", p.alias("ps"))
    failed = F.array_position(F.transform("ps", lambda x: x > F.lit(delta / strata)), True)
    level = (F.when(failed == 0, F.lit(LEVELS)).otherwise(failed) - 1).cast("int") - 1
    judged = judged.withColumn("level", level).where("level >= 0")
    return judged.join(levels, "stratum").select(
        "stratum", "level", F.get("levels", F.col("level")).alias("cutoffs"), "n",
        F.get("ks", F.col("level")).alias("k"), F.get("ps", F.col("level")).alias("p"),
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    label: str = "quality",
    alpha: float = ALPHA,
    delta: float = DELTA,
) -> DataFrame:
    """Per row: ``key``, the five counts, ``base_failed``, ``failed`` (names of the rules above their cutoff) and ``kept``.

    A stratum without a certified setting (too few good labels: at ``alpha`` 0.01 some hundreds are needed) rejects by
    the base rule alone. Null texts have no words and fail the base rule; a null stratum is one of its own, named
    ``und``; a null key is judged like any other but has no label; rows with the same key are judged one by one, each by
    its own text. An empty table gives no rows, empty labels certify nothing. Other columns are not looked at. Texts of any
    length are read whole.
    """
    measured = materialize(measure(docs, key, text, stratum), "measured")
    texts = materialize(labelled(measured, labels, key, label), "labelled")
    chosen = materialize(certify(texts, alpha, delta).select("stratum", "cutoffs"), "cutoffs")
    discard(texts)
    broken = F.filter(
        F.arrays_zip("scores", "cutoffs", F.array(*[F.lit(r) for r in RULES]).alias("rule")),
        lambda x: x["scores"] > x["cutoffs"],
    )
    failed = F.when(F.col("cutoffs").isNull(), F.array().cast("array<string>")).otherwise(
        F.transform(broken, lambda x: x["rule"])
    )
    return (
        measured.join(chosen, "stratum", "left")
        .select(
            key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", failed.alias("failed")
        )
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
    )
