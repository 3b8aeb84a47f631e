"""Edge rows of the text functions, and brute-force comparison on random texts."""

import os
import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import normalize as N
from corpusloom.functions import scores as P
from corpusloom.functions import text as T
from corpusloom.functions import tokens as K
from corpusloom.operators import aggregates as E
from corpusloom.operators import long_texts as L
from corpusloom.plans import jobs


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first().y


def words(n):
    return " ".join(f"w{i}" for i in range(n))


def run(spark, texts, expr):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    return [r.y for r in df.select("i", expr.alias("y")).orderBy("i").collect()]


ODD = ["", " ", None, "a", " a b　", "a\x1cb\x1fc", "x​y", "\ttab\nline\r\n", "ünï çödé \U0001f600 z"]


def test_tokens_follow_str_split(spark):
    got = run(spark, ODD, K.WHITESPACE.tokens("x"))
    assert got == [None if t is None else t.split() for t in ODD]
    assert run(spark, ODD, K.token_count("x")) == [None if t is None else len(t.split()) for t in ODD]
    assert run(spark, ODD, K.char_count("x")) == [None if t is None else len(t) for t in ODD]
    assert run(spark, ODD, K.strip("x")) == [None if t is None else t.strip() for t in ODD]
    assert run(spark, ODD, K.is_blank("x")) == [t is None or not t.strip() for t in ODD]


@pytest.mark.parametrize("n", [0, 1, 509, 510, 511, 970, 971])
def test_truncate_and_chunk_lengths(spark, n):
    text = words(n)
    row = (
        spark.createDataFrame([(text,)], "x string")
        .select(
            *[T.truncate("x", strategy=s).alias(s) for s in ("head", "tail", "middle", "other")],
            T.chunks("x").alias("chunks"),
        )
        .first()
    )
    tokens = text.split()
    if n <= 510:
        assert row.head == row.tail == row.middle == text and row.chunks == [text]
        return
    start = (n - 510) // 2
    assert row.head.split() == tokens[:510] == row.other.split()
    assert row.tail.split() == tokens[-510:]
    assert row.middle.split() == tokens[start : start + 510]
    assert len(row.chunks) == -(-(n - 510) // 460) + 1
    rebuilt = row.chunks[0].split() + [t for c in row.chunks[1:] for t in c.split()[50:]]
    assert rebuilt == tokens


def test_chunk_rejects_overlap(spark):
    with pytest.raises(ValueError):
        T.chunks("x", 10, 10)


def test_chunk_keeps_null_and_blank(spark):
    df = spark.createDataFrame([(1, None), (2, " ")], "i int, text string")
    got = sorted(tuple(r) for r in L.chunk(df).select("i", "chunk_pos", "text").collect())
    assert got == [(1, 0, None), (2, 0, " ")]


def brute_smart(text, limit):
    if len(text.split()) <= limit:
        return text
    kept = ""
    for sentence in text.split(". "):
        longer = kept + sentence + ". "
        if len(longer.split()) > limit:
            break
        kept = longer
    return kept.strip() if kept else " ".join(text.split()[:limit])


def brute_head_tail(text, budget, ratio, sentence):
    import re

    tokens = text.split()
    if len(tokens) <= budget:
        return text
    head = max(1, int(budget * ratio))
    tail = budget - head
    if sentence:
        parts = re.split(r"(?<=[.!?])\s+", text)

        def fitting(seq, limit):
            total, n = 0, 0
            for s in seq:
                total += len(s.split())
                if total > limit:
                    break
                n += 1
            return n

        h, t = fitting(parts, head), fitting(parts[::-1], tail)
        if h or t:
            return " ".join(parts[:h] + ["..."] + (parts[-t:] if t else []))
    return " ".join(tokens[:head] + ["..."] + (tokens[-tail:] if tail else []))


def random_texts(seed, n=300):
    rng = random.Random(seed)
    pieces = ["a", "bb", "ccc", ". ", ". . ", "! ", "?\n", "  ", "\n", "\t", "d.", ".", "e. ", " ", "f "]
    return ["".join(rng.choice(pieces) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize("limit", [1, 3, 8])
def test_smart_truncate_brute_force(spark, limit):
    texts = random_texts(limit)
    want = [brute_smart(t, limit) for t in texts]
    assert run(spark, texts, T.smart_truncate("x", limit)) == want
    split = K.tokenizer_udf(lambda t: t.split(), glue=" ")
    assert run(spark, texts, T.smart_truncate("x", limit, split)) == want


@pytest.mark.parametrize("sentence", [False, True])
@pytest.mark.parametrize("budget,ratio", [(4, 0.75), (8, 0.5), (6, 1.0), (1, 0.75)])
def test_head_tail_brute_force(spark, budget, ratio, sentence):
    texts = random_texts(budget)
    got = run(spark, texts, T.head_tail("x", budget, ratio, "sentence" if sentence else "token"))
    assert got == [brute_head_tail(t, budget, ratio, sentence) for t in texts]


def test_head_tail_default_budget(spark):
    assert one(spark, words(450), T.head_tail("x")) == words(450)
    cut = one(spark, words(451), T.head_tail("x")).split()
    assert (len(cut), cut[336], cut[337], cut[338]) == (451, "w336", "...", "w338")
    spaced = "a  b"
    assert one(spark, spaced, T.head_tail("x")) == spaced


@pytest.mark.parametrize("n", [100, 2000])
def test_ellipsize(spark, n):
    assert one(spark, "é" * n, T.ellipsize("x", n)) == "é" * n
    assert one(spark, "é" * (n + 1), T.ellipsize("x", n)) == "é" * n + "..."


def test_length_bins_are_right_closed(spark):
    values = [0, 1, 128, 129, 256, 384, 512, 513, 1024, 2048, 2049]
    df = spark.createDataFrame([(v,) for v in values], "token_count int")
    got = {r.token_count: r.b for r in df.select("token_count", T.length_bin("token_count").alias("b")).collect()}
    assert got == {
        0: None, 1: "0-128", 128: "0-128", 129: "128-256", 256: "128-256", 384: "256-384", 512: "384-512",
        513: "512-1024", 1024: "512-1024", 2048: "1024-2048", 2049: "2048+",
    }
    histogram = E.length_histogram(df.where("token_count < 129"), short_labels=True).collect()
    assert [(r.token_bin, r["count"]) for r in histogram] == [
        ("0-128", 2), ("128-256", 0), ("256-384", 0), ("384-512", 0), ("512-1K", 0), ("1K-2K", 0), ("2K+", 0)
    ]


def test_truncation_record(spark):
    texts = [None, "  ", "a b. c", "a b c. d e f. g"]
    got = run(spark, texts, T.truncation_record("x", 4))
    assert got[:2] == [None, None]
    assert tuple(got[2]) == ("a b. c", 6, 6, 3, 3, False)
    assert tuple(got[3]) == ("a b c.", 15, 6, 7, 3, True)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=20), st.integers(2, 6))
def test_chunks_cover_all_tokens(spark, texts, limit):
    for text, chunks in zip(texts, run(spark, texts, T.chunks("x", limit, 1))):
        if len(text.split()) <= limit:
            assert chunks == [text]
        else:
            assert all(len(c.split()) <= limit for c in chunks)
            assert chunks[0].split() + [t for c in chunks[1:] for t in c.split()[1:]] == text.split()


BPE = "/opt/tokenizers/byte_bpe_50k.json"


@pytest.mark.skipif(not os.path.exists(BPE), reason="no vocabulary file")
def test_subword_tokenizer(spark):
    from tokenizers import Tokenizer

    def load():
        tokenizer = Tokenizer.from_file(BPE)

        def pieces(text):
            ends = [end for _, end in tokenizer.encode(text, add_special_tokens=False).offsets]
            out, start = [], 0
            for end in ends:
                out.append(text[start:end])
                start = max(start, end)
            return [*out[:-1], out[-1] + text[start:]] if out else out

        return pieces

    tk = K.FunctionTokenizer(load)  # as a user brings one
    texts = ["Hello there, general. Kenobi was here. And then he left", "ünï çödé \U0001f600!", "", None, "  two  spaces "]
    got = run(spark, texts, tk.tokens("x"))
    assert all(t is None or "".join(p) == t for p, t in zip(got, texts))
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(BPE)
    assert [len(p) for p in got if p is not None] == [len(plain.encode(t, add_special_tokens=False).ids) for t in texts if t is not None]
    n = len(plain.encode("Hello there, general. ", add_special_tokens=False).ids)
    assert one(spark, texts[0], T.smart_truncate("x", n, tk)) == "Hello there, general."
    chunks = one(spark, texts[0], T.chunks("x", 5, 2, tk))
    assert all(len(tk_piece) <= len(texts[0]) for tk_piece in chunks) and texts[0].startswith(chunks[0])


def test_profiles_of_chunked_texts(spark):
    df = spark.createDataFrame([(words(25),), (words(3),)], "text string")
    split = K.tokenizer_udf(lambda t: t.split(), glue=" ")
    for tk in (None, split):
        result = jobs.process_long_texts(df, "chunk", limit=60, tokenizer=tk)
        assert {r.stage: (r.total_samples, r.tokens_max) for r in result.profile.collect()} == {"before": (2, 25), "after": (2, 25)}
        result = jobs.process_long_texts(df, "simple", limit=10, tokenizer=tk)
        got = {r.stage: (r.total_samples, r.tokens_max, r.words_mean) for r in result.profile.collect()}
        assert got == {"before": (2, 25, 14.0), "after": (2, 10, 6.5)}
        assert (result.summary.first().truncated, result.summary.first().max_final_tokens) == (1, 10)


def test_unknown_strategy_warns(spark):
    df = spark.createDataFrame([("a b. c d",)], "text string")
    with pytest.warns(UserWarning):
        assert L.shorten(df, strategy="other", limit=3).first().text == "a b."


def test_encode_fixed(spark):
    df = spark.createDataFrame([("a b a",), ("",), (words(9),)], "text string")
    rows = L.encode_fixed(df, length=5).collect()
    assert all(len(r.input_ids) == len(r.attention_mask) == 5 for r in rows)
    assert rows[0].attention_mask == [1, 1, 1, 0, 0] and rows[0].input_ids[0] == rows[0].input_ids[2] != 0
    assert rows[1].input_ids == [0] * 5 and rows[2].attention_mask == [1] * 5


def test_normalisers(spark):
    urls = ["HTTPS://A.com/P?q=1#f", "http://a.com/x#y?z", "", None, "?q", "a.com/b"]
    assert run(spark, urls, N.normalize_url("x")) == ["https://A.com/P", "http://a.com/x", None, None, None, "a.com/b"]
    assert run(spark, ["  A B ", None, ""], N.normalize_title("x")) == ["a b", "", ""]
    dates = ["2024-02-29T10:00:00Z", "2024-02-30", "soon", None, "2024-01-05"]
    got = run(spark, dates, N.format_date(N.parse_date("x")))
    assert got == ["2024-02-29", None, None, None, "2024-01-05"]
    stamps = ["2024-06-29 12:00:01", "2024-06-29 12:00:00", "2024-06-30 12:00:00.000001", None]
    got = run(spark, stamps, N.age_days(F.col("x").cast("timestamp"), "2024-06-30 12:00:00"))
    assert got == [0, 1, -1, None]


def test_scores(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 1.0]), (2, [1000.0, -1000.0]), (3, None), (4, [0.0, 0.5])], "i int, a array<double>"
    )
    rows = df.select(
        "i", P.softmax("a").alias("p"), P.argmax("a").alias("k"), P.argmax_label("a", ["x", "y"]).alias("l")
    ).orderBy("i").collect()
    assert rows[0].p == [0.5, 0.5] and rows[0].k == 0 and rows[0].l == "x"
    assert rows[1].p == [1.0, 0.0]
    assert (rows[2].p, rows[2].k, rows[2].l) == (None, None, None)
    assert rows[3].p == pytest.approx([0.37754066879814546, 0.6224593312018546]) and rows[3].l == "y"


def test_length_stats_sample_deviation_and_median(spark):
    df = spark.createDataFrame([(words(n),) for n in (1, 2, 3, 600)], "text string")
    row = E.length_stats(df).first()
    assert (row.total_samples, row.tokens_median, row.tokens_max, row.over_limit_count) == (4, 2.5, 600, 1)
    assert row.tokens_std == pytest.approx(299.0006, abs=1e-3) and row.over_limit_pct == 25.0
    assert E.length_stats(df, approximate=True).first().tokens_median in (2.0, 3.0)


def test_tokens_of_a_batch_are_not_held_together(spark, monkeypatch):
    texts = pd.Series(["ab " * 5, None, "", "x" * 40, "c d", "e"] * 3)
    monkeypatch.setattr(K, "PART_CHARS", 16)
    split = K.tokenizer_udf(str.split)
    want = [None if t is None else t.split() for t in texts]
    parts = list(split._tokens.func(iter([texts, texts[:0]])))
    assert [t for p in parts for t in p] == want and len(parts) > 6
    assert max(sum(len(t or "") for t in p) for p in K._parts(texts)) <= 40 + 16
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    got = df.select("i", split.tokens("t").alias("w"), split.count("t").alias("n")).orderBy("i").collect()
    assert [r.w for r in got] == want and [r.n for r in got] == [None if w is None else len(w) for w in want]
