"""Collocations against a plain count of all phrases, and the filters against dictionaries."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import collocations, quotient

SCHEMA = "doc_id long, text string, lang string, word string, block long, n long"


def plain(rows, least, top, cover=80):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang or "und"] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts[lang or "und", tuple(words[i : i + n])] += 1
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, words), a in candidates.items():
        longer = [
            b for (other, w), b in candidates.items()
            if other == lang and len(w) > len(words) and any(w[i : i + len(words)] == words for i in range(len(w)))
        ]
        if any(100 * b >= cover * a for b in longer):
            continue
        cuts = [(2000000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, totals[lang], -s)
        for lang, found in out.items()
        for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])
    )


def texts(seed=2, n=150):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "City", "Ünï", "x1", "<b>", "\x1cq", "a_b", "'s"]
    rows = []
    for _ in range(n):
        out = []
        for _ in range(rng.randrange(60)):
            out.append(rng.choice(["new york city hall", "kick the bucket", "of the", *words]))
            out.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " ! "]))
        rows.append(("".join(out), rng.choice(["en", "en", "en", "fr", None])))
    return rows + [(None, "en"), ("", "fr"), (" . ", "de"), ("solo", None)] + [rows[0]] * 40


@pytest.mark.parametrize("sizes", [{}, {"block": 300, "shard": 20, "round_bits": 2}, {"block": 2000, "shard": 3, "round_bits": 3}])
def test_same_as_plain(spark, sizes):
    rows = texts()
    frame = spark.createDataFrame([(i, t, g, "w", 1, 2) for i, (t, g) in enumerate(rows)], SCHEMA).repartition(3)
    got = collocations.collocations(frame, "text", "lang", least=5, top=25, **sizes).collect()
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == plain(rows, 5, 25)


def test_nothing_to_find(spark):
    frame = spark.createDataFrame([(1, "a b c", "en", "w", 1, 2), (2, None, None, "w", 1, 2)], SCHEMA)
    assert collocations.collocations(frame).count() == 0
    assert collocations.collocations(frame.where("false")).count() == 0


def test_very_long_text(spark):
    text = "big apple pie. " * 20_000
    frame = spark.createDataFrame([(1, text, "en", "w", 1, 2)], SCHEMA)
    got = collocations.collocations(frame, block=10_000).collect()
    assert [(r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got] == [("big apple pie", 20_000, 20_000, 20_000, 60_000, 1_000_000)]


@pytest.mark.parametrize("n", [2, 3, 4])
@pytest.mark.parametrize("largest", [1, 3, 300, 70_000, 2**32 - 1])
def test_filter_is_lossless(n, largest):
    rng = np.random.default_rng(n)
    bits = quotient.id_bits(largest)
    half = n * bits // 2
    words = [rng.integers(1, largest, 3000, endpoint=True, dtype=np.uint64) for _ in range(n)]
    words = [np.concatenate([w, np.repeat(w[:2], 400)]) for w in words]
    left, right = quotient.permute(*quotient.pack(words, bits), half)
    assert int(left.max()) < 1 << half and int(right.max()) < 1 << half
    expected = Counter(zip(*(w.tolist() for w in words), strict=True))
    cut = len(left) // 2
    parts = [quotient.Filter.of(half, left[:cut], right[:cut]), quotient.Filter.of(half, left[cut:], right[cut:])]
    for shard_bits in (0, 1, min(5, half)):
        shards = {}
        for part in parts:
            for prefix, piece in part.split(shard_bits):
                shards.setdefault(prefix, []).append(quotient.Filter.load(piece.dump(shard_bits), prefix))
        found = Counter()
        for pieces in shards.values():
            merged = quotient.Filter.merged(pieces)
            back = quotient.unpack(*quotient.restore(merged.left, merged.right, half), n, bits)
            keys = list(zip(*(b.tolist() for b in back), strict=True))
            assert len(set(keys)) == len(keys)
            found.update(dict(zip(keys, merged.count.tolist(), strict=True)))
        assert found == expected


def test_filter_is_compact():
    rng = np.random.default_rng(1)
    words = [rng.integers(1, 60_000, 200_000, dtype=np.uint64) for _ in range(2)]
    whole = quotient.Filter.of(16, *quotient.permute(*quotient.pack(words, 16), 16))
    assert len(whole.dump(0)) < 4 * len(whole.left)


def test_too_many_words():
    with pytest.raises(ValueError):
        quotient.id_bits(2**32)
