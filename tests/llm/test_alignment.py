"""Alignment against a plain version that walks every token, on real vocabularies and awkward texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import alignment
from tests.llm.rows import documents, frame

tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def files():
    with open(tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        return a.read(), b.read()


ODD = [
    "two  spaces   and\ttabs \n\n lines ", " leading", "trailing ", "   ", "\n", "▁ already", "a▁b c", "<|endoftext|> <s> <unk> <0x0A>",
    "naïve café — Ünïcödé… 中文字符 混合 text 日本", "😀😃 emoji👩‍👩‍👧 zwj", "=" * 500, "ab" * 400, "\x00\x1c\x85\xa0　 x", "x  y \x1f z", "it's we'll 1234567 3.14",
    "word " * 300, "́combining é", "Ａ１ ﬁ ①",
]


def plain(texts, files):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_str(files[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=files[1])
    letters = {v: k for k, v in enumerate(alignment.byte_letters())}

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    out, held = [], Counter()
    for text in texts:
        want = (" " + text).encode() if text else b""
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        raw_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in x]
        raw_b = [bytes_b(i) for i in y]
        if not text or b"".join(raw_a) != want or b"".join(raw_b) != want:
            out.append((0, 0, [], Counter()))
            continue
        groups, links, i, j, end_a, end_b = [], Counter(), 0, 0, 0, 0
        start = (0, 0)
        while i < len(x) or j < len(y):
            if end_a <= end_b:
                end_a += len(raw_a[i])
                i += 1
            else:
                end_b += len(raw_b[j])
                j += 1
            if end_a == end_b:
                own_a, own_b = x[start[0] : i], y[start[1] : j]
                groups.append(",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b)))
                links.update((p, q) for p in own_a for q in own_b)
                start = (i, j)
        held.update(links.keys())
        out.append((len(x), len(y), groups, links))
    most = {}
    for (p, _), n in held.items():
        most[p] = max(most.get(p, 0), n)
    return [
        (n_a, n_b, len(g), sum(links.values()), sum(n for k, n in links.items() if held[k] == most[k[0]]), sum(n * held[k] for k, n in links.items()), ";".join(g))
        for n_a, n_b, g, links in out
    ]


def columns(rows):
    return sorted(
        [(r.doc_id if r.doc_id is not None else -1, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in rows]
    )


@pytest.mark.parametrize("block", [1, 1000, 1 << 20])
def test_same_as_plain(spark, files, block):
    rows = documents(3) + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, ODD[0])]
    expected = plain([t for _, t in rows], files)
    got = alignment.link_counts(frame(spark, rows).repartition(3), "doc_id", "text", *files, block=block)
    assert columns(got.collect()) == sorted((-1 if i is None else i, *e) for (i, _), e in zip(rows, expected, strict=True))


def test_digest_and_wide_groups(spark, files, monkeypatch):
    rows = [(1, "=" * 500 + " x"), (2, None)]
    expected = plain([t for _, t in rows], files)
    got = alignment.link_counts(frame(spark, rows), "doc_id", "text", *files, digest=True).orderBy("doc_id").collect()
    assert got[0].groups == hashlib.sha256(expected[0][-1].encode()).hexdigest() and got[1].groups == ""
    pair = alignment.Pair(*files)
    tokens = pair.tokens([t for t in ODD if "▁" not in t])
    tokens = [t for t in tokens if t]
    narrow = alignment.Aligned.of(pair, tokens).links(32000, 40)
    monkeypatch.setattr(alignment, "WIDE", 1)
    wide = alignment.Aligned.of(pair, tokens).links(32000, 40)
    assert all((p == q).all() for p, q in zip(narrow, wide, strict=True))


def test_forgetting_changes_nothing(files, monkeypatch):
    texts = [t for _, t in documents(5) if t]
    pair = alignment.Pair(*files)
    before = [t and tuple(map(bytes, t)) for t in pair.tokens(texts)]
    monkeypatch.setattr(alignment, "REMEMBERED", 10)
    monkeypatch.setattr(alignment, "LONG_UNIT", 1)
    assert [t and tuple(map(bytes, t)) for t in pair.tokens(texts) if True] == before


def test_both_ways_of_the_first_vocabulary_agree(files):
    """The quicker one is used for Latin signs alone: every sign of these, in four surroundings."""
    pair = alignment.Pair(*files)
    for c in map(chr, range(0x250)):
        for text in (f" {c}", f" a{c}", f" {c}1", f" x{c}{c}y'{c} {c}"):
            assert pair.quick.encode_ordinary(text) == pair._encode_a([text])[0], repr(text)
    assert alignment._UNCOMMON.search("\u0250") and not alignment._UNCOMMON.search("\u024f\x00 az")


def test_gallop():
    rng = random.Random(4)
    for _ in range(200):
        y = np.array(sorted(rng.sample(range(1000), rng.randrange(1, 200))))
        x = np.array([rng.randrange(y[-1] + 1) for _ in range(50)])
        start = np.array([rng.randrange(len(y)) for _ in x])
        assert (alignment.gallop(x, y, start) == np.searchsorted(y, x)).all()


def test_empty_table(spark, files):
    assert alignment.link_counts(frame(spark, [(1, "x")]).where("false"), "doc_id", "text", *files).count() == 0
    got = alignment.link_counts(frame(spark, [(1, None), (2, "")]), "doc_id", "text", *files).collect()
    assert columns(got) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
