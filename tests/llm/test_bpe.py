"""Ids and decoded texts against the library that the vocabulary belongs to."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusloom.llm import bpe
from tests.llm import rows

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def both():
    return Tokenizer.from_file(PATH), bpe.Encoder(open(PATH, encoding="utf-8").read())


def agree(both, text):
    theirs = both[0].encode(text, add_special_tokens=False).ids
    packed = both[1].encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == theirs, text
    assert both[1].decode(packed) == both[0].decode(theirs, skip_special_tokens=False), text


def test_every_letter(both):
    for code in range(0, 0x20000):
        if not 0xD800 <= code < 0xE000:
            agree(both, f"a{chr(code)}b {chr(code)}")


def test_mixed_texts(both):
    rng = random.Random(5)
    signs = "aAbBΣσ'stre ll12½\t\n\x1c\x85 éé́ß!?…漢字\U0001f600İ"
    for _ in range(3000):
        parts = [rng.choice(signs) if rng.random() < 0.95 else "<|endoftext|>" for _ in range(rng.randrange(30))]
        agree(both, "".join(parts))
    agree(both, "ab" * 3000 + " " + "z" * 500)


def test_frame(spark, both):
    data = rows.documents()
    df = rows.frame(spark, data)
    got = bpe.decode(bpe.encode(df, "doc_id", "text", PATH), PATH).collect()
    want = [(i, both[0].encode(t or "", add_special_tokens=False).ids) for i, t in data]
    assert sorted((r.doc_id is not None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in got) == sorted(
        (i is not None, i or 0, ids, both[0].decode(ids, skip_special_tokens=False)) for i, ids in want
    )
    assert bpe.encode(df.limit(0), "doc_id", "text", PATH).collect() == []
