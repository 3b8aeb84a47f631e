"""Byte-pair encoding with a public vocabulary, and decoding.

Each word is a doubly linked list of symbols. A heap holds the possible merges by rank, then place; an entry whose
symbols have changed since it was pushed is stale and skipped. Words repeat, so a worker remembers their ids.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _classes() -> tuple[str, str]:
    """Character classes of letters and of numbers, as ranges."""
    ranges: dict[str, list] = {"L": [], "N": []}
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind in ranges:
            if ranges[kind] and ranges[kind][-1][1] == code - 1:
                ranges[kind][-1][1] = code
            else:
                ranges[kind].append([code, code])
    ranges["L"] += NEW_LETTERS
    ranges["N"] += NEW_NUMBERS
    return tuple("".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in ranges[k]) for k in "LN")


#: Letters, numbers and lower cases newer than this Python's Unicode tables, which the vocabulary's
#: own library knows (first, last; for lower cases the distance).
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEW_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)
NEW_LOWER = (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1),
    (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC),
    (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B),
)
#: White space as Unicode defines it, and the contractions the vocabulary was made with.
SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself, or for the others 256 and on in their order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Encoder:
    """One vocabulary file of the word-end kind: its merges, special tokens and remembered words."""

    LIMIT = 400_000

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        vocab = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.strings = [""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])], default=0))
        for token, number in vocab.items():
            self.strings[number] = token
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, number in self.special.items():
            self.strings[number] = token
        self.letters = [vocab[c] for c in byte_letters()]
        self.last = [vocab[c + self.end] for c in byte_letters()]
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        letter, number = _classes()
        # a word that no contraction begins is a run of letters, one number, or a run of other signs
        self.words = re.compile(f"{CONTRACTIONS}|[{letter}]+|[{number}]|[^{SPACE}{letter}{number}]+")
        self.lower = {c: c + d for a, b, d in NEW_LOWER for c in range(a, b + 1)}
        self.new = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b, _ in NEW_LOWER) + "]")
        self.spaces, self.odd = re.compile(f"[{SPACE}]+"), re.compile("[\x1c-\x1f]")
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.known: dict[str, bytes] = {}
        self.known_words: dict[str, bytes] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        n, merges, push = len(symbols), self.merges, heapq.heappush
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []
        for i, pair in enumerate(zip(symbols, symbols[1:], strict=False)):
            if pair in merges:
                rank, merged = merges[pair]
                heap.append((rank, i, pair, merged))
        heapq.heapify(heap)
        while heap:
            _, i, pair, merged = heapq.heappop(heap)
            j = after[i]
            if j < 0 or (symbols[i], symbols[j]) != pair:
                continue  # stale
            symbols[i], symbols[j] = merged, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (pair := (merged, symbols[k])) in merges:
                    rank, new = merges[pair]
                    push(heap, (rank, i, pair, new))
            h = before[i]
            if h >= 0 and (pair := (symbols[h], merged)) in merges:
                rank, new = merges[pair]
                push(heap, (rank, h, pair, new))
        return [s for s in symbols if s >= 0]

    def word(self, word: str) -> bytes:
        raw = word.encode()
        letters = self.letters
        symbols = [letters[b] for b in raw]
        symbols[-1] = self.last[raw[-1]]
        ids = self.merge(symbols)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= 40:
            if len(self.known_words) >= self.LIMIT:
                self.known_words.clear()
            self.known_words[word] = packed
        return packed

    def chunk(self, chunk: str) -> bytes:
        """The ids of what stands between two white spaces: some words without a space."""
        get, word = self.known_words.get, self.word
        packed = b"".join([get(w) or word(w) for w in self.words.findall(chunk)])
        if len(chunk) <= 64:
            if len(self.known) >= self.LIMIT:
                self.known.clear()
            self.known[chunk] = packed
        return packed

    def plain(self, text: str) -> bytes:
        text = unicodedata.normalize("NFC", text)
        # lower case letter by letter: str.lower() alone treats a final sigma by its neighbours
        text = text.lower() if "Σ" not in text else "".join([c.lower() for c in text])
        if not text.isascii() and self.new.search(text):
            text = text.translate(self.lower)
        get, chunk = self.known.get, self.chunk
        # str.split() also splits at four control signs that are no white space here
        chunks = text.split() if not self.odd.search(text) else self.spaces.split(text)
        return b"".join([get(c) or chunk(c) for c in chunks])

    def encode(self, text: str) -> bytes:
        """The ids as packed little-endian unsigned 32-bit integers."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.plain(text)
        return b"".join(
            np.array([self.special[part]], "<u4").tobytes() if part in self.special else self.plain(part)
            for part in self.cut.split(text)
            if part
        )

    def decode(self, packed: bytes) -> str:
        """The vocabulary's strings of the ids; without a decoder in the file they are joined by spaces."""
        return " ".join(map(self.strings.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(2)
def _encoder(content: str) -> Encoder:
    return Encoder(content)


def _shared(df: DataFrame, tokenizer: str):
    """The vocabulary file, read once and sent to the executors; a few MB whatever the input is."""
    with open(tokenizer, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, key: str, text: str, tokenizer: str) -> DataFrame:
    """``key`` and ``ids``, the whole text's token ids as packed little-endian unsigned 32-bit integers.

    A null or empty text has no ids. Special tokens spelled out in a text count as such; none is added.
    """
    vocabulary = _shared(df, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                ids = pa.array([encoder.encode(t or "") for t in part.column(1).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["k", "ids"])

    narrow = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    out = narrow.mapInArrow(run, f"k {dict(narrow.dtypes)['k']}, ids binary")
    return out.select(F.col("k").alias(key), "ids")


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the decoded text of packed ids; null ids give an empty text."""
    vocabulary = _shared(df, tokenizer)
    schema = [f"`{c}` {t}" for c, t in df.dtypes if c != out] + [f"`{out}` string"]
    place = [c for c in df.columns if c != out].index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = [encoder.decode(x or b"") for x in part.column(place).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], [*part.schema.names, out]
                )

    return df.select(*[f"`{c}`" for c in df.columns if c != out]).mapInArrow(run, ", ".join(schema))
