"""Alignment of two tokenizers' tokens over the same bytes, and how often their ids meet in a corpus.

A text's token ends under either vocabulary are two increasing lists of byte offsets. The shorter drives the search: from
a proportional guess each of its ends gallops through the longer list in doubling steps, and a binary search settles the
bracket. Offsets found in both lists cut the tokens into groups; the ranks of neighbouring common ends give each group's
range of tokens on either side, and so the pairs that overlap.

Tokenizing goes by units, cut at single spaces between two other signs. No token of either vocabulary reaches
over such a cut, so the units' tokens are the text's, and a worker remembers the units it has seen.

The pairs of ids are counted block by block (a few MB of text): a block sends each distinct pair once, with
the number of its texts that hold it, and gets the corpus-wide counts back for its own pairs.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bpe import byte_letters
from corpusloom.session import discard, materialize

#: Bytes of text per block.
BLOCK = 4 << 20
#: Groups with more pairs of tokens than this are counted by distinct ids first.
WIDE = 4096
#: Units per generation that a worker remembers (it keeps two), and the longest of them.
REMEMBERED, LONG_UNIT = 150_000, 100
#: Units that are tokenized in one call.
TOGETHER = 1000
#: Characters of texts that are cut into units at a time.
AT_ONCE = 1 << 18
_CUT = re.compile(r" (?<=\S )(?=\S)")
# Fixed value: how byte-level vocabularies of this kind cut a text into words.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Signs beyond Latin, about whose classes two libraries may differ.
_UNCOMMON = re.compile("[^\\x00-\u024f]")


class Pair:
    """Both vocabularies: ids of a text's units, byte lengths and printed numbers of all tokens."""

    def __init__(self, first: str, second: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(first)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=second)
        letters = {letter: value for value, letter in enumerate(byte_letters())}
        vocabulary = json.loads(first)["model"]["vocab"]
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes_a[number] = bytes([letters[c] for c in token]) if all(c in letters for c in token) else token.encode()
        # the same merges, found faster; used where both agree on what a letter is
        special = {t["id"] for t in json.loads(first)["added_tokens"]}
        ranks = {raw: number for number, raw in enumerate(self.bytes_a) if raw and number not in special}
        self.quick = tiktoken.Encoding("first", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece has a space after another sign: texts can't be cut at spaces")
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.size_a, self.size_b = (np.array([len(x) for x in table]) for table in (self.bytes_a, self.bytes_b))
        self.names = [f"{i}{end}" for n, ends in ((len(self.bytes_a), ",|"), (len(pieces), ",;")) for i in range(n) for end in ends]
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.older = self.known

    def learn(self, units: set[str]) -> None:
        """Tokenize units that are not remembered. None: the bytes of one side are not the unit's."""
        if len(self.known) > REMEMBERED:  # what is used again moves to the new generation, the rest goes with the old
            self.older, self.known = self.known, {}
        units = [u for u in units if u not in self.known]
        self.known.update((u, self.older[u]) for u in units if u in self.older)
        units = [u for u in units if u not in self.known]
        # many units in one call, joined as a text has them; those with white space at an end could merge there
        joined = [u for u in units if not (u[0].isspace() or u[-1].isspace())]
        joined.sort(key=lambda u: _UNCOMMON.search(u) is not None)  # few calls with signs that need the slower way
        for i in range(0, len(joined), TOGETHER):
            part = joined[i : i + TOGETHER]
            raw = [(" " + u).encode() for u in part]
            found = [
                self._divided(ids, table, sizes, raw)
                for ids, table, sizes in (
                    (self._encode_joined("".join([" " + u for u in part])), self.bytes_a, self.size_a),
                    (self.b.encode(" ".join(part)), self.bytes_b, self.size_b),
                )
            ]
            if None not in found:
                self.known.update(zip(part, zip(*found, strict=True), strict=True))
        rest = [u for u in units if u not in self.known]
        get_a, get_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        for unit, x, y in zip(rest, self._encode_a([" " + u for u in rest]), self.b.encode(rest, num_threads=1), strict=True):
            raw = (" " + unit).encode()
            same = b"".join(map(get_a, x)) == raw and b"".join(map(get_b, y)) == raw
            self.known[unit] = (np.array(x, np.int32).tobytes(), np.array(y, np.int32).tobytes()) if same else None

    def _encode_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _encode_joined(self, text: str) -> list[int]:
        return self._encode_a([text])[0] if _UNCOMMON.search(text) else self.quick.encode_ordinary(text)

    def _divided(self, ids: list[int], table: list[bytes], sizes: np.ndarray, raw: list[bytes]) -> list[bytes] | None:
        """The tokens of each unit; None where some unit's bytes don't come back, or a token reaches over a cut."""
        if b"".join(map(table.__getitem__, ids)) != b"".join(raw):
            return None
        found = np.array(ids, np.int32)
        ends, cuts = np.cumsum(sizes[found]), np.cumsum([len(r) for r in raw])
        last = np.searchsorted(ends, cuts)
        if (ends[last] != cuts).any():
            return None
        edges = [0, *(last + 1).tolist()]
        return [found[s:e].tobytes() for s, e in zip(edges, edges[1:], strict=False)]

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """The ids of each text (None: it has no tokens)."""
        out, start = [], 0
        while start < len(texts):  # some texts at a time: their units are small strings that take room
            end, size = start, 0
            while end < len(texts) and size < AT_ONCE:
                size += len(texts[end])
                end += 1
            out += self._tokens(texts[start:end])
            start = end
        return out

    def _tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        cut = [_CUT.split(t) if t else [] for t in texts]
        self.learn({u for units in cut for u in units})
        out = []
        for units in cut:
            found = list(map(self.known.__getitem__, units))
            if not found or None in found:
                out.append(None)
            else:
                a, b = zip(*found, strict=True)
                out.append((np.frombuffer(b"".join(a), np.int32), np.frombuffer(b"".join(b), np.int32)))
        for u in {u for units in cut for u in units if len(u) > LONG_UNIT}:
            self.known.pop(u, None)
        return out


def gallop(x: np.ndarray, y: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each of ``x`` the place of the first of ``y`` (increasing, its last not below any ``x``) that is not less,
    sought from ``start``: doubling steps to either side until the place is between two of them, then halving."""
    low, high = start.copy(), start.copy()
    below = y[start] < x
    todo, step = np.flatnonzero(below), 1
    while len(todo):
        high[todo] = np.minimum(low[todo] + step, len(y) - 1)
        todo = todo[y[high[todo]] < x[todo]]
        low[todo] = high[todo]
        step *= 2
    todo, step = np.flatnonzero(~below), 1
    while len(todo):
        low[todo] = np.maximum(high[todo] - step, -1)
        todo = todo[(low[todo] >= 0) & (y[low[todo]] >= x[todo])]
        high[todo] = low[todo]
        step *= 2
    todo = np.flatnonzero(high - low > 1)
    while len(todo):
        middle = (low[todo] + high[todo]) >> 1
        less = y[middle] < x[todo]
        low[todo[less]], high[todo[~less]] = middle[less], middle[~less]
        todo = todo[high[todo] - low[todo] > 1]
    return high


def common(ends_a: np.ndarray, ends_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks, in either list, of the ends that both have. The lists hold texts one after the other, ``n_a`` and ``n_b``
    tokens of each; the shorter list of a text drives."""
    found = []
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    for own, other, n, m, first, there, driver in (
        (ends_a, ends_b, n_a, n_b, first_a, first_b, n_a <= n_b),
        (ends_b, ends_a, n_b, n_a, first_b, first_a, n_a > n_b),
    ):
        rank = np.flatnonzero(np.repeat(driver, n))
        text = np.repeat(np.flatnonzero(driver), n[driver])
        guess = there[text] + (rank - first[text]) * m[text] // np.maximum(n[text], 1)
        at = gallop(own[rank], other, guess) if len(rank) else rank
        equal = other[at] == own[rank] if len(rank) else np.zeros(0, bool)
        found.append((rank[equal], at[equal]))
    a, b = np.concatenate([found[0][0], found[1][1]]), np.concatenate([found[0][1], found[1][0]])
    order = np.argsort(a, kind="stable")
    return a[order], b[order]


@dataclass
class Aligned:
    """A block of texts: group ``g`` holds the A tokens from ``a[g]`` on, ``n_a[g]`` of them, and likewise of B."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    text: np.ndarray
    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray

    @classmethod
    def of(cls, pair: Pair, tokens: list[tuple[np.ndarray, np.ndarray]]) -> Aligned:
        ids_a, ids_b = (np.concatenate([t[i] for t in tokens]) if tokens else np.zeros(0, np.int32) for i in (0, 1))
        sizes = [np.array([len(t[i]) for t in tokens], np.int64) for i in (0, 1)]
        last_a, last_b = common(np.cumsum(pair.size_a[ids_a]), np.cumsum(pair.size_b[ids_b]), *sizes)
        a, b = (np.concatenate([[0], last[:-1] + 1]) if len(last) else last for last in (last_a, last_b))
        text = np.searchsorted(np.cumsum(sizes[0]), last_a, side="right")
        return cls(ids_a, ids_b, text, a, b, last_a - a + 1, last_b - b + 1)

    def printed(self, pair: Pair, n_texts: int) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        group_a, group_b = (np.repeat(np.arange(len(n)), n) for n in (self.n_a, self.n_b))
        codes = np.empty(len(self.ids_a) + len(self.ids_b), np.int64)
        last_a, last_b = (np.append(g[1:] != g[:-1], True) if len(g) else g.astype(bool) for g in (group_a, group_b))
        # a group's A tokens come after all B tokens of earlier groups, its B tokens after its own A tokens
        codes[np.arange(len(group_a)) + self.b[group_a]] = self.ids_a * 2 + last_a
        offset = 2 * len(pair.bytes_a)
        codes[np.arange(len(group_b)) + (self.a + self.n_a)[group_b]] = offset + self.ids_b * 2 + last_b
        size = np.bincount(self.text, weights=self.n_a + self.n_b, minlength=n_texts).astype(np.int64)
        names, out, start = pair.names.__getitem__, [], 0
        for n in size.tolist():
            out.append("".join(map(names, codes[start : start + n].tolist()))[:-1])
            start += n
        return out

    def links(self, second: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct ``text << shift | a * second + b``, and how many pairs of tokens each stands for."""
        wide = self.n_a * self.n_b > WIDE
        own_a = np.flatnonzero(np.repeat(~wide, self.n_a))
        group = np.repeat(np.arange(len(wide)), self.n_a)[own_a]
        times = self.n_b[group]
        total = np.cumsum(times)
        partner = np.repeat(self.b[group] - (total - times), times) + np.arange(total[-1] if len(total) else 0)
        keys = np.repeat((self.text[group].astype(np.int64) << shift) + self.ids_a[own_a].astype(np.int64) * second, times)
        keys, counts = np.unique(keys + self.ids_b[partner], return_counts=True)
        if not wide.any():
            return keys, counts
        more, weights = [keys], [counts]
        for g in np.flatnonzero(wide).tolist():
            a, n = np.unique(self.ids_a[self.a[g] : self.a[g] + self.n_a[g]], return_counts=True)
            b, m = np.unique(self.ids_b[self.b[g] : self.b[g] + self.n_b[g]], return_counts=True)
            more.append(((int(self.text[g]) << shift) + a.astype(np.int64)[:, None] * second + b[None, :]).ravel())
            weights.append((n[:, None] * m[None, :]).ravel())
        keys, counts = np.concatenate(more), np.concatenate(weights)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[at], np.add.reduceat(counts[order], at)


_TEXTS = pa.struct([
    ("key", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups", pa.string()), ("pairs", pa.int64()),
])
_BLOCKS = pa.schema([
    ("block", pa.int64()), ("texts", pa.list_(_TEXTS)), ("packed", pa.binary()), ("a", pa.int32()), ("b", pa.int32()),
    ("pos", pa.int32()), ("n", pa.int64()),
])
_BLOCK_ROWS = (
    "block long, texts array<struct<key: long, n_a: long, n_b: long, n_groups: long, n_links: long, groups: string, "
    "pairs: long>>, packed binary, a int, b int, pos int, n long"
)


def _block_rows(pair: Pair, block: int, keys: list, texts: list[str], digest: bool) -> Iterator[pa.RecordBatch]:
    tokens = pair.tokens(texts)
    have = [i for i, t in enumerate(tokens) if t is not None]
    own = Aligned.of(pair, [tokens[i] for i in have])
    second = len(pair.bytes_b)
    shift = (len(pair.bytes_a) * second).bit_length()
    link, times = own.links(second, shift)
    found, place, n = np.unique(link & ((1 << shift) - 1), return_inverse=True, return_counts=True)
    per_text = {
        "n_groups": np.bincount(own.text, minlength=len(have)),
        "n_links": np.bincount(own.text, weights=own.n_a * own.n_b, minlength=len(have)).astype(np.int64),
        "pairs": np.bincount(link >> shift, minlength=len(have)),
    }
    rows = [{"key": k, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups": "", "pairs": 0} for k in keys]
    for j, (i, groups) in enumerate(zip(have, own.printed(pair, len(have)), strict=True)):
        rows[i] |= {name: int(values[j]) for name, values in per_text.items()}
        rows[i] |= {"n_a": len(tokens[i][0]), "n_b": len(tokens[i][1])}
        rows[i]["groups"] = hashlib.sha256(groups.encode()).hexdigest() if digest else groups
    packed = np.concatenate([place.astype("<u4"), np.minimum(times, 0xFFFFFFFF).astype("<u4")]).tobytes()
    size = len(place).to_bytes(8, "little")
    yield pa.RecordBatch.from_pylist(
        [{"block": block, "texts": rows, "packed": size + pa.compress(packed, codec="zstd", asbytes=True)}], _BLOCKS
    )
    if len(found):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(found), block)), pa.nulls(len(found), _BLOCKS.field("texts").type),
                pa.nulls(len(found), pa.binary()), pa.array((found // second).astype(np.int32)),
                pa.array((found % second).astype(np.int32)), pa.array(np.arange(len(found), dtype=np.int32)), pa.array(n),
            ],
            schema=_BLOCKS,
        )


def align(docs: DataFrame, key: str, text: str, first: str, second: bytes, digest: bool = False, block: int = BLOCK) -> DataFrame:
    """Blocks of aligned texts, and their distinct pairs of ids (rows with ``pos``) with the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, made, keys, texts, size = Pair(first, second), TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for k, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys.append(k)
                texts.append(body)
                size += len(body) + 64
                if size >= block:
                    yield from _block_rows(pair, made, keys, texts, digest)
                    made, keys, texts, size = made + 1, [], [], 0
        if keys:
            yield from _block_rows(pair, made, keys, texts, digest)

    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    return rows.mapInArrow(run, _BLOCK_ROWS)


_SCORED = pa.schema([(f.name, f.type) for f in _TEXTS if f.name != "pairs"] + [("n_best", pa.int64()), ("count_sum", pa.int64())])


def link_counts(
    docs: DataFrame, key: str, text: str, first: str, second: bytes, digest: bool = False, block: int = BLOCK
) -> DataFrame:
    """Per row: ``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups``.

    ``first`` is the content of a byte-level BPE file, ``second`` that of a sentencepiece model that writes spaces as
    U+2581. ``groups`` has the ids of each group, ``a1,a2|b1;a3|b2,b3`` (or, with ``digest``, the SHA-256 of that).
    A pair's count is the number of rows that hold it linked; ``n_best`` counts links whose pair has the highest count
    of its A id, ``count_sum`` adds the counts of all links. Texts that are null or empty, or whose bytes either
    vocabulary does not give back, have no tokens: zeros and an empty string. Keys may be null or repeated, equal texts
    count as often as they are there; other columns are not looked at; an empty table gives no rows.
    """
    blocks = materialize(align(docs, key, text, first, second, digest, block), "aligned")
    pairs = blocks.where("pos IS NOT NULL").select("block", "pos", "a", "b", "n")
    counts = materialize(pairs.groupBy("a", "b").agg(F.sum("n").alias("count")), "pairs")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    ranked = materialize(counts.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best")), "ranked")
    known = pairs.join(ranked, ["a", "b"]).select(F.col("block").alias("of"), "pos", "count", "best")

    def finish(key: tuple, texts: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        count, best = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
        place = known.column("pos").to_numpy()
        count[place], best[place] = known.column("count").to_numpy(), known.column("best").to_numpy().astype(np.int64)
        for rows, packed in zip(texts.column("texts"), texts.column("packed"), strict=True):
            blob = packed.as_py()
            n = int.from_bytes(blob[:8], "little")
            place, times = np.frombuffer(pa.decompress(blob[8:], 8 * n, codec="zstd"), "<u4").reshape(2, n).astype(np.int64)
            sums = [np.concatenate([[0], np.cumsum(times * values[place])]) for values in (best, count)]
            start = 0
            for row in rows.as_py():
                end = start + row.pop("pairs")
                out.append(row | {"n_best": int(sums[0][end] - sums[0][start]), "count_sum": int(sums[1][end] - sums[1][start])})
                start = end
        return pa.Table.from_pylist(out, _SCORED)

    texts = blocks.where("pos IS NULL").select("block", "texts", "packed")
    rows = texts.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(
        finish, "key long, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long"
    )
    found = materialize(
        rows.select(F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"), "links"
    )
    discard(blocks, counts, ranked)
    return found
