"""What several operators share: table access, row identity, hashing of words and windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands in for a null id inside an operator: below every id, and compared like any other value.
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_id(name: str) -> Column:
    """The id as a long that is never null; a null id sorts first."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def id_or_null(value: Column) -> Column:
    return F.when(value != NO_ID, value)


def text_tag(text: str) -> Column:
    """A hash of the text. Ids should be unique; with the tag, rows that share one, or have none, stay apart. 64 bits,
    because one id, or none, may stand on very many rows."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def text_hash(text: str) -> Column:
    return text_tag(text)


def documents(df: DataFrame, key: str, text: str) -> DataFrame:
    """``id``, ``tag`` and the text as UTF-8 ``body`` (null: empty), whatever else the frame holds."""
    return df.select(
        row_id(key).alias("id"), text_tag(text).alias("tag"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"),
    )


class Words(dict):
    """64-bit hashes of words, remembered per worker. Python's own hash differs between processes."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def hashes(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Rolling:
    """Polynomial hashes, modulo 2**64, of any slices of a sequence of 64-bit values.

    Equal slices have equal hashes wherever they stand: the sum of ``value[i] * B**i`` over a slice is
    multiplied by the inverse of ``B`` to the power of its start.
    """

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 2**64)
        self._up = self._down = np.ones(1, np.uint64)

    def _grown(self, n: int) -> None:
        while len(self._up) < n:
            for name, factor in (("_up", self.base), ("_down", self.inverse)):
                have = getattr(self, name)
                step = np.uint64(pow(factor, len(have), 2**64))
                setattr(self, name, np.concatenate([have, have * step]))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        self._grown(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self._up[: len(values)], out=out[1:])
        return out

    def slices(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self._down[start])

    def grams(self, prefix: np.ndarray, size: int) -> np.ndarray:
        """The hashes of all slices of one size, by start."""
        n = len(prefix) - size
        return mix((prefix[size:] - prefix[:n]) * self._down[:n])


GRAM, CONTEXT = Rolling(0x9E3779B97F4A7C15), Rolling(0xD1B54A32D192ED03)
_PLACE = np.uint64(24)
#: Sequences are worked through in pieces of so many items, which bounds a task's memory for a very long text.
PIECE = 1 << 20


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of each ``width`` neighbours."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """Winnowing: the places of the least hash among each ``width`` neighbours, the leftmost of equals.

    The choice depends on the window's content alone, so equal windows choose the same place.
    """
    places = np.arange(len(grams), dtype=np.uint64)
    keys = (grams >> _PLACE << _PLACE) | places
    least = sliding_min(keys, width) & np.uint64((1 << 24) - 1)
    keep = np.ones(len(least), bool)
    keep[1:] = least[1:] != least[:-1]
    return np.unique(least[keep]).astype(np.int64)


def anchor_rows(values: np.ndarray, window: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, hash of ``size`` items and hash of the context, for every anchor of the windows of one sequence.

    Each window of ``window`` items contains an anchor. Its context are the items that any window around the
    anchor can reach, cut at the ends of the sequence.
    """
    n, reach = len(values), window - size
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for start in range(0, max(n - window + 1, 0), PIECE):
        low = max(0, start - reach)
        part = values[low : start + PIECE + 2 * window]
        hashes = GRAM.grams(GRAM.prefix(part), size)[start - low :][: PIECE + reach]
        at = anchors(hashes, reach + 1)
        place = at + (start - low)
        left, right = np.maximum(place - reach, 0), np.minimum(place + window, len(part))
        shape = ((place - left) * (window + 1) + right - place).astype(np.uint64)
        context = CONTEXT.slices(CONTEXT.prefix(part), left, right) ^ mix(shape + np.uint64(1))
        found.append((at + start, hashes[at], context))
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty.astype(np.uint64), empty.astype(np.uint64)
    place, gram, context = (np.concatenate(x) for x in zip(*found, strict=True))
    _, first = np.unique(place, return_index=True)
    return place[first], gram[first], context[first]


def as_long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values)
