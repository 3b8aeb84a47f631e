"""Whitespace handling and the token array every length and truncation rule is defined on.

Whitespace means what ``str.split()`` means: the Unicode White_Space property plus U+001C..U+001F.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
WHITESPACE_CLASS = r"[\s\x1c-\x1f]"
#: Characters of text whose tokens a Python worker holds at a time.
PART_CHARS = 1 << 20
TOKEN_PATTERN = r"(?U)[^\s\x1c-\x1f]++"  # possessive: a token never needs to give back


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``; plain reuse would evaluate it per mention."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column | str) -> Column:
    """Remove whitespace at both ends (``trim`` alone removes only spaces)."""
    return F.btrim(col(c), F.lit(WHITESPACE_CHARS))


def is_blank(c: Column | str) -> Column:
    """True for null and for text without any non-whitespace character."""
    return F.coalesce(strip(c) == "", F.lit(True))


class WhitespaceTokenizer:
    """Default tokenizer: maximal runs of non-whitespace, all inside the JVM."""

    def tokens(self, c: Column | str) -> Column:
        return F.regexp_extract_all(col(c), F.lit(TOKEN_PATTERN), F.lit(0))

    def count(self, c: Column | str) -> Column:
        return F.size(self.tokens(c))

    def fit(self, pieces: Column, limit: int) -> Column:
        """How many leading pieces hold at most ``limit`` tokens together. Every piece ends in whitespace,
        so the counts add up; pieces after the first miss are not looked at."""
        return fit_prefix(pieces, limit, self.count)

    def join(self, tokens: Column) -> Column:
        return F.array_join(tokens, " ")


def _parts(texts: pd.Series) -> Iterator[pd.Series]:
    """The series in order, in pieces of about ``PART_CHARS`` characters, or one longer text."""
    ends = np.cumsum([0 if t is None else len(t) for t in texts])
    cuts = np.flatnonzero(np.diff(ends // PART_CHARS)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(texts)], strict=True):
        yield texts.iloc[start:end]


class FunctionTokenizer:
    """A user's ``text -> list of tokens`` function, run in Arrow batches.

    ``make`` returns the function; it runs in the Python workers, once per task, so that a vocabulary is
    loaded there and not shipped with the plan. ``glue`` is what belongs between tokens when they are put
    together again (``""`` for sub-words that carry their own spaces).
    """

    def __init__(self, make: Callable[[], Callable[[str], list[str]]], glue: str = ""):
        self.glue = glue

        @F.pandas_udf("array<string>")
        def _tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            fn = make()
            for texts in batches:
                for part in _parts(texts):  # tokens of a whole batch take many times its texts' memory
                    yield part.map(lambda t: None if t is None else list(fn(t)))

        @F.pandas_udf("int")
        def _count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            fn = make()
            for texts in batches:
                yield pd.Series([None if t is None else len(list(fn(t))) for t in texts], dtype="Int32")

        @F.pandas_udf("int")
        def _fit(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            fn = make()

            def leading(pieces, limit):
                if pieces is None:
                    return None
                text, kept = "", 0
                for piece in pieces:
                    text += piece
                    if len(fn(text)) > limit:
                        break
                    kept += 1
                return kept

            for pieces, limits in batches:
                yield pd.Series([leading(p, lim) for p, lim in zip(pieces, limits)], dtype="Int32")

        # Marked non-deterministic only to keep the optimizer from folding this call into another Python call
        # on its result, a nesting it cannot plan.
        self._tokens, self._count, self._fit = _tokens, _count, _fit.asNondeterministic()

    def tokens(self, c: Column | str) -> Column:
        return self._tokens(col(c))

    def count(self, c: Column | str) -> Column:
        return self._count(col(c))

    def fit(self, pieces: Column, limit: int) -> Column:
        """How many leading pieces hold at most ``limit`` tokens when put together."""
        return self._fit(pieces, F.lit(limit))

    def join(self, tokens: Column) -> Column:
        return F.array_join(tokens, self.glue)


WHITESPACE = WhitespaceTokenizer()


def tokenizer_udf(fn: Callable[[str], list[str]], glue: str = "") -> FunctionTokenizer:
    """Wrap a user's tokenizing function for every ``tokenizer=`` argument of this package."""
    return FunctionTokenizer(lambda: fn, glue)


def fit_prefix(pieces: Column, limit: int, count: Callable[[Column], Column]) -> Column:
    """Number of leading ``pieces`` whose counts sum to at most ``limit`` (greedy, stops at the first miss)."""

    def state(n, kept, full):
        return F.struct(n.alias("n"), kept.alias("kept"), full.alias("full"))

    def step(acc: Column, piece: Column) -> Column:
        grown = lambda n: F.when(n > limit, state(acc["n"], acc["kept"], F.lit(True))).otherwise(
            state(n, acc["kept"] + 1, F.lit(False))
        )
        return F.when(acc["full"], acc).otherwise(let(acc["n"] + count(piece), grown))

    return F.aggregate(pieces, state(F.lit(0), F.lit(0), F.lit(False)), step, lambda acc: acc["kept"])


def token_count(c: Column | str, tokenizer=None) -> Column:
    return (tokenizer or WHITESPACE).count(c)


def char_count(c: Column | str) -> Column:
    """Length in code points."""
    return F.length(col(c))


def word_count(c: Column | str) -> Column:
    return WHITESPACE.count(c)
