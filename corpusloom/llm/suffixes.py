"""Exact substring removal with sorted suffixes.

The suffixes that start at repeated anchors, and the reversed texts before them, are sorted group by group: multikey
quicksort down to a shallow depth, then a blind trie for the strings that are still equal there. Longest common
prefixes with all others follow from those of neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import repeats
from corpusloom.llm.common import documents, id_or_null

#: Depth in bytes, beyond the anchor, at which quicksort hands over to the blind trie.
SHALLOW = 16
#: Classes of one anchor that are compared in a task. More are dealt out by what their windows have in common, and where
#: even that is common to more, every window of theirs is counted as a row instead.
GROUP = 2048
#: How many ranges of windows the classes of a frequent anchor are dealt out by.
PARTS = 4


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def _byte(text: bytes, at: int) -> int:
    """The byte there; -1 at the end, which sorts first."""
    return text[at] if at < len(text) else -1


def _blind(strings: list[bytes], group: list[int]) -> list[int]:
    """Order strings through a blind trie. An inner node is ``[depth, {byte there: node}]``, a leaf the equal strings.

    A string walks down by its branch bytes alone, is compared with a string of the leaf it meets, and is put in
    where the two first differ.
    """
    root: list | tuple = (group[0],)
    for new in group[1:]:
        text, node = strings[new], root
        while isinstance(node, list):
            node = node[1].get(_byte(text, node[0])) or next(iter(node[1].values()))
        other = strings[node[0]]
        depth = common(text, other)
        equal = depth == len(text) == len(other)
        parent, step, node = None, -1, root
        while isinstance(node, list) and (equal or node[0] < depth):
            parent, step = node, _byte(text, node[0])
            node = node[1][step]
        if isinstance(node, list) and node[0] == depth:
            node[1][_byte(text, depth)] = (new,)
            continue
        made = node + (new,) if equal else [depth, {_byte(text, depth): (new,), _byte(other, depth): node}]
        if parent is None:
            root = made
        else:
            parent[1][step] = made
    order: list[int] = []
    stack: list = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, list):
            stack += [node[1][k] for k in sorted(node[1], reverse=True)]
        else:
            order += node
    return order


def deep_shallow(strings: list[bytes], depth: int = 0, shallow: int = SHALLOW) -> list[int]:
    """The order of ``strings``, which share their first ``depth`` bytes or are sorted from there on."""
    limit, order = depth + shallow, []
    stack = [(list(range(len(strings))), depth)]
    while stack:
        group, at = stack.pop()
        if len(group) < 2:
            order += group
        elif at >= limit:
            order += _blind(strings, group)
        else:
            byte = [_byte(strings[i], at) for i in group]
            pivot = sorted((byte[0], byte[len(byte) // 2], byte[-1]))[1]
            less = [i for i, c in zip(group, byte, strict=True) if c < pivot]
            same = [i for i, c in zip(group, byte, strict=True) if c == pivot]
            more = [i for i, c in zip(group, byte, strict=True) if c > pivot]
            stack.append((more, at))
            if pivot < 0:  # these have ended and are equal
                stack += [([i], at) for i in reversed(same)]
            else:
                stack.append((same, at + 1))
            stack.append((less, at))
    return order


def _neighbours(strings: list[bytes], order: list[int]) -> np.ndarray:
    return np.array([common(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False)], np.int64)


def shared_windows(before: list[bytes], after: list[bytes], window: int, size: int) -> list[tuple[int, int] | None]:
    """For texts around one anchor: how far before it the first and the last window begins that another text has too.

    ``before`` holds the reversed texts before the anchor. A window that begins ``back`` before the anchor is shared
    by two texts whose reversed parts agree over ``back`` bytes and whose suffixes agree over the rest. Classes change
    only at the lengths that neighbours have in common, so only these are tried.
    """
    n, reach = len(before), window - size
    if n == 2:
        left, right = common(*before), common(*after)
        return [(left, window - right)] * 2 if left + right >= window else [None, None]
    order_b, order_a = deep_shallow(before), deep_shallow(after, size)
    lcp_b, lcp_a = _neighbours(before, order_b), _neighbours(after, order_a)
    back = np.unique(np.concatenate([lcp_b, window - lcp_a, [0, reach]]))
    back = back[(back >= 0) & (back <= reach)]
    most, least = np.full(n, -1), np.full(n, reach + 1)
    in_b, in_a = np.empty(n, np.int64), np.empty(n, np.int64)
    for b in back.tolist():
        in_b[order_b] = np.concatenate([[0], np.cumsum(lcp_b < b)])
        in_a[order_a] = np.concatenate([[0], np.cumsum(lcp_a < window - b)])
        _, which, times = np.unique(in_b * n + in_a, return_inverse=True, return_counts=True)
        # a text too short for the window has nothing in common with any other and stands alone
        hit = times[which] > 1
        most[hit] = np.maximum(most[hit], b)
        least[hit] = np.minimum(least[hit], b)
    return [(m, k) if m >= 0 else None for m, k in zip(most.tolist(), least.tolist(), strict=True)]


def _bytes():
    return lambda body: np.frombuffer(body, np.uint8).astype(np.uint64) + np.uint64(1)


def ranges(before: bytes, after: bytes, window: int, size: int, parts: int) -> Iterator[int]:
    """A hash per range of windows that exist around an anchor: of the bytes that all windows of the range hold.

    The windows of a range begin ``low`` to ``high`` before the anchor. Equal windows hold equal bytes, so classes that
    share a window have a hash in common.
    """
    reach = window - size
    for j in range(parts):
        low, high = reach * j // parts, reach * (j + 1) // parts
        if len(before) >= low and len(after) >= window - high:
            yield xxhash.xxh3_64_intdigest(before[:low] + after[: window - high], seed=j + 1) - 2**63


def _contexts(reps: DataFrame, docs: DataFrame, window: int, size: int, parts: int = 0) -> DataFrame:
    """The texts before (reversed) and after each representative anchor; with ``parts``, once for every range of
    windows, with its hash as ``part`` (else 0)."""
    reach = window - size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for body, reps_of in zip(batch.column(0), batch.column(1), strict=True):
                text = body.as_py()
                for r in reps_of.as_py():
                    p = r["pos"]
                    before, after = text[max(0, p - reach) : p][::-1], text[p : p + window]
                    for part in ranges(before, after, window, size, parts) if parts else (0,):
                        for column, x in zip(out, (r["gram"], part, r["ctx"], before, after), strict=True):
                            column.append(x)
                    if len(out[0]) >= 5000:
                        yield _batch(out)
                        out = [[], [], [], [], []]
            if out[0]:
                yield _batch(out)

    def _batch(out: list[list]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["gram", "part", "ctx", "before", "after"]
        )

    joined = repeats.with_text(reps, docs, "gram", "ctx", "pos").select("body", "reps")
    return joined.mapInArrow(run, "gram long, part long, ctx long, before binary, after binary")


def _dealt(hot: DataFrame, docs: DataFrame, window: int, size: int) -> tuple[DataFrame, DataFrame]:
    """The contexts of frequent anchors by range of windows, those with company that fits a task, and the classes
    (``gram``, ``ctx``) of larger companies."""
    parts = _contexts(hot, docs, window, size, PARTS)
    sizes = parts.groupBy("gram", "part").agg(F.count("*").alias("m"), F.min("ctx").alias("lo"), F.max("ctx").alias("hi"))
    sizes = sizes.where("lo < hi").select("gram", "part", "m")
    fit = parts.join(sizes.where(F.col("m") <= GROUP).hint("merge"), ["gram", "part"], "left_semi")
    large = parts.select("gram", "part", "ctx").join(sizes.where(F.col("m") > GROUP).hint("merge"), ["gram", "part"], "left_semi")
    return fit, large.select("gram", "ctx").distinct()


def _compare(contexts: DataFrame, window: int, size: int) -> DataFrame:
    """``most`` and ``least`` of the classes with a shared window; a group stays small enough for one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[bytes, bytes]] = {}
        of = None
        out: list[tuple[int, int, int, int]] = []

        def close() -> None:
            if len(held) > 1:
                before, after = zip(*held.values(), strict=True)
                for ctx, found in zip(held, shared_windows(list(before), list(after), window, size), strict=True):
                    if found:
                        out.append((of[0], ctx, *found))

        def flush() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else ([], [], [], [])
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["gram", "ctx", "most", "least"]
            )
            out.clear()
            return batch

        for batch in batches:
            for g, p, c, b, a in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if (g, p) != of:
                    close()
                    held, of = {}, (g, p)
                held[c] = (b, a)
            yield flush()
        close()
        yield flush()

    dealt = contexts.repartition("gram", "part").sortWithinPartitions("gram", "part")
    return dealt.mapInArrow(run, "gram long, ctx long, most long, least long")


def remove_repeats(df: DataFrame, key: str, text: str, window: int = 400, size: int = 200) -> DataFrame:
    """Remove every byte covered by a ``window``-byte string that also starts elsewhere in the corpus.

    Per row: ``key``, ``n_bytes``, ``removed`` (maximal stretches, ``s`` to before ``e``) and ``kept`` (the other
    bytes). Null texts count as empty; texts shorter than the window keep everything. Rows with equal texts lose
    all of it from the window's length on, also rows with the same id. Other columns are not looked at.
    """
    docs = documents(df, key, text)
    anchors = repeats.repeated(repeats.find_anchors(docs, _bytes, window, size))
    classes = repeats.classes(anchors)
    reach = window - size
    # a class of two members is repeated as it is; only for single ones others have to be looked at
    open_ = classes.where("least_n = 1")
    contexts = _contexts(open_.where(F.col("n_classes") <= GROUP), docs, window, size)
    hot = open_.where(F.col("n_classes") > GROUP)
    if hot.isEmpty():
        found = _compare(contexts, window, size)
    else:
        fit, large = _dealt(hot, docs, window, size)
        rows = repeats.window_hashes(hot.join(large, ["gram", "ctx"], "left_semi"), docs, _bytes, window, size)
        often = rows.groupBy("gram", "back", "hash").agg(F.min("ctx").alias("lo"), F.max("ctx").alias("hi")).where("lo < hi")
        shared = rows.join(often.select("gram", "back", "hash"), ["gram", "back", "hash"], "left_semi")
        shared = shared.select("gram", "ctx", F.col("back").alias("most"), F.col("back").alias("least"))
        found = _compare(contexts.union(fit.select(*contexts.columns)), window, size).union(shared)
        found = found.groupBy("gram", "ctx").agg(F.max("most").alias("most"), F.min("least").alias("least"))
    whole = classes.where("n > 1").select("gram", "ctx", F.lit(reach).alias("most"), F.lit(0).alias("least"))
    found = found.join(classes.where("n > 1"), ["gram", "ctx"], "left_anti").union(whole)
    covered = (
        anchors.where("one").select("id", "tag", "pos", F.lit(reach).alias("most"), F.lit(0).alias("least"))
    ).union(anchors.where("NOT one").join(found, ["gram", "ctx"]).select("id", "tag", "pos", "most", "least"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                sizes, removed, kept = [], [], []
                for body, own in zip(part.column(1), part.column(2), strict=True):
                    body = body.as_py()
                    gone = repeats.merged(own.as_py(), len(body))
                    ends = [0, *(x for s in gone for x in s), len(body)]
                    sizes.append(len(body))
                    removed.append([{"s": s, "e": e} for s, e in gone])
                    kept.append(b"".join(body[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)))
                kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())],
                    ["k", "n_bytes", "removed", "kept"],
                )

    out = (
        docs.join(repeats.spans(covered, window, size), ["id", "tag"], "left")
        .select(F.col("id").alias("k"), "body", "spans")
        .mapInArrow(run, "k long, n_bytes long, removed array<struct<s: long, e: long>>, kept binary")
    )
    return out.select(id_or_null(F.col("k")).alias(key), "n_bytes", "removed", "kept")
