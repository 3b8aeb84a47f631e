"""Substring removal in bytes and in words against brute force."""

import os
import random
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import common, doubling, suffixes
from tests.llm import rows


def union(hits, window):
    out = []
    for p in hits:
        if out and p <= out[-1][1]:
            out[-1][1] = p + window
        else:
            out.append([p, p + window])
    return [tuple(x) for x in out]


def brute_bytes(data, window):
    bodies = [(i, (t or "").encode()) for i, t in data]
    times = Counter(b[p : p + window] for _, b in bodies for p in range(len(b) - window + 1))
    out = []
    for i, b in bodies:
        gone = union([p for p in range(len(b) - window + 1) if times[b[p : p + window]] > 1], window)
        kept = bytes(x for p, x in enumerate(b) if not any(s <= p < e for s, e in gone))
        out.append((i, len(b), gone, kept))
    return out


def brute_words(data, window):
    low = lambda i: -1 if i is None else i
    texts = [(i, (t or "").encode().split()) for i, t in data]
    first = {}
    for i, w in texts:
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            first[key] = min(first.get(key, low(i)), low(i))
    out = []
    for i, w in texts:
        gone = union([p for p in range(len(w) - window + 1) if first[tuple(w[p : p + window])] < low(i)], window)
        out.append((i, len(w), gone, b" ".join(x for p, x in enumerate(w) if not any(s <= p < e for s, e in gone))))
    return out


def same(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(map(key, got)) == sorted(map(key, want))


def collect(df, size):
    return [(r.doc_id, r[size], [(x.s, x.e) for x in r.removed], bytes(r.kept)) for r in df.collect()]


@pytest.mark.parametrize("group", [2048, 3])
def test_bytes(spark, monkeypatch, group):
    monkeypatch.setattr(suffixes, "GROUP", group)  # 3: hot anchors take the way without groups
    data = rows.documents()
    got = collect(suffixes.remove_repeats(rows.frame(spark, data), "doc_id", "text", 40, 20), "n_bytes")
    same(got, brute_bytes(data, 40))


def test_frequent_anchors_in_unlike_places_make_no_row_per_window(spark, monkeypatch):
    """Classes that share an anchor but no window are told apart by what the ranges of their windows hold."""
    rng = random.Random(6)
    fresh = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    often, pair = fresh(24), fresh(60)
    data = [(i, fresh(50) + often + fresh(50)) for i in range(40)] + [(100, fresh(9) + pair), (101, pair + fresh(9))]
    data += [(102, fresh(50) + often + "xyz" * 5 + fresh(50)), (103, fresh(50) + often + "xyz" * 5 + fresh(50))]
    counted, hashes = [], suffixes.repeats.window_hashes
    monkeypatch.setattr(suffixes, "GROUP", 5)
    monkeypatch.setattr(suffixes.repeats, "window_hashes", lambda reps, *a: counted.append(reps.count()) or hashes(reps, *a))
    got = collect(suffixes.remove_repeats(rows.frame(spark, data), "doc_id", "text", 40, 20), "n_bytes")
    same(got, brute_bytes(data, 40))
    assert counted == [0]


def test_words(spark):
    data = rows.documents(2)
    got = collect(doubling.remove_repeats(rows.frame(spark, data), "doc_id", "text", 8), "n_words")
    same(got, brute_words(data, 8))


def test_near_copies_and_runs(spark):
    rng = random.Random(4)
    base = [f"v{i}" for i in range(120)]
    data = []
    for i in range(40):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(120)] = "zz"
        data.append((i, " ".join(w)))
    data += [(100, "z" * 900), (101, "z" * 300), (102, "ab" * 400)]
    got = collect(suffixes.remove_repeats(rows.frame(spark, data), "doc_id", "text", 60, 30), "n_bytes")
    same(got, brute_bytes(data, 60))
    got = collect(doubling.remove_repeats(rows.frame(spark, data), "doc_id", "text", 10), "n_words")
    same(got, brute_words(data, 10))


def test_empty_table(spark):
    none = rows.frame(spark, rows.documents()).limit(0)
    assert suffixes.remove_repeats(none, "doc_id", "text").collect() == []
    assert doubling.remove_repeats(none, "doc_id", "text").collect() == []


def test_sorting():
    rng = random.Random(3)
    for _ in range(500):
        base = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(60))) for _ in range(4)]
        strings = [rng.choice(base)[: rng.randrange(60)] + rng.choice([b"", b"c", b"ab"]) for _ in range(rng.randrange(1, 30))]
        order = suffixes.deep_shallow(strings, 0, rng.choice([0, 1, 4, 16]))
        assert [strings[i] for i in order] == sorted(strings) and sorted(order) == list(range(len(strings)))
        assert suffixes.common(strings[0], strings[-1]) == len(os.path.commonprefix([strings[0], strings[-1]]))


def test_long_texts_are_cut_without_loss(monkeypatch):
    values = np.random.default_rng(1).integers(0, 3, 5000).astype(np.uint64)
    whole = common.anchor_rows(values, 40, 20)
    monkeypatch.setattr(common, "PIECE", 128)
    for a, b in zip(whole, common.anchor_rows(values, 40, 20), strict=True):
        assert (a == b).all()


def test_many_equal_rows_of_one_id_and_of_none(spark):
    """Linear in the rows: the stretches of rows with one id and text count once."""
    import time

    text = " ".join(f"word{i}" for i in range(300))
    rows = [(0, text)] + [(5, text)] * 800 + [(None, text + " tail")] * 800
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    start = time.time()
    by_bytes = suffixes.remove_repeats(frame, "doc_id", "text").collect()
    by_words = doubling.remove_repeats(frame, "doc_id", "text").collect()
    assert time.time() - start < 90
    assert len(by_bytes) == len(by_words) == len(rows)
    # a null id is below all others: its first 300 words stay, and go from every row with an id
    assert {r.doc_id: bytes(r.kept) for r in by_words} == {None: (text + " tail").encode(), 0: b"", 5: b""}
    assert {bytes(r.kept) for r in by_bytes} == {b""}


def test_ids_and_checksums_do_not_make_one_document(spark):
    """Different texts without an id and with equal CRC-32 are two documents."""
    import zlib

    seen, rng = {}, random.Random(5)
    while True:
        body = f"{rng.getrandbits(400):0100x}"
        if (crc := zlib.crc32(body.encode())) in seen:
            break
        seen[crc] = body
    rows = [(None, seen[crc]), (None, body), (1, seen[crc] + " " + seen[crc])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffixes.remove_repeats(frame, "doc_id", "text", 40, 20).collect()
    assert sorted(bytes(r.kept) for r in got if r.doc_id is None) == [b"", body.encode()]
