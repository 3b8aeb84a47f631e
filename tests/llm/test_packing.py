"""Shards: near equal sizes, gapless slots, equal texts together, awkward rows."""

import random
import zlib

import numpy as np

from corpusloom.llm import packing
from tests.llm import rows


def test_shards(spark):
    rng = random.Random(3)
    data = [(i, "word " * rng.randrange(1, 80) + str(i)) for i in range(1500)]
    data += [(5000 + i, "copy") for i in range(900)] + [(9000 + i, "twice") for i in range(2)] + rows.documents()
    got = packing.shard(rows.frame(spark, data), "doc_id", "text", 8, 256).collect()
    want = sorted((i is not None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in data)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r["size"], r.text_crc32) for r in got) == want
    for values in ("size", "tokens", None):
        totals = np.zeros(8)
        for r in got:
            totals[r.shard] += r[values] if values else 1
        assert totals.max() <= 1.03 * totals.mean() and totals.min() >= 0.97 * totals.mean(), (values, totals)
    for s in range(8):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in got if r.text_crc32 == zlib.crc32(b"twice")}) == 1
    assert len({r.shard for r in got if r.text_crc32 == zlib.crc32(b"copy")}) > 1  # a hot group is cut
    assert packing.shard(rows.frame(spark, []), "doc_id", "text").collect() == []


def test_placing_prefers_the_fitting_shard():
    sizes = np.array([[0.5, 0.0], [0.0, 0.5], [0.5, 0.0], [0.0, 0.5]])
    where = packing.place(sizes, 2)
    for s in (0, 1):
        assert np.allclose(sizes[where == s].sum(axis=0), [0.5, 0.5])


def test_hot_group_without_ids_is_cut_evenly(spark):
    data = [(None, "the same text")] * 4000 + [(7, "another one")] * 1500 + [(100 + i, f"text {i}") for i in range(2000)]
    got = packing.shard(rows.frame(spark, data), "doc_id", "text").collect()
    totals = np.zeros(16)
    for r in got:
        totals[r.shard] += r["size"]
    assert totals.max() <= 1.06 * totals.mean() and totals.min() >= 0.94 * totals.mean(), totals
    for s in range(16):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
