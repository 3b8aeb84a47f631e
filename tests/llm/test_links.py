"""Near duplicates of texts and of vectors, and components, against brute force."""

import random

import numpy as np
import pytest

from corpusloom.llm import minhash, quantised
from corpusloom.llm.components import components
from tests.llm import rows


def shingle_set(text, size=4):
    words = (text or "").encode().lower().split()
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute(data, percent=80):
    sets = [(-1 if i is None else i, shingle_set(t)) for i, t in data]
    links = [
        (a, b)
        for x, (a, s) in enumerate(sets)
        for b, t in sets[:x]
        if s and t and 100 * len(s & t) >= percent * len(s | t)
    ]
    least = rows.components({i for i, _ in sets}, links)
    null = lambda i: None if i == -1 else i
    return [(null(i), len(s), null(least[i]), i == least[i]) for i, s in sets]


def same(got, want):
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(map(key, got)) == sorted(map(key, want))


def near_copies(seed, n):
    rng = random.Random(seed)
    base = [f"v{i}" for i in range(60)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(60)] = f"z{rng.randrange(5)}"
        out.append((1000 + i, " ".join(w)))
    return out


@pytest.mark.parametrize("tile", [256, 4])
def test_documents(spark, monkeypatch, tile):
    monkeypatch.setattr(minhash, "TILE", tile)  # 4: buckets are cut into many tiles
    data = rows.documents(3) + near_copies(1, 60)
    data = [r for r in data if r[0] is not None or r[1] is None]  # null ids share a node
    got = minhash.near_duplicates(rows.frame(spark, data), "doc_id", "text").collect()
    same(got, brute(data))


@pytest.mark.parametrize("tile", [256, 4])
def test_ids_of_several_texts(spark, monkeypatch, tile):
    monkeypatch.setattr(minhash, "TILE", tile)
    rng = random.Random(5)
    data = []
    for i in range(40):  # the two texts of an id, or all those of none, have nothing in common
        for part in "ab":
            words = [f"{part}{i}x{j}" for j in range(60)]
            data.append((None if i < 3 else i, " ".join(words)))
            data += [(1000 + 2 * i + (part == "b"), " ".join([*words[:-1], "near"]))]
    data += near_copies(2, 30) + [(None if rng.random() < 0.3 else 2000 + i % 7, t) for i, t in near_copies(3, 30)]
    data += [data[0], (5, None), (5, ""), (None, "")]
    rng.shuffle(data)
    got = minhash.near_duplicates(rows.frame(spark, data), "doc_id", "text").collect()
    same(got, brute(data))


def test_null_ids_and_empty(spark):
    data = [(None, "a b c d e"), (None, None), (4, "A b  c\td e"), (5, "")]
    got = minhash.near_duplicates(rows.frame(spark, data), "doc_id", "text").collect()
    same(got, [(None, 2, None, True), (None, 0, None, True), (4, 2, None, False), (5, 0, 5, True)])
    assert minhash.near_duplicates(rows.frame(spark, data).limit(0), "doc_id", "text").collect() == []


def test_long_chain(spark):
    n = 300
    links = [(i, i + 1) for i in range(n)] + [(1000, 1002), (1002, 1001), (7, 7)]
    random.Random(1).shuffle(links)
    got = components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {r.id: r.component for r in got} == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000, 1002: 1000}


def vectors():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 16))
    data = [base[i % 40] * rng.uniform(0.1, 9) + rng.normal(size=16) * (0.05, 0.2, 0.3)[i % 3] for i in range(220)]
    data += [data[3]] * 5 + [data[4] * 2]
    out = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    bad = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] * 16, [1.0, None], [1.0, 2.0], [2.0, 4.0], [None] * 16]
    return out + [(1000 + i, b) for i, b in enumerate(bad)] + [(None, out[0][1])]


@pytest.mark.parametrize("kind,block", [("double", 4096), ("double", 16), ("float", 50)])
def test_vectors(spark, kind, block):
    data = vectors()
    if kind == "float":
        data = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in data]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in data], f"vec_id long, embedding array<{kind}>, v int, cell int")
    got = quantised.near_vectors(df, "vec_id", "embedding", block=block, cells=5).collect()
    ids, links, n_links = [-1 if i is None else i for i, _ in data], [], {}
    fine = lambda v: v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    for a, (_, v) in zip(ids, data, strict=True):
        n_links[a] = 0
        for b, (_, w) in zip(ids, data, strict=True):
            if a != b and fine(v) and fine(w) and len(v) == len(w):
                if np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.95:
                    links.append((a, b))
                    n_links[a] += 1
    least = rows.components(set(ids), links)
    null = lambda i: None if i == -1 else i
    same(got, [(null(i), n_links[i], null(least[i]), least[i] == i) for i in ids])
    assert quantised.near_vectors(df.limit(0), "vec_id", "embedding").collect() == []


@pytest.mark.parametrize("block", [4096, 16])
def test_vectors_of_shared_ids(spark, block):
    data = [(None if i is None or i % 9 == 0 else i // 2, v) for i, v in vectors()]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = quantised.near_vectors(df, "vec_id", "embedding", block=block, cells=5).collect()
    ids, links, n_links = [-1 if i is None else i for i, _ in data], [], [0] * len(data)
    fine = lambda v: v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    for a, (_, v) in enumerate(data):
        for b, (_, w) in enumerate(data):
            if a != b and fine(v) and fine(w) and len(v) == len(w):
                if np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.95:
                    links.append((ids[a], ids[b]))
                    n_links[a] += 1
    least = rows.components(set(ids), links)
    null = lambda i: None if i == -1 else i
    same(got, [(null(i), n, null(least[i]), least[i] == i) for i, n in zip(ids, n_links, strict=True)])


def test_bounds_hold():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    q, s, e = quantised.quantised(x)
    rough = (q.astype(float) @ q.T.astype(float)) * s[:, None] * s[None, :]
    assert (np.abs(rough - x @ x.T) <= e[:, None] + (1 + e[:, None]) * e[None, :] + 1e-12).all()


def test_extreme_lengths_lose_no_link(spark):
    rows = [(1, [1.0, 1.0]), (2, [1.0, 1.01]), (3, [1e-200, 1e-200]), (4, [1e200, 1e200]), (5, [0.0, 0.0]), (6, [-1.0, 1.0]), (7, [5e-324, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in quantised.near_vectors(df, "vec_id", "embedding").collect()}
    assert got == {1: 3, 2: 3, 3: 3, 4: 3, 5: 0, 6: 0, 7: 0}


def test_rounds_of_adverse_chains(spark, monkeypatch):
    import random

    from corpusloom.llm import components

    rounds = []
    write = components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, name: (rounds.append(name), write(df, name))[1])
    for order in ([1, *range(60, 1, -1)], random.Random(1).sample(range(1, 121), 120)):
        rounds.clear()
        links = spark.createDataFrame(list(zip(order, order[1:])), "u long, v long")
        got = components.components(links).collect()
        assert {r.component for r in got} == {1} and len(got) == len(order)
        assert rounds.count("labels") <= 12
