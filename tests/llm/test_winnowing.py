"""Contamination against brute force, with short items, ties and awkward rows."""

import re

from corpusloom.llm import winnowing
from tests.llm import rows


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for p in range(len(w) - n + 1):
                if (owners := windows.get(tuple(w[p : p + n]))) is not None:
                    hit |= set(range(p, p + n))
                    found |= owners
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def test_contamination(spark, monkeypatch):
    data = rows.documents(5)
    texts = [t for _, t in data if t and len(t.split()) > 40]
    items = [(i, " ".join(texts[i].split()[3 : 3 + n]).upper()) for i, n in enumerate((13, 20, 30, 14, 12, 5, 1))]
    items += [(20, texts[0]), (20, texts[0]), (21, None), (22, ""), (None, " ".join(texts[2].split()[:15])), (23, "?!"), (24, "one")]
    df = rows.frame(spark, data)
    tests = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, hash string, id int")
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    want = sorted(map(key, brute(data, items)))
    assert sorted(key(tuple(r)) for r in winnowing.contamination(df, tests).collect()) == want
    monkeypatch.setattr(winnowing, "BROADCAST_ROWS", 0)  # the way without broadcasts
    assert sorted(key(tuple(r)) for r in winnowing.contamination(df, tests).collect()) == want
    none = winnowing.contamination(df, tests.limit(0)).collect()
    assert len(none) == len(data) and all(r.n_hit == 0 and r["items"] == [] for r in none)
    assert winnowing.contamination(df.limit(0), tests).collect() == []
