"""Small documents with the awkward rows that every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, tag string, body int, k int, spans string"


def documents(seed=1, n=30, words=90, vocabulary=400):
    rng = random.Random(seed)
    words_ = [f"w{i}" if i % 7 else f"Wört{i}" for i in range(vocabulary)]
    texts = []
    for _ in range(n):
        texts.append(" ".join(rng.choice(words_) for _ in range(rng.randrange(1, words))))
    long = [t for t in texts if len(t.split()) > 60]
    texts += [long[0], long[0] + " tail", "head " + long[1], long[2].replace("w1", "w2", 3), long[0].upper()]
    texts += ["x y " + " ".join(long[3].split()[5:60]) + "\n" + " ".join(texts[1].split()[:9]), "a " * 300, "a " * 300 + "b"]
    texts += [None, "", "   ", None, "\x00\x1c !?", "one", "one two three", "one two three"]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    rows += [rows[0], rows[31], (None, long[1]), (None, None)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 9, "x", 1, 2, "y") for i, t in rows], SCHEMA)


def components(nodes, links):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least
