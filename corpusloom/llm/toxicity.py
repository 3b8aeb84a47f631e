"""Toxicity by a subsequence string kernel and a support vector machine on Nyström landmarks.

The kernel counts the subsequences of three and four letters that two words share, each weighted down for every letter in
between, so an insult with inserted or missing letters stays close to the plain one. A machine is trained on the words
of labelled texts. Since the kernel is a product of weighted subsequence counts, the trained sum over landmarks folds
into one weight per subsequence, and scoring a word costs a few look-ups whatever the number of landmarks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import row_id
from corpusloom.session import materialize

#: Bounds of the fit: labelled rows, training words and landmarks. Scores are computed for all rows.
TRAIN_ROWS, TRAIN_WORDS, LANDMARKS = 20_000, 30_000, 384
#: A subsequence spans up to six letters; each letter in between multiplies its weight.
SPAN, DECAY = 5, 0.6
STEPS = [steps for n in (2, 3) for steps in combinations(range(1, SPAN + 1), n)]
#: Signs that are read as letters.
ALIKE = str.maketrans("013457@$!|", "oieastasil")
_LETTERS = 64
#: Subsequences of three letters have keys of their own, those of four share as many.
KEYS = 2 * _LETTERS**3
_EDGE = re.compile(r"^\W+|\W+$")
REMEMBERED = 200_000
#: Words whose subsequences meet the landmarks at a time: some 200 rows of landmarks each, on the driver.
PRODUCTS = 20


def _codes() -> np.ndarray:
    """A small code per character: a letter's place in the alphabet, others share the codes above."""
    codes = 27 + (np.arange(0x800) * 7) % 35
    codes[ord("a") : ord("z") + 1] = np.arange(1, 27)
    codes[ord("\n")], codes[ord("\x02")] = 0, 62
    return codes.astype(np.int64)


CODES = _codes()


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word number, key and weight of every subsequence, weights scaled to length 1 within a word."""
    joined = "\n".join(f"\x02{w}\x02" for w in words) + "\n"
    code = CODES[np.minimum(np.frombuffer(joined.encode("utf-32-le"), np.uint32), 0x7FF)]
    word = np.cumsum(code == 0) - (code == 0)
    code_after = np.concatenate([code, np.zeros(SPAN, np.int64)])
    word_after = np.concatenate([word, np.full(SPAN, -1)])
    n, which, keys, weights = len(code), [], [], []
    for steps in STEPS:
        last = steps[-1]
        ok = np.nonzero((code > 0) & (word_after[last : last + n] == word) & (code_after[last : last + n] > 0))[0]
        key = code[ok]
        for step in steps:
            key = key * _LETTERS + code_after[ok + step]
        if len(steps) == 3:
            key = _LETTERS**3 + key * 2654435761 % 2**32 // 2**14
        which.append(word[ok])
        keys.append(key)
        weights.append(np.full(len(ok), DECAY ** (last - len(steps))))
    w, key, weight = (np.concatenate(x) for x in (which, keys, weights))
    length = np.sqrt(np.bincount(w, weight**2, minlength=len(words)))
    return w, key, weight / length[w]


def units(text: str) -> list[str]:
    """The distinct words of a text, and runs of single letters read as one word."""
    tokens = text.lower().split()
    found = set(tokens)
    single = [i for i, t in enumerate(tokens) if len(t) == 1]
    if len(single) > 2:
        run: list[int] = []
        for i in [*single, -1]:
            if run and i != run[-1] + 1:
                if len(run) > 2:
                    found.add("".join(tokens[r] for r in run))
                run = []
            run.append(i)
    return list(found)


def plain(unit: str) -> str:
    return _EDGE.sub("", unit).translate(ALIKE)


@dataclass
class Model:
    """Weights per subsequence, offset, and how a text's two highest word scores become its score."""

    table: np.ndarray
    offset: float
    top: tuple[float, float, float]

    def words(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        which, key, weight = subsequences(words)
        return np.bincount(which, weight * self.table[key], minlength=len(words)) + self.offset

    def texts(self, texts: list[str | None], known: dict[str, float]) -> np.ndarray:
        """Highest and second highest word score of each text (a text of one word has it twice); ``known`` remembers
        scores of units."""
        of = [units(t or "") for t in texts]
        new = list({u for us in of for u in us if u not in known})
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list({u for us in of for u in us})
        for i in range(0, len(new), 1000):
            part = new[i : i + 1000]
            known.update(zip(part, self.words([plain(u) for u in part]).tolist(), strict=True))
        out = np.full((len(texts), 2), -2.0)
        for row, us in zip(out, of, strict=True):
            if us:
                scores = sorted(map(known.__getitem__, us))[-2:]
                row[:] = scores[-1], scores[0]
        return np.clip(out, -2, 4)

    def score(self, top: np.ndarray) -> np.ndarray:
        a, b, c = self.top
        return 1 / (1 + np.exp(-(a * top[:, 0] + b * top[:, 1] + c)))


def _landmark_products(words: list[str], rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The kernel of each word with each landmark; ``rows`` finds a subsequence's row in ``table``."""
    out = np.zeros((len(words), table.shape[1]), np.float32)
    for i in range(0, len(words), PRODUCTS):
        which, key, weight = subsequences(words[i : i + PRODUCTS])
        hit = rows[key] > 0
        which, key, weight = which[hit], key[hit], weight[hit]
        order = np.argsort(which, kind="stable")
        which = which[order]
        values = table[rows[key[order]]]
        values *= weight[order, None].astype(np.float32)
        starts = np.nonzero(np.concatenate([[True], which[1:] != which[:-1]]))[0] if len(which) else []
        if len(which):
            out[i + which[starts]] = np.add.reduceat(values, starts, axis=0)
    return out


def fit_words(words: list[str], toxic: np.ndarray, clean: np.ndarray, landmarks: int) -> tuple[np.ndarray, float]:
    """Weights per subsequence and offset, from words with the numbers of toxic and clean texts they are in."""
    n = toxic + clean
    base = toxic.sum() / max(n.sum(), 1)
    odd = (toxic - n * base) / np.sqrt(n * base * (1 - base) + 1e-9)
    order = np.lexsort((np.arange(len(words)), -odd))
    chosen = np.unique(np.concatenate([order[: landmarks // 2], np.argsort(-n, kind="stable")[: landmarks // 2]]))
    marks = [words[i] for i in chosen]
    which, key, weight = subsequences(marks)
    distinct = np.unique(key)
    rows = np.zeros(KEYS, np.int32)
    rows[distinct] = np.arange(1, len(distinct) + 1)
    table = np.zeros((len(distinct) + 1, len(marks)), np.float32)
    np.add.at(table, (rows[key], which), weight.astype(np.float32))
    values, vectors = np.linalg.eigh((table.T @ table).astype(float))
    good = values > 1e-5 * values.max()
    root = (vectors[:, good] / np.sqrt(values[good])).astype(np.float32)
    x = np.ones((len(words), root.shape[1] + 1), np.float32)
    blocks = [slice(i, i + 2000) for i in range(0, len(words), 2000)]
    for b in blocks:
        np.matmul(_landmark_products(words[b], rows, table), root, out=x[b, :-1])
    # squared hinge loss, by Newton's method; a word is an example once per text it is in
    v, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-5 * n.sum())
    ridge[-1] = 1e-6 * n.sum()
    for _ in range(30):
        slope, curve = ridge * v, np.diag(ridge)
        for b in blocks:
            part = x[b].astype(float)
            f = part @ v
            up, down = toxic[b] * (f < 1), clean[b] * (f > -1)
            slope += part.T @ (down * (1 + f) - up * (1 - f))
            curve += (part * (up + down)[:, None]).T @ part
        step = np.linalg.solve(curve, slope)
        v -= step
        if np.abs(step).max() < 1e-6:
            break
    weights = np.zeros(KEYS)
    weights[distinct] = table[1:] @ (root @ v[:-1]).astype(np.float32)
    return weights, float(v[-1])


def fit_top(top: np.ndarray, label: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression on the two highest word scores."""
    x, v = np.column_stack([top, np.ones(len(top))]), np.zeros(3)
    loss = lambda w: np.logaddexp(0, x @ w).sum() - label @ (x @ w) + 5e-3 * w @ w
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ v))
        slope = x.T @ (p - label) + 1e-2 * v
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3), slope)
        while np.abs(step).max() > 1e-9 and loss(v - step) > loss(v):
            step /= 2  # a full step may overshoot
        v = v - step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(v.tolist())


def learn(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, usable: Column, train_rows: int = TRAIN_ROWS
) -> Model:
    """Fit on at most ``train_rows`` labelled rows, those with the least hashes of their key.

    ``labels`` has one label 0 or 1 per key (of several the greatest; null ones are left out); ``usable`` says which
    of its rows may be learnt from. Three quarters train the words, a quarter the step from words to texts. Without
    labels of both kinds every text scores the share of toxic ones.
    """
    rows = labels.where(usable & F.col(label).isin(0, 1) & F.col(key).isNotNull())
    rows = rows.groupBy(F.col(key).cast("long").alias("id")).agg(F.max(label).cast("int").alias("y"))
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(train_rows)  # bounded, so it may be broadcast
    known = docs.select(row_id(key).alias("id"), F.col(text).alias("t")).join(F.broadcast(picked), "id")
    known = materialize(known.withColumn("part", F.expr("pmod(xxhash64(id, 3), 4)")), "labelled")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, y = [], []
            for t, label_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = {plain(u) for u in units(t or "")}
                w += own
                y += [label_] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(y, pa.int32())], ["w", "y"])

    # written first: collected at once, every task would send its own most frequent words to the driver
    counts = materialize(
        known.where("part > 0").select("t", "y").mapInArrow(words, "w string, y int").where("w <> ''")
        .groupBy("w").agg(F.sum("y").alias("toxic"), F.count("*").alias("n"))
        .where("n > 1").orderBy(F.desc("n"), "w").limit(TRAIN_WORDS),
        "frequent",
    ).orderBy(F.desc("n"), "w").collect()
    toxic = np.array([r.toxic for r in counts], float)
    n = np.array([r.n for r in counts], float)
    share = known.agg(F.avg("y")).first()[0] or 0.0
    if not len(counts) or toxic.sum() in (0, n.sum()):
        share = min(max(share, 0.01), 0.99)
        return Model(np.zeros(KEYS), 0.0, (0.0, 0.0, float(np.log(share / (1 - share)))))
    table, offset = fit_words([r.w for r in counts], toxic, n - toxic, LANDMARKS)
    model = Model(table, offset, (0.0, 0.0, 0.0))
    held = _top(known.where("part = 0").select("y", "t"), "y", model).select("y", "top", "second").collect()
    if held:
        model.top = fit_top(np.array([[r.top, r.second] for r in held]), np.array([r.y for r in held], float))
    return model


def _top(df: DataFrame, key: str, model: Model) -> DataFrame:
    """``key`` with the two highest word scores and the score of each text (second column)."""
    kind = dict(df.dtypes)[key]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = shared.value, {}
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                top = own.texts(part.column(1).to_pylist(), known)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(top[:, 0]), pa.array(top[:, 1]), pa.array(own.score(top))],
                    [key, "top", "second", "score"],
                )

    return df.mapInArrow(run, f"`{key}` {kind}, top double, second double, score double")


def toxicity(docs: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """``key`` and ``score`` (0 to 1) of every row's whole text; null and empty texts score as having no words."""
    return _top(docs.select(F.col(key), F.col(text).alias("_text")), key, model).select(key, "score")
