"""The step-wise trainer against a plain NumPy one: same states, scores and choice."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import training as X
from corpusloom.operators.metrics import overall


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    out = []
    for i in range(300):
        label = int(rng.random() < 0.3)
        words = [f"w{rng.integers(40)}" for _ in range(rng.integers(0, 12))]
        words += [("up" if label else "down") if rng.random() < 0.7 else "both"] * (rng.random() < 0.8)
        out.append((i, " ".join(words), label, ["train", "train", "val"][i % 3]))
    out += [(900, None, 1, "train"), (901, "no label", None, "train"), (902, "", 0, "train")]
    return spark.createDataFrame(out, "doc_id long, text string, label_id int, split string").repartition(5)


def plain(rows, val, setting, start=None, pull=0.0):
    """Dense matrices and a loop."""

    def dense(df):
        found = df.where("text IS NOT NULL AND label_id IS NOT NULL").select(
            X.word_ids("text", setting.features).alias("ids"), "label_id", F.pmod(F.xxhash64("text"), F.lit(setting.batches)).alias("part")
        ).collect()
        x = np.zeros((len(found), setting.features + 1))
        for k, r in enumerate(found):
            for i in r.ids:
                x[k, i] += 1 / np.sqrt(len(r.ids))
            x[k, -1] = 1
        return x, np.array([r.label_id for r in found]), np.array([r.part for r in found])

    x, y, part = dense(rows)
    vx, vy, _ = dense(val)
    share = len(y) / (2 * np.bincount(y, minlength=2))
    w = np.zeros((2, setting.features + 1)) if start is None else start.weights.copy()
    home, seen = w.copy(), np.zeros_like(w)

    def f1(w):
        p = (vx @ w.T).argmax(axis=1)
        out = []
        for c in np.union1d(p, vy):
            hit, wrong = ((p == c) & (vy == c)).sum(), ((p == c) != (vy == c)).sum()
            out.append(2 * hit / (2 * hit + wrong))
        return np.mean(out)

    scores, best, step_of_best, worse = [(0, f1(w))], w.copy(), 0, 0
    for step in range(1, setting.steps + 1):
        own = part == (step - 1) % setting.batches
        z = x[own] @ w.T
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p -= np.eye(2)[y[own]]
        s = share[y[own]]
        slope = (p * s[:, None]).T @ x[own] / s.sum() + (0 if start is not None else setting.reg * w)
        seen += slope**2
        rate = setting.rate / (np.sqrt(seen) + 1e-6)
        w = w - rate * slope
        if start is not None:
            w = (w + rate * pull * home) / (1 + rate * pull)
        if step % setting.every == 0 or step == setting.steps:
            scores.append((step, f1(w)))
            if scores[-1][1] > max(v for _, v in scores[:-1]):
                best, step_of_best, worse = w.copy(), step, 0
            else:
                worse += 1
                if worse == setting.patience:
                    break
    return best, step_of_best, scores


@pytest.mark.parametrize(
    "setting",
    [
        X.Setting(features=64, steps=9, every=2, patience=9),
        X.Setting(features=64, steps=12, every=1, patience=2, rate=2.0, reg=0.1),
        X.Setting(features=8, steps=7, every=3, batches=3),
    ],
)
def test_same_as_numpy(rows, setting):
    train, val = rows.where("split = 'train'"), rows.where("split = 'val'")
    got = X.train(train, val, setting=setting)
    weights, step, scores = plain(train, val, setting)
    assert (got.step, [s for s, _ in got.scores]) == (step, [s for s, _ in scores])
    assert np.allclose([v for _, v in got.scores], [v for _, v in scores], atol=1e-12)
    assert np.allclose(got.weights, weights, atol=1e-9)
    out = got.apply(val)
    assert set(out.columns) == {*val.columns, "logits", "probabilities", "predicted_id"}
    again = overall(out, "label_id", "predicted_id").first().f1_macro
    assert again == pytest.approx(max(v for _, v in scores), abs=1e-9)


def test_warm_start(spark, rows, tmp_path):
    train, val = rows.where("split = 'train'"), rows.where("split = 'val'")
    setting = X.Setting(features=64, steps=6, every=2)
    base = X.train(train, val, setting=setting)
    base.save(spark, str(tmp_path / "base"))
    base = X.Trained.load(spark, str(tmp_path / "base"))
    assert base.setting == setting and len(base.scores) == 4
    turned = rows.withColumn("text", F.regexp_replace(F.regexp_replace("text", "up", "x"), "down", "up"))
    turned = turned.withColumn("text", F.regexp_replace("text", r"\bx\b", "down"))
    own, own_val = turned.where("split = 'train'"), turned.where("split = 'val'")
    none = X.train(own, own_val, setting=X.Setting(features=64, steps=0), start=base, pull=1.0)
    assert none.step == 0 and (none.weights == base.weights).all()
    longer = X.Setting(features=64, steps=40, every=5, rate=1.0, patience=9)
    adapted = X.train(own, own_val, setting=longer, start=base, pull=0.001)
    weights, step, scores = plain(own, own_val, longer, base, 0.001)
    assert adapted.step == step and np.allclose(adapted.weights, weights, atol=1e-9)
    assert adapted.scores[0][1] < max(v for _, v in adapted.scores)  # better than the base in the domain
    drawn = X.train(own, own_val, setting=longer, start=base, pull=1e4)
    assert abs(adapted.weights - base.weights).max() > 0.1 > 1e-3 > abs(drawn.weights - base.weights).max()


def test_refusals(rows):
    base = X.Trained(np.zeros((2, 9)), X.Setting(features=8))
    with pytest.raises(ValueError):
        X.train(rows, rows, setting=X.Setting(features=16), start=base)
    with pytest.raises(ValueError):
        X.train(rows.where("false"), rows)


def test_three_classes_and_empty_validation(spark):
    df = spark.createDataFrame([("a a", 0), ("b b", 1), ("c", 2)] * 10, "text string, label_id int")
    setting = X.Setting(features=32, steps=6, every=2)
    got = X.train(df, df, setting=setting)
    assert got.weights.shape == (3, 33) and max(v for _, v in got.scores) == 1.0
    assert X.train(df, df.where("false"), setting=setting).step == 0
