"""The classifier chain against a plain version: word statistics by counting, models by Newton's method on dense matrices."""

import math
import random
import re

import numpy as np

from lexspark.llm import _text as tx
from lexspark.llm import toxicity


def corpus(n):
    rng = random.Random(17)
    stock, bad, poor = [f"w{i}" for i in range(60)], [f"bad{i}" for i in range(5)], [f"poor{i}" for i in range(6)]
    rows = []
    for i in range(n):
        low, toxic = rng.random() < 0.3, rng.random() < 0.25
        words = rng.choices(stock, k=rng.randint(3, 25)) + (rng.choices(poor, k=2) if low else []) + (rng.choices(bad, k=2) if toxic else rng.choices(bad, k=int(rng.random() < 0.05)))
        rng.shuffle(words)
        rows.append((3 * i - 50, " ".join(words).replace("bad1", "BAD1,"), int(not low), int(toxic or (low and rng.random() < 0.3))))
    return rows


def newton(x, y, ridge=0.5):
    """Ridge-penalised logistic regression, the bias (last column) free."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.append(np.full(x.shape[1] - 1, ridge), 0.0)
    theta = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ theta))
        grad = x.T @ (p - y) + penalty * theta
        theta -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(penalty + 1e-12), grad)
    return theta


def odds_of(theta, x):
    return x @ theta[:-1] + theta[-1]


def test_chain_equals_a_plain_one(spark):
    rows = corpus(700)
    sets = [set(re.findall(r"[^\W_]+", t.lower())) for _, t, _, _ in rows]
    yes = {"low_quality": np.array([r[2] == 0 for r in rows], float), "toxic": np.array([r[3] == 1 for r in rows], float)}
    total, chosen = len(rows), set()
    for y in yes.values():
        for w in set().union(*sets):
            has = np.array([w in s for s in sets])
            n, a, t, k = has.sum(), (has * y).sum(), total, y.sum()
            cell = lambda o, e: o * math.log(o / e) if o > 0 else 0.0
            g2 = 2 * (cell(a, n * k / t) + cell(n - a, n * (t - k) / t) + cell(k - a, (t - n) * k / t) + cell(t - n - (k - a), (t - n) * (t - k) / t))
            if n >= 3 and g2 >= toxicity.LEAST_G2:
                chosen.add(w)
    words = sorted(chosen)
    x = np.array([[w in s for w in words] for s in sets], float)
    fold = (tx.mix(np.array([r[0] for r in rows], np.int64).view(np.uint64)) % np.uint64(toxicity.FOLDS)).astype(int)
    want, features, learned = {}, x, x
    for name, y in yes.items():
        theta = newton(learned, y)
        want[name] = odds_of(theta, features)
        # The next model learns from predictions of models that haven't seen the row, and meets those of the whole model.
        held = np.zeros(total)
        for k in range(toxicity.FOLDS):
            held[fold == k] = odds_of(newton(learned[fold != k], y[fold != k]), learned[fold == k])
        learned = np.hstack([learned, np.clip(held, -6, 6)[:, None]])
        features = np.hstack([features, np.clip(want[name], -6, 6)[:, None]])

    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows], "doc_id bigint, quality int, toxic int").repartition(3)
    chain = toxicity.fit_chain(docs, labels)
    assert len(chain.words) == len(words) >= 8 and chain.categories == ("low_quality", "toxic") and len(chain.models[1][2]) == 1
    got = {r.doc_id: (r.p_low_quality, r.p_toxic) for r in toxicity.score_chain(docs, chain).collect()}
    for k, name in enumerate(yes):
        p = 1 / (1 + np.exp(-want[name]))
        assert max(abs(got[r[0]][k] - p[i]) for i, r in enumerate(rows)) < 0.02


def test_clashing_names(spark):
    rows = corpus(60)
    docs = spark.createDataFrame([(*r[:2], 0.5, "x") for r in rows], "doc_id bigint, text string, p_toxic double, words string")
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows], "doc_id bigint, quality int, toxic int")
    out = toxicity.score_chain(docs, toxicity.fit_chain(docs, labels))
    assert out.columns == ["doc_id", "text", "words", "p_low_quality", "p_toxic"] and out.where("words = 'x'").count() == 60
