import math
import random
from collections import Counter

import numpy as np
import pytest

from tierflow.llm import lm_scoring as lm
from tierflow.llm.common import fold_of


def corpus(n=300, seed=2):
    rng = random.Random(seed)
    words = ["The", "a", "É", "of"] + [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(rng.choice(words[:8] if rng.random() < 0.5 else words) for _ in range(rng.randrange(0, 30)))) for k in range(n)]
    return [*rows, (n, None), (n + 1, "\t \n"), (None, "the of"), (5, rows[5][1])]


def tokens(text):
    return [*(text or "").encode().lower().split(), b" "]


def brute(rows, step_rounding=True):
    """Counts, weights and scores by plain dictionaries."""
    train = [(fold_of(d, 10), tokens(t)) for d, t in rows]
    def count(folds):
        one, two = Counter(), Counter()
        for f, t in train:
            if f in folds:
                one.update(t)
                two.update(zip([b" ", *t], t, strict=False))
        return one, two
    one, two = count(range(1, 10))
    kept1, kept2 = count(range(2, 10))
    n, types, kept_n = sum(one.values()), len(one), sum(kept1.values())
    uniform = 1 / (types + 1)
    def parts(a, b, c1, c2, total):
        return (c2[a, b] / c1[a] if c1[a] else 0.0, c1[b] / total if total else 0.0, uniform)
    cells = Counter()
    for f, t in train:
        if f == lm.DELETED:
            for a, b in zip([b" ", *t], t, strict=False):
                p = parts(a, b, kept1, kept2, kept_n)
                key = [round(lm.STEP * math.log2(x / uniform)) if x else -1000 for x in p[:2]]
                cells[int(lm.bucket_of(np.array([kept1[a]]))[0]), *key] += 1
    import pandas as pd
    frame = pd.DataFrame([(*k, v) for k, v in cells.items()], columns=["bucket", "two", "one", "tokens"])
    mix = lm.weights(frame)
    out = {}
    for (d, _), (f, t) in zip(rows, train, strict=True):
        score = sum(math.log10(float(mix[lm.bucket_of(np.array([one[a]]))[0]] @ parts(a, b, one, two, n)))
                    for a, b in zip([b" ", *t], t, strict=False))
        base = sum(math.log10((one[w] + 0.1) / (n + 0.1 * (types + 1))) for w in t)
        out[d] = (f == 0, len(t), sum(one[w] > 0 for w in t), n, base, score)
    return out


def test_scores_equal_plain_counting(spark):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, 1.0) for d, t in rows], "doc_id long, text string, score double")
    expected = brute(rows)
    out = lm.score(docs, chunk_chars=700).collect()
    assert len(out) == len(rows)
    for r in out:
        held, n, known, total, base, score = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def test_chunk_size_changes_nothing(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    def scores(chars):
        return sorted((r.doc_id or -1, round(r.score, 9)) for r in lm.score(docs, chars).collect())
    assert scores(300) == scores(10**7)


def test_em_finds_the_weights_of_a_mixture():
    import pandas as pd
    rng = np.random.default_rng(1)
    true, ratios = np.array([0.6, 0.3, 0.1]), np.array([[16.0, 1.0, 1.0], [1.0, 16.0, 1.0], [0.0, 0.0, 1.0]])
    # kinds of tokens, whose frequency under the mixture is proportional to true @ ratios
    share = ratios @ true * np.array([1, 1, 10])
    counts = rng.multinomial(200_000, share / share.sum())
    frame = pd.DataFrame({"bucket": 3, "two": [16, 0, -1000], "one": [0, 16, -1000], "tokens": counts})
    w = lm.weights(frame)[3]
    assert w.sum() == pytest.approx(1) and (w > 0).all()
    def likelihood(x):
        return (counts * np.log(ratios @ x)).sum()
    assert likelihood(w) >= max(likelihood(np.array([a, b, 1 - a - b])) for a in np.arange(0.02, 0.97, 0.05)
                                for b in np.arange(0.02, 0.97 - a, 0.05)) - 1


def test_probabilities_sum_to_one():
    """After every context, seen or not, over all words and the unknown one."""
    import pandas as pd
    rng = np.random.default_rng(5)
    pairs = rng.integers(0, 5, (12, 12)) * (rng.random((12, 12)) < 0.4)
    pairs[3] = 0  # a context never seen
    one, seen = pairs.sum(0) + 1, pairs.sum(1)
    frame = pd.DataFrame({"bucket": [1, 2, 2], "two": [8, 4, -1000], "one": [4, -4, -1000], "tokens": [50, 30, 5]})
    mix = lm.weights(frame)
    assert np.allclose(mix.sum(1), 1) and mix[0, 0] == 0 and (mix[1:] > 0).all()
    for context in range(12):
        w = mix[lm.bucket_of(seen[context:context + 1])][0]
        p = w[0] * lm.share(pairs[context], seen[context]) + w[1] * one / one.sum() + w[2] / 13
        assert p.sum() + w[2] / 13 == pytest.approx(1)


def test_without_training_documents(spark):
    held = [k for k in range(200) if fold_of(k, 10) == 0][:3]
    docs = spark.createDataFrame([(k, "a b") for k in held], "doc_id long, text string")
    for r in lm.score(docs).collect():
        assert (r.n_known, r.train_tokens, r.base_score, r.score) == (0, 0, pytest.approx(0), pytest.approx(3 * math.log10(1 / 3)))
    assert lm.score(docs.where("false")).collect() == []
