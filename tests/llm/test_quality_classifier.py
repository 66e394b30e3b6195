import random

import duckdb
import numpy as np

from tierflow.llm import quality_classifier as qc
from tierflow.llm.common import fold_of


def corpus(n=1500, seed=2):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        bad = rng.random() < 0.3
        words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(rng.randrange(12, 60))]
        if bad:
            words = [w + rng.choice(["%%%", "###", "!!"]) for w in words] if k % 2 else [words[0]] * 40
        source = ("bad" if bad else "good") if rng.random() < 0.9 else "any"
        rows.append((k, " ".join(words), rng.choice(["en", "de", None]), source, sum(map(len, words)), int(not bad)))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"


def frames(spark, rows, labelled=0.3):
    docs = spark.createDataFrame([(*r[:5], "x") for r in rows], SCHEMA)
    labels = spark.createDataFrame([(r[0], r[5]) for r in rows if r[0] % 10 < 10 * labelled], "doc_id long, quality int")
    return docs, labels


def test_held_out_accuracy(spark):
    rows = corpus()
    docs, labels = frames(spark, rows)
    out = {r.doc_id: r for r in qc.score(docs, qc.fit(docs, labels, labelled=300, pool=300)).collect()}
    held = [r for r in rows if fold_of(r[0], qc.FOLDS) == qc.HELD_OUT]
    assert len(out) == len(rows) and all(out[r[0]].held_out for r in held)
    assert sum(out[r[0]].kept == bool(r[5]) for r in held) >= 0.97 * len(held)


def test_views_learn_from_each_other():
    """With few labels, pseudo-labels of the text view make the metadata view better."""
    rows = corpus(3000, 5)
    views = [np.stack([qc.text_view(r[1]) for r in rows]), np.stack([qc.metadata_view(*r[2:5]) for r in rows])]
    y, folds = np.array([r[5] for r in rows]), np.array([fold_of(r[0], qc.FOLDS) for r in rows])
    label = np.where(np.arange(len(y)) < 300, y, -1)
    test = np.arange(len(y)) >= 1500
    seen = ~test
    def metadata_error(rounds):
        model = qc.co_train(label[seen], folds[seen], [v[seen] for v in views], rounds, 400, 0.95)
        return ((qc.margin(views[1][test], model.metadata) > 0) != y[test]).mean()
    assert metadata_error(4) <= metadata_error(0)


def given_views():
    """Views, labels (-1 without one) and folds of the given documents."""
    frame = duckdb.sql("""
        SELECT doc_id, lang, source, n_chars::double AS n_chars, text, quality FROM '/root/testdata/sf0.1/documents.parquet'
        LEFT JOIN (SELECT doc_id, min(quality) AS quality FROM '/root/testdata/sf0.1/labels.parquet' GROUP BY 1) USING (doc_id)
        ORDER BY doc_id""").df()
    views = [np.stack([qc.text_view(t) for t in frame["text"]]),
             np.stack([qc.metadata_view(*r) for r in zip(frame["lang"], frame["source"], frame["n_chars"], strict=True)])]
    y = frame["quality"].fillna(-1).astype(int).to_numpy()
    return views, y, np.array([fold_of(d, qc.FOLDS) for d in frame["doc_id"]])


def test_exchange_improves_the_metadata_view_of_given_documents():
    """Each fold held out in turn, as one has some 400 labels: less loss, both classes weighing the same."""
    views, y, folds = given_views()
    losses, handed = {0: [], 5: []}, []
    for turn in range(qc.FOLDS):
        fold = (folds + turn) % qc.FOLDS
        test, labelled = (fold == qc.HELD_OUT) & (y >= 0), (fold != qc.HELD_OUT) & (y >= 0)
        pool = np.random.default_rng(turn).permutation(np.flatnonzero((fold != qc.HELD_OUT) & (y < 0)))[:4000]
        seen = np.sort(np.concatenate([np.flatnonzero(labelled), pool]))
        for rounds, found in losses.items():
            model = qc.co_train(y[seen], fold[seen], [v[seen] for v in views], rounds, 400, 0.99)
            p = np.clip(model.scores(views[0][test], views[1][test])[1], 1e-9, 1 - 1e-9)
            of = y[test] > 0
            found.append((-np.log(p[of]).mean() - np.log(1 - p[~of]).mean()) / 2)
        handed.append(model.handed[0])
    assert min(handed) > 0 and np.mean(losses[5]) < np.mean(losses[0])


def test_both_views_hand_on_and_gain():
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 6000)
    def view(noise):
        signs = (2 * y - 1)[:, None] * np.array([1.0, 0.6, 0.3, *[0.0] * 30])
        return np.hstack([np.ones((len(y), 1)), signs + rng.normal(0, noise, (len(y), 33))])
    views, folds = [view(0.8), view(1.0)], np.arange(len(y)) % 10
    label, test = np.where(np.arange(len(y)) < 300, y, -1), np.arange(len(y)) >= 4000
    seen = ~test
    before, after = (qc.co_train(label[seen], folds[seen], [v[seen] for v in views], r, 200, 0.9) for r in (0, 5))
    assert min(after.handed) > 0 and before.handed == (0, 0)
    for view, name in zip(views, ("text", "metadata"), strict=True):
        errors = [((qc.margin(view[test], getattr(m, name)) > 0) != y[test]).mean() for m in (before, after)]
        assert errors[1] < errors[0]


def test_a_view_without_news_is_left_as_it_was():
    rng = np.random.default_rng(1)
    y, folds = rng.integers(0, 2, 2000), np.arange(2000) % 10
    views = [np.stack([np.ones(2000), 4.0 * y - 2 + rng.normal(0, 1, 2000)], 1), np.ones((2000, 1))]
    label = np.where(np.arange(2000) < 500, y, -1)
    models = [qc.co_train(label, folds, views, r, 200, 0.95) for r in (0, 5)]
    assert models[1].handed == (0, 0) and np.allclose(models[0].metadata, models[1].metadata)


def test_platt_is_the_best_line():
    rng = np.random.default_rng(2)
    z = rng.normal(0, 2, 400)
    y = (rng.random(400) < qc.sigmoid(0.5 + 1.5 * z)).astype(int)
    def loss(a, b):
        losses = np.logaddexp(0, np.where(y > 0, -1, 1) * (a + b * z))
        return (losses[y > 0].mean() + losses[y <= 0].mean()) / 2
    a, b = qc.platt(z, y)
    assert qc.calibrated_loss(z, y) == loss(a, b)
    assert loss(a, b) <= min(loss(u, v) for u in np.arange(-2, 2, 0.05) for v in np.arange(0, 3, 0.05)) + 1e-4


def test_sure_is_the_widest_band_by_trying_all():
    rng = np.random.default_rng(6)
    for _ in range(20):
        z = rng.normal(0, 1, 150)
        y = (rng.random(150) < qc.sigmoid(4 * z)).astype(int)
        found = qc.sure(z, z, y, 0.9)
        for value, sign in ((1, 1), (0, -1)):
            widest = max((k for k in range(20, 151)
                          if (y[np.argsort(-sign * z)[:k]] == value).sum() / (k + 1) >= 0.9), default=0)
            band = set(np.argsort(-sign * z)[:widest].tolist())
            assert set(np.flatnonzero(found == value)) == (band if value == 0 else band - set(np.flatnonzero(found == 0)))


def test_one_row_for_each_sampled_id(spark):
    rows = corpus(300)
    docs, labels = frames(spark, [*rows, *[(rows[0][0], f"other text {k}", "en", "x", k, 1) for k in range(150)]], 1.0)
    chosen = qc.sample(docs, labels, 100, 100)
    ids = [r.doc_id for r in chosen.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) <= 300
    def first(frame):
        return {r.doc_id: (r.text_view, r.metadata_view) for r in frame.collect()}
    assert first(chosen) == first(qc.sample(docs.repartition(7), labels, 100, 100))


def test_sure_bands_hold_their_precision():
    z = np.linspace(-3, 3, 400)
    y = (z > 0).astype(int)
    y[(z > 0.2) & (z < 0.6)] = 0
    found = qc.sure(z, z, y, 0.95)
    for value in (0, 1):
        assert (y[found == value] == value).mean() >= 0.95 and (found == value).sum() > 50
    assert (qc.sure(z, z, np.tile([0, 1], 200), 0.95) == -1).all()


def test_held_out_labels_are_not_read(spark):
    rows = corpus(400)
    docs, labels = frames(spark, rows, 1.0)
    turned = spark.createDataFrame([(r[0], 1 - r[5] if fold_of(r[0], qc.FOLDS) == qc.HELD_OUT else r[5]) for r in rows],
                                   "doc_id long, quality int")
    def scores(marks):
        return sorted((r.doc_id, r.score) for r in qc.score(docs, qc.fit(docs, marks)).collect())
    assert scores(labels) == scores(turned)


def test_defined_cases(spark):
    rows = [*corpus(200), (900, None, None, None, None, 1), (901, "", "en", "x", 0, 1), (None, "a b c", "en", "x", 5, 1)]
    rows.append(rows[0])
    docs = spark.createDataFrame([(*r[:5], "x") for r in rows], SCHEMA)
    labels = spark.createDataFrame([(r[0], r[5]) for r in rows if r[0] != 900] + [(900, None), (None, 1)], "doc_id long, quality int")
    out = qc.score(docs, qc.fit(docs, labels)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    for marks, constant in ((labels.where("quality = 1"), 1.0), (labels.where("false"), 1.0), (labels.where("quality = 0"), 0.0)):
        assert {r.score for r in qc.score(docs, qc.fit(docs, marks)).collect()} == {constant}
    assert qc.score(docs.where("false"), qc.fit(docs.where("false"), labels)).collect() == []
