import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierflow.llm import quality_rules as q


def brute_repeats(found, n=5):
    windows = [tuple(found[i:i + n]) for i in range(len(found) - n + 1)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered.update(range(i, i + n))
    return len(covered)


def test_repeated_words():
    rng = random.Random(4)
    for _ in range(300):
        found = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(0, 40))]
        assert q.repeated_words(found) == brute_repeats(found)
    many = [str(k).encode() for k in range(9000)]
    assert q.repeated_words(many + many[:7]) == 14


def test_base_counts():
    text = "Ab\xa0c #d\n \nx y\nx y\r\nx y\n"
    n, chars, symbols, dup_lines, repeats, *_ = q.signals(text)
    assert (n, chars, symbols, dup_lines, repeats) == (8, 12, 1, 1, 0)
    assert q.signals(None)[:5] == q.signals("")[:5] == (0, 0, 0, 0, 0)
    assert q.signals("é € 🙂")[:2] == (3, 3)


def test_upper_bound_is_exact():
    # no rejection among n: 1 - error ** (1 / n)
    assert q.upper_bound(0, 50, 0.05) == pytest.approx(1 - 0.05 ** (1 / 50), rel=1e-9)
    # P(Bin(3, p) <= 1) = (1 - p)^3 + 3 p (1 - p)^2
    p = q.upper_bound(1, 3, 0.1)
    assert (1 - p) ** 3 + 3 * p * (1 - p) ** 2 == pytest.approx(0.1, rel=1e-9)
    assert q.upper_bound(5, 5, 0.1) == 1.0


def rows(n, seed=1):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        bad = k % 4 == 0
        words = ["".join(rng.choice("abcdefgh") for _ in range(4)) + ("###" if bad else "") for _ in range(30)]
        out.append((k, " ".join(words), "en" if k % 2 else "de", 0 if bad else 1))
    return out


def test_rules_reject_bad_and_keep_good(spark):
    found = rows(6000)
    docs = spark.createDataFrame([(d, t, lang, "x", 1) for d, t, lang, _ in found],
                                 "doc_id long, text string, lang string, kept string, n_words int")
    labels = spark.createDataFrame([(d, y, 0) for d, _, _, y in found], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in q.apply_rules(docs, labels).collect()}
    assert len(out) == 6000
    good = [out[d].kept for d, _, _, y in found if y]
    assert sum(good) >= 0.95 * len(good)
    assert not any(out[d].kept for d, _, _, y in found if not y)


def test_cutoffs_keep_their_promise():
    """Over many holdouts, a cutoff that truly rejects too much is admitted in few."""
    rng = random.Random(9)
    wrong = sum(q.admitted(sum(rng.random() < 0.06 for _ in range(400)), 400, 0.05, 0.1) for _ in range(300))
    assert wrong <= 30


def test_ladder_orders_by_bad_for_good():
    rules = {s: np.zeros((2, len(q.GRID) + 1), int) for s in ("upper_share", "run_share")}
    good, bad = rules["upper_share"]
    good[[1, 10, 20]], bad[[10, 20, 30]] = (80, 10, 2), (15, 20, 7)
    good, bad = rules["run_share"]
    good[[0, 5]], bad[[5, 40]] = (90, 5), (4, 30)
    # 30 and 7 bad for none, then 20 for 2, then 15 for 10; 4 for 5 gains nothing
    assert q.ladder(rules) == [("run_share", 39), ("upper_share", 29), ("upper_share", 19), ("upper_share", 9)]
    steps = q.ladder(rules)
    assert [q.first_steps(steps, "upper_share")[b] for b in (0, 9, 10, 19, 20, 29, 30, 50)] == [4, 4, 3, 3, 2, 2, 1, 1]


def test_whole_rule_set_keeps_its_promise():
    """Over 1,000 holdouts, the steps taken truly reject more than alpha in at most delta of them."""
    rng = np.random.default_rng(3)
    shares = np.array([0.0, 0.01, 0.01, 0.015, 0.01, 0.01, 0.02, 0.05])
    truth = np.cumsum(shares)
    for n in (60, 160, 900):
        lost = rng.multinomial(n, [*shares, 1 - shares.sum()], 1000)[:, :-1]
        taken = [q.accepted(row.tolist(), n, 0.05, 0.05) for row in lost]
        assert np.mean([t > 0 and truth[t - 1] > 0.05 for t in taken]) <= 0.05
        assert np.mean([t > 0 for t in taken]) > 0.9


def test_needed_labels():
    assert q.needed(0.05, 0.05 / 4) == 86
    assert q.admitted(0, 86, 0.05, 0.05 / 4) and not q.admitted(0, 85, 0.05, 0.05 / 4)


def test_copies_change_no_cutoff(spark):
    found = rows(1200)
    docs = spark.createDataFrame([(d, t, lang) for d, t, lang, _ in found], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(d, y) for d, _, _, y in found], "doc_id long, quality int")
    more = docs.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(7)))).select(
        (F.col("doc_id") + 10_000 * F.col("k")).alias("doc_id"), "text", "lang")
    more_labels = more.join(labels.withColumnRenamed("doc_id", "id"), F.col("doc_id") % 10_000 == F.col("id")).select("doc_id", "quality")
    chosen = [q.cutoffs(q.features(d), y, 0.05, 0.05) for d, y in ((docs, labels), (docs.unionAll(docs), labels), (more, more_labels))]
    assert chosen[0] == chosen[1] == chosen[2]
    assert chosen[0]["de"] and not chosen[0]["en"]  # all bad rows are of one language


def test_every_language_has_rules(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    chosen = q.cutoffs(q.features(docs), labels, 0.05, 0.05)
    assert {lang for lang, rules in chosen.items() if rules} >= {"en", "de", "fr", "es"}


def test_few_labels_turn_rules_off(spark):
    found = rows(40)
    docs = spark.createDataFrame([(d, t, lang) for d, t, lang, _ in found], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(d, y) for d, _, _, y in found], "doc_id long, quality int")
    assert q.apply_rules(docs, labels).where("kept").count() == 40


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, None, "en"), (1, None, "en"), (None, "a b c d e f g h i j k", None), (2, "", "en")],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    out = q.apply_rules(docs, labels)
    assert out.where("base_failed and not kept").count() == 3
    assert out.where(F.col("doc_id").isNull() & F.col("kept")).count() == 1
    assert q.apply_rules(docs.where("false"), labels).count() == 0
    assert q.apply_rules(docs, labels.where("false")).count() == 4
