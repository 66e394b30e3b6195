"""Quality rules with risk-controlled cutoffs.

Every rule rejects a document whose signal lies above a cutoff. Labelled texts are dealt by a hash
into two halves. On the first, each stratum (language) gets a ladder: the cutoffs of all rules, of a
fixed grid, ordered by how many bad texts they reject for each good one, the mildest first within a
rule; cutoffs that gain nothing are left out. The second half, the holdout, tests the ladder. Step
``t`` is the hypothesis "the rules with the cutoffs up to ``t`` together reject more than ``alpha``
of the good texts". It is refuted if the exact binomial (Clopper-Pearson) upper bound on the false
rejections stays within ``alpha``. Steps are tested in order up to the first that is not refuted,
which needs no correction, since the holdout had no part in the order; all strata share the error
``delta`` (Bonferroni). So with probability ``1 - delta`` no stratum loses more than ``alpha`` of its
good texts to the rules. A stratum can have rules from ``log(delta / strata) / log(1 - alpha)`` good
texts in its holdout on: 86 for four strata at 0.05, some 172 labelled ones.

A trial is a distinct text of a stratum, however often it is repeated, as copies tell nothing new;
the promise is about distinct texts. Near copies do count as separate trials.

Only strata with enough labelled texts reach the driver, each with a histogram over rules and
cutoffs and one over steps, whose sizes do not depend on the number of documents.

Defined results: a null text is empty; null languages are the stratum ''; a stratum without
labels has no rules and keeps what passes the base rules; repeated documents get a row each; a
text with several labels counts as good only if all say so; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import as_bytes, written

SYMBOLS = b"#*$%&|<>"
NGRAM = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SIGNALS = ("symbol_share", "marked_share", "upper_share", "dup_line_share", "repeat_share", "run_share",
           "digit_share", "long_word_share", "top_word_share")
GRID = tuple(round(0.02 * k, 2) for k in range(50))
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
FEATURES = f"doc_id long, lang string, digest string, {BASE}, " + ", ".join(f"{s} double" for s in SIGNALS)

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_SPACE = b" \t\n\x0b\x0c\r"


def without(raw: bytes, some: bytes) -> int:
    """How many of the bytes are in ``some``."""
    return len(raw) - len(raw.translate(None, some))


def repeated_words(found: list[bytes], n: int = NGRAM) -> int:
    """Words that lie in an ``n``-word window found twice or more in the text."""
    if len(found) < n + 1:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in found), np.int64, len(found))
    code, base = ids[:len(ids) - n + 1].copy(), len(number)
    size = base
    for k in range(1, n):
        if size > (2**62) // base:
            values, code = np.unique(code, return_inverse=True)
            size = len(values)
        code = code * base + ids[k:len(ids) - n + 1 + k]
        size *= base
    _, where, counts = np.unique(code, return_inverse=True, return_counts=True)
    twice = counts[where] > 1
    if not twice.any():
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(twice)
    edge[starts] += 1
    np.add.at(edge, starts + n, -1)
    return int((edge.cumsum() > 0).sum())


def signals(text: str | None) -> tuple:
    """The base counts, then the signals, each a share of words, lines or characters."""
    raw = as_bytes(text)
    found = raw.split()
    n = len(found)
    # code points are the bytes that do not continue one
    chars = len(text or "") - without(raw, _SPACE)
    symbols = without(raw, SYMBOLS)
    lines = [line for line in raw.split(b"\n") if line.split()]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(found)
    upper, lower = without(raw, _UPPER), without(raw, _LOWER)
    marked = sum(w[-1:] in b"#*$%&|<>!" for w in found)
    runs = sum(a == b for a, b in zip(found, found[1:], strict=False))
    most = Counter(found).most_common(1)[0][1] if found else 0
    return (n, chars, symbols, dup_lines, repeats,
            symbols / max(1, chars), marked / max(1, n), upper / max(1, upper + lower),
            dup_lines / max(1, len(lines)), repeats / max(1, n), runs / max(1, n - 1),
            without(raw, _DIGITS) / max(1, chars), sum(len(w) > 24 for w in found) / max(1, n),
            (most / n if n >= 50 else 0.0))


def features(docs: DataFrame) -> DataFrame:
    names = [c.split()[0] for c in FEATURES.split(", ")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch["text"]]
            found = [(d, lang if isinstance(lang, str) else "", xxhash.xxh3_128_hexdigest(as_bytes(t)), *signals(t))
                     for d, lang, t in zip(batch["doc_id"], batch["lang"], texts, strict=True)]
            yield pd.DataFrame(found, columns=names).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), "text").mapInPandas(rows, FEATURES)


def upper_bound(rejected: int, good: int, error: float) -> float:
    """Clopper-Pearson: the largest rate at which ``rejected`` or fewer of ``good`` have probability ``error``."""
    if rejected >= good:
        return 1.0
    logs = [math.lgamma(good + 1) - math.lgamma(k + 1) - math.lgamma(good - k + 1) for k in range(rejected + 1)]

    def tail(p: float) -> float:
        terms = [c + k * math.log(p) + (good - k) * math.log1p(-p) for k, c in enumerate(logs)]
        top = max(terms)
        return top + math.log(sum(math.exp(t - top) for t in terms))

    low, high = rejected / good, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        if middle <= 0 or tail(middle) > math.log(error):
            low = middle
        else:
            high = middle
    return high


def admitted(rejected: int, good: int, allowed: float, error: float) -> bool:
    # the point estimate is below the bound, so most cutoffs need no search for it
    return good > 0 and rejected <= allowed * good and upper_bound(rejected, good, error) <= allowed


def needed(alpha: float, error: float) -> int:
    """Good texts from which on a step that rejects none of them is refuted."""
    return math.ceil(math.log(error) / math.log1p(-alpha))


def ladder(by_rule: dict[str, np.ndarray]) -> list[tuple[str, int]]:
    """Steps (rule, place of its cutoff in the grid) by bad texts rejected for each good one.

    ``by_rule`` holds the good and the bad texts of each bin; a text in bin b has a signal above the
    cutoffs 0 .. b - 1. A rule's steps are the corners of the upper hull of bad over good ones.
    """
    steps = []
    for rule, counts in by_rule.items():
        good, bad = (np.cumsum(c[::-1])[::-1][1:].tolist() for c in counts)
        lost = hit = 0
        end = len(GRID)
        while True:
            ahead = [((bad[k] - hit) / (good[k] - lost) if good[k] > lost else math.inf, bad[k] - hit, k)
                     for k in range(end) if bad[k] - hit > good[k] - lost]
            if not ahead:
                break
            ratio, gained, end = max(ahead)
            lost, hit = good[end], bad[end]
            steps.append((-ratio, -gained, rule, end))
    return [(rule, k) for _, _, rule, k in sorted(steps)]


def first_steps(steps: list[tuple[str, int]], rule: str) -> list[int]:
    """For each bin of a rule the first step that rejects it; the number of steps if none does."""
    return [min((t for t, (name, k) in enumerate(steps) if name == rule and k < b), default=len(steps))
            for b in range(len(GRID) + 1)]


def accepted(lost: list[int], good: int, alpha: float, error: float) -> int:
    """How many steps are refuted in order, given the good texts first rejected by each."""
    rejected = 0
    for t, more in enumerate(lost):
        rejected += more
        if not admitted(rejected, good, alpha, error):
            return t
    return len(lost)


def trials(found: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct labelled texts of a stratum that pass the base rules, with the bin of each signal."""
    marks = (labels.where("doc_id is not null and quality is not null")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality")))
    bins = [F.least(F.ceil(F.round(F.col(s) / F.lit(GRID[1]), 9)), F.lit(len(GRID))).cast("int") for s in SIGNALS]
    return (found.where(~base_failed()).join(marks, "doc_id").groupBy("lang", "digest")
            .agg((F.min("quality") > 0).cast("int").alias("good"),
                 *[F.min(b).alias(s) for s, b in zip(SIGNALS, bins, strict=True)])
            .withColumn("held_out", F.crc32(F.col("digest").cast("binary")) % 2 == 1))


def cutoffs(found: DataFrame, labels: DataFrame, alpha: float, delta: float) -> dict[str, dict[str, float]]:
    """Cutoff of each rule that is on, by stratum."""
    spark = found.sparkSession
    tried = written(trials(found, labels), "trials")
    goods = {r["lang"]: r["good"] for r in tried.where("held_out").groupBy("lang").agg(F.sum("good").alias("good"))
             .where(F.col("good") >= needed(alpha, delta)).toLocalIterator()}
    if not goods:
        return {}
    strata = spark.createDataFrame([(lang,) for lang in goods], "lang string")
    bins = F.explode(F.array(*[F.struct(F.lit(s).alias("rule"), F.col(s).alias("at")) for s in SIGNALS]))
    counts = (tried.where("not held_out").join(strata, "lang").select("lang", "good", bins.alias("b"))
              .groupBy("lang", "b.rule", "b.at").agg(F.sum("good").alias("good"), F.count("*").alias("texts")))
    histogram = {lang: {s: np.zeros((2, len(GRID) + 1), np.int64) for s in SIGNALS} for lang in goods}
    for row in counts.toLocalIterator():
        histogram[row["lang"]][row["rule"]][:, row["at"]] += (row["good"], row["texts"] - row["good"])
    ladders = {lang: ladder(by_rule) for lang, by_rule in histogram.items()}
    places = spark.createDataFrame(
        [(lang, *[first_steps(steps, s) for s in SIGNALS]) for lang, steps in ladders.items()],
        "lang string, " + ", ".join(f"{s}_steps array<int>" for s in SIGNALS))
    step = F.least(*[F.element_at(f"{s}_steps", F.col(s) + 1) for s in SIGNALS])
    lost = {lang: [0] * (len(steps) + 1) for lang, steps in ladders.items()}
    for row in (tried.where("held_out").join(places, "lang").groupBy("lang", step.alias("step"))
                .agg(F.sum("good").alias("good")).toLocalIterator()):
        lost[row["lang"]][row["step"]] += row["good"]
    # a later step of a rule has the lower cutoff
    return {lang: {rule: GRID[k] for rule, k in
                   steps[:accepted(lost[lang][:-1], goods[lang], alpha, delta / len(goods))]}
            for lang, steps in ladders.items()}


def base_failed():
    n, repeats = F.col("n_words"), F.col("n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n)


def apply_rules(docs: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.05) -> DataFrame:
    """Signals of every document with ``base_failed``, ``kept`` and the names of the rules it broke."""
    found = written(features(docs), "signals")
    chosen = cutoffs(found, labels, alpha, delta)
    limits = docs.sparkSession.createDataFrame(
        [(lang, *[rules.get(s) for s in SIGNALS]) for lang, rules in chosen.items()],
        "lang string, " + ", ".join(f"{s}_limit double" for s in SIGNALS))
    broken = F.filter(F.array(*[F.when(F.round(F.col(s), 9) > F.col(f"{s}_limit"), F.lit(s)) for s in SIGNALS]),
                      lambda rule: rule.isNotNull())
    found = found.join(limits, "lang", "left")
    return (found.withColumn("base_failed", base_failed()).withColumn("broken", broken)
            .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
            .drop("digest", *[f"{s}_limit" for s in SIGNALS]))
