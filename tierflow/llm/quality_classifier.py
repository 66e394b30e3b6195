"""Co-trained quality classifier: a view of the text and a view of the page's metadata.

Two logistic classifiers start from the labelled documents, one on the text alone, one on
language, source and length. Each round, either view labels documents of a pool of unlabelled ones
that it is sure of, in a confidence band whose precision was measured on calibration labels, and
hands some, drawn anywhere in the band, to the other view. (The surest would be all of one kind,
and teach the other view what that kind looks like.) The other view is fitted again, and keeps
the labels and the fit if its calibrated loss on the calibration labels falls, so that no exchange
makes it worse there. In the end each view's margin is calibrated (Platt) and the two are combined
by a logistic fit on the same calibration labels. A view that is never precise enough hands on
nothing.

The fit is on bounded samples: ``labelled`` labelled rows of each class and ``pool`` unlabelled
rows, those with the smallest hash of their id, of all folds but ``HELD_OUT``, one row for each id
(the smallest by its views). Scoring reads every whole text and is one pass without a shuffle.

Defined results: null text is empty, null metadata is a category of its own; rows with null ids
get scores but are never sampled; repeated rows get a score each; without labels of both classes
every score is the share of good labels (1 without labels); an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import fold
from tierflow.llm.quality_rules import signals

FOLDS, HELD_OUT, CALIBRATION = 10, 0, (1, 2)
HASHED = 256
LENGTH_BINS = (1, 4, 16)  # of an octave
SCORES = "doc_id long, held_out boolean, text_score double, metadata_score double, score double, kept boolean"
SAMPLED = "doc_id long, fold int, label int, text_view binary, metadata_view binary"


def text_view(text: str | None) -> np.ndarray:
    """Shares and sizes of the text, and how its words' first and last characters are spread."""
    n, chars, symbols, dup_lines, repeats, *shares = signals(text)
    out = np.zeros(8 + len(shares) + HASHED, np.float32)
    out[0] = 1
    out[1:1 + len(shares)] = shares
    out[1 + len(shares):6 + len(shares)] = (np.log1p(n) / 10, np.log1p(symbols) / 10, np.log1p(dup_lines) / 5,
                                            min(1.0, chars / max(1, n) / 20), n < 10)
    found = (text or "").split()
    if found:
        ends = np.fromiter((31 * ord(w[-1]) + ord(w[0]) for w in found), np.int64, len(found))
        spread = np.bincount(ends % HASHED, minlength=HASHED)
        out[-HASHED:] = np.sqrt(spread / len(found))
    return out


def metadata_view(lang: str | None, source: str | None, n_chars: float | None) -> np.ndarray:
    """Language, source, and length in bins of an octave, a quarter and a sixteenth of one."""
    out = np.zeros(1 + 16 + 128 + sum(1 + 23 * k for k in LENGTH_BINS), np.float32)
    out[0] = 1
    out[1 + zlib.crc32(str(lang).encode("utf-8", "replace")) % 16] = 1
    out[17 + zlib.crc32(str(source).encode("utf-8", "replace")) % 128] = 1
    at = 145
    for k in LENGTH_BINS:
        out[at + (0 if n_chars is None else 1 + min(23 * k - 1, int(k * np.log2(max(0, n_chars) + 1))))] = 1
        at += 1 + 23 * k
    return out


def margin(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 25) -> np.ndarray:
    """Class-balanced logistic regression by Newton steps; column 0 is the intercept."""
    w = np.zeros(x.shape[1])
    x = x.astype(np.float64)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))
    ridge = np.full(x.shape[1], penalty)
    ridge[0] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + ridge * w
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class CoTrained:
    text: np.ndarray = field(default_factory=lambda: np.zeros(0))
    metadata: np.ndarray = field(default_factory=lambda: np.zeros(0))
    text_scale: np.ndarray = field(default_factory=lambda: np.zeros(2))
    metadata_scale: np.ndarray = field(default_factory=lambda: np.zeros(2))
    combined: np.ndarray = field(default_factory=lambda: np.zeros(3))
    constant: float | None = None
    handed: tuple[int, ...] = (0, 0)  # pseudo-labels of each view that the other kept

    def scores(self, text: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.constant is not None:
            same = np.full(len(text), self.constant)
            return same, same, same
        one = self.text_scale[0] + self.text_scale[1] * margin(text, self.text)
        two = self.metadata_scale[0] + self.metadata_scale[1] * margin(metadata, self.metadata)
        both = np.stack([np.ones(len(text)), np.clip(one, -12, 12), np.clip(two, -12, 12)], 1) @ self.combined
        return sigmoid(one), sigmoid(two), sigmoid(both)


def platt(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Intercept and slope that turn margins into log odds."""
    w = logistic(np.stack([np.ones(len(z)), z], 1), y, penalty=1e-4)
    return np.array([w[0], max(0.0, w[1])])


def calibrated_loss(z: np.ndarray, y: np.ndarray) -> float:
    """Log loss of calibrated margins, both classes weighing the same."""
    scale = platt(z, y)
    losses = np.logaddexp(0, np.where(y > 0, -1, 1) * (scale[0] + scale[1] * z))
    return float((losses[y > 0].mean() + losses[y <= 0].mean()) / 2)


def sure(z: np.ndarray, z_cal: np.ndarray, y_cal: np.ndarray, precision: float) -> np.ndarray:
    """1, 0 or -1 (unsure) for each margin: bands that held ``precision`` on calibration labels."""
    out = np.full(len(z), -1)
    order = np.argsort(-z_cal)
    for label, order_, sign in ((1, order, 1), (0, order[::-1], -1)):
        right = np.cumsum(y_cal[order_] == label)
        size = np.arange(1, len(order_) + 1)
        # one error is added, so that a few lucky documents don't open a band
        held = np.flatnonzero((right / (size + 1) >= precision) & (size >= 20))
        if len(held):
            limit = sign * z_cal[order_][held[-1]]
            out[sign * z >= limit] = label
    return out


def co_train(label: np.ndarray, folds: np.ndarray, views: list[np.ndarray], rounds: int, per_round: int,
             precision: float) -> CoTrained:
    """Fit on rows with label 0 or 1; rows with label -1 are the pool."""
    known = label >= 0
    if len(np.unique(label[known])) < 2:
        return CoTrained(constant=float(label[known].mean()) if known.any() else 1.0)
    calibration = known & np.isin(folds, CALIBRATION)
    train = known & ~calibration
    if min(len(np.unique(label[train])), len(np.unique(label[calibration]))) < 2:
        train = calibration = known
    given = [np.where(train, label, -1) for _ in views]  # what each view learns from
    fits = [logistic(v[train], label[train]) for v in views]
    y_cal = label[calibration]
    losses = [calibrated_loss(margin(v, w)[calibration], y_cal) for v, w in zip(views, fits, strict=True)]
    handed = [0] * len(views)
    rng = np.random.default_rng(0)
    for _ in range(rounds):
        offered = 0
        for one, other in ((0, 1), (1, 0)):
            z = margin(views[one], fits[one])
            found = sure(z, z[calibration], y_cal, precision)
            fresh = ~known & (given[other] < 0) & (found >= 0)
            learnt = given[other].copy()
            for value in (0, 1):
                some = rng.permutation(np.flatnonzero(fresh & (found == value)))[:per_round]
                learnt[some] = value
                offered += len(some)
            if (learnt == given[other]).all():
                continue
            again = logistic(views[other][learnt >= 0], learnt[learnt >= 0])
            loss = calibrated_loss(margin(views[other], again)[calibration], y_cal)
            if loss < losses[other]:
                handed[one] += int((learnt != given[other]).sum())
                given[other], fits[other], losses[other] = learnt, again, loss
        if not offered:
            break
    model = CoTrained(*fits, handed=tuple(handed))
    z = [margin(v, w)[calibration] for v, w in zip(views, fits, strict=True)]
    model.text_scale, model.metadata_scale = (platt(x, y_cal) for x in z)
    calibrated = [np.clip(s[0] + s[1] * x, -12, 12)
                  for s, x in zip((model.text_scale, model.metadata_scale), z, strict=True)]
    model.combined = logistic(np.stack([np.ones(len(y_cal)), *calibrated], 1), y_cal, penalty=1e-4)
    return model


def sample(docs: DataFrame, labels: DataFrame, labelled: int, pool: int) -> DataFrame:
    """Views of the bounded sample: both classes of the labelled rows, and unlabelled rows."""
    marks = (labels.where("doc_id is not null and quality is not null")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min(F.when(F.col("quality") > 0, 1).otherwise(0)).alias("label")))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    ids = (ids.withColumn("fold", fold(F.col("doc_id"), FOLDS)).where(F.col("fold") != HELD_OUT)
           .join(marks, "doc_id", "left").withColumn("order", F.xxhash64("doc_id")))
    parts = [ids.where(condition).orderBy("order", "doc_id").limit(size)
             for condition, size in (("label = 1", labelled), ("label = 0", labelled), ("label is null", pool))]
    chosen = parts[0].unionAll(parts[1]).unionAll(parts[2]).select("doc_id", "fold", F.coalesce("label", F.lit(-1)).alias("label"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({
                "doc_id": b["doc_id"], "fold": b["fold"], "label": b["label"],
                "text_view": [text_view(t).tobytes() for t in b["text"]],
                "metadata_view": [metadata_view(*m).tobytes() for m in _metadata(b)]})

    # the chosen ids are at most 2 * labelled + pool rows
    return (_columns(docs).join(F.broadcast(chosen), "doc_id")
            .select("doc_id", "fold", "label", "text", "lang", "source", "n_chars").mapInPandas(rows, SAMPLED)
            .groupBy("doc_id", "fold", "label").agg(F.min(F.struct("text_view", "metadata_view")).alias("views"))
            .select("doc_id", "fold", "label", "views.*"))


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string"),
                       F.col("source").cast("string"), F.col("n_chars").cast("double"))


def _metadata(batch: pd.DataFrame) -> Iterator[tuple]:
    for lang, source, n in zip(batch["lang"], batch["source"], batch["n_chars"], strict=True):
        yield lang, source, None if n is None or n != n else n


def fit(docs: DataFrame, labels: DataFrame, labelled: int = 4000, pool: int = 4000, rounds: int = 5,
        per_round: int = 400, precision: float = 0.99) -> CoTrained:
    rows = sample(docs, labels, labelled, pool).toPandas().sort_values("doc_id")
    if rows.empty:
        return CoTrained(constant=1.0)
    views = [np.stack([np.frombuffer(r, np.float32) for r in rows[v]]) for v in ("text_view", "metadata_view")]
    return co_train(rows["label"].to_numpy(), rows["fold"].to_numpy(), views, rounds, per_round, precision)


def score(docs: DataFrame, model: CoTrained, threshold: float = 0.5) -> DataFrame:
    """Scores of every document; ``kept`` is ``score >= threshold``."""
    names = [c.split()[0] for c in SCORES.split(", ")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                b = batch.iloc[at:at + 1000]
                text = np.stack([text_view(t if isinstance(t, str) else None) for t in b["text"]])
                metadata = np.stack([metadata_view(*m) for m in _metadata(b)])
                one, two, both = model.scores(text, metadata)
                yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"], "text_score": one,
                                    "metadata_score": two, "score": both, "kept": both >= threshold})[names]

    return (_columns(docs).withColumn("held_out", fold(F.col("doc_id"), FOLDS) == HELD_OUT)
            .mapInPandas(rows, SCORES))
