"""Log probabilities of texts under an n-gram model with deleted interpolation.

The model mixes maximum-likelihood bigram, unigram and uniform probabilities. The mixture weights
depend on how often the context was seen (a bucket per power of two) and are learned by
expectation-maximisation on a part of the training documents whose counts are deleted for that.
A context that was never seen has no pair probabilities: its bucket mixes the other two alone, so that
the probabilities after it sum to one as well.
All documents outside the held-out fold give the counts.

Texts are dealt into chunks of about ``chunk_chars`` by a hash. A chunk asks for the counts of its
distinct words and word pairs: it sends their 64-bit hashes, sorted and packed, to the key ranges
they fall in, with its own counts. Each range adds up what it gets and answers every chunk in the
order it asked; the chunk, read again, joins its answers. So the shuffle holds each distinct key
of a chunk once, no key has more than one entry per chunk however frequent it is, and no table of
counts has to fit anywhere. The weights are learned from a histogram of fixed size.

Defined results: null and empty texts are the end token alone; without training documents counts
are 0 and the model is uniform; null ids are in fold 0, which is held out; repeated rows count
and are scored once per row; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import as_bytes, blocks_for, fold, mixed, packed, unpacked, written

FOLDS, HELD_OUT, DELETED = 10, 0, 1
BUCKETS = 24
END = b" "  # no word has a space
ASKED = "range long, chunk long, role int, kind int, size int, keys binary, counts binary"
ANSWERED = "chunk long, range long, kind int, train binary, deleted binary, tokens long, deleted_tokens long, types long"
HISTOGRAM = "bucket int, two int, one int, tokens long"
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")
STEP = 4  # histogram cells per power of two


class Chunk:
    """The distinct words and word pairs of some texts, by the order of their hashes."""

    def __init__(self, texts: list[bytes]) -> None:
        number: dict[bytes, int] = {END: 0}
        ids, lengths = [], []
        for text in texts:
            found = [number.setdefault(w, len(number)) for w in text.lower().split()]
            ids += [0, *found]
            lengths.append(len(found) + 1)
        # document k is [0, words..., 0]: the end of one is written as the start of the next
        flat = np.array([*ids, 0], np.int64)
        self.lengths = np.array(lengths, np.int64)
        self.doc = np.repeat(np.arange(len(lengths)), self.lengths)
        self.context, self.word = flat[:-1], flat[1:]
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in number), np.uint64, len(number))
        pairs, self.pair = np.unique(self.context * len(number) + self.word, return_inverse=True)
        pair_hash = mixed(mixed(hashes[pairs // len(number)]) * np.uint64(3) + hashes[pairs % len(number)])
        order = (np.argsort(hashes), np.argsort(pair_hash))
        self.keys = hashes[order[0]], pair_hash[order[1]]
        self.counts = (np.bincount(self.word, minlength=len(number))[order[0]],
                       np.bincount(self.pair, minlength=len(pairs))[order[1]])
        # place of each word and pair in the sorted keys
        self.places = tuple(np.empty(len(o), np.int64) for o in order)
        for place, o in zip(self.places, order, strict=True):
            place[o] = np.arange(len(o))

    def look_up(self, answers: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of each token's context, word and pair."""
        word, pair = (a[p] for a, p in zip(answers, self.places, strict=True))
        return word[self.context], word[self.word], pair[self.pair]


def raw(texts: pd.Series) -> list[bytes]:
    return [as_bytes(t if isinstance(t, str) else None) for t in texts]


def in_chunks(docs: DataFrame, chunk_chars: int) -> tuple[DataFrame, int]:
    """Texts with a chunk and its role (0 held out, 1 deleted, 2 training); chunks have one role."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks = blocks_for(chars, chunk_chars)
    part = fold(F.col("doc_id"), FOLDS)
    role = F.when(part == HELD_OUT, 0).when(part == DELETED, 1).otherwise(2)
    few = blocks_for(chunks, FOLDS)
    spread = F.when(role < 2, F.pmod(F.xxhash64("doc_id", "text"), F.lit(few))).otherwise(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    out = docs.select(F.col("doc_id").cast("long"), "text").withColumn("role", role)
    return out.withColumn("chunk", spread * 3 + F.col("role")), chunks


def ask(texts: DataFrame, ranges: int) -> DataFrame:
    def requests(rows: pd.DataFrame) -> pd.DataFrame:
        chunk, out = Chunk(raw(rows["text"])), []
        for kind, (keys, counts) in enumerate(zip(chunk.keys, chunk.counts, strict=True)):
            at = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
            edges = np.searchsorted(at, np.arange(ranges + 1, dtype=np.uint64))
            for r in np.flatnonzero(np.diff(edges)):
                a, b = edges[r], edges[r + 1]
                steps = np.diff(keys[a:b], prepend=np.uint64(0))
                out.append((r, rows["chunk"].iloc[0], rows["role"].iloc[0], kind, b - a, packed(steps),
                            packed(counts[a:b].astype(np.uint32))))
        return pd.DataFrame(out, columns=[c.split()[0] for c in ASKED.split(", ")])

    return texts.groupBy("chunk").applyInPandas(requests, ASKED)


def answer(asked: DataFrame) -> DataFrame:
    """Total counts for each request, in its order; one more row per range with its totals."""
    def replies(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for kind, blocks in rows.groupby("kind"):
            keys = np.concatenate([np.cumsum(unpacked(k, np.uint64), dtype=np.uint64) for k in blocks["keys"]])
            counts = np.concatenate([unpacked(c, np.uint32) for c in blocks["counts"]])
            role = np.repeat(blocks["role"].to_numpy(), blocks["size"].to_numpy())
            distinct, where = np.unique(keys, return_inverse=True)
            train, deleted = (np.bincount(where, np.where(role >= least, counts, 0), len(distinct)).astype(np.uint64)
                              for least in (1, 2))
            deleted = train - deleted
            at = 0
            for chunk, size, of in zip(blocks["chunk"], blocks["size"], blocks["role"], strict=True):
                some = where[at:at + size]
                at += size
                out.append((chunk, blocks["range"].iloc[0], kind, packed(train[some]),
                            packed(deleted[some]) if of == 1 else None, None, None, None))
            if kind == 0:
                out.append((-1, blocks["range"].iloc[0], kind, None, None, int(train.sum()), int(deleted.sum()),
                            int((train > 0).sum())))
        frame = pd.DataFrame(out, columns=[c.split()[0] for c in ANSWERED.split(", ")])
        return frame.astype({"tokens": "Int64", "deleted_tokens": "Int64", "types": "Int64"})

    return asked.groupBy("range").applyInPandas(replies, ANSWERED)


def answers_of(rows: pd.DataFrame, column: str) -> tuple[np.ndarray, np.ndarray]:
    rows = rows.sort_values("range")
    return tuple(np.concatenate([unpacked(x, np.uint64) for x in rows.loc[rows["kind"] == kind, column]]).astype(np.float64)
                 for kind in (0, 1))


def bucket_of(seen: np.ndarray) -> np.ndarray:
    return np.minimum(BUCKETS - 1, np.ceil(np.log2(seen + 1))).astype(np.int64)


def share(part: np.ndarray, of: np.ndarray | float) -> np.ndarray:
    return np.divide(part, of, out=np.zeros(len(part)), where=np.asarray(of) > 0)


def cells(p: np.ndarray, uniform: float) -> np.ndarray:
    """Histogram cell of a probability relative to the uniform one; -1000 for zero."""
    out = np.full(len(p), -1000)
    out[p > 0] = np.round(STEP * np.log2(p[p > 0] / uniform))
    return out


def histogram(texts: DataFrame, answers: DataFrame, tokens: int, types: int) -> DataFrame:
    """How often deleted tokens meet each combination of bucket and component probabilities."""
    def count(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame(columns=["bucket", "two", "one", "tokens"])
        chunk = Chunk(raw(rows["text"]))
        train, deleted = answers_of(found, "train"), answers_of(found, "deleted")
        context, word, pair = chunk.look_up(tuple(a - b for a, b in zip(train, deleted, strict=True)))
        uniform = 1 / (types + 1)
        key = np.stack([bucket_of(context), cells(share(pair, context), uniform), cells(share(word, tokens), uniform)], 1)
        values, counts = np.unique(key, axis=0, return_counts=True)
        return pd.DataFrame({"bucket": values[:, 0], "two": values[:, 1], "one": values[:, 2], "tokens": counts})

    chunks = texts.where("role = 1").groupBy("chunk").cogroup(answers.where("deleted is not null").groupBy("chunk"))
    return (chunks.applyInPandas(count, HISTOGRAM)
            .groupBy("bucket", "two", "one").agg(F.sum("tokens").alias("tokens")))


def weights(counts: pd.DataFrame, rounds: int = 100, prior: float = 10.0) -> np.ndarray:
    """Weights of pair, word and uniform probability for each bucket, by EM.

    Each bucket has ``prior`` tokens' worth of the weights over all buckets, so that a bucket with
    few tokens is near them and no weight becomes zero, but that of pairs in bucket 0, whose
    contexts were never seen. Without deleted tokens there is nothing to learn: the three weigh the same.
    """
    def fit(p: np.ndarray, n: np.ndarray, base: np.ndarray, start: np.ndarray) -> np.ndarray:
        w = start
        for _ in range(rounds):
            parts = p * w
            w = ((parts / parts.sum(1, keepdims=True)) * n[:, None]).sum(0) + prior * base
            w = w / w.sum()
        return w

    even = np.full(3, 1 / 3)
    if counts.empty:
        return np.tile(even, (BUCKETS, 1))
    ratios = [np.where(counts[c] == -1000, 0.0, np.exp2(np.clip(counts[c], -400, 400) / STEP)) for c in ("two", "one")]
    p = np.stack([*ratios, np.ones(len(counts))], 1)
    n, at = counts["tokens"].to_numpy(np.float64), counts["bucket"].to_numpy()
    overall = fit(p, n, even, even)
    mix = np.stack([fit(p[at == b], n[at == b], overall, overall) if (at == b).any() else overall
                    for b in range(BUCKETS)])
    mix[0, 0] = 0
    mix[0] /= mix[0].sum()
    return mix


def score_chunks(texts: DataFrame, answers: DataFrame, tokens: int, types: int, mix: np.ndarray) -> DataFrame:
    def score(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        names = [c.split()[0] for c in SCORES.split(", ")]
        if rows.empty:
            return pd.DataFrame(columns=names)
        chunk = Chunk(raw(rows["text"]))
        context, word, pair = chunk.look_up(answers_of(found, "train"))
        w = mix[bucket_of(context)]
        p = w[:, 0] * share(pair, context) + w[:, 1] * share(word, tokens) + w[:, 2] / (types + 1)
        base = np.log10((word + 0.1) / (tokens + 0.1 * (types + 1)))
        docs = len(rows)
        return pd.DataFrame({
            "doc_id": rows["doc_id"].astype("Int64").to_numpy(), "held_out": (rows["role"] == 0).to_numpy(),
            "n_tokens": chunk.lengths, "n_known": np.bincount(chunk.doc, word > 0, docs).astype(np.int64),
            "train_tokens": tokens, "base_score": np.bincount(chunk.doc, base, docs),
            "score": np.bincount(chunk.doc, np.log10(p), docs)})[names]

    return (texts.groupBy("chunk").cogroup(answers.where("chunk >= 0").select("chunk", "range", "kind", "train").groupBy("chunk"))
            .applyInPandas(score, SCORES))


def score(docs: DataFrame, chunk_chars: int = 8_000_000) -> DataFrame:
    """Base and model scores of every document."""
    texts, chunks = in_chunks(docs, chunk_chars)
    answers = written(answer(ask(texts, chunks)), "counts")
    total = answers.where("chunk < 0").agg(F.sum("tokens"), F.sum("deleted_tokens"), F.sum("types")).first()
    tokens, deleted, types = (x or 0 for x in total)
    mix = weights(histogram(texts, answers, tokens - deleted, types).toPandas())
    return score_chunks(texts, answers, tokens, types, mix)
