"""Removal of byte strings that repeat within or across documents, by suffix arrays.

A string of ``LENGTH`` bytes that starts in two places is removed in both. Every such string holds
an anchor, its ``GRAM``-byte substring with the smallest hash (the first of equals), which depends
on nothing but the string. So strings that repeat have equal anchors, and only places with an
anchor that occurs twice are looked at further: with each anchor goes its context, the bytes of
all strings it is the anchor of.

Equal contexts need no search, all their strings repeat. Where an anchor has different contexts,
one copy of each goes to a task that builds their Burrows-Wheeler transform and derives the common
prefixes of neighbouring suffixes by increasing value: breadth-first, an interval of suffixes is
extended to the left by every character before it, which tells the boundaries whose common prefix
is one longer; at ``LENGTH`` the expansion stops, and neighbours without a boundary repeat.

An anchor may have very many contexts, such as a line that a third of all documents hold. Those
with more than ``crowd`` are split by content until none is left: the strings of a context are
halved by where the anchor lies in them, and each half is grouped by the bytes all its strings
share. Strings that are equal stay together; half of a crowd's strings has other bytes in common.

Defined results: a null text is empty and keeps nothing; ``kept_sha256`` of nothing is the hash of
no bytes; rows that are equal are different documents, so strings in them repeat; rows with null
ids take part; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import arrow, as_bytes, blocks_for, bloom, maybe_held, mixed, running_hash, slices, written

LENGTH = 200
GRAM = 64
SEARCHED_BYTES = 128_000
WINDOW = LENGTH - GRAM + 1  # grams in a string

PLACES = "uid long, anchor array<long>, context array<long>, lo array<long>, at array<int>, span array<int>"
CONTEXTS = "anchor long, context long, part long, first int, last int, bytes binary"
CONTEXT_NAMES = ["anchor", "context", "part", "first", "last", "bytes"]
FOUND = "anchor long, context long, first int, last int"
TEXTS = "doc_id long, uid long, n_bytes long, raw binary, whole string"
REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def uid_of(doc_id: int | None, raw: bytes) -> int:
    """Identifies an id with its text; only rows that are equal share it."""
    return xxhash.xxh3_64_intdigest(raw, seed=xxhash.xxh3_64_intdigest(str(doc_id))) - (1 << 63)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima of blocks."""
    n = len(x) - width + 1
    blocks = np.concatenate([x, np.full(-len(x) % width, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    from_left = np.minimum.accumulate(blocks, 1).reshape(-1)
    from_right = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].reshape(-1)
    return np.minimum(from_right[:n], from_left[width - 1:width - 1 + n])


def anchors(raw: bytes) -> tuple[np.ndarray, ...]:
    """(anchor hash, context hash, first string, place of the anchor in it, further strings) by place."""
    text = np.frombuffer(raw, np.uint8)
    total, down = running_hash(text)
    n = len(text) - GRAM + 1
    hashes = mixed((total[GRAM:] - total[:n]) * down[:n])
    place = (sliding_min((hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64), WINDOW)
             & np.uint64(0xFFFFFFFF)).astype(np.int64)
    lo = np.flatnonzero(np.diff(place, prepend=-1))
    hi = np.append(lo[1:], len(place)) - 1
    at = place[lo]
    context = mixed((total[hi + LENGTH] - total[lo]) * down[lo]) + mixed(((hi - lo) * 1000 + (at - lo)).astype(np.uint64))
    return hashes[at], context, lo, at - lo, hi - lo


def identified(batches) -> Iterator[tuple[list, np.ndarray, list[bytes]]]:
    """Ids, uids and bytes of texts, in portions."""
    for ids, texts in slices(batches):
        raw = [as_bytes(t) for t in texts]
        yield ids, np.array([uid_of(d, r) for d, r in zip(ids, raw, strict=True)], np.int64), raw


def find_places(docs: DataFrame) -> DataFrame:
    def rows(batches):
        for _, uids, raw in identified(batches):
            out = []
            for uid, text in zip(uids, raw, strict=True):
                if len(text) >= LENGTH:
                    anchor, context, lo, at, span = anchors(text)
                    out.append((uid, anchor.view(np.int64), context.view(np.int64), lo, at.astype(np.int32), span.astype(np.int32)))
            if out:
                yield arrow(pd.DataFrame(out, columns=["uid", "anchor", "context", "lo", "at", "span"]), PLACES)

    return docs.mapInArrow(rows, PLACES)


def contexts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of one place of each wanted context."""
    held = bloom(wanted.select("uid"), "uid")

    def texts(batches):
        for _, uids, raw in identified(batches):
            hit = np.flatnonzero(maybe_held(held, uids) & (np.array([len(r) for r in raw]) >= LENGTH))
            if len(hit):
                yield arrow(pd.DataFrame({"uid": uids[hit], "raw": [raw[k] for k in hit]}), "uid long, raw binary")

    columns = ("anchor", "context", "lo", "at", "span")
    places = wanted.groupBy("uid").agg(F.collect_list(F.struct(*columns)).alias("p")).select(
        "uid", *[F.col(f"p.{c}").alias(c) for c in columns])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for raw, *found in zip(batch["raw"], *[batch[c] for c in columns], strict=True):
                for anchor, context, lo, at, span in zip(*[x.tolist() for x in found], strict=True):
                    out.append((anchor, context, anchor, -at, span - at, raw[lo:lo + span + LENGTH]))
            yield pd.DataFrame(out, columns=CONTEXT_NAMES)

    # equal rows share a uid, so a context may come more than once
    return (docs.mapInArrow(texts, "uid long, raw binary").join(places, "uid").select("raw", *columns).mapInPandas(cut, CONTEXTS)
            .groupBy("anchor", "context").agg(*[F.min(c).alias(c) for c in ("part", "first", "last", "bytes")]))


def halved(context: tuple, low: int, high: int) -> Iterator[tuple]:
    """A context's strings in two halves, with parts told by the bytes that all of a half share.

    ``first`` and ``last`` count strings from the anchor: string s starts s bytes after it. All
    strings from a to b share the bytes from b up to a + LENGTH, which any context with a string
    from a to b has. Gives contexts followed by the bounds of their half.
    """
    anchor, name, part, first, last, raw = context
    middle = (low + high) // 2
    for a, b in ((low, middle), (middle + 1, high)):
        start, end = max(a, first), min(b, last)
        if start <= end:
            seed = (part ^ (a * 1000003)) & 0xFFFFFFFFFFFFFFFF
            shared = xxhash.xxh3_64_intdigest(raw[b - first:a + LENGTH - first], seed=seed) - (1 << 63)
            yield anchor, name, shared, start, end, raw[start - first:end - first + LENGTH], a, b


def halves(crowded: DataFrame) -> DataFrame:
    """All contexts of crowds in halves."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([half for r in batch[[*CONTEXT_NAMES, "low", "high"]].itertuples(index=False)
                                for half in halved(tuple(r[:6]), r.low, r.high)], columns=[*CONTEXT_NAMES, "low", "high"])

    return crowded.mapInPandas(rows, CONTEXTS + ", low int, high int")


def refined(contexts: list[tuple], rounds: int = 3) -> tuple[list[tuple], list[tuple]]:
    """(runs found, contexts left) after halving the contexts of a task.

    A half that shares its bytes with no other is done, so is one that occurs twice as a whole:
    of that, one copy stays for the others to be compared with.
    """
    found, bounded = [], [(*c, 1 - WINDOW, 0) for c in contexts]
    for _ in range(rounds):
        parts: dict[int, dict[tuple, list[tuple]]] = {}
        for c in bounded:
            for half in halved(c[:6], *c[6:]):
                parts.setdefault(half[2], {}).setdefault(half[3:6], []).append(half)
        bounded = []
        for contents in parts.values():
            for copies in contents.values():
                if len(copies) > 1:
                    found += [(c[0], c[1], c[3], c[4]) for c in copies]
                if len(contents) > 1:
                    bounded.append(copies[0])
    return found, [c[:6] for c in bounded]


def suffix_order(text: np.ndarray, alphabet: int) -> np.ndarray:
    """Rank of every suffix; prefixes of doubling length, only what is not yet unique is sorted."""
    n, step = len(text), 4 if alphabet < 50_000 else 2  # as many characters as fit a number
    padded = np.concatenate([text, np.zeros(step, np.int64)])
    key = padded[:n]
    for k in range(1, step):
        key = key * alphabet + padded[k:n + k]
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    open_ = order[~(new & np.append(new[1:], True))]
    while len(open_):
        ahead = open_ + step
        key = rank[open_] * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.argsort(key)
        at, key = open_[by], key[by]
        group = rank[at]
        fresh = np.concatenate([[True], group[1:] != group[:-1]])
        new = np.concatenate([[True], key[1:] != key[:-1]])
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        inside = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0)) - start
        rank[at] = group + inside
        open_ = at[~(new & np.append(new[1:], True))]
        step *= 2
    return rank


def repeated_starts(texts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Of each text the places where a string of ``length`` bytes starts that starts elsewhere too.

    Boundaries between neighbouring suffixes are found by increasing common prefix. If a suffix
    interval splits between rows i < j with the same character before them, and no such row lies
    between, then the suffixes one character longer split before that of j, one level later.
    """
    ends = np.cumsum([len(t) + 1 for t in texts])
    count = len(texts)
    text = np.empty(int(ends[-1]), np.int64)
    text[ends - 1] = np.arange(count)  # ends of texts differ from each other and sort first
    inside = np.ones(len(text), bool)
    inside[ends - 1] = False
    text[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + count
    rank = suffix_order(text, count + 256)
    n = len(text)
    suffix = np.empty(n, np.int64)
    suffix[rank] = np.arange(n)
    before = text[suffix - 1]  # the transform; the row of the whole text has the last end, which is unique
    order = np.argsort(before * n + np.arange(n))
    sorted_before = before[order]
    same = sorted_before[1:] == sorted_before[:-1]
    left, right = order[:-1][same].astype(np.int32), order[1:][same].astype(np.int32)
    target = rank[suffix[right] - 1].astype(np.int32)
    first = text[suffix]
    known = np.concatenate([[True], first[1:] != first[:-1]])
    for _ in range(1, length):
        seen = np.cumsum(known, dtype=np.int32)
        split = seen[right] > seen[left]
        if not split.any():
            break
        known[target[split]] = True
        keep = ~split
        left, right, target = left[keep], right[keep], target[keep]
    twice = ~known
    twice[:-1] |= ~known[1:]
    repeats = np.zeros(n, bool)
    repeats[suffix[twice]] = True
    return [repeats[end - len(t) - 1:end - length] if len(t) >= length else np.empty(0, bool)
            for t, end in zip(texts, ends, strict=True)]


def expand(contexts: DataFrame, task_bytes: int) -> DataFrame:
    """Runs of strings that repeat, counted from the anchor, for contexts in one task per group of parts."""
    size = contexts.agg(F.sum(F.length("bytes"))).first()[0] or 0
    tasks = blocks_for(size, task_bytes)

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        out, left = refined(list(rows[CONTEXT_NAMES].itertuples(index=False, name=None)))
        left.sort(key=lambda c: (c[2], c[0], c[1], c[3]))
        # equal strings are in one part: parts are searched together up to some bytes that stay in cache
        batch, size = [], 0
        for k, c in enumerate(left):
            batch.append(c)
            size += len(c[5])
            if k + 1 == len(left) or size > SEARCHED_BYTES and left[k + 1][2] != c[2]:
                for (anchor, name, _, first, _, _), twice in zip(batch, repeated_starts([c[5] for c in batch]), strict=True):
                    edges = np.flatnonzero(np.diff(twice, prepend=False, append=False))
                    out += [(anchor, name, first + a, first + b - 1) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
                batch, size = [], 0
        return pd.DataFrame(out, columns=["anchor", "context", "first", "last"])

    return (contexts.withColumn("task", F.pmod(F.xxhash64("part"), F.lit(tasks)))
            .groupBy("task").applyInPandas(search, FOUND))


def repeated_runs(contexts: DataFrame, crowd: int, task_bytes: int) -> DataFrame:
    """(anchor, context, first, last) of all strings that repeat, ``first`` and ``last`` from the anchor."""
    low, high = F.lit(1 - WINDOW), F.lit(0)
    contexts = contexts.withColumn("low", low.cast("int")).withColumn("high", high.cast("int"))
    done, ready = [], []
    while True:
        sizes = contexts.groupBy("part").agg(F.count(F.lit(1)).alias("members"))
        big = written(sizes.where(F.col("members") > crowd).select("part"), "crowds")
        if big.isEmpty():
            ready.append(contexts)
            break
        ready.append(contexts.join(big, "part", "left_anti").select(contexts.columns))
        split = written(halves(contexts.join(big, "part", "left_semi").select(contexts.columns)), "halves")
        content = [F.col("part"), F.xxhash64("bytes").alias("h1"), F.hash("bytes").alias("h2"), F.col("first"), F.col("last")]
        keyed = split.select("*", content[1], content[2])
        copies = (keyed.groupBy("part", "h1", "h2", "first", "last")
                  .agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("anchor", "context")).alias("kept")))
        counted = keyed.join(copies, ["part", "h1", "h2", "first", "last"])
        counted = written(counted, "counted")
        done.append(counted.where("copies > 1").select("anchor", "context", "first", "last"))
        one = counted.where(F.struct("anchor", "context") == F.col("kept"))
        alive = one.groupBy("part").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("part")
        contexts = written(one.join(alive, "part", "left_semi").select(contexts.columns), "contexts")
    small = reduce(DataFrame.unionAll, ready).drop("low", "high")
    return reduce(DataFrame.unionAll, [*done, expand(small, task_bytes)])


def dedup(docs: DataFrame, crowd: int = 4000, task_bytes: int = 1_000_000) -> DataFrame:
    """Sizes and hashes of every document without its repeated bytes."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    places = written(find_places(docs), "places").select(
        "uid", F.explode(F.arrays_zip("anchor", "context", "lo", "at", "span")).alias("p")).select("uid", "p.*")
    twice = (places.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("a"), F.max("context").alias("b"))
             .where("n > 1").select("anchor", (F.col("a") != F.col("b")).alias("differ")))
    # written, so that the join has an exchange on either side and Spark can split a hot anchor
    live = written(places.join(written(twice, "twice"), "anchor"), "live")
    counted = (live.groupBy("anchor", "context")
               .agg(F.count(F.lit(1)).alias("held"), F.first("differ").alias("differ"),
                    F.min(F.struct("uid", "lo", "at", "span")).alias("p")))
    counted = written(counted.select("anchor", "context", "held", "differ", "p.*"), "contexts")
    wanted = counted.where("differ")
    contexts = written(contexts_of(docs, wanted), "bytes")
    runs = written(repeated_runs(contexts, crowd, task_bytes), "runs")
    whole = live.join(counted.where("held > 1").select("anchor", "context"), ["anchor", "context"]).select(
        "uid", F.col("lo").alias("start"), (F.col("lo") + F.col("span") + LENGTH).alias("end"))
    partly = live.join(runs, ["anchor", "context"]).select(
        "uid", (F.col("lo") + F.col("at") + F.col("first")).alias("start"),
        (F.col("lo") + F.col("at") + F.col("last") + LENGTH).alias("end"))
    spans = written(whole.unionAll(partly).groupBy("uid").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")
    return cut_out(docs, spans)


def cut_out(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Removes the spans. Only texts that may have some are shuffled to the join."""
    held = bloom(spans.select("uid"), "uid")

    def texts(batches):
        for ids, uids, raw in identified(batches):
            hit = maybe_held(held, uids)
            yield arrow(pd.DataFrame({
                "doc_id": pd.array(ids, "Int64"), "uid": uids, "n_bytes": [len(r) for r in raw],
                "raw": [r if h else None for r, h in zip(raw, hit, strict=True)],
                "whole": [None if h else hashlib.sha256(r).hexdigest() for r, h in zip(raw, hit, strict=True)]}), TEXTS)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in REMOVED.split(", ")]
        for b in batches:
            out = []
            for doc_id, n, raw, whole, start, end in zip(*[b[c] for c in ("doc_id", "n_bytes", "raw", "whole", "start", "end")], strict=True):
                if raw is None:
                    out.append((doc_id, n, 0, 0, whole))
                    continue
                edge = np.zeros(n + 1, np.int64)
                if start is not None:
                    np.add.at(edge, start, 1)
                    np.add.at(edge, end, -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                runs = int((np.diff(gone, prepend=False) & gone).sum())
                out.append((doc_id, n, int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    return (docs.mapInArrow(texts, TEXTS).join(spans.select("uid", "spans.start", "spans.end"), "uid", "left")
            .select("doc_id", "n_bytes", "raw", "whole", "start", "end").mapInPandas(rows, REMOVED))
