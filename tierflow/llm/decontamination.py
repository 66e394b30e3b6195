"""Passages of a training corpus that repeat benchmark items.

Items are indexed by term with BM25 impacts, each divided by the score the item gives itself, so
that one threshold serves items of any length. Postings are cut into blocks with their largest
impact. Every document is cut into overlapping passages long enough to hold any item of the index
whole, and every passage queries the index by block-max WAND for all items above the threshold.
The block maxima of a passage's terms are summed for all blocks at once; WAND then walks the
lists of the passages for which some block can reach the threshold.
What is retrieved is verified on five-word shingles: the question (all sentences but the last)
and the answer (the last one) must each be found to ``overlap`` in the document.

Items are dealt by row into shards of about ``shard_bytes`` of text, and kept as a table with their
terms. In how many items a term is, their mean length and that of the longest are counted over all
items, so scores and passages do not depend on the shards. Documents are read once per shard. The
driver and each task hold one shard and its terms at a time, with block maxima only for the blocks
that hold a term, so memory grows with ``shard_bytes`` and not with the benchmark.

Defined results: words are runs of letters, digits and ``_`` in any case; a text of fewer than
five words is one shingle; items without words match nothing, null texts have no passages; an
item of one sentence has a question only; repeated documents are reported once per row,
repeated items once per row; an empty benchmark or corpus gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import arrow, blocks_for, discard, parts, written
from tierflow.session import scratch_path

WORD = re.compile(r"\w+")
SENTENCES = re.compile(r"(?<=[.!?])\s+")
BLOCK = 4  # items that share a bound
POSTINGS = 32  # postings that share a bound
HITS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def terms(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def shingles(found: list[str], n: int) -> set[str]:
    if len(found) < n:
        return {" ".join(found)} if found else set()
    return {" ".join(found[i:i + n]) for i in range(len(found) - n + 1)}


def question_answer(text: str) -> tuple[str, str]:
    parts = [p for p in SENTENCES.split(text.strip()) if terms(p)]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


class Statistics(NamedTuple):
    """Of all items that have words: their number, mean and largest length, and items by term."""

    items: int
    mean: float
    longest: int
    df: dict[str, int]


def statistics(items: list[tuple[int, str]]) -> Statistics:
    counts = [Counter(c) for c in (terms(t) for _, t in items) if c]
    lengths = [c.total() for c in counts]
    return Statistics(len(counts), sum(lengths) / max(1, len(lengths)), max(lengths, default=0),
                      Counter(t for c in counts for t in c))


class ItemIndex:
    """Block-max postings of one shard of items, by default of all."""

    def __init__(self, items: list[tuple[int, str]], n: int, threshold: float, of: Statistics | None = None,
                 k1: float = 1.2, b: float = 0.75) -> None:
        of = of or statistics(items)
        self.items = [(i, t) for i, t in items if terms(t)]
        counts = [Counter(terms(t)) for _, t in self.items]
        lengths = [c.total() for c in counts]
        mean, self.longest = of.mean, of.longest
        idf = {t: np.log1p((of.items - d + 0.5) / (d + 0.5)) for t, d in of.df.items()}
        postings, self.threshold = defaultdict(list), threshold
        for at, (count, length) in enumerate(zip(counts, lengths, strict=True)):
            impact = {t: idf[t] * f * (k1 + 1) / (f + k1 * (1 - b + b * length / mean)) for t, f in count.items()}
            own = sum(impact.values())
            for t, x in impact.items():
                postings[t].append((at, x / own))
        self.postings = {t: ([i for i, _ in p], [x for _, x in p],
                             [max(x for _, x in p[k:k + POSTINGS]) for k in range(0, len(p), POSTINGS)])
                         for t, p in postings.items()}
        self.most = {t: max(p[1]) for t, p in self.postings.items()}
        self.number = {t: at for at, t in enumerate(self.postings)}
        # block maxima of term t: entries starts[t] .. starts[t] + sizes[t] of (block, bound)
        self.blocks = -(-len(counts) // BLOCK)
        blocks, bounds, sizes = [], [], []
        for items_of, impacts, _ in self.postings.values():
            block = np.array(items_of) // BLOCK
            first = np.flatnonzero(np.diff(block, prepend=-1))
            blocks.append(block[first])
            bounds.append(np.maximum.reduceat(np.array(impacts), first))
            sizes.append(len(first))
        self.block, self.bound = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (blocks, bounds))
        self.sizes = np.array(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.parts = []
        for _, text in self.items:
            question, answer = question_answer(text)
            self.parts.append((shingles(terms(question), n), shingles(terms(answer), n)))
        self.n = n

    def reachable(self, numbers: set[int]) -> float:
        """The largest sum of block maxima of some terms over all blocks."""
        at = np.fromiter(numbers, np.int64, len(numbers))
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        entry = np.repeat(self.starts[at] - ends + sizes, sizes) + np.arange(ends[-1])
        return np.bincount(self.block[entry], self.bound[entry]).max()

    def search(self, query: set[str]) -> Iterator[tuple[int, float]]:
        """Every item scoring ``threshold`` or more, by block-max WAND."""
        threshold = self.threshold
        lists = [[0, *self.postings[t], self.most[t]] for t in query if t in self.postings]
        end = len(self.items)
        slack = 1e-9
        while lists:
            lists.sort(key=lambda x: x[1][x[0]])
            total, pivot = 0.0, None
            for at, x in enumerate(lists):
                total += x[4]
                if total >= threshold - slack:
                    pivot = at
                    break
            if pivot is None:
                return
            item = lists[pivot][1][lists[pivot][0]]
            while pivot + 1 < len(lists) and lists[pivot + 1][1][lists[pivot + 1][0]] == item:
                pivot += 1
            # move lists to the block that could hold the pivot, and sum the block maxima
            bound, jump = 0.0, end
            for x in lists[:pivot + 1]:
                place = bisect_left(x[1], item, x[0])
                if place < len(x[1]):
                    block = place // POSTINGS
                    bound += x[3][block]
                    last = x[1][min(len(x[1]), (block + 1) * POSTINGS) - 1]
                    jump = min(jump, last + 1)
            if pivot + 1 < len(lists):
                jump = min(jump, lists[pivot + 1][1][lists[pivot + 1][0]])
            if bound >= threshold - slack:
                score = 0.0
                for x in lists[:pivot + 1]:
                    x[0] = bisect_left(x[1], item, x[0])
                    if x[0] < len(x[1]) and x[1][x[0]] == item:
                        score += x[2][x[0]]
                        x[0] += 1
                if score >= threshold - slack:
                    yield item, score
            else:
                target = max(jump, item + 1)
                for x in lists[:pivot + 1]:
                    x[0] = bisect_left(x[1], target, x[0])
            lists = [x for x in lists if x[0] < len(x[1])]

    def passages(self, found: list[str]) -> Iterator[tuple[int, int]]:
        """Windows such that any run of ``longest`` words lies within one."""
        step = max(64, self.longest)
        for start in range(0, max(1, len(found) - step), step):
            yield start, min(len(found), start + 2 * step)

    def matches(self, text: str | None, overlap: float) -> list[tuple[int, float, float, float]]:
        found = terms(text)
        numbers = list(map(self.number.get, found))
        best: dict[int, float] = {}
        for start, end in self.passages(found):
            passage = set(numbers[start:end])
            passage.discard(None)
            if passage and self.reachable(passage) >= self.threshold - 1e-6:
                for item, score in self.search(self.postings.keys() & found[start:end]):
                    best[item] = max(score, best.get(item, 0.0))
        if not best:
            return []
        own, out = shingles(found, self.n), []
        joined = " " + " ".join(found) + " "

        def share(part: set[str]) -> float:
            if not part:
                return 1.0
            return sum(s in own or s.count(" ") + 1 < self.n and f" {s} " in joined for s in part) / len(part)

        for item, score in sorted(best.items()):
            question, answer = (share(p) for p in self.parts[item])
            if question >= overlap and answer >= overlap:
                out.append((self.items[item][0], score, question, answer))
        return out


def shards(benchmark: DataFrame, shard_bytes: int) -> Iterator[tuple[list[tuple[int, str]], Statistics]]:
    """Items by shard, one at a time, with the statistics of all items for the shard's terms."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null")
    count = blocks_for(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0, shard_bytes)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [terms(t) for t in batch["text"]]
            yield batch.assign(length=[len(f) for f in found], terms=[list(set(f)) for f in found])

    # dealt by row: copies of one item are spread too
    items = written(items.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(count)))
                    .mapInPandas(counted, "item_id long, text string, shard long, length long, terms array<string>")
                    .where("length > 0"), "items")
    total, words, longest = items.agg(F.count("*"), F.sum("length"), F.max("length")).first()
    # a term has one row per shard, however many items hold it
    held = items.select("shard", F.explode("terms").alias("term")).groupBy("shard", "term").agg(F.count("*").alias("held"))
    by_term = held.groupBy("term").agg(F.sum("held").alias("df"))
    df = written(held.join(by_term, "term").select("shard", "term", "df"), "item_terms")
    for shard in range(count) if total else ():
        block = [(r["item_id"], r["text"]) for r in items.where(F.col("shard") == shard).select("item_id", "text").collect()]
        some = {r["term"]: r["df"] for r in df.where(F.col("shard") == shard).select("term", "df").collect()}
        if block:
            yield block, Statistics(total, words / total, longest, some)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, overlap: float = 0.8,
                 n: int = 5, shard_bytes: int = 4_000_000) -> DataFrame:
    """(doc_id, item_id) of every item found in a document, with its score and overlaps."""
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("text is not null")

    def search(items: list[tuple[int, str]], of: Statistics) -> DataFrame:
        def hits(batches):
            index = ItemIndex(items, n, threshold, of)
            for part in parts(batches):
                found = [(doc_id, *hit) for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True)
                         for hit in index.matches(text, overlap)]
                frame = pd.DataFrame(found, columns=[c.split()[0] for c in HITS.split(", ")])
                yield arrow(frame.astype({"doc_id": "Int64"}), HITS)
        return texts.mapInArrow(hits, HITS)

    found = [written(search(block, of), "hits") for block, of in shards(benchmark, shard_bytes)]
    return reduce(DataFrame.unionAll, found) if found else docs.sparkSession.createDataFrame([], HITS)


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, overlap: float = 0.8,
          n: int = 5, shard_bytes: int = 4_000_000) -> DataFrame:
    """The documents, all columns kept, in which no item is found.

    What a shard leaves is written before the next one, and deleted once that is written in turn.
    """
    def without(docs: DataFrame, items: list[tuple[int, str]], of: Statistics) -> DataFrame:
        def kept(batches):
            import pyarrow as pa
            index = ItemIndex(items, n, threshold, of)
            for part in parts(batches):
                yield part.filter(pa.array([not index.matches(t, overlap) for t in part.column("text").to_pylist()], pa.bool_()))
        return docs.mapInArrow(kept, docs.schema)

    spark, before = docs.sparkSession, None
    for at, (block, of) in enumerate(shards(benchmark, shard_bytes)):
        if at:
            folder = scratch_path(spark, "clean")
            docs = written(docs, "clean", folder)
            if before:
                discard(spark, before)
            before = folder
        docs = without(docs, block, of)
    return docs
