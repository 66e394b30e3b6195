"""Exact Jaccard self-join of documents on word n-grams, by T-occurrence search (DivideSkip).

Two documents with similarity t or more share at least T of their n-grams, and by the prefix
principle at least k of those that come first in a common order. The order puts n-grams with long
inverted lists last. So each document is put into the inverted lists of the first
``n - ceil(t n) + k`` n-grams of its set only, of which it may skip a few of the longest. Short
lists travel packed, sorted and many documents together, and are merged by range of the n-gram;
entries of long lists are rows, which Spark can split. Occurrences of a pair are counted, and
pairs that reach k less the lists skipped by either are candidates. The skipped lists, and all
others, are then probed by binary search in the sorted sets of the two documents, which gives the
exact overlap.

Pairs are formed in lists of up to ``CROWD`` entries only. Two documents must meet there in k
lists less those skipped and less the longer ones that both have. Only if that leaves nothing, as
among many copies of one text, do longer lists count: documents that may owe a link to these and
meet in one, directly or through others, are a crowd. Its pairs are never formed. Texts with equal
sets are one node; a crowd is compared with its first node; what that leaves in other components
than most of the crowd is searched among its documents of like size in blocks: inverted lists over up to ``BLOCK`` whole sets in
memory, the short ones merged, the long ones probed. A block gives no more links than it has
documents, enough to connect what is linked.

Which n-grams have long lists is estimated from all documents; it changes the order, hence the
cost, and never the result. At most ``long_lists`` are known, which bounds what tasks receive.

Defined results: texts without words have an empty set and link to nothing; a text of fewer than
n words has one n-gram, the whole sequence; rows with one doc_id are one document, which links if
any of its texts does; rows with null doc_id have a null component; an empty table gives no rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import (
    arrow,
    as_bytes,
    blocks_for,
    bloom,
    components,
    in_bloom,
    maybe_held,
    mixed,
    packed,
    slices,
    unpacked,
    word_hashes,
    written,
)

SHAPES = "doc_id long, n_shingles long, digest long, digest2 long, gram long, seen long"
LISTS = "range int, grams binary, at binary, doc_ids binary, digests binary, metas binary, gram array<long>, doc_id long, digest long, meta long"
ENTRIES = "gram long, node long, meta long"
SETS = "doc_id long, n long, grams binary"
SKETCHES = "doc_id long, n long, sketch binary"
SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                  0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
MET_PERCENT = 3  # of a set that must meet in its lists: more makes the lists longer and the candidates fewer
CROWD = 32  # entries above which a list's documents are searched in blocks instead of paired
BLOCK = 512  # documents of a block
RANGE_GRAMS = 2_500_000  # n-grams of all sets per range of short lists; about a fifth enter the lists


def raw(texts: list[str | None]) -> list[bytes]:
    """UTF-8 with A-Z in lower case."""
    return [as_bytes(t).lower() for t in texts]


def grams(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the word n-grams of each text."""
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    total = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        total += words[k:len(words) - n + 1 + k] * SALTS[k] if len(total) else total
    total = mixed(total)
    out = []
    for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
        if count >= n:
            out.append(np.unique(total[end - count:end - n + 1]))
        elif count:  # the whole sequence, told apart from n-grams by its length
            out.append(mixed((words[end - count:end] * SALTS[:count]).sum(keepdims=True) + np.uint64(count)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def often_held(sets: list[np.ndarray], often: int) -> pd.DataFrame:
    """The n-grams that ``often`` or more of the sets hold."""
    held = np.concatenate(sets)
    cell = (held >> np.uint64(44)).astype(np.int32)
    found, counts = np.unique(held[np.bincount(cell, minlength=1 << 20)[cell] >= often], return_counts=True)
    return pd.DataFrame({"gram": found[counts >= often].view(np.int64), "seen": counts[counts >= often]})


def shapes(docs: DataFrame, n: int, often: int = 3, flush: int = 1_000_000) -> DataFrame:
    """Size and digest of every set; and n-grams that many documents of a task hold."""
    def rows(batches):
        held, size = [], 0
        for ids, texts in slices(batches):
            sets = grams(raw(texts), n)
            digests = np.array([np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) for s in sets])
            yield arrow(pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "n_shingles": [len(s) for s in sets],
                                      "digest": digests[:, 0], "digest2": digests[:, 1]}), SHAPES)
            held += sets
            size += sum(map(len, sets))
            if size > flush:
                yield arrow(often_held(held, often), SHAPES)
                held, size = [], 0
        if held:
            yield arrow(often_held(held, often), SHAPES)

    return docs.mapInArrow(rows, SHAPES)


def prefix_sizes(n: int, percent: int) -> tuple[int, int, int]:
    """Prefix length, occurrences k that a pair must reach in it, and lists that may be skipped.

    k grows with the set and is 2 or more where the set has two to share. Lists are skipped as if for the smallest set that can be linked, so two
    linked documents together skip fewer than the smaller k of both.
    """
    least = -(-percent * n // 100)
    return n - least + occurrences(n, least), occurrences(n, least), may_skip(least)


def occurrences(n: int, least: int) -> int:
    return min(least, 2 + MET_PERCENT * n // 100)


def may_skip(least: int) -> int:
    """Lists a set may skip whose linked sets have ``least`` members or more."""
    return 3 * least // 100 // 2


def smallest_need(n: int, percent: int, skipped: int) -> int:
    """Occurrences that a set must have in common with any set linked to it, less what both skip."""
    least = -(-percent * n // 100)
    return occurrences(least, -(-percent * least // 100)) - skipped - may_skip(n + 1)


def lists(docs: DataFrame, n: int, percent: int, long_grams: np.ndarray, ranges: int) -> DataFrame:
    """The list entries of each document: those of short lists packed by range of the n-gram, in
    blocks of many documents; those of long lists in rows of their own.

    ``long_grams`` are in order of list length, longest last. ``meta`` is 64 times the size of the
    set plus the lists skipped.
    """
    by_value, rank = np.sort(long_grams), np.argsort(long_grams)

    def rows(batches):
        for ids, texts in slices(batches):
            short_of, long_of, ids_of, digests, metas = [], [], [], [], []
            for doc_id, found in zip(ids, grams(raw(texts), n), strict=True):
                if not len(found) or doc_id is None:
                    continue
                size, _, may_skip = prefix_sizes(len(found), percent)
                at = np.minimum(np.searchsorted(by_value, found), max(0, len(by_value) - 1))
                is_long = by_value[at] == found if len(by_value) else np.zeros(len(found), bool)
                short, long = found[~is_long][:size], found[is_long]
                skipped = min(may_skip, max(0, size - len(short)))
                left = size - skipped - len(short)
                short_of.append(short)
                long_of.append(long[np.argsort(rank[at[is_long]])][:left].view(np.int64) if left > 0 else None)
                ids_of.append(doc_id)
                digests.append(xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63))
                metas.append(64 * len(found) + skipped)
            if not ids_of:
                continue
            ids_of, digests, metas = (np.array(x, np.int64) for x in (ids_of, digests, metas))
            with_long = [k for k, x in enumerate(long_of) if x is not None and len(x)]
            if with_long:
                yield arrow(pd.DataFrame({"range": -1, "gram": [long_of[k] for k in with_long], "doc_id": ids_of[with_long],
                                          "digest": digests[with_long], "meta": metas[with_long]}), LISTS)
            held = np.concatenate(short_of)
            order = np.argsort(held)
            held, doc = held[order], np.repeat(np.arange(len(ids_of)), [len(x) for x in short_of])[order]
            edges = np.searchsorted((held >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32), np.arange(ranges + 1, dtype=np.uint64))
            blocks = []
            for r in np.flatnonzero(np.diff(edges)):
                some = slice(edges[r], edges[r + 1])
                present, at = np.unique(doc[some], return_inverse=True)
                blocks.append((r, packed(np.diff(held[some], prepend=np.uint64(0))), packed(at.astype(np.uint32)),
                               packed(ids_of[present]), packed(digests[present]), packed(metas[present])))
            yield arrow(pd.DataFrame(blocks, columns=["range", "grams", "at", "doc_ids", "digests", "metas"]), LISTS)

    return docs.mapInArrow(rows, LISTS)


def shared_entries(blocks: pd.DataFrame) -> pd.DataFrame:
    """Entries of the lists of one range that hold different sets; of equal sets the smallest id."""
    parts = []
    for b in blocks.itertuples(index=False):
        at = unpacked(b.at, np.uint32)
        held = np.cumsum(unpacked(b.grams, np.uint64), dtype=np.uint64)
        parts.append((held, *(unpacked(x, np.int64)[at] for x in (b.digests, b.doc_ids, b.metas))))
    held, digest, node, meta = (np.concatenate(x) for x in zip(*parts, strict=True))
    # most n-grams occur once: leave them out before sorting by all columns
    order = np.argsort(held)
    same = held[order][1:] == held[order][:-1]
    some = order[np.append(same, False) | np.insert(same, 0, False)]
    some = some[np.lexsort((node[some], digest[some], held[some]))]
    held, digest, node, meta = held[some], digest[some], node[some], meta[some]
    first = np.ones(len(held), bool)
    first[1:] = (held[1:] != held[:-1]) | (digest[1:] != digest[:-1])
    held, node, meta = held[first], node[first], meta[first]
    same = held[1:] == held[:-1]
    kept = np.append(same, False) | np.insert(same, 0, False) if len(held) else np.empty(0, bool)
    return pd.DataFrame({"gram": held[kept].view(np.int64), "node": node[kept], "meta": meta[kept]})


def of_some(docs: DataFrame, ids: DataFrame, n: int, schema: str, make: Callable[[np.ndarray], bytes]) -> DataFrame:
    """``make`` of the set of each given document; a Bloom filter spares the others the shuffle to the join."""
    held = bloom(ids, "doc_id")
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def rows(batches):
        import pyarrow as pa
        for batch in batches:
            hit = maybe_held(held, batch.column("doc_id").to_numpy(zero_copy_only=False))
            for some, texts in slices([batch.filter(pa.array(hit, pa.bool_()))]):
                found = [(d, len(g), make(g)) for d, g in zip(some, grams(raw(texts), n), strict=True) if len(g)]
                yield arrow(pd.DataFrame(found, columns=names), schema)

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(rows, schema).join(ids, "doc_id", "left_semi")


def sets_of(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    return of_some(docs, ids, n, SETS, lambda found: packed(np.diff(found, prepend=np.uint64(0))))


def sketch(found: np.ndarray) -> bytes:
    """Parities of the members per bucket, of which there are two to four times as many."""
    buckets = 1 << max(6, (2 * len(found)).bit_length())
    counts = np.bincount((found & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def differences(mine: pd.Series, other: pd.Series) -> pd.Series:
    """A lower bound on the members that only one of two sets has: buckets of another parity."""
    out = []
    for a, b in zip(mine, other, strict=True):
        x, y = (np.frombuffer(raw, np.uint8) for raw in (a, b))
        if len(x) < len(y):
            x, y = y, x
        while len(x) > len(y):  # the parities of half as many buckets
            x = x[:len(x) // 2] ^ x[len(x) // 2:]
        out.append(int(np.bitwise_count(x ^ y).sum()))
    return pd.Series(out, dtype="int64")


def overlaps(mine: pd.Series, other: pd.Series) -> pd.Series:
    out = []
    for a, b in zip(mine, other, strict=True):
        x, y = (np.cumsum(unpacked(raw, np.uint64), dtype=np.uint64) for raw in (a, b))
        if len(x) > len(y):
            x, y = y, x
        at = np.minimum(np.searchsorted(y, x), len(y) - 1)  # binary probes of the shorter set in the longer
        out.append(int((y[at] == x).sum()))
    return pd.Series(out, dtype="int64")


def paired(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """The pairs (a, b) with size and ``column`` of both documents."""
    one, other = (table.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col(column).alias(f"{column}_{x}"))
                  for x in ("a", "b"))
    return pairs.join(one, "a").join(other, "b")


def verified(docs: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose exact similarity reaches the threshold, as a table.

    Sets are long, so they are compared only where small sketches don't show too many differences.
    """
    def documents(some: DataFrame) -> DataFrame:
        return some.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()

    pairs = written(pairs, "candidates")
    sketches = written(of_some(docs, documents(pairs), n, SKETCHES, sketch), "sketches")
    differ = F.pandas_udf(differences, "long")
    pairs = (paired(pairs, sketches, "sketch")
             .select("a", "b", (F.col("n_a") + F.col("n_b")).alias("sizes"), differ("sketch_a", "sketch_b").alias("differ"))
             .where((100 + percent) * F.col("differ") <= (100 - percent) * F.col("sizes")).select("a", "b").distinct())
    pairs = written(pairs, "close")
    sets = written(sets_of(docs, documents(pairs), n), "sets")
    overlap = F.pandas_udf(overlaps, "long")
    found = (paired(pairs, sets, "grams")
             .select("a", "b", (F.col("n_a") + F.col("n_b")).alias("sizes"), overlap("grams_a", "grams_b").alias("shared"))
             .where(100 * F.col("shared") >= percent * (F.col("sizes") - F.col("shared"))).select("a", "b").distinct())
    return written(found, "links")


def met_in_short_lists(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs that meet in as many lists as linked documents must, less the long lists they may share."""
    one, other = (entries.select("gram", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "k", "skipped", "long")]) for x in ("a", "b"))
    least = F.least("k_a", "k_b") - F.col("skipped_a") - F.col("skipped_b") - F.least("long_a", "long_b")
    return (one.join(other, "gram")
            .where((F.col("node_a") < F.col("node_b")) & (100 * F.col("n_a") >= percent * F.col("n_b"))
                   & (100 * F.col("n_b") >= percent * F.col("n_a")))
            .groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
            .agg(F.count(F.lit(1)).alias("met"), F.first(least).alias("least"))
            .where("met >= least").select("a", "b"))


def divide_skip(lists: list[np.ndarray], least: int, weight: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Members of ``least`` or more of the sorted lists, and of how many.

    The longest lists are set aside, fewer than ``least``; the short ones are merged, and what
    occurs often enough to reach ``least`` with them is looked up in each by binary search.
    """
    lists = sorted(lists, key=len)
    if not lists or len(lists) < least:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    aside = min(least - 1, int(least / (weight * np.log2(len(lists[-1]) + 1) + 1)))
    members, counts = np.unique(np.concatenate(lists[:len(lists) - aside]), return_counts=True)
    near = counts >= least - aside
    members, counts = members[near], counts[near]
    for long in lists[len(lists) - aside:]:
        counts += long[np.minimum(np.searchsorted(long, members), len(long) - 1)] == members
    return members[counts >= least], counts[counts >= least]


def search_block(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between the queries and the indexed documents of a block, as a spanning forest.

    Documents with one label are connected already, and so are those this block has linked.
    """
    index, queries = rows[rows["indexed"]].sort_values("node"), rows[~rows["indexed"]].sort_values("node")
    sets = [np.cumsum(unpacked(g, np.uint64), dtype=np.uint64) for g in index["grams"]]
    held = np.concatenate([*sets, np.empty(0, np.uint64)])
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(held, kind="stable")
    entries = np.repeat(np.arange(len(sets)), sizes)[order]
    values, start = np.unique(held[order], return_index=True)
    end = np.append(start[1:], len(held))
    label, parent = index["label"].to_numpy(), {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    out, nodes = [], index["node"].to_numpy()
    for node, own, raw in zip(queries["node"], queries["label"], queries["grams"], strict=True):
        mine = np.cumsum(unpacked(raw, np.uint64), dtype=np.uint64)
        at = np.searchsorted(values, mine)
        at = at[(at < len(values)) & (values[np.minimum(at, len(values) - 1)] == mine)] if len(values) else at[:0]
        members, shared = divide_skip([entries[start[k]:end[k]] for k in at], -(-percent * len(mine) // 100))
        linked = 100 * shared >= percent * (len(mine) + sizes[members] - shared)
        for k in members[linked].tolist():
            a, b = root(int(own)), root(int(label[k]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((node, nodes[k]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def band(n: Column, percent: int) -> Column:
    """A number for the size of a set; those of linked sets differ by one at most."""
    return F.floor(F.log(n.cast("double")) / F.lit(max(1e-9, 1.0001 * math.log(100 / percent))))


def links_of_crowds(docs: DataFrame, crowds: DataFrame, known: DataFrame, n: int, percent: int) -> list[DataFrame]:
    """Links within crowds: documents that meet in long lists, directly or through others.

    All are compared with the crowd's first document, which connects copies of one text. What is
    then in another component than most of its crowd is searched in blocks against the crowd's
    documents of sizes that can be linked.
    """
    crowds = written(crowds, "crowds")
    stars = verified(docs, crowds.where("node <> crowd").select(F.col("node").alias("a"), F.col("crowd").alias("b")), n, percent)
    labels = components(known.unionAll(stars)).withColumnRenamed("component", "label")
    members = written(crowds.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "members")
    main = (members.groupBy("crowd", "label").agg(F.count(F.lit(1)).alias("size"))
            .groupBy("crowd").agg(F.max_by("label", F.struct("size", "label")).alias("main"),
                                  (F.sum("size") - F.max("size")).alias("others")).where("others > 0"))
    split = written(members.join(main.select("crowd", "main"), "crowd"), "split_crowds")
    sets = written(sets_of(docs, split.select(F.col("node").alias("doc_id")), n), "crowd_sets").withColumnRenamed("doc_id", "node")
    # a node of several texts is searched at the size of each
    sized = split.join(sets.select("node", "n").distinct(), "node").withColumn("band", band(F.col("n"), percent))
    indexed = sized.withColumn("band", F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)))
    asked = sized.where("label <> main")
    counts = [rows.groupBy("crowd", "band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias(name))
              for rows, name in ((indexed, "index_blocks"), (asked, "query_blocks"))]
    bands = written(counts[0].join(counts[1], ["crowd", "band"]), "bands")
    place = {"q": F.pmod(F.xxhash64("node"), F.col("query_blocks")), "i": F.pmod(F.xxhash64("node", F.lit(1)), F.col("index_blocks"))}
    every = {"q": F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)), "i": F.explode(F.sequence(F.lit(0), F.col("index_blocks") - 1))}
    indexed, asked = (rows.join(bands, ["crowd", "band"]) for rows in (indexed, asked))
    indexed = indexed.withColumn("i", place["i"]).withColumn("q", every["q"]).withColumn("indexed", F.lit(True))
    asked = asked.withColumn("q", place["q"]).withColumn("i", every["i"]).withColumn("indexed", F.lit(False))
    blocks = indexed.unionByName(asked).select("crowd", "band", "q", "i", "node", "n", "label", "indexed").join(sets, ["node", "n"])
    links = blocks.groupBy("crowd", "band", "q", "i").applyInPandas(lambda rows: search_block(rows, percent), "a long, b long")
    return [stars, written(links, "crowd_links")]


def link(docs: DataFrame, n: int = 4, percent: int = 85, long_lists: int = 100_000) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    shaped = written(shapes(docs, n), "shapes")
    common = (shaped.where("gram is not null").groupBy("gram").agg(F.sum("seen").alias("seen"))
              .orderBy(F.desc("seen"), "gram").limit(long_lists).orderBy("seen", "gram").select("gram").toPandas())
    long_grams = common["gram"].to_numpy(np.int64).view(np.uint64)
    sizes = shaped.where("n_shingles is not null").select("doc_id", "n_shingles", "digest", "digest2")
    nodes = written(sizes.where("n_shingles > 0 and doc_id is not null").groupBy("digest", "digest2")
                    .agg(F.min("doc_id").alias("node")), "nodes")
    total = sizes.agg(F.sum("n_shingles")).first()[0] or 0
    entered = written(lists(docs, n, percent, long_grams, blocks_for(total, RANGE_GRAMS)), "lists")
    short = (entered.where("range >= 0").select("range", "grams", "at", "doc_ids", "digests", "metas")
             .groupBy("range").applyInPandas(shared_entries, ENTRIES))
    long = (entered.where("range < 0").select(F.explode("gram").alias("gram"), "digest", "doc_id", "meta")
            .groupBy("gram", "digest").agg(F.min("doc_id").alias("node"), F.min("meta").alias("meta")).select("gram", "node", "meta"))
    entries = written(short.unionAll(long), "entries").withColumns({
        "n": F.expr("meta div 64"), "skipped": F.expr("meta % 64")}).drop("meta")
    least = F.expr(f"ceil({percent} * n / 100)")
    entries = entries.withColumn("k", F.least(least, F.expr(f"2 + {MET_PERCENT} * n div 100")))
    sized = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("entries")).where("entries > 1")
    # written, so that the join has an exchange on either side and Spark can split a hot n-gram
    shared = written(entries.join(written(sized, "list_sizes"), "gram"), "shared_lists")
    long = shared.where(F.col("entries") > CROWD).groupBy("node").agg(F.count(F.lit(1)).alias("long"))
    shared = shared.join(written(long, "long_lists"), "node", "left").withColumn("long", F.coalesce("long", F.lit(0)))
    found = [verified(docs, met_in_short_lists(shared.where(F.col("entries") <= CROWD), percent), n, percent)]
    # smallest_need, as an expression
    few = f"ceil({percent} * n / 100)"
    need = F.expr(f"least(ceil({percent} * {few} / 100), 2 + {MET_PERCENT} * {few} div 100) - skipped - 3 * (n + 1) div 100 div 2")
    crowded = shared.where(F.col("entries") > CROWD).select("gram", "node", "n", "skipped", "long")
    sizes_of = crowded.select("node", "n", "skipped", "long").distinct().where(F.col("long") >= need).select("node")
    crowded = written(crowded.select("gram", "node").join(written(sizes_of, "crowded"), "node"), "crowded_lists")
    stars = crowded.join(written(crowded.groupBy("gram").agg(F.min("node").alias("head")), "heads"), "gram").where(
        "node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    crowds = components(stars).withColumnRenamed("component", "crowd")
    found += links_of_crowds(docs, crowds, found[0], n, percent)
    joined = components(reduce(DataFrame.unionAll, found))
    found = (nodes.join(joined, nodes["node"] == joined["node"], "left")
             .select("digest", "digest2", F.coalesce("component", nodes["node"]).alias("of_node")))
    # rows of an empty set, and null ids, take part in no join
    linked = (sizes.where("n_shingles > 0 and doc_id is not null").join(found, ["digest", "digest2"])
              .select("doc_id", "n_shingles", F.col("of_node").alias("component_id")))
    alone = sizes.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionAll(alone)


def row_keys(docs: DataFrame) -> Column:
    """A key for each row: its id, or where that is null or not the row's alone a hash of id and text.

    Hashes lie above 2 ** 62, so that plain ids come before them. Which ids repeat is told by a Bloom
    filter: an id that it takes for a repeated one by mistake gets a hash, which does as well.
    """
    key = F.col("doc_id").cast("long")
    hashed = F.lit(1 << 62) + F.pmod(F.xxhash64(key, "text"), F.lit(1 << 62))
    repeated = written(docs.select(key.alias("doc_id")).where("doc_id is not null").groupBy("doc_id")
                       .agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id"), "repeated_ids")
    if repeated.isEmpty():
        return F.coalesce(key, hashed)
    return F.when(key.isNull() | F.coalesce(in_bloom(bloom(repeated, "doc_id"), key), F.lit(False)), hashed).otherwise(key)


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, long_lists: int = 100_000) -> DataFrame:
    """The documents, all columns kept, without those linked to one with a smaller id.

    Rows are told apart by id and text: of rows equal in both one stays, rows of one id with different
    texts are documents of their own, and rows without an id take part by their text; both come after
    plain ids in the choice of who stays. Rows without words are linked to nothing and all stay. Rows
    that stay anyway are not shuffled: a Bloom filter holds back those that may go, and these meet
    the exact list.
    """
    mark = "_maybe_" + uuid.uuid4().hex
    docs = docs.withColumn(mark + "key", row_keys(docs))
    linked = written(link(docs.select(F.col(mark + "key").alias("doc_id"), "text"), n, percent, long_lists), "components")
    counted = (linked.where("n_shingles > 0").groupBy("doc_id")
               .agg(F.min("component_id").alias("component_id"), F.count(F.lit(1)).alias("rows")))
    special = written(counted.where("component_id <> doc_id or rows > 1").select("doc_id", "component_id"), "special")
    docs = docs.withColumn(mark, F.coalesce(in_bloom(bloom(special.select("doc_id"), "doc_id"), F.col(mark + "key")), F.lit(False)))
    gone = special.where("component_id <> doc_id").select(F.col("doc_id").alias(mark + "id"))
    checked = docs.where(F.col(mark)).join(gone, F.col(mark + "key") == F.col(mark + "id"), "left_anti")
    # of rows that share a key one stays, unless they have no words
    wordless = F.trim(F.translate(F.coalesce("text", F.lit("")), "\t\n\x0b\x0c\r", "     ")) == ""
    once = checked.where(~wordless).dropDuplicates([mark + "key"])
    return docs.where(~F.col(mark)).unionByName(once).unionByName(checked.where(wordless)).drop(mark, mark + "key")
