import random
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tierflow.llm import jaccard_join as jj
from tierflow.llm.common import components


def brute(rows, n=4, percent=85):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        s = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
        sets.setdefault(d, []).append(s)
    parent = {d: d for d in sets}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = [d for d in sets if d is not None]
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {d: find(d) if d is not None else None for d in sets}, sets


def corpus(seed, families=25, members=6):
    """Families of near copies, from one another by chains of small edits, sharing common passages."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(120)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = []
    for _ in range(families):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 7, 20, 60, 150]))]
        if rng.random() < 0.4:
            words += passage
        for _ in range(rng.randrange(1, members)):
            texts.append(" ".join(words))
            words = list(words)
            for _ in range(rng.randrange(0, 1 + max(1, len(words) // 25))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "n", "percent"), [(1, 4, 85), (2, 4, 85), (3, 5, 80), (4, 2, 60)])
def test_components_equal_all_pairs(spark, seed, n, percent):
    rows = corpus(seed)
    expected, sets = brute(rows, n, percent)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = jj.link(docs, n, percent).collect()
    assert {r.doc_id: r.component_id for r in out} == expected and len(out) == len(rows)
    assert all(r.n_shingles == len(sets[r.doc_id][0]) for r in out)
    assert len(set(expected.values())) < len(rows)


def test_the_order_of_lists_never_changes_the_result(spark):
    rows = corpus(7)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [sorted((r.doc_id, r.component_id) for r in jj.link(docs, long_lists=k).collect()) for k in (1, 5, 100_000)]
    assert found[0] == found[1] == found[2]


def test_a_chain_of_near_copies_is_one_component(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(60):
        rows.append((k, " ".join(words)))
        for _ in range(2):
            words[rng.randrange(200)] = f"x{k}{rng.random()}"
    expected, _ = brute(rows)
    out = jj.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in out} == expected


@pytest.mark.parametrize("seed", [1, 2])
def test_crowds_are_searched_in_blocks(spark, monkeypatch, seed):
    """Big families of near copies, most of which are not linked to their first text."""
    monkeypatch.setattr(jj, "CROWD", 3)
    monkeypatch.setattr(jj, "BLOCK", 4)
    rng = random.Random(seed)
    rows = []
    for family in range(3):
        base = [f"f{family}w{k}" for k in range(120)]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randrange(0, 6)):
                words[rng.randrange(len(words))] = f"x{rng.random()}"
            rows.append((len(rows), " ".join(words)))
    rows += [(200 + k, rows[k][1]) for k in range(0, 60, 7)]
    expected, _ = brute(rows)
    out = jj.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in out} == expected and len(set(expected.values())) > 4


def test_need_as_expression(spark):
    """The operator has the bound as SQL: on sizes of all kinds it equals the function."""
    sizes = spark.range(1, 2000).withColumnRenamed("id", "n").withColumn("skipped", F.expr("n % 7"))
    for percent in (50, 80, 85):
        few = f"ceil({percent} * n / 100)"
        need = F.expr(f"least(ceil({percent} * {few} / 100), 2 + {jj.MET_PERCENT} * {few} div 100) - skipped - 3 * (n + 1) div 100 div 2")
        assert all(r.need == jj.smallest_need(r.n, percent, r.skipped) for r in sizes.withColumn("need", need).collect())


def test_sketches_bound_the_differences():
    rng = np.random.default_rng(2)
    close = 0
    for _ in range(300):
        x = np.unique(rng.integers(0, 2**63, rng.integers(1, 900)).astype(np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < rng.choice([0.5, 0.9, 1.0])],
                                      rng.integers(0, 2**63, rng.integers(1, 60)).astype(np.uint64)]))
        bound = jj.differences(pd.Series([jj.sketch(x)]), pd.Series([jj.sketch(y)]))[0]
        true = len(np.setxor1d(x, y))
        assert bound <= true
        close += bound >= 0.7 * true
    assert close > 200
    assert jj.differences(pd.Series([jj.sketch(x)]), pd.Series([jj.sketch(x)]))[0] == 0


def test_divide_skip():
    rng = random.Random(6)
    for _ in range(300):
        lists = [sorted(rng.sample(range(40), rng.randrange(1, 40))) for _ in range(rng.randrange(1, 12))]
        least = rng.randrange(1, 9)
        members, counts = jj.divide_skip([np.array(x) for x in lists], least)
        total = [sum(m in x for x in lists) for m in range(40)]
        assert dict(zip(members.tolist(), counts.tolist(), strict=True)) == {m: c for m, c in enumerate(total) if c >= least}


def test_shared_prefix_bound():
    """Linked sets share at least k entries of their prefixes, less what both skip."""
    rng = random.Random(3)
    for percent in (50, 80, 85):
        for _ in range(400):
            universe = rng.sample(range(10**6), 400)
            size = rng.randrange(1, 300)
            x = set(universe[:size])
            y = set(rng.sample(sorted(x), rng.randrange(1, size + 1))) | set(universe[size:size + rng.randrange(0, 40)])
            if 100 * len(x & y) < percent * len(x | y):
                continue
            heads, ks, skips = [], [], []
            for s in (x, y):
                length, k, skip = jj.prefix_sizes(len(s), percent)
                heads.append(set(sorted(s)[:length - skip]))
                ks.append(k)
                skips.append(skip)
            assert len(heads[0] & heads[1]) >= min(ks) - sum(skips) >= 1
            assert all(jj.smallest_need(len(s), percent, skip) <= min(ks) - sum(skips) for s, skip in zip((x, y), skips, strict=True))


def test_defined_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, "A b", "x"), (5, "a  B", "x"), (6, "a b c", None), (7, "a b c", "x"),
            (7, "a b c", "x"), (None, "a b", "x"), (None, None, None), (8, "É b c d", "x"), (9, "é b c d", "x"), (10, "a b c", "x")]
    docs = spark.createDataFrame([(d, t, s, 5) for d, t, s in rows], "doc_id long, text string, component_id string, node int")
    out = sorted(((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jj.link(docs).collect()))
    assert out == [(0, 0, 0), (0, 1, 0), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 6), (7, 1, 6),
                   (8, 1, 8), (9, 1, 9), (10, 1, 6)]
    kept = jj.one_of_each(docs, 4, 85)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 8, 9]  # the row without an id copies row 4
    assert jj.link(docs.where("false")).collect() == [] and jj.one_of_each(docs.where("false")).collect() == []


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "x y")], "doc_id long, text string")
    assert sorted(r.doc_id for r in jj.one_of_each(docs).collect()) == [1, 2]


def test_rows_are_told_apart_by_id_and_text(spark):
    long = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([
        (5, long, "a"), (7, long, "a"), (7, "another clean text of some length here", "b"), (7, "another clean text of some length here", "b"),
        (None, long, "c"), (None, "only without an id as it were", "d"), (None, "only without an id as it were", "d"),
        (9, "two texts under one id the first", "e"), (9, "and quite some other words for it", "f"),
        (None, None, "g"), (None, None, "g"), (3, " \t", "h"), (3, "", "h"), (2**62 + 5, long, "i")], "doc_id long, text string, source string")
    kept = sorted((r.doc_id or 0, r.source) for r in jj.one_of_each(docs).collect())
    assert kept == [(0, "d"), (0, "g"), (0, "g"), (3, "h"), (3, "h"), (5, "a"), (7, "b"), (9, "e"), (9, "f")]


def test_components_of_random_graphs(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(k, k + 1) for k in range(100, 140)]
    expected = {}
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    for start in sorted(near):
        if start not in expected:
            todo = [start]
            while todo:
                x = todo.pop()
                if x not in expected:
                    expected[x] = start
                    todo += near[x]
    out = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in out} == expected and len(out) == len(expected)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_grams_of_words():
    def one(text, n=4):
        return jj.grams([b"x y", text.encode().lower(), b"", b"a"], n)[1].tolist()
    assert len(one("a b c d a b c d")) == 4
    assert one("A B c d") == one("a\tb C\n D") != one("a b d c")
    assert one("a b") == one(" a  b ") != one("b a") and len(one("a b")) == 1 and one(" \n") == []
    assert one("é b c") != one("e b c") and one("ab c") != one("a bc")


def test_hashes_do_not_depend_on_the_neighbours():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["a", "bb", "é", "c" * 300]) for _ in range(rng.randrange(0, 9))).encode() for _ in range(200)]
    assert [g.tolist() for g in jj.grams(texts, 3)] == [jj.grams([t], 3)[0].tolist() for t in texts]


def test_crowds_are_searched_among_like_sizes(spark, monkeypatch):
    """One boilerplate, with endings of very different lengths: blocks hold documents of like size only."""
    monkeypatch.setattr(jj, "CROWD", 3)
    monkeypatch.setattr(jj, "BLOCK", 4)
    tables = {}

    def kept(df, name, real=jj.written):
        tables[name] = real(df, name)
        return tables[name]

    monkeypatch.setattr(jj, "written", kept)
    rng = random.Random(5)
    boiler = [f"b{k}" for k in range(12)]
    rows = [(k, " ".join([*boiler, *(f"x{rng.randrange(10**6)}" for _ in range(length))])) for k, length in enumerate([1, 2, 3, 5, 8, 12, 20, 30] * 8)]
    crowds = spark.createDataFrame([(k, 0) for k, _ in rows], "node long, crowd long")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = spark.createDataFrame([], "a long, b long")
    found = jj.links_of_crowds(docs, crowds, none, 4, 80)
    links = {tuple(sorted(r)) for df in found for r in df.collect()}
    expected, sets = brute(rows, percent=80)
    parent = {d: d for d, _ in rows}
    for _ in rows:
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert parent == expected and 1 < len(set(parent.values())) < len(rows)
    sizes = {d: len(s[0]) for d, s in sets.items()}
    blocks = [r.asDict() for r in tables["bands"].collect()]
    whole = -(-len(rows) // jj.BLOCK)
    assert sum(b["index_blocks"] * b["query_blocks"] for b in blocks) < whole * whole / 2
    bands = {d: b for d, b in spark.createDataFrame(list(sizes.items()), "d long, n long").select("d", jj.band(F.col("n"), 80)).collect()}
    assert all(abs(bands[a] - bands[b]) <= 1 for a in sizes for b in sizes if 80 * sizes[b] <= 100 * sizes[a] <= 100 * sizes[b])


def test_bands_of_linked_sizes_touch(spark):
    sizes = spark.range(1, 3000).withColumnRenamed("id", "n")
    for percent in (50, 80, 85, 100):
        edge = sizes.select(jj.band(F.col("n"), percent).alias("x"), jj.band(F.ceil(F.col("n") * percent / 100), percent).alias("y"))
        assert edge.agg(F.max(F.col("x") - F.col("y"))).first()[0] <= 1
