import random
import zlib

import numpy as np
import pytest

from tierflow.llm import packing
from tierflow.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, piece string, lane string"


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder.of(tokenizer_path())


def test_ids_are_those_of_the_tokenizer(encoder):
    rng = random.Random(5)
    texts = ["", " ", "a  b\n\n c ", "\n \n x", "it's we'll", "é\t q\x85z", "日本 🙂 ٣", "x<|endoftext|> y", "x" * 3000,
             *["".join(rng.choice("ab é\n\t.,'1٣🙂\x1c\xa0") for _ in range(rng.randrange(80))) for _ in range(200)]]
    for text in texts:
        expected = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == expected


def test_only_the_first_piece_is_shorter():
    ids = np.arange(2500, dtype="<u4").tobytes()
    pieces = list(packing.cut_ids(ids, 1024))
    assert [(p, s, len(r) // 4) for p, s, r in pieces] == [(0, 0, 452), (1, 452, 1024), (2, 1476, 1024)]
    assert b"".join(r for _, _, r in pieces) == ids
    assert [len(r) // 4 for _, _, r in packing.cut_ids(ids[:4096], 1024)] == [1024]


def brute_sum_of_squares(lengths, size):
    bins, out = [], []  # used space of each bin
    for s in lengths:
        def after(choice):
            used = bins + [0] if choice == len(bins) else list(bins)
            used[choice] += s
            gaps = [size - u for u in used if u < size]
            return sum(gaps.count(g) ** 2 for g in set(gaps)), size - used[choice], choice == len(bins)
        best = min((c for c in range(len(bins) + 1) if c == len(bins) or bins[c] + s <= size), key=after)
        if best == len(bins):
            bins.append(0)
        out.append((after(best)[:2], bins[best]))
        bins[best] += s
    return bins, out


def test_each_piece_goes_where_the_sum_of_squares_is_smallest():
    rng = random.Random(2)
    for _ in range(40):
        lengths = [rng.randrange(1, 21) for _ in range(25)]
        bins, offsets = packing.sum_of_squares(np.array(lengths), 20)
        used = np.bincount(bins, lengths)
        expected, _ = brute_sum_of_squares(lengths, 20)
        assert sorted(used) == sorted(expected)
        for b in set(bins):  # gapless from 0
            inside = sorted((o, s) for x, o, s in zip(bins, offsets, lengths, strict=True) if x == b)
            assert [o for o, _ in inside] == np.cumsum([0, *[s for _, s in inside]])[:-1].tolist()


def test_pack(spark, encoder):
    rows = [(1, "one two three " * 900, "x", "y"), (2, None, None, None), (3, "", "x", "y"), (2, None, None, None),
            (None, "short text", "x", "y"), *[(k, "word " * k, "x", "y") for k in range(10, 60)]]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = packing.pack(docs, tokenizer_path(), group=20).toPandas()
    assert len(found[found.doc_id == 2]) == 2 and found[found.doc_id.isna()].shape[0] == 1
    for (_, text, _, _), doc_id in zip(rows, [r[0] for r in rows], strict=True):
        if doc_id in (None, 2):
            continue
        ids = encoder.ids(text or "") + np.array([2], "<u4").tobytes()
        pieces = found[found.doc_id == doc_id].sort_values("piece")
        assert pieces.length.sum() == len(ids) // 4
        for p in pieces.itertuples():
            assert zlib.crc32(ids[4 * p.start:4 * (p.start + p.length)]) == p.ids_crc32
    for _, inside in found.sort_values("offset").groupby("sequence_id"):
        assert inside.offset.tolist() == np.cumsum([0, *inside.length])[:-1].tolist()
        assert inside.length.sum() <= 1024


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), tokenizer_path()).collect() == []
