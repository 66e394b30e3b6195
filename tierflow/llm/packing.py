"""Sum-of-squares packing of tokenized documents into sequences of a fixed length.

Each document becomes token ids and an end id, and is cut into pieces only if it is longer than
a sequence: full pieces at its end, the shorter one first. Pieces are dealt into groups of about
``group`` rows; every group is packed in one task, largest pieces first, each placed where the
sum of the squared counts of open bins per residual gap becomes smallest. A group leaves a
handful of bins unfilled whatever its size, so larger groups waste less.

Defined results: null and empty texts are the end id alone; repeated rows are packed once per
row; of equally good places the one leaving the smallest gap is taken, an open bin before a new
one; an empty table gives no rows. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import arrow, blocks_for, parts, written

END_ID = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, lane long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class Encoder:
    """Ids of whole texts by a byte-level BPE file of ``tokenizers``, four bytes an id.

    The merges of such a file rank tokens by id, so ``tiktoken`` gives the same ids from them in
    a fifth of the time; a text that holds a special token goes to the tokenizer itself.
    """

    _SHARED: dict[str, Encoder] = {}
    # The pattern that byte-level BPE files of this kind split text by: a fixed value.
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        self.path = path
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        self.special = [t["content"] for t in given["added_tokens"]]
        # bytes that do not print are written as code points from 256 on, in order
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in printable}
        byte |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
        ranks = {bytes(byte[c] for c in token): at for token, at in given["model"]["vocab"].items() if token not in self.special}
        self.fast = tiktoken.Encoding(path, pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.path)

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._SHARED:
            cls._SHARED[path] = cls(path)
        return cls._SHARED[path]

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            found = self.fast.encode_ordinary(text)
        return np.array(found, "<u4").tobytes()


def cut_ids(ids: bytes, size: int) -> Iterator[tuple[int, int, bytes]]:
    """(piece, start, ids) of a document; only the first piece may be shorter than ``size``."""
    total = len(ids) // 4
    first = total - size * (-(-total // size) - 1)
    start, length, piece = 0, first, 0
    while start < total:
        yield piece, start, ids[4 * start:4 * (start + length)]
        start, length, piece = start + length, size, piece + 1


def tokenized_pieces(docs: DataFrame, path: str, size: int, end_id: int = END_ID) -> DataFrame:
    """One row per piece. ``lane`` spreads rows evenly over groups, repeated documents included."""
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches):
        encoder, count = Encoder.of(path), 0
        for part in parts(batches):
            out = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                ids = encoder.ids(text) if text else b""
                for piece, start, raw in cut_ids(ids + end, size):
                    count += 1
                    lane = zlib.crc32(f"{doc_id} {piece} {count}".encode())
                    out.append((doc_id, piece, start, len(raw) // 4, zlib.crc32(raw), lane))
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "lane"])
            yield arrow(frame.astype({"doc_id": "Int64"}), PIECES)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, PIECES)


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, in the given order.

    ``open_[g]`` counts open bins with gap g. Taking a piece of length s into gap g changes the
    sum of squares by (n_g - 1)^2 - n_g^2 + (n_h + 1)^2 - n_h^2 with h = g - s; a new bin only
    adds the second half, and a filled bin (h = 0) is no longer open.
    """
    open_ = np.zeros(size + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    bins, offsets, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for at, s in enumerate(lengths.tolist()):
        gaps = open_[s:size]
        after = 2 * open_[:size - s] + 1
        if s < size:
            after[0] = 0
        change = np.where(gaps > 0, 1 - 2 * gaps + after, np.iinfo(np.int64).max)
        fresh = 2 * open_[size - s] + 1 if s < size else 0
        best = int(change.argmin()) if len(change) else 0
        if len(change) and change[best] <= fresh and gaps[best] > 0:
            gap = s + best
            number = stacks[gap].pop()
            open_[gap] -= 1
        else:
            gap, number, made = size, made, made + 1
        bins[at], offsets[at] = number, size - gap
        if gap > s:
            open_[gap - s] += 1
            stacks[gap - s].append(number)
    return bins, offsets


def pack(docs: DataFrame, path: str, size: int = 1024, group: int = 150_000) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    pieces = written(tokenized_pieces(docs, path, size), "pieces")
    groups = blocks_for(pieces.count(), group)

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "lane", "doc_id", "piece"], ascending=[False, True, True, True])
        bins, offsets = sum_of_squares(rows["length"].to_numpy(np.int64), size)
        rows = rows.assign(sequence_id=bins * groups + rows["group_id"].to_numpy(np.int64), offset=offsets)
        return rows[[c.split()[0] for c in PACKED.split(", ")]]

    return (pieces.withColumn("group_id", F.col("lane") % groups)
            .groupBy("group_id").applyInPandas(packed, PACKED))
