"""Compression of vectors to short codes: product quantization with codebooks of Ball k-means.

Vectors become whole numbers and are cut into equal parts; each part position has a codebook of its
own, and the code of a vector is the index of the nearest entry, position by position.

Ball k-means: the members of an entry lie in a ball around it. Only entries whose distance from it
is at most twice the ball's radius can be nearer to a member: these are its neighbours. Half the
distance to the nearest neighbour bounds the stable core, whose members keep their entry without
being compared; the halves of the other distances cut the rest of the ball into rings, and a member
in the n-th ring is compared with the n nearest neighbours only. Radii are those of the members at
hand, a batch of rows: smaller balls have fewer neighbours, and the result is the same.

All arithmetic is on whole numbers, squared distances included, so that results don't depend on how
rows are batched. A round reads the rows with their codes and writes them anew with the new ones;
each batch adds what its moved members change in the sums of the entries. Core members add nothing.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import discard
from tierflow.session import scratch_path
from tierflow.sources.tables import stage

PARTS = 8
SCALE = 4096


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances between rows of equal position (or broadcast)."""
    gap = x - y
    return np.einsum("...i,...i->...", gap, gap)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, the lowest index on ties, and its distance: all compared."""
    best, at = distances(x, book[0]), np.zeros(len(x), np.int64)
    for j in range(1, len(book)):
        d = distances(x, book[j])
        nearer = d < best
        best[nearer], at[nearer] = d[nearer], j
    return at, best


def ball_step(x: np.ndarray, own: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """``nearest`` for parts that had the entries ``own``, and how many comparisons it took.

    An entry c' is as near as the own entry c at best if |c c'| <= 2 |x c|, by the triangle
    inequality; on squares of whole numbers: ceil(|c c'|^2 / 4) <= |x c|^2.
    """
    best, at, compared = distances(x, book[own]), own.copy(), len(x)
    radius = np.zeros(len(book), np.int64)
    np.maximum.at(radius, own, best)
    half = (distances(book[:, None], book[None]) + 3) // 4
    members = np.argsort(own, kind="stable")
    edges = np.searchsorted(own[members], np.arange(len(book) + 1))
    for i in range(len(book)):
        mine = members[edges[i]:edges[i + 1]]
        neighbours = [j for j in np.argsort(half[i], kind="stable").tolist() if j != i and half[i, j] <= radius[i]]
        if not neighbours or not len(mine):
            continue
        ring = np.searchsorted(half[i, neighbours], best[mine], side="right")  # 0: in the stable core
        mine = mine[np.argsort(-ring, kind="stable")]
        ring = np.sort(ring)[::-1]
        for n, j in enumerate(neighbours):
            outer = mine[:np.searchsorted(-ring, -n, side="left")]  # members beyond the n-th ring
            if not len(outer):
                break
            d = distances(x[outer], book[j])
            compared += len(outer)
            nearer = (d < best[outer]) | ((d == best[outer]) & (j < at[outer]))
            best[outer[nearer]], at[outer[nearer]] = d[nearer], j
    return at, best, compared


def moved_sums(x: np.ndarray, old: np.ndarray | None, new: np.ndarray, entries: int) -> np.ndarray:
    """What changes in count and sum of the entries: one row an entry, the count first."""
    change = np.zeros((entries, x.shape[1] + 1), np.int64)
    moved = slice(None) if old is None else old != new
    members = np.concatenate([np.ones((len(x), 1), np.int64), x], axis=1)[moved]
    np.add.at(change, new[moved], members)
    if old is not None:
        np.subtract.at(change, old[moved], members)
    return change


def reach(dim: int) -> int:
    """Components below this keep all distances within 64 bits, and fit in 32 themselves."""
    return math.isqrt((1 << 61) // max(1, dim // PARTS)) // 2


def _usable(vectors: DataFrame) -> DataFrame:
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(F.coalesce(sound, F.lit(False)) & (F.size("embedding") > 0) & (F.size("embedding") % PARTS == 0))


def _whole(x: Column, limit: int) -> Column:
    """``floor(SCALE * v)``; beyond the limit null."""
    scaled = F.transform(x.cast("array<double>"), lambda v: F.floor(v * SCALE))
    return F.when(F.forall(x.cast("array<double>"), lambda v: F.abs(v) * SCALE < limit), scaled)


def _matrix(column, rows: int) -> np.ndarray:
    """Rows, parts and components of whole numbers: lists at first, their bytes in later rounds."""
    import pyarrow as pa
    if pa.types.is_list(column.type):
        flat = column.flatten().to_numpy()
    else:
        flat = np.frombuffer(b"".join(column.to_pylist()), np.int32)
    return flat.reshape(rows, PARTS, -1).astype(np.int64)


def _rows_as_bytes(values: np.ndarray):
    import pyarrow as pa
    raw, width = values.tobytes(), values.nbytes // len(values)
    return pa.array([raw[at:at + width] for at in range(0, len(raw), width)], pa.binary())


def _pass(vectors: DataFrame, books: np.ndarray, first: bool, last: bool) -> DataFrame:
    """Rows with their entries of these codebooks; ``change`` in the first row of a batch."""
    entries = books.shape[1]
    kept = ["vec_id", "label"]
    fields = [vectors.schema[c] for c in kept] + [T.StructField("code", T.BinaryType())] + (
        [T.StructField("error", T.LongType())] if last else
        [T.StructField("x", T.BinaryType()), T.StructField("change", T.ArrayType(T.LongType()))])

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column("x"), n)
            old = None if first else np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, PARTS).astype(np.int64)
            new, error, change = np.empty((n, PARTS), np.int64), np.zeros(n, np.int64), []
            for p in range(PARTS):
                part = np.ascontiguousarray(x[:, p])
                new[:, p], d = nearest(part, books[p]) if first else ball_step(part, old[:, p], books[p])[:2]
                error += d
                change.append(moved_sums(part, None if first else old[:, p], new[:, p], entries))
            code = _rows_as_bytes(new.astype(np.uint8))
            if last:
                more = [code, pa.array(error)]
            else:
                sums = pa.array([np.concatenate(change).reshape(-1).tolist(), *[None] * (n - 1)], pa.list_(pa.int64()))
                more = [code, _rows_as_bytes(x.reshape(n, -1).astype(np.int32)), sums]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + more, names=[f.name for f in fields])

    return vectors.mapInArrow(rows, T.StructType(fields))


def _seeds(vectors: DataFrame, entries: int) -> list[list[int]]:
    """The vectors of the smallest ids; ties by their components, null ids last."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("x").asc()]
    return [row["x"] for row in vectors.select("vec_id", "x").orderBy(*order).limit(entries).collect()]


def _size(vectors: DataFrame) -> int | None:
    found = vectors.select("vec_id", F.size("embedding").alias("n")).orderBy(F.col("vec_id").asc_nulls_last(), "n").first()
    return found and found["n"]


def compress(vectors: DataFrame, entries: int = 16, rounds: int = 6) -> DataFrame:
    """Codes of the vectors: vec_id, code, error, label_error, codebooks_sha256, label.

    Components become ``floor(4096 * x)``. The codebook of each of the 8 parts starts as that part of
    the vectors with the smallest ids (all of them, if there are fewer); ``rounds`` times every part
    goes to its nearest entry (squared distance, ties to the lower index) and every entry to the floor
    of the mean of its parts, unused ones staying; then parts are assigned once more.

    Left out: null vectors, ones with a null or non-finite component, and those that cannot be cut
    or added up with the others: of a length that is no multiple of 8, or not that of the smallest
    id kept (ties: the shortest), or with components so large that distances leave 64 bits (beyond
    60,000 at 64 components). Repeated rows all count and are all returned; null ids come last among
    the first entries; null labels form one label. An empty table gives an empty result.

    Memory: the codebooks and their sums are all that reaches the driver, 8 x ``entries`` rows
    whatever the input. Nothing is shuffled but these sums and the errors per label.
    """
    spark = vectors.sparkSession
    usable = _usable(vectors.select("vec_id", "embedding", "label"))
    dim = _size(usable)
    whole = usable.where(F.size("embedding") == (dim or 0)).withColumn("x", _whole(F.col("embedding"), reach(dim or PARTS)))
    whole = whole.where("x IS NOT NULL").select("vec_id", "label", "x")
    seeds = np.array(_seeds(whole, entries), np.int64).reshape(-1, PARTS, (dim or PARTS) // PARTS)
    books = np.ascontiguousarray(seeds.transpose(1, 0, 2))
    if not len(seeds):
        books = np.zeros((PARTS, 1, 1), np.int64)  # no row will meet them
    total, state, folder = np.zeros((PARTS, books.shape[1], books.shape[2] + 1), np.int64), whole, None
    for step in range(rounds):
        before, folder = folder, scratch_path(spark, "vector_round")
        state = stage(_pass(state, books, step == 0, False), folder)
        if before:
            discard(spark, before)  # the round after it holds all its rows
        found = (state.where("change IS NOT NULL").select(F.posexplode("change").alias("at", "v"))
                 .groupBy("at").agg(F.sum("v").alias("v")).collect())
        for row in found:
            total.reshape(-1)[row["at"]] += row["v"]
        used = total[:, :, :1] > 0
        books = np.where(used, total[:, :, 1:] // np.maximum(total[:, :, :1], 1), books)
    coded = stage(_pass(state, books, rounds == 0, True), scratch_path(spark, "vector_codes"))
    if folder:
        discard(spark, folder)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    # written, so that Spark knows its size when it decides how to join
    by_label = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")), scratch_path(spark, "label_errors"))
    return (coded.alias("v").join(by_label.alias("l"), F.col("v.label").eqNullSafe(F.col("l.label")))
            .select("v.vec_id", F.lower(F.hex("v.code")).alias("code"), "v.error", "l.label_error",
                    F.lit(digest).alias("codebooks_sha256"), "v.label"))
