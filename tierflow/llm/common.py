"""Helpers shared by the text operators."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.session import scratch_path
from tierflow.sources.tables import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """The frame as a table in the shared folder: computed once, safe from lost executors.

    Texts travel to Python in smaller batches than by default, as both sides hold a batch whole. Compressed no more than
    the session says: Spark would take the table for smaller than it is in the driver's memory, and broadcast it.
    """
    spark = df.sparkSession
    rows = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, min(1000, int(rows)) if int(rows) > 0 else 1000)
    try:
        return stage(df, folder or scratch_path(spark, name), compression=None)
    finally:
        spark.conf.set(BATCH_ROWS, rows)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids fall in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0)).cast("int")


def fold_of(doc_id: int | None, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds if doc_id is not None else 0


def as_bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``: these six bytes are the white space of ``bytes.split``."""
    return as_bytes(text).split()


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    for multiplier in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x ^= x >> np.uint64(31)
        x *= np.uint64(multiplier)
    return x ^ (x >> np.uint64(32))


ODD = 0x9E3779B97F4A7C15


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as needed."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * len(cls.up), 1 << 16)
            inverse = pow(ODD, -1, 1 << 64)
            factors = np.full((2, size), [[ODD], [inverse]], np.uint64)
            factors[:, 0] = 1
            cls.up, cls.down = np.cumprod(factors, axis=1, dtype=np.uint64)
        return cls.up, cls.down


def running_hash(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(total, down): ``(total[b] - total[a]) * down[a]`` depends on the bytes from a to b only."""
    up, down = Powers.of(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], dtype=np.uint64, out=total[1:])
    return total, down


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and how many words each text has."""
    raw = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)  # a space before and after each
    space = _IS_SPACE[raw]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, end = edges[::2], edges[1::2]
    total, down = running_hash(raw)
    hashes = mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    text_ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    return hashes, np.diff(np.searchsorted(start, text_ends, side="right"), prepend=0)


def packed(values: np.ndarray) -> bytes:
    """Compressed, with equal bytes of all values side by side."""
    return zlib.compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes(), 1)


def unpacked(raw: bytes, kind: type) -> np.ndarray:
    flat = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(flat.T).view(kind).reshape(-1)


def blocks_for(rows: int, per_block: int) -> int:
    return max(1, -(-rows // per_block))


def slices(batches: Iterator, size: int = 400_000) -> Iterator[tuple[list, list[str | None]]]:
    """Ids and texts of Arrow batches, in portions of about ``size`` characters or one text."""
    for batch in batches:
        ids, texts, held = [], [], 0
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                if held and held + len(text or "") > size:
                    yield ids, texts
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(text)
                held += len(text or "")
        if ids:
            yield ids, texts


def parts(batches: Iterator, rows: int = 256) -> Iterator:
    """Arrow batches in portions of some rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def arrow(frame: pd.DataFrame, schema: str):
    """A frame as an Arrow batch of the columns of a schema string, null where it has none."""
    import pyarrow as pa
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32()), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [pa.field(c.split(" ")[0], kinds[c.split(" ")[1]]) for c in schema.split(", ")]
    columns = [pa.array(frame[f.name], f.type, from_pandas=True) if f.name in frame else pa.nulls(len(frame), f.type) for f in fields]
    return pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))


BLOOM_BITS = 1 << 25


def _bloom_bits(values: np.ndarray) -> list[np.ndarray]:
    first = mixed(values.astype(np.int64).view(np.uint64) + np.uint64(ODD))
    return [((first >> np.uint64(shift)) % np.uint64(BLOOM_BITS)).astype(np.int64) for shift in (0, 19, 39)]


def bloom(ids: DataFrame, key: str) -> np.ndarray:
    """A Bloom filter of a column of numbers in ``BLOOM_BITS`` bits (4 MB), built in the cluster.

    Its size is fixed: with more ids it lets more rows pass, never fewer than it must.
    """
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros(BLOOM_BITS // 32, np.uint32)
        for batch in batches:
            for bit in _bloom_bits(batch[key].to_numpy()):
                np.bitwise_or.at(held, bit >> 5, np.uint32(1) << (bit & 31).astype(np.uint32))
        word = np.flatnonzero(held)
        yield pd.DataFrame({"word": word, "bits": held[word].astype(np.int64)})

    words = (ids.select(F.col(key).cast("long").alias(key)).where(F.col(key).isNotNull()).mapInPandas(rows, "word int, bits long")
             .groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas())
    out = np.zeros(BLOOM_BITS // 32, np.uint32)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return out


def maybe_held(held: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each value."""
    hit = np.ones(len(values), bool)
    for bit in _bloom_bits(values):
        hit &= (held[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 == 1
    return hit


def in_bloom(held: np.ndarray, key: str | Column) -> Column:
    """``maybe_held`` of a column; null for null."""
    def test(values: pd.Series) -> pd.Series:
        known = values.notna()
        out = pd.Series([None] * len(values), index=values.index, dtype="object")
        out[known] = maybe_held(held, values[known].to_numpy(np.int64))
        return out

    return F.pandas_udf(test, "boolean")(key)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected graph given as (a, b): smallest node reachable.

    Large-star and small-star steps over distributed edges until nothing changes. Both replace a
    node's edges by edges to its smallest neighbour, so no step makes more edges than it reads,
    and a node with many neighbours is aggregated in the map tasks and joined, never collected.
    Each round is written to the shared folder.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "edges")
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: neighbours above a node point to its smallest neighbour
        large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        # small star: neighbours below a node, and the node, point to the smallest
        large = written(large, "large_star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("x"), "a", "m"))
        stars = (small.select(F.col("x").alias("a"), F.col("m").alias("b"))
                 .unionAll(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        found = written(stars, "stars")
        same = (found.count() == edges.count()
                and found.join(edges, ["a", "b"], "left_anti").isEmpty())
        edges = found
        if same:
            return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
                    .unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
