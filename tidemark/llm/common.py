"""Shared pieces: staged tables, segments, and vectorised word hashing over Arrow text columns.

A word is a maximal run of characters other than space and U+0009 to U+000D. These are single bytes in UTF-8,
so the work is done on bytes. Null texts count as empty.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes handled by one vectorised step; a longer document is a step of its own.
STEP_BYTES = 1 << 20

MULT = np.uint64(0x9E3779B97F4A7C15)
MIX1 = np.uint64(0xBF58476D1CE4E5B9)
MIX2 = np.uint64(0x94D049BB133111EB)

#: Native form of "the words of a text": Java's regex class equals the contract's.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
SPACE_PATTERN = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Unset, it is a temporary folder on a local master and an error on any other."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{tempfile.gettempdir()}/checkpoints"
    return found.rstrip("/")


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def fresh_dir(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    at, fs = _path(spark, path)
    fs.mkdirs(at)
    fs.deleteOnExit(at)
    return path


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends at replicated files. They go with unstage, or with the driver's JVM."""
    path = fresh_dir(df.sparkSession, tag)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def staged_buckets(df: DataFrame, tag: str, key: str, buckets: int) -> DataFrame:
    """As staged, dealt by a hash of `key` to buckets as it is written, without a shuffle; a later grouping by `key` needs none either."""
    spark, path, name = df.sparkSession, fresh_dir(df.sparkSession, tag), f"{tag.replace('-', '_')}_{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").option("path", path).bucketBy(max(1, min(buckets, 100_000)), key).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"drop table {name}")  # the files stay
    out.staged_at = path
    return out


def unstage(*dfs: DataFrame) -> None:
    """Delete the files of staged tables that nothing will read again."""
    for df in dfs:
        at, fs = _path(df.sparkSession, df.staged_at)
        fs.delete(at, True)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def shares(total: int, each: int, least: int, most: int) -> int:
    """A power of two of parts of about `each`, that follows the input and not the cluster."""
    return 1 << (min(most, max(least, total // each)) - 1).bit_length()


#: Keys that hot_join broadcasts at most, and the rows from which a key is hot at least.
HOT_KEYS, HOT_ROWS = 10_000, 200


def hot_join(rows: DataFrame, keyed: DataFrame, keys: list[str], count: str = "__n", floor: int = HOT_ROWS, most: int = HOT_KEYS) -> DataFrame:
    """rows joined (inner) with keyed, which has one row for each key and in `count` at least the number of rows that hold it.

    Keys of over max(floor, all / most) rows are `most` at most, and are broadcast, so that none of them meets in one task; the others
    are shuffled as usual. Both sides are read twice: pass staged tables.
    """
    total, largest = (x or 0 for x in keyed.agg(F.sum(count), F.max(count)).first())
    limit = max(floor, total // most)
    if largest <= limit:
        return rows.join(keyed.drop(count), keys)
    hot = F.col(count) > limit
    few = keyed.where(hot).drop(count)
    plain = rows.join(F.broadcast(few.select(*keys)), keys, "left_anti").join(keyed.where(~hot).drop(count), keys)
    return plain.unionByName(rows.join(F.broadcast(few), keys))


def fnv_free_mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    h = (h ^ (h >> np.uint64(30))) * MIX1
    h = (h ^ (h >> np.uint64(27))) * MIX2
    return h ^ (h >> np.uint64(31))


def inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inv = base | 1, inverse(base | 1)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            grow = lambda b: np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, b, np.uint64))])
            self.up, self.down = grow(np.uint64(self.base)), grow(np.uint64(self.inv))
        return self.up[:n], self.down[:n]


_BYTE_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_WORD_BASES = (0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)
_powers: dict[int, Powers] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers.setdefault(base, Powers(base)).get(n)


SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def steps(off: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, "right")) - 1)
        yield a, b
        a = b


class Words:
    """The words of some documents laid end to end: byte spans, and the first word of each document."""

    def __init__(self, data: np.ndarray, off: np.ndarray, lower: bool = False):
        self.data, n = LOWER[data] if lower else data, len(data)
        space = SPACES[data]
        edge = np.ones(n + 1, bool)
        edge[1:] = False
        edge[off[:-1]] = True
        edge = edge[:n]
        before, after = edge.copy(), np.zeros(n, bool)
        before[1:] |= space[:-1]
        if n:
            after[:-1] = space[1:] | edge[1:]
            after[-1] = True
        self.start = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(~space & after) + 1
        self.first = np.searchsorted(self.start, off)  # len(off) entries: word ranges of documents
        self.doc = np.repeat(np.arange(len(off) - 1), np.diff(self.first))

    def hashes(self, which: int = 0) -> np.ndarray:
        """A hash of each word. Words are taken in runs of about STEP_BYTES, so that running sums don't grow with the text."""
        out, a, n = np.empty(len(self.start), np.uint64), 0, len(self.start)
        while a < n:
            lo = self.start[a]
            b = max(a + 1, int(np.searchsorted(self.start, lo + STEP_BYTES)))
            size = int(self.end[b - 1] - lo)
            up, down = powers(_BYTE_BASES[which], size + 1)
            run = np.zeros(size + 1, np.uint64)
            np.cumsum((self.data[lo : lo + size].astype(np.uint64) + np.uint64(1)) * up[:size], out=run[1:])
            out[a:b] = fnv_free_mix((run[self.end[a:b] - lo] - run[self.start[a:b] - lo]) * down[self.start[a:b] - lo])
            a = b
        return out

    def grams(self, h: np.ndarray, k: int, which: int = 0) -> np.ndarray:
        """Hashes of the k-word sequences starting at each word; those crossing a document's end are meaningless."""
        n = len(h)
        up, down = powers(_WORD_BASES[which], n + 1)
        run = np.zeros(n + 1, np.uint64)
        np.cumsum(h * up[:n], out=run[1:])
        m = max(0, n - k + 1)
        return fnv_free_mix((run[k : k + m] - run[:m]) * down[:m])

    def inside(self, k: int) -> np.ndarray:
        """Which k-word sequences lie in one document."""
        m = max(0, len(self.start) - k + 1)
        return self.doc[:m] == self.doc[k - 1 : k - 1 + m]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, by doubling."""
    done = 1
    while done < w:
        step = min(done, w - done)
        x = np.minimum(x[: len(x) - step], x[step:])
        done += step
    return x


def sliding_max(x: np.ndarray, w: int) -> np.ndarray:
    done = 1
    while done < w:
        step = min(done, w - done)
        x = np.maximum(x[: len(x) - step], x[step:])
        done += step
    return x


def by_segment(seg: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(segment, bytes of each column) of rows dealt by segment, each segment once."""
    order = np.argsort(seg, kind="stable")
    seg = seg[order]
    columns = [c[order] for c in columns]
    cuts = np.flatnonzero(np.diff(seg)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(seg)], strict=True):
        if b > a:
            yield (int(seg[a]), *(c[a:b].tobytes() for c in columns))


def packed(rows: Iterator[tuple], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    hold: list[tuple] = []
    for row in rows:
        hold.append(row)
        if len(hold) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*hold, strict=True), schema.types, strict=True)], schema=schema)
            hold = []
    if hold:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*hold, strict=True), schema.types, strict=True)], schema=schema)


def unpack(column: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def packed_row(docs: DataFrame) -> DataFrame:
    """docs as one struct column `row`: no helper column can meet one of its names."""
    return docs.select(F.struct("*").alias("row"))


def unpacked_row(df: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The named columns of `row`, then the new ones, which replace those of the same name."""
    both = df.select("row", F.struct(*[v.alias(k) for k, v in new.items()]).alias("new"))  # at the top no alias that an expression could mean
    return both.select(*[F.col("row").getField(c).alias(c) for c in columns if c not in new], *[F.col("new").getField(k).alias(k) for k in new])


def text_key(text: Column) -> list[Column]:
    """128 bits that tell texts apart."""
    return [F.xxhash64(text).alias("c1"), F.xxhash64(F.lit("b"), text).alias("c2")]


def let(x: Column, f) -> Column:
    """f(x) with x computed once, wherever the optimiser may copy the expression to."""
    return F.get(F.transform(F.array(x), f), 0)


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of an id as text, modulo; null ids go to remainder -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus, F.lit(-1))
