"""Shared helpers of the llm operators: scratch tables, whole-text Arrow
passes, vectorised word hashing and a distributed gapless rank."""

from __future__ import annotations

import ctypes
import functools
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crowdscope.session import scratch_path

#: Text bytes handled by one vectorised step inside a task.
SLICE_BYTES = 1 << 19
#: Bytes of an Arrow batch between Spark and a Python worker, where the session sets none.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: cuts the
    lineage, and a lost executor never repeats the work behind it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Let the session bound Arrow batches by bytes, not by rows alone, so that
    what a task holds doesn't grow with the length of texts. A session that
    sets a bound of its own keeps it."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_column(df: DataFrame, column: str = "text") -> Column:
    return df[column].cast("string")


def utf8_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the row offsets into them. Null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    arr = arr.cast(pa.large_string())
    n = len(arr)
    _, off, data = arr.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64, n + 1, arr.offset * 8)
    base, end = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(data, np.uint8, end - base, base) if end > base else np.zeros(0, np.uint8)
    return raw, offsets - base


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES, rows: int | None = None) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes, and at most ``rows`` rows, each; a
    longer row is a range by itself."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        j = j if rows is None else min(j, i + rows)
        yield i, j
        i = j


def text_parts(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and row offsets of parts of about ``limit`` bytes. A
    longer row comes in several parts, cut after a byte that ``inside`` (256
    flags) calls no part of a word; only a longer word makes a longer part."""
    for lo, hi in row_slices(offsets, limit):
        at, end = int(offsets[lo]), int(offsets[hi])
        if end - at <= limit or hi - lo > 1:
            yield lo, raw[at:end], offsets[lo:hi + 1] - at
            continue
        while at < end:
            cut = min(end, at + limit)
            while cut < end and inside[raw[cut - 1]]:
                ahead = np.flatnonzero(~inside[raw[cut:min(end, cut + 65536)]])
                cut = cut + int(ahead[0]) + 1 if len(ahead) else min(end, cut + 65536)
            yield lo, raw[at:cut], np.array([0, cut - at], np.int64)
            at = cut


def hash_below(key: Column, salt: str, rows: int, n: int) -> Column:
    """Whether a key is one of about ``rows`` of ``n``, by 63 bits of its hash."""
    bound = (1 << 63) - 1 if n <= rows else rows * (1 << 63) // n
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(salt)), 1) < F.lit(bound).cast("long")


def annotate(df: DataFrame, name: str, fields: T.StructType, make: Callable, keep: list[str] | None = None,
             text: str = "text") -> tuple[DataFrame, str]:
    """Append one struct column computed from the whole text of every row.

    ``make()`` is called once a task and returns a function from (bytes, row
    offsets, null mask, batch) to one Arrow array for each field. ``keep``
    names the input columns to carry along (all by default). The new column's
    name never clashes with an input column; the name used is returned too.
    """
    keep = df.columns if keep is None else keep
    name = free_name(df, name)
    hidden = free_name(df, "text__")
    types = [T.StructField(c, df.schema[c].dataType, True) for c in keep]
    src = df.select(*[F.col(f"`{c}`") for c in keep], text_column(df, f"`{text}`").alias(hidden))
    out = T.StructType([*types, T.StructField(name, fields, True)])
    n_keep, names = len(keep), fields.names

    def run(batches):
        step = make()
        give_back()
        for batch in batches:
            col = batch.column(n_keep)
            raw, offsets = utf8_buffers(col)
            nulls = np.asarray(col.is_null())
            arrays = step(raw, offsets, nulls, batch)
            made = pa.StructArray.from_arrays(arrays, names=names)
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_keep], made], names=[*batch.schema.names[:n_keep], name])
        give_back()

    bound_batches(df.sparkSession)
    return src.mapInArrow(run, out), name


def ship(spark: SparkSession, model) -> Broadcast:
    """Broadcast a model of bounded size as bytes, its class included, so that
    executors need no copy of this package; ``pickle.loads`` gives it back."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def held(key: str, build: Callable):
    """What ``build`` makes, kept by the Python worker for its next tasks. Only
    one object is kept: a stage that holds its own frees that of the stage before."""
    kept = sys.modules.setdefault("_llm_held", types.ModuleType("_llm_held")).__dict__
    if kept.get("key") != key:
        kept["key"] = kept["made"] = None
        kept["made"] = build()
        kept["key"] = key
    return kept["made"]


def give_back() -> None:
    """Return freed memory of this Python process to the machine: a worker lives
    on through later stages beside others, and allocators keep what it freed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable) -> Callable:
    """A pass over Arrow batches that holds no model: what the worker keeps for
    an earlier stage goes before it, and its own freed memory after it."""

    @functools.wraps(run)
    def passed(batches):
        held("", lambda: None)
        give_back()
        yield from run(batches)
        give_back()

    return passed


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class WordHasher:
    """Hashes of all words of a slice of texts, vectorised.

    A word is a run of ASCII letters, digits and non-ASCII bytes; A-Z count as
    a-z. A word's hash is a polynomial in its bytes modulo 2**64, taken from
    one running sum over the slice, then mixed.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        fold = np.zeros(256, np.uint8)
        for c in range(256):
            if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128:
                fold[c] = c
            elif 65 <= c <= 90:
                fold[c] = c + 32
        self.fold = fold
        self.inverse = pow(self.BASE, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        while len(self.up) < n:
            m = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.BASE, m, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, m, 1 << 64))])

    def __call__(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word hashes, first word of each row (one entry more than rows), and
        each word's first byte and the byte after its last."""
        n = len(raw)
        rows = len(offsets) - 1
        if n == 0:
            z = np.zeros(0, np.int64)
            return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64), z, z
        self._powers(n + 1)
        folded = self.fold[raw]
        inside = folded != 0
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        stop = inside.copy()
        stop[:-1] &= ~inside[1:]
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        begin[cut] = inside[cut]
        stop[cut - 1] = inside[cut - 1]
        first, last = np.flatnonzero(begin), np.flatnonzero(stop)
        total = np.cumsum(folded.astype(np.uint64) * self.up[:n], dtype=np.uint64)
        before = np.zeros(len(first), np.uint64)
        some = first > 0
        before[some] = total[first[some] - 1]
        hashes = mix64((total[last] - before) * self.down[first])
        return hashes, np.searchsorted(first, offsets), first, last + 1


def shingle_hashes(words: np.ndarray, word_rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within a row, and row offsets. A row
    of fewer words, but not none, is one shingle."""
    counts = np.diff(word_rows)
    n_shingles = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    offsets = np.concatenate([[0], np.cumsum(n_shingles)]).astype(np.int64)
    if offsets[-1] == 0:
        return np.zeros(0, np.uint64), offsets
    start = np.arange(offsets[-1]) - np.repeat(offsets[:-1], n_shingles) + np.repeat(word_rows[:-1], n_shingles)
    end = np.repeat(word_rows[1:], n_shingles)
    out = np.zeros(len(start), np.uint64)
    for k in range(size):
        at = start + k
        has = at < end
        part = words[np.minimum(at, len(words) - 1)]
        out = np.where(has, mix64(out * np.uint64(0xD6E8FEB86659FD93) + part), out)
    return out, offsets


#: Rows that one rank bucket holds on average.
RANK_BUCKET = 50_000


def gapless_rank(df: DataFrame, key: str, spread: Column, order: list[Column], name: str) -> DataFrame:
    """Number the rows of each ``key`` from 0 without gaps, in a scale-out way.

    A key's rows are dealt over hash buckets of about ``RANK_BUCKET`` rows, so
    a key with a third of all rows is no single task; bucket sizes give each
    bucket its first number. ``df`` must be a landed table (it is read twice).
    """
    buckets = max(1, -(-df.count() // RANK_BUCKET))
    dealt = df.withColumn("_bucket", F.pmod(spread, F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(key, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy(key, "_bucket").orderBy(*order)
    numbered = dealt.withColumn("_row", F.row_number().over(inside) - 1)
    return (numbered.join(firsts, [key, "_bucket"])
            .withColumn(name, (F.col("_first") + F.col("_row")).cast("long")).drop("_bucket", "_first", "_row"))
