"""Shared helpers: scratch tables, bounded id filters, and numpy text kernels.

The numpy kernels work on slices of at most ``SLICE_BYTES`` of text (one longer
document is a slice of its own), so a task's memory does not depend on how many
rows an Arrow batch holds.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeledger.session import scratch_dir
from lakeledger.sources.tables import _FS

SLICE_BYTES = 1 << 20
#: Sorts after every real id: rows without an id are "later" than all others.
NO_ID = (1 << 63) - 1
#: Bits of the id filter: 8 Mi bits, 1 MiB, whatever the size of the input.
FILTER_BITS = 23


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(columns: list[str], stem: str = "_text") -> str:
    """A column name that is not taken (names match without case)."""
    taken = {c.lower() for c in columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


#: Scratch tables written by this process, oldest first; ``drop_scratch`` removes them.
SCRATCH: list[str] = []


def drop_scratch(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Remove the scratch tables from number ``since`` on, but for the last ``keep``. Results that
    still read them must have been written before."""
    for path in SCRATCH[since:len(SCRATCH) - keep]:
        _FS(spark, path).delete(path)
    del SCRATCH[since:len(SCRATCH) - keep]


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the lineage is
    cut, a lost executor loses nothing, and both sides of a later join are plain
    shuffles that adaptive execution can split."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    SCRATCH.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_sample(rows: DataFrame, per_group: int, by: str, *ids: str) -> DataFrame:
    """At most ``per_group`` rows of each value of ``by``: those with the smallest hashes of ``ids``. The values are few
    (languages, labels). Group sizes are counted first, and a hash threshold lets about twice the wanted rows
    through, so no task sorts a whole group."""
    unit = 1 << 40
    place = F.pmod(F.xxhash64(*ids), F.lit(unit))
    sizes = rows.groupBy(by).agg(F.count("*").alias("_size"))
    near = (rows.join(F.broadcast(sizes), by)
            .filter(place < F.lit(2.0 * per_group * unit) / F.col("_size")).withColumn("_place", place))
    order = Window.partitionBy(by).orderBy("_place", *ids)
    return (near.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= per_group)
            .drop("_size", "_place", "_rank"))


# --- bounded id filter -----------------------------------------------------------


def id_filter(ids: DataFrame, *cols: str, bits: int = FILTER_BITS) -> DataFrame:
    """A bitmap of hashed ids as rows (word, mask): at most 2**bits / 64 rows of
    16 bytes (2 MB), so broadcasting it is safe at any input size. It has false
    positives, never false negatives; a full bitmap only filters nothing."""
    slot = F.pmod(F.xxhash64(*cols), F.lit(1 << bits))
    return (ids.select(F.shiftright(slot, 6).alias("_word"),
                       F.expr(f"shiftleft(1L, cast(pmod(xxhash64({', '.join(cols)}), {1 << bits}L) % 64 as int))").alias("_mask"))
            .groupBy("_word").agg(F.bit_or("_mask").alias("_mask")))


def filter_by(df: DataFrame, bitmap: DataFrame, *cols: str, how: str = "left_semi",
              bits: int = FILTER_BITS) -> DataFrame:
    """Rows whose id may be in the bitmap (``left_semi``) or surely is not (``left_anti``)."""
    slot = f"pmod(xxhash64({', '.join(cols)}), {1 << bits}L)"
    cond = F.expr(f"_word = shiftright({slot}, 6) AND (_mask & shiftleft(1L, cast({slot} % 64 as int))) != 0L")
    return df.join(F.broadcast(bitmap), cond, how)


# --- numpy kernels -----------------------------------------------------------------

_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240917))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
_INV = _U(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (or of the inverse base), cached."""
    name = "inv" if inverse else "pow"
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, _INV if inverse else _BASE, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * SLICE_BYTES:
            _POWERS[name] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of value * base**position modulo 2**64. Differences tell short grams apart; over long ranges this sum alone
    can be made to collide (any odd base, Thue-Morse texts), see ``range_hash``."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values)), out=out[1:])
    return out


#: A prime, and a primitive root of it: no power of the root by a power of two is 1, so texts built by doubling do not cancel.
_PRIME, _ROOT = (1 << 31) - 1, 48271
_ROOTS: dict[int, np.ndarray] = {}


def prime_powers(n: int, inverse: bool = False) -> np.ndarray:
    """root**0 .. root**(n-1) modulo the prime (or of the inverse root), cached."""
    base = pow(_ROOT, -1, _PRIME) if inverse else _ROOT
    have = _ROOTS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.ones(size, np.uint64)
        k = 1
        while k < size:
            m = min(k, size - k)
            have[k:k + m] = have[:m] * _U(pow(base, k, _PRIME)) % _U(_PRIME)
            k += m
        if size <= 4 * SLICE_BYTES:
            _ROOTS[base] = have
    return have[:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Two rows of prefix sums: modulo 2**64, and of the values' upper 31 bits times powers modulo a prime (terms
    below 2**32, reduced when a range is taken); see ``range_hash``."""
    out = np.zeros((2, len(values) + 1), np.uint64)
    np.cumsum(values * powers(len(values)), out=out[0, 1:])
    term = (values >> _U(33)) * prime_powers(len(values))
    np.cumsum((term & _U(_PRIME)) + (term >> _U(31)), out=out[1, 1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for every pair; equal ranges hash equally wherever they stand, and the length takes part. The sums
    modulo 2**64 and modulo the prime have nothing in common that a text could be built on."""
    n = prefix.shape[1]
    x = (prefix[0, end] - prefix[0, start]) * powers(n, inverse=True)[start]
    y = (prefix[1, end] - prefix[1, start]) % _U(_PRIME) * prime_powers(n, inverse=True)[start] % _U(_PRIME)
    return mix(mix(x + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93)) + y * _U(0x9FB21C651E98DF25))


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


def window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values (two running minima per block)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, values.dtype)
    pad = -len(values) % width
    full = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, width)
    left = np.minimum.accumulate(full, axis=1).ravel()
    right = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def give_back() -> None:
    """Return freed memory to the system, so that a worker process that is used again does not keep the most
    that any task of it has held."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def text_slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row count, bytes, offsets) of consecutive rows of a string
    column, cut so that a slice holds about ``SLICE_BYTES``; null is empty."""
    col = batch.column(batch.schema.get_field_index(column))
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(col):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
        to = min(to, len(col))
        yield at, to - at, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to
    give_back()


def word_bounds(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE):
    """Starts and ends of the words of every row and the first word number of
    each row (length rows + 1). Words never cross rows."""
    n = len(data)
    is_word = ~space[data]
    start_mark = is_word.copy()
    start_mark[1:] &= ~is_word[:-1]
    end_mark = np.zeros(n + 1, bool)
    end_mark[1:n + 1] = is_word
    end_mark[1:n] &= ~is_word[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    both = cuts[is_word[cuts] & is_word[cuts - 1]]  # a word on each side of a row's edge
    start_mark[both] = True
    end_mark[both] = True
    starts, ends = np.flatnonzero(start_mark), np.flatnonzero(end_mark)
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hash(prefix_hash(byte_values(data)), starts, ends)


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def merge_runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open ranges: overlapping or touching ones become one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], s[1:] > e[:-1]])
    return s[first], e[np.concatenate([np.flatnonzero(first)[1:] - 1, [len(s) - 1]])]


def share(spark: SparkSession, value):
    """Broadcast an object of bounded size. Returns a function that gives it on the executors, where it is
    made once for each worker process."""
    import pickle

    from pyspark import cloudpickle

    held = spark.sparkContext.broadcast({"bytes": cloudpickle.dumps(value)})

    def get():
        box = held.value
        if "object" not in box:
            box["object"] = pickle.loads(box["bytes"])
        return box["object"]
    return get


def without(df: DataFrame, rows: DataFrame, col: str, text_col: str = "text") -> DataFrame:
    """Rows whose id and text are not among ``rows`` (a column of the same name, and text_hash); rows that a bounded
    bitmap rules out do not move. A null id is an id like others."""
    gone = materialise(rows.select(F.col(col).alias("_gone"), F.col("text_hash").alias("_hash")).distinct(), "gone")
    bitmap = materialise(id_filter(gone, "_gone", "_hash"), "gone-bitmap")
    key = (f"`{col}`", f"xxhash64(`{text_col}`)")
    maybe = filter_by(df, bitmap, *key).join(gone, F.col(col).eqNullSafe(F.col("_gone")) & (F.xxhash64(text_col) == F.col("_hash")), "left_anti")
    return filter_by(df, bitmap, *key, how="left_anti").unionByName(maybe)
