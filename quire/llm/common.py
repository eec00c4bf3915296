"""What the training-data operators share: Arrow access to text, word splitting, hashing and cut lineage."""

from __future__ import annotations

import atexit
import os
import tempfile
import time
import uuid
import weakref
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes that part words: space and the five ASCII controls from tab to carriage return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Text bytes that one step of a task works on; a longer document is a step of its own.
STEP_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders made where spark.checkpoint.dir is unset, by application.
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. In local mode, where that is unset, an own one; a cluster
    must have it set, as executors would not see each other's files."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = _OWN.setdefault(spark.sparkContext.applicationId, "")
        if not found:
            found = _OWN[spark.sparkContext.applicationId] = "file://" + tempfile.mkdtemp(prefix="quire-")
    return found.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session may be gone when the interpreter ends
        pass


#: Seconds between two collections of the driver's garbage that settle() asks for, at least, and when the last one was.
TIDY = 2.0
_TIDIED = [0.0]


def tidy(spark: SparkSession) -> None:
    """Have Spark drop the shuffle files of what is done, and the driver its plans and compiled classes. Both wait for the
    driver to collect its garbage, which may be long after; and listeners hold the last plan until they have seen its end."""
    context = spark.sparkContext
    bus = context._jsc.sc().listenerBus()
    bus.waitUntilEmpty()
    # Threads that wait for the next event still hold the last one, which has a plan; this one has none.
    bus.post(context._jvm.org.apache.spark.scheduler.SparkListenerUnpersistRDD(-1))
    bus.waitUntilEmpty()
    context._jvm.System.gc()
    _TIDIED[0] = time.monotonic()


#: Where the tables that settle() wrote are, by the frame that reads each.
_SETTLED: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def settle(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it again, so that lost executors never cost the work before it, and what it
    took to make df need not be kept."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/settled-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    _SETTLED[out] = path
    if time.monotonic() - _TIDIED[0] > TIDY:
        tidy(spark)
    return out


def discard(*frames: DataFrame) -> None:
    """Remove the tables that settle() wrote for these, when nothing will read them again, and tidy()."""
    for df in frames:
        if path := _SETTLED.pop(df, None):
            _remove(df.sparkSession, path)
    if frames:
        tidy(frames[0].sparkSession)


def unused(df: DataFrame, name: str) -> str:
    """A column name like this one that df has not, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows handed to Python at once: whole texts are long, so far fewer than the default."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values one after another, offsets); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = pc.fill_null(column, b"" if binary else "").cast(pa.large_binary() if binary else pa.large_string())
    n = len(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    if data is None or at[0] == at[-1]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def steps(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that each holds at most `limit` bytes of text or one document."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = utf8(batch.column(text))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + limit, "right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of the maximal runs without white space; runs end with their document."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = at[:-1][at[:-1] < at[1:]]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = at[1:][at[:-1] < at[1:]] - 1
    ends[last] = inside[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.repeat(np.arange(len(at) - 1), np.diff(np.searchsorted(starts, at)))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all else as it is."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def word_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as one Arrow array of bytes."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    kept = data[~SPACE[data]] if len(data) else data
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(kept))])


def distinct_words(array: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(number of each word's entry, the distinct words)."""
    coded = pc.dictionary_encode(array)
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


#: One random 64-bit value for each byte value, from a rule.
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_POWERS = np.ones(4096, np.uint64)
np.multiply.accumulate(np.full(4095, _STEP, np.uint64), out=_POWERS[1:])


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        more = np.ones(n * 2, np.uint64)
        np.multiply.accumulate(np.full(n * 2 - 1, _STEP, np.uint64), out=more[1:])
        _POWERS = more
    return _POWERS


def hashed(array: pa.Array) -> np.ndarray:
    """64-bit polynomial hashes of an array of non-empty byte strings."""
    data, at = utf8(array)
    if not len(at) - 1:
        return np.zeros(0, np.uint64)
    lengths = np.diff(at)
    inner = np.arange(len(data), dtype=np.int64) - np.repeat(at[:-1], lengths)
    terms = _BYTE[data] * _powers(int(lengths.max(initial=0)))[inner]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
    return mixed(sums[at[1:]] - sums[at[:-1]] + lengths.astype(np.uint64))


#: The inverses of _POWERS modulo 2^64, and the values of bytes in which A-Z count as lower case.
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_INVERSE = np.ones(1, np.uint64)
_LOWER = _BYTE[lower_ascii(np.arange(256, dtype=np.uint8))]
#: Bytes that word_hashes() sums up at once, about; a longer word is a piece of its own.
PIECE = 1 << 17


def _inverses(n: int) -> np.ndarray:
    global _INVERSE
    if n > len(_INVERSE):
        out = np.ones(n * 2, np.uint64)
        np.multiply.accumulate(np.full(n * 2 - 1, _BACK, np.uint64), out=out[1:])
        _INVERSE = out
    return _INVERSE


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """hashed() of the words between these bounds, with A-Z in lower case: differences of sums over the bytes as they stand."""
    out, k = np.empty(len(starts), np.uint64), 0
    while k < len(starts):
        j = max(k + 1, int(np.searchsorted(ends, starts[k] + PIECE, "right")))
        first, n = starts[k], int(ends[j - 1] - starts[k])
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_LOWER[data[first : first + n]] * _powers(n)[:n], out=sums[1:])
        begin, end = starts[k:j] - first, ends[k:j] - first
        out[k:j] = (sums[end] - sums[begin]) * _inverses(n)[begin] + (end - begin).astype(np.uint64)
        k = j
    return mixed(out)


def crc_of(ids: pa.Array) -> np.ndarray:
    """crc32 of each id written as text; of the empty string for null."""
    return np.fromiter((zlib.crc32(b"" if x is None else str(x).encode()) for x in ids.to_pylist()), np.int64, len(ids))


def vocabulary(name: str, folder: str | None = None) -> str:
    """The path of a public tokenizer's file; folder, or QUIRE_TOKENIZERS, tells another place for them."""
    folder = folder or os.environ.get("QUIRE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=256)
def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a short DDL list; types are spelt as Spark does: long, int, double, string, binary, boolean, array<...>."""
    plain = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}

    def kind(said: str) -> pa.DataType:
        return pa.list_(kind(said[6:-1])) if said.startswith("array<") else plain[said]

    return pa.schema([(name.strip("`"), kind(said)) for name, said in (x.rsplit(" ", 1) for x in ddl.split(", "))])


def batch_of(ddl: str, **columns) -> pa.RecordBatch:
    """A record batch of these columns in the types of ddl."""
    schema = arrow_schema(ddl)
    return pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in schema], schema=schema)
