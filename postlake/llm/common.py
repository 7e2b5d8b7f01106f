"""Arrow text access, packed key lists and written tables for the operators."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from postlake.session import checkpoint_root

#: Words of the contracts: runs without space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
NO_ID = np.int64(2**63 - 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def parts(spark: SparkSession) -> int:
    """The session's number of shuffle partitions; users size it to the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Later stages then read files that outlive any executor, and
    non-deterministic input (row order after a shuffle) is fixed once.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/postlake/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns whose names clash with those an operator adds."""
    lower = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in lower])


def numbered(df: DataFrame, *names: str) -> tuple[DataFrame, list, list]:
    """``df`` with columns in_0, in_1, ..., Columns that give them their names back, and what ``names`` are called now.

    An operator's own columns can't clash with these, whatever the input's are called.
    """
    plain = df.toDF(*[f"in_{k}" for k in range(len(df.columns))])
    lower = [c.lower() for c in df.columns]
    at = [df.columns.index(n) if n in df.columns else lower.index(n.lower()) for n in names]
    return plain, [F.col(f"in_{k}").alias(c) for k, c in enumerate(df.columns)], [f"in_{k}" for k in at]


_FEW = 64


def hot_join(big: DataFrame, small: DataFrame, key: str, total: int) -> DataFrame:
    """``big`` joined to ``small``, which has one row a key with ``_n``, the key's rows in ``big`` of ``total``.

    A key with more than its share of rows is dealt out to as many parts as
    it has shares, and its row of ``small`` goes to each.  There are fewer
    than twice as many such keys as shuffle partitions, so their list is
    broadcast whatever the tables' sizes.  ``_n`` isn't kept.
    """
    share = max(_FEW, total // (2 * parts(big.sparkSession)))
    ways = F.ceil(F.col("_n") / share).cast("int")
    hot = F.broadcast(small.where(F.col("_n") > share).select(key, ways.alias("_ways")))
    spread = (big.join(hot, key, "left").withColumn("_way", F.coalesce(F.pmod(F.xxhash64(*big.columns), "_ways").cast("int"), F.lit(0)))
              .drop("_ways"))
    each = F.explode(F.sequence(F.lit(0), F.when(F.col("_n") > share, ways - 1).otherwise(0)))
    return spread.join(small.withColumn("_way", each).drop("_n"), [key, "_way"]).drop("_way")


def with_fields(schema: StructType, *fields: tuple) -> StructType:
    return StructType([*schema.fields, *[StructField(n, t, True) for n, t in fields]])


def normal_words(text):
    """The words of a text joined by single spaces, as a Column."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), GAP, " "))


# ---------------------------------------------------------------- Arrow text

def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets int64 of n+1, bytes) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    n = len(column)
    if n == 0 or off is None:
        return np.zeros(n + 1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0]:offsets[-1]]


def string_array(offsets: np.ndarray, data: np.ndarray, valid: pa.Array) -> pa.Array:
    """The inverse of ``utf8``; ``valid`` is false where the text was null."""
    mask = pa.array(valid, pa.bool_()).buffers()[1]
    return pa.Array.from_buffers(pa.string(), len(valid), [mask, pa.py_buffer(offsets.astype(np.int32).tobytes()),
                                                           pa.py_buffer(np.ascontiguousarray(data).tobytes())])


def pieces(batch: pa.RecordBatch, text: str, limit: int):
    """Cut a record batch so that a piece holds about ``limit`` text bytes (one row at least)."""
    offsets, _ = utf8(batch.column(text))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unipc(blob: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(blob) as stream:
        return stream.read_next_batch()


# ------------------------------------------------------------- word hashing

def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit words."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_bounds(offsets: np.ndarray, data: np.ndarray):
    """Byte starts, byte ends and document index of every word."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = np.zeros(n + 1, bool)
    first[offsets] = True  # a document's first byte starts a word, whatever stands before it
    before = np.empty(n, bool)
    before[0], before[1:] = False, solid[:-1]
    starts = np.flatnonzero(solid & (~before | first[:n]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, solid[1:]
    ends = np.flatnonzero(solid & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


_powers_kept: list[np.ndarray] = []
_KEEP = 1 << 21  # longer tables of powers, for longer texts, are made anew each time


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if _powers_kept and len(_powers_kept[0]) >= n:
        return _powers_kept
    size, out = 1 << max(16, (n - 1).bit_length()), []
    for base in (_BASE, _INVERSE):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    if size <= _KEEP:
        _powers_kept[:] = out
    return out


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: a polynomial by prefix sums, then mixed with the length."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * down[starts]
    return mix64(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


# --------------------------------------------------------- packed key lists

def pack_keys(keys: np.ndarray, index: np.ndarray) -> bytes:
    """Sorted 64-bit keys and a small index each, as byte planes of their differences.

    Random keys cost about 64 - log2(n) bits each this way.
    """
    step = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)
    index = index.astype(np.uint32).view(np.uint8).reshape(-1, 4)
    named = {f"k{i}": step[:, i] for i in range(8) if i == 0 or step[1:, i].any() or len(step) and step[0, i]}
    named |= {f"i{i}": index[:, i] for i in range(4) if i == 0 or index[:, i].any()}
    return ipc(pa.record_batch({k: pa.array(np.ascontiguousarray(v)) for k, v in named.items()}))


def unpack_keys(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    batch = unipc(blob)
    step, index = np.zeros((batch.num_rows, 8), np.uint8), np.zeros((batch.num_rows, 4), np.uint8)
    for name in batch.schema.names:
        (step if name[0] == "k" else index)[:, int(name[1])] = batch.column(name).to_numpy(zero_copy_only=False)
    return np.cumsum(step.view(np.uint64).ravel()), index.view(np.uint32).ravel()


def block_cuts(keys: np.ndarray, blocks: int) -> np.ndarray:
    """Where each of ``blocks`` equal ranges of the 64-bit key space starts in sorted keys."""
    edges = np.array([(b << 64) // blocks for b in range(1, blocks)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)
