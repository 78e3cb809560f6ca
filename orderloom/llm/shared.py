"""What several operators use: hand-over tables, row keys, hashing of word sequences.

Words are the runs of bytes between the six ASCII blanks 0x20 and 0x09-0x0D.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import shared_folder

#: Odd multipliers of the rolling hashes (fixed values, any odd 64-bit numbers do).
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xC2B2AE3D27D4EB4F
TWIN_BASE = 0xD6E8FEB86659FD93

NULL_ID = -(1 << 63)

#: Texts hashed together: enough bytes to amortise a numpy call, few enough to stay in cache.
BLOCK_BYTES = 1 << 20

#: Bytes of an Arrow batch, beyond its last row.
BATCH_BYTES = 4 << 20

#: Row keys (8 bytes each) that may be broadcast.
BROADCAST_ROWS = 500_000

_blank = np.zeros(256, dtype=bool)
_blank[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[int, np.ndarray] = {}


def prepare(spark: SparkSession) -> None:
    """What the operators ask of a session.

    Python workers find this package where the driver found it, if it is not installed; and
    batches sent to them are bounded by bytes, since a row may hold any length of text.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def frugal(run):
    """A mapInPandas function that returns its freed memory to the system when a task ends: idle
    workers outlive their stage, and several of them share an executor's memory."""

    def wrapped(batches):
        yield from run(batches)
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def handover(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here, and a lost
    executor costs no recomputation beyond it.

    The tables lie under `<spark.checkpoint.dir>/orderloom-llm/<application id>` and may be
    removed once the application has ended.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/orderloom-llm/{spark.sparkContext.applicationId}"
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(docs: DataFrame) -> Column:
    """The text, null as empty."""
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty) and row_key, a 64-bit hash of both.

    Rows equal in id and text share a key: operators treat them as one document and give each
    of them its result. Other columns are left behind, so their names cannot clash.
    """
    text = text_of(docs)
    doc_id = docs["doc_id"].cast("long")
    return docs.select(
        doc_id.alias("doc_id"), text.alias("text"), F.xxhash64(doc_id, text).alias("row_key")
    )


def for_python(doc_id: Column) -> Column:
    """The id with the least 64-bit number for null: pandas keeps exact integers only without
    nulls. from_python undoes it."""
    return F.coalesce(doc_id.cast("long"), F.lit(NULL_ID)).alias("doc_id")


def from_python(doc_id: str | Column) -> Column:
    return F.nullif(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit(NULL_ID)).alias("doc_id")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of docs, with all columns, whose row key is not among keys(row_key).

    The keys are written and counted: up to BROADCAST_ROWS of them are broadcast, more are joined
    by shuffle.
    """
    keys = handover(keys.select("row_key").distinct(), "row-keys")
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    key = fresh(docs, "row_key")
    rows = docs.withColumn(key, F.xxhash64(docs["doc_id"].cast("long"), text_of(docs)))
    return rows.join(keys.withColumnRenamed("row_key", key), key, "left_anti").select(*docs.columns)


def crc_fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo the given number; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def powers(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < count:
        have = np.full(max(count, BLOCK_BYTES + 1), base, dtype=np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        _powers[base] = have
    return have[:count]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[start:end] for each pair, equal for equal runs wherever they lie."""
    power = powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * power[:-1], out=total[1:])
    inverse = powers(pow(base, -1, 1 << 64), len(values) + 1)
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes as an array, and start and end of each word."""
    data = np.frombuffer(raw, dtype=np.uint8)
    solid = np.zeros(len(data) + 2, dtype=np.int8)
    solid[1:-1] = ~_blank[data]
    edge = np.diff(solid)
    return data, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about BLOCK_BYTES together; a longer text stands alone."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > BLOCK_BYTES:
            yield begin, i
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts one after another, and where each text's words begin
    (one entry more than texts)."""
    data, starts, ends = word_bounds(b"\n".join(texts))
    values = data.astype(np.uint64) + np.uint64(1)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    text_starts = np.concatenate(([0], np.cumsum(lengths)))
    return runs(values, starts, ends, BYTE_BASE), np.searchsorted(starts, text_starts)


def windows(words: np.ndarray, width: int, base: int = WORD_BASE) -> np.ndarray:
    """Hash of each run of `width` words; none if there are fewer."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    starts = np.arange(count)
    return runs(words, starts, starts + width, base)


# --- hashes that decide what is equal ---------------------------------------------------------

#: Modulus of the sequence hashes below, a prime: over a field, sequences of a few repeated values
#: do not cancel out as they do modulo a power of two.
PRIME = (1 << 61) - 1
_P = np.uint64(PRIME)
_prime_powers: dict[int, np.ndarray] = {}


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> np.uint64(61))
    return np.where(x >= _P, x - _P, x)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, both below it."""
    a_high, a_low = a >> np.uint64(31), a & np.uint64((1 << 31) - 1)
    b_high, b_low = b >> np.uint64(31), b & np.uint64((1 << 31) - 1)
    middle = a_high * b_low + a_low * b_high
    # 2**62 is 2, and 2**61 is 1, modulo the prime.
    high = a_high * b_high * np.uint64(2) + (middle >> np.uint64(30))
    return _reduced(high + ((middle & np.uint64((1 << 30) - 1)) << np.uint64(31)) + a_low * b_low)


def prime_powers(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count-1) modulo PRIME."""
    have = _prime_powers.get(base)
    if have is None:
        have = np.ones(1, dtype=np.uint64)
    while len(have) < count:
        step = np.uint64(pow(base, len(have), PRIME))
        have = np.concatenate((have, product(have, step)))
    _prime_powers[base] = have
    return have[:count]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two independent hashes (the halves of XXH3-128) of all words of the texts one after
    another, and where each text's words begin (one entry more than texts)."""
    split = [text.split() for text in texts]
    digests = b"".join([xxhash.xxh3_128_digest(word) for words in split for word in words])
    halves = np.frombuffer(digests, dtype="<u8").reshape(-1, 2)
    begin = np.concatenate(([0], np.cumsum([len(words) for words in split], dtype=np.int64)))
    return np.ascontiguousarray(halves[:, 0]), np.ascontiguousarray(halves[:, 1]), begin


class Sequences:
    """Hashes of runs of values, equal for equal runs wherever they lie."""

    def __init__(self, values: np.ndarray, base: int):
        self.base = base % PRIME
        parts = product(_reduced(values), prime_powers(self.base, len(values)))
        low = np.cumsum(parts & np.uint64((1 << 32) - 1))
        high = np.cumsum(parts >> np.uint64(32))
        total = _reduced(_reduced(low) + product(_reduced(high), np.uint64(1 << 32)))
        self.total = np.concatenate((np.zeros(1, dtype=np.uint64), total))

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Sums of the runs, moved to the origin; below PRIME."""
        inverse = prime_powers(pow(self.base, -1, PRIME), len(self.total))
        return product(_reduced(self.total[ends] + _P - self.total[starts]), inverse[starts])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for each pair."""
        return mix(self.between(starts, ends) + (ends - starts).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """Hash of each run of `width` values; none if there are fewer."""
        starts = np.arange(max(0, len(self.total) - width))
        return self.runs(starts, starts + width)

    def without_one(self) -> np.ndarray:
        """Hash of all values but one, for each of them."""
        size = len(self.total) - 1
        before, after = self.total[:-1], _reduced(self.total[-1] + _P - self.total[1:])
        inverse = np.uint64(pow(self.base, -1, PRIME))
        return mix(_reduced(before + product(after, inverse)) + np.uint64(size - 1))
