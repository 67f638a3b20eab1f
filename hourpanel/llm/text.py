"""Shared helpers for operators that read whole texts as Arrow batches inside Spark tasks.

Words are ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 text with A-Z lower-cased, which is exactly what
``bytes.lower().split()`` gives. Word hashes are taken for a whole slice of documents at once, so
the cost per word is a few array operations and no Python object.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourpanel.session import materialise

SLICE_BYTES = 2 << 20  # text handled at once inside a task; one longer document makes its own slice
SHINGLE = 5  # words per shingle

_rng = np.random.default_rng(20240611)
_ODD = np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)[_LOWER]  # upper and lower case share a value
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = _rng.integers(0, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + _ODD
_powers: dict[int, np.ndarray] = {}


def read_documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_bucket(column: str, modulus: int):
    """crc32 of the identifier written as text, modulo ``modulus``; a null identifier counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def map_batches(df: DataFrame, work: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(work, schema)


@contextmanager
def batches_of(spark, limit: int):
    """Jobs started inside hand Python Arrow batches of about ``limit`` bytes, or one longer row."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(limit))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def encoded(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    return [b"" if x is None else x.encode("utf-8", "replace") for x in column.to_pylist()]


def slices(raw: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose text stays below ``limit`` bytes; at least one row each."""
    begin = size = 0
    for i, x in enumerate(raw):
        if i > begin and size + len(x) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(x)
    if begin < len(raw):
        yield begin, len(raw)


def parts(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose text stays below ``limit`` bytes, so that only one slice at a time becomes Python objects."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin = size = 0
    for i, n in enumerate(sizes.tolist()):
        if i > begin and size + n > limit:
            yield batch.slice(begin, i - begin)
            begin, size = i, 0
        size += n
    if begin < batch.num_rows:
        yield batch.slice(begin)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums of hashes become well spread."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _power(base: np.uint64, n: int) -> np.ndarray:
    kept = _powers.get(int(base))
    if kept is None or len(kept) < n:
        full = np.full(max(n, 1), base, np.uint64)
        full[0] = 1
        _powers[int(base)] = kept = np.cumprod(full, dtype=np.uint64)
    return kept[:n]


def word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every document in turn, and where each document's words begin (one more entry at the end)."""
    buffer = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    n = len(buffer)
    inside = np.zeros(n + 1, np.int8)
    inside[1:] = ~_IS_SPACE[buffer]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[buffer] * _power(_BASE, n), out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * _power(_INVERSE, n)[starts])
    offsets = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in raw], out=offsets[1:])
    return hashes, np.searchsorted(starts, offsets)


def combined(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(width), np.uint64)
    for j in range(width):
        total += hashes[j : j + n] * _PLACE[j]
    return mixed(total)


def shingles(hashes: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Distinct word-shingle hashes of each document, sorted. Fewer than five words make one shingle; no words, none."""
    full = combined(hashes, SHINGLE)
    found = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            found.append(np.unique(full[a : b - SHINGLE + 1]))
        elif b > a:
            found.append(combined(hashes[a:b], b - a))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def text_shingles(raw: list[bytes]) -> list[np.ndarray]:
    return shingles(*word_hashes(raw))


def multipliers(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + _ODD, rng.integers(0, 2**63, count, dtype=np.uint64)


def signatures(sets: list[np.ndarray], scale: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """MinHash values (rows: sets, columns: functions) as 32-bit numbers; all ones for an empty set."""
    out = np.full((len(sets), len(scale)), np.uint32(0xFFFFFFFF), np.uint32)
    filled = [i for i, s in enumerate(sets) if len(s)]
    if not filled:
        return out
    flat = np.concatenate([sets[i] for i in filled])
    begin = np.zeros(len(filled), np.int64)
    np.cumsum([len(sets[i]) for i in filled[:-1]], out=begin[1:])
    for k in range(len(scale)):
        value = ((flat * scale[k] + shift[k]) >> np.uint64(32)).astype(np.uint32)
        out[filled, k] = np.minimum.reduceat(value, begin)
    return out


TABLE_BITS = 26  # a key table has 2**26 bits (8 MB), whatever the number of keys


def key_table(keys: DataFrame, column: str = "key") -> np.ndarray:
    """A table of fixed size with a bit for the leading ``TABLE_BITS`` bits of every key: no key is missed, a few others pass.

    Tasks send the non-zero words of the table, so the driver gets 2**20 of them at most.
    """
    slot = F.shiftrightunsigned(F.col(column), 64 - TABLE_BITS)
    words = (
        keys.select(slot.alias("slot"))
        .distinct()
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits"))
        .toArrow()
    )
    table = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return table.view(np.uint8)


def in_table(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys.view(np.uint64) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


PAGE_BITS = 10  # the table as a column: pages of 2**10 words of 64 bits
SPARSE_BITS = 8  # it has 2**8 bits a key or more, until it has ``TABLE_BITS``


def key_pages(keys: DataFrame, column: str = "key") -> tuple[DataFrame, int]:
    """The table of ``key_table`` as one written row (pages array<array<long>>), laid out by tasks: every word stands in it, zeros too;
    and how many leading bits of a key it takes, which few keys need fewer of."""
    width = min(TABLE_BITS, max(6 + PAGE_BITS, (keys.count() << SPARSE_BITS).bit_length()))
    slot = F.shiftrightunsigned(F.col(column), 64 - width)
    words = keys.select(slot.alias("slot")).select(F.shiftright("slot", 6).alias("word"), F.expr("shiftleft(1L, cast(slot % 64 as int))").alias("bits"))
    every = keys.sparkSession.range(1 << (width - 6)).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = every.unionByName(words).groupBy("word").agg(F.bit_or("bits").alias("bits"))

    def in_order(at: str, value: str) -> Column:
        return F.transform(F.sort_array(F.collect_list(F.struct(at, value))), lambda x: x[value])

    pages = words.groupBy(F.shiftright("word", PAGE_BITS).alias("page")).agg(in_order("word", "bits").alias("words"))
    return materialise(pages.agg(in_order("page", "words").alias("pages")), "key_pages"), width


def divided(docs: DataFrame, keys: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` whose ``key`` is surely not among ``keys`` (column key), and the others: those that are, and a few more.

    Rows are told apart by DataFrame operations where they are read, so those of the first part need not be moved.
    """
    pages, width = key_pages(keys)
    slot = F.shiftrightunsigned(key, 64 - width)
    page = F.get(pages.scalar(), F.shiftright(slot, 6 + PAGE_BITS).cast("int"))
    word = F.get(page, F.shiftright(slot, 6).bitwiseAND(F.lit((1 << PAGE_BITS) - 1)).cast("int"))
    among = F.getbit(word, (slot % 64).cast("int")) == 1
    return docs.where(~among), docs.where(among)
