"""Token identifiers as Parquet list columns, in ascending order of documents.

Documents are dealt by ranges of their identifier and encoded in order. A row holds a document, or one of the
``CHUNK``-token pieces of a longer one: ``doc_id, part, ordinal, chunk, first, n_tokens, ids``. Identifiers of
tokens are dictionary coded; the ascending number columns are delta coded; row groups and pages have a
stated size, and the page index lets a reader of few documents or of a token range skip the other pages. ``first`` and
``ordinal`` count within a file, so that files are written independently; a manifest with one row a file, made
from the number columns alone, turns them into positions in the whole corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourpanel.llm.pieces import ByteLevel, IdTable, gathered, pieces_of
from hourpanel.llm.text import map_batches, parts
from hourpanel.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END = 0  # written after every document
CHUNK = 1 << 16  # tokens of a row at most
ROW_GROUP = 16 << 20  # bytes
PAGE = 256 << 10  # bytes
SLICE_BYTES = 8 << 20  # text encoded at once

_ROW = "doc_id long, part int, ordinal long, chunk int, first long, n_tokens long, ids array<int>"
_NUMBERS = ("doc_id", "part", "ordinal", "chunk", "first", "n_tokens")
_coders: dict[str, IdTable] = {}


def coder(path: str) -> IdTable:
    """The tokenizer of a file, loaded once in a worker, as a function from pieces to identifiers."""
    if path not in _coders:
        _coders[path] = IdTable(ByteLevel(path))
    return _coders[path]


def _encode(path: str, end: int, chunk: int):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = coder(path), TaskContext.get().partitionId()
        first = ordinal = 0
        for batch in batches:
            for rows in parts(batch, limit=SLICE_BYTES):
                distinct, codes, bounds = pieces_of(rows.column("text"), spaced=False)
                plain, cuts = gathered(*encode(distinct), codes, bounds)
                ids = np.insert(plain, cuts[1:], end).astype(np.int32)
                edges = cuts + np.arange(len(cuts))  # each document is one longer
                sizes = np.diff(edges)
                pieces = -(-sizes // chunk)  # at least one, as a document has its end
                owner = np.repeat(np.arange(len(sizes)), pieces)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                begin = edges[:-1][owner] + number * chunk
                lists = pa.ListArray.from_arrays(pa.array(np.append(begin, edges[-1]).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id").take(pa.array(owner)), pa.array(np.full(len(owner), part, np.int32)), pa.array(ordinal + owner), pa.array(number.astype(np.int32)),
                        pa.array(first + begin), pa.array(sizes[owner]), lists,
                    ],
                    [*_NUMBERS, "ids"],
                )
                first, ordinal = first + int(edges[-1]), ordinal + len(sizes)

    return work


@dataclass(frozen=True)
class TokenTable:
    """A written table of tokens: ``rows`` has the columns of a file, ``manifest`` one row (part, base, tokens) a file."""

    rows: DataFrame
    manifest: DataFrame

    def placed(self) -> DataFrame:
        """The rows with ``start``, the position of their first token in the whole corpus. Files hold few numbers in the manifest."""
        return self.rows.join(self.manifest.select("part", "base"), "part").withColumn("start", F.col("base") + F.col("first")).drop("base")

    def documents(self) -> DataFrame:
        """doc_id, start, n_tokens of every document, from the number columns alone."""
        return self.placed().where("chunk = 0").select("doc_id", "start", "n_tokens")

    def between(self, start: int, stop: int) -> DataFrame:
        """(position, id) of the tokens from ``start`` to before ``stop``: the manifest names the files, the page index the pages."""
        files = self.manifest.where((F.col("base") < stop) & (F.col("base") + F.col("tokens") > start)).select("part", "base")
        rows = self.rows.where(F.col("part").isin([r.part for r in files.collect()])).join(files, "part").withColumn("at", F.col("base") + F.col("first"))
        rows = rows.where((F.col("at") < stop) & (F.col("at") + F.size("ids") > start))
        each = rows.select("at", F.posexplode("ids").alias("i", "id")).select((F.col("at") + F.col("i")).alias("position"), "id")
        return each.where(F.col("position").between(start, stop - 1))


def write_tokens(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end: int = END, chunk: int = CHUNK) -> TokenTable:
    """Encode ``docs`` (doc_id, text; others ignored) into Parquet files at ``path``, ascending by doc_id, nulls first.

    Null and empty texts have the end identifier alone. Rows with equal identifiers follow each other in the order
    of a hash of their text; equal rows stand side by side. An empty table gives an empty one. A hot identifier spreads over files.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    keys = ["doc_id", "tie", "row"]  # equal rows may be dealt apart
    ordered = plain.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    writer = map_batches(ordered, _encode(tokenizer, end, chunk), _ROW).write.mode("overwrite")
    settings = {
        "compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.block.size": ROW_GROUP, "parquet.page.size": PAGE,
        **{f"parquet.enable.dictionary#{name}": "false" for name in _NUMBERS}, "parquet.enable.dictionary#ids.list.element": "true",
    }
    writer.options(**settings).parquet(path)
    rows = docs.sparkSession.read.schema(_ROW).parquet(path)
    sums = rows.where("chunk = 0").groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    sums.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"), "tokens").write.mode("overwrite").parquet(_manifest_of(path))
    return read_tokens(docs.sparkSession, path)


def _manifest_of(path: str) -> str:
    return f"{path.rstrip('/')}_manifest"


def read_tokens(spark: SparkSession, path: str) -> TokenTable:
    """The table that ``write_tokens`` left at ``path``."""
    return TokenTable(spark.read.schema(_ROW).parquet(path), spark.read.schema("part int, base long, tokens long").parquet(_manifest_of(path)))


def _powers() -> list[list[int]]:
    """The effect of 2**k zero bytes on a checksum, as images of its 32 bits."""
    nothing = zlib.crc32(b"\0")
    steps = [[zlib.crc32(b"\0", 1 << i) ^ nothing for i in range(32)]]
    for _ in range(44):
        steps.append([_image(steps[-1], x) for x in steps[-1]])
    return steps


def _image(step: list[int], crc: int) -> int:
    out, i = 0, 0
    while crc:
        if crc & 1:
            out ^= step[i]
        crc, i = crc >> 1, i + 1
    return out


_STEPS = _powers()


def carried(crc: int, n: int) -> int:
    """A checksum's share in that of a text which goes on for ``n`` bytes: shares of all parts combine by exclusive or."""
    k = 0
    while n:
        if n & 1:
            crc = _image(_STEPS[k], crc)
        n, k = n >> 1, k + 1
    return crc


def _checksums(chunk: int):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            edges = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<i4")).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            number, total = batch.column("chunk").to_pylist(), batch.column("n_tokens").to_pylist()
            crc = [carried(c, 4 * max(0, n - (k + 1) * chunk)) if n > chunk else c for c, k, n in zip(crc, number, total, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _NUMBERS), pa.array(crc, pa.int64())], [*_NUMBERS, "crc"])

    return work


def checksums(table: TokenTable, chunk: int = CHUNK) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files' tokens. Pieces of long documents are checked apart and combined."""
    schema = "doc_id long, part int, ordinal long, chunk int, first long, n_tokens long, crc long"
    rows = map_batches(table.rows, _checksums(chunk), schema)
    docs = rows.groupBy("part", "ordinal").agg(
        F.max("doc_id").alias("doc_id"), F.min("first").alias("first"), F.max("n_tokens").alias("n_tokens"), F.bit_xor("crc").alias("ids_crc32")
    )
    return docs.join(table.manifest.select("part", "base"), "part").select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str = TOKENIZER, end: int = END) -> DataFrame:
    """Write the tokens of ``docs`` to the shared folder and describe every document from the files."""
    return checksums(write_tokens(docs, scratch_path(docs.sparkSession, "token_table"), tokenizer, end))
