"""Token counts of documents in flat token files that have no index.

Documents stand one after another in a shard, each closed by the end-of-document identifier. A shard is read in
blocks of ``BLOCK`` tokens; every task searches its blocks for the identifier with one vectorised
comparison. A document that goes over block edges is stitched by a prefix scan over the blocks'
summaries: the number of separators before a block numbers its documents, and the last separator before it
gives the beginning of the one that is open at its edge. The scan moves a few numbers per block.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourpanel.llm.text import map_batches
from hourpanel.session import materialise

BLOCK = 1 << 16  # tokens
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public splitting pattern that belongs to this vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_DOCUMENT = 50256


def load_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary, read on the driver; it has a fixed size."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def width_of(vocabulary: int) -> int:
    return 2 if vocabulary <= 1 << 16 else 4


def token_shards(docs: DataFrame, ranks: dict[bytes, int], end: int = END_OF_DOCUMENT, pattern: str = PATTERN, block: int = BLOCK) -> DataFrame:
    """Rows (shard, block, tokens, doc_ids): each input partition as one flat shard, cut into blocks.

    ``tokens`` has the little-endian identifiers and nothing that tells where documents are; ``doc_ids``
    names, in order, the documents that end in the block. Null text gives an empty document.
    """
    width = width_of(max(end, max(ranks.values())) + 1)
    kind = np.dtype(f"<u{width}")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        coder = tiktoken.Encoding("shard", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
        shard, number, held, size, names = str(TaskContext.get().partitionId()), 0, [], 0, []

        def row(tokens: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([shard]), pa.array([number], pa.int64()), pa.array([tokens.tobytes()], pa.binary()), pa.array([names], pa.list_(pa.int64()))],
                ["shard", "block", "tokens", "doc_ids"],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = np.array([*coder.encode_ordinary(text or ""), end], kind)
                while size + len(own) >= block:
                    cut = block - size
                    held.append(own[:cut])
                    own = own[cut:]
                    if not len(own):
                        names.append(doc_id)
                    yield row(np.concatenate(held))
                    number, held, size, names = number + 1, [], 0, []
                    if not len(own):
                        break
                if len(own):
                    held.append(own)
                    size += len(own)
                    names.append(doc_id)
        if size:
            yield row(np.concatenate(held))

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(plain, work, "shard string, block long, tokens binary, doc_ids array<long>")


def read_flat_files(spark: SparkSession, path: str, width: int, block: int = BLOCK) -> DataFrame:
    """Raw token files of any store that Spark reads as (shard, block, tokens); a file must fit in a row (2 GB)."""
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block * width).cast("long"))
    pieces = files.select(F.col("path").alias("shard"), "content", F.posexplode(starts).alias("block", "at"))
    return pieces.select("shard", F.col("block").cast("long").alias("block"), F.expr(f"substring(content, cast(at as int) + 1, {block * width})").alias("tokens"))


def scan(blocks: DataFrame, width: int, end: int = END_OF_DOCUMENT, block: int = BLOCK) -> DataFrame:
    """Per document of every shard: shard, ordinal (from 0), first_token, n_tokens (without the separator), closed.

    ``blocks`` has shard, block (from 0, all but the last full) and tokens. Two separators in a row enclose an empty
    document. Tokens after the last separator are a last document with ``closed`` false. An empty shard has none.
    """
    kind = np.dtype(f"<u{width}")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sizes = [], []
            for number, raw in zip(batch.column("block").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                tokens = np.frombuffer(raw, kind)
                at.append(np.flatnonzero(tokens == end) + number * block)
                sizes.append(len(tokens))
            ends = pa.array([x.astype(np.int64) for x in at], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("block"), pa.array(sizes, pa.int64()), ends], ["shard", "block", "n", "ends"])

    found = map_batches(blocks.select("shard", F.col("block").cast("long").alias("block"), "tokens"), search, "shard string, block long, n long, ends array<long>")
    found = materialise(found, "separators")
    order = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    summary = found.select("shard", "block", F.size("ends").cast("long").alias("count"), F.try_element_at("ends", F.lit(-1)).alias("last"))
    carried = summary.select(
        "shard", "block", F.coalesce(F.sum("count").over(order), F.lit(0)).alias("before"), F.coalesce(F.max("last").over(order), F.lit(-1).cast("long")).alias("open_after")
    )
    begin = F.concat(F.array("open_after"), F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0))))
    closed = (
        found.join(carried, ["shard", "block"])
        .where(F.size("ends") > 0)
        .select("shard", "before", F.posexplode(F.arrays_zip(begin.alias("after"), F.col("ends").alias("stop"))).alias("i", "d"))
        .select("shard", (F.col("before") + F.col("i")).alias("ordinal"), (F.col("d.after") + 1).alias("first_token"), (F.col("d.stop") - F.col("d.after") - 1).alias("n_tokens"), F.lit(True).alias("closed"))
    )
    tails = found.groupBy("shard").agg(
        F.sum(F.size("ends").cast("long")).alias("ordinal"), F.coalesce(F.max(F.try_element_at("ends", F.lit(-1))), F.lit(-1).cast("long")).alias("last"),
        F.sum("n").alias("n"),
    ).where("n > last + 1")
    rest = tails.select("shard", "ordinal", (F.col("last") + 1).alias("first_token"), (F.col("n") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(rest)


def count_tokens(docs: DataFrame, tokenizer: str = TOKENIZER, block: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: doc_id, shard, ordinal, n_tokens, found by scanning flat shards of the tokenised table.

    Null and empty texts have no tokens; repeated rows and null identifiers are documents of their own; other columns
    are ignored; a text that spells the separator is ordinary text. The shards are written once in the shared folder.
    """
    ranks = load_ranks(tokenizer)
    shards = materialise(token_shards(docs, ranks, block=block), "token_shards")
    spans = scan(shards.select("shard", "block", "tokens"), width_of(END_OF_DOCUMENT + 1), block=block)
    order = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ids = shards.select("shard", "block", "doc_ids", F.coalesce(F.sum(F.size("doc_ids").cast("long")).over(order), F.lit(0)).alias("before"))
    named = ids.select("shard", "before", F.posexplode("doc_ids").alias("i", "doc_id")).select("shard", (F.col("before") + F.col("i")).alias("ordinal"), "doc_id")
    return named.join(spans, ["shard", "ordinal"]).select("doc_id", "shard", "ordinal", "n_tokens")
