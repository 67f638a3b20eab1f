"""Benchmark items inside documents by size-partitioned MinHash containment search.

Items are short and documents long, so a plain MinHash of a long document says nothing about a
short item. Both sides are therefore partitioned by size: items into classes of 1, 2, 4, 8, ... shingles, and for
each class a document is cut into overlapping windows of twice the class size, so every item-sized
stretch lies whole in some window. A window that holds 80 % of an item then has a Jaccard
similarity of at least 0.36 with it (less the smaller the item in its class: 0.19), and shares at
least one of ``FUNCTIONS`` MinHash values with probability over 1 - 1e-5.

Window values are looked up in a bit table of fixed size made from all items' values; what passes is
joined with the items on the value itself, and every candidate pair is verified by exact
containment of the item's distinct shingles in the whole document.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourpanel.llm.text import SHINGLE, combined, divided, encoded, in_table, key_table, map_batches, mixed, multipliers, slices, text_shingles, word_hashes
from hourpanel.session import materialise

FUNCTIONS = 64
SMALLEST = 1  # shingles of the smallest size class
PERCENT = 80  # a hit: 100 * shared >= PERCENT * item shingles
SEED = 4211


def _class_of(size: int) -> int:
    width = SMALLEST
    while width < size:
        width *= 2
    return width


def _tagged(values: np.ndarray, width: int, k: int) -> np.ndarray:
    """One 64-bit key from a MinHash value, its function and its size class."""
    return mixed(values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(width * 1024 + k))


def _item_keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scale, shift = multipliers(FUNCTIONS, SEED)
    for batch in batches:
        raw = encoded(batch.column("text"))
        hashes, bounds = word_hashes(raw)
        counts = np.diff(bounds)
        sets = text_shingles(raw)
        keys, widths = [], []
        for s, n, at in zip(sets, counts.tolist(), bounds.tolist(), strict=False):
            if n == 0:
                keys.append(np.zeros(0, np.uint64))
                widths.append(0)
            elif n < SHINGLE:  # the whole item is one run of n words
                keys.append(_tagged(combined(hashes[at : at + n], n), n, 1000))
                widths.append(-n)
            else:
                width = _class_of(len(s))
                keys.append(np.concatenate([_tagged((((s * scale[k] + shift[k]) >> np.uint64(32)).min())[None], width, k) for k in range(FUNCTIONS)]))
                widths.append(width)
        as_long = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("item_no"),
                pa.array(widths, pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([s.astype(np.int64) for s in sets], as_long),
                pa.array([k.astype(np.int64) for k in keys], as_long),
            ],
            ["item_no", "width", "n_item", "members", "keys"],
        )


def described_items(items: DataFrame) -> DataFrame:
    """(item_no, item_id, width, n_item, members, keys), one row per item row."""
    numbered = materialise(items.select(F.monotonically_increasing_id().alias("item_no"), F.col("item_id"), F.col("text")), "items")
    found = map_batches(numbered.select("item_no", "text"), _item_keys, "item_no long, width long, n_item long, members array<long>, keys array<long>")
    return materialise(found.join(numbered.select("item_no", "item_id"), "item_no"), "item_sets")


def _windows(full: np.ndarray, begin: np.ndarray, count: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of ``width`` shingles of every document: start of each block and the document's number."""
    blocks = -(-count // width)
    doc = np.repeat(np.arange(len(count)), blocks)
    first = np.zeros(len(blocks), np.int64)
    np.cumsum(blocks[:-1], out=first[1:])
    inner = np.arange(len(doc)) - np.repeat(first, blocks)
    return begin[doc] + inner * width, doc


def document_keys(raw: list[bytes], table: np.ndarray, widths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(document number, key) of window values whose slot is in use."""
    scale, shift = multipliers(FUNCTIONS, SEED)
    hashes, bounds = word_hashes(raw)
    docs, keys = [], []

    def look(doc: np.ndarray, key: np.ndarray) -> None:
        hit = in_table(table, key)
        if hit.any():
            docs.append(doc[hit])
            keys.append(key[hit])

    for n in (-w for w in widths if w < 0):
        runs = combined(hashes, n)
        owner = np.searchsorted(bounds, np.arange(len(runs)), side="right") - 1
        inside = np.arange(len(runs)) + n <= bounds[owner + 1]
        look(owner[inside], _tagged(runs[inside], n, 1000))
    count = np.maximum(np.diff(bounds) - SHINGLE + 1, 0)
    large = [w for w in widths if w > 0]
    if not large or not count.any():
        return (np.concatenate(docs), np.concatenate(keys)) if docs else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    full = combined(hashes, SHINGLE)
    used = np.flatnonzero(count)
    flat = np.concatenate([full[a : a + c] for a, c in zip(bounds[:-1][used].tolist(), count[used].tolist(), strict=True)])
    begin = np.zeros(len(used), np.int64)
    np.cumsum(count[used][:-1], out=begin[1:])
    # blocks of the smallest class are reduced first; larger classes are minima over those
    layout = {w: _windows(flat, begin, count[used], w) for w in large}
    for k in range(FUNCTIONS):
        value = ((flat * scale[k] + shift[k]) >> np.uint64(32)).astype(np.uint32)
        for w in large:
            at, doc = layout[w]
            least = np.minimum.reduceat(value, at)
            pair = least.copy()  # a window: a block and the next one of the same document
            same = doc[1:] == doc[:-1]
            pair[:-1][same] = np.minimum(least[:-1][same], least[1:][same])
            look(used[doc], _tagged(pair, w, k))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(docs), np.concatenate(keys)


def _verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = encoded(batch.column("text"))
        widths = batch.column("width").to_pylist()
        members = batch.column("members")
        shared = []
        for k, text in enumerate(raw):
            item = np.array(members[k].as_py(), np.int64).view(np.uint64)
            hashes, bounds = word_hashes([text])
            width = SHINGLE if widths[k] > 0 or len(hashes) < -widths[k] else -widths[k]
            own = combined(hashes, width) if len(hashes) >= width else combined(hashes, max(1, len(hashes)))
            shared.append(int(np.isin(item, own).sum()))
        yield pa.RecordBatch.from_arrays([batch.column("row_no"), batch.column("item_no"), pa.array(shared, pa.int64())], ["row_no", "item_no", "shared"])


def texts_of(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose text_key is among ``keys``, and a few more, without moving any other text."""
    table = texts.sparkSession.sparkContext.broadcast(key_table(keys))

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_table(table.value, batch.column("text_key").to_numpy())))

    return map_batches(texts, keep, "doc_id long, text_key long, text string")


def contained_items(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (doc_id, item_id, n_item, shared, containment, text_key) with 100 * shared >= percent * n_item on distinct five-word shingles.

    An item of fewer than five words counts as one shingle of its length and is found where its words
    stand together. Items without words are in nothing; null and empty texts contain nothing. A repeated
    document row gives its pairs once per row, and so does a repeated item row. No items or no documents: no rows.
    """
    described = described_items(items)
    table = key_table(described.select(F.explode("keys").alias("key")))
    widths = sorted(r["width"] for r in described.select("width").distinct().collect() if r["width"])
    shared_table = docs.sparkSession.sparkContext.broadcast(table)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = encoded(batch.column("text"))
            for a, b in slices(raw):
                doc, key = document_keys(raw[a:b], shared_table.value, widths)
                both = np.unique(np.stack([doc.astype(np.int64), key.view(np.int64)]), axis=1) if len(doc) else np.zeros((2, 0), np.int64)
                text_key = batch.column("text_key").slice(a, b - a).take(pa.array(both[0]))
                ids = batch.column("doc_id").slice(a, b - a).take(pa.array(both[0]))
                yield pa.RecordBatch.from_arrays([ids, text_key, pa.array(both[1])], ["doc_id", "text_key", "key"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    hits = map_batches(texts, scan, "doc_id long, text_key long, key long")
    item_keys = described.select("item_no", F.explode("keys").alias("key"))
    pairs = hits.join(item_keys, "key").select("doc_id", "text_key", "item_no").distinct()
    pairs = materialise(pairs.select(F.col("doc_id").alias("p_id"), F.col("text_key").alias("p_key"), "item_no"), "leak_pairs")
    held = texts_of(texts, pairs.select(F.col("p_key").alias("key")))
    wanted = pairs.select("p_id", "p_key").distinct()
    numbered = held.join(wanted, F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("text_key") == F.col("p_key")), "left_semi")
    numbered = materialise(numbered.select(F.monotonically_increasing_id().alias("row_no"), "*"), "leak_texts")
    joined = (
        numbered.join(pairs, F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("text_key") == F.col("p_key")))
        .join(described.select("item_no", "width", "members"), "item_no")
        .select("row_no", "item_no", "text", "width", "members")
    )
    counted = map_batches(joined, _verify, "row_no long, item_no long, shared long")
    out = counted.join(described.select("item_no", "item_id", "n_item"), "item_no").where(F.col("shared") * 100 >= F.col("n_item") * percent)
    return out.join(numbered.select("row_no", "doc_id", "text_key"), "row_no").select(
        "doc_id", "item_id", "n_item", "shared", (F.col("shared") / F.col("n_item")).alias("containment"), "text_key"
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no item. Rows are told apart by identifier and text; only texts that may go are moved."""
    found = contained_items(docs, items).select(F.col("doc_id").alias("l_id"), F.col("text_key").alias("l_key")).distinct()
    leaks = materialise(found, "leaks")
    sure, open_rows = divided(docs, leaks.select(F.col("l_key").alias("key")), F.xxhash64(docs["text"]))
    match = open_rows["doc_id"].cast("long").eqNullSafe(F.col("l_id")) & (F.xxhash64(open_rows["text"]) == F.col("l_key"))
    return sure.unionByName(open_rows.hint("merge").join(leaks, match, "left_anti"))
