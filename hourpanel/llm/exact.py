"""Exact duplicates through an extendible-hash index on shared files, in DataFrame operations only.

* Entries: one per distinct (hash key, SHA-256) with its count and smallest row, summed before the
  shuffle, so a group of copies holding a third of all rows reaches the index as one entry a task.
* Directory: the leading bits of the key. It starts with one bucket; while a bucket holds more than
  ``CAPACITY`` entries, the directory doubles and the bucket splits on its next bit. Buckets that
  are full enough keep their depth, so the depth follows the keys. It has about two cells per
  ``CAPACITY`` entries.
* Owner tasks: entries are dealt by ranges of (bucket, key) and written in the shared folder; a task owns a
  range of keys.
* Chains: entries with equal keys stand in one chain. Where a chain or a class has several rows, the
  texts themselves are compared: rows are grouped by key and full normalised text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourpanel.llm.text import divided
from hourpanel.session import materialise

CAPACITY = 4096  # entries in a bucket
MAX_DEPTH = 32  # bits of the key that a directory may use; a fuller bucket there goes on as a chain

SPACES = r"[\x20\x09-\x0D]+"


def normalised(column: str = "text"):
    """The text with each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(F.col(column), F.lit("")), SPACES, " ")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, sha) of every row; the key is a 64-bit hash of the normalised text."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("body"))
    return text.select("doc_id", F.xxhash64("body").alias("key"), F.sha2("body", 256).alias("sha"))


def entries_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key", "sha").agg(F.count("*").alias("rows"), F.min("doc_id").alias("first_id"))


def directory(entries: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """Buckets (depth, prefix, entries): every key has exactly one bucket, the shallowest one that is not overfull.

    A doubling looks only at cells whose parent was overfull. The cells of one depth are counts, summed
    before the shuffle; the loop ends when nothing splits, after about log2(entries / capacity) rounds.
    """
    total = entries.count()
    depth = 0
    while depth < max_depth and (total >> depth) > capacity:
        depth += 1  # below this depth a bucket would be overfull on average, so these doublings are certain
    open_cells, done = None, None
    while True:
        prefix = F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")
        cells = entries.select(prefix.alias("prefix"), "key")
        if open_cells is not None:
            parents = open_cells.select(F.col("prefix").alias("parent"))
            cells = cells.join(parents, F.shiftrightunsigned("prefix", 1) == F.col("parent"), "left_semi")
        counted = materialise(cells.groupBy("prefix").agg(F.count("*").alias("entries"), F.countDistinct("key").alias("keys")), "hash_cells")
        split = (F.col("entries") > capacity) & (F.col("keys") > 1) & F.lit(depth < max_depth)
        closed = counted.where(~split).select(F.lit(depth).alias("depth"), "prefix", "entries")
        done = closed if done is None else done.unionByName(closed)
        open_cells = counted.where(split)
        if open_cells.isEmpty():
            return materialise(done, "hash_directory")
        depth += 1


def index(entries: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """The entries with their bucket, written to shared files by owners of key ranges, and their place in the key's chain."""
    buckets = directory(entries, capacity, max_depth)
    placed = None
    for depth in sorted(r["depth"] for r in buckets.select("depth").distinct().collect()):
        prefix = F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")
        own = buckets.where(F.col("depth") == depth).select("depth", F.col("prefix").alias("bucket"))
        part = entries.withColumn("bucket", prefix).join(own, "bucket")
        placed = part if placed is None else placed.unionByName(part)
    if placed is None:
        placed = entries.select("*", F.lit(0).cast("long").alias("bucket"), F.lit(0).alias("depth"))
    owned = placed.repartitionByRange("key").sortWithinPartitions("key", "first_id", "sha")
    chain = F.row_number().over(Window.partitionBy("key").orderBy("first_id", "sha"))
    return materialise(owned.withColumn("chain", chain), "hash_index")


def exact_duplicates(docs: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, and texts that differ only in the length or kind of white space are
    equal. ``keep_id`` is the smallest non-null doc_id of the equal rows; ``kept`` compares null-safely.
    Repeated rows (same id, same text) are all in one group and all marked kept. Other columns are
    ignored. An empty table gives no rows.
    """
    rows = materialise(keyed(docs), "hash_rows")
    entries = materialise(entries_of(rows), "hash_entries")
    owned = index(entries, capacity, max_depth)
    several = owned.groupBy("key").agg(F.sum("rows").alias("n")).where("n > 1").select(F.col("key").alias("shared"))
    several = materialise(several, "hash_shared")
    bodies = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("body")).withColumn("key", F.xxhash64("body"))
    # grouping by the text itself compares bytes; copies fold within each task before the shuffle
    same = bodies.join(several, F.col("key") == F.col("shared"), "left_semi").groupBy("key", "body").agg(
        F.count("*").alias("group_size"), F.min("doc_id").alias("keep_id")
    )
    classes = same.select(F.col("key").alias("c_key"), F.sha2("body", 256).alias("c_sha"), "group_size", "keep_id")
    out = rows.join(materialise(classes, "hash_classes"), (F.col("key") == F.col("c_key")) & (F.col("sha") == F.col("c_sha")), "left")
    keep = F.when(F.col("c_key").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def survivors(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` to keep: one per class of equal texts, also where a row is repeated. Only texts that may go are moved."""
    copies = exact_duplicates(docs).where("group_size > 1").groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count("*").alias("times"))
    doubt = copies.where("not kept or times > 1").select(F.col("doc_id").alias("k_id"), F.col("text_sha256").alias("k_sha"), F.col("kept").alias("k_kept"))
    doubt = materialise(doubt, "hash_doubt")
    sure, open_rows = divided(docs, doubt.select(F.xxhash64("k_id").alias("key")), F.xxhash64(docs["doc_id"].cast("long")))
    tagged = open_rows.withColumn("__sha", F.sha2(normalised(), 256))
    match = tagged["doc_id"].cast("long").eqNullSafe(F.col("k_id")) & (tagged["__sha"] == F.col("k_sha"))
    dropped = doubt.where("not k_kept")
    # only repeated rows have an identifier and a text in common with another one that stays
    stay = tagged.hint("merge").join(dropped, match, "left_anti").dropDuplicates(["doc_id", "__sha"])
    return sure.unionByName(stay.select(*[F.col(f"`{c}`") for c in docs.columns]))


EXACT_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n.body) AS text_sha256
FROM n JOIN g ON n.body = g.body
"""
