"""MinHash near-duplicates over an LSH forest with adaptive depth.

Every distinct shingle set gets one MinHash signature. A tree of the forest is an order of its
values: the sets are sorted by the reordered values, and sets that stand near each other with a
common prefix are candidates. In every region (the sets that share the first values of an order) immediate neighbours
are confirmed and joined into components first. Only regions that still hold several components go on: those of up to ``REACH`` sets are
compared whole. A fuller one is too shallow for its sets: they go down to the next of ``DEPTHS``, where a region
shares more values, and where there are so many more trees that a pair at the threshold is still met (``trees_for``).
There the regions of several components are compared whole on the full sets, by pairs of blocks of about ``BLOCK`` sets, so no pair of
a region is left out and no row is made for a pair that is no link (``blockwise``). Regions of more than ``CROWD`` sets go deeper first; at
the last depth all are compared.

A candidate is confirmed on the full sets. The only loss is the chance that a true pair shares no
region of its depth, or that its estimate falls below the floor: under 4e-6 for a pair at exactly 0.85 in
ordinary regions, under ``MISS`` in each deeper level.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourpanel.llm.graph import components
from hourpanel.llm.text import batches_of, divided, encoded, in_table, key_table, map_batches, mixed, multipliers, parts, signatures, text_shingles
from hourpanel.session import materialise

FUNCTIONS = 128  # MinHash values per set
TREES = 16  # sorted orders, rotations of the signature
STEP = FUNCTIONS // TREES  # a tree starts this many values after the one before
DEPTH = 3  # values that members of a region share
DEPTHS = (6, 10, 14)  # the same for sets whose regions are full
MISS = 1e-3  # chance that a pair at the threshold shares no region of a deeper level
REACH = 32  # largest region that a task compares whole
CROWD = 4096  # largest region that is compared whole if there is a deeper level
BLOCK = 256  # sets that one row holds where fuller regions are compared whole
BLOCK_SHINGLES = 1 << 18  # shingles that it holds, if its sets are long
PERCENT = 85  # a link: 100 * intersection >= PERCENT * union
SLACK = 0.14  # the estimate may fall this far below the threshold (4.4 standard errors)
DEEP_FUNCTIONS = 256  # MinHash values of the sets that go deeper, made from their full sets
DEEP_ERRORS = 3.1  # standard errors that an estimate may fall below the threshold there
SEED = 977
BATCH_BYTES = 8 << 20  # rows handed to Python at once
SLICE_BYTES = 512 << 10  # text shingled at once

_ROW = "doc_id long, n_shingles long, text_key long, print_a long, print_b long, sig binary"


def _describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scale, shift = multipliers(FUNCTIONS, SEED)
    for batch in batches:
        for part in parts(batch, limit=SLICE_BYTES):
            sets = text_shingles(encoded(part.column("text")))
            sig = signatures(sets, scale, shift).astype(">u4")
            sums = [(int(mixed(s).sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mixed(s * scale[0])))) if len(s) else (0, 0) for s in sets]
            prints = np.array(sums, np.uint64).reshape(-1, 2).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    part.column("text_key"),
                    pa.array(prints[:, 0]),
                    pa.array(prints[:, 1]),
                    pa.array([x.tobytes() for x in sig], pa.binary()),
                ],
                ["doc_id", "n_shingles", "text_key", "print_a", "print_b", "sig"],
            )


def described(docs: DataFrame) -> DataFrame:
    """One row per document with its set size, set fingerprint (128 bits) and signature."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("text_key"))
    return map_batches(source, _describe, _ROW)


def _rotated(tree: int):
    cut = 4 * STEP * tree
    return F.concat(F.expr(f"substring(sig, {cut + 1})"), F.expr(f"substring(sig, 1, {cut})")) if cut else F.col("sig")


def _regions(sets: DataFrame, placed: DataFrame) -> DataFrame:
    """Rows (node, tree, region) whose region holds another set, with its members and the set's columns.

    Regions of one set, the bulk, are dropped by their counts before a signature is moved.
    """
    shared = placed.groupBy("region").agg(F.count("*").alias("members")).where("members > 1")
    return placed.join(shared, "region").join(sets, "node")


def forest(sets: DataFrame, trees: int = TREES) -> DataFrame:
    """(region, members, node, n_shingles, order) of the sets that share a region with another one.

    ``sets`` has node, n_shingles and sig.
    """
    entries = [F.struct(F.lit(t).alias("tree"), F.xxhash64(F.lit(t), F.substring(_rotated(t), 1, 4 * DEPTH)).alias("region")) for t in range(trees)]
    placed = sets.select("node", F.explode(F.array(*entries)).alias("e")).select("node", "e.tree", "e.region")
    order = F.lit(None).cast("binary")
    for t in reversed(range(trees)):
        order = F.when(F.col("tree") == t, _rotated(t)).otherwise(order)
    return _regions(sets, placed).select("region", "members", "node", "n_shingles", order.alias("order"))


def neighbours(rows: DataFrame, reach: int, percent: int = PERCENT) -> DataFrame:
    """Candidate pairs (u, v) from the rows of ``forest`` with their root and cut."""
    return _in_order(rows, reach, percent)


def _in_order(rows: DataFrame, reach: int, percent: int) -> DataFrame:
    """Candidate pairs (u, v) from forest rows: near in sorted order, same region, sizes and estimate that allow a link.

    Rows are dealt by ranges: regions of up to ``REACH`` sets, whose ``cut`` is null, stay whole; a fuller one spreads over
    tasks by its order. A task reads the order as a stream and holds the last ``reach`` rows.
    """
    floor = percent / 100 - SLACK

    def pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("region", "node", "root", "n_shingles")]
            cols.append(np.frombuffer(b"".join(batch.column("order").to_pylist()), ">u4").reshape(batch.num_rows, -1))
            fresh = 0
            if tail is not None:
                fresh = len(tail[0])
                cols = [np.concatenate([x, y]) for x, y in zip(tail, cols, strict=True)]
            region, node, root, size, sig = cols
            found = []
            for gap in range(1, min(reach, len(region) - 1) + 1):
                i = np.arange(max(0, fresh - gap), len(region) - gap)
                i = i[region[i] == region[i + gap]]
                if not len(i):
                    break  # ordered by region: no wider gap can match either
                j = i + gap
                ok = (root[i] != root[j]) & (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j]))
                i, j = i[ok], j[ok]
                for a in range(0, len(i), 20_000):
                    x, y = i[a : a + 20_000], j[a : a + 20_000]
                    close = (sig[x] == sig[y]).mean(axis=1) >= floor
                    found.append(np.stack([node[x[close]], node[y[close]]]))
            tail = [x[-reach:] for x in cols]
            if found:
                both = np.concatenate(found, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(both.min(axis=0)), pa.array(both.max(axis=0))], ["u", "v"])

    # a range for every shuffle partition; bounds cut inside full regions only, as other rows of a region have one ``cut``
    dealt = rows.repartitionByRange("region", "cut").sortWithinPartitions("region", "order", "node")
    return map_batches(dealt.select("region", "node", "root", "n_shingles", "order"), pairs, "u long, v long").distinct()


def _sets_again(table):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch.filter(pa.array(in_table(table.value, batch.column("d_key").to_numpy()))), limit=SLICE_BYTES):
                sets = [s.tobytes() for s in text_shingles(encoded(part.column("text")))]
                yield pa.RecordBatch.from_arrays([part.column("d_id"), part.column("d_key"), pa.array(sets, pa.binary())], ["d_id", "d_key", "members"])

    return work


def _confirm(percent: int):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            keep = []
            for k in range(batch.num_rows):
                a, b = np.frombuffer(left[k].as_buffer(), np.uint64), np.frombuffer(right[k].as_buffer(), np.uint64)
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return work


def full_sets(nodes: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, members) of the ``nodes``: only their documents are shingled again."""
    wanted = materialise(nodes.join(sets.select("node", F.col("first_id").alias("f_id"), F.col("first_key").alias("f_key")), "node"), "near_wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("d_id"), F.xxhash64("text").alias("d_key"), "text")
    table = docs.sparkSession.sparkContext.broadcast(key_table(wanted, "f_key"))  # keeps other texts from being moved
    shingled = map_batches(texts, _sets_again(table), "d_id long, d_key long, members binary")
    found = shingled.join(wanted, (F.col("d_key") == F.col("f_key")) & F.col("d_id").eqNullSafe(F.col("f_id")))
    full = materialise(found.select("node", "members").dropDuplicates(["node"]), "near_full")
    table.destroy()
    return full


def confirmed(pairs: DataFrame, full: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of the written ``pairs`` whose full shingle sets meet the threshold."""
    joined = (
        pairs.join(full.select(F.col("node").alias("u"), F.col("members").alias("left")), "u")
        .join(full.select(F.col("node").alias("v"), F.col("members").alias("right")), "v")
        .select("u", "v", "left", "right")
    )
    return materialise(map_batches(joined, _confirm(percent), "u long, v long"), "near_links")


def trees_for(depth: int, percent: int, miss: float = MISS, functions: int = DEEP_FUNCTIONS) -> int:
    """The fewest trees that a pair at the threshold misses with a chance of at most ``miss``, over all numbers of equal values it may have."""
    p = percent / 100
    weight = [math.comb(functions, m) * p**m * (1 - p) ** (functions - m) for m in range(functions + 1)]
    shares = [math.comb(m, depth) / math.comb(functions, depth) for m in range(functions + 1)]
    trees = 1
    while sum(w * (1 - h) ** trees for w, h in zip(weight, shares, strict=True)) > miss:
        trees += max(1, trees // 16)
    return trees


def _regions_of(sig: np.ndarray, depth: int, trees: int) -> np.ndarray:
    """The region of every set (rows) in every tree (columns): a hash of the tree's choice of values."""
    rng = np.random.default_rng(SEED + depth)
    chosen = np.stack([rng.permutation(sig.shape[1])[:depth] for _ in range(trees)])
    factor = rng.integers(0, 2**63, (trees, depth), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return mixed((sig[:, chosen].astype(np.uint64) * factor).sum(axis=2, dtype=np.uint64) + np.arange(trees, dtype=np.uint64)).view(np.int64)


def _sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scale, shift = multipliers(DEEP_FUNCTIONS, SEED + 1)
    for part in _pieces(batches):
        sets = [np.frombuffer(x, np.uint64) for x in part.column("members").to_pylist()]
        values = signatures(sets, scale, shift)
        sig, low = (pa.array([x.tobytes() for x in values.astype(kind)], pa.binary()) for kind in (">u4", np.uint8))
        yield pa.RecordBatch.from_arrays(
            [part.column("node"), pa.array([len(x) for x in sets], pa.int64()), sig, low, part.column("members")], ["node", "n_shingles", "sig", "low", "members"]
        )


def _signatures_of(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("sig").to_pylist()), ">u4").reshape(batch.num_rows, -1)


def _pieces(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def _place(depth: int, trees: int):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _pieces(batches):
            region = _regions_of(_signatures_of(part), depth, trees)
            owner = pa.array(np.repeat(np.arange(part.num_rows), trees))
            yield pa.RecordBatch.from_arrays([pa.array(region.ravel()), *(part.column(c).take(owner) for c in ("root", "n_shingles"))], ["region", "root", "n_shingles"])

    return work


def _members(depth: int, trees: int, wanted):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _pieces(batches):
            region = _regions_of(_signatures_of(part), depth, trees).ravel()
            at = np.flatnonzero(in_table(wanted.value, region))
            yield pa.RecordBatch.from_arrays([pa.array(region[at]), part.column("node").take(pa.array(at // trees))], ["region", "node"])

    return work


def _floor(percent: int) -> float:
    """Least estimate of a pair among the sets that go deeper, from which it is compared on its full sets."""
    return percent / 100 - DEEP_ERRORS * math.sqrt(percent * (100 - percent) / DEEP_FUNCTIONS) / 100


def _compare_blocks(percent: int):
    """Links of two blocks, or within one, between different components: sizes and estimate allow them and the full sets confirm them."""
    floor = _floor(percent)

    def side(batch: pa.RecordBatch, name: str, k: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        rows = batch.column(name).slice(k, 1).flatten()
        node, root, size = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("node", "root", "n_shingles"))
        low = np.frombuffer(b"".join(rows.field("low").to_pylist()), np.uint8).reshape(len(node), -1)
        return [node, root, size, low], [np.frombuffer(x, np.uint64) for x in rows.field("members").to_pylist()]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                (node, root, size, low), sets = side(batch, "left", k)
                own = batch.column("block")[k].as_py() == batch.column("other")[k].as_py()
                others, other_sets = side(batch, "right", k)
                found = []
                for i in range(len(node)):
                    skip = i + 1 if own else 0
                    v, r, n, x = (y[skip:] for y in others)
                    at = np.flatnonzero((r != root[i]) & (100 * np.minimum(n, size[i]) >= percent * np.maximum(n, size[i])))
                    at = at[(x[at] == low[i]).mean(axis=1) >= floor] if len(at) else at
                    if not len(at):
                        continue
                    flat = np.concatenate([other_sets[skip + j] for j in at.tolist()])
                    same = sets[i][np.minimum(np.searchsorted(sets[i], flat), len(sets[i]) - 1)] == flat
                    common = np.add.reduceat(same.astype(np.int64), np.concatenate([[0], np.cumsum(n[at])[:-1]]))
                    linked = v[at[100 * common >= percent * (n[at] + size[i] - common)]]
                    found.append(np.stack([np.minimum(linked, node[i]), np.maximum(linked, node[i])]))
                if found:
                    both = np.concatenate(found, axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["u", "v"])

    return work


def blockwise(sets: DataFrame, regions: DataFrame, depth: int, percent: int) -> DataFrame:
    """Links (u, v) of different components among all written ``sets`` (node, root, n_shingles, sig, low, members) that share one of the ``regions`` of a depth.

    A region is dealt into blocks of about ``BLOCK`` sets and every two blocks meet in one row, so a task holds two blocks
    whatever the size of a region. The number of comparisons grows with the square of the regions.
    """
    trees = trees_for(depth, percent)
    table = sets.sparkSession.sparkContext.broadcast(key_table(regions, "region"))
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("shingles") / BLOCK_SHINGLES))
    place = regions.select("region", blocks.alias("blocks"))
    placed = map_batches(sets.select("node", "sig"), _members(depth, trees, table), "region long, node long").join(place, "region")
    dealt = placed.withColumn("block", F.expr("pmod(xxhash64(node, region), blocks)")).join(sets.drop("sig"), "node")
    held = F.collect_list(F.struct("node", "root", "n_shingles", "low", "members")).alias("held")
    blocks = materialise(dealt.groupBy("region", "blocks", "block").agg(held), "near_blocks")
    table.destroy()
    alone = blocks.select("block", F.col("block").alias("other"), F.col("held").alias("left"), F.col("held").alias("right"))
    left = blocks.where("block < blocks - 1")
    left = left.select("region", "block", F.col("held").alias("left"), F.explode(F.sequence(F.col("block") + 1, F.col("blocks") - 1)).alias("other"))
    right = blocks.where("block > 0").select("region", F.col("block").alias("other"), F.col("held").alias("right"))
    met = alone.unionByName(left.join(right, ["region", "other"]).select("block", "other", "left", "right"))
    return materialise(map_batches(met, _compare_blocks(percent), "u long, v long").distinct(), "near_links")


def several(sets: DataFrame, depth: int, percent: int) -> DataFrame:
    """(region, members, shingles) of the regions of a depth that hold several components, for written rows with root, n_shingles and sig."""
    placed = map_batches(sets.select("root", "n_shingles", "sig"), _place(depth, trees_for(depth, percent)), "region long, root long, n_shingles long")
    counts = placed.groupBy("region").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("shingles"), F.min("root").alias("low"), F.max("root").alias("high"))
    return materialise(counts.where("low < high").drop("low", "high"), "near_several")


def crowded(sets: DataFrame, regions: DataFrame, depth: int, percent: int) -> DataFrame:
    """(node) of the sets in the given regions of a depth."""
    table = sets.sparkSession.sparkContext.broadcast(key_table(regions, "region"))
    placed = map_batches(sets.select("node", "sig"), _members(depth, trees_for(depth, percent), table), "region long, node long")
    nodes = materialise(placed.join(regions.select("region"), "region", "left_semi").select("node").distinct(), "near_crowded")
    table.destroy()
    return nodes


def _rooted(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return rows.withColumn("root", F.col("node"))
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _joined(links: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The roots after ``links`` are added."""
    if roots is not None:
        links = links.unionByName(roots.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")))
    return materialise(components(links), "near_roots")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept, n_links (confirmed links of its set that were needed).

    Null, empty or blank text: an empty set, linked with nothing, its own component. Repeated rows and
    documents with equal sets share a component. ``component_id`` is the smallest doc_id reachable;
    ``kept`` compares null-safely, so a null identifier stays only if nothing in its component has one.
    Other columns are ignored.
    """
    with batches_of(docs.sparkSession, BATCH_BYTES):
        return _near_duplicates(docs, percent)


def _near_duplicates(docs: DataFrame, percent: int) -> DataFrame:
    rows = materialise(described(docs), "near_rows")
    keys = ["print_a", "print_b", "n_shingles"]
    grouped = rows.where("n_shingles > 0").groupBy(*keys).agg(
        F.min(F.struct("doc_id", "text_key")).alias("first"), F.min("doc_id").alias("least_id"), F.first("sig").alias("sig")
    )
    sets = materialise(
        grouped.select(
            F.monotonically_increasing_id().alias("node"), *keys, "sig", "least_id",
            F.col("first.doc_id").alias("first_id"), F.col("first.text_key").alias("first_key"),
        ),
        "near_sets",
    )
    plain = sets.select("node", "n_shingles", "sig")
    level = materialise(forest(plain), "near_forest")
    level = level.withColumn("cut", F.when(F.col("members") > REACH, F.col("order")))
    links, roots = [], None

    def confirm(pairs: DataFrame) -> None:
        nonlocal roots
        pairs = materialise(pairs, "near_pairs")
        if roots is not None and pairs.isEmpty():
            return  # nothing can join two components
        nodes = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
        links.append(confirmed(pairs, full_sets(nodes, sets, docs), percent))
        roots = _joined(links[-1], roots)

    confirm(neighbours(_rooted(level, None), 1, percent))
    rooted = _rooted(level.select("region", "members", "node"), roots)
    mixed_regions = rooted.groupBy("region").agg(F.first("members").alias("members"), F.min("root").alias("low"), F.max("root").alias("high"))
    mixed_regions = materialise(mixed_regions.where("low < high").select("region", "members"), "near_mixed")
    small, large = (mixed_regions.where(x).select("region") for x in (F.col("members") <= REACH, F.col("members") > REACH))
    confirm(neighbours(_rooted(level.join(small, "region", "left_semi"), roots), REACH, percent))
    unsettled = materialise(level.join(large, "region", "left_semi").select("node").distinct(), "near_unsettled")
    signed = None
    for depth in DEPTHS:
        if unsettled.isEmpty():
            break
        if signed is None:
            schema = "node long, n_shingles long, sig binary, low binary, members binary"
            signed = materialise(map_batches(full_sets(unsettled, sets, docs), _sign, schema), "near_signed")
        tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        own = materialise(_rooted(signed.join(unsettled, "node", "left_semi"), roots).repartition(tasks), "near_unsettled_sets")
        regions = several(own, depth, percent)
        fuller = regions.where(F.lit(depth != DEPTHS[-1]) & (F.col("members") > CROWD))
        links.append(blockwise(own, regions.join(fuller.select("region"), "region", "left_anti"), depth, percent))
        roots = _joined(links[-1], roots)
        if fuller.isEmpty():
            break
        unsettled = crowded(own, fuller, depth, percent)
    links = reduce(DataFrame.unionByName, links).distinct()

    known = sets.select("node", *keys, "least_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = known.groupBy("root").agg(F.min("least_id").alias("component_id"))
    degree = links.select(F.col("u").alias("node")).unionByName(links.select(F.col("v").alias("node"))).groupBy("node").agg(F.count("*").alias("n_links"))
    classes = known.join(least, "root").join(degree, "node", "left").select(*keys, "component_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    out = rows.select("doc_id", *keys).join(materialise(classes, "near_classes"), keys, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


def survivors(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that near_duplicates keeps, one per component. Only texts that may go are moved."""
    ids = near_duplicates(docs, percent).groupBy(F.col("doc_id").alias("d_id")).agg(F.max("kept").alias("kept"))
    dropped = materialise(ids.where("not kept").select("d_id"), "near_dropped")
    sure, open_rows = divided(docs, dropped.select(F.xxhash64("d_id").alias("key")), F.xxhash64(docs["doc_id"].cast("long")))
    stay = open_rows.hint("merge").join(dropped, open_rows["doc_id"].cast("long").eqNullSafe(F.col("d_id")), "left_anti")
    return sure.unionByName(stay)
