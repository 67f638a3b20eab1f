"""Alignment of two tokenizers by their byte offsets, with inverted bitmaps of token pairs.

Where tokens of both tokenizers end at the same byte, a text is cut into groups. Two tokens are linked where their
bytes overlap. A task numbers its documents within a block and turns the block's links into postings: per pair of
identifiers the compressed bitmap of the documents that have it, and planes for the bits of its multiplicity in
each of them. Bitmaps of a pair combine over blocks by union, as no document is in two: documents are popcounts of
the bitmaps, links popcounts of the planes times two to the power of the plane. The counts return to the postings, and every
posting gives its documents their scores.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourpanel.llm.pieces import ByteLevel, Memo, byte_letters, gathered, joined, pieces_of
from hourpanel.llm.text import map_batches, parts
from hourpanel.session import materialise

BYTES_FILE = public_tokenizers.path("byte_bpe_50k.json")
PIECES_FILE = public_tokenizers.path("piece_bpe_32k.model")
BLOCK_LINKS = 2 << 20  # links of a block at most, or one document
BLOCK_DOCS = 1 << 16  # documents of a block at most, so that 16 bits number them
SLICE_BYTES = 2 << 20

_DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_ROW = f"block long, place int, {_DOC}, a int, b int, docs int, links long, dense boolean, bitmap binary, planes binary"
_DOC_NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
_POSTING_NAMES = ("a", "b", "docs", "links", "dense", "bitmap", "planes")


class Aligner:
    """Both tokenizers, loaded once in a worker. ``memo`` gives for distinct pieces (sound, n_a, n_b, n_groups, pairs, groups)."""

    def __init__(self, bytes_file: str, pieces_file: str):
        import sentencepiece

        self.a = ByteLevel(bytes_file, plain_specials=True)
        letters = byte_letters()
        self.a_bytes = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in self.a.whole.get_vocab().items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_file)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(x[3:-1], 16)]) if self.b.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]
        if any(" " in x.replace("▁", " ").lstrip(" ") for x in names):
            raise ValueError("an entry goes over the beginning of a word: texts cannot be cut into pieces")
        self.space = [self.b.piece_to_id("▁")]  # of a last space, for which nothing is left to encode
        self.memo = Memo(self.align)

    def align(self, pieces: list[str]) -> list[tuple]:
        """``pieces`` begin with a space, which the second tokenizer adds by itself."""
        ids, counts = self.a(pa.array(pieces))
        first = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        second = [y or self.space for y in self.b.encode([x[1:] for x in pieces], num_threads=1)]
        return [self._one(p.encode(), x, y) for p, x, y in zip(pieces, first, second, strict=True)]

    def _one(self, raw: bytes, first: list[int], second: list[int]) -> tuple:
        a_bytes, b_bytes = self.a_bytes, self.b_bytes
        left, right = [a_bytes[i] for i in first], [b_bytes[i] for i in second]
        if b"".join(left) != raw or b"".join(right) != raw:
            return False, 0, 0, 0, b"", ""
        i = j = begin_i = begin_j = 0
        end_i, end_j = len(left[0]), len(right[0])
        pairs, groups = [], []
        while True:
            pairs.append(first[i] << 32 | second[j])
            if end_i == end_j:
                groups.append(f"{','.join(map(str, first[begin_i : i + 1]))}|{','.join(map(str, second[begin_j : j + 1]))}")
                i, j = i + 1, j + 1
                begin_i, begin_j = i, j
                if i == len(first):
                    break
                end_i, end_j = end_i + len(left[i]), end_j + len(right[j])
            elif end_i < end_j:
                i += 1
                end_i += len(left[i])
            else:
                j += 1
                end_j += len(right[j])
        return True, len(first), len(second), len(groups), np.array(pairs, "<i8").tobytes(), ";".join(groups)


_aligners: dict[tuple, Aligner] = {}


def aligner(*files: str) -> Aligner:
    if files not in _aligners:
        _aligners[files] = Aligner(*files)
    return _aligners[files]


def _binary(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Byte strings that stand one after another in ``flat``."""
    edges = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=edges[1:])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(flat))])


def _places(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run of the given sizes."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _bits(sizes: np.ndarray, on: np.ndarray) -> np.ndarray:
    """Flags of runs packed into whole bytes for each run."""
    width = -(-sizes // 8)
    flags = np.zeros(8 * width.sum(), np.uint8)
    flags[np.repeat(8 * (np.cumsum(width) - width), sizes) + _places(sizes)] = on
    return np.packbits(flags)


def _planes(sizes: np.ndarray, times: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, sizes): per pair the bits of its documents' multiplicities, plane after plane; nothing if all are 1."""
    most = np.maximum.reduceat(times, starts)
    depth = np.where(most > 1, np.floor(np.log2(most)).astype(np.int64) + 1, 0)
    width = -(-sizes // 8)
    begin = np.cumsum(depth * width) - depth * width
    flat = np.zeros(int((depth * width).sum()), np.uint8)
    for k in range(int(depth.max(initial=0))):
        has = depth > k
        inside = np.repeat(has, sizes)
        packed = _bits(sizes[has], (times[inside] >> k) & 1)
        flat[np.repeat(begin[has] + k * width[has], width[has]) + _places(width[has])] = packed
    return flat, depth * width


def postings(pairs: np.ndarray, docs: np.ndarray, n_docs: int) -> Iterator[dict[str, pa.Array]]:
    """A block's links as one posting per pair: sorted 16-bit numbers where few documents have it, else a bitmap of all."""
    order = np.lexsort((docs, pairs))
    pairs, docs = pairs[order], docs[order]
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs[1:] != pairs[:-1]) | (docs[1:] != docs[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(pairs)))
    pairs, docs = pairs[at], docs[at]
    begin = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    sizes = np.diff(np.append(begin, len(pairs)))
    dense = 16 * sizes > n_docs
    for kind in (False, True):
        chosen = dense == kind
        if not chosen.any():
            continue
        inside = np.repeat(chosen, sizes)
        own, each, n = docs[inside], times[inside], sizes[chosen]
        starts = np.cumsum(n) - n
        if kind:
            flags = np.zeros((len(n), n_docs), np.uint8)
            flags[np.repeat(np.arange(len(n)), n), own] = 1
            rows = np.packbits(flags, axis=1)
            bitmap = _binary(rows.reshape(-1), np.full(len(n), rows.shape[1]))
        else:
            bitmap = _binary(own.astype("<u2").view(np.uint8), 2 * n)
        key = pairs[begin[chosen]]
        yield {
            "a": pa.array((key >> 32).astype(np.int32)), "b": pa.array((key & 0xFFFFFFFF).astype(np.int32)), "docs": pa.array(n.astype(np.int32)),
            "links": pa.array(np.add.reduceat(each, starts)), "dense": pa.array(np.full(len(n), kind)), "bitmap": bitmap, "planes": _binary(*_planes(n, each, starts)),
        }


def members(dense: bool, bitmaps: list[bytes], planes: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, multiplicity) of postings of one kind in turn; ``docs`` has their numbers of documents."""
    raw = np.frombuffer(b"".join(bitmaps), np.uint8)
    places = np.nonzero(np.unpackbits(raw).reshape(len(bitmaps), -1))[1] if dense else raw.view("<u2").astype(np.int64)
    times = np.ones(len(places), np.int64)
    width = -(-docs // 8)
    size = np.array([len(x) for x in planes], np.int64)
    depth = size // np.maximum(width, 1)
    if depth.any():
        flat, begin = np.unpackbits(np.frombuffer(b"".join(planes), np.uint8)), np.cumsum(size) - size
        times[np.repeat(depth > 0, docs)] = 0
        for k in range(int(depth.max())):
            has = depth > k
            bit = np.repeat(8 * (begin[has] + k * width[has]), docs[has]) + _places(docs[has])
            times[np.repeat(has, docs)] += flat[bit].astype(np.int64) << k
    return places, times


def _row(block: int, count: int, **columns) -> pa.RecordBatch:
    schema = _arrow(_ROW)
    data = {"block": pa.array(np.full(count, block)), **columns}
    return pa.RecordBatch.from_arrays([data.get(f.name, pa.nulls(count, f.type)) for f in schema], schema=schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in schema.split(", "))])


def _index(files: tuple[str, str]):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, block = aligner(*files).memo, TaskContext.get().partitionId() << 24
        docs: list[tuple] = []
        pairs: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        links = 0

        def flush() -> Iterator[pa.RecordBatch]:
            columns = {n: pa.array([d[k] for d in docs], pa.string() if n == "groups_sha256" else pa.int64()) for k, n in enumerate(_DOC_NAMES)}
            yield _row(block, len(docs), place=pa.array(np.arange(len(docs), dtype=np.int32)), **columns)
            if links:
                for posting in postings(np.concatenate(pairs), np.concatenate(owners), len(docs)):
                    yield _row(block, len(posting["a"]), **posting)

        for batch in batches:
            for rows in parts(batch, limit=SLICE_BYTES):
                distinct, codes, bounds = pieces_of(rows.column("text"), spaced=True)
                found = memo(distinct.to_pylist())
                numbers = np.array([x[:4] for x in found], np.int64).reshape(-1, 4)[codes]
                sums = np.zeros((len(codes) + 1, 4), np.int64)
                np.cumsum(numbers, axis=0, out=sums[1:])
                total = sums[bounds[1:]] - sums[bounds[:-1]]
                flat, edges = gathered(*joined([x[4] for x in found], np.dtype("<i8")), codes, bounds)
                texts = [x[5] for x in found]
                for k, (doc_id, text) in enumerate(zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist(), strict=True)):
                    lo, hi = bounds[k], bounds[k + 1]
                    own = flat[edges[k] : edges[k + 1]]
                    if not text or total[k, 0] != hi - lo:
                        doc, own = (doc_id, 0, 0, 0, 0, ""), own[:0]
                    else:
                        groups = ";".join([texts[c] for c in codes[lo:hi].tolist()])
                        doc = (doc_id, *total[k, 1:].tolist(), len(own), hashlib.sha256(groups.encode()).hexdigest())
                    if docs and (links + len(own) > BLOCK_LINKS or len(docs) == BLOCK_DOCS):
                        yield from flush()
                        block, docs, pairs, owners, links = block + 1, [], [], [], 0
                    owners.append(np.full(len(own), len(docs), np.int64))
                    docs.append(doc)
                    pairs.append(own)
                    links += len(own)
        if docs:
            yield from flush()

    return work


def index(docs: DataFrame, bytes_file: str = BYTES_FILE, pieces_file: str = PIECES_FILE) -> DataFrame:
    """Blocks of documents, written: a row per document (``place`` in its block) and a row per posting (``place`` null)."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialise(map_batches(plain, _index((bytes_file, pieces_file)), _ROW), "pair_index")


def pair_counts(indexed: DataFrame) -> DataFrame:
    """(a, b, documents, count, best): documents and links that have a pair, and whether no pair of the same ``b`` has more links."""
    rows = indexed.where("place IS NULL").groupBy("a", "b").agg(F.sum("docs").alias("documents"), F.sum("links").alias("count"))
    rows = materialise(rows, "pair_sums")
    most = rows.groupBy("b").agg(F.max("count").alias("most"))
    return materialise(rows.join(most, "b").select("a", "b", "documents", "count", (F.col("count") == F.col("most")).alias("best")), "pair_counts")


_SCORED = f"{_DOC}, n_best long, count_sum long"


def _scores(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From blocks in order, documents before postings: the documents with their scores."""
    block, held, best, total = None, [], None, None

    def done() -> pa.RecordBatch:
        docs = pa.concat_batches(held)
        names = [f.name for f in _arrow(_SCORED)]
        return pa.RecordBatch.from_arrays([*(docs.column(n) for n in _DOC_NAMES), pa.array(best), pa.array(total)], names)

    for batch in batches:
        blocks = batch.column("block").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(blocks)) + 1, [len(blocks)]])
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if hi == lo:
                continue
            if blocks[lo] != block:
                if block is not None:
                    yield done()
                block, held, best = int(blocks[lo]), [], None
            part = batch.slice(lo, hi - lo)
            of_docs = part.column("place").is_valid()
            if (rows := part.filter(of_docs)).num_rows:
                held.append(rows)
                size = sum(x.num_rows for x in held)
                best, total = np.zeros(size, np.int64), np.zeros(size, np.int64)  # documents come before postings
            for kind in (False, True):
                some = part.filter(pc.fill_null(pc.equal(part.column("dense"), kind), False))
                if some.num_rows:
                    docs = some.column("docs").to_numpy().astype(np.int64)
                    at, times = members(kind, some.column("bitmap").to_pylist(), some.column("planes").to_pylist(), docs)
                    np.add.at(total, at, times * np.repeat(some.column("count").to_numpy(), docs))
                    np.add.at(best, at, times * np.repeat(some.column("best").to_numpy(zero_copy_only=False).astype(np.int64), docs))
    if block is not None:
        yield done()


def align(docs: DataFrame, bytes_file: str = BYTES_FILE, pieces_file: str = PIECES_FILE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and texts that either tokenizer does not give back byte by byte, have no tokens: zeros and an empty
    ``groups_sha256``. Repeated rows are documents of their own and count each. Other columns are ignored; an empty
    table gives an empty one. A frequent pair has a posting per block, so its counts are sums of few numbers and its postings
    stay spread over the blocks.
    """
    indexed = index(docs, bytes_file, pieces_file)
    counts = pair_counts(indexed)
    # pairs grow with the corpus up to the product of the vocabularies: merged at every size, never broadcast
    found = indexed.where("place IS NULL").select("block", *_POSTING_NAMES).hint("merge").join(counts.select("a", "b", "count", "best"), ["a", "b"])
    rows = indexed.where("place IS NOT NULL").select("block", "place", *_DOC_NAMES)
    both = rows.unionByName(found.drop("a", "b", "links"), allowMissingColumns=True)
    order = both.repartition("block").sortWithinPartitions("block", F.col("place").asc_nulls_last())
    out = map_batches(order, _scores, _SCORED)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
