"""Language-model scores by context-tree weighting over bytes, and an add-one word baseline.

A byte is eight binary decisions; each decision has its own context tree over the bytes before it.
A node holds how often 0 and 1 followed and their Krichevsky-Trofimov estimate. A node's weighted
probability is the mean of its own estimate and the product of its children's, so the prediction
mixes the estimates of all depths, each by its evidence in the training texts.

The tree goes ``DEPTH`` bytes deep and keeps every context in which ``LEAST`` training bytes stand, so it grows with the
corpus. Rarer contexts of a parent form one leaf together; no training byte is left out. Counts come from all documents: each task
sums its (DEPTH + 1)-byte runs and Spark adds them up. The subtrees below two context bytes are weighed in groups (``subtree``); what is
above has a fixed size (``Crown``). Every distinct run gets its value in a table: documents meet the runs seen most in memory, the others by a join.

``fit_tree`` is the dense form for few contexts, of one table of 256 values a context; the query does not use it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourpanel.llm.text import encoded, id_bucket, map_batches, slices
from hourpanel.session import materialise

DEPTH = 4
RUN_BITS = 8 * (DEPTH + 1)
OWNERS = 1 << (64 - RUN_BITS)  # documents handled at once: a run and its document make one number of 64 bits
TOP = 2  # a task holds the subtree below a context of so many bytes; above are at most 256 contexts and the root
LEAST = 2  # training bytes that must stand in a context for a node of its own, at every size of the corpus
CONTEXTS = 16384  # of the dense form
FREQUENT_RUNS = 1 << 18  # runs whose values every task holds; all others are looked up by a join
FREQUENT = 1 << 16  # words whose counts every task holds; all others are looked up by a join
HELD_OUT = (7, 2)  # a row is held out if crc32(doc_id) % 7 == 2
PAD, END = 0xFE, 0xFF  # bytes that UTF-8 never has: before the text, and its end
WORDS_AT_ONCE = 400_000  # distinct words a task holds before it hands them on


def _runs(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(code, document number) at every byte and end of every text: the byte with the DEPTH before it, oldest in the high bits."""
    pad = bytes([PAD]) * DEPTH
    data = np.frombuffer(b"".join(pad + x.lower() + b"\xff" for x in raw), np.uint8).astype(np.uint64)
    code = data[: len(data) - DEPTH]
    for j in range(1, DEPTH + 1):
        code = (code << np.uint64(8)) | data[j : len(data) - DEPTH + j]
    owner = np.repeat(np.arange(len(raw)), [len(x) + 1 + DEPTH for x in raw])[DEPTH:]
    real = data[DEPTH:] != PAD
    return code[real], owner[real]


def _count_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = encoded(batch.column("text"))
        for a, b in slices(raw, 4 << 20):
            code, n = np.unique(_runs(raw[a:b])[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(n, pa.int64())], ["code", "n"])


class Tree:
    """The kept contexts of each depth and the log10 probability of every byte in every state.

    A state is a kept context of full depth, or what is left of a shallower one after its kept children.
    """

    def __init__(self, kept: list[np.ndarray]):
        self.kept = kept  # by depth 0..DEPTH, sorted
        sizes = [len(k) for k in kept]
        self.base = np.concatenate([[0], np.cumsum(sizes)])  # one state per kept context: leaf at full depth, rest above
        self.table = np.zeros((0, 256), np.float32)

    def states(self, code: np.ndarray) -> np.ndarray:
        context = code >> np.uint64(8)
        out = np.zeros(len(code), np.int64)
        todo = np.arange(len(code))
        for depth in range(DEPTH, 0, -1):
            own = context[todo] & np.uint64((1 << 8 * depth) - 1)
            kept = self.kept[depth]
            if len(kept):
                at = np.minimum(np.searchsorted(kept, own), len(kept) - 1)
                hit = kept[at] == own
                out[todo[hit]] = self.base[depth] + at[hit]
                todo = todo[~hit]
        return out

    def weigh(self, state: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> None:
        """Fill the table from the training counts of (state, symbol)."""
        total = int(self.base[-1])
        counts = np.zeros((total, 256))
        np.add.at(counts, (state, symbol), n)
        parent = np.full(total, -1)
        for depth in range(1, DEPTH + 1):
            up = self.kept[depth] & np.uint64((1 << 8 * (depth - 1)) - 1)
            parent[self.base[depth] : self.base[depth + 1]] = self.base[depth - 1] + np.searchsorted(self.kept[depth - 1], up)
        table = np.zeros((total, 256))
        for level in range(8):
            own = counts.reshape(total, 1 << level, 2, -1).sum(axis=-1)  # of the state: leaf or rest
            table += np.repeat(np.log10(self._predict(own, parent)).reshape(total, -1), 1 << (7 - level), axis=1)
        self.table = table.astype(np.float32)

    def _predict(self, own: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """Mixed probability of each bit in each state. ``own``: counts (state, decision, bit)."""
        inner = own.copy()  # counts of the kept context as a tree node: its rest and its kept children
        for depth in range(DEPTH, 0, -1):
            part = slice(self.base[depth], self.base[depth + 1])
            np.add.at(inner, parent[part], inner[part])
        log_inner, log_rest = log_kt(inner), log_kt(own)
        children = log_rest.copy()  # the rest is a leaf child of its context
        weighted = log_inner.copy()
        for depth in range(DEPTH, -1, -1):
            part = slice(self.base[depth], self.base[depth + 1])
            if depth < DEPTH:
                weighted[part] = np.logaddexp(log_inner[part], children[part]) - np.log(2)
            if depth:
                np.add.at(children, parent[part], weighted[part])
        share = np.exp(log_inner - np.log(2) - weighted)  # how much a node trusts its own estimate

        def estimate(c: np.ndarray) -> np.ndarray:
            return (c + 0.5) / (c.sum(axis=-1, keepdims=True) + 1)

        here = estimate(inner)
        full = np.arange(len(own)) >= self.base[DEPTH]
        p = np.where(full[:, None, None], here, estimate(own))
        node = np.where(full, parent, np.arange(len(own)))  # the context above a leaf, or the one whose rest this is
        while (node >= 0).any():
            at = np.flatnonzero(node >= 0)
            w = share[node[at]][..., None]
            p[at] = w * here[node[at]] + (1 - w) * p[at]
            node[at] = parent[node[at]]
        return p


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural log of the gamma function for x > 0: Stirling's series after a shift by eight."""
    product = np.ones_like(x)
    for k in range(8):
        product = product * (x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(product)


def log_kt(counts: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of (zeros, ones) on the last axis."""
    a, b = counts[..., 0], counts[..., 1]
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1) - np.log(np.pi)


def fit_tree(texts: DataFrame, contexts: int = CONTEXTS) -> Tree:
    """The weighted tree of all rows of ``texts`` (column text)."""
    spark = texts.sparkSession
    runs = materialise(map_batches(texts.select("text"), _count_runs, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")), "byte_runs")
    total = runs.agg(F.sum("n")).first()[0] or 0
    least = max(1, -(-total // contexts))
    levels = [F.struct(F.lit(d).alias("depth"), F.shiftright("code", 8).bitwiseAND(F.lit((1 << 8 * d) - 1)).alias("context")) for d in range(1, DEPTH + 1)]
    seen = runs.select("n", F.explode(F.array(*levels)).alias("c")).groupBy("c.depth", "c.context").agg(F.sum("n").alias("n"))
    kept: list[list[int]] = [[0]] + [[] for _ in range(DEPTH)]
    for row in seen.where(F.col("n") >= least).select("depth", "context").collect():  # at most CONTEXTS a depth
        kept[row["depth"]].append(row["context"])
    tree = Tree([np.array(sorted(k), np.uint64) for k in kept])

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column("code").to_numpy().astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree.states(code)), pa.array((code & np.uint64(255)).astype(np.int64)), batch.column("n")], ["state", "symbol", "n"]
            )

    grouped = map_batches(runs, place, "state long, symbol long, n long").groupBy("state", "symbol").agg(F.sum("n").alias("n"))
    found = grouped.toArrow()
    tree.weigh(*(found.column(c).to_numpy() for c in ("state", "symbol", "n")))
    return tree


def _classes(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each class of equal values begins in a sorted array, and its size."""
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])
    return first, np.diff(first, append=len(ordered))


def _dealt(raw: list[bytes]) -> Iterator[tuple[int, int]]:
    """Row ranges as of ``slices``, of at most ``OWNERS`` rows."""
    for a, b in slices(raw):
        for i in range(a, b, OWNERS):
            yield i, min(i + OWNERS, b)


def _meet(code: np.ndarray, owner: np.ndarray, held: np.ndarray, value: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The sum of the values of each document's runs that are ``held`` (sorted), and the others as distinct (owner, code, times), sorted.

    Runs are sorted as numbers with their owner in the low bits, so each distinct run is looked up once for all documents.
    """
    low = np.uint64(64 - RUN_BITS)
    both = np.sort((code << low) | owner.astype(np.uint64))
    first, size = _classes(both >> low)
    code, owner = (both[first] >> low).astype(np.int64), (both & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    if len(held):
        at = np.minimum(np.searchsorted(held, code), len(held) - 1)
        hit = held[at] == code
        known = np.where(hit, value[at], 0.0)
    else:
        hit, known = np.zeros(len(code), bool), np.zeros(len(code))
    scores = np.bincount(owner, np.repeat(known, size), documents)
    other = np.repeat(~hit, size)
    pairs = np.sort((owner[other].astype(np.uint64) << np.uint64(RUN_BITS)) | (both[other] >> low))
    first, times = _classes(pairs)
    pairs = pairs[first]
    return scores, (pairs >> np.uint64(RUN_BITS)).astype(np.int64), (pairs & np.uint64((1 << RUN_BITS) - 1)).astype(np.int64), times


def _count_both(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(code, n, seen): how often a run stands in training texts and in all."""
    for batch in batches:
        raw = encoded(batch.column("text"))
        training = ~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        for a, b in slices(raw, 4 << 20):
            code, owner = _runs(raw[a:b])
            code = np.sort((code << np.uint64(1)) | training[a:b][owner])  # the lowest bit: whether it stands in a training text
            first, seen = _classes(code >> np.uint64(1))
            n = np.add.reduceat(code & np.uint64(1), first).astype(np.int64) if len(first) else seen
            code = code[first] >> np.uint64(1)
            yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(n), pa.array(seen, pa.int64())], ["code", "n", "seen"])


def _estimate(zeros: np.ndarray, ones: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (np.where(bit, ones, zeros) + 0.5) / (zeros + ones + 1)


def subtree(code: np.ndarray, n: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray] | None:
    """For the distinct runs below one context of ``TOP`` bytes: the probability of each run's eight bits mixed down to that context
    (runs, 8), and the weighted log probability of the context's 255 decisions by heap number. None if the context is not kept."""
    context, symbol = code >> np.uint64(8), (code & np.uint64(255)).astype(np.int64)
    own = {d: context & np.uint64((1 << 8 * d) - 1) for d in range(TOP, DEPTH + 1)}
    kept = {}
    for d, c in own.items():
        _, at = np.unique(c, return_inverse=True)
        kept[d] = np.bincount(at, n)[at] >= least
    if not kept[TOP][0]:
        return None
    state = TOP + sum(kept[d].astype(np.int64) for d in range(TOP + 1, DEPTH + 1))
    p, weights = np.zeros((len(code), 8)), np.zeros(256)
    for level in range(8):
        prefix, bit = symbol >> (8 - level), (symbol >> (7 - level)) & 1
        below = None
        shares, heres = {}, {}
        for d in range(DEPTH, TOP - 1, -1):
            _, first, at = np.unique((own[d] << np.uint64(level)) | prefix.astype(np.uint64), return_index=True, return_inverse=True)

            def sums(count: np.ndarray, at: np.ndarray = at, bit: np.ndarray = bit, size: int = len(first)) -> np.ndarray:
                return np.stack([np.bincount(at, count * (1 - bit), size), np.bincount(at, count * bit, size)], axis=-1)

            inner = sums(n)
            log_inner = log_kt(inner)
            heres[d] = _estimate(*inner[at].T, bit)
            if d == DEPTH:
                weighted = log_inner
                p[:, level] = heres[d]
            else:
                rest = sums(n * (state == d))
                child, child_first, child_kept = below
                children = log_kt(rest) + np.bincount(at[child_first], child * child_kept, len(first))
                weighted = np.logaddexp(log_inner, children) - np.log(2)
                shares[d] = np.exp(log_inner - np.log(2) - weighted)[at]
                p[:, level] = np.where(state == d, _estimate(*rest[at].T, bit), p[:, level])
            below = (weighted, first, kept[d][first])
        for d in range(DEPTH - 1, TOP - 1, -1):
            p[:, level] = np.where(state >= d, shares[d] * heres[d] + (1 - shares[d]) * p[:, level], p[:, level])
        weights[(1 << level) + prefix[below[1]]] = below[0]
    return p, weights


def _heap(counts: np.ndarray) -> np.ndarray:
    """(contexts, heap number of a decision, bit) from (contexts, symbol)."""
    out = np.zeros((len(counts), 256, 2))
    for level in range(8):
        out[:, 1 << level : 2 << level] = counts.reshape(len(counts), 1 << level, 2, -1).sum(axis=-1)
    return out


class Crown:
    """The tree above ``TOP`` bytes: contexts of one byte and the root, from sums per last byte (at most 256 rows)."""

    def __init__(self, byte: np.ndarray, sums: np.ndarray, least: int):
        below, rest, counts = (np.zeros((256, 256)) for _ in range(3))  # weighted logs of kept contexts of two bytes; counts of the others; all
        below[byte], rest[byte], counts[byte] = sums[:, 0], sums[:, 1], sums[:, 2]
        self.kept = counts.sum(axis=1) >= least
        self.inner, self.rest = _heap(counts), _heap(rest)
        log_inner = log_kt(self.inner)
        weighted = np.logaddexp(log_inner, log_kt(self.rest) + below) - np.log(2)
        self.share = np.exp(log_inner - np.log(2) - weighted)
        self.root, self.root_rest = _heap(counts.sum(axis=0)[None])[0], _heap(counts[~self.kept].sum(axis=0)[None])[0]
        log_root = log_kt(self.root)
        whole = np.logaddexp(log_root, log_kt(self.root_rest) + weighted[self.kept].sum(axis=0)) - np.log(2)
        self.root_share = np.exp(log_root - np.log(2) - whole)

    def log10(self, code: np.ndarray, p: np.ndarray) -> np.ndarray:
        """log10 probability of runs; ``p`` from ``subtree``, NaN where their context of ``TOP`` bytes is not kept."""
        symbol, byte = (code & 255), (code >> 8) & 255
        total = np.zeros(len(code))
        for level in range(8):
            node, bit = (1 << level) + (symbol >> (8 - level)), (symbol >> (7 - level)) & 1
            inner, rest, share = self.inner[byte, node], self.rest[byte, node], self.share[byte, node]
            q = np.where(np.isnan(p[:, level]), _estimate(*rest.T, bit), p[:, level])
            q = share * _estimate(*inner.T, bit) + (1 - share) * q
            q = np.where(self.kept[byte], q, _estimate(*self.root_rest[node].T, bit))
            share = self.root_share[node]
            total += np.log10(share * _estimate(*self.root[node].T, bit) + (1 - share) * q)
        return total


def run_values(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """Written rows (code, seen, value) of every distinct run of ``rows`` (text, held_out): log10 probability of its last byte, learned from rows not held out."""
    runs = map_batches(rows.select("text", "held_out"), _count_both, "code long, n long, seen long").groupBy("code").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))

    def below(table: pa.Table) -> pa.Table:
        code, n = table.column("code").to_numpy().astype(np.uint64), table.column("n").to_numpy()
        order = np.argsort(code)
        code, n, seen = code[order], n[order], table.column("seen").to_numpy()[order]
        pair = int(code[0] >> np.uint64(8)) & 0xFFFF
        counts = np.bincount((code & np.uint64(255)).astype(np.int64), n, 256)
        found = subtree(code, n, least)
        top = np.stack([found[1], np.zeros(256), counts] if found else [np.zeros(256), counts, counts])
        mixed = [x.tobytes() for x in found[0]] if found else [None] * len(code)
        return pa.table(
            {
                "code": pa.array([*code.astype(np.int64).tolist(), -1 - pair], pa.int64()), "seen": pa.array([*seen.tolist(), 0], pa.int64()),
                "mixed": pa.array([*mixed, top.tobytes()], pa.binary()),
            }
        )

    pair = F.shiftright("code", 8).bitwiseAND(F.lit(0xFFFF))
    nodes = materialise(runs.groupBy(pair.alias("pair")).applyInArrow(below, "code long, seen long, mixed binary"), "tree_nodes")

    def add_up(table: pa.Table) -> pa.Table:
        pairs = table.column("code").to_numpy()
        rows = [np.frombuffer(x, float) for x in table.column("mixed").to_pylist()]
        total = sum(rows[k] for k in np.argsort(pairs).tolist())  # in one order, so that reruns agree
        return pa.table({"byte": pa.array([int(-1 - pairs[0]) & 255], pa.int64()), "sums": pa.array([total.tobytes()], pa.binary())})

    tops = nodes.where("code < 0").groupBy((-1 - F.col("code")).bitwiseAND(F.lit(255)).alias("byte")).applyInArrow(add_up, "byte long, sums binary").toArrow()
    sums = np.frombuffer(b"".join(tops.column("sums").to_pylist()), float).reshape(-1, 3, 256)
    shared = rows.sparkSession.sparkContext.broadcast(Crown(tops.column("byte").to_numpy(), sums, least))
    unknown = np.full(8, np.nan).tobytes()

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column("code").to_numpy()
            p = np.frombuffer(b"".join(unknown if x is None else x for x in batch.column("mixed").to_pylist()), float).reshape(-1, 8)
            yield pa.RecordBatch.from_arrays([batch.column("code"), batch.column("seen"), pa.array(shared.value.log10(code, p))], ["code", "seen", "value"])

    return materialise(map_batches(nodes.where("code >= 0"), finish, "code long, seen long, value double"), "run_values")


def most_seen(values: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs and values of at most ``limit`` runs, those seen most often, sorted by run; whole classes of like counts."""
    rank = F.floor(F.log2("seen") * 8).cast("long")
    left, cut = limit, None
    for row in sorted(values.groupBy(rank.alias("rank")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["rank"]):
        left -= row["n"]
        if left < 0:
            break
        cut = row["rank"]
    if cut is None:
        return np.zeros(0, np.int64), np.zeros(0)
    found = values.where(rank >= cut).select("code", "value").toArrow()
    code, value = found.column("code").to_numpy(), found.column("value").to_numpy()
    order = np.argsort(code)
    return code[order], value[order]


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[bytes] = Counter()

    def handed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for x in encoded(batch.column("text")):
            held.update(x.lower().split())
            if len(held) > WORDS_AT_ONCE:
                yield handed()
                held.clear()
    if held:
        yield handed()


def score_texts(docs: DataFrame, modulus: int = HELD_OUT[0], remainder: int = HELD_OUT[1], least: int = LEAST, frequent: int = FREQUENT, frequent_runs: int = FREQUENT_RUNS) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    ``score`` is the tree's log10 probability of the lower-cased text and its end; ``bits_per_byte`` its
    code length over the bytes, the end counted as one. Null text counts as empty: one token, the end.
    A null identifier counts as empty text in the split. Without training rows every bit has
    probability 1/2 and no token is known. Repeated rows count as often as they stand. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (id_bucket("doc_id", modulus) == remainder).alias("held_out"), "text"
    )
    training = rows.where(~F.col("held_out"))
    words = materialise(map_batches(training.select("text"), _count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")), "word_counts")
    ends = training.count()
    sums = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, distinct = sums["n"] + ends, sums["v"] + (1 if ends else 0)
    values = run_values(rows, least)
    top = words.orderBy(F.desc("c"), "word").limit(frequent).toArrow()
    shared = spark.sparkContext.broadcast((*most_seen(values, frequent_runs), dict(zip(top.column("word").to_pylist(), top.column("c").to_pylist(), strict=True))))
    end_log = float(np.log10(ends + 1))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_value, counts = shared.value
        logs = {w: float(np.log10(c + 1)) for w, c in counts.items()}
        for batch in batches:
            raw = encoded(batch.column("text"))
            for a, b in _dealt(raw):
                scores, owner, runs, run_times = _meet(*_runs(raw[a:b]), held, held_value, b - a)
                bounds = pa.array(np.searchsorted(owner, np.arange(b - a + 1)), pa.int32())
                out = []
                for text in raw[a:b]:
                    tokens = text.lower().split()
                    own = Counter(tokens)
                    base = sum(map(mul, own.values(), map(logs.get, own, repeat(0.0))), end_log)
                    rare = [w for w in own if w not in logs]
                    times = [own[w] for w in rare]
                    out.append((len(tokens) + 1, len(tokens) - sum(times) + bool(ends), base, rare, times))
                n_tokens, known, base, rare, times = zip(*out, strict=True)
                size = np.array([len(x) + 1 for x in raw[a:b]])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a), batch.column("held_out").slice(a, b - a),
                        pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()),
                        pa.array(scores, pa.float64()), pa.array(size, pa.int64()),
                        pa.ListArray.from_arrays(bounds, pa.array(runs, pa.int64())), pa.ListArray.from_arrays(bounds, pa.array(run_times, pa.int64())),
                        pa.array(rare, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "held_out", "n_tokens", "known", "base", "score", "size", "runs", "run_times", "rare", "times"],
                )

    schema = "doc_id long, held_out boolean, n_tokens long, known long, base double, score double, size long, runs array<long>, run_times array<long>, rare array<binary>, times array<long>"
    scored = materialise(map_batches(rows, work, schema).select(F.monotonically_increasing_id().alias("row_no"), "*"), "text_scores")
    rare = scored.select("row_no", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row_no", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    looked = rare.join(words, "word").groupBy("row_no").agg(F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("rare_base"), F.sum("times").alias("rare_known"))
    other = scored.select("row_no", F.explode(F.arrays_zip("runs", "run_times")).alias("x")).select("row_no", F.col("x.runs").alias("code"), F.col("x.run_times").alias("times"))
    other = other.join(values.select("code", "value"), "code").groupBy("row_no").agg(F.sum(F.col("times") * F.col("value")).alias("rare_score"))
    out = scored.drop("rare", "times", "runs", "run_times").join(looked, "row_no", "left").join(other, "row_no", "left")
    score = F.col("score") + F.coalesce("rare_score", F.lit(0.0))
    norm = float(np.log10(total + distinct + 1))
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        score.alias("score"), (-score / F.lit(float(np.log10(2))) / F.col("size")).alias("bits_per_byte"),
    )
