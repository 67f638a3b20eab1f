"""Toxicity by class-conditional Kneser-Ney bigram models.

Two models, of toxic and of ordinary labelled texts, with absolute discounting. Both back off to
the same lower-order distribution, the continuation counts of the two classes together, so a word
that is rare in either class gets nearly the same probability from both and decides nothing.

Below the word, a second pair of models runs over the bytes inside words: the next byte after ``GRAM`` - 1 others, again backing
off to continuation counts that both classes share. It knows a stem in compounds and with endings that were never seen as whole words.

A text is described, for words and for bytes, by the log-likelihood ratio per step over the whole text and by its
``PEAKS`` largest word ratios, as one word can make a long text toxic. A logistic curve, fitted on labelled rows
that the counts have not seen, turns them into a probability.

Models are fitted on a bounded sample of the labelled rows (``FIT_DOCS`` and ``CURVE_DOCS`` a class). Equal texts
count once, and an expression counts once a text, so a repetition proves nothing; one in fewer than
``LEAST_DOCS`` texts is treated as unseen and left to the shared counts. Scoring reads whole texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourpanel.llm.text import encoded, id_bucket, map_batches
from hourpanel.session import materialise

FIT_DOCS = 3000
CURVE_DOCS = 1500
DISCOUNT = 0.75
PEAKS = 3
LEAST_DOCS = 10
HELD_OUT = 5
GRAM = 6  # bytes of an expression inside a word
FEATURES = tuple(f"{kind}{name}" for kind in ("", "inner_") for name in ("ratio", *(f"peak_{k + 1}" for k in range(PEAKS))))

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(raw: bytes) -> list[bytes]:
    return _WORD.findall(raw.lower())


def labelled_sample(docs: DataFrame, labels: DataFrame, modulus: int = HELD_OUT) -> DataFrame:
    """(toxic, curve, weight, text) of the rows to learn from. ``weight`` undoes the sampling of a class."""
    known = labels.where(F.col("toxic").isin(0, 1) & (id_bucket("doc_id", modulus) != 0)).groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    known = known.withColumn("curve", id_bucket("l_id", modulus) == 1)
    sizes = known.groupBy("toxic", "curve").agg(F.count("*").alias("n")).select(F.col("toxic").alias("s_toxic"), F.col("curve").alias("s_curve"), "n")
    sizes = materialise(sizes, "toxic_sizes")  # at most four rows, known to be small when it is joined
    chance = F.shiftrightunsigned(F.xxhash64("l_id", F.lit(71)), 11).cast("double") / F.lit(float(1 << 53))
    rate = F.least(F.lit(1.0), F.when(F.col("curve"), F.lit(float(CURVE_DOCS))).otherwise(F.lit(float(FIT_DOCS))) / F.col("n"))
    drawn = known.join(sizes, (F.col("toxic") == F.col("s_toxic")) & (F.col("curve") == F.col("s_curve"))).where(chance < rate)
    drawn = materialise(drawn.select("l_id", "toxic", "curve", (1 / rate).alias("weight")), "toxic_sample")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(drawn, F.col("doc_id") == F.col("l_id")).select("toxic", "curve", "weight", "text").dropDuplicates(["text"])


def _count_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held: tuple[Counter, Counter] = (Counter(), Counter())
        for label, raw in zip(batch.column("toxic").to_pylist(), encoded(batch.column("text")), strict=True):
            own = words_of(raw)
            held[label].update(set(zip([b"", *own], own, strict=False)))
        for label in (0, 1):
            if held[label]:
                before, word = zip(*held[label], strict=True)
                n = pa.array(list(held[label].values()), pa.int64())
                none = pa.array([0] * len(n), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(before, pa.binary()), pa.array(word, pa.binary()), n if label else none, none if label else n], ["before", "word", "toxic", "plain"]
                )


class Ratio:
    """log p_toxic - log p_plain of a word after another, from counts of both classes."""

    def __init__(self, vocabulary: dict, contexts: dict, pairs: dict):
        self.ids = {w: i + 1 for i, w in enumerate(vocabulary["word"])}  # 0: any other word
        n = np.stack([vocabulary["plain"], vocabulary["toxic"]]).astype(float)
        totals = vocabulary["totals"]  # words and distinct words of each class, kept or not
        size = np.array([max(1.0, totals["plain"]), max(1.0, totals["toxic"])])[:, None]
        types = np.array([totals["plain_types"], totals["toxic_types"]], float)[:, None]
        backoff = np.maximum(DISCOUNT * types / size, 1e-6)
        followed = np.concatenate([[1.0], vocabulary["followed"]]) / max(1.0, totals["pairs"] + 1)  # shared by both classes
        counted = np.concatenate([np.zeros((2, 1)), np.maximum(n - DISCOUNT, 0) / size], axis=1)
        self.word = counted + backoff * followed
        self.single = np.log(self.word[1]) - np.log(self.word[0])
        at = np.array([0] + [self.ids.get(w, 0) for w in contexts["before"]], np.int64)[1:]
        self.back = np.ones((2, len(self.ids) + 2))  # last: the beginning of a text
        self.total = np.zeros((2, len(self.ids) + 2))
        first = len(self.ids) + 1
        at = np.array([first if w == b"" else i for w, i in zip(contexts["before"], at, strict=True)], np.int64)
        inside = at > 0
        for c, name in enumerate(("plain", "toxic")):
            total = np.asarray(contexts[name], float)[inside]
            kinds = np.asarray(contexts[f"{name}_types"], float)[inside]
            self.total[c, at[inside]] = total
            self.back[c, at[inside]] = np.where(total > 0, np.maximum(DISCOUNT * kinds / np.maximum(total, 1), 1e-6), 1.0)
        self.shift = np.log(self.back[1]) - np.log(self.back[0])
        self.width = len(self.ids) + 2
        left = np.array([first if w == b"" else self.ids.get(w, 0) for w in pairs["before"]], np.int64)
        right = np.array([self.ids.get(w, 0) for w in pairs["word"]], np.int64)
        use = (left > 0) & (right > 0)
        left, right = left[use], right[use]
        p = []
        for c, name in enumerate(("plain", "toxic")):
            k = np.maximum(np.asarray(pairs[name], float)[use] - DISCOUNT, 0) / np.maximum(self.total[c, left], 1)
            p.append(k + self.back[c, left] * self.word[c, right])
        code = left * self.width + right
        order = np.argsort(code)
        self.code, self.pair = code[order], (np.log(p[1]) - np.log(p[0]))[order]
        self.first = first
        del self.word, self.back, self.total

    def features(self, raw: bytes) -> list[float]:
        """Mean ratio of the words, and the largest ones."""
        own = words_of(raw)
        if not own:
            return _described(np.zeros(0), np.zeros(0))
        get = self.ids.get
        ids = np.array([self.first, *(get(w, 0) for w in own)], np.int64)
        value = self.shift[ids[:-1]] + self.single[ids[1:]]
        if len(self.code):
            code = ids[:-1] * self.width + ids[1:]
            at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
            value = np.where(self.code[at] == code, self.pair[at], value)
        return _described(value, value)


def _described(steps: np.ndarray, words: np.ndarray) -> list[float]:
    """The mean of ``steps`` and the PEAKS largest of ``words``, 0 for those that are not there."""
    top = np.sort(np.partition(words, -PEAKS)[-PEAKS:] if len(words) > PEAKS else words)[::-1].tolist()
    return [float(steps.mean()) if len(steps) else 0.0, *top, *[0.0] * (PEAKS - len(top))]


def inner_grams(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(code, number of its word) of all runs of GRAM bytes inside the words, a space standing for each end of a word."""
    own = words_of(raw)
    text = np.frombuffer(b" " + b" ".join(own) + b" ", np.uint8).astype(np.int64)
    n = len(text) - GRAM + 1
    if not own or n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.zeros(n, np.int64)
    for k in range(GRAM):
        code = code << 8 | text[k : k + n]
    spaces = np.concatenate([[0], np.cumsum(text == 32)])
    at = np.flatnonzero(spaces[GRAM - 1 : GRAM - 1 + n] == spaces[1 : 1 + n])  # no space but at either end
    return code[at], spaces[1:][at] - 1


def _count_inner(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label = batch.column("toxic").to_numpy()
        found = [np.unique(inner_grams(x)[0]) for x in encoded(batch.column("text"))]
        for kind in (0, 1):
            own = [x for x, t in zip(found, label, strict=True) if t == kind]
            gram, count = np.unique(np.concatenate(own) if own else np.zeros(0, np.int64), return_counts=True)
            none = np.zeros(len(gram), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(count if kind else none), pa.array(none if kind else count)], ["gram", "toxic", "plain"])


class Inner:
    """log p_toxic - log p_plain of a byte after GRAM - 1 others, from the texts of each class that have the run."""

    def __init__(self, gram: np.ndarray, plain: np.ndarray, toxic: np.ndarray):
        order = np.argsort(gram)
        self.gram, n = gram[order], np.stack([plain, toxic])[:, order].astype(float)
        context = self.gram >> 8
        self.context, at = np.unique(context, return_inverse=True)
        total = np.stack([np.bincount(at, x, len(self.context)) for x in n])
        types = np.stack([np.bincount(at, x > 0, len(self.context)) for x in n])
        # the shared lower order: how many bytes come before a run without its first byte, in either class
        shorter, where = np.unique(self.gram & ((1 << 8 * (GRAM - 1)) - 1), return_inverse=True)
        follows = np.bincount(where, minlength=len(shorter)).astype(float)
        stem, of = np.unique(shorter >> 8, return_inverse=True)
        below = follows[where] / np.bincount(of, follows, len(stem))[of[where]]
        back = DISCOUNT * (types + 1) / (total + 1)
        p = np.maximum(n - DISCOUNT, 0) / (total[:, at] + 1) + back[:, at] * below
        self.value = np.log(p[1]) - np.log(p[0]) if len(self.gram) else np.zeros(0)
        self.shift = np.log(back[1]) - np.log(back[0])

    def ratios(self, code: np.ndarray) -> np.ndarray:
        if not len(self.gram):
            return np.zeros(len(code))
        at = np.minimum(np.searchsorted(self.gram, code), len(self.gram) - 1)
        before = np.minimum(np.searchsorted(self.context, code >> 8), len(self.context) - 1)
        unseen = np.where(self.context[before] == code >> 8, self.shift[before], 0.0)  # a byte that neither class has there
        return np.where(self.gram[at] == code, self.value[at], unseen)

    def features(self, raw: bytes) -> list[float]:
        """Mean ratio of the bytes, and the largest sums over a word."""
        code, word = inner_grams(raw)
        value = self.ratios(code)
        return _described(value, np.bincount(word, value) if len(code) else value)


def fit_inner(sample: DataFrame) -> Inner:
    """Runs of at least LEAST_DOCS of the sample's texts come to the driver."""
    counts = map_batches(sample.select("toxic", "text"), _count_inner, "gram long, toxic long, plain long").groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))
    table = counts.where(F.col("plain") + F.col("toxic") >= LEAST_DOCS).toArrow()
    return Inner(*(table.column(c).to_numpy() for c in ("gram", "plain", "toxic")))


def fit_ratio(sample: DataFrame) -> Ratio:
    """Counts of the sample's texts in Spark; pairs and words of at least LEAST_DOCS texts come to the driver."""
    pairs = map_batches(sample.select("toxic", "text"), _count_pairs, "before binary, word binary, toxic long, plain long")
    pairs = materialise(pairs.groupBy("before", "word").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain")), "toxic_pairs")
    words = pairs.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"), F.count("*").alias("followed"))
    words = materialise(words, "toxic_words")
    totals = words.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("plain", "toxic")],
        *[F.count(F.when(F.col(c) > 0, 1)).alias(f"{c}_types") for c in ("plain", "toxic")],
        F.coalesce(F.sum("followed"), F.lit(0)).alias("pairs"),
    ).first()
    contexts = pairs.groupBy("before").agg(
        F.sum("plain").alias("plain"), F.sum("toxic").alias("toxic"),
        F.count(F.when(F.col("plain") > 0, 1)).alias("plain_types"), F.count(F.when(F.col("toxic") > 0, 1)).alias("toxic_types"),
    )

    def local(df: DataFrame, *numbers: str) -> dict:
        table = df.where(F.col("plain") + F.col("toxic") >= LEAST_DOCS).toArrow()
        return {c: table.column(c).to_numpy() if c in numbers else table.column(c).to_pylist() for c in table.column_names}

    kept = local(words.orderBy("word"), "plain", "toxic", "followed")
    kept["totals"] = totals.asDict()
    return Ratio(kept, local(contexts, "plain", "toxic", "plain_types", "toxic_types"), local(pairs, "plain", "toxic"))


def fit_curve(points: np.ndarray, toxic: np.ndarray, weight: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton steps: intercept and one slope per feature."""
    x = np.concatenate([np.ones((len(points), 1)), points], axis=1)
    beta = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [1e-3] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (toxic - p)) - ridge @ beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        beta = beta + np.clip(np.linalg.solve(hessian, gradient), -5, 5)
    return beta


def score_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = HELD_OUT) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, ratio (per word) and the largest word ratios, and the same for the bytes inside words.

    Null, empty and wordless texts have zeros and get the curve's value there. Several labels of one
    document: toxic if any is. Null labels are not learned from. Without labelled rows of both classes
    every score is the share of toxic ones (0 without any). Repeated rows are scored alike; other columns are ignored.
    """
    sample = materialise(labelled_sample(docs, labels, modulus), "toxic_texts")
    fitted = sample.where("NOT curve")
    shared = docs.sparkSession.sparkContext.broadcast((fit_ratio(fitted), fit_inner(fitted)))

    def described(keep: list[str], schema: str):
        def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, inner = shared.value
            for batch in batches:
                found = [(*words.features(x), *inner.features(x)) for x in encoded(batch.column("text"))]
                columns = [pa.array([x[k] for x in found], pa.float64()) for k in range(len(FEATURES))]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + columns, [*keep, *FEATURES])

        return lambda df: map_batches(df, work, ", ".join([schema, *(f"{n} double" for n in FEATURES)]))

    points = described(["toxic", "weight"], "toxic int, weight double")(sample.where("curve").select("toxic", "weight", "text")).toArrow()
    toxic, weight = points.column("toxic").to_numpy(), points.column("weight").to_numpy()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (id_bucket("doc_id", modulus) == 0).alias("held_out"), "text")
    out = described(["doc_id", "held_out"], "doc_id long, held_out boolean")(rows)
    if len(np.unique(toxic)) < 2:
        score = F.lit(float(np.average(toxic, weights=weight)) if len(toxic) else 0.0)
    else:
        beta = fit_curve(np.stack([points.column(n).to_numpy() for n in FEATURES], axis=1), toxic, weight)
        linear = F.lit(float(beta[0]))
        for slope, name in zip(beta[1:], FEATURES, strict=True):
            linear = linear + F.lit(float(slope)) * F.col(name)
        score = 1 / (1 + F.exp(-linear))
    return out.select("doc_id", "held_out", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), *FEATURES)
