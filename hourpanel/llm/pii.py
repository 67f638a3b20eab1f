"""Personal data by candidate generation and gradient boosting.

1. Generators propose spans with high recall: the four exact patterns, and loose forms of each (spelled-out
   addresses, phone numbers without a plus, digit groups of card length, dotted groups). Spans may overlap.
2. Boosted trees (MLlib) score every candidate from its format and its surroundings. They learn from the
   candidates themselves: a span that an exact pattern accepts is a positive, one that touches none is a
   negative. The sign that makes a phone number exact is left out of the features, so look-alikes score high.
3. A threshold per kind is set at a precision of ``PRECISION`` on all labelled candidates that the trees have not
   seen, weighted to the mix of labels in the whole corpus; candidates above it are added to the exact spans, best first, without overlaps.

Trees are fitted on a bounded sample of candidates (``FIT_ROWS``); candidates come from all whole texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourpanel.llm.text import map_batches
from hourpanel.session import materialise

KINDS = ("email", "ip", "card", "phone")
FIT_ROWS = 20_000
FIT_TENTHS = 7  # of the sample; its other rows are left for the thresholds
BINS = 10_000  # of the score, for the counts that thresholds are read from
ROUNDS = 10
PRECISION = 0.95
LEAST_ROWS = 40  # of each label, to fit trees at all
NEAR = 24  # characters of context on each side

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_QUAD = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]|[(\[]at[)\]]|\sdot\s")
_AT = re.compile(r"\s?(?:@|\(at\)|\[at\])\s?|\sat\s(?=[A-Za-z0-9-]{1,63}\sdot\s)")
_LOOSE_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|\s?\(dot\)\s?|\s?\[dot\]\s?|\sdot\s)[A-Za-z0-9-]{1,63}){1,4}")
_LOOSE = (
    re.compile(r"(?<![0-9.])[0-9]{1,4}(?:\s?\.\s?[0-9]{1,4}){3}(?![0-9])"),
    re.compile(r"(?<![0-9A-Za-z])[0-9]{4}(?:[\x20./-]?[0-9]{2,6}){2,4}(?![0-9A-Za-z])"),
    re.compile(r"(?<![0-9A-Za-z+])(?:\([0-9]{1,4}\)[\x20.-]?)?[0-9]{2,4}(?:[\x20.-]?[0-9]{2,4}){1,4}(?![0-9A-Za-z])"),
)
_HINTS = ("mail", "contact", "write", "call", "phone", "tel", "fax", "card", "visa", "pay", "ip", "host", "server", "addr", "token", "key", "password", "id")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern, found from each @ so that prose costs nothing."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and _is_local(text[begin - 1]):
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            found.append((begin, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    return found


def _is_local(c: str) -> bool:
    return c.isascii() and (c.isalnum() or c in "._%+-")


def _loose_emails(text: str) -> list[tuple[int, int]]:
    """Addresses with spaces or words for the signs; the local part has up to 64 characters."""
    found = []
    for m in _AT.finditer(text):
        begin = m.start()
        while begin > max(0, m.start() - 64) and _is_local(text[begin - 1]):
            begin -= 1
        domain = _LOOSE_DOMAIN.match(text, m.end()) if begin < m.start() else None
        if domain:
            found.append((begin, domain.end()))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the exact patterns, by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    for run in _DOTTED.finditer(text):
        if text.count(".", run.start(), run.end()) >= 3:
            for m in _QUAD.finditer(text, run.start(), run.end()):
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                    out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = re.sub(r"[\x20-]", "", m.group()) if m.end() - m.start() >= 16 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((3, *m.span()))
    return out


def candidates(text: str) -> list[tuple[int, int, int, bool, bool]]:
    """(kind, start, end, exact, touches an exact span) of all generators."""
    exact = base_spans(text)
    out = [(*s, True, True) for s in exact]
    taken = {s for s in exact}
    loose = [(0, *s) for s in _loose_emails(text)]
    loose += [(kind, *m.span()) for kind, pattern in enumerate(_LOOSE, 1) for m in pattern.finditer(text)]
    for s in loose:
        if s not in taken:
            out.append((*s, False, any(a < s[2] and s[1] < b for _, a, b in exact)))
    return out


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    body, before, after = text[start:end], text[max(0, start - NEAR) : start], text[end : end + NEAR]
    digits = [c for c in body if c.isdigit()]
    groups = re.findall(r"[0-9]+", body)
    low = before.lower()
    return [
        float(kind), float(len(body)), float(len(digits)), len(digits) / max(1, len(body)), float(len(groups)), float(max(map(len, groups), default=0)),
        float(min(map(len, groups), default=0)), float(body.count(".")), float(body.count("-")), float(body.count(" ")), float("(" in body), float("@" in body),
        float(sum(c.isalpha() for c in body)), float(len(digits) > 1 and luhn("".join(digits)) if all(c in "0123456789" for c in digits) else False),
        float(all(len(g) <= 3 and int(g) <= 255 for g in groups)), float(before[-1:].isspace() or not before), float(after[:1].isspace() or not after),
        float(before.rstrip(" +")[-1:] in "=:\"'"), float(any(c.isdigit() for c in before)), float(any(c.isdigit() for c in after)), *[float(h in low) for h in _HINTS],
    ]


def spelled(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


_CANDIDATE = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("exact", pa.bool_()), ("touches", pa.bool_()), ("features", pa.list_(pa.float32()))])


def _propose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, spans, found = [], [], [], []
        for text in batch.column("text").to_pylist():
            own = candidates(text) if text and _ANY.search(text) else []
            exact = [c[:3] for c in own if c[3]]
            counts.append([sum(k == i for k, *_ in exact) for i in range(4)])
            spans.append(spelled(exact))
            digests.append(hashlib.sha256(spans[-1].encode()).hexdigest())
            found.append([{"kind": k, "start": a, "stop": b, "exact": e, "touches": t, "features": features(text, k, a, b)} for k, a, b, e, t in own])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array([c[i] for c in counts], pa.int64()) for i in range(4)), pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(found, pa.list_(_CANDIDATE))],
            ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base_spans", "found"],
        )


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the selected candidates to the exact spans, best score first, without overlaps."""
    for batch in batches:
        out, extra = [], []
        for base, added in zip(batch.column("base_spans").to_pylist(), batch.column("added").to_pylist(), strict=True):
            spans = [(KINDS.index(k), int(a), int(b)) for k, a, b in (x.split(":") for x in base.split(",") if x)]
            chosen: list[tuple[int, int, int]] = []
            for c in sorted(added or [], key=lambda c: (-c["score"], c["start"], c["stop"], c["kind"])):
                if all(c["stop"] <= a or b <= c["start"] for _, a, b in spans + chosen):
                    chosen.append((c["kind"], c["start"], c["stop"]))
            out.append(spelled(spans + chosen))
            extra.append(len(chosen))
        keep = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(out, pa.string()), pa.array(extra, pa.int64())], [*keep, "spans", "n_added"])


def thresholds(kind: np.ndarray, score: np.ndarray, label: np.ndarray, weight: np.ndarray, precision: float = PRECISION) -> dict[int, float]:
    """By kind, the smallest score from which on the weighted share of positives is at least ``precision``. Kinds without one are absent."""
    out = {}
    for k in np.unique(kind).tolist():
        own = kind == k
        order = np.argsort(-score[own], kind="stable")
        s, y, w = score[own][order], label[own][order], weight[own][order]
        good = (np.cumsum(y * w) / np.cumsum(w) >= precision) & np.append(s[1:] != s[:-1], True)
        if good.any():
            out[int(k)] = float(max(0.5, s[np.flatnonzero(good)[-1]]))
    return out


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Positions are code points, end exclusive. Null text counts as empty: no spans, the digest of the
    empty string. Too few candidates of a label: no trees, the exact spans only. Repeated rows are
    searched again; other columns are ignored.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    cand = "array<struct<kind:int,start:bigint,stop:bigint,exact:boolean,touches:boolean,features:array<float>>>"
    proposed = map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _propose,
        f"doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base_spans string, found {cand}",
    )
    rows = materialise(proposed.select(F.monotonically_increasing_id().alias("row_no"), "*"), "pii_rows")
    each = rows.select("row_no", F.explode("found").alias("c")).select(
        "row_no", "c.kind", "c.start", "c.stop", "c.exact", "c.touches", array_to_vector(F.col("c.features").cast("array<double>")).alias("features")
    )
    labelled = each.where("exact OR NOT touches").withColumn("label", F.col("exact").cast("double"))
    sizes = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    added = None
    if min(sizes.get(0.0, 0), sizes.get(1.0, 0)) >= LEAST_ROWS:
        rate = F.when(F.col("label") == 1, FIT_ROWS / 2 / sizes[1.0]).otherwise(FIT_ROWS / 2 / sizes[0.0])
        turn_of = F.xxhash64("row_no", "kind", "start", "stop")
        chance = F.shiftrightunsigned(turn_of, 11).cast("double") / F.lit(float(1 << 53))
        fit = (chance < rate) & (F.pmod(turn_of, F.lit(10)) < FIT_TENTHS)
        sample = materialise(labelled.where(fit).select("label", "features"), "pii_sample").coalesce(2)
        model = GBTClassifier(maxIter=ROUNDS, maxDepth=3, stepSize=0.3, seed=17, maxBins=32).fit(sample)
        binned = model.transform(labelled.where(~fit)).withColumn("bin", F.floor(vector_to_array("probability")[1] * BINS))
        seen = binned.groupBy("kind", "bin", "label").agg(F.count("*").alias("n")).toArrow()  # at most BINS + 1 a kind and label
        kind, score, label, n = (seen.column(c).to_numpy() for c in ("kind", "bin", "label", "n"))
        left = {k: 1 - FIT_TENTHS / 10 * min(1.0, FIT_ROWS / 2 / v) for k, v in sizes.items()}  # share of a label outside the fit
        limits = thresholds(kind, score / BINS, label, n / np.where(label == 1, left[1.0], left[0.0]))
        if limits:
            limit = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(v))])[F.col("kind")]
            scored = model.transform(each.where("NOT exact AND NOT touches")).withColumn("score", vector_to_array("probability")[1])
            added = scored.where(F.col("score") >= limit).groupBy("row_no").agg(F.collect_list(F.struct("kind", "start", "stop", "score")).alias("added"))
    kinds = "array<struct<kind:int,start:bigint,stop:bigint,score:double>>"
    plain = rows.drop("found")
    joined = plain.withColumn("added", F.lit(None).cast(kinds)) if added is None else plain.join(added, "row_no", "left")
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return map_batches(joined.drop("row_no"), _merge, schema)
