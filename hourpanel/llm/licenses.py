"""License scan by templates with optional and replaceable regions.

A template is a sequence of words with markup: ``[ ... ]`` may be absent, ``<n>`` stands for up to n
words of any kind. It is compiled into an automaton over words; a text matches where the mandatory
words stand exactly, in order. A scan starts an automaton only at its first word and keeps a set of states
per start, so its cost is bounded by the template and not by the text's repetitions.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourpanel.llm.text import encoded, map_batches, slices

# Base phrases and their labels, in the contract's order.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Wording of public license texts and notices with markup; label, template.
TEMPLATES = (
    ("gpl", "licensed under the [terms of the] [gnu] general public license [as published by the free software foundation] [either] [version 3] [version 2]"),
    ("lgpl", "[gnu] lesser general public license"),
    ("lgpl", "[gnu] library general public license"),
    ("agpl", "gnu affero general public license"),
    ("mit", "[released] [licensed] [available] under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files [the software] to deal in the software without restriction"),
    ("apache-2.0", "licensed under [the terms of] the apache license [version 2 0] [the license]"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "[licensed] [released] under the [new] [modified] [simplified] bsd [2 clause] [3 clause] license"),
    ("isc", "permission to use copy modify [and or] [and] distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v [2 0]"),
    ("cc-by", "[this work is] licensed under [a] [the] creative commons attribution <3> [license]"),
    ("cc-by", "licensed under cc by [sa] [nc] [nd] [4 0] [3 0]"),
    ("reserved", "copyright [c] <6> all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_IS_WORD = np.ones(256, bool)
_IS_WORD[0x00:0x30] = _IS_WORD[0x3A:0x61] = _IS_WORD[0x7B:0x80] = False


class Automaton:
    """States are places between words; ``steps[state]`` maps a word to next states, ``any`` holds wild steps."""

    def __init__(self, template: str):
        self.mandatory = 0
        items: list[tuple[str, list[bytes] | int]] = []
        for token in re.findall(r"\[[^\]]*\]|<\d+>|[^\s\[\]<>]+", template):
            if token[0] == "[":
                items.append(("optional", token[1:-1].encode().split()))
            elif token[0] == "<":
                items.append(("wild", int(token[1:-1])))
            else:
                self.mandatory += 1
                items.append(("word", [token.encode()]))
        self.steps: list[dict[bytes, set[int]]] = [{}]
        self.wild: list[set[int]] = [set()]
        self.skip: list[set[int]] = [set()]
        here = 0
        for kind, value in items:
            if kind == "wild":
                ends = []
                for _ in range(value):
                    ends.append(here)
                    nxt = self._new()
                    self.wild[here].add(nxt)
                    here = nxt
                for e in ends:
                    self.skip[e].add(here)
            else:
                begin = here
                for w in value:
                    nxt = self._new()
                    self.steps[here].setdefault(w, set()).add(nxt)
                    here = nxt
                if kind == "optional":
                    self.skip[begin].add(here)
        self.final = here
        self.first = {w for s in self._closed({0}) for w in self.steps[s]}
        words = [v[0] for k, v in items if k == "word"]
        self.anchor = max(words, key=len)  # every match holds it

    def _new(self) -> int:
        self.steps.append({})
        self.wild.append(set())
        self.skip.append(set())
        return len(self.steps) - 1

    def _closed(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in self.skip[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return seen

    def match(self, words: list[bytes], at: int) -> int | None:
        """End of the longest match that begins at ``at``."""
        states, best = self._closed({0}), None
        if self.final in states:
            best = at
        while states and at < len(words):
            w = words[at]
            states = self._closed({t for s in states for t in (self.steps[s].get(w, set()) | self.wild[s])})
            at += 1
            if self.final in states:
                best = at
        return best


@lru_cache(maxsize=8)
def compiled(templates: tuple[tuple[str, str], ...]) -> tuple[tuple[str, Automaton], ...]:
    return tuple((label, Automaton(t)) for label, t in templates)


def words_of(raw: bytes) -> list[bytes]:
    return _WORD.findall(raw.lower())


def _base_places(words: list[bytes], base) -> list[tuple[int, str]]:
    places = []
    for phrase, label in base:
        want = phrase.encode().split()
        i = -1
        while True:
            try:
                i = words.index(want[0], i + 1)
            except ValueError:
                break
            if words[i : i + len(want)] == want:
                places.append((i, label))
    return places


def template_spans(words: list[bytes], automata) -> list[tuple[str, int, int, int]]:
    """(label, start, end, mandatory words) of every leftmost-longest template match."""
    found = []
    present: dict[bytes, list[int]] = {}
    needed = set().union(*(a.first for _, a in automata)) if automata else set()
    for i, w in enumerate(words):
        if w in needed:
            present.setdefault(w, []).append(i)
    for label, automaton in automata:
        last = 0
        for i in sorted({p for w in automaton.first for p in present.get(w, ())}):
            if i < last:
                continue
            end = automaton.match(words, i)
            if end is not None and end > i:
                found.append((label, i, end, automaton.mandatory))
                last = end
    return found


def scan(raw: bytes, base=BASE, templates=TEMPLATES) -> tuple[list[tuple[int, str]], list[tuple[str, int, int, int]]]:
    low = raw.lower()
    automata = [(label, a) for label, a in compiled(tuple(templates)) if a.anchor in low]
    hit = [b for b in base if all(w in low for w in b[0].encode().split())]
    if not automata and not hit:
        return [], []
    words = words_of(raw)
    return _base_places(words, hit), template_spans(words, automata)


def count_words(raw: list[bytes]) -> np.ndarray:
    """Words of each text, counted in one pass over the joined bytes; bytes from 0x80 on are word bytes."""
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    buffer = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    word = _IS_WORD[low[buffer]]
    starts = word[1:] & ~word[:-1]
    totals = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(starts, out=totals[1:])
    ends = np.cumsum([len(x) + 1 for x in raw])
    return np.diff(np.concatenate([[0], totals[ends]]))


def _work(base, templates):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = encoded(batch.column("text"))
            for a, b in slices(raw):
                counts = count_words(raw[a:b])
                rows = []
                for text in raw[a:b]:
                    places, spans = scan(text, base, templates)
                    starts = [p for p, _ in places]
                    own = sorted({x for _, x in places})
                    covered = max((e - s for _, s, e, _ in spans), default=0)
                    # a template of ten or more words is sure; shorter notices and bare phrases say less
                    score = max([0.5] * bool(places) + [min(1.0, 0.6 + 0.04 * m) for *_, m in spans], default=0.0)
                    spelled = ",".join(f"{x}:{s}:{e}" for x, s, e, _ in sorted(spans, key=lambda z: (z[1], z[2], z[0])))
                    rows.append((len(places), min(starts, default=None), max(starts, default=None), ",".join(own), ",".join(sorted(set(own) | {x for x, *_ in spans})), score, covered, spelled))
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.float64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(counts, pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "longest", "matches"],
                )

    return work


def scan_licenses(docs: DataFrame, base=BASE, templates=TEMPLATES) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, longest, matches.

    ``matches`` lists label:start:end of the template matches in words. Null or empty text: no words, no labels,
    score 0. A repeated row is scanned again; other columns are ignored.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, longest long, matches string"
    return map_batches(plain, _work(base, templates), schema)


def _license_sql() -> str:
    words = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), x -> x <> '')"
    return f"SELECT doc_id, {words} AS words FROM documents"


BASE_SQL = f"""
WITH w AS ({_license_sql()}),
p AS (SELECT doc_id, words, generate_subscripts(words, 1) AS i FROM w),
h AS (SELECT doc_id, i - 1 AS place, CASE
        WHEN words[i] = 'cc' AND words[i + 1] = 'by' THEN 'cc-by'
        WHEN words[i] = 'general' AND words[i + 1] = 'public' AND words[i + 2] = 'license' THEN 'gpl'
        WHEN words[i] = 'all' AND words[i + 1] = 'rights' AND words[i + 2] = 'reserved' THEN 'reserved' END AS label
      FROM p),
g AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM h WHERE label IS NOT NULL GROUP BY doc_id)
SELECT w.doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels
FROM w LEFT JOIN g ON w.doc_id = g.doc_id
"""
