"""Encoding of whole texts by their distinct pieces.

A text is cut before every space that follows no white space. Neither tokenizer used here lets a token
go over such a cut: the byte-level pattern starts a new match at that space, and no entry of the piece
vocabulary has a space after another character (checked when it is loaded). So the tokens of a text are
the tokens of its pieces in turn, and each distinct piece of a slice is encoded once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from hourpanel.llm.text import mixed

CUT = re.compile(r"(?<!\s)(?= )")
# a space at the beginning or after white space of any kind: such texts are cut by CUT itself
UNEVEN = r"(?:^|[\s\x0b\x1c-\x1f\x{85}\pZ]) "
MEMO = 200_000  # pieces of one generation; two are held
TABLE = 1_500_000  # pieces of a table of identifiers, about 45 bytes each
LONGEST = 64  # characters of a piece that is worth holding


class Memo:
    """Results of ``work`` by piece. Two generations of bounded size: what is used again moves to the younger."""

    def __init__(self, work: Callable[[list[str]], list], size: int = MEMO):
        self.work, self.size, self.young, self.old = work, size, {}, {}

    def __call__(self, pieces: list[str]) -> list:
        young, old = self.young, self.old
        found = [young.get(x) for x in pieces]
        missing = []
        for i, x in enumerate(found):
            if x is None:
                known = old.get(pieces[i])
                if known is None:
                    missing.append(i)
                else:
                    found[i] = young[pieces[i]] = known
        if missing:
            for i, x in zip(missing, self.work([pieces[i] for i in missing]), strict=True):
                found[i] = x
                if len(pieces[i]) <= LONGEST:
                    young[pieces[i]] = x
        if len(young) > self.size:
            self.young, self.old = {}, young
        return found


_rng = np.random.default_rng(20250117)
_BYTES = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64)
_BASES = _rng.integers(2**62, 2**63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def prints(strings: pa.Array) -> np.ndarray:
    """A 128-bit fingerprint of every string, as two rows of numbers."""
    offsets = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    raw = np.frombuffer(strings.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    begin, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    out = np.empty((2, len(strings)), np.uint64)
    for k in range(2):
        steps = np.full(len(raw) + 1, _BASES[k], np.uint64)
        steps[0] = 1
        np.cumprod(steps, out=steps)
        back = np.full(len(raw) + 1, pow(int(_BASES[k]), -1, 1 << 64), np.uint64)
        back[0] = 1
        np.cumprod(back, out=back)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[k][raw] * steps[:-1], out=sums[1:])
        out[k] = mixed((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))
    return out


class IdTable:
    """Identifiers by piece, as arrays ordered by the pieces' fingerprints, so that a slice is looked up at once.

    Holds up to ``size`` pieces; beyond it, those that were not used since the last time go.
    """

    def __init__(self, work: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], size: int = TABLE):
        self.work, self.size = work, size
        self.key, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.start, self.count, self.used = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.ids = np.zeros(0, np.uint32)

    def _places(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.key, key), max(len(self.key) - 1, 0))
        if not len(self.key):
            return np.full(len(key), -1)
        return np.where((self.key[at] == key) & (self.check[at] == check), at, -1)

    def _shrink(self) -> None:
        keep = np.flatnonzero(self.used)
        count = self.count[keep]
        start = np.cumsum(count) - count
        self.ids = self.ids[np.repeat(self.start[keep] - start, count) + np.arange(count.sum())]
        self.key, self.check, self.start, self.count = self.key[keep], self.check[keep], start, count
        self.used = np.zeros(len(keep), bool)

    def __call__(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(all identifiers, start and number of those of each piece)."""
        if not len(pieces):
            return self.ids, self.start[:0], self.count[:0]
        if len(self.key) > self.size:
            self._shrink()
        key, check = prints(pieces)
        at = self._places(key, check)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            ids, count = self.work(pieces.take(pa.array(missing)))
            start = len(self.ids) + np.cumsum(count) - count
            self.ids = np.concatenate([self.ids, ids])
            order = np.argsort(key[missing], kind="stable")
            own = key[missing][order]
            where = np.searchsorted(self.key, own)
            self.key, self.check = np.insert(self.key, where, own), np.insert(self.check, where, check[missing][order])
            self.start, self.count = np.insert(self.start, where, start[order]), np.insert(self.count, where, count[order])
            self.used = np.insert(self.used, where, False)
            at = self._places(key, check)
        self.used[at] = True
        return self.ids, self.start[at], self.count[at]


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


# Words of old letters, which are letters in every version of Unicode that a pattern may know, with marks behind them,
# and perhaps a second word on a new line. An apostrophe is no mark here, as patterns give it meanings of its own.
_LETTERS = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}\x{391}-\x{3a1}\x{3a3}-\x{3ce}\x{400}-\x{481}\x{48a}-\x{52f}]"
_MARKS = r"[!-&(-/:-@\[-`{-~]"
UNITS = ("word", "marks", "line", "second", "ends")
WORD = rf"^(?P<word> ?{_LETTERS}+)(?P<marks>{_MARKS}*)(?P<line>\n?)(?P<second>{_LETTERS}*)(?P<ends>{_MARKS}*)$"
WORDS_AT_ONCE = 1000


class ByteLevel:
    """A byte-level tokenizer file as a function from pieces to identifiers.

    The tokenizer's pattern takes letters with a space before them, a run of marks, and a single new line as one match each, so
    such words are handed to its merges many at a time, one of each; other pieces go through the whole tokenizer.
    """

    def __init__(self, path: str, plain_specials: bool = False):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = plain_specials  # their strings are then ordinary text
        kind = json.loads(self.whole.to_str())
        before = kind["pre_tokenizer"] or {}
        self.wordwise = before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and kind["normalizer"] is None and kind["model"]["type"] == "BPE"
        self.merges = Tokenizer(self.whole.model)
        self.merges.pre_tokenizer = WhitespaceSplit()
        letter = {b: c for c, b in byte_letters().items()}
        self.letters = {b: letter[b] for b in range(256)} | {10: " "}

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        filled = pc.not_equal(words, "")
        some, ids, counts = words.filter(filled), [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for a in range(0, len(some), WORDS_AT_ONCE):
            part = some.slice(a, WORDS_AT_ONCE)
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part), "\n")[0].as_buffer().to_pybytes()
            found = self.merges.encode(text.decode("latin-1").translate(self.letters), add_special_tokens=False)
            ids.append(np.array(found.ids, np.uint32))
            counts.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(part)))
        out = np.zeros(len(words), np.int64)
        out[filled.to_numpy(zero_copy_only=False)] = np.concatenate(counts)
        return np.concatenate(ids), out

    def _wholes(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.whole.encode_batch_fast(pieces.to_pylist(), add_special_tokens=False)]
        return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)

    def __call__(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(identifiers of all pieces in turn, their number for each)."""
        if not self.wordwise:
            return self._wholes(pieces)
        cut = pc.extract_regex(pieces, WORD)
        plain = cut.is_valid()
        is_word = plain.to_numpy(zero_copy_only=False)
        coded = [cut.filter(plain).field(k).dictionary_encode() for k in range(len(UNITS))]
        units = [(self._words if name in ("word", "second") else self._wholes)(c.dictionary) for name, c in zip(UNITS, coded, strict=True)]
        units.append(self._wholes(pieces.filter(pc.invert(plain))))
        counts = np.concatenate([n for _, n in units])
        first = np.cumsum([0, *(len(n) for _, n in units)])
        bounds = np.zeros(len(pieces) + 1, np.int64)
        np.cumsum(np.where(is_word, len(UNITS), 1), out=bounds[1:])
        codes = np.empty(bounds[-1], np.int64)
        for k, c in enumerate(coded):
            codes[bounds[:-1][is_word] + k] = first[k] + c.indices.to_numpy()
        codes[bounds[:-1][~is_word]] = first[len(UNITS)] + np.arange((~is_word).sum())
        ids, edges = gathered(np.concatenate([x for x, _ in units]), np.cumsum(counts) - counts, counts, codes, bounds)
        return ids, np.diff(edges)


def _with_space(words: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise("", words, " ")


def pieces_of(texts: pa.Array, spaced: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct pieces, the piece numbers of all texts in turn, where each text's begin and, last, the end).

    ``spaced`` reads every text with one space in front. Null counts as empty.
    """
    texts = pc.fill_null(texts, "")
    lists = pc.split_pattern(texts, " ")
    uneven = np.flatnonzero(pc.match_substring_regex(texts, UNEVEN).to_numpy(zero_copy_only=False))
    if len(uneven):
        own = []
        for k in uneven.tolist():
            cut = CUT.split(" " * spaced + texts[k].as_py())
            cut = cut[1:] if spaced else cut
            own.append(cut[: not spaced] + [x[1:] for x in cut[not spaced :]])
        at = np.arange(len(texts))
        at[uneven] = len(texts) + np.arange(len(uneven))
        lists = pa.concat_arrays([lists, pa.array(own, lists.type)]).take(pa.array(at))
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(sizes, out=bounds[1:])
    flat = lists.flatten()
    if spaced:
        coded = flat.dictionary_encode()
        return _with_space(coded.dictionary), coded.indices.to_numpy().astype(np.int64), bounds
    first = np.zeros(len(flat), bool)
    first[bounds[:-1][sizes > 0]] = True
    head, rest = flat.filter(pa.array(first)).dictionary_encode(), flat.filter(pa.array(~first)).dictionary_encode()
    codes = np.empty(len(flat), np.int64)
    codes[first] = head.indices.to_numpy()
    codes[~first] = rest.indices.to_numpy().astype(np.int64) + len(head.dictionary)
    return pa.concat_arrays([head.dictionary, _with_space(rest.dictionary)]), codes, bounds


def gathered(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray, codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all texts in turn, from those of each piece in ``flat``, and where each text's begin and, last, the end."""
    sizes = counts[codes]
    ends = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    at = np.repeat(starts[codes] - ends[:-1], sizes) + np.arange(ends[-1])
    return flat[at], ends[bounds]


def joined(found: list[bytes], kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all numbers, start and number of those of each piece)."""
    counts = np.array([len(x) for x in found], np.int64) // kind.itemsize
    return np.frombuffer(b"".join(found), kind), np.cumsum(counts) - counts, counts
