"""Operators on tokens against the tokenizers run on whole texts."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import prose
from pyspark.sql import functions as F

from hourpanel.llm import alignment, pieces, token_table
from hourpanel.llm.pieces import Memo, pieces_of


ODD = [
    "", " ", "  ", "\n", "a  b", " a", "a ", "a \n b", "a\n  b\t c ", "x  y", "  z", "it's  we'll", "1 2  3", "a\x1c b", "a\u0085 b", "  q", "\r\n \r\n", "▁ a▁b",
    "<|endoftext|> and <s> </s> <unk> <0x41>", "﻿ x", "\U0001f600 \U0001f601‍", "é नमस्ते 你好　你", "x" * 3000, "!? ?! .. ,", "a\x00 b", None,
]


@pytest.fixture(scope="module")
def texts(corpus):
    rng = random.Random(1)
    mixed = ["".join(rng.choice("ab \n\t.'s1é你 ") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    return ODD + mixed + [r[1] for r in corpus]


@pytest.fixture(scope="module")
def coders():
    import sentencepiece
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ordinary = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ordinary.encode_special_tokens = True
    return plain, ordinary, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.mark.parametrize("spaced", [False, True])
def test_pieces_make_up_the_text(texts, spaced):
    distinct, codes, bounds = pieces_of(pa.array(texts), spaced)
    distinct = distinct.to_pylist()
    got = ["".join(distinct[c] for c in codes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    assert got == [" " * spaced + (t or "") for t in texts]


def test_memo_is_bounded_and_keeps_what_is_used():
    asked = []
    memo = Memo(lambda xs: asked.extend(xs) or [x.encode() for x in xs], size=50)
    for i in range(500):
        assert memo(["often", f"w{i}"]) == [b"often", f"w{i}".encode()]
        assert len(memo.young) + len(memo.old) <= 104
    assert Counter(asked)["often"] == 1


def test_id_table_drops_what_is_not_used():
    asked = []

    def work(words):
        asked.extend(words.to_pylist())
        found = [[len(x), *x.encode()] for x in words.to_pylist()]
        return np.array(sum(found, []), np.uint32), np.array([len(x) for x in found])

    table = pieces.IdTable(work, size=60)
    for i in range(300):
        words = ["", " often", f" w{i}", "é" * (i % 5)]
        ids, start, count = table(pa.array(words))
        assert [ids[a : a + n].tolist() for a, n in zip(start, count)] == [[len(x), *x.encode()] for x in words]
        assert len(table.key) <= 64
    assert Counter(asked)[" often"] == 1


def expected_tokens(rows, coder, end=0):
    start, out = 0, []
    for doc_id, text in rows:
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_table_equals_encoding_whole_texts(spark, table, texts, coders, tmp_path):
    rows = [(len(texts) - i, t) for i, t in enumerate(texts)]
    path = str(tmp_path / "tokens")
    stored = token_table.write_tokens(table(rows), path, chunk=50)
    want = expected_tokens(sorted(rows), coders[0])
    got = sorted(tuple(r) for r in token_table.checksums(stored, chunk=50).collect())
    assert got == want
    assert sorted(tuple(r) for r in token_table.read_tokens(spark, path).documents().collect()) == [w[:3] for w in want]
    flat = [i for _, t in sorted(rows) for i in [*coders[0].encode(t or "", add_special_tokens=False).ids, 0]]
    got = stored.between(1234, 1890).orderBy("position").collect()
    assert [r.id for r in got] == flat[1234:1890] and got[0].position == 1234


def test_token_table_reads_number_columns_alone(table, texts, tmp_path):
    stored = token_table.write_tokens(table([(i, t) for i, t in enumerate(texts)]), str(tmp_path / "t"))
    plan = stored.documents()._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema", 1)[1].split("\n")[0]
    import pyarrow.parquet as pq

    files = sorted((tmp_path / "t").glob("*.parquet"))
    used = {}
    for f in files:
        group = pq.ParquetFile(f).metadata.row_group(0)
        used |= {group.column(i).path_in_schema: (group.column(i).encodings, group.column(i).has_offset_index) for i in range(group.num_columns)}
    assert any("DICTIONARY" in x for x in used["ids.list.element"][0]) and "DELTA_BINARY_PACKED" in used["first"][0] and all(x[1] for x in used.values())


def test_token_table_ties_and_empty(spark, table, coders):
    rows = [(None, "b b"), (None, "a"), (7, "same"), (7, "same"), (7, None)]
    got = token_table.token_files(table(rows)).collect()
    assert sorted(r.n_tokens for r in got if r.doc_id is None) == [2, 3]
    assert sorted(r.start for r in got if r.doc_id is None)[0] == 0 and min(r.start for r in got if r.doc_id == 7) == 5
    spans = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert token_table.token_files(table([])).collect() == []


def test_checksums_combine():
    raw = bytes(random.Random(2).randrange(256) for _ in range(1000))
    assert token_table.carried(zlib.crc32(raw[:300]), 700) ^ token_table.carried(zlib.crc32(raw[300:700]), 300) ^ zlib.crc32(raw[700:]) == zlib.crc32(raw)


def expected_alignment(rows, first, second):
    letters = pieces.byte_letters()
    names = {i: t for t, i in first.get_vocab().items()}
    docs, pairs = [], Counter()
    for doc_id, text in rows:
        raw = (" " + (text or "")).encode()
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        a_raw = [bytes(letters[c] for c in names[i]) for i in a]
        b_raw = [bytes([int(second.id_to_piece(i)[3:-1], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(a_raw) != raw or b"".join(b_raw) != raw:
            docs.append((doc_id, 0, 0, 0, [], ""))
            continue
        spans = []
        for parts in (a_raw, b_raw):
            at, own = 0, []
            for p in parts:
                own.append((at, at + len(p)))
                at += len(p)
            spans.append(own)
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        links = [(x, y) for x, (s, e) in zip(a, spans[0]) for y, (u, v) in zip(b, spans[1]) if s < v and u < e]
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, own) if low <= s and e <= cut) for ids, own in ((a, spans[0]), (b, spans[1]))))
            low = cut
        pairs.update(links)
        docs.append((doc_id, len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, y), n in pairs.items():
        best[y] = max(best[y], n)
    full = [(d, na, nb, g, len(ls), sum(pairs[x] == best[x[1]] for x in ls), sum(pairs[x] for x in ls), sha) for d, na, nb, g, ls, sha in docs]
    held = Counter(p for *_, ls, _ in docs for p in set(ls))
    return full, pairs, held


def test_alignment_equals_brute_force(table, texts, coders, monkeypatch):
    rows = [(i, t) for i, t in enumerate(texts) if len(t or "") < 2000] + [(2000 + i, texts[-5]) for i in range(3)] + [(1, "repeated row"), (1, "repeated row")]
    want, pairs, held = expected_alignment(rows, coders[1], coders[2])
    docs = table(rows).repartition(2)
    got = sorted(tuple(r) for r in alignment.align(docs).collect())
    assert got == sorted(want)
    counts = {(r.a, r.b): (r.documents, r["count"]) for r in alignment.pair_counts(alignment.index(docs)).collect()}
    assert counts == {p: (held[p], n) for p, n in pairs.items()}


def test_many_small_blocks_give_the_same(table, texts):
    rows = [(i, t) for i, t in enumerate(texts[:200])]
    whole = sorted(tuple(r) for r in alignment.align(table(rows)).collect())
    indexed = alignment.index(table(rows * 1))
    assert indexed.where("place IS NOT NULL").count() == len(rows)
    pairs, docs = np.array([5, 5, 5, 9, 9, 5, 7], np.int64), np.array([0, 0, 3, 1, 1, 3, 2], np.int64)
    back = Counter()
    for n_docs in (4, 4000):
        back.clear()
        for posting in alignment.postings(pairs, docs, n_docs):
            columns = {k: v.to_pylist() for k, v in posting.items()}
            for k in range(len(columns["b"])):
                at, times = alignment.members(columns["dense"][k], [columns["bitmap"][k]], [columns["planes"][k]], np.array([columns["docs"][k]]))
                back.update({(columns["b"][k], int(d)): int(t) for d, t in zip(at, times)})
        assert back == Counter(zip(pairs.tolist(), docs.tolist()))
    assert whole == sorted(tuple(r) for r in alignment.align(table(rows).repartition(40)).collect())


@pytest.mark.parametrize("run", [alignment.align, token_table.token_files])
def test_odd_and_empty_tables(table, odd_rows, clashing, run):
    assert len(run(clashing(table(odd_rows))).collect()) == len(odd_rows)
    assert run(table([])).collect() == []


def test_long_text(table, coders):
    rng = random.Random(9)
    rows = [(1, prose(rng, "en", 60_000)), (2, "short"), (3, "y" * 300_000)]
    assert sorted(tuple(r) for r in token_table.token_files(table(rows)).collect()) == expected_tokens(rows, coders[0])
    got = {r.doc_id: r for r in alignment.align(table(rows)).collect()}
    assert got[1].n_a == len(coders[1].encode(" " + rows[0][1], add_special_tokens=False).ids) and got[1].n_b == len(coders[2].encode(rows[0][1]))
    assert got[3].n_b == len(coders[2].encode(rows[2][1]))
