"""Each operator against a brute-force version or planted cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import prose
from pyspark.sql import functions as F

import corpus_pipeline
from hourpanel.llm import ctw, decontam, exact, graph, langid, licenses, mixing, near, pii, token_scan, toxicity
from hourpanel.llm.text import divided, in_table, key_table, text_shingles


def word_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def linked_components(rows):
    sets = [word_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 85 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return {rows[i][0]: (len(sets[i]), min(groups[find(i)])) for i in range(len(rows))}


def test_shingle_hashes_follow_words():
    raw = ["A b  c\td e f", "a B c d e f", "a b", "", "abc d e f g"]
    sets = text_shingles([x.encode() for x in raw])
    assert [len(s) for s in sets] == [len(word_set(x)) for x in raw]
    assert (sets[0] == sets[1]).all() and not np.isin(sets[0], sets[4]).any()


def test_key_table_misses_nothing(spark):
    keys = spark.range(2000).selectExpr("xxhash64(id) AS key")
    table = key_table(keys)
    own = np.array([r.key for r in keys.collect()])
    assert in_table(table, own).all()
    assert in_table(table, np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)).mean() < 0.01


def test_near_duplicates_match_brute_force(table, corpus):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_duplicates(table(corpus)).collect()}
    assert got == linked_components(corpus)


def test_large_group_of_near_copies_is_one_component(table):
    rng = random.Random(3)
    base = prose(rng, "en", 150).split()
    rows = []
    for i in range(400):
        words = list(base)
        words[i % 150] = f"w{i}"
        rows.append((1000 - i, " ".join(words)))
    out = near.near_duplicates(table(rows)).collect()
    assert {r.component_id for r in out} == {601} and sum(r.kept for r in out) == 1


def test_full_regions_of_unlike_documents_descend(table):
    rng = random.Random(5)
    shared = [f"s{i}" for i in range(200)]  # about 0.7 alike through the shared passage, 0.9 within a pair
    rows = []
    for i in range(120):
        own = [f"o{i}-{j}" for j in range(45)]
        other = own[:-6] + [f"p{i}-{j}" for j in range(6)]
        rows += [(2 * i, " ".join(shared + own)), (2 * i + 1, " ".join(shared + other))]
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_duplicates(table(rows)).collect()}
    assert got == linked_components(rows)
    assert len({c for _, c in got.values()}) == 120


def test_links_in_full_regions_need_no_neighbours(table, monkeypatch):
    rng = random.Random(6)
    shared = [f"s{i}" for i in range(200)]
    rows = []
    for i in range(60):
        own = [f"o{i}-{j}" for j in range(45)]
        rows += [(2 * i, " ".join(shared + own)), (2 * i + 1, " ".join(shared + own[:-6] + [f"p{i}-{j}" for j in range(rng.randint(1, 6))]))]
    met = near.neighbours
    monkeypatch.setattr(near, "neighbours", lambda *args: met(*args).where("false"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_duplicates(table(rows)).collect()}
    assert got == linked_components(rows) and len({c for _, c in got.values()}) == 60


def test_regions_full_at_the_last_depth_are_compared_whole(table, monkeypatch):
    rng = random.Random(8)
    shared = [f"s{i}" for i in range(200)]  # 0.72 alike across pairs, so they share many regions at the depth below
    rows = []
    for i in range(70):
        own = [f"o{i}-{j}" for j in range(35)]
        rows += [(2 * i, " ".join(shared + own)), (2 * i + 1, " ".join(shared + own[:-6] + [f"p{i}-{j}" for j in range(6)]))]
    rng.shuffle(rows)
    met = near._in_order
    monkeypatch.setattr(near, "_in_order", lambda *args: met(*args).where("false"))
    monkeypatch.setattr(near, "DEPTHS", (2,))
    monkeypatch.setattr(near, "DEPTH", 1)
    monkeypatch.setattr(near, "BLOCK", 16)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_duplicates(table(rows)).collect()}
    assert got == linked_components(rows) and len({c for _, c in got.values()}) == 70


def test_alike_documents_make_no_row_a_pair(table, monkeypatch):
    rng = random.Random(9)
    shared = [f"s{i}" for i in range(200)]  # all 0.77 alike: every pair is compared, none is a link
    rows = [(i, " ".join(shared + [f"o{i}-{j}" for j in range(rng.randint(27, 30))])) for i in range(300)]
    written, write = [], near.materialise

    def counted(df, name):
        out = write(df, name)
        written.append((out.count(), name))
        return out

    monkeypatch.setattr(near, "materialise", counted)
    assert all(r.kept for r in near.near_duplicates(table(rows)).collect())
    assert max(written)[0] <= 20 * len(rows)


def test_components_are_the_same_in_many_folds(spark, monkeypatch):
    rng = random.Random(10)
    links = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(170)] + [(7, 7)]
    parent = list(range(400))
    for a, b in links:
        while parent[a] != a:
            a = parent[a]
        while parent[b] != b:
            b = parent[b]
        parent[max(a, b)] = min(a, b)

    def root(i):
        return i if parent[i] == i else root(parent[i])

    expected = {i: root(i) for i in {x for link in links if link[0] != link[1] for x in link}}
    frame = spark.createDataFrame(links, "u long, v long").repartition(6)
    for at_once in (1 << 20, 16):
        monkeypatch.setattr(graph, "AT_ONCE", at_once)
        assert {r.node: r.root for r in graph.components(frame).collect()} == expected


def test_token_scan_counts_equal_encoding(table, corpus):
    import tiktoken

    coder = tiktoken.Encoding("t", pat_str=token_scan.PATTERN, mergeable_ranks=token_scan.load_ranks(token_scan.TOKENIZER), special_tokens={})
    rows = [*corpus, (900, "<|endoftext|> inside"), (901, None), (902, "")]
    want = Counter((r[0], len(coder.encode_ordinary(r[1] or ""))) for r in rows)
    for block in (1 << 16, 64, 1):  # documents over many blocks, and one block each token
        if block == 1:
            rows, want = rows[:12], Counter((r[0], len(coder.encode_ordinary(r[1] or ""))) for r in rows[:12])
        got = Counter((r.doc_id, r.n_tokens) for r in token_scan.count_tokens(table(rows), block=block).collect())
        assert got == want


def test_token_scan_reads_raw_files(spark, tmp_path):
    end, ids = 9, [1, 2, 9, 9, 3, 4, 5, 9, 6]
    (tmp_path / "a.bin").write_bytes(np.array(ids, "<u4").tobytes())
    (tmp_path / "b.bin").write_bytes(np.array([9], "<u4").tobytes())
    (tmp_path / "empty.bin").write_bytes(b"")
    blocks = token_scan.read_flat_files(spark, str(tmp_path / "*.bin"), 4, block=2)
    got = sorted((r.shard[-5:], r.ordinal, r.first_token, r.n_tokens, r.closed) for r in token_scan.scan(blocks, 4, end, block=2).collect())
    assert got == [("a.bin", 0, 0, 2, True), ("a.bin", 1, 3, 0, True), ("a.bin", 2, 4, 3, True), ("a.bin", 3, 8, 1, False), ("b.bin", 0, 0, 0, True)]


def water_filled(sizes, weights, most=3):
    target, open_ = {}, dict(weights)
    total = sum(sizes.values())
    while open_:
        level = (total - sum(target.values())) / sum(open_.values())
        over = [s for s in open_ if level * open_[s] > most * sizes[s]]
        if not over:
            return target | {s: level * w for s, w in open_.items()}
        for s in over:
            target[s] = most * sizes[s]
            del open_[s]
    return target


def test_mix_targets_and_sizes(table, corpus):
    out = mixing.mix(table(corpus)).collect()
    sizes = Counter()
    for r in corpus:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = water_filled(sizes, {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)})
    taken, largest = Counter(), Counter()
    for r in out:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9)
        assert r.taken <= 3 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(0.05 * want[s], largest[s] / 2), s
    again = mixing.mix(table(corpus)).collect()
    assert sorted((r.doc_id, r.taken) for r in out) == sorted((r.doc_id, r.taken) for r in again)


def test_mix_over_many_slots_and_weights(table, monkeypatch):
    monkeypatch.setattr(mixing, "SLOT_ROWS", 16)
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(1, 60), None, "hot" if i % 3 else f"s{i % 5}") for i in range(900)]
    taken, target = Counter(), {}
    for r in mixing.mix(table(rows)).collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= max(15, 0.01 * target[s]) for s in target)


def slow_base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        check = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and check % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return out


def test_pii_base_spans_on_random_strings():
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice("aé.@+-_ 0123456789()%4") for _ in range(rng.randint(0, 60)))
        assert sorted(pii.base_spans(text)) == sorted(slow_base(text)), text


def test_pii_adds_look_alikes(table):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        number = f"({rng.randint(200, 999)}) {rng.randint(100, 999)}-{rng.randint(1000, 9999)}"
        rows.append((i, f"{prose(rng)} call me at +1 {number} or write to {'ab' + str(i)}@mail.example.org. {prose(rng)}"))
        rows.append((1000 + i, f"{prose(rng)} in {rng.randint(1000, 2024)} we had {rng.randint(10, 99)} {rng.randint(10, 99)} pieces {prose(rng)}"))
    rows.append((5000, "nothing here"))
    out = {r.doc_id: r for r in pii.find_personal_data(table(rows)).collect()}
    for doc_id, text in rows:
        base = slow_base(text)
        spelled = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in sorted(base))
        r = out[doc_id]
        assert r.base_sha256 == hashlib.sha256(spelled.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, *_ in base) for i in range(4)]
        assert set(filter(None, spelled.split(","))) <= set(r.spans.split(","))
    assert out[5000].spans == ""


def test_pii_thresholds_see_the_mix_of_the_corpus(table, monkeypatch):
    monkeypatch.setattr(pii, "FIT_ROWS", 400)
    rng = random.Random(12)
    rows = [(i, f"{prose(rng, words=5)} write to ab{i}@mail.example.org now") for i in range(300)]
    rows += [(1000 + i, f"{prose(rng, words=5)} and {rng.randint(10, 99)} {rng.randint(10, 99)} pieces") for i in range(6000)]
    want = Counter(exact for _, text in rows for *_, exact, touches in pii.candidates(text) if exact or not touches)
    seen, limits = Counter(), pii.thresholds

    def spy(kind, score, label, *rest):
        for y, w in zip(label, rest[0] if rest else np.ones(len(label)), strict=True):
            seen[bool(y)] += w
        return limits(kind, score, label, *rest)

    monkeypatch.setattr(pii, "thresholds", spy)
    pii.find_personal_data(table(rows)).collect()
    assert want[False] > 15 * want[True]
    assert all(abs(seen[y] / want[y] - 1) < 0.2 for y in want)


def test_contained_items_match_brute_force(spark, table, corpus):
    rng = random.Random(9)
    items = [(i, prose(rng, "en", rng.randint(2, 70))) for i in range(30)]
    rows = list(corpus)
    for i, (_, text) in enumerate(items):
        words = text.split()
        if i % 3 == 0 and len(words) > 30:
            words[len(words) // 2] = "other"
        if i % 2 == 0:
            rows.append((2000 + i, f"{prose(rng, 'en', 3000)} {' '.join(words)} {prose(rng, 'en', 50)}"))
    items += [(100, "changed"), (101, None)]

    def inside(item, text):
        own = re.findall(r"[^\x20\x09-\x0D]+", (item or "").lower())
        n = min(5, len(own))
        if not n:
            return False
        words = text.lower().split()
        have = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
        want = word_set(item)
        return 100 * len(want & have) >= 80 * len(want)

    got = {(r.doc_id, r.item_id) for r in decontam.contained_items(table(rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(r[0], i) for r in rows for i, t in items if inside(t, r[1])}


def test_license_templates():
    def labels(text):
        places, spans = licenses.scan(text.encode())
        return sorted({x for _, x in places}), sorted({x for x, *_ in spans})

    assert labels("This work is licensed under the GNU General Public License, version 3.") == (["gpl"], ["gpl"])
    assert labels("Licensed under the Apache License, Version 2.0.")[1] == ["apache-2.0"]
    assert labels("Copyright (c) 2024 Some Body. All rights reserved.") == (["reserved"], ["reserved"])
    assert labels("Licensed under CC BY-NC 4.0.") == (["cc-by"], ["cc-by"])
    assert labels("Released under the MIT License") == ([], ["mit"])
    assert labels("the general license of the public") == ([], [])
    assert licenses.template_spans("all rights copyright c a b c d e f g all rights reserved".split(), []) == []


def test_license_words_and_base(table, corpus):
    rows = [*corpus, (700, "ALL  rights--reserved; general public license CC BY! cc, by"), (701, "é1 all rights"), (702, "\x7fa`b")]
    out = {r.doc_id: r for r in licenses.scan_licenses(table(rows)).collect()}
    for doc_id, text, *_ in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({c: c + 32 for c in range(65, 91)}))
        places = [(i, label) for phrase, label in licenses.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        r = out[doc_id]
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(places), ",".join(sorted({x for _, x in places})))
        assert (r.first_word, r.last_word) == (min((p for p, _ in places), default=None), max((p for p, _ in places), default=None))


def test_tree_is_a_distribution_and_matches_recursion(spark):
    texts = ["abracadabra", "abba cab", "barbara", ""] * 3
    tree = ctw.fit_tree(spark.createDataFrame([(t,) for t in texts], "text string"), contexts=40)
    assert np.allclose((10.0 ** tree.table.astype(float)).sum(axis=1), 1, atol=1e-5)
    assert math.isclose(ctw.log_gamma(np.array([0.5, 7.25]))[1], math.lgamma(7.25), rel_tol=1e-12)

    # the same mixture by plain recursion over dictionaries, for the first bit of every byte
    code = ctw._runs([t.encode() for t in texts])[0]
    kept = [set(k.tolist()) for k in tree.kept]

    def counts(member):
        n = [0, 0]
        for c in code.tolist():
            if member(c >> 8):
                n[(c >> 7) & 1] += 1
        return n

    def kt(n):
        return math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.lgamma(sum(n) + 1) - math.log(math.pi)

    def node(depth, context):
        mask = (1 << 8 * depth) - 1
        own = counts(lambda c: c & mask == context)
        if depth == ctw.DEPTH:
            return own, kt(own)
        below = [k for k in kept[depth + 1] if k & mask == context]
        wide = (1 << 8 * (depth + 1)) - 1
        rest = counts(lambda c: c & mask == context and (c & wide) not in below)
        total = kt(rest) + sum(node(depth + 1, k)[1] for k in below)
        return own, np.logaddexp(kt(own), total) - math.log(2)

    def predict(depth, context, path):
        own, weighted = node(depth, context)
        here = (own[1] + 0.5) / (sum(own) + 1)
        if depth == ctw.DEPTH:
            return here
        wide = (1 << 8 * (depth + 1)) - 1
        if (path & wide) in kept[depth + 1]:
            deeper = predict(depth + 1, path & wide, path)
        else:
            mask = (1 << 8 * depth) - 1
            rest = counts(lambda c: c & mask == context and (c & wide) not in kept[depth + 1])
            deeper = (rest[1] + 0.5) / (sum(rest) + 1)
        w = math.exp(kt(own) - math.log(2) - weighted)
        return w * here + (1 - w) * deeper

    for c in np.unique(code)[::5]:
        state = tree.states(np.array([c], np.uint64))[0]
        high = (10.0 ** tree.table[state, 128:].astype(float)).sum()
        assert math.isclose(high, predict(0, 0, int(c) >> 8), rel_tol=1e-4)


def test_run_values_equal_the_dense_tree_and_grow(spark, table, corpus):
    texts = [r[1] for r in corpus[:40]] + ["abracadabra", "abba cab", ""] * 3
    flags = [(t, k % 5 == 0) for k, t in enumerate(texts)]
    total = sum(len(t.encode()) + 1 for t, held in flags if not held)
    for least in (2, 40):
        tree = ctw.fit_tree(spark.createDataFrame([(t,) for t, held in flags if not held], "text string"), contexts=-(-total // least) if least == 2 else total // least)
        if least == 2:
            assert -(-total // -(-total // 2)) == 2
        out = ctw.run_values(spark.createDataFrame(flags, "text string, held_out boolean"), -(-total // (-(-total // 2))) if least == 2 else -(-total // (total // least))).toPandas()
        code = out["code"].to_numpy().astype(np.uint64)
        dense = tree.table[tree.states(code), (code & np.uint64(255)).astype(int)]
        assert np.allclose(out["value"], dense, atol=1e-4) and len(set(code.tolist())) == len(code)
    rows = corpus[:60]
    few, all_held = (sorted(tuple(r) for r in ctw.score_texts(table(rows), frequent_runs=k).select("doc_id", "score").collect()) for k in (50, 1 << 18))
    assert np.allclose([r[1] for r in few], [r[1] for r in all_held], rtol=1e-9)


def test_runs_are_counted_and_looked_up_once_for_all_documents(corpus, monkeypatch):
    texts = [r[1].encode() for r in corpus[:60]] + [b"", b"ab", b"abababab", "ßé \U0001f600".encode()]
    training = [k % 3 > 0 for k in range(len(texts))]
    data = [b"\xfe" * 4 + x.lower() + b"\xff" for x in texts]
    runs = [[int.from_bytes(x[i : i + 5], "big") for i in range(len(x) - 4)] for x in data]
    monkeypatch.setattr(ctw, "OWNERS", 7)
    assert [*ctw._dealt(texts)] == [(i, min(i + 7, len(texts))) for i in range(0, len(texts), 7)]
    batch = pa.table({"text": [x.decode() for x in texts], "held_out": [not t for t in training]}).to_batches()[0]
    seen, n = Counter(), Counter()
    for out in ctw._count_both([batch]):
        for r in out.to_pylist():
            seen[r["code"]] += r["seen"]
            n[r["code"]] += r["n"]
    assert seen == Counter(c for x in runs for c in x)
    assert {c: k for c, k in n.items() if k} == Counter(c for x, t in zip(runs, training, strict=True) if t for c in x)
    asked, search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *rest, **named: asked.append(len(v)) or search(a, v, *rest, **named))
    for held in (sorted(seen)[::3], []):
        value = {c: -1 / (k + 1) for k, c in enumerate(held)}
        code, owner = ctw._runs(texts)
        scores, *pairs = ctw._meet(code, owner, np.array(held, np.int64), np.array([*value.values()], float), len(texts))
        assert np.allclose(scores, [sum(value.get(c, 0) for c in x) for x in runs])
        want = Counter((k, c) for k, x in enumerate(runs) for c in x if c not in value)
        assert [*zip(*(x.tolist() for x in pairs), strict=True)] == sorted((*c, times) for c, times in want.items())
    assert asked == [len(seen)] and len(seen) < len(code)


def test_base_scores_match_brute_force(table, corpus):
    rows = corpus[:80]
    out = {r.doc_id: r for r in ctw.score_texts(table(rows), frequent=15).collect()}
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 != 2]
    counts = Counter(w for r in train for w in r[1].lower().split())
    counts[None] = len(train)
    total, kinds = sum(counts.values()), len(counts)
    for doc_id, text, *_ in rows:
        tokens = [*text.lower().split(), None]
        r = out[doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[t] > 0 for t in tokens), total)
        assert math.isclose(r.base_score, sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens), rel_tol=1e-9)
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 7 == 2)


def test_languages_of_held_out_rows(table, corpus):
    lang = {r[0]: r[2] for r in corpus}
    out = [r for r in langid.predict_languages(table(corpus)).collect() if r.held_out]
    assert len(out) > 20 and sum(r.lang_pred == lang[r.doc_id] for r in out) / len(out) > 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_toxic_texts_score_higher(spark, table):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(500):
        words = prose(rng, "en", 80).split()
        if i % 5 == 0:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "nasty", "rotten"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    out = toxicity.score_toxicity(table(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [r for r in out if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 5 == 0) for r in held) / len(held) > 0.97


def test_toxic_stems_are_found_in_new_compounds(table, spark):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(900):
        words = prose(rng, "de", 80).split()
        if i % 4 == 0:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), "".join(rng.choice(["keit", "ung", "ver", "sch", "ein", ""]) for _ in range(2)) + "quaxol" + "".join(rng.choice(["heit", "en", "er", "zu", "lich"]) for _ in range(2)) + str(rng.choice("abcdefgh")))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    held = [r for r in toxicity.score_toxicity(table(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect() if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in held) / len(held) > 0.97


def test_inner_model_is_kneser_ney(table, spark):
    rng = random.Random(13)
    texts = [(int(i % 3 == 0), prose(rng, "en", 30) + (" wretched" if i % 3 == 0 else "")) for i in range(60)]
    model = toxicity.fit_inner(spark.createDataFrame(texts, "toxic int, text string"))
    size, seen = toxicity.GRAM, {0: Counter(), 1: Counter()}
    for label, text in texts:
        seen[label].update({w[k : k + size] for w in (f" {x} " for x in re.findall(r"[a-z]+", text.lower())) for k in range(len(w) - size + 1)})
    kept = {g for g in seen[0] | seen[1] if seen[0][g] + seen[1][g] >= toxicity.LEAST_DOCS}
    follows = Counter(g[1:] for g in kept)
    for g in kept:
        below = follows[g[1:]] / sum(n for s, n in follows.items() if s[:-1] == g[1:-1])
        p = []
        for c in (0, 1):
            same = [x for x in kept if x[:-1] == g[:-1]]
            total, types = sum(seen[c][x] for x in same), sum(seen[c][x] > 0 for x in same)
            p.append(max(seen[c][g] - toxicity.DISCOUNT, 0) / (total + 1) + toxicity.DISCOUNT * (types + 1) / (total + 1) * below)
        code = np.array([int.from_bytes(g.encode(), "big")])
        assert math.isclose(model.ratios(code)[0], math.log(p[1] / p[0]), rel_tol=1e-9)
    assert len(kept) == len(model.gram) > 50


@pytest.mark.parametrize("capacity,depth", [(4096, 32), (2, 32), (1, 3)])
def test_exact_duplicates_and_directory(table, corpus, capacity, depth):
    docs = table(corpus)
    body = {r[0]: re.sub(r"[\x20\x09-\x0D]+", " ", r[1]) for r in corpus}
    groups = defaultdict(list)
    for k, v in body.items():
        groups[v].append(k)
    for r in exact.exact_duplicates(docs, capacity, depth).collect():
        own = groups[body[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (min(own), len(own), r.doc_id == min(own))
        assert r.text_sha256 == hashlib.sha256(body[r.doc_id].encode()).hexdigest()
    entries = exact.entries_of(exact.keyed(docs))
    cells = exact.directory(entries, capacity, depth).collect()
    assert sum(c.entries for c in cells) == len(groups)
    assert sum(2.0**-c.depth for c in cells) <= 1  # no key has two buckets
    assert all(c.entries <= capacity or c.depth == depth for c in cells)


def test_pipeline_drops_near_copies_from_80_percent_on(spark, table):
    words = [f"w{i}" for i in range(200)]
    copy = [f"x{i}" if i in (20, 70, 120, 170) else w for i, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(copy))]
    a, b = (word_set(r[1]) for r in rows)
    assert 80 * len(a | b) <= 100 * len(a & b) < 85 * len(a | b)
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert [r.doc_id for r in stage(spark, table(rows), "").collect()] == [1]
    assert all(r.kept for r in near.near_duplicates(table(rows)).collect())  # the query op1 links from 85 on


def test_stages_move_only_texts_that_may_go(spark, table, corpus):
    """The pipeline stages that drop rows: a row that surely stays is read and written without an exchange, odd and repeated rows too."""
    repeated = [(None, corpus[3][1], "en"), (None, "nothing like it", "en"), (None, "nothing like it", "en"), (5, "nothing  like it", "en"), (900, None, "en"), (900, None, "en"), (901, "", "en"), (3, "another text of row three", "en")]
    docs = table([*corpus, *repeated])
    rows = docs.collect()
    items = spark.createDataFrame([(1, " ".join(corpus[9][1].split()[:40])), (2, "like it")], "item_id long, text string")
    held = {tuple(r) for r in decontam.contained_items(docs, items).select("doc_id").distinct().collect()}
    ids = [r.doc_id for r in near.near_duplicates(docs, 80).where("kept").collect()]
    bodies, times = {}, Counter()
    for r in rows:
        body = re.sub(r"\s+", " ", r.text or "")
        bodies.setdefault(body, []).append(r.doc_id)
    first = {(min((i for i in x if i is not None), default=None), body) for body, x in bodies.items()}
    for r in exact.survivors(docs).collect():
        times[r.doc_id, re.sub(r"\s+", " ", r.text or "")] += 1
    assert set(times) == first and max(times.values()) == 1
    assert Counter(r.doc_id for r in near.survivors(docs, 80).collect()) == Counter(r.doc_id for r in rows if r.doc_id in set(ids))
    stays = [r.doc_id for r in decontam.clean(docs, items).collect()]
    assert held and not {i for i, in held if i is not None and i != 5} & set(stays) and len(stays) < len(rows)
    for out in (exact.survivors(docs), near.survivors(docs, 80), decontam.clean(docs, items)):
        plan = out._jdf.queryExecution().optimizedPlan()
        assert plan.nodeName() == "Union"
        assert not re.search("Join|Aggregate", plan.children().apply(0).toString())  # the table itself is dealt to three tasks


def test_exact_stage_runs_no_python(spark, table, corpus):
    """Exact deduplication is DataFrame operations only, in the pipeline too; rows are told apart by their keys."""
    docs = table(corpus)
    for out in (exact.survivors(docs), exact.exact_duplicates(docs)):
        assert not re.search("Python|InArrow|InPandas", out._jdf.queryExecution().executedPlan().toString())
    keys = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 3000)
    rows = spark.createDataFrame([(k,) for k in [*keys.tolist(), -(2**63), -1, 0, 2**63 - 1]], "k long")
    some = [*keys[:700].tolist(), *keys[:9].tolist(), -1, 2**63 - 1]
    for own in (some, []):
        sure, others = ([r.k for r in part.collect()] for part in divided(rows, spark.createDataFrame([(k,) for k in own], "key long"), F.col("k")))
        assert sorted(sure + others) == sorted(r.k for r in rows.collect())
        assert set(own) <= set(others) and len(others) < len(set(own)) + (40 if own else 1)


def test_pipeline_equals_brute_force(spark, tmp_path, table, corpus):
    rows = [*corpus, (800, "12 34 !!", "en", "s0", 1), (801, None, "en", "s0", 1)]
    item = " ".join(corpus[9][1].split()[:40])
    table(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    coders = [(k, langid._compressor(v)) for k, v in sorted(langid.fit(table(rows)).items())]
    kept = [r for r in rows if (j := langid.judge(r[1], coders))[0] != "und" and j[1] >= langid.MIN_MARGIN]
    seen, unique = set(), []
    for r in sorted(kept):
        body = re.sub(r"\s+", " ", r[1])
        if body not in seen:
            seen.add(body)
            unique.append(r)
    component = linked_components(unique)
    distinct = [r for r in unique if component[r[0]][1] == r[0]]
    want = word_set(item)
    clean = {r[0] for r in distinct if 100 * len(want & word_set(r[1])) < 80 * len(want)}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == clean and len(out) == len(clean) < len(distinct) < len(unique) < len(kept) < len(rows)
