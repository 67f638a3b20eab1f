"""Every operator on odd rows, clashing columns, empty tables; every stage keeps the columns of documents."""

import pytest

import corpus_pipeline
from hourpanel.llm import ctw, decontam, exact, langid, licenses, mixing, near, pii, token_scan, toxicity


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "the and the and the thing"), (2, None), (3, "word"), (4, "")], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 1), (4, 1, 0), (5, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def operators(items, labels):
    return {
        "near": near.near_duplicates, "tokens": token_scan.count_tokens, "mix": mixing.mix, "pii": pii.find_personal_data, "licenses": licenses.scan_licenses,
        "ctw": ctw.score_texts, "langid": langid.predict_languages, "toxicity": lambda d: toxicity.score_toxicity(d, labels), "exact": exact.exact_duplicates,
        "decontam": lambda d: decontam.contained_items(d, items),
    }


NAMES = ["near", "tokens", "mix", "pii", "licenses", "ctw", "langid", "toxicity", "exact", "decontam"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(table, odd_rows, clashing, items, labels, name):
    out = operators(items, labels)[name](clashing(table(odd_rows))).collect()
    if name == "decontam":
        assert {(r.doc_id, r.item_id) for r in out} == {(None, 1), (4, 3), (5, 3)}
    else:
        assert sorted((r.doc_id is not None, r.doc_id or 0) for r in out) == sorted((r[0] is not None, r[0] or 0) for r in odd_rows)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(table, items, labels, name):
    assert operators(items, labels)[name](table([])).collect() == []


def test_odd_values(table, odd_rows, labels):
    docs = table(odd_rows)
    rows = {r.doc_id: r for r in exact.exact_duplicates(docs).collect() if r.doc_id}
    assert rows[2].keep_id == 1 and rows[4].group_size == 2 and rows[4].kept and rows[3].keep_id == 3
    rows = {r.doc_id: r for r in near.near_duplicates(docs).collect() if r.doc_id}
    assert rows[1].n_shingles == 0 and rows[1].kept and rows[5].component_id == 4 and not rows[5].kept
    rows = {r.doc_id: r for r in langid.predict_languages(docs).collect() if r.doc_id}
    assert rows[1].lang_pred == rows[6].lang_pred == "und" and rows[1].score == 0
    rows = {r.doc_id: r for r in ctw.score_texts(docs).collect() if r.doc_id}
    assert rows[1].n_tokens == 1 and rows[2].score == rows[1].score < 0
    rows = {r.doc_id: r for r in licenses.scan_licenses(docs).collect() if r.doc_id}
    assert (rows[1].n_words, rows[6].n_words, rows[7].n_words) == (0, 2, 100)


def test_numerals_are_no_letters():
    assert [langid.letters_of(x) for x in ("½ ²", "Ⅷ", "5 ½ a", "Été!", None)] == ["", "", "½ a", "été", ""]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_odd_and_empty_tables(spark, table, odd_rows, tmp_path, items, name, stage):
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in (odd_rows, []):
        docs = table(rows)
        out = stage(spark, docs, str(tmp_path))
        if name != "mix":
            assert out.columns == docs.columns
        kept = out.collect()
        assert len(kept) <= len(rows)
        if name == "exact_dedup" and rows:
            assert len(kept) == len({" ".join((r[1] or "").split()) if (r[1] or "").strip() else (r[1] or "").strip("\t\n ") + " " * bool(r[1]) for r in rows})
