"""Language identification by compression with per-language zstandard dictionaries.

A dictionary is raw text of one language. A text is compressed with each dictionary, and the
language with the smallest result is chosen; if the second smallest is hardly larger, the text is rejected.

The dictionaries come from a bounded sample of the labelled rows (about ``SAMPLE_DOCS`` a language,
``SAMPLE_CHARS`` of each, ``DICTIONARY`` bytes kept), chosen by a hash over all of them. Scoring reads whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourpanel.llm.text import id_bucket, map_batches
from hourpanel.session import materialise

SAMPLE_DOCS = 400
SAMPLE_CHARS = 4000
DICTIONARY = 112 << 10
BLOCK = 16 << 10  # texts are encoded in blocks, so that a long one does not become its own dictionary
MIN_MARGIN = 0.01  # of the second smallest size; below it the text is rejected
UNKNOWN = "und"
HELD_OUT = 5  # a row is held out if this divides crc32(doc_id)

_NO_LETTER = re.compile(r"[\W\d_]+")


def letters_of(text: str | None) -> str:
    """Lower-cased letters with single spaces between the runs; empty if there is none but numerals such as ½, ² or Ⅷ."""
    body = _NO_LETTER.sub(" ", text.lower()).strip() if text else ""
    return body if any(map(str.isalpha, body)) else ""


def training_sample(docs: DataFrame, modulus: int = HELD_OUT) -> DataFrame:
    """(lang, part, turn): about SAMPLE_DOCS rows of each language; a row's chance is the same for all rows of its language."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (id_bucket("doc_id", modulus) != 0)).select("lang", "text")
    turn = F.xxhash64("text", F.lit(31))
    chance = (F.shiftrightunsigned(turn, 11).cast("double")) / F.lit(float(1 << 53))
    counts = rows.groupBy(F.col("lang").alias("r_lang")).agg(F.count("*").alias("n"))
    # written first: the join then knows that it is small, and does not deal the texts by language
    rates = materialise(counts.select("r_lang", (F.lit(float(SAMPLE_DOCS)) / F.col("n")).alias("rate")), "lang_rates")
    drawn = rows.select("lang", "text", turn.alias("turn"), chance.alias("chance")).join(rates, F.col("lang") == F.col("r_lang"))
    return drawn.where("chance < rate").select("lang", F.substring("text", 1, SAMPLE_CHARS).alias("part"), "turn")


def fit(docs: DataFrame, modulus: int = HELD_OUT) -> dict[str, bytes]:
    """Dictionary text by language. Twice SAMPLE_DOCS rows a language reach the driver at most, but for chance of no account."""
    parts: dict[str, list[str]] = {}
    for row in sorted(training_sample(docs, modulus).collect(), key=lambda r: (r["lang"], r["turn"], r["part"])):
        parts.setdefault(row["lang"], []).append(letters_of(row["part"]))
    found = {lang: " ".join(x).encode("utf-8", "replace")[-DICTIONARY:] for lang, x in parts.items()}
    return {lang: x for lang, x in found.items() if x.strip()}


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_LAZY2, min_match=3, window_log=18, hash_log=17, chain_log=17, search_log=4,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    # raw content shorter than eight bytes is no dictionary to zstandard
    data = zstandard.ZstdCompressionDict(content.ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=params)


def judge(text: str | None, coders: list[tuple[str, zstandard.ZstdCompressor]]) -> tuple[str, float]:
    """(language, margin); margin is 0 where there is nothing to choose."""
    body = letters_of(text).encode("utf-8", "replace")
    if not body or not coders:
        return UNKNOWN, 0.0
    blocks = [body[i : i + BLOCK] for i in range(0, len(body), BLOCK)]
    sizes = sorted((sum(len(coder.compress(b)) for b in blocks), lang) for lang, coder in coders)
    return sizes[0][1], 1.0 if len(sizes) == 1 else 1 - sizes[0][0] / sizes[1][0]


def identify(docs: DataFrame, dictionaries: dict[str, bytes], *keep: str) -> DataFrame:
    """``keep`` columns with lang_pred, margin (0 to 1), score (0 to 1) and rejected.

    Null text or text without a letter: ``und``, score 0, rejected. Equal sizes: the first language by
    name, margin 0, rejected. Without any dictionary every text is ``und``.
    """
    fields = [docs.schema[c] for c in keep]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = [(lang, _compressor(content)) for lang, content in sorted(dictionaries.items())]
        for batch in batches:
            found = [judge(t, coders) for t in batch.column("__text").to_pylist()]
            extra = [
                pa.array([x[0] for x in found], pa.string()),
                pa.array([x[1] for x in found], pa.float64()),
                pa.array([x[1] / (x[1] + 0.05) * 1.05 for x in found], pa.float64()),
                pa.array([x[0] == UNKNOWN or x[1] < MIN_MARGIN for x in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + extra, [*keep, "lang_pred", "margin", "score", "rejected"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "lang_pred string, margin double, score double, rejected boolean"])
    return map_batches(docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("__text")), work, schema)


def predict_languages(docs: DataFrame, modulus: int = HELD_OUT) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, rejected. Rows without lang are scored and not learned from."""
    dictionaries = fit(docs, modulus)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (id_bucket("doc_id", modulus) == 0).alias("held_out"), "text")
    return identify(plain, dictionaries, "doc_id", "held_out").select("doc_id", "held_out", "lang_pred", "score", "rejected")


def recognised(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, unchanged; the text passes through once with its row."""
    columns = list(docs.columns)
    return identify(docs, fit(docs), *columns).where(~F.col("rejected")).select(*[F.col(f"`{c}`") for c in columns])
