import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMNS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    ]
)
SYLLABLES = {"en": "the and ing tion er ha in on re th".split(), "fr": "eau que ou ment le la un ré eux ch".split(), "de": "sch ung ein ich der die ver keit ge zu".split()}


def prose(rng, lang="en", words=60):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="session")
def table(spark):
    def make(rows):
        full = [(*r, *[None] * (5 - len(r))) for r in rows]
        return spark.createDataFrame(full, COLUMNS).repartition(3)

    return make


@pytest.fixture(scope="session")
def corpus():
    """Rows in three languages with copies, near copies, odd whitespace, nulls and a long text."""
    rng = random.Random(7)
    rows = []
    for i in range(150):
        lang = ("en", "fr", "de")[i % 3]
        rows.append((i, prose(rng, lang, rng.randint(3, 120)), lang, f"s{i % 4}", 1))
    rows += [(200 + i, rows[i][1].replace(" ", "  \t"), rows[i][2], "s1", 1) for i in range(20)]
    for i in range(20):
        words = prose(rng, "en", 200).split()
        rows.append((300 + 2 * i, " ".join(words), "en", "s0", 1))
        words[rng.randrange(200)] = "changed"
        rows.append((301 + 2 * i, " ".join(words), "en", None, 1))
    rows.append((400, prose(rng, "de", 9000), "de", "s2", 1))
    return rows


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty and blank texts, null identifiers, repeated rows and ties."""
    return [
        (1, None, "en", "a", 0), (2, "", None, None, None), (3, " \t\n ", "en", "a", 3), (None, "the and the and the thing", "en", "a", 1),
        (None, None, None, None, None), (4, "word", "en", "b", 4), (4, "word", "en", "b", 4), (5, "Word", "fr", "b", 4), (6, "123 !! 456", "en", "c", 1),
        (7, "ßé \U0001f600 " * 50, "de", "c", 1), (8, "x" * 5000, "en", None, 1),
    ]


@pytest.fixture(scope="session")
def clashing():
    """Adds columns whose names the operators use inside."""
    names = ("key", "body", "sha", "word", "n", "c", "size", "rank", "slot", "node", "root", "u", "v", "label", "toxic", "score", "features", "block", "shard", "row_no", "text_key", "item_id", "kept", "target", "rate", "turn", "times", "k_id", "__text", "margin")

    def add(df):
        for name in names:
            df = df.withColumn(name, F.lit("clash"))
        return df

    return add
