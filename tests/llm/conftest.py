import random

import pytest

SF = "/root/testdata/sf0.001"
#: Documents whose extra columns are named like those the operators return.
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, n_tokens long, component_id string, "
        "sequence_id string, score string, hash int")


def doc_rows(texts):
    """Rows of DOCS with ids 0, 1, ... of (text, lang, source) or plain texts."""
    out = []
    for i, t in enumerate(texts):
        text, lang, source = t if isinstance(t, tuple) else (t, None, None)
        out.append((i, text, lang, source, None, -1, "x", "y", "z", 3))
    return out


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, odd characters."""
    rng = random.Random(5)
    long = " ".join(f"w{rng.randrange(400)}" for _ in range(30_000))
    texts = [None, "", "   \n\t", "a", "!!!", long, long + " end", "Ünï  cödé\r\n\x1cx\x85y", "<|endoftext|> a<|endoftext|>b",
             "one two three four", "ONE two\nthree  four", "x" * 5000, "同じ 文章 です 。 はい いいえ"]
    rows = doc_rows(texts) + [(None, "null id text here it is", None, None, None, None, None, None, None, None)]
    rows += [rows[5], rows[9], rows[1]]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
