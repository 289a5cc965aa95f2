"""Small tables of documents."""

import random

import pytest

from shelfline.llm.catalog import prepared

SMALL = "/root/testdata/sf0.001"

#: Columns whose names operators use inside or add.
CLASHING = "chunk string, rest string, size string, kept string, block int, shard string, n_words string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


def frame(spark, docs):
    """A table of documents with further columns of clashing names."""
    extra = ("c", "r", "s", "k", 7, "h", "w")
    rows = [(d["doc_id"], d["text"], "xx", d.get("source"), len(d["text"] or ""), *extra) for d in docs]
    return spark.createDataFrame(rows, SCHEMA)


def odd_docs():
    """Nulls, empty and blank texts, ties, repeated rows, near copies, shared passages, non-ASCII, one very long text."""
    rng = random.Random(3)
    vocabulary = [f"{a}{b}" for a in ("word", "Ünit", "x", "日本", "the", "CC") for b in range(40)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, base = say(60), say(120)
    near = base.split(" ")
    near[50] = "changed"
    texts = [None, "", "  \n\t ", "one", "one two", "ONE Two", base, base, base.upper(), " ".join(near), say(30) + "\n" + passage + "  " + say(9)]
    texts += [passage, passage + " " + say(5), say(12), say(13), "a b\tc\x0bd\x0ce\rf\ng\x00h\xa0i j", "same line\n" * 40 + say(10)]
    texts += ["# $ % & | < > *", "all rights reserved. CC BY 4.0, General  Public-License", say(12000) + " " + passage, "😀 é́ ▁ <s> <|endoftext|>x", "x " * 300]
    docs = [{"doc_id": i * 3, "text": t, "source": ["a", "b", None, "é", "a"][i % 5]} for i, t in enumerate(texts)]
    docs += [dict(docs[6]), {"doc_id": 18, "text": "another text of the same id", "source": "a"}, {"doc_id": None, "text": base, "source": "b"}]
    rng.shuffle(docs)
    return docs


@pytest.fixture(scope="session")
def llm(spark):
    return prepared(spark)


@pytest.fixture(scope="session")
def small(llm):
    return llm.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def small_rows(small):
    return [r.asDict() for r in small.collect()]


@pytest.fixture(scope="session")
def odd():
    return odd_docs()
