"""Small tables with every awkward case, and the documents of the smallest scale."""

import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, node long, n long, key long, component string"


def awkward_texts(seed: int) -> list[str | None]:
    """Copies, near copies, shared passages, blanks, nulls, one long text."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "bcdfgklmnprst" for b in ("a", "e", "in", "or", "ust", "é")]
    base = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 5, 9, 30, 80]))) for _ in range(60)]
    passage = " ".join(rng.choice(words) for _ in range(20))
    out: list[str | None] = list(base)
    for t in base[:30]:
        w = t.split(" ")
        w[rng.randrange(len(w))] = "CHANGED"
        out += [t, " ".join(w), t.upper(), t + "\n" + passage, passage + " " + t]
    near = base[7].split(" ") + passage.split(" ") * 3
    for _ in range(40):
        w = list(near)
        w[rng.randrange(len(w))] = rng.choice(words)
        out.append(" ".join(w))
    out += [None, None, "", "", "   ", "\n\t \n", "x", "x", ". . .", " ".join(rng.choice(words) for _ in range(20_000)), "a" * 50_000]
    rng.shuffle(out)
    return out


@pytest.fixture(scope="session")
def awkward(spark):
    """Awkward documents with columns whose names clash with the operators' own; ids unique."""
    rows = [(i, t, "en", "s", None, -i, 7, None, i, "c") for i, t in enumerate(awkward_texts(1))]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def ragged(awkward):
    """The same with null and repeated ids, and repeated rows."""
    from pyspark.sql import functions as F

    return awkward.withColumn("doc_id", F.expr("case when doc_id % 11 = 0 then null when doc_id % 7 = 0 then 7 else doc_id end")).union(awkward.limit(20))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


@pytest.fixture(scope="session")
def texts(awkward):
    return {r.doc_id: r.text or "" for r in awkward.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def corpus_texts(corpus):
    return {r.doc_id: r.text or "" for r in corpus.select("doc_id", "text").collect()}
