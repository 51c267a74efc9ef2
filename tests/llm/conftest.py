import random

import pytest

WORDS = "alpha beta gamma delta of the and to in river stone light paper house green seven window garden".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randint(0, 40)) for _ in range(n))


def edge_rows():
    """Rows with NULLs in every column, empty, blank, short and very long texts, ties, repeats."""
    long = prose(1, 30_000)
    base = prose(2, 120)
    near = base.replace(base.split()[60], "changed", 1)
    passage = prose(3, 110)
    return [
        (10, base, "en", "s1"),
        (10, base, "en", "s1"),  # a repeated row
        (11, base, "en", "s2"),  # an exact copy
        (7, near, "en", "s1"),
        (None, base, None, None),
        (None, prose(4, 50), "en", None),
        (12, None, None, None),
        (13, None, "fr", "s1"),
        (14, "", "en", "s1"),
        (14, "", "en", "s1"),
        (15, " \n\t  ", None, "s2"),
        (16, "word", "en", "s1"),
        (17, "Word", "en", "s1"),
        (18, long, "en", "s1"),
        (19, prose(5, 20) + "\n" + passage + " " + prose(6, 30), "fr", "s3"),
        (20, "Été ß 中文 😀 " + passage + " 　ende <|endoftext|> x", "de", "s3"),
        (21, "12345 !!! ???", "en", "s2"),
        (22, "aaaa " * 400, "en", "s2"),
    ]


# Names the operators use inside or return.
CLASHES = {
    "key": "1", "hash": "2", "rank": "3", "ids": "4", "part": "5", "kept": "'x'", "score": "6", "spans": "7",
    "n_words": "8", "level": "9", "_row": "10", "node": "11", "component": "12", "family": "13", "at": "14",
    "label": "15", "m0": "16", "lang_pred": "'zz'", "evidence": "17", "length": "18", "piece": "19",
}

SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows with extra columns whose names clash."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(edge_rows(), SCHEMA)
    return docs.withColumns({k: F.expr(v) for k, v in CLASHES.items()}).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_docs(spark, small):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
