import random
import re
from collections import Counter

import numpy as np
import pytest

from clientele.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, best):
    counts, words = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(w)
            of = counts.setdefault(lang, Counter())
            for i in range(len(w)):
                for k in range(1, 6):
                    if i + k <= len(w):
                        of[tuple(w[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n, found = words[lang], []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in candidates.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside[p[i:j]], a)
        for p, a in candidates.items():
            if 100 * inside[p] >= 100 * a:
                continue
            s, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    usual = ["the", "Of", "and", "a", "Été", "ß", "x\0y", "中文", "to\xa0go"]
    out = []
    for k in range(150):
        text = "".join(r.choice(usual) + r.choice([" ", " ", " ", "\t", ". ", "\n", ",", " ;", "  "]) for _ in range(r.randint(0, 60)))
        text += r.choice(["", "once upon a time there was", "Once upon a time there", " ha ha ha ha ha ha ha"])
        out.append((r.choice(["en", "en", "fr", None, ""]), r.choice([text, text, text, None, ""]) if k % 10 == 0 else text))
    out += [out[3]] * 40  # repeated rows
    out.append(("en", "word " * 20_000 + "the of and " * 5_000))  # very long, without a border
    return out


@pytest.mark.parametrize(("words", "least", "best"), [(1 << 18, 5, 2000), (64, 12, 7)])
def test_collocations(spark, rows, monkeypatch, words, least, best):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows, "lang string, text string").withColumns(
        {c: F.lit(1) for c in ("words", "phrase", "n", "a", "hash", "rank", "score")}
    )
    monkeypatch.setattr(phrases, "RANGE_WORDS", words)
    got = phrases.collocations(docs.repartition(3), least=least, best=best, shard_words=words)
    assert sorted(map(tuple, got.collect())) == brute(rows, least, best)


def test_collocations_of_small_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = phrases.collocations(docs, least=10)
    assert sorted(map(tuple, got.collect())) == brute([(r.lang, r.text) for r in docs.collect()], 10, 2000)


def test_query_has_its_parameters(spark):
    from clientele.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = QUERIES["op11_phrases"](spark, folder)
    assert sorted(map(tuple, got.collect())) == brute([(r.lang, r.text) for r in docs.collect()], 100, 2000)


@pytest.mark.parametrize("rows_", [[], [(None, None), ("en", "")], [("en", ". , ;")]])
def test_nothing_to_find(spark, rows_):
    docs = spark.createDataFrame(rows_, "lang string, text string")
    assert phrases.collocations(docs).collect() == []


def test_filter_that_lets_everything_through(spark, rows, monkeypatch):
    """A full filter costs time and changes nothing."""
    monkeypatch.setattr(phrases.Filter, "__call__", lambda self, hashes: np.ones(len(hashes), bool))
    docs = spark.createDataFrame(rows[:120], "lang string, text string")
    assert sorted(map(tuple, phrases.collocations(docs, least=8).collect())) == brute(rows[:120], 8, 2000)


def test_scores_are_exact(spark):
    from pyspark.sql import functions as F

    numbers = [(10**13, 9 * 10**15, 10**13 + 7, 10**13 + 9), (100, 10**15, 100, 101), (100, 100, 10**9, 10**9), (999, 10**15 + 1, 37, 27)]
    df = spark.createDataFrame(numbers, "a long, n long, l long, r long")
    got = df.select("a", "n", "l", "r", phrases.score(*map(F.col, "anlr")).alias("s")).collect()
    for a, n, left, right, s in got:
        assert s == 1000 * a * n // (left * right)


def test_suffixes_are_in_order():
    ids = np.array([0, 3, 1, 3, 1, 2, 0, 3, 1, 0], np.int32)
    order = phrases.suffix_rows(ids, 6)
    cyclic = [tuple(np.roll(ids, -int(p))[:6]) for p in order]
    assert cyclic == sorted(cyclic) and sorted(order) == list(range(len(ids)))
