"""Near-duplicates, repeated passages, components and the pipeline against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from brute import components as plain_components
from brute import near, repeats, roots
from conftest import prose
from pyspark.sql import functions as F

from clientele.llm import embeddings, minhash, queries, suffixes
from clientele.llm.graph import components


def test_components(spark):
    r = random.Random(3)
    links = [(r.randint(0, 400), r.randint(0, 400)) for _ in range(300)] + [(k, k + 1) for k in range(500, 560)] + [(7, 7)]
    df = spark.createDataFrame([*links, (None, 3)], "x long, y long")
    top = roots(561, links)
    expected = {i: top[i] for p in links for i in p if sum(t == top[i] for t in top) > 1}
    assert {r.node: r.component for r in components(df).collect()} == expected


def test_minhash_query(spark, small, small_docs):
    found = queries.op2_minhash(spark, small).collect()
    assert sorted(map(tuple, found), key=str) == near(small_docs, 2, 80)


@pytest.mark.parametrize(("crowded", "block"), [(2_048, 1_000_000), (4, 60)])
def test_minhash_with_large_groups_and_edges(spark, edge, none, monkeypatch, crowded, block):
    """The same result when regions and families are cut into many blocks."""
    monkeypatch.setattr(minhash, "CROWDED", crowded)
    monkeypatch.setattr(minhash, "BLOCK", block)
    r = random.Random(9)
    base = prose(50, 60).split()
    copies = []
    for k in range(60):
        words = list(base)
        for _ in range(r.randint(0, 2)):
            words[r.randrange(60)] = f"new{k}"
        copies.append((100 + k, " ".join(words)))
    docs = edge.select("doc_id", "text").unionByName(spark.createDataFrame(copies, "doc_id long, text string"))
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    found = minhash.near_duplicates(docs, shingle=3, percent=80).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found), key=str)
    assert got == near(plain, 3, 80)
    if crowded > 100:
        assert minhash.near_duplicates(none).collect() == []


def vectors_brute(rows):
    good = []
    for _, v in rows:
        x = np.array([np.nan if e is None else e for e in v], float) if v else np.zeros(1)
        good.append(x if np.isfinite(x).all() and np.abs(x).max() > 0 else None)
    links, n = [], [0] * len(rows)
    for i, a in enumerate(good):
        for j, b in enumerate(good):
            if i != j and a is not None and b is not None and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.9:
                links.append((i, j))
                n[i] += 1
    top = plain_components([k for k, _ in rows], links)
    return sorted(((k, n[i], top[i], k is not None and top[i] == k) for i, (k, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("crowded", [2_048, 8])
def test_embeddings_with_hot_groups_and_edges(spark, monkeypatch, crowded):
    monkeypatch.setattr(embeddings, "CROWDED", crowded)
    rng = np.random.default_rng(4)
    centre = rng.normal(size=16)
    rows = [(k, (centre + 0.18 * rng.normal(size=16)).tolist()) for k in range(60)]
    rows += [(k, rng.normal(size=16).tolist()) for k in range(100, 300)]
    rows += [(400 + k, rows[k][1]) for k in range(30)] + [(400, rows[0][1])]
    rows += [(500, None), (501, []), (502, [0.0] * 16), (503, [1.0, None] * 8), (504, [float("inf")] * 16), (505, [float("nan")] * 16)]
    rows += [(506, [1.0, 2.0]), (507, [2.0, 4.0]), (None, rows[0][1]), (508, [1e-30, 0.0]), (509, [3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS key", "2 AS bucket")
    found = embeddings.near_duplicates(df.repartition(3)).collect()
    assert sorted(map(tuple, found), key=str) == vectors_brute(rows)


def test_embeddings_empty(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_hashing_scheme_grows_with_the_logarithm():
    few, many = embeddings.hashing(64, 1_000), embeddings.hashing(64, 10**9)
    assert few.rotations < many.rotations <= 5 and few.tables <= many.tables


def test_suffix_query(spark, small, small_docs):
    found = queries.op5_suffixes(spark, small).collect()
    assert sorted(map(tuple, found), key=str) == repeats(small_docs, 400)


@pytest.mark.parametrize(("length", "base"), [(24, 200), (100, suffixes.BASE)])
def test_repeats_on_edges(spark, edge, none, monkeypatch, length, base):
    monkeypatch.setattr(suffixes, "BASE", base)
    r = random.Random(length)
    passages = [prose(70 + k, 20) for k in range(6)]
    mixed = []
    for k in range(40):
        parts = [prose(1_000 + k, r.randint(0, 30))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, 40)
            parts += [p[a : a + r.randint(length - 2, length + 30)], prose(r.randint(0, 10**6), r.randint(0, 6))]
        mixed.append((200 + k, "".join(parts)))
    mixed += [(300, "ab" * 300), (301, "x" * (length + 1)), (302, "y" * length), (303, "z" * (length - 1)), (304, "é" * length)]
    docs = edge.filter("doc_id <> 18 OR doc_id IS NULL").select("doc_id", "text", "key", "spans").unionByName(
        spark.createDataFrame(mixed, "doc_id long, text string"), allowMissingColumns=True
    )
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, suffixes.digests(docs, length).collect()), key=str) == repeats(plain, length)
    if length == 100:
        assert suffixes.digests(none).collect() == []
        short = {r.doc_id: r for r in suffixes.remove(docs, length).collect()}
        assert short[302].text == "y" * length and short[300].text == "" and short[12].text is None


@pytest.mark.parametrize("stretch", [2, 3, 7])
def test_no_repeat_is_lost_at_the_border_of_a_stretch(spark, monkeypatch, stretch):
    """Suffixes that agree for long have ranks with holes and repeats."""
    monkeypatch.setattr(suffixes, "BASE", 0)
    monkeypatch.setattr(suffixes, "STRETCH", stretch)
    r = random.Random(11)
    passages = [prose(40 + k, 40) for k in range(5)]
    docs = []
    for k in range(120):
        p = r.choice(passages)
        a = r.randint(0, 120)
        docs.append((k, prose(500 + k, r.randint(0, 12)) + p[a : a + r.randint(58, 200)] + prose(900 + k, r.randint(0, 12))))
    found = suffixes.digests(spark.createDataFrame(docs, "doc_id long, text string"), 60).collect()
    assert sorted(map(tuple, found), key=str) == repeats(docs, 60)


def test_prefixes_of_the_reach_need_one_level(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BASE", 0)
    monkeypatch.setattr(suffixes, "MOST_LEVELS", 0)
    passage = prose(3, 60)
    docs = [(k, prose(500 + k, 4) + passage[k : k + 150 + k] + prose(900 + k, 5)) for k in range(20)]
    found = suffixes.digests(spark.createDataFrame(docs, "doc_id long, text string"), 60).collect()
    assert sorted(map(tuple, found), key=str) == repeats(docs, 60)


def lines_over_and_over(n):
    """Texts of one line many times, some with words of their own between, some as copies."""
    line, r = "the same line of words in all of them, number 1\n", random.Random(12)
    docs = []
    for k in range(n):
        own = prose(1_300 + k, 20)
        body = [line * r.randint(15, 60), own[:70], line * r.randint(0, 4), own[70:] * r.randint(1, 20)]
        docs.append((k, own[: r.randint(0, 40)] + "".join(body[: r.randint(1, 4)])))
    return [*docs, *((1_000 + k, t) for k, t in docs[::5]), (2_000, line + prose(13, 9)), (2_001, prose(14, 9) + line * 2)]


def test_lines_over_and_over(spark):
    docs = lines_over_and_over(40)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for length in (24, 60, 400):
        assert sorted(map(tuple, suffixes.digests(df, length).collect()), key=str) == repeats(docs, length)


def test_what_one_text_repeats_is_dealt_over_the_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = spark.createDataFrame(lines_over_and_over(40), "key long, text string")
        found = suffixes.repeated(suffixes.prefixes(docs, 400)).withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({(r.key, r.start) for r in found}) == len(found) and min(r.start for r in found) >= 0
    hashes, parts = (Counter(r[c] for r in found) for c in ("hash", "part"))
    assert max(hashes.values()) > 0.6 * len(found)  # One string has most rows.
    assert len(parts) > 1 and max(parts.values()) < 2 * len(found) / len(parts)


def test_short_passages_over_and_over(spark):
    texts = ["a b " * 40, "a b " * 40, prose(15, 30) + " c d" * 30, prose(16, 30) + " e f g"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    left = {r.doc_id: r.text for r in suffixes.remove(docs, 250, words=12).collect()}
    # Blanks at the ends are no part of a passage.
    assert left == {0: " ", 1: " ", 2: prose(15, 30) + " ", 3: texts[3]}


@pytest.mark.parametrize("base", [0, suffixes.BASE])
def test_suffix_ranks_are_lexicographic(spark, monkeypatch, base):
    monkeypatch.setattr(suffixes, "BASE", base)
    r = random.Random(8)
    strings = [[r.randint(0, 2) for _ in range(r.randint(1, 40))] for _ in range(25)] + [[1] * 50, [1] * 49]
    rows = [(k, i, s, 1, -1 - k) for k, x in enumerate(strings) for i, s in enumerate(x)]
    df = spark.createDataFrame(rows, "string long, place int, symbol long, size int, terminator long")
    ranks = suffixes.suffix_ranks(df, enough=10**9).collect()
    by_rank = [(r.string, r.place) for r in sorted(ranks, key=lambda r: r.rank)]
    # A terminator is below all symbols and differs between strings.
    plain = sorted(
        ((k, i) for k, x in enumerate(strings) for i in range(len(x))),
        key=lambda p: [(1, s) for s in strings[p[0]][p[1] :]] + [(0, -1 - p[0])],
    )
    assert sorted(r.rank for r in ranks) == list(range(len(plain)))
    assert by_rank == plain
