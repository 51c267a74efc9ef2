"""Counts, licenses, languages and quality against plain versions and on edge cases."""

import zlib
from collections import Counter

import numpy as np
import pytest
from brute import counts, phrases
from pyspark.sql import functions as F

from clientele.llm import language, licenses, quality, queries, rules


def test_rules_count_as_brute_force(spark, small, small_docs):
    found = {r.doc_id: r for r in queries.op7_rules(spark, small).collect()}
    assert len(found) == len(small_docs)
    for doc_id, text in small_docs:
        assert tuple(found[doc_id])[1:7] == counts(text)
        assert not (found[doc_id].kept and found[doc_id].base_failed)


def test_rules_on_edges(edge, none):
    found = rules.judge(edge)
    assert [c for c in found.columns if c in edge.columns] == [
        *(c for c in edge.columns if c not in ("text", *rules.RESULTS)), "n_words", "kept"
    ]
    rows = found.collect()
    texts = edge.select("doc_id", "text").collect()
    assert sorted(tuple(r[c] for c in rules.COUNTS) + (r.base_failed,) for r in rows) == sorted(counts(t.text) for t in texts)
    assert rules.judge(none).collect() == []


def test_rules_reject_what_is_far_from_its_group(spark):
    words = "river stone light paper house green seven window garden little".split()
    clean = [(i, " ".join(words[(i * 7 + k * (1 + i % 3) + k * k) % 10] + "abcdefgh"[(i + k) % 8] for k in range(40 + i % 30)), "en", "s") for i in range(120)]
    junk = [(1_000 + i, " ".join(f"{w}$$${i}***" for w in words * 2), "en", "s") for i in range(20)]
    found = rules.judge(spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string"))
    kept = {r.doc_id: r.kept for r in found.collect()}
    assert not any(kept[i] for i, *_ in junk)
    assert sum(kept[i] for i, *_ in clean if not counts(dict((c[0], c[1]) for c in clean)[i])[5]) == sum(
        not counts(t)[5] for _, t, *_ in clean
    )


def test_rules_run_without_python(spark, small):
    plan = rules.text_counts(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_licenses_find_base_phrases_as_brute_force(spark, small, small_docs):
    found = {r.doc_id: r for r in queries.op3_licenses(spark, small).collect()}
    assert len(found) == len(small_docs)
    for doc_id, text in small_docs:
        r = found[doc_id]
        assert tuple(r)[1:6] == phrases(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1


def test_licenses_on_edges(spark, edge, none):
    extra = [
        (30, "x under the MIT license, UNDER THE MIT-LICENSE! cc by nc by nc cc by nc"),
        (31, "under the mit"),
        (32, "all rights reserved all rights reserved all rights reserved"),
        # A word put in and one left out: neighbouring diagonals merge.
        (33, "permission is hereby granted free of charge to any single person obtaining a copy of this software "
             "and associated documentation the software to deal in the software without restriction"),
        (33, None),
    ]
    docs = edge.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    found = licenses.scan(docs).collect()
    expected = [(r.doc_id, *phrases(r.text)) for r in docs.collect()]
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found]
    assert sorted(got, key=str) == sorted(expected, key=str)
    labels = {r.doc_id: r.labels for r in found if r.n_words}
    assert labels[32] == "all-rights-reserved" and labels[33] == "mit" and labels[31] == ""
    assert licenses.scan(none).collect() == []


def test_template_table_is_bounded(spark):
    with pytest.raises(ValueError, match="at most"):
        licenses.template_runs(spark, [licenses.Template("x", "w " * (licenses.MAX_TEMPLATE_WORDS + 10))])
    with pytest.raises(ValueError, match="needs"):
        licenses.template_runs(spark, [licenses.Template("x", "two words")])


def test_language_on_held_out(spark, small):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    found = queries.op10_language(spark, small).collect()
    assert len(found) == len(docs)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    held = [r.lang_pred == docs[r.doc_id].lang for r in found if r.held_out]
    assert sum(held) >= 0.95 * len(held)


def test_language_on_edges(edge, none):
    learn = ~language.held_out(F.col("doc_id"))
    found = language.identify(edge, language.fit(edge, learn)).collect()
    assert len(found) == edge.count()
    for r in found:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0)
        assert r.key == 1 and r.label == 15
    assert language.fit(none, learn) is None
    assert language.identify(none, None).collect() == []
    assert {r.lang_pred for r in language.identify(edge, None).collect()} == {"und"}


def test_quality_tells_junk_from_prose(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = queries.op6_quality(spark, sf).collect()
    seen = Counter((labels[r.doc_id], r.kept) for r in found if r.doc_id in labels)
    assert seen[(1, 0), True] >= 0.97 * (seen[(1, 0), True] + seen[(1, 0), False])
    bad = sum(n for (x, _), n in seen.items() if x[0] == 0)
    assert sum(n for (x, kept), n in seen.items() if x[0] == 0 and not kept) >= 0.9 * bad


def test_quality_finds_toxic_among_many_labels(spark):
    """The more labels, the more words tell good from bad; those of toxic texts must stay among them."""
    sf, good = "/root/testdata/sf0.1", queries.fit_for_training()
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source", "lang")
    away = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    twice = lambda t: t.withColumn("doc_id", F.explode(F.array("doc_id", F.col("doc_id") + 10**9)))
    learned = twice(labels.filter(~away))
    assert learned.count() > quality.SAMPLE
    model = quality.fit(twice(docs), learned, good)
    asked = docs.join(labels.filter(away), "doc_id").select("text", "quality", "toxic").toPandas()
    kept = model.evidence(asked["text"]) + np.log(3) >= 0
    toxic, clean = asked["toxic"] == 1, (asked["quality"] == 1) & (asked["toxic"] == 0)
    assert (~kept[toxic]).sum() >= 0.9 * toxic.sum() and toxic.sum() > 50
    assert kept[clean].sum() >= 0.97 * clean.sum()


def test_quality_shrinks_sparse_sites(spark):
    docs = [(i, "some words here", "big", "p") for i in range(200)] + [(500, "x", "tiny", None), (501, "y", None, "p")]
    labels = [(i, int(i % 10 != 0)) for i in range(200)] + [(500, 0), (500, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    rates = {r._host: r for r in quality.site_rates(d, marks, F.col("quality") == 1, "doc_id", "source", "lang").filter("_path <> ''").collect()}
    assert abs(rates["=big"].path_rate - 0.9) < 0.03
    assert 0.3 < rates["=tiny"].path_rate < 0.9  # one bad label does not condemn a site


def test_quality_on_edges(spark, edge, none):
    labels = spark.createDataFrame([(10, 1), (10, 0), (14, 0), (18, 1), (None, 1), (19, None)], "doc_id long, quality int")
    good = F.col("quality") == 1
    found = quality.judge(edge, labels, good)
    rows = found.collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.key == 1 for r in rows)
    assert quality.judge(none, labels, good).collect() == []
    assert {r.score for r in quality.judge(edge, labels.limit(0), good).collect()} == {0.5}


def plain_estimate(x):
    """Centre and covariance of the tighter rows, all rows of a group at hand."""
    least = np.diag(np.square(rules.FLOORS))
    spread = lambda rows, scale: scale * np.cov(rows.T, bias=True) + least
    cells = np.sort(np.floor(x * 128), axis=0)
    share = np.arange(1, len(x) + 1) / len(x)
    at = lambda q: (cells[np.argmax(share >= q)] + 0.5) / 128
    starts = [(x.mean(0), spread(x, 1.0)), (at(0.5), np.diag(((at(0.75) - at(0.25)) / 1.349) ** 2) + least)]
    found = []
    for mean, cov in starts:
        for _ in range(rules.STEPS):
            bins = np.floor(np.log2(np.maximum(plain_distance(x, mean, cov), 1e-6)) * rules.BINS_PER_OCTAVE)
            nearer = np.array([(bins < b).sum() for b in bins])
            near = x[nearer < rules.QUOTA * len(x)]
            mean, cov = near.mean(0), spread(near, rules._consistency())
        found.append((np.linalg.slogdet(cov)[1], mean, cov))
    return min(found, key=lambda f: f[0])[1:]


def plain_distance(x, mean, cov):
    away = x - mean
    return np.einsum("ij,ij->i", away @ np.linalg.inv(cov), away)


def test_rules_judge_as_plain_estimates(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    x, fails = [], []
    for d in docs:
        n_words, chars, symbols, lines, repeats, failed = counts(d.text)
        n = n_words + rules.SMOOTH
        n_lines = sum(any(c not in " \t\n\x0b\x0c\r" for c in line) for line in (d.text or "").split("\n"))
        x.append((np.log((chars + rules.SMOOTH * rules.WORD_LENGTH) / n), np.log1p(symbols / n), lines / max(n_lines, 1), repeats / n))
        fails.append(failed)
    x, fails = np.array(x), np.array(fails)
    levels = [[(), (d.lang,), (d.lang, d.source)] for d in docs]
    members = {}
    for i in np.flatnonzero(~fails):
        for level in levels[i]:
            members.setdefault(level, []).append(i)
    shapes = {k: plain_estimate(x[v]) for k, v in members.items() if len(v) >= rules.LEAST or not k}
    found = {r.doc_id: r for r in queries.op7_rules(spark, small).collect()}
    for i, d in enumerate(docs):
        shape = next(shapes[k] for k in reversed(levels[i]) if k in shapes)
        distance = plain_distance(x[i : i + 1], *shape)[0]
        assert found[d.doc_id].distance == pytest.approx(distance, rel=1e-6, abs=1e-9)
        assert found[d.doc_id].kept == (not fails[i] and distance <= rules.CUTOFF)


def test_language_scores_as_plain_kernel(spark, small):
    """Every score from sets of grams, one text and one landmark at a time."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = language.fit(docs, ~language.held_out(F.col("doc_id")))
    found = language.identify(docs.select("doc_id", "text"), model).collect()

    def grams(text):
        b = text.lower().encode()
        places = set()
        for n in language.ORDERS:
            for i in range(len(b) - n + 1):
                code = int.from_bytes(bytes([n]) + b[i : i + n], "big") % 2**32
                places.add(code * 0x9E3779B1 % 2**32 >> 17)
        return places

    marks = [set(np.flatnonzero(np.unpackbits(m))) for m in model.landmarks]
    for r in found[::3]:
        own = grams(r.text or "")
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == (language.UNKNOWN, 0.0)
            continue
        kernel = [len(own & m) / np.sqrt(len(own) * len(m)) for m in marks]
        values = np.array(kernel) @ model.weights
        assert r.score == pytest.approx(np.clip((1 + values.max()) / 2, 0, 1), abs=1e-3)
        assert values[model.languages.index(r.lang_pred)] == pytest.approx(values.max(), abs=2e-3)
