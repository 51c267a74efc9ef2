"""The pipeline's stages on the small table, each against what it was given."""

import random

import pytest
from brute import near, repeats
from test_tokens import check_packing

import corpus_pipeline as pipeline
from clientele.llm.common import keep


@pytest.fixture(scope="module")
def steps(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in pipeline.STAGES:
        docs = keep(stage(spark, docs, small), "stage")
        out.append((name, docs))
    return dict(out)


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns_and_only_remove(steps):
    frames = list(steps.values())
    for before, after in zip(frames[:-2], frames[1:-1], strict=True):
        assert after.columns == before.columns
        assert rows(after).keys() <= rows(before).keys()
    filters = ("language ID", "quality classifier", "MinHash near-dedup")
    texts = rows(steps["documents"])
    assert all(texts[d] == t for name in filters for d, t in rows(steps[name]).items())


def test_filters_keep_clean_documents(spark, small, steps):
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    clean = {d for d, mark in labels.items() if mark == (1, 0)}
    kept = rows(steps["quality classifier"]).keys()
    assert len(clean & kept) >= 0.95 * len(clean)
    letters = {d for d, t in rows(steps["documents"]).items() if any(c.isalpha() for c in t or "")}
    assert len(rows(steps["language ID"]).keys()) >= 0.98 * len(letters)


def test_language_stage_rejects_what_is_like_no_language(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    r = random.Random(5)
    kinds = ["abcdefghijklmnopqrstuvwxyz", "bcdfghjklmnpqrstvwxz", "0123456789abcdef", "абвгдежзийклмнопрстуфхцчшщ"]
    kinds.append("".join(chr(0x4E00 + k) for k in range(3_000)))
    word = lambda letters: "".join(r.choice(letters) for _ in range(r.randint(3, 9)))
    strange = [
        (10**6 + 100 * k + i, " ".join(word(letters) for _ in range(r.randint(20, 200))))
        for k, letters in enumerate(kinds)
        for i in range(20)
    ]
    # Without a language they are judged and not learned from.
    more = spark.createDataFrame(strange, "doc_id long, text string")
    kept = rows(pipeline.known_language(spark, docs.unionByName(more, allowMissingColumns=True), small))
    assert sum(d >= 10**6 for d in kept) <= 0.02 * len(strange)
    assert len(kept) >= 0.98 * docs.filter(r"text rlike '\\p{L}'").count()


def test_one_of_each_group_stays(steps):
    given = list(rows(steps["quality classifier"]).items())
    assert sorted(rows(steps["MinHash near-dedup"])) == sorted(d for d, _, _, kept in near(given, 5, 80) if kept)


def test_passages_are_taken_out(steps):
    given = list(rows(steps["MinHash near-dedup"]).items())
    removed = {d: gone for d, _, gone, _, _ in repeats(given, pipeline.PASSAGE)}
    for d, text in rows(steps["suffix-array dedup"]).items():
        # Whole characters only: at each end of a span up to three bytes may stay.
        left = len((dict(given)[d] or "").encode()) - len((text or "").encode())
        assert removed[d] - 60 <= left <= removed[d]
    assert all(r.n_chars == len(r.text or "") for r in steps["suffix-array dedup"].collect())


def test_passages_of_short_words_are_taken_out(spark, small):
    r = random.Random(7)
    words = lambda n: [r.choice("bcdfgh") + r.choice("aeiou")[: r.randint(0, 1)] + str(r.randint(0, 9)) for _ in range(n)]
    own = lambda k, n: [f"{k}x{r.randrange(10**9)}" for _ in range(n)]
    planted, texts, left = [" ".join(words(n)) for n in (51, 50, 51, 60)], [], []
    assert max(map(len, planted)) < pipeline.PASSAGE
    for k in range(8):
        before, after = " ".join(own(k, 20)), " ".join(own(k, 20))
        texts.append(f"{before} {planted[k // 2]}\n{after}")
        left.append(f"{before} \n{after}" if k // 2 != 1 else texts[-1])
    texts += [" ".join(words(55))] * 2 + [" ".join(words(40))] * 2
    left += ["", "", texts[-1], texts[-1]]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert rows(pipeline.no_repeated_passages(spark, docs, small)) == dict(enumerate(left))


def test_all_documents_are_packed(steps):
    packed = steps["best-fit packing"].collect()
    check_packing(packed, pipeline.SEQUENCE)
    assert {r.doc_id for r in packed} == rows(steps["suffix-array dedup"]).keys()


def test_stages_on_edges(spark, edge, none, small):
    for docs in (edge, none):
        docs = docs.selectExpr("doc_id", "text", "lang", "source", "cast(length(text) as bigint) AS n_chars")
        for name, stage in pipeline.STAGES:
            out = stage(spark, docs, small)
            found = out.collect()
            if name == "MinHash near-dedup":
                # Equal rows, exact and near copies leave one.
                assert len({r.text for r in found}) == len([r for r in found if (r.text or "").strip()]) + len(
                    {r.text for r in found if not (r.text or "").strip()}
                )
