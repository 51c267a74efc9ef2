"""Token ids, files and packing against the tokenizers library."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from brute import crc, little
from tokenizers import Tokenizer

from clientele.llm import bpe, encode, packing, queries, token_files

BYTE, WORD = queries.BYTE_BPE, queries.WORD_BPE
PARTS = [
    "a", "b", "the ", " the", "  ", "\n", "\t", "é", "中", "😀", "aaaa", "<|endoftext|>", "<|", " ", "　", "1", "23",
    "'s", "'LL", "!!", "...", " \n", "ing", "tion", "İ", "\x1c", "\x85", "́", "ABC", "\n\n", "----", "​", "٣", "×", "÷", "ÀÖ",
]


def texts(n):
    r = random.Random(5)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 12))) for _ in range(n)]


def test_prefix_programming_is_exact():
    library, own = Tokenizer.from_file(BYTE), bpe.Vocabulary(BYTE)
    for text in [*texts(3_000), "a" * 3_000, "ab" * 700, " " * 500 + "x"]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids, text
        assert own.decode(little(ids)) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize(("path", "chunks"), [(BYTE, "spaced"), (WORD, "words")])
def test_cached_chunks_are_exact(path, chunks):
    library = Tokenizer.from_file(path)
    sample = texts(3_000)
    for text, ids in zip(sample, encode.encode_texts(sample, path, chunks), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert encode.encode_texts([None, ""], path, chunks) == [b"", b""]


def test_bpe_query(spark, small, small_docs):
    library = Tokenizer.from_file(BYTE)
    found = {r.doc_id: tuple(r)[1:] for r in queries.op4_bpe(spark, small).collect()}
    for doc_id, text in small_docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert found[doc_id] == (
            len(ids), hashlib.sha256(little(ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest()
        )


def test_bpe_on_edges(edge, none):
    coded = edge.withColumn("ids", bpe.encode(edge["text"], BYTE))
    back = coded.withColumn("again", bpe.decode(coded["ids"], BYTE)).collect()
    assert all(r.again == (r.text or "") for r in back)
    assert none.select(bpe.encode(none["text"], BYTE)).collect() == []


def test_token_files_query(spark, small, small_docs):
    library = Tokenizer.from_file(WORD)
    found, start = queries.op8_token_files(spark, small).orderBy("start").collect(), 0
    for r, (doc_id, text) in zip(found, sorted(small_docs), strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert tuple(r) == (doc_id, start, len(ids), crc(ids))
        start += len(ids)


def test_token_files_on_edges(spark, edge, none):
    library = Tokenizer.from_file(WORD)
    folder = token_files.dataset_folder(spark)
    written = token_files.write_tokens(edge, folder, WORD, "words", 2, 49_408)
    found = token_files.read_tokens(written, folder, 49_408).orderBy("start").collect()
    expected = [(r.doc_id, little([*library.encode(r.text or "", add_special_tokens=False).ids, 2])) for r in edge.collect()]
    assert sorted(((r.doc_id, bytes(r.ids)) for r in found), key=str) == sorted(expected, key=str)
    keys = [r.doc_id for r in found]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))
    assert [r.start for r in found[1:]] == [r.start + r.n_tokens for r in found[:-1]]
    empty = token_files.dataset_folder(spark)
    written = token_files.write_tokens(none, empty, WORD, "words", 2, 49_408)
    assert token_files.read_tokens(written, empty, 49_408).collect() == []
    assert token_files.id_type(65_536) == "<u2" and token_files.id_type(65_537) == "<u4"


def test_files_are_flat_arrays(spark, small):
    folder = token_files.dataset_folder(spark)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    written = token_files.write_tokens(docs, folder, WORD, "words", 2, 49_408).orderBy("part").collect()
    base = 0
    for r in written:
        ids = token_files._mapped(folder, f"part-{r.part:06d}.bin", "<u2")
        off = token_files._mapped(folder, f"part-{r.part:06d}.off", "<u8")
        assert r.base == base == off[0] and len(ids) == r.ids == off[-1] - off[0] and len(off) == r.docs + 1
        assert all(ids[int(e - off[0]) - 1] == 2 for e in off[1:])
        base += r.ids


def check_packing(rows, size):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_packing_query(spark, small, small_docs):
    library = Tokenizer.from_file(BYTE)
    rows = queries.op9_packing(spark, small).collect()
    expected, total = {}, 0
    for doc_id, text in small_docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        total += len(ids)
        starts = [0, *range(len(ids) % 2048 or 2048, len(ids), 2048)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            expected[doc_id, k] = (a, b - a, crc(ids[a:b]))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    assert check_packing(rows, 2048) <= -(-total // 2048) + 1


def test_packing_on_edges(edge, none):
    rows = packing.pack_documents(edge, BYTE, "spaced", 64, 0).collect()
    check_packing(rows, 64)
    assert sum(r.piece == 0 for r in rows) == edge.count()
    assert packing.pack_documents(none, BYTE, "spaced", 64, 0).collect() == []


def test_fullest_against_all_subsets():
    r = random.Random(1)
    for _ in range(300):
        lengths = [r.randint(1, 30) for _ in range(r.randint(0, 9))]
        room = r.randint(0, 80)
        best = max(s for m in range(1 << len(lengths)) if (s := sum(x for k, x in enumerate(lengths) if m >> k & 1)) <= room)
        counts = {x: lengths.count(x) for x in lengths}
        chosen = packing.fullest(counts, room)
        assert sum(k * n for k, n in chosen.items()) == best
        assert all(n <= counts[k] for k, n in chosen.items())


def test_plan_stays_short():
    r = random.Random(2)
    counts = {k: r.randint(1, 10**6) for k in range(1, 2049)}
    plan = packing.plan_bins(counts, 2048)
    assert len(plan) < 60_000
    for length, n in counts.items():
        taken = sorted((a, b) for x, a, b, *_ in plan if x == length)
        assert taken[0][0] == 0 and taken[-1][1] == n and all(p[1] == q[0] for p, q in zip(taken, taken[1:], strict=False))
