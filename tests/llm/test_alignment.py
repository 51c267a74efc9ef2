import hashlib
import json
from collections import Counter

import pytest

from clientele.llm import alignment
from clientele.llm.encode import byte_characters
from clientele.llm.queries import BYTE_BPE, PIECE_BPE

EXTRA = [
    (50, "a▁b"),
    (51, "x <s> </s> <|endoftext|>   y\0z"),
    (52, "▁"),
    (53, " lead"),
    (54, "漢字かな交じり 😀😀"),
]


@pytest.fixture(scope="module")
def models():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)


def brute(docs, a_model, b_model):
    """All links and groups from dictionaries of the offsets where tokens end."""
    byte_of = {chr(c): b for b, c in byte_characters().items()}
    special = {t["id"] for t in json.load(open(BYTE_BPE, encoding="utf-8"))["added_tokens"]}
    a_bytes = {i: bytes(byte_of[c] for c in t) for t, i in a_model.get_vocab().items() if i not in special}

    def b_bytes(i):
        piece = b_model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_model.is_byte(i) else piece.replace("▁", " ").encode()

    found, counts = [], Counter()
    for doc_id, text in docs:
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if b"".join(a_bytes[i] for i in a) != whole or b"".join(map(b_bytes, b)) != whole:
            a, b = [], []
        ends_a, ends_b = {}, {}
        for ids, size, ends in ((a, a_bytes.get, ends_a), (b, b_bytes, ends_b)):
            n = 0
            for k, i in enumerate(ids):
                n += len(size(i))
                ends[n] = k
        shared = sorted(ends_a.keys() & ends_b.keys())
        links = [(a[ends_a[e]], b[ends_b[e]]) for e in shared]
        counts.update(links)
        groups, x, y = [], 0, 0
        for e in shared:
            groups.append(",".join(map(str, a[x : ends_a[e] + 1])) + "|" + ",".join(map(str, b[y : ends_b[e] + 1])))
            x, y = ends_a[e] + 1, ends_b[e] + 1
        found.append((doc_id, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(n, top.get(y, 0))
    return sorted(
        (
            (d, a, b, len(x), len(x), sum(counts[p] == top[p[1]] for p in x), sum(counts[p] for p in x), digest)
            for d, a, b, x, digest in found
        ),
        key=str,
    )


@pytest.mark.parametrize("piece", [alignment.PIECE, 1, 2, 7, 1000])
def test_alignment_of_edge_rows(spark, edge, models, piece):
    """Pieces of any length give the same: texts in one piece and in as many as they have ends."""
    docs = edge.select("doc_id", "text", "score", "piece", "part").unionByName(
        spark.createDataFrame(EXTRA, "doc_id long, text string"), allowMissingColumns=True
    )
    got = alignment.align(docs, BYTE_BPE, PIECE_BPE, piece=piece)
    expected = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], *models)
    assert sorted(map(tuple, got.collect()), key=str) == expected
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_of_small_table(spark, small, small_docs, models):
    from clientele.llm.queries import QUERIES

    got = QUERIES["op13_alignment"](spark, small)
    assert sorted(map(tuple, got.collect()), key=str) == brute(small_docs, *models)


def test_alignment_of_nothing(none):
    assert alignment.align(none, BYTE_BPE, PIECE_BPE).collect() == []


def test_fast_encoder_gives_the_library_ids(models, small_docs):
    own = alignment.tokenizer(BYTE_BPE)
    assert own.fast is not None
    texts = [t for _, t in small_docs if t]
    # Every character once beside letters, blanks and digits.
    every = [chr(c) for c in range(1, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    texts += ["".join(f"a{c}b {c} 1{c}{c} " for c in every[k : k + 500]) for k in range(0, len(every), 500)]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == models[0].encode(text, add_special_tokens=False).ids


def test_links_are_bounded_by_the_vocabularies(models, small_docs):
    bound = alignment.pair_bound(alignment.tokenizer(BYTE_BPE).tokens, alignment.tokenizer(PIECE_BPE).tokens)
    assert 10_000 < bound < 1_000_000


def test_splits_keep_equal_ends_together():
    import numpy as np

    a, b = np.array([1, 3, 4, 9, 12]), np.array([2, 3, 4, 8, 9, 10, 12])
    for piece in range(1, 14):
        i, j = alignment.diagonal_splits(a, b, piece)
        assert i[0] == j[0] == 0 and i[-1] == len(a) and j[-1] == len(b)
        assert (np.diff(i) >= 0).all() and (np.diff(j) >= 0).all() and (np.diff(i + j) <= piece + 1).all()
        for x, y in zip(i, j, strict=True):
            assert not set(a[:x]) & set(b[y:]) and not set(b[:y]) & set(a[x:])
            assert max([*a[:x], *b[:y], 0]) <= min([*a[x:], *b[y:], 99])
