"""Tokens of two tokenizers of the same texts, aligned where both end: merge-path pieces.

Both token sequences of a text are sorted lists of byte offsets where tokens end.  Merging
the two lists finds the offsets they share, which cut the text into groups.  The merge is
divided before it is done: on every ``piece``-th diagonal of the merge (so many ends of A and
B together) a binary search finds how many of these ends are A's.  The pieces between two
diagonals have equal work whatever the length of a text, need nothing from each other, and are
stored as rows, so that Spark deals the pieces of one long text to many tasks.  A split that
would part two equal ends is moved behind both.  Each piece emits its links and the groups
closed in it; what is open at its borders is stitched to the neighbours' per text.

How often an id pair is linked is counted over the whole corpus, combined in each task first.
A pair links only if one token's bytes end with the other's, so there are at most some
hundreds of thousands of different pairs however large the corpus is (``pair_bound`` has the
number for two vocabularies); that table alone is broadcast.

Byte-level files whose ids follow their merges are encoded by the tiktoken library, which gives
the same ids as the tokenizers library several times as fast.

Defined results: a NULL or empty text, and one whose tokens' bytes are not the text with a space
before it (U+2581 in a text becomes a space in B), has no tokens: zeros and ''.  Strings of
special tokens inside texts are plain text.  Equal counts for a B id are all the best.
Repeated rows and repeated or NULL ids are aligned each on their own, and all count.  An
empty table gives no rows.  Columns beside id and text are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import keep, small_batches
from clientele.llm.encode import byte_characters, tiktoken_of
from clientele.llm.token_files import id_type

PIECE = 1 << 14  # ends of A and B in one piece


class Tokens(NamedTuple):
    """Bytes of every token id, one after the other, and where each begins."""

    data: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Tokens:
        lengths = np.array([len(t) for t in tokens], np.int64)
        return cls(np.frombuffer(b"".join(tokens), np.uint8), np.concatenate([[0], np.cumsum(lengths)]))

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        return self.first[ids + 1] - self.first[ids]

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a token sequence."""
        n = self.lengths(ids)
        begin = np.cumsum(n) - n
        return self.data[np.arange(n.sum()) + np.repeat(self.first[ids] - begin, n)]


class ByteLevel:
    """A byte-level tokenizer file; special tokens in texts are plain text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        byte_of = {chr(c): b for b, c in byte_characters().items()}
        special = {t["id"] for t in stored["added_tokens"]}
        if stored.get("normalizer"):
            raise ValueError("only byte-level tokenizers without normalizer are known here")
        ranks = {bytes(byte_of[c] for c in t): n for t, n in stored["model"]["vocab"].items() if n not in special}
        self.fast = tiktoken_of(path, special=False)
        if self.fast is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(path)
            self.slow.encode_special_tokens = True
            self.slow.no_truncation()
            self.slow.no_padding()
        by_id = {n: t for t, n in ranks.items()}
        self.tokens = Tokens.of([by_id.get(i, b"") for i in range(1 + max([*by_id, *special]))])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.fast is not None:
            return [self.fast.encode_to_numpy(t, disallowed_special=()).astype(np.int64) for t in texts]
        return [np.array(self.slow.encode(t, add_special_tokens=False).ids, np.int64) for t in texts]


class Pieces:
    """A sentencepiece model; it puts the space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        tokens = []
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                tokens.append(bytes([int(piece[3:5], 16)]))
            else:
                tokens.append(b"" if self.model.is_control(i) else piece.replace("▁", " ").encode())
        self.tokens = Tokens.of(tokens)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


@lru_cache(maxsize=4)
def tokenizer(path: str) -> ByteLevel | Pieces:
    return ByteLevel(path) if path.endswith(".json") else Pieces(path)


def pair_bound(a: Tokens, b: Tokens) -> int:
    """How many pairs of an A and a B token could ever end together: one ends with the other."""

    def by_bytes(t: Tokens) -> dict[bytes, int]:
        counts: dict[bytes, int] = {}
        for x, y in zip(t.first[:-1], t.first[1:], strict=True):
            token = t.data[x:y].tobytes()
            counts[token] = counts.get(token, 0) + (y > x)
        return counts

    in_a, in_b = by_bytes(a), by_bytes(b)
    shorter_b = sum(n * in_b.get(t[k:], 0) for t, n in in_a.items() for k in range(len(t)))
    shorter_a = sum(n * in_a.get(t[k:], 0) for t, n in in_b.items() for k in range(1, len(t)))
    return shorter_b + shorter_a


def diagonal_splits(a_ends: np.ndarray, b_ends: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of A and of B come before each piece of the merge, and the whole at the end.

    One binary search for all diagonals at once.  Of equal ends A's comes first; both stay
    in one piece.
    """
    n, m = len(a_ends), len(b_ends)
    d = np.arange(piece, n + m, piece)
    low, high = np.maximum(0, d - m), np.minimum(d, n)
    while (low < high).any():
        active = low < high
        i = np.where(active, (low + high) // 2, 0)
        a_first = a_ends[np.minimum(i, n - 1)] <= b_ends[np.clip(d - 1 - i, 0, m - 1)]
        low = np.where(active & a_first, i + 1, low)
        high = np.where(active & ~a_first, i, high)
    i, j = low, d - low
    if len(d):
        tied = (i > 0) & (j < m) & (a_ends[np.maximum(i, 1) - 1] == b_ends[np.minimum(j, m - 1)])
        j = j + tied
    return np.concatenate([[0], i, [n]]), np.concatenate([[0], j, [m]])


def encode_pieces(
    docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text", piece: int = PIECE
) -> DataFrame:
    """Texts encoded by both tokenizers and divided: one row per piece, kept as a table.

    ``a`` and ``b`` are the ids in the piece, ``a_from`` and ``b_from`` the bytes before them.
    """
    small_batches(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ta, tb = tokenizer(a_path), tokenizer(b_path)
        a_type, b_type = id_type(len(ta.tokens.first) - 1), id_type(len(tb.tokens.first) - 1)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            columns: tuple[list, ...] = ([], [], [], [], [], [], [], [])
            coded = zip(texts, ta.encode([" " + t for t in texts]), tb.encode(texts), strict=True)
            for k, (t, a, b) in enumerate(coded):
                wanted = np.frombuffer(b" " + t.encode(), np.uint8)
                if not t or not (
                    np.array_equal(ta.tokens.joined(a), wanted) and np.array_equal(tb.tokens.joined(b), wanted)
                ):
                    a = b = np.zeros(0, np.int64)
                a_ends, b_ends = np.cumsum(ta.tokens.lengths(a)), np.cumsum(tb.tokens.lengths(b))
                i, j = diagonal_splits(a_ends, b_ends, piece)
                # A moved split can leave its last piece without ends.
                for p in range(len(i) - 1):
                    row = (
                        k, p, len(i) - 1,
                        a[i[p] : i[p + 1]].astype(a_type).tobytes(), b[j[p] : j[p + 1]].astype(b_type).tobytes(),
                        int(a_ends[i[p] - 1]) if i[p] else 0, int(b_ends[j[p] - 1]) if j[p] else 0,
                    )
                    for column, value in zip(columns, row, strict=False):
                        column.append(value)
            at = pa.array(columns[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(at), batch.column("doc_id").take(at),
                    pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()),
                    pa.array(columns[3], pa.binary()), pa.array(columns[4], pa.binary()),
                    pa.array(columns[5], pa.int64()), pa.array(columns[6], pa.int64()),
                ],
                names=["row", "doc_id", "piece", "pieces", "a", "b", "a_from", "b_from"],
            )

    # The row number is written with the pieces, so it is one and the same for every later step.
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    )
    return keep(
        rows.mapInArrow(
            encode, "row long, doc_id long, piece int, pieces int, a binary, b binary, a_from long, b_from long"
        ),
        "merge-pieces",
    )


def _merge(a: np.ndarray, b: np.ndarray, a_from: int, b_from: int, ta: Tokens, tb: Tokens):
    """Places in ``a`` and ``b`` of the tokens that end together."""
    a_ends, b_ends = np.cumsum(ta.lengths(a)) + a_from, np.cumsum(tb.lengths(b)) + b_from
    j = np.searchsorted(b_ends, a_ends)
    i = np.flatnonzero(b_ends[np.minimum(j, len(b) - 1)] == a_ends) if len(b) else np.zeros(0, np.int64)
    return i, j[i]


def _merged(batch: pa.RecordBatch, a_path: str, b_path: str) -> Iterator[tuple]:
    """Every piece of a batch: ids of A, ids of B, places of both where they end together."""
    ta, tb = tokenizer(a_path).tokens, tokenizer(b_path).tokens
    a_type, b_type = id_type(len(ta.first) - 1), id_type(len(tb.first) - 1)
    starts = zip(batch.column("a_from").to_pylist(), batch.column("b_from").to_pylist(), strict=True)
    blobs = zip(batch.column("a"), batch.column("b"), starts, strict=True)
    for a_blob, b_blob, (a_from, b_from) in blobs:
        a = np.frombuffer(a_blob.as_buffer(), a_type).astype(np.int64)
        b = np.frombuffer(b_blob.as_buffer(), b_type).astype(np.int64)
        yield a, b, *_merge(a, b, a_from, b_from, ta, tb)


def _added(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts added up per code."""
    every, inverse = np.unique(np.concatenate(codes), return_inverse=True)
    return every, np.bincount(inverse, np.concatenate(counts), len(every)).astype(np.int64)


def link_counts(pieces: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Every linked id pair with its number of links, and whether it is its B id's highest."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        codes, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in batches:
            linked = [(a[i] << 32) | b[j] for a, b, i, j in _merged(batch, a_path, b_path)]
            if linked:
                found, times = np.unique(np.concatenate(linked), return_counts=True)
                codes.append(found)
                counts.append(times)
            if sum(map(len, codes)) > 4 * len(codes[0]) + 1_000_000:
                c, n = _added(codes, counts)
                codes, counts = [c], [n]
        c, n = _added(codes, counts)
        yield pa.RecordBatch.from_pydict({"a": c >> 32, "b": c & 0xFFFFFFFF, "n": n})

    counted = (
        pieces.mapInArrow(count, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    )
    highest = counted.groupBy("b").agg(F.max("n").alias("most"))
    return keep(counted.join(highest, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "link-counts")


@lru_cache
def _digits(ids: int) -> tuple[np.ndarray, np.ndarray]:
    """Every id in decimal, one byte a digit and one place more, and how many digits it has."""
    texts = [str(i) for i in range(ids)]
    width = len(texts[-1])
    padded = np.frombuffer("".join(t.ljust(width + 1) for t in texts).encode(), np.uint8).reshape(ids, width + 1)
    return padded, np.array([len(t) for t in texts])


def group_text(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> bytes:
    """Groups in decimal, ``a1,a2|b1;a3|b2,b3``; ``i`` and ``j`` are the places where they end."""
    if not len(i):
        return b""
    before = np.arange(len(a)), np.arange(len(b))
    # A group's tokens stand together, A's before B's: each comes after its own side's earlier
    # tokens and after the other side's tokens of earlier groups (or, for B, this one's).
    a_group, b_group = np.searchsorted(i, before[0]), np.searchsorted(j, before[1])
    at_a = before[0] + np.concatenate([[0], j + 1])[a_group]
    at_b = before[1] + i[b_group] + 1
    tokens = np.empty(len(a) + len(b), np.int64)
    tokens[at_a], tokens[at_b] = a, b
    after = np.full(len(tokens), ord(","), np.uint8)
    after[at_a[i]], after[at_b[j]] = ord("|"), ord(";")
    digits, lengths = _digits(1 << 16 if not len(tokens) or tokens.max() < 1 << 16 else int(tokens.max()) + 1)
    rows, n = digits[tokens], lengths[tokens]
    rows[np.arange(len(n)), n] = after
    return rows[np.arange(rows.shape[1]) <= n[:, None]].tobytes()[:-1]


def _ids(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<u4")


def _part(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> dict:
    """What a piece of a longer text hands to its neighbours: tokens up to its first shared end,
    its own groups, tokens after its last shared end."""
    if not len(i):
        return {"closed": False, "head_a": a, "head_b": b, "body": b"", "tail_a": a[:0], "tail_b": b[:0]}
    h, t = (i[0] + 1, j[0] + 1), (i[-1] + 1, j[-1] + 1)
    body = group_text(a[h[0] : t[0]], b[h[1] : t[1]], i[1:] - h[0], j[1:] - h[1])
    return {"closed": True, "head_a": a[: h[0]], "head_b": b[: h[1]], "body": body, "tail_a": a[t[0] :], "tail_b": b[t[1] :]}


def stitched(parts: Iterable[dict]) -> bytes:
    """The groups of a text from its pieces in order."""
    out, open_a, open_b = [], [], []
    decimal = lambda arrays: b",".join(b"%d" % t for blob in arrays for t in _ids(blob))
    for part in parts:
        open_a.append(part["head_a"])
        open_b.append(part["head_b"])
        if part["closed"]:
            out.append(decimal(open_a) + b"|" + decimal(open_b))
            if part["body"]:
                out.append(part["body"])
            open_a, open_b = [part["tail_a"]], [part["tail_b"]]
    return b";".join(out)


_RESULT = (
    "row long, doc_id long, piece int, n_a long, n_b long, n_links long, n_best long, count_sum long, digest string,"
    "part struct<piece:int,closed:boolean,head_a:binary,head_b:binary,body:binary,tail_a:binary,tail_b:binary>"
)


def align(
    docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text", piece: int = PIECE
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    pieces = encode_pieces(docs, a_path, b_path, doc_id, text, piece)
    counts = link_counts(pieces, a_path, b_path)
    # Bounded by the two vocabularies, see the module's docstring.
    table = counts.toPandas()
    code = (table["a"].to_numpy(np.int64) << 32) | table["b"].to_numpy(np.int64)
    order = np.argsort(code)
    shared = spark.sparkContext.broadcast((code[order], table["n"].to_numpy(np.int64)[order], table["best"].to_numpy(bool)[order]))
    part_type = pa.struct(
        [("piece", pa.int32()), ("closed", pa.bool_()), *((c, pa.binary()) for c in ("head_a", "head_b", "body", "tail_a", "tail_b"))]
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, numbers, best = shared.value
        for batch in batches:
            n_a, n_b, n_links, n_best, sums, digests, parts = [], [], [], [], [], [], []
            known = zip(batch.column("piece").to_pylist(), batch.column("pieces").to_pylist(), strict=True)
            for (number, of), (a, b, i, j) in zip(known, _merged(batch, a_path, b_path), strict=True):
                at = np.searchsorted(codes, (a[i] << 32) | b[j])
                n_a.append(len(a))
                n_b.append(len(b))
                n_links.append(len(i))
                n_best.append(int(best[at].sum()))
                sums.append(int(numbers[at].sum()))
                if of == 1:
                    digests.append(hashlib.sha256(group_text(a, b, i, j)).hexdigest() if len(a) else "")
                    parts.append(None)
                else:
                    digests.append(None)
                    cut = {k: v.astype("<u4").tobytes() if isinstance(v, np.ndarray) else v for k, v in _part(a, b, i, j).items()}
                    parts.append({"piece": number, **cut})
            longs = [pa.array(x, pa.int64()) for x in (n_a, n_b, n_links, n_best, sums)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("piece"), *longs, pa.array(digests, pa.string()), pa.array(parts, part_type)],
                names=["row", "doc_id", "piece", "n_a", "n_b", "n_links", "n_best", "count_sum", "digest", "part"],
            )

    @F.pandas_udf("string")
    def digest(columns: pd.DataFrame) -> pd.Series:
        """The digest of a text in one piece as it is, that of a longer one from its pieces."""
        return pd.Series(
            [
                hashlib.sha256(stitched(sorted(parts, key=lambda p: p["piece"]))).hexdigest() if done is None else done
                for done, parts in zip(columns["digest"], columns["parts"], strict=True)
            ],
            dtype=object,
        )

    totals = (
        pieces.mapInArrow(measure, _RESULT)
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            *(F.sum(c).alias(c) for c in ("n_a", "n_b", "n_links", "n_best", "count_sum")),
            F.first("digest", ignorenulls=True).alias("digest"),
            # Only pieces of texts that have more than one.
            F.collect_list("part").alias("parts"),
        )
    )
    return totals.select(
        "doc_id", "n_a", "n_b",
        # Every shared end closes one group and links one pair: no token is empty.
        F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum",
        digest(F.struct("digest", "parts")).alias("groups_sha256"),
    )
