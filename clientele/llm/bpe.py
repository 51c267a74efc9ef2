"""Byte-level BPE by per-prefix dynamic programming, and its inverse.

The encoding of every prefix of a piece of text has one last token.  It is the one token that
ends there and is compatible with the last token of the prefix before it: the merges, taken
in the order of their ranks, never join across that boundary.  So one pass over a piece, with
all vocabulary matches that end at each byte, stores the last token of every prefix; the
tokens are read off by following the matches back.

Whether two tokens may stand side by side is decided without text.  Both are undone merge by
merge, the later one first, looking at the two parts that touch the boundary.  If these parts
have a merge of their own that comes before the merge just undone, the boundary would have
been crossed.

Texts are first cut into the pieces of the tokenizer's splitting rule.  Pieces are the same
in many texts: a worker remembers a bounded number of those it has encoded.

Defined results: a NULL or empty text has no ids.  Special tokens written out in a text are
their own ids, as the tokenizers library has it.  Decoding puts U+FFFD where bytes are not
UTF-8.  Repeated rows are encoded alike, an empty table gives none, and other columns stay.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from clientele.llm.encode import _PLAIN, _WHOLE, CHUNKS, PIECES, byte_characters

# Chunks remembered by a worker; the memory is emptied when it is full.
REMEMBERED = 600_000
PAIRS_REMEMBERED = 2_000_000
# The splitting rule of byte-level vocabularies, for texts beyond Latin-1.
_SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


class Vocabulary:
    """Tokens, merges and the automaton of one tokenizer file."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        model = stored["model"]
        if stored.get("normalizer") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
            raise ValueError("only byte-level vocabularies without normalizer are known here")
        byte_of = {chr(c): b for b, c in byte_characters().items()}
        as_bytes = lambda token: bytes(byte_of[c] for c in token)
        size = 1 + max([*model["vocab"].values(), *(t["id"] for t in stored["added_tokens"])])
        self.bytes_of: list[bytes] = [b""] * size
        self.special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        for content, number in self.special.items():
            self.bytes_of[number] = content.encode()
        self.matches = ahocorasick.Automaton()
        for token, number in model["vocab"].items():
            if number in self.special.values():
                continue
            self.bytes_of[number] = as_bytes(token)
            # The automaton reads text; one character stands for one byte.
            self.matches.add_word(self.bytes_of[number].decode("latin-1"), (number, len(self.bytes_of[number])))
        self.matches.make_automaton()
        # How each token is made: the rank of its merge and the two tokens merged.
        self.made: dict[int, tuple[int, int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, whole = model["vocab"][left], model["vocab"][right], model["vocab"][left + right]
            if whole in self.made:
                raise ValueError(f"two merges make the token {left + right!r}")
            self.made[whole] = (rank, a, b)
            self.merged[a, b] = rank
        self.fits: dict[tuple[int, int], bool] = {}
        self.known: dict[bytes, bytes] = {}
        self.split = regex.compile(_SPLIT).findall
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave the boundary between two tokens alone."""
        key = (left, right)
        known = self.fits.get(key)
        if known is not None:
            return known
        answer, bound, same_counts = True, None, False
        while True:
            # ``bound`` is the rank of the merge undone last; the touching parts were there
            # until just before it.  A merge across the boundary with a smaller rank came first;
            # of one rule applied twice the place further left comes first, which is the
            # boundary if the merge undone was on its right.
            across = self.merged.get((left, right))
            if across is not None and (bound is None or across < bound or (across == bound and same_counts)):
                answer = False
                break
            a, b = self.made.get(left), self.made.get(right)
            if a is None and b is None:
                break
            if b is None or (a is not None and a[0] > b[0]):
                bound, same_counts, left = a[0], False, a[2]
            else:
                bound, same_counts, right = b[0], True, b[1]
        if len(self.fits) >= PAIRS_REMEMBERED:
            self.fits.clear()
        self.fits[key] = answer
        return answer

    def piece(self, piece: bytes) -> list[int]:
        """The tokens of a piece."""
        last: list[tuple[int, int] | None] = [None] * (len(piece) + 1)
        compatible, done = self.compatible, -1
        # All matches, by where they end, the longest first.
        for end, (token, length) in self.matches.iter(piece.decode("latin-1")):
            if end == done:
                continue
            start = end + 1 - length
            if start == 0 or compatible(last[start][0], token):
                last[end + 1] = (token, start)
                done = end
        out, at = [], len(piece)
        while at:
            token, at = last[at]
            out.append(token)
        out.reverse()
        return out

    def _ids(self, pieces: Iterable[bytes]) -> bytes:
        return np.array([t for p in pieces for t in self.piece(p)], "<u4").tobytes()

    def chunk(self, chunk: bytes) -> bytes:
        """The ids of a chunk without white space inside, remembered."""
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if _PLAIN.fullmatch(chunk):
            ids = self._ids(PIECES["spaced"].findall(chunk))
        else:
            ids = self._ids(p.encode() for p in self.split(chunk.decode()))
        self.known[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a text."""
        if not _WHOLE.search(text):
            known = self.known
            return b"".join(
                [known[c] if c in known else self.chunk(c) for c in CHUNKS["spaced"].findall(text.encode())]
            )
        out = []
        for part in self.at_special(text) if self.at_special else [text]:
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            else:
                out.append(self._ids(p.encode() for p in self.split(part)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join([self.bytes_of[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode(errors="replace")


@lru_cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(text: Column, path: str) -> Column:
    """Ids of ``text`` as little-endian unsigned 32-bit integers."""

    @F.pandas_udf("binary")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = vocabulary(path)
        for texts in batches:
            yield texts.map(lambda t: words.encode(t) if isinstance(t, str) else b"")

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """The text of little-endian unsigned 32-bit ids."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = vocabulary(path)
        for blobs in batches:
            yield blobs.map(lambda b: words.decode(b) if b is not None else None)

    return text(ids)
