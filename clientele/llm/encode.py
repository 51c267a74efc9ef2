"""Token ids of whole texts from a tokenizer file, as one binary value per text.

Byte-level files are encoded by tiktoken (see ``tiktoken_of``).  For a tokenizer of words a text is
cut where no token can reach across, at ASCII white space and between ASCII letters and marks, and
the tokenizers library encodes each different chunk once while a Python worker remembers it.  Texts where such a cut could
change the result (other white space, special tokens) are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from clientele.llm.words import LOWER, NON_SPACE, byte_table, text_buffer

# Chunks in a worker's memory when it becomes the old one: some 50 MB each.
REMEMBERED = 400_000

# How chunks are cut, by the tokenizer's own pre-splitting rule.
#   spaced: a word takes one space before it; all but the last of several blanks go together.
#   words: blanks only separate; capitals are lowered.
CHUNKS = {
    "spaced": re.compile(rb" ?[^ \t-\r]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]"),
    "words": re.compile(rb"[^ \t-\r]+"),
}
# The same rules' pieces within a chunk of ASCII and Latin-1 letters.
_LETTER = rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])"
_OTHER = rb"(?:[^ \t-\r0-9A-Za-z\x80-\xff]|\xc3[\x97\xb7])"
_SHORT = rb"'(?:[stmd]|re|ve|ll)"
PIECES = {
    "spaced": re.compile(
        _SHORT + rb"| ?" + _LETTER + rb"+| ?[0-9]+| ?" + _OTHER + rb"+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]"
    ),
    "words": re.compile(_SHORT + rb"|" + _LETTER + rb"+|[0-9]|" + _OTHER + rb"+"),
}
_PLAIN = re.compile(rb"(?:[\x00-\x1b\x20-\x7f]|\xc3[\x80-\xbf])*")
# The splitting rule of byte-level files.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WHOLE = re.compile(r"<\||[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def byte_characters() -> dict[int, int]:
    """The character that stands for each byte in byte-level vocabularies: itself where it is
    printable, otherwise the next one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: b if b in shown else 256 + hidden.index(b) for b in range(256)}


def tiktoken_of(path: str, special: bool):
    """A byte-level file as a tiktoken encoding, or None where it is not of that kind.

    It gives the ids of the tokenizers library several times as fast.  Ids must follow the
    merges.  With ``special`` the strings of special tokens in texts are their ids.
    """
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    model, before = stored["model"], stored.get("pre_tokenizer") or {}
    affixes = model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")
    if stored.get("normalizer") or affixes or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
        return None
    byte_of = {chr(c): b for b, c in byte_characters().items()}
    added = {t["content"]: t["id"] for t in stored["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in t): n for t, n in model["vocab"].items() if n not in added.values()}
    pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
    made = [model["vocab"][a + b] for a, b in pairs]
    if made != sorted(set(made)) or len(made) + 256 != len(ranks):
        return None
    import tiktoken

    return tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=added if special else {})


class _Whole:
    """Encodes whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.fast = tiktoken_of(path, special=True)
        if self.fast is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(path)
            self.slow.no_truncation()
            self.slow.no_padding()

    def texts(self, texts: pa.Array, dtype: str) -> list[bytes]:
        if self.fast is not None:
            encode = lambda t: self.fast.encode_to_numpy(t, allowed_special="all")
        else:
            encode = lambda t: np.array(self.slow.encode(t, add_special_tokens=False).ids, np.uint32)
        return [encode(t).astype(dtype).tobytes() if t else b"" for t in texts.to_pylist()]


_LETTERS = byte_table(bytes(range(0x61, 0x7B)))
_MARKS = byte_table(bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b != 0x27))
_NOTHING = np.zeros(0, np.uint32), np.zeros(1, np.int64)


class _Words:
    """Encodes each different chunk between blanks once while it is remembered.

    The ids of all chunks stand in one array; a chunk's number leads to its place in it.  When
    the memory is full it becomes the old one, which is asked before a chunk is encoded anew.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.shown = byte_characters()
        self.old, self.now = ({}, *_NOTHING), ({}, *_NOTHING)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _new(self, chunk: bytes) -> list[int]:
        known, ids, first = self.old
        at = known.get(chunk)
        if at is not None:
            return ids[first[at] : first[at + 1]].tolist()
        if _PLAIN.fullmatch(chunk):
            # The library's merges on the pieces, without the steps around them.
            pieces = PIECES["words"].findall(chunk.decode().lower().encode())
            return [t.id for p in pieces for t in self.model.tokenize(p.decode("latin-1").translate(self.shown))]
        return self.whole(chunk.decode())

    def _numbers(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number of each chunk, and the ids of all numbers with where each's begin."""
        if len(self.now[0]) > REMEMBERED:
            self.old, self.now = self.now, ({}, *_NOTHING)
        known, ids, first = self.now
        numbers, new, lengths = [known.get(c, -1) for c in chunks], [], []
        for k, number in enumerate(numbers):
            if number < 0:
                found = self._new(chunks[k])
                new += found
                lengths.append(len(found))
                numbers[k] = known[chunks[k]] = len(known)
        if lengths:
            ids = np.concatenate([ids, np.array(new, np.uint32)])
            first = np.concatenate([first, first[-1] + np.cumsum(lengths)])
            self.now = known, ids, first
        return np.array(numbers, np.int64), ids, first

    def texts(self, texts: pa.Array, dtype: str) -> list[bytes]:
        plain = texts.to_pylist()
        whole = {k: self.whole(t) for k, t in enumerate(plain) if t and _WHOLE.search(t)}
        if whole:
            texts = pa.array([None if k in whole else t for k, t in enumerate(plain)], pa.large_string())
        data, ends = text_buffer(pc.fill_null(texts, ""))
        data = LOWER[data]  # as the tokenizer's own first step does
        inside = NON_SPACE[data]
        at_start = np.zeros(len(data) + 1, bool)
        at_start[ends[:-1]] = True
        letter, mark = _LETTERS[data], _MARKS[data]
        # Between an ASCII letter and a mark a piece always ends, so that words are the same with
        # and without marks at their sides.  (Apostrophes may belong to a word.)
        parted = np.concatenate([[False], (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])])
        starts = np.append(inside & (~np.concatenate([[False], inside[:-1]]) | parted | at_start[:-1]), True)
        begin = np.flatnonzero(starts[:-1])
        end = np.flatnonzero(inside & (starts[1:] | np.concatenate([~inside[1:], [True]]))) + 1
        offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
        chunks = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside]))]
        ).dictionary_encode()
        numbers, known, first = self._numbers(chunks.dictionary.to_pylist())
        number = numbers[chunks.indices.to_numpy(zero_copy_only=False)]
        count = first[number + 1] - first[number]
        so_far = np.concatenate([[0], np.cumsum(count)])
        ids = known[np.arange(so_far[-1]) + np.repeat(first[number] - so_far[:-1], count)].astype(dtype)
        bounds = so_far[np.searchsorted(begin, ends)]
        out = [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for k, found in whole.items():
            out[k] = np.array(found, dtype).tobytes()
        return out


@lru_cache
def _encoder(path: str, chunks: str) -> _Whole | _Words:
    return _Words(path) if chunks == "words" else _Whole(path)


def encode_texts(texts: Iterable, path: str, chunks: str, dtype: str = "<u4") -> list[bytes]:
    """Little-endian ids of each text; a missing text counts as empty."""
    texts = [t if isinstance(t, str) else None for t in texts]
    return _encoder(path, chunks).texts(pa.array(texts, pa.large_string()), dtype)


def token_ids(text: Column, path: str, chunks: str, dtype: str = "<u4") -> Column:
    """The ids of ``text`` as little-endian unsigned integers; NULL gives no ids."""

    @F.arrow_udf("binary")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(path, chunks)
        for texts in batches:
            yield pa.array(encoder.texts(texts, dtype), pa.binary())

    return ids(text)
