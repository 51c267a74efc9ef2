"""Collocations: frequent phrases per language, from FM-indexes over word ids.

Tasks cut their texts into shards of a bounded number of words and index each: the
Burrows-Wheeler transform of its word ids and that of the reversed ids.  A phrase is an interval
of rows in either.  Extending a phrase by a word on the left is a step in the one index, on the
right in the other, and the interval in the other index follows by counting smaller words, so
phrases grow on both sides.  All intervals of a shard are extended at once with a few array
operations.  The transforms order suffixes by their first words only, as many as a phrase may
have and more; longer agreement never moves the border of an interval.

A shard extends only what can be frequent: all phrases inside a phrase must be.  Words are counted
first, then pairs of frequent words, then longer phrases of frequent pairs.  In these rounds tasks
add up their shards' counts by hash value and send them packed; values that reach the least
count over all shards are known to the tasks as a bit each, in a filter of bounded size.  A hash
value shared by chance, or a bit, only lets a phrase pass; none that is frequent is
lost.  The last round counts what passes by its text over all shards, which is exact.

A phrase is part of a longer one with as many occurrences exactly if it is part of one that is a
word longer, so only these are compared.

Defined results: NULL texts have no words, a NULL language is ``und``.  Phrases do not cross piece
borders, texts or languages.  Equal scores are ranked by count, then by the phrase's bytes.
Repeated rows count as often as they come.  An empty table gives no rows.  Very long texts are
cut into shards at piece borders.  Columns beside text and language are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import forget, keep, partitions, release, small_batches
from clientele.llm.words import LOWER, byte_table, mix, text_buffer
from clientele.operators.hot import spread_join
from clientele.operators.pick import first_n_per_key
from clientele.sources import tables

SHARD_WORDS = 1 << 18
LONGEST = 5
# A filter has at least 32 bits for each phrase in it while it is below its greatest size.
BITS_EACH, LEAST_BITS, MOST_BITS = 32, 1 << 20, 1 << 28
GROUP_ROWS = 4  # shards in a row group of their table
HASH_BITS = 44
PARTS = 16  # most ranges of hash values for each shuffle partition
RANGE_WORDS = 1 << 20
HELD = 1 << 21  # hash values a task holds before it sends or adds them up
_BREAKS = byte_table(b".,;:!?\x0a\x0b\x0c\x0d")
_BLANKS = byte_table(b" \t")
_U = np.uint64
_FACTOR = _U(0x9E3779B97F4A7C15)


# ---- shards ---------------------------------------------------------------------------


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of a batch of texts, the number of the text each is from, and whether a piece ends
    behind it."""
    data, ends = text_buffer(texts)
    data = LOWER[data]
    inside = ~(_BREAKS | _BLANKS)[data]
    text_start = np.zeros(len(data) + 1, bool)
    text_start[ends[:-1]] = True
    before = np.concatenate([[False], inside[:-1]]) & ~text_start[:-1]
    start = np.flatnonzero(inside & ~before)
    after = np.concatenate([inside[1:], [False]]) & ~text_start[1:]
    end = np.flatnonzero(inside & ~after) + 1
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside]))]
    )
    text = np.searchsorted(ends, start, "right") - 1
    # Breaks and starts of texts before each place; a piece ends where two words differ in them.
    passed = np.cumsum(_BREAKS[data] | text_start[:-1])
    broken = np.ones(len(start), bool)
    broken[:-1] = passed[start[1:]] != passed[start[:-1]]
    return words, text, broken


def suffix_rows(ids: np.ndarray, words: int) -> np.ndarray:
    """Positions of all suffixes, ordered by at least their first ``words`` ids."""
    rank, depth = ids.astype(np.int64), 1
    while True:
        following = np.concatenate([rank[depth:], rank[:depth]])
        key = rank * (int(rank.max()) + 1) + following
        order = np.argsort(key)
        in_order = key[order]
        new = np.concatenate([[0], np.cumsum(in_order[1:] != in_order[:-1])])
        depth *= 2
        if depth >= words or new[-1] == len(ids) - 1:
            return order
        rank = np.empty(len(ids), np.int64)
        rank[order] = new


def transform(ids: np.ndarray) -> np.ndarray:
    """The id before each suffix, in the order of the suffixes; deep enough for LONGEST words."""
    return ids[suffix_rows(ids, LONGEST + 1) - 1]


def _shard(words: pa.ChunkedArray, lang: np.ndarray, broken: np.ndarray, langs: list[str]) -> pa.RecordBatch:
    """One indexed shard: its languages with their numbers of words, its dictionary with each
    word's language and count, and both transforms.  Id 0 is the border between pieces."""
    coded = words.combine_chunks().dictionary_encode()
    pair = lang.astype(np.int64) * len(coded.dictionary) + coded.indices.to_numpy(zero_copy_only=False)
    known, ids = np.unique(pair, return_inverse=True)
    # A border behind every piece, and one before the first.
    at = np.arange(1, len(ids) + 1) + np.concatenate([[0], np.cumsum(broken)[:-1]])
    sequence = np.zeros(len(ids) + int(broken.sum()) + 1, np.int32)
    sequence[at] = ids + 1
    word_lang = known // len(coded.dictionary)
    texts = coded.dictionary.take(pa.array(known % len(coded.dictionary))).cast(pa.binary())
    present, of_lang = np.unique(lang, return_counts=True)
    return pa.RecordBatch.from_pydict(
        {
            "langs": [[langs[k] for k in present]],
            "lang_words": [of_lang],
            "words": [texts.cast(pa.string())],
            "word_lang": [np.searchsorted(present, word_lang).astype(np.int32)],
            "counts": [np.bincount(ids, minlength=len(known))],
            "left": [transform(sequence).tobytes()],
            "right": [transform(np.ascontiguousarray(sequence[::-1])).tobytes()],
        },
        schema=_SHARD,
    )


_SHARD = pa.schema(
    [
        ("langs", pa.list_(pa.string())), ("lang_words", pa.list_(pa.int64())), ("words", pa.list_(pa.string())),
        ("word_lang", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64())), ("left", pa.binary()), ("right", pa.binary()),
    ]
)
_SHARD_SQL = (
    "langs array<string>, lang_words array<bigint>, words array<string>, word_lang array<int>, counts array<bigint>,"
    "left binary, right binary"
)


def _cut(broken: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Spans of about ``size`` words that end with a piece; the last may be shorter."""
    stops, at = np.flatnonzero(broken) + 1, 0
    while at < len(broken):
        k = min(np.searchsorted(stops, at + size), len(stops) - 1)
        yield at, int(stops[k])
        at = int(stops[k])


def index_shards(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = SHARD_WORDS) -> DataFrame:
    """All texts as a kept table of indexed shards."""
    spark = docs.sparkSession
    small_batches(spark)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        langs: dict[str, int] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            if waiting:
                words = pa.chunked_array([w for w, _, _ in waiting])
                of, broken = (np.concatenate([x[k] for x in waiting]) for k in (1, 2))
                names = list(langs)
                # Equal shares of about ``size`` words.
                for a, b in _cut(broken, -(-len(broken) // max(1, len(broken) // size))):
                    yield _shard(words.slice(a, b - a), of[a:b], broken[a:b], names)
                waiting.clear()
                langs.clear()

        for batch in batches:
            words, of_text, broken = _tokens(batch.column("text"))
            if len(words):
                numbers = np.array([langs.setdefault(name, len(langs)) for name in batch.column("lang").to_pylist()])
                waiting.append((words, numbers[of_text], broken))
            if sum(len(w) for w, _, _ in waiting) >= size:
                yield from flush()
        yield from flush()

    shards = docs.select(
        F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang), F.lit("und")).alias("lang")
    ).mapInArrow(index, _SHARD_SQL)
    path = tables.new_table_path(spark, "phrase-shards")
    # A shard is a row of some megabytes, and a row group is held whole by who writes or reads it.
    shards.write.option("parquet.block.row.count.limit", GROUP_ROWS).option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


# ---- filters --------------------------------------------------------------------------


class Filter:
    """A bit for each hash value of some phrases."""

    def __init__(self, bits: int, rows: list):
        self.mask = _U(bits - 1)
        self.bytes = np.zeros(bits // 8, np.uint8)
        for bucket, bitmap in rows:
            part = np.frombuffer(bitmap, np.uint8)
            at = (bucket - 1) * 4096
            self.bytes[at : at + len(part)] = part[: len(self.bytes) - at]

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.mask
        return (self.bytes[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1 == 1


def make_filter(frequent: DataFrame) -> Filter:
    """The filter of the phrases in ``frequent`` by their hash column; built by Spark's bitmaps, of
    which the driver takes at most MOST_BITS."""
    wanted = max(1, frequent.count()) * BITS_EACH
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (wanted - 1).bit_length()))
    # Bits are numbered from 1 in buckets of 32768.
    place = F.col("hash").bitwiseAND(bits - 1) + 1
    built = frequent.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    return Filter(bits, [(r.bucket, bytes(r.bits)) for r in built.collect()])


def word_hashes(words: pa.Array, langs: list[str], word_lang: np.ndarray) -> np.ndarray:
    """Hashes of words with their language, the same in every shard."""
    of = lambda texts: pd.util.hash_array(np.array(texts, dtype=object), categorize=False)
    return mix(of(words.to_pylist()) + of(langs)[word_lang] * _FACTOR)


def phrase_hashes(of_words: np.ndarray, phrases: np.ndarray) -> np.ndarray:
    """Hashes of phrases, one a row of word ids."""
    total = np.zeros(len(phrases), np.uint64)
    for column in phrases.T:
        total = total * _FACTOR + of_words[column]
    return mix(total) >> _U(64 - HASH_BITS)


# ---- extension ------------------------------------------------------------------------


class Direction:
    """One transform, and the row each of its rows steps to when its id is put in front."""

    def __init__(self, blob):
        self.ids = np.frombuffer(blob, np.int32)
        order = np.argsort(self.ids, kind="stable")
        self.step = np.empty(len(order), np.int64)
        self.step[order] = np.arange(len(order))
        self.first = self.ids[order]


def extend(
    index: Direction, low: np.ndarray, size: np.ndarray, other_low: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All extensions of disjoint intervals by an id in front, in one index.

    Returns which interval was extended, by which id, and the new interval: its place in this
    index, its size and its place in the other index.
    """
    n = len(index.ids)
    owner = np.full(n, -1, np.int64)
    begin = np.cumsum(size) - size
    rows = np.arange(size.sum()) + np.repeat(low - begin, size)
    owner[index.step[rows]] = np.repeat(np.arange(len(low)), size)
    # Rows stepped to from one interval by one id stand together.
    change = np.concatenate([[True], (owner[1:] != owner[:-1]) | (index.first[1:] != index.first[:-1])])
    start = np.flatnonzero(change)
    length = np.diff(np.concatenate([start, [n]]))
    met = owner[start] >= 0
    start, length = start[met], length[met]
    of, by = owner[start], index.first[start]
    # In the other index an interval is divided by the new id, smaller ids (borders too) first.
    order = np.argsort(of, kind="stable")
    so_far = np.cumsum(length[order]) - length[order]
    base = np.empty(len(low), np.int64)
    heads = np.concatenate([[True], of[order][1:] != of[order][:-1]]) if len(order) else np.zeros(0, bool)
    base[of[order][heads]] = so_far[heads]
    place = np.empty(len(order), np.int64)
    place[order] = so_far - base[of[order]]
    word = by > 0
    return of[word], by[word], start[word], length[word], (other_low[of] + place)[word]


class Shard:
    """One shard, read for the enumeration of its phrases."""

    def __init__(self, row: dict):
        self.langs, self.words = row["langs"].as_py(), row["words"].values
        self.word_lang, self.counts = (row[c].values.to_numpy() for c in ("word_lang", "counts"))
        self.hashes = np.concatenate([np.zeros(1, np.uint64), word_hashes(self.words, self.langs, self.word_lang)])
        self.transforms = [row.get("left"), row.get("right")]

    def phrases(self, known: dict[int, Filter], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Phrases of up to ``longest`` words that can be frequent, by length, one phrase a row
        of word ids, with their numbers.

        ``known`` has the filters of frequent phrases by length.  Phrases grow on the left and on
        the right in turn.
        """
        phrases, size = np.arange(1, len(self.words) + 1)[:, None], self.counts
        # Ids are numbered in order, so a word's rows follow those of all smaller ids.
        low = [None, None]
        index: list[Direction | None] = [None, None]
        for k in range(1, longest + 1):
            if k in known:
                keep_ = known[k](phrase_hashes(self.hashes, phrases))
                phrases, size, low = phrases[keep_], size[keep_], [x if x is None else x[keep_] for x in low]
            yield k, phrases, size
            if k == longest:
                return
            side = (k - 1) % 2
            if index[side] is None:
                index[side] = Direction(self.transforms[side].as_buffer())
                if k == 1:
                    start = len(index[0].ids) - self.counts.sum() + np.cumsum(self.counts) - self.counts
                    low = [start[phrases[:, 0] - 1]] * 2
            of, by, here, size, there = extend(index[side], low[side], size, low[1 - side])
            low = [here, there] if side == 0 else [there, here]
            pair = (by[:, None], phrases[of])
            phrases = np.concatenate(pair if side == 0 else pair[::-1], axis=1)
            # The phrase without its other end must be frequent too; where frequent phrases of
            # this length are not known yet, at least the new pair of words.
            width = k if k in known else max((w for w in known if w <= k), default=0)
            if width:
                beside = phrases[:, :width] if side == 0 else phrases[:, -width:]
                keep_ = known[width](phrase_hashes(self.hashes, beside))
                phrases, size, low = phrases[keep_], size[keep_], [x[keep_] for x in low]

    def texts(self, phrases: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
        parts = [self.words.take(pa.array(column - 1)) for column in phrases.T]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.langs, pa.string()).take(pa.array(self.word_lang[phrases[:, 0] - 1])),
                pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0],
                pa.array(size, pa.int64()),
                pa.array(phrase_hashes(self.hashes, phrases).view(np.int64)),
            ],
            names=["lang", "phrase", "n", "hash"],
        )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield Shard({c: batch.column(c)[k] for c in batch.schema.names})


_DICTIONARY = ["langs", "words", "word_lang", "counts"]


def counted_texts(shards: DataFrame, known: dict[int, Filter], lengths: range, least: int) -> DataFrame:
    """Phrases of some lengths that occur ``least`` times or more, by text, exactly."""
    sent = shards.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _read(batches):
            for k, phrases, size in shard.phrases(sent.value, lengths[-1]):
                if k in lengths:
                    yield shard.texts(phrases, size)

    columns = _DICTIONARY if lengths[-1] == 1 else shards.columns
    counted = shards.select(*columns).mapInArrow(count, "lang string, phrase string, n long, hash long")
    summed = counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"), F.min("hash").alias("hash"))
    found = keep(summed.filter(F.col("n") >= least), "phrases")
    sent.unpersist()
    return found


# ---- counts of hash values ------------------------------------------------------------


def _summed(values: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Values in order, each once, with its counts added up."""
    v, n = np.concatenate(values), np.concatenate(counts)
    order = np.argsort(v, kind="stable")
    v, n = v[order], n[order]
    start = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.zeros(0, np.int64)
    return v[start], np.add.reduceat(n, start) if len(start) else n


def packed(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Ordered values and their counts as differences, byte by byte, which compresses well."""
    gaps = np.diff(values, prepend=_U(0)).astype("<u8")
    planes = [x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for x in (gaps, counts)]
    return planes[0] + planes[1]


def unpacked(blob) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(blob, np.uint8).reshape(2, 8, -1)
    gaps, counts = (np.ascontiguousarray(p.T).view("<u8").ravel() for p in planes)
    return np.cumsum(gaps, dtype=np.uint64), counts.astype(np.int64)


def counted_hashes(
    shards: DataFrame, known: dict[int, Filter], lengths: range, least: int, words: int
) -> DataFrame:
    """Hash values of phrases of some lengths that occur ``least`` times or more, kept as rows
    (length, hash).  Phrases with one hash value count together, so no frequent one is missing.

    A task adds up its shards' counts and sends them in blocks of a range of values.  A range has
    about RANGE_WORDS of the corpus's ``words``; there are up to PARTS for each shuffle partition.
    """
    spark = shards.sparkSession
    n = partitions(spark)
    part_bits = (min(n * PARTS, -(-words // RANGE_WORDS)) - 1).bit_length() if words else 0
    shift = _U(HASH_BITS - part_bits)
    sent = spark.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def send() -> Iterator[pa.RecordBatch]:
            for k, pairs in held.items():
                values, counts = _summed([v for v, _ in pairs], [c for _, c in pairs])
                part = (values >> shift).astype(np.int64)
                start = np.flatnonzero(np.diff(part, prepend=-1))
                stop = np.append(start[1:], len(part))
                blobs = [packed(values[a:b], counts[a:b]) for a, b in zip(start, stop, strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "length": pa.array(np.full(len(start), k), pa.int32()),
                        "part": pa.array(part[start], pa.int32()),
                        "block": pa.array(blobs, pa.binary()),
                    }
                )
            held.clear()

        for shard in _read(batches):
            for k, phrases, size in shard.phrases(sent.value, lengths[-1]):
                if k in lengths and len(phrases):
                    held.setdefault(k, []).append((phrase_hashes(shard.hashes, phrases), size))
            if sum(len(v) for pairs in held.values() for v, _ in pairs) > HELD:
                yield from send()
        yield from send()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks come in order of length and range."""
        at, values, counts = None, [], []

        def frequent() -> Iterator[pa.RecordBatch]:
            if at is not None:
                v, c = _summed(values, counts)
                hit = v[c >= least].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), at[0]), pa.int32()), pa.array(hit)], names=["length", "hash"])

        for batch in batches:
            keys = zip(batch.column("length").to_pylist(), batch.column("part").to_pylist(), strict=True)
            for key, block in zip(keys, batch.column("block"), strict=True):
                if key != at:
                    yield from frequent()
                    at, values, counts = key, [], []
                v, c = unpacked(block.as_buffer())
                values.append(v)
                counts.append(c)
                if sum(map(len, values)) > 2 * len(values[0]) + HELD:
                    v, c = _summed(values, counts)
                    values, counts = [v], [c]
        yield from frequent()

    blocks = shards.mapInArrow(count, "length int, part int, block binary")
    dealt = blocks.repartition(n, "length", "part").sortWithinPartitions("length", "part")
    found = keep(dealt.mapInArrow(add, "length int, hash long"), "phrase-hashes")
    sent.unpersist()
    return found


# ---- scores ---------------------------------------------------------------------------


def _words(from_: Column | int, count: Column | int) -> Column:
    return F.array_join(F.slice("words", from_, count), " ")


def score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (left right)) in whole numbers of up to 38 digits."""
    big = lambda c: c.cast("decimal(19,0)")
    over = (big(a) * big(n)).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    return F.call_function("div", over, (big(left) * big(right)).cast("decimal(38,0)"))


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = 100,
    best: int = 2000,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The ``best`` phrases of two to LONGEST words per language: lang, rank, phrase, a, l, r, n, score."""
    shards = index_shards(docs, text, lang, shard_words)
    words = counted_texts(shards, {}, range(1, 2), least)
    known = {1: make_filter(words)}
    made = [shards, words]
    # Pairs first; longer phrases are few enough then to be counted together.
    total = shards.agg(F.sum(F.aggregate("lang_words", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    for lengths in (range(2, 3), range(3, LONGEST + 1)):
        hashes = counted_hashes(shards, known, lengths, least, total)
        made.append(hashes)
        known |= {k: make_filter(hashes.filter(F.col("length") == k)) for k in lengths}
        release(docs.sparkSession)
    longer = counted_texts(shards, known, range(2, LONGEST + 1), least)
    made.append(longer)
    per_lang = (
        shards.select(F.explode(F.arrays_zip("langs", "lang_words")).alias("x"))
        .groupBy(F.col("x.langs").alias("lang"))
        .agg(F.sum("x.lang_words").alias("n_lang"))
    )
    result = keep(best_phrases(words, longer, per_lang, best), "collocations")
    forget(made)
    return result


def best_phrases(words: DataFrame, longer: DataFrame, per_lang: DataFrame, best: int) -> DataFrame:
    """Rank the frequent phrases of more than one word; ``words`` has the frequent words."""
    listed = words.unionByName(longer).select("lang", "phrase", "n")
    longer = longer.select("lang", "phrase", "n", F.split("phrase", " ").alias("words"))
    size = F.size("words")
    inside = (
        longer.filter(size > 2)
        .select("lang", F.explode(F.array(_words(1, size - 1), _words(2, size - 1))).alias("phrase"), "n")
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("_longer"))
    )
    candidates = (
        longer.join(inside, ["lang", "phrase"], "left")
        .filter(F.col("_longer").isNull() | (F.col("_longer") < F.col("n")))
        .withColumnRenamed("n", "a")
    )
    cuts = candidates.select(
        "lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    ).select("lang", "phrase", "a", "k", _words(1, F.col("k")).alias("first"), _words(F.col("k") + 1, size - F.col("k")).alias("rest"))
    # A usual word may begin or end a large part of all phrases.
    heads = listed.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    tails = listed.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    counted = spread_join(spread_join(cuts, heads, ["lang", "first"], "inner"), tails, ["lang", "rest"], "inner")
    # One row per language on the other side.
    counted = spread_join(counted, per_lang, "lang", "inner")
    scored = counted.withColumn("score", score(F.col("a"), F.col("n_lang"), F.col("l"), F.col("r")))
    lowest = scored.groupBy("lang", "phrase", "a", F.col("n_lang").alias("n")).agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    flat = lowest.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    top = first_n_per_key(flat, "lang", order, best, "rank")
    return top.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
