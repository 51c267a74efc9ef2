"""Near-duplicate documents by a MinHash LSH forest.

Each document is a set of word shingles.  Documents with equal sets are one class from the
start.  A class has one MinHash signature, cut into trees of DEPTH values each; sorting the
classes by a tree's values puts likely duplicates side by side, and those that share a prefix
of the sorted order are candidates.  The depth of the prefix is chosen per region: two values
where a region is sparse, all of the tree's where it is crowded; a region that is still
crowded at full depth is dealt out in pairs of blocks, so that none of its pairs is dropped.

Within a region, neighbours by longest common prefix are compared first, then whatever is not
yet connected, by the whole signatures; only a spanning set of candidate links leaves a task.
The candidate links' components are families.  Texts of families with two classes or more
are brought together, large families in pairs of blocks, and every link is confirmed on the
full sets; pairs already connected in the task need no test.  The confirmed links' components
are the result.

A pair of the threshold similarity 0.8 shares a prefix in at least one of 20 trees with
probability 1 - 3e-5 at full depth and 1 - 2e-9 at depth two.

Defined results: a text without words, or NULL, has an empty set and is linked with nothing.
A text with fewer words than a shingle is one shingle of all its words.  Repeated rows are
classes of equal sets.  A NULL id takes part but is smaller than none: a component of NULL
ids alone has no component_id.
An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import keep, small_batches
from clientele.llm.filters import may_be_in
from clientele.llm.graph import components
from clientele.llm.words import NON_SPACE, mix, shingle_hashes, words_of

LAST = 2**63 - 1  # in place of a NULL id
SHINGLE = 5
PERCENT = 80
TREES = 20
DEPTH = 4
SHALLOW = 2
# Signatures that agree in this share of values make a candidate: 4.5 standard deviations
# below what a pair at the threshold shows.
AGREEING = 0.6
# Classes in a region above which it is cut deeper, and at full depth into blocks.
CROWDED = 2_048
# Shingles of a family that one block holds.
BLOCK = 1_000_000


# ---- sets and signatures ----------------------------------------------------------------


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and their offsets."""
    words = words_of(texts, NON_SPACE)
    every = shingle_hashes(words.hash, size)
    sets = []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= size:
            sets.append(np.unique(every[a : b - size + 1]))
        elif b > a:
            # All words as one shingle; padded with zeros, which no long text's shingle equals
            # but by chance of 2^-64.
            short = np.zeros(size, np.uint64)
            short[: b - a] = words.hash[a:b]
            sets.append(shingle_hashes(short, size))
        else:
            sets.append(every[:0])
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else every[:0]), offsets


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(20_240_601).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def min_hashes(flat: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """``n`` 32-bit MinHash values of each set; empty sets get the largest value."""
    out = np.full((len(offsets) - 1, n), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        starts = offsets[:-1][some]
        for k, factor in enumerate(_multipliers(n)):
            # The high half of a product with a random odd number; the low bits are folded in
            # first, since they reach the high half only from below.
            least = np.minimum.reduceat((flat ^ (flat >> np.uint64(31))) * factor, starts)
            out[some, k] = (least >> np.uint64(32)).astype(np.uint32)
    return out


def _set_key(flat: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """A 128-bit key for each set, equal for equal sets."""
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        s = flat[a:b]
        one = mix(np.array([s.sum(dtype=np.uint64), np.bitwise_xor.reduce(s) if b > a else np.uint64(0)], np.uint64))
        two = mix(np.array([mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64))
        out.append((one[:1] ^ (one[1:] << np.uint64(1))).tobytes() + two.tobytes())
    return out


def sign(docs: DataFrame, shingle: int, doc_id: str, text: str) -> DataFrame:
    """Each row's doc_id, text_hash, set key, set size and signature."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = shingle_sets(batch.column(2), shingle)
            values = min_hashes(flat, offsets, TREES * DEPTH)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(_set_key(flat, offsets), pa.binary()),
                    pa.array(np.diff(offsets)),
                    pa.array([row.tobytes() for row in values], pa.binary()),
                    # One byte of each value is enough to compare signatures: unequal values
                    # agree by chance in one of 256.
                    pa.array([row.tobytes() for row in values.astype(np.uint8)], pa.binary()),
                ],
                names=["doc_id", "text_hash", "set_key", "n_shingles", "signature", "sketch"],
            )

    small_batches(docs.sparkSession)
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")
    ).mapInArrow(signed, "doc_id long, text_hash long, set_key binary, n_shingles long, signature binary, sketch binary")


# ---- candidates -----------------------------------------------------------------------


class _Joined:
    """Union-find over the rows a task holds."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)

    def roots(self, a: int, b: int) -> np.ndarray:
        return np.array([self.root(i) for i in range(a, b)])

    def spanning(self, keys: np.ndarray) -> pd.DataFrame:
        """One link per row that is not its tree's root."""
        pairs = [(keys[i], keys[r]) for i in range(len(keys)) if (r := self.root(i)) != i]
        return pd.DataFrame(pairs, columns=["p", "q"])


def _whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Sorted batches cut anew, so that each holds whole groups; with the groups' bounds."""
    held: list[pd.DataFrame] = []

    def bounds(frame: pd.DataFrame) -> np.ndarray:
        new = np.zeros(len(frame), bool)
        new[:1] = True
        for k in keys:
            values = frame[k].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.append(np.flatnonzero(new), len(frame))

    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        if len(held) > 1 and all((held[0][k].iloc[0] == batch[k].iloc[-1]) for k in keys):
            continue  # still the group that was begun
        frame = pd.concat(held, ignore_index=True)
        at = bounds(frame)
        done = at[-2]
        held = [frame.iloc[done:].reset_index(drop=True)]
        if done:
            yield frame.iloc[:done], at[:-1]
    if held:
        frame = pd.concat(held, ignore_index=True)
        yield frame, bounds(frame)


def _agreeing(region: DataFrame) -> DataFrame:
    """Candidate links within regions of rows sorted by region and prefix values."""
    least = int(np.ceil(AGREEING * TREES * DEPTH))

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, at in _whole_groups(batches, ["region", "pair"]):
            if len(at) > len(frame):
                continue  # regions of one class each
            sketch = np.frombuffer(b"".join(frame["sketch"]), np.uint8).reshape(len(frame), -1)
            joined = _Joined(len(frame))
            first = np.zeros(len(frame), bool)
            first[at[:-1]] = True
            # Neighbours in sorted order have the longest common prefixes.
            inner = np.flatnonzero(~first)
            near = inner[(sketch[inner] == sketch[inner - 1]).sum(axis=1) >= least]
            for i in near:
                joined.join(i, i - 1)
            for g in np.flatnonzero(np.diff(at) > 2):
                a, b = at[g], at[g + 1]
                _connect(joined, a, b, lambda i, others: (sketch[others] == sketch[i]).sum(axis=1) >= least)
            yield joined.spanning(frame["set_key"].to_numpy())

    return region.mapInPandas(linked, "p binary, q binary")


def _connect(joined: _Joined, a: int, b: int, test) -> None:
    """Join rows a to b that pass the test; those already connected with a row are not tested."""
    for i in range(a, b - 1):
        roots = joined.roots(i, b)
        others = i + np.flatnonzero(roots != roots[0])
        others = others[others > i]
        if not len(others):
            if i == a:
                return
            continue
        # Few tests first: one hit often connects the rest.
        done, step = 0, 8
        while done < len(others):
            part = others[done : done + step]
            for j in part[test(i, part)]:
                joined.join(i, j)
            done, step = done + step, step * 8
            mine = joined.root(i)
            rest = others[done:]
            if len(rest):
                others = np.concatenate([others[:done], [j for j in rest if joined.root(j) != mine]]).astype(np.int64)


def _pairs_of_blocks(rows: DataFrame, key: list[str], blocks: str) -> DataFrame:
    """Deal the rows of a group to pairs of its blocks: column pair, 0 where there is one block.

    A row goes to as many pairs as there are blocks; every two rows of a group meet.
    """
    mine = F.pmod(F.xxhash64(*key), F.col(blocks))
    other = F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    dealt = rows.withColumn("_mine", mine).withColumn("_other", other)
    return dealt.withColumn(
        "pair", F.least("_mine", "_other") * F.col(blocks) + F.greatest("_mine", "_other")
    ).drop("_mine", "_other")


def candidates(classes: DataFrame) -> DataFrame:
    """Candidate links between classes (set_key, sketch, signature): a spanning set per region."""
    depths = range(SHALLOW, DEPTH + 1)
    trees = F.inline(
        F.array(
            *(
                F.struct(
                    *(
                        F.xxhash64(F.lit(t), F.substring("signature", t * DEPTH * 4 + 1, d * 4)).alias(f"d{d}")
                        for d in depths
                    ),
                    F.substring("signature", t * DEPTH * 4 + 1, DEPTH * 4).alias("order"),
                )
                for t in range(TREES)
            )
        )
    )
    rows = classes.select("set_key", "sketch", trees)
    above = classes.select(trees).drop("order")
    # A class that is alone in its sparsest region has no candidate there, at no depth; it is
    # known by the regions' numbers before sketches are shuffled.
    sizes = above.groupBy(f"d{SHALLOW}").agg(F.count("*").alias(f"n{SHALLOW}"))
    shared = keep(sizes.filter(F.col(f"n{SHALLOW}") > 1), "shared")
    rows = may_be_in(rows, F.col(f"d{SHALLOW}"), shared, F.col(f"d{SHALLOW}"))
    # Regions with more than CROWDED classes at each depth, among those crowded one step above.
    for d in depths:
        sizes = shared if d == SHALLOW else above.groupBy(f"d{d}").agg(F.count("*").alias(f"n{d}"))
        many = keep(sizes.filter(F.col(f"n{d}") > CROWDED), "crowded")
        above = above.join(many, f"d{d}", "left_semi")
        rows = rows.join(many, f"d{d}", "left")
    region = F.col(f"d{DEPTH}")
    for d in reversed(range(SHALLOW, DEPTH)):
        region = F.when(F.col(f"n{d}").isNull(), F.col(f"d{d}")).otherwise(region)
    full = F.lit(True)
    for d in range(SHALLOW, DEPTH):
        full = full & F.col(f"n{d}").isNotNull()
    blocks = F.when(full, F.ceil(F.coalesce(f"n{DEPTH}", F.lit(1)) / CROWDED)).otherwise(1)
    placed = rows.select("set_key", "sketch", "order", region.alias("region"), blocks.cast("long").alias("_blocks"))
    dealt = _pairs_of_blocks(placed, ["set_key"], "_blocks").drop("_blocks")
    return _agreeing(dealt.repartition("region", "pair").sortWithinPartitions("region", "pair", "order", "set_key"))


# ---- confirmation ---------------------------------------------------------------------


def _confirm(dealt: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links within families, confirmed on full sets: a spanning set per pair of blocks."""

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, at in _whole_groups(batches, ["family", "pair"]):
            flat, offsets = shingle_sets(pa.array(frame["text"], pa.large_string()), shingle)
            size = np.diff(offsets)

            def alike(i: int, others: np.ndarray) -> np.ndarray:
                mine = flat[offsets[i] : offsets[i + 1]]
                lengths = size[others]
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                where = np.repeat(offsets[others] - starts, lengths) + np.arange(lengths.sum())
                theirs = flat[where]
                found = np.searchsorted(mine, theirs)
                found[found == len(mine)] = 0
                common = np.add.reduceat((mine[found] == theirs).astype(np.int64), starts)
                return 100 * common >= percent * (lengths + len(mine) - common)

            joined = _Joined(len(frame))
            for a, b in zip(at[:-1], at[1:], strict=True):
                _connect(joined, a, b, alike)
            yield joined.spanning(frame["set_key"].to_numpy())

    return dealt.mapInPandas(linked, "p binary, q binary")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, text_hash, stands.

    Documents are linked if at least ``percent`` of the union of their sets is common.
    ``stands`` marks the row (or equal rows) that stays of each component; ``text_hash``
    (xxhash64 of the text) tells rows of one id apart.
    """
    signed = keep(sign(docs, shingle, doc_id, text), "signed")
    at = F.coalesce(F.col("doc_id"), F.lit(LAST)).alias("at")
    # The row that stands for a class is that with the smallest id, and among those with one
    # id that with the smallest hash.
    classes = keep(
        signed.filter("n_shingles > 0")
        .groupBy("set_key")
        .agg(
            F.min(F.struct(at, "text_hash")).alias("stands"),
            F.any_value("signature").alias("signature"),
            F.any_value("sketch").alias("sketch"),
            F.any_value("n_shingles").alias("n_shingles"),
        ),
        "classes",
    )
    families = components(candidates(classes))
    members = classes.join(families, F.col("set_key") == F.col("node")).select(
        "set_key", "stands.at", "stands.text_hash", "n_shingles", F.col("component").alias("family")
    )
    weights = members.groupBy("family").agg(
        F.ceil(F.sum("n_shingles") / BLOCK).alias("_blocks")
    )
    known = keep(members.join(weights, "family"), "members")
    texts = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("at"),
        F.xxhash64(text).alias("text_hash"),
        F.col(text).alias("text"),
    )
    # Most texts are in no family; they are dropped before texts are shuffled.
    of_row = F.xxhash64("at", "text_hash")
    texts = may_be_in(texts, of_row, known, of_row)
    # A class's row may be there several times; one of them is enough, and equal ones do no harm.
    found = texts.join(known, ["at", "text_hash"])
    dealt = _pairs_of_blocks(found, ["set_key"], "_blocks").select("family", "pair", "set_key", "text")
    links = _confirm(
        dealt.repartition("family", "pair").sortWithinPartitions("family", "pair", "set_key"), shingle, percent
    )
    linked = components(links)
    named = (
        classes.select("set_key", "stands")
        .join(linked, F.col("set_key") == F.col("node"), "left")
        .withColumn("component", F.coalesce("component", "set_key"))
    )
    smallest = named.groupBy("component").agg(F.min("stands").alias("first"))
    of_class = named.select("set_key", "component").join(smallest, "component").select("set_key", "first")
    alone = F.col("n_shingles") == 0
    rows = signed.select(
        "doc_id", at, "n_shingles", "text_hash", F.when(~alone, F.col("set_key")).alias("set_key")
    ).join(of_class, "set_key", "left")
    first_id = F.when(alone, F.col("doc_id")).when(F.col("first.at") != LAST, F.col("first.at"))
    return rows.select(
        "doc_id",
        "n_shingles",
        first_id.alias("component_id"),
        F.coalesce(F.col("doc_id") == first_id, F.lit(False)).alias("kept"),
        "text_hash",
        (alone | (F.struct("at", "text_hash") == F.struct("first.at", "first.text_hash"))).alias("stands"),
    )
