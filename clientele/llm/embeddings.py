"""Near-duplicate vectors by cross-polytope hashing.

A vector is rotated by three rounds of random signs and the fast Hadamard transform; its hash
is the coordinate of largest size, with its sign.  A bucket joins the hashes of a few
rotations.  Each vector stands in its own bucket of every table and probes the next likely
ones: those that cost the least squared size by taking a second or third coordinate instead.
Two vectors are candidates where the one's own bucket is the other's own or probed one.

Equal vectors are one class with a weight.  Candidates are compared in blocks of a bucket by
matrix products in double precision; no pair leaves a task, only each vector's number of
links and a spanning set of links.  A pair that meets in several buckets is counted in the
first of them, which both vectors' hashes tell.  A bucket with more than CROWDED rows is
dealt out in pairs of blocks.

The number of rotations in a bucket follows the logarithm of the number of vectors, so that
buckets of unlike vectors stay small; the number of tables follows from it so that a pair at
the threshold is missed with probability MISSED at most.

Defined results: a vector that is NULL, empty, zero, or holds NULL or non-finite values links
with nothing and is its own component.  Vectors of different length never link.  Repeated
rows link with each other.  A NULL id takes part but is smaller than none.  An empty table
gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import keep, small_batches
from clientele.llm.graph import components
from clientele.llm.minhash import LAST, _Joined, _whole_groups

COSINE = 0.9
MISSED = 1e-5
CROWDED = 2_048
SMALL = 24  # groups up to this size are compared all at once
_SEED = 7_919


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of every row (a power of two long), unscaled."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x


@dataclass(frozen=True)
class Hashing:
    """Tables of cross-polytope hashes for vectors of one length."""

    dim: int
    rotations: int  # in a bucket
    probes: int
    tables: int

    @cached_property
    def signs(self) -> np.ndarray:
        d = 1 << max(1, (self.dim - 1).bit_length())
        rng = np.random.default_rng(_SEED)
        return rng.choice([-1.0, 1.0], size=(self.tables, self.rotations, 3, d))

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """Bucket hashes of unit rows: rows x tables x (own, then probed)."""
        d = self.signs.shape[-1]
        x = np.pad(x, ((0, 0), (0, d - x.shape[1])))
        near = min(3 if self.rotations > 1 else self.probes + 1, d)
        choices = np.array(list(itertools.product(range(near), repeat=self.rotations)))
        out = np.zeros((len(x), self.tables, self.probes + 1), np.int64)
        for t in range(self.tables):
            codes, loss = np.zeros((len(x), len(choices)), np.uint64), np.zeros((len(x), len(choices)))
            codes += np.uint64(t * 0x9E3779B1 + self.dim)
            for k in range(self.rotations):
                y = x
                for r in range(3):
                    y = hadamard(y * self.signs[t, k, r]) / math.sqrt(d)
                size = np.abs(y)
                top = np.argsort(-size, axis=1, kind="stable")[:, :near]
                value = np.take_along_axis(size, top, 1)
                code = 2 * top + (np.take_along_axis(y, top, 1) > 0)
                codes = codes * np.uint64(0x9E3779B97F4A7C15) + code[:, choices[:, k]].astype(np.uint64) + np.uint64(1)
                loss += (value[:, :1] - value)[:, choices[:, k]] ** 2 + 2 * value[:, :1] * (value[:, :1] - value)[:, choices[:, k]]
            codes ^= codes >> np.uint64(29)
            order = np.argsort(loss, axis=1, kind="stable")[:, : self.probes + 1]
            out[:, t] = np.take_along_axis(codes, order, 1).astype(np.int64)
        return out


def _meet(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of rows of buckets: whether a's own bucket holds b, and b's own holds a."""
    return (a[:, :, :1] == b).any(axis=2), (b[:, :, :1] == a).any(axis=2)


@lru_cache
def hashing(dim: int, vectors: int, cosine: float = COSINE, missed: float = MISSED) -> Hashing:
    """As many rotations as keep buckets small among so many vectors, and enough tables."""
    d = 1 << max(1, (dim - 1).bit_length())
    rotations = max(1, round(math.log(max(vectors, 2)) / math.log(2 * d)))
    # Simulated pairs at the threshold tell how often one table lets them meet.
    rng = np.random.default_rng(_SEED + 1)
    a, b = rng.normal(size=(2, 4_000, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
    b = cosine * a + math.sqrt(1 - cosine * cosine) * b
    one = Hashing(dim, rotations, probes=min(2 * rotations - 1, 3**rotations - 1), tables=1)
    own, other = _meet(one.buckets(a), one.buckets(b))
    met = min(max((own | other).mean(), 0.01), 0.999)
    return Hashing(dim, rotations, one.probes, max(1, math.ceil(math.log(missed) / math.log(1 - met))))


def _unit(blobs) -> np.ndarray:
    x = np.frombuffer(b"".join(blobs), "<f8").reshape(len(blobs), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _classes(vectors: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, DataFrame]:
    """All rows with their class, and the classes: key, dim, weight, first id, vector."""

    def checked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, dims, blobs = [], [], []
            for values in batch["v"]:
                x = None if values is None else np.array(values, dtype=float) + 0.0  # -0 becomes 0
                # Scaled by the largest value, so that no square overflows or vanishes.
                most = np.abs(x).max() if x is not None and len(x) else 0.0
                good = np.isfinite(most) and most > 0 and bool(np.isfinite(x).all())
                blob = (x / most).astype("<f8").tobytes() if good else None
                blobs.append(blob)
                dims.append(len(x) if good else 0)
                keys.append(hashlib.blake2b(x.astype("<f8").tobytes(), digest_size=16).digest() if good else None)
            yield pd.DataFrame({"vec_id": batch["vec_id"].astype("Int64"), "key": keys, "dim": dims, "vector": blobs})

    small_batches(vectors.sparkSession)
    rows = keep(
        vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("v")).mapInPandas(
            checked, "vec_id long, key binary, dim int, vector binary"
        ),
        "vectors",
    )
    classes = rows.filter("key IS NOT NULL").groupBy("key", "dim").agg(
        F.count("*").alias("weight"),
        F.min(F.coalesce("vec_id", F.lit(LAST))).alias("first_id"),
        F.any_value("vector").alias("vector"),
    )
    return rows, keep(classes, "classes")


def _in_buckets(classes: DataFrame, sizes: dict[int, int], cosine: float) -> DataFrame:
    """Every class in its own and probed buckets: bucket, own, key, dim, weight, vector."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, rows in batch.groupby("dim"):
                scheme = hashing(int(dim), sizes[int(dim)], cosine)
                buckets = scheme.buckets(_unit(list(rows["vector"])))
                per = scheme.tables * (scheme.probes + 1)
                own = np.tile(np.arange(scheme.probes + 1) == 0, scheme.tables)
                out = rows.loc[rows.index.repeat(per)].reset_index(drop=True)
                out.insert(0, "bucket", buckets.reshape(-1))
                out.insert(1, "own", np.tile(own, len(rows)))
                yield out

    return classes.select("key", "dim", "weight", "vector").mapInPandas(
        hashed, "bucket long, own boolean, key binary, dim int, weight long, vector binary"
    )


def _links(dealt: DataFrame, sizes: dict[int, int], cosine: float) -> DataFrame:
    """Per block of a bucket: each class's links counted there, and a spanning set of links."""

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, at in _whole_groups(batches, ["bucket", "dim", "pair"]):
            keys, own = frame["key"].to_numpy(), frame["own"].to_numpy()
            mine, cross = frame["mine"].to_numpy(), frame["cross"].to_numpy()
            bucket, dims, weight = (frame[c].to_numpy() for c in ("bucket", "dim", "weight"))
            joined, links = _Joined(len(frame)), np.zeros(len(frame), np.int64)
            for dim in np.unique(dims):
                # Groups are of one length each; rows of others keep zeros here.
                here = np.flatnonzero(dims == dim)
                unit = np.zeros((len(frame), dim))
                unit[here] = _unit(list(frame["vector"].to_numpy()[here]))
                scheme = hashing(int(dim), sizes[int(dim)], cosine)
                for i, j in _close(unit, at[:-1], at[1:], dims[at[:-1]] == dim, cosine):
                    # One of the two must stand in its own bucket; blocks of two meet crosswise.
                    right = (own[i] | own[j]) & (~cross[i] | (mine[i] != mine[j]))
                    i, j = i[right], j[right]
                    used, place = np.unique(np.concatenate([i, j]), return_inverse=True)
                    if not len(used):
                        continue
                    codes = scheme.buckets(unit[used])
                    for a in range(0, len(i), 20_000):
                        p, q = i[a : a + 20_000], j[a : a + 20_000]
                        cp, cq = codes[place[: len(i)][a : a + 20_000]], codes[place[len(i) :][a : a + 20_000]]
                        in_p, in_q = _meet(cp, cq)
                        table = (in_p | in_q).argmax(axis=1)
                        row = np.arange(len(p))
                        none = np.int64(2**63 - 1)
                        first = np.minimum(
                            np.where(in_p[row, table], cp[row, table, 0], none),
                            np.where(in_q[row, table], cq[row, table, 0], none),
                        )
                        counted = first == bucket[p]
                        np.add.at(links, p[counted], weight[q[counted]])
                        np.add.at(links, q[counted], weight[p[counted]])
                        for x, y in zip(p.tolist(), q.tolist(), strict=True):
                            joined.join(x, y)
            out = joined.spanning(keys)
            out["links"] = 0
            some = links > 0
            yield pd.concat([out, pd.DataFrame({"p": keys[some], "q": None, "links": links[some]})], ignore_index=True)

    return dealt.mapInPandas(linked, "p binary, q binary, links long")


def _close(unit, starts, ends, wanted, cosine) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of the same group with at least this cosine."""
    size = ends - starts
    small = np.flatnonzero(wanted & (size > 1) & (size <= SMALL))
    if len(small):
        last = np.zeros(len(unit), np.int64)
        rows = np.concatenate([np.arange(starts[g], ends[g]) for g in small])
        last[rows] = np.repeat(ends[small], size[small])
        found_i, found_j = [], []
        for step in range(1, SMALL):
            i = rows[rows + step < last[rows]]
            if not len(i):
                break
            for a in range(0, len(i), 50_000):
                b = i[a : a + 50_000]
                good = np.einsum("ij,ij->i", unit[b], unit[b + step]) >= cosine
                found_i.append(b[good])
                found_j.append(b[good] + step)
        yield np.concatenate(found_i), np.concatenate(found_j)
    for g in np.flatnonzero(wanted & (size > SMALL)):
        x = unit[starts[g] : ends[g]]
        for a in range(0, len(x), 512):
            i, j = np.nonzero(x[a : a + 512] @ x[a:].T >= cosine)
            later = j > i
            yield starts[g] + a + i[later], starts[g] + a + j[later]


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows, classes = _classes(vectors, vec_id, embedding)
    # One number per vector length.
    sizes = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    placed = _in_buckets(classes, sizes, cosine)
    crowded = keep(
        placed.groupBy("bucket", "dim").agg(F.count("*").alias("_n")).filter(F.col("_n") > CROWDED), "crowded"
    )
    blocks = F.coalesce(F.ceil(F.col("_n") / CROWDED), F.lit(1)).cast("long")
    dealt = (
        placed.join(crowded, ["bucket", "dim"], "left")
        .withColumn("blocks", blocks)
        .withColumn("mine", F.pmod(F.xxhash64("key"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("pair", F.least("mine", "other") * F.col("blocks") + F.greatest("mine", "other"))
        .withColumn("cross", F.col("pair") % (F.col("blocks") + 1) != 0)
        .drop("_n", "blocks", "other")
    )
    found = keep(
        _links(
            dealt.repartition("bucket", "dim", "pair").sortWithinPartitions("bucket", "dim", "pair", "key"),
            sizes,
            cosine,
        ),
        "links",
    )
    linked = components(found.filter("q IS NOT NULL").select("p", "q"))
    counts = found.groupBy(F.col("p").alias("key")).agg(F.sum("links").alias("links"))
    named = (
        classes.select("key", "first_id", "weight")
        .join(linked.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("component", F.coalesce("component", "key"))
        .join(counts, "key", "left")
    )
    smallest = named.groupBy("component").agg(F.min("first_id").alias("first"))
    of_class = named.join(smallest, "component").select(
        "key", "first", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    component = F.when(F.col("key").isNull(), F.col("vec_id")).when(F.col("first") != LAST, F.col("first"))
    return rows.select("vec_id", "key").join(of_class, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
