"""Token ids in flat binary files with 64-bit document offsets.

A dataset is a folder of parts in ascending id order.  A part is four flat little-endian
files: ``.bin`` holds the ids of its documents one after the other, ``.off`` the offset of
each document in the whole dataset (in ids, and the end of the last), ``.len`` their lengths from which offsets were made, ``.doc``
the documents' ids.  Offsets count from the start of the dataset: a part's base is the sum of the ids in the
parts before it, a prefix sum over one number per part.  All files can be memory-mapped, and
a reader needs no more than one part's offsets to find a document.

Parts are written by tasks under a temporary name and renamed, so a repeated task replaces
its own part with the same bytes.

Defined results: a NULL text is an empty document with the end id alone.  A NULL document id
sorts first and is stored as the smallest 64-bit integer.  Repeated ids stand next to each
other, in the order of their tokens.  An empty table gives a folder without parts.  Columns
beside id and text are not read.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from clientele.llm.common import keep, partitions, small_batches
from clientele.llm.encode import token_ids

NO_ID = -(2**63)
PART_DOCS = 200_000  # documents in a part, some hundreds of MB of ids


def _open(folder: str):
    """File system and path of a folder that all executors reach."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _write(folder: str, name: str, chunks: Iterator[bytes]) -> None:
    """One file, whole or not at all."""
    import uuid

    system, path = _open(folder)
    system.create_dir(path, recursive=True)
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        for chunk in chunks:
            out.write(chunk)
    system.move(part, f"{path}/{name}")


def _mapped(folder: str, name: str, dtype: str) -> np.ndarray:
    """A flat file as an array: memory-mapped where it is a file of a mounted system."""
    from pyarrow import fs

    system, path = _open(folder)
    file = f"{path}/{name}"
    if not system.get_file_info(file).size:
        return np.zeros(0, dtype)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(file, dtype, "r")
    with system.open_input_file(file) as source:
        return np.frombuffer(source.read_buffer(), dtype)


def id_type(vocabulary: int) -> str:
    """The narrowest unsigned type that holds every id."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    chunks: str,
    end_id: int,
    vocabulary: int,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encode and write all documents; returns one row per part (part, docs, ids, base).

    Texts are encoded where they are read; only ids are dealt by ranges of document id.
    """
    spark = docs.sparkSession
    small_batches(spark)
    dtype = id_type(vocabulary)
    end = np.array([end_id], dtype).tobytes()

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Write the parts of a task one after the other; rows come sorted by part."""
        runs = (run for batch in batches for run in batch.groupby("part", sort=False))
        for part, group in itertools.groupby(runs, key=lambda run: run[0]):
            lengths: list[int] = []
            keys: list[int] = []

            def blobs(group=group, lengths=lengths, keys=keys) -> Iterator[bytes]:
                for _, rows in group:
                    keys.extend(NO_ID if pd.isna(k) else int(k) for k in rows["doc_id"])
                    for ids in rows["ids"]:
                        lengths.append(len(ids) // len(end) + 1)
                        yield ids + end

            _write(folder, f"part-{part:06d}.bin", blobs())
            _write(folder, f"part-{part:06d}.doc", iter([np.array(keys, "<i8").tobytes()]))
            _write(folder, f"part-{part:06d}.len", iter([np.array(lengths, "<u8").tobytes()]))
            yield pd.DataFrame({"part": [part], "docs": [len(keys)], "ids": [int(np.sum(lengths))]})

    key = F.col(doc_id).cast("long")
    n = max(partitions(spark), -(-docs.count() // PART_DOCS))
    # Where parts begin: quantiles of the ids alone, so that texts are read and encoded once.
    shares = [i / n for i in range(1, n)]
    quantiles = F.percentile_approx(key, F.array(*map(F.lit, [0.5, *shares])), 100 * n)
    cuts = sorted(set(docs.select(quantiles).first()[0] or []))
    encoded = docs.select(
        # A NULL id is in the first part.
        F.size(F.filter(F.lit(cuts).cast("array<bigint>"), lambda cut: key >= cut)).cast("long").alias("part"),
        key.alias("doc_id"),
        token_ids(F.col(text), tokenizer, chunks, dtype).alias("ids"),
    )
    sizes = keep(
        encoded.repartition(n, "part")
        .sortWithinPartitions("part", "doc_id", F.length("ids"), "ids")
        .mapInPandas(parts, "part long, docs long, ids long"),
        "parts",
    )
    # One row per part: the window runs over as many rows as there are files.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = keep(sizes.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0))), "manifest")

    def offsets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, base in zip(batch["part"], batch["base"], strict=True):
                lengths = _mapped(folder, f"part-{part:06d}.len", "<u8")
                ends = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8") + np.uint64(base)
                _write(folder, f"part-{part:06d}.off", iter([ends.tobytes()]))
            yield batch

    # With a number of partitions these few rows stay dealt out, a task for some parts.
    spread = manifest.repartition(n, "part")
    return keep(spread.mapInPandas(offsets, manifest.schema), "written")


def read_tokens(written: DataFrame, folder: str, vocabulary: int) -> DataFrame:
    """Documents as the files have them: doc_id, start, n_tokens, ids (little-endian bytes)."""
    dtype = id_type(vocabulary)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in batch["part"]:
                keys = _mapped(folder, f"part-{part:06d}.doc", "<i8")
                ends = _mapped(folder, f"part-{part:06d}.off", "<u8").astype("i8")
                ids = _mapped(folder, f"part-{part:06d}.bin", dtype)
                for a in range(0, len(keys), 512):
                    b = min(a + 512, len(keys))
                    yield pd.DataFrame(
                        {
                            "doc_id": pd.array([None if k == NO_ID else int(k) for k in keys[a:b]], dtype="Int64"),
                            "start": ends[a:b],
                            "n_tokens": ends[a + 1 : b + 1] - ends[a:b],
                            "ids": [
                                ids[ends[i] - ends[0] : ends[i + 1] - ends[0]].astype("<u4").tobytes()
                                for i in range(a, b)
                            ],
                        }
                    )

    return (
        written.select("part")
        .repartition(max(partitions(written.sparkSession), written.count()), "part")
        .mapInPandas(read, "doc_id long, start long, n_tokens long, ids binary")
    )


@F.pandas_udf(LongType())
def checksum(ids: pd.Series) -> pd.Series:
    """Unsigned crc32 of the bytes."""
    return ids.map(lambda b: zlib.crc32(b)).astype("int64")


def dataset_folder(spark: SparkSession) -> str:
    """A new folder for token files in the place all executors share."""
    from clientele.sources import tables

    return tables.new_table_path(spark, "tokens")
