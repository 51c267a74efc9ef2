"""Packing documents into sequences of a fixed size by minimum bin slack.

Only the lengths decide how full a sequence can get, and there are no more different
lengths than the sequence has tokens.  So the bins are planned on the counts per length:
take the longest piece left, find by a bitset subset-sum over all lengths left the fullest
combination that fits beside it, remove it, and go on.  The same combination is taken as
often as the counts allow, hence the plan is short however many pieces there are.  The
pieces then find their place by their rank among those of the same length; ranks come from
counts per bucket and prefix sums, and no task holds all pieces.

Defined results: a NULL text is empty and gives one piece with the end token alone.
Repeated rows are packed as often as they come; a NULL id is an id like any other.  An empty
table gives no pieces.  Columns beside id and text are not read.  Pieces of the same length
are interchangeable and are ranked by id, piece and checksum.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.common import keep, partitions, piece_of, small_batches
from clientele.llm.encode import encode_texts

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLAN = "length long, rank_from long, rank_to long, first_sequence long, times long, place long"


def cut_documents(
    docs: DataFrame, tokenizer: str, chunks: str, size: int, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Tokens of each document with the end token, cut into pieces of at most ``size``.

    A document of more than ``size`` tokens ends with full pieces; its first may be shorter.
    """
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, ids in zip(batch["doc_id"], encode_texts(batch["text"], tokenizer, chunks), strict=True):
                ids += end
                n = len(ids) // 4
                # The remainder goes first; without one, the first piece is full.
                starts = [0, *range(n % size or size, n, size)]
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                    rows.append((key, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype(
                {"doc_id": "Int64"}
            )

    small_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(
        pieces, PIECES
    )


def fullest(counts: Mapping[int, int], room: int) -> dict[int, int]:
    """How many of each length fill ``room`` best: a subset-sum over a bitset of totals."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted(counts, reverse=True):
        left, take = min(counts[length], room // length), 1
        while left > 0 and not reach >> room:
            take = min(take, left)
            more = (reach | reach << (length * take)) & mask
            if more != reach:
                steps.append((length, take, reach))
                reach = more
            left -= take
            take *= 2
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def plan_bins(counts: Mapping[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Bins for so many pieces of each length, as rows of PLAN.

    A row says: of the pieces of this length, those with ranks ``rank_from`` up to
    ``rank_to`` go, ``times`` at a time, to sequences from ``first_sequence`` on, at ``place``
    and, for each further round, one length behind it.
    """
    left = {length: n for length, n in counts.items() if n}
    used, plan, sequence = dict.fromkeys(left, 0), [], 0
    while left:
        longest = max(left)
        rest = {k: n - (k == longest) for k, n in left.items() if k <= size - longest and n > (k == longest)}
        bin_ = fullest(rest, size - longest)
        bin_[longest] = bin_.get(longest, 0) + 1
        times, place = min(left[k] // n for k, n in bin_.items()), 0
        for length in sorted(bin_, reverse=True):
            taken = bin_[length] * times
            plan.append((length, used[length], used[length] + taken, sequence, times, place))
            used[length] += taken
            left[length] -= taken
            place += bin_[length] * length
            if not left[length]:
                del left[length]
        sequence += times
    return plan


def pack(pieces: DataFrame, size: int) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with doc_id, piece, start, length, ids_crc32.

    ``pieces`` is read several times: hand in a written table.
    """
    spark = pieces.sparkSession
    keys = ["doc_id", "piece", "start", "ids_crc32"]
    dealt = pieces.withColumn("_bucket", piece_of(keys, partitions(spark)))
    # At most ``size`` lengths, so at most ``size`` rows for the driver.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(plan_bins(counts, size), PLAN)
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        dealt.groupBy("length", "_bucket")
        .agg(F.count("*").alias("_n"))
        .select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    in_bucket = Window.partitionBy("length", "_bucket").orderBy(*keys)
    ranked = (
        dealt.withColumn("_row", F.row_number().over(in_bucket) - 1)
        .join(bases, ["length", "_bucket"])
        .withColumn("_rank", F.col("_base") + F.col("_row"))
    )
    # The plan has a few rows per length at most, whatever the number of pieces.
    where = plan.withColumnRenamed("length", "_length")
    place = (
        (F.col("length") == F.col("_length"))
        & (F.col("_rank") >= F.col("rank_from"))
        & (F.col("_rank") < F.col("rank_to"))
    )
    at = F.col("_rank") - F.col("rank_from")
    return ranked.join(F.broadcast(where), place).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first_sequence") + at % F.col("times")).alias("sequence_id"),
        (F.col("place") + F.floor(at / F.col("times")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, chunks: str, size: int, end_id: int) -> DataFrame:
    """Cut documents into pieces and pack these into as few sequences as it finds."""
    return pack(keep(cut_documents(docs, tokenizer, chunks, size, end_id), "pieces"), size)
