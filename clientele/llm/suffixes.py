"""Repeated passages by a distributed suffix array.

Every byte covered by a string of ``length`` bytes that also starts elsewhere is found; the
input may be far larger than any machine.

1. *Symbols.* Texts are cut where a hash of the next few bytes is the smallest in some window
   of ``window`` places.  Cuts depend on the bytes near by only, so two equal strings have the
   same cuts inside.  The symbol of a cut is a hash of the phrases behind it that make up the
   reach: the least whole phrases that a repeated string must have from its first cut on.
2. *Residue.* A symbol that occurs once cannot lie inside a repeated string.  One shuffle by
   symbol drops these; the runs of repeated symbols are the strings to be sorted.
3. *Suffix array* of all runs by the difference cover modulo 3: sort the triples at places 1
   and 2 modulo 3, name them by rank, recurse on the names until names are unique or reach
   far enough, then merge in the suffixes at places 0.  The merge is two sorts with running
   counts: places 0 with places 1 by (symbol, rank of the next), places 0 with places 2 by
   (symbol, next symbol, rank of the one after).  Runs end with terminators of their own.
   Names of symbols of the reach are far enough at once; shorter symbols take more levels.
4. *Adjacent prefixes.* Equal prefixes stand side by side in the array.  A place whose phrases
   equal a neighbour's over ``length`` bytes is certain to be repeated.  What is left are the
   ends of passages, which need not lie on cuts: their strings of ``length`` bytes are hashed
   and compared, where the array has a neighbour with a common prefix of the least size a
   repeated string must show.  Blocks of strings are judged together by what they have in
   common and what they make up, so that few are hashed place by place.

Equal texts are one class; all of a text of ``length`` bytes that has a copy is repeated.

Defined results: NULL is an empty text.  Texts below ``length`` bytes are left whole.
Matches never cross texts, overlap in a text counts.  Repeated rows are copies.  A NULL id is
kept as it is.  An empty table gives no rows.  Strings are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.common import forget, keep, release, small_batches
from clientele.llm.minhash import _whole_groups
from clientele.llm.words import mix, running_hash, span_hash, text_buffer

LENGTH = 400
GRAM = 8  # bytes whose hash decides a cut
MOST_LEVELS = 40
# Periods, in phrases, that are looked for.
PERIODS = 8
# Places of one string in one text from which on they are dealt by place.
MANY = 16
# Symbols at which the recursion ends in one task; a constant, however large the input.
BASE = 100_000


def window_of(length: int) -> int:
    """Places in which one cut falls at least.  Small against ``length``, so that a repeated
    string has at least ``reach_of`` bytes of whole phrases inside."""
    return max(4, length // 6)


def reach_of(length: int) -> int:
    return max(1, length - 4 * window_of(length) - GRAM + 4)


def block_of(length: int) -> int:
    """Neighbouring strings that are judged together where they can be: few enough that what
    they have in common, and what they make up together, are nearly as long as one."""
    return max(2, min(16, length // 8))


# ---- cuts and phrases -----------------------------------------------------------------


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        values = best(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return best(values[: len(values) - rest], values[rest:]) if rest else values


def cuts(grams: np.ndarray, window: int) -> np.ndarray:
    """Places whose hash is the smallest in some window of places that holds them."""
    if len(grams) < window:
        return np.zeros(0, np.int64)
    least = _sliding(grams, window, np.minimum)
    pad = np.zeros(window - 1, grams.dtype)
    highest = _sliding(np.concatenate([pad, least, pad]), window, np.maximum)
    return np.flatnonzero(highest == grams)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the GRAM bytes from each place on."""
    if len(data) < GRAM:
        return np.zeros(0, np.uint32)
    # The eight bytes of each place as one number.
    h = np.ndarray((len(data) - GRAM + 1,), "<u8", np.ascontiguousarray(data), strides=(1,)).astype(np.uint64)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(32)).astype(np.uint32)


def prefixes(docs: DataFrame, length: int) -> DataFrame:
    """Cuts of all texts (columns key, text) with the phrases behind them that make up the reach
    of ``length``: hash of these, key, start, size in bytes, and the cut before (-1: none).
    Cuts with fewer phrases behind them are left out."""
    window, reach = window_of(length), reach_of(length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = text_buffer(batch.column(1))
            texts = np.flatnonzero(np.diff(ends) >= length)
            if not len(texts):
                continue
            grams = gram_hashes(data)
            found = [ends[t] + cuts(grams[ends[t] : ends[t + 1] - GRAM + 1], window) for t in texts]
            counts = np.array([len(f) for f in found])
            place, text = np.concatenate(found), np.repeat(texts, counts)
            stop = np.repeat(np.cumsum(counts), counts)
            upto = np.searchsorted(place, place + reach)
            chosen = np.flatnonzero(upto < stop)
            start, end, text = place[chosen], place[upto[chosen]], text[chosen]
            before = np.full(len(chosen), -1)
            inner = (chosen > 0) & (place[chosen - 1] >= ends[text])
            before[inner] = (place[chosen - 1] - ends[text])[inner]
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            out = [span_hash(running_hash(data), start, end), keys[text], start - ends[text], end - start, before]
            kinds = (np.int64, np.int64, np.int32, np.int32, np.int32)
            yield from dealt(
                pa.RecordBatch.from_arrays(
                    [pa.array(c.astype(k)) for c, k in zip(out, kinds, strict=True)],
                    names=["hash", "key", "start", "size", "before"],
                ),
                text,
            )

    small_batches(docs.sparkSession)
    return docs.select("key", "text").mapInArrow(cut, "hash long, key long, start int, size int, before int")


def _with_starts(rows, start: np.ndarray):
    """A batch or table of rows with other starts."""
    at = rows.schema.get_field_index("start")
    return rows.set_column(at, "start", pa.array(start.astype(np.int32)))


def dealt(rows: pa.RecordBatch, text: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (hash, key, start, more), each of the text of that number, made ready for ``repeated``.

    What one text holds at MANY places is repeated whatever other texts hold.  Such rows need not
    meet the others of their hash: their starts are turned into -2 and below, and they are dealt
    by place.  A row at start -1 stands for them before the others.  This depends on the text alone,
    so that copies, and a task that runs again, deal every row to the same place.
    """
    group = rows.column(0).to_numpy().view(np.uint64) ^ mix(text.astype(np.uint64) + np.uint64(1))
    in_turn = np.sort(group)
    often = np.unique(in_turn[MANY - 1 :][in_turn[MANY - 1 :] == in_turn[: max(0, len(group) - MANY + 1)]])
    if not len(often):
        yield rows
        return
    start = rows.column(2).to_numpy()
    _, first = np.unique(group, return_index=True)
    yield _with_starts(rows, np.where(np.isin(group, often), -2 - start, start))
    first = first[np.isin(group[first], often)]
    yield _with_starts(rows.take(pa.array(first)), np.full(len(first), -1))


def repeated(rows: DataFrame) -> DataFrame:
    """Rows whose ``hash`` occurs at two different places (key, start); equal rows once.  Rows are
    as ``dealt`` leaves them.

    One shuffle by hash; a sorted stream is compared row by row with its neighbours, so that a
    hash of any frequency takes no memory.
    """
    columns = rows.columns

    def places(table: pa.Table, found: np.ndarray) -> list[pa.RecordBatch]:
        table = table.filter(pa.array(found))
        start = table.column("start").to_numpy()
        return _with_starts(table, np.where(start < -1, -2 - start, start)).combine_chunks().to_batches()

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, whose right neighbour is not known yet
        held_kept = False
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            h, k, s = (table.column(c).to_numpy() for c in ("hash", "key", "start"))
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (k[1:] != k[:-1]) | (s[1:] != s[:-1])
            table, h, s = table.filter(pa.array(new)), h[new], s[new]
            if not len(h):
                continue
            left = np.zeros(len(h), bool)
            left[1:] = h[1:] == h[:-1]
            left[0] = held is not None and held_kept
            right = np.zeros(len(h), bool)
            right[:-1] = left[1:]
            held, held_kept = table.slice(len(h) - 1), bool(left[-1])
            found = ((left | right | (s < -1)) & (s != -1))[:-1]
            if found.any():
                yield from places(table.slice(0, len(h) - 1), found)
        if held is not None:
            s = held.column("start").to_numpy()
            yield from places(held, (s < -1) | (held_kept & (s >= 0)))

    by = F.when(F.col("start") < -1, F.xxhash64("key", "start")).otherwise(F.col("hash"))
    in_turn = rows.repartition(by).sortWithinPartitions("hash", "key", "start")
    return in_turn.mapInArrow(several, rows.schema).select(*columns)


def runs(residue: DataFrame, length: int) -> DataFrame:
    """Runs of neighbouring cuts with repeated prefixes, one row per cut and its prefix as symbol.

    ``long`` digests the prefixes from here that make up ``length`` and ``far`` their size; 0
    where the run ends before.  The inner cuts of periodic stretches are left out: these are
    repeated as they stand, rows with place -1.
    """
    window = window_of(length)

    def strung(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, at in _whole_groups(batches, ["key"]):
            start, before = frame["start"].to_numpy(np.int64), frame["before"].to_numpy(np.int64)
            symbol, keys = frame["hash"].to_numpy(), frame["key"].to_numpy()
            end, step = start + frame["size"].to_numpy(np.int64), start - before
            row = np.arange(len(frame))
            first_of_key = np.zeros(len(frame), bool)
            first_of_key[at[:-1]] = True

            def numbered(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
                """Of the chosen rows: the number of the run each is in, where runs begin and end."""
                new = np.ones(len(chosen), bool)
                new[1:] = (
                    (np.diff(chosen) != 1) | first_of_key[chosen[1:]] | (before[chosen[1:]] != start[chosen[:-1]])
                )
                begin = np.flatnonzero(new)
                return np.cumsum(new) - 1, begin, np.append(begin[1:], len(chosen))

            run, begin, stop = numbered(row)
            # Prefixes overlap, so a digest of several takes in the steps from cut to cut, too.
            running = running_hash(np.column_stack([step, symbol]).view(np.uint8).reshape(-1))
            upto = np.searchsorted((run << 33) + end, (run << 33) + start + length)
            has_long = upto < stop[run]
            upto = np.minimum(upto, len(frame) - 1)
            long, far = span_hash(running, 16 * row + 8, 16 * upto + 16).astype(np.int64), end[upto] - start
            useful = np.ones(len(frame), bool)
            sure = []
            for q in range(1, PERIODS + 1):
                same = np.zeros(len(frame) + 1, bool)
                same[q:-1] = (symbol[q:] == symbol[:-q]) & (step[q:] == step[:-q]) & (run[q:] == run[:-q])
                edge = np.flatnonzero(np.diff(np.concatenate([[False], same])))
                for a, b in zip(edge[::2], edge[1::2], strict=True):
                    low, high = start[a - q], end[b - 1]
                    period = start[a] - low
                    # With longer periods, what lies between the two would count as repeated.
                    if period <= length and high - low >= length + period:
                        # Every byte in here is in a string that recurs one period on or back.
                        # Strings that reach out of it hold its first or last bytes only.
                        sure.append((keys[a], low, high - low))
                        near = length + 2 * window
                        useful[a - q : b] &= (start[a - q : b] < low + near) | (end[a - q : b] > high - near)
            chosen = np.flatnonzero(useful)
            run, begin, _ = numbered(chosen)
            if len(chosen):
                string = mix(
                    keys[chosen].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    + start[chosen][begin][run].astype(np.uint64)
                ).astype(np.int64)
                yield pd.DataFrame(
                    {
                        "string": string,
                        # Terminators are negative, below all ranks.
                        "terminator": -((string.view(np.uint64) >> np.uint64(2)).astype(np.int64)) - 1,
                        "place": (np.arange(len(chosen)) - begin[run]).astype(np.int32),
                        "symbol": symbol[chosen],
                        "size": frame["size"].to_numpy()[chosen].astype(np.int32),
                        "key": keys[chosen],
                        "start": start[chosen].astype(np.int32),
                        "before": before[chosen].astype(np.int32),
                        "long": np.where(has_long, long, 0)[chosen],
                        "far": np.where(has_long, far, 0)[chosen].astype(np.int32),
                    }
                )
            if sure:
                # Periodic stretches as rows of their own, at no place of any string.
                columns = pd.DataFrame(sure, columns=["key", "start", "far"]).astype({"start": "int32", "far": "int32"})
                yield columns.assign(
                    string=0, terminator=-1, place=np.int32(-1), symbol=0, size=np.int32(0), before=np.int32(2**30), long=0
                )[["string", "terminator", "place", "symbol", "size", "key", "start", "before", "long", "far"]]

    return residue.repartition("key").sortWithinPartitions("key", "start").mapInPandas(
        strung,
        "string long, terminator long, place int, symbol long, size int, key long, start int, before int, "
        "long long, far int",
    )


# ---- the suffix array -----------------------------------------------------------------


def in_order(
    rows: DataFrame, by: Sequence[str], flags: Sequence[str], made: list[DataFrame] | None = None
) -> DataFrame:
    """Add to every row its position in the order of ``by``, and for each boolean flag how many
    rows before it have the flag: ``position`` and ``<flag>_before``; ``new`` marks the first
    row of each value of ``by`` and ``first`` is that row's position.

    A range sort, local counts, and one number per partition and flag added up.  The table
    written is noted in ``made``.
    """
    names = ["position", *(f"{f}_before" for f in flags)]

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        done, last, first = np.zeros(len(names), np.int64), None, 0
        for batch in batches:
            if not len(batch):
                continue
            values = batch[list(by)].to_numpy()
            new = np.ones(len(batch), bool)
            new[1:] = (values[1:] != values[:-1]).any(axis=1)
            new[0] = last is None or (values[0] != last).any()
            last = values[-1]
            out = batch.assign(new=new, part=part)
            for k, (name, flag) in enumerate(zip(names, [None, *flags], strict=True)):
                one = np.ones(len(batch), np.int64) if flag is None else batch[flag].to_numpy().astype(np.int64)
                out[name] = done[k] + np.cumsum(one) - one
                done[k] += one.sum()
            out["first"] = np.maximum.accumulate(np.where(new, out["position"], first))
            first = int(out["first"].iloc[-1])
            yield out

    schema = ", ".join(
        [*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "new boolean", "part int"]
        + [f"`{n}` bigint" for n in [*names, "first"]]
    )
    sorted_rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).mapInPandas(counted, schema)
    local = keep(sorted_rows, "sorted")
    if made is not None:
        made.append(local)
    # One row per partition, whatever the number of rows.
    sums = local.groupBy("part").agg(
        F.count("*").alias("_position"), *(F.count_if(f).alias(f"_{f}_before") for f in flags)
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", *(F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in names))
    return (
        local.join(F.broadcast(bases), "part")
        .withColumns({"first": F.col("first") + F.col("_position"), **{n: F.col(n) + F.col(f"_{n}") for n in names}})
        .drop("part", *(f"_{n}" for n in names))
    )


def _base_ranks(strings: DataFrame) -> DataFrame:
    """The end of the recursion: at most BASE symbols, sorted in one task by prefix doubling."""

    def ranked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = [b for b in batches if len(b)]
        if not frames:
            return
        rows = pd.concat(frames, ignore_index=True)
        new = np.ones(len(rows), bool)
        new[1:] = rows["string"].to_numpy()[1:] != rows["string"].to_numpy()[:-1]
        first = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        # All strings in a row, each with its terminator behind it; terminators rank lowest.
        at = np.arange(len(rows)) + run
        ends = np.append(first[1:], len(rows)) + np.arange(len(first))
        rank = np.zeros(len(rows) + len(first), np.int64)
        rank[ends] = np.argsort(np.argsort(rows["terminator"].to_numpy()[first]))
        rank[at] = len(first) + np.unique(rows["symbol"].to_numpy(), return_inverse=True)[1]
        step = 1
        while rank.max() + 1 < len(rank):
            then = rank[np.minimum(np.arange(len(rank)) + step, len(rank) - 1)]
            rank = np.unique(rank * (len(rank) + 1) + then, return_inverse=True)[1]
            step *= 2
        yield rows[["string", "place"]].assign(rank=rank[at] - len(first))

    one = strings.repartition(1).sortWithinPartitions("string", "place")
    return one.mapInPandas(ranked, "string long, place int, rank long")


def suffix_ranks(
    strings: DataFrame, enough: int, level: int = 0, made: list[DataFrame] | None = None
) -> DataFrame:
    """The rank of every suffix of every string: string, place, rank.

    ``strings`` has string, place (from 0 without gaps), symbol (0 or more in effect: any order
    serves), size (bytes a symbol stands for) and terminator (negative, one per run).  Suffixes
    that agree for ``enough`` bytes may come in any order; ranks are unique where none do.  The tables the
    result still depends on are left in ``made``.
    """
    if level > MOST_LEVELS:
        raise RuntimeError("the suffix recursion does not end")
    made = [] if made is None else made
    used = []
    if level:  # The first strings are the caller's table.
        strings = keep(strings, "strings")
        used.append(strings)
    if strings.count() <= BASE:
        made.extend(used)
        return _base_ranks(strings)
    along = Window.partitionBy("string").orderBy("place")
    lead = lambda c, k: F.lead(c, k).over(along)
    wide = keep(
        strings.select(
            "string",
            "place",
            "terminator",
            "symbol",
            # Behind the end stands the terminator, smaller than all symbols: end flags sort first.
            F.coalesce(lead("symbol", 1), F.col("terminator")).alias("next"),
            F.when(lead("symbol", 1).isNull(), 0).otherwise(1).cast("tinyint").alias("in1"),
            F.coalesce(lead("symbol", 2), F.when(lead("symbol", 1).isNotNull(), F.col("terminator")).otherwise(0)).alias("after"),
            F.when(lead("symbol", 2).isNull(), 0).otherwise(1).cast("tinyint").alias("in2"),
            (F.col("size") + F.coalesce(lead("size", 1), F.lit(0)) + F.coalesce(lead("size", 2), F.lit(0)))
            .cast("bigint")
            .alias("size3"),
            F.lead("size", 2).over(along).isNull().alias("ends"),
            (F.col("place") % 3).alias("class"),
        ),
        "triples",
    )
    used.append(wide)
    sample = wide.filter("class > 0").select(
        "string", "place", "terminator", "symbol", "in1", "next", "in2", "after", "size3", "ends", "class"
    )
    # A triple's name is the position of its first row: in the order of triples, equal for equal.
    named = in_order(sample, ["symbol", "in1", "next", "in2", "after"], [], used).withColumnRenamed("first", "name")
    open_ = keep(
        # Rows of one name have one size.
        named.filter(F.col("size3") < enough).groupBy("name").agg(F.count("*").alias("n")).filter("n > 1").select("name"),
        "open",
    )
    if open_.isEmpty():
        # All columns went along; only places 0 have no rank yet.
        placed = named.withColumnRenamed("position", "rank").unionByName(wide.filter("class = 0"), allowMissingColumns=True)
    else:
        # Only strings with a name that is neither unique nor long enough go on.  Others are
        # ordered by their names; of one open name all places are in strings that go on.
        below = named.select(
            F.xxhash64("string", "class").alias("string"),
            F.floor((F.col("place") - 1) / 3).cast("int").alias("place"),
            F.col("name").alias("symbol"),
            F.col("size3").alias("size"),
            "terminator",
            F.col("string").alias("_string"),
            F.col("place").alias("_place"),
        )
        going = below.join(open_.withColumnRenamed("name", "symbol"), "symbol", "left_semi").select("string").distinct()
        deeper = suffix_ranks(
            below.join(going, "string", "left_semi").drop("_string", "_place"), enough, level + 1, used
        )
        refined = below.join(deeper, ["string", "place"], "left").select(
            F.col("_string").alias("string"),
            F.col("_place").alias("place"),
            F.col("symbol").alias("name"),
            F.coalesce("rank", F.lit(0)).alias("inner"),
        )
        ranks = in_order(refined, ["name", "inner"], [], used).select("string", "place", F.col("position").alias("rank"))
        placed = wide.join(ranks, ["string", "place"], "left")
    release(strings.sparkSession)
    # Ranks of the next two suffixes of every place; behind the end, the terminator.
    follow = lambda k: F.coalesce(F.lead("rank", k).over(along), F.col("terminator"))
    merged = keep(
        placed.select(
            "string",
            "place",
            "class",
            "symbol",
            "in1",
            "next",
            "rank",
            follow(1).alias("rank1"),
            follow(2).alias("rank2"),
            (F.col("class") == 0).alias("zero"),
            (F.col("class") != 0).alias("other"),
        ),
        "merging",
    )
    forget(used)
    with1 = in_order(
        merged.filter("class <> 2").select("string", "place", "class", "rank", "symbol", "rank1", "zero", "other"),
        ["symbol", "rank1"],
        ["zero", "other"],
        made,
    )
    with2 = in_order(
        merged.filter("class <> 1").select("string", "place", "class", "rank", "symbol", "in1", "next", "rank2", "zero", "other"),
        ["symbol", "in1", "next", "rank2"],
        ["zero", "other"],
        made,
    )
    forget([merged])
    samples = (
        with1.filter("class = 1").select("string", "place", (F.col("rank") + F.col("zero_before")).alias("rank"))
    ).unionByName(
        with2.filter("class = 2").select("string", "place", (F.col("rank") + F.col("zero_before")).alias("rank"))
    )
    zeros = (
        with1.filter("class = 0")
        .select("string", "place", (F.col("zero_before") + F.col("other_before")).alias("_first"))
        .join(with2.filter("class = 0").select("string", "place", F.col("other_before").alias("_second")), ["string", "place"])
        .select("string", "place", (F.col("_first") + F.col("_second")).alias("rank"))
    )
    return samples.unionByName(zeros)


# ---- from the array to spans ------------------------------------------------------------

# Neighbours in the array are compared in stretches of so many ranks, of more where there would
# be over MOST_STRETCHES.
STRETCH = 50_000
MOST_STRETCHES = 100_000
SPANS = "array<struct<f:bigint,t:bigint>>"


def shared_prefixes(suffixes: DataFrame, ranks: DataFrame, made: list[DataFrame]) -> DataFrame:
    """Places whose first symbol a neighbour in the array shares: key, start, before, that symbol as
    ``short``, far (the size of the ``long`` prefix where that is shared too, else 0)."""
    ranked = keep(
        suffixes.filter("place >= 0")
        .join(ranks, ["string", "place"])
        .select("key", "start", "before", F.col("symbol").alias("short"), "long", "far", (F.col("far") > 0).alias("has_long"), "rank", "string", "place"),
        "ranked",
    )
    made.append(ranked)
    # Ranks of suffixes that agree for the reach may repeat and leave holes, so what stands next
    # to a stretch is read off the rows: each is shown the last row before it and the first
    # one behind it.  Rows of one rank are in one stretch.
    width = max(STRETCH, -(-(ranked.agg(F.max("rank")).first()[0] or 0) // MOST_STRETCHES))
    placed = ranked.withColumn("_stretch", F.floor(F.col("rank") / width))
    row, place = F.struct("short", "long", "has_long"), F.struct("rank", "string", "place")
    in_turn = Window.orderBy("_stretch")
    borders = (
        placed.groupBy("_stretch")
        .agg(F.min_by(row, place).alias("first"), F.max_by(row, place).alias("last"))
        .select("_stretch", F.lag("last").over(in_turn).alias("before"), F.lead("first").over(in_turn).alias("behind"))
        .select(
            "_stretch",
            F.explode(
                F.array(
                    F.struct(F.lit(-1).cast("long").alias("rank"), F.col("before").alias("row")),
                    F.struct(F.lit((1 << 63) - 1).alias("rank"), F.col("behind").alias("row")),
                )
            ).alias("x"),
        )
        .filter("x.row IS NOT NULL")
        .select("_stretch", "x.rank", "x.row.*", F.lit(True).alias("_border"))
    )
    along = Window.partitionBy("_stretch").orderBy("rank")
    same = lambda c: sum(
        (F.coalesce(step(c).over(along) == c, F.lit(False)).cast("int") for step in (F.lag, F.lead)), F.lit(0)
    )
    compared = (
        placed.drop("string", "place")
        .withColumn("_border", F.lit(False))
        .unionByName(borders, allowMissingColumns=True)
        .withColumns({"_short": same(F.col("short")), "_long": same(F.when(F.col("has_long"), F.col("long")))})
        .filter("NOT _border AND _short > 0")
    )
    certain = F.col("has_long") & (F.col("_long") > 0)
    periodic = suffixes.filter("place < 0").select("key", "start", "before", F.col("symbol").alias("short"), "far")
    return compared.select(
        "key", "start", "before", "short", F.when(certain, F.col("far")).otherwise(0).alias("far")
    ).unionByName(periodic)


def _open_places(shared: DataFrame, sizes: DataFrame, length: int) -> DataFrame:
    """For every shared place the starts it stands for, ``low`` to ``high``, and whether any of
    their strings is not yet covered by certain repeats (``open``); ``near`` and ``wide`` are
    then how many bytes before the place the last and the first such string start.  ``until`` is
    where the certain repeats end that begin at the place and overlap or touch, 0 at others."""
    window = window_of(length)

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, at in _whole_groups(batches, ["key"]):
            start, before, far = (frame[c].to_numpy(np.int64) for c in ("start", "before", "far"))
            n = frame["n_bytes"].to_numpy(np.int64)
            low = np.where(before < 0, 0, np.maximum(0, before - window + 2))
            high = np.minimum(start - window + 1, n - length)
            open_ = np.zeros(len(frame), bool)
            first, last = start.copy(), start.copy()
            until = np.zeros(len(frame), np.int64)
            for a, b in zip(at[:-1], at[1:], strict=True):
                edge = np.zeros(n[a] + 1, np.int64)
                np.add.at(edge, start[a:b], far[a:b] > 0)
                np.add.at(edge, start[a:b] + far[a:b], -(far[a:b] > 0).astype(np.int64))
                covered = np.cumsum(edge)[:-1] > 0
                begins = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]])))
                until[a + np.searchsorted(start[a:b], begins[::2])] = begins[1::2]
                bare = np.concatenate([[0], np.cumsum(~covered)])
                # Starts with a bare byte in their string, counted up to each start.
                some = np.concatenate([[0], np.cumsum(bare[length:] > bare[: len(bare) - length])])
                right = high[a:b] >= low[a:b]
                lo, hi = np.where(right, low[a:b], 0), np.where(right, high[a:b] + 1, 0)
                open_[a:b] = some[hi] > some[lo]
                first[a:b] = np.searchsorted(some, some[lo], "right") - 1
                last[a:b] = np.searchsorted(some, some[hi], "left") - 1
            yield frame[["key", "short"]].assign(
                start=start, until=until, low=low, high=high, open=open_, near=start - last, wide=start - first
            )

    rows = shared.join(sizes, "key").repartition("key").sortWithinPartitions("key", "start")
    return rows.mapInPandas(
        places,
        "key long, short long, start long, until long, low long, high long, open boolean, near long, wide long",
    )


def _lists(column: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """The items of all lists of a column in a row, and the row each is of."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), sizes), column.flatten()


def _expanded(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges ``first`` to ``last``, and the range each is of."""
    sizes = np.maximum(0, last - first + 1)
    of = np.repeat(np.arange(len(first)), sizes)
    return first[of] + np.arange(len(of)) - (np.cumsum(sizes) - sizes)[of], of


def _blocks(asks: pa.ListArray, block: int) -> tuple[np.ndarray, ...]:
    """Blocks of the strings asked for: row, where the part common to a block's strings starts,
    and the first and last start asked for in it.

    Strings are in blocks by how far before their place they start; equal strings start equally
    far, so that they are in equal blocks.
    """
    row, items = _lists(asks)
    place, low, high = (items.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "low", "high"))
    number, of = _expanded((place - high) // block, (place - low) // block)
    part = place[of] - number * block
    return row[of], part, np.maximum(low[of], part - block + 1), np.minimum(high[of], part)


def find(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text"):
    """Tables of what is repeated: rows (doc_id, key, n_bytes, sha256), texts (key, text) of all
    keys with spans, and spans (key, spans: array of from, to).

    ``key`` is the 64-bit hash of a text; rows of one key have the same text.
    """
    small_batches(docs.sparkSession)
    whole = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(whole).alias("key"), whole.alias("text"))
    rows = keep(
        keyed.select(
            "doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256")
        ),
        "rows",
    )
    sizes = rows.groupBy("key").agg(F.max("n_bytes").alias("n_bytes"), F.count("*").alias("copies"))
    suffixes = keep(runs(repeated(prefixes(keyed, length)), length), "suffixes")
    release(docs.sparkSession)
    # Equal prefixes of the reach must stand side by side; what agrees further may be in any order.
    strings = suffixes.filter("place >= 0").select("string", "place", "symbol", "size", "terminator")
    made = [suffixes]
    shared = shared_prefixes(suffixes, suffix_ranks(strings, reach_of(length), made=made), made)
    places = keep(_open_places(shared, sizes.select("key", "n_bytes"), length), "places")
    forget(made)
    release(docs.sparkSession)
    # A start that is open must be compared with all that share its prefix, certain or not.  Equal
    # strings start equally far before their places: no others than the open distances are asked.
    distances = places.filter("open").groupBy("short").agg(F.min("near").alias("_near"), F.max("wide").alias("_wide"))
    asked = (
        places.select("key", "short", "start", "low", "high")
        .join(distances, "short")
        .select(
            "key",
            "start",
            F.greatest("low", F.col("start") - F.col("_wide")).alias("low"),
            F.least("high", F.col("start") - F.col("_near")).alias("high"),
        )
        .filter("high >= low")
    )
    wanted = asked.select("key", F.struct("start", "low", "high").alias("ask"), F.lit(None).cast("struct<f:bigint,t:bigint>").alias("sure"))
    certain = places.filter("until > 0").select(
        "key",
        F.lit(None).cast("struct<start:bigint,low:bigint,high:bigint>").alias("ask"),
        F.struct(F.col("start").alias("f"), F.col("until").alias("t")).alias("sure"),
    )
    # Lists of one text's places: no longer than the text.
    per_key = wanted.unionByName(certain).groupBy("key").agg(
        F.collect_list("ask").alias("asks"), F.collect_list("sure").alias("sures")
    )
    copied = sizes.filter((F.col("copies") > 1) & (F.col("n_bytes") >= length)).select("key")
    texts = keep(keyed.select("key", "text").join(per_key, "key").dropDuplicates(["key"]), "texts")
    block = block_of(length)

    def hashed(batch: pa.RecordBatch, row: np.ndarray, start: np.ndarray, size: int, running: np.ndarray, ends: np.ndarray, **more):
        """Hashes of the strings of ``size`` bytes at the starts in the texts of the rows, each once."""
        row, start = (x := np.unique((row << 32) + start)) >> 32, x & 0xFFFFFFFF
        h = span_hash(running, ends[row] + start, ends[row] + start + size).astype(np.int64)
        keys = batch.column(0).to_numpy(zero_copy_only=False)[row]
        out = {"hash": h, "key": keys, "start": start.astype(np.int32), **{k: np.full(len(h), v) for k, v in more.items()}}
        return dealt(pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in out.items()}), row)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = text_buffer(batch.column(1))
            running = running_hash(data)
            row, part, _, _ = _blocks(batch.column(2), block)
            yield from hashed(batch, row, part, length - block + 1, running, ends, whole=False)
            inside = (part - block + 1 >= 0) & (part + length <= (ends[row + 1] - ends[row]))
            yield from hashed(batch, row[inside], part[inside] - block + 1, length + block - 1, running, ends, whole=True)

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = text_buffer(batch.column(1))
            row, part, first, last = _blocks(batch.column(2), block)
            of, common = _lists(batch.column(3))
            chosen = np.isin((row << 32) + part, (of << 32) + common.to_numpy(zero_copy_only=False))
            start, of = _expanded(first[chosen], last[chosen])
            yield from hashed(batch, row[chosen][of], start, length, running_hash(data), ends)

    # What a block of strings has in common must be repeated if one of them is, and all are if what
    # they make up together is.  Strings are compared one by one in blocks between the two and
    # in all blocks that have as much in common with one of these.
    asking = texts.filter(F.size("asks") > 0).select("key", "text", "asks")
    judged = keep(repeated(asking.mapInArrow(blocks, "hash long, key long, start int, whole boolean")), "blocks")
    common = judged.filter("NOT whole").select("hash", "key", "start")
    whole_blocks = judged.filter("whole").select("key", (F.col("start") + block - 1).alias("start"))
    between = common.join(whole_blocks, ["key", "start"], "left_anti").select("hash").distinct()
    going = asking.join(
        common.join(between, "hash", "left_semi").groupBy("key").agg(F.collect_list("start").alias("common")), "key"
    )
    hits = repeated(going.select("key", "text", "asks", "common").mapInArrow(strings, "hash long, key long, start int"))
    found = (
        hits.select("key", "start", F.lit(False).alias("whole"))
        .unionByName(judged.filter("whole").select("key", "start", "whole"))
        .groupBy("key")
        .agg(
            F.collect_list(F.when(~F.col("whole"), F.col("start"))).alias("starts"),
            F.collect_list(F.when(F.col("whole"), F.col("start"))).alias("wholes"),
        )
    )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, sure = _lists(batch.column(1))
            rows_, froms, tos = [row], [sure.field("f").to_numpy(zero_copy_only=False)], [sure.field("t").to_numpy(zero_copy_only=False)]
            for column, size in ((batch.column(2), length), (batch.column(3), length + block - 1)):
                row, at = _lists(column)
                rows_.append(row)
                froms.append(at.to_numpy(zero_copy_only=False).astype(np.int64))
                tos.append(froms[-1] + size)
            row = np.concatenate(rows_) << 32
            low, high = row + np.concatenate(froms), row + np.concatenate(tos)
            order = np.argsort(low, kind="stable")
            low, high = low[order], np.maximum.accumulate(high[order])
            new = np.ones(len(low), bool)
            new[1:] = low[1:] > high[:-1]
            first = np.flatnonzero(new)
            low, high = low[first], high[np.append(first[1:], len(high)) - 1] if len(first) else high
            bounds = np.searchsorted(low, np.arange(len(batch) + 1) << 32).astype(np.int32)
            spans = pa.StructArray.from_arrays([pa.array(low & 0xFFFFFFFF), pa.array(high & 0xFFFFFFFF)], names=["f", "t"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(bounds), spans)], names=["key", "spans"]
            )

    partly = (
        texts.select("key", "sures")
        .join(found, "key", "left")
        .select("key", "sures", "starts", "wholes")
        .mapInArrow(merged, f"key long, spans {SPANS}")
        .filter(F.size("spans") > 0)
        .join(copied, "key", "left_anti")
    )
    fully = copied.join(sizes.select("key", "n_bytes"), "key").select(
        "key", F.array(F.struct(F.lit(0).cast("long").alias("f"), F.col("n_bytes").alias("t"))).alias("spans")
    )
    spans = keep(partly.unionByName(fully), "spans")
    forget([judged])
    return rows, texts.select("key", "text"), spans


def cut_out(text: str, spans, whole_characters: bool = False) -> bytes:
    """The bytes of a text outside the spans; with whole characters, none is cut in two."""
    body, out, at = text.encode(), [], 0
    for span in spans:
        a, b = span["f"], span["t"]
        if whole_characters:
            while a < b and body[a] & 0xC0 == 0x80:
                a += 1
            while b > a and b < len(body) and body[b] & 0xC0 == 0x80:
                b -= 1
        out.append(body[at:a])
        at = b
    return b"".join([*out, body[at:]])


def digests(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows, texts, spans = find(docs, length, doc_id, text)

    def digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for batch in batches:
            kept = [hashlib.sha256(cut_out(t, s)).hexdigest() for t, s in zip(batch["text"], batch["spans"], strict=True)]
            yield pd.DataFrame({"key": batch["key"], "kept_sha256": kept})

    cut = texts.join(spans, "key").mapInPandas(digested, "key long, kept_sha256 string")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["t"] - s["f"])
    by_key = spans.select("key", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"))
    return (
        rows.join(by_key, "key", "left")
        .join(cut, "key", "left")
        .select(
            "doc_id",
            "n_bytes",
            F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
            F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
            F.when(F.col("n_removed") == F.col("n_bytes"), F.sha2(F.lit(""), 256))
            .otherwise(F.coalesce("kept_sha256", "sha256"))
            .alias("kept_sha256"),
        )
    )


def short_passages(keyed: DataFrame, length: int, words: int) -> DataFrame:
    """Spans (key, spans) of all passages of ``words`` words in less than ``length`` bytes that
    also stand elsewhere.  ``keyed`` has key and text; equal texts have one key.

    Words are parted by ASCII blanks.  Longer passages of as many words are strings of ``length``
    bytes, so that only texts of short words have rows here, one per word at most.
    """

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = text_buffer(batch.column(1))
            running = running_hash(data)
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            inside = (data != 32) & ((data < 9) | (data > 13))
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for text, (key, a, b) in enumerate(zip(keys, ends[:-1], ends[1:], strict=True)):
                edge = np.flatnonzero(np.diff(np.concatenate([[False], inside[a:b], [False]]).astype(np.int8)))
                start, end = edge[::2], edge[1::2]
                if len(start) < words:
                    continue
                start, end = start[: len(start) - words + 1], end[words - 1 :]
                short = end - start < length
                start, end = start[short], end[short]
                out[0].append(span_hash(running, a + start, a + end))
                out[1].append(np.full(len(start), key, np.int64))
                out[2].append(start)
                out[3].append(end - start)
                out[4].append(np.full(len(start), text))
            if out[0]:
                kinds = (np.int64, np.int64, np.int32, np.int32)
                yield from dealt(
                    pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c).astype(k)) for c, k in zip(out, kinds, strict=False)],
                        names=["hash", "key", "start", "size"],
                    ),
                    np.concatenate(out[4]),
                )

    windows = lambda rows: rows.select("key", "text").mapInArrow(strings, "hash long, key long, start int, size int")
    # Texts that are whole copies are one place to ``repeated``; all in them is repeated.
    copied = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    copies = (
        windows(keyed.join(copied, "key", "left_semi").dropDuplicates(["key"]))
        .filter("start <> -1")
        .withColumn("start", F.when(F.col("start") < -1, -2 - F.col("start")).otherwise(F.col("start")))
    )
    return (
        repeated(windows(keyed))
        .unionByName(copies)
        .groupBy("key")
        # No longer than the text.
        .agg(F.collect_set(F.struct(F.col("start").cast("long").alias("f"), (F.col("start") + F.col("size")).cast("long").alias("t"))).alias("spans"))
    )


def remove(
    docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", words: int | None = None
) -> DataFrame:
    """The documents with all repeated passages taken out of their texts, whole characters at a
    time; all other columns as they are.  With ``words``, passages of as many words are taken out
    also where they have less than ``length`` bytes."""
    _, _, spans = find(docs, length, doc_id, text)
    if words is not None:
        whole = F.coalesce(F.col(text), F.lit(""))
        short = short_passages(docs.select(F.xxhash64(whole).alias("key"), whole.alias("text")), length, words)

        @F.pandas_udf(SPANS)
        def joined(lists: pd.Series) -> pd.Series:
            out = []
            for found in lists:
                merged: list[list[int]] = []
                for a, b in sorted((s["f"], s["t"]) for s in found):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                out.append([{"f": a, "t": b} for a, b in merged])
            return pd.Series(out, index=lists.index, dtype=object)

        both = spans.unionByName(short).groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"))
        spans = keep(both.select("key", joined("spans").alias("spans")), "spans")
    named = spans.select(F.col("key").alias("_key"), F.col("spans").alias("_spans"))

    @F.pandas_udf("string")
    def left(texts: pd.Series, where: pd.Series) -> pd.Series:
        return pd.Series(
            [cut_out(t, s, True).decode() for t, s in zip(texts, where, strict=True)], index=texts.index, dtype=object
        )

    found = docs.withColumn("_key", F.xxhash64(F.coalesce(F.col(text), F.lit("")))).join(named, "_key", "left")
    # Texts without spans are not handed to Python.
    some = F.col("_spans").isNotNull()
    shorter = left(F.when(some, F.col(text)).otherwise(""), F.coalesce("_spans", F.array().cast(SPANS)))
    return found.withColumn(text, F.when(some, shorter).otherwise(F.col(text))).select(*docs.columns)
