"""License scans by diagonal voting.

Every run of three words of a text is hashed and joined to the places where it stands in the
license templates.  A hit at word ``p`` of the text and ``t`` of the template votes for the
diagonal ``p - t``: a copy of the template puts all its votes on one diagonal, one with words
put in or left out on a few close ones.  Votes are summed by diagonal, close diagonals merge,
and a merged span counts when it covers enough of the template and is not much longer.

Base phrases are short templates that must stand word for word: all their runs on one
diagonal.  Their starts are counted; the labels of other templates come on top.

Defined results: a NULL or empty text has no words, no places and the empty string as labels.
Repeated rows are scanned alike and all returned.  A table without rows gives none.  Other
columns of the input are not read.  Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clientele.llm.common import small_batches
from clientele.llm.words import LETTERS, shingle_hashes, words_of

RUN = 3
GAP = 4  # diagonals this close belong to one copy
COVERED = 0.8  # least share of a template's runs
STRETCH = 1.5  # a span may be so many times the template's length
MAX_TEMPLATE_WORDS = 20_000  # of all templates together: bounds the table that is broadcast


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False  # word for word, and counted


# The phrases to count, and the notices by which each license is known.
BASE_PHRASES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
)
NOTICES = (
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    Template("apache-2", "licensed under the apache license version 2 0"),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    Template("gpl-3", "licensed under the gnu general public license version 3"),
    Template("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by", "licensed under cc by 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("all-rights-reserved", "all rights reserved"),
)


def template_runs(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """Where each run of words stands in the templates: run, template, at, runs, label, base.

    Template -1 stands for the end mark of every text, whose run is NULL's stand-in 0.
    """
    rows = []
    for number, t in enumerate(templates):
        words = words_of(pa.array([t.text]), LETTERS).hash
        if len(words) < RUN:
            raise ValueError(f"a template needs {RUN} words: {t.text!r}")
        runs = shingle_hashes(words, RUN).astype(np.int64)
        rows += [(int(h), number, at, len(runs), t.label, t.base) for at, h in enumerate(runs)]
    if len(rows) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"{len(rows)} runs of template words; at most {MAX_TEMPLATE_WORDS} are broadcast")
    rows.append((0, -1, 0, 1, "", False))
    return spark.createDataFrame(rows, "run long, template int, at int, runs int, label string, base boolean")


def text_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: doc_id, copy (a hash of the text), n_words, runs (array of hashes).

    The last run is the end mark 0, so that texts without a hit are joined once too.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = words_of(batch.column(2), LETTERS)
            every = shingle_hashes(words.hash, RUN).astype(np.int64)
            n = np.diff(words.first)
            inside = np.maximum(n - RUN + 1, 0)
            # The runs of each text, without those that reach into the next one, and its mark.
            ends = np.cumsum(inside + 1)
            values = np.zeros(ends[-1] if len(ends) else 0, np.int64)
            places = np.ones(len(values), bool)
            places[ends - 1] = False
            at = np.repeat(words.first[:-1] - np.concatenate([[0], np.cumsum(inside)[:-1]]), inside) + np.arange(inside.sum())
            values[places] = every[at]
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n.astype(np.int64)), pa.ListArray.from_arrays(offsets, pa.array(values))],
                names=["doc_id", "copy", "n_words", "runs"],
            )

    small_batches(docs.sparkSession)
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("copy"), F.col(text).alias("text")
    ).mapInArrow(runs, "doc_id long, copy long, n_words long, runs array<long>")


def scan(docs: DataFrame, templates: Sequence[Template] = (*BASE_PHRASES, *NOTICES), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of licenses found: one row per text with places of base phrases and labels."""
    spark = docs.sparkSession
    key = ["doc_id", "copy", "n_words"]
    # A literal table of at most MAX_TEMPLATE_WORDS rows.
    hits = (
        text_runs(docs, doc_id, text)
        .select(*key, F.posexplode("runs").alias("p", "run"))
        .join(F.broadcast(template_runs(spark, templates)), "run")
        .select(*key, "template", "runs", "label", "base", "at", (F.col("p") - F.col("at")).alias("diagonal"))
    )
    # The end marks count the rows with this id and text; votes are sets, equal for all of them.
    votes = (
        hits.withColumn("diagonal", F.when(F.col("template") >= 0, F.col("diagonal")))
        .groupBy(*key, "template", "runs", "label", "base", "diagonal")
        .agg(F.collect_set("at").alias("ats"), F.count("*").alias("rows"))
    )
    same = [*key, "template"]
    nearby = Window.partitionBy(*same).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(nearby) > F.when(F.col("base"), 0).otherwise(GAP)
    merged = (
        votes.withColumn("span", F.sum(F.coalesce(apart, F.lit(False)).cast("int")).over(nearby))
        .groupBy(*same, "runs", "label", "base", "span")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("votes"),
            F.max(F.size("ats")).alias("straight"),
            F.min(F.col("diagonal") + F.array_min("ats")).alias("first"),
            F.max(F.col("diagonal") + F.array_max("ats")).alias("last"),
            F.min("diagonal").alias("start"),
            F.max("rows").alias("rows"),
        )
        .withColumn("share", F.col("votes") / F.col("runs"))
        .withColumn(
            "right",
            F.when(F.col("base"), F.col("votes") == F.col("runs")).otherwise(
                # One diagonal is enough by itself; merged ones must not be spread out.
                (F.col("straight") >= COVERED * F.col("runs"))
                | (F.col("share") >= COVERED)
                & (F.col("last") - F.col("first") + RUN <= STRETCH * (F.col("runs") + RUN - 1))
            )
            & (F.col("template") >= 0),
        )
    )
    base = F.col("right") & F.col("base")
    labels = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    found = merged.groupBy(*key).agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("right")).alias("labels"),
        F.coalesce(F.max(F.when(F.col("right"), F.col("share"))), F.lit(0.0)).alias("score"),
        F.array_sort(
            F.collect_list(
                F.when(F.col("right"), F.struct("first", (F.col("last") + RUN).alias("end"), "label", "share"))
            )
        ).alias("spans"),
        F.max(F.when(F.col("template") < 0, F.col("rows"))).alias("_rows"),
    )
    return found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int")))).drop("_copy", "_rows", "copy")
